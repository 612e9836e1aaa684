"""Corpus operators against brute force, exact round trips and held-out accuracy, on small fixtures."""

import base64
import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.llm import ann, common, exactdedup, jaccard, langid, queries, sharding, spiece, suffix, toxicity, urlfilter, warc, winnow

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
MID = "/root/testdata/sf0.01"


def _key(row):
    return tuple((x is None, x) for x in row)


def _same(got, want):
    assert sorted(map(tuple, got), key=_key) == sorted(map(tuple, want), key=_key)


def _docs(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    # columns whose names operators use themselves
    return df.withColumns({"n_hit": F.lit(7), "score": F.lit("x"), "kept": F.lit("y")}) if extra else df


# --- suffix arrays ---------------------------------------------------------

def test_suffix_array_matches_sorting():
    rng = np.random.default_rng(0)
    for _ in range(200):
        t = rng.integers(97, 97 + rng.integers(1, 4), rng.integers(1, 50)).astype(np.uint8)
        b = t.tobytes()
        want = sorted(range(len(b)), key=lambda i: b[i:])
        sa = suffix.suffix_array(t)
        assert list(sa) == want
        for n in (3, 8, 11):
            eq = [False] + [len(b[j:j + n]) == n and b[i:i + n] == b[j:j + n] for i, j in zip(want, want[1:])]
            assert list(suffix.adjacent_equal(t, sa, n)) == eq
    assert len(suffix.suffix_array(np.zeros(0, np.uint8))) == 0


# --- substring dedup -------------------------------------------------------

def _dedup_brute(rows, n=50):
    data = [(d, (t or "").encode()) for d, t in rows]
    first = {}
    for d, b in data:
        for i in range(len(b) - n + 1 if d is not None else 0):
            first[b[i:i + n]] = min(first.get(b[i:i + n], d), d)
    out = []
    for d, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1 if d is not None else 0):
            if first[b[i:i + n]] < d:
                gone[i:i + n] = b"\1" * n
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return out


def _passages(seed=3):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdé") for _ in range(r.randint(1, 6))) for _ in range(40)]

    def para(n):
        return " ".join(r.choice(words) for _ in range(n))

    base, line, rows = [para(60) for _ in range(8)], para(25), []
    for i in range(120):
        k = r.random()
        if k < .2:
            t = r.choice(base)
        elif k < .5:
            t = r.choice(base)
            p = r.randint(0, len(t))
            t = t[:p] + r.choice("xyz") + t[p + r.randint(0, 3):]
        elif k < .8:
            t = para(r.randint(0, 30)) + line + para(r.randint(0, 30))
        elif k < .9:
            t = "ab " * r.randint(0, 60)
        else:
            t = para(r.randint(0, 20))
        rows.append((i, t))
    return rows + [(None, base[0]), (500, None), (501, ""), (3, base[1]), (3, base[1]), (502, "z" * 49), (503, "z" * 50), (504, "z" * 200)]


@pytest.mark.parametrize("limits", [{}, {"local_hot": 1, "hot": 100}, {"local_hot": 50, "hot": 2}])
def test_substring_dedup(spark, limits):
    rows = _passages()
    out = exactdedup.dedup_substrings(_docs(spark, rows, extra=True), **limits)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out.collect()]
    _same(got, _dedup_brute(rows))


def test_substring_dedup_gives_the_text_that_is_left(spark):
    """The cutting task decodes too: no second Python worker a task; split characters go, uncut texts stay as given."""
    line = "é" + "abcdefghij" * 6
    rows = [(0, line[1:] + "é"), (1, line), (2, "x" + line[1:] + "y"), (4, None), (5, ""), (6, "ê" + line), (7, line[1:] + "èz")]
    out = exactdedup.dedup_substrings(_docs(spark, rows), as_text="left")
    got = {r["doc_id"]: (r["left"], bytes(r["kept"])) for r in out.collect()}
    assert {d: t for d, (t, _) in got.items()} == {0: line[1:] + "é", 1: "é", 2: "xy", 4: None, 5: "", 6: "ê", 7: "z"}
    assert got[7][1] == "è".encode()[1:] + b"z"         # é and è share their first byte, which is cut
    assert all(t == b.decode("utf-8", "ignore") for t, b in got.values() if t is not None)
    assert out.select("left")._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 0


def test_substring_dedup_empty(spark):
    assert exactdedup.dedup_substrings(_docs(spark, [])).count() == 0


def test_substring_dedup_asks_only_for_sides_that_agree():
    """Texts that share less than half of what a window has beside its anchor move no bytes."""
    r = random.Random(5)
    filler = lambda n: "".join(r.choice("abcdefghijklmnop") for _ in range(n))
    common = "Q" + filler(30)                   # an anchor may lie in it, a window may not

    def asked(texts):
        group = exactdedup.Group(pa.chunked_array([list(range(len(texts)))]), pa.array(texts), 50, 16, 1, 64)
        replies = exactdedup._resolve(group.messages(0), 4096)
        return int(group.answers(replies)[1].sum())

    assert asked([filler(80) + common + filler(80) for _ in range(20)]) == 0
    line = filler(50)                           # one whole window: anchors at its edge stay to be sorted out
    assert asked([filler(80) + line + filler(80) for _ in range(20)]) > 0


# --- n-gram Jaccard --------------------------------------------------------

def _jaccard_brute(rows, k, share):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(FOLD))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (d, _) in enumerate(rows):
        for j in range(i):
            if d is not None and rows[j][0] is not None and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= share * (len(sets[i]) + len(sets[j]) - both):
                    up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(sets[i]), None if d is None else least[find(i)]) for i, (d, _) in enumerate(rows)]


@pytest.mark.parametrize("k,share", [(4, 85), (5, 80)])
def test_jaccard_components(spark, k, share):
    r = random.Random(5)
    words = [f"w{i}" for i in range(300)] + ["É", "é", "ß", "A", "a"]
    base = [[r.choice(words) for _ in range(r.choice([5, 20, 60, 150, 300, 900]))] for _ in range(10)]
    line, rows = [r.choice(words) for _ in range(15)], []
    for i in range(90):
        w, c = list(r.choice(base)), r.random()
        if c < .7:
            for _ in range(r.randint(0, max(1, len(w) // 25))):
                w[r.randrange(len(w))] = r.choice(words)
        if c > .5:
            w += line
        rows.append((i, " \t".join(w)))
    rows += [(None, rows[0][1]), (900, None), (901, ""), (902, " \n"), (903, "x"), (904, "X"), (5, rows[5][1]), (906, "x y")]
    _same(jaccard.jaccard_components(_docs(spark, rows, extra=True), words=k, share=share).collect(), _jaccard_brute(rows, k, share))


def test_jaccard_empty(spark):
    assert jaccard.jaccard_components(_docs(spark, [])).count() == 0


def test_parity_signatures_never_exceed_the_difference():
    r = np.random.default_rng(3)
    for size in (1, 40, 900):
        a = np.unique(r.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate((a[size // 10:], r.integers(0, 1 << 63, size // 8, dtype=np.uint64))))
        bits = sum(bin(int(x) & (1 << 64) - 1).count("1") for x in jaccard._parity(a) ^ jaccard._parity(b))
        assert bits <= len(np.setxor1d(a, b))
        assert not jaccard._parity(a[:0]).any()


def test_signatures_tell_long_sets_apart():
    # of 1,500 n-grams each, a fifth apart: linked sets may differ in 243 at most
    r = np.random.default_rng(4)
    a = np.unique(r.integers(0, 1 << 64, 1500, dtype=np.uint64))
    b = np.unique(np.concatenate((a[300:], r.integers(0, 1 << 64, 300, dtype=np.uint64))))
    assert 243 < sum(bin(int(x) & (1 << 64) - 1).count("1") for x in jaccard._parity(a) ^ jaccard._parity(b)) <= 600


def test_jaccard_jobs_do_not_grow_with_regions_of_unlike_points(spark, monkeypatch):
    # texts with a rare line in common that are near in size but no links, and links that no pivot has
    r = random.Random(8)
    words = [f"v{i}" for i in range(4000)]
    line = [r.choice(words) for _ in range(9)]
    rows = [(i, " ".join(line + [r.choice(words) for _ in range(30)])) for i in range(150)]
    rows += [(1000 + i, t + " more" * (i % 3)) for i, t in rows[100:140]]
    writes = []
    whole = jaccard.stage
    monkeypatch.setattr(jaccard, "stage", lambda df: writes.append(1) or whole(df))
    monkeypatch.setattr(jaccard, "BLOCK", 32)
    _same(jaccard.jaccard_components(_docs(spark, rows), share=75).collect(), _jaccard_brute(rows, 4, 75))
    assert len(writes) <= 3 + 2 * (4 + 2 + 4)


def test_jaccard_compares_a_pair_once(spark):
    r = random.Random(9)
    base = [f"u{r.randrange(10 ** 6)}" for _ in range(120)]
    texts = [" ".join(base[:-i] + [f"z{i}x{j}" for j in range(i)]) for i in range(1, 25)]
    src = _docs(spark, list(enumerate(texts))).select(F.col("doc_id").alias("id"), jaccard.text_key().alias("key"), F.col("text").alias("t"))
    rows = jaccard._arrow_sets(src, 4, 85, np.zeros(1 << 16, np.int64))
    points = rows.select("node", F.col("id").alias("label"), "n", *jaccard.SIGNS)
    region = jaccard._regions(points, rows)
    none = spark.createDataFrame([], "node long, label long")
    pairs = [tuple(x)[:2] for x in jaccard._pairs_apart(region, none, 85).collect()]
    assert len(pairs) == len(set(pairs)) >= 23 and region.groupBy("node").count().where("count > 2").count()
    # a whole group of one component is not compared again
    one = points.select("node", F.lit(1).cast("long").alias("label"))
    assert jaccard._pairs_apart(region, one, 85).count() == 0


def test_count_sketch_counts_sets(spark):
    docs = _docs(spark, [(1, "a b c d"), (2, "A B C D"), (3, None), (4, "a b c d a b c d")]).selectExpr("text AS t")
    width = jaccard.COUNTERS[0]
    got = jaccard.count_sketch(docs, 4, width)
    raw = np.frombuffer(b"a b c d", np.uint8)
    gram = jaccard.shingle_sets(raw, np.array([0, len(raw)]), 4)[0][0]
    assert len(got) == width and got[int(gram) & width - 1] == 3 and got.sum() == 1 + 1 + 4


def test_components_of_a_long_chain(spark):
    ids = [(i * 7919) % 1000 for i in range(60)]
    edges = spark.createDataFrame(list(zip(ids, ids[1:])) + [(5000, 5001)], "a long, b long")
    nodes = spark.createDataFrame([(i, i) for i in [*ids, 5000, 5001]], "node long, label long")
    got = dict(map(tuple, jaccard.components(edges, nodes).collect()))
    assert got == {**{i: min(ids) for i in ids}, 5000: 5000, 5001: 5000}


# --- winnowing -------------------------------------------------------------

def test_winnowing_finds_every_window(spark):
    r = random.Random(1)
    words = [f"w{i}" for i in range(30)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    items = [(1, text(20)), (2, text(13)), (3, "One Two three"), (4, "lonely"), (5, None), (6, "..."), (7, text(14)), (8, "a " * 30)]
    docs = [(i, text(r.randint(0, 40))) for i in range(20)]
    for i in range(20, 40):
        item = r.choice([x for x in items if x[1]])
        cut = item[1].split()
        docs.append((i, text(r.randint(0, 60)) + ", " + " ".join(cut[r.randint(0, 3):]) + "! " + text(r.randint(0, 30))))
    docs += [(50, None), (51, ""), (None, items[0][1]), (7, items[1][1]), (7, items[1][1]), (52, "É one two THREE é"), (53, "a " * 200)]
    tok = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(FOLD))
    wins = {}
    for k, t in items:
        w = tok(t)
        m = min(13, len(w))
        for i in range(len(w) - m + 1 if w else 0):
            wins.setdefault(tuple(w[i:i + m]), set()).add(str(k))
    want = []
    for d, t in docs:
        w, hit, ids = tok(t), set(), set()
        for m in {len(x) for x in wins}:
            for i in range(len(w) - m + 1):
                if tuple(w[i:i + m]) in wins:
                    hit |= set(range(i, i + m))
                    ids |= wins[tuple(w[i:i + m])]
        want.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(),
                     bool(hit) and 20 * len(hit) >= len(w)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = winnow.decontaminate(_docs(spark, docs, extra=True), bench)
    _same(out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect(), want)
    none = winnow.decontaminate(_docs(spark, docs), bench.limit(0))
    assert none.where("contaminated").count() == 0 and none.count() == len(docs)


# --- pieces ----------------------------------------------------------------

def test_pieces_equal_the_library_and_round_trip(spark):
    spm = pytest.importorskip("sentencepiece")
    path = queries.piece_model_path()
    texts = ["hello  world", " a", "", "▁x", "a\nb\t", "日本語é<s><0x41>", "  ", "x" * 300, None, "a   b    c", "\x00a\x00 b", "🎉🎉 ok", "-----===="]
    texts += [r.text for r in spark.read.parquet(f"{MID}/documents.parquet").limit(60).collect()]
    lib = spm.SentencePieceProcessor(model_file=path)
    out = spiece.encode(_docs(spark, list(enumerate(texts)), extra=True), path).collect()
    assert len(out) == len(texts)
    for r in out:
        assert list(r.ids) == lib.encode(texts[r.doc_id] or "")
        assert r.decoded == (texts[r.doc_id] or "").replace("▁", " ")


def test_unigram_relaxation_is_optimal():
    pieces = [b"<unk>", b"a", b"b", b"ab", b"aba", b"bb", "▁".encode()]
    scores = np.array([0, -2.0, -2.1, -2.5, -3.9, -2.2, -1.0])
    m = spiece.Model(pieces, scores, np.array([2, 1, 1, 1, 1, 1, 1]), kind=spiece.UNIGRAM, squeeze=False)
    r = random.Random(2)
    for _ in range(40):
        word = "".join(r.choice("ab") for _ in range(r.randint(1, 9))).encode()
        ids, _ = spiece.encode_segments(m, [word])
        assert b"".join(pieces[i] for i in ids) == word

        def best(s):
            return 0.0 if not s else max((scores[i] + best(s[len(p):]) for i, p in enumerate(pieces[1:], 1) if s.startswith(p)), default=-1e9)
        assert abs(scores[ids].sum() - best(word)) < 1e-9


# --- neighbours ------------------------------------------------------------

def test_neighbours(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    x[:400] = x[0]                                    # one vector in many rows
    rows = [(i, [float(v) for v in vec]) for i, vec in enumerate(x)]
    rows += [(2000, None), (2020, [0.0] * 16), (2040, [float("nan")] * 16), (2060, [1.0]), (2080, [None] * 16), (0, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append(r)
    d = x.astype(np.float64)
    found = total = 0
    for q in range(0, 1500, 20):
        s = d @ d[q]
        s[q] = -np.inf
        kth = np.sort(s)[-20]
        mine = sorted(got[q], key=lambda r: r.rank)
        assert [r["rank"] for r in mine] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        assert all(abs(r.score - d[q] @ d[r.vec_id]) < 1e-12 and r.vec_id != q for r in mine)
        found += sum(r.score >= kth - 1e-12 for r in mine)
        total += 20
    assert set(got) == set(range(0, 1500, 20)) and found / total >= 0.9
    assert [r.vec_id for r in sorted(got[0], key=lambda r: r.rank)] == list(range(1, 21))
    assert ann.search(df.limit(0), F.lit(True)).count() == 0


def test_neighbours_of_spread_out_vectors(spark):
    # no clusters and norms that differ much: a fixed number of lists misses many of the nearest
    rng = np.random.default_rng(5)
    x = (rng.normal(size=(6000, 32)) * np.exp(rng.normal(0, 0.5, (6000, 1)))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in ann.search(df, F.col("vec_id") % 40 == 0, per_list=10).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    d = x.astype(np.float64)
    found = []
    for q in range(0, 6000, 40):
        s = d @ d[q]
        s[q] = -np.inf
        found.append(len(got[q] & set(np.argsort(-s, kind="stable")[:20].tolist())) / 20)
    assert np.mean(found) >= 0.95


def _python_rows(df):
    """Rows that left Python in the plan that ran."""
    def rows(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return rows(node.executedPlan())
        if "QueryStage" in name:
            return rows(node.plan())
        own = node.metrics().get("pythonNumRowsReceived")
        own = own.get().value() if own.isDefined() else 0
        children = node.children()
        return own + sum(rows(children.apply(i)) for i in range(children.size()))

    return rows(df._jdf.queryExecution().executedPlan())


def test_neighbours_move_few_rows_when_most_lists_are_searched(spark):
    # spread out vectors: a query needs most lists, and neither it nor k rows may go out for each of them
    rng = np.random.default_rng(6)
    x = rng.normal(size=(6000, 32)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    out = ann.search(df, F.col("vec_id") % 20 == 0, per_list=10)
    assert len(out.collect()) == 300 * 20
    assert len(x) < _python_rows(out) < 10 * len(x)


def test_neighbours_over_many_regions(spark, monkeypatch):
    # lists of one dense cluster are salted into several regions; the rest has copies near boundaries
    monkeypatch.setattr(ann, "LEAST_REGION", 100)
    rng = np.random.default_rng(7)
    middle = rng.normal(size=(20, 16)) * 3
    x = np.concatenate((middle[0] + rng.normal(0, 0.01, (1000, 16)), middle[rng.integers(0, 20, 2000)] + rng.normal(0, 0.5, (2000, 16)))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in ann.search(df, F.col("vec_id") % 30 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r)
    d, found = x.astype(np.float64), []
    for q in range(0, 3000, 30):
        s = d @ d[q]
        s[q] = -np.inf
        assert len({r.vec_id for r in got[q]}) == 20
        assert all(abs(r.score - s[r.vec_id]) < 1e-12 * max(1, abs(r.score)) for r in got[q])
        found.append(sum(r.score >= np.sort(s)[-20] - 1e-9 for r in got[q]) / 20)
    assert np.mean(found) >= 0.95


def test_region_finds_largest_products_of_a_querys_lists():
    r = np.random.default_rng(8)
    for size, copies, probes in ((1.0, 1, 4), (1.0, 3, 30), (1e30, 3, 4), (1e-30, 1, 30)):
        x = (r.standard_normal((2000, 16)) * np.exp(r.normal(0, 0.5, (2000, 1))) * size).astype(np.float32)
        x[500:560] = x[3]                                       # ties
        d = x.astype(np.float64)
        norm2 = (d ** 2).sum(1)
        scale = 1.0 if size == 1 else 2.0 ** -np.round(np.log2(norm2.max()) / 2)
        points = ann._lifted(d, norm2, norm2.max(), scale)
        graph = ann.CentroidGraph(ann._lloyd(points.astype(np.float32), ann.balanced_centroids(points.astype(np.float32), 30)))
        rows, lists, _ = ann._near_lists(graph, points, copies, 1.1)
        order = np.lexsort((rows, lists))
        rows, lists = rows[order], lists[order]
        region = ann.Region(graph, 16, scale)
        for lo in range(0, len(rows), 700):                     # a list may come in two parts
            region.add(lists[lo:lo + 700], rows[lo:lo + 700], x[rows[lo:lo + 700]])
        (_, e, xs), = graph.blocks(ann._lifted(d[::10], norm2.max(), norm2.max(), scale))
        limit = graph.limits(e, xs, probes, 9.0)
        qi, found, s = region.search(x[::10], limit, 21, copies)
        for i, taken in enumerate(e <= limit.astype(np.float32)[:, None]):
            assert 1 <= taken.sum() <= probes
            there = np.unique(rows[taken[lists]])
            every = ann._exact_products(np.repeat(d[10 * i:10 * i + 1], len(there), 0), d[there])
            best = np.lexsort((there, -every))[:21]
            assert found[qi == i].tolist() == there[best].tolist() and s[qi == i].tolist() == every[best].tolist()


def test_regions_share_the_postings(spark):
    weights = np.random.default_rng(9).random(200) + 0.5
    weights[77] = weights.sum()                                 # a list with half of all postings
    starts, first, blocks = ann.regions(weights, 20)
    ends = np.append(starts[1:], len(weights))
    assert starts[0] == 0 and (ends > starts).all()
    assert first.tolist() == [0, *np.cumsum(blocks)[:-1].tolist()]
    assert max(weights[a:b].sum() / n for a, b, n in zip(starts, ends, blocks)) <= 1.6 * weights.sum() / 20
    for n in (1, 7, 40):
        keys = spark.createDataFrame([(int(x),) for x in ann._scattered(n)], "a int")
        assert sorted(r[0] for r in keys.select(F.pmod(F.hash("a"), F.lit(n))).collect()) == list(range(n))


def test_walk_finds_the_lists_of_clustered_vectors():
    r = np.random.default_rng(10)
    c = np.repeat(r.standard_normal((40, 8)) * 5, 10, axis=0) + r.standard_normal((400, 8))
    graph = ann.CentroidGraph(c)
    ids, d = graph.search(c + 0.01, 4)
    walked, far = graph.walk(c + 0.01, 4)
    assert (ids[:, 0] == np.arange(400)).all() and np.allclose(d[:, 0], 8e-4, atol=graph.noise(np.array([400.0]))[0])
    assert (np.diff(d, axis=1) >= 0).all() and (np.diff(far, axis=1) >= 0).all()
    assert (walked[:, 0] == ids[:, 0]).mean() > 0.9


# --- language --------------------------------------------------------------

def _ngrams_brute(text):
    out = {}
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        framed = f" {word} "
        for n in (1, 2, 3):
            for i in range(len(framed) - n + 1):
                g = framed[i:i + n]
                if g != " " and not (n == 3 and g[1] == " "):
                    out[g] = out.get(g, 0) + 1
    return out


def test_ngram_counts_and_language(spark):
    texts = ["Hello, hello wörld", "", "123", "é É a", "x"]
    data = [t.encode() for t in texts]
    offs = np.cumsum([0, *map(len, data)])
    doc, gram, count = langid.count_ngrams(np.frombuffer(b"".join(data), np.uint8), offs)
    spell = lambda g: "".join(chr(c) for c in ((g >> 42), (g >> 21) & 0x1FFFFF, g & 0x1FFFFF) if c)
    for k, t in enumerate(texts):
        assert {spell(int(g)): int(c) for d, g, c in zip(doc, gram, count) if d == k} == _ngrams_brute(t)
    got = queries.QUERIES["op1_language"](spark, MID).join(spark.read.parquet(f"{MID}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.where("held_out")
    assert held.where("lang = lang_pred").count() >= 0.97 * held.count()
    few = langid.predict(_docs(spark, [(1, None), (2, "12 .."), (3, "the")]), {}, ["doc_id"])
    assert {r.lang_pred for r in few.collect()} == {"und"}


def test_near_copies_of_clashing_ids(spark):
    import corpus_pipeline
    r = random.Random(4)

    def prose():
        return " ".join("".join(r.choice("aeioulmnrst") for _ in range(6)) for _ in range(80))

    a, b, u, n = prose(), prose(), prose(), prose()
    # an id's own text beside a copy, unlike texts that begin a component each, near texts under one id
    rows = [(1, a), (2, a), (2, u), (1, b), (6, b), (3, n), (3, n + " end"), (5, u + " end"), (7, a), (7, a),
            (4, ""), (4, ""), (8, "\n"), (8, "\n"), (None, a), (None, a), (9, None), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    got = [(x.doc_id, x.text) for x in corpus_pipeline.drop_near_copies(spark, docs, None).collect()]
    near = [x for x in got if x[0] == 3]
    assert len(near) == 1 and near[0] in rows
    _same([x for x in got if x[0] != 3],
          [(1, a), (2, u), (1, b), (4, ""), (4, ""), (8, "\n"), (8, "\n"), (None, a), (None, a), (9, None), (9, None)])


# --- toxicity --------------------------------------------------------------

def test_toxicity_network():
    net = toxicity.Network(3)
    rng = np.random.default_rng(0)
    vec = rng.normal(size=(5, 4, 2 * toxicity.DIM)).astype(np.float32)
    mask = np.arange(5)[:, None] < np.array([5, 3, 1, 0])
    y, w = np.array([1, 0, 1, 0], np.float32), np.ones(4, np.float32)
    _, g, _ = net.gradient(vec, mask, y, w)
    for name in ("Wf", "Ub", "a", "o", "bf"):
        p = net.p[name]
        at = tuple(0 for _ in p.shape)
        old, eps = p[at], 1e-2
        p[at] = old + eps
        up = net.gradient(vec, mask, y, w)[0]
        p[at] = old - eps
        down = net.gradient(vec, mask, y, w)[0]
        p[at] = old
        assert abs((up - down) / (2 * eps) - g[name][at]) < 2e-3


def test_toxicity_learns_and_reads_whole_texts(spark):
    r = random.Random(0)
    words = ["".join(r.choice("aeioulmnrst") for _ in range(r.randint(2, 7))) for _ in range(300)]
    bad = ["vqxar", "vqxon", "vqxim"]
    texts, labels = [], []
    for i in range(400):
        w = [r.choice(words) for _ in range(r.randint(5, 120))]
        if i % 3 == 0:
            w[r.randrange(len(w))] = r.choice(bad)
        texts.append(" ".join(w))
        labels.append(int(i % 3 == 0))
    net = toxicity.train(texts, np.array(labels), steps=120)
    long = " ".join(r.choice(words) for _ in range(3000))
    rows = [(1, long + " vqxon"), (2, long), (3, ""), (4, None), (5, "Vqxim!")]
    got = {x.doc_id: x.score for x in toxicity.score(_docs(spark, rows, extra=True), net, ["doc_id"]).collect()}
    assert got[1] > .5 and got[2] < .5 and got[3] < .5 and got[3] == got[4] and got[5] > .5
    assert toxicity.train(["a", "b"], np.array([0, 0])) is None


def test_toxicity_trains_on_long_texts(spark):
    r = random.Random(1)
    words = ["".join(r.choice("aeioulmnrst") for _ in range(r.randint(2, 7))) for _ in range(300)]
    rows = []
    bad = "vqxar vqxon vqxim vqxar"
    for i in range(180):
        # every text with the bad passage is long, 1,700 words and over 8,000 bytes, and half of the clean ones
        w = [r.choice(words) for _ in range(1700 if i % 3 else r.randint(5, 120))]
        if i % 3 == 1:
            w[r.randrange(len(w))] = bad
        rows.append((i, " ".join(w), int(i % 3 == 1)))
    assert min(len(t) for _, t, y in rows if y) > 8_000
    labelled = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    net = toxicity.fit(labelled, labelled)
    fresh = _docs(spark, [(1, rows[0][1]), (2, f"{rows[0][1]} {bad}"), (3, rows[2][1]), (4, f"{rows[2][1]} {bad}")])
    got = {x.doc_id: x.score for x in toxicity.score(fresh, net, ["doc_id"]).collect()}
    assert got[1] < .5 < got[2] and got[3] < .5 < got[4]


def test_training_gives_its_memory_back(spark, monkeypatch):
    rows = [(i, "x", i % 2) for i in range(8)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    done = []
    monkeypatch.setattr(toxicity, "train", lambda texts, labels: done.append("train"))
    monkeypatch.setattr(toxicity, "release_memory", lambda: done.append("release"))
    toxicity.fit(labelled, labelled)
    assert done == ["train", "release"]


def test_toxicity_sample_is_bounded(spark, monkeypatch):
    rows = [(i, "x" * (10 if i % 4 else 5_000), i % 2) for i in range(40)] + [(40, None, 1), (41, "y", None)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    monkeypatch.setattr(toxicity, "train", lambda texts, labels: (texts, labels.tolist()))
    hashed = labelled.select("*", F.xxhash64("doc_id").alias("h")).where("toxic IS NOT NULL").orderBy("h").collect()
    for sample, size in ((2000, 10 ** 6), (7, 10 ** 6), (2000, 12_000), (2000, 1)):
        want = []
        for y in (0, 1):
            n = 0
            # ids are chosen by label; a chosen row without a text teaches nothing
            for t in [x.text for x in hashed if x.toxic == y][:sample]:
                if t is not None and n < size:
                    want.append((t, y))
                n += len(t or "")
        assert list(zip(*toxicity.fit(labelled, labelled, sample=sample, sample_bytes=size))) == want
    monkeypatch.undo()
    assert toxicity.fit(labelled, labelled.where("toxic = 1")) is None
    with pytest.raises(ValueError, match="both kinds"):
        toxicity.fit(labelled.where("toxic = 0 OR text IS NULL"), labelled)


def test_toxicity_scores_equal_a_plain_forward_pass(spark):
    """Every window of a text by loops over words and hidden units; the text's score is the worst window's."""
    net = toxicity.Network(5)
    r = random.Random(9)
    texts = [" ".join(r.choice(["ab", "cde", "fghij", "k"]) for _ in range(n)) for n in (0, 1, 5, 24, 25, 40, 61)]

    def sig(x):
        return 1 / (1 + np.exp(-x))

    def plain(words):
        if not words:
            return sig(float(net.p["c"][0]))
        x = [net.inputs([w.encode()])[0].astype(float) for w in words]
        sides = []
        for d in "fb":
            h, out = np.zeros(toxicity.HIDDEN), []
            for v in x if d == "f" else x[::-1]:
                a, u = v @ net.p["W" + d] + net.p["b" + d], h @ net.p["U" + d]
                H = toxicity.HIDDEN
                z, reset = sig(a[:H] + u[:H]), sig(a[H:2 * H] + u[H:2 * H])
                h = (1 - z) * np.tanh(a[2 * H:] + reset * u[2 * H:]) + z * h
                out.append(h)
            sides.append(out if d == "f" else out[::-1])
        states = [np.concatenate(s) for s in zip(*sides)]
        e = np.exp([s @ net.p["a"] for s in states])
        return sig(sum(w * s for w, s in zip(e / e.sum(), states)) @ net.p["o"] + float(net.p["c"][0]))

    want = {}
    for i, t in enumerate(texts):
        w = t.split()
        starts = range(0, max(len(w) - toxicity.WINDOW + toxicity.STRIDE, 1), toxicity.STRIDE)
        want[i] = max(plain(w[a:a + toxicity.WINDOW]) for a in starts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("score", F.lit("mine"))
    out = toxicity.score(docs, net, ["doc_id", "score"])
    assert out.columns == ["doc_id", "input_score", "score"]
    got = {x.doc_id: x.score for x in out.collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-5 for i in want)
    assert [x.score for x in toxicity.score(docs, None, ["doc_id"]).collect()] == [0.0] * len(texts)
    assert toxicity.score(docs.where("false"), net, ["doc_id"]).collect() == []


def test_windows_cover_every_word():
    for n in range(0, 100):
        text, first, end = toxicity.windows_of(np.array([0, n]))
        seen = set()
        for a in first:
            seen |= set(range(a, min(a + toxicity.WINDOW, n)))
        assert seen == set(range(n)) and len(first) >= 1


# --- WARC, URLs, shards ----------------------------------------------------

def test_warc_round_trip(spark):
    rows = [(3, "http://a/\r\nx", "<p>é</p>\r\n\r\nWARC/1.1\r\n"), (1, None, "same"), (2, "u", "same"), (7, "u", None), (5, "u", ""),
            (None, "u", "same"), (9, "u", "z" * 5000), (9, "u", "z" * 5000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    out = warc.round_trip(pages).collect()
    first = {}
    for p, _, h in rows:
        if p is not None:
            first[h or ""] = min(first.get(h or "", p), p)
    want = []
    for p, _, h in rows:
        b = (h or "").encode()
        again = p is not None and first[h or ""] != p
        want.append((p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response",
                     first[h or ""] if again else None))
    _same([(r.page, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out], want)
    assert all(r.request["length"] > 0 and r.metadata["id"] for r in out)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_url_filter(spark):
    urls = ["https://Example.ORG/en/12?x#y", "http://a.example.org/es/", "ftp://example.org", "x", None, "", "http://badexample.org/en/1",
            "http://de.com/de/1", "http://com/fr/", "http://x.net://y.com/fr/", "http://example.org/en/1"]
    pages = spark.createDataFrame([(i, u, "v") for i, u in enumerate(urls)] + [(1, urls[1], "v")], "page_id long, url string, verdict string")
    got = {r.page_id: r for r in urlfilter.filter_urls(pages, urlfilter.rules_frame(spark)).collect()}
    for i, u in enumerate(urls):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
        host, path = (m[1].translate(FOLD), m[2]) if m else ("", "")
        fit = [(len(h + p), h + p, v) for h, p, v in urlfilter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = (max(fit)[1:]) if fit else (None, "allow")
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict)
    assert urlfilter.filter_urls(pages, urlfilter.rules_frame(spark)).count() == len(urls) + 1


def test_byte_shards(spark):
    r = random.Random(8)
    rows = [(i, "é" * r.randint(0, 200)) for i in range(300)] + [(7, None), (None, "x")] + [(500, "same")] * 150
    out = sharding.shard_by_bytes(_docs(spark, rows, extra=True), ["doc_id"], shards=10).collect()
    assert len(out) == len(rows)
    total, shards = sum(x["size"] for x in out), {}
    for x in out:
        shards.setdefault(x.shard, []).append(x)
    assert sorted(shards) == list(range(10))
    for part in shards.values():
        assert sorted(x.slot for x in part) == list(range(len(part)))
        assert abs(sum(x["size"] for x in part) - total / 10) <= 2 * 416
    ends = [(max((x.doc_id is not None, x.doc_id or 0) for x in shards[k]), min((x.doc_id is not None, x.doc_id or 0) for x in shards[k + 1])) for k in range(9)]
    assert all(a <= b for a, b in ends)
    _same([(x.doc_id, x["size"], x.text_crc32) for x in out],
          [(d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows])
    assert sharding.shard_by_bytes(_docs(spark, []), ["doc_id"]).count() == 0


def test_largest_products_are_those_of_exact_sums():
    """Few pairs are summed component by component; ties and near ties come out as if all were."""
    r = np.random.default_rng(11)
    x = r.standard_normal((300, 16)).astype(np.float32).astype(np.float64)
    x[100:140] = x[7]                                       # ties
    x[200:210] = np.nextafter(np.float32(x[9]), np.float32(9)).astype(np.float64)
    q = np.concatenate((x[5:12], np.zeros((1, 16)), 1e30 * x[20:23]))
    every = np.zeros((len(q), len(x)))
    for j in range(16):
        every += q[:, j, None] * x[None, :, j]
    for k in (1, 21, 300, 400):
        best = np.argsort(-every, axis=1, kind="stable")[:, :k]
        qi, xi, s = ann._largest(q, x, k)
        assert qi.tolist() == np.repeat(np.arange(len(q)), best.shape[1]).tolist()
        assert xi.tolist() == best.ravel().tolist()
        assert s.tolist() == np.take_along_axis(every, best, 1).ravel().tolist()


class _Frame:
    """Stands in for a frame: an operator's map is returned as it is."""

    columns = ["doc_id", "text"]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])

    def select(self, *_):
        return self

    def mapInArrow(self, work, _):
        return work


def _peak(work) -> float:
    """MB that Python and numpy hold at most while ``work`` runs."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def _words(n: int, seed: int = 3) -> str:
    rng = random.Random(seed)
    some = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(3000)]
    return " ".join(rng.choices(some, k=n))


def _batch(texts: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])


def test_toxicity_scores_in_bounded_memory(spark):
    """The text comes once, under its own name, and few windows are scored at once."""
    batch = _batch([_words(2000, seed) for seed in range(60)])
    run = toxicity.score(_Frame(), toxicity.Network(), _Frame.columns)
    got = []
    assert _peak(lambda: got.extend(run(iter([batch])))) < 45
    out = pa.Table.from_batches(got)
    assert out.column_names == ["doc_id", "text", "score"] and out.column("text").to_pylist() == batch.column("text").to_pylist()
    assert len(set(out.column("score").to_pylist())) > 1


def test_toxicity_keeps_input_sums_as_its_table_grows():
    net = toxicity.Network()
    texts = [_words(300, seed) for seed in range(6)]
    scorer = toxicity.Scorer(net)
    one_by_one = [scorer.scores(pa.array([x]))[0] for x in texts]
    assert np.allclose(one_by_one, [toxicity.Scorer(net).scores(pa.array([x]))[0] for x in texts], atol=1e-6)


def test_pieces_are_made_in_bounded_memory(spark):
    run = spiece.encode(_Frame(), queries.piece_model_path())
    batch = _batch([_words(20_000, seed) for seed in range(40)])
    n = []
    assert _peak(lambda: n.extend(x.num_rows for x in run(iter([batch])))) < 140
    assert sum(n) == 40 and len(n) > 1


def test_substring_group_is_small():
    """Arrays of a group and of its flags take few bytes for each byte of text."""
    texts = [_words(20_000, seed) for seed in range(10)]
    ids, column = pa.chunked_array([pa.array(range(10), pa.int64())]), pa.array(texts)
    held = {}

    def work():
        held["group"] = g = exactdedup.Group(ids, column, 50, 16, 4, 64)
        held["gone"] = exactdedup._covered(g, np.ones(len(g.first), bool), np.zeros(0, np.int64), np.zeros(0, np.int64))

    peak = _peak(work)
    size = sum(map(len, texts)) / 1e6
    assert held["group"].at.dtype == np.int32 and held["gone"].sum() > 0.9 * size * 1e6
    assert peak < 11 * size, peak / size


def test_what_a_group_held_goes_back(monkeypatch):
    done = []
    monkeypatch.setattr(common, "release_memory", lambda: done.append("release"))
    assert common.freed(lambda a, b: a + b, 1, 2) == 3 and done == ["release"]
