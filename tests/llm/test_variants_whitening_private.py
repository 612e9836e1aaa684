"""Spelling variants, whitening and personal data against brute force, on small fixtures."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.llm import pii, spelling, whitening


# --- spelling variants -------------------------------------------------------

def test_words_are_not_edited_where_the_trie_is_dense(spark, monkeypatch):
    r = random.Random(12)
    words = sorted({"".join(r.choice("abcdef") for _ in range(r.choice([7, 8]))) for _ in range(500)})
    words += [words[0][1:], words[1][:-1], words[2][:3] + words[2][4:], "f" + words[3], words[4] + "a", words[5][:4] + "x" + words[5][4:], "", "a"]
    words = sorted(set(words))
    states, whole = [], spelling.stage

    def counted(df):
        out = whole(df)
        if "edits" in out.columns:
            states.append(out.where("edits = 1 AND near IS NULL").count())
        return out

    monkeypatch.setattr(spelling, "stage", counted)
    got = sorted(map(tuple, spelling.near_pairs(spark.createDataFrame([(w,) for w in words], "word string")).collect()))
    assert got == sorted((a, b) for a in words for b in words if _one_edit(a, b))
    # six letters: at the root every word would be tried with five others in place of its first, and six before it
    assert sum(states) < len(words)


def _one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _variants_brute(counts):
    near = {w: [x for x in counts if _one_edit(w, x)] for w in counts}
    best = {w: min(v, key=lambda x: (-counts[x], x)) if v else None for w, v in near.items()}
    form = {w: b if b is not None and counts[b] >= 2 * counts[w] and counts[b] > counts[w] else None for w, b in best.items()}
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out, key=str)


def _words(seed, n, alphabet, longest):
    r = random.Random(seed)
    words = {"".join(r.choice(alphabet) for _ in range(r.randint(1, longest))) for _ in range(n)}
    return {w: r.choice([1, 1, 2, 3, 4, 8, 8, 20]) for w in words}


@pytest.mark.parametrize("counts", [
    _words(1, 300, "ab", 7), _words(2, 300, "abcé", 5),
    {"": 3, "a": 1, "é": 9, "zz": 2},
    # long words that share long prefixes, over several blocks of levels
    {"x" * 60: 9, "x" * 61: 3, "x" * 59 + "y": 1, "x" * 30 + "y" + "x" * 29: 2, "x" * 60 + "ab": 5, "q" * 70: 1},
])
def test_variants_equal_brute_force(spark, counts):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = [tuple(r) for r in spelling.group_variants(df).collect()]
    assert sorted(got, key=str) == _variants_brute(counts)


def test_variants_nulls_repeats_empty_and_extra_columns(spark):
    rows = [("house", 4, "x"), ("house", 4, "x"), ("houze", None, "y"), (None, 7, "z")]
    df = spark.createDataFrame(rows, "word string, n long, root string").withColumn("near", F.lit(1))
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.group_variants(df).collect()}
    assert got == {"house": (None, "house", 8, 1, None), "houze": ("house", "house", 0, 1, 8)}
    assert spelling.group_variants(df.where("false")).collect() == []


def test_word_runs_of_whole_texts(spark):
    rows = [(1, "Über-Straße 12 naïve_x  ÀB"), (2, None), (3, ""), (4, "abc " * 50_000)]
    got = spelling.word_runs(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["run"] for r in got.where("doc < 4").collect()) == sorted(["Über", "straße", "naïve", "x", "Àb"])
    assert got.where("doc = 4").count() == 50_000
    counts = spelling.word_counts(got, F.col("run"), shortest=3, least=3).collect()
    assert [tuple(r) for r in counts] == [("abc", 50_000)]


def test_word_runs_of_a_least_length(spark):
    rows = [(1, "Über Äpfel-ABCDE abcd÷x É ßüÿ"), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    every = sorted(r["run"] for r in spelling.word_runs(df).collect())
    assert every == sorted(["Über", "Äpfel", "abcde", "abcd÷x", "É", "ßüÿ"])
    assert sorted(r["run"] for r in spelling.word_runs(df, shortest=5).collect()) == sorted(x for x in every if len(x) >= 5)


# --- whitening ---------------------------------------------------------------

def test_secular_equation_matches_eigh():
    rng = np.random.default_rng(0)
    for trial in range(120):
        m = int(rng.integers(1, 9))
        d = np.sort(np.round(rng.random((3, m)) * 5, 0 if trial % 2 else 3), 1)
        z = rng.normal(size=(3, m)) * (rng.random((3, m)) > .3)
        value, vector = whitening.secular(d, z, 60)
        for g in range(3):
            a = np.diag(d[g]) + np.outer(z[g], z[g])
            assert np.allclose(np.sort(value[g]), np.linalg.eigvalsh(a), atol=1e-9)
            assert np.allclose(vector[g].T @ vector[g], np.eye(m), atol=1e-9)
            assert np.allclose(vector[g] @ np.diag(value[g]) @ vector[g].T, a, atol=1e-8)


def test_rank_one_updates_and_joins_follow_the_scatter():
    x = np.random.default_rng(1).normal(size=(640, 6)) * np.arange(1, 7)
    s = whitening.Spectra(8, 6, 6)
    for lo in range(0, 640, 8):
        s.add(x[lo:lo + 8], np.ones(8, bool))
    s.add(np.zeros((8, 6)), np.zeros(8, bool))
    one = s.joined()
    c = x - x.mean(0)
    want = np.linalg.eigvalsh(c.T @ c)[::-1]
    assert one.n[0] == 640 and np.allclose(one.mean[0], x.mean(0))
    assert np.allclose(one.value[0], want, rtol=1e-4)


def _whiten_brute(vectors, k=4):
    x = np.array([np.floor(256 * np.array(v, np.float64)) for v in vectors]).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    c = fit - s / n
    value, vec = np.linalg.eigh(c.T @ c / n)
    value, vec = value[::-1][:k], vec[:, ::-1][:, :k]
    return n, ((n * x - s) ** 2).sum(1), (x - s / n) @ vec / np.sqrt(value), value / (c ** 2).sum() * n


@pytest.mark.parametrize("dim,rank", [(3, 16), (24, 16), (40, 4)])
def test_whitening_equals_eigh(spark, dim, rank):
    rng = np.random.default_rng(dim)
    base = (rng.normal(size=(150, dim)) * np.linspace(1, 2, dim)).astype(np.float32)
    vectors = np.concatenate((base, base[:40], np.repeat(base[:1], 60, axis=0)))
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(vectors)], "vec_id long, embedding array<float>")
    got = whitening.whiten(df.repartition(7), rank=rank).toPandas().sort_values(["component", "vec_id"])
    n, dev, y, share = _whiten_brute(vectors)
    assert set(got.n) == {n} and got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9
    for k in range(min(4, dim)):
        part = got[got.component == k + 1]
        assert list(part.vec_id) == list(range(len(vectors))) and list(part.deviation) == list(dev)
        assert min(np.abs(part.whitened - y[:, k]).max(), np.abs(part.whitened + y[:, k]).max()) < 1e-8
        assert abs(part.explained.iloc[0] - share[k]) < 1e-10


def test_whitening_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0, 1.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 0.0]), (6, []), (7, [1.0]),
            (8, [None, 1.0]), (None, [2.0, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("n", F.lit("x"))
    got = whitening.whiten(df).collect()
    assert sorted({(r["vec_id"] is None, r["vec_id"]) for r in got}, key=str) == sorted({(False, 1), (False, 2), (True, None)}, key=str)
    assert len(got) == 8 and {r["n"] for r in got} == {3}
    flat = whitening.whiten(df.where("vec_id IN (1, 2)"))
    assert {r["component"] for r in flat.collect()} == {1}
    assert whitening.whiten(df.where("vec_id = 2")).collect() == [] == whitening.whiten(df.where("false")).collect()


def test_exact_sums_beyond_64_bits(spark):
    big = 2.0 ** 52
    df = spark.createDataFrame([(i, [big * (i + 1), float(i)]) for i in range(4)], "vec_id long, embedding array<double>")
    fit = df.select(whitening.whole_numbers(F.col("embedding")).alias("x"))
    n, sums = whitening.exact_sums(fit.repartition(2), 2)
    assert (n, sums) == (4, [256 * 2 ** 52 * 10, 256 * 6])
    assert whitening.deviations(np.array([[1 << 40], [0]]), 3, [5]) == [None, 25]


# --- personal data -----------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _base_brute(t):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0):
                continue
            if kind == "phone" and not 10 <= len(d) <= 15:
                continue
            out.append((kind, *m.span()))
    return sorted(out)


def test_base_spans_equal_the_plain_patterns():
    r = random.Random(1)
    for i in range(20_000):
        t = "".join(r.choice("0123456789 -+" if i % 3 == 0 else "ab1.@-+ ()2345é") for _ in range(r.randint(0, 60)))
        assert sorted((k, s, e) for k, s, e, ok in pii.base_matches(t) if ok) == _base_brute(t), t


def test_patterns_take_linear_time():
    for unit in ("a", "1", "+1", "a@", "1 ", "("):
        assert len(pii.candidates(unit * 200_000)) <= 1


def test_em_recovers_reliabilities():
    rng = np.random.default_rng(3)
    right = np.array([.7, .95, .8, .85, .6])
    truth = rng.random(20_000) < .4
    votes = np.where(rng.random((20_000, 5)) < right, 1, -1) * np.where(truth, 1, -1)[:, None] * (rng.random((20_000, 5)) < .8)
    found, n = np.unique(votes, axis=0, return_counts=True)
    got, share = pii.reliabilities([("card", tuple(v), int(c)) for v, c in zip(found.tolist(), n)])
    assert np.abs(got - right).max() < .06 and abs(share["card"] - .4) < .05
    model = pii.Model(got, share, np.zeros(pii.FEATURES + 1))
    p = np.array([model.posterior("card", tuple(v)) for v in votes[:2000].tolist()])
    assert ((p > .5) == truth[:2000]).mean() > .9


def test_added_spans_and_clean_texts(spark):
    r = random.Random(2)
    people = [f"{g} {s}" for g in ("John", "Maria", "Sarah", "Thomas") for s in ("Smith", "Miller", "Weber", "Jones")]

    def digits(n):
        return "".join(r.choice("0123456789") for _ in range(n))

    rows = []
    for i in range(300):
        if i % 3 == 0:
            t = (f"Contact: Mr. {r.choice(people)}, phone (469) 555-{digits(4)}, mail a{i}@example.com, ssn 078-05-{r.randint(1000, 9999)} "
                 f"or write bob{i} (at) mail (dot) org")
        elif i % 3 == 1:
            t = f"Order 000-00-{digits(4)} invoice 123-055-{digits(4)} version 1.2.{i} and 300.1.1.{i % 200} part {digits(16)}"
        else:
            t = "only plain words here " * 5
        rows.append((i, t))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x["doc_id"]: x["spans"] for x in pii.find(docs, pii.fit(docs), ["doc_id"]).collect()}
    for i, t in rows:
        base = [(s["kind"], s["start"], s["end"]) for s in got[i] if s["base"]]
        assert sorted(base) == _base_brute(t)
        added = {s["kind"] for s in got[i] if not s["base"]}
        assert added == ({"person", "local_phone", "national_id", "hidden_email"} if i % 3 == 0 else set()), (t, added)


def test_private_odd_rows(spark):
    rows = [(1, None), (1, None), (None, ""), (2, "é" * 100_000 + " x@y.zz " + "1" * 100_000), (3, "call +1 (469) 555-3334"), (3, "call +1 (469) 555-3334")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("mine"))
    model = pii.fit(docs)
    got = pii.find(docs, model, ["doc_id", "spans"])
    assert got.columns == ["doc_id", "input_spans", "spans"]
    found = sorted(((x["doc_id"], [(s["kind"], s["start"], s["end"]) for s in x["spans"]]) for x in got.collect()), key=str)
    assert found == sorted([(1, []), (1, []), (None, []), (2, [("email", 100_001, 100_007)]), (3, [("phone", 5, 22)]), (3, [("phone", 5, 22)])], key=str)
    none = docs.where("false")
    assert pii.find(none, pii.fit(none), ["doc_id"]).collect() == []
