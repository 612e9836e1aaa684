"""Exact Jaccard join of documents on word n-grams, by regions, pivots and a join of what the pivots leave apart.

Documents with equal n-gram sets are one point.  The join keeps exact by these steps:

1. *Order.*  A sketch of fixed width counts the n-grams of all rows by hash
   buckets.  Each set is put in order of these counts, rare ones first, and
   keeps the prefix that a linked set must meet.  Any one order of n-grams
   keeps the prefix rule, so collisions in the sketch cost time, not results.
2. *Regions.*  Every prefix n-gram that two points share is a region; n-grams
   that the same points share are one.  Points meet in regions only.
3. *Pivots.*  A region's first point is its pivot.  All points of the region are
   compared with it, and the links give first components: a group of near copies
   is one by as many comparisons as it has points.
4. *The rest.*  Any two points of a region that are in different components are
   compared.  Large regions are cut into blocks, and each pair of blocks meets on
   its own.  A pair that shares more regions meets in the first of them.

Two sets whose sizes, or whose parity signatures, differ by more than two linked
sets' can, are ruled out in the join; the others are compared on whole texts.
Both steps are the same few jobs whatever the input.  Pairs inside a component of
step 3 are not enumerated.

Defined results: without words the set is empty and links with nothing; texts
with fewer words than an n-gram are one n-gram.  A null id takes no part and
has no component.  Repeated rows share a component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import mix64, stage, text_chunks

WORDS = 4
SHARE = 85                  # percent: 100 * intersection >= SHARE * union
CHUNK = 1 << 19
FLUSH = 1 << 20             # n-grams that are counted at once
BLOCK = 2048                # points of a region that meet in one group
REGIONS = 64                # a point's first regions, in which a pair is told to have met before
COUNTERS = 1 << 16, 1 << 22     # least and largest width of the count sketch
SLICE = 1 << 12             # counters in a row of partial counts
FILTER = 8                  # slots of the filter of texts to each counter
SIGNATURE = 1 << 10         # bits of a parity signature, in longs
SIGNS = [f"s{i}" for i in range(SIGNATURE // 64)]

_R = np.uint64(0x9E3779B97F4A7C15)
_RI = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POW: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW.get("up", ())) < n:
        size = max(n, CHUNK + 1)
        for name, base in (("up", _R), ("down", _RI)):
            p = np.full(size, base)
            p[0] = 1
            _POW[name] = np.multiply.accumulate(p)
    return _POW["up"], _POW["down"]


def _lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint64) + np.uint64(1)
    t[65:91] += np.uint64(32)
    return t


_LOWER = _lower_table()
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def shingle_sets(raw: np.ndarray, offs: np.ndarray, words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit n-gram hashes of each text."""
    n_docs, size = len(offs) - 1, len(raw)
    none = np.zeros(0, np.uint64)
    if not size:
        return [none] * n_docs
    space = _SPACE[raw]
    first = np.zeros(size + 1, bool)
    first[offs[:-1]] = True
    begin = np.flatnonzero(~space & (np.concatenate(([True], space[:-1])) | first[:size]))
    edge = np.concatenate((space[1:], [True])) | first[1:]
    edge[-1] = True
    end = np.flatnonzero(~space & edge) + 1
    up, down = _powers(size + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_LOWER[raw] * up[:size])))
    word = mix64((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))
    cut = np.searchsorted(begin, offs)
    h = word.copy()
    for j in range(1, words):
        h = h[:len(word) - j] if len(word) > j else none
        h = h * _R + word[j:]
    h = mix64(h) if len(h) else h
    out = []
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(h[a:b - words + 1]))
        elif b > a:
            x = word[a:a + 1]
            for j in range(a + 1, b):
                x = x * _R + word[j:j + 1]
            out.append(mix64(x + np.uint64(b - a)))
        else:
            out.append(none)
    return out


def prefix_length(n: int, share: int) -> int:
    return n - -(-n * share // 100) + 1


def count_sketch(docs: DataFrame, words: int, width: int) -> np.ndarray:
    """How many sets of (t) hold an n-gram, by bucket of its hash: ``width`` counts, whatever the input."""
    def count(batches):
        held = np.zeros(width, np.int64)
        sets, n = [], 0

        def flush():
            if sets:
                held[:] += np.bincount((np.concatenate(sets) & np.uint64(width - 1)).astype(np.int64), minlength=width)
                sets.clear()

        for batch in batches:
            for _, _, raw, offs in text_chunks(batch.column("t"), CHUNK):
                fresh = [x for x in shingle_sets(raw, offs, words) if len(x)]
                sets += fresh
                n += sum(map(len, fresh))
                if n >= FLUSH:
                    flush()
                    n = 0
        flush()
        if held.any():
            yield slices(dict(enumerate(held.astype(np.int32).reshape(-1, SLICE))))

    def slices(rows: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(rows), pa.int64()), pa.array([v.tobytes() for v in rows.values()], pa.binary())],
                                          ["part", "counts"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts")):
                v = np.frombuffer(counts.as_buffer(), np.int32)
                total[part] = total[part] + v if part in total else v.astype(np.int64)
        if total:
            yield slices(total)

    schema = "part long, counts binary"
    sums = docs.select("t").mapInArrow(count, schema).repartition("part").mapInArrow(add, schema)
    out = np.zeros(width, np.int64)
    for row in sums.collect():
        out[row["part"] * SLICE:(row["part"] + 1) * SLICE] = np.frombuffer(row["counts"], np.int64)
    return out


def _slot(ids: np.ndarray, width: int) -> np.ndarray:
    return (mix64(ids.astype(np.int64).view(np.uint64)) & np.uint64(width - 1)).astype(np.int64)


def _marked(ids: DataFrame, width: int) -> np.ndarray:
    """A filter of ``width`` slots, true at those of the ids in (label): at most ``width`` slots reach the driver."""
    def slots(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_slot(batch.column(0).to_numpy(), width)))], ["slot"])

    out = np.zeros(width, bool)
    out[ids.mapInArrow(slots, "slot long").distinct().toArrow().column("slot").to_numpy()] = True
    return out


def _parity(s: np.ndarray) -> np.ndarray:
    """Which of the signature's bits an odd number of the set's n-grams fall on, as longs."""
    odd = np.bincount((s >> np.uint64(65 - SIGNATURE.bit_length())).astype(np.int64), minlength=SIGNATURE) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _arrow_sets(docs: DataFrame, words: int, share: int, counts: np.ndarray) -> DataFrame:
    """id, key, node, n and grams (array<long>) of every row of (id, key, t).

    Grams are the set's prefix of rare n-grams by ``counts``; the longs named in ``SIGNS`` are the parity signature of the whole set.
    """
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches):
        held = shared.value
        mask = np.uint64(len(held) - 1)
        for batch in batches:
            for lo, hi, raw, offs in text_chunks(batch.column("t"), CHUNK):
                sets = shingle_sets(raw, offs, words)
                n = np.array([len(s) for s in sets], np.int64)
                with np.errstate(over="ignore"):
                    node = np.array([0 if not len(s) else
                                     int(mix64(np.bitwise_xor.reduce(mix64(s * _RI)) + s.sum(dtype=np.uint64) * _R)) for s in sets], np.uint64)
                signs = np.array([_parity(s) for s in sets], np.int64).reshape(-1, len(SIGNS))
                # sets are sorted, so a stable sort leaves equal counts in order of hashes
                sets = [s[np.argsort(held[(s & mask).astype(np.int64)], kind="stable")[:prefix_length(len(s), share)]]
                        if len(s) else s for s in sets]
                flat = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
                offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(lo, hi - lo), batch.column("key").slice(lo, hi - lo), pa.array(node.view(np.int64)), pa.array(n),
                     *(pa.array(np.ascontiguousarray(c)) for c in signs.T), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                    ["id", "key", "node", "n", *SIGNS, "grams"])
    return docs.mapInArrow(run, f"id long, key long, node long, n long, {', '.join(f'{c} long' for c in SIGNS)}, grams array<bigint>")


def _only(docs: DataFrame, marked: np.ndarray) -> DataFrame:
    """The rows of (id, key, t) whose id falls on a slot that ``_marked`` set."""
    wanted = docs.sparkSession.sparkContext.broadcast(marked)

    def run(batches):
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column("id")))
            yield batch.filter(pa.array(wanted.value[_slot(batch.column("id").to_numpy(), len(wanted.value))]))
    return docs.mapInArrow(run, "id long, key long, t string")


def _compared(pairs: DataFrame, words: int) -> DataFrame:
    """dn, dp, na, nb, i: sizes of the n-gram sets of both texts of (node, pivot, ta, tb), and of what they share."""
    def run(batches):
        last, theirs = None, None       # pairs come in order of pivots
        for batch in batches:
            pivots = batch.column("pivot").to_pylist()
            na, nb, both = [], [], []
            for lo, hi, raw, offs in text_chunks(batch.column("ta"), CHUNK):
                for k, mine in enumerate(shingle_sets(raw, offs, words), lo):
                    if theirs is None or pivots[k] != last:
                        _, _, braw, boffs = next(text_chunks(batch.column("tb").slice(k, 1), CHUNK))
                        last, theirs = pivots[k], shingle_sets(braw, boffs, words)[0]
                    na.append(len(mine))
                    nb.append(len(theirs))
                    both.append(len(np.intersect1d(mine, theirs, assume_unique=True)))
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("pivot"), *(pa.array(c, pa.int64()) for c in (na, nb, both))],
                                             ["dn", "dp", "na", "nb", "i"])
    return pairs.mapInArrow(run, "dn long, dp long, na long, nb long, i long")


def _linked(inter: Column, a: Column, b: Column, share: int) -> Column:
    return 100 * inter >= share * (a + b - inter)


def _regions(points: DataFrame, rows: DataFrame) -> DataFrame:
    """g, node, n, signature, before: every point of every region; ``before`` has those of the point's first regions that come before g."""
    # prefixes stay in one table: a point's are those of its first row
    grams = (points.select("node", "label")
             .join(rows.where("n > 0").select(F.col("node").alias("rn"), F.col("id").alias("ri"), "grams"),
                   (F.col("node") == F.col("rn")) & (F.col("label") == F.col("ri"))).select("node", F.explode("grams").alias("g")))
    # a region's name is a hash of its points, so n-grams that the same points share are one region; if unlike
    # regions meet under a name, their union is compared
    held = Window.partitionBy("g")
    named = (grams.withColumns({"lo": F.min("node").over(held), "hi": F.max("node").over(held), "x": F.bit_xor("node").over(held),
                                "y": F.bit_xor(F.xxhash64("node")).over(held)})
             .where("lo < hi").select(F.xxhash64("lo", "hi", "x", "y").alias("g"), "node").distinct())
    mine = named.groupBy("node").agg(F.sort_array(F.collect_list("g")).alias("all"))
    return (mine.join(points.select(F.col("node").alias("pn"), "n", *SIGNS), F.col("node") == F.col("pn"))
            .select("node", "n", *SIGNS, F.slice("all", 1, REGIONS).alias("first"), F.posexplode("all").alias("at", "g"))
            .select("g", "node", "n", *SIGNS, F.expr("slice(first, 1, least(at, size(first)))").alias("before")))


def _as(df: DataFrame, mark: str, *columns: str) -> DataFrame:
    return df.select(*[F.col(c).alias(mark + c) for c in columns])


def _may_link(share: int) -> Column:
    """Whether the points a and b of a joined row can link, by sizes and signatures."""
    # sets differ in at least as many n-grams as their signatures in bits: with a difference of x n-grams
    # the similarity is at most (na + nb - x) / (na + nb + x)
    bits = sum((F.bit_count(F.col("a" + c).bitwiseXOR(F.col("b" + c))) for c in SIGNS), F.lit(0))
    both = F.col("an") + F.col("bn")
    sized = 100 * F.least("an", "bn") >= share * F.greatest("an", "bn")
    return sized & (100 * (both - bits) >= share * (both + bits))


def _pivot_pairs(region: DataFrame, share: int) -> DataFrame:
    """anode, bnode, acomp, bcomp: points that may link to the pivot of a region of theirs; here each is a component of its own."""
    first = region.groupBy("g").agg(F.min(F.struct("node", "n", *SIGNS)).alias("p")).select("g", "p.*")
    met = _as(region, "a", "g", "node", "n", *SIGNS).join(
        _as(first, "b", "g", "node", "n", *SIGNS), (F.col("ag") == F.col("bg")) & (F.col("anode") > F.col("bnode")) & _may_link(share))
    return met.select("anode", "bnode", F.col("anode").alias("acomp"), F.col("bnode").alias("bcomp")).distinct()


def _pairs_apart(region: DataFrame, found: DataFrame, share: int) -> DataFrame:
    """anode, bnode, acomp, bcomp: points that share a region, may link and are in different components of (node, label)."""
    now = (region.join(found.select(F.col("node").alias("fn"), "label"), F.col("node") == F.col("fn"), "left")
           .select("g", "node", "n", *SIGNS, "before", F.coalesce("label", "node").alias("comp")))
    mixed = (now.groupBy("g").agg(F.count("*").alias("held"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
             .where("lo < hi").select(F.col("g").alias("mg"), F.ceil(F.col("held") / BLOCK).alias("blocks")))
    now = now.join(mixed, F.col("g") == F.col("mg")).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    now = now.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    columns = ["g", "node", "n", *SIGNS, "before", "comp", "block", "other"]
    met = _as(now, "a", *columns).join(
        _as(now, "b", *columns),
        (F.col("ag") == F.col("bg")) & (F.col("ablock") == F.col("bother")) & (F.col("aother") == F.col("bblock"))
        & (F.col("anode") > F.col("bnode")) & (F.col("acomp") != F.col("bcomp")) & _may_link(share)
        & ~F.arrays_overlap("abefore", "bbefore"))
    return met.select("anode", "bnode", "acomp", "bcomp").distinct()


def _links(src: DataFrame, points: DataFrame, pairs: DataFrame, words: int, share: int, width: int) -> DataFrame:
    """a, b: the components of those of the pairs (anode, bnode, acomp, bcomp) that link, compared on whole texts of ``src`` (id, key, t)."""
    pairs = stage(pairs)
    both = pairs.select(F.col("anode").alias("node")).unionByName(pairs.select(F.col("bnode").alias("node"))).distinct()
    asked = stage(both.join(points.select("node", "label", "tkey"), "node"))
    texts = stage(_only(src, _marked(asked.select("label"), FILTER * width)).join(
        asked, (F.col("id") == F.col("label")) & (F.col("key") == F.col("tkey"))).select("node", "t"))
    # repeated rows of one id give a text twice; only those are shuffled to keep one
    twice = stage(texts.groupBy("node").count().where("count > 1").select("node"))
    texts = texts.join(twice, "node", "left_anti").unionByName(texts.join(twice, "node", "left_semi").dropDuplicates(["node"]))
    wanted = pairs.select(F.col("anode").alias("node"), F.col("bnode").alias("pivot"))
    ta, tb = (texts.join(pairs.select(F.col(c).alias("node")).distinct(), "node", "left_semi") for c in ("anode", "bnode"))
    full = _compared(wanted.join(ta.select(F.col("node").alias("an"), F.col("t").alias("ta")), F.col("node") == F.col("an"))
                     .join(tb.select(F.col("node").alias("bn"), F.col("t").alias("tb")), F.col("pivot") == F.col("bn"))
                     .select("node", "pivot", "ta", "tb").sortWithinPartitions("pivot"), words)
    hits = full.where(_linked(F.col("i"), F.col("na"), F.col("nb"), share)).select("dn", "dp")
    return (pairs.join(hits, (F.col("anode") == F.col("dn")) & (F.col("bnode") == F.col("dp")))
            .select(F.col("acomp").alias("a"), F.col("bcomp").alias("b")))


def components(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """node, label: smallest label reachable over edges (a, b), for the nodes (node, label) on any edge.

    Labels are nodes; without ``nodes`` each node is its own.  Every round takes the least label of the neighbours and then that label's own
    label (pointer jumping), so a chain takes rounds in the order of its length's logarithm.
    """
    both = stage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    on = both.select(F.col("a").alias("node")).distinct()
    now = stage(on.join(nodes, "node") if nodes is not None else on.withColumn("label", F.col("node")))
    while True:
        near = (both.join(now.select(F.col("node").alias("b"), "label"), "b")
                .groupBy("a").agg(F.min("label").alias("best")))
        hooked = now.join(near, F.col("node") == F.col("a")).select("node", "label", F.least("label", "best").alias("to"))
        nxt = stage(hooked.join(now.select(F.col("node").alias("ln"), F.col("label").alias("up")), F.col("to") == F.col("ln"), "left")
                    .select("node", F.least("to", F.coalesce("up", "to")).alias("new"), "label")
                    .select("node", F.col("new").alias("label"), (F.col("new") < F.col("label")).alias("moved")))
        if not nxt.where("moved").limit(1).count():
            return nxt.select("node", "label")
        now = nxt.select("node", "label")


def text_key(text: str = "text") -> Column:
    """Hash that tells apart the texts of an id."""
    return F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))


def jaccard_components(docs: DataFrame, doc: str = "doc_id", text: str = "text", words: int = WORDS,
                       share: int = SHARE, keys: bool = False) -> DataFrame:
    """doc, n_shingles, component_id for every row of ``docs``.

    ``keys`` adds ``text_key`` and ``component_key``: components of unlike texts under one id can share
    a component_id but not a component_key (null without a component).
    """
    src = docs.select(F.col(f"`{doc}`").cast("long").alias("id"), text_key(text).alias("key"),
                      F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    # 1. order: rare n-grams first
    least, most = COUNTERS
    width = 1 << min(max(4 * src.count(), least), most).bit_length() - 1
    rows = stage(_arrow_sets(src, words, share, count_sketch(src, words, width)))
    points = stage(rows.where("n > 0 AND id IS NOT NULL").groupBy("node").agg(
        F.min(F.struct("id", "key")).alias("first"), F.first("n").alias("n"), *(F.first(c).alias(c) for c in SIGNS))
        .select("node", F.col("first.id").alias("label"), F.col("first.key").alias("tkey"), "n", *SIGNS))
    # 2. regions
    region = stage(_regions(points, rows))
    # 3. pivots
    found = components(_links(src, points, _pivot_pairs(region, share), words, share, width))
    # 4. the rest: components of components
    more = components(_links(src, points, _pairs_apart(region, found, share), words, share, width))
    comp = (points.select("node", F.col("label").alias("own")).join(found, "node", "left")
            .select("node", "own", F.coalesce("label", "node").alias("first"))
            .join(more.select(F.col("node").alias("mn"), "label"), F.col("first") == F.col("mn"), "left")
            .select("node", "own", F.coalesce("label", "first").alias("comp")))
    least = comp.groupBy("comp").agg(F.min("own").alias("component"))
    label = comp.join(least, "comp").select(F.col("node").alias("pnode"), "component", "comp")
    out = rows.select("id", "key", "node", "n").join(label, (F.col("node") == F.col("pnode")) & (F.col("n") > 0), "left")
    extra = [F.col("key").alias("text_key"), F.when(F.col("id").isNotNull(), F.col("comp")).alias("component_key")]
    return out.select(F.col("id").alias(doc), F.col("n").alias("n_shingles"),
                      F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))).alias("component_id"),
                      *(extra if keys else []))
