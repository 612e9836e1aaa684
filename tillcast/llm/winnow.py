"""Benchmark decontamination by winnowing, in native SQL functions.

Words are runs of characters that are not ASCII punctuation, space or control
(A-Z lower-cased).  A benchmark window is ``SPAN`` consecutive words of an
item, or the whole item when it is shorter; a document word inside any
occurrence of a window is hit.

Method: hash every ``GRAM``-word gram, keep the smallest hash of each run of
``SPAN - GRAM + 1`` grams on both sides (any shared span of SPAN words then
shares a kept hash), equi-join the kept hashes, and extend each hit: only
windows that cover a hit gram are compared, as strings, with the benchmark's
windows.  An item of m < SPAN words gets its own class: grams of min(GRAM, m)
words over runs that fit m, on both sides, so its occurrences are found too.

The benchmark's hashes are broadcast only when a count proves them few
(``BROADCAST_HASHES``); beyond it Spark picks a shuffled join.  A passage in a
third of all documents gives each of them a few rows, never a group.

Defined results: null or wordless text has 0 words and is not contaminated;
items without words have no window; equal item texts all count; rows that
repeat are judged alike, and null ids are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import ascii_lower

#: fixed value: separators between words (after lower-casing A-Z)
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPAN = 13
GRAM = 5
BROADCAST_HASHES = 1_000_000    # 8 bytes each


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _grams(hashes: Column, k: int) -> Column:
    """Hash of each run of k word hashes (empty array if there is none)."""
    last = F.size(hashes) - k
    return F.when(last >= 0, F.transform(F.sequence(F.lit(1), last + 1),
                                         lambda i: F.xxhash64(F.slice(hashes, i, k)))
                  ).otherwise(F.array().cast("array<bigint>"))


def _kept(grams: Column, run: int) -> Column:
    """Smallest hash of each run of ``run`` grams, distinct."""
    if run == 1:
        return F.array_distinct(grams)
    last = F.size(grams) - run
    return F.when(last >= 0, F.array_distinct(F.transform(
        F.sequence(F.lit(1), last + 1), lambda i: F.array_min(F.slice(grams, i, run))))
    ).otherwise(F.array().cast("array<bigint>"))


def _classes(span: int, gram: int, short: list[int]) -> list[tuple[int, int, int]]:
    """(window words, gram words, run) for full windows and each short item length."""
    return [(m, min(gram, m), m - min(gram, m) + 1) for m in [*sorted(short), span]]


def _fingerprints(words: Column, m: int, k: int, run: int, carry: list[str], df: DataFrame) -> DataFrame:
    """carry..., hash: kept hashes of class m.

    ``words``, hashes and grams are each materialised as one column, so that
    the nested functions don't evaluate them again.
    """
    return (df.select(*carry, words.alias("__w"))
            .select(*carry, F.transform("__w", lambda w: F.xxhash64(w)).alias("__h"))
            .select(*carry, _grams(F.col("__h"), k).alias("__g"))
            .select(*carry, F.explode(_kept(F.col("__g"), run)).alias("hash")))


def _items(bench: DataFrame, item: str, text: str) -> DataFrame:
    return (bench.select(F.col(f"`{item}`").alias("item"), words_of(F.col(f"`{text}`")).alias("w"))
            .where(F.size("w") > 0))


def _windows(items: DataFrame, span: int) -> DataFrame:
    """m, win, ids: every benchmark window with the items that hold it."""
    m = F.least(F.lit(span), F.size("w"))
    starts = F.sequence(F.lit(1), F.size("w") - m + 1)
    return (items.select("item", "w", m.alias("m"), F.explode(starts).alias("s"))
            .select(F.col("m"), F.array_join(F.slice("w", F.col("s"), F.col("m")), " ").alias("win"),
                    F.col("item").cast("string").alias("id"))
            .groupBy("m", "win").agg(F.collect_set("id").alias("ids")))


def decontaminate(docs: DataFrame, bench: DataFrame, doc: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text", span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Input columns of ``docs`` plus n_words, n_hit, n_items, items, items_sha256, contaminated."""
    items = _items(bench, item, item_text)
    short = [r[0] for r in items.where(F.size("w") < span).select(F.size("w")).distinct().collect()]  # < span values
    classes = _classes(span, gram, short)
    windows = _windows(items, span)

    base = docs.select(F.col(f"`{doc}`").alias("__d"), F.col(f"`{text}`").alias("__t"))
    keyed = base.select("__d", F.xxhash64("__t").alias("__x"), "__t")
    hits = None
    for m, k, run in classes:
        own = items.where(F.size("w") == m) if m < span else items.where(F.size("w") >= span)
        marks = _fingerprints(F.col("w"), m, k, run, [], own).distinct()
        if marks.count() <= BROADCAST_HASHES:
            marks = F.broadcast(marks)
        found = (_fingerprints(words_of(F.col("__t")), m, k, run, ["__d", "__x"], keyed)
                 .join(marks, "hash", "left_semi").groupBy("__d", "__x").agg(F.collect_set("hash").alias("hs"))
                 .select("__d", "__x", F.lit(m).alias("m"), F.lit(k).alias("k"), "hs"))
        hits = found if hits is None else hits.unionByName(found)

    # extend: windows of the hit documents that cover a hit gram, compared as strings
    hits = hits.withColumnsRenamed({"__d": "__hd", "__x": "__hx"})
    h = (keyed.join(hits, F.col("__d").eqNullSafe(F.col("__hd")) & (F.col("__x") == F.col("__hx")))
         .select("__d", "__x", "m", "k", "hs", words_of(F.col("__t")).alias("w"))
         .select("__d", "__x", "m", "k", "hs", "w", F.transform("w", lambda x: F.xxhash64(x)).alias("wh")))
    n = F.size("w")
    # the gram hashes are a column of their own: inside a nested function they would be evaluated per element
    h = h.select("__d", "__x", "m", "k", "hs", "w", _grams(F.col("wh"), F.col("k")).alias("g"))
    at = F.array_compact(F.transform("g", lambda g, i: F.when(F.array_contains(F.col("hs"), g), i + 1)))
    h = h.select("__d", "__x", "m", "k", "w", at.alias("at"))
    starts = F.array_distinct(F.flatten(F.transform("at", lambda p: F.sequence(
        F.greatest(F.lit(1), p - F.col("m") + F.col("k")),
        F.greatest(F.least(p, n - F.col("m") + 1), F.greatest(F.lit(1), p - F.col("m") + F.col("k")))))))
    h = (h.select("__d", "__x", "m", "w", F.explode(starts).alias("s")).where(F.col("s") <= n - F.col("m") + 1)
         .select("__d", "__x", "m", "s", F.array_join(F.slice("w", F.col("s"), F.col("m")), " ").alias("win")))
    occ = h.join(windows, ["m", "win"]).select("__d", "__x", "m", "s", "ids")
    per = occ.groupBy("__d", "__x").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list(F.sequence("s", F.col("s") + F.col("m") - 1))))).cast("long").alias("__n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("__items"))

    added = ("n_words", "n_hit", "n_items", "items", "items_sha256", "contaminated")
    own = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added],
                      F.size(words_of(F.col(f"`{text}`"))).cast("long").alias("n_words"),
                      F.col(f"`{doc}`").alias("__d0"), F.xxhash64(f"`{text}`").alias("__x0"))
    out = own.join(per, F.col("__d0").eqNullSafe(F.col("__d")) & (F.col("__x0") == F.col("__x")), "left")
    none = F.array().cast("array<string>")
    out = (out.withColumn("n_hit", F.coalesce("__n_hit", F.lit(0).cast("long")))
           .withColumn("items", F.coalesce("__items", none))
           .withColumn("n_items", F.size("items").cast("long"))
           .withColumn("items_sha256", F.sha2(F.array_join("items", ",").cast("binary"), 256))
           .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))))
    return out.drop("__d0", "__x0", "__d", "__x", "__n_hit", "__items")
