"""Spelling variants: words one edit apart, found by a relational trie frontier.

The trie of all words is a distributed edge table (node, c, words, only): a node
is a prefix that two words or more share, c the next code point ('' where a word
ends), ``words`` how many words go on that way and ``only`` the word if it is
one.  A frontier of states (word, pos, node, edits) walks it level by level, one
join a level:

* match   the edge of the word's next code point; edits stay
* delete  the edge of the code point after the next; one edit
* replace an edge of another code point; one edit
* insert  such an edge, and the word's code point still to come; one edit

The trie holds every word twice, forwards and backwards, and a walk edits only the
latter half of what it reads: an edit near a word's start is met by the walk from
its end.  So edits are made where the trie is thin, not at the root, where each
would be tried at every word.  A mark in front keeps the directions apart.

The last two join on (node, the code point that must follow), a view of two edges
in a row, so that edges that lead nowhere are never met.  Of a run of equal code
points only the last is deleted and one is inserted only behind it, so every
neighbour is reached once from a side; those of a word's middle come from both, and one is kept.  A state with one edit that meets the end of a word,
or the only word that is left with the same rest, is a neighbour.  States without
an edit whose subtree holds their word alone are done.

Levels are as many as the longest prefix that two words share, and each writes
its frontier to the shared checkpoint folder.  Edges come in blocks of levels, so
that a long word costs a block at a time and nothing beyond the prefix that it
shares.  A level's edges are broadcast only if they are counted and small, as at
the root, where every word asks the same node; else Spark splits hot nodes.

Defined results: null words take no part; repeated rows of a word add up their
counts (null counts are 0); an empty table gives no rows; other columns are not
looked at.  Ties of forms go to the smaller word in code-point order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import ascii_lower, stage

RUNS = "([A-Za-zÀ-ÿ]+)"
BLOCK = 24                  # levels whose edges are built at once
SMALL_ROWS, SMALL_BYTES = 20_000, 2_000_000     # edges that may be broadcast
LEAST_RATIO = 2
ON, BACK = ">", "<"         # marks of a word read forwards and backwards


def word_runs(docs: DataFrame, doc: str = "doc_id", text: str = "text", shortest: int = 1) -> DataFrame:
    """doc, run: maximal letter runs of ``shortest`` code points or more of every whole text, A-Z lower-cased; null texts have none.

    Runs are lower-cased one by one: most are ASCII, while a text with one other capital takes the slow way as a whole.
    """
    runs = F.regexp_extract_all(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(RUNS))
    rows = docs.select(F.col(f"`{doc}`").alias("doc"), F.explode(runs).alias("run")).where(F.length("run") >= shortest)
    plain = F.octet_length("run") == F.length("run")
    return rows.select("doc", F.when(plain, F.lower("run")).otherwise(ascii_lower(F.col("run"))).alias("run"))


def word_counts(words: DataFrame, word: Column, shortest: int = 5, least: int = 3) -> DataFrame:
    """word, n of the words of at least ``shortest`` code points that come ``least`` times or more."""
    # a generated column is computed once; a plain one would be computed again by the filter on it
    return (words.select(F.explode(F.array(word)).alias("word")).where(F.length("word") >= shortest)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least))


def _edges(words: DataFrame, lo: int) -> DataFrame:
    """Edges of the shared nodes of lengths lo .. lo + BLOCK - 1."""
    levels = F.explode(F.sequence(F.lit(lo), F.least(F.lit(lo + BLOCK - 1), F.length("word"))))
    rows = words.where(F.length("word") >= lo).select("word", levels.alias("level"))
    rows = rows.select("level", F.expr("substring(word, 1, level)").alias("node"), F.expr("substring(word, level + 1, 1)").alias("c"), "word")
    edges = rows.groupBy("level", "node", "c").agg(F.count("*").alias("words"), F.min("word").alias("only"))
    shared = edges.groupBy("level", "node").agg(F.sum("words").alias("all")).where("all > 1").select("level", "node")
    return (edges.join(shared, ["level", "node"])
            .withColumn("only", F.when(F.col("words") == 1, F.col("only"))).repartition("node").sortWithinPartitions("level"))


def _at(word: str, pos: str) -> str:
    return f"substring({word}, {pos} + 1, 1)"


class _Trie:
    """The edge table, grown by blocks as the frontier goes down."""

    def __init__(self, words: DataFrame):
        self.words, self.blocks, self.sizes = words, {}, {}
        self._grow(0)

    def _grow(self, lo: int) -> None:
        if lo:
            deep = self.blocks[lo - BLOCK].where(f"level = {lo - 1} AND words > 1 AND c <> ''").select(F.concat("node", "c").alias("start"))
            self.words = self.words.join(deep, F.expr(f"substring(word, 1, {lo})") == F.col("start"), "left_semi")
        block = stage(_edges(self.words, lo))
        self.blocks[lo] = block
        for r in block.groupBy("level").agg(F.count("*").alias("n"), F.sum(F.octet_length("node") + F.coalesce(F.octet_length("only"), F.lit(0))).alias("b")).collect():
            self.sizes[r["level"]] = (r["n"], r["b"])

    def level(self, at: int) -> DataFrame | None:
        """Edges that leave the nodes of a level; None below the last shared node."""
        lo = at - at % BLOCK
        if lo not in self.blocks and (lo - 1) in self.sizes:
            self._grow(lo)
        return self.blocks[lo].where(F.col("level") == at) if at in self.sizes else None

    def hint(self, df: DataFrame, *levels: int) -> DataFrame:
        rows, size = (sum(self.sizes.get(x, (0, 0))[k] for x in levels) for k in (0, 1))
        return F.broadcast(df) if rows <= SMALL_ROWS and size <= SMALL_BYTES else df


def near_pairs(words: DataFrame, word: str = "word") -> DataFrame:
    """word, near: all pairs of distinct words one inserted, deleted or replaced code point apart, both ways."""
    words = words.select(F.col(f"`{word}`").alias("word")).where("word IS NOT NULL").distinct()
    words = stage(words.select(F.explode(F.array(F.concat(F.lit(ON), "word"), F.concat(F.lit(BACK), F.reverse("word")))).alias("word")))
    trie = _Trie(words)
    spark = words.sparkSession
    # the mark is not edited; a word of odd length has its middle edited from behind
    late = f"edits = 0 AND 2 * (pos - 1) + IF(word < '{ON}', 1, 0) >= length(word) - 1"
    done, at = [], 0
    states = words.select("word", F.lit(0).alias("pos"), F.lit("").alias("node"), F.lit(0).alias("edits"))
    while (edges := trie.level(at)) is not None:
        below = trie.level(at + 1)
        one = edges.select(F.col("node").alias("en"), "c", "words", "only")
        alone = edges.where("words = 1 AND c <> ''").select(
            F.col("node").alias("en"), "c", F.expr(_at("only", str(at + 1))).alias("d"), "words", "only")
        two = alone
        if below is not None:
            on = below.select(F.col("node").alias("bn"), F.col("c").alias("d"), "words", "only")
            up = edges.where("words > 1 AND c <> ''").select(F.col("node").alias("en"), "c")
            two = alone.unionByName(up.join(on, F.concat("en", "c") == F.col("bn")).drop("bn"))

        # the edges to take by match or delete, and the edge to find behind a replaced or inserted one
        plain = F.expr(f"struct({_at('word', 'pos')} AS key, pos + 1 AS to, edits AS e)")
        cut = F.expr(f"struct({_at('word', 'pos + 1')} AS key, pos + 2 AS to, 1 AS e)")
        may_cut = F.expr(f"{late} AND pos < length(word) AND {_at('word', 'pos')} <> {_at('word', 'pos + 1')}")
        step = states.select("word", "node", F.explode(F.when(may_cut, F.array(plain, cut)).otherwise(F.array(plain))).alias("s"))
        step = step.select("word", "node", "s.key", F.col("s.to").alias("pos"), F.col("s.e").alias("edits"))
        took = step.join(trie.hint(one, at), (F.col("node") == F.col("en")) & (F.col("key") == F.col("c")))
        took = took.select("word", "pos", "edits", "words", "only", F.concat("node", "c").alias("node"), (F.col("c") == "").alias("ends"), F.lit(at + 1).alias("level"))

        put = F.expr(f"struct({_at('word', 'pos')} AS key, pos + 1 AS to)")
        swap = F.expr(f"struct({_at('word', 'pos + 1')} AS key, pos + 2 AS to)")
        edit = states.where(late).select(
            "word", "node", F.expr(_at("word", "pos")).alias("here"),
            F.explode(F.when(F.expr("pos < length(word)"), F.array(put, swap)).otherwise(F.array(put))).alias("s"))
        edit = edit.select("word", "node", "here", "s.key", F.col("s.to").alias("pos"))
        met = edit.join(trie.hint(two, at, at + 1), (F.col("node") == F.col("en")) & (F.col("key") == F.col("d")) & (F.col("here") != F.col("c")))
        met = met.select("word", "pos", F.lit(1).alias("edits"), "words", "only", F.concat("node", "c", "d").alias("node"),
                         (F.col("d") == "").alias("ends"), F.lit(at + 2).alias("level"))

        rows = took.unionByName(met)
        rest = F.expr("substring(word, pos + 1) = substring(only, level + 1)")
        near = F.when(F.col("ends"), F.col("node")).when((F.col("words") == 1) & rest, F.col("only"))
        rows = rows.withColumn("near", F.when(F.col("edits") == 1, near))
        rows = rows.where("near IS NOT NULL OR (words > 1 AND NOT ends)")
        done.append(stage(rows.select("word", "pos", "node", "edits", "level", "near")))
        at += 1
        waiting = [d.where((F.col("level") == at) & F.col("near").isNull()) for d in done[-2:]]
        states = reduce(DataFrame.unionByName, waiting).select("word", "pos", "node", "edits")
    if not done:
        return spark.createDataFrame([], "word string, near string")
    found = reduce(DataFrame.unionByName, [d.where("near IS NOT NULL").select("word", "near") for d in done])
    read = [F.expr(f"IF({c} < '{ON}', reverse(substring({c}, 2)), substring({c}, 2))").alias(c) for c in ("word", "near")]
    return found.select(*read).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """word, root of the words that have a form, by pointer jumping."""
    now = stage(forms.select("word", F.col("form").alias("root")))
    while True:
        hop = now.select(F.col("word").alias("hw"), F.col("root").alias("hr"))
        nxt = stage(now.join(hop, F.col("root") == F.col("hw"), "left")
                    .select("word", F.coalesce("hr", "root").alias("root"), F.col("hr").isNotNull().alias("moved")))
        if not nxt.where("moved").limit(1).count():
            return nxt.select("word", "root")
        now = nxt.select("word", "root")


def group_variants(words: DataFrame, word: str = "word", n: str = "n", ratio: int = LEAST_RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word.

    ``form`` is the near word of largest n if that is ``ratio`` times the word's
    n or more.  n grows along forms, so they end; ``root`` is the last.
    """
    words = stage(words.select(F.col(f"`{word}`").alias("word"), F.coalesce(F.col(f"`{n}`").cast("long"), F.lit(0)).alias("n"))
                  .where("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n")))
    near = near_pairs(words).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("b"))
    found = stage(words.join(best, "word", "left").withColumn("fits", (-F.col("b.m") >= ratio * F.col("n")) & (-F.col("b.m") > F.col("n")))
                  .select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("fits"), F.col("b.near")).alias("form"),
                          F.when(F.col("fits"), -F.col("b.m")).alias("form_n")))
    roots = _roots(found.where("form IS NOT NULL")).withColumnRenamed("word", "rw")
    return (found.join(roots, F.col("word") == F.col("rw"), "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
