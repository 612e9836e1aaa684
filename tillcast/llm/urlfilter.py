"""URL filters by hashed host-suffix / path-prefix expressions.

A rule is (host, path, verdict).  It fits a URL whose host is the rule's host
or a subdomain of it and whose path starts with the rule's path; of the rules
that fit, the one with the longest text (host + path) wins, and a URL that no
rule fits gets ``default``.

Method: every distinct URL is expanded into the expressions host suffix x path
prefix (only prefix lengths that rules use), the expressions meet the rules in
an equi-join on a short SHA-256 prefix, and a hit counts only if the full
digests agree.  Native SQL functions throughout; a URL that fills a third of
the table is expanded once.

Defined results: null URL or one without ``://`` has an empty host and path,
fits no rule and gets ``default``.  A rule with a null host or path is void.
The same rule given both ways: ``block`` wins.  Rows repeat as given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.common import UPPER

#: fixed values: the rules of the registered query (host, path, verdict)
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
PREFIX_HEX = 8          # hex digits of the digest that the join uses
MAX_LENGTHS = 4096      # distinct rule path lengths; more is refused, not cut


def host_of(url: Column) -> Column:
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(raw, F.lit("")), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rules_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def _digest(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` plus host, path, rule and verdict (input columns of these names are replaced)."""
    r = (rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
         .select(F.concat("host", "path").alias("rule"), F.length("path").alias("plen"), "verdict")
         .groupBy("rule", "plen").agg(F.max("verdict").alias("rule_verdict"))
         .withColumn("digest", _digest(F.col("rule")))
         .withColumn("short", F.substring("digest", 1, PREFIX_HEX)))
    lengths = sorted(x[0] for x in r.select("plen").distinct().limit(MAX_LENGTHS + 1).collect())
    if len(lengths) > MAX_LENGTHS:
        raise ValueError("too many distinct rule path lengths")

    u = pages.select(F.col(f"`{url}`").alias("u")).where("u IS NOT NULL").distinct()
    u = u.select("u", host_of(F.col("u")).alias("h"), path_of(F.col("u")).alias("p")).where("h <> ''")
    parts = F.split("h", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)),
                           lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    prefixes = F.array(*[F.when(F.length("p") >= n, F.substring("p", 1, n)) for n in lengths]) \
        if lengths else F.array().cast("array<string>")
    expr = (u.select("u", F.explode(suffixes).alias("hs"), "p")
            .select("u", "hs", F.explode(F.filter(prefixes, lambda x: x.isNotNull())).alias("pp"))
            .select("u", _digest(F.concat("hs", "pp")).alias("d"),
                    F.concat("hs", "pp").alias("e"), F.length("pp").alias("n"))
            .withColumn("short", F.substring("d", 1, PREFIX_HEX)))
    hits = expr.join(r, "short").where((F.col("d") == F.col("digest")) & (F.col("n") == F.col("plen")))
    best = hits.groupBy("u").agg(F.max(F.struct(F.length("rule").alias("l"), "plen", "rule", "rule_verdict")).alias("b"))
    best = best.select("u", F.col("b.rule").alias("__rule"), F.col("b.rule_verdict").alias("__verdict"))
    keep = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c not in ("host", "path", "rule", "verdict")],
                        F.col(f"`{url}`").alias("__url"))
    out = keep.join(best, F.col("__url") == F.col("u"), "left")
    return (out.withColumn("host", host_of(F.col("__url"))).withColumn("path", path_of(F.col("__url")))
            .withColumn("rule", F.col("__rule"))
            .withColumn("verdict", F.coalesce("__verdict", F.lit(default)))
            .drop("__url", "u", "__rule", "__verdict"))
