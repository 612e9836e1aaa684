"""Registered queries of the corpus operators and their DuckDB restatements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm import ann, exactdedup, jaccard, langid, pii, sharding, spelling, spiece, toxicity, urlfilter, warc, whitening, winnow
from tillcast.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(f):
        QUERIES[key] = f
        if sql is not None:
            ORACLE[key] = sql
        return f
    return deco


@register("op6_url_filter", """
WITH rules(rhost, rpath, v) AS (VALUES ('org','/','allow'), ('example.org','/es/','block'),
  ('example.org','/en/1','block'), ('com','/fr/','allow'), ('com','/de/','block')),
u AS (SELECT page_id, row_number() OVER () AS rid,
  translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
m AS (SELECT u.rid, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(v, length(rhost || rpath)) AS v
  FROM u JOIN rules ON (u.host = rhost OR ends_with(u.host, '.' || rhost)) AND starts_with(u.path, rpath) GROUP BY 1)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM u LEFT JOIN m USING (rid)""")
def op6_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    out = urlfilter.filter_urls(pages, urlfilter.rules_frame(spark))
    return out.select("page_id", "host", "path", "rule", "verdict")


@register("op8_byte_shards", """
WITH s AS (SELECT doc_id, coalesce(octet_length(encode(text)), 0) + 16 AS size,
  CASE WHEN coalesce(text, '') = '' THEN 0 ELSE list_reduce(list_prepend(4294967295::UBIGINT,
    list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::UBIGINT)),
    lambda c, b: xor(c >> 8, list_reduce(list_prepend(xor(c & 255, b), [1,2,3,4,5,6,7,8]::UBIGINT[]),
      lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END))) END AS crc
  FROM documents),
o AS (SELECT doc_id, size, CASE WHEN crc = 0 AND size = 16 THEN 0 ELSE xor(crc, 4294967295::UBIGINT) END::BIGINT AS text_crc32,
  sum(size) OVER (ORDER BY doc_id, size, crc ROWS UNBOUNDED PRECEDING) AS e, sum(size) OVER () AS t,
  row_number() OVER (ORDER BY doc_id, size, crc) AS g FROM s),
p AS (SELECT *, least(39, ((2 * e - size) * 40) // (2 * t))::INTEGER AS shard FROM o)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, shard,
  (g - min(g) OVER (PARTITION BY shard))::BIGINT AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM p""")
def op8_byte_shards(spark, sf_dir):
    out = sharding.shard_by_bytes(table(spark, sf_dir, "documents"), ["doc_id"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


ITEM_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@register("op4_decontamination", """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, l, array_to_string(w[s:s + l - 1], ' ') AS win FROM
    (SELECT item_id, w, least(13, len(w)) AS l, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s FROM i WHERE len(w) > 0)),
dw AS (SELECT rid, l, s, array_to_string(w[s:s + l - 1], ' ') AS win FROM
    (SELECT rid, w, l, unnest(range(1, len(w) - l + 2)) AS s FROM d, (SELECT DISTINCT l FROM iw) WHERE len(w) >= l)),
h AS (SELECT rid, l, s, item_id FROM dw JOIN iw USING (l, win)),
c AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT rid, unnest(range(s, s + l)) AS p FROM h) GROUP BY 1),
t AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM
    (SELECT DISTINCT rid, item_id::VARCHAR AS id FROM h) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN t USING (rid)""")
def op4_decontamination(spark, sf_dir):
    out = winnow.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


FOLDS = 5


def held_out(doc_id="doc_id"):
    """The fold that no label is learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0


@register("op1_language")
def op1_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    profiles = langid.learn(docs.where(~F.coalesce(held_out(), F.lit(False))))
    return langid.predict(docs, profiles, ["doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out")])


_B32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((('0x' || substr(sha, {1 + 10 * q}, 10))::BIGINT) >> {s}) & 31)::INTEGER, 1)"
                   for q in range(4) for s in range(35, -5, -5))


@register("op5_warc", f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS sha FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY sha, n) AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, {_B32} AS payload_digest,
  CASE WHEN page_id IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM f""")
def op5_warc(spark, sf_dir):
    out = warc.round_trip(table(spark, sf_dir, "pages"))
    return out.select(F.col("page").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op7_neighbours")
def op7_neighbours(spark, sf_dir):
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def piece_model_path() -> str:
    """The public piece model installed beside the tokenizer libraries."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@register("op9_pieces")
def op9_pieces(spark, sf_dir):
    out = spiece.encode(table(spark, sf_dir, "documents"), piece_model_path())
    whole = F.coalesce("text", F.lit(""))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_ids"),
                      F.octet_length(whole).cast("long").alias("n_bytes"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                      (F.col("decoded") == F.replace(whole, F.lit(spiece.MARK), F.lit(" "))).alias("round_trip"))


@register("op10_substring_dedup")
def op10_substring_dedup(spark, sf_dir):
    out = exactdedup.dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register("op2_jaccard")
def op2_jaccard(spark, sf_dir):
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def toxicity_network(spark, sf_dir):
    """Network trained on the labelled documents outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").where("toxic IS NOT NULL").where(~held_out())
    return toxicity.fit(table(spark, sf_dir, "documents"), labels)


@register("op3_toxicity")
def op3_toxicity(spark, sf_dir):
    out = toxicity.score(table(spark, sf_dir, "documents"), toxicity_network(spark, sf_dir),
                         ["doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out")])
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


MISSPELT = 97
SHORTEST = 5


@register("op11_spelling", """
WITH RECURSIVE c AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::UBIGINT, [1,2,3,4,5,6,7,8]::UBIGINT[]),
    lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)) AS tab),
r AS (SELECT doc_id, run, count(*) AS m FROM (SELECT doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents) GROUP BY ALL),
h AS (SELECT run, m, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(
    regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '..'), lambda x: ('0x' || x)::UBIGINT)),
    lambda a, b: xor(a >> 8, tab[(xor(a & 255, b) + 1)::BIGINT])), 4294967295::UBIGINT)::BIGINT AS h FROM r, c),
w AS MATERIALIZED (SELECT word, sum(m)::BIGINT AS n FROM (SELECT m, CASE WHEN h % 97 = 0
    THEN substr(run, 1, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) ELSE run END AS word FROM h)
    WHERE length(word) >= 5 GROUP BY 1 HAVING sum(m) >= 3),
v AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM w)),
e AS MATERIALIZED (SELECT a.word, b.word AS near FROM v a JOIN v b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
    UNION SELECT v.word, w.word FROM v JOIN w ON v.less = w.word UNION SELECT w.word, v.word FROM v JOIN w ON v.less = w.word),
f AS MATERIALIZED (SELECT w.word, any_value(w.n) AS n, count(near)::BIGINT AS n_near, first(near ORDER BY x.n DESC, near) AS best, max(x.n) AS best_n
    FROM w LEFT JOIN e USING (word) LEFT JOIN w x ON x.word = e.near GROUP BY 1),
g AS MATERIALIZED (SELECT word, n, n_near, CASE WHEN best_n >= 2 * n THEN best END AS form, CASE WHEN best_n >= 2 * n THEN best_n END AS form_n FROM f),
k AS (SELECT word, word AS root FROM g UNION ALL SELECT k.word, g.form FROM k JOIN g ON g.word = k.root WHERE g.form IS NOT NULL)
SELECT g.word, g.form, k.root, g.n, g.n_near, g.form_n FROM g JOIN k ON k.word = g.word JOIN g l ON l.word = k.root WHERE l.form IS NULL""")
def op11_spelling(spark, sf_dir):
    # a word is its run or one code point less, so shorter runs make none
    runs = spelling.word_runs(table(spark, sf_dir, "documents"), shortest=SHORTEST)
    h = F.crc32(F.concat(F.coalesce(F.col("doc").cast("string"), F.lit("")), F.lit(":"), "run").cast("binary"))
    at = h % F.length("run")
    less = F.concat(F.expr("substring(run, 1, cast(at as int))"), F.expr("substring(run, cast(at as int) + 2)"))
    runs = runs.withColumns({"h": h, "at": at})
    return spelling.group_variants(spelling.word_counts(runs, F.when(F.col("h") % MISSPELT == 0, less).otherwise(F.col("run")), SHORTEST))


@register("op12_whitening")
def op12_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@register("op13_private")
def op13_private(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = pii.find(docs, pii.fit(docs), ["doc_id"])
    listed = F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.array_join(F.transform(F.filter("spans", lambda x: x["base"]), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    counts = [F.expr(f"cast(size(filter(spans, x -> x.base AND x.kind = '{k}')) AS long)").alias(f"n_{k}") for k in pii.BASE]
    return out.select("doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), listed.alias("spans"))
