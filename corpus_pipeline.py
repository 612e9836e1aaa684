"""A corpus pipeline of five stages, each a call of one corpus operator.

Every stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and, but
for the last, returns the columns of ``docs``; between stages the rows are
written as Parquet and read again.

1. toxicity      documents that the network scores at 0.5 or more go
2. jaccard       of documents with Jaccard similarity of 0.8 or more on
                 five-word shingles (linked directly or through others) the one
                 with the smallest id stays, one row of it; other texts of that
                 id are documents of their own; documents without words all stay
3. substrings    bytes of passages of 50 bytes or more that a smaller id also
                 holds are cut; UTF-8 sequences that a cut splits go whole,
                 and n_chars is the new length.  Texts that were empty or null
                 stay as they are
4. benchmark     documents that the contamination rule flags go
5. pieces        ids of the remaining texts, which decode to them

Columns may have any names besides doc_id and text: stages keep them under names of
their own while an operator works.

``ORACLE_SQL`` is None: SQL can't express the first stage.  Each stage and ``run``
are tested against plain Python on planted fixtures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm import exactdedup, jaccard, spiece, toxicity, winnow
from tillcast.llm.common import stage
from tillcast.llm.queries import piece_model_path, toxicity_network

SHINGLE_WORDS = 5
SHINGLE_SHARE = 80

ORACLE_SQL = None


OWN = ("doc_id", "text")


def _hidden(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The rows with every column but doc_id and text under a name that no operator uses, and those names."""
    names = {c: f"__c{i}" for i, c in enumerate(docs.columns) if c not in OWN}
    return docs.withColumnsRenamed(names), names


def _shown(docs: DataFrame, names: dict[str, str], columns: list[str]) -> DataFrame:
    return docs.select(*[F.col(names.get(c, c)).alias(c) for c in columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, names = _hidden(docs)
    scored = toxicity.score(rows, toxicity_network(spark, sf_dir), rows.columns)
    return _shown(scored.where(F.col("score") < 0.5), names, docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, names = _hidden(docs)
    found = jaccard.jaccard_components(docs.select("doc_id", "text"), words=SHINGLE_WORDS, share=SHINGLE_SHARE, keys=True)
    found = found.where("component_key IS NOT NULL").select(F.struct("doc_id", "text_key").alias("row"), "component_key").distinct()
    first = found.groupBy("component_key").agg(F.min("row").alias("stays"))
    gone = (found.join(first, "component_key").where("row <> stays")
            .select(F.col("row.doc_id").alias("__gone"), F.col("row.text_key").alias("__gone_key")))
    kept = (rows.withColumn("__key", jaccard.text_key())
            .join(gone, (F.col("doc_id") == F.col("__gone")) & (F.col("__key") == F.col("__gone_key")), "left_anti"))
    # repeated rows of one id are copies too where their texts are equal; rows without an id or words all stay
    again = F.col("doc_id").isNotNull() & F.coalesce("text", F.lit("")).rlike(r"[^\t-\r ]")
    rest = [c for c in kept.columns if c not in ("doc_id", "__key")]
    one = kept.where(again).groupBy("doc_id", "__key").agg(F.min(F.struct(*rest)).alias("__row")).select("doc_id", "__row.*")
    return _shown(kept.where(~again).drop("__key").unionByName(one), names, docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, names = _hidden(docs)
    # a cut can split a character: what is left of it goes, in the task that cuts
    whole = exactdedup.dedup_substrings(rows, as_text="__text").withColumn("text", F.col("__text"))
    if "n_chars" in names:
        n = names["n_chars"]
        whole = whole.withColumn(n, F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col(n)))
    return _shown(whole, names, docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows, names = _hidden(docs)
    return _shown(winnow.decontaminate(rows, bench).where(~F.col("contaminated")), names, docs.columns)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return spiece.encode(docs, piece_model_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_benchmark),
    ("sentencepiece", to_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir))
    return docs
