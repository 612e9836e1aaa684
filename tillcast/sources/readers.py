"""Panel scans from files or tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.schema import NULL_TOKENS, PANEL_SCHEMA

# Column names of the restaurant CSV -> panel names.
CSV_RENAMES = {"restaurant_id": "store_id", "menu_item_id": "item_id"}


def read_panel_csv(spark: SparkSession, path: str, schema: T.StructType = PANEL_SCHEMA,
                   null_tokens=NULL_TOKENS, renames: dict | None = None,
                   date_format: str = "yyyy-MM-dd") -> DataFrame:
    """S1+S2: header CSV with a declared schema and pandas-style NULL tokens.

    Spark's CSV reader knows one ``nullValue``; the file is read as text, every
    token of ``null_tokens`` becomes NULL, then columns are cast to ``schema``.
    """
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    renames = CSV_RENAMES if renames is None else renames
    raw = raw.withColumnsRenamed({k: v for k, v in renames.items() if k in raw.columns})
    tokens = F.array(*[F.lit(t) for t in null_tokens])
    out = []
    for f in schema.fields:
        c = F.col(f.name)
        c = F.when(F.array_contains(tokens, F.trim(c)), F.lit(None).cast("string")).otherwise(c)
        if isinstance(f.dataType, T.DateType):
            c = F.to_date(c, date_format)
        elif not isinstance(f.dataType, T.StringType):
            c = c.cast(f.dataType)
        out.append(c.alias(f.name))
    return raw.select(*out)


def read_panel(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """S3: any Spark source — ``csv`` (via S1), ``parquet``/``orc``/``json``, or ``table``."""
    if fmt == "csv":
        return read_panel_csv(spark, path, **options)
    if fmt == "table":
        return spark.read.table(path)
    return spark.read.format(fmt).options(**options).load(path)
