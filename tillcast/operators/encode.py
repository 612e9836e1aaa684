"""Encoders: label codes (W6/B34/C1), target encoding (B28/B29), group maps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def label_codes(df: DataFrame, col: str, name: str | None = None, null_as: str | None = None) -> DataFrame:
    """Dictionary (value, code): 0-based index in the sorted distinct values.

    ``StringIndexer`` orders by frequency by default; this matches
    ``alphabetAsc``.  The distinct values are found by a partial and a final
    aggregate; numbering them is one task over the levels of a dimension
    (stores, items, categories), whose number the catalog bounds.
    """
    name = name or f"{col}_enc"
    v = F.col(col) if null_as is None else F.coalesce(F.col(col), F.lit(null_as))
    vals = df.select(v.alias("__v")).where(F.col("__v").isNotNull()).distinct()
    return vals.withColumn(name, (F.row_number().over(Window.orderBy("__v")) - 1).cast("int"))


def label_encode(df: DataFrame, col: str, name: str | None = None, null_as: str | None = None,
                 codes: DataFrame | None = None) -> DataFrame:
    name = name or f"{col}_enc"
    codes = codes if codes is not None else label_codes(df, col, name, null_as)
    key = F.col(col) if null_as is None else F.coalesce(F.col(col), F.lit(null_as))
    return (df.withColumn("__v", key).join(codes, "__v", "left").drop("__v"))


def smoothed_mean(n: Column, mean: Column, prior: Column, smooth: float = 100.0) -> Column:
    """(n * mean + smooth * prior) / (n + smooth)."""
    return (n * mean + F.lit(smooth) * prior) / (n + F.lit(smooth))


def group_map_df(spark: SparkSession, groups: Mapping[str, Sequence[str]], item_col: str = "item_id",
                 group_col: str = "component_group") -> DataFrame:
    """C9 literal map with priority = declaration order (first group wins, T16)."""
    rows = [(item, g, prio) for prio, (g, items) in enumerate(groups.items()) for item in items]
    lit = spark.createDataFrame(rows, f"{item_col} string, {group_col} string, __prio int")
    return lit.groupBy(item_col).agg(F.min_by(group_col, "__prio").alias(group_col))


def assign_groups(p: DataFrame, groups: Mapping[str, Sequence[str]], item_col: str = "item_id",
                  group_col: str = "component_group", default: str = "other") -> DataFrame:
    """Each item's primary group; unlisted items get ``default``.

    The map is built from the parameter lists (bounded by the catalog) and
    joined; ``create_map`` would inline it as a literal instead.
    """
    spark = p.sparkSession
    m = group_map_df(spark, groups, item_col, group_col)
    return (p.join(m, item_col, "left")
             .withColumn(group_col, F.coalesce(F.col(group_col), F.lit(default))))
