"""Bind the sales panel to the star-schema tables.

``lineitem ⋈ part ⋈ supplier ⋈ nation ⋈ region`` aggregated to one row per
(store, item, date).  The ship-date window is a timestamp range on the raw
column so Parquet row groups are skipped (``PushedFilters``); only the columns
used are read.  Joins carry no hints: with AQE on, each dimension side is
broadcast only when its measured size is under the threshold, otherwise the
join stays a shuffle join.  After the aggregation the panel is hash-partitioned
by series key (store_id, item_id): every series window and every series-grain
aggregate downstream then runs without another exchange, and a series holds at
most one row per calendar day, so no partition group can outgrow the horizon.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillcast import functions as fn
from tillcast.horizon import DEFAULT, Horizon
from tillcast.schema import DOW, PANEL_SCHEMA

# ---- fixed values of the binding (FIXTURES §2) --------------------------------
# Holiday calendar: Thanksgiving Day = 4th Thursday of November;
# Christmas Day = 12-25; Independence Day = 07-04; Veterans Day = 11-11.
THANKSGIVING_NAME = "Thanksgiving Day"
FIXED_HOLIDAYS = ((12, 25, "Christmas Day"), (7, 4, "Independence Day"), (11, 11, "Veterans Day"))
NULL_QTY_MODULUS = 251          # quantity is NULL when min(l_orderkey) % 251 = 0
PROMO_DISCOUNT = 0.08           # is_promotion when max(l_discount) >= 0.08
EVENT_PERIOD, EVENT_KINDS, EVENT_STORE_STEP = 45, 6, 17
SIZE_WORDS = (("small", "-S"), ("large", "-L"))   # otherwise "-R"
# --------------------------------------------------------------------------------


def _ts(d: _dt.date):
    return F.lit(_dt.datetime(d.year, d.month, d.day)).cast("timestamp_ntz")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shipments(spark, sf_dir, start: _dt.date, end_excl: _dt.date) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    return (li.where((F.col("l_shipdate") >= _ts(start)) & (F.col("l_shipdate") < _ts(end_excl)))
              .select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_discount",
                      F.to_date("l_shipdate").alias("date")))


def part_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part -> (item_id, category, price): category = 2nd word, size from the 1st."""
    words = F.split(F.col("p_name"), " ")
    first, second = F.element_at(words, 1), F.element_at(words, 2)
    size = F.when(first == SIZE_WORDS[0][0], SIZE_WORDS[0][1]) \
            .when(first == SIZE_WORDS[1][0], SIZE_WORDS[1][1]).otherwise("-R")
    return _read(spark, sf_dir, "part").select(
        "p_partkey", F.concat(second, size).alias("item_id"), second.alias("category"), "p_retailprice")


def supplier_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier -> (nation key, region name)."""
    sup = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nat = _read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    reg = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (sup.join(nat, sup.s_nationkey == nat.n_nationkey)
               .join(reg, nat.n_regionkey == reg.r_regionkey)
               .select("s_suppkey", F.col("s_nationkey").alias("sk"), "r_name"))


def holiday_name(d) -> F.Column:
    d = F.col(d) if isinstance(d, str) else d
    expr = F.when(d == fn.thanksgiving(F.year(d)), F.lit(THANKSGIVING_NAME))
    for m, day, name in FIXED_HOLIDAYS:
        expr = expr.when((F.month(d) == m) & (F.dayofmonth(d) == day), F.lit(name))
    return expr


PANEL_COLUMNS = [f.name for f in PANEL_SCHEMA.fields]


def with_covariates(agg: DataFrame) -> DataFrame:
    """Panel columns of rows (sk, r_name, item_id, category, date, qty, min_orderkey, max_discount, unit_price):
    calendar, weather, holidays and events are rules of the date and the store."""
    d = F.col("date")
    sk = F.col("sk")
    doy = F.dayofyear(d)
    temp = (F.lit(70.0) - F.abs(doy - F.lit(200)).cast("double") * F.lit(0.25) + (sk % 5).cast("double"))
    precip = F.greatest((doy * 7 + sk * 13) % 10 - F.lit(5), F.lit(0)).cast("double") / F.lit(5.0)
    ev_code = doy + sk * EVENT_STORE_STEP
    event = F.when(ev_code % EVENT_PERIOD == 0,
                   F.concat(F.lit("Event_"), (F.floor(ev_code / EVENT_PERIOD) % EVENT_KINDS).cast("string")))
    hol = holiday_name(d)
    return (agg.select(
                d.alias("date"),
                F.concat(F.lit("S"), F.lpad(sk.cast("string"), 2, "0")).alias("store_id"),
                "item_id",
                F.concat(F.col("r_name"), F.lit("-"), (sk % 2).cast("string")).alias("city"),
                F.col("r_name").alias("state"),
                "category",
                F.when(F.col("min_orderkey") % NULL_QTY_MODULUS == 0, F.lit(None).cast("double"))
                 .otherwise(F.col("qty")).alias("quantity"),
                "unit_price",
                F.year(d).alias("year"), F.month(d).alias("month"), F.weekday(d).alias(DOW),
                temp.alias("avg_temp_f"), precip.alias("precip_inches"),
                hol.alias("holiday_name"), event.alias("special_event_name"),
                fn.flag(F.col("max_discount") >= PROMO_DISCOUNT).alias("is_promotion"))
            .withColumns({
                "is_weekend": fn.flag(F.col(DOW) >= 5),
                "precip_type": F.when(F.col("precip_inches") == 0, F.lit(None).cast("string"))
                                .when(F.col("avg_temp_f") < 32, F.lit("Snow")).otherwise(F.lit("Rain")),
                "is_holiday": fn.flag(F.col("holiday_name").isNotNull()),
                "is_special_event": fn.flag(F.col("special_event_name").isNotNull()),
            }))


def future_skeleton(spark: SparkSession, sf_dir: str, hz: Horizon = DEFAULT) -> DataFrame:
    """Panel rows of every (store, item, day) of the test season, whatever sold then or before.

    Stores and items come from the dimension tables, days from the horizon; covariates are the rules of
    ``with_covariates`` and no promotion is planned.  No table is crossed with another: the item catalog is one
    array of a scalar subquery that each store explodes, then each series explodes its days.  Quantity is NULL.
    """
    parts = part_items(spark, sf_dir)
    items = parts.groupBy("item_id", "category").agg(F.min("p_retailprice").alias("__p"))
    price = Window.partitionBy("item_id")
    items = items.select("item_id", "category", F.min("__p").over(price).alias("unit_price"))
    catalog = items.agg(F.sort_array(F.collect_list(F.struct("item_id", "category", "unit_price")))).scalar()
    stores = supplier_stores(spark, sf_dir).select("sk", "r_name").distinct()
    keys = stores.select("sk", "r_name", F.explode(catalog).alias("i")).select("sk", "r_name", "i.*")
    cells = fn.date_spine(keys, hz.test_start, hz.test_end)
    none = F.lit(None)
    cells = cells.withColumns({"qty": none.cast("double"), "min_orderkey": none.cast("long"), "max_discount": F.lit(0.0)})
    return with_covariates(cells).select(*PANEL_COLUMNS)


def panel_with_future(spark: SparkSession, sf_dir: str, hz: Horizon = DEFAULT) -> DataFrame:
    """The observed panel before the test start and the complete skeleton from it on."""
    past = panel_from_star(spark, sf_dir, hz, partition_by_series=False).where(F.col("date") < F.lit(hz.test_start))
    return past.unionByName(future_skeleton(spark, sf_dir, hz)).repartition("store_id", "item_id")


def panel_from_star(spark: SparkSession, sf_dir: str, hz: Horizon = DEFAULT,
                    partition_by_series: bool = True) -> DataFrame:
    """The sparse daily panel (one row per observed store, item, date)."""
    li = _shipments(spark, sf_dir, hz.train_from, hz.panel_end)
    parts = part_items(spark, sf_dir)
    prices = parts.groupBy("item_id").agg(F.min("p_retailprice").alias("unit_price"))
    stores = supplier_stores(spark, sf_dir)
    agg = (li.join(parts.select("p_partkey", "item_id", "category"), li.l_partkey == parts.p_partkey)
             .join(stores, li.l_suppkey == stores.s_suppkey)
             .groupBy("sk", "r_name", "item_id", "category", "date")
             .agg(F.sum("l_quantity").alias("qty"),
                  F.min("l_orderkey").alias("min_orderkey"),
                  F.max("l_discount").alias("max_discount")))
    panel = with_covariates(agg.join(prices, "item_id"))
    panel = panel.select(*PANEL_COLUMNS)
    if partition_by_series:
        panel = panel.repartition("store_id", "item_id")
    return panel


def panel_dense(spark: SparkSession, sf_dir: str, hz: Horizon = DEFAULT,
                partition_by_series: bool = True) -> DataFrame:
    """Complete daily series: (store = region) x (item = category) x every day, 0-filled.

    The spine is generated per series key (``explode(sequence)``), never by a
    cross join, and the observations are left-joined on the full grain.
    """
    li = _shipments(spark, sf_dir, hz.train_from, hz.panel_end)
    parts = part_items(spark, sf_dir).select("p_partkey", "category")
    stores = supplier_stores(spark, sf_dir).select("s_suppkey", "r_name")
    obs = (li.join(parts, li.l_partkey == parts.p_partkey)
             .join(stores, li.l_suppkey == stores.s_suppkey)
             .groupBy(F.col("r_name").alias("store_id"), F.col("category").alias("item_id"), "date")
             .agg(F.sum("l_quantity").alias("qty")))
    keys = obs.select("store_id", "item_id").distinct()
    spine = fn.date_spine(keys, hz.train_from, hz.test_end)
    dense = (spine.join(obs, ["store_id", "item_id", "date"], "left")
                  .select("store_id", "item_id", "date",
                          F.coalesce(F.col("qty"), F.lit(0.0)).alias("quantity"),
                          F.year("date").alias("year"), F.month("date").alias("month"),
                          F.weekday("date").alias(DOW)))
    if partition_by_series:
        dense = dense.repartition("store_id", "item_id")
    return dense
