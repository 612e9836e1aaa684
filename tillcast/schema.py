"""Panel schema: one row per (date, store, item)."""

from pyspark.sql import types as T

KEYS = ("store_id", "item_id")
SERIES_KEYS = KEYS
GRAIN = ("store_id", "item_id", "date")

PANEL_SCHEMA = T.StructType([
    T.StructField("date", T.DateType(), False),
    T.StructField("store_id", T.StringType(), False),
    T.StructField("item_id", T.StringType(), False),
    T.StructField("city", T.StringType(), True),
    T.StructField("state", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("quantity", T.DoubleType(), True),
    T.StructField("unit_price", T.DoubleType(), True),
    T.StructField("year", T.IntegerType(), True),
    T.StructField("month", T.IntegerType(), True),
    T.StructField("day_of_week_num", T.IntegerType(), True),
    T.StructField("is_weekend", T.IntegerType(), True),
    T.StructField("is_holiday", T.IntegerType(), True),
    T.StructField("is_special_event", T.IntegerType(), True),
    T.StructField("is_promotion", T.IntegerType(), True),
    T.StructField("holiday_name", T.StringType(), True),
    T.StructField("special_event_name", T.StringType(), True),
    T.StructField("precip_type", T.StringType(), True),
    T.StructField("avg_temp_f", T.DoubleType(), True),
    T.StructField("precip_inches", T.DoubleType(), True),
])

# CSV scans: the pandas-2 default NA token list; all become NULL (trap T10).
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
               "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
               "n/a", "nan", "null")

DOW = "day_of_week_num"   # Monday = 0 (trap T22)
