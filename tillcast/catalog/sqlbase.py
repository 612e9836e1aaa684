"""DuckDB SQL building blocks shared by the oracle queries.

The oracle is an independent restatement of each operator in plain SQL over the
raw tables (``lineitem part supplier nation region``), used only to check the
Spark results.
"""

_FACTS = r"""
li AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, l_discount, CAST(l_shipdate AS DATE) AS date
  FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '2001-01-01'),
parts AS (
  SELECT p_partkey, split_part(p_name, ' ', 2) AS category,
         split_part(p_name, ' ', 2) || CASE split_part(p_name, ' ', 1)
             WHEN 'small' THEN '-S' WHEN 'large' THEN '-L' ELSE '-R' END AS item_id,
         p_retailprice
  FROM part),
item_price AS (SELECT item_id, min(p_retailprice) AS unit_price FROM parts GROUP BY item_id),
stores AS (
  SELECT s_suppkey, s_nationkey AS sk, r_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
agg AS (
  SELECT sk, r_name, item_id, category, date, sum(l_quantity) AS qty,
         min(l_orderkey) AS min_ok, max(l_discount) AS max_disc
  FROM li JOIN parts ON l_partkey = p_partkey JOIN stores ON l_suppkey = s_suppkey
  GROUP BY sk, r_name, item_id, category, date),
"""

# the rows that become the panel: what was observed, or that before the test start and every cell from it on
_OBSERVED = r"""
cells AS (SELECT * FROM agg),
"""
_FUTURE = r"""
cells AS (
  SELECT sk, r_name, item_id, category, date, qty, min_ok, max_disc FROM agg WHERE date < DATE '2000-10-01'
  UNION ALL
  SELECT s.sk, s.r_name, i.item_id, i.category, CAST(t.d AS DATE), NULL, NULL, 0.0
  FROM (SELECT DISTINCT sk, r_name FROM stores) s, (SELECT DISTINCT item_id, category FROM parts) i,
       generate_series(DATE '2000-10-01', DATE '2000-12-31', INTERVAL 1 DAY) t(d)),
"""

_PANEL = r"""
base AS (
  SELECT date, 'S' || lpad(CAST(sk AS VARCHAR), 2, '0') AS store_id, item_id,
         r_name || '-' || CAST(sk % 2 AS VARCHAR) AS city, r_name AS state, category,
         CASE WHEN min_ok % 251 = 0 THEN NULL ELSE qty END AS quantity, unit_price,
         CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
         CAST(isodow(date) - 1 AS INTEGER) AS day_of_week_num,
         CAST(dayofyear(date) AS INTEGER) AS doy, sk, max_disc
  FROM cells JOIN item_price USING (item_id)),
base2 AS (
  SELECT *, 70.0 - abs(doy - 200) * 0.25 + CAST(sk % 5 AS DOUBLE) AS avg_temp_f,
         CAST(greatest((doy * 7 + sk * 13) % 10 - 5, 0) AS DOUBLE) / 5.0 AS precip_inches,
         make_date(year, 11, 1) + CAST(((3 - (isodow(make_date(year, 11, 1)) - 1) + 7) % 7) + 21 AS INTEGER) AS tg
  FROM base),
panel AS (
  SELECT date, store_id, item_id, city, state, category, quantity, unit_price, year, month,
         day_of_week_num,
         CAST(day_of_week_num >= 5 AS INTEGER) AS is_weekend,
         CAST(hol IS NOT NULL AS INTEGER) AS is_holiday,
         CAST(ev IS NOT NULL AS INTEGER) AS is_special_event,
         CAST(max_disc >= 0.08 AS INTEGER) AS is_promotion,
         hol AS holiday_name, ev AS special_event_name,
         CASE WHEN precip_inches = 0 THEN NULL WHEN avg_temp_f < 32 THEN 'Snow' ELSE 'Rain' END AS precip_type,
         avg_temp_f, precip_inches
  FROM (SELECT *,
          CASE WHEN date = tg THEN 'Thanksgiving Day'
               WHEN month = 12 AND day(date) = 25 THEN 'Christmas Day'
               WHEN month = 7 AND day(date) = 4 THEN 'Independence Day'
               WHEN month = 11 AND day(date) = 11 THEN 'Veterans Day' END AS hol,
          CASE WHEN (doy + sk * 17) % 45 = 0
               THEN 'Event_' || CAST(((doy + sk * 17) // 45) % 6 AS VARCHAR) END AS ev
        FROM base2) b),
prep0 AS (
  SELECT *, CASE WHEN date < DATE '2000-10-01' THEN quantity END AS qf0 FROM panel),
prep AS (
  SELECT * EXCLUDE (qf0, fillv),
         CASE WHEN qf0 IS NULL AND date < DATE '2000-10-01' THEN fillv ELSE qf0 END AS quantity_filled
  FROM (SELECT *, avg(CASE WHEN date < DATE '2000-10-01' THEN qf0 END)
                   OVER (PARTITION BY store_id, item_id, day_of_week_num) AS fillv FROM prep0) x),
train AS (SELECT * FROM prep WHERE date < DATE '2000-10-01' AND quantity_filled IS NOT NULL)
"""

PANEL_CTE = _FACTS + _OBSERVED + _PANEL
FUTURE_CTE = _FACTS + _FUTURE + _PANEL

DENSE_CTE = r"""
dli AS (
  SELECT l_partkey, l_suppkey, l_quantity, CAST(l_shipdate AS DATE) AS date FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '2001-01-01'),
dobs AS (
  SELECT r_name AS store_id, split_part(p_name, ' ', 2) AS item_id, date, sum(l_quantity) AS qty
  FROM dli JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY ALL),
dkeys AS (SELECT DISTINCT store_id, item_id FROM dobs),
dspine AS (
  SELECT store_id, item_id, CAST(d AS DATE) AS date
  FROM dkeys, generate_series(DATE '1996-01-01', DATE '2000-12-31', INTERVAL 1 DAY) t(d)),
dense AS (
  SELECT s.store_id, s.item_id, s.date, coalesce(o.qty, 0.0) AS quantity,
         CAST(year(s.date) AS INTEGER) AS year, CAST(month(s.date) AS INTEGER) AS month,
         CAST(isodow(s.date) - 1 AS INTEGER) AS day_of_week_num,
         CASE WHEN s.date < DATE '2000-10-01' THEN coalesce(o.qty, 0.0) END AS quantity_filled
  FROM dspine s LEFT JOIN dobs o USING (store_id, item_id, date))
"""


def clip(x: str, lo=None, hi=None) -> str:
    """NULL-preserving clip for the oracle (DuckDB's greatest/least skip NULL, trap T1)."""
    parts = []
    if lo is not None:
        parts.append(f"WHEN ({x}) < {lo} THEN {lo}")
    if hi is not None:
        parts.append(f"WHEN ({x}) > {hi} THEN {hi}")
    return f"(CASE {' '.join(parts)} ELSE ({x}) END)"


def with_panel(body: str, future: bool = False) -> str:
    """``future``: the complete grid from the test start on in place of the cells that sold."""
    return "WITH " + (FUTURE_CTE if future else PANEL_CTE) + "\n" + body


def with_dense(body: str) -> str:
    return "WITH " + DENSE_CTE + "\n" + body


def with_both(body: str) -> str:
    return "WITH " + PANEL_CTE + ",\n" + DENSE_CTE + "\n" + body
