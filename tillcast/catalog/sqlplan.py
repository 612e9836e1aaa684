"""Oracle restatement of the model-free plan."""

PLAN_CTE = r"""
, pkeys AS (SELECT DISTINCT store_id, item_id, category FROM panel),
psk AS (SELECT store_id, item_id, category, m AS month FROM pkeys, (VALUES (10), (11), (12)) v(m)),
psums AS (
  SELECT store_id, item_id, month,
         sum(CASE WHEN year = 1996 THEN quantity END) AS q1996, sum(CASE WHEN year = 1997 THEN quantity END) AS q1997,
         sum(CASE WHEN year = 1998 THEN quantity END) AS q1998, sum(CASE WHEN year = 1999 THEN quantity END) AS q1999
  FROM panel WHERE month IN (10, 11, 12) AND year BETWEEN 1996 AND 1999 GROUP BY ALL),
pb0 AS (SELECT k.*, coalesce(q1996, 0.0) AS a, coalesce(q1997, 0.0) AS b, coalesce(q1998, 0.0) AS c,
               coalesce(q1999, 0.0) AS d FROM psk k LEFT JOIN psums USING (store_id, item_id, month)),
pb1 AS (SELECT *, pow((CASE WHEN a > 0 THEN b / a ELSE 1.0 END) * (CASE WHEN b > 0 THEN c / b ELSE 1.0 END)
                      * (CASE WHEN c > 0 THEN d / c ELSE 1.0 END), 1.0 / 3) AS g FROM pb0),
PBASE AS (
  SELECT store_id, item_id, category, month, d AS last_year_qty, g AS avg_growth,
         CASE WHEN d * g > 0 THEN d * g
              ELSE avg(CASE WHEN d * g > 0 THEN d * g END) OVER (PARTITION BY category, month) END AS base_qty
  FROM pb1),
psrc AS (SELECT * FROM panel WHERE year BETWEEN 1996 AND 1999),
phol AS (SELECT holiday_name, year, month, avg(quantity) AS h FROM psrc
         WHERE is_holiday = 1 AND holiday_name IS NOT NULL GROUP BY ALL),
pnrm AS (SELECT year, month, avg(quantity) AS n FROM psrc WHERE is_holiday = 0 GROUP BY ALL),
IMPACT AS (SELECT holiday_name, min(month) AS month, count(*) AS years, avg((h - n) / n) AS impact
           FROM phol JOIN pnrm USING (year, month) WHERE n <> 0 GROUP BY holiday_name),
pmm AS (SELECT month, exp(sum(ln(1.0 + impact))) AS mult FROM IMPACT GROUP BY month),
psg0 AS (SELECT store_id, sum(CASE WHEN year = 1996 THEN quantity END) AS q0,
                sum(CASE WHEN year = 1999 THEN quantity END) AS q1 FROM panel WHERE quantity IS NOT NULL GROUP BY store_id),
psg1 AS (SELECT store_id, CASE WHEN q0 > 0 THEN pow(q1 / q0, 1.0 / 3) ELSE 1.0 END AS g FROM psg0),
SMULT AS (SELECT store_id, g / (SELECT avg(g) FROM psg1) AS store_mult FROM psg1),
TARGETS AS (
  SELECT b.*, b.base_qty * coalesce(m.mult, 1.0) AS holiday_adj_qty, s.store_mult,
         b.base_qty * coalesce(m.mult, 1.0) * coalesce(s.store_mult, 1.0) AS target_qty
  FROM PBASE b LEFT JOIN pmm m USING (month) LEFT JOIN SMULT s USING (store_id)),
pq4 AS (SELECT * FROM panel WHERE month IN (10, 11, 12) AND year BETWEEN 1996 AND 1999),
pown AS (SELECT store_id, item_id, day_of_week_num, avg(quantity) AS o FROM pq4 GROUP BY ALL),
pcat AS (SELECT category, day_of_week_num, avg(quantity) AS c FROM pq4 GROUP BY ALL),
PROFILE AS (
  SELECT k.store_id, k.item_id, k.category, CAST(r.d AS INTEGER) AS day_of_week_num, coalesce(o.o, c.c) AS pattern
  FROM pkeys k CROSS JOIN (SELECT range AS d FROM range(0, 7)) r
  LEFT JOIN pown o ON o.store_id = k.store_id AND o.item_id = k.item_id AND o.day_of_week_num = r.d
  LEFT JOIN pcat c ON c.category = k.category AND c.day_of_week_num = r.d),
pspine AS (
  SELECT k.store_id, k.item_id, k.category, CAST(t.d AS DATE) AS date
  FROM pkeys k, generate_series(DATE '2000-10-01', DATE '2000-12-31', INTERVAL 1 DAY) t(d)),
pdays AS (
  SELECT s.*, CAST(month(s.date) AS INTEGER) AS month, CAST(isodow(s.date) - 1 AS INTEGER) AS day_of_week_num,
         coalesce(pr.pattern, 0.0) AS skeleton, tg.target_qty
  FROM pspine s
  LEFT JOIN PROFILE pr ON pr.store_id = s.store_id AND pr.item_id = s.item_id AND pr.day_of_week_num = isodow(s.date) - 1
  LEFT JOIN TARGETS tg ON tg.store_id = s.store_id AND tg.item_id = s.item_id AND tg.month = month(s.date)),
DAILY AS (
  SELECT *, skeleton * CASE WHEN sum(skeleton) OVER (PARTITION BY store_id, item_id, month) > 0
                            THEN target_qty / sum(skeleton) OVER (PARTITION BY store_id, item_id, month)
                            ELSE 1.0 END AS daily_qty FROM pdays),
pel0 AS (
  SELECT category, (SELECT (lo + hi) / 2.0 FROM BINS WHERE avg_temp_f >= lo AND avg_temp_f < hi) AS mid, quantity
  FROM pq4 WHERE quantity IS NOT NULL AND avg_temp_f IS NOT NULL),
pel1 AS (SELECT category, mid, avg(quantity) AS dm FROM pel0 WHERE mid IS NOT NULL GROUP BY ALL),
ELAST AS (SELECT category, count(*) AS bins, regr_slope(dm, mid) / avg(dm) AS elasticity FROM pel1
          GROUP BY category HAVING count(*) > 2),
pdt AS (SELECT store_id, date, avg(avg_temp_f) AS t FROM panel WHERE date >= DATE '2000-10-01' GROUP BY ALL),
pht AS (SELECT store_id, month, avg(avg_temp_f) AS h FROM panel WHERE date < DATE '2000-10-01' GROUP BY ALL),
ADJ AS (
  SELECT d.store_id, d.item_id, d.category, d.date, d.month, d.daily_qty,
         CASE WHEN x < 0 THEN 0.0 ELSE x END AS adjusted_qty
  FROM (SELECT d.*, d.daily_qty * (1.0 + coalesce(e.elasticity * (t.t - h.h), 0.0)) * (1.0 + coalesce(i.impact, 0.0)) AS x
        FROM DAILY d
        LEFT JOIN pdt t USING (store_id, date)
        LEFT JOIN pht h USING (store_id, month)
        LEFT JOIN ELAST e USING (category)
        LEFT JOIN IMPACT i ON i.holiday_name = (
            CASE WHEN d.date = make_date(year(d.date), 11, 1) + CAST(((3 - (isodow(make_date(year(d.date), 11, 1)) - 1) + 7) % 7) + 21 AS INTEGER) THEN 'Thanksgiving Day'
                 WHEN month(d.date) = 12 AND day(d.date) = 25 THEN 'Christmas Day'
                 WHEN month(d.date) = 7 AND day(d.date) = 4 THEN 'Independence Day'
                 WHEN month(d.date) = 11 AND day(d.date) = 11 THEN 'Veterans Day' END)) d)
"""


def plan_cte(bins) -> str:
    """The plan with its temperature bins [lo, hi)."""
    return ", BINS AS (SELECT * FROM (VALUES " + ", ".join(f"({lo}, {hi})" for lo, hi in bins) + ") b(lo, hi))" + PLAN_CTE
