"""DuckDB restatement of the feature layers (oracle only), built from the same Catalog."""

from __future__ import annotations

from tillcast.catalog.sqlbase import clip
from tillcast.operators.features import DRIVER_CATALOG, Catalog, _clean


def _values(cat: Catalog) -> str:
    rows = []
    for prio, (g, items) in enumerate(cat.component_groups.items()):
        rows += [f"('{it}', '{g}', {prio})" for it in items]
    return ", ".join(rows)


def features_cte(cat: Catalog = DRIVER_CATALOG) -> str:
    pair_cols, pair_ratios = [], []
    for a, b in list(cat.size_pairs) + list(cat.combos):
        for it in (a, b):
            c = f"m_{_clean(it)}"
            if c not in [x.split(" AS ")[-1] for x in pair_cols]:
                pair_cols.append(f"avg(CASE WHEN item_id = '{it}' THEN quantity_filled END) AS {c}")
    for (a, b), nm in zip(cat.size_pairs, cat.size_ratio_names()):
        pair_ratios.append(f"coalesce(m_{_clean(a)} / CASE WHEN m_{_clean(b)} < 1 THEN 1 ELSE m_{_clean(b)} END, 1.0) AS {nm}")
    for (c, b), nm in zip(cat.combos, cat.combo_ratio_names()):
        pair_ratios.append(f"coalesce(m_{_clean(c)} / CASE WHEN m_{_clean(b)} < 1 THEN 1 ELSE m_{_clean(b)} END, 1.0) AS {nm}")
    pair_names = cat.size_ratio_names() + cat.combo_ratio_names()
    return f"""
, dim_store AS (
  SELECT store_id, first(city ORDER BY item_id, date) AS city, first(state ORDER BY item_id, date) AS state
  FROM prep GROUP BY store_id),
dstore AS (
  SELECT store_id, city, state,
    CAST(dense_rank() OVER (ORDER BY store_id) - 1 AS INTEGER) AS restaurant_enc,
    CAST(dense_rank() OVER (ORDER BY city) - 1 AS INTEGER) AS city_enc,
    CAST(dense_rank() OVER (ORDER BY state) - 1 AS INTEGER) AS state_enc,
    count(*) OVER (PARTITION BY city) AS n_restaurants_city,
    count(*) OVER (PARTITION BY state) AS n_restaurants_state
  FROM dim_store),
grp_map AS (SELECT item_id, arg_min(grp, prio) AS component_group
            FROM (VALUES {_values(cat)}) v(item_id, grp, prio) GROUP BY item_id),
ditem AS (
  SELECT i.item_id, coalesce(g.component_group, 'other') AS component_group,
    CAST(dense_rank() OVER (ORDER BY i.item_id) - 1 AS INTEGER) AS menu_item_enc,
    CAST(dense_rank() OVER (ORDER BY coalesce(g.component_group, 'other')) - 1 AS INTEGER) AS component_group_enc
  FROM (SELECT DISTINCT item_id FROM prep) i LEFT JOIN grp_map g USING (item_id)),
P AS (SELECT p.* EXCLUDE (city, state), s.* EXCLUDE (store_id), it.* EXCLUDE (item_id)
      FROM prep p LEFT JOIN dstore s USING (store_id) LEFT JOIN ditem it USING (item_id)),
T AS (SELECT * FROM P WHERE date < DATE '2000-10-01' AND quantity_filled IS NOT NULL),
gm AS (SELECT avg(quantity_filled) AS v FROM T),
f_rimdow AS (SELECT store_id, item_id, month, day_of_week_num, avg(quantity_filled) AS struct_rimdow FROM T GROUP BY ALL),
f_rim AS (SELECT store_id, item_id, month, avg(quantity_filled) AS struct_rim, count(quantity_filled) AS n_rim,
                 sum(quantity_filled) AS sum_rim FROM T GROUP BY ALL),
f_ridow AS (SELECT store_id, item_id, day_of_week_num, avg(quantity_filled) AS mean_ridow,
                   count(quantity_filled) AS n_ridow FROM T GROUP BY ALL),
f_cmdow AS (SELECT category, month, day_of_week_num, avg(quantity_filled) AS struct_cmdow FROM T GROUP BY ALL),
Q4 AS (SELECT * FROM T WHERE month IN (10, 11, 12)),
f_q4ri AS (SELECT store_id, item_id, avg(quantity_filled) AS q4ri FROM Q4 GROUP BY ALL),
f_q4rimdow AS (SELECT store_id, item_id, month, day_of_week_num, avg(quantity_filled) AS q4rimdow FROM Q4 GROUP BY ALL),
f_q4cmdow AS (SELECT category, month, day_of_week_num, avg(quantity_filled) AS q4cmdow FROM Q4 GROUP BY ALL),
f_trend AS (SELECT r.store_id, r.item_id,
                   {clip('r.rec / CASE WHEN e.ear < 1 THEN 1 ELSE e.ear END', 0.5, 2.0)} AS trend
            FROM (SELECT store_id, item_id, avg(quantity_filled) AS rec FROM Q4 WHERE year = 1999 GROUP BY ALL) r
            LEFT JOIN (SELECT store_id, item_id, avg(quantity_filled) AS ear FROM Q4 WHERE year < 1999 GROUP BY ALL) e
            USING (store_id, item_id)),
nonhol AS (SELECT avg(quantity_filled) AS v FROM T WHERE is_holiday = 0),
f_hol AS (SELECT holiday_name, avg(quantity_filled) / (SELECT v FROM nonhol) AS hm FROM T
          WHERE is_holiday = 1 AND holiday_name IS NOT NULL GROUP BY holiday_name),
f_cathol AS (
  SELECT h.category, h.holiday_name, h.m / coalesce(c.b, (SELECT v FROM nonhol)) AS chm
  FROM (SELECT category, holiday_name, avg(quantity_filled) AS m FROM T
        WHERE is_holiday = 1 AND holiday_name IS NOT NULL GROUP BY ALL) h
  LEFT JOIN (SELECT category, avg(quantity_filled) AS b FROM T WHERE is_holiday = 0 GROUP BY category) c USING (category)
  WHERE coalesce(c.b, (SELECT v FROM nonhol)) > 0),
f_elast AS (SELECT category, regr_slope(quantity_filled, avg_temp_f) / avg(quantity_filled) AS el FROM T
            GROUP BY category HAVING count(*) > 100),
q4temp AS (SELECT avg(avg_temp_f) AS v FROM Q4),
nonev AS (SELECT avg(quantity_filled) AS v FROM T WHERE is_special_event = 0),
f_ev AS (SELECT special_event_name, avg(quantity_filled) / (SELECT v FROM nonev) AS em FROM T
         WHERE is_special_event = 1 AND special_event_name IS NOT NULL GROUP BY 1),
sg0 AS (SELECT store_id, avg(CASE WHEN year = 1996 THEN quantity_filled END) AS q0,
               avg(CASE WHEN year = 1999 THEN quantity_filled END) AS q1 FROM T GROUP BY store_id),
sg1 AS (SELECT store_id, CASE WHEN q0 > 0 THEN pow(q1 / q0, 1.0 / 3) ELSE 1.0 END AS g FROM sg0),
f_sg AS (SELECT store_id, g / (SELECT avg(g) FROM sg1) AS sgm FROM sg1),
f_promo AS (SELECT category, avg(CASE WHEN is_promotion = 1 THEN quantity_filled END)
                             / avg(CASE WHEN is_promotion = 0 THEN quantity_filled END) AS pl
            FROM T GROUP BY category HAVING avg(CASE WHEN is_promotion = 0 THEN quantity_filled END) > 0),
f_cv AS (SELECT store_id, item_id,
                {clip('stddev_samp(quantity_filled) / CASE WHEN avg(quantity_filled) < 1 THEN 1 ELSE avg(quantity_filled) END', 0.0, 2.0)} AS cv FROM T GROUP BY ALL),
f_city AS (SELECT city, month, day_of_week_num, avg(quantity_filled) AS cdi FROM T GROUP BY ALL),
f_state AS (SELECT state, month, day_of_week_num, avg(quantity_filled) AS sdi FROM T GROUP BY ALL),
f_rcs AS (SELECT r.store_id, r.month, r.rt / CASE WHEN c.ct < 1 THEN 1 ELSE c.ct END AS rcs
          FROM (SELECT store_id, city, month, sum(quantity_filled) AS rt FROM T GROUP BY ALL) r
          JOIN (SELECT city, month, sum(quantity_filled) AS ct FROM T GROUP BY ALL) c USING (city, month)),
ct_rest AS (SELECT store_id, category, month, sum(quantity_filled) AS ctr FROM T GROUP BY ALL),
f_ics AS (SELECT r.store_id, r.item_id, r.month, r.sum_rim / CASE WHEN c.ctr < 1 THEN 1 ELSE c.ctr END AS ics
          FROM (SELECT f.*, d.category FROM f_rim f JOIN (SELECT DISTINCT item_id, category FROM P) d USING (item_id)) r
          JOIN ct_rest c USING (store_id, category, month)),
f_crs AS (SELECT c.store_id, c.category, c.month, c.ctr / CASE WHEN r.rmt < 1 THEN 1 ELSE r.rmt END AS crs
          FROM ct_rest c JOIN (SELECT store_id, month, sum(quantity_filled) AS rmt FROM T GROUP BY ALL) r
          USING (store_id, month)),
f_comp AS (SELECT store_id, component_group, month, day_of_week_num, avg(quantity_filled) AS cdx FROM T GROUP BY ALL),
f_icomp AS (SELECT a.store_id, a.item_id, a.month, a.q / CASE WHEN b.q < 1 THEN 1 ELSE b.q END AS icomp
            FROM (SELECT store_id, item_id, component_group, month, sum(quantity_filled) AS q FROM T GROUP BY ALL) a
            JOIN (SELECT store_id, component_group, month, sum(quantity_filled) AS q FROM T GROUP BY ALL) b
            USING (store_id, component_group, month)),
f_pairs AS (SELECT store_id, month, {", ".join(pair_ratios)}
            FROM (SELECT store_id, month, {", ".join(pair_cols)} FROM T GROUP BY ALL) x),
f_sidx AS (SELECT state, item_id, month, day_of_week_num, avg(quantity_filled) AS sidx FROM T GROUP BY ALL),
f_rvs AS (SELECT r.store_id, r.item_id, r.month, r.struct_rim / CASE WHEN s.sa < 1 THEN 1 ELSE s.sa END AS rvs
          FROM (SELECT f.*, d.state FROM f_rim f JOIN dstore d USING (store_id)) r
          JOIN (SELECT state, item_id, month, avg(quantity_filled) AS sa FROM T GROUP BY ALL) s
          USING (state, item_id, month)),
dcat AS (SELECT category, CAST(dense_rank() OVER (ORDER BY category) - 1 AS INTEGER) AS category_enc
         FROM (SELECT DISTINCT category FROM P) c),
dprecip AS (SELECT pt, CAST(dense_rank() OVER (ORDER BY pt) - 1 AS INTEGER) AS precip_type_enc
            FROM (SELECT DISTINCT coalesce(precip_type, 'None') AS pt FROM P) x),
f_price AS (SELECT category, avg(up) AS cap FROM
             (SELECT item_id, first(category ORDER BY store_id, date) AS category,
                     first(unit_price ORDER BY store_id, date) AS up FROM P GROUP BY item_id) x GROUP BY category),
edges AS (SELECT quantile_cont(unit_price, [1.0/3, 2.0/3]) AS e FROM P),
F0 AS (
  SELECT P.*,
    r1.struct_rimdow, r2.struct_rim, cm.struct_cmdow,
    coalesce(q1.q4ri, r2.struct_rim) AS q4_hist_ri,
    coalesce(q2.q4rimdow, r1.struct_rimdow) AS struct_rimdow_q4,
    coalesce(q3.q4cmdow, cm.struct_cmdow) AS q4_cmdow,
    coalesce(tr.trend, 1.0) AS q4_trend_ratio,
    coalesce(h.hm, 1.0) AS holiday_mult,
    coalesce(ch.chm, 1.0) AS cat_holiday_mult,
    coalesce(el.el, 0.0) AS cat_temp_elasticity,
    avg_temp_f - (SELECT v FROM q4temp) AS temp_deviation,
    dc.category_enc,
    dc.category_enc * avg_temp_f AS cat_temp_interaction,
    CAST(avg_temp_f < 32 AS INTEGER) AS temp_freezing,
    CAST(avg_temp_f >= 32 AND avg_temp_f < 50 AS INTEGER) AS temp_cold,
    CAST(avg_temp_f >= 50 AND avg_temp_f < 70 AS INTEGER) AS temp_mild,
    CAST(precip_inches > 0 AS INTEGER) AS has_precip,
    CAST(precip_inches > 0.5 AS INTEGER) AS heavy_precip,
    coalesce(e.em, 1.0) AS event_mult,
    coalesce(sg.sgm, 1.0) AS store_growth_mult,
    CASE WHEN is_promotion = 1 THEN coalesce(pr.pl, 1.0) ELSE 1.0 END AS promo_lift_cat,
    lag(quantity_filled, 7) OVER w AS lag_7, lag(quantity_filled, 14) OVER w AS lag_14,
    lag(quantity_filled, 364) OVER w AS lag_364, lag(quantity_filled, 365) OVER w AS lag_365,
    lag(quantity_filled, 728) OVER w AS lag_728,
    CASE WHEN count(quantity_filled) OVER w28 >= 7 THEN avg(quantity_filled) OVER w28 END AS roll_mean,
    CASE WHEN count(quantity_filled) OVER w28 >= 7 THEN stddev_samp(quantity_filled) OVER w28 END AS roll_std,
    coalesce((n_rim * r2.struct_rim + 100 * (SELECT v FROM gm)) / (n_rim + 100), (SELECT v FROM gm)) AS target_enc_rim,
    coalesce((n_ridow * rd.mean_ridow + 100 * (SELECT v FROM gm)) / (n_ridow + 100), (SELECT v FROM gm)) AS target_enc_ridow,
    coalesce(cv.cv, 0.5) AS item_cv,
    CAST(sum(is_promotion) OVER (PARTITION BY P.store_id, P.category, P.date) AS BIGINT) AS promo_count_cat,
    coalesce(lag(avg_temp_f) OVER (PARTITION BY P.store_id ORDER BY P.item_id, P.date), avg_temp_f) AS temp_lag1,
    avg(avg_temp_f) OVER (PARTITION BY P.store_id ORDER BY P.item_id, P.date
                          ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS temp_rolling3,
    dp.precip_type_enc,
    coalesce(ci.cdi, (SELECT v FROM gm)) AS city_demand_idx,
    coalesce(st.sdi, (SELECT v FROM gm)) AS state_demand_idx,
    coalesce(rcs.rcs, 0.5) AS rest_city_share,
    coalesce(cm.struct_cmdow, (SELECT v FROM gm)) AS cat_chain_demand_idx,
    coalesce(ics.ics, 0.1) AS item_category_share,
    coalesce(crs.crs, 0.125) AS cat_rest_share,
    coalesce(cp.cdx, (SELECT v FROM gm)) AS component_demand_idx,
    coalesce(ico.icomp, 0.1) AS item_component_share,
    {", ".join(f"coalesce(pa.{n}, 1.0) AS {n}" for n in pair_names)},
    coalesce(si.sidx, (SELECT v FROM gm)) AS state_item_demand_idx,
    coalesce(rvs.rvs, 1.0) AS rest_vs_state_ratio,
    unit_price / CASE WHEN fp.cap < 1 THEN 1 ELSE fp.cap END AS price_vs_cat_avg,
    CAST(CASE WHEN unit_price <= (SELECT e[1] FROM edges) THEN 0
              WHEN unit_price <= (SELECT e[2] FROM edges) THEN 1 ELSE 2 END AS INTEGER) AS price_tier
  FROM P
  LEFT JOIN f_rimdow r1 USING (store_id, item_id, month, day_of_week_num)
  LEFT JOIN f_rim r2 USING (store_id, item_id, month)
  LEFT JOIN f_ridow rd USING (store_id, item_id, day_of_week_num)
  LEFT JOIN f_cmdow cm USING (category, month, day_of_week_num)
  LEFT JOIN f_q4ri q1 USING (store_id, item_id)
  LEFT JOIN f_q4rimdow q2 USING (store_id, item_id, month, day_of_week_num)
  LEFT JOIN f_q4cmdow q3 USING (category, month, day_of_week_num)
  LEFT JOIN f_trend tr USING (store_id, item_id)
  LEFT JOIN f_hol h USING (holiday_name)
  LEFT JOIN f_cathol ch USING (category, holiday_name)
  LEFT JOIN f_elast el USING (category)
  LEFT JOIN dcat dc USING (category)
  LEFT JOIN f_ev e USING (special_event_name)
  LEFT JOIN f_sg sg USING (store_id)
  LEFT JOIN f_promo pr USING (category)
  LEFT JOIN f_cv cv USING (store_id, item_id)
  LEFT JOIN dprecip dp ON coalesce(P.precip_type, 'None') = dp.pt
  LEFT JOIN f_city ci USING (city, month, day_of_week_num)
  LEFT JOIN f_state st USING (state, month, day_of_week_num)
  LEFT JOIN f_rcs rcs USING (store_id, month)
  LEFT JOIN f_ics ics USING (store_id, item_id, month)
  LEFT JOIN f_crs crs USING (store_id, category, month)
  LEFT JOIN f_comp cp USING (store_id, component_group, month, day_of_week_num)
  LEFT JOIN f_icomp ico USING (store_id, item_id, month)
  LEFT JOIN f_pairs pa USING (store_id, month)
  LEFT JOIN f_sidx si USING (state, item_id, month, day_of_week_num)
  LEFT JOIN f_rvs rvs USING (store_id, item_id, month)
  LEFT JOIN f_price fp USING (category)
  WINDOW w AS (PARTITION BY P.store_id, P.item_id ORDER BY P.date),
         w28 AS (PARTITION BY P.store_id, P.item_id ORDER BY P.date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)),
FEAT AS (
  SELECT *,
    coalesce(lag_7, lag_364) AS lag_7_filled, coalesce(lag_14, lag_364) AS lag_14_filled,
    {clip('coalesce(lag_364 / CASE WHEN lag_728 < 1 THEN 1 ELSE lag_728 END, 1.0)', 0.5, 2.0)} AS yoy_growth,
    coalesce(roll_mean, struct_rimdow) AS rolling_mean_28,
    coalesce(roll_std, 0.0) AS rolling_std_28,
    lag_364 / CASE WHEN struct_rimdow < 1 THEN 1 ELSE struct_rimdow END AS yoy_ratio,
    cat_temp_elasticity * temp_deviation AS weather_impact,
    struct_rimdow * q4_trend_ratio AS struct_rimdow_trended,
    struct_rimdow * event_mult AS struct_x_event,
    struct_rimdow * holiday_mult AS struct_x_holiday,
    CAST(dayofyear(date) AS INTEGER) AS day_of_year,
    CAST(weekofyear(date) AS INTEGER) AS week_of_year,
    CAST(day(date) AS INTEGER) AS day_of_month,
    CAST(least(greatest(date - (make_date(year, 11, 1) + CAST(((3 - (isodow(make_date(year, 11, 1)) - 1) + 7) % 7) + 21 AS INTEGER)), -60), 60) AS INTEGER) AS days_from_thanksgiving,
    CAST(least(greatest(date - make_date(year, 12, 25), -60), 30) AS INTEGER) AS days_from_christmas,
    CAST(day_of_week_num * 100 + month AS INTEGER) AS dow_x_month,
    CAST(least(abs(day(date) - 1), abs(day(date) - 15), abs(day(date) - 16)) AS INTEGER) AS days_from_payday,
    sin((2 * pi() * 1) * dayofyear(date) / 365.25) AS sin_1, cos((2 * pi() * 1) * dayofyear(date) / 365.25) AS cos_1,
    sin((2 * pi() * 2) * dayofyear(date) / 365.25) AS sin_2, cos((2 * pi() * 2) * dayofyear(date) / 365.25) AS cos_2,
    sin((2 * pi() * 3) * dayofyear(date) / 365.25) AS sin_3, cos((2 * pi() * 3) * dayofyear(date) / 365.25) AS cos_3
  FROM F0),
FEATS AS (
  SELECT *,
    CAST(days_from_thanksgiving BETWEEN -3 AND 3 AS INTEGER) AS is_thanksgiving_week,
    CAST(days_from_thanksgiving = 1 AS INTEGER) AS is_black_friday,
    CAST(days_from_christmas BETWEEN -7 AND 1 AS INTEGER) AS is_christmas_week,
    CAST((month = 12 AND day_of_month >= 28) OR (month = 1 AND day_of_month <= 3) AS INTEGER) AS is_new_year_period,
    CAST(days_from_payday <= 2 AS INTEGER) AS is_payday_window,
    CAST(day_of_month <= 3 AS INTEGER) AS is_month_start,
    CAST(day_of_month >= 28 AS INTEGER) AS is_month_end
  FROM FEAT)
"""
