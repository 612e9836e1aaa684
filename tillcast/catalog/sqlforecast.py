"""Oracle restatement of the closed-form ensemble forecast."""

from __future__ import annotations

from tillcast.catalog.sqlbase import clip
from tillcast.operators.ensemble import weight_grid


def grid_values(grid=None) -> str:
    grid = grid or weight_grid()
    return ", ".join(f"({g}, {a!r}::DOUBLE, {b!r}::DOUBLE, {c!r}::DOUBLE)" for g, a, b, c in grid)


def forecast_cte(grid=None, last: str = "0.0") -> str:
    raw = ("coalesce(f.struct_rimdow, f.struct_cmdow) * f.holiday_mult * f.event_mult"
           " * (1.0 + f.weather_impact) * f.store_growth_mult * f.promo_lift_cat")
    dom = clip(raw, lo=0.0)
    return f"""
, MEM AS (
  SELECT f.date, f.store_id, f.item_id, f.category, f.month, f.quantity, f.quantity_filled, f.struct_rimdow,
         coalesce(f.struct_rimdow, f.struct_cmdow, {last}) AS m_struct,
         coalesce({dom}, {last}) AS m_domain, coalesce({raw}, {last}) AS m_domain_raw,
         coalesce(n.quantity_filled, f.struct_cmdow, {last}) AS m_naive,
         CASE WHEN f.date >= DATE '1999-10-01' AND f.date <= DATE '1999-12-31' AND f.quantity_filled IS NOT NULL
              THEN 'val' WHEN f.date >= DATE '2000-10-01' THEN 'test' END AS split
  FROM FEATS f LEFT JOIN FEATS n
    ON n.store_id = f.store_id AND n.item_id = f.item_id AND n.date = CAST(f.date - INTERVAL 365 DAY AS DATE)),
MEMS AS (SELECT * FROM MEM WHERE split IS NOT NULL),
GRID AS (SELECT * FROM (VALUES {grid_values(grid)}) g(grid_id, w1, w2, w3)),
GSCORE AS (
  SELECT store_id, grid_id, w1, w2, w3,
         sum(CASE WHEN quantity_filled > 0 THEN abs(quantity_filled - (w1 * m_struct + w2 * m_domain + w3 * m_naive)) END)
         / sum(CASE WHEN quantity_filled > 0 THEN quantity_filled END) AS wmape
  FROM MEMS, GRID WHERE split = 'val' GROUP BY ALL),
WEIGHTS AS (
  SELECT store_id, CASE WHEN wmape < 1 THEN grid_id END AS grid_id, CASE WHEN wmape < 1 THEN w1 ELSE 0.33::DOUBLE END AS w1,
         CASE WHEN wmape < 1 THEN w2 ELSE 0.33::DOUBLE END AS w2, CASE WHEN wmape < 1 THEN w3 ELSE 0.34::DOUBLE END AS w3, wmape FROM (
    SELECT *, row_number() OVER (PARTITION BY store_id
                                 ORDER BY round(coalesce(wmape, 'inf'::DOUBLE), 12), grid_id) AS rn FROM GSCORE) x
  WHERE rn = 1),
BL AS (SELECT m.*, w.w1, w.w2, w.w3, coalesce(w.w1, 0.33) * m.m_struct + coalesce(w.w2, 0.33) * m.m_domain
              + coalesce(w.w3, 0.34) * m.m_naive AS ensemble
       FROM MEMS m LEFT JOIN WEIGHTS w USING (store_id)),
BIAS AS (SELECT store_id, CASE WHEN avg(ensemble) > 0 THEN avg(quantity_filled) / avg(ensemble) ELSE 1.0 END AS bias
         FROM BL WHERE split = 'val' GROUP BY store_id),
PRED AS (SELECT b.*, bi.bias,
                (coalesce(b.w1, 0.33) * b.m_struct + coalesce(b.w2, 0.33) * b.m_domain_raw + coalesce(b.w3, 0.34) * b.m_naive)
                * coalesce(bi.bias, 1.0) AS raw_prediction, {clip('b.ensemble * coalesce(bi.bias, 1.0)', lo=0.0)} AS predicted
         FROM BL b LEFT JOIN BIAS bi USING (store_id))
"""
