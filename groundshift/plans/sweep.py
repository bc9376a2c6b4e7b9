"""Queries of parameter sweeps and of two runs over the same parcels: one from means of the observations, one from their medians."""

from __future__ import annotations

from pyspark.sql import functions as F

from groundshift.operators import comparison, sweep
from groundshift.operators import polygons as pg
from groundshift.operators.components import written
from groundshift.operators.series import interval_shifts
from groundshift.plans.land import _C, _COMPOSITE, _GRID, COMPOSITE, _grid
from groundshift.plans.quarry import _LAYER, _REVIEW, _quarries, _reviewed
from groundshift.plans.registry import query
from groundshift.plans.shapes import _edges, _r, _shapes, _sweep
from groundshift.plans.stats_profiles import PROFILES
from groundshift.sources.tables import ADAPTERS, ctes

_BASE = {"delta": COMPOSITE["delta"], "increase": COMPOSITE["increase"], "least": 3, "adjacency": 30.0, "followup": 1}
_VALUES = {"delta": [-0.15, -0.2, -0.3], "increase": [0.05, 0.1, 0.15], "least": [1, 2, 4], "followup": [1, 2], "adjacency": [20.0, 40.0, 80.0, 120.0]}
VARIANTS = sweep.one_at_a_time(_BASE, _VALUES)
SETTINGS = list(dict.fromkeys((v.delta, v.increase) for v in VARIANTS))
_PARCEL_AREA = 100.0


def _cells(name: str, key: str, out: str) -> str:
    """Coverage of a layer of polygons as (k, r, c, area)."""
    n = name.removesuffix("_points")
    return f"""{out}_c AS (SELECT k || '_' || r || '_' || c AS g, * FROM (SELECT k, r, unnest(range(CAST(floor(x0 / 10) AS INT), CAST(ceil(x1 / 10) AS INT))) AS c FROM (SELECT *, unnest(range(CAST(floor(y0 / 10) AS INT), CAST(ceil(y1 / 10) AS INT))) AS r FROM {n}_b))),
    {out}_p AS (SELECT g, 0 AS layer, s, xa, ya, xb, yb FROM {out}_c JOIN {n}_e USING (k) UNION ALL SELECT g, 1, s, c * 10e0, (r + h) * 10e0, c * 10e0 + 10, (r + h) * 10e0 FROM {out}_c, (VALUES (1, 1), (0, -1)) v(h, s)),
    {_sweep(f'{out}_p', f'{out}_o')}, {out} AS (SELECT k, r, c, ab AS area FROM {out}_c JOIN {out}_o USING (g) WHERE ab > 1e-6)"""


_SWEPT = f"""{_COMPOSITE}, {_LAYER}, {ctes('aoi_points', 'zone_points')}, {_edges('aoi_points', 'aoi_id')}, {_edges('zone_points', 'zone_id')}, {_cells('aoi_points', 'aoi_id', 'ao')}, {_cells('zone_points', 'zone_id', 'zo')},
    sv AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{v.parameter}', '{v.value}', {v.delta}e0, {v.increase}e0, {v.least}, {v.adjacency}e0)" for i, v in enumerate(VARIANTS))}) AS v(i, parameter, value, d, inc, least, adjacency)),
    sl AS (SELECT i, r, c, v AND ndvi0 >= {_C['before']} AND ndvi <= {_C['after']} AND dn <= d AS loss, v AND ndvi0 < {_C['recovery']} AND dn >= {_C['recovery_delta']} AND ndvi >= {_C['recovery']} AND db <= -{_C['decrease']} AND NOT wt AS back, db >= inc AND bsi >= {_C['exposed_bsi']} AND NOT wt AS bared, NOT wt AND NOT db <= -{_C['conflict']} AS sure FROM dd, sv),
    sx AS (SELECT i, r, c, coalesce(bool_or(loss AND bared), FALSE) AS exposed, coalesce(bool_or(loss AND (bared OR sure)), FALSE) AS loss, coalesce(bool_or(back AND NOT loss), FALSE) AS recovery FROM sl GROUP BY i, r, c),
    qc AS (SELECT k, r, c, (c + 0.5e0) * 10 AS x, (r + 0.5e0) * 10 AS y FROM (SELECT k, r, unnest(range(CAST(floor(x0 / 10) AS INT), CAST(ceil(x1 / 10) AS INT))) AS c FROM (SELECT *, unnest(range(CAST(floor(y0 / 10) AS INT), CAST(ceil(y1 / 10) AS INT))) AS r FROM quarry_b))),
    inq AS (SELECT DISTINCT r, c FROM (SELECT q.k, r, c FROM qc q JOIN quarry_e e ON e.k = q.k AND xa <= x AND x < xb AND ya + (yb - ya) / (xb - xa) * (x - xa) > y GROUP BY 1, 2, 3 HAVING sum(s) > 0)),
    far AS (SELECT t.r, t.c, sqrt(min((t.r - i.r) * (t.r - i.r) + (t.c - i.c) * (t.c - i.c))) * 10 AS away FROM (SELECT DISTINCT r, c FROM sx WHERE exposed) t CROSS JOIN inq i GROUP BY t.r, t.c),
    ex AS (SELECT i, r, c FROM sx WHERE exposed), xr AS (SELECT i, r, c, CAST(r AS BIGINT) * 1048576 + c AS q FROM ex UNION SELECT n.i, n.r, n.c, xr.q FROM xr JOIN ex n ON n.i = xr.i AND abs(n.r - xr.r) <= 1 AND abs(n.c - xr.c) <= 1),
    xc AS (SELECT i, r, c, min(q) AS comp FROM xr GROUP BY i, r, c), near AS (SELECT i, comp FROM xc JOIN far USING (r, c) JOIN sv USING (i) GROUP BY i, comp, least, adjacency HAVING count(*) >= least AND min(away) <= adjacency),
    ep2 AS (SELECT i, r, c FROM xc JOIN near USING (i, comp) WHERE (r, c) NOT IN (SELECT (r, c) FROM inq)), st2 AS (SELECT sx.*, e.r IS NOT NULL AS expansion FROM sx LEFT JOIN ep2 e ON e.i = sx.i AND e.r = sx.r AND e.c = sx.c),
    ia AS (SELECT i, {', '.join(f"coalesce(sum(CASE WHEN {m} THEN area END), 0e0) / 1e4 AS {m}_ha" for m in ('exposed', 'loss', 'expansion', 'recovery'))} FROM ao JOIN st2 USING (r, c) GROUP BY i),
    ip AS (SELECT i, count(*) FILTER (round(e, 6) >= {_PARCEL_AREA}) AS parcels_exposed, count(*) FILTER (round(p, 6) >= {_PARCEL_AREA}) AS parcels_expansion FROM (SELECT i, k, coalesce(sum(CASE WHEN exposed THEN area END), 0e0) AS e, coalesce(sum(CASE WHEN expansion THEN area END), 0e0) AS p FROM zo JOIN st2 USING (r, c) GROUP BY i, k) GROUP BY i),
    ij AS (SELECT a.i, count(*) FILTER (a.exposed AND b.exposed) AS eb, count(*) FILTER (a.exposed OR b.exposed) AS ee, count(*) FILTER (a.expansion AND b.expansion) AS pb, count(*) FILTER (a.expansion OR b.expansion) AS pe FROM st2 a JOIN st2 b ON b.i = 0 AND b.r = a.r AND b.c = a.c GROUP BY a.i)"""


@query("A43_parameter_sweep", f"""WITH RECURSIVE {_SWEPT} SELECT parameter, value, {', '.join(f'round(coalesce({m}_ha, 0e0) + 1e-9, 6) AS {m}_ha' for m in ('exposed', 'loss', 'expansion', 'recovery'))}, coalesce(parcels_exposed, 0) AS parcels_exposed, coalesce(parcels_expansion, 0) AS parcels_expansion,
    round(coalesce(eb, 0) * 1e0 / greatest(coalesce(ee, 0), 1) + 1e-9, 6) AS jaccard_exposed, round(pb * 1e0 / nullif(pe, 0) + 1e-9, 6) AS jaccard_expansion FROM sv LEFT JOIN ia USING (i) LEFT JOIN ip USING (i) LEFT JOIN ij USING (i)""")
def parameter_sweep(spark, sf_dir):
    g = written(_grid(spark, sf_dir))
    states = written(sweep.swept_states(g, interval_shifts(g), COMPOSITE, SETTINGS))
    wider = sweep.expanded(states, _quarries(spark, sf_dir).centres(), VARIANTS, SETTINGS, pg.SIZE)
    area, zones = (_shapes(spark, sf_dir, n, k).cover for n, k in (("aoi_points", "aoi_id"), ("zone_points", "zone_id")))
    out = sweep.swept(states, wider, area, zones, VARIANTS, SETTINGS, "zone_id", _PARCEL_AREA)
    return out.select(*(c if c in ("parameter", "value") or c.startswith("parcels") else _r(c, 6).alias(c) for c in out.columns))


@query("A41_profile_areas", f"""WITH {_GRID}, pr AS (SELECT * FROM (VALUES {', '.join(f"('{p}', {b}e0, {a}e0, {d}e0)" for p, (b, a, d) in PROFILES.items())}) AS v(profile, b, a, d)), l AS (SELECT r, c, k, ndvi, lag(ndvi) OVER (PARTITION BY r, c ORDER BY k) AS before, count(ndvi) OVER (PARTITION BY r, c) AS n FROM grid),
    e AS (SELECT profile, r, c, k, ndvi, coalesce(before >= b AND ndvi <= a AND ndvi - before <= d, FALSE) AND n >= 4 AS event FROM l, pr), z AS (SELECT *, max(CASE WHEN event THEN k END) OVER (PARTITION BY profile, r, c) AS last_k FROM e),
    s AS (SELECT profile, r, c, count(*) FILTER (event) AS f, CASE WHEN count(*) FILTER (event) = 0 THEN 'NONE' WHEN coalesce(bool_or(k > last_k AND ndvi >= 0.4e0), FALSE) THEN 'TEMPORARY' WHEN count(ndvi) FILTER (k > last_k) >= 1 THEN 'PERSISTENT' ELSE 'UNCONFIRMED' END AS kind FROM z GROUP BY 1, 2, 3)
    SELECT s.profile, count(*) FILTER (s.f > 0) AS decline_cells, count(*) FILTER (s.f > 0) * 100e0 AS decline_area_m2, {', '.join(f"count(*) FILTER (s.kind = '{k}') * 100e0 AS {k.lower()}_area_m2" for k in ('PERSISTENT', 'TEMPORARY', 'UNCONFIRMED'))}, count(*) FILTER (s.f >= 2) AS repeated_cells,
    round(count(*) FILTER (s.f > 0 AND b.f > 0) * 1e0 / nullif(count(*) FILTER (s.f > 0 OR b.f > 0), 0), 6) AS jaccard FROM s JOIN s b ON b.profile = 'default' AND b.r = s.r AND b.c = s.c GROUP BY s.profile""")
def profile_areas(spark, sf_dir):
    return sweep.profile_areas(_grid(spark, sf_dir), PROFILES, pg.SIZE**2).withColumn("jaccard", F.round("jaccard", 6))


_KEPT = "k AS zone_id, composite_type, quarry_context, exposed"
_TWO_RUNS = f"""one AS (WITH RECURSIVE {_REVIEW} SELECT {_KEPT} FROM b3), two AS (WITH RECURSIVE {_REVIEW.replace(ctes('pixels'), f"pixels AS ({ADAPTERS['median_pixels'].strip()})")} SELECT {_KEPT} FROM b3),
    runs AS (SELECT zone_id, a.composite_type AS composite_type_single, b.composite_type AS composite_type_comp, a.quarry_context AS quarry_context_single, b.quarry_context AS quarry_context_comp, a.exposed AS exposed_single, b.exposed AS exposed_comp, a.composite_type = b.composite_type AS type_agree,
        a.composite_type = 'EXPOSED_SURFACE_INCREASE' AND b.composite_type = 'EXPOSED_SURFACE_INCREASE' AS robust_exposed_increase, a.quarry_context = 'POTENTIAL_QUARRY_EXPANSION' AND b.quarry_context = 'POTENTIAL_QUARRY_EXPANSION' AS robust_quarry_expansion FROM one a JOIN two b USING (zone_id))"""


def _runs(spark, sf_dir):
    one, two = (_reviewed(spark, sf_dir, source).select("zone_id", "composite_type", "quarry_context", "exposed") for source in ("pixels", "median_pixels"))
    return comparison.compared(one, two, "zone_id", ["composite_type", "quarry_context", "exposed"])


@query("E06_J28_run_comparison", f"WITH {_TWO_RUNS} SELECT * EXCLUDE (exposed_single, exposed_comp), round(exposed_single + 1e-9, 4) AS exposed_single, round(exposed_comp + 1e-9, 4) AS exposed_comp, robust_exposed_increase OR robust_quarry_expansion AS robust_any FROM runs")
def run_comparison(spark, sf_dir):
    return _runs(spark, sf_dir).withColumns({f"exposed_{x}": _r(f"exposed_{x}", 4) for x in ("single", "comp")})


@query("A48_two_runs", f"""WITH {_TWO_RUNS}, e AS (SELECT *, composite_type_single <> 'INSUFFICIENT_DATA' AND composite_type_comp <> 'INSUFFICIENT_DATA' AS ok FROM runs)
    SELECT count(*) AS n, count(*) FILTER (ok) AS n_evaluable, round(count(*) FILTER (ok AND type_agree) * 1e0 / nullif(count(*) FILTER (ok), 0), 6) AS agreement,
    {', '.join(f"count(*) FILTER ({c}_single = '{t}') AS {n}_single, count(*) FILTER ({c}_comp = '{t}') AS {n}_comp, count(*) FILTER ({c}_single = '{t}' AND {c}_comp = '{t}') AS {n}_both, round(count(*) FILTER ({c}_single = '{t}' AND {c}_comp = '{t}') * 1e0 / nullif(count(*) FILTER ({c}_single = '{t}' OR {c}_comp = '{t}'), 0), 6) AS {n}_jaccard" for n, (c, t) in comparison.TARGETS.items())},
    CASE WHEN count(*) FILTER (ok) > 3 THEN round(covar_pop(exposed_single, exposed_comp) FILTER (ok) / nullif(stddev_pop(exposed_single) FILTER (ok) * stddev_pop(exposed_comp) FILTER (ok), 0), 6) END AS exposed_r, count(*) FILTER (robust_exposed_increase OR robust_quarry_expansion) AS robust FROM e""")
def two_runs(spark, sf_dir):
    s = comparison.agreement(_runs(spark, sf_dir), "exposed")
    return s.select(*(F.round(c, 6).alias(c) if c in ("agreement", "exposed_r") or c.endswith("_jaccard") else c for c in s.columns))
