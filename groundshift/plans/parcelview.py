"""Screening table of parcels from computed areas, the view over all results, and questions answered from it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundshift.operators import parcelview as pv
from groundshift.operators import polygons as pg
from groundshift.operators import series
from groundshift.operators.components import written
from groundshift.plans.land import _DECLINE, COMPOSITE, _grid
from groundshift.plans.quarry import _REVIEW, _reviewed
from groundshift.plans.registry import query
from groundshift.plans.shapes import _edges, _near, _r, _shapes, _sweep
from groundshift.sources.tables import ctes

#: Area of persistent decline outside of the reference that puts a parcel into the first tier; metres to the railway; the interval that is asked for.
_PERSISTENT, _NEARBY, _ASKED = 300.0, 150.0, 2
_LEAST = lambda ev: f"greatest(200e0, 0.1e0 * {ev})"
_AREA = lambda m: f"round(coalesce(sum(CASE WHEN {m} THEN area END), 0e0), 6)"

_SCREENED = f"""{_REVIEW}, {ctes('footprint_points')}, {_edges('footprint_points', 'bld_id')},
    vi AS (SELECT w.k AS zone, v.k, {_AREA('v.event')} AS d, {_AREA('e.event = 2')} AS ex, {_AREA('e.event = 1')} AS lo, {_AREA('e.event = 3')} AS rc, {_AREA('v.ndvi IS NOT NULL AND v.before IS NOT NULL')} AS e10, {_AREA('e.event IS NOT NULL')} AS e20
        FROM wz w JOIN ev v ON v.r = w.r AND v.c = w.c AND v.k > 0 LEFT JOIN events e ON e.r = v.r AND e.c = v.c AND e.k = v.k GROUP BY 1, 2),
    vs AS (SELECT zone, k, CASE WHEN NOT e10 >= 400 AND NOT e20 >= 800 THEN 'na' WHEN e20 >= 800 AND ex >= {_LEAST('e20')} THEN 'exposed' WHEN (e10 >= 400 AND d >= {_LEAST('e10')}) OR (e20 >= 800 AND lo >= {_LEAST('e20')}) THEN 'veg_loss' WHEN e20 >= 800 AND rc >= {_LEAST('e20')} THEN 'recovery' ELSE 'none' END AS status FROM vi),
    vl AS (SELECT zone, list(status ORDER BY k) AS states FROM vs GROUP BY zone),
    vt AS (SELECT b.*, b.k AS zone_id, coalesce(states, []) AS states, CASE WHEN len(list_filter(coalesce(states, []), lambda x: x <> 'na')) = 0 THEN 4 WHEN list_contains(states, 'exposed') OR round(persistent_out, 6) >= {_PERSISTENT} THEN 1 WHEN list_contains(states, 'veg_loss') OR list_contains(states, 'recovery') THEN 2 ELSE 3 END AS tier FROM b4 b LEFT JOIN vl ON zone = b.k),
    vn AS ({_near('footprint', 'zone')}), vp AS (SELECT (ka, kb) AS g, 0 AS layer, s, xa, ya, xb, yb FROM vn JOIN footprint_e ON k = ka UNION ALL SELECT (ka, kb), 1, s, xa, ya, xb, yb FROM vn JOIN zone_e ON k = kb), {_sweep('vp', 'vo')},
    vf AS (SELECT k, sum(s * (xb - xa) * (ya + yb) / 2) AS area FROM footprint_e GROUP BY k), vb AS (SELECT g[2] AS zone, count(*) AS buildings, sum(area) AS footprint_m2 FROM vo JOIN vf ON k = g[1] WHERE ab > 1e-6 AND round(ab, 6) >= 0.5e0 * round(area, 6) GROUP BY 1),
    view_ AS (SELECT vt.zone_id, concat(CAST(vt.zone_id % 40 AS VARCHAR), '-', CAST(vt.zone_id % 3 AS VARCHAR)) AS lot, tier, states, coalesce(buildings, 0) AS buildings, round(coalesce(footprint_m2, 0e0) + 1e-9, 4) AS footprint_m2, composite_type, quarry_context, confusion_risk, round(exposed + 1e-9, 2) AS exposed_m2, round(rail + 1e-9, 2) AS rail_m, farm FROM vt LEFT JOIN vb ON zone = vt.zone_id)"""


def _screened(spark, sf_dir):
    """Parcels with the states of all intervals, tier, buildings, type, context and distances."""
    z, f = _shapes(spark, sf_dir, "zone_points", "zone_id"), _shapes(spark, sf_dir, "footprint_points", "bld_id")
    g = written(_grid(spark, sf_dir))
    own = series.decline_events(g, **_DECLINE).where("k > 0").select("r", "c", "k", F.col("event").alias("decline"), (F.col("ndvi").isNotNull() & F.col("before").isNotNull()).alias("known"))
    both = series.composite_events(g, series.interval_shifts(g), COMPOSITE).select("r", "c", "k", "event")
    states = pv.interval_states(z.cover, "zone_id", own.join(both, ["r", "c", "k"], "left"))
    p = pv.screened(written(_reviewed(spark, sf_dir)), written(states), "zone_id", F.round("persistent_out", 6) >= _PERSISTENT)
    b = pv.buildings_of(pg.overlaps(f, z), f.cover.groupBy("bld_id").agg(F.sum("area").alias("area")), "zone_id", "bld_id")
    lot = F.concat((F.col("zone_id") % 40).cast("string"), F.lit("-"), (F.col("zone_id") % 3).cast("string"))
    return p.join(b, "zone_id", "left").select(
        "zone_id", lot.alias("lot"), "tier", "states", F.coalesce("buildings", F.lit(0)).alias("buildings"), _r(F.coalesce("footprint_m2", F.lit(0.0)), 4).alias("footprint_m2"),
        "composite_type", "quarry_context", "confusion_risk", _r("exposed", 2).alias("exposed_m2"), _r("rail_distance", 2).alias("rail_m"), "farm",
    )


@query("E10_screening_table", f"WITH RECURSIVE {_SCREENED} SELECT zone_id, tier, array_to_string(states, ',') AS states, buildings, footprint_m2 FROM view_")
def screening_table(spark, sf_dir):
    return _screened(spark, sf_dir).select("zone_id", "tier", F.array_join("states", ",").alias("states"), "buildings", "footprint_m2")


@query("S29_parcel_view", f"WITH RECURSIVE {_SCREENED} SELECT zone_id, lot, CASE tier WHEN 1 THEN 'FIRST_CHECK' WHEN 2 THEN 'RECOMMENDED' WHEN 3 THEN 'NO_CHANGE' ELSE 'UNDETERMINED' END AS tier_name, array_to_string(states, ',') AS states, buildings, footprint_m2, composite_type, quarry_context, confusion_risk, exposed_m2, rail_m, rail_m <= {_NEARBY} AS near_rail FROM view_")
def parcel_view(spark, sf_dir):
    name = F.element_at(F.array(*map(F.lit, ("FIRST_CHECK", "RECOMMENDED", "NO_CHANGE", "UNDETERMINED"))), F.col("tier"))
    return _screened(spark, sf_dir).select("zone_id", "lot", name.alias("tier_name"), F.array_join("states", ",").alias("states"), "buildings", "footprint_m2", "composite_type", "quarry_context", "confusion_risk", "exposed_m2", "rail_m", (F.col("rail_m") <= _NEARBY).alias("near_rail"))


#: Questions: the rows they are about, and the column that the first five of them are told by (True: falling).
_QUESTIONS = {
    "first check": ("tier = 1", "zone_id", False), "exposed in the interval": (f"{{at}} = 'exposed'", "exposed_m2", True), "first check near the railway": (f"tier = 1 AND rail_m <= {_NEARBY}", "rail_m", False),
    "possible expansion": ("quarry_context = 'POTENTIAL_QUARRY_EXPANSION'", "exposed_m2", True), "first check with buildings": ("tier = 1 AND buildings > 0", "footprint_m2", True), "changing farmland": ("farm AND tier IN (1, 2)", "zone_id", False), "undetermined": ("tier = 4", "zone_id", False),
}
_ASK = lambda q, m, c, down: f"SELECT '{q}' AS question, count(*) AS n, coalesce(string_agg(concat(lot, '/', CAST(zone_id AS VARCHAR)), ', ' ORDER BY i) FILTER (i <= 5), '') AS top FROM (SELECT *, row_number() OVER (ORDER BY {c} {'DESC' if down else 'ASC'}, zone_id) AS i FROM view_ WHERE {m.format(at=f'states[{_ASKED}]')})"


@query("A65_answers", f"WITH RECURSIVE {_SCREENED} " + " UNION ALL ".join(_ASK(q, *x) for q, x in _QUESTIONS.items()) + " UNION ALL SELECT 'lots of several parcels', count(*), '' FROM (SELECT lot FROM view_ GROUP BY lot HAVING count(*) > 1)")
def answers(spark, sf_dir):
    v = written(_screened(spark, sf_dir))
    text = F.concat("lot", F.lit("/"), F.col("zone_id").cast("string"))
    told = [pv.answer(q, v.where(m.format(at=f"try_element_at(states, {_ASKED})")), {c: down} | ({} if c == "zone_id" else {"zone_id": False}), text) for q, (m, c, down) in _QUESTIONS.items()]
    several = v.groupBy("lot").count().where("count > 1").agg(F.count(F.lit(1)).alias("n")).select(F.lit("lots of several parcels").alias("question"), "n", F.lit("").alias("top"))
    return reduce(DataFrame.unionByName, [*told, several])
