"""Queries of exposed ground near reference polygons: distances, connected components, candidates, and the review of parcels as one chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from groundshift.operators import composite as comp
from groundshift.operators import polygons as pg
from groundshift.operators import quarry as qy
from groundshift.operators import scoring
from groundshift.operators.components import written
from groundshift.plans.composite import _types
from groundshift.plans.composite import _TYPES
from groundshift.plans.land import _GRID, _SERIES, _indexed, _persistence
from groundshift.plans.registry import query
from groundshift.plans.scoring import _JIMOK, _jimok
from groundshift.plans.shapes import _SIDES, _edges, _r, _shapes, _sweep
from groundshift.sources.tables import ctes, table

_LAYER = f"{ctes('quarry_points')}, {_edges('quarry_points', 'quarry_id')}"
_RELATED = f"""{_TYPES}, {_LAYER}, qc AS (SELECT k, r, c, (c + 0.5e0) * 10 AS x, (r + 0.5e0) * 10 AS y FROM (SELECT k, r, unnest(range(CAST(floor(x0 / 10) AS INT), CAST(ceil(x1 / 10) AS INT))) AS c FROM (SELECT *, unnest(range(CAST(floor(y0 / 10) AS INT), CAST(ceil(y1 / 10) AS INT))) AS r FROM quarry_b))),
    inq AS (SELECT DISTINCT r, c FROM (SELECT q.k, r, c FROM qc q JOIN quarry_e e ON e.k = q.k AND xa <= x AND x < xb AND ya + (yb - ya) / (xb - xa) * (x - xa) > y GROUP BY 1, 2, 3 HAVING sum(s) > 0)),
    far AS (SELECT t.r, t.c, min((t.r - i.r) * (t.r - i.r) + (t.c - i.c) * (t.c - i.c)) AS d2 FROM types t CROSS JOIN inq i GROUP BY t.r, t.c),
    ex AS (SELECT r, c FROM types WHERE type = 'EXPOSED_SURFACE_INCREASE'),
    xr AS (SELECT r, c, CAST(r AS BIGINT) * 1048576 + c AS q FROM ex UNION SELECT n.r, n.c, xr.q FROM xr JOIN ex n ON abs(n.r - xr.r) <= 1 AND abs(n.c - xr.c) <= 1),
    xc AS (SELECT r, c, min(q) AS comp FROM xr GROUP BY r, c), con AS (SELECT comp FROM xc JOIN far USING (r, c) GROUP BY comp HAVING count(*) >= 3 AND min(sqrt(d2) * 10) <= 30),
    rel AS (SELECT t.*, i.r IS NOT NULL AS inside, sqrt(d2) * 10e0 AS distance, xc.comp, con.comp IS NOT NULL AS connected FROM types t LEFT JOIN inq i ON i.r = t.r AND i.c = t.c LEFT JOIN far ON far.r = t.r AND far.c = t.c LEFT JOIN xc ON xc.r = t.r AND xc.c = t.c LEFT JOIN con ON con.comp = xc.comp),
    qcl AS (SELECT *, CASE WHEN type IS NULL AND NOT inside THEN NULL WHEN from_exposed AND type IS DISTINCT FROM 'EXPOSED_SURFACE_INCREASE' THEN 'POSSIBLE_REVEGETATION' WHEN type = 'EXPOSED_SURFACE_INCREASE' AND connected AND NOT inside THEN 'POTENTIAL_QUARRY_EXPANSION'
        WHEN type = 'EXPOSED_SURFACE_INCREASE' AND inside THEN 'QUARRY_INTERNAL_CHANGE' WHEN type = 'EXPOSED_SURFACE_INCREASE' THEN 'EXPOSED_SURFACE_CHANGE' WHEN type IN ('VEGETATION_LOSS', 'UNCERTAIN_CHANGE') THEN 'UNCLASSIFIED' WHEN inside THEN 'VERIFIED_QUARRY_AREA' END AS quarry_class FROM rel)"""


def _related(spark, sf_dir, quarries: pg.Shapes, source: str = "pixels"):
    """Cell types with their relation to the quarries, and the class that follows."""
    t = qy.related(_types(spark, sf_dir, source), F.col("type") == "EXPOSED_SURFACE_INCREASE", quarries.centres(), pg.SIZE)
    is_ = lambda *x: F.coalesce(F.col("type").isin(*x), F.lit(False))
    kind = comp.quarry_class(F.col("inside"), F.col("connected"), is_("EXPOSED_SURFACE_INCREASE"), is_("VEGETATION_LOSS", "UNCERTAIN_CHANGE"), F.col("from_exposed"), F.col("type").isNotNull())
    return t.withColumn("quarry_class", kind)


def _quarries(spark, sf_dir):
    return _shapes(spark, sf_dir, "quarry_points", "quarry_id")


@query("A55_A56_related_cells", f"WITH RECURSIVE {_RELATED} SELECT r, c, inside, round(distance, 6) AS distance, comp, connected FROM rel")
def related_cells(spark, sf_dir):
    return _related(spark, sf_dir, _quarries(spark, sf_dir)).select("r", "c", "inside", F.round("distance", 6).alias("distance"), "comp", "connected")


@query("P22_quarry_class", f"WITH RECURSIVE {_RELATED} SELECT quarry_class, count(*) AS cells FROM qcl GROUP BY 1")
def quarry_class(spark, sf_dir):
    return _related(spark, sf_dir, _quarries(spark, sf_dir)).groupBy("quarry_class").agg(F.count(F.lit(1)).alias("cells"))


@query("A13_candidates", f"""WITH RECURSIVE {_RELATED}, n AS (SELECT comp, count(*) AS n_cells, count(*) * 100e0 AS area_m2, min(first_exposed) AS first_interval, max(confidence) AS confidence, round(min(distance), 6) AS distance FROM qcl WHERE comp IS NOT NULL GROUP BY comp),
    f AS (SELECT comp, follow, row_number() OVER (PARTITION BY comp ORDER BY count(*) DESC, follow) AS i FROM qcl WHERE comp IS NOT NULL GROUP BY comp, follow), g AS (SELECT comp, quarry_class, row_number() OVER (PARTITION BY comp ORDER BY count(*) DESC, quarry_class) AS i FROM qcl WHERE comp IS NOT NULL GROUP BY comp, quarry_class)
    SELECT n.*, follow, quarry_class FROM n JOIN f ON f.comp = n.comp AND f.i = 1 JOIN g ON g.comp = n.comp AND g.i = 1""")
def candidates(spark, sf_dir):
    return qy.candidates(written(_related(spark, sf_dir, _quarries(spark, sf_dir))), pg.SIZE).withColumn("distance", F.round("distance", 6))


_MASKS = {
    "evaluable": "type IS NOT NULL", "exposed": "type = 'EXPOSED_SURFACE_INCREASE'", "exposed_persistent": "type = 'EXPOSED_SURFACE_INCREASE' AND follow = 'PERSISTENT'",
    "exposed_revegetated": "type = 'EXPOSED_SURFACE_INCREASE' AND follow = 'REVEGETATED'", "loss": "type = 'VEGETATION_LOSS'", "recovery": "type = 'VEGETATION_RECOVERY'", "persistent": "type = 'PERSISTENT_EXPOSED_SURFACE'",
    "uncertain": "type = 'UNCERTAIN_CHANGE'", "stable": "type = 'STABLE_VEGETATION'", "water": "wet", "built": "cls = 7", "expansion": "quarry_class = 'POTENTIAL_QUARRY_EXPANSION'",
    "internal": "quarry_class = 'QUARRY_INTERNAL_CHANGE'", "surface": "quarry_class = 'EXPOSED_SURFACE_CHANGE'", "revegetation": "quarry_class = 'POSSIBLE_REVEGETATION'",
}
_OUTSIDE = {"evaluable_out": "p_evaluable", "decline_out": "frequency > 0", "persistent_out": "persistence = 'PERSISTENT'", "temporary_out": "persistence = 'TEMPORARY'", "unconfirmed_out": "persistence = 'UNCONFIRMED'"}
#: Least area of a parcel and of a change, least share that can be judged.
_AREA, _FRACTION = 100.0, 0.5
_OK = lambda m: f"({m} >= 100 AND {m} / greatest(evaluable, 1e0) >= 0.1e0)"
_CHANGED = "('EXPOSED_SURFACE_INCREASE', 'VEGETATION_LOSS', 'VEGETATION_RECOVERY', 'UNCERTAIN_CHANGE')"
_CASE = lambda x, scores: f"CASE {x} " + " ".join(f"WHEN '{k}' THEN {v}e0" for k, v in scores.items()) + " ELSE 0e0 END"
_LAND_SQL = "CASE t.x " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in scoring.LAND.items()) + " END"

_REVIEW = f"""{_RELATED}{_SERIES[len(_GRID):]}, {ctes('zone_points', 'rail', 'classes')}, {_edges('zone_points', 'zone_id')},
    zc AS (SELECT k || '_' || r || '_' || c AS g, * FROM (SELECT k, r, unnest(range(CAST(floor(x0 / 10) AS INT), CAST(ceil(x1 / 10) AS INT))) AS c FROM (SELECT *, unnest(range(CAST(floor(y0 / 10) AS INT), CAST(ceil(y1 / 10) AS INT))) AS r FROM zone_b))),
    zp AS (SELECT g, 0 AS layer, s, xa, ya, xb, yb FROM zc JOIN zone_e USING (k) UNION ALL SELECT g, 1, s, c * 10e0, (r + h) * 10e0, c * 10e0 + 10, (r + h) * 10e0 FROM zc, (VALUES (1, 1), (0, -1)) v(h, s)
        UNION ALL SELECT g, 2, s, xa, ya, xb, yb FROM zc JOIN quarry_b b ON b.x0 <= c * 10 + 10 AND b.x1 >= c * 10 AND b.y0 <= r * 10 + 10 AND b.y1 >= r * 10 JOIN quarry_e e ON e.k = b.k),
    {_sweep('zp', 'zo')}, wz AS (SELECT k, r, c, ab AS area, ab - abc AS outside FROM zc JOIN zo USING (g) WHERE ab > 1e-6),
    wet AS (SELECT r, c, coalesce(bool_or(mndwi > 0.2e0), FALSE) AS wet FROM idx GROUP BY r, c), ps AS (SELECT r, c, evaluable AS p_evaluable, frequency, persistence FROM pers),
    za AS (SELECT k, sum(area) AS area_m2, sum(area) - sum(outside) AS overlap, {', '.join(f"coalesce(sum(CASE WHEN {m} THEN area END), 0e0) AS {a}" for a, m in _MASKS.items())}, {', '.join(f"coalesce(sum(CASE WHEN {m} THEN outside END), 0e0) AS {a}" for a, m in _OUTSIDE.items())},
        coalesce(sum(CASE WHEN cls > 0 THEN area END), 0e0) AS known FROM wz LEFT JOIN qcl USING (r, c) LEFT JOIN ps USING (r, c) LEFT JOIN wet USING (r, c) LEFT JOIN classes USING (r, c) GROUP BY k),
    rd AS (SELECT p.k, min({_SIDES}) AS rail FROM zone_s p CROSS JOIN rail q GROUP BY p.k), t AS (SELECT s_suppkey AS k, substr(trim({_JIMOK}), 1, 1) AS x FROM supplier),
    b1 AS (SELECT za.*, rail, overlap / area_m2 AS overlap_ratio, x IN ('전', '답', '과') AS farm, {_LAND_SQL} AS jimok, round(area_m2, 6) < 100 OR round(evaluable, 6) < 100 AS bad FROM za JOIN rd USING (k) JOIN t USING (k)),
    b2 AS (SELECT *, CASE WHEN bad THEN 'INSUFFICIENT_DATA' WHEN {_OK('exposed')} THEN 'EXPOSED_SURFACE_INCREASE' WHEN {_OK('loss')} THEN 'VEGETATION_LOSS' WHEN {_OK('recovery')} THEN 'VEGETATION_RECOVERY' WHEN {_OK('persistent')} THEN 'PERSISTENT_EXPOSED_SURFACE' WHEN {_OK('uncertain')} THEN 'UNCERTAIN_CHANGE'
        WHEN stable / greatest(evaluable, 1e0) >= 0.5e0 THEN 'STABLE_VEGETATION' ELSE 'NO_SIGNIFICANT_CHANGE' END AS composite_type,
        CASE WHEN concat_ws(';', CASE WHEN area_m2 < 100 THEN 'LOW_PIXEL_COUNT' END, CASE WHEN evaluable / area_m2 < 0.5e0 THEN 'LOW_COVERAGE' END, CASE WHEN water > 0.1e0 * greatest(evaluable, 1e0) THEN 'WATER_SUSPECT' END) = '' THEN 'VALID'
             ELSE concat_ws(';', CASE WHEN area_m2 < 100 THEN 'LOW_PIXEL_COUNT' END, CASE WHEN evaluable / area_m2 < 0.5e0 THEN 'LOW_COVERAGE' END, CASE WHEN water > 0.1e0 * greatest(evaluable, 1e0) THEN 'WATER_SUSPECT' END) END AS flags FROM b1),
    b3 AS (SELECT *, CASE WHEN bad THEN 'NOT_EVALUATED' WHEN expansion >= 100 THEN 'POTENTIAL_QUARRY_EXPANSION' WHEN internal >= 100 THEN 'QUARRY_INTERNAL_CHANGE' WHEN surface >= 100 THEN 'EXPOSED_SURFACE_CHANGE' WHEN revegetation >= 100 THEN 'POSSIBLE_REVEGETATION'
            WHEN overlap_ratio >= 0.5e0 THEN 'VERIFIED_QUARRY_AREA' WHEN composite_type = 'VEGETATION_LOSS' THEN 'GENERAL_VEGETATION_LOSS' ELSE 'NONE' END AS quarry_context,
        CASE WHEN bad THEN 'NONE' WHEN contains(flags, 'LOW_COVERAGE') OR contains(flags, 'WATER') THEN 'LOW' WHEN composite_type = 'EXPOSED_SURFACE_INCREASE' AND exposed_persistent >= 100 THEN 'HIGH' WHEN composite_type IN ('STABLE_VEGETATION', 'NO_SIGNIFICANT_CHANGE') THEN 'HIGH'
            WHEN composite_type IN ('VEGETATION_LOSS', 'UNCERTAIN_CHANGE') THEN 'LOW' ELSE 'MEDIUM' END AS confidence,
        concat_ws(';', CASE WHEN farm AND composite_type IN {_CHANGED} THEN 'FARMLAND_VARIATION_POSSIBLE' END, CASE WHEN composite_type IN {_CHANGED} AND (coalesce(built / nullif(known, 0), 0) >= 0.5e0 OR coalesce(jimok IN ({', '.join(f"'{x}'" for x in scoring.DEVELOPED)}), FALSE)) THEN 'BUILT_OR_DEVELOPED_CONTEXT' END,
            CASE WHEN jimok = '임야' AND composite_type IN {_CHANGED} THEN 'FOREST_MANAGEMENT_OR_CLEARING_POSSIBLE' END) AS confusion_risk,
        CASE WHEN decline_out <= 0 THEN 'NONE' WHEN persistent_out >= temporary_out AND persistent_out >= unconfirmed_out THEN 'PERSISTENT' WHEN temporary_out >= unconfirmed_out THEN 'TEMPORARY' ELSE 'UNCONFIRMED' END AS status_out, coalesce(decline_out / nullif(evaluable_out, 0), 0e0) AS ratio_out FROM b2),
    b4 AS (SELECT *, (0.4e0 * greatest(0e0, least(1e0, ratio_out / 0.5e0)) * 100 + 0.35e0 * {_CASE('status_out', qy.DECLINE_SCORES)} + 0.25e0 * greatest(0e0, least(1e0, (500e0 - rail) / 500e0)) * 100) AS a_score,
        decline_out >= 300 AND ratio_out >= 0.1e0 AND status_out IN ('PERSISTENT', 'UNCONFIRMED') AND composite_type <> 'INSUFFICIENT_DATA' AS a_candidate,
        0.4e0 * greatest(0e0, least(1e0, coalesce(exposed / nullif(evaluable, 0), 0e0) / 0.5e0)) * 100 + 0.4e0 * {_CASE('quarry_context', qy.LINK_SCORES)} + 0.2e0 * CASE WHEN exposed_persistent > 0 THEN 100e0 WHEN exposed > 0 AND exposed_revegetated <= 0 THEN 50e0 WHEN exposed_revegetated > 0 THEN 20e0 ELSE 0e0 END AS b_score,
        (exposed >= 200 OR quarry_context IN ('POTENTIAL_QUARRY_EXPANSION', 'QUARRY_INTERNAL_CHANGE')) AND composite_type <> 'INSUFFICIENT_DATA' AS b_candidate FROM b3)"""


@query("E05_P35_P40_quarry_review", f"""WITH RECURSIVE {_REVIEW} SELECT k AS zone_id, composite_type, quarry_context, flags, confidence, confusion_risk, status_out, round(overlap_ratio + 1e-9, 6) AS overlap_ratio, round(decline_out + 1e-9, 4) AS decline_out, round(exposed + 1e-9, 4) AS exposed,
    round(a_score + 1e-9, 6) AS a_score, a_candidate, CASE WHEN a_candidate THEN row_number() OVER (PARTITION BY a_candidate ORDER BY round(a_score, 9) DESC, round(decline_out, 6) DESC, k) END AS a_rank,
    round(b_score + 1e-9, 6) AS b_score, b_candidate, CASE WHEN b_candidate THEN row_number() OVER (PARTITION BY b_candidate ORDER BY round(b_score, 9) DESC, round(exposed, 6) DESC, k) END AS b_rank FROM b4""")
def quarry_review(spark, sf_dir):
    """From pixels and polygons to two rankings: types of cells, their relation to the reference, areas of parcels inside and outside of it, contexts, flags and scores."""
    return _ranked(_reviewed(spark, sf_dir))


def _reviewed(spark, sf_dir, source="pixels"):
    """Parcels with the areas of all masks, their type, context, flags, confidence and risks, from one table of pixels."""
    z, q = _shapes(spark, sf_dir, "zone_points", "zone_id"), _quarries(spark, sf_dir)
    cells = written(_related(spark, sf_dir, q, source))
    declines = _persistence(spark, sf_dir, source).select("r", "c", F.col("evaluable").alias("p_evaluable"), "frequency", "persistence")
    wet = _indexed(spark, sf_dir, source).groupBy("r", "c").agg(F.coalesce(F.bool_or(F.col("mndwi") > 0.2), F.lit(False)).alias("wet"))
    w = pg.overlaid(z, q).withColumn("outside", F.col("area") - F.col("both"))
    j = w.join(cells, ["r", "c"], "left").join(declines, ["r", "c"], "left").join(wet, ["r", "c"], "left").join(table(spark, sf_dir, "classes"), ["r", "c"], "left")
    total = lambda m, v: F.coalesce(F.sum(F.when(F.expr(m), F.col(v))), F.lit(0.0))
    a = j.groupBy("zone_id").agg(F.sum("area").alias("area_m2"), F.sum("both").alias("overlap"), total("cls > 0", "area").alias("known"), *(total(m, "area").alias(n) for n, m in _MASKS.items()), *(total(m, "outside").alias(n) for n, m in _OUTSIDE.items()))
    sides = pg.sides(z.points, "zone_id").select("zone_id", "xa", "ya", "xb", "yb")
    rail = table(spark, sf_dir, "rail").select("seg_id", *(F.col(x).cast("double").alias(y) for x, y in (("xa", "pa"), ("ya", "qa"), ("xb", "pb"), ("yb", "qb"))))
    a = a.join(pg.nearest_side(sides, rail, "zone_id", ["seg_id"]).select("zone_id", F.col("distance").alias("rail_distance")), "zone_id")
    letter = F.substring(F.trim(_jimok()), 1, 1)
    a = a.join(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("zone_id"), F.coalesce(letter.isin(scoring.FARMLAND), F.lit(False)).alias("farm"), scoring.looked_up(letter, scoring.LAND).alias("jimok")), "zone_id")
    bad = qy.insufficient(F.round("area_m2", 6), F.round("evaluable", 6), _AREA)
    masks = {m: F.col(m) for m in ("exposed", "loss", "recovery", "persistent", "uncertain", "stable")}
    a = a.withColumns({"overlap_ratio": F.col("overlap") / F.col("area_m2"), "bad": bad, "composite_type": F.when(bad, "INSUFFICIENT_DATA").otherwise(comp.parcel_type(F.round("area_m2", 6), F.round("evaluable", 6), masks, least=_AREA))})
    a = a.withColumn("flags", qy.flags(F.col("area_m2"), F.col("evaluable"), F.col("water"), [], _AREA, _FRACTION))
    areas = {"expansion": "expansion", "internal": "internal", "exposed": "surface", "revegetation": "revegetation", "overlap_ratio": "overlap_ratio", "type": "composite_type"}
    p, t, u = F.col("persistent_out"), F.col("temporary_out"), F.col("unconfirmed_out")
    a = a.withColumns({
        "quarry_context": qy.context({k: F.col(v) for k, v in areas.items()}, _AREA, F.col("bad")),
        "confidence": qy.confidence(F.col("composite_type"), F.col("flags"), F.col("exposed_persistent"), _AREA, F.col("bad")),
        "confusion_risk": scoring.confusion_risk(F.col("composite_type"), F.col("farm"), F.try_divide("built", F.nullif("known", F.lit(0.0))), F.coalesce("jimok", F.lit(""))),
        "status_out": F.when(F.col("decline_out") <= 0, "NONE").when((p >= t) & (p >= u), "PERSISTENT").when(t >= u, "TEMPORARY").otherwise("UNCONFIRMED"),
        "decline_ratio_out": F.try_divide("decline_out", F.nullif("evaluable_out", F.lit(0.0))), "exposed_ratio": F.try_divide("exposed", F.nullif("evaluable", F.lit(0.0))),
        "sufficient": F.col("composite_type") != "INSUFFICIENT_DATA",
    })
    return a


def _ranked(a):
    out = qy.ranking_b(qy.ranking_a(a, "zone_id"), "zone_id")
    return out.select(
        "zone_id", "composite_type", "quarry_context", "flags", "confidence", "confusion_risk", "status_out", _r("overlap_ratio", 6).alias("overlap_ratio"), _r("decline_out", 4).alias("decline_out"), _r("exposed", 4).alias("exposed"),
        _r("A_score", 6).alias("a_score"), F.col("A_candidate").alias("a_candidate"), F.col("A_rank").alias("a_rank"), _r("B_score", 6).alias("b_score"), F.col("B_candidate").alias("b_candidate"), F.col("B_rank").alias("b_rank"),
    )


@query("L06_priority_lists", f"""WITH RECURSIVE {_REVIEW}, x AS (SELECT 'A' AS list, k AS zone_id, row_number() OVER (ORDER BY round(a_score, 9) DESC, round(decline_out, 6) DESC, k) AS rank, round(a_score + 1e-9, 6) AS score FROM b4 WHERE a_candidate
    UNION ALL SELECT 'B', k, row_number() OVER (ORDER BY round(b_score, 9) DESC, round(exposed, 6) DESC, k), round(b_score + 1e-9, 6) FROM b4 WHERE b_candidate) SELECT * FROM x""")
def priority_lists(spark, sf_dir):
    e = quarry_review(spark, sf_dir)
    one = lambda n: e.where(f"{n}_candidate").select(F.lit(n.upper()).alias("list"), "zone_id", F.col(f"{n}_rank").alias("rank"), F.col(f"{n}_score").alias("score"))
    return one("a").union(one("b")).orderBy("list", "rank")
