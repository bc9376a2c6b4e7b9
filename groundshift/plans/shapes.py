"""Queries of polygons with slanted sides and holes. Their SQL sweeps whole shapes or pairs of shapes, without cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from groundshift.operators import polygons as pg
from groundshift.operators.components import components
from groundshift.plans.registry import query
from groundshift.sources.tables import ctes, table

def _edges(name: str, key: str) -> str:
    """Sides, signed edges and boxes of a layer as common table expressions name_s, name_e, name_b."""
    n = name.removesuffix("_points")
    return f"""{n}_s AS (SELECT {key} AS k, ring, x AS xa, y AS ya, coalesce(lead(x) OVER w, first_value(x) OVER w) AS xb, coalesce(lead(y) OVER w, first_value(y) OVER w) AS yb FROM {name} WINDOW w AS (PARTITION BY {key}, ring ORDER BY i)),
    {n}_e AS (SELECT k, CASE WHEN xa < xb THEN -o ELSE o END AS s, least(xa, xb) AS xa, CASE WHEN xa < xb THEN ya ELSE yb END AS ya, greatest(xa, xb) AS xb, CASE WHEN xa < xb THEN yb ELSE ya END AS yb
        FROM (SELECT *, sign(sum(xa * yb - xb * ya) OVER (PARTITION BY k, ring)) * CASE WHEN ring = 0 THEN 1 ELSE -1 END AS o FROM {n}_s) WHERE xa <> xb),
    {n}_b AS (SELECT k, min(xa) AS x0, max(xa) AS x1, min(ya) AS y0, max(ya) AS y1 FROM {n}_s GROUP BY k)"""


def _near(a: str, b: str, by: float = 0) -> str:
    return f"SELECT a.k AS ka, b.k AS kb FROM {a}_b a JOIN {b}_b b ON a.x0 - {by} <= b.x1 AND b.x0 <= a.x1 + {by} AND a.y0 - {by} <= b.y1 AND b.y0 <= a.y1 + {by}"


def _sweep(src: str, out: str) -> str:
    """Areas of layer 0, layer 1, both and all three layers of each group g of edges (g, layer, s, xa, ya, xb, yb), from slabs between all places where an edge ends or two cross."""
    y = "(({0}.yb - {0}.ya) / ({0}.xb - {0}.xa) * ({1} - {0}.xa) + {0}.ya)"
    lo, hi = "greatest(p.xa, q.xa)", "least(p.xb, q.xb)"
    return f"""{out}_c AS (SELECT g, lo + (hi - lo) * d0 / (d0 - d1) AS x FROM (SELECT p.g, {lo} AS lo, {hi} AS hi, {y.format('p', lo)} - {y.format('q', lo)} AS d0, {y.format('p', hi)} - {y.format('q', hi)} AS d1
            FROM {src} p JOIN {src} q ON p.g = q.g AND p.xa < q.xb AND q.xa < p.xb) WHERE d0 * d1 < 0),
        {out}_x AS (SELECT g, x AS lo, lead(x) OVER (PARTITION BY g ORDER BY x) AS hi FROM (SELECT g, xa AS x FROM {src} UNION SELECT g, xb FROM {src} UNION SELECT g, x FROM {out}_c)),
        {out}_y AS (SELECT e.g, lo, hi, layer, s, (lo + hi) / 2 AS m, {y.format('e', '((lo + hi) / 2)')} AS y FROM {out}_x x JOIN {src} e ON e.g = x.g AND e.xa <= (lo + hi) / 2 AND e.xb >= (lo + hi) / 2 WHERE hi > lo),
        {out}_w AS (SELECT g, (hi - lo) * (y - coalesce(lead(y) OVER o, y)) AS area, sum(CASE WHEN layer = 0 THEN s ELSE 0 END) OVER o > 0 AS a, sum(CASE WHEN layer = 1 THEN s ELSE 0 END) OVER o > 0 AS b, sum(CASE WHEN layer = 2 THEN s ELSE 0 END) OVER o > 0 AS c FROM {out}_y
            WINDOW o AS (PARTITION BY g, lo ORDER BY y DESC, layer, s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
        {out} AS (SELECT g, coalesce(sum(area) FILTER (a), 0e0) AS a, coalesce(sum(area) FILTER (b), 0e0) AS b, coalesce(sum(area) FILTER (a AND b), 0e0) AS ab, coalesce(sum(area) FILTER (a AND b AND c), 0e0) AS abc FROM {out}_w GROUP BY g)"""


def _over(a: str, b: str, out: str = "o") -> str:
    """Sweep of each shape of a with all near shapes of b."""
    return f"{out}_n AS ({_near(a, b)}), {out}_p AS (SELECT k AS g, 0 AS layer, s, xa, ya, xb, yb FROM {a}_e UNION ALL SELECT ka, 1, s, xa, ya, xb, yb FROM {out}_n JOIN {b}_e ON k = kb), {_sweep(f'{out}_p', out)}"


_TO = "sqrt(pow({x} - {p}xa - {t} * ({p}xb - {p}xa), 2) + pow({y} - {p}ya - {t} * ({p}yb - {p}ya), 2))"


def _to_side(x: str, y: str, p: str) -> str:
    t = f"greatest(0e0, least(1e0, (({x} - {p}xa) * ({p}xb - {p}xa) + ({y} - {p}ya) * ({p}yb - {p}ya)) / nullif(pow({p}xb - {p}xa, 2) + pow({p}yb - {p}ya, 2), 0)))"
    return _TO.format(x=x, y=y, p=p, t=t)


def _turn(x: str, y: str, p: str) -> str:
    return f"(({p}xb - {p}xa) * ({y} - {p}ya) - ({p}yb - {p}ya) * ({x} - {p}xa))"


#: Distance of the sides p and q.
_SIDES = f"""CASE WHEN {_turn('q.xa', 'q.ya', 'p.')} * {_turn('q.xb', 'q.yb', 'p.')} < 0 AND {_turn('p.xa', 'p.ya', 'q.')} * {_turn('p.xb', 'p.yb', 'q.')} < 0 THEN 0e0
    ELSE least({_to_side('q.xa', 'q.ya', 'p.')}, {_to_side('q.xb', 'q.yb', 'p.')}, {_to_side('p.xa', 'p.ya', 'q.')}, {_to_side('p.xb', 'p.yb', 'q.')}) END"""


def _r(x, digits: int) -> Column:
    """Rounded as in the SQL: what lies on half a digit, but for the last bits, goes up in both."""
    return F.round((F.col(x) if isinstance(x, str) else x) + 1e-9, digits)


def _shapes(spark, sf_dir, name: str, key: str, size: float = pg.SIZE) -> pg.Shapes:
    return pg.Shapes(table(spark, sf_dir, name), key, size)


_ZONES = f"{ctes('zone_points')}, {_edges('zone_points', 'zone_id')}"


@query("J08_shape_coverage", f"""WITH {_ZONES}, cell AS (SELECT k, r, c FROM (SELECT k, r, unnest(range(CAST(floor(x0 / 10) AS INT), CAST(ceil(x1 / 10) AS INT))) AS c FROM (SELECT *, unnest(range(CAST(floor(y0 / 10) AS INT), CAST(ceil(y1 / 10) AS INT))) AS r FROM zone_b))),
    box AS (SELECT k || '_' || r || '_' || c AS g, * FROM cell), p AS (SELECT g, 0 AS layer, s, xa, ya, xb, yb FROM box JOIN zone_e USING (k) UNION ALL SELECT g, 1, s, c * 10e0, (r + h) * 10e0, c * 10e0 + 10, (r + h) * 10e0 FROM box, (VALUES (1, 1), (0, -1)) v(h, s)),
    {_sweep('p', 'o')} SELECT k AS zone_id, r, c, round(ab + 1e-9, 5) AS area FROM box JOIN o USING (g) WHERE ab > 1e-6""")
def shape_coverage(spark, sf_dir):
    return _shapes(spark, sf_dir, "zone_points", "zone_id").cover.select("zone_id", "r", "c", _r("area", 5).alias("area"))


@query("F15_shape_measures", f"WITH {_ZONES}, r AS (SELECT k, ring, sum(xa * yb - xb * ya) AS a, sum((xa + xb) * (xa * yb - xb * ya)) AS mx, sum((ya + yb) * (xa * yb - xb * ya)) AS my, sum(sqrt(pow(xb - xa, 2) + pow(yb - ya, 2))) AS l FROM zone_s GROUP BY k, ring), t AS (SELECT k, sum(abs(a) * CASE WHEN ring = 0 THEN 1 ELSE -1 END) AS a, sum(mx * sign(a) * CASE WHEN ring = 0 THEN 1 ELSE -1 END) AS mx, sum(my * sign(a) * CASE WHEN ring = 0 THEN 1 ELSE -1 END) AS my, sum(l) AS l FROM r GROUP BY k) SELECT k AS zone_id, round(a / 2 + 1e-9, 6) AS area, round(l + 1e-9, 6) AS perimeter, round(mx / (3 * a) + 1e-9, 6) AS x, round(my / (3 * a) + 1e-9, 6) AS y FROM t")
def shape_measures(spark, sf_dir):
    return pg.measures(table(spark, sf_dir, "zone_points"), "zone_id").select("zone_id", *(_r(c, 6).alias(c) for c in ("area", "perimeter", "x", "y")))


@query("J11_clipped_to_area", f"WITH {_ZONES}, {ctes('aoi_points')}, {_edges('aoi_points', 'aoi_id')}, {_over('zone', 'aoi')} SELECT g AS zone_id, round(a + 1e-9, 4) AS area_m2, round(ab + 1e-9, 4) AS area_in_aoi_m2 FROM o WHERE ab > 0.01e0")
def clipped_to_area(spark, sf_dir):
    o = pg.overlaid(_shapes(spark, sf_dir, "zone_points", "zone_id"), _shapes(spark, sf_dir, "aoi_points", "aoi_id")).groupBy("zone_id").agg(F.sum("area").alias("area"), F.sum("both").alias("both"))
    return o.where("both > 0.01").select("zone_id", _r("area", 4).alias("area_m2"), _r("both", 4).alias("area_in_aoi_m2"))


@query("J13_union_area", f"WITH {_ZONES}, p AS (SELECT CAST(floor(k / 10) AS BIGINT) AS g, 0 AS layer, s, xa, ya, xb, yb FROM zone_e), {_sweep('p', 'o')}, t AS (SELECT g, sum(s * (xb - xa) * (ya + yb) / 2) AS total FROM p GROUP BY g) SELECT g AS block, round(total + 1e-9, 4) AS area_sum, round(a + 1e-9, 4) AS area_union, round(total - a + 1e-9, 4) AS counted_twice FROM o JOIN t USING (g)")
def union_area(spark, sf_dir):
    z = _shapes(spark, sf_dir, "zone_points", "zone_id")
    block = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("zone_id"), F.floor(F.col("s_suppkey") / 10).cast("bigint").alias("block"))
    u = pg.union_area(z, block, "block")
    return u.select("block", _r("area_sum", 4).alias("area_sum"), _r("area_union", 4).alias("area_union"), _r(F.col("area_sum") - F.col("area_union"), 4).alias("counted_twice"))


_QUARRY = f"{ctes('quarry_points')}, {_edges('quarry_points', 'quarry_id')}"


@query("J22_J32_reference", f"""WITH {_ZONES}, {_QUARRY}, {_over('zone', 'quarry')}, d AS (SELECT p.k, min({_SIDES}) AS d FROM zone_s p CROSS JOIN quarry_s q GROUP BY p.k), t AS (SELECT k, round(CASE WHEN ab > 1e-6 THEN 0e0 ELSE d END + 1e-9, 6) AS distance, a, ab FROM d JOIN o ON o.g = d.k)
    SELECT k AS zone_id, distance, round(ab + 1e-9, 4) AS overlap_m2, round(ab / a + 1e-9, 6) AS overlap_ratio, distance <= 30 AS adjacent, round(a - ab + 1e-9, 4) AS outside_m2 FROM t""")
def reference(spark, sf_dir):
    z, q = _shapes(spark, sf_dir, "zone_points", "zone_id"), _shapes(spark, sf_dir, "quarry_points", "quarry_id")
    other = pg.sides(q.points, "quarry_id").select("quarry_id", F.col("xa").alias("pa"), F.col("ya").alias("qa"), F.col("xb").alias("pb"), F.col("yb").alias("qb"))
    d = pg.nearest_side(pg.sides(z.points, "zone_id"), other, "zone_id", ["quarry_id"])
    o = pg.overlaid(z, q).groupBy("zone_id").agg(F.sum("area").alias("area"), F.sum("both").alias("both")).join(d, "zone_id")
    o = o.withColumn("distance", _r(F.when(F.col("both") > pg.LEAST, 0.0).otherwise(F.col("distance")), 6))
    return o.select("zone_id", "distance", _r("both", 4).alias("overlap_m2"), _r(F.col("both") / F.col("area"), 6).alias("overlap_ratio"), (F.col("distance") <= 30).alias("adjacent"), _r(F.col("area") - F.col("both"), 4).alias("outside_m2"))


_FOOT = f"{ctes('footprint_points')}, {_edges('footprint_points', 'bld_id')}"


@query("J23_context_share", f"WITH {_ZONES}, {_FOOT}, {_over('zone', 'footprint')} SELECT g AS zone_id, round(ab + 1e-9, 4) AS covered_m2, round(ab / a + 1e-9, 6) AS share FROM o")
def context_share(spark, sf_dir):
    o = pg.overlaid(_shapes(spark, sf_dir, "zone_points", "zone_id"), _shapes(spark, sf_dir, "footprint_points", "bld_id")).groupBy("zone_id").agg(F.sum("area").alias("area"), F.sum("both").alias("both"))
    return o.select("zone_id", _r("both", 4).alias("covered_m2"), _r(F.col("both") / F.col("area"), 6).alias("share"))


@query("J34_uncovered", f"WITH {_ZONES}, {_FOOT}, {_over('footprint', 'zone')} SELECT g AS bld_id, round(a + 1e-9, 5) AS area_m2, round(a - ab + 1e-9, 5) AS uncovered_m2, round((a - ab) / a + 1e-9, 6) AS fraction FROM o")
def uncovered(spark, sf_dir):
    o = pg.overlaid(_shapes(spark, sf_dir, "footprint_points", "bld_id"), _shapes(spark, sf_dir, "zone_points", "zone_id")).groupBy("bld_id").agg(F.sum("area").alias("area"), F.sum("both").alias("both"))
    return o.select("bld_id", _r("area", 5).alias("area_m2"), _r(F.col("area") - F.col("both"), 5).alias("uncovered_m2"), _r((F.col("area") - F.col("both")) / F.col("area"), 6).alias("fraction"))


@query("J12_shape_overlay", f"""WITH {_ZONES}, {_FOOT}, n AS ({_near('footprint', 'zone', 3)}), p AS (SELECT (ka, kb) AS g, 0 AS layer, s, xa, ya, xb, yb FROM n JOIN footprint_e ON k = ka UNION ALL SELECT (ka, kb), 1, s, xa, ya, xb, yb FROM n JOIN zone_e ON k = kb), {_sweep('p', 'o')},
    d AS (SELECT n.ka, n.kb, min({_SIDES}) AS d FROM n JOIN footprint_s p ON p.k = n.ka JOIN zone_s q ON q.k = n.kb GROUP BY 1, 2), t AS (SELECT n.ka, n.kb, CASE WHEN ab > 1e-6 THEN round(ab + 1e-9, 4) ELSE 0e0 END AS ab, d FROM n JOIN o ON o.g = (n.ka, n.kb) JOIN d ON d.ka = n.ka AND d.kb = n.kb),
    f AS (SELECT k, sum(s * (xb - xa) * (ya + yb) / 2) AS area FROM footprint_e GROUP BY k), h AS (SELECT ka, sum(ab) AS ab, arg_max(kb, (ab, -kb)) AS site, max(ab) AS most, max((kb * 31 % 100) / 100e0) FILTER (ab > 0) AS score, bool_or(ab > 0 OR round(d + 1e-9, 6) <= 3) AS near FROM t GROUP BY ka)
    SELECT k AS bld_id, round(coalesce(ab, 0e0) + 1e-9, 4) AS overlap_m2, round(coalesce(ab, 0e0) / area + 1e-9, 6) AS change_ratio, score AS max_score, CASE WHEN most > 0 THEN site END AS site_id, coalesce(near, FALSE) AS near_change FROM f LEFT JOIN h ON ka = k""")
def shape_overlay(spark, sf_dir):
    f, z = _shapes(spark, sf_dir, "footprint_points", "bld_id"), _shapes(spark, sf_dir, "zone_points", "zone_id")
    o = pg.overlaps(f, z).select("bld_id", "zone_id", _r("overlap", 4).alias("both")).where("both > 0")  # what rounds to nothing is none
    score = (F.col("zone_id") * 31 % 100) / F.lit(100.0)
    o = o.groupBy("bld_id").agg(F.sum("both").alias("both"), F.max_by("zone_id", F.struct("both", -F.col("zone_id"))).alias("site_id"), F.max(score).alias("max_score"))
    near = pg.touching(f, z, 3.0).select("bld_id").distinct().withColumn("near", F.lit(True))
    out = f.cover.groupBy("bld_id").agg(F.sum("area").alias("area")).join(o, "bld_id", "left").join(near, "bld_id", "left")
    both = F.coalesce("both", F.lit(0.0))
    return out.select("bld_id", _r(both, 4).alias("overlap_m2"), _r(both / F.col("area"), 6).alias("change_ratio"), "max_score", "site_id", F.coalesce("near", F.lit(False)).alias("near_change"))


@query("J20_J21_shape_rail", f"""WITH {_ZONES}, {ctes('rail')}, d AS (SELECT p.k, q.seg_id, min({_SIDES}) AS d FROM zone_s p CROSS JOIN rail q GROUP BY 1, 2), m AS (SELECT k, min(d) AS d, arg_min(seg_id, (round(d + 1e-9, 9), seg_id)) AS seg, min(d) FILTER (seg_id % 4 <> 0) AS surface FROM d GROUP BY k)
    SELECT k AS zone_id, round(d + 1e-9, 6) AS distance, round(surface + 1e-9, 6) AS surface_distance, seg % 4 = 0 AS nearest_is_tunnel, CASE WHEN round(d + 1e-9, 6) <= 50 THEN 50 WHEN round(d + 1e-9, 6) <= 100 THEN 100 WHEN round(d + 1e-9, 6) <= 500 THEN 500 END AS band FROM m""")
def shape_rail(spark, sf_dir):
    own = pg.sides(table(spark, sf_dir, "zone_points"), "zone_id").select("zone_id", "xa", "ya", "xb", "yb")
    rail = table(spark, sf_dir, "rail").select("seg_id", F.col("xa").cast("double").alias("pa"), F.col("ya").cast("double").alias("qa"), F.col("xb").cast("double").alias("pb"), F.col("yb").cast("double").alias("qb"))
    d = pg.nearest_side(own, rail, "zone_id", ["seg_id"])
    s = pg.nearest_side(own, rail.where("seg_id % 4 <> 0"), "zone_id", ["seg_id"]).select("zone_id", _r("distance", 6).alias("surface_distance"))
    near = _r("distance", 6)
    return d.join(s, "zone_id").select("zone_id", near.alias("distance"), "surface_distance", (F.col("seg_id") % 4 == 0).alias("nearest_is_tunnel"), F.when(near <= 50, 50).when(near <= 100, 100).when(near <= 500, 500).alias("band"))


@query("J24_A31_shape_hotspots", f"""WITH RECURSIVE {_FOOT}, n AS (SELECT ka, kb FROM ({_near('footprint', 'footprint', 2)}) WHERE ka <> kb), l AS (SELECT n.ka, n.kb FROM n JOIN footprint_s p ON p.k = n.ka JOIN footprint_s q ON q.k = n.kb GROUP BY 1, 2 HAVING min({_SIDES}) <= 2),
    hr AS (SELECT k AS node, k AS q FROM footprint_b UNION SELECT l.kb, hr.q FROM hr JOIN l ON l.ka = hr.node), lab AS (SELECT node, min(q) AS g FROM hr GROUP BY node),
    p AS (SELECT g, 0 AS layer, s, xa, ya, xb, yb FROM lab JOIN footprint_e ON k = node), {_sweep('p', 'o')}, m AS (SELECT k, sum(xa * yb - xb * ya) / 2 AS a, sum((xa + xb) * (xa * yb - xb * ya)) / 6 AS mx, sum((ya + yb) * (xa * yb - xb * ya)) / 6 AS my FROM footprint_s GROUP BY k),
    t AS (SELECT g, count(*) AS n, sum(abs(a)) AS total, sum(mx * sign(a)) / sum(abs(a)) AS x, sum(my * sign(a)) / sum(abs(a)) AS y, sum(abs(a) * (k * 31 % 100) / 100e0) / sum(abs(a)) AS score FROM lab JOIN m ON k = node GROUP BY g)
    SELECT g AS label, n, round(o.a + 1e-9, 4) AS area_m2, round(total + 1e-9, 4) AS area_sum, round(x + 1e-9, 4) AS x, round(y + 1e-9, 4) AS y, round(score + 1e-9, 6) AS score FROM t JOIN o USING (g) WHERE o.a >= 100""")
def shape_hotspots(spark, sf_dir):
    f = _shapes(spark, sf_dir, "footprint_points", "bld_id")
    pairs = pg.touching(f, f.renamed("other"), 2.0).where("bld_id < other").select(F.col("bld_id").alias("a"), F.col("other").alias("b"))
    label = components(f.points.select(F.col("bld_id").alias("node")).distinct(), pairs).select(F.col("node").alias("bld_id"), "label")
    u = pg.union_area(f, label, "label")
    m = pg.measures(f.points, "bld_id").join(label, "bld_id")
    mean = lambda v: F.sum(F.col("area") * v) / F.sum("area")
    t = m.groupBy("label").agg(F.count(F.lit(1)).alias("n"), mean(F.col("x")).alias("x"), mean(F.col("y")).alias("y"), mean((F.col("bld_id") * 31 % 100) / F.lit(100.0)).alias("score"))
    out = t.join(u, "label").where("area_union >= 100")
    return out.select("label", "n", _r("area_union", 4).alias("area_m2"), _r("area_sum", 4).alias("area_sum"), _r("x", 4).alias("x"), _r("y", 4).alias("y"), _r("score", 6).alias("score"))


@query("F18_monitoring_cells", f"""WITH {ctes('aoi_points')}, {_edges('aoi_points', 'aoi_id')}, cell AS (SELECT r, unnest(range(CAST(floor(x0 / 25) AS INT), CAST(ceil(x1 / 25) AS INT))) AS c FROM (SELECT *, unnest(range(CAST(floor(y0 / 25) AS INT), CAST(ceil(y1 / 25) AS INT))) AS r FROM aoi_b)),
    p AS (SELECT (r, c) AS g, 0 AS layer, s, xa, ya, xb, yb FROM cell, aoi_e UNION ALL SELECT (r, c), 1, s, c * 25e0, (r + h) * 25e0, c * 25e0 + 25, (r + h) * 25e0 FROM cell, (VALUES (1, 1), (0, -1)) v(h, s)), {_sweep('p', 'o')}
    SELECT concat('R', lpad(CAST(r AS VARCHAR), 4, '0'), 'C', lpad(CAST(c AS VARCHAR), 4, '0')) AS cell_id, round(ab + 1e-9, 4) AS area_m2, round(ab / 625 + 1e-9, 6) AS share FROM cell JOIN o ON o.g = (r, c) WHERE ab > 1e-6""")
def monitoring_cells(spark, sf_dir):
    a = _shapes(spark, sf_dir, "aoi_points", "aoi_id", 25.0)
    return a.cover.select(F.format_string("R%04dC%04d", "r", "c").alias("cell_id"), _r("area", 4).alias("area_m2"), _r(F.col("area") / 625.0, 6).alias("share"))
