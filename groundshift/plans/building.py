"""Building change from pixels to priority, for every pair of consecutive years, as one chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from groundshift.functions import keys
from groundshift.operators import components as cc
from groundshift.operators import evidence as ev
from groundshift.operators import focal, parcels, series
from groundshift.operators.indices import tier
from groundshift.plans.focal import _EDGES, _MIRROR, WIDTH, _dates
from groundshift.plans.land import _ROBUST, _robust
from groundshift.plans.registry import query
from groundshift.plans.shapes import _edges, _shapes, _sweep
from groundshift.sources.tables import ctes, epochs, table

#: Least probability of change, cells of a change, metres around a building in which a change is near.
_LEAST, _CELLS, _NEAR = 0.45, 2, 3.0
_SCORES = f"""{_EDGES}{_ROBUST[len(ctes('pixels')):]},
    sp AS (SELECT a.k, a.r, a.c, a.h, b.v AS g1, a.v AS g2 FROM dg a JOIN dg b ON b.k = a.k - 1 AND b.r = a.r AND b.c = a.c), sr AS (SELECT k, CASE WHEN greatest(max(g1), max(g2)) > least(min(g1), min(g2)) THEN greatest(max(g1), max(g2)) - least(min(g1), min(g2)) ELSE 1e0 END AS l FROM sp GROUP BY k),
    s7 AS (SELECT * FROM (SELECT unnest(range(-3, 4)) AS dr), (SELECT unnest(range(-3, 4)) AS dc)),
    sw AS (SELECT a.k, a.r, a.c, sum(n.g1) / 49 AS ua, sum(n.g2) / 49 AS ub, sum(n.g1 * n.g1) / 49 AS aa, sum(n.g2 * n.g2) / 49 AS bb, sum(n.g1 * n.g2) / 49 AS ab FROM sp a, s7 JOIN sp n ON n.k = a.k AND n.r = {_MIRROR('a.r + dr', 'a.h')} AND n.c = {_MIRROR('a.c + dc', WIDTH)} GROUP BY 1, 2, 3),
    ss AS (SELECT k, r, c, greatest(0e0, least(1e0, 1 - ((2 * ua * ub + pow(0.01e0 * l, 2)) * (2 * 49e0 / 48 * (ab - ua * ub) + pow(0.03e0 * l, 2))) / ((ua * ua + ub * ub + pow(0.01e0 * l, 2)) * (49e0 / 48 * (aa - ua * ua) + 49e0 / 48 * (bb - ub * ub) + pow(0.03e0 * l, 2))))) AS score FROM sw JOIN sr USING (k)),
    ok AS (SELECT b.epoch, b.r, b.c FROM pixels a JOIN pixels b ON b.epoch = a.epoch + 1 AND b.r = a.r AND b.c = a.c AND a.n >= 2 AND b.n >= 2),
    prob AS (SELECT ss.k, ss.r, ss.c, round((coalesce(robust.score, 0e0) + ss.score + ec.score) / 3, 6) AS prob, ok.r IS NOT NULL AS valid FROM ss JOIN dim ON TRUE JOIN ec ON ec.k = ss.k AND ec.r = ss.r AND ec.c = ss.c LEFT JOIN robust ON robust.k = first + ss.k AND robust.r = ss.r AND robust.c = ss.c LEFT JOIN ok ON ok.epoch = first + ss.k AND ok.r = ss.r AND ok.c = ss.c)"""
_CHANGES = f"""{_SCORES}, hit AS (SELECT k, r, c, prob FROM prob WHERE valid AND prob >= {_LEAST}), cr AS (SELECT k, r, c, CAST(r AS BIGINT) * 1048576 + c AS q FROM hit UNION SELECT n.k, n.r, n.c, cr.q FROM cr JOIN hit n ON n.k = cr.k AND abs(n.r - cr.r) + abs(n.c - cr.c) = 1),
    cp AS (SELECT k, r, c, min(q) AS comp FROM cr GROUP BY 1, 2, 3), ft AS (SELECT cp.k, comp, count(*) * 100e0 AS area, round(max(prob), 4) AS top, round(round(avg(d.v), 2) - round(avg(e.v), 2), 2) AS brighter FROM cp JOIN hit USING (k, r, c) JOIN dg d ON d.k = cp.k AND d.r = cp.r AND d.c = cp.c JOIN dg e ON e.k = cp.k - 1 AND e.r = cp.r AND e.c = cp.c GROUP BY 1, 2 HAVING count(*) >= {_CELLS}),
    cf AS (SELECT k, r, c, comp FROM cp JOIN ft USING (k, comp))"""
_BUILDINGS = f"""{_CHANGES}, {ctes('footprint_points', 'register')}, {_edges('footprint_points', 'bld_id')},
    fc AS (SELECT k || '_' || r || '_' || c AS g, k, r, c FROM (SELECT k, r, unnest(range(CAST(floor(x0 / 10) AS INT), CAST(ceil(x1 / 10) AS INT))) AS c FROM (SELECT *, unnest(range(CAST(floor(y0 / 10) AS INT), CAST(ceil(y1 / 10) AS INT))) AS r FROM footprint_b))),
    fp AS (SELECT g, 0 AS layer, s, xa, ya, xb, yb FROM fc JOIN footprint_e USING (k) UNION ALL SELECT g, 1, s, c * 10e0, (r + h) * 10e0, c * 10e0 + 10, (r + h) * 10e0 FROM fc, (VALUES (1, 1), (0, -1)) v(h, s)), {_sweep('fp', 'fo')},
    fv AS (SELECT k AS bld_id, r, c, ab AS area FROM fc JOIN fo USING (g) WHERE ab > 1e-6), fa AS (SELECT bld_id, sum(area) AS whole FROM fv GROUP BY 1),
    ov AS (SELECT bld_id, cf.k, comp, round(sum(area), 6) AS area FROM fv JOIN cf USING (r, c) GROUP BY 1, 2, 3),
    nr AS (SELECT DISTINCT b.k AS bld_id, cf.k FROM footprint_b b JOIN cf ON cf.c * 10 < b.x1 + {_NEAR} AND cf.c * 10 + 10 > b.x0 - {_NEAR} AND cf.r * 10 < b.y1 + {_NEAR} AND cf.r * 10 + 10 > b.y0 - {_NEAR}),
    oa AS (SELECT bld_id, ov.k, sum(ov.area) AS overlap, max(top) AS score, arg_max(comp, (ov.area, -comp)) AS site, arg_max(brighter, (ov.area, -comp)) AS brighter FROM ov JOIN ft USING (k, comp) GROUP BY 1, 2),
    lr AS (SELECT bld_id, arg_max(use_apr_day, (use_apr_day IS NOT NULL, coalesce(use_apr_day, ''), -rec_id)) AS day FROM register GROUP BY 1),
    bj AS (SELECT nr.bld_id, nr.k, round(coalesce(overlap, 0e0) / whole, 6) AS ratio, score, site, brighter, lr.bld_id IS NOT NULL AS matched, CASE WHEN length(day) = 8 THEN strptime(day, '%Y%m%d')::DATE END AS approved, make_date(CAST(first + nr.k - 1 AS INT), 7, 1) AS t1, make_date(CAST(first + nr.k AS INT), 7, 1) AS t2
        FROM nr JOIN fa USING (bld_id) JOIN dim ON TRUE LEFT JOIN oa ON oa.bld_id = nr.bld_id AND oa.k = nr.k LEFT JOIN lr ON lr.bld_id = nr.bld_id),
    bt AS (SELECT *, CASE WHEN ratio = 0 THEN 'OTHER_CHANGE' WHEN matched AND approved BETWEEN t1 AND t2 THEN 'NEW_BUILDING' WHEN matched AND approved IS NOT NULL THEN 'EXPANSION_OR_RECONSTRUCTION' WHEN ratio >= 0.5e0 THEN 'NEW_BUILDING' ELSE 'EXPANSION_OR_RECONSTRUCTION' END AS change_type,
        CASE WHEN ratio > 0 AND NOT (matched AND approved IS NOT NULL) THEN brighter IS NULL OR brighter >= 0 END AS consistent, CASE WHEN NOT matched THEN 1e0 WHEN approved BETWEEN t1 AND t2 THEN 0.1e0 ELSE 0.6e0 END AS uncertainty FROM bj),
    bp AS (SELECT *, round(0.4e0 * greatest(0e0, least(1e0, coalesce(score, 0e0))) + 0.3e0 * greatest(0e0, least(1e0, ratio)) + 0.2e0 * uncertainty + 0.1e0 * CASE WHEN change_type IN ('NEW_BUILDING', 'EXPANSION_OR_RECONSTRUCTION', 'DEMOLITION') THEN 1e0 ELSE 0.3e0 END, 4) AS priority FROM bt)"""


def _change_cells(spark, sf_dir):
    """(k, r, c, prob): cells whose mean of robust spectral distance, structural change and edge change is large enough, k numbering the pairs from 1."""
    first = epochs(spark, sf_dir)[0]
    g, height = _dates(spark, sf_dir)
    g = cc.written(g)
    pairs = cc.written(g.withColumn("g1", F.lag("v").over(series.cell().orderBy("k"))).where("k > 0").select("k", "r", "c", "g1", F.col("v").alias("g2")))
    structure = focal.ssim_change(pairs, height, WIDTH, by=("k",)).withColumnRenamed("score", "structure")
    edge = focal.edge_change(g, height, WIDTH).withColumnRenamed("score", "edge")
    spectral = _robust(spark, sf_dir).select((F.col("k") - first).alias("k"), "r", "c", F.col("score").alias("spectral"))
    order = series.cell().orderBy("epoch")
    p = table(spark, sf_dir, "pixels")
    valid = p.withColumns({"n1": F.lag("n").over(order), "before": F.lag("epoch").over(order)}).where("before = epoch - 1 and n >= 2 and n1 >= 2").select((F.col("epoch") - first).alias("k"), "r", "c")
    j = structure.join(edge, ["k", "r", "c"]).join(valid, ["k", "r", "c"]).join(spectral, ["k", "r", "c"], "left")
    prob = F.round((F.coalesce("spectral", F.lit(0.0)) + F.col("structure") + F.col("edge")) / 3, 6)
    return cc.written(j.select("k", "r", "c", prob.alias("prob")).where(F.col("prob") >= _LEAST)), pairs


def _changes(spark, sf_dir):
    """Cells of changes with comp, and a row for each change: area, largest probability, how much brighter it became."""
    cells, pairs = _change_cells(spark, sf_dir)
    labelled = cc.written(cells.join(cc.cell_components(cells, ["k"]), ["k", "r", "c"]))
    f = labelled.join(pairs, ["k", "r", "c"]).groupBy("k", "comp").agg((F.count(F.lit(1)) * 100.0).alias("area"), F.round(F.max("prob"), 4).alias("top"), F.round(F.round(F.avg("g2"), 2) - F.round(F.avg("g1"), 2), 2).alias("brighter"))
    f = cc.written(f.where(F.col("area") >= _CELLS * 100.0))
    return labelled.join(f.select("k", "comp"), ["k", "comp"], "left_semi"), f


@query("E01_building_change", f"""WITH RECURSIVE {_BUILDINGS} SELECT k, 'building' AS kind, CAST(bld_id AS BIGINT) AS id, ratio AS change_ratio, score AS max_score, site AS site_id, change_type, consistent, priority AS priority_score, CASE WHEN priority >= 0.7e0 THEN 'HIGH' WHEN priority >= 0.4e0 THEN 'MEDIUM' ELSE 'LOW' END AS inspection_priority FROM bp
    UNION ALL SELECT k, 'change', comp, NULL, top, comp, CASE WHEN top >= 0.6e0 AND area >= 50 AND NOT coalesce(brighter > 0, FALSE) THEN 'DEMOLITION' ELSE 'OTHER_CHANGE' END, NULL, NULL, NULL FROM ft WHERE NOT EXISTS (SELECT 1 FROM ov WHERE ov.k = ft.k AND ov.comp = ft.comp)""")
def building_change(spark, sf_dir):
    """Scores of three kinds from pixels, their mean as a mask, connected changes, their overlay with footprints, the register, and a type and priority for each building and for each change without one."""
    cells, features = _changes(spark, sf_dir)
    cells = cc.written(cells)
    first = epochs(spark, sf_dir)[0]
    foot = _shapes(spark, sf_dir, "footprint_points", "bld_id")
    o = cc.written(foot.cover.join(cells.select("k", "r", "c", "comp"), ["r", "c"]).groupBy("bld_id", "k", "comp").agg(F.round(F.sum("area"), 6).alias("overlap")))
    main = F.struct("overlap", -F.col("comp"))
    of = o.join(features, ["k", "comp"]).groupBy("bld_id", "k").agg(F.sum("overlap").alias("overlap"), F.max("top").alias("max_score"), F.max_by("comp", main).alias("site_id"), F.max_by("brighter", main).alias("brighter"))
    box = foot.points.groupBy("bld_id").agg(*((f(x) + s * _NEAR).alias(n) for n, f, x, s in (("x0", F.min, "x", -1), ("y0", F.min, "y", -1), ("x1", F.max, "x", 1), ("y1", F.max, "y", 1))))
    near = parcels.coverage(box, "bld_id", least=0.0).join(cells.select("k", "r", "c"), ["r", "c"]).select("bld_id", "k").distinct()
    reg = ev.latest_by(table(spark, sf_dir, "register"), "bld_id", "use_apr_day", "rec_id").select("bld_id", keys.date8(F.col("use_apr_day")).alias("approved"), F.lit(True).alias("matched"))
    b = near.join(foot.cover.groupBy("bld_id").agg(F.sum("area").alias("whole")), "bld_id").join(of, ["bld_id", "k"], "left").join(reg, "bld_id", "left").na.fill(False, ["matched"])
    on = lambda year: F.make_date(F.col("k") + year, F.lit(7), F.lit(1))
    b = b.withColumns({"ratio": F.round(F.coalesce("overlap", F.lit(0.0)) / F.col("whole"), 6), "t1": on(first - 1), "t2": on(first)})
    ratio, matched, approved = F.col("ratio"), F.col("matched"), F.col("approved")
    b = b.withColumns({"change_type": ev.change_type(ratio, F.lit(True), matched, approved, F.col("t1"), F.col("t2")), "consistent": ev.direction_consistent(ratio, matched, approved, F.col("brighter")), "uncertainty": ev.administrative_uncertainty(matched, approved, F.col("t1"), F.col("t2"))})
    b = b.withColumn("priority_score", ev.priority_score(F.col("max_score"), ratio, F.col("uncertainty"), F.col("change_type")))
    rows = b.select("k", F.lit("building").alias("kind"), F.col("bld_id").cast("bigint").alias("id"), F.col("ratio").alias("change_ratio"), "max_score", "site_id", "change_type", "consistent", "priority_score", tier(F.col("priority_score"), 0.7, 0.4).alias("inspection_priority"))
    rest = features.join(o.select("k", "comp").distinct(), ["k", "comp"], "left_anti")
    kind = ev.unmatched_type(F.col("top"), F.col("area"), F.col("brighter"))
    none = {c: F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("change_ratio", "consistent", "priority_score", "inspection_priority")}
    return rows.unionByName(rest.select("k", F.lit("change").alias("kind"), F.col("comp").alias("id"), none["change_ratio"], F.col("top").alias("max_score"), F.col("comp").alias("site_id"), kind.alias("change_type"), none["consistent"], none["priority_score"], none["inspection_priority"]))
