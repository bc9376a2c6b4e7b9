"""Queries of sites to visit: roll-up with worst labels, zones for close review, work orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from groundshift.operators import evidence as ev
from groundshift.operators import fieldwork as fw
from groundshift.operators import polygons as pg
from groundshift.operators import reporting as rp
from groundshift.operators.components import written
from groundshift.operators.indices import tier
from groundshift.plans.evidence import _COMP, _GRADE, _SCORED, _TYPED, BASE, T1, T2, _scored
from groundshift.plans.registry import query
from groundshift.plans.shapes import _SIDES, _edges, _near, _r
from groundshift.plans.summary import building_parcel
from groundshift.sources.tables import ctes, table

_ALL = f"""{_SCORED}, {_GRADE}{_COMP[len(_TYPED):]}, gr AS (SELECT cand_id, CASE WHEN explained THEN 'NONE' WHEN strong AND over THEN 'A_STRONG' WHEN strong OR over THEN 'B_MODERATE' WHEN score > 0 THEN 'C_WEAK' ELSE 'NONE' END AS grade FROM i),
    full_ AS (SELECT s.*, k.status, gr.grade, CASE WHEN s.priority_score >= 0.7e0 THEN 'HIGH' WHEN s.priority_score >= 0.4e0 THEN 'MEDIUM' ELSE 'LOW' END AS inspection_priority FROM s JOIN k USING (cand_id) JOIN gr USING (cand_id))"""


def _labelled(spark, sf_dir):
    """Candidates with every label: change type, direction, priority, status at the baseline date, grade."""
    s = _scored(spark, sf_dir)
    status = ev.compensation_status(F.col("matched"), F.col("approved"), F.lit(None).cast("date"), F.col("permitted"), F.col("change_type"), BASE, T1, T2)
    grade = ev.illegal_grade(F.col("matched"), F.col("change_type"), F.col("change_ratio"), F.col("max_change_score"), F.col("building_area"), F.col("arch_area"), F.col("consistent"), F.col("approved"))["illegal_grade"]
    return s.withColumns({"status": status, "grade": grade, "inspection_priority": tier(F.col("priority_score"), 0.7, 0.4)})


_REVIEWED = "full_ WHERE (NOT matched AND inspection_priority = 'HIGH') OR NOT consistent OR status = 'POST_BASELINE_UNVERIFIED'"


@query("P44_review_selection", f"WITH {_ALL} SELECT cand_id, change_type, inspection_priority, status FROM {_REVIEWED}")
def review_selection(spark, sf_dir):
    return fw.for_review(_labelled(spark, sf_dir)).select("cand_id", "change_type", "inspection_priority", "status")


_BUFFER = 3.0
_CUT = f"CAST(floor(({{}} - {_BUFFER}) / 2) AS INT), CAST(floor(({{}} + {_BUFFER}) / 2) AS INT) + 1"


@query("J31_review_zones", f"""WITH RECURSIVE {_ALL}, picked AS (SELECT cand_id FROM {_REVIEWED}), {ctes('footprint_points')}, chosen_points AS (SELECT f.* FROM footprint_points f JOIN picked ON cand_id = bld_id), {_edges('chosen_points', 'bld_id')},
    nn AS (SELECT ka, kb FROM ({_near('chosen', 'chosen', 2 * _BUFFER)}) WHERE ka <> kb), ll AS (SELECT nn.ka, nn.kb FROM nn JOIN chosen_s p ON p.k = nn.ka JOIN chosen_s q ON q.k = nn.kb GROUP BY 1, 2 HAVING min({_SIDES}) <= {2 * _BUFFER}),
    zr AS (SELECT k AS node, k AS q FROM chosen_b UNION SELECT ll.kb, zr.q FROM zr JOIN ll ON ll.ka = zr.node), zn AS (SELECT node, min(q) AS zone FROM zr GROUP BY node),
    pc AS (SELECT k, r, c, (c + 0.5e0) * 2 AS x, (r + 0.5e0) * 2 AS y FROM (SELECT k, r, unnest(range({_CUT.format('x0', 'x1')})) AS c FROM (SELECT *, unnest(range({_CUT.format('y0', 'y1')})) AS r FROM chosen_b))),
    pd AS (SELECT k, r, c, min(sqrt(pow(x - xa - t * (xb - xa), 2) + pow(y - ya - t * (yb - ya), 2))) AS d FROM (SELECT pc.*, xa, ya, xb, yb, greatest(0e0, least(1e0, ((x - xa) * (xb - xa) + (y - ya) * (yb - ya)) / ((xb - xa) * (xb - xa) + (yb - ya) * (yb - ya)))) AS t FROM pc JOIN chosen_s USING (k)) GROUP BY k, r, c),
    pi AS (SELECT pc.k, r, c FROM pc JOIN chosen_e e ON e.k = pc.k AND xa <= x AND x < xb AND ya + (yb - ya) / (xb - xa) * (x - xa) > y GROUP BY 1, 2, 3 HAVING sum(s) > 0),
    pa AS (SELECT zone, count(DISTINCT (r, c)) * 4e0 AS area_m2 FROM (SELECT k, r, c FROM pd WHERE round(d, 9) <= {_BUFFER} UNION SELECT k, r, c FROM pi) JOIN zn ON node = k GROUP BY zone)
    SELECT zone, count(*) AS members, any_value(area_m2) AS area_m2 FROM zn JOIN pa USING (zone) GROUP BY zone""")
def review_zones(spark, sf_dir):
    picked = written(review_selection(spark, sf_dir).select(F.col("cand_id").alias("bld_id")))
    points = written(table(spark, sf_dir, "footprint_points").join(picked, "bld_id"))
    return fw.review_zones(pg.Shapes(points, "bld_id"), _BUFFER)


# a site is a square of 100 m, so that a site and a team's strip of 1,000 m hold what the ground holds
_SITE = f"""{_ALL}, {ctes('points', 'parcels', 'buildings')}, bo AS (SELECT bld_id, pnu, (least(b.x1, p.x1) - greatest(b.x0, p.x0)) * (least(b.y1, p.y1) - greatest(b.y0, p.y0)) AS area, (b.x1 - b.x0) * (b.y1 - b.y0) AS whole FROM buildings b JOIN parcels p ON b.x0 < p.x1 AND p.x0 < b.x1 AND b.y0 < p.y1 AND p.y0 < b.y1),
    bk AS (SELECT bld_id, pnu FROM (SELECT *, row_number() OVER (PARTITION BY bld_id ORDER BY area DESC, pnu) AS rn FROM bo) WHERE rn = 1 AND area / whole >= 0.5e0),
    cs AS (SELECT f.*, p.x, p.y, CAST(floor(p.y / 100) * 1000 + floor(p.x / 100) AS BIGINT) AS sid, CAST(floor(p.y / 1000) AS BIGINT) AS project, bk.pnu, {"CASE status " + " ".join(f"WHEN '{k}' THEN {v}e0" for k, v in ev.RISK.items()) + " END"} AS risk FROM full_ f JOIN points p ON p.id = cand_id LEFT JOIN bk ON bk.bld_id = cand_id),
    dom AS (SELECT sid, change_type AS dominant_type FROM (SELECT sid, change_type, row_number() OVER (PARTITION BY sid ORDER BY count(*) DESC, change_type) AS rn FROM cs WHERE change_type IS NOT NULL GROUP BY sid, change_type) WHERE rn = 1),
    sg AS (SELECT sid AS site_id, project, count(*) AS candidates, count(*) FILTER (change_type IN ('NEW_BUILDING', 'EXPANSION_OR_RECONSTRUCTION')) AS buildings, round(sum(change_area), 4) AS area, round(sum(greatest(change_area, 1e0) * x) / sum(greatest(change_area, 1e0)) + 1e-9, 4) AS x, round(sum(greatest(change_area, 1e0) * y) / sum(greatest(change_area, 1e0)) + 1e-9, 4) AS y,
        count(*) FILTER (matched) AS matched, count(*) FILTER (NOT consistent) AS flagged, arg_max(status, (risk, status)) AS status, min(grade) AS grade, max(priority_score) AS score, coalesce(array_to_string(list_sort(list(DISTINCT pnu) FILTER (pnu IS NOT NULL)), ';'), '') AS pnu_list FROM cs GROUP BY sid, project),
    st AS (SELECT sg.*, dominant_type, CASE WHEN score >= 0.7e0 THEN 'HIGH' WHEN score >= 0.4e0 THEN 'MEDIUM' ELSE 'LOW' END AS site_priority FROM sg LEFT JOIN dom ON dom.sid = site_id)"""
_FOCUS = "concat_ws(' / ', CASE dominant_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fw.FOCUS.items()) + f""" END, CASE WHEN matched = 0 AND candidates > 0 THEN '{fw.UNMATCHED}' END, CASE WHEN flagged > 0 THEN concat('{fw.DIRECTION[0]}', CAST(flagged AS VARCHAR), '{fw.DIRECTION[1]}') END, CASE WHEN status = 'POST_BASELINE_UNVERIFIED' THEN '{fw.BASELINE}' END,
    CASE WHEN grade = 'A_STRONG' THEN '{fw.STRONG}' END, CASE WHEN candidates >= 5 THEN concat('{fw.MANY[0]}', CAST(candidates AS VARCHAR), '{fw.MANY[1]}') END)"""


def _sites(spark, sf_dir):
    p = table(spark, sf_dir, "points").select(F.col("id").alias("cand_id"), "x", "y")
    parcel = building_parcel(spark, sf_dir).select(F.col("bld_id").alias("cand_id"), "pnu")
    cell = (F.floor(F.col("y") / 100) * 1000 + F.floor(F.col("x") / 100)).cast("bigint")
    c = written(_labelled(spark, sf_dir).join(p, "cand_id").join(parcel, "cand_id", "left").withColumns({"site_id": cell, "project": F.floor(F.col("y") / 1000).cast("bigint")}))
    w = F.greatest("change_area", F.lit(1.0))
    mean = lambda v: _r(F.sum(w * F.col(v)) / F.sum(w), 4)
    g = c.groupBy("site_id", "project").agg(
        F.count(F.lit(1)).alias("candidates"), F.count_if(F.col("change_type").isin(ev.NEW, ev.EXPANSION)).alias("buildings"), F.round(F.sum("change_area"), 4).alias("area"), mean("x").alias("x"), mean("y").alias("y"),
        F.count_if("matched").alias("matched"), F.count_if(~F.col("consistent")).alias("flagged"), F.max_by("status", F.struct(ev.risk(F.col("status")), "status")).alias("status"), F.min("grade").alias("grade"),
        F.max("priority_score").alias("score"), F.array_join(F.array_sort(F.collect_set("pnu")), ";").alias("pnu_list"),
    )
    kinds = c.where("change_type is not null").groupBy("site_id", "change_type").agg(F.count(F.lit(1)).alias("n"))
    kinds = kinds.groupBy("site_id").agg(F.min_by("change_type", F.struct(-F.col("n"), "change_type")).alias("dominant_type"))
    return g.join(kinds, "site_id", "left").withColumn("site_priority", tier(F.col("score"), 0.7, 0.4))


@query("A29_site_sheet", f"WITH {_SITE} SELECT * FROM st")
def site_sheet(spark, sf_dir):
    return _sites(spark, sf_dir)


@query("P46_survey_focus", f"WITH {_SITE} SELECT site_id, CASE WHEN {_FOCUS} = '' THEN '{fw.PLAIN}' ELSE substr({_FOCUS}, 1, 400) END AS focus FROM st")
def survey_focus(spark, sf_dir):
    return _sites(spark, sf_dir).select("site_id", fw.survey_focus(*(F.col(x) for x in ("dominant_type", "candidates", "matched", "flagged", "status", "grade"))).alias("focus"))


_WALK = f"""{_SITE}, vt AS (SELECT *, CASE site_priority WHEN 'HIGH' THEN 0 WHEN 'MEDIUM' THEN 1 ELSE 2 END AS tr, CASE WHEN {_FOCUS} = '' THEN '{fw.PLAIN}' ELSE substr({_FOCUS}, 1, 400) END AS focus FROM st),
    walk AS (SELECT project, CAST(1 AS BIGINT) AS step, site_id, x, y, [site_id] AS seen FROM (SELECT *, row_number() OVER (PARTITION BY project ORDER BY tr, score DESC, site_id) AS rn FROM vt) WHERE rn = 1
        UNION ALL SELECT project, step, site_id, x, y, list_append(seen, site_id) FROM (SELECT v.project, w.step + 1 AS step, v.site_id, v.x, v.y, w.seen, row_number() OVER (PARTITION BY v.project ORDER BY v.tr, (v.x - w.x) * (v.x - w.x) + (v.y - w.y) * (v.y - w.y), v.site_id) AS rn FROM walk w JOIN vt v ON v.project = w.project AND NOT list_contains(w.seen, v.site_id)) WHERE rn = 1)"""
_SOURCES = {"route_order": "step", "x": "round(vt.x, 2)", "y": "round(vt.y, 2)", "site_id": "vt.site_id"}


@query("S28_work_order", f"WITH RECURSIVE {_WALK} SELECT " + ", ".join((f"coalesce({n}, '')" if n in ("site_priority", "dominant_type", "status", "grade", "focus", "pnu_list") else _SOURCES.get(n, n)) + f' AS "{label}"' for n, label in fw.SHEET.items()) + ", " + ", ".join(f"""'' AS "{label}" """ for label in fw.BY_HAND) + " FROM vt JOIN walk USING (site_id)")
def work_order(spark, sf_dir):
    """Sites of a strip in the order of its tour, with what to check and blanks to fill in."""
    s = written(_sites(spark, sf_dir))
    route = rp.routed(s.select("project", "site_id", F.col("site_priority").alias("tier"), "score", "x", "y"), "project").select("site_id", "route_order")
    s = s.join(route, "site_id", "left").withColumn("focus", fw.survey_focus(*(F.col(x) for x in ("dominant_type", "candidates", "matched", "flagged", "status", "grade"))))
    return fw.work_order(s.withColumns({"x": F.round("x", 2), "y": F.round("y", 2)}))
