"""Queries over registers, building candidates and sites."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from groundshift.functions import keys
from groundshift.operators import evidence as ev
from groundshift.operators.indices import tier
from groundshift.plans.registry import query
from groundshift.sources.tables import ctes, table

T1, T2, BASE = date(1994, 1, 1), date(1997, 1, 1), date(1995, 6, 1)
_D = "CASE WHEN length({0}) = 8 THEN TRY_CAST(TRY_STRPTIME({0}, '%Y%m%d') AS DATE) END"
_LATEST = """latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY bld_id ORDER BY use_apr_day DESC NULLS LAST, rec_id) AS rn FROM register) WHERE rn = 1)"""
_JOINED = f"""{ctes('register', 'candidates')}, {_LATEST}, j AS (SELECT c.*, use_apr_day, pms_day, arch_area, purpose, purpose IS NOT NULL AS matched, {_D.format('use_apr_day')} AS approved, {_D.format('pms_day')} AS permitted FROM candidates c LEFT JOIN latest l ON l.bld_id = c.cand_id)"""
_TYPED = f"""{_JOINED}, t AS (SELECT *, CASE WHEN change_ratio = 0 AND near_change THEN 'OTHER_CHANGE' WHEN change_ratio = 0 THEN NULL WHEN matched AND approved BETWEEN DATE '{T1}' AND DATE '{T2}' THEN 'NEW_BUILDING'
        WHEN matched AND approved IS NOT NULL THEN 'EXPANSION_OR_RECONSTRUCTION' WHEN change_ratio >= 0.5e0 THEN 'NEW_BUILDING' ELSE 'EXPANSION_OR_RECONSTRUCTION' END AS change_type,
        CASE WHEN change_ratio > 0 AND NOT (matched AND approved IS NOT NULL) THEN brightness_delta IS NULL OR brightness_delta >= 0 END AS consistent,
        CASE WHEN NOT matched THEN 1e0 WHEN coalesce(approved BETWEEN DATE '{T1}' AND DATE '{T2}', FALSE) THEN 0.1e0 ELSE 0.6e0 END AS uncertainty FROM j)"""
_SCORED = f"""{_TYPED}, s AS (SELECT *, round(0.40e0 * greatest(0e0, least(1e0, coalesce(max_change_score, 0e0))) + 0.30e0 * greatest(0e0, least(1e0, coalesce(change_ratio, 0e0))) + 0.20e0 * uncertainty
        + 0.10e0 * CASE WHEN change_type IN ('NEW_BUILDING', 'EXPANSION_OR_RECONSTRUCTION', 'DEMOLITION') THEN 1e0 ELSE 0.3e0 END, 4) AS priority_score FROM t)"""


def _joined(spark, sf_dir):
    latest = ev.latest_by(table(spark, sf_dir, "register"), "bld_id", "use_apr_day", "rec_id").withColumnRenamed("bld_id", "cand_id")
    j = table(spark, sf_dir, "candidates").join(latest, "cand_id", "left")
    return j.withColumns({"matched": F.col("purpose").isNotNull(), "approved": keys.date8(F.col("use_apr_day")), "permitted": keys.date8(F.col("pms_day"))})


def _typed(spark, sf_dir):
    m, a, r = F.col("matched"), F.col("approved"), F.col("change_ratio")
    return _joined(spark, sf_dir).withColumns({
        "change_type": ev.change_type(r, F.col("near_change"), m, a, T1, T2),
        "consistent": ev.direction_consistent(r, m, a, F.col("brightness_delta")),
        "uncertainty": ev.administrative_uncertainty(m, a, T1, T2),
    })


def _scored(spark, sf_dir):
    return _typed(spark, sf_dir).withColumn("priority_score", ev.priority_score(F.col("max_change_score"), F.col("change_ratio"), F.col("uncertainty"), F.col("change_type")))


@query("W09_latest_record", f"WITH {ctes('register')}, {_LATEST} SELECT bld_id, rec_id, use_apr_day, purpose FROM latest")
def latest_record(spark, sf_dir):
    return ev.latest_by(table(spark, sf_dir, "register"), "bld_id", "use_apr_day", "rec_id").select("bld_id", "rec_id", "use_apr_day", "purpose")



@query("F03_F04_parcel_keys", f"WITH {ctes('parcels')} SELECT pnu, concat(substr(pnu, 1, 10), substr(pnu, 12)) AS key18, length(pnu) = 19 AS length_ok, concat(CASE WHEN substr(pnu, 11, 1) = '2' THEN '산 ' ELSE '' END, CAST(CAST(substr(pnu, 12, 4) AS INT) AS VARCHAR), CASE WHEN CAST(substr(pnu, 16, 4) AS INT) > 0 THEN concat('-', CAST(CAST(substr(pnu, 16, 4) AS INT) AS VARCHAR)) ELSE '' END) AS lot FROM parcels")
def parcel_keys(spark, sf_dir):
    p = F.col("pnu")
    return table(spark, sf_dir, "parcels").select(p, keys.without_kind(p).alias("key18"), (F.length(keys.clean_pnu(p)) == 19).alias("length_ok"), keys.lot_of_pnu(p).alias("lot"))


@query("F05_F06_road_keys", "SELECT o_orderkey, concat(lpad(CAST(o_custkey % 10000000 AS VARCHAR), 7, '0'), '_', CASE WHEN o_orderkey % 7 = 0 THEN '0000' ELSE lpad(CAST(o_orderkey % 900 AS VARCHAR), 4, '0') END, '_', CASE WHEN o_orderkey % 2 = 0 THEN lpad(CAST(o_orderkey % 50 AS VARCHAR), 4, '0') ELSE '0000' END) AS road_key FROM orders")
def road_keys(spark, sf_dir):
    k = F.col("o_orderkey")
    text = F.concat(F.when(k % 7 == 0, F.lit(" ")).otherwise((k % 900).cast("string")), F.when(k % 2 == 0, F.concat(F.lit("-"), (k % 50).cast("string"))).otherwise(F.lit("")))
    main, sub = keys.building_number(text)
    road = F.concat(F.lit("41590"), F.lpad((F.col("o_custkey") % 10000000).cast("string"), 7, "0"))
    return table(spark, sf_dir, "orders").select("o_orderkey", keys.road_key(road, main, sub).alias("road_key"))


@query("J15_register_join", f"WITH {ctes('register', 'buildings')}, {_LATEST}, site AS (SELECT * FROM (SELECT *, bld_id % 100 AS site, row_number() OVER (PARTITION BY bld_id % 100 ORDER BY use_apr_day DESC NULLS LAST, rec_id) AS rs FROM register) WHERE rs = 1) SELECT b.bld_id, b.bld_id % 100 AS site, CASE WHEN l.purpose IS NOT NULL THEN l.purpose ELSE s.purpose END AS purpose, CASE WHEN l.purpose IS NOT NULL THEN l.rec_id ELSE s.rec_id END AS rec_id, CASE WHEN l.purpose IS NOT NULL THEN 'bld_id' WHEN s.purpose IS NOT NULL THEN 'site' END AS match_method FROM buildings b LEFT JOIN latest l ON l.bld_id = b.bld_id LEFT JOIN site s ON s.site = b.bld_id % 100")
def register_join(spark, sf_dir):
    reg = table(spark, sf_dir, "register").withColumn("site", F.col("bld_id") % 100)
    b = table(spark, sf_dir, "buildings").select("bld_id", (F.col("bld_id") % 100).alias("site"))
    return ev.join_register(b, ev.latest_by(reg, "bld_id", "use_apr_day", "rec_id"), ev.latest_by(reg, "site", "use_apr_day", "rec_id"), "bld_id", "site", ["purpose", "rec_id"], "purpose")


@query("P23_P24_change_type", f"WITH {_TYPED} SELECT cand_id, change_type, consistent, matched FROM t")
def change_type(spark, sf_dir):
    return _typed(spark, sf_dir).select("cand_id", "change_type", "consistent", "matched")


@query("P25_unmatched_type", f"WITH {ctes('candidates')} SELECT cand_id, CASE WHEN coalesce(max_change_score, 0e0) >= 0.6e0 AND change_area >= 50 AND NOT coalesce(brightness_delta > 0, FALSE) THEN 'DEMOLITION' ELSE 'OTHER_CHANGE' END AS change_type FROM candidates")
def unmatched_type(spark, sf_dir):
    return table(spark, sf_dir, "candidates").select("cand_id", ev.unmatched_type(F.col("max_change_score"), F.col("change_area"), F.col("brightness_delta")).alias("change_type"))


@query("P26_P27_building_priority", f"WITH {_SCORED} SELECT cand_id, uncertainty, priority_score, CASE WHEN priority_score >= 0.7e0 THEN 'HIGH' WHEN priority_score >= 0.4e0 THEN 'MEDIUM' ELSE 'LOW' END AS inspection_priority FROM s")
def building_priority(spark, sf_dir):
    return _scored(spark, sf_dir).select("cand_id", "uncertainty", "priority_score", tier(F.col("priority_score"), 0.7, 0.4).alias("inspection_priority"))


_COMP = f"""{_TYPED}, k AS (SELECT *, CASE WHEN matched AND approved IS NOT NULL AND change_type = 'NEW_BUILDING' THEN CASE WHEN approved < DATE '{BASE}' THEN 'PRE_BASELINE' WHEN permitted < DATE '{BASE}' THEN 'POST_BASELINE_PERMITTED' ELSE 'POST_BASELINE_UNVERIFIED' END
        WHEN NOT matched THEN 'STRADDLES_BASELINE' WHEN approved IS NULL THEN 'UNKNOWN' ELSE 'STRADDLES_BASELINE' END AS status FROM t)"""


@query("P28_compensation", f"WITH {_COMP} SELECT cand_id, status, CASE status WHEN 'POST_BASELINE_UNVERIFIED' THEN 1e0 WHEN 'STRADDLES_BASELINE' THEN 0.6e0 WHEN 'POST_BASELINE_PERMITTED' THEN 0.3e0 WHEN 'UNKNOWN' THEN 0.5e0 ELSE 0e0 END AS risk FROM k")
def compensation(spark, sf_dir):
    status = ev.compensation_status(F.col("matched"), F.col("approved"), F.lit(None).cast("date"), F.col("permitted"), F.col("change_type"), BASE, T1, T2)
    return _typed(spark, sf_dir).withColumn("status", status).select("cand_id", "status", ev.risk(F.col("status")).alias("risk"))


@query("A66_status_counts", f"WITH {_COMP} SELECT status, count(*) AS n FROM k GROUP BY status")
def status_counts(spark, sf_dir):
    return compensation(spark, sf_dir).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


_GRADE = """g AS (SELECT *, NOT matched AND coalesce(change_type IN ('NEW_BUILDING', 'EXPANSION_OR_RECONSTRUCTION'), FALSE) AS suspect, CASE WHEN arch_area > 0 THEN round(building_area * 1e0 / arch_area, 3) END AS excess FROM t),
    h AS (SELECT *, suspect AND change_ratio >= 0.5e0 AND coalesce(max_change_score, 0e0) >= 0.6e0 AS strong, coalesce(excess >= 1.3e0, FALSE) AS over, matched AND approved IS NOT NULL AND coalesce(excess < 1.3e0, FALSE) AS explained FROM g),
    i AS (SELECT *, CASE WHEN strong THEN 0.45e0 WHEN suspect THEN 0.15e0 ELSE 0e0 END + CASE WHEN over THEN 0.4e0 ELSE 0e0 END + CASE WHEN NOT consistent THEN 0.1e0 ELSE 0e0 END AS score FROM h)"""


@query("P29_illegal_grade", f"""WITH {_TYPED}, {_GRADE}
    SELECT cand_id, CASE WHEN explained THEN 'NONE' WHEN strong AND over THEN 'A_STRONG' WHEN strong OR over THEN 'B_MODERATE' WHEN score > 0 THEN 'C_WEAK' ELSE 'NONE' END AS illegal_grade, CASE WHEN explained THEN 0e0 ELSE round(least(score, 1e0), 3) END AS illegal_score, excess AS area_excess_ratio FROM i""")
def illegal_grade(spark, sf_dir):
    t = _typed(spark, sf_dir)
    return t.select("cand_id", *(c.alias(n) for n, c in ev.illegal_grade(F.col("matched"), F.col("change_type"), F.col("change_ratio"), F.col("max_change_score"), F.col("building_area"), F.col("arch_area"), F.col("consistent"), F.col("approved")).items()))


_SITE = f"""{_SCORED}, d AS (SELECT site_id, change_type, count(*) AS n FROM s WHERE change_type IS NOT NULL GROUP BY 1, 2), top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY n DESC, change_type) AS rn FROM d) WHERE rn = 1),
    b AS (SELECT site_id, count(*) AS candidates, round(sum(change_area), 4) AS area, max(priority_score) AS best, CAST(sum(CASE WHEN change_type = 'NEW_BUILDING' THEN 1 ELSE 0 END) AS BIGINT) AS new_buildings, round(sum(change_area) / (count(*) * 200e0), 6) AS area_ratio FROM s GROUP BY site_id)"""


@query("A29_site_rollup", f"WITH {_SITE} SELECT b.site_id, candidates, area, best, new_buildings, top.change_type AS main_type FROM b LEFT JOIN top ON top.site_id = b.site_id")
def site_rollup(spark, sf_dir):
    s = _scored(spark, sf_dir)
    b = s.groupBy("site_id").agg(F.count(F.lit(1)).alias("candidates"), F.round(F.sum("change_area"), 4).alias("area"), F.max("priority_score").alias("best"), F.count_if(F.col("change_type") == ev.NEW).alias("new_buildings"))
    d = s.where("change_type is not null").groupBy("site_id", "change_type").agg(F.count(F.lit(1)).alias("n"))
    top = ev.ranked(d, F.desc("n"), "change_type", "site_id", 1).select("site_id", F.col("change_type").alias("main_type"))
    return b.join(top, "site_id", "left")


@query("P30_development_stage", f"WITH {_SITE} SELECT site_id, CASE WHEN area_ratio < 0.03e0 THEN CASE WHEN new_buildings = 0 THEN 'NOT_STARTED' ELSE 'STABLE' END WHEN NOT site_id % 3 > 0 THEN 'STABLE' WHEN area_ratio >= 0.1e0 AND new_buildings = 0 THEN 'SITE_WORK' WHEN new_buildings > 0 AND site_id % 10 / 10e0 >= 0.5e0 THEN 'CONSTRUCTION' WHEN new_buildings > 0 THEN 'NEARING_COMPLETION' ELSE 'SITE_WORK' END AS stage FROM b")
def development_stage(spark, sf_dir):
    b = _scored(spark, sf_dir).groupBy("site_id").agg(F.round(F.sum("change_area") / (F.count(F.lit(1)) * 200.0), 6).alias("area_ratio"), F.count_if(F.col("change_type") == ev.NEW).alias("new_buildings"))
    return b.select("site_id", ev.development_stage(F.col("area_ratio"), F.col("new_buildings"), F.col("site_id") % 10 / 10, F.col("site_id") % 3 > 0).alias("stage"))


@query("A34_pair_summary", f"WITH {_SCORED} SELECT district, count(*) AS candidates, count(DISTINCT site_id) AS sites, CAST(sum(CASE WHEN priority_score >= 0.7e0 THEN 1 ELSE 0 END) AS BIGINT) AS high, CAST(sum(CASE WHEN matched THEN 1 ELSE 0 END) AS BIGINT) AS matches, round(100e0 * (1 - count(DISTINCT site_id) * 1e0 / count(*)), 4) AS visits_saved_pct FROM s GROUP BY district")
def pair_summary(spark, sf_dir):
    return _scored(spark, sf_dir).groupBy("district").agg(F.count(F.lit(1)).alias("candidates"), F.countDistinct("site_id").alias("sites"), F.count_if(F.col("priority_score") >= 0.7).alias("high"), F.count_if("matched").alias("matches"), F.round(100 * (1 - F.countDistinct("site_id") / F.count(F.lit(1))), 4).alias("visits_saved_pct"))


@query("A44_threshold_sweep", f"WITH {ctes('candidates')}, th AS (SELECT * FROM (VALUES (0.3e0), (0.4e0), (0.5e0), (0.6e0), (0.7e0)) AS v(threshold)) SELECT threshold, district, CAST(sum(CASE WHEN change_ratio >= threshold THEN 1 ELSE 0 END) AS BIGINT) AS new_buildings, CAST(sum(CASE WHEN change_ratio > 0 AND change_ratio < threshold THEN 1 ELSE 0 END) AS BIGINT) AS expansions FROM th, candidates GROUP BY 1, 2")
def threshold_sweep(spark, sf_dir):
    """Each row is given to a fixed short list of thresholds by explode; no join."""
    c = table(spark, sf_dir, "candidates").withColumn("threshold", F.explode(F.array(*map(F.lit, (0.3, 0.4, 0.5, 0.6, 0.7)))))
    r, t = F.col("change_ratio"), F.col("threshold")
    return c.groupBy("threshold", "district").agg(F.count_if(r >= t).alias("new_buildings"), F.count_if((r > 0) & (r < t)).alias("expansions"))


@query("U01_union_of_kinds", f"WITH {_TYPED} SELECT cand_id, change_type, change_ratio, NULL::DOUBLE AS change_area FROM t WHERE change_type IS NOT NULL UNION ALL SELECT cand_id, CASE WHEN coalesce(max_change_score, 0e0) >= 0.6e0 AND change_area >= 50 AND NOT coalesce(brightness_delta > 0, FALSE) THEN 'DEMOLITION' ELSE 'OTHER_CHANGE' END, NULL, change_area FROM candidates WHERE change_ratio = 0")
def union_of_kinds(spark, sf_dir):
    t = _typed(spark, sf_dir).where("change_type is not null").select("cand_id", "change_type", "change_ratio")
    u = table(spark, sf_dir, "candidates").where("change_ratio = 0").select("cand_id", ev.unmatched_type(F.col("max_change_score"), F.col("change_area"), F.col("brightness_delta")).alias("change_type"), "change_area")
    return t.unionByName(u, allowMissingColumns=True)


@query("L01_top_purposes", f"WITH {ctes('register')} SELECT purpose, count(*) AS n FROM register GROUP BY purpose ORDER BY n DESC, purpose LIMIT 3")
def top_purposes(spark, sf_dir):
    return table(spark, sf_dir, "register").groupBy("purpose").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "purpose").limit(3)
