"""Queries of tables for people, of text fields and of bookkeeping."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from groundshift.functions import keys
from groundshift.operators import reporting as rp
from groundshift.plans.land import _COVER, _SERIES, _cover, _persistence
from groundshift.operators.selection import quantiles
from groundshift.plans.registry import query
from groundshift.sources.tables import ctes, table

_LEAST = lambda ev: f"greatest(200e0, 0.1e0 * {ev})"
_IV = f"SELECT o_custkey AS pnu, o_orderkey % 5 AS k, sum(o_orderkey % 700) * 1e0 AS d, sum(o_orderkey % 500) * 1e0 AS ex, sum(o_orderkey % 300) * 1e0 AS lo, sum(o_orderkey % 900) * 1e0 AS rc, sum(o_orderkey % 2000) * 1e0 AS e10, sum(o_orderkey % 3000) * 1e0 AS e20 FROM orders GROUP BY 1, 2"
_STATE = f"CASE WHEN NOT e10 >= 400 AND NOT e20 >= 800 THEN 'na' WHEN e20 >= 800 AND ex >= {_LEAST('e20')} THEN 'exposed' WHEN (e10 >= 400 AND d >= {_LEAST('e10')}) OR (e20 >= 800 AND lo >= {_LEAST('e20')}) THEN 'veg_loss' WHEN e20 >= 800 AND rc >= {_LEAST('e20')} THEN 'recovery' ELSE 'none' END"


def _states(spark, sf_dir):
    k = F.col("o_orderkey")
    names = {"d": 700, "ex": 500, "lo": 300, "rc": 900, "e10": 2000, "e20": 3000}
    g = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("pnu"), (k % 5).alias("k")).agg(*(F.sum(k % m).cast("double").alias(n) for n, m in names.items()))
    return g.select("pnu", "k", rp.interval_status(*(F.col(n) for n in ("d", "ex", "lo", "rc", "e10", "e20"))).alias("status"))


@query("P42_interval_status", f"WITH a AS ({_IV}) SELECT pnu, k, {_STATE} AS status FROM a")
def interval_status(spark, sf_dir):
    return _states(spark, sf_dir)


@query("P43_screening_tier", f"WITH a AS ({_IV}), s AS (SELECT pnu, list({_STATE}) AS st FROM a GROUP BY pnu) SELECT pnu, CASE WHEN len(list_filter(st, lambda x: x <> 'na')) = 0 THEN 4 WHEN list_contains(st, 'exposed') OR pnu % 7 = 0 THEN 1 WHEN list_contains(st, 'veg_loss') OR list_contains(st, 'recovery') THEN 2 ELSE 3 END AS tier FROM s")
def screening_tier(spark, sf_dir):
    s = _states(spark, sf_dir).groupBy("pnu").agg(F.collect_list("status").alias("st"))
    return s.select("pnu", rp.screening_tier(F.col("st"), F.col("pnu") % 7 == 0).alias("tier"))


@query("P45_height", "SELECT p_partkey, CASE WHEN p_size % 6 = 0 THEN 2 ELSE p_size % 6 END * 3e0 AS height_m, p_size % 6 = 0 AS is_estimated FROM part")
def height(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", *(c.alias(n) for n, c in rp.height(F.col("p_size") % 6).items()))


@query("P49_aerial_cost", "SELECT p_partkey, round(coalesce(CASE WHEN p_size % 5 <> 0 THEN p_size * 1000e0 END, 0e0) + p_retailprice * 25, 4) AS cost FROM part")
def aerial_cost(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.round(F.coalesce(F.when(F.col("p_size") % 5 != 0, F.col("p_size") * 1000.0), F.lit(0.0)) + F.col("p_retailprice") * 25, 4).alias("cost"))


@query("A54_zoning", f"WITH {ctes('classes', 'parcels')}, {_COVER}, s AS (SELECT pnu, cls, round(sum(area) / sum(sum(area)) OVER (PARTITION BY pnu), 6) AS share FROM cov JOIN classes USING (r, c) GROUP BY pnu, cls) SELECT pnu, CASE WHEN max(share) >= 0.25e0 THEN arg_max(cls, (share, cls)) END AS zone, max(share) AS share FROM s GROUP BY pnu")
def zoning(spark, sf_dir):
    from groundshift.plans.land import land_cover_share

    return rp.zoning(land_cover_share(spark, sf_dir), "pnu", "cls", "share", 0.25)


@query("F15_ring_measures", f"WITH {ctes('buildings')} SELECT bld_id, round((x1 - x0) * (y1 - y0), 6) AS area, round((x0 + x1) / 2, 6) AS cx, round((y0 + y1) / 2, 6) AS cy, x0 AS xmin, y0 AS ymin, x1 AS xmax, y1 AS ymax FROM buildings")
def ring_measures(spark, sf_dir):
    p = lambda x, y: F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    b = table(spark, sf_dir, "buildings").select("bld_id", F.array(p("x0", "y0"), p("x1", "y0"), p("x1", "y1"), p("x0", "y1"), p("x0", "y0")).alias("ring"))
    m = rp.ring_measures(F.col("ring"))
    return b.select("bld_id", *(F.round(m[c], 6).alias(c) for c in ("area", "cx", "cy")), *(m[c].alias(c) for c in ("xmin", "ymin", "xmax", "ymax")))


@query("F12_truthy", "SELECT p_partkey, lower(trim(CASE p_size % 4 WHEN 0 THEN 'True' WHEN 1 THEN ' 1 ' WHEN 2 THEN 'no' END)) IN ('true', '1') IS TRUE AS flag FROM part")
def truthy(spark, sf_dir):
    s = F.col("p_size") % 4
    return table(spark, sf_dir, "part").select("p_partkey", keys.truthy(F.when(s == 0, "True").when(s == 1, " 1 ").when(s == 2, "no")).alias("flag"))


@query("F17_event_dates", "WITH t AS (SELECT o_orderkey, concat('notice ', CAST(o_orderdate AS DATE), ' and again ', CAST(o_orderdate AS DATE) + INTERVAL 30 DAY) AS text FROM orders), e AS (SELECT o_orderkey, unnest(regexp_extract_all(text, '\\d{4}-\\d{2}-\\d{2}')) AS d FROM t) SELECT o_orderkey, CAST(d AS DATE) AS event_date, row_number() OVER (PARTITION BY o_orderkey ORDER BY d) AS nth FROM e")
def event_dates(spark, sf_dir):
    d = F.col("o_orderdate").cast("date")
    t = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("notice "), d.cast("string"), F.lit(" and again "), F.date_add(d, 30).cast("string")).alias("text"))
    found = F.array_sort(F.regexp_extract_all("text", F.lit(r"\d{4}-\d{2}-\d{2}"), F.lit(0)))
    return t.select("o_orderkey", F.posexplode(found).alias("i", "d")).select("o_orderkey", F.to_date("d").alias("event_date"), (F.col("i") + 1).cast("bigint").alias("nth"))


@query("A63_context_window", "SELECT o_orderkey, date_diff('day', DATE '1994-01-01', CAST(o_orderdate AS DATE)) AS days_before, round(date_diff('day', DATE '1994-01-01', CAST(o_orderdate AS DATE)) * 1e0 / date_diff('day', DATE '1994-01-01', DATE '1999-01-01'), 6) AS share FROM orders")
def context_window(spark, sf_dir):
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit(date(1994, 1, 1)))
    return table(spark, sf_dir, "orders").select("o_orderkey", days.alias("days_before"), F.round(days / (date(1999, 1, 1) - date(1994, 1, 1)).days, 6).alias("share"))


@query("A35_period_statistics", f"WITH {ctes('candidates')} SELECT district, count(*) AS n, round(median(change_area), 4) AS med, round(avg(change_area), 4) AS mean, max(change_area) AS most, round(count(*) / (1096 / 365.25e0), 6) AS per_year FROM candidates GROUP BY district")
def period_statistics(spark, sf_dir):
    c = table(spark, sf_dir, "candidates")
    middle = quantiles(c.select("district", F.col("change_area").alias("v")), ["district"], [0.5]).select(F.col("district").alias("of"), F.round("value", 4).alias("med"))
    g = c.groupBy("district").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("change_area"), 4).alias("mean"), F.max("change_area").alias("most"), F.round(F.count(F.lit(1)) / (1096 / 365.25), 6).alias("per_year"))
    return g.join(middle, F.col("district").eqNullSafe(F.col("of"))).drop("of")


@query("A37_quality_summary", f"WITH {_SERIES} SELECT 'persistence' AS section, persistence AS item, count(*) AS value FROM pers GROUP BY 2 UNION ALL SELECT 'n_valid', CAST(n_valid AS VARCHAR), count(*) FROM pers GROUP BY 2 UNION ALL SELECT 'check', 'evaluable', count(*) FILTER (evaluable) FROM pers")
def quality_summary(spark, sf_dir):
    """Three sections from one pass: an entry of each for every cell, then one aggregation."""
    e = lambda s, i, v: F.struct(F.lit(s).alias("section"), i.alias("item"), v.cast("bigint").alias("v"))
    p = _persistence(spark, sf_dir).select(F.explode(F.array(e("persistence", F.col("persistence"), F.lit(1)), e("n_valid", F.col("n_valid").cast("string"), F.lit(1)), e("check", F.lit("evaluable"), F.col("evaluable").cast("int")))).alias("x"))
    return p.groupBy("x.section", "x.item").agg(F.sum("x.v").alias("value"))


@query("S26_pending_pairs", f"WITH {ctes('pixels')}, y AS (SELECT DISTINCT epoch FROM pixels), p AS (SELECT a.epoch AS t1, b.epoch AS t2 FROM y a JOIN y b ON b.epoch > a.epoch), m AS (SELECT t1, t2 FROM p WHERE t2 - t1 = 1 AND t1 % 2 = 1) SELECT t1, t2 FROM p WHERE (t1, t2) NOT IN (SELECT (t1, t2) FROM m)")
def pending_pairs(spark, sf_dir):
    y = table(spark, sf_dir, "pixels").select("epoch").distinct()
    every = y.agg(F.array_sort(F.collect_set("epoch")).alias("l")).select(F.explode("l").alias("t1"), "l").select("t1", F.explode("l").alias("t2")).where("t2 > t1")
    done = every.where("t2 - t1 = 1 and t1 % 2 = 1").withColumn("status", F.lit("SUCCESS")).unionByName(every.where("t2 - t1 = 2").withColumn("status", F.lit("FAILED")))
    return rp.pending(every, done, ["t1", "t2"])


@query("S18_deduplicated", "SELECT DISTINCT l_orderkey AS id FROM lineitem")
def deduplicated(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id")).dropDuplicates(["id"])


_VISIT = f"""{ctes('points', 'candidates')}, s AS (SELECT site_id AS project, id AS site_id, CASE WHEN change_ratio > 0.6e0 THEN 0 WHEN change_ratio > 0.3e0 THEN 1 ELSE 2 END AS tr, coalesce(max_change_score, 0e0) AS score, CASE WHEN id % 19 <> 0 THEN x END AS x, y FROM points JOIN candidates ON id = cand_id),
    walk AS (SELECT project, CAST(1 AS BIGINT) AS step, site_id, x, y, [site_id] AS seen FROM (SELECT *, row_number() OVER (PARTITION BY project ORDER BY tr, score DESC, site_id) AS rn FROM s WHERE x IS NOT NULL) WHERE rn = 1
        UNION ALL SELECT project, step, site_id, x, y, list_append(seen, site_id) FROM (SELECT s.project, w.step + 1 AS step, s.site_id, s.x, s.y, w.seen, row_number() OVER (PARTITION BY s.project ORDER BY s.tr, (s.x - w.x) * (s.x - w.x) + (s.y - w.y) * (s.y - w.y), s.site_id) AS rn FROM walk w JOIN s ON s.project = w.project AND s.x IS NOT NULL AND NOT list_contains(w.seen, s.site_id)) WHERE rn = 1),
    last AS (SELECT project, max(step) AS n FROM walk GROUP BY project)"""


@query("W16_visit_order", f"WITH RECURSIVE {_VISIT} SELECT project, site_id, step AS route_order FROM walk UNION ALL SELECT s.project, s.site_id, coalesce(n, 0) + row_number() OVER (PARTITION BY s.project ORDER BY s.site_id) FROM s LEFT JOIN last USING (project) WHERE x IS NULL")
def visit_order(spark, sf_dir):
    c = table(spark, sf_dir, "points").join(table(spark, sf_dir, "candidates").withColumnRenamed("cand_id", "id"), "id")
    tier = F.when(F.col("change_ratio") > 0.6, "HIGH").when(F.col("change_ratio") > 0.3, "MEDIUM").otherwise("LOW")
    sites = c.select(F.col("site_id").alias("project"), F.col("id").alias("site_id"), tier.alias("tier"), F.coalesce("max_change_score", F.lit(0.0)).alias("score"), F.when(F.col("id") % 19 != 0, F.col("x")).alias("x"), "y")
    return rp.routed(sites, "project")
