"""Queries of statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from groundshift.operators import permutations as pm
from groundshift.operators import selection
from groundshift.operators import statistics as st
from groundshift.operators.ranking import numbered
from groundshift.plans.land import _COVER, _GRID, _SERIES, _cover, _grid, _persistence
from groundshift.plans.registry import query
from groundshift.sources.tables import ctes, table

_CONF = "count(*) FILTER (truth AND pred) AS tp, count(*) FILTER (NOT truth AND pred) AS fp, count(*) FILTER (truth AND NOT pred) AS fn, count(*) FILTER (NOT truth AND NOT pred) AS tn"
_RATES = "round(tp * 1e0 / nullif(tp + fp, 0), 6) AS precision, round(tp * 1e0 / nullif(tp + fn, 0), 6) AS recall, round(2e0 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1, round((tp + tn) * 1e0 / nullif(tp + fp + fn + tn, 0), 6) AS accuracy"


@query("A40_confusion", f"WITH {ctes('samples')}, c AS (SELECT stratum, {_CONF} FROM samples GROUP BY stratum) SELECT *, {_RATES} FROM c")
def confusion(spark, sf_dir):
    return st.confusion(table(spark, sf_dir, "samples"), F.col("truth"), F.col("pred"), "stratum")


@query("A02_otsu", """WITH e AS (SELECT min(p_retailprice) * 1e0 AS lo, max(p_retailprice) * 1e0 AS hi FROM part), b AS (SELECT CAST(least(255, floor((p_retailprice - lo) / (hi - lo) * 256)) AS INT) AS bin, lo, hi, count(*) AS n FROM part, e GROUP BY 1, 2, 3),
    s AS (SELECT *, sum(n) OVER (ORDER BY bin) AS w0, sum(n * bin) OVER (ORDER BY bin) AS m0, sum(n) OVER () AS w, sum(n * bin) OVER () AS m FROM b), t AS (SELECT *, round(coalesce(w0 * (w - w0) * pow(m0 * 1e0 / w0 - (m - m0) * 1e0 / nullif(w - w0, 0), 2), 0e0), 3) AS btw FROM s)
    SELECT bin, round(lo + (bin + 1) * (hi - lo) / 256, 6) AS threshold FROM t ORDER BY btw DESC, bin LIMIT 1""")
def otsu(spark, sf_dir):
    return st.otsu(table(spark, sf_dir, "part"), "p_retailprice").withColumn("threshold", F.round("threshold", 6))


@query("L02_stratified_sample", f"WITH {ctes('candidates')} SELECT cand_id, district, CAST(nth AS INT) AS nth FROM (SELECT *, row_number() OVER (PARTITION BY district ORDER BY sha256(concat(CAST(cand_id AS VARCHAR), ':42')), cand_id) AS nth FROM candidates) WHERE nth <= 12")
def stratified_sample(spark, sf_dir):
    return st.stratified(table(spark, sf_dir, "candidates"), "district", "cand_id", 12).select("cand_id", "district", "nth")


@query("L04_validation_split", f"WITH {ctes('parcels')} SELECT pnu, CAST(concat('0x', substr(sha256(pnu), 1, 4)) AS INT) % 5 = 0 AS validation FROM parcels")
def validation_split(spark, sf_dir):
    return table(spark, sf_dir, "parcels").select("pnu", st.validation_split(F.col("pnu")).alias("validation"))


_KNN = """knn AS (SELECT a.id, b.id AS other, pow(a.x - b.x, 2) + pow(a.y - b.y, 2) AS d2, row_number() OVER (PARTITION BY a.id ORDER BY pow(a.x - b.x, 2) + pow(a.y - b.y, 2), b.id) AS rank FROM points a JOIN points b ON a.id <> b.id),
    e AS (SELECT * FROM knn WHERE rank <= 8)"""


def _edges(spark, sf_dir):
    return st.neighbours(table(spark, sf_dir, "points"), 8, 40.0)


@query("J25_neighbours", f"WITH {ctes('points')}, {_KNN} SELECT id, other, round(d2, 6) AS d2, CAST(rank AS INT) AS rank FROM e")
def neighbours(spark, sf_dir):
    return _edges(spark, sf_dir).withColumn("d2", F.round("d2", 6))


@query("A49_morans_i", f"WITH {ctes('points')}, {_KNN}, m AS (SELECT avg(v) AS mean FROM points), z AS (SELECT id, v - mean AS z FROM points, m), l AS (SELECT e.id, avg(zj.z) AS lag FROM e JOIN z zj ON zj.id = e.other GROUP BY e.id) SELECT count(*) AS n, round(sum(z.z * lag) / sum(z.z * z.z), 6) AS moran_i, round(-1e0 / (count(*) - 1), 9) AS expected FROM z JOIN l USING (id)")
def morans_i(spark, sf_dir):
    p = table(spark, sf_dir, "points")
    return st.morans_i(p, _edges(spark, sf_dir), "v").select("n", F.round("moran_i", 6).alias("moran_i"), F.round("expected", 9).alias("expected"))


@query("A50_P47_getis_ord", f"WITH {ctes('points')}, {_KNN}, s AS (SELECT count(*) AS n, avg(v) AS m, stddev_pop(v) AS s FROM points), g AS (SELECT x.id, sum(v) AS sm, count(*) AS w FROM (SELECT id, other FROM e UNION ALL SELECT id, id FROM points) x JOIN points p ON p.id = x.other GROUP BY x.id), z AS (SELECT id, (sm - m * w) / (s * sqrt((n * w - w * w) * 1e0 / (n - 1))) AS z FROM g, s) SELECT id, round(z, 6) AS z, CASE WHEN z >= 2.576e0 THEN 'HOT_99' WHEN z >= 1.96e0 THEN 'HOT_95' WHEN z >= 1.645e0 THEN 'HOT_90' WHEN z <= -2.576e0 THEN 'COLD_99' WHEN z <= -1.96e0 THEN 'COLD_95' WHEN z <= -1.645e0 THEN 'COLD_90' ELSE 'NOT_SIG' END AS gi_class FROM z")
def getis_ord(spark, sf_dir):
    return st.getis_ord(table(spark, sf_dir, "points"), _edges(spark, sf_dir), "v").withColumn("z", F.round("z", 6))


@query("A36_grouping_sets", f"WITH {_SERIES} SELECT persistence, n_valid, count(*) AS cells, count(*) * 100 AS area_m2 FROM pers GROUP BY GROUPING SETS ((persistence), (n_valid), (persistence, n_valid), ())")
def grouping_sets(spark, sf_dir):
    return _persistence(spark, sf_dir).groupingSets([["persistence"], ["n_valid"], ["persistence", "n_valid"], []], "persistence", "n_valid").agg(F.count(F.lit(1)).alias("cells"), (F.count(F.lit(1)) * 100).alias("area_m2"))


@query("A47_areas_above", f"WITH {_GRID} SELECT epoch, " + ", ".join(f"count(*) FILTER (ndvi >= {t}e0) * 100 AS above_{int(t * 100)}" for t in (0.2, 0.3, 0.4, 0.5)) + ", round(count(ndvi) * 1e0 / count(*), 6) AS valid_fraction FROM grid GROUP BY epoch")
def areas_above(spark, sf_dir):
    return _grid(spark, sf_dir).groupBy("epoch").agg(*((F.count_if(F.col("ndvi") >= t) * 100).alias(f"above_{int(t * 100)}") for t in (0.2, 0.3, 0.4, 0.5)), F.round(F.count("ndvi") / F.count(F.lit(1)), 6).alias("valid_fraction"))


@query("A45_mask_overlap", f"WITH {_SERIES}, m AS (SELECT k, r, c, event, lag(event) OVER (PARTITION BY r, c ORDER BY k) AS b FROM ev WHERE k > 0) SELECT k, count(*) FILTER (event) AS on_cells, round(count(*) FILTER (event AND b) * 1e0 / nullif(count(*) FILTER (event OR b), 0), 6) AS jaccard FROM m GROUP BY k")
def mask_overlap(spark, sf_dir):
    from groundshift.operators import series
    from groundshift.plans.land import _DECLINE

    m = series.decline_events(_grid(spark, sf_dir), **_DECLINE).where("k > 0").withColumn("b", F.lag("event").over(series.cell().orderBy("k")))
    return m.groupBy("k").agg(F.count_if("event").alias("on_cells"), F.round(F.try_divide(F.count_if(F.col("event") & F.col("b")), F.count_if(F.col("event") | F.col("b"))), 6).alias("jaccard"))


@query("A38_consistency", f"WITH {_SERIES}, {ctes('parcels')}, {_COVER}, t AS (SELECT pnu, sum(area) AS a, sum(CASE WHEN evaluable THEN area ELSE 0 END) AS e, sum(CASE WHEN frequency > 0 THEN area ELSE 0 END) AS d FROM cov LEFT JOIN pers USING (r, c) GROUP BY pnu) SELECT count(*) AS parcels, count(DISTINCT pnu) AS keys, count(*) FILTER (d > e + 1e-6) AS decline_over_evaluable, count(*) FILTER (e > a + 1e-6) AS evaluable_over_area FROM t")
def consistency(spark, sf_dir):
    j = _cover(spark, sf_dir).join(_persistence(spark, sf_dir), ["r", "c"], "left").groupBy("pnu").agg(F.sum("area").alias("a"), F.sum(F.when(F.col("evaluable"), F.col("area")).otherwise(0)).alias("e"), F.sum(F.when(F.col("frequency") > 0, F.col("area")).otherwise(0)).alias("d"))
    return j.agg(F.count(F.lit(1)).alias("parcels"), F.countDistinct("pnu").alias("keys"), F.count_if(F.col("d") > F.col("e") + 1e-6).alias("decline_over_evaluable"), F.count_if(F.col("e") > F.col("a") + 1e-6).alias("evaluable_over_area"))


_PERMUTATIONS, _SEED = 199, 42
_PLACED = f"""{ctes('points')}, {_KNN}, pl AS (SELECT id, v, row_number() OVER (ORDER BY sha256(CAST(id AS VARCHAR)), id) - 1 AS place FROM points WHERE v IS NOT NULL), nn AS (SELECT count(*) AS n FROM pl)"""
_AB = lambda less: f"SELECT s, a, CASE WHEN a % m = 1 AND b = 0 THEN 1 ELSE b END AS b FROM (SELECT s, m, list_filter(range(c, c + 200), lambda x: gcd(x, m) = 1)[1] AS a, b FROM (SELECT s, m, 1 + (s * s * 7919 + s * 104729 + {_SEED}) % m AS c, (s * 15485863 + {_SEED}) % m AS b FROM range(1, {_PERMUTATIONS + 1}) r(s), (SELECT n - {less} AS m FROM nn)))"


@query("A49_moran_permutations", f"""WITH {_PLACED}, ab AS ({_AB(0)} UNION ALL SELECT 0, 1, 0), z AS (SELECT id, place, v - avg(v) OVER () AS v FROM pl),
    q AS (SELECT s, e.id, ((p.place * a + b) % n) AS own, ((o.place * a + b) % n) AS other FROM ab, nn, e JOIN pl p ON p.id = e.id JOIN pl o ON o.id = e.other),
    t AS (SELECT s, q.id, any_value(x.v) * avg(y.v) AS m FROM q JOIN z x ON x.place = own JOIN z y ON y.place = other GROUP BY s, q.id), i AS (SELECT s, round(sum(m) / (SELECT sum(v * v) FROM z), 12) AS i FROM t GROUP BY s), f AS (SELECT i AS moran_i FROM i WHERE s = 0)
    SELECT (SELECT n FROM nn) AS n, round(moran_i, 6) AS moran_i, round((least(count(*) FILTER (i >= moran_i), {_PERMUTATIONS} - count(*) FILTER (i >= moran_i)) + 1) / {_PERMUTATIONS + 1}e0, 6) AS p_sim, round((moran_i - avg(i)) / stddev_pop(i), 5) AS z_sim FROM i, f WHERE s > 0 GROUP BY moran_i""")
def moran_permutations(spark, sf_dir):
    m = pm.morans_i(table(spark, sf_dir, "points"), _edges(spark, sf_dir), "v", permutations=_PERMUTATIONS, seed=_SEED)
    return m.select("n", F.round("moran_i", 6).alias("moran_i"), F.round("p_sim", 6).alias("p_sim"), F.round("z_sim", 5).alias("z_sim"))


@query("A50_gi_permutations", f"""WITH {_PLACED}, ab AS ({_AB(1)}), r AS (SELECT e.id, p.place, sum(o.v) AS total, count(*) AS k FROM e JOIN pl p ON p.id = e.id JOIN pl o ON o.id = e.other GROUP BY 1, 2),
    d AS (SELECT r.id, s, total, (place + 1 + (m * a + b + place * 7) % (n - 1)) % n AS spot FROM r, ab, nn, range(1, 9) w(m) WHERE m <= k), t AS (SELECT d.id, s, any_value(total) AS total, sum(v) AS x FROM d JOIN pl ON pl.place = spot GROUP BY d.id, s)
    SELECT id, count(*) FILTER (round(x, 9) >= round(total, 9)) AS above, round((least(count(*) FILTER (round(x, 9) >= round(total, 9)), {_PERMUTATIONS} - count(*) FILTER (round(x, 9) >= round(total, 9))) + 1) / {_PERMUTATIONS + 1}e0, 6) AS p_sim FROM t GROUP BY id""")
def gi_permutations(spark, sf_dir):
    return pm.getis_ord(table(spark, sf_dir, "points"), _edges(spark, sf_dir), "v", permutations=_PERMUTATIONS, seed=_SEED).withColumn("p_sim", F.round("p_sim", 6))


_ROI = "roi AS (SELECT c_custkey AS roi_id, c_nationkey % 3 AS project, row_number() OVER (PARTITION BY c_nationkey % 3 ORDER BY c_acctbal DESC, c_custkey) AS rank, (c_custkey * 37 % 4900) / 10e0 AS x0, c_custkey * 4 / 15e0 AS y0, (c_custkey * 37 % 4900) / 10e0 + 20 + c_custkey % 25 AS x1, c_custkey * 4 / 15e0 + 20 + c_custkey % 25 AS y1 FROM customer)"
_INTER = "greatest(0e0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0e0, least(a.y1, b.y1) - greatest(a.y0, b.y0)) >= 0.5e0 * (b.x1 - b.x0) * (b.y1 - b.y0)"


@query("W14_roi_suppression", f"""WITH RECURSIVE {_ROI}, g AS (SELECT project, CAST(0 AS BIGINT) AS i, CAST([] AS STRUCT(roi_id BIGINT, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE)[]) AS kept FROM (SELECT DISTINCT project FROM roi)
    UNION ALL SELECT g.project, i + 1, CASE WHEN len(list_filter(kept, lambda a: {_INTER})) = 0 THEN list_append(kept, {{'roi_id': CAST(b.roi_id AS BIGINT), 'x0': CAST(b.x0 AS DOUBLE), 'y0': CAST(b.y0 AS DOUBLE), 'x1': CAST(b.x1 AS DOUBLE), 'y1': CAST(b.y1 AS DOUBLE)}}) ELSE kept END FROM g JOIN roi b ON b.project = g.project AND b.rank = i + 1),
    l AS (SELECT project, max_by(kept, i) AS kept FROM g GROUP BY project) SELECT project, k.roi_id FROM (SELECT project, unnest(kept) AS k FROM l)""")
def roi_suppression(spark, sf_dir):
    c, key = table(spark, sf_dir, "customer"), F.col("c_custkey")
    x, y, side = (key * 37 % 4900) / F.lit(10.0), key * 4 / F.lit(15.0), 20 + key % 25
    b = c.select(key.alias("roi_id"), (F.col("c_nationkey") % 3).alias("project"), "c_acctbal", x.alias("x0"), y.alias("y0"), (x + side).alias("x1"), (y + side).alias("y1"))
    b = numbered(b, [F.desc("c_acctbal"), F.col("roi_id")], "rank", ["project"])
    return selection.suppressed(b, "roi_id", "project", "rank").select("project", "roi_id")
