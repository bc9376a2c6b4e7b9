"""Queries of lookups, zonal tables and rankings over the tables of the other plans."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from groundshift.functions import keys
from groundshift.operators import raster, scoring
from groundshift.plans.evidence import _SCORED, _TYPED, _scored, _typed
from groundshift.plans.land import _AREAS, _COVER, _GRID, _SERIES, _areas, _cover, _grid, _indexed, _persistence
from groundshift.plans.registry import query
from groundshift.sources.tables import ctes, table

_T5 = ", ".join("(%d, %d)" % d for d in ((0, 0), (0, 1), (1, 0), (1, 1)))


@query("J05_children", f"WITH {ctes('classes')} SELECT r * 2 + dr AS r, c * 2 + dc AS c, cls FROM classes, (VALUES {_T5}) AS d(dr, dc)")
def children(spark, sf_dir):
    d = F.explode(F.array(*(F.struct(F.lit(i).alias("dr"), F.lit(j).alias("dc")) for i in (0, 1) for j in (0, 1))))
    return table(spark, sf_dir, "classes").select("r", "c", "cls", d.alias("d")).select((F.col("r") * 2 + F.col("d.dr")).alias("r"), (F.col("c") * 2 + F.col("d.dc")).alias("c"), "cls")


@query("J07_class_at_centre", f"WITH {ctes('classes')}, t AS (SELECT DISTINCT CAST(floor(r / 2) AS INT) AS r, CAST(floor(c / 2) AS INT) AS c FROM classes) SELECT t.r, t.c, k.cls FROM t LEFT JOIN classes k ON k.r = t.r * 2 + 1 AND k.c = t.c * 2 + 1")
def class_at_centre(spark, sf_dir):
    k = table(spark, sf_dir, "classes")
    t = k.select(F.floor(F.col("r") / 2).cast("int").alias("r"), F.floor(F.col("c") / 2).cast("int").alias("c")).distinct()
    return raster.nearest(t, k, "cls", 20.0, 10.0)


@query("J10_pair_masks", f"WITH {ctes('buildings')}, b AS (SELECT bld_id % 3 AS pair, * FROM buildings), x AS (SELECT pair, x0, y0, x1, y1, unnest(range(CAST(floor(x0 / 10) AS INT), CAST(ceil(x1 / 10) AS INT))) AS c FROM b), y AS (SELECT *, unnest(range(CAST(floor(y0 / 10) AS INT), CAST(ceil(y1 / 10) AS INT))) AS r FROM x) SELECT DISTINCT pair, r, c FROM y WHERE (c + 0.5e0) * 10 >= x0 AND (c + 0.5e0) * 10 < x1 AND (r + 0.5e0) * 10 >= y0 AND (r + 0.5e0) * 10 < y1")
def pair_masks(spark, sf_dir):
    from groundshift.operators.parcels import centre_cells

    b = table(spark, sf_dir, "buildings")
    return centre_cells(b, "bld_id").select((F.col("bld_id") % 3).alias("pair"), "r", "c").distinct()


@query("J35_mosaic", f"WITH {ctes('pixels')} SELECT r, c, arg_max(red, epoch) AS red FROM pixels WHERE n >= 2 GROUP BY r, c")
def mosaic(spark, sf_dir):
    """The latest valid tile wins."""
    return table(spark, sf_dir, "pixels").where("n >= 2").groupBy("r", "c").agg(F.max_by("red", "epoch").alias("red"))


@query("A08_change_intensity", f"WITH {_GRID}, d AS (SELECT r, c, abs(ndvi - lag(ndvi) OVER (PARTITION BY r, c ORDER BY k)) AS d FROM grid) SELECT r, c, round(max(d), 6) AS intensity FROM d GROUP BY r, c")
def change_intensity(spark, sf_dir):
    from groundshift.operators.series import cell

    d = _grid(spark, sf_dir).select("r", "c", F.abs(F.col("ndvi") - F.lag("ndvi").over(cell().orderBy("k"))).alias("d"))
    return d.groupBy("r", "c").agg(F.round(F.max("d"), 6).alias("intensity"))


@query("A14_zonal_table", f"WITH {ctes('pixels', 'parcels')}, {_COVER} SELECT pnu, epoch, round(avg(red), 6) AS mean_red, min(nir) AS lo_nir, max(nir) AS hi_nir, count(*) AS cells FROM cov JOIN pixels USING (r, c) GROUP BY pnu, epoch")
def zonal_table(spark, sf_dir):
    j = _cover(spark, sf_dir).join(table(spark, sf_dir, "pixels"), ["r", "c"])
    return j.groupBy("pnu", "epoch").agg(F.round(F.avg("red"), 6).alias("mean_red"), F.min("nir").alias("lo_nir"), F.max("nir").alias("hi_nir"), F.count(F.lit(1)).alias("cells"))


@query("A17_mean_delta", f"WITH {ctes('pixels', 'parcels')}, {_COVER}, w AS (SELECT b.epoch, a.r, a.c, b.nir - a.nir AS d FROM pixels a JOIN pixels b ON b.epoch = a.epoch + 1 AND b.r = a.r AND b.c = a.c) SELECT pnu, epoch, round(sum(area * d) / sum(area), 6) AS delta FROM cov JOIN w USING (r, c) GROUP BY pnu, epoch")
def mean_delta(spark, sf_dir):
    w = scoring.date_pairs(table(spark, sf_dir, "pixels"), ["nir"], F.lit(True)).select(F.col("k").alias("epoch"), "r", "c", (F.col("nir_2") - F.col("nir_1")).alias("d"))
    return _cover(spark, sf_dir).join(w, ["r", "c"]).groupBy("pnu", "epoch").agg(F.round(F.sum(F.col("area") * F.col("d")) / F.sum("area"), 6).alias("delta"))


@query("A33_run_summary", f"WITH {ctes('candidates')} SELECT count(*) AS n, coalesce(sum(change_area), 0e0) AS total, round(coalesce(avg(change_area), 0e0), 6) AS mean, coalesce(max(max_change_score), 0e0) AS best FROM candidates WHERE change_ratio > 0")
def run_summary(spark, sf_dir):
    z = F.lit(0.0)
    return table(spark, sf_dir, "candidates").where("change_ratio > 0").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("change_area"), z).alias("total"), F.round(F.coalesce(F.avg("change_area"), z), 6).alias("mean"), F.coalesce(F.max("max_change_score"), z).alias("best"))


@query("A27_grid_identity", f"WITH {ctes('pixels')}, g AS (SELECT epoch, max(c) AS w, min(c) AS x0 FROM pixels GROUP BY epoch) SELECT count(DISTINCT (w, x0)) = 1 AS same_grid, count(*) AS epochs FROM g")
def grid_identity(spark, sf_dir):
    g = table(spark, sf_dir, "pixels").groupBy("epoch").agg(F.max("c").alias("w"), F.min("c").alias("x0"))
    return g.agg((F.countDistinct(F.struct("w", "x0")) == 1).alias("same_grid"), F.count(F.lit(1)).alias("epochs"))


@query("A60_executive_summary", f"WITH {_SCORED} SELECT count(*) AS candidates, count(*) FILTER (change_type = 'NEW_BUILDING') AS new_buildings, count(*) FILTER (consistent = FALSE) AS inconsistent, count(*) FILTER (priority_score >= 0.7e0) AS high, count(*) FILTER (NOT matched) AS unmatched FROM s")
def executive_summary(spark, sf_dir):
    c = F.col
    return _scored(spark, sf_dir).agg(F.count(F.lit(1)).alias("candidates"), F.count_if(c("change_type") == "NEW_BUILDING").alias("new_buildings"), F.count_if(~c("consistent")).alias("inconsistent"), F.count_if(c("priority_score") >= 0.7).alias("high"), F.count_if(~c("matched")).alias("unmatched"))


@query("A39_cell_shares", f"WITH {ctes('points')}, g AS (SELECT CAST(floor(x / 100) AS BIGINT) AS gx, CAST(floor(y / 100) AS BIGINT) AS gy, count(*) AS n FROM points GROUP BY 1, 2) SELECT gx, gy, n, round(n * 1e0 / sum(n) OVER (), 6) AS share FROM g ORDER BY n DESC, gx, gy LIMIT 3")
def cell_shares(spark, sf_dir):
    """The three fullest cells and their share of all points."""
    g = table(spark, sf_dir, "points").groupBy(F.floor(F.col("x") / 100).alias("gx"), F.floor(F.col("y") / 100).alias("gy")).agg(F.count(F.lit(1)).alias("n"))
    total = g.agg(F.sum("n").alias("total"))
    return g.orderBy(F.desc("n"), "gx", "gy").limit(3).join(F.broadcast(total)).select("gx", "gy", "n", F.round(F.col("n") / F.col("total"), 6).alias("share"))


@query("W18_main_change", f"WITH {ctes('candidates')} SELECT site_id, arg_max(cand_id, (change_area, cand_id)) AS cand_id, max(change_area) AS area FROM candidates GROUP BY site_id")
def main_change(spark, sf_dir):
    return table(spark, sf_dir, "candidates").groupBy("site_id").agg(F.max_by("cand_id", F.struct("change_area", "cand_id")).alias("cand_id"), F.max("change_area").alias("area"))


@query("W19_typical_cases", f"WITH {_TYPED} SELECT change_type, cand_id FROM (SELECT change_type, cand_id, row_number() OVER (PARTITION BY change_type ORDER BY change_area DESC, cand_id) AS rn FROM t WHERE change_type IS NOT NULL) WHERE rn = 1")
def typical_cases(spark, sf_dir):
    t = _typed(spark, sf_dir).where("change_type is not null")
    return t.groupBy("change_type").agg(F.max_by("cand_id", F.struct("change_area", -F.col("cand_id"))).alias("cand_id"))


@query("L07_tier_order", f"WITH {_SCORED} SELECT cand_id, CASE WHEN priority_score >= 0.7e0 THEN 0 WHEN priority_score >= 0.4e0 THEN 1 ELSE 2 END AS tier FROM s ORDER BY tier, cand_id")
def tier_order(spark, sf_dir):
    return _scored(spark, sf_dir).select("cand_id", F.when(F.col("priority_score") >= 0.7, 0).when(F.col("priority_score") >= 0.4, 1).otherwise(2).alias("tier")).orderBy("tier", "cand_id")


@query("L08_top_parcels", f"WITH {_AREAS} SELECT pnu, round(decline_area, 4) AS decline_area FROM areas ORDER BY round(decline_area, 4) DESC, pnu LIMIT 3")
def top_parcels(spark, sf_dir):
    return _areas(spark, sf_dir).select("pnu", F.round("decline_area", 4).alias("decline_area")).orderBy(F.desc("decline_area"), "pnu").limit(3)


@query("F01_lot_parts", "WITH t AS (SELECT s_suppkey, concat(CASE WHEN s_suppkey % 3 = 0 THEN '산 ' ELSE '' END, CAST(s_suppkey AS VARCHAR), CASE WHEN s_suppkey % 2 = 0 THEN concat('-', CAST(s_suppkey % 7 AS VARCHAR)) ELSE '' END, CASE s_suppkey % 4 WHEN 0 THEN ' 전' WHEN 1 THEN ' 임' ELSE '' END) AS t FROM supplier) SELECT s_suppkey, t LIKE '산%' AS mountain, CAST(s_suppkey AS INT) AS main_no, CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey % 7 AS INT) ELSE 0 END AS sub_no, CASE s_suppkey % 4 WHEN 0 THEN '전' WHEN 1 THEN '임' END AS category FROM t")
def lot_parts(spark, sf_dir):
    k = F.col("s_suppkey")
    text = F.concat(F.when(k % 3 == 0, F.lit("산 ")).otherwise(F.lit("")), k.cast("string"), F.when(k % 2 == 0, F.concat(F.lit("-"), (k % 7).cast("string"))).otherwise(F.lit("")), F.when(k % 4 == 0, F.lit(" 전")).when(k % 4 == 1, F.lit(" 임")).otherwise(F.lit("")))
    return table(spark, sf_dir, "supplier").select("s_suppkey", *(c.alias(n) for n, c in keys.lot_parts(text).items()))
