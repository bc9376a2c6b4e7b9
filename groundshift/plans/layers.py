"""Queries of layers from several sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from groundshift.operators import polygons as pg
from groundshift.operators.components import scratch, written
from groundshift.plans.registry import query
from groundshift.plans.shapes import _edges, _over, _r, _shapes, _sweep
from groundshift.sources import layers
from groundshift.sources.tables import ctes, table


@query("S14_dissolved_areas", f"""WITH {ctes('zone_points')}, {_edges('zone_points', 'zone_id')}, na AS (SELECT s_suppkey AS k, n_name FROM supplier JOIN nation ON n_nationkey = s_nationkey), p AS (SELECT n_name AS g, 0 AS layer, s, xa, ya, xb, yb FROM zone_e JOIN na USING (k)), {_sweep('p', 'o')},
    c AS (SELECT n_name, count(*) AS parts FROM na GROUP BY 1) SELECT n_name, parts, round(a / 1e6 + 1e-12, 9) AS area_km2 FROM c JOIN o ON g = n_name""")
def dissolved_areas(spark, sf_dir):
    """An area of interest for each name, from all features that bear it, overlaps counted once."""
    s = table(spark, sf_dir, "supplier").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))  # nations are a fixed short list
    s = written(s.select(F.col("s_suppkey").alias("zone_id"), "n_name"))
    names = [r[0] for r in s.select("n_name").distinct().collect()]  # at most the nations
    own = layers.named_areas(s, "n_name", names)
    u = pg.union_area(_shapes(spark, sf_dir, "zone_points", "zone_id"), own.select("zone_id", "n_name"), "n_name")
    return own.groupBy("n_name").agg(F.count(F.lit(1)).alias("parts")).join(u, "n_name").select("n_name", "parts", F.round(F.col("area_union") / 1e6 + 1e-12, 9).alias("area_km2"))


@query("S17_permits", f"WITH {ctes('register')}, d AS (SELECT DISTINCT o_custkey % 50 AS dong FROM orders WHERE o_orderkey % 3 = 0) SELECT rec_id, concat('01000', lpad(CAST(bld_id % 50 AS VARCHAR), 5, '0'), '1', lpad(CAST(rec_id % 997 AS VARCHAR), 4, '0'), lpad(CAST(bld_id % 31 AS VARCHAR), 4, '0')) AS pnu FROM register JOIN d ON d.dong = bld_id % 50")
def permits(spark, sf_dir):
    """Permits of the legal dongs in which there are parcels."""
    dong = lambda c: F.lpad((F.col(c) % 50).cast("string"), 5, "0")
    p = table(spark, sf_dir, "orders").where("o_orderkey % 3 = 0").select(F.concat(F.lit("01000"), dong("o_custkey"), F.lit("100010000")).alias("pnu"))
    items = table(spark, sf_dir, "register").select("rec_id", F.lit("01000").alias("district"), dong("bld_id").alias("dong"), F.lit("1").alias("kind"), (F.col("rec_id") % 997).alias("main"), (F.col("bld_id") % 31).alias("sub"))
    return layers.permits(items, p).select("rec_id", "pnu")


@query("S19_U04_clipped_parts", f"WITH {ctes('zone_points', 'aoi_points')}, {_edges('zone_points', 'zone_id')}, {_edges('aoi_points', 'aoi_id')}, {_over('zone', 'aoi')} SELECT g AS zone_id, CASE WHEN g % 2 = 0 THEN 'main' ELSE 'sub' END AS part, CASE WHEN g % 2 = 0 THEN g * 7 END AS lot, round(ab + 1e-9, 4) AS area_in_aoi_m2 FROM o WHERE ab > 0.01e0")
def clipped_parts(spark, sf_dir):
    """Two parts of a layer, one with a column that the other lacks, put together and clipped to the area of interest."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("zone_id"))
    both = layers.together([s.where("zone_id % 2 = 0").select("zone_id", F.lit("main").alias("part"), (F.col("zone_id") * 7).alias("lot")), s.where("zone_id % 2 = 1").select("zone_id", F.lit("sub").alias("part"))])
    o = pg.overlaid(_shapes(spark, sf_dir, "zone_points", "zone_id"), _shapes(spark, sf_dir, "aoi_points", "aoi_id")).groupBy("zone_id").agg(F.sum("both").alias("both")).where("both > 0.01")
    return both.join(o, "zone_id").select("zone_id", "part", "lot", _r("both", 4).alias("area_in_aoi_m2"))


@query("S20_exchange", "WITH p AS (SELECT CASE WHEN o_orderkey % 11 <> 0 THEN concat('01', lpad(CAST(o_custkey AS VARCHAR), 17, '0')) END AS pnu, o_orderpriority AS category, o_totalprice AS area, o_orderkey AS id FROM orders) SELECT pnu, category, area FROM (SELECT *, row_number() OVER (PARTITION BY pnu ORDER BY area DESC, id) AS rn FROM p WHERE pnu IS NOT NULL) WHERE rn = 1")
def exchange(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    p = o.select(F.when(F.col("o_orderkey") % 11 != 0, F.concat(F.lit("01"), F.lpad(F.col("o_custkey").cast("string"), 17, "0"))).alias("pnu"), F.col("o_orderpriority").alias("category"), F.col("o_totalprice").alias("area"), F.col("o_orderkey").alias("id"))
    return layers.exchange(p, "pnu", ["category", "area"], [-F.col("area"), F.col("id")])


@query("S21_imagery_candidates", "SELECT CAST(p_partkey AS VARCHAR) AS offer, CASE WHEN p_partkey % 9 <> 0 THEN DATE '2024-01-01' + CAST(p_partkey % 97 AS INT) END AS acquired, CASE WHEN p_partkey % 8 <> 0 THEN CAST(p_size AS DOUBLE) END AS cloud, CASE WHEN p_partkey % 7 <> 0 THEN p_partkey % 5 * 1e0 END AS resolution FROM part")
def imagery_candidates(spark, sf_dir):
    """Offers written as CSV, with texts where a date or number is not known, and read again."""
    k, path = F.col("p_partkey"), scratch(spark)
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (k % 97).cast("int")), "yyyy-MM-dd")
    rows = table(spark, sf_dir, "part").select(k.cast("string").alias("offer"), F.when(k % 9 != 0, day).otherwise("soon").alias("acquired"), F.when(k % 8 != 0, F.col("p_size").cast("string")).otherwise("n/a").alias("cloud"), F.when(k % 7 != 0, (k % 5).cast("string")).alias("resolution"))
    rows.write.option("header", True).csv(path)
    return layers.imagery_candidates(spark, path)
