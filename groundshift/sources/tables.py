"""Readers, and adapters that turn star-schema tables into the tables of this library.

An adapter is a select over base tables that means the same in Spark SQL and in ANSI SQL; checks use the same text.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BASE = "region nation customer supplier part orders lineitem events documents labels".split()

ADAPTERS = {
    "pixels": """
        SELECT CAST(year(l_shipdate) AS INT) AS epoch, CAST(floor(l_partkey / 50) AS INT) AS r, CAST(l_partkey % 50 AS INT) AS c, count(*) AS n,
               CAST(floor(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) / count(*) / 1000) AS INT) AS nir,
               CAST(floor(sum(CAST(round(l_quantity) AS BIGINT)) * 100 / count(*)) AS INT) AS red,
               CAST(floor(sum(CAST(round(l_tax * 100) AS BIGINT)) * 500 / count(*)) AS INT) AS blue,
               CAST(floor(sum(CAST(round(l_discount * 100) AS BIGINT)) * 400 / count(*)) AS INT) AS green,
               CAST(floor(sum(CAST(l_suppkey % 50 AS BIGINT)) * 100 / count(*)) AS INT) AS swir
        FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1, 2, 3""",
    # the same cells and epochs from medians of the observations instead of their means: the input of a second run
    "median_pixels": """
        SELECT CAST(year(l_shipdate) AS INT) AS epoch, CAST(floor(l_partkey / 50) AS INT) AS r, CAST(l_partkey % 50 AS INT) AS c, count(*) AS n,
               CAST(floor(median(CAST(round(l_extendedprice * 100) AS BIGINT)) / 1000) AS INT) AS nir,
               CAST(floor(median(CAST(round(l_quantity) AS BIGINT)) * 100) AS INT) AS red,
               CAST(floor(median(CAST(round(l_tax * 100) AS BIGINT)) * 500) AS INT) AS blue,
               CAST(floor(median(CAST(round(l_discount * 100) AS BIGINT)) * 400) AS INT) AS green,
               CAST(floor(median(CAST(l_suppkey % 50 AS BIGINT)) * 100) AS INT) AS swir
        FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1, 2, 3""",
    "parcels": """
        SELECT concat('01', lpad(CAST(s_suppkey AS STRING), 17, '0')) AS pnu, (s_suppkey % 10) * 50 + 3.5e0 AS x0, floor(s_suppkey / 10) * 40 + 2.5e0 AS y0,
               (s_suppkey % 10) * 50 + 47.5e0 AS x1, floor(s_suppkey / 10) * 40 + 35.5e0 AS y1 FROM supplier""",
    "buildings": """
        SELECT c_custkey AS bld_id, (c_custkey * 37 % 4900) / 10e0 AS x0, c_custkey * 4 / 15e0 AS y0,
               (c_custkey * 37 % 4900) / 10e0 + 6 + c_nationkey % 10 AS x1, c_custkey * 4 / 15e0 + 5 + c_custkey % 8 AS y1 FROM customer""",
    "register": """
        SELECT o_custkey AS bld_id, CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS STRING) AS use_apr_day,
               CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST((year(o_orderdate) - 1) * 10000 + 615 AS STRING) END AS pms_day,
               30 + o_orderkey % 60 AS arch_area, o_orderpriority AS purpose, o_orderkey AS rec_id FROM orders""",
    "scenes": """
        SELECT event_id AS scene_id, user_id % 4 AS tile, ts, event_type AS platform, value % 100 AS cloud, 1 - (event_id * 7919 % 1000) / 5e3 AS clear_fraction FROM events""",
    "points": "SELECT c_custkey AS id, (c_custkey * 37 % 4900) / 10e0 AS x, c_custkey * 4 / 15e0 AS y, c_acctbal AS v FROM customer",
    "classes": """
        SELECT CAST(floor(p_partkey / 50) AS INT) AS r, CAST(p_partkey % 50 AS INT) AS c,
               CASE p_size % 5 WHEN 0 THEN 5 WHEN 1 THEN 7 WHEN 2 THEN 8 WHEN 3 THEN 2 ELSE 0 END AS cls FROM part""",
    "rail": "SELECT n_nationkey AS seg_id, n_nationkey * 20 AS xa, 200 + (n_nationkey % 3) * 10 AS ya, (n_nationkey + 1) * 20 AS xb, 200 + ((n_nationkey + 1) % 3) * 10 AS yb FROM nation",
    "samples": """
        SELECT l.doc_id AS id, l.quality = 1 AS truth, d.n_chars > 500 AS pred, d.lang AS stratum FROM labels l JOIN documents d ON l.doc_id = d.doc_id""",
    # rings of polygons, a row for each corner; ring 0 is the outline, others are holes
    "zone_points": """
        SELECT s_suppkey AS zone_id, v.ring, v.i, (s_suppkey % 10) * 50 + 25e0 + v.dx * (0.6e0 + (s_suppkey * 7 % 10) / 10e0) AS x,
               floor(s_suppkey / 10) * 40 + 20e0 + v.dy * (0.6e0 + (s_suppkey * 7 % 10) / 10e0) AS y
        FROM supplier JOIN (VALUES (0, 0, 0, -24e0, -10e0), (0, 0, 1, 3e0, -21e0), (0, 0, 2, 27e0, -6e0), (0, 0, 3, 19e0, 16e0), (0, 0, 4, -5e0, 22e0), (0, 0, 5, -21e0, 9e0),
                                   (0, 1, 0, -4e0, -3e0), (0, 1, 1, 7e0, -5e0), (0, 1, 2, 4e0, 7e0), (0, 1, 3, -6e0, 5e0),
                                   (1, 0, 0, -22e0, -17e0), (1, 0, 1, -19e0, 18e0), (1, 0, 2, 2e0, 3e0), (1, 0, 3, 23e0, 19e0), (1, 0, 4, 20e0, -15e0),
                                   (2, 0, 0, -25e0, -4e0), (2, 0, 1, -3e0, -20e0), (2, 0, 2, 26e0, 5e0), (2, 0, 3, 4e0, 21e0)) AS v(kind, ring, i, dx, dy) ON v.kind = s_suppkey % 3""",
    "quarry_points": """
        SELECT s_suppkey AS quarry_id, v.ring, v.i, (s_suppkey % 10) * 50 + 40e0 + v.dx * 0.7e0 AS x, floor(s_suppkey / 10) * 40 + 31e0 + v.dy * 0.7e0 AS y
        FROM supplier JOIN (VALUES (0, 0, 0, -21e0, -3e0), (0, 0, 1, 4e0, -19e0), (0, 0, 2, 25e0, 4e0), (0, 0, 3, 1e0, 22e0), (0, 1, 0, -2e0, -2e0), (0, 1, 1, 5e0, 0e0), (0, 1, 2, 1e0, 6e0),
                                   (1, 0, 0, -18e0, -14e0), (1, 0, 1, 20e0, -9e0), (1, 0, 2, 6e0, 17e0)) AS v(kind, ring, i, dx, dy) ON v.kind = s_suppkey % 2 WHERE s_suppkey % 7 = 3""",
    "footprint_points": """
        SELECT c_custkey AS bld_id, v.ring, v.i, (c_custkey * 37 % 4900) / 10e0 + v.dx AS x, c_custkey * 4 / 15e0 + v.dy AS y
        FROM customer JOIN (VALUES (0, 0, 0, -4e0, -2e0), (0, 0, 1, 3e0, -5e0), (0, 0, 2, 5e0, 2e0), (0, 0, 3, -2e0, 5e0), (1, 0, 0, -6e0, -3e0), (1, 0, 1, 0e0, -1e0), (1, 0, 2, 6e0, -4e0), (1, 0, 3, 1e0, 6e0),
                                   (2, 0, 0, -3e0, -6e0), (2, 0, 1, 4e0, -6e0), (2, 0, 2, 4e0, 7e0), (2, 0, 3, -3e0, 7e0)) AS v(kind, ring, i, dx, dy) ON v.kind = c_custkey % 3""",
    "aoi_points": """
        SELECT 1 AS aoi_id, v.ring, v.i, v.x, v.y0 + v.h * top AS y FROM (SELECT 1 AS kind, floor(max(s_suppkey) / 10) * 40 + 40e0 AS top FROM supplier) t
        JOIN (VALUES (1, 0, 0, 37e0, 2e0, 0e0), (1, 0, 1, 471e0, 5e0, 0e0), (1, 0, 2, 452e0, 0e0, 0.96e0), (1, 0, 3, 243e0, 0e0, 0.85e0), (1, 0, 4, 52e0, 0e0, 0.98e0),
                     (1, 1, 0, 180e0, 3e0, 0.4e0), (1, 1, 1, 260e0, -2e0, 0.4e0), (1, 1, 2, 222e0, 5e0, 0.6e0)) AS v(kind, ring, i, x, y0, h) ON v.kind = t.kind""",
    "candidates": """
        SELECT c_custkey AS cand_id, c_custkey % 5 = 0 AS near_change, CASE WHEN c_custkey % 3 = 0 THEN 0e0 ELSE (c_custkey * 31 % 100) / 100e0 END AS change_ratio,
               CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE (c_custkey * 57 % 100) / 100e0 END AS max_change_score, (c_custkey * 13 % 200) * 1e0 AS change_area,
               CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE (c_custkey * 7 % 41 - 20) * 1e0 END AS brightness_delta, 40 + c_custkey % 150 AS building_area,
               c_nationkey AS site_id, c_mktsegment AS district FROM customer""",
}


def _whole(x: Column) -> Column:
    """CAST(round(x) AS BIGINT) of a double, halves away from zero, without Spark's detour over decimals; what is large or no number goes the plain way."""
    size = F.abs(x)
    up = F.floor(size) + F.when(size - F.floor(size) >= 0.5, 1).otherwise(0)
    return F.when(size < 1e15, F.when(x < 0, -up).otherwise(up)).otherwise(F.round(x).cast("bigint"))


def pixels(lineitem: DataFrame) -> DataFrame:
    """The adapter of pixels, value for value, of lines whose amounts are doubles."""
    mean = lambda x, by: F.floor(F.sum(x) * by / F.count(F.lit(1)))
    of = lambda c, by=1: _whole(F.col(c) * by)
    at = [F.year("l_shipdate").alias("epoch"), F.floor(F.col("l_partkey") / 50).cast("int").alias("r"), (F.col("l_partkey") % 50).cast("int").alias("c")]
    price = F.floor(F.sum(of("l_extendedprice", 100)) / F.count(F.lit(1)) / 1000)
    bands = {"nir": price, "red": mean(of("l_quantity"), 100), "blue": mean(of("l_tax", 100), 500), "green": mean(of("l_discount", 100), 400), "swir": mean((F.col("l_suppkey") % 50).cast("bigint"), 100)}
    return lineitem.where("l_shipdate is not null").groupBy(*at).agg(F.count(F.lit(1)).alias("n"), *(x.cast("int").alias(n) for n, x in bands.items()))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table or an adapted one."""
    if name == "pixels":
        lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
        if all(lines.schema[c].dataType.typeName() == "double" for c in ("l_extendedprice", "l_quantity", "l_tax", "l_discount")):
            return pixels(lines)
    if name not in ADAPTERS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = ADAPTERS[name]
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in BASE if re.search(rf"(FROM|JOIN) {t}\b", sql)}
    return spark.sql(re.sub(rf"(FROM|JOIN) ({'|'.join(used)})\b", r"\1 {\2}", sql), **used)


def epochs(spark: SparkSession, sf_dir: str) -> list[int]:
    """The years of pixels, from the first to the last; only these two come to the driver."""
    first, last = spark.read.parquet(f"{sf_dir}/lineitem.parquet").agg(F.year(F.min("l_shipdate")), F.year(F.max("l_shipdate"))).first()
    return [] if first is None else list(range(first, last + 1))


def ctes(*names: str) -> str:
    """The adapters of these names as common table expressions."""
    return ", ".join(f"{n} AS ({ADAPTERS[n].strip()})" for n in names)
