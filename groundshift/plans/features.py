"""Queries of nested features: a round trip through GeoJSON, rings from open ways, and the filter by tags."""

from __future__ import annotations

from pyspark.sql import functions as F

from groundshift.operators import polygons as pg
from groundshift.plans.registry import query
from groundshift.sources import features as ft
from groundshift.sources.tables import ctes, table


def _texts(spark, sf_dir):
    """Each zone as the text of a feature with two tags."""
    p = table(spark, sf_dir, "zone_points")
    rings = p.groupBy("zone_id", "ring").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x", "y"))), lambda q: F.array(q["x"], q["y"])).alias("r"))
    rings = rings.withColumn("r", F.concat("r", F.slice("r", 1, 1)))  # closed, as the format wants it
    z = rings.groupBy("zone_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ring", "r"))), lambda q: q["r"]).alias("rings"))
    k = F.col("zone_id")
    tags = F.create_map(F.lit("landuse"), F.when(k % 4 == 0, "quarry").otherwise("forest"), F.lit("natural"), F.when(k % 5 == 0, "bare_rock").otherwise("wood"))
    return z.select(ft.feature_text(k, tags, F.col("rings")).alias("text"))


@query("S10_geojson", f"WITH {ctes('zone_points')} SELECT CAST(zone_id AS VARCHAR) AS feature, ring, i, round(x + 1e-9, 6) AS x, round(y + 1e-9, 6) AS y FROM zone_points")
def geojson(spark, sf_dir):
    c = ft.corners(ft.parsed(_texts(spark, sf_dir), "text"))
    return c.select("feature", "ring", "i", F.round(F.col("x") + 1e-9, 6).alias("x"), F.round(F.col("y") + 1e-9, 6).alias("y"))


@query("S12_tagged_features", "SELECT CAST(s_suppkey AS VARCHAR) AS feature, CASE WHEN s_suppkey % 4 = 0 THEN 'quarry' ELSE 'forest' END AS landuse, CASE WHEN s_suppkey % 5 = 0 THEN 'bare_rock' ELSE 'wood' END AS nature FROM supplier WHERE s_suppkey % 4 = 0 OR s_suppkey % 5 = 0")
def tagged_features(spark, sf_dir):
    f = ft.tagged(ft.parsed(_texts(spark, sf_dir), "text"), {"landuse": ["quarry"], "natural": ["bare_rock", "scree"], "none": ["x"]})
    return f.select("feature", F.col("properties")["landuse"].alias("landuse"), F.col("properties")["natural"].alias("nature"))


@query("S11_assembled_rings", f"""WITH {ctes('zone_points')}, s AS (SELECT zone_id, i, x, y, coalesce(lead(x) OVER w, first_value(x) OVER w) AS xb, coalesce(lead(y) OVER w, first_value(y) OVER w) AS yb FROM zone_points WHERE ring = 0 WINDOW w AS (PARTITION BY zone_id ORDER BY i))
    SELECT zone_id, count(*) AS corners, round(abs(sum(x * yb - xb * y)) / 2 + 1e-9, 5) AS area, round(sum(sqrt(pow(xb - x, 2) + pow(yb - y, 2))) + 1e-9, 5) AS perimeter FROM s GROUP BY zone_id""")
def assembled_rings(spark, sf_dir):
    """Outlines cut into ways of two sides or one, every second one turned round, in no order, and put together again."""
    p = table(spark, sf_dir, "zone_points").where("ring = 0")
    ring = p.groupBy("zone_id").agg(F.array_sort(F.collect_list(F.struct("i", "x", "y"))).alias("q"))
    ring = ring.withColumn("q", F.transform("q", lambda x: F.struct(x["x"].alias("x"), x["y"].alias("y")))).withColumn("q", F.concat("q", F.slice("q", 1, 1)))
    w = ring.select("zone_id", "q", F.explode(F.sequence(F.lit(0), F.size("q") - 2, F.lit(2))).alias("at")).select("zone_id", "at", F.slice("q", F.col("at") + 1, F.lit(3)).alias("points"))
    turned = (F.col("zone_id") + F.col("at") / 2) % 2 == 1
    w = w.select(F.col("zone_id").alias("rel"), F.xxhash64("zone_id", "at").alias("way"), F.when(turned, F.reverse("points")).otherwise(F.col("points")).alias("points"))
    rings = ft.assembled(w).select(F.col("rel").alias("zone_id"), F.lit(0).alias("ring"), "i", "x", "y")
    n = rings.groupBy("zone_id").agg(F.count(F.lit(1)).alias("corners"))
    m = pg.measures(rings, "zone_id").join(n, "zone_id")
    return m.select("zone_id", "corners", F.round(F.col("area") + 1e-9, 5).alias("area"), F.round(F.col("perimeter") + 1e-9, 5).alias("perimeter"))
