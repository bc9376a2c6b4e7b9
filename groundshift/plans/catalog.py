"""Queries over the scene catalog and costs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from groundshift.operators import scenes
from groundshift.operators.ranking import numbered
from groundshift.plans.registry import query
from groundshift.sources.tables import ctes, table

FROM, TO = datetime(1995, 1, 1), datetime(2030, 1, 1)
_S = f"WITH {ctes('scenes')}"
_HOUR = "CAST(extract('hour' FROM ts) AS INT)"


@query("S02_scene_search", f"{_S} SELECT scene_id, tile, ts, platform, cloud FROM scenes WHERE ts BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '2030-01-01' AND cloud < 20")
def scene_search(spark, sf_dir):
    return scenes.search(table(spark, sf_dir, "scenes"), FROM, TO, 20).select("scene_id", "tile", "ts", "platform", "cloud")


@query("S03_latest_processing", f"{_S} SELECT tile, max(scene_id) AS scene_id, arg_max(cloud, scene_id) AS cloud FROM scenes GROUP BY tile, date_trunc('second', ts)")
def latest_processing(spark, sf_dir):
    return scenes.latest_processing(table(spark, sf_dir, "scenes")).select("tile", "scene_id", "cloud")


@query("S04_best_scenes", f"{_S}, r AS (SELECT *, {_HOUR} AS grp, row_number() OVER (PARTITION BY {_HOUR} ORDER BY cloud, scene_id) AS rank FROM scenes) SELECT grp, scene_id, cloud, CAST(rank AS INT) AS rank FROM r WHERE rank <= 3")
def best_scenes(spark, sf_dir):
    return scenes.best_of(table(spark, sf_dir, "scenes"), F.hour("ts"), 3).select("grp", "scene_id", "cloud", "rank")


@query("S05_newest_scene", f"{_S} SELECT arg_max(scene_id, (ts, scene_id)) AS scene_id, CAST(date_diff('day', CAST(max(ts) AS DATE), DATE '2030-01-01') AS INT) AS age_days FROM scenes WHERE cloud < 20")
def newest_scene(spark, sf_dir):
    return scenes.newest(table(spark, sf_dir, "scenes"), TO, 100_000, 20)


@query("S06_availability", f"{_S}, p AS (SELECT CAST(unnest(range(0, 30)) AS INT) AS period), a AS (SELECT {_HOUR} AS period, count(*) AS n, min(cloud) AS best_cloud, arg_min(scene_id, (cloud, scene_id)) AS best_scene FROM scenes WHERE cloud < 20 GROUP BY 1) SELECT period, coalesce(n, 0) AS n, best_cloud, best_scene, CASE WHEN coalesce(n, 0) = 0 THEN 'NONE' WHEN n < 5 THEN 'FEW' ELSE 'OK' END AS status FROM p LEFT JOIN a USING (period)")
def availability(spark, sf_dir):
    periods = spark.range(30).select(F.col("id").cast("int").alias("period"))
    return scenes.availability(table(spark, sf_dir, "scenes"), periods, F.hour("ts"), 20)


@query("W08_chosen_scene", f"{_S}, s AS (SELECT *, {_HOUR} AS grp, max(clear_fraction) OVER (PARTITION BY {_HOUR}) AS best FROM scenes WHERE clear_fraction >= 0.5e0), r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY abs(date_diff('day', CAST(ts AS DATE), DATE '2024-01-05')), clear_fraction DESC, scene_id) AS rank FROM s WHERE clear_fraction >= best - 0.1e0) SELECT grp, scene_id, round(clear_fraction, 6) AS clear_fraction FROM r WHERE rank = 1")
def chosen_scene(spark, sf_dir):
    return scenes.choose(table(spark, sf_dir, "scenes"), F.hour("ts"), datetime(2024, 1, 5)).select("grp", "scene_id", F.round("clear_fraction", 6).alias("clear_fraction"))


_OFFERS = "SELECT p_partkey AS offer, CASE WHEN p_partkey % 9 <> 0 THEN DATE '2024-01-01' + CAST(p_partkey % 97 AS INT) END AS acquired, CASE WHEN p_partkey % 8 <> 0 THEN p_size END AS cloud, CASE WHEN p_partkey % 7 <> 0 THEN p_partkey % 5 END AS resolution FROM part"


@query("L05_offer_order", f"SELECT *, row_number() OVER (ORDER BY acquired DESC NULLS LAST, cloud NULLS LAST, resolution NULLS LAST, offer) AS nth FROM ({_OFFERS})")
def offer_order(spark, sf_dir):
    """All offers, numbered: newest, then clearest, then finest first."""
    k = F.col("p_partkey")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (k % 97).cast("int"))
    p = table(spark, sf_dir, "part").select(k.alias("offer"), F.when(k % 9 != 0, day).alias("acquired"), F.when(k % 8 != 0, F.col("p_size")).alias("cloud"), F.when(k % 7 != 0, k % 5).alias("resolution"))
    return numbered(p, [F.desc_nulls_last("acquired"), F.asc_nulls_last("cloud"), F.asc_nulls_last("resolution"), F.col("offer")], "nth")


@query("P48_A58_order_costs", "WITH a AS (SELECT * FROM (VALUES (25e0), (100e0), (400e0)) AS v(area)), o AS (SELECT p_partkey AS offer, CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_retailprice END AS price, p_size AS minimum, CASE WHEN p_partkey % 2 = 0 THEN p_size * 10 END AS processing FROM part) SELECT offer, area, round(CASE WHEN price IS NOT NULL THEN greatest(area * price, minimum * 1000e0) * 2 + coalesce(processing, 0) END, 4) AS cost, price IS NOT NULL AS comparable FROM a, o")
def order_costs(spark, sf_dir):
    """Unknown price, unknown cost; each offer is given to a fixed short list of areas."""
    k = F.col("p_partkey")
    price = F.when(k % 9 != 0, F.col("p_retailprice"))
    processing = F.when(k % 2 == 0, F.col("p_size") * 10)
    o = table(spark, sf_dir, "part").select(k.alias("offer"), price.alias("price"), F.col("p_size").alias("minimum"), processing.alias("processing")).withColumn("area", F.explode(F.array(*map(F.lit, (25.0, 100.0, 400.0)))))
    cost = F.when(F.col("price").isNotNull(), F.greatest(F.col("area") * F.col("price"), F.col("minimum") * 1000.0) * 2 + F.coalesce("processing", F.lit(0)))
    return o.select("offer", "area", F.round(cost, 4).alias("cost"), F.col("price").isNotNull().alias("comparable"))
