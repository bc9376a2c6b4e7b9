"""Scene catalog: search, de-duplication, choice and availability."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def search(scenes: DataFrame, start: datetime, end: datetime, max_cloud: float) -> DataFrame:
    return scenes.where(F.col("ts").between(F.lit(start), F.lit(end)) & (F.col("cloud") < max_cloud))


def latest_processing(scenes: DataFrame) -> DataFrame:
    """The greatest scene id of each tile and second of acquisition."""
    rest = [c for c in scenes.columns if c not in ("tile", "ts", "scene_id")]
    sec = F.date_trunc("second", "ts").alias("second")
    g = scenes.groupBy("tile", sec).agg(F.max("scene_id").alias("scene_id"), F.max_by(F.struct("ts", *rest), "scene_id").alias("s"))
    return g.select("tile", "scene_id", "s.*")


def best_of(scenes: DataFrame, group: Column, n: int) -> DataFrame:
    """The n scenes of least cloud of each group, each id once."""
    s = scenes.dropDuplicates(["scene_id"]).withColumn("grp", group)
    return s.withColumn("rank", F.row_number().over(Window.partitionBy("grp").orderBy("cloud", "scene_id"))).where(F.col("rank") <= n)


def newest(scenes: DataFrame, as_of: datetime, within_days: int, max_cloud: float) -> DataFrame:
    """The newest usable scene before as_of and its age in days."""
    s = scenes.where((F.col("ts") <= F.lit(as_of)) & (F.col("cloud") < max_cloud) & (F.datediff(F.lit(as_of), "ts") <= within_days))
    return s.agg(F.max_by("scene_id", F.struct("ts", "scene_id")).alias("scene_id"), F.datediff(F.lit(as_of), F.max("ts")).alias("age_days"))


def availability(scenes: DataFrame, periods: DataFrame, period: Column, max_cloud: float) -> DataFrame:
    """Count, best cloud and best scene of every period; a period without a scene stays with status NONE."""
    s = scenes.withColumn("period", period).where(F.col("cloud") < max_cloud)
    a = s.groupBy("period").agg(F.count(F.lit(1)).alias("n"), F.min("cloud").alias("best_cloud"), F.min_by("scene_id", F.struct("cloud", "scene_id")).alias("best_scene"))
    status = F.when(F.coalesce("n", F.lit(0)) == 0, "NONE").when(F.col("n") < 5, "FEW").otherwise("OK")
    return periods.join(a, "period", "left").select("period", F.coalesce("n", F.lit(0)).alias("n"), "best_cloud", "best_scene", status.alias("status"))


def choose(scenes: DataFrame, group: Column, target: datetime, clear_min: float = 0.5, tolerance: float = 0.1) -> DataFrame:
    """Of scenes clear enough and near the clearest one of their group: the nearest to the target date, then the clearest."""
    s = scenes.withColumn("grp", group).where(F.col("clear_fraction") >= clear_min)
    s = s.withColumn("best", F.max("clear_fraction").over(Window.partitionBy("grp"))).where(F.col("clear_fraction") >= F.col("best") - tolerance)
    order = [F.abs(F.datediff("ts", F.lit(target))), F.desc("clear_fraction"), F.col("scene_id")]
    return s.withColumn("rank", F.row_number().over(Window.partitionBy("grp").orderBy(*order))).where("rank = 1").drop("rank", "best")
