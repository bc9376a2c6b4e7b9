"""Sites of change through epochs: the same place at other dates, what persists, progress of blocks, and when a change was first seen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundshift.operators.components import written
from groundshift.operators.evidence import RISK


def same_sites(sites: DataFrame, distance: float = 30.0) -> DataFrame:
    """sites (id, k, x, y) with others, the sorted epochs k of other sites whose centre is not farther than distance, and n_epochs with their own. Centres meet in buckets of that size."""
    s = written(sites.select("id", "k", "x", "y"))
    at = lambda c: F.floor(F.col(c) / distance)
    around = s.withColumn("bx", F.explode(F.sequence(at("x") - 1, at("x") + 1))).withColumn("by", F.explode(F.sequence(at("y") - 1, at("y") + 1)))
    other = s.select(F.col("k").alias("k2"), F.col("x").alias("x2"), F.col("y").alias("y2"), at("x").alias("bx"), at("y").alias("by"))
    dx, dy = F.col("x") - F.col("x2"), F.col("y") - F.col("y2")
    met = around.join(other, ["bx", "by"]).where((F.col("k") != F.col("k2")) & (dx * dx + dy * dy <= distance * distance))
    found = met.groupBy("id").agg(F.array_sort(F.collect_set("k2")).alias("others"))
    j = s.join(found, "id", "left")
    others = F.coalesce("others", F.array().cast(found.schema["others"].dataType))
    return j.select("id", "k", "x", "y", others.alias("others"), (F.size(others) + 1).alias("n_epochs"))


def persisting(cells: DataFrame) -> DataFrame:
    """(k, n, persistent): of cells (k, id, r, c) of sites, how many sites an epoch has and how many of them share a cell with a site of the epoch before."""
    c = cells.select("k", "id", "r", "c").distinct()
    before = c.select((F.col("k") + 1).alias("k"), "r", "c").distinct().withColumn("met", F.lit(True))
    s = c.join(before, ["k", "r", "c"], "left").groupBy("k", "id").agg(F.coalesce(F.bool_or("met"), F.lit(False)).alias("met"))
    return s.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.count_if("met").alias("persistent"))


def touched(cover: DataFrame, cells: DataFrame, key: str) -> DataFrame:
    """(key, k, area, n, new): area of changes in each block and epoch, how many changes it meets, and how many of these are new. cover: (key, r, c, area); cells: (k, id, r, c, new)."""
    j = cover.join(cells, ["r", "c"]).groupBy(key, "k", "id").agg(F.sum("area").alias("area"), F.max(F.col("new").cast("int")).alias("new"))
    return j.groupBy(key, "k").agg(F.sum("area").alias("area"), F.count(F.lit(1)).alias("n"), F.sum("new").alias("new"))


def progress(blocks: DataFrame, touched: DataFrame, epochs: list[int], key: str, active_area: float = 0.0) -> DataFrame:
    """blocks (key, whole) with epochs observed and with change, persistence, area and its ratio, counts of the last epoch with change, whether the last epoch has any. No epochs are an error."""
    if not epochs:
        raise ValueError("no epochs to follow blocks through")
    on = F.col("area") > active_area
    latest = F.max_by(F.struct("k", "n", "new", "area"), F.when(on, F.col("k")))
    g = touched.groupBy(key).agg(F.count_if(on).alias("active"), F.sum("area").alias("area"), latest.alias("last"), F.coalesce(F.bool_or(on & (F.col("k") == max(epochs))), F.lit(False)).alias("active_now"))
    j = blocks.join(g, key, "left")
    n = len(epochs)
    return j.select(
        key, F.lit(n).alias("epochs"), F.coalesce("active", F.lit(0)).alias("active"), (F.coalesce("active", F.lit(0)) / n).alias("persistence"), F.coalesce("area", F.lit(0.0)).alias("area"), (F.coalesce("area", F.lit(0.0)) / F.col("whole")).alias("ratio"),
        F.col("last.k").alias("last_active"), F.coalesce("last.n", F.lit(0)).alias("last_n"), F.coalesce("last.new", F.lit(0)).alias("last_new"), F.coalesce("active_now", F.lit(False)).alias("active_now"),
    )


def bracketed(status: Column, risk: Column, start: Column, end: Column, baseline: Column) -> tuple[Column, Column]:
    """Status and risk after the earliest interval (start, end) in which a change was seen; NULL start: none was, and nothing changes."""
    after, before = start >= baseline, end <= baseline
    refined = F.when(start.isNull(), status).when(after, F.when(status.isin("STRADDLES_BASELINE", "UNKNOWN"), "POST_BASELINE_UNVERIFIED").otherwise(status)).when(before, "PRE_BASELINE").otherwise(status)
    weight = F.when(start.isNull(), risk).when(after, F.greatest(risk, F.lit(RISK["POST_BASELINE_UNVERIFIED"]))).when(before, F.lit(RISK["PRE_BASELINE"])).otherwise(risk)
    return refined, weight
