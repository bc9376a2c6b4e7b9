"""One row a parcel with all that is known of it, and answers to questions asked over it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundshift.operators.reporting import interval_status, screening_tier


def interval_states(cover: DataFrame, key: str, intervals: DataFrame) -> DataFrame:
    """(key, k, status) of every parcel and interval from the exact areas of its cells. intervals (r, c, k, decline, known, event): whether vegetation declined, whether both ends are known,
    and the event of both indices (NULL where not known)."""
    area = lambda m: F.round(F.coalesce(F.sum(F.when(m, F.col("area"))), F.lit(0.0)), 6)
    event = F.col("event")
    g = cover.join(intervals, ["r", "c"]).groupBy(key, "k").agg(
        area(F.col("decline")).alias("d"), area(event == 2).alias("ex"), area(event == 1).alias("lo"), area(event == 3).alias("rc"), area(F.col("known")).alias("e10"), area(event.isNotNull()).alias("e20")
    )
    return g.select(key, "k", interval_status(*(F.col(x) for x in ("d", "ex", "lo", "rc", "e10", "e20"))).alias("status"))


def screened(parcels: DataFrame, states: DataFrame, key: str, persistent: Column) -> DataFrame:
    """parcels with the states of their intervals in order (an array, as long as there are intervals) and the tier that follows; a parcel without a cell cannot be judged."""
    s = states.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "status"))), lambda x: x.status).alias("states"))
    p = parcels.join(s, key, "left").withColumn("states", F.coalesce("states", F.array().cast("array<string>")))
    return p.withColumn("tier", screening_tier(F.col("states"), persistent))


def buildings_of(overlaps: DataFrame, areas: DataFrame, key: str, building: str, least: float = 0.5) -> DataFrame:
    """(key, buildings, footprint_m2): buildings at least half of which lie in a parcel. overlaps (building, key, overlap), areas (building, area)."""
    j = overlaps.join(areas, building).where(F.round(F.col("overlap"), 6) >= least * F.round(F.col("area"), 6))
    return j.groupBy(key).agg(F.count(F.lit(1)).alias("buildings"), F.sum("area").alias("footprint_m2"))


def answer(question: str, rows: DataFrame, order: dict[str, bool], text: Column, most: int = 5) -> DataFrame:
    """(question, n, top): how many rows there are, and the texts of the first of them, in the order of these columns (True: falling; they must leave no ties)."""
    by = [F.col(c).desc() if down else F.col(c).asc() for c, down in order.items()]
    first = rows.select(*order, text.alias("__text")).orderBy(*by).limit(most)
    key = F.struct(*((-F.col(c) if down else F.col(c)).alias(c) for c, down in order.items()), "__text")
    top = first.agg(F.array_join(F.transform(F.array_sort(F.collect_list(key)), lambda x: x["__text"]), ", ").alias("top"))  # at most `most` rows
    return rows.agg(F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(top)).select(F.lit(question).alias("question"), "n", "top")  # one row each
