"""Exact quantiles without a buffer of all values, and greedy suppression without a sequential loop.

Quantiles: the value of a rank is bracketed by histograms. Each round counts the values of a bracket in BINS equal bins (a partial aggregation: tasks send counts) and goes
on with the least and largest value of the bin that holds the rank; a bracket of one value is its answer, and one of at most FEW rows is sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from groundshift.operators.components import dropped, written

BINS, FEW = 1024, 10_000
#: Brackets that are sent to all tasks; with more of them groups are small and rows are joined.
BROADCAST = 200_000


def _at(values: DataFrame, brackets: DataFrame, keys: list[str]) -> DataFrame:
    few = brackets.limit(BROADCAST + 1).count() <= BROADCAST
    other = brackets.select(*(F.col(k).alias(f"__{k}") for k in keys), *(c for c in brackets.columns if c not in keys))
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    j = values.join(F.broadcast(other) if few else other, on)
    return j.where(F.col("v").between(F.col("lo"), F.col("hi"))).drop(*(f"__{k}" for k in keys))


def quantiles(values: DataFrame, by: list[str], shares: list[float]) -> DataFrame:
    """(by, n, p, value): for each group of values (by, v) its number of values and the quantile of each share p, interpolated between neighbours. NULL and NaN do not count; groups without a value are left out."""
    if not by:
        return quantiles(values.withColumn("__all", F.lit(0)), ["__all"], shares).drop("__all")
    v = written(values.select(*by, F.col("v").cast("double").alias("v")).where("v is not null and not isnan(v)"))
    g = v.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    place = F.col("p") * (F.col("n") - 1)
    wanted = g.withColumn("p", F.explode(F.array(*map(F.lit, map(float, shares))))).withColumn("rank", F.explode(F.array_distinct(F.array(F.floor(place), F.ceil(place)))))
    todo = written(wanted.select(*by, "rank", "lo", "hi", F.lit(0).cast("bigint").alias("below"), F.col("n").alias("size")).distinct())
    done, keys = [], [*by, "rank"]
    while True:
        done.append(todo.where("lo = hi").select(*keys, F.col("lo").alias("v")))
        few = _at(v, todo.where(f"lo < hi and size <= {FEW}"), by)
        nth = F.row_number().over(Window.partitionBy(*keys).orderBy("v"))
        done.append(few.withColumn("nth", nth).where(F.col("nth") == F.col("rank") - F.col("below") + 1).select(*keys, "v"))
        open_ = todo.where(f"lo < hi and size > {FEW}")
        if not open_.limit(1).count():
            break
        wide = F.col("hi") - F.col("lo")
        k = F.least(F.lit(BINS - 1), F.floor((F.col("v") - F.col("lo")) / wide * BINS)).cast("int")
        h = _at(v, open_, by).groupBy(*keys, "below", k.alias("bin")).agg(F.count(F.lit(1)).alias("size"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        up = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        h = h.withColumn("below", F.col("below") + F.coalesce(F.sum("size").over(up), F.lit(0)))
        todo = written(h.where((F.col("below") <= F.col("rank")) & (F.col("rank") < F.col("below") + F.col("size"))).select(*keys, "lo", "hi", "below", "size"))
    found = done[0]
    for more in done[1:]:
        found = found.union(more)
    found = written(found)
    asked = written(wanted.select(*by, "n", "p", "rank", (place - F.floor(place)).alias("part"), (F.col("rank") == F.floor(place)).alias("first")))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in keys]
    j = asked.join(found.select(*(F.col(c).alias(f"__{c}") for c in keys), "v"), same)
    low, high = F.max(F.when(F.col("first"), F.col("v"))), F.max(F.when(~F.col("first"), F.col("v")))
    out = written(j.groupBy(*by, "n", "p").agg(F.when(high.isNull(), low).otherwise(low * (1 - F.max("part")) + high * F.max("part")).alias("value")))
    dropped(v)
    return out


def suppressed(boxes: DataFrame, key: str, group: str, rank: str, share: float = 0.5) -> DataFrame:
    """boxes (key, group, rank, x0, y0, x1, y1) that stay when each group is gone through by rank and a box goes if an earlier one that stays covers at least a share of it. Ranks of a group are distinct.

    Rounds over the graph of covers instead of the loop: a box all of whose covers are gone stays, one with a cover that stays goes.
    """
    b = written(boxes)
    side = b.agg(F.max(F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))).alias("s")).first()["s"]
    if not side:
        return b
    cut = lambda x: F.floor(F.col(x) / side)
    dealt = b.withColumn("__bx", F.explode(F.sequence(cut("x0"), cut("x1")))).withColumn("__by", F.explode(F.sequence(cut("y0"), cut("y1"))))
    one, two = (dealt.select(group, "__bx", "__by", *(F.col(c).alias(f"{c}_{s}") for c in (key, rank, "x0", "y0", "x1", "y1"))) for s in "ab")
    both = lambda q: F.greatest(F.lit(0.0), F.least(f"{q}1_a", f"{q}1_b") - F.greatest(f"{q}0_a", f"{q}0_b"))
    area = (F.col("x1_b") - F.col("x0_b")) * (F.col("y1_b") - F.col("y0_b"))
    pairs = one.join(two, [group, "__bx", "__by"]).where((F.col(f"{rank}_a") < F.col(f"{rank}_b")) & (both("x") * both("y") >= share * area))
    covers = written(pairs.select(F.col(f"{key}_a").alias("a"), F.col(f"{key}_b").alias("b")).distinct())
    state = written(b.select(F.col(key).alias("node"), F.lit(None).cast("boolean").alias("stays")))
    while True:
        of_a = state.select(F.col("node").alias("a"), F.col("stays").alias("a_stays"))
        seen = covers.join(of_a, "a").groupBy("b").agg(F.bool_or("a_stays").alias("covered"), F.count_if(F.col("a_stays").isNull()).alias("open"))
        j = state.join(seen, state["node"] == seen["b"], "left")
        told = F.when(F.col("stays").isNotNull(), F.col("stays")).when(F.col("covered"), False).when(F.coalesce("open", F.lit(0)) == 0, True)
        new = written(j.select("node", told.alias("stays")))
        dropped(state)
        state = new
        if not state.where("stays is null").limit(1).count():
            break
    return b.join(state.where("stays").select(F.col("node").alias(key)), key, "left_semi")
