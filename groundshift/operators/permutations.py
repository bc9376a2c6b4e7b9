"""Permutation tests of spatial statistics without a row for each point and permutation.

Points are numbered in the order of a hash of their key, so their places say nothing about where they lie. Permutation s is the bijection place -> (a(s) * place + b(s)) mod n
of these numbers, with a(s) prime to n; rows are dealt to groups, and each group gets the values of all places, one number a place, by a
shuffle of blocks; a row then computes all its permutations, and what is added up from row to row is one number for each permutation. No value passes the driver. There are n * phi(n) such bijections: enough for hundreds of permutations of some hundred points, while for a few dozen points some come twice. For the conditional test of a point, its neighbours are drawn from the other n - 1 places in the same way.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundshift.operators.components import written
from groundshift.operators.ranking import numbered

#: Rows of one group on average (BROADCAST: each group gets all values), groups for each core at least, values of one block and rows that are worked on at a time.
BROADCAST, GROUPS, VALUES, ROWS = 250_000, 2, 1 << 16, 8192


def multipliers(n: int, permutations: int, seed: int) -> list[tuple[int, int]]:
    """a and b of each permutation of n places, never the identity; a is the first number prime to n from a pseudo-random one on."""
    out = []
    for s in range(1, permutations + 1):
        a = 1 + (s * s * 7919 + s * 104729 + seed) % n
        while math.gcd(a, n) != 1:
            a += 1
        b = (s * 15485863 + seed) % n
        out.append((a, 1 if n > 1 and a % n == 1 and b == 0 else b))
    return out


def _placed(points: DataFrame, value: str, key: str) -> DataFrame:
    """(id, v, place): places from 0 on in the order of a hash."""
    p = points.where(F.col(value).isNotNull()).select(F.col(key).alias("id"), F.col(value).cast("double").alias("v"), F.sha2(F.col(key).cast("string"), 256).alias("h"))
    return numbered(p, [F.col("h"), F.col("id")], "place").select("id", "v", (F.col("place") - 1).alias("place"))


def _permuted(rows: DataFrame, placed: DataFrame, n: int, task, schema: str) -> DataFrame:
    """task(rows of a group as a table, values of all n places as an array) of each group of rows."""
    groups = max(GROUPS * rows.sparkSession.sparkContext.defaultParallelism, -(-n // max(1, BROADCAST)))
    blocks = placed.groupBy(F.floor(F.col("place") / VALUES).alias("block")).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "v"))), lambda x: x["v"]).alias("v"))
    blocks = written(blocks).select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), "block", "v")

    def whole(own, values):
        return task(own, values.sort_by("block")["v"].combine_chunks().flatten().to_numpy())

    own = rows.withColumn("group", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int"))
    return own.repartition(groups, "group").groupBy("group").cogroup(blocks.repartition(groups, "group").groupBy("group")).applyInArrow(whole, schema)


def morans_i(points: DataFrame, edges: DataFrame, value: str, key: str = "id", permutations: int = 999, seed: int = 42) -> DataFrame:
    """One row: n, moran_i (row-standardized neighbours), p_sim and z_sim against permutations of all values; NULLs where there are not more points than neighbours."""
    placed = written(_placed(points, value, key))
    n = placed.count()
    most = edges.agg(F.max("rank")).first()[0] or 0
    if n < most + 1 or n < 2:
        return points.sparkSession.range(1).select(F.lit(n).cast("bigint").alias("n"), *(F.lit(None).cast("double").alias(c) for c in ("moran_i", "p_sim", "z_sim")))
    mean = placed.agg(F.avg("v").alias("m"))
    z = placed.join(F.broadcast(mean)).select("id", (F.col("v") - F.col("m")).alias("v"), "place")
    own, other = z.select("id", "place"), z.select(F.col("id").alias("other"), F.col("place").alias("to"))
    rows = edges.select("id", "other").join(other, "other").groupBy("id").agg(F.array_sort(F.collect_list("to")).alias("to")).join(own, "id")
    pairs, most = [(1, 0), *multipliers(n, permutations, seed)], ROWS  # permutation 0 leaves all as it is

    def task(own, values):
        import numpy as np
        import pyarrow as pa

        total = np.zeros(len(pairs))
        if own.num_rows:
            place, to = own["place"].to_numpy(), own["to"].combine_chunks()
            size = to.value_lengths().to_numpy()
            flat, ends = to.flatten().to_numpy(), np.r_[0, np.cumsum(size)]
            for i in range(0, len(place), most):
                j = min(i + most, len(place))
                p, t, start = place[i:j], flat[ends[i] : ends[j]], ends[i:j] - ends[i]
                for s, (a, b) in enumerate(pairs):
                    total[s] += (values[(p * a + b) % n] * np.add.reduceat(values[(t * a + b) % n], start) / size[i:j]).sum()
        return pa.table({"s": pa.array(np.arange(len(pairs), dtype=np.int32)), "x": pa.array(total)})

    sums = _permuted(rows, z, n, task, "s int, x double").groupBy("s").agg(F.sum("x").alias("x"))
    scale = z.agg(F.sum(F.col("v") * F.col("v")).alias("s2"))
    i = sums.join(F.broadcast(scale)).select("s", F.round(F.try_divide("x", "s2"), 12).alias("i"))
    first = i.where("s = 0").select(F.col("i").alias("moran_i"))
    t = i.where("s > 0").join(F.broadcast(first)).groupBy("moran_i").agg(F.count_if(F.col("i") >= F.col("moran_i")).alias("above"), F.avg("i").alias("mean"), F.stddev_pop("i").alias("sd"))
    p = (F.least("above", permutations - F.col("above")) + 1) / (permutations + 1.0)
    return t.select(F.lit(n).cast("bigint").alias("n"), "moran_i", p.alias("p_sim"), F.try_divide(F.col("moran_i") - F.col("mean"), F.col("sd")).alias("z_sim"))


def getis_ord(points: DataFrame, edges: DataFrame, value: str, key: str = "id", permutations: int = 999, seed: int = 42) -> DataFrame:
    """(id, above, p_sim): how many of the permutations give a sum of neighbours at least as large, the point itself staying where it is, and the folded pseudo p-value."""
    placed = written(_placed(points, value, key))
    n = placed.count()
    most = edges.agg(F.max("rank")).first()[0] or 0
    if n < most + 1 or n < 3:
        return points.select(F.col(key).alias("id"), F.lit(None).cast("bigint").alias("above"), F.lit(None).cast("double").alias("p_sim"))
    value_of = placed.select(F.col("id").alias("other"), F.col("v").alias("w"))
    rows = edges.select("id", "other").join(value_of, "other").groupBy("id").agg(F.sum("w").alias("sum"), F.count(F.lit(1)).alias("k")).join(placed.select("id", "place"), "id")
    pairs, most = multipliers(n - 1, permutations, seed), ROWS

    def task(own, values):
        import numpy as np
        import pyarrow as pa

        place, k, total = own["place"].to_numpy(), own["k"].to_numpy(), own["sum"].to_numpy()
        above = np.zeros(len(place), np.int64)
        for i in range(0, len(place), most):
            p, size, least = place[i : i + most], k[i : i + most], np.round(total[i : i + most], 9)
            for a, b in pairs:
                x = np.zeros(len(p))
                for m in range(1, int(size.max()) + 1):
                    x += np.where(size >= m, values[(p + 1 + (m * a + b + p * 7) % (n - 1)) % n], 0.0)
                above[i : i + most] += np.round(x, 9) >= least
        return pa.table({"id": own["id"], "above": pa.array(above)})

    j = _permuted(rows, placed, n, task, f"id {points.schema[key].dataType.simpleString()}, above bigint")
    return j.select("id", "above", ((F.least("above", permutations - F.col("above")) + 1) / (permutations + 1.0)).alias("p_sim"))
