"""Exact Euclidean distance of grid cells to the nearest reference cell, in two passes.

Down each column every reference cell hands its distance to the rows that are nearer to it than to the next one; no row looks for anything. Along each row the nearest
reference is then the lowest of as many parabolas as the row has columns with a reference; their lower envelope is built once for a row and read by all its cells. A task holds one
grid row at a time, so memory is bounded by the width of the grid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def distance_transform(cells: DataFrame, reference: DataFrame) -> DataFrame:
    """cells (r, c) with d2, the squared distance in cells to the nearest cell (r, c) of reference: 0 within it, NULL if reference is empty."""
    asked = cells.select(F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c")).distinct()
    box = asked.agg(F.min("r").alias("lo"), F.max("r").alias("hi")).first()
    if box["lo"] is None:
        return asked.withColumn("d2", F.lit(None).cast("bigint"))
    down = Window.partitionBy("c").orderBy("r")
    ref = reference.select(F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c")).distinct().withColumns({"before": F.lag("r").over(down), "after": F.lead("r").over(down)})
    first = F.coalesce(F.floor((F.col("before") + F.col("r")) / 2) + 1, F.lit(box["lo"])).cast("int")
    last = F.coalesce(F.floor((F.col("r") + F.col("after")) / 2), F.lit(box["hi"])).cast("int")
    first, last = F.greatest(first, F.lit(box["lo"])), F.least(last, F.lit(box["hi"]))
    g = ref.where(first <= last).select(F.explode(F.sequence(first, last)).alias("row"), "c", "r")
    g = g.select(F.col("row").alias("r"), "c", F.abs(F.col("row") - F.col("r")).cast("bigint").alias("g"))

    def task(batches):
        import numpy as np
        import pyarrow as pa

        def told(c, g):
            """Squared distances of the places of c that carry no g."""
            at, f = c[g >= 0], g[g >= 0] ** 2
            want = c[g < 0]
            if not len(at):
                return want, np.full(len(want), -1)
            low, edge = [], []
            for x, fx in zip(at.tolist(), f.tolist()):
                s = -float("inf")
                while low:
                    v, fv = low[-1]
                    s = ((fx + x * x) - (fv + v * v)) / (2 * (x - v))
                    if s > edge[-1]:
                        break
                    low.pop()
                    edge.pop()
                    s = -float("inf")
                low.append((x, fx))
                edge.append(s)
            v, fv = np.array(low, np.int64).T
            k = np.searchsorted(np.array(edge), want, "right") - 1
            return want, (want - v[k]) ** 2 + fv[k]

        def row(r, parts):
            c, g = (np.concatenate(x) for x in zip(*parts))
            want, d2 = told(c, g)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(want), r, np.int32)), pa.array(want.astype(np.int32)), pa.array(d2, mask=d2 < 0, type=pa.int64())], ["r", "c", "d2"])

        now, parts = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            r, c, g = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            for a, z in zip(*(lambda e: (e[:-1], e[1:]))(np.r_[0, np.flatnonzero(r[1:] != r[:-1]) + 1, len(r)])):
                if parts and r[a] != now:
                    yield row(now, parts)
                    parts = []
                now = r[a]
                parts.append((c[a:z].astype(np.int64), g[a:z].astype(np.int64)))
        if parts:
            yield row(now, parts)

    both = g.union(asked.select("r", "c", F.lit(-1).cast("bigint").alias("g")))
    return both.repartition("r").sortWithinPartitions("r", "c").mapInArrow(task, "r int, c int, d2 bigint")
