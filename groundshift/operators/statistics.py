"""Statistics over results: confusion, thresholds, samples, agreement, neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundshift.operators.components import written


def confusion(df: DataFrame, truth: Column, pred: Column, *by: str) -> DataFrame:
    """tp, fp, fn, tn, precision, recall, f1 and accuracy; NULL where a denominator is 0."""
    tp, fp, fn, tn = F.count_if(truth & pred), F.count_if(~truth & pred), F.count_if(truth & ~pred), F.count_if(~truth & ~pred)
    g = df.groupBy(*by).agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"))
    c = F.col
    return g.withColumns({
        "precision": F.round(F.try_divide(c("tp"), c("tp") + c("fp")), 6),
        "recall": F.round(F.try_divide(c("tp"), c("tp") + c("fn")), 6),
        "f1": F.round(F.try_divide(2 * c("tp"), 2 * c("tp") + c("fp") + c("fn")), 6),
        "accuracy": F.round(F.try_divide(c("tp") + c("tn"), c("tp") + c("fp") + c("fn") + c("tn")), 6),
    })


def otsu(df: DataFrame, value: str, bins: int = 256) -> DataFrame:
    """One row: the threshold that parts a histogram best; NULL if there is nothing to part. Only the histogram (bins rows) is windowed in one task."""
    edge = df.agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"))
    b = df.where(F.col(value).isNotNull()).join(F.broadcast(edge)).where("hi > lo")
    b = b.groupBy(F.least(F.lit(bins - 1), F.floor((F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)).cast("int").alias("bin"), "lo", "hi").agg(F.count(F.lit(1)).alias("n"))
    up, every = Window.orderBy("bin"), Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = b.withColumns({"w0": F.sum("n").over(up), "m0": F.sum(F.col("n") * F.col("bin")).over(up), "w": F.sum("n").over(every), "m": F.sum(F.col("n") * F.col("bin")).over(every)})
    between = F.col("w0") * (F.col("w") - F.col("w0")) * F.pow(F.col("m0") / F.col("w0") - (F.col("m") - F.col("m0")) / F.nullif(F.col("w") - F.col("w0"), F.lit(0)), F.lit(2))
    s = s.withColumn("between", F.round(F.coalesce(between, F.lit(0.0)), 3))
    return s.agg(F.max_by("bin", F.struct("between", -F.col("bin"))).alias("bin"), F.first("lo").alias("lo"), F.first("hi").alias("hi")).select("bin", (F.col("lo") + (F.col("bin") + 1) * (F.col("hi") - F.col("lo")) / bins).alias("threshold"))


def seeded_order(*keys: str, seed: int) -> Column:
    return F.sha2(F.concat_ws(":", *(F.col(k).cast("string") for k in keys), F.lit(str(seed))), 256)


def stratified(df: DataFrame, stratum: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows of each stratum (all, if there are fewer), always the same ones for a seed."""
    order = Window.partitionBy(stratum).orderBy(seeded_order(key, seed=seed), key)
    return df.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= n)


def validation_split(key: Column, folds: int = 5) -> Column:
    """True for about one in folds, by a hash of the group's key, so that a group is never split."""
    return F.conv(F.substring(F.sha2(key.cast("string"), 256), 1, 4), 16, 10).cast("int") % folds == 0


#: Rows of a task that looks for neighbours, and distances that are worked out at a time.
TASK_ROWS, DISTANCES = 500_000, 1 << 20


def _nearest(k: int, reach: float):
    """The task of whole cells, one after another: (cx, cy, asks, key, x, y) in the order of cells and keys to (id, other, d2, rank, full). It holds one cell's candidates and needs nothing of this package."""
    most = DISTANCES

    def task(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def told(parts):
            t = pa.Table.from_batches(parts)
            key, x, y = t.column(3).combine_chunks(), t.column(4).to_numpy(), t.column(5).to_numpy()
            asks = t.column(2).to_numpy()
            code = np.r_[0, np.cumsum(np.asarray(pc.not_equal(key[1:], key[:-1])))]  # equal keys have one number
            of, to = np.flatnonzero(asks), np.flatnonzero(~asks)
            step = max(1, most // max(1, len(to)))
            for i in range(0, len(of) if len(to) else 0, step):
                q = of[i : i + step]
                dx, dy = x[q][:, None] - x[to], y[q][:, None] - y[to]
                d = dx * dx + dy * dy
                d[(code[q][:, None] == code[to]) | ~(d <= reach * reach)] = np.inf
                last = np.partition(d, k - 1, 1)[:, k - 1] if len(to) > k else np.full(len(q), np.inf)
                row, at = np.nonzero((d <= last[:, None]) & np.isfinite(d))
                far = d[row, at]
                order = np.lexsort((at, far, row))  # of equally near ones the least key
                row, at, far = row[order], at[order], far[order]
                rank = np.arange(len(row)) - np.searchsorted(row, row) + 1
                keep = rank <= k
                row, at, far, rank = row[keep], at[keep], far[keep], rank[keep]
                full = (np.bincount(row, minlength=len(q)) == k)[row]
                yield pa.RecordBatch.from_arrays([key.take(pa.array(q[row])), key.take(pa.array(to[at])), pa.array(far), pa.array(rank.astype(np.int32)), pa.array(full)], ["id", "other", "d2", "rank", "full"])

        now, parts = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            cx, cy = (batch.column(c).to_numpy() for c in range(2))
            cut = np.flatnonzero((cx[1:] != cx[:-1]) | (cy[1:] != cy[:-1])) + 1
            for i, j in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
                if parts and (cx[i], cy[i]) != now:
                    yield from told(parts)
                    parts = []
                now = (cx[i], cy[i])
                parts.append(batch.slice(i, j - i))
        if parts:
            yield from told(parts)

    return task


def neighbours(points: DataFrame, k: int, cell: float, key: str = "id") -> DataFrame:
    """(id, other, d2, rank): the k nearest others. Candidates are in the 3 x 3 cells around a point; a ring that may be too small is widened until
    each point has k neighbours nearer than the ring's edge, so the result is exact. Rounds end, as rings double up to the extent. Pairs are compared within a cell and only the nearest leave it;
    tasks grow in number with the points, not in size."""
    spark = points.sparkSession
    p = points.where("x is not null and y is not null").select(key, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    size = cell
    todo, done = p, None
    all_ = p.agg(F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("s"), F.count(F.lit(1)).alias("n")).first()
    span, waiting = all_["s"] or 0.0, all_["n"]
    of = points.schema[key].dataType.simpleString()
    while True:
        at = lambda c: F.floor(F.col(c) / size).cast("bigint")  # noqa: B023,E731
        placed = lambda d: d.withColumns({"cx": at("x"), "cy": at("y")})  # noqa: B023,E731
        around = lambda d: d.withColumn("cx", F.explode(F.sequence(F.col("cx") - 1, F.col("cx") + 1))).withColumn("cy", F.explode(F.sequence(F.col("cy") - 1, F.col("cy") + 1)))
        asked, others = placed(todo), placed(p)
        if done is None:
            others = around(others)
        else:  # few are left: only what lies around them
            wanted = asked.select("cx", "cy").distinct().withColumns({"tx": F.col("cx"), "ty": F.col("cy")})
            others = others.join(around(wanted), ["cx", "cy"]).drop("cx", "cy").withColumnsRenamed({"tx": "cx", "ty": "cy"})
        rows = asked.select("cx", "cy", F.lit(True).alias("asks"), key, "x", "y").union(others.select("cx", "cy", F.lit(False), key, "x", "y"))
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-10 * waiting // TASK_ROWS))
        near = rows.repartition(parts, "cx", "cy").sortWithinPartitions("cx", "cy", key).mapInArrow(_nearest(k, size if size < span else float("inf")), f"id {of}, other {of}, d2 double, rank int, full boolean")
        near = written(near)  # a round reads the last one's result and does not make it again
        found = near.where("full").drop("full")
        if size >= span:
            return near.drop("full") if done is None else done.unionByName(near.drop("full"))
        done = found if done is None else done.unionByName(found)
        todo = written(todo.join(found.where("rank = 1").select(F.col("id").alias(key)), key, "left_anti").select(p.columns))
        waiting = todo.count()
        if not waiting:
            return done
        size *= 2


def morans_i(points: DataFrame, edges: DataFrame, value: str, key: str = "id") -> DataFrame:
    """One row: n, global Moran's I with row-standardized neighbours, and its expectation."""
    mean = points.agg(F.avg(value).alias("mean"))
    z = points.join(F.broadcast(mean)).select(F.col(key).alias("id"), (F.col(value) - F.col("mean")).alias("z"))
    total = z.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("z") * F.col("z")).alias("s2"))
    zi, zj = z.select("id", F.col("z").alias("zi")), z.select(F.col("id").alias("other"), F.col("z").alias("zj"))
    e = edges.join(zi, "id").join(zj, "other").groupBy("id").agg(F.avg("zj").alias("lag"), F.first("zi").alias("zi"))
    return e.agg(F.sum(F.col("zi") * F.col("lag")).alias("s")).join(F.broadcast(total)).select("n", F.when(F.col("s2") > 0, F.col("s") / F.col("s2")).alias("moran_i"), (-1 / (F.col("n") - 1)).alias("expected"))


def getis_ord(points: DataFrame, edges: DataFrame, value: str, key: str = "id") -> DataFrame:
    """(id, z, class): Gi* with binary neighbours and the point itself."""
    stat = points.agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("m"), F.stddev_pop(value).alias("s"))
    v = points.select(F.col(key).alias("other"), F.col(value).alias("v"))
    own = points.select(F.col(key).alias("id"), F.col(key).alias("other"))
    g = edges.select("id", "other").unionByName(own).join(v, "other").groupBy("id").agg(F.sum("v").alias("sum"), F.count(F.lit(1)).alias("w"))
    g = g.join(F.broadcast(stat))
    spread = F.col("s") * F.sqrt((F.col("n") * F.col("w") - F.col("w") * F.col("w")) / (F.col("n") - 1))
    z = F.when(spread > 0, (F.col("sum") - F.col("m") * F.col("w")) / spread)
    kind = F.when(z >= 2.576, "HOT_99").when(z >= 1.96, "HOT_95").when(z >= 1.645, "HOT_90").when(z <= -2.576, "COLD_99").when(z <= -1.96, "COLD_95").when(z <= -1.645, "COLD_90").otherwise("NOT_SIG")
    return g.select("id", z.alias("z"), kind.alias("gi_class"))
