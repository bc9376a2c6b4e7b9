"""Grids: resampling, composites, offsets between dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundshift.operators.components import written
from groundshift.operators.selection import quantiles


def nearest(target: DataFrame, source: DataFrame, value: str, size: float, source_size: float, x0: float = 0.0, y0: float = 0.0, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, r, c, value): each target cell takes the source cell that holds its centre; NULL outside."""
    at = lambda n, o: F.floor(((F.col(n) + 0.5) * size - o) / source_size).cast("int")
    t = target.select(*by, "r", "c", at("r", y0).alias("sr"), at("c", x0).alias("sc"))
    return t.join(source.select(*by, F.col("r").alias("sr"), F.col("c").alias("sc"), value), [*by, "sr", "sc"], "left").select(*by, "r", "c", value)


def bilinear(target: DataFrame, source: DataFrame, value: str, size: float, source_size: float, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, r, c, value): weighted mean of the four nearest source centres, over those that are there."""
    y, x = (F.col("r") + 0.5) * size / source_size - 0.5, (F.col("c") + 0.5) * size / source_size - 0.5
    t = target.select(*by, "r", "c", y.alias("y"), x.alias("x")).withColumn("d", F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)))))
    fy, fx = F.col("y") - F.floor("y"), F.col("x") - F.floor("x")
    w = F.when(F.col("d.i") == 1, fy).otherwise(1 - fy) * F.when(F.col("d.j") == 1, fx).otherwise(1 - fx)
    t = t.select(*by, "r", "c", (F.floor("y") + F.col("d.i")).cast("int").alias("sr"), (F.floor("x") + F.col("d.j")).cast("int").alias("sc"), w.alias("w"))
    j = t.join(source.where(F.col(value).isNotNull()).select(*by, F.col("r").alias("sr"), F.col("c").alias("sc"), value), [*by, "sr", "sc"])
    return j.groupBy(*by, "r", "c").agg((F.sum(F.col("w") * F.col(value)) / F.nullif(F.sum("w"), F.lit(0.0))).alias(value))


def median_composite(scenes: DataFrame, value: str, least: int = 2) -> DataFrame:
    """(r, c, epoch, value, n): median of the observations of a cell and epoch, NULL below least."""
    return scenes.groupBy("r", "c", "epoch").agg(F.when(F.count(value) >= least, F.median(value)).alias(value), F.count(value).alias("n"))


def offsets(pairs: DataFrame, size: float, most: int = 2) -> DataFrame:
    """(k, dy, dx, displacement, quality, n): by how many cells the second date of each pair k is moved against the first, from the correlation at all shifts of up to most cells.

    pairs: (k, r, c, v, w), v of the first and w of the second date. The moments of all shifts are one aggregation. The peak is set between cells by a parabola through
    its neighbours; offsets are NULL where it lies at the border of the shifts (no convergence). quality is the correlation at the peak.
    """
    span = F.sequence(F.lit(-most), F.lit(most))
    a = pairs.where("v is not null").select("k", "r", "c", "v", F.explode(span).alias("dy")).select("k", "r", "c", "v", "dy", F.explode(span).alias("dx"))
    a = a.select("k", (F.col("r") + F.col("dy")).alias("r"), (F.col("c") + F.col("dx")).alias("c"), "v", "dy", "dx")
    g = a.join(pairs.where("w is not null").select("k", "r", "c", "w"), ["k", "r", "c"]).groupBy("k", "dy", "dx").agg(F.round(F.corr("v", "w"), 9).alias("corr"), F.count(F.lit(1)).alias("n"))
    far = F.col("dy") * F.col("dy") + F.col("dx") * F.col("dx")
    best = F.max_by(F.struct("dy", "dx", "corr", "n"), F.struct("corr", -far, -F.col("dy"), -F.col("dx")))
    j = g.where("corr is not null").groupBy("k").agg(best.alias("b"), F.map_from_entries(F.collect_list(F.struct(F.struct("dy", "dx"), F.col("corr")))).alias("all"))
    at = lambda y, x: F.try_element_at("all", F.struct((F.col("b.dy") + y).cast("int").alias("dy"), (F.col("b.dx") + x).cast("int").alias("dx")))

    def between(low: Column, high: Column) -> Column:
        return (low - high) / (2 * (low - 2 * F.col("b.corr") + high))

    inner = (F.abs("b.dy") < most) & (F.abs("b.dx") < most)
    dy, dx = F.when(inner, F.col("b.dy") + between(at(-1, 0), at(1, 0))), F.when(inner, F.col("b.dx") + between(at(0, -1), at(0, 1)))
    return j.select("k", dy.alias("dy"), dx.alias("dx"), (size * F.sqrt(dy * dy + dx * dx)).alias("displacement"), F.col("b.corr").alias("quality"), F.col("b.n").alias("n"))


def robust_change(changes: DataFrame) -> DataFrame:
    """(k, r, c, score): length of the vector of robust z-scores of changes (k, r, c, band, d), over its 99th percentile of the pair k, clipped to [0, 1]. A band without a median deviation
    counts by its standard deviation, one without that not at all."""
    d = written(changes)
    keys = ["k", "band"]
    middle = quantiles(d.select(*keys, F.col("d").alias("v")), keys, [0.5]).select(*keys, F.col("value").alias("m"))
    away = d.join(middle, keys)
    wide = quantiles(away.select(*keys, F.abs(F.col("d") - F.col("m")).alias("v")), keys, [0.5]).select(*keys, (F.col("value") * 1.4826).alias("s"))
    other = d.groupBy(*keys).agg(F.stddev_pop("d").alias("sd"))
    scale = F.when(F.col("s") > 0, F.col("s")).otherwise(F.col("sd"))
    z = away.join(wide, keys).join(other, keys).withColumn("z", F.when(scale > 0, (F.col("d") - F.col("m")) / scale).otherwise(0.0))
    mag = written(z.groupBy("k", "r", "c").agg(F.sqrt(F.sum(F.col("z") * F.col("z"))).alias("mag")))
    top = quantiles(mag.select("k", F.col("mag").alias("v")), ["k"], [0.99]).select("k", F.col("value").alias("top"))
    return mag.join(top, "k").select("k", "r", "c", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide("mag", "top"), F.lit(0.0)))).alias("score"))


def stretched(df: DataFrame, value: str, low: float = 0.02, high: float = 0.98) -> DataFrame:
    """df with value stretched to [0, 1] between two percentiles; a flat band uses a width of one."""
    q = quantiles(df.select(F.col(value).alias("v")), [], [low, high]).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    wide = F.when(F.col("hi") > F.col("lo"), F.col("hi") - F.col("lo")).otherwise(F.lit(1.0))
    return df.join(F.broadcast(q)).withColumn("stretched", F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col(value) - F.col("lo")) / wide))).drop("lo", "hi")
