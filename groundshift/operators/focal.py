"""Focal operators: windows around a cell. A box is separable: sums along rows, then along columns; borders mirror.

Each cell is dealt to a tile of TILE cells a side, with a halo from its neighbours, so no window partition is larger than a tile's row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundshift.operators.components import cell_components, written
from groundshift.operators.selection import quantiles

TILE = 512


def mirrored(cells: DataFrame, half: int, height: int, width: int) -> DataFrame:
    """cells (r, c, ...) and their mirror images within half beyond the border (d c b a | a b c d), each given to the tiles it touches: (tr, tc, r, c, ...)."""
    images = lambda x, n: F.filter(F.array(F.col(x), -F.col(x) - 1, F.lit(2 * n - 1) - F.col(x)), lambda v: (v >= -half) & (v < n + half))
    rest = [x for x in cells.columns if x not in ("r", "c")]
    m = cells.select(*rest, F.explode(images("r", height)).alias("r"), "c").select(*rest, "r", F.explode(images("c", width)).alias("c"))
    tiles = lambda x, n: F.array_distinct(F.transform(F.array(F.col(x) - half, F.col(x), F.col(x) + half), lambda v: F.floor(F.least(F.lit(n - 1), F.greatest(F.lit(0), v)) / TILE).cast("int")))
    m = m.select(*rest, "r", "c", F.explode(tiles("r", height)).alias("tr"))
    return m.select(*rest, "r", "c", "tr", F.explode(tiles("c", width)).alias("tc"))


def _own(height: int, width: int) -> Column:
    """Cells of a tile that are its own and no images."""
    return (F.floor(F.col("r") / TILE) == F.col("tr")) & (F.floor(F.col("c") / TILE) == F.col("tc")) & F.col("r").between(0, height - 1) & F.col("c").between(0, width - 1)


def box(cells: DataFrame, half: int, height: int, width: int, fold=F.sum, by: tuple[str, ...] = (), **values: Column) -> DataFrame:
    """cells with each value folded (sum, min or max) over the (2 half + 1) square around it. cells: a full (r, c) grid, or one for each of by."""
    m = mirrored(cells.select(*by, "r", "c", *(v.alias(k) for k, v in values.items())), half, height, width)
    along = Window.partitionBy(*by, "tr", "tc", "r").orderBy("c").rangeBetween(-half, half)
    m = m.select(*by, "tr", "tc", "r", "c", *(fold(k).over(along).alias(k) for k in values))
    down = Window.partitionBy(*by, "tr", "tc", "c").orderBy("r").rangeBetween(-half, half)
    m = m.select(*by, "tr", "tc", "r", "c", *(fold(k).over(down).alias(k) for k in values))
    return m.where(_own(height, width)).select(*by, "r", "c", *values)


def ssim_change(pairs: DataFrame, height: int, width: int, window: int = 7, span: float | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, r, c, score): 1 - structural similarity of g1 and g2, clipped to [0, 1]. The span of values is that of each of by, if not given."""
    a, b = F.col("g1"), F.col("g2")
    s = box(pairs, window // 2, height, width, by=by, sa=a, sb=b, saa=a * a, sbb=b * b, sab=a * b)
    if span is None:
        wide = (F.greatest(F.max("g1"), F.max("g2")) - F.least(F.min("g1"), F.min("g2"))).cast("double")
        one = pairs.groupBy(*by).agg(F.when(wide > 0, wide).otherwise(1.0).alias("span"))
        s = s.join(F.broadcast(one), list(by)) if by else s.join(F.broadcast(one))
    else:
        s = s.withColumn("span", F.lit(float(span)))
    n = float(window * window)
    ua, ub = F.col("sa") / n, F.col("sb") / n
    fix = n / (n - 1)
    va, vb, vab = fix * (F.col("saa") / n - ua * ua), fix * (F.col("sbb") / n - ub * ub), fix * (F.col("sab") / n - ua * ub)
    c1, c2 = F.pow(0.01 * F.col("span"), F.lit(2)), F.pow(0.03 * F.col("span"), F.lit(2))
    ssim = ((2 * ua * ub + c1) * (2 * vab + c2)) / ((ua * ua + ub * ub + c1) * (va + vb + c2))
    return s.select(*by, "r", "c", F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - ssim)).alias("score"))


def opened(mask: DataFrame, k: int, height: int, width: int, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, r, c, on) after erosion and then dilation with a k x k square. mask: a full grid with on in {0, 1}, or one for each of by."""
    half = k // 2
    return box(box(mask, half, height, width, F.min, by, on=F.col("on")), half, height, width, F.max, by, on=F.col("on"))


def closed(mask: DataFrame, k: int, height: int, width: int, by: tuple[str, ...] = ()) -> DataFrame:
    """The same after dilation and then erosion."""
    half = k // 2
    return box(box(mask, half, height, width, F.max, by, on=F.col("on")), half, height, width, F.min, by, on=F.col("on"))


def gradient(cells: DataFrame, value: str, height: int, width: int, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, r, c, gx, gy) of the 3 x 3 Sobel operator; the cells of the border count twice."""
    m = mirrored(cells.select(*by, "r", "c", F.col(value).alias("v")), 1, height, width)
    along = Window.partitionBy(*by, "tr", "tc", "r").orderBy("c")
    m = m.select(*by, "tr", "tc", "r", "c", (F.lead("v").over(along) - F.lag("v").over(along)).alias("dx"), (F.lag("v").over(along) + 2 * F.col("v") + F.lead("v").over(along)).alias("sm"))
    down = Window.partitionBy(*by, "tr", "tc", "c").orderBy("r")
    m = m.select(*by, "tr", "tc", "r", "c", (F.lag("dx").over(down) + 2 * F.col("dx") + F.lead("dx").over(down)).alias("gx"), (F.lead("sm").over(down) - F.lag("sm").over(down)).alias("gy"))
    return m.where(_own(height, width)).select(*by, "r", "c", "gx", "gy")


def sobel(cells: DataFrame, value: str, height: int, width: int, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, r, c, magnitude) of the 3 x 3 Sobel gradient."""
    return gradient(cells, value, height, width, by).select(*by, "r", "c", F.sqrt(F.col("gx") * F.col("gx") + F.col("gy") * F.col("gy")).alias("magnitude"))


def gradient_change(dates: DataFrame, value: str, height: int, width: int, spread: int = 2) -> DataFrame:
    """(k, r, c, score): how far the Sobel magnitudes of a date (k) and the one before differ. Each date's are divided by their 99th percentile and cut at 1; the differences are averaged over
    2 spread + 1 cells each way and divided by their own 99th percentile. A percentile of 0 gives 0 for a date and leaves differences as they are."""
    peak = lambda d, x: quantiles(d.select("k", F.col(x).alias("v")), ["k"], [0.99]).select("k", F.col("value").alias("peak"))
    cut = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(x) / F.col("peak")))
    m = written(sobel(dates, value, height, width, by=("k",)))
    m = m.join(F.broadcast(peak(m, "magnitude")), "k").withColumn("m", F.when(F.col("peak") > 0, cut("magnitude")).otherwise(0.0))  # one percentile for each date
    d = m.withColumn("d", F.abs(F.col("m") - F.lag("m").over(Window.partitionBy("r", "c").orderBy("k")))).where("d is not null").select("k", "r", "c", "d")
    n = float((2 * spread + 1) ** 2)
    w = written(box(d, spread, height, width, by=("k",), s=F.col("d")).select("k", "r", "c", (F.col("s") / n).alias("s")))
    return w.join(F.broadcast(peak(w, "s")), "k").select("k", "r", "c", F.when(F.col("peak") > 0, cut("s")).otherwise(F.col("s")).alias("score"))


#: Tangent of 22.5 degrees, as a fraction of 2^15; directions flatter than it are horizontal, steeper than its complement vertical.
_FLAT = 13573


def edges(cells: DataFrame, value: str, height: int, width: int, low: int = 50, high: int = 150, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, r, c) of the edge cells of a grid of whole numbers from 0 to 255: gradients by their sum of absolute parts, only those that are largest along their direction, and of these
    all that are above high or hang together with one that is, over cells above low. Cells outside of the grid have no gradient."""
    g = gradient(cells, value, height, width, by).withColumn("mag", F.abs("gx") + F.abs("gy"))
    m = mirrored(g, 1, height, width)
    m = m.withColumn("mag", F.when(F.col("r").between(0, height - 1) & F.col("c").between(0, width - 1), F.col("mag")).otherwise(0))
    along = Window.partitionBy(*by, "tr", "tc", "r").orderBy("c")
    m = m.withColumns({"west": F.lag("mag").over(along), "east": F.lead("mag").over(along)})
    down = Window.partitionBy(*by, "tr", "tc", "c").orderBy("r")
    m = m.withColumns({"n": F.lag("mag").over(down), "s": F.lead("mag").over(down), "nw": F.lag("west").over(down), "ne": F.lag("east").over(down), "sw": F.lead("west").over(down), "se": F.lead("east").over(down)})
    ax, ay = F.abs("gx").cast("bigint"), F.abs("gy").cast("bigint") * (1 << 15)
    flat, steep = ay < ax * _FLAT, ay > ax * _FLAT + ax * (1 << 16)
    x = F.col("mag")
    falling = (F.col("gx") < 0) != (F.col("gy") < 0)
    peak = F.when(flat, (x > F.col("west")) & (x >= F.col("east"))).when(steep, (x > F.col("n")) & (x >= F.col("s"))).when(falling, (x > F.col("ne")) & (x > F.col("sw"))).otherwise((x > F.col("nw")) & (x > F.col("se")))
    kept = written(m.where(_own(height, width) & (x > low) & peak).select(*by, "r", "c", (x > high).alias("strong")))
    comp = written(kept.join(cell_components(kept.select(*by, "r", "c"), list(by), eight=True), [*by, "r", "c"]))
    return comp.join(comp.where("strong").select(*by, "comp").distinct(), [*by, "comp"]).select(*by, "r", "c")


def edge_change(cells: DataFrame, height: int, width: int, low: int = 50, high: int = 150, spread: int = 5) -> DataFrame:
    """(k, r, c, score): 1 where of the edges of date k and those of the date before, widened by a square, only one is there. cells: full grids (k, r, c, v) of dates numbered one after another."""
    wide = cells.groupBy("k").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    scaled = F.when(F.col("hi") > F.col("lo"), F.floor((F.col("v") - F.col("lo")) * (F.lit(255.0) / (F.col("hi") - F.col("lo"))))).otherwise(0)
    g = written(cells.join(F.broadcast(wide), "k").select("k", "r", "c", scaled.cast("int").alias("v")))
    on = edges(g, "v", height, width, low, high, ("k",)).withColumn("on", F.lit(1))
    full = g.select("k", "r", "c").join(on, ["k", "r", "c"], "left").na.fill(0, ["on"])
    d = box(full, spread // 2, height, width, F.max, ("k",), on=F.col("on"))
    before = F.lag("on").over(Window.partitionBy("r", "c").orderBy("k"))
    return d.withColumn("before", before).where("before is not null").select("k", "r", "c", F.abs(F.col("on") - F.col("before")).cast("double").alias("score"))
