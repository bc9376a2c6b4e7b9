"""Coverage of features by cells, and tables of parcels made from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundshift.operators.components import written
from groundshift.operators.ranking import numbered

SIZE = 10.0
#: Score of a persistence status.
PERSISTENCE_SCORES = {"PERSISTENT": 100.0, "UNCONFIRMED": 50.0, "TEMPORARY": 30.0}


def coverage(features: DataFrame, key: str, size: float = SIZE, least: float = 1e-6) -> DataFrame:
    """(key, r, c, area): exact overlap of rectangles x0, y0, x1, y1 with the cells of a grid; no join, each feature makes its own cells."""
    last = lambda x: F.ceil(F.col(x) / size).cast("int") - 1
    first = lambda x: F.floor(F.col(x) / size).cast("int")
    f = features.select(key, "x0", "y0", "x1", "y1", F.explode(F.sequence(first("y0"), F.greatest(first("y0"), last("y1")))).alias("r"))
    f = f.withColumn("c", F.explode(F.sequence(first("x0"), F.greatest(first("x0"), last("x1")))))
    wide = F.least("x1", (F.col("c") + 1) * size) - F.greatest("x0", F.col("c") * size)
    high = F.least("y1", (F.col("r") + 1) * size) - F.greatest("y0", F.col("r") * size)
    return f.withColumn("area", wide * high).where((wide > 0) & (high > 0) & (F.col("area") > least)).select(key, "r", "c", "area")


def centre_cells(features: DataFrame, key: str, size: float = SIZE) -> DataFrame:
    """(key, r, c) of the cells whose centre lies in the feature."""
    x, y = (F.col("c") + 0.5) * size, (F.col("r") + 0.5) * size
    cells = coverage(features, key, size).join(features, key)
    return cells.where((x >= F.col("x0")) & (x < F.col("x1")) & (y >= F.col("y0")) & (y < F.col("y1"))).select(key, "r", "c")


def area_where(cover: DataFrame, cells: DataFrame, key: str, **masks: Column) -> DataFrame:
    """Area of each mask for each feature."""
    sums = [F.coalesce(F.sum(F.when(m, F.col("area"))), F.lit(0.0)).alias(name) for name, m in masks.items()]
    return cover.join(cells, ["r", "c"], "left").groupBy(key).agg(F.sum("area").alias("area_m2"), *sums)


def weighted_means(cover: DataFrame, pixels: DataFrame, key: str, value: str, by: str = "epoch") -> DataFrame:
    """Area-weighted mean, valid area and number of valid cells for each feature and epoch."""
    have = F.when(F.col(value).isNotNull(), F.col("area"))
    out = cover.join(pixels.select("r", "c", by, value), ["r", "c"]).groupBy(key, by).agg(F.sum(have * F.col(value)).alias("s"), F.coalesce(F.sum(have), F.lit(0.0)).alias("valid_area"), F.count(value).alias("n_valid"))
    return out.select(key, by, F.when(F.col("valid_area") > 0, F.col("s") / F.col("valid_area")).alias("mean"), "valid_area", "n_valid")


def weighted_median(cover: DataFrame, pixels: DataFrame, key: str, value: str, by: str = "epoch") -> DataFrame:
    """First value whose cumulative weight reaches half of the total."""
    w = Window.partitionBy(key, by)
    j = cover.join(pixels.select("r", "c", by, value).where(F.col(value).isNotNull()), ["r", "c"])
    j = j.withColumns({"run": F.sum("area").over(w.orderBy(value, "r", "c")), "whole": F.sum("area").over(w)})
    return j.where(F.col("run") >= F.col("whole") / 2).groupBy(key, by).agg(F.min(value).alias("median"))


def priority(parcels: DataFrame, full_ratio: float = 0.5, near: float = 0.0, far: float = 500.0, weights: tuple[float, float, float] = (0.4, 0.35, 0.25), high: float = 60.0, medium: float = 40.0, least_area: float = 300.0) -> DataFrame:
    """Scores from 0 to 100 of decline ratio, persistence and distance to rail, their weighted mean, and a rank among candidates."""
    clamp = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
    persistence = F.coalesce(F.create_map(*(F.lit(x) for kv in PERSISTENCE_SCORES.items() for x in kv))[F.col("persistence_status")], F.lit(0.0))
    out = parcels.withColumns({
        "score_ratio": clamp(F.coalesce("decline_ratio", F.lit(0.0)) / full_ratio) * 100,
        "score_persistence": persistence,
        "score_rail": F.coalesce(clamp((far - F.col("rail_distance")) / (far - near)) * 100, F.lit(0.0)),
    })
    a, b, c = weights
    out = out.withColumn("priority_score", (a * F.col("score_ratio") + b * F.col("score_persistence") + c * F.col("score_rail")) / (a + b + c))
    out = out.withColumn("candidate", F.col("decline_area") >= least_area)
    score = F.round("priority_score", 9)
    out = written(out.withColumn("tier", F.when(~F.col("candidate"), "NONE").when(score >= high, "HIGH").when(score >= medium, "MEDIUM").otherwise("LOW")))
    ranked = numbered(out.where("candidate"), [F.desc(score), F.desc(F.round("decline_area", 6)), F.col("pnu")], "priority_rank")
    return ranked.unionByName(out.where("candidate is null or not candidate").withColumn("priority_rank", F.lit(None).cast("bigint")))


def segment_distance(parcels: DataFrame, segments: DataFrame, key: str, limit: int = 1000) -> DataFrame:
    """Least distance from the centre of each rectangle to a set of line segments. A short set (limit, which is checked) is broadcast as one array; a longer one is refused."""
    if segments.limit(limit + 1).count() > limit:
        raise ValueError(f"more than {limit} segments: cut them to the area first")
    lines = segments.agg(F.collect_list(F.struct("xa", "ya", "xb", "yb")).alias("lines"))
    p = parcels.select(key, ((F.col("x0") + F.col("x1")) / 2).alias("x"), ((F.col("y0") + F.col("y1")) / 2).alias("y")).join(F.broadcast(lines))

    def distance(s: Column) -> Column:
        dx, dy = s.xb - s.xa, s.yb - s.ya
        along = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((F.col("x") - s.xa) * dx + (F.col("y") - s.ya) * dy) / (dx * dx + dy * dy)))
        return F.sqrt(F.pow(F.col("x") - s.xa - along * dx, F.lit(2)) + F.pow(F.col("y") - s.ya - along * dy, F.lit(2)))

    return p.select(key, F.array_min(F.transform("lines", distance)).alias("distance"))
