"""Screening of all pairs of years: changes of any shape that lie near each other become hotspots, the best ones squares to order images for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundshift.operators.components import components, written
from groundshift.operators.ranking import numbered
from groundshift.operators.scoring import roi
from groundshift.operators.selection import suppressed


def cell_links(cells: DataFrame, distance: float, size: float) -> DataFrame:
    """(a, b), a < b: changes (id, r, c) with cells not farther apart than distance, from border to border. A cell looks at the fixed ring of places around it, so work grows with cells."""
    reach = int(distance // size) + 1
    gap = lambda d: max(abs(d) - 1, 0) * size
    near = [(i, j) for i in range(-reach, reach + 1) for j in range(-reach, reach + 1) if gap(i) ** 2 + gap(j) ** 2 <= distance**2]
    moved = cells.select(F.col("id").alias("a"), "r", "c", F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in near))).alias("d")).select("a", (F.col("r") + F.col("d.i")).alias("r"), (F.col("c") + F.col("d.j")).alias("c"))
    return moved.join(cells.select(F.col("id").alias("b"), "r", "c"), ["r", "c"]).where("a < b").select("a", "b").distinct()


def hotspots(cells: DataFrame, features: DataFrame, distance: float, size: float) -> tuple[DataFrame, DataFrame]:
    """Hotspots of cells (id, r, c) and their features (id, area_m2, score, year_from, year_to, pair), and the hotspot (label) of each feature.

    area_m2 is that of the union: a cell that changed several times counts once. score is weighted by the features' areas; x, y is the centre of the union.
    """
    links = written(cell_links(cells, distance, size))
    label = written(components(features.select(F.col("id").alias("node")), links).select(F.col("node").alias("id"), "label"))
    u = cells.join(label, "id").select("label", "r", "c").distinct()
    mid = lambda x: F.avg((F.col(x) + 0.5) * size)
    u = u.groupBy("label").agg(
        (F.count(F.lit(1)) * size * size).alias("area_m2"), mid("c").alias("x"), mid("r").alias("y"), (F.min("c") * size).alias("x0"), (F.min("r") * size).alias("y0"), ((F.max("c") + 1) * size).alias("x1"), ((F.max("r") + 1) * size).alias("y1")
    )
    g = features.join(label, "id").groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), (F.sum(F.col("area_m2") * F.col("score")) / F.sum("area_m2")).alias("score"), F.min("year_from").alias("first_year"), F.max("year_to").alias("last_year"),
        F.countDistinct("pair").alias("frequency"), F.array_join(F.array_sort(F.collect_set("pair")), ",").alias("pairs"),  # as many pairs as there are years
    )
    return g.join(u, "label"), label


def ranked(spots: DataFrame, top: int, least_area: float = 0.0, least_score: float = 0.0) -> DataFrame:
    """Hotspots with rank by area times score times frequency, hotspot_id, and whether images are recommended: among the first, large and strong enough."""
    s = numbered(spots.withColumn("priority", F.round(F.col("area_m2") * F.col("score") * F.col("frequency") + 1e-9, 1)), [F.desc("priority"), F.col("label")], "rank")
    fits = (F.col("rank") <= top) & (F.col("area_m2") >= least_area) & (F.col("score") >= least_score)
    return s.withColumns({"hotspot_id": F.format_string("HS_%02d", "rank"), "recommended": fits})


def orders(ranked_spots: DataFrame, buffer: float, least: float, most: float | None, share: float = 0.5) -> DataFrame:
    """Squares around the recommended hotspots; one that an earlier square covers by share of it is not ordered again."""
    r = roi(ranked_spots.where("recommended"), buffer, least, most)
    boxes = r.select("hotspot_id", "rank", "roi_clipped", "roi_size_m", "roi_area_km2", F.lit(0).alias("all"), F.col("rx0").alias("x0"), F.col("ry0").alias("y0"), F.col("rx1").alias("x1"), F.col("ry1").alias("y1"))
    return suppressed(boxes, "hotspot_id", "all", "rank", share).drop("all")


def pair_summary(pairs: DataFrame, features: DataFrame, label: DataFrame) -> DataFrame:
    """(pair, polygons, area_m2, hotspots) of every pair of years, zeros included: its changes, their area and the hotspots that they are part of."""
    g = features.join(label, "id", "left").groupBy("pair").agg(F.count(F.lit(1)).alias("polygons"), F.sum("area_m2").alias("area_m2"), F.countDistinct("label").alias("hotspots"))
    return pairs.join(g, "pair", "left").select("pair", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("polygons", "area_m2", "hotspots")))
