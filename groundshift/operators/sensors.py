"""Two sensors and two lattices: the second band must come from the very scene of the first, and fine cells must fall whole into coarse ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundshift.operators.indices import bsi, mndwi


def second_band(scenes: DataFrame, items: DataFrame, keep: list[str]) -> DataFrame:
    """(keep, scene_id, status, reason): whether the second sensor has the same scene. scenes and items: scene_id, day, baseline, removed (the offset taken off; NULL if not recorded); an item once.

    UNAVAILABLE with the first reason that holds: NO_SCENE_ID, NOT_FOUND, DATE_MISMATCH, BASELINE_MISMATCH, OFFSET_MISMATCH. What a scene did not record is not compared.
    """
    found = items.select("scene_id", *(F.col(c).alias(f"__{c}") for c in ("day", "baseline", "removed")), F.lit(True).alias("__found"))
    differs = lambda c: F.col(c).isNotNull() & ~F.col(c).eqNullSafe(F.col(f"__{c}"))
    reason = (
        F.when(F.col("scene_id").isNull(), "NO_SCENE_ID").when(F.col("__found").isNull(), "NOT_FOUND").when(differs("day"), "DATE_MISMATCH").when(differs("baseline"), "BASELINE_MISMATCH").when(differs("removed"), "OFFSET_MISMATCH")
    )
    j = scenes.join(found, "scene_id", "left").withColumn("reason", reason)
    return j.select(*keep, "scene_id", F.when(F.col("reason").isNull(), "OK").otherwise("UNAVAILABLE").alias("status"), "reason")


def coarse_stack(pixels: DataFrame, available: DataFrame, valid: Column, least: int = 2) -> DataFrame:
    """(epoch, r, c, ndvi, bsi, mndwi, available) of cells of two by two: means of the valid fine cells' bands where there are enough of them. available (epoch): dates that have the second band;
    for others what needs it is NULL, and the date stays."""
    half = lambda c: F.floor(F.col(c) / 2).cast("int").alias(c)
    bands = ("red", "nir", "blue", "green", "swir")
    mean = lambda c: F.when(F.count_if(valid) >= least, F.avg(F.when(valid, F.col(c)))).alias(c)
    g = pixels.groupBy("epoch", half("r"), half("c")).agg(*map(mean, bands))
    g = g.join(F.broadcast(available.select("epoch", F.lit(True).alias("available"))), "epoch", "left").withColumn("available", F.coalesce("available", F.lit(False)))  # a row for each date
    red, nir, blue, green, swir = (F.col(b) for b in bands)
    total = red + nir
    shown = lambda x: F.when(F.col("available"), x)
    return g.select("epoch", "r", "c", F.when(total > 0, (nir - red) / total).alias("ndvi"), shown(bsi(red, nir, blue, swir)).alias("bsi"), shown(mndwi(green, swir)).alias("mndwi"), "available")


def placed(cells: DataFrame, origin: tuple[float, float], onto: tuple[float, float], size: float) -> DataFrame:
    """cells of a lattice of size with this origin, with the places (r, c) they have on one twice as coarse from another origin, as fine places of it (r, c) and coarse ones (r2, c2).
    Lattices that are not whole cells apart are an error."""
    shift = [(a - b) / size for a, b in zip(origin, onto, strict=True)]
    if any(abs(s - round(s)) > 1e-6 for s in shift):
        raise ValueError(f"the lattices are {shift[0]} and {shift[1]} cells apart, not whole ones")
    c = cells.withColumns({"c": F.col("c") + round(shift[0]), "r": F.col("r") + round(shift[1])})
    return c.withColumns({"r2": F.floor(F.col("r") / 2).cast("int"), "c2": F.floor(F.col("c") / 2).cast("int")})


def audited(considered: DataFrame, chosen: DataFrame, group: str) -> DataFrame:
    """considered scenes with selected: whether the scene is the one chosen in its group."""
    own = chosen.select(F.col(group), "scene_id", F.lit(True).alias("selected"))
    return considered.join(own, [group, "scene_id"], "left").withColumn("selected", F.coalesce("selected", F.lit(False)))


def composite_records(provenance: DataFrame) -> DataFrame:
    """Scene records of composites, the input of a run on them, from provenance (year, status, day, scene_id, n_scenes, valid_fraction): only those with status OK."""
    p = provenance.where("status = 'OK'")
    return p.select("year", "day", F.lit("median composite").alias("provider"), "scene_id", F.format_string("median of %d scenes", "n_scenes").alias("platform"), F.lit("mixed").alias("baseline"), F.col("valid_fraction").alias("clear_fraction"))
