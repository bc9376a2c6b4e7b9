"""What the events of both indices make of a cell over all years, and of a parcel from its cells' areas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundshift.operators.series import cell


def cell_types(grid: DataFrame, events: DataFrame, th: dict, min_valid: int = 3, min_followup: int = 1, min_exposed: int = 4) -> DataFrame:
    """(r, c): first change and first exposure (interval from 1), what followed the last exposure, type and confidence.

    grid and events are (r, c, k) tables; their aggregates are joined by cell, not their rows.
    """
    both = F.col("ndvi").isNotNull() & F.col("bsi").isNotNull()
    state = both & (F.col("ndvi") <= th["exposed_ndvi"]) & (F.col("bsi") >= th["exposed_bsi"])
    hit = lambda code: F.coalesce(F.col("event") == code, F.lit(False))
    e = events.withColumn("last_exposed", F.max(F.when(hit(2), F.col("k"))).over(Window.partitionBy("r", "c")))
    j = grid.join(e.select("r", "c", "k", "event", "from_exposed", "last_exposed"), ["r", "c", "k"], "left").withColumn("last_exposed", F.max("last_exposed").over(cell()))
    later = both & (F.col("k") > F.col("last_exposed"))
    a = j.groupBy("r", "c").agg(
        F.count_if(both).alias("n_valid"),
        *(F.coalesce(F.bool_or(hit(code)), F.lit(False)).alias(name) for code, name in ((1, "loss"), (2, "bare"), (3, "back"), (4, "unsure"))),
        F.min(F.when(F.col("event").between(1, 4), F.col("k"))).alias("first_change"),
        F.min(F.when(hit(2), F.col("k"))).alias("first_exposed"),
        F.count_if(later).alias("n_later"),
        F.coalesce(F.bool_or(later & (F.col("ndvi") >= th["recovery"])), F.lit(False)).alias("green_again"),
        F.coalesce(F.bool_and(F.when(later, state)), F.lit(True)).alias("still"),
        F.count_if(state).alias("n_exposed"),
        F.coalesce(F.bool_and(F.when(both, F.col("ndvi") >= th["before"])), F.lit(True)).alias("always_green"),
        F.coalesce(F.bool_or("from_exposed"), F.lit(False)).alias("from_exposed"),
    )
    follow = F.when(~F.col("bare"), "NONE").when(F.col("green_again"), "REVEGETATED").when(F.col("n_later") < min_followup, "UNCONFIRMED").when(F.col("still"), "PERSISTENT").otherwise("PARTIAL")
    kind = (
        F.when(F.col("n_valid") < min_valid, None)
        .when(F.col("bare"), "EXPOSED_SURFACE_INCREASE").when(F.col("loss"), "VEGETATION_LOSS").when(F.col("back"), "VEGETATION_RECOVERY")
        .when(F.col("n_exposed") >= min_exposed, "PERSISTENT_EXPOSED_SURFACE").when(F.col("always_green") & F.col("first_change").isNull(), "STABLE_VEGETATION")
        .when(F.col("unsure"), "UNCERTAIN_CHANGE").otherwise("NONE")
    )
    a = a.withColumns({"follow": follow, "type": kind})
    sure = (
        F.when(F.col("type").isin("STABLE_VEGETATION"), 3).when((F.col("type") == "EXPOSED_SURFACE_INCREASE") & (F.col("follow") == "PERSISTENT"), 3)
        .when(F.col("type").isin("EXPOSED_SURFACE_INCREASE", "PERSISTENT_EXPOSED_SURFACE", "VEGETATION_RECOVERY"), 2).when(F.col("type").isin("VEGETATION_LOSS", "UNCERTAIN_CHANGE"), 1).otherwise(0)
    )
    return a.select("r", "c", "n_valid", "first_change", "first_exposed", "follow", "type", sure.alias("confidence"), "from_exposed")


def quarry_class(inside: Column, connected: Column, bare: Column, other: Column, back: Column, evaluable: Column) -> Column:
    """Later rules win: not evaluable, recovery from exposure, expansion, internal change, plain exposure, other change, the reference itself."""
    return (
        F.when(~evaluable & ~inside, None).when(back & ~bare, "POSSIBLE_REVEGETATION").when(bare & connected & ~inside, "POTENTIAL_QUARRY_EXPANSION").when(bare & inside, "QUARRY_INTERNAL_CHANGE")
        .when(bare, "EXPOSED_SURFACE_CHANGE").when(other, "UNCLASSIFIED").when(inside, "VERIFIED_QUARRY_AREA")
    )


def parcel_type(area: Column, evaluable: Column, masks: dict[str, Column], least: float = 800.0, ratio: float = 0.1) -> Column:
    """Type of a parcel from areas in square metres (exposed, loss, recovery, persistent, uncertain, stable)."""
    ev = F.greatest(evaluable, F.lit(1.0))
    ok = lambda m: (masks[m] >= least) & (masks[m] / ev >= ratio)
    return (
        F.when((area < least) | (evaluable < least), "INSUFFICIENT_DATA").when(ok("exposed"), "EXPOSED_SURFACE_INCREASE").when(ok("loss"), "VEGETATION_LOSS").when(ok("recovery"), "VEGETATION_RECOVERY")
        .when(ok("persistent"), "PERSISTENT_EXPOSED_SURFACE").when(ok("uncertain"), "UNCERTAIN_CHANGE").when(masks["stable"] / ev >= 0.5, "STABLE_VEGETATION").otherwise("NO_SIGNIFICANT_CHANGE")
    )


def quality_flags(area: Column, evaluable: Column, year_fractions: Column, cell_area: float = 100.0, least_cells: int = 4, least_fraction: float = 0.8, least_year: float = 0.5) -> Column:
    """Flags in the order of their weight; empty if all is well. year_fractions: array of valid shares, NULL for none."""
    share = F.coalesce(evaluable / F.nullif(area, F.lit(0.0)), F.lit(0.0))
    none = F.forall(year_fractions, lambda x: F.coalesce(x, F.lit(0.0)) <= 0)
    flags = [
        (F.coalesce(evaluable, F.lit(0.0)) <= 0) | none, area / cell_area < least_cells, share < least_fraction, F.exists(year_fractions, lambda x: F.coalesce(x, F.lit(0.0)) < least_year),
    ]
    names = ["NOT_EVALUABLE", "LOW_PIXEL_COUNT", "LOW_COVERAGE", "CLOUD_CONTAMINATION"]
    return F.filter(F.array(*(F.when(f, F.lit(n)) for f, n in zip(flags, names, strict=True))), lambda x: x.isNotNull())


def series_type(evaluable: Column, persistent: Column, temporary: Column, unconfirmed: Column, total: Column, means: Column, insufficient: Column, area_min: float = 300.0, ratio_min: float = 0.1) -> Column:
    """Change type of a parcel: declines by area first, else by the course of its yearly means (array, NULLs allowed)."""
    m = F.filter(means, lambda x: x.isNotNull())
    n = F.size(m)
    delta = F.element_at(m, -1) - F.element_at(m, 1)
    mean = F.aggregate(m, F.lit(0.0), lambda a, x: a + x) / n
    sd = F.sqrt(F.aggregate(m, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean)) / n)
    ok = lambda a: (a >= area_min) & (a / evaluable >= ratio_min)
    main = F.when((persistent >= temporary) & (persistent >= unconfirmed), "PERSISTENT_DECLINE").when(temporary >= unconfirmed, "TEMPORARY_DECLINE").otherwise("DECLINE_UNCONFIRMED")
    return (
        F.when(insufficient | (n < 2), "INSUFFICIENT_DATA").when(ok(persistent), "PERSISTENT_DECLINE").when(ok(temporary), "TEMPORARY_DECLINE").when(ok(unconfirmed), "DECLINE_UNCONFIRMED").when(ok(total), main)
        .when(delta >= 0.1, "RECOVERY").when(sd >= 0.1, "FLUCTUATING").when(delta <= -0.1, "GRADUAL_DECLINE").when(mean >= 0.35, "STABLE_VEGETATION").otherwise("STABLE_NON_VEGETATION")
    )
