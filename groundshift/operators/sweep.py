"""One-at-a-time sweeps of parameters. All variants share the pixels' scan, windows and exchange: a cell carries an array of states, one for each setting that changes what a cell is."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundshift.operators.components import cell_components, written
from groundshift.operators.distance import distance_transform
from groundshift.operators.indices import decline
from groundshift.operators.series import cell, interval_differences, interval_event


@dataclass(frozen=True)
class Variant:
    """A setting of the sweep. Only delta and increase change the states of cells; least and adjacency change which components count; followup neither."""

    parameter: str
    value: str
    delta: float
    increase: float
    least: int
    adjacency: float
    followup: int


def one_at_a_time(base: dict, values: dict[str, list]) -> list[Variant]:
    """The base setting first, then each listed value of each parameter with all others as they are."""
    rows = [Variant("default", "default", **base)]
    return rows + [Variant(name, str(v), **(base | {name: v})) for name, listed in values.items() for v in listed]


def swept_states(grid: DataFrame, shifts: DataFrame, th: dict, settings: list[tuple[float, float]], min_valid: int = 3) -> DataFrame:
    """(r, c, exposed, loss, recovery): arrays with a boolean for each (delta, increase), whether any interval of the cell has that event."""
    hit = lambda codes, code: F.coalesce(F.bool_or(code.isin(*codes)), F.lit(False))
    codes = [interval_event(th | {"delta": d, "increase": i})[0] for d, i in settings]
    states = {"exposed": [2], "loss": [1, 2], "recovery": [3]}
    return interval_differences(grid, shifts, th, min_valid).groupBy("r", "c").agg(*(F.array(*(hit(c, code) for code in codes)).alias(name) for name, c in states.items()))


def expanded(states: DataFrame, reference: DataFrame, variants: list[Variant], settings: list[tuple[float, float]], size: float) -> DataFrame:
    """(r, c, variants): exposed cells outside of the reference whose component is large and near enough, with the numbers of the variants that find so.

    Components are made once for each setting of the cells, with the setting in their key; sizes and distances are then one row a component, to which all variants are put.
    """
    inside = reference.select("r", "c").distinct()
    bare = written(states.select("r", "c", F.posexplode("exposed").alias("setting", "on")).where("on").select("setting", "r", "c"))
    far = distance_transform(states.select("r", "c"), reference).select("r", "c", (F.sqrt("d2") * size).alias("distance"))
    comp = written(cell_components(bare, ["setting"], eight=True).join(far, ["r", "c"]))
    g = comp.groupBy("setting", "comp").agg(F.count(F.lit(1)).alias("n"), F.min("distance").alias("near"))
    fits = F.array(*(F.when((F.col("setting") == settings.index((v.delta, v.increase))) & (F.col("n") >= v.least) & (F.col("near") <= v.adjacency), F.lit(i)) for i, v in enumerate(variants)))
    g = g.withColumn("fits", F.filter(fits, lambda x: x.isNotNull())).where("size(fits) > 0").select("setting", "comp", "fits")
    out = comp.join(inside, ["r", "c"], "left_anti").join(g, ["setting", "comp"]).select("r", "c", F.explode("fits").alias("i"))
    return out.groupBy("r", "c").agg(F.collect_set("i").alias("variants"))  # at most one of each variant


def swept(states: DataFrame, expansion: DataFrame, area: DataFrame, parcels: DataFrame, variants: list[Variant], settings: list[tuple[float, float]], key: str, least_area: float) -> DataFrame:
    """A row for each variant: areas of its states within the area of interest (hectares), parcels with enough of them, and what exposure and expansion share with the first variant.

    states come from swept_states, expansion from expanded; area (r, c, area) and parcels (key, r, c, area) are coverages.
    """
    at = lambda name, v: F.element_at(name, settings.index((v.delta, v.increase)) + 1)
    found = lambda i: F.coalesce(F.array_contains("variants", i), F.lit(False))
    own = F.array(*(F.struct(F.lit(i).alias("i"), at("exposed", v).alias("exposed"), at("loss", v).alias("loss"), at("recovery", v).alias("recovery"), found(i).alias("expansion")) for i, v in enumerate(variants)))
    # a cell's row is its few flags until it has met its area. Such rows are written in far less than they take in memory, so their files' size must not let them be sent to all tasks
    cells = written(states.join(expansion, ["r", "c"], "left")).hint("merge")
    rows = lambda df, *keep: df.select(*keep, F.explode(own).alias("x")).select(*keep, "x.*")
    total = lambda m: F.coalesce(F.sum(F.when(F.col(m), F.col("area"))), F.lit(0.0))
    inner = rows(area.join(cells, ["r", "c"]), "area").groupBy("i").agg(*((total(m) / 10000.0).alias(f"{m}_ha") for m in ("exposed", "loss", "expansion", "recovery")))
    by = rows(parcels.join(cells, ["r", "c"]), key, "area").groupBy("i", key).agg(total("exposed").alias("e"), total("expansion").alias("p"))
    enough = lambda c: F.round(c, 6) >= least_area
    by = by.groupBy("i").agg(F.count_if(enough("e")).alias("parcels_exposed"), F.count_if(enough("p")).alias("parcels_expansion"))
    first = cells.withColumn("b", F.element_at(own, 1))
    both = rows(first, "b").groupBy("i").agg(*(F.count_if(F.col(m) & F.col(f"b.{m}")).alias(f"{m}_both") for m in ("exposed", "expansion")), *(F.count_if(F.col(m) | F.col(f"b.{m}")).alias(f"{m}_either") for m in ("exposed", "expansion")))
    names = states.sparkSession.createDataFrame([(i, v.parameter, v.value) for i, v in enumerate(variants)], "i int, parameter string, value string")
    out = names.join(inner, "i", "left").join(by, "i", "left").join(both, "i", "left")
    return out.select(
        "parameter", "value", *(F.coalesce(f"{m}_ha", F.lit(0.0)).alias(f"{m}_ha") for m in ("exposed", "loss", "expansion", "recovery")), *(F.coalesce(x, F.lit(0)).alias(x) for x in ("parcels_exposed", "parcels_expansion")),
        (F.coalesce("exposed_both", F.lit(0)) / F.greatest(F.coalesce("exposed_either", F.lit(0)), F.lit(1))).alias("jaccard_exposed"), F.try_divide("expansion_both", "expansion_either").alias("jaccard_expansion"),
    )


def profile_areas(grid: DataFrame, profiles: dict[str, tuple[float, float, float]], area: float, min_valid: int = 4, min_followup: int = 1, recovery: float = 0.4, base: str = "default") -> DataFrame:
    """A row for each threshold profile (least before, most after, greatest change): cells and area that decline, the area of each class of what followed, cells with repeated declines, and the
    cells shared with the base profile. A cell's course is one array, as long as there are epochs; the profiles are put to it side by side."""
    order = cell().orderBy("k")
    g = grid.withColumn("before", F.lag("ndvi").over(order)).groupBy("r", "c").agg(F.collect_list(F.struct("k", "before", "ndvi")).alias("course"), F.count("ndvi").alias("n_valid"))

    def states(name: str, limits: tuple[float, float, float]) -> Column:
        events = F.filter("course", lambda x: decline(x.before, x.ndvi, *limits) & (F.col("n_valid") >= min_valid))
        last = F.array_max(F.transform(events, lambda x: x.k))
        later = F.filter("course", lambda x: x.ndvi.isNotNull() & (x.k > last))
        kind = F.when(F.size(events) == 0, "NONE").when(F.exists(later, lambda x: x.ndvi >= recovery), "TEMPORARY").when(F.size(later) >= min_followup, "PERSISTENT").otherwise("UNCONFIRMED")
        return F.struct(F.lit(name).alias("profile"), F.size(events).alias("frequency"), kind.alias("kind"))

    s = g.select(F.array(*(states(n, t) for n, t in profiles.items())).alias("s"))
    s = s.select(F.element_at("s", list(profiles).index(base) + 1)["frequency"].alias("f0"), F.explode("s").alias("x")).select("f0", "x.*")
    on, ref = F.col("frequency") > 0, F.col("f0") > 0
    of = lambda k: (F.count_if(F.col("kind") == k) * area).alias(f"{k.lower()}_area_m2")
    return s.groupBy("profile").agg(
        F.count_if(on).alias("decline_cells"), (F.count_if(on) * area).alias("decline_area_m2"), of("PERSISTENT"), of("TEMPORARY"), of("UNCONFIRMED"),
        F.count_if(F.col("frequency") >= 2).alias("repeated_cells"), F.try_divide(F.count_if(on & ref), F.count_if(on | ref)).alias("jaccard"),
    )
