"""Time series of pixels. Every cell has a row for every epoch, so that a missing year is a NULL observation and not a skipped one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from groundshift.operators.components import written
from groundshift.operators.selection import quantiles

from groundshift.operators.indices import decline, exposed

def cell() -> WindowSpec:
    return Window.partitionBy("r", "c")


def full_grid(indexed: DataFrame, epochs: list[int]) -> DataFrame:
    """Each cell that was ever observed, at each epoch; k is the epoch's number. A row stands for itself and for the epochs without one up to the cell's next row, the first also for those
    before it, so that rows are dealt by cell once and nothing is collected or joined."""
    values = [c for c in indexed.columns if c not in ("r", "c", "epoch")]
    listed = F.array(*map(F.lit, epochs)).cast("array<int>")
    own = F.coalesce(F.array_position(listed, F.col("epoch").cast("int")), F.lit(0)).cast("int") - 1
    order = cell().orderBy("__k")
    g = indexed.withColumn("__k", own).withColumns({"__number": F.row_number().over(order), "__next": F.lead("__k").over(order)})
    start = F.when(F.col("__number") == 1, 0).otherwise(F.greatest(F.lit(0), F.col("__k")))
    g = g.withColumns({"__start": start, "__stop": F.coalesce(F.col("__next"), F.lit(len(epochs))) - 1}).where("__start <= __stop")
    grid = g.withColumn("k", F.explode(F.sequence("__start", "__stop")))
    return grid.select("r", "c", F.get(listed, F.col("k")).alias("epoch"), "k", *(F.when(F.col("k") == F.col("__k"), F.col(v)).alias(v) for v in values))


def decline_events(grid: DataFrame, min_valid: int = 4, **thresholds: float) -> DataFrame:
    """Adds before, event (whether the interval that ends here is a decline) and n_valid of the cell."""
    order = cell().orderBy("k")
    g = grid.withColumn("before", F.lag("ndvi").over(order)).withColumn("n_valid", F.count("ndvi").over(cell()))
    return g.withColumn("event", decline(F.col("before"), F.col("ndvi"), **thresholds) & (F.col("n_valid") >= min_valid))


def persistence(grid: DataFrame, min_valid: int = 4, min_followup: int = 1, recovery: float = 0.5, **thresholds: float) -> DataFrame:
    """A row for each cell: n_valid, evaluable, frequency of declines, first interval (from 0) and class of what followed the last one."""
    g = decline_events(grid, min_valid, **thresholds)
    g = g.withColumn("last_k", F.max(F.when(F.col("event"), F.col("k"))).over(cell()))
    later = F.col("ndvi").isNotNull() & (F.col("k") > F.col("last_k"))
    out = g.groupBy("r", "c").agg(
        F.max("n_valid").alias("n_valid"),
        F.count_if("event").alias("frequency"),
        (F.min(F.when(F.col("event"), F.col("k"))) - 1).alias("first_interval"),
        F.count_if(later).alias("n_follow"),
        F.coalesce(F.bool_or(later & (F.col("ndvi") >= recovery)), F.lit(False)).alias("recovered"),
    )
    kind = F.when(F.col("frequency") == 0, "NONE").when(F.col("recovered"), "TEMPORARY").when(F.col("n_follow") >= min_followup, "PERSISTENT").otherwise("UNCONFIRMED")
    return out.select("r", "c", "n_valid", (F.col("n_valid") >= min_valid).alias("evaluable"), "frequency", "first_interval", kind.alias("persistence"))


def first_last(grid: DataFrame) -> DataFrame:
    """First and last valid value of each cell and their difference."""
    have = F.array_sort(F.filter(F.collect_list(F.struct("k", "ndvi")), lambda x: x.ndvi.isNotNull()))
    g = grid.groupBy("r", "c").agg(have.alias("s")).where(F.size("s") > 0)
    first, last = F.element_at("s", 1)["ndvi"], F.element_at("s", -1)["ndvi"]
    return g.select("r", "c", first.alias("first_ndvi"), last.alias("last_ndvi"), (last - first).alias("change"))


def interval_shifts(grid: DataFrame, stable: float = 0.05, least: int = 100) -> DataFrame:
    """For each interval: median change of all valid cells, and of bare soil over cells of stable vegetation; 0 where too few cells are valid."""
    order = cell().orderBy("k")
    g = grid.withColumns({"dn": F.col("ndvi") - F.lag("ndvi").over(order), "db": F.col("bsi") - F.lag("bsi").over(order)}).where("k > 0")
    g = written(g.select("k", "dn", F.when(F.abs("dn") < stable, F.col("db")).alias("quiet")))
    one = lambda c, name: quantiles(g.select("k", F.col(c).alias("v")), ["k"], [0.5]).select("k", F.when(F.col("n") > least, F.col("value")).otherwise(0.0).alias(name))
    out = g.groupBy("k").agg(F.count("dn").alias("n")).join(one("dn", "ndvi_shift"), "k", "left").join(one("quiet", "bsi_shift"), "k", "left")
    return out.select("k", F.coalesce("ndvi_shift", F.lit(0.0)).alias("ndvi_shift"), F.coalesce("bsi_shift", F.lit(0.0)).alias("bsi_shift"), "n")


def interval_differences(grid: DataFrame, shifts: DataFrame, th: dict, min_valid: int = 3) -> DataFrame:
    """A row for each cell and interval: both ends of the indices, their differences dn and db corrected by the interval's shifts, v (known at both ends), wt (water at either end)."""
    order = cell().orderBy("k")
    both = F.col("ndvi").isNotNull() & F.col("bsi").isNotNull()
    g = grid.withColumns({"ok": both, "state": both & exposed(F.col("ndvi"), F.col("bsi"), th["exposed_ndvi"], th["exposed_bsi"]), "wet": F.coalesce(F.col("mndwi") > th["water"], F.lit(False))})
    g = g.withColumn("n_valid", F.count_if("ok").over(cell()))
    g = g.withColumns({f"{c}0": F.lag(c).over(order) for c in ("ndvi", "bsi", "ok", "state", "wet")})
    g = g.join(F.broadcast(shifts.select("k", "ndvi_shift", "bsi_shift")), "k")  # one row for each interval
    known = F.coalesce(F.col("ok") & F.col("ok0"), F.lit(False)) & (F.col("n_valid") >= min_valid)
    changed = {"dn": F.col("ndvi") - F.col("ndvi0") - F.col("ndvi_shift"), "db": F.col("bsi") - F.col("bsi0") - F.col("bsi_shift"), "v": known, "wt": F.col("wet") | F.col("wet0")}
    return g.withColumns(changed).where("k > 0")


def interval_event(th: dict) -> tuple[Column, Column]:
    """Event of a row of interval_differences (2 exposed, 1 vegetation loss, 3 recovery, 4 uncertain, 0 none, NULL not known), and whether it is a recovery from exposure."""
    v, wet, dn, db = (F.col(x) for x in ("v", "wt", "dn", "db"))
    loss = v & (F.col("ndvi0") >= th["before"]) & (F.col("ndvi") <= th["after"]) & (dn <= th["delta"])
    bare = loss & (db >= th["increase"]) & (F.col("bsi") >= th["exposed_bsi"]) & ~wet
    conflict = loss & (db <= -th["conflict"])
    plain = loss & ~bare & ~wet & ~conflict
    back = v & (F.col("ndvi0") < th["recovery"]) & (dn >= th["recovery_delta"]) & (F.col("ndvi") >= th["recovery"]) & (db <= -th["decrease"]) & ~wet
    unsure = v & ((loss & (wet | conflict)) | (wet & (F.abs(dn) >= th["recovery_delta"])) | ((dn >= th["recovery_delta"]) & ~back & ~wet))
    return F.when(~v, None).when(bare, 2).when(plain, 1).when(back, 3).when(unsure, 4).otherwise(0), back & F.col("state0")


def composite_events(grid: DataFrame, shifts: DataFrame, th: dict, min_valid: int = 3) -> DataFrame:
    """Event of each interval from both indices, corrected by the interval's shifts."""
    code, back = interval_event(th)
    return interval_differences(grid, shifts, th, min_valid).select("r", "c", "k", "epoch", code.alias("event"), back.alias("from_exposed"))


def year_pairs(years: DataFrame, long_term: list[tuple[int, int]]) -> DataFrame:
    """Consecutive years (step), and long-term pairs that are no steps and whose years are both there."""
    spark = years.sparkSession
    steps = years.select(F.col("year").alias("year_from"), F.lead("year").over(Window.orderBy("year")).alias("year_to")).where("year_to is not null")  # one row a year
    more = spark.createDataFrame(long_term, "year_from int, year_to int").distinct()
    have = years.select("year")
    more = more.join(have.withColumnRenamed("year", "year_from"), "year_from", "left_semi").join(have.withColumnRenamed("year", "year_to"), "year_to", "left_semi")
    more = more.join(steps, ["year_from", "year_to"], "left_anti").select("year_from", "year_to")
    return steps.withColumn("pair_kind", F.lit("step")).unionByName(more.withColumn("pair_kind", F.lit("long_term")))
