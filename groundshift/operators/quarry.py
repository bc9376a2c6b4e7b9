"""What exposed ground has to do with reference polygons: connected components, candidates, contexts of parcels and two rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundshift.operators.components import cell_components, written
from groundshift.operators.distance import distance_transform
from groundshift.operators.ranking import numbered

#: Contexts and their scores as a link to a quarry, scores of a persistence status.
LINK_SCORES = {"POTENTIAL_QUARRY_EXPANSION": 100.0, "QUARRY_INTERNAL_CHANGE": 70.0, "EXPOSED_SURFACE_CHANGE": 40.0, "POSSIBLE_REVEGETATION": 20.0}
EXPOSED_SCORES = {"PERSISTENT": 100.0, "UNCONFIRMED": 50.0, "REVEGETATED": 20.0}
DECLINE_SCORES = {"PERSISTENT": 100.0, "UNCONFIRMED": 50.0, "TEMPORARY": 30.0}


def related(cells: DataFrame, exposed: Column, reference: DataFrame, size: float, adjacency: float = 30.0, least: int = 3) -> DataFrame:
    """cells (r, c, ...) with inside (a reference cell), distance to the reference in metres (NULL without any), comp (8-connected exposed cells; NULL elsewhere) and connected:
    whether the component has enough cells and comes near enough to the reference."""
    c = written(cells.withColumn("__exposed", F.coalesce(exposed, F.lit(False))))
    inside = reference.select("r", "c").distinct().withColumn("inside", F.lit(True))
    d = distance_transform(c.select("r", "c"), reference).withColumn("distance", F.sqrt("d2") * size)
    comp = cell_components(c.where("__exposed").select("r", "c"), [], eight=True)
    j = written(c.join(inside, ["r", "c"], "left").join(d.select("r", "c", "distance"), ["r", "c"]).join(comp, ["r", "c"], "left"))
    near = j.where("comp is not null").groupBy("comp").agg(F.count(F.lit(1)).alias("n"), F.min("distance").alias("d")).where((F.col("n") >= least) & (F.col("d") <= adjacency))
    j = j.join(near.select("comp", F.lit(True).alias("connected")), "comp", "left")
    return j.select(*cells.columns, F.coalesce("inside", F.lit(False)).alias("inside"), "distance", "comp", F.coalesce("connected", F.lit(False)).alias("connected"))


def candidates(cells: DataFrame, size: float) -> DataFrame:
    """A row for each component of cells (comp, first_exposed, follow, quarry_class, confidence, distance): cells, area, earliest interval, most frequent persistence and class (ties to
    the least name), largest confidence, least distance."""
    c = cells.where("comp is not null")

    def mode(x: str) -> DataFrame:
        n = c.groupBy("comp", x).agg(F.count(F.lit(1)).alias("n"))
        return n.groupBy("comp").agg(F.min_by(x, F.struct(-F.col("n"), F.coalesce(F.col(x), F.lit("")))).alias(x))

    g = c.groupBy("comp").agg(F.count(F.lit(1)).alias("n_cells"), (F.count(F.lit(1)) * size * size).alias("area_m2"), F.min("first_exposed").alias("first_interval"), F.max("confidence").alias("confidence"), F.min("distance").alias("distance"))
    return g.join(mode("follow"), "comp").join(mode("quarry_class"), "comp")


def insufficient(area: Column, evaluable: Column, least: float) -> Column:
    return (area < least) | (evaluable < least)


def context(p: dict[str, Column], enough: float, insufficient: Column) -> Column:
    """Context of a parcel from the areas of the quarry classes (expansion, internal, exposed, revegetation), its overlap ratio with the reference, and its type."""
    return (
        F.when(insufficient, "NOT_EVALUATED").when(p["expansion"] >= enough, "POTENTIAL_QUARRY_EXPANSION").when(p["internal"] >= enough, "QUARRY_INTERNAL_CHANGE")
        .when(p["exposed"] >= enough, "EXPOSED_SURFACE_CHANGE").when(p["revegetation"] >= enough, "POSSIBLE_REVEGETATION").when(F.coalesce(p["overlap_ratio"], F.lit(0.0)) >= 0.5, "VERIFIED_QUARRY_AREA")
        .when(p["type"] == "VEGETATION_LOSS", "GENERAL_VEGETATION_LOSS").otherwise("NONE")
    )


def flags(area: Column, evaluable: Column, water: Column, missing: list[int], least: float, fraction: float) -> Column:
    """Quality flags of a parcel as one text, VALID if there are none. missing: years without a short-wave band."""
    share = F.when(area > 0, evaluable / area).otherwise(0.0)
    found = [F.when(area < least, "LOW_PIXEL_COUNT"), F.when(share < fraction, "LOW_COVERAGE"), F.when(water > 0.1 * F.greatest(evaluable, F.lit(1.0)), "WATER_SUSPECT")]
    if missing:
        found.append(F.lit("BSI_YEAR_MISSING:" + ",".join(map(str, missing))))
    text = F.concat_ws(";", *found)
    return F.when(text == "", "VALID").otherwise(text)


def confidence(kind: Column, flag: Column, persistent: Column, enough: float, insufficient: Column) -> Column:
    return (
        F.when(insufficient, "NONE").when(flag.contains("LOW_COVERAGE") | flag.contains("WATER"), "LOW").when((kind == "EXPOSED_SURFACE_INCREASE") & (persistent >= enough), "HIGH")
        .when(kind.isin("STABLE_VEGETATION", "NO_SIGNIFICANT_CHANGE"), "HIGH").when(kind.isin("VEGETATION_LOSS", "UNCERTAIN_CHANGE"), "LOW").otherwise("MEDIUM")
    )


def _looked_up(x: Column, scores: dict[str, float]) -> Column:
    return F.coalesce(F.create_map(*(F.lit(v) for kv in scores.items() for v in kv))[x], F.lit(0.0))


def _ranked(df: DataFrame, key: str, name: str, area: str) -> DataFrame:
    order = [F.desc(F.round(f"{name}_score", 9)), F.desc(F.round(area, 6)), F.col(key)]
    df = written(df)
    ranked = numbered(df.where(f"{name}_candidate"), order, f"{name}_rank")
    return ranked.unionByName(df.where(f"not coalesce({name}_candidate, false)").withColumn(f"{name}_rank", F.lit(None).cast("bigint")))


def ranking_a(df: DataFrame, key: str, full_ratio: float = 0.5, near: float = 0.0, far: float = 500.0, weights: tuple[float, float, float] = (0.4, 0.35, 0.25), least_area: float = 300.0, least_ratio: float = 0.1) -> DataFrame:
    """Decline outside of the reference: A_score of ratio, persistence and distance to rail, A_candidate (enough area and ratio, persistent or not confirmed, data suffice) and A_rank.
    Columns: decline_out, decline_ratio_out, status_out, rail_distance, sufficient."""
    clamp = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
    ratio = F.coalesce("decline_ratio_out", F.lit(0.0))
    a, b, c = weights
    score = (a * clamp(ratio / full_ratio) * 100 + b * _looked_up(F.col("status_out"), DECLINE_SCORES) + c * F.coalesce(clamp((far - F.col("rail_distance")) / (far - near)) * 100, F.lit(0.0))) / (a + b + c)
    fits = (F.col("decline_out") >= least_area) & (ratio >= least_ratio) & F.col("status_out").isin("PERSISTENT", "UNCONFIRMED") & F.col("sufficient")
    return _ranked(df.withColumns({"A_score": score, "A_candidate": F.coalesce(fits, F.lit(False))}), key, "A", "decline_out")


def ranking_b(df: DataFrame, key: str, full_ratio: float = 0.5, weights: tuple[float, float, float] = (0.4, 0.4, 0.2), least_area: float = 200.0) -> DataFrame:
    """Exposure and its link to the reference: B_score, B_candidate and B_rank. Columns: exposed_ratio, quarry_context, exposed_persistent, exposed, exposed_revegetated, composite_type."""
    link = F.greatest(*(F.when(F.col("quarry_context") == k, v).otherwise(0.0) for k, v in LINK_SCORES.items()))
    lasting = (
        F.when(F.col("exposed_persistent") > 0, EXPOSED_SCORES["PERSISTENT"]).when((F.col("exposed") > 0) & (F.col("exposed_revegetated") <= 0), EXPOSED_SCORES["UNCONFIRMED"])
        .when(F.col("exposed_revegetated") > 0, EXPOSED_SCORES["REVEGETATED"]).otherwise(0.0)
    )
    a, b, c = weights
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce("exposed_ratio", F.lit(0.0)) / full_ratio)) * 100
    fits = ((F.col("exposed") >= least_area) | F.col("quarry_context").isin("POTENTIAL_QUARRY_EXPANSION", "QUARRY_INTERNAL_CHANGE")) & (F.col("composite_type") != "INSUFFICIENT_DATA")
    return _ranked(df.withColumns({"B_score": (a * share + b * link + c * lasting) / (a + b + c), "B_candidate": F.coalesce(fits, F.lit(False))}), key, "B", "exposed")
