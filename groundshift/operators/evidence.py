"""Evidence from registers: joins by key, rules that name a change, its risk and its priority. All rules are one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NEW, EXPANSION, DEMOLITION, OTHER = "NEW_BUILDING", "EXPANSION_OR_RECONSTRUCTION", "DEMOLITION", "OTHER_CHANGE"
#: Risk of a compensation status.
RISK = {"POST_BASELINE_UNVERIFIED": 1.0, "STRADDLES_BASELINE": 0.6, "POST_BASELINE_PERMITTED": 0.3, "UNKNOWN": 0.5, "PRE_BASELINE": 0.0}
#: Weights of the building priority.
WEIGHTS = {"confidence": 0.40, "ratio": 0.30, "uncertainty": 0.20, "relevance": 0.10}


def latest_by(register: DataFrame, key: str, date: str, tie: str) -> DataFrame:
    """The record of each key with the latest date (NULL dates last, then the smallest tie). An aggregation, so hot keys combine before the shuffle."""
    rest = [c for c in register.columns if c != key]
    best = F.max_by(F.struct(*rest), F.struct(F.col(date).isNotNull(), F.coalesce(F.col(date), F.lit("")), -F.col(tie)))
    return register.where(F.col(key).isNotNull()).groupBy(key).agg(best.alias("rec")).select(key, "rec.*")


def join_register(buildings: DataFrame, by_first: DataFrame, by_second: DataFrame, first: str, second: str, columns: list[str], proof: str) -> DataFrame:
    """Register columns by the first key; where its record has no proof column, by the second; match_method tells which."""
    a = by_first.select(first, F.struct(*columns).alias("rec_a"))
    b = by_second.select(second, F.struct(*columns).alias("rec_b"))
    j = buildings.join(a, first, "left").join(b, second, "left")
    hit = F.col(f"rec_a.{proof}").isNotNull()
    rec = F.when(hit, F.col("rec_a")).otherwise(F.col("rec_b"))
    j = j.withColumn("rec", rec).select(*buildings.columns, "rec.*", hit.alias("hit"))
    return j.withColumn("match_method", F.when(F.col("hit"), first).when(F.col(proof).isNotNull(), second)).drop("hit")


def change_type(ratio: Column, near: Column, matched: Column, approved: Column, t1, t2, new_ratio: float = 0.5) -> Column:
    """What happened to a building; a register date inside the interval is stronger than the image."""
    return (
        F.when((ratio == 0) & near, OTHER)
        .when(ratio == 0, None)
        .when(matched & approved.between(t1, t2), NEW)
        .when(matched & approved.isNotNull(), EXPANSION)
        .when(ratio >= new_ratio, NEW)
        .otherwise(EXPANSION)
    )


def direction_consistent(ratio: Column, matched: Column, approved: Column, brightness: Column) -> Column:
    """Only for types that no register date settles: brighter or unknown is consistent."""
    return F.when((ratio > 0) & ~(matched & approved.isNotNull()), brightness.isNull() | (brightness >= 0))


def unmatched_type(score: Column, area: Column, brightness: Column, score_min: float = 0.6, area_min: float = 50.0) -> Column:
    strong = (F.coalesce(score, F.lit(0.0)) >= score_min) & (F.coalesce(area, F.lit(0.0)) >= area_min)
    return F.when(strong & ~F.coalesce(brightness > 0, F.lit(False)), DEMOLITION).otherwise(OTHER)


def administrative_uncertainty(matched: Column, approved: Column, t1, t2) -> Column:
    return F.when(~matched, 1.0).when(F.coalesce(approved.between(t1, t2), F.lit(False)), 0.1).otherwise(0.6)


def priority_score(confidence: Column, ratio: Column, uncertainty: Column, kind: Column) -> Column:
    clamp = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(x, F.lit(0.0))))
    relevance = F.when(kind.isin(NEW, EXPANSION, DEMOLITION), 1.0).otherwise(0.3)
    total = WEIGHTS["confidence"] * clamp(confidence) + WEIGHTS["ratio"] * clamp(ratio) + WEIGHTS["uncertainty"] * F.coalesce(uncertainty, F.lit(1.0)) + WEIGHTS["relevance"] * relevance
    return F.round(total, 4)


def compensation_status(matched: Column, approved: Column, started: Column, permitted: Column, kind: Column, baseline, t1, t2) -> Column:
    """Whether a change is before or after the baseline date of compensation."""
    earlier = F.least(permitted, started)  # ignores NULL
    by_images = F.when(F.lit(t1) >= F.lit(baseline), "{after}").when(F.lit(t2) <= F.lit(baseline), "PRE_BASELINE").otherwise("STRADDLES_BASELINE")
    register = F.when(approved < F.lit(baseline), "PRE_BASELINE").when(earlier < F.lit(baseline), "POST_BASELINE_PERMITTED").otherwise("POST_BASELINE_UNVERIFIED")
    pick = lambda after: F.when(by_images == "{after}", after).otherwise(by_images)
    return F.when(matched & approved.isNotNull() & (F.coalesce(kind, F.lit("")) == NEW), register).when(~matched, pick("POST_BASELINE_UNVERIFIED")).when(approved.isNull(), "UNKNOWN").otherwise(pick("UNKNOWN"))


def risk(status: Column) -> Column:
    return F.create_map(*(F.lit(x) for kv in RISK.items() for x in kv))[status]


def illegal_grade(matched: Column, kind: Column, ratio: Column, confidence: Column, footprint: Column, registered: Column, consistent: Column, approved: Column, tolerance: float = 1.3) -> dict[str, Column]:
    """Grade, score and excess ratio from three signals; a register record without excess explains the change away."""
    suspect = ~matched & F.coalesce(kind.isin(NEW, EXPANSION), F.lit(False))
    strong = suspect & (F.coalesce(ratio, F.lit(0.0)) >= 0.5) & (F.coalesce(confidence, F.lit(0.0)) >= 0.6)
    excess = F.when((footprint > 0) & (registered > 0), F.round(footprint / registered, 3))
    over = F.coalesce(excess >= tolerance, F.lit(False))
    explained = matched & approved.isNotNull() & F.coalesce(excess < tolerance, F.lit(False))
    score = F.when(strong, 0.45).when(suspect, 0.15).otherwise(0.0) + F.when(over, 0.4).otherwise(0.0) + F.when(F.coalesce(~consistent, F.lit(False)), 0.1).otherwise(0.0)
    signals = strong.cast("int") + over.cast("int")
    grade = F.when(explained, "NONE").when(signals >= 2, "A_STRONG").when(signals == 1, "B_MODERATE").when(score > 0, "C_WEAK").otherwise("NONE")
    return {"illegal_grade": grade, "illegal_score": F.when(explained, 0.0).otherwise(F.round(F.least(score, F.lit(1.0)), 3)), "area_excess_ratio": excess}


def development_stage(area_ratio: Column, new_buildings: Column, persistence: Column, active: Column, site_work: float = 0.1, least: float = 0.03) -> Column:
    return (
        F.when(area_ratio < least, F.when(new_buildings == 0, "NOT_STARTED").otherwise("STABLE"))
        .when(~active, "STABLE")
        .when((area_ratio >= site_work) & (new_buildings == 0), "SITE_WORK")
        .when((new_buildings > 0) & (persistence >= 0.5), "CONSTRUCTION")
        .when(new_buildings > 0, "NEARING_COMPLETION")
        .otherwise("SITE_WORK")
    )


def ranked(df: DataFrame, by: Column, tie: str, group: str, most: int) -> DataFrame:
    """The first rows of each group."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(by, tie))).where(F.col("rank") <= most)
