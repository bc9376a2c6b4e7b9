"""Change scores of two dates and what is told from them: distance, ensemble, thresholds, brightness, rankings, context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Land categories by their first character, and which are farmland or developed.
LAND = {"전": "전", "답": "답", "과": "과수원", "목": "목장용지", "임": "임야", "광": "광천지", "염": "염전", "대": "대", "장": "공장용지", "학": "학교용지", "차": "주차장", "주": "주유소", "창": "창고용지", "도": "도로", "철": "철도용지", "제": "제방", "천": "하천", "구": "구거", "유": "유지", "양": "양어장", "수": "수도용지", "공": "공원", "체": "체육용지", "원": "유원지", "종": "종교용지", "사": "사적지", "묘": "묘지", "잡": "잡종지"}
FARMLAND = ["전", "답", "과"]
DEVELOPED = ["대", "공장용지", "잡종지", "도로", "철도용지", "창고용지", "주유소", "주차장"]
CHANGED = ["EXPOSED_SURFACE_INCREASE", "VEGETATION_LOSS", "VEGETATION_RECOVERY", "UNCERTAIN_CHANGE"]
#: Land-cover codes.
COVER = {1: "water", 2: "trees", 4: "flooded_veg", 5: "crops", 7: "built", 8: "bare", 9: "snow", 10: "clouds", 11: "rangeland"}


def looked_up(code: Column, names: dict) -> Column:
    """The name of a code; NULL for one that is not in the list."""
    return F.create_map(*(F.lit(x) for kv in names.items() for x in kv))[code]


def date_pairs(pixels: DataFrame, bands: list[str], valid: Column, only: tuple[int, int] | None = None) -> DataFrame:
    """k, r, c, valid (at both dates), and each band at both dates as {band}_1, {band}_2, of the cells that both dates have. k is the later date of each pair of consecutive years;
    with only, the pair of these two dates alone. One window by cell, no join."""
    p = pixels if only is None else pixels.where(F.col("epoch").isin(*only))
    step = 1 if only is None else only[1] - only[0]
    order = Window.partitionBy("r", "c").orderBy("epoch")
    before = F.lag(F.struct("epoch", valid.alias("valid"), *bands)).over(order)
    j = p.withColumn("__a", before).where(F.col("__a.epoch") == F.col("epoch") - step)
    both = F.coalesce(valid & F.col("__a.valid"), F.lit(False))
    return j.select(F.col("epoch").alias("k"), "r", "c", both.alias("valid"), *(F.col(f"__a.{b}" if i == 1 else b).alias(f"{b}_{i}") for b in bands for i in (1, 2)))


def spectral_distance(cells: DataFrame, bands: list[str], name: str = "spectral") -> DataFrame:
    """cells (k, ...) with the Euclidean distance of the two dates' bands over the largest one of the pair; 0 where all are 0."""
    far = F.sqrt(sum((F.pow(F.col(f"{b}_1") - F.col(f"{b}_2"), F.lit(2)) for b in bands), F.lit(0.0)))
    d = cells.withColumn(name, far)
    most = d.groupBy("k").agg(F.max(name).alias("__most"))  # a row for each pair of dates
    return d.join(F.broadcast(most), "k").withColumn(name, F.when(F.col("__most") > 0, F.col(name) / F.col("__most")).otherwise(F.lit(0.0))).drop("__most")


def ensemble(weights: dict[str, float]) -> Column:
    return sum((F.lit(w) * F.col(c) for c, w in weights.items()), F.lit(0.0))


def masked(cells: DataFrame, score: str, method: str, threshold: float) -> DataFrame:
    """cells (k, ...) with mask: a score at or above the threshold where valid; "otsu" takes the threshold of each pair from its valid scores, and the given one where they are all equal.
    An unknown method is an error."""
    if method not in ("fixed", "otsu"):
        raise ValueError(f"unknown threshold method {method}")
    if method == "fixed":
        return cells.withColumn("mask", (F.col(score) >= threshold) & F.col("valid"))
    t = plateau_otsu(cells.where("valid"), score, threshold)  # a row for each pair of dates
    return cells.join(F.broadcast(t), "k", "left").withColumn("mask", (F.col(score) >= F.coalesce("threshold", F.lit(threshold))) & F.col("valid")).drop("threshold")


def plateau_otsu(values: DataFrame, value: str, fallback: float = 0.5, bins: int = 256) -> DataFrame:
    """(k, threshold) for each k with values: the threshold of largest variance between classes; of bins tied within 1e-9 the middle one; fallback where all values are equal.
    Windows run over a row for each bin of a k."""
    v = values.where(F.col(value).isNotNull() & ~F.isnan(value)).select("k", F.col(value).cast("double").alias("v"))
    ends = v.groupBy("k").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    at = F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1)).cast("int")
    counted = v.join(F.broadcast(ends), "k").where("hi > lo").groupBy("k", at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = ends.where("hi > lo").withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))).join(counted, ["k", "bin"], "left")
    h = every.select("k", "bin", F.coalesce("n", F.lit(0)).cast("double").alias("n"), (F.col("lo") + (F.col("bin") + 0.5) * (F.col("hi") - F.col("lo")) / bins).alias("centre"))
    order = Window.partitionBy("k").orderBy("bin")
    below, above = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(1, Window.unboundedFollowing)
    w = h.withColumns({"w1": F.sum("n").over(below), "s1": F.sum(F.col("n") * F.col("centre")).over(below), "w2": F.sum("n").over(above), "s2": F.sum(F.col("n") * F.col("centre")).over(above)})
    w = w.where("w1 > 0 and w2 > 0").withColumn("variance", F.col("w1") * F.col("w2") * F.pow(F.col("s1") / F.col("w1") - F.col("s2") / F.col("w2"), F.lit(2)))
    w = w.withColumn("best", F.max("variance").over(Window.partitionBy("k")))
    tied = w.where("best > 0 and variance >= best * (1 - 1e-9)").groupBy("k").agg(F.array_sort(F.collect_list(F.struct("bin", "centre"))).alias("l"))
    middle = F.get("l", F.floor(F.size("l") / 2).cast("int")).getField("centre")
    return ends.select("k").join(tied, "k", "left").select("k", F.coalesce(middle, F.lit(fallback)).alias("threshold"))


def strength(i: Column, p: Column) -> Column:
    """Label of a spatial autocorrelation."""
    return F.when(p.isNull() | (p >= 0.05), "통계적으로 유의하지 않은").when(i < 0.3, "약한 양의").when(i < 0.6, "중간 정도의 양의").otherwise("강한 양의")


def roi(hotspots: DataFrame, buffer: float = 300.0, least: float = 500.0, most: float | None = None) -> DataFrame:
    """Squares around boxes x0, y0, x1, y1: widened by buffer, of a least side, cut to a largest one about the centre."""
    side = F.greatest(F.col("x1") - F.col("x0") + 2 * buffer, F.col("y1") - F.col("y0") + 2 * buffer, F.lit(least))
    clipped = side > most if most is not None else F.lit(False)
    h = hotspots.withColumns({"roi_clipped": clipped, "side": F.when(clipped, F.lit(most)).otherwise(side), "cx": (F.col("x0") + F.col("x1")) / 2, "cy": (F.col("y0") + F.col("y1")) / 2})
    half = F.col("side") / 2
    return h.select(*hotspots.columns, "roi_clipped", F.round("side", 1).alias("roi_size_m"), F.round(F.col("side") * F.col("side") / 1e6, 3).alias("roi_area_km2"), (F.col("cx") - half).alias("rx0"), (F.col("cy") - half).alias("ry0"), (F.col("cx") + half).alias("rx1"), (F.col("cy") + half).alias("ry1"))


def acquisition_years(pairs: DataFrame, years: DataFrame, active: float = 0.25) -> DataFrame:
    """year, role for the images to be ordered: before, at and after the steps of much change; both ends where nothing changed. pairs: year_from, year_to, kind, area_m2, a row for each pair of years."""
    step = pairs.where("kind = 'step'")
    top = step.agg(F.max("area_m2").alias("top"))
    a = step.crossJoin(F.broadcast(top)).where(F.col("top") > 0).where(F.col("area_m2") >= active * F.col("top"))
    ends = a.agg(F.min_by("year_from", "year_from").alias("first"), F.max("year_to").alias("last"))
    told = lambda year, role, prio: F.struct(year.alias("year"), F.lit(role).alias("role"), F.lit(prio).alias("prio"))
    rows = a.select(F.explode(F.array(told(F.col("year_to"), "변화 검출/진행", 1), told(F.when(F.col("year_to") - F.col("year_from") >= 2, F.floor((F.col("year_from") + F.col("year_to")) / 2)).cast("int"), "중간 연도(변화 시점 좁히기)", 1))).alias("x"))
    rows = rows.unionByName(ends.select(told(F.col("first"), "변화 전 baseline", 0).alias("x")))
    later = years.crossJoin(F.broadcast(ends)).where("year > last").agg(F.min("year").alias("year"))
    rows = rows.unionByName(later.select(told(F.col("year"), "변화 후 안정화 확인", 2).alias("x")))
    still = years.agg(F.min("year").alias("lo"), F.max("year").alias("hi")).crossJoin(F.broadcast(top)).where("top <= 0")
    rows = rows.unionByName(still.select(F.explode(F.array(told(F.col("lo"), "비교 anchor", 0), told(F.col("hi"), "비교 anchor", 0))).alias("x")))
    return rows.select("x.*").where("year is not null").groupBy("year").agg(F.min_by("role", "prio").alias("role"))


def agricultural(jimok: Column, cropland: Column, disadvantaged: Column, crops: Column, least: float = 0.5) -> Column:
    """What speaks for farmland, joined by commas."""
    parts = [(jimok.isin(FARMLAND), "지목(전·답·과)"), (cropland >= least, "산림입지도 경작지"), (disadvantaged >= least, "영농여건불리농지"), (F.coalesce(crops, F.lit(0.0)) >= least, "LULC crops")]
    return F.array_join(F.array_compact(F.array(*(F.when(c, F.lit(t)) for c, t in parts))), ",")


def confusion_risk(kind: Column, farmland: Column, built: Column, jimok: Column) -> Column:
    """What a change may be mistaken for, joined by semicolons."""
    changed = kind.isin(CHANGED)
    parts = [(farmland & changed, "FARMLAND_VARIATION_POSSIBLE"), (changed & ((F.coalesce(built, F.lit(0.0)) >= 0.5) | jimok.isin(DEVELOPED)), "BUILT_OR_DEVELOPED_CONTEXT"), ((jimok == "임야") & changed, "FOREST_MANAGEMENT_OR_CLEARING_POSSIBLE")]
    return F.array_join(F.array_compact(F.array(*(F.when(c, F.lit(t)) for c, t in parts))), ";")


def valid_ring(ring: Column) -> Column:
    """A closed ring of four points or more with an area."""
    n = F.size(ring)
    pairs = F.zip_with(F.slice(ring, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(ring, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a, b: a.x * b.y - b.x * a.y)
    twice = F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x)
    return F.coalesce((n >= 4) & (F.get(ring, F.lit(0)) == F.get(ring, n - 1)) & (F.abs(twice) > 0), F.lit(False))
