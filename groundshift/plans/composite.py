"""Queries of composite cell and parcel types."""

from __future__ import annotations

from pyspark.sql import functions as F

from groundshift.operators import composite as comp
from groundshift.operators import parcels, series
from groundshift.operators.components import written
from groundshift.plans.land import _AREAS, _C, _COMPOSITE, _COVER, COMPOSITE, _areas, _cover, _grid, _indexed
from groundshift.plans.registry import query
from groundshift.sources.tables import ctes, epochs, table

_TYPES = f"""{_COMPOSITE}, le AS (SELECT *, max(CASE WHEN event = 2 THEN k END) OVER (PARTITION BY r, c) AS last_exposed FROM events),
    jj AS (SELECT st.*, le.event, le.from_exposed, max(le.last_exposed) OVER (PARTITION BY st.r, st.c) AS last_exposed FROM st LEFT JOIN le ON le.r = st.r AND le.c = st.c AND le.k = st.k),
    ag AS (SELECT r, c, count(*) FILTER (ok) AS n_valid, coalesce(bool_or(event = 1), FALSE) AS loss, coalesce(bool_or(event = 2), FALSE) AS bare, coalesce(bool_or(event = 3), FALSE) AS back, coalesce(bool_or(event = 4), FALSE) AS unsure,
        min(CASE WHEN event BETWEEN 1 AND 4 THEN k END) AS first_change, min(CASE WHEN event = 2 THEN k END) AS first_exposed, count(*) FILTER (ok AND k > last_exposed) AS n_later,
        coalesce(bool_or(ok AND k > last_exposed AND ndvi >= {_C['recovery']}), FALSE) AS green_again, coalesce(bool_and(CASE WHEN ok AND k > last_exposed THEN state END), TRUE) AS still, count(*) FILTER (ok AND state) AS n_exposed,
        coalesce(bool_and(CASE WHEN ok THEN ndvi >= {_C['before']} END), TRUE) AS always_green, coalesce(bool_or(from_exposed), FALSE) AS from_exposed FROM jj GROUP BY r, c),
    ty AS (SELECT *, CASE WHEN NOT bare THEN 'NONE' WHEN green_again THEN 'REVEGETATED' WHEN n_later < 1 THEN 'UNCONFIRMED' WHEN still THEN 'PERSISTENT' ELSE 'PARTIAL' END AS follow,
        CASE WHEN n_valid < 3 THEN NULL WHEN bare THEN 'EXPOSED_SURFACE_INCREASE' WHEN loss THEN 'VEGETATION_LOSS' WHEN back THEN 'VEGETATION_RECOVERY' WHEN n_exposed >= 4 THEN 'PERSISTENT_EXPOSED_SURFACE' WHEN always_green AND first_change IS NULL THEN 'STABLE_VEGETATION' WHEN unsure THEN 'UNCERTAIN_CHANGE' ELSE 'NONE' END AS type FROM ag),
    types AS (SELECT r, c, n_valid, first_change, first_exposed, follow, type, CASE WHEN type = 'STABLE_VEGETATION' OR (type = 'EXPOSED_SURFACE_INCREASE' AND follow = 'PERSISTENT') THEN 3 WHEN type IN ('EXPOSED_SURFACE_INCREASE', 'PERSISTENT_EXPOSED_SURFACE', 'VEGETATION_RECOVERY') THEN 2 WHEN type IN ('VEGETATION_LOSS', 'UNCERTAIN_CHANGE') THEN 1 ELSE 0 END AS confidence, from_exposed FROM ty)"""


def _types(spark, sf_dir, source="pixels"):
    g = written(_grid(spark, sf_dir, source))  # read by the shifts, the events and the types
    return comp.cell_types(g, series.composite_events(g, series.interval_shifts(g), COMPOSITE), COMPOSITE)


@query("W04_P20_P21_cell_types", f"WITH {_TYPES} SELECT * FROM types")
def cell_types(spark, sf_dir):
    return _types(spark, sf_dir)


_MASK = {"exposed": "EXPOSED_SURFACE_INCREASE", "loss": "VEGETATION_LOSS", "recovery": "VEGETATION_RECOVERY", "persistent": "PERSISTENT_EXPOSED_SURFACE", "uncertain": "UNCERTAIN_CHANGE", "stable": "STABLE_VEGETATION"}
_PT = f"{_TYPES}, {ctes('parcels')}, {_COVER}, pa AS (SELECT pnu, sum(area) AS area_m2, coalesce(sum(CASE WHEN type IS NOT NULL THEN area END), 0e0) AS evaluable, " + ", ".join(f"coalesce(sum(CASE WHEN type = '{t}' THEN area END), 0e0) AS {m}" for m, t in _MASK.items()) + " FROM cov LEFT JOIN types USING (r, c) GROUP BY pnu)"
_OK = lambda m: f"({m} >= 100 AND {m} / greatest(evaluable, 1e0) >= 0.1e0)"


@query("A20_P34_parcel_type", f"WITH {_PT} SELECT pnu, round(evaluable, 4) AS evaluable, round(exposed, 4) AS exposed, round(loss, 4) AS loss, CASE WHEN area_m2 < 100 OR evaluable < 100 THEN 'INSUFFICIENT_DATA' WHEN {_OK('exposed')} THEN 'EXPOSED_SURFACE_INCREASE' WHEN {_OK('loss')} THEN 'VEGETATION_LOSS' WHEN {_OK('recovery')} THEN 'VEGETATION_RECOVERY' WHEN {_OK('persistent')} THEN 'PERSISTENT_EXPOSED_SURFACE' WHEN {_OK('uncertain')} THEN 'UNCERTAIN_CHANGE' WHEN stable / greatest(evaluable, 1e0) >= 0.5e0 THEN 'STABLE_VEGETATION' ELSE 'NO_SIGNIFICANT_CHANGE' END AS composite_type FROM pa")
def parcel_type(spark, sf_dir):
    masks = {m: F.col("type") == t for m, t in _MASK.items()}
    a = parcels.area_where(_cover(spark, sf_dir), _types(spark, sf_dir), "pnu", evaluable=F.col("type").isNotNull(), **masks)
    kind = comp.parcel_type(F.col("area_m2"), F.col("evaluable"), {m: F.col(m) for m in masks}, least=100.0)
    return a.select("pnu", *(F.round(c, 4).alias(c) for c in ("evaluable", "exposed", "loss")), kind.alias("composite_type"))


_ST = f"""{_AREAS}, wm AS (SELECT pnu, epoch, sum(CASE WHEN ndvi IS NOT NULL THEN area * ndvi END) / nullif(sum(CASE WHEN ndvi IS NOT NULL THEN area END), 0) AS mean, coalesce(sum(CASE WHEN ndvi IS NOT NULL THEN area END), 0e0) AS va FROM cov JOIN idx USING (r, c) GROUP BY pnu, epoch),
    wl AS (SELECT a.pnu, e.k, w.mean, coalesce(w.va, 0e0) / a.area_m2 AS frac FROM areas a CROSS JOIN ep e LEFT JOIN wm w ON w.pnu = a.pnu AND w.epoch = e.epoch),
    ws AS (SELECT pnu, list(mean ORDER BY k) FILTER (mean IS NOT NULL) AS m, list(frac ORDER BY k) AS f, count(*) FILTER (frac >= 0.5e0) AS n_valid_years FROM wl GROUP BY pnu),
    fl AS (SELECT *, list_filter([CASE WHEN evaluable_area <= 0 OR list_max(f) <= 0 THEN 'NOT_EVALUABLE' END, CASE WHEN area_m2 / 100 < 4 THEN 'LOW_PIXEL_COUNT' END, CASE WHEN evaluable_area / area_m2 < 0.8e0 THEN 'LOW_COVERAGE' END, CASE WHEN list_min(f) < 0.5e0 THEN 'CLOUD_CONTAMINATION' END], lambda x: x IS NOT NULL) AS flags FROM areas JOIN ws USING (pnu)),
    sx AS (SELECT *, list_avg(m) AS mu, sqrt(list_avg(list_transform(m, lambda x: (x - list_avg(m)) * (x - list_avg(m))))) AS sd, m[len(m)] - m[1] AS delta, list_contains(flags, 'NOT_EVALUABLE') OR n_valid_years < 4 OR evaluable_area < 400 AS bad FROM fl)"""
_SOK = lambda a: f"({a} >= 300 AND {a} / evaluable_area >= 0.1e0)"


@query("P31_P32_P33_series_type", f"WITH {_ST} SELECT pnu, n_valid_years, CASE WHEN len(flags) = 0 THEN 'VALID' ELSE array_to_string(flags, ';') END AS quality_flags, CASE WHEN len(flags) = 0 THEN 'VALID' ELSE flags[1] END AS quality_status, CASE WHEN bad OR len(m) < 2 THEN 'INSUFFICIENT_DATA' WHEN {_SOK('persistent_area')} THEN 'PERSISTENT_DECLINE' WHEN {_SOK('temporary_area')} THEN 'TEMPORARY_DECLINE' WHEN {_SOK('unconfirmed_area')} THEN 'DECLINE_UNCONFIRMED' WHEN {_SOK('decline_area')} THEN CASE WHEN persistent_area >= temporary_area AND persistent_area >= unconfirmed_area THEN 'PERSISTENT_DECLINE' WHEN temporary_area >= unconfirmed_area THEN 'TEMPORARY_DECLINE' ELSE 'DECLINE_UNCONFIRMED' END WHEN delta >= 0.1e0 THEN 'RECOVERY' WHEN sd >= 0.1e0 THEN 'FLUCTUATING' WHEN delta <= -0.1e0 THEN 'GRADUAL_DECLINE' WHEN mu >= 0.35e0 THEN 'STABLE_VEGETATION' ELSE 'STABLE_NON_VEGETATION' END AS change_type, CASE WHEN bad OR len(m) < 2 THEN 'NONE' WHEN len(flags) > 0 THEN 'LOW' WHEN n_valid_years < (SELECT count(*) FROM ep) THEN 'MEDIUM' ELSE 'HIGH' END AS analysis_confidence FROM sx")
def series_type(spark, sf_dir):
    a = _areas(spark, sf_dir)
    w = parcels.weighted_means(_cover(spark, sf_dir), _indexed(spark, sf_dir), "pnu", "ndvi").groupBy("pnu").agg(F.map_from_entries(F.collect_list(F.struct("epoch", F.struct("mean", "valid_area")))).alias("by"))
    observed = epochs(spark, sf_dir)
    years = F.array(*map(F.lit, observed)).cast("array<int>")
    j = a.join(w, "pnu", "left")
    j = j.withColumns({"means": F.transform(years, lambda y: F.try_element_at("by", y)["mean"]), "fractions": F.transform(years, lambda y: F.coalesce(F.try_element_at("by", y)["valid_area"], F.lit(0.0)) / F.col("area_m2"))})
    j = j.withColumns({"n_valid_years": F.size(F.filter("fractions", lambda x: x >= 0.5)).cast("bigint"), "flags": comp.quality_flags(F.col("area_m2"), F.col("evaluable_area"), F.col("fractions"))})
    bad = F.array_contains("flags", "NOT_EVALUABLE") | (F.col("n_valid_years") < 4) | (F.col("evaluable_area") < 400)
    kind = comp.series_type(F.col("evaluable_area"), F.col("persistent_area"), F.col("temporary_area"), F.col("unconfirmed_area"), F.col("decline_area"), F.col("means"), bad)
    j = j.withColumn("change_type", kind)
    fine = F.size("flags") == 0
    confidence = F.when(F.col("change_type") == "INSUFFICIENT_DATA", "NONE").when(~fine, "LOW").when(F.col("n_valid_years") < len(observed), "MEDIUM").otherwise("HIGH")
    return j.select("pnu", "n_valid_years", F.when(fine, "VALID").otherwise(F.array_join("flags", ";")).alias("quality_flags"), F.when(fine, "VALID").otherwise(F.try_element_at("flags", F.lit(1))).alias("quality_status"), "change_type", confidence.alias("analysis_confidence"))
