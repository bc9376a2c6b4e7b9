"""Queries over pixels, series and parcels."""

from __future__ import annotations

from pyspark.sql import functions as F

from groundshift.operators import indices, parcels, raster, series
from groundshift.operators.selection import quantiles
from groundshift.plans.registry import query
from groundshift.sources.tables import ctes, epochs, table

COMPOSITE = dict(exposed_ndvi=0.3, exposed_bsi=0.0, water=0.2, before=0.4, after=0.35, delta=-0.1, increase=0.02, conflict=0.2, recovery=0.4, recovery_delta=0.15, decrease=0.02)

_NDVI = "CASE WHEN n >= 2 AND red > 0 AND nir > 0 AND (nir - red) * 1e0 / (nir + red) BETWEEN -1 AND 1 THEN (nir - red) * 1e0 / (nir + red) END"
_IDX = f"""idx AS (SELECT *, {_NDVI} AS ndvi, CASE WHEN n >= 2 AND swir + red + nir + blue >= 1e-3 THEN ((swir + red) - (nir + blue)) * 1e0 / (swir + red + nir + blue) END AS bsi,
    CASE WHEN n >= 2 AND green + swir >= 1e-3 THEN (green - swir) * 1e0 / (green + swir) END AS mndwi, CASE WHEN n >= 2 THEN (red + green + blue) / 3e0 END AS gray FROM pixels)"""
_EPOCH = "ep AS (SELECT CAST(epoch - min(epoch) OVER () AS INT) AS k, epoch FROM (SELECT CAST(unnest(range(lo, hi + 1)) AS INT) AS epoch FROM (SELECT min(epoch) AS lo, max(epoch) AS hi FROM pixels)))"
_GRID = f"{ctes('pixels')}, {_IDX}, {_EPOCH}, grid AS (SELECT x.r, x.c, ep.epoch, ep.k, i.ndvi, i.bsi, i.mndwi, i.gray, i.n FROM (SELECT DISTINCT r, c FROM pixels) x CROSS JOIN ep LEFT JOIN idx i ON i.r = x.r AND i.c = x.c AND i.epoch = ep.epoch)"
_TH = "before >= 0.4e0 AND ndvi <= 0.35e0 AND ndvi - before <= -0.1e0"
_SERIES = f"""{_GRID}, lagged AS (SELECT *, lag(ndvi) OVER (PARTITION BY r, c ORDER BY k) AS before, count(ndvi) OVER (PARTITION BY r, c) AS n_valid FROM grid),
    ev AS (SELECT *, coalesce({_TH}, FALSE) AND n_valid >= 4 AS event FROM lagged),
    lastk AS (SELECT *, max(CASE WHEN event THEN k END) OVER (PARTITION BY r, c) AS last_k FROM ev),
    per AS (SELECT r, c, max(n_valid) AS n_valid, sum(CASE WHEN event THEN 1 ELSE 0 END) AS frequency, min(CASE WHEN event THEN k END) - 1 AS first_interval,
        sum(CASE WHEN ndvi IS NOT NULL AND k > last_k THEN 1 ELSE 0 END) AS n_follow, coalesce(bool_or(k > last_k AND ndvi >= 0.4e0), FALSE) AS recovered FROM lastk GROUP BY r, c),
    pers AS (SELECT r, c, n_valid, n_valid >= 4 AS evaluable, CAST(frequency AS BIGINT) AS frequency, first_interval,
        CASE WHEN frequency = 0 THEN 'NONE' WHEN recovered THEN 'TEMPORARY' WHEN n_follow >= 1 THEN 'PERSISTENT' ELSE 'UNCONFIRMED' END AS persistence FROM per)"""
_COVER = """cov AS (SELECT pnu, r, c, w * h AS area FROM (SELECT pnu, r, c, least(x1, (c + 1) * 10e0) - greatest(x0, c * 10e0) AS w, least(y1, (r + 1) * 10e0) - greatest(y0, r * 10e0) AS h
    FROM (SELECT *, unnest(range(CAST(floor(x0 / 10) AS INT), CAST(ceil(x1 / 10) AS INT))) AS c FROM (SELECT *, unnest(range(CAST(floor(y0 / 10) AS INT), CAST(ceil(y1 / 10) AS INT))) AS r FROM parcels))) WHERE w > 0 AND h > 0 AND w * h > 1e-6)"""
_DECLINE = dict(before_min=0.4, after_max=0.35, delta_max=-0.1)


def _indexed(spark, sf_dir, source="pixels"):
    return indices.with_indices(table(spark, sf_dir, source))


def _grid(spark, sf_dir, source="pixels"):
    return series.full_grid(_indexed(spark, sf_dir, source).select("r", "c", "epoch", "n", "ndvi", "bsi", "mndwi", "gray"), epochs(spark, sf_dir))


def _persistence(spark, sf_dir, source="pixels"):
    return series.persistence(_grid(spark, sf_dir, source), recovery=0.4, **_DECLINE)


def _cover(spark, sf_dir):
    return parcels.coverage(table(spark, sf_dir, "parcels"), "pnu")


@query("P08_P10_P11_indices", f"WITH {ctes('pixels')}, {_IDX} SELECT epoch, r, c, round(ndvi, 6) AS ndvi, round(bsi, 6) AS bsi, round(mndwi, 6) AS mndwi, round(gray, 6) AS gray, coalesce(mndwi > 0.2e0, FALSE) AS water FROM idx")
def pixel_indices(spark, sf_dir):
    i = _indexed(spark, sf_dir)
    return i.select("epoch", "r", "c", *(F.round(c, 6).alias(c) for c in ("ndvi", "bsi", "mndwi", "gray")), F.coalesce(F.col("mndwi") > 0.2, F.lit(False)).alias("water"))


@query("P05_P06_reflectance", f"WITH {ctes('pixels')} SELECT epoch, r, c, CASE WHEN red > 0 THEN red / 10000e0 END AS red_refl, greatest(1, least(65535, nir - CASE WHEN epoch >= 1998 THEN 1000 ELSE 0 END)) AS nir_dn FROM pixels")
def reflectance(spark, sf_dir):
    p = table(spark, sf_dir, "pixels").withColumn("baseline", F.when(F.col("epoch") >= 1998, "04.00").when(F.col("epoch") >= 1996, "02.14").otherwise("n/a"))
    return p.select("epoch", "r", "c", indices.reflectance(F.col("red")).alias("red_refl"), indices.without_offset(F.col("nir"), indices.boa_offset(F.col("baseline"))).alias("nir_dn"))


@query("P03_gray_of_present", f"WITH {ctes('pixels')}, b AS (SELECT epoch, r, c, nullif(red, 2500) AS red, nullif(green, 0) AS green, nullif(blue, 0) AS blue FROM pixels) SELECT epoch, r, c, round((coalesce(red, 0) + coalesce(green, 0) + coalesce(blue, 0)) * 1e0 / nullif((red IS NOT NULL)::INT + (green IS NOT NULL)::INT + (blue IS NOT NULL)::INT, 0), 6) AS gray FROM b")
def gray_of_present(spark, sf_dir):
    p = table(spark, sf_dir, "pixels")
    return p.select("epoch", "r", "c", F.round(indices.mean_of_present(F.nullif("red", F.lit(2500)), F.nullif("green", F.lit(0)), F.nullif("blue", F.lit(0))), 6).alias("gray"))


@query("P12_P13_decline_events", f"WITH {_SERIES} SELECT r, c, epoch, round(ndvi - before, 6) AS delta, event FROM ev WHERE k > 0")
def decline_events(spark, sf_dir):
    return series.decline_events(_grid(spark, sf_dir), **_DECLINE).where("k > 0").select("r", "c", "epoch", F.round(F.col("ndvi") - F.col("before"), 6).alias("delta"), "event")


@query("P18_exposed_state", f"WITH {ctes('pixels')}, {_IDX} SELECT epoch, CAST(sum(CASE WHEN ndvi <= 0.3e0 AND bsi >= 0e0 THEN 1 ELSE 0 END) AS BIGINT) AS exposed, count(*) AS cells FROM idx GROUP BY epoch")
def exposed_state(spark, sf_dir):
    return _indexed(spark, sf_dir).groupBy("epoch").agg(F.count_if(indices.exposed(F.col("ndvi"), F.col("bsi"))).alias("exposed"), F.count(F.lit(1)).alias("cells"))


@query("W03_persistence", f"WITH {_SERIES} SELECT * FROM pers")
def persistence(spark, sf_dir):
    return _persistence(spark, sf_dir)


@query("W07_first_last", f"WITH {_GRID}, s AS (SELECT r, c, list(ndvi ORDER BY k) FILTER (ndvi IS NOT NULL) AS l FROM grid GROUP BY r, c) SELECT r, c, round(l[1], 6) AS first_ndvi, round(l[len(l)], 6) AS last_ndvi, round(l[len(l)] - l[1], 6) AS change FROM s WHERE len(l) > 0")
def first_last(spark, sf_dir):
    return series.first_last(_grid(spark, sf_dir)).select("r", "c", *(F.round(x, 6).alias(x) for x in ("first_ndvi", "last_ndvi", "change")))


_SHIFT = f"""{_GRID}, d AS (SELECT *, ndvi - lag(ndvi) OVER w AS dn, bsi - lag(bsi) OVER w AS db FROM grid WINDOW w AS (PARTITION BY r, c ORDER BY k)),
    shifts AS (SELECT k, CASE WHEN count(dn) > 100 THEN median(dn) ELSE 0e0 END AS ndvi_shift, CASE WHEN count(CASE WHEN abs(dn) < 0.05e0 THEN db END) > 100 THEN median(CASE WHEN abs(dn) < 0.05e0 THEN db END) ELSE 0e0 END AS bsi_shift, count(dn) AS n FROM d WHERE k > 0 GROUP BY k)"""


@query("A23_A24_interval_shifts", f"WITH {_SHIFT} SELECT k, round(ndvi_shift, 6) AS ndvi_shift, round(bsi_shift, 6) AS bsi_shift, n FROM shifts")
def interval_shifts(spark, sf_dir):
    return series.interval_shifts(_grid(spark, sf_dir)).select("k", F.round("ndvi_shift", 6).alias("ndvi_shift"), F.round("bsi_shift", 6).alias("bsi_shift"), "n")


_C = {k: f"({v}e0)" for k, v in COMPOSITE.items()}
_COMPOSITE = f"""{_SHIFT}, st AS (SELECT *, ndvi IS NOT NULL AND bsi IS NOT NULL AS ok, coalesce(ndvi <= {_C['exposed_ndvi']} AND bsi >= {_C['exposed_bsi']}, FALSE) AS state, coalesce(mndwi > {_C['water']}, FALSE) AS wet,
        count(CASE WHEN ndvi IS NOT NULL AND bsi IS NOT NULL THEN 1 END) OVER (PARTITION BY r, c) AS n_valid FROM grid),
    lg AS (SELECT *, lag(ndvi) OVER w AS ndvi0, lag(bsi) OVER w AS bsi0, lag(ok) OVER w AS ok0, lag(state) OVER w AS state0, lag(wet) OVER w AS wet0 FROM st WINDOW w AS (PARTITION BY r, c ORDER BY k)),
    dd AS (SELECT lg.*, ndvi - ndvi0 - ndvi_shift AS dn, bsi - bsi0 - bsi_shift AS db, coalesce(ok AND ok0, FALSE) AND n_valid >= 3 AS v, wet OR wet0 AS wt FROM lg JOIN shifts USING (k)),
    l AS (SELECT *, v AND ndvi0 >= {_C['before']} AND ndvi <= {_C['after']} AND dn <= {_C['delta']} AS loss, v AND ndvi0 < {_C['recovery']} AND dn >= {_C['recovery_delta']} AND ndvi >= {_C['recovery']} AND db <= -{_C['decrease']} AND NOT wt AS back FROM dd),
    m AS (SELECT *, loss AND db >= {_C['increase']} AND bsi >= {_C['exposed_bsi']} AND NOT wt AS bare, loss AND db <= -{_C['conflict']} AS conflict FROM l),
    events AS (SELECT r, c, k, epoch, CASE WHEN NOT v THEN NULL WHEN bare THEN 2 WHEN loss AND NOT bare AND NOT wt AND NOT conflict THEN 1 WHEN back THEN 3
        WHEN (loss AND (wt OR conflict)) OR (wt AND abs(dn) >= {_C['recovery_delta']}) OR (dn >= {_C['recovery_delta']} AND NOT back AND NOT wt) THEN 4 ELSE 0 END AS event, back AND state0 AS from_exposed FROM m)"""


@query("P19_composite_events", f"WITH {_COMPOSITE} SELECT event, count(*) AS cells, CAST(sum(CASE WHEN from_exposed THEN 1 ELSE 0 END) AS BIGINT) AS from_exposed, k FROM events GROUP BY event, k")
def composite_events(spark, sf_dir):
    g = _grid(spark, sf_dir)
    return series.composite_events(g, series.interval_shifts(g), COMPOSITE).groupBy("event", "k").agg(F.count(F.lit(1)).alias("cells"), F.count_if("from_exposed").alias("from_exposed"))


@query("W17_year_pairs", f"WITH {ctes('pixels')}, y AS (SELECT DISTINCT epoch AS year FROM pixels), s AS (SELECT year AS year_from, lead(year) OVER (ORDER BY year) AS year_to FROM y), st AS (SELECT * FROM s WHERE year_to IS NOT NULL), lt AS (SELECT * FROM (VALUES (1995, 2000), (1995, 1996), (1996, 1999), (1990, 2000)) AS v(year_from, year_to)) SELECT year_from, year_to, 'step' AS pair_kind FROM st UNION ALL SELECT year_from, year_to, 'long_term' FROM lt WHERE (year_from, year_to) NOT IN (SELECT (year_from, year_to) FROM st) AND year_from IN (SELECT year FROM y) AND year_to IN (SELECT year FROM y)")
def year_pairs(spark, sf_dir):
    years = table(spark, sf_dir, "pixels").select(F.col("epoch").alias("year")).distinct()
    return series.year_pairs(years, [(1995, 2000), (1995, 1996), (1996, 1999), (1990, 2000)])


@query("J08_coverage", f"WITH {ctes('parcels')}, {_COVER} SELECT pnu, r, c, round(area, 6) AS area FROM cov")
def coverage(spark, sf_dir):
    return _cover(spark, sf_dir).withColumn("area", F.round("area", 6))


@query("J09_centre_cells", f"WITH {ctes('parcels')}, {_COVER} SELECT cov.pnu, r, c FROM cov JOIN parcels p ON p.pnu = cov.pnu WHERE (c + 0.5e0) * 10 >= x0 AND (c + 0.5e0) * 10 < x1 AND (r + 0.5e0) * 10 >= y0 AND (r + 0.5e0) * 10 < y1")
def centre_cells(spark, sf_dir):
    return parcels.centre_cells(table(spark, sf_dir, "parcels"), "pnu")


@query("A15_weighted_means", f"WITH {ctes('pixels', 'parcels')}, {_IDX}, {_COVER} SELECT pnu, epoch, round(sum(CASE WHEN ndvi IS NOT NULL THEN area * ndvi END) / nullif(sum(CASE WHEN ndvi IS NOT NULL THEN area END), 0), 6) AS mean, round(coalesce(sum(CASE WHEN ndvi IS NOT NULL THEN area END), 0e0), 4) AS valid_area, count(ndvi) AS n_valid FROM cov JOIN idx USING (r, c) GROUP BY pnu, epoch")
def weighted_means(spark, sf_dir):
    return parcels.weighted_means(_cover(spark, sf_dir), _indexed(spark, sf_dir), "pnu", "ndvi").withColumns({"mean": F.round("mean", 6), "valid_area": F.round("valid_area", 4)})


@query("A16_weighted_median", f"WITH {ctes('pixels', 'parcels')}, {_IDX}, {_COVER}, j AS (SELECT pnu, epoch, ndvi, sum(area) OVER (PARTITION BY pnu, epoch ORDER BY ndvi, r, c) AS run, sum(area) OVER (PARTITION BY pnu, epoch) AS whole FROM cov JOIN idx USING (r, c) WHERE ndvi IS NOT NULL) SELECT pnu, epoch, round(min(ndvi), 6) AS median FROM j WHERE run >= whole / 2 GROUP BY pnu, epoch")
def weighted_median(spark, sf_dir):
    return parcels.weighted_median(_cover(spark, sf_dir), _indexed(spark, sf_dir), "pnu", "ndvi").withColumn("median", F.round("median", 6))


_MASKS = {"evaluable_area": "evaluable", "decline_area": "frequency > 0", "persistent_area": "persistence = 'PERSISTENT'", "temporary_area": "persistence = 'TEMPORARY'", "unconfirmed_area": "persistence = 'UNCONFIRMED'", "repeated_area": "frequency >= 2"}
_AREAS = f"{_SERIES}, {ctes('parcels')}, {_COVER}, areas AS (SELECT pnu, sum(area) AS area_m2, " + ", ".join(f"coalesce(sum(CASE WHEN {m} THEN area END), 0e0) AS {a}" for a, m in _MASKS.items()) + " FROM cov LEFT JOIN pers USING (r, c) GROUP BY pnu)"


def _areas(spark, sf_dir):
    return parcels.area_where(_cover(spark, sf_dir), _persistence(spark, sf_dir), "pnu", **{a: F.expr(m) for a, m in _MASKS.items()})


@query("A18_A19_decline_areas", f"WITH {_AREAS} SELECT pnu, " + ", ".join(f"round({a}, 4) AS {a}" for a in ("area_m2", *_MASKS)) + " FROM areas")
def decline_areas(spark, sf_dir):
    return _areas(spark, sf_dir).select("pnu", *(F.round(a, 4).alias(a) for a in ("area_m2", *_MASKS)))


_DIST = """dist AS (SELECT pnu, min(sqrt(pow(x - xa - t * (xb - xa), 2) + pow(y - ya - t * (yb - ya), 2))) AS distance FROM (SELECT *, greatest(0e0, least(1e0, ((x - xa) * (xb - xa) + (y - ya) * (yb - ya)) / ((xb - xa) * (xb - xa) + (yb - ya) * (yb - ya)))) AS t
    FROM (SELECT pnu, (x0 + x1) / 2 AS x, (y0 + y1) / 2 AS y FROM parcels) CROSS JOIN rail) GROUP BY pnu)"""


@query("J20_rail_distance", f"WITH {ctes('parcels', 'rail')}, {_DIST} SELECT pnu, round(distance, 6) AS distance, distance <= 100 AS within_100m FROM dist")
def rail_distance(spark, sf_dir):
    d = parcels.segment_distance(table(spark, sf_dir, "parcels"), table(spark, sf_dir, "rail"), "pnu")
    return d.select("pnu", F.round("distance", 6).alias("distance"), (F.col("distance") <= 100).alias("within_100m"))


_PRIO = f"""{_AREAS}, {ctes('rail')}, {_DIST}, j AS (SELECT areas.*, distance AS rail_distance, decline_area / nullif(evaluable_area, 0) AS decline_ratio,
        CASE WHEN decline_area <= 0 THEN 'NONE' WHEN persistent_area >= temporary_area AND persistent_area >= unconfirmed_area THEN 'PERSISTENT' WHEN temporary_area >= unconfirmed_area THEN 'TEMPORARY' ELSE 'UNCONFIRMED' END AS persistence_status FROM areas JOIN dist USING (pnu)),
    s AS (SELECT *, greatest(0e0, least(1e0, coalesce(decline_ratio, 0e0) / 0.5e0)) * 100 AS score_ratio, CASE persistence_status WHEN 'PERSISTENT' THEN 100e0 WHEN 'UNCONFIRMED' THEN 50e0 WHEN 'TEMPORARY' THEN 30e0 ELSE 0e0 END AS score_persistence,
        greatest(0e0, least(1e0, (500e0 - rail_distance) / 500e0)) * 100 AS score_rail, decline_area >= 300 AS candidate FROM j),
    p AS (SELECT *, (0.4e0 * score_ratio + 0.35e0 * score_persistence + 0.25e0 * score_rail) / (0.4e0 + 0.35e0 + 0.25e0) AS priority_score FROM s)"""


@query("E04_parcel_priority", f"WITH {_PRIO} SELECT pnu, persistence_status, round(decline_area, 4) AS decline_area, round(priority_score, 6) AS priority_score, CASE WHEN candidate THEN row_number() OVER (PARTITION BY candidate ORDER BY round(priority_score, 9) DESC, round(decline_area, 6) DESC, pnu) END AS priority_rank, CASE WHEN NOT candidate THEN 'NONE' WHEN round(priority_score, 9) >= 60 THEN 'HIGH' WHEN round(priority_score, 9) >= 40 THEN 'MEDIUM' ELSE 'LOW' END AS tier FROM p")
def parcel_priority(spark, sf_dir):
    a = _areas(spark, sf_dir)
    d = parcels.segment_distance(table(spark, sf_dir, "parcels"), table(spark, sf_dir, "rail"), "pnu").withColumnRenamed("distance", "rail_distance")
    p, t, u = F.col("persistent_area"), F.col("temporary_area"), F.col("unconfirmed_area")
    status = F.when(F.col("decline_area") <= 0, "NONE").when((p >= t) & (p >= u), "PERSISTENT").when(t >= u, "TEMPORARY").otherwise("UNCONFIRMED")
    ratio = F.when(F.col("evaluable_area") > 0, F.col("decline_area") / F.col("evaluable_area"))
    out = parcels.priority(a.join(d, "pnu").withColumns({"persistence_status": status, "decline_ratio": ratio}))
    return out.select("pnu", "persistence_status", F.round("decline_area", 4).alias("decline_area"), F.round("priority_score", 6).alias("priority_score"), "priority_rank", "tier")


@query("A21_area_summary", f"WITH {_SERIES} SELECT count(*) AS cells, CAST(sum(CASE WHEN evaluable THEN 1 ELSE 0 END) AS BIGINT) AS evaluable, CAST(sum(CASE WHEN frequency > 0 THEN 1 ELSE 0 END) AS BIGINT) AS declined, CAST(sum(CASE WHEN persistence = 'PERSISTENT' THEN 1 ELSE 0 END) AS BIGINT) AS persistent FROM pers")
def area_summary(spark, sf_dir):
    return _persistence(spark, sf_dir).agg(F.count(F.lit(1)).alias("cells"), F.count_if("evaluable").alias("evaluable"), F.count_if(F.col("frequency") > 0).alias("declined"), F.count_if(F.col("persistence") == "PERSISTENT").alias("persistent"))


@query("A25_raster_quality", f"WITH {ctes('pixels')}, {_IDX} SELECT epoch, count(*) AS cells, count(ndvi) AS valid, round(min(ndvi), 6) AS lo, round(max(ndvi), 6) AS hi, round(median(ndvi), 6) AS med, round(quantile_cont(ndvi, 0.05), 6) AS p05, round(quantile_cont(ndvi, 0.95), 6) AS p95, round(quantile_cont(red, 0.005), 6) AS dark, round(avg(CASE WHEN nir > 4000 THEN 1e0 ELSE 0e0 END), 6) AS bright FROM idx GROUP BY epoch")
def raster_quality(spark, sf_dir):
    i = _indexed(spark, sf_dir)
    v = i.select("epoch", F.explode(F.array(F.struct(F.lit("ndvi").alias("band"), F.col("ndvi").alias("v")), F.struct(F.lit("red").alias("band"), F.col("red").cast("double").alias("v")))).alias("x")).select("epoch", "x.*")
    q = quantiles(v, ["epoch", "band"], [0.005, 0.05, 0.5, 0.95])
    at = lambda band, p, name: F.round(F.max(F.when((F.col("band") == band) & (F.col("p") == p), F.col("value"))), 6).alias(name)
    q = q.groupBy("epoch").agg(at("ndvi", 0.5, "med"), at("ndvi", 0.05, "p05"), at("ndvi", 0.95, "p95"), at("red", 0.005, "dark"))
    g = i.groupBy("epoch").agg(F.count(F.lit(1)).alias("cells"), F.count("ndvi").alias("valid"), F.round(F.min("ndvi"), 6).alias("lo"), F.round(F.max("ndvi"), 6).alias("hi"), F.round(F.avg((F.col("nir") > 4000).cast("double")), 6).alias("bright"))
    return g.join(q, "epoch")


@query("A26_year_correlation", f"WITH {_GRID}, p AS (SELECT k, ndvi, lag(ndvi) OVER (PARTITION BY r, c ORDER BY k) AS b FROM grid) SELECT k, count(*) AS n, CASE WHEN count(*) > 10 THEN round(corr(ndvi, b), 6) END AS r FROM p WHERE ndvi IS NOT NULL AND b IS NOT NULL GROUP BY k")
def year_correlation(spark, sf_dir):
    p = _grid(spark, sf_dir).withColumn("b", F.lag("ndvi").over(series.cell().orderBy("k"))).where("ndvi is not null and b is not null")
    return p.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.when(F.count(F.lit(1)) > 10, F.round(F.corr("ndvi", "b"), 6)).alias("r"))


@query("A05_block_mean", f"WITH {ctes('pixels')}, {_IDX} SELECT epoch, CAST(floor(r / 2) AS INT) AS r, CAST(floor(c / 2) AS INT) AS c, CASE WHEN count(ndvi) >= 2 THEN round(avg(ndvi), 6) END AS ndvi, count(ndvi) AS n FROM idx GROUP BY 1, 2, 3")
def block_mean(spark, sf_dir):
    half = lambda c: F.floor(F.col(c) / 2).cast("int").alias(c)
    return _indexed(spark, sf_dir).groupBy("epoch", half("r"), half("c")).agg(F.when(F.count("ndvi") >= 2, F.round(F.avg("ndvi"), 6)).alias("ndvi"), F.count("ndvi").alias("n"))


_ROBUST = f"""{ctes('pixels')}, bd AS (SELECT epoch, r, c, unnest(['red', 'nir', 'green']) AS band, unnest([red, nir, green]) AS v FROM pixels), ch AS (SELECT b.epoch AS k, b.r, b.c, b.band, b.v - a.v AS d FROM bd a JOIN bd b ON a.r = b.r AND a.c = b.c AND a.band = b.band AND b.epoch = a.epoch + 1),
    cm AS (SELECT k, band, median(d) AS m, stddev_pop(d) AS sd FROM ch GROUP BY k, band), cs AS (SELECT k, band, m, CASE WHEN median(abs(d - m)) > 0 THEN median(abs(d - m)) * 1.4826e0 ELSE any_value(sd) END AS s FROM ch JOIN cm USING (k, band) GROUP BY k, band, m),
    cg AS (SELECT k, r, c, sqrt(sum(CASE WHEN s > 0 THEN pow((d - m) / s, 2) ELSE 0e0 END)) AS mag FROM ch JOIN cs USING (k, band) GROUP BY k, r, c), cq AS (SELECT k, quantile_cont(mag, 0.99) AS top FROM cg GROUP BY k),
    robust AS (SELECT k, r, c, CASE WHEN top > 0 THEN greatest(0e0, least(1e0, mag / top)) ELSE 0e0 END AS score FROM cg JOIN cq USING (k))"""


def _robust(spark, sf_dir):
    """Change vector analysis of every pair of consecutive years."""
    order = series.cell().orderBy("epoch")
    band = lambda x: F.struct(F.lit(x).alias("band"), (F.col(x) - F.lag(x).over(order)).alias("d"))
    p = table(spark, sf_dir, "pixels").select("r", "c", F.col("epoch").alias("k"), (F.lag("epoch").over(order) + 1).alias("next"), F.array(*map(band, ("red", "nir", "green"))).alias("x"))
    return raster.robust_change(p.where("k = next").select("k", "r", "c", F.explode("x").alias("x")).select("k", "r", "c", "x.*"))


@query("A01_robust_change", f"WITH {_ROBUST} SELECT k, r, c, round(score, 6) AS score FROM robust")
def robust_change(spark, sf_dir):
    return _robust(spark, sf_dir).withColumn("score", F.round("score", 6))


@query("A46_transitions", f"WITH {_GRID}, t AS (SELECT k, ndvi >= 0.4e0 AS v2, lag(ndvi) OVER (PARTITION BY r, c ORDER BY k) >= 0.4e0 AS v1 FROM grid) SELECT k, v1, v2, count(*) * 100 AS area_m2 FROM t WHERE v1 IS NOT NULL AND v2 IS NOT NULL GROUP BY k, v1, v2")
def transitions(spark, sf_dir):
    t = _grid(spark, sf_dir).select("k", (F.col("ndvi") >= 0.4).alias("v2"), (F.lag("ndvi").over(series.cell().orderBy("k")) >= 0.4).alias("v1"))
    return t.where("v1 is not null and v2 is not null").groupBy("k", "v1", "v2").agg((F.count(F.lit(1)) * 100).alias("area_m2"))


@query("A51_land_cover_share", f"WITH {ctes('classes', 'parcels')}, {_COVER} SELECT pnu, cls, round(sum(area), 4) AS area, round(sum(area) / sum(sum(area)) OVER (PARTITION BY pnu), 6) AS share FROM cov JOIN classes USING (r, c) GROUP BY pnu, cls")
def land_cover_share(spark, sf_dir):
    from pyspark.sql import Window

    g = _cover(spark, sf_dir).join(table(spark, sf_dir, "classes"), ["r", "c"]).groupBy("pnu", "cls").agg(F.sum("area").alias("area"))
    return g.select("pnu", "cls", F.round("area", 4).alias("area"), F.round(F.col("area") / F.sum("area").over(Window.partitionBy("pnu")), 6).alias("share"))
