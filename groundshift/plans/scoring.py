"""Queries of change scores, brightness, rankings and context, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from groundshift.functions import keys
from groundshift.operators import components as cc
from groundshift.operators import indices, parcels, scoring, series
from groundshift.plans.clusters import _BOXES_SQL, _COMP, _FEATURES, _boxes, _labelled, components
from groundshift.plans.land import _COVER, _GRID, _IDX, _SERIES, _cover, _grid, _indexed
from groundshift.plans.registry import query
from groundshift.plans.stats_profiles import PROFILES
from groundshift.sources.tables import ctes, epochs, table

_BANDS = ["red", "green", "blue", "nir"]
_TWO = f"""{ctes('pixels')}, {_IDX}, two AS (SELECT b.epoch AS k, a.r, a.c, a.n >= 2 AND b.n >= 2 AS valid, sqrt(pow(a.red - b.red, 2) + pow(a.green - b.green, 2) + pow(a.blue - b.blue, 2) + pow(a.nir - b.nir, 2)) AS far,
        abs(coalesce(a.gray, 0e0) - coalesce(b.gray, 0e0)) AS light, abs(coalesce(a.ndvi, 0e0) - coalesce(b.ndvi, 0e0)) AS green FROM idx a JOIN idx b ON a.r = b.r AND a.c = b.c AND b.epoch = a.epoch + 1),
    sc AS (SELECT k, r, c, valid, CASE WHEN max(far) OVER w > 0 THEN far / max(far) OVER w ELSE 0e0 END AS spectral, CASE WHEN max(light) OVER w > 0 THEN light / max(light) OVER w ELSE 0e0 END AS brightness, CASE WHEN max(green) OVER w > 0 THEN green / max(green) OVER w ELSE 0e0 END AS vegetation FROM two WINDOW w AS (PARTITION BY k)),
    pr AS (SELECT *, 0.5e0 * spectral + 0.3e0 * brightness + 0.2e0 * vegetation AS prob FROM sc)"""


def _scores(spark, sf_dir):
    """Three scores of every pair of consecutive years: distance of all bands, of brightness and of vegetation."""
    p = _indexed(spark, sf_dir).withColumns({"light": F.coalesce("gray", F.lit(0.0)), "veg": F.coalesce("ndvi", F.lit(0.0))})
    d = scoring.date_pairs(p, [*_BANDS, "light", "veg"], F.col("n") >= 2)
    d = scoring.spectral_distance(d, _BANDS)
    d = scoring.spectral_distance(scoring.spectral_distance(d, ["light"], "brightness"), ["veg"], "vegetation")
    return d.select("k", "r", "c", "valid", "spectral", "brightness", "vegetation", scoring.ensemble({"spectral": 0.5, "brightness": 0.3, "vegetation": 0.2}).alias("prob"))


@query("P04_P14_spectral_distance", f"WITH {_TWO} SELECT k, r, c, valid, round(spectral, 6) AS spectral FROM sc")
def spectral_distance(spark, sf_dir):
    return _scores(spark, sf_dir).select("k", "r", "c", "valid", F.round("spectral", 6).alias("spectral"))


@query("P15_P16_ensemble_mask", f"WITH {_TWO} SELECT k, r, c, round(prob, 6) AS prob, round(prob, 9) >= 0.3e0 AND valid AS mask FROM pr")
def ensemble_mask(spark, sf_dir):
    s = _scores(spark, sf_dir).withColumn("p", F.round("prob", 9))
    return scoring.masked(s, "p", "fixed", 0.3).select("k", "r", "c", F.round("prob", 6).alias("prob"), "mask")


@query("A04_change_statistics", f"WITH {_TWO} SELECT k, count(*) FILTER (valid) AS valid_cells, count(*) FILTER (valid AND round(prob, 9) >= 0.3e0) AS changed_cells, round(100e0 * count(*) FILTER (valid AND round(prob, 9) >= 0.3e0) / greatest(count(*) FILTER (valid), 1), 4) AS changed_pct, round(avg(spectral) FILTER (valid), 4) AS spectral, round(avg(brightness) FILTER (valid), 4) AS brightness, round(avg(vegetation) FILTER (valid), 4) AS vegetation FROM pr GROUP BY k")
def change_statistics(spark, sf_dir):
    s = scoring.masked(_scores(spark, sf_dir).withColumn("p", F.round("prob", 9)), "p", "fixed", 0.3)
    n = F.count_if("valid")
    return s.groupBy("k").agg(n.alias("valid_cells"), F.count_if("mask").alias("changed_cells"), F.round(100.0 * F.count_if("mask") / F.greatest(n, F.lit(1)), 4).alias("changed_pct"), *(F.round(F.avg(F.when(F.col("valid"), F.col(x))), 4).alias(x) for x in ("spectral", "brightness", "vegetation")))


_OTSU = f"""{_TWO}, v AS (SELECT k, round(prob, 9) AS v FROM pr WHERE valid), e AS (SELECT k, min(v) AS lo, max(v) AS hi FROM v GROUP BY k), b AS (SELECT k, least(CAST(floor((v - lo) / (hi - lo) * 256) AS INT), 255) AS bin, count(*) AS n FROM v JOIN e USING (k) WHERE hi > lo GROUP BY 1, 2),
    h AS (SELECT e.k, i AS bin, coalesce(n, 0) * 1e0 AS n, lo + (i + 0.5e0) * (hi - lo) / 256 AS centre FROM (SELECT unnest(range(256)) AS i) CROSS JOIN e LEFT JOIN b ON b.bin = i AND b.k = e.k WHERE hi > lo),
    w AS (SELECT a.k, a.bin, a.centre, sum(x.n) FILTER (x.bin <= a.bin) AS w1, sum(x.n * x.centre) FILTER (x.bin <= a.bin) AS s1, sum(x.n) FILTER (x.bin > a.bin) AS w2, sum(x.n * x.centre) FILTER (x.bin > a.bin) AS s2 FROM h a JOIN h x USING (k) GROUP BY 1, 2, 3),
    q AS (SELECT k, bin, centre, w1 * w2 * pow(s1 / w1 - s2 / w2, 2) AS variance FROM w WHERE w1 > 0 AND w2 > 0), t AS (SELECT k, list(centre ORDER BY bin) AS l FROM (SELECT *, max(variance) OVER (PARTITION BY k) AS best FROM q) WHERE best > 0 AND variance >= best * (1 - 1e-9) GROUP BY k),
    ot AS (SELECT e.k, coalesce(l[len(l) // 2 + 1], 0.5e0) AS threshold FROM e LEFT JOIN t USING (k))"""


@query("A03_plateau_otsu", f"WITH {_OTSU} SELECT k, round(threshold, 6) AS threshold FROM ot")
def plateau_otsu(spark, sf_dir):
    s = _scores(spark, sf_dir).where("valid").select("k", F.round("prob", 9).alias("prob"))
    return scoring.plateau_otsu(s, "prob").select("k", F.round("threshold", 6).alias("threshold"))


@query("P16_otsu_mask", f"WITH {_OTSU} SELECT k, count(*) AS cells, count(*) FILTER (valid AND round(prob, 9) >= coalesce(threshold, 0.5e0)) AS changed_cells FROM pr LEFT JOIN ot USING (k) GROUP BY k")
def otsu_mask(spark, sf_dir):
    s = scoring.masked(_scores(spark, sf_dir).withColumn("p", F.round("prob", 9)), "p", "otsu", 0.5)
    return s.groupBy("k").agg(F.count(F.lit(1)).alias("cells"), F.count_if("mask").alias("changed_cells"))


@query("A12_brightness", f"WITH RECURSIVE {_COMP} SELECT k, comp, round(avg(g1), 2) AS brightness_t1, round(avg(g2), 2) AS brightness_t2, round(round(avg(g2), 2) - round(avg(g1), 2), 2) AS brightness_delta FROM (SELECT comp.k, comp.comp, a.gray AS g1, b.gray AS g2 FROM comp JOIN grid a ON a.r = comp.r AND a.c = comp.c AND a.k = comp.k - 1 JOIN grid b ON b.r = comp.r AND b.c = comp.c AND b.k = comp.k) GROUP BY k, comp")
def brightness(spark, sf_dir):
    g = _grid(spark, sf_dir).select("r", "c", "k", "gray")
    g = g.withColumn("before", F.lag("gray").over(series.cell().orderBy("k")))
    b = components(spark, sf_dir).join(g, ["r", "c", "k"]).groupBy("k", "comp").agg(F.round(F.avg("before"), 2).alias("brightness_t1"), F.round(F.avg("gray"), 2).alias("brightness_t2"))
    return b.withColumn("brightness_delta", F.round(F.col("brightness_t2") - F.col("brightness_t1"), 2))


@query("J18_main_parcel", f"WITH RECURSIVE {_COMP}, {ctes('parcels')}, {_COVER}, o AS (SELECT k, comp, pnu, round(sum(area), 6) AS area FROM comp JOIN cov USING (r, c) GROUP BY 1, 2, 3), m AS (SELECT k, comp, arg_max(pnu, (area, pnu)) AS pnu, max(area) AS area FROM o GROUP BY 1, 2) SELECT x.k, x.comp, m.pnu, m.area FROM (SELECT DISTINCT k, comp FROM comp) x LEFT JOIN m ON m.k = x.k AND m.comp = x.comp")
def main_parcel(spark, sf_dir):
    comp = cc.written(components(spark, sf_dir))
    o = comp.join(_cover(spark, sf_dir), ["r", "c"]).groupBy("k", "comp", "pnu").agg(F.round(F.sum("area"), 6).alias("area"))
    m = o.groupBy("k", "comp").agg(F.max_by("pnu", F.struct("area", "pnu")).alias("pnu"), F.max("area").alias("area"))
    return comp.select("k", "comp").distinct().join(m, ["k", "comp"], "left")


_DATES = "CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y%m%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 2 THEN strftime(o_orderdate, ' %Y/%m/%d ') WHEN 3 THEN strftime(o_orderdate, '%Y') WHEN 4 THEN strftime(o_orderdate, '%d.%m.%Y') END"


@query("F08_any_date", f"SELECT o_orderkey, CASE WHEN o_orderkey % 6 < 3 THEN CAST(o_orderdate AS DATE) WHEN o_orderkey % 6 = 3 THEN make_date(CAST(year(o_orderdate) AS INT), 1, 1) END AS d FROM (SELECT o_orderkey, o_orderdate, {_DATES} AS t FROM orders)")
def any_date(spark, sf_dir):
    d, form = F.col("o_orderdate"), F.col("o_orderkey") % 6
    text = F.when(form == 0, F.date_format(d, "yyyyMMdd")).when(form == 1, F.date_format(d, "yyyy-MM-dd")).when(form == 2, F.date_format(d, " yyyy/MM/dd ")).when(form == 3, F.date_format(d, "yyyy")).when(form == 4, F.date_format(d, "dd.MM.yyyy"))
    return table(spark, sf_dir, "orders").select("o_orderkey", keys.any_date(text).alias("d"))


@query("F09_season", f"WITH {ctes('pixels')} SELECT DISTINCT epoch, make_date(epoch, 4, 10) AS first_day, make_date(epoch, 5, 31) AS last_day FROM pixels")
def season(spark, sf_dir):
    on = lambda x: F.to_date(F.concat_ws("-", F.col("epoch").cast("string"), F.lit(x)))
    return table(spark, sf_dir, "pixels").select("epoch").distinct().select("epoch", on("04-10").alias("first_day"), on("05-31").alias("last_day"))


@query("F10_number", "SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN c_acctbal END AS v FROM customer")
def number(spark, sf_dir):
    k = F.col("c_custkey") % 4
    text = F.when(k == 0, F.col("c_acctbal").cast("string")).when(k == 1, F.lit("")).when(k == 2, F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select("c_custkey", keys.number(text).alias("v"))


_LAND = "VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in scoring.LAND.items())
_JIMOK = "CASE s_suppkey % 9 WHEN 0 THEN '전' WHEN 1 THEN '답' WHEN 2 THEN '과' WHEN 3 THEN '임야' WHEN 4 THEN ' 대' WHEN 5 THEN '장' WHEN 6 THEN '?' WHEN 7 THEN '' END"


def _jimok():
    k = F.col("s_suppkey") % 9
    out = F
    for i, t in enumerate(["전", "답", "과", "임야", " 대", "장", "?", ""]):
        out = out.when(k == i, F.lit(t))
    return out


@query("F11_land_category", f"WITH m(a, b) AS ({_LAND}), t AS (SELECT s_suppkey, substr(trim({_JIMOK}), 1, 1) AS x FROM supplier) SELECT s_suppkey, b AS jimok, coalesce(x IN ('전', '답', '과'), FALSE) AS farmland FROM t LEFT JOIN m ON m.a = t.x")
def land_category(spark, sf_dir):
    x = F.substring(F.trim(_jimok()), 1, 1)
    return table(spark, sf_dir, "supplier").select("s_suppkey", scoring.looked_up(x, scoring.LAND).alias("jimok"), F.coalesce(x.isin(scoring.FARMLAND), F.lit(False)).alias("farmland"))


_SHARES = f"""{ctes('parcels', 'classes')}, {_COVER}, sh AS (SELECT pnu, sum(CASE WHEN cls = 5 THEN area ELSE 0 END) / nullif(sum(CASE WHEN cls > 0 THEN area ELSE 0 END), 0) AS crops, sum(CASE WHEN cls = 7 THEN area ELSE 0 END) / nullif(sum(CASE WHEN cls > 0 THEN area ELSE 0 END), 0) AS built FROM cov JOIN classes USING (r, c) GROUP BY pnu),
    j AS (SELECT concat('01', lpad(CAST(s_suppkey AS STRING), 17, '0')) AS pnu, substr(trim({_JIMOK}), 1, 1) AS x FROM supplier)"""


def _shares(spark, sf_dir):
    j = _cover(spark, sf_dir).join(table(spark, sf_dir, "classes"), ["r", "c"])
    whole = F.sum(F.when(F.col("cls") > 0, F.col("area")).otherwise(0.0))
    share = lambda code: F.try_divide(F.sum(F.when(F.col("cls") == code, F.col("area")).otherwise(0.0)), F.nullif(whole, F.lit(0.0)))
    sh = j.groupBy("pnu").agg(share(5).alias("crops"), share(7).alias("built"))
    x = table(spark, sf_dir, "supplier").select(F.concat(F.lit("01"), F.lpad(F.col("s_suppkey").cast("string"), 17, "0")).alias("pnu"), F.substring(F.trim(_jimok()), 1, 1).alias("x"))
    return sh.join(x, "pnu")


@query("P41_agricultural_evidence", f"WITH {_SHARES} SELECT pnu, concat_ws(',', CASE WHEN x IN ('전', '답', '과') THEN '지목(전·답·과)' END, CASE WHEN coalesce(round(crops, 9), 0e0) >= 0.3e0 THEN 'LULC crops' END) AS evidence, coalesce(x IN ('전', '답', '과'), FALSE) OR coalesce(round(crops, 9), 0e0) >= 0.3e0 AS farmland FROM sh JOIN j USING (pnu)")
def agricultural_evidence(spark, sf_dir):
    e = scoring.agricultural(F.col("x"), F.lit(0.0), F.lit(0.0), F.round("crops", 9), 0.3)
    return _shares(spark, sf_dir).select("pnu", e.alias("evidence")).withColumn("farmland", F.length("evidence") > 0)


@query("P07_A22_clear_fraction", f"WITH {ctes('parcels', 'classes')}, {_COVER}, cen AS (SELECT DISTINCT cov.r, cov.c FROM cov JOIN parcels p ON p.pnu = cov.pnu WHERE (c + 0.5e0) * 10 >= x0 AND (c + 0.5e0) * 10 < x1 AND (r + 0.5e0) * 10 >= y0 AND (r + 0.5e0) * 10 < y1) SELECT count(*) AS cells, round(count(*) FILTER (cls IN (4, 5, 6, 7)) * 1e0 / count(*), 6) AS clear_fraction, round(100e0 * count(*) FILTER (cls > 0) / count(*), 4) AS valid_pct, round(100e0 * count(*) FILTER (cls IN (3, 8, 9, 10, 11)) / count(*), 4) AS cloud_pct FROM classes JOIN cen USING (r, c)")
def clear_fraction(spark, sf_dir):
    inside = parcels.centre_cells(table(spark, sf_dir, "parcels"), "pnu").select("r", "c").distinct()
    s = table(spark, sf_dir, "classes").join(inside, ["r", "c"])
    share = lambda c, f: f * F.count_if(c) / F.count(F.lit(1))
    return s.agg(F.count(F.lit(1)).alias("cells"), F.round(share(indices.clear(F.col("cls")), 1.0), 6).alias("clear_fraction"), F.round(share(F.col("cls") > 0, 100.0), 4).alias("valid_pct"), F.round(share(F.col("cls").isin(3, 8, 9, 10, 11), 100.0), 4).alias("cloud_pct"))


_NAMES = "VALUES " + ", ".join(f"({a}, '{b}')" for a, b in scoring.COVER.items())


@query("J29_cover_names", f"WITH {ctes('classes')}, m(a, b) AS ({_NAMES}) SELECT b AS name, count(*) AS cells FROM classes LEFT JOIN m ON m.a = classes.cls GROUP BY b")
def cover_names(spark, sf_dir):
    return table(spark, sf_dir, "classes").groupBy(scoring.looked_up(F.col("cls"), scoring.COVER).alias("name")).agg(F.count(F.lit(1)).alias("cells"))


@query("F14_strength", "SELECT s_suppkey, CASE WHEN s_suppkey % 11 = 0 OR s_suppkey % 7 / 100e0 >= 0.05e0 THEN '통계적으로 유의하지 않은' WHEN s_suppkey % 10 / 10e0 < 0.3e0 THEN '약한 양의' WHEN s_suppkey % 10 / 10e0 < 0.6e0 THEN '중간 정도의 양의' ELSE '강한 양의' END AS label FROM supplier")
def strength(spark, sf_dir):
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select("s_suppkey", scoring.strength(k % 10 / 10.0, F.when(k % 11 != 0, k % 7 / 100.0)).alias("label"))


@query("F16_valid_rings", f"WITH {ctes('buildings')} SELECT bld_id, bld_id % 5 NOT IN (1, 2, 3) AND x1 > x0 AND y1 > y0 AS ok FROM buildings")
def valid_rings(spark, sf_dir):
    """Rings of buildings, of which some are left open, too short or flat."""
    at = lambda x, y: F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    k = F.col("bld_id") % 5
    ring = F.when(k == 1, F.array(at("x0", "y0"), at("x1", "y0"), at("x1", "y1"), at("x0", "y1"))).when(k == 2, F.array(at("x0", "y0"), at("x1", "y0"), at("x0", "y0"))).when(k == 3, F.array(at("x0", "y0"), at("x1", "y0"), at("x1", "y0"), at("x0", "y0")))
    ring = ring.otherwise(F.array(at("x0", "y0"), at("x1", "y0"), at("x1", "y1"), at("x0", "y1"), at("x0", "y0")))
    return table(spark, sf_dir, "buildings").select("bld_id", scoring.valid_ring(ring).alias("ok"))


@query("S07_recoverable", f"WITH {ctes('scenes')}, p AS (SELECT CAST(unnest(range(0, 40)) AS INT) AS day), s AS (SELECT CAST(day(ts) AS INT) AS day, count(*) AS n, round(min(cloud), 2) AS best_cloud FROM scenes WHERE cloud < 20 GROUP BY 1) SELECT p.day, coalesce(n, 0) AS n, best_cloud, CASE WHEN coalesce(n, 0) > 0 THEN '가능' ELSE '불가' END AS recoverable FROM p LEFT JOIN s USING (day)")
def recoverable(spark, sf_dir):
    days = spark.range(40).select(F.col("id").cast("int").alias("day"))
    s = table(spark, sf_dir, "scenes").where("cloud < 20").groupBy(F.dayofmonth("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.round(F.min("cloud"), 2).alias("best_cloud"))
    return days.join(s, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"), "best_cloud", F.when(F.col("n") > 0, "가능").otherwise("불가").alias("recoverable"))


@query("W15_roi", f"WITH RECURSIVE {_BOXES_SQL}, s AS (SELECT *, greatest(x1 - x0 + 600, y1 - y0 + 600, 500e0) AS side FROM box) SELECT id, side > 620 AS roi_clipped, round(least(side, 620e0), 1) AS roi_size_m, round(least(side, 620e0) * least(side, 620e0) / 1e6, 3) AS roi_area_km2, (x0 + x1) / 2 - least(side, 620e0) / 2 AS rx0, (y0 + y1) / 2 - least(side, 620e0) / 2 AS ry0 FROM s")
def roi(spark, sf_dir):
    return scoring.roi(_boxes(spark, sf_dir), most=620.0).select("id", "roi_clipped", "roi_size_m", "roi_area_km2", "rx0", "ry0")


@query("A57_acquisition_years", f"""WITH RECURSIVE {_FEATURES}, p AS (SELECT CAST(first + k - 1 AS INT) AS year_from, CAST(first + k AS INT) AS year_to, sum(area_m2) AS area FROM feat, (SELECT min(epoch) AS first FROM ep) GROUP BY k, first), t AS (SELECT max(area) AS top FROM p), a AS (SELECT * FROM p, t WHERE top > 0 AND area >= 0.25e0 * top), e AS (SELECT min(year_from) AS f, max(year_to) AS l FROM a),
    roles AS (SELECT f AS year, '변화 전 baseline' AS role, 0 AS prio FROM e UNION ALL SELECT year_to, '변화 검출/진행', 1 FROM a UNION ALL SELECT CAST(min(y) AS INT), '변화 후 안정화 확인', 2 FROM (SELECT epoch AS y FROM pixels), e WHERE y > l) SELECT year, arg_min(role, prio) AS role FROM roles WHERE year IS NOT NULL GROUP BY year""")
def acquisition_years(spark, sf_dir):
    first = epochs(spark, sf_dir)[0]
    f = cc.change_features(_labelled(spark, sf_dir), ["k"]).groupBy("k").agg(F.sum("area_m2").alias("area_m2"))
    pairs = f.select((F.col("k") + (first - 1)).alias("year_from"), (F.col("k") + first).alias("year_to"), F.lit("step").alias("kind"), "area_m2")
    return scoring.acquisition_years(pairs, table(spark, sf_dir, "pixels").select(F.col("epoch").alias("year")).distinct())


_HIT = " OR ".join(f"(profile = '{p}' AND before >= {b}e0 AND ndvi <= {a}e0 AND ndvi - before <= {d}e0)" for p, (b, a, d) in PROFILES.items())


@query("A42_profile_parcels", f"WITH {_SERIES}, {ctes('parcels')}, {_COVER}, pr AS (SELECT unnest({list(PROFILES)}) AS profile), h AS (SELECT DISTINCT profile, r, c FROM lagged, pr WHERE {_HIT}), a AS (SELECT profile, pnu, sum(area) AS area FROM cov JOIN h USING (r, c) GROUP BY 1, 2) SELECT pr.profile, count(pnu) AS any_decline, count(CASE WHEN area >= 300 THEN 1 END) AS large_decline FROM pr LEFT JOIN a USING (profile) GROUP BY pr.profile")
def profile_parcels(spark, sf_dir):
    """Parcels with any decline and with a large one under each threshold profile, from one pass over the series."""
    g = _grid(spark, sf_dir).withColumn("before", F.lag("ndvi").over(series.cell().orderBy("k")))
    m = g.groupBy("r", "c").agg(*(F.coalesce(F.bool_or(indices.decline(F.col("before"), F.col("ndvi"), *t)), F.lit(False)).alias(p) for p, t in PROFILES.items()))
    areas = _cover(spark, sf_dir).join(m, ["r", "c"]).groupBy("pnu").agg(*(F.sum(F.when(F.col(p), F.col("area"))).alias(p) for p in PROFILES))
    s = areas.agg(F.array(*(F.struct(F.lit(p).alias("profile"), F.count(p).alias("any_decline"), F.count_if(F.col(p) >= 300).alias("large_decline")) for p in PROFILES)).alias("s"))
    return s.select(F.explode("s").alias("s")).select("s.*")
