"""Queries of grids, overlays, summaries and comparisons."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from groundshift.functions import keys
from groundshift.operators import parcels, raster, scoring
from groundshift.operators import statistics as st
from groundshift.operators.components import near_boxes
from groundshift.plans.land import _COVER, _GRID, _SERIES, _cover, _grid, _indexed, _persistence
from groundshift.plans.registry import query
from groundshift.plans.stats_profiles import PROFILES
from groundshift.sources.tables import ctes, table

_COARSE = "t AS (SELECT DISTINCT epoch, CAST(floor(r * 10 / 15) AS INT) AS r, CAST(floor(c * 10 / 15) AS INT) AS c FROM pixels)"


def _coarse(p):
    """Cells of 15 m that the cells of each epoch touch first."""
    return p.select("epoch", F.floor(F.col("r") * 10 / 15).cast("int").alias("r"), F.floor(F.col("c") * 10 / 15).cast("int").alias("c")).distinct()


@query("J03_nearest", f"WITH {ctes('pixels')}, {_COARSE} SELECT t.epoch, t.r, t.c, s.red FROM t LEFT JOIN pixels s ON s.epoch = t.epoch AND s.r = CAST(floor((t.r + 0.5e0) * 15 / 10) AS INT) AND s.c = CAST(floor((t.c + 0.5e0) * 15 / 10) AS INT)")
def nearest(spark, sf_dir):
    p = table(spark, sf_dir, "pixels")
    return raster.nearest(_coarse(p), p, "red", 15.0, 10.0, by=("epoch",))


@query("J04_bilinear", f"WITH {ctes('pixels')}, {_COARSE}, y AS (SELECT *, (r + 0.5e0) * 15 / 10 - 0.5e0 AS y, (c + 0.5e0) * 15 / 10 - 0.5e0 AS x FROM t), n AS (SELECT y.*, i, j, CASE WHEN i = 1 THEN y - floor(y) ELSE 1 - (y - floor(y)) END * CASE WHEN j = 1 THEN x - floor(x) ELSE 1 - (x - floor(x)) END AS w FROM y, (VALUES (0), (1)) a(i), (VALUES (0), (1)) b(j)) SELECT n.epoch, n.r, n.c, round(sum(w * red) / nullif(sum(w), 0), 6) AS red FROM n JOIN pixels s ON s.epoch = n.epoch AND s.r = CAST(floor(n.y) AS INT) + i AND s.c = CAST(floor(n.x) AS INT) + j GROUP BY n.epoch, n.r, n.c")
def bilinear(spark, sf_dir):
    p = table(spark, sf_dir, "pixels")
    return raster.bilinear(_coarse(p), p, "red", 15.0, 10.0, by=("epoch",)).withColumn("red", F.round("red", 6))


@query("J01_J02_aligned_bands", f"WITH {ctes('pixels')} SELECT b.epoch, a.r, a.c, a.red AS red_before, b.red AS red_after, b.red - a.red AS delta FROM pixels a JOIN pixels b ON a.r = b.r AND a.c = b.c AND b.epoch = a.epoch + 1")
def aligned_bands(spark, sf_dir):
    """Both dates of every pair of consecutive years in one row: one window by cell instead of a self join."""
    w = scoring.date_pairs(table(spark, sf_dir, "pixels"), ["red"], F.lit(True))
    return w.select(F.col("k").alias("epoch"), "r", "c", F.col("red_1").alias("red_before"), F.col("red_2").alias("red_after"), (F.col("red_2") - F.col("red_1")).alias("delta"))


@query("A07_median_composite", "WITH o AS (SELECT CAST(year(l_shipdate) AS INT) AS epoch, CAST(floor(l_partkey / 50) AS INT) AS r, CAST(l_partkey % 50 AS INT) AS c, l_quantity AS v FROM lineitem) SELECT r, c, epoch, CASE WHEN count(v) >= 2 THEN median(v) END AS v, count(v) AS n FROM o GROUP BY r, c, epoch")
def median_composite(spark, sf_dir):
    y = F.year("l_shipdate")
    o = table(spark, sf_dir, "lineitem").select(y.alias("epoch"), F.floor(F.col("l_partkey") / 50).cast("int").alias("r"), (F.col("l_partkey") % 50).cast("int").alias("c"), F.col("l_quantity").cast("double").alias("v"))
    return raster.median_composite(o, "v")


@query("A62_registration_offset", f"""WITH {ctes('pixels')}, d AS (SELECT unnest(range(-2, 3)) AS d), g AS (SELECT b.epoch AS k, y.d AS dy, x.d AS dx, round(corr(a.nir, b.nir), 9) AS corr, count(*) AS n FROM pixels a, d y, d x, pixels b WHERE b.epoch = a.epoch + 1 AND b.r = a.r + y.d AND b.c = a.c + x.d GROUP BY 1, 2, 3),
    best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY corr DESC, dy * dy + dx * dx, dy, dx) AS i FROM g WHERE corr IS NOT NULL) WHERE i = 1),
    p AS (SELECT b.k, b.corr, b.n, b.dy, b.dx, abs(b.dy) < 2 AND abs(b.dx) < 2 AS ok, max(g.corr) FILTER (g.dy = b.dy - 1 AND g.dx = b.dx) AS yl, max(g.corr) FILTER (g.dy = b.dy + 1 AND g.dx = b.dx) AS yh, max(g.corr) FILTER (g.dy = b.dy AND g.dx = b.dx - 1) AS xl, max(g.corr) FILTER (g.dy = b.dy AND g.dx = b.dx + 1) AS xh
        FROM best b JOIN g USING (k) GROUP BY 1, 2, 3, 4, 5, 6), s AS (SELECT *, CASE WHEN ok THEN dy + (yl - yh) / (2 * (yl - 2 * corr + yh)) END AS y, CASE WHEN ok THEN dx + (xl - xh) / (2 * (xl - 2 * corr + xh)) END AS x FROM p)
    SELECT k, round(y, 5) AS dy, round(x, 5) AS dx, round(10 * sqrt(x * x + y * y), 4) AS displacement, corr AS quality, n FROM s""")
def registration_offset(spark, sf_dir):
    p = table(spark, sf_dir, "pixels").select("epoch", "r", "c", "nir")
    first = p.select((F.col("epoch") + 1).alias("k"), "r", "c", F.col("nir").alias("v"))
    pairs = first.join(p.select(F.col("epoch").alias("k"), "r", "c", F.col("nir").alias("w")), ["k", "r", "c"], "full")
    o = raster.offsets(pairs, 10.0)
    return o.select("k", F.round("dy", 5).alias("dy"), F.round("dx", 5).alias("dx"), F.round("displacement", 4).alias("displacement"), "quality", "n")


@query("P50_stretch", f"WITH {ctes('pixels')}, q AS (SELECT quantile_cont(red, 0.02) AS lo, quantile_cont(red, 0.98) AS hi FROM pixels) SELECT epoch, r, c, round(greatest(0e0, least(1e0, (red - lo) / CASE WHEN hi > lo THEN hi - lo ELSE 1e0 END)), 6) AS stretched FROM pixels, q")
def stretch(spark, sf_dir):
    return raster.stretched(table(spark, sf_dir, "pixels").select("epoch", "r", "c", "red"), "red").select("epoch", "r", "c", F.round("stretched", 6).alias("stretched"))


_BCOV = """bcov AS (SELECT bld_id, r, c, w * h AS area FROM (SELECT bld_id, r, c, least(x1, (c + 1) * 10e0) - greatest(x0, c * 10e0) AS w, least(y1, (r + 1) * 10e0) - greatest(y0, r * 10e0) AS h
    FROM (SELECT *, unnest(range(CAST(floor(x0 / 10) AS INT), CAST(ceil(x1 / 10) AS INT))) AS c FROM (SELECT *, unnest(range(CAST(floor(y0 / 10) AS INT), CAST(ceil(y1 / 10) AS INT))) AS r FROM buildings))) WHERE w > 0 AND h > 0 AND w * h > 1e-6)"""


@query("J12_building_overlay", f"WITH {_SERIES}, {ctes('buildings')}, {_BCOV} SELECT bld_id, round(sum(area), 4) AS building_area, round(coalesce(sum(CASE WHEN frequency > 0 THEN area END), 0e0), 4) AS change_area, round(coalesce(sum(CASE WHEN frequency > 0 THEN area END), 0e0) / sum(area), 6) AS change_ratio, max(frequency) AS most FROM bcov LEFT JOIN pers USING (r, c) GROUP BY bld_id")
def building_overlay(spark, sf_dir):
    j = parcels.coverage(table(spark, sf_dir, "buildings"), "bld_id").join(_persistence(spark, sf_dir), ["r", "c"], "left")
    hit = F.coalesce(F.sum(F.when(F.col("frequency") > 0, F.col("area"))), F.lit(0.0))
    return j.groupBy("bld_id").agg(F.round(F.sum("area"), 4).alias("building_area"), F.round(hit, 4).alias("change_area"), F.round(hit / F.sum("area"), 6).alias("change_ratio"), F.max("frequency").alias("most"))


@query("J19_building_parcel", f"WITH {ctes('parcels', 'buildings')}, o AS (SELECT bld_id, pnu, (least(b.x1, p.x1) - greatest(b.x0, p.x0)) * (least(b.y1, p.y1) - greatest(b.y0, p.y0)) AS area, (b.x1 - b.x0) * (b.y1 - b.y0) AS whole FROM buildings b JOIN parcels p ON b.x0 < p.x1 AND p.x0 < b.x1 AND b.y0 < p.y1 AND p.y0 < b.y1), k AS (SELECT *, row_number() OVER (PARTITION BY bld_id ORDER BY area DESC, pnu) AS rn FROM o) SELECT bld_id, pnu, round(area / whole, 6) AS share FROM k WHERE rn = 1 AND area / whole >= 0.5e0")
def building_parcel(spark, sf_dir):
    """The parcel that holds at least half of a building: rectangles meet by the 50 m buckets they touch; a pair is counted in the bucket of its overlap's corner."""
    cut = lambda x: F.floor(F.col(x) / 50).cast("int")
    deal = lambda d: d.withColumn("bx", F.explode(F.sequence(cut("x0"), cut("x1")))).withColumn("by", F.explode(F.sequence(cut("y0"), cut("y1"))))
    b = deal(table(spark, sf_dir, "buildings").select("bld_id", "x0", "y0", "x1", "y1"))
    p = deal(table(spark, sf_dir, "parcels").select("pnu", "x0", "y0", "x1", "y1")).select("pnu", "bx", "by", *(F.col(c).alias(f"p{c}") for c in ("x0", "y0", "x1", "y1")))
    left, low = F.greatest("x0", "px0"), F.greatest("y0", "py0")
    wide, high = F.least("x1", "px1") - left, F.least("y1", "py1") - low
    o = b.join(p, ["bx", "by"]).where((wide > 0) & (high > 0) & (F.floor(left / 50) == F.col("bx")) & (F.floor(low / 50) == F.col("by")))
    o = o.select("bld_id", "pnu", (wide * high).alias("area"), ((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))).alias("whole"))
    best = o.groupBy("bld_id").agg(F.max("area").alias("area"), F.first("whole").alias("whole"))
    first = o.join(best.select("bld_id", F.col("area").alias("most")), "bld_id").where("area = most").groupBy("bld_id").agg(F.min("pnu").alias("pnu"), F.first("area").alias("area"), F.first("whole").alias("whole"))
    return first.where("area / whole >= 0.5").select("bld_id", "pnu", F.round(F.col("area") / F.col("whole"), 6).alias("share"))


@query("J26_near_buildings", f"WITH {ctes('buildings')} SELECT a.bld_id AS a, b.bld_id AS b FROM buildings a JOIN buildings b ON a.bld_id < b.bld_id AND pow(greatest(0e0, a.x0 - b.x1, b.x0 - a.x1), 2) + pow(greatest(0e0, a.y0 - b.y1, b.y0 - a.y1), 2) <= 100")
def near_buildings(spark, sf_dir):
    return near_boxes(table(spark, sf_dir, "buildings"), "bld_id", 10.0)


@query("J33_corridor", f"WITH {_SERIES}, {ctes('rail')}, n AS (SELECT r, c, min(sqrt(pow(x - xa - t * (xb - xa), 2) + pow(y - ya - t * (yb - ya), 2))) AS d FROM (SELECT *, greatest(0e0, least(1e0, ((x - xa) * (xb - xa) + (y - ya) * (yb - ya)) / ((xb - xa) * (xb - xa) + (yb - ya) * (yb - ya)))) AS t FROM (SELECT r, c, c * 10 + 5e0 AS x, r * 10 + 5e0 AS y FROM pers WHERE frequency > 0), rail) GROUP BY r, c) SELECT CAST(sum(CASE WHEN d <= 50 THEN 100 ELSE 0 END) AS BIGINT) AS within_50, CAST(sum(CASE WHEN d <= 150 THEN 100 ELSE 0 END) AS BIGINT) AS within_150 FROM n")
def corridor(spark, sf_dir):
    c = _persistence(spark, sf_dir).where("frequency > 0").select(F.struct("r", "c").alias("cell"), (F.col("c") * 10.0).alias("x0"), (F.col("r") * 10.0).alias("y0"), (F.col("c") * 10.0 + 10).alias("x1"), (F.col("r") * 10.0 + 10).alias("y1"))
    d = parcels.segment_distance(c, table(spark, sf_dir, "rail"), "cell")
    return d.agg(*(F.coalesce(F.sum(F.when(F.col("distance") <= m, 100).otherwise(0)), F.lit(0)).cast("bigint").alias(f"within_{m}") for m in (50, 150)))


@query("A30_block_progress", f"WITH {_SERIES}, b AS (SELECT CAST(floor(r / 10) AS INT) AS br, CAST(floor(c / 10) AS INT) AS bc, k, count(*) FILTER (event) AS cells FROM ev WHERE k > 0 GROUP BY 1, 2, 3) SELECT br, bc, count(*) AS epochs, count(*) FILTER (cells > 0) AS active, round(count(*) FILTER (cells > 0) * 1e0 / count(*), 6) AS persistence, CAST(sum(cells) AS BIGINT) * 100 AS area_m2, arg_max(cells > 0, k) AS latest_active FROM b GROUP BY br, bc")
def block_progress(spark, sf_dir):
    from groundshift.operators import series
    from groundshift.plans.land import _DECLINE

    e = series.decline_events(_grid(spark, sf_dir), **_DECLINE).where("k > 0")
    b = e.groupBy(F.floor(F.col("r") / 10).cast("int").alias("br"), F.floor(F.col("c") / 10).cast("int").alias("bc"), "k").agg(F.count_if("event").alias("cells"))
    on = F.col("cells") > 0
    return b.groupBy("br", "bc").agg(F.count(F.lit(1)).alias("epochs"), F.count_if(on).alias("active"), F.round(F.count_if(on) / F.count(F.lit(1)), 6).alias("persistence"), (F.sum("cells") * 100).alias("area_m2"), F.max_by(on, "k").alias("latest_active"))


@query("A41_threshold_profiles", f"WITH {_GRID}, pr AS (SELECT * FROM (VALUES ('default', 0.4e0, 0.35e0, -0.1e0), ('conservative', 0.45e0, 0.3e0, -0.2e0), ('relaxed', 0.35e0, 0.4e0, -0.05e0)) AS v(profile, b, a, d)), l AS (SELECT r, c, k, ndvi, lag(ndvi) OVER (PARTITION BY r, c ORDER BY k) AS before FROM grid), m AS (SELECT profile, r, c, bool_or(coalesce(before >= b AND ndvi <= a AND ndvi - before <= d, FALSE)) AS hit FROM l, pr GROUP BY 1, 2, 3), w AS (SELECT m.profile, count(*) FILTER (m.hit) AS cells, round(count(*) FILTER (m.hit AND f.hit) * 1e0 / nullif(count(*) FILTER (m.hit OR f.hit), 0), 6) AS jaccard FROM m JOIN m f ON f.profile = 'default' AND f.r = m.r AND f.c = m.c GROUP BY m.profile) SELECT * FROM w")
def threshold_profiles(spark, sf_dir):
    """All profiles in one pass: a boolean for each, no copy of the pixels."""
    from groundshift.operators.indices import decline
    from groundshift.operators.series import cell

    profiles = PROFILES
    g = _grid(spark, sf_dir).withColumn("before", F.lag("ndvi").over(cell().orderBy("k")))
    m = g.groupBy("r", "c").agg(*(F.bool_or(decline(F.col("before"), F.col("ndvi"), *t)).alias(p) for p, t in profiles.items()))
    stats = [F.struct(F.lit(p).alias("profile"), F.count_if(p).alias("cells"), F.round(F.try_divide(F.count_if(F.col(p) & F.col("default")), F.count_if(F.col(p) | F.col("default"))), 6).alias("jaccard")) for p in profiles]
    return m.agg(F.array(*stats).alias("s")).select(F.explode("s").alias("s")).select("s.*")


@query("A48_run_agreement", f"WITH {_SERIES}, x AS (SELECT CAST(floor(r / 2) AS INT) AS br, CAST(floor(c / 2) AS INT) AS bc, count(*) FILTER (frequency > 0) AS f, count(*) FILTER (persistence = 'PERSISTENT') AS p FROM pers GROUP BY 1, 2) SELECT count(*) AS n, count(*) FILTER ((f > 1) = (p > 0)) AS agree, count(*) FILTER (f > 1 AND p > 0) AS both_, count(*) FILTER (f > 1 OR p > 0) AS either_, round(corr(f, p), 6) AS r FROM x")
def run_agreement(spark, sf_dir):
    half = lambda c: F.floor(F.col(c) / 2).cast("int")
    x = _persistence(spark, sf_dir).groupBy(half("r").alias("br"), half("c").alias("bc")).agg(F.count_if(F.col("frequency") > 0).alias("f"), F.count_if(F.col("persistence") == "PERSISTENT").alias("p"))
    a, b = F.col("f") > 1, F.col("p") > 0
    return x.agg(F.count(F.lit(1)).alias("n"), F.count_if(a == b).alias("agree"), F.count_if(a & b).alias("both_"), F.count_if(a | b).alias("either_"), F.round(F.corr("f", "p"), 6).alias("r"))


@query("U02_U03_U05_mask_sets", f"WITH {_SERIES}, m AS (SELECT r, c, bool_or(k = 1 AND event) AS a, bool_or(k = 2 AND event) AS b, bool_or(event) AS ever FROM ev WHERE k > 0 GROUP BY r, c) SELECT count(*) FILTER (ever) AS ever, count(*) FILTER (a AND b) AS both_, count(*) FILTER (a <> b) AS xor_, round(count(*) FILTER (a AND b) * 1e0 / nullif(count(*) FILTER (a OR b), 0), 6) AS jaccard FROM m")
def mask_sets(spark, sf_dir):
    from groundshift.operators import series
    from groundshift.plans.land import _DECLINE

    e = series.decline_events(_grid(spark, sf_dir), **_DECLINE).where("k > 0")
    m = e.groupBy("r", "c").agg(F.bool_or((F.col("k") == 1) & F.col("event")).alias("a"), F.bool_or((F.col("k") == 2) & F.col("event")).alias("b"), F.bool_or("event").alias("ever"))
    a, b = F.col("a"), F.col("b")
    return m.agg(F.count_if("ever").alias("ever"), F.count_if(a & b).alias("both_"), F.count_if(a != b).alias("xor_"), F.round(F.try_divide(F.count_if(a & b), F.count_if(a | b)), 6).alias("jaccard"))


@query("S16_composed_pnu", "SELECT o_orderkey, concat(lpad(CAST(o_custkey % 100000 AS VARCHAR), 5, '0'), lpad(CAST(o_orderkey % 100000 AS VARCHAR), 5, '0'), CASE WHEN o_orderkey % 4 = 0 THEN '0' ELSE CAST(o_orderkey % 2 AS VARCHAR) END, lpad(CAST(o_orderkey % 997 AS VARCHAR), 4, '0'), lpad(CAST(o_custkey % 31 AS VARCHAR), 4, '0')) AS pnu FROM orders")
def composed_pnu(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    text = lambda x: x.cast("string")
    return table(spark, sf_dir, "orders").select(k, keys.parcel_number(F.lpad(text(c % 100000), 5, "0"), F.lpad(text(k % 100000), 5, "0"), F.when(k % 4 != 0, text(k % 2)), text(k % 997), text(c % 31)).alias("pnu"))


@query("W13_A53_parcel_quality", "WITH p AS (SELECT CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE concat('01', lpad(CAST(o_custkey AS VARCHAR), 17, '0')) END AS pnu, o_totalprice AS area, o_orderkey AS id FROM orders), k AS (SELECT *, row_number() OVER (PARTITION BY pnu ORDER BY area DESC, id) AS rn FROM p) SELECT count(*) AS parcels, count(*) FILTER (pnu IS NULL) AS missing, count(*) FILTER (pnu IS NOT NULL AND length(pnu) <> 19) AS bad_length, count(*) FILTER (pnu IS NOT NULL AND rn > 1) AS duplicates, count(*) FILTER (pnu IS NULL OR rn = 1) AS kept FROM k")
def parcel_quality(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    pnu = F.when(F.col("o_orderkey") % 11 != 0, F.concat(F.lit("01"), F.lpad(F.col("o_custkey").cast("string"), 17, "0")))
    g = o.select(pnu.alias("pnu")).groupBy("pnu").agg(F.count(F.lit(1)).alias("n"))
    has = F.col("pnu").isNotNull()
    total = lambda c, x: F.coalesce(F.sum(F.when(c, x)), F.lit(0)).cast("bigint")
    return g.agg(F.sum("n").alias("parcels"), total(~has, F.col("n")).alias("missing"), total(has & (F.length("pnu") != 19), F.col("n")).alias("bad_length"), total(has, F.col("n") - 1).alias("duplicates"), (total(~has, F.col("n")) + total(has, F.lit(1))).alias("kept"))


@query("L03_stratified_cells", f"WITH {_SERIES}, s AS (SELECT r, c, persistence, row_number() OVER (PARTITION BY persistence ORDER BY sha256(concat(CAST(r AS VARCHAR), ':', CAST(c AS VARCHAR), ':7')), r, c) AS nth, count(*) OVER (PARTITION BY persistence) AS size FROM pers) SELECT r, c, persistence, size FROM s WHERE nth <= 12")
def stratified_cells(spark, sf_dir):
    p = _persistence(spark, sf_dir)
    order = Window.partitionBy("persistence").orderBy(st.seeded_order("r", "c", seed=7), "r", "c")
    return p.withColumns({"nth": F.row_number().over(order), "size": F.count(F.lit(1)).over(Window.partitionBy("persistence"))}).where("nth <= 12").select("r", "c", "persistence", "size")


@query("A52_buildings_per_parcel", f"WITH {ctes('parcels', 'buildings')}, o AS (SELECT bld_id, pnu, (least(b.x1, p.x1) - greatest(b.x0, p.x0)) * (least(b.y1, p.y1) - greatest(b.y0, p.y0)) AS area, (b.x1 - b.x0) * (b.y1 - b.y0) AS whole FROM buildings b JOIN parcels p ON b.x0 < p.x1 AND p.x0 < b.x1 AND b.y0 < p.y1 AND p.y0 < b.y1), k AS (SELECT *, row_number() OVER (PARTITION BY bld_id ORDER BY area DESC, pnu) AS rn FROM o) SELECT pnu, count(*) AS buildings, round(avg(round(area / whole, 6)), 4) AS mean_share FROM k WHERE rn = 1 AND area / whole >= 0.5e0 GROUP BY pnu")
def buildings_per_parcel(spark, sf_dir):
    return building_parcel(spark, sf_dir).groupBy("pnu").agg(F.count(F.lit(1)).alias("buildings"), F.round(F.avg("share"), 4).alias("mean_share"))


@query("A61_common_grid", f"WITH {ctes('buildings')} SELECT floor(min(x0) / 10) * 10 AS x0, floor(min(y0) / 10) * 10 AS y0, ceil(max(x1) / 10) * 10 AS x1, ceil(max(y1) / 10) * 10 AS y1, CAST((ceil(max(x1) / 10) - floor(min(x0) / 10)) AS BIGINT) AS width, CAST((ceil(max(y1) / 10) - floor(min(y0) / 10)) AS BIGINT) AS height FROM buildings")
def common_grid(spark, sf_dir):
    lo = lambda c: F.floor(F.min(c) / 10)
    hi = lambda c: F.ceil(F.max(c) / 10)
    return table(spark, sf_dir, "buildings").agg((lo("x0") * 10).cast("double").alias("x0"), (lo("y0") * 10).cast("double").alias("y0"), (hi("x1") * 10).cast("double").alias("x1"), (hi("y1") * 10).cast("double").alias("y1"), (hi("x1") - lo("x0")).alias("width"), (hi("y1") - lo("y0")).alias("height"))
