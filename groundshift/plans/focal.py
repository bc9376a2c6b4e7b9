"""Queries of focal operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from groundshift.operators import focal
from groundshift.operators.components import written
from groundshift.plans.registry import query
from groundshift.sources.tables import ctes, epochs, table

WIDTH = 50
_MIRROR = lambda x, n: f"CASE WHEN {x} < 0 THEN -({x}) - 1 WHEN {x} >= {n} THEN 2 * {n} - 1 - ({x}) ELSE {x} END"
# full grids of every date, numbered from 0, filled where nothing was observed; g1 is the date before
_G = f"""{ctes('pixels')}, dim AS (SELECT CAST(max(r) + 1 AS INT) AS h, min(epoch) AS first, max(epoch) AS last FROM pixels),
    base AS (SELECT CAST(e - first AS INT) AS k, e AS epoch, CAST(a AS INT) AS r, CAST(b AS INT) AS c, h FROM (SELECT *, unnest(range(0, h)) AS a FROM (SELECT *, unnest(range(first, last + 1)) AS e FROM dim)), (SELECT unnest(range(0, {WIDTH})) AS b)),
    g AS (SELECT b.k, b.r, b.c, b.h, coalesce(p.red, 2500) AS g2, CASE WHEN coalesce(p.red, 2500) < 2700 THEN 1 ELSE 0 END AS on_, lag(coalesce(p.red, 2500)) OVER (PARTITION BY b.r, b.c ORDER BY b.k) AS g1 FROM base b LEFT JOIN pixels p ON p.r = b.r AND p.c = b.c AND p.epoch = b.epoch)"""
_NEAR = lambda n, src="g": f"(SELECT g.k, g.r, g.c, dr, dc, n.* EXCLUDE (k, r, c, h) FROM {src} g, (SELECT unnest(range(-{n}, {n} + 1)) AS dr) y, (SELECT unnest(range(-{n}, {n} + 1)) AS dc) x, {src} n WHERE n.k = g.k AND n.r = {_MIRROR('g.r + dr', 'g.h')} AND n.c = {_MIRROR('g.c + dc', WIDTH)})"


def _grid(spark, sf_dir):
    """A full grid of every date (k, r, c, g2, g1 of the date before, on), filled where nothing was observed; and its height."""
    p, years = table(spark, sf_dir, "pixels"), epochs(spark, sf_dir)
    height = p.agg(F.max("r")).first()[0] + 1
    base = spark.range(height * WIDTH).select(F.floor(F.col("id") / WIDTH).cast("int").alias("r"), (F.col("id") % WIDTH).cast("int").alias("c"), F.explode(F.array(*map(F.lit, years))).alias("epoch"))
    red = F.coalesce("red", F.lit(2500)).cast("long")
    g = base.join(p.select("epoch", "r", "c", "red"), ["epoch", "r", "c"], "left").select((F.col("epoch") - years[0]).alias("k"), "r", "c", red.alias("g2"), (red < 2700).cast("int").alias("on"))
    return g.withColumn("g1", F.lag("g2").over(Window.partitionBy("r", "c").orderBy("k"))), height


@query("W01_ssim_change", f"""WITH {_G}, pg AS (SELECT * FROM g WHERE k > 0), s AS (SELECT k, r, c, sum(g1)::DOUBLE AS sa, sum(g2)::DOUBLE AS sb, sum(CAST(g1 AS BIGINT) * g1)::DOUBLE AS saa, sum(CAST(g2 AS BIGINT) * g2)::DOUBLE AS sbb, sum(CAST(g1 AS BIGINT) * g2)::DOUBLE AS sab FROM {_NEAR(3, 'pg')} GROUP BY k, r, c),
    rg AS (SELECT k, CASE WHEN greatest(max(g1), max(g2)) > least(min(g1), min(g2)) THEN greatest(max(g1), max(g2)) - least(min(g1), min(g2)) ELSE 1 END AS l FROM pg GROUP BY k), m AS (SELECT k, r, c, sa / 49 AS ua, sb / 49 AS ub, 49e0 / 48 * (saa / 49 - (sa / 49) * (sa / 49)) AS va, 49e0 / 48 * (sbb / 49 - (sb / 49) * (sb / 49)) AS vb, 49e0 / 48 * (sab / 49 - (sa / 49) * (sb / 49)) AS vab, pow(0.01e0 * l, 2) AS c1, pow(0.03e0 * l, 2) AS c2 FROM s JOIN rg USING (k))
    SELECT k, r, c, round(greatest(0e0, least(1e0, 1 - ((2 * ua * ub + c1) * (2 * vab + c2)) / ((ua * ua + ub * ub + c1) * (va + vb + c2)))), 5) AS score FROM m""")
def ssim(spark, sf_dir):
    g, height = _grid(spark, sf_dir)
    return focal.ssim_change(written(g.where("k > 0")), height, WIDTH, by=("k",)).select("k", "r", "c", F.round("score", 5).alias("score"))


def _twice(first: str, then: str) -> str:
    return f"WITH {_G}, e AS (SELECT k, r, c, {first}(on_) AS on_ FROM {_NEAR(1)} GROUP BY k, r, c), g2 AS (SELECT e.*, h FROM e, dim) SELECT k, r, c, CAST({then}(on_) AS INT) AS on_ FROM {_NEAR(1, 'g2')} GROUP BY k, r, c"


@query("W05_opened_mask", _twice("min", "max"))
def opened_mask(spark, sf_dir):
    g, height = _grid(spark, sf_dir)
    return focal.opened(g, 3, height, WIDTH, by=("k",)).select("k", "r", "c", F.col("on").alias("on_"))


@query("W05_closed_mask", _twice("max", "min"))
def closed_mask(spark, sf_dir):
    g, height = _grid(spark, sf_dir)
    return focal.closed(g, 3, height, WIDTH, by=("k",)).select("k", "r", "c", F.col("on").alias("on_"))


_SOBEL = f"{_G}, sm AS (SELECT k, r, c, sqrt(pow(sum(g2 * dc * CASE dr WHEN 0 THEN 2 ELSE 1 END), 2) + pow(sum(g2 * dr * CASE dc WHEN 0 THEN 2 ELSE 1 END), 2)) AS magnitude FROM {_NEAR(1)} GROUP BY k, r, c)"


@query("W02_sobel", f"WITH {_SOBEL} SELECT k, r, c, round(magnitude, 5) AS magnitude FROM sm")
def sobel(spark, sf_dir):
    g, height = _grid(spark, sf_dir)
    return focal.sobel(g, "g2", height, WIDTH, by=("k",)).select("k", "r", "c", F.round("magnitude", 5).alias("magnitude"))


@query("W02_gradient_change", f"""WITH {_SOBEL}, pk AS (SELECT k, quantile_cont(magnitude, 0.99) AS peak FROM sm GROUP BY k), nm AS (SELECT k, r, c, CASE WHEN peak > 0 THEN least(1e0, magnitude / peak) ELSE 0e0 END AS m FROM sm JOIN pk USING (k)),
    df AS (SELECT k, r, c, h, d FROM (SELECT *, abs(m - lag(m) OVER (PARTITION BY r, c ORDER BY k)) AS d FROM nm), dim WHERE d IS NOT NULL), av AS (SELECT k, r, c, sum(d) / 25 AS s FROM {_NEAR(2, 'df')} GROUP BY k, r, c), pd AS (SELECT k, quantile_cont(s, 0.99) AS peak FROM av GROUP BY k)
    SELECT k, r, c, round(CASE WHEN peak > 0 THEN least(1e0, s / peak) ELSE s END + 1e-9, 5) AS score FROM av JOIN pd USING (k)""")
def gradient_change(spark, sf_dir):
    g, height = _grid(spark, sf_dir)
    return focal.gradient_change(g, "g2", height, WIDTH).select("k", "r", "c", F.round(F.col("score") + 1e-9, 5).alias("score"))


# full grids of every date, numbered from 0; 0 where nothing was observed
_DATES = f"""{ctes('pixels')}, dim AS (SELECT CAST(max(r) + 1 AS INT) AS h, min(epoch) AS first, max(epoch) AS last FROM pixels),
    base AS (SELECT CAST(e - first AS INT) AS k, e AS epoch, CAST(a AS INT) AS r, CAST(b AS INT) AS c, h FROM (SELECT *, unnest(range(0, h)) AS a FROM (SELECT *, unnest(range(first, last + 1)) AS e FROM dim)), (SELECT unnest(range(0, {WIDTH})) AS b)),
    dg AS (SELECT b.k, b.r, b.c, b.h, coalesce((p.red + p.green + p.blue) / 3e0, 0e0) AS v FROM base b LEFT JOIN pixels p ON p.r = b.r AND p.c = b.c AND p.epoch = b.epoch)"""
_HOLD = lambda x, n: f"greatest(0, least({n} - 1, {x}))"
_EDGES = f"""{_DATES}, ug AS (SELECT k, r, c, h, CASE WHEN max(v) OVER w > min(v) OVER w THEN CAST(floor((v - min(v) OVER w) * (255e0 / (max(v) OVER w - min(v) OVER w))) AS INT) ELSE 0 END AS v FROM dg WINDOW w AS (PARTITION BY k)),
    st AS (SELECT * FROM (SELECT unnest(range(-1, 2)) AS dr), (SELECT unnest(range(-1, 2)) AS dc)),
    gr AS (SELECT a.k, a.r, a.c, sum(b.v * dc * (2 - abs(dr))) AS gx, sum(b.v * dr * (2 - abs(dc))) AS gy FROM ug a, st JOIN ug b ON b.k = a.k AND b.r = {_HOLD('a.r + dr', 'a.h')} AND b.c = {_HOLD('a.c + dc', WIDTH)} GROUP BY 1, 2, 3),
    mg AS (SELECT *, abs(gx) + abs(gy) AS m FROM gr), nb AS (SELECT a.k, a.r, a.c, a.gx, a.gy, a.m, {', '.join(f"coalesce(max(b.m) FILTER (dr = {y} AND dc = {x}), 0) AS n{y + 1}{x + 1}" for y in (-1, 0, 1) for x in (-1, 0, 1))}
        FROM mg a, st LEFT JOIN mg b ON b.k = a.k AND b.r = a.r + dr AND b.c = a.c + dc GROUP BY 1, 2, 3, 4, 5, 6),
    weak AS (SELECT k, r, c, m FROM nb WHERE m > 50 AND CASE WHEN abs(gy) * 32768 < abs(gx) * 13573 THEN m > n10 AND m >= n12 WHEN abs(gy) * 32768 > abs(gx) * 13573 + abs(gx) * 65536 THEN m > n01 AND m >= n21
        WHEN (gx < 0) <> (gy < 0) THEN m > n02 AND m > n20 ELSE m > n00 AND m > n22 END),
    edge AS (SELECT k, r, c FROM weak WHERE m > 150 UNION SELECT w.k, w.r, w.c FROM edge e JOIN weak w ON w.k = e.k AND abs(w.r - e.r) <= 1 AND abs(w.c - e.c) <= 1),
    wide AS (SELECT g.k, g.r, g.c, max(CASE WHEN e.r IS NULL THEN 0 ELSE 1 END) AS on_ FROM ug g LEFT JOIN edge e ON e.k = g.k AND abs(e.r - g.r) <= 2 AND abs(e.c - g.c) <= 2 GROUP BY 1, 2, 3),
    ec AS (SELECT a.k, a.r, a.c, abs(a.on_ - b.on_) * 1e0 AS score FROM wide a JOIN wide b ON b.k = a.k - 1 AND b.r = a.r AND b.c = a.c)"""


def _dates(spark, sf_dir):
    """(k, r, c, v): a full grid of brightness for each date, and its height."""
    p, years = table(spark, sf_dir, "pixels"), epochs(spark, sf_dir)
    height = p.agg(F.max("r")).first()[0] + 1
    base = spark.range(height * WIDTH).select(F.floor(F.col("id") / WIDTH).cast("int").alias("r"), (F.col("id") % WIDTH).cast("int").alias("c"), F.explode(F.array(*map(F.lit, years))).alias("epoch"))
    v = F.coalesce((F.col("red") + F.col("green") + F.col("blue")) / 3, F.lit(0.0))
    return base.join(p, ["epoch", "r", "c"], "left").select((F.col("epoch") - years[0]).alias("k"), "r", "c", v.alias("v")), height


@query("W06_edge_change", f"WITH RECURSIVE {_EDGES} SELECT k, r, c, score FROM ec")
def edge_change(spark, sf_dir):
    g, height = _dates(spark, sf_dir)
    return focal.edge_change(g, height, WIDTH)
