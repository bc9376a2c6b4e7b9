"""Screening of all pairs of years as one chain, from pixels to squares to order."""

from __future__ import annotations

from pyspark.sql import functions as F

from groundshift.operators import screening as sg
from groundshift.operators.components import change_features, written
from groundshift.plans.clusters import _FEATURES, _labelled
from groundshift.plans.registry import query
from groundshift.plans.shapes import _r
from groundshift.sources.tables import epochs

#: Metres between changes of one hotspot, cells of a change, and what makes a hotspot worth an order.
_DISTANCE, _CELLS, _TOP, _AREA, _SCORE = 20.0, 4, 10, 500.0, 0.15
_BUFFER, _SIDE, _MOST = 30.0, 100.0, 200.0

_SPOTS = f"""{_FEATURES}, sf AS (SELECT k * 1000000000000 + comp AS id, k, comp, area_m2, -mean_score AS score, CAST(first + k - 1 AS INT) AS year_from, CAST(first + k AS INT) AS year_to, concat(CAST(first + k - 1 AS VARCHAR), '_', CAST(first + k AS VARCHAR)) AS pair FROM feat, (SELECT min(epoch) AS first FROM ep) WHERE n_cells >= {_CELLS}),
    sc AS (SELECT id, r, c FROM comp JOIN sf USING (k, comp)), sl AS (SELECT DISTINCT a.id AS a, b.id AS b FROM sc a JOIN sc b ON a.id <> b.id AND abs(a.r - b.r) <= 3 AND abs(a.c - b.c) <= 3 AND pow(greatest(abs(a.r - b.r) - 1, 0) * 10, 2) + pow(greatest(abs(a.c - b.c) - 1, 0) * 10, 2) <= {_DISTANCE**2}),
    sh AS (SELECT id AS node, id AS q FROM sf UNION SELECT sl.b, sh.q FROM sh JOIN sl ON sl.a = sh.node), sb AS (SELECT node AS id, min(q) AS label FROM sh GROUP BY node),
    su AS (SELECT label, count(*) * 100e0 AS area_m2, avg((c + 0.5e0) * 10) AS x, avg((r + 0.5e0) * 10) AS y, min(c) * 10e0 AS x0, min(r) * 10e0 AS y0, (max(c) + 1) * 10e0 AS x1, (max(r) + 1) * 10e0 AS y1 FROM (SELECT DISTINCT label, r, c FROM sc JOIN sb USING (id)) GROUP BY label),
    sp AS (SELECT label, count(*) AS n, sum(area_m2 * score) / sum(area_m2) AS score, min(year_from) AS first_year, max(year_to) AS last_year, count(DISTINCT pair) AS frequency, array_to_string(list_sort(list(DISTINCT pair)), ',') AS pairs FROM sf JOIN sb USING (id) GROUP BY label),
    sr AS (SELECT *, round(area_m2 * score * frequency + 1e-9, 1) AS priority FROM sp JOIN su USING (label)), sk AS (SELECT *, row_number() OVER (ORDER BY priority DESC, label) AS rank FROM sr), ss AS (SELECT *, printf('HS_%02d', rank) AS hotspot_id, rank <= {_TOP} AND area_m2 >= {_AREA} AND score >= {_SCORE} AS recommended FROM sk)"""


def _found(spark, sf_dir):
    """Cells and features of the changes of all pairs."""
    cells = written(_labelled(spark, sf_dir).withColumn("id", F.col("k") * F.lit(1000000000000) + F.col("comp")))
    first = epochs(spark, sf_dir)[0]
    year = (F.col("k") + (first - 1)).cast("int")
    f = change_features(cells, ["k"], least=_CELLS * 100.0).select((F.col("k") * F.lit(1000000000000) + F.col("comp")).alias("id"), "area_m2", (-F.col("mean_score")).alias("score"), year.alias("year_from"), (year + 1).alias("year_to"), F.concat_ws("_", year.cast("string"), (year + 1).cast("string")).alias("pair"))
    f = written(f)
    return written(cells.join(f.select("id"), "id", "left_semi").select("id", "r", "c")), f


@query("E03_hotspots", f"WITH RECURSIVE {_SPOTS} SELECT hotspot_id, rank, label, n, area_m2, round(score + 1e-9, 6) AS score, first_year, last_year, frequency, pairs, priority, round(x + 1e-9, 4) AS x, round(y + 1e-9, 4) AS y, recommended FROM ss")
def hotspots(spark, sf_dir):
    """Hotspots of any shape with their ranks; clusters of J24 from cells and not from boxes."""
    h = sg.ranked(sg.hotspots(*_found(spark, sf_dir), _DISTANCE, 10.0)[0], _TOP, _AREA, _SCORE)
    return h.select("hotspot_id", "rank", "label", "n", "area_m2", _r("score", 6).alias("score"), "first_year", "last_year", "frequency", "pairs", "priority", _r("x", 4).alias("x"), _r("y", 4).alias("y"), "recommended")


_SQUARES = f"""{_SPOTS}, qa AS (SELECT hotspot_id, row_number() OVER (ORDER BY rank) AS i, (x0 + x1) / 2 AS cx, (y0 + y1) / 2 AS cy, greatest(x1 - x0 + {2 * _BUFFER}, y1 - y0 + {2 * _BUFFER}, {_SIDE}e0) AS side FROM ss WHERE recommended), qs AS (SELECT hotspot_id, i, side > {_MOST} AS roi_clipped, cx, cy, least(side, {_MOST}e0) AS side FROM qa),
    q AS (SELECT *, cx - side / 2 AS x0, cy - side / 2 AS y0, cx + side / 2 AS x1, cy + side / 2 AS y1 FROM qs),
    go AS (SELECT CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS kept UNION ALL SELECT b.i, CASE WHEN (SELECT count(*) FROM q a WHERE list_contains(go.kept, a.i) AND greatest(0e0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0e0, least(a.y1, b.y1) - greatest(a.y0, b.y0)) >= 0.5e0 * b.side * b.side) = 0 THEN list_append(go.kept, b.i) ELSE go.kept END FROM go JOIN q b ON b.i = go.i + 1)"""


@query("E03_image_orders", f"WITH RECURSIVE {_SQUARES} SELECT hotspot_id, roi_clipped, round(side, 1) AS roi_size_m, round(side * side / 1e6, 3) AS roi_area_km2, x0, y0, x1, y1 FROM q WHERE list_contains((SELECT max_by(kept, i) FROM go), i)")
def image_orders(spark, sf_dir):
    h = sg.ranked(sg.hotspots(*_found(spark, sf_dir), _DISTANCE, 10.0)[0], _TOP, _AREA, _SCORE)
    return sg.orders(h, _BUFFER, _SIDE, _MOST).drop("rank")


@query("E03_A32_pair_summary", f"WITH RECURSIVE {_SPOTS}, pr AS (SELECT concat(CAST(epoch - 1 AS VARCHAR), '_', CAST(epoch AS VARCHAR)) AS pair FROM ep WHERE k > 0) SELECT pr.pair, count(sf.id) AS polygons, coalesce(sum(sf.area_m2), 0e0) AS area_m2, count(DISTINCT label) AS hotspots FROM pr LEFT JOIN sf USING (pair) LEFT JOIN sb USING (id) GROUP BY pr.pair")
def pair_summary(spark, sf_dir):
    cells, f = _found(spark, sf_dir)
    years = epochs(spark, sf_dir)
    pairs = spark.createDataFrame([(f"{a}_{b}",) for a, b in zip(years, years[1:])], "pair string")
    return sg.pair_summary(pairs, f, sg.hotspots(cells, f, _DISTANCE, 10.0)[1])
