"""Queries of components, hotspots and what is made from change features."""

from __future__ import annotations

from pyspark.sql import functions as F

from groundshift.operators import components as cc
from groundshift.operators import parcels, series
from groundshift.operators.ranking import numbered
from groundshift.plans.land import _COVER, _DECLINE, _SERIES, _cover, _grid
from groundshift.plans.registry import query
from groundshift.sources.tables import ctes, epochs, table

_CELLS = f"{_SERIES}, cells AS (SELECT k, r, c, ndvi - before AS score FROM ev WHERE event)"
# the same closure by recursion over neighbours
_COMP = f"""{_CELLS}, reach AS (SELECT k, r, c, CAST(r AS BIGINT) * 1048576 + c AS q FROM cells UNION SELECT n.k, n.r, n.c, x.q FROM reach x JOIN cells n ON n.k = x.k AND abs(n.r - x.r) + abs(n.c - x.c) = 1),
    comp AS (SELECT k, r, c, min(q) AS comp FROM reach GROUP BY k, r, c)"""


def _cells(spark, sf_dir):
    return series.decline_events(_grid(spark, sf_dir), **_DECLINE).where("event").select("k", "r", "c", (F.col("ndvi") - F.col("before")).alias("score"))


def _labelled(spark, sf_dir):
    cells = cc.written(_cells(spark, sf_dir))
    return cells.join(cc.cell_components(cells, ["k"]), ["k", "r", "c"])


@query("A09_components", f"WITH RECURSIVE {_COMP} SELECT k, r, c, comp FROM comp")
def components(spark, sf_dir):
    return cc.cell_components(cc.written(_cells(spark, sf_dir)), ["k"])


_FEATURES = f"""{_COMP}, feat AS (SELECT k, comp, count(*) AS n_cells, round(avg(score), 4) AS mean_score, round(max(score), 4) AS max_score, min(r) AS r0, max(r) AS r1, min(c) AS c0, max(c) AS c1, count(*) * 100e0 AS area_m2 FROM comp JOIN cells USING (k, r, c) GROUP BY k, comp)"""


@query("A10_A11_W10_change_features", f"WITH RECURSIVE {_FEATURES} SELECT k, concat('CHG_', lpad(CAST(row_number() OVER (PARTITION BY k ORDER BY comp) AS VARCHAR), 5, '0')) AS change_id, n_cells, mean_score, max_score, area_m2 FROM feat WHERE n_cells >= 2")
def change_features(spark, sf_dir):
    f = numbered(cc.change_features(_labelled(spark, sf_dir), ["k"], least=200.0), [F.col("comp")], "number", ["k"])
    return f.select("k", F.format_string("CHG_%05d", "number").alias("change_id"), "n_cells", "mean_score", "max_score", "area_m2")


_BOXES_SQL = f"""{_FEATURES}, box AS (SELECT k * 1000000000000 + comp AS id, c0 * 10e0 AS x0, r0 * 10e0 AS y0, (c1 + 1) * 10e0 AS x1, (r1 + 1) * 10e0 AS y1, area_m2, -mean_score AS score, first + k - 1 AS year_from, first + k AS year_to, concat(CAST(first + k - 1 AS VARCHAR), '_', CAST(first + k AS VARCHAR)) AS pair FROM feat, (SELECT min(epoch) AS first FROM ep) WHERE n_cells >= 4)"""
_HOT = f"""{_BOXES_SQL},
    link AS (SELECT a.id AS a, b.id AS b FROM box a JOIN box b ON a.id <> b.id AND pow(greatest(0e0, a.x0 - b.x1, b.x0 - a.x1), 2) + pow(greatest(0e0, a.y0 - b.y1, b.y0 - a.y1), 2) <= 20 * 20),
    hr AS (SELECT id AS node, id AS q FROM box UNION SELECT link.b, hr.q FROM hr JOIN link ON link.a = hr.node), lab AS (SELECT node, min(q) AS label FROM hr GROUP BY node),
    hot AS (SELECT label, count(*) AS n, round(sum(area_m2), 4) AS area_m2, round(sum(area_m2 * score) / sum(area_m2), 6) AS score, min(year_from) AS first_year, max(year_to) AS last_year, count(DISTINCT pair) AS frequency, array_to_string(list_sort(list_distinct(list(pair))), ',') AS pairs FROM box JOIN lab ON lab.node = box.id GROUP BY label)"""


def _boxes(spark, sf_dir):
    f = cc.change_features(_labelled(spark, sf_dir), ["k"], least=400.0)
    year = F.col("k") + (epochs(spark, sf_dir)[0] - 1)
    return cc.written(f.select((F.col("k") * F.lit(1000000000000) + F.col("comp")).alias("id"), (F.col("c0") * 10.0).alias("x0"), (F.col("r0") * 10.0).alias("y0"), ((F.col("c1") + 1) * 10.0).alias("x1"), ((F.col("r1") + 1) * 10.0).alias("y1"), "area_m2", (-F.col("mean_score")).alias("score"), year.alias("year_from"), (year + 1).alias("year_to"), F.concat_ws("_", year.cast("string"), (year + 1).cast("string")).alias("pair")))


@query("A31_hotspots", f"WITH RECURSIVE {_HOT} SELECT label, n, area_m2, score, first_year, last_year, frequency, pairs FROM hot")
def hotspots(spark, sf_dir):
    return cc.hotspots(_boxes(spark, sf_dir), "id", 20.0)


@query("J24_near_pairs", f"WITH RECURSIVE {_HOT} SELECT a, b FROM link WHERE a < b")
def near_pairs(spark, sf_dir):
    return cc.near_boxes(_boxes(spark, sf_dir), "id", 20.0)


@query("W11_hotspot_rank", f"WITH RECURSIVE {_HOT} SELECT label, rank, rank <= 10 AND area_m2 >= 500 AS recommended FROM (SELECT label, area_m2, row_number() OVER (ORDER BY round(area_m2 * score * frequency, 4) DESC, label) AS rank FROM hot)")
def hotspot_rank(spark, sf_dir):
    h = cc.hotspots(_boxes(spark, sf_dir), "id", 20.0).withColumn("key", F.round(F.col("area_m2") * F.col("score") * F.col("frequency"), 4))
    return numbered(h, [F.desc("key"), F.col("label")], "rank").select("label", "rank", ((F.col("rank") <= 10) & (F.col("area_m2") >= 500)).alias("recommended"))


@query("A32_pair_summary", f"WITH RECURSIVE {_FEATURES}, p AS (SELECT CAST(unnest(range(1, 8)) AS INT) AS k) SELECT p.k, count(comp) AS polygons, coalesce(sum(area_m2), 0e0) AS area_m2 FROM p LEFT JOIN feat ON feat.k = p.k GROUP BY p.k")
def pair_summary(spark, sf_dir):
    pairs = spark.range(1, 8).select(F.col("id").cast("int").alias("k"))
    f = cc.change_features(_labelled(spark, sf_dir), ["k"])
    return pairs.join(f.groupBy("k").agg(F.count(F.lit(1)).alias("polygons"), F.sum("area_m2").alias("area_m2")), "k", "left").select("k", F.coalesce("polygons", F.lit(0)).alias("polygons"), F.coalesce("area_m2", F.lit(0.0)).alias("area_m2"))


@query("J17_A28_parcel_changes", f"WITH RECURSIVE {_COMP}, {ctes('parcels')}, {_COVER}, o AS (SELECT pnu, k, comp, sum(area) AS area FROM cov JOIN comp USING (r, c) GROUP BY 1, 2, 3) SELECT pnu, round(sum(area), 4) AS area, count(*) AS changes, arg_max(k * 1000000000000 + comp, (round(area, 6), k * 1000000000000 + comp)) AS main_change FROM o GROUP BY pnu")
def parcel_changes(spark, sf_dir):
    comp = cc.written(components(spark, sf_dir))
    o = _cover(spark, sf_dir).join(comp, ["r", "c"]).groupBy("pnu", "k", "comp").agg(F.sum("area").alias("area"))
    ident = F.col("k") * F.lit(1000000000000) + F.col("comp")
    return o.groupBy("pnu").agg(F.round(F.sum("area"), 4).alias("area"), F.count(F.lit(1)).alias("changes"), F.max_by(ident, F.struct(F.round("area", 6), ident)).alias("main_change"))


@query("J14_unmatched_changes", f"WITH RECURSIVE {_COMP}, {ctes('buildings')}, {_COVER.replace('pnu', 'bld_id').replace('parcels', 'buildings')} SELECT DISTINCT k, comp FROM comp WHERE (k, comp) NOT IN (SELECT (k, comp) FROM comp JOIN cov USING (r, c))")
def unmatched_changes(spark, sf_dir):
    """Changes that touch no building."""
    comp = cc.written(components(spark, sf_dir))
    built = parcels.coverage(table(spark, sf_dir, "buildings"), "bld_id").select("r", "c")
    met = comp.join(built, ["r", "c"], "left_semi").select("k", "comp").distinct()
    return comp.select("k", "comp").distinct().join(met, ["k", "comp"], "left_anti")
