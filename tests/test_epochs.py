"""Incremental runs on written tables, sites through epochs, features from text and from ways."""

import json
import random

import pytest
from pyspark.sql import functions as F

from groundshift.operators import incremental as inc
from groundshift.operators import sites
from groundshift.sources import features as ft


def table(spark, rows):
    return spark.createDataFrame(rows, "pair string, v int")


def test_only_changed_new_and_failed_pairs_are_done_again(spark, tmp_path):
    target, seen = f"file://{tmp_path}/run", []

    def total(d):
        seen.append({r.pair for r in d.select("pair").distinct().collect()})
        return d.where("v > 0").groupBy("pair").agg(F.sum("v").alias("total"))

    def broken(d):
        raise RuntimeError("no result")

    first = [("a", 1), ("a", 2), ("b", 5), ("c", 7)]
    assert inc.run(table(spark, first), total, target) == 3
    assert inc.run(table(spark, first[::-1]), total, target) == 0 and len(seen) == 1
    assert inc.run(table(spark, [*first, ("b", 1), ("d", 4)]), total, target) == 2 and seen[-1] == {"b", "d"}
    with pytest.raises(RuntimeError):
        inc.run(table(spark, [*first, ("c", 9)]), broken, target)
    # c and b have changed: b is as in the first run again, so it was in the failed run as well
    last = {r.pair: (r.status, r.run) for r in inc.manifest(spark, target).collect()}
    assert last["c"][0] == last["b"][0] == "FAILED" and last["a"] == ("SUCCESS", 1)
    with pytest.raises(ValueError, match="c"):
        inc.collected(spark, target, ["a", "c"])
    # c has no rows with v > 0 now: it is done, and its old result is gone
    assert inc.run(table(spark, [("a", 1), ("a", 2), ("b", 5), ("c", -1), ("d", 4)]), total, target) == 2
    assert {(r.pair, r.total) for r in inc.collected(spark, target, ["a", "b", "c", "d"]).collect()} == {("a", 3), ("b", 5), ("d", 4)}


def test_signatures_count_repeated_rows(spark):
    one, two = (inc.signatures(table(spark, [("a", 1)] * n)).first().signature for n in (1, 2))
    assert one != two and one == inc.signatures(table(spark, [("a", 1)]).select("v", "pair")).first().signature


def test_same_sites_equal_all_pairs(spark):
    rng = random.Random(6)
    rows = [(i, rng.randrange(4), rng.uniform(-90, 90), rng.uniform(-90, 90)) for i in range(120)]
    got = {r.id: r.others for r in sites.same_sites(spark.createDataFrame(rows, "id bigint, k int, x double, y double"), 30.0).collect()}
    for i, k, x, y in rows:
        assert got[i] == sorted({k2 for _, k2, x2, y2 in rows if k2 != k and (x - x2) ** 2 + (y - y2) ** 2 <= 900})


def test_bracketing(spark):
    df = spark.createDataFrame([("STRADDLES_BASELINE", 0.6, 5, 6), ("STRADDLES_BASELINE", 0.6, 1, 2), ("UNKNOWN", 0.5, 2, 4), ("POST_BASELINE_PERMITTED", 0.3, 4, 5), ("UNKNOWN", 0.5, None, None)], "s string, r double, a int, b int")
    status, risk = sites.bracketed(F.col("s"), F.col("r"), F.col("a"), F.col("b"), F.lit(3))
    assert [tuple(x) for x in df.select(status, risk).collect()] == [("POST_BASELINE_UNVERIFIED", 1.0), ("PRE_BASELINE", 0.0), ("UNKNOWN", 0.5), ("POST_BASELINE_PERMITTED", 1.0), ("UNKNOWN", 0.5)]
    with pytest.raises(ValueError):
        sites.progress(df, df, [], "s")


def test_geojson_files(spark, tmp_path):
    square = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
    feats = [
        {"type": "Feature", "id": "a", "properties": {"landuse": "quarry", "n": 3}, "geometry": {"type": "Polygon", "coordinates": [square, [[1, 1], [2, 1], [2, 2], [1, 1]]]}},
        {"type": "Feature", "id": "b", "properties": None, "geometry": {"type": "MultiPolygon", "coordinates": [[square], [[[9, 9], [10, 9], [9, 10]]]]}},
        {"type": "Feature", "id": "c", "properties": {"landuse": "farm"}, "geometry": {"type": "Point", "coordinates": [1, 2]}},
    ]
    (tmp_path / "c.json").write_text(json.dumps({"type": "FeatureCollection", "features": feats}, indent=1))
    (tmp_path / "l.jsonl").write_text("\n".join([*map(json.dumps, feats), "not a feature", ""]))
    for f in (ft.read_geojson(spark, str(tmp_path / "c.json")), ft.read_geojson(spark, str(tmp_path / "l.jsonl"), lines=True)):
        assert f.count() == 3
        n = {(r.feature, r.part, r.ring): r.n for r in ft.corners(f).groupBy("feature", "part", "ring").agg(F.count("x").alias("n")).collect()}
        assert n == {("a", 0, 0): 4, ("a", 0, 1): 3, ("b", 0, 0): 4, ("b", 1, 0): 3}
        assert [r.feature for r in ft.tagged(f, {"landuse": ["quarry"], "natural": ["rock"]}).collect()] == ["a"]
        assert ft.tagged(f, {"landuse": ["none"]}).count() == 0


def test_ways_make_rings(spark):
    rng, rows, want = random.Random(8), [], {}
    for rel in range(5):
        n = [3, 4, 9, 17, 30][rel]
        ring = [(float(rel * 100 + rng.randrange(50)), float(k)) for k in range(n)]
        want[rel] = ring
        cuts = sorted(rng.sample(range(n), max(2, n // 3)))
        for k, (a, b) in enumerate(zip(cuts, [*cuts[1:], cuts[0] + n], strict=True)):
            points = [ring[i % n] for i in range(a, b + 1)]
            rows.append((rel, rel * 1000 + rng.randrange(900) * 10 + k, points[::-1] if rng.random() < 0.5 else points))
    rows += [(7, 1, [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]), (8, 1, [(0.0, 0.0), (5.0, 5.0)]), (8, 2, [(5.0, 5.0), (9.0, 9.0)])]
    df = spark.createDataFrame([(r, w, [dict(x=x, y=y) for x, y in p]) for r, w, p in rows], "rel int, way bigint, points array<struct<x:double,y:double>>")
    got = {}
    for r in sorted(ft.assembled(df).collect(), key=lambda r: (r.rel, r.i)):
        got.setdefault(r.rel, []).append((r.x, r.y))
    assert set(got) == {*want, 7} and got[7] == [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]
    for rel, ring in want.items():
        at = ring.index(got[rel][0])
        around = [ring[(at + k) % len(ring)] for k in range(len(ring))]
        assert got[rel] in (around, [around[0], *around[:0:-1]])


def test_swept_cells_are_not_sent_to_all_tasks(spark):
    """The table of all cells compresses well; its files' size lets nothing be broadcast."""
    from groundshift.operators import sweep

    variants = sweep.one_at_a_time({"delta": -0.2, "increase": 0.1, "least": 1, "adjacency": 30.0, "followup": 1}, {"least": [2, 3]})
    states = spark.range(400).selectExpr("int(id / 20) r", "int(id % 20) c", "array(id % 3 = 0) exposed", "array(id % 2 = 0) loss", "array(false) recovery")
    expansion = states.where("r < 2").selectExpr("r", "c", "array(0, 2) variants")
    cover = states.selectExpr("r", "c", "100.0D area")
    out = sweep.swept(states, expansion, cover, cover.selectExpr("r k", "r", "c", "area"), variants, [(-0.2, 0.1)], "k", 100.0)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("SortMergeJoin [r#") == 2
    got = {(r.parameter, r.value): (r.loss_ha, r.expansion_ha, r.parcels_expansion) for r in out.collect()}
    assert got == {("default", "default"): (2.0, 0.4, 2), ("least", "2"): (2.0, 0.0, 0), ("least", "3"): (2.0, 0.4, 2)}
