"""Sweeps, screening, field work and sensor rules on small cases, against plain Python where there is something to compute."""

import random

import pytest
from pyspark.sql import functions as F

from groundshift.operators import fieldwork as fw
from groundshift.operators import focal, scoring, screening, sensors, sweep
from groundshift.operators import polygons as pg


def reached(cells, near):
    """Plain closure: label of each cell's group, the least member."""
    label, left = {}, set(cells)
    while left:
        group, todo = set(), [min(left)]
        while todo:
            a = todo.pop()
            if a in left:
                left.discard(a)
                group.add(a)
                todo += [b for b in left if near(a, b)]
        label |= dict.fromkeys(group, min(group))
    return label


def test_expansion_of_each_variant_equals_a_plain_search(spark):
    rnd = random.Random(3)
    base = {"delta": -0.1, "increase": 0.02, "least": 3, "adjacency": 30.0, "followup": 1}
    variants = sweep.one_at_a_time(base, {"delta": [-0.3], "least": [1, 4], "adjacency": [15.0, 60.0]})
    settings = list(dict.fromkeys((v.delta, v.increase) for v in variants))
    cells = {(r, c): [rnd.random() < 0.3, False] for r in range(14) for c in range(14)}
    for s in cells.values():
        s[1] = s[0] and rnd.random() < 0.6
    quarry = {(6, 6), (6, 7), (7, 6)}
    states = spark.createDataFrame([(r, c, s) for (r, c), s in cells.items()], "r int, c int, exposed array<boolean>")
    got = {(x.r, x.c, i) for x in sweep.expanded(states, spark.createDataFrame(list(quarry), "r int, c int"), variants, settings, 10.0).collect() for i in x.variants}
    want = set()
    for i, v in enumerate(variants):
        on = [p for p, s in cells.items() if s[settings.index((v.delta, v.increase))]]
        label = reached(on, lambda a, b: max(abs(a[0] - b[0]), abs(a[1] - b[1])) <= 1)
        for top in set(label.values()):
            group = [p for p in on if label[p] == top]
            far = min(((p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2) ** 0.5 * 10 for p in group for q in quarry)
            if len(group) >= v.least and far <= v.adjacency:
                want |= {(*p, i) for p in group if p not in quarry}
    assert got == want and want


def test_nothing_expands_without_a_reference(spark):
    states = spark.createDataFrame([(0, 0, [True])], "r int, c int, exposed array<boolean>")
    one = sweep.one_at_a_time({"delta": -0.1, "increase": 0.0, "least": 1, "adjacency": 1e9, "followup": 1}, {})
    assert sweep.expanded(states, spark.createDataFrame([], "r int, c int"), one, [(-0.1, 0.0)], 10.0).count() == 0


def test_hotspots_follow_shapes_and_not_boxes(spark):
    hook = [("hook", 0, c) for c in range(9)] + [("hook", r, 0) for r in range(9)]
    inner, same = [("inner", 6, 6), ("inner", 6, 7)], [("again", 0, 8), ("again", 0, 7)]
    cells = spark.createDataFrame(hook + inner + same, "id string, r int, c int")
    feats = spark.createDataFrame([("hook", 1700.0, 0.2, 2000, 2001, "2000_2001"), ("inner", 200.0, 0.4, 2000, 2001, "2000_2001"), ("again", 200.0, 0.8, 2001, 2002, "2001_2002")], "id string, area_m2 double, score double, year_from int, year_to int, pair string")
    spots, label = screening.hotspots(cells, feats, 20.0, 10.0)
    got = {r.label: r for r in spots.collect()}
    assert {r.id: r.label for r in label.collect()} == {"hook": "again", "again": "again", "inner": "inner"}  # the box of the hook holds inner, its cells are 30 m away and more
    a = got["again"]
    assert (a.area_m2, a.n, a.frequency, a.pairs, a.first_year, a.last_year) == (1700.0, 2, 2, "2000_2001,2001_2002", 2000, 2002)
    assert a.score == pytest.approx((1700 * 0.2 + 200 * 0.8) / 1900)
    ranked = {r.label: (r.rank, r.hotspot_id, r.recommended) for r in screening.ranked(spots, 2, 300.0, 0.0).collect()}
    assert ranked == {"again": (1, "HS_01", True), "inner": (2, "HS_02", False)}
    pairs = spark.createDataFrame([("2000_2001",), ("2001_2002",), ("2002_2003",)], "pair string")
    assert sorted(map(tuple, screening.pair_summary(pairs, feats, label).collect())) == [("2000_2001", 2, 1900.0, 2), ("2001_2002", 1, 200.0, 1), ("2002_2003", 0, 0.0, 0)]


def test_a_square_that_a_better_one_covers_is_not_ordered(spark):
    boxes = [(1, "HS_01", True, 0.0, 0.0, 10.0, 10.0), (2, "HS_02", True, 20.0, 0.0, 30.0, 10.0), (3, "HS_03", True, 500.0, 0.0, 510.0, 10.0), (4, "HS_04", False, 900.0, 0.0, 910.0, 10.0)]
    h = spark.createDataFrame(boxes, "rank int, hotspot_id string, recommended boolean, x0 double, y0 double, x1 double, y1 double")
    got = {r.hotspot_id: r.roi_size_m for r in screening.orders(h, 45.0, 80.0, None).collect()}
    assert got == {"HS_01": 100.0, "HS_03": 100.0}


def square(key, x, y, side):
    return [(key, 0, i, float(a), float(b)) for i, (a, b) in enumerate([(x, y), (x + side, y), (x + side, y + side), (x, y + side)])]


def test_review_zones_merge_where_buffers_touch(spark):
    rows = square(1, 0, 0, 20) + square(2, 25, 0, 20) + square(3, 200, 200, 10) + square(4, 4, 4, 4)
    shapes = pg.Shapes(spark.createDataFrame(rows, "id int, ring int, i int, x double, y double"), "id")
    got = {r.zone: (r.members, r.area_m2) for r in fw.review_zones(shapes, 3.0, size=1.0).collect()}
    assert got.keys() == {1, 3} and (got[1][0], got[3][0]) == (3, 1)

    def area(squares):
        near = lambda x, y, q: ((max(q[0] - x, 0, x - q[0] - q[2])) ** 2 + (max(q[1] - y, 0, y - q[1] - q[2])) ** 2) ** 0.5 <= 3
        return float(sum(any(near(x + 0.5, y + 0.5, q) for q in squares) for x in range(-10, 230) for y in range(-10, 230)))

    assert got[1][1] == area([(0, 0, 20), (25, 0, 20), (4, 4, 4)]) and got[3][1] == area([(200, 200, 10)])


def test_review_takes_only_criteria_that_are_there(spark):
    c = spark.createDataFrame([(1, False, "HIGH", None, "UNKNOWN"), (2, True, "HIGH", True, "PRE_BASELINE"), (3, True, "LOW", False, None), (4, None, None, None, "POST_BASELINE_UNVERIFIED")], "id int, matched boolean, inspection_priority string, consistent boolean, status string")
    ids = lambda d: {r.id for r in fw.for_review(d).collect()}
    assert ids(c) == {1, 3, 4} and ids(c.drop("status")) == {1, 3} and ids(c.select("id", "consistent")) == {3} and ids(c.select("id")) == set()


def test_focus_names_every_reason_or_the_plain_text(spark):
    rows = [(1, "DEMOLITION", 6, 0, 2, "POST_BASELINE_UNVERIFIED", "A_STRONG"), (2, None, 1, 1, 0, None, None)]
    s = spark.createDataFrame(rows, "id int, kind string, n long, matched long, flagged long, status string, grade string")
    got = {r.id: r.t for r in s.select("id", fw.survey_focus(*(F.col(x) for x in ("kind", "n", "matched", "flagged", "status", "grade"))).alias("t")).collect()}
    assert got[1].split(" / ") == [fw.FOCUS["DEMOLITION"], fw.UNMATCHED, "2".join(fw.DIRECTION), fw.BASELINE, fw.STRONG, "6".join(fw.MANY)]
    assert got[2] == fw.PLAIN


def test_second_band_gives_the_first_reason(spark):
    schema = "scene_id int, day string, baseline string, removed int"
    scenes = spark.createDataFrame([(None, "a", "4", 1), (1, "a", "4", 1), (2, "b", "5", 1), (3, "a", "5", 0), (4, "a", "4", 0), (5, "a", None, None), (6, "a", "4", 1)], schema)
    items = spark.createDataFrame([(i, "a", "4", 1) for i in range(2, 7)], schema)
    got = {r.scene_id: (r.status, r.reason) for r in sensors.second_band(scenes, items, ["day"]).collect()}
    bad = lambda r: ("UNAVAILABLE", r)
    assert got == {None: bad("NO_SCENE_ID"), 1: bad("NOT_FOUND"), 2: bad("DATE_MISMATCH"), 3: bad("BASELINE_MISMATCH"), 4: bad("OFFSET_MISMATCH"), 5: ("OK", None), 6: ("OK", None)}


def test_lattices_must_be_whole_cells_apart(spark):
    c = spark.createDataFrame([(0, 0), (1, 3)], "r int, c int")
    assert sorted(map(tuple, sensors.placed(c, (-10.0, 20.0), (0.0, 0.0), 10.0).select("r", "c", "r2", "c2").collect())) == [(2, -1, 1, -1), (3, 2, 1, 1)]
    with pytest.raises(ValueError, match="whole"):
        sensors.placed(c, (5.0, 0.0), (0.0, 0.0), 10.0)


def test_otsu_threshold_is_each_pairs_own(spark):
    rows = [(1, i, True, 0.1 if i % 2 else 0.5) for i in range(20)] + [(2, i, True, 0.7 if i % 2 else 0.9) for i in range(20)] + [(3, i, True, 0.4) for i in range(5)]
    s = spark.createDataFrame(rows, "k int, c int, valid boolean, p double")
    got = dict(scoring.masked(s, "p", "otsu", 0.6).groupBy("k").agg(F.count_if("mask")).collect())
    assert got == {1: 10, 2: 10, 3: 0}


def test_gradient_change_is_zero_between_equal_dates(spark):
    g = spark.createDataFrame([(k, r, c, (100 if c >= 4 + (k == 2) else 0)) for k in range(3) for r in range(8) for c in range(8)], "k int, r int, c int, v long")
    got = focal.gradient_change(g, "v", 8, 8).groupBy("k").agg(F.max("score").alias("m")).collect()
    assert {r.k: r.m for r in got} == {1: 0.0, 2: 1.0}
