"""Rules on small hand-made cases."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from groundshift.functions import keys
from groundshift.operators import evidence, indices, parcels, reporting, scoring, series, statistics
from groundshift.operators.ranking import numbered


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(k) for k, c in columns.items())).first()


def test_series_that_fall_and_may_rise_again(spark):
    values = [[0.62, 0.08, 0.11, 0.05], [0.33, 0.41, 0.38, 0.36], [0.55, 0.58, 0.12, 0.66], [0.61, 0.57, 0.59, 0.09]]
    rows = [(i, 0, 2001 + k, v) for i, s in enumerate(values) for k, v in enumerate(s)]
    df = spark.createDataFrame(rows, "r int, c int, epoch int, ndvi double")
    got = {x.r: (x.persistence, x.first_interval) for x in series.persistence(series.full_grid(df, [2001, 2002, 2003, 2004])).collect()}
    assert got == {0: ("PERSISTENT", 0), 1: ("NONE", None), 2: ("TEMPORARY", 1), 3: ("UNCONFIRMED", 2)}


def test_missing_year_is_no_decline(spark):
    rows = [(0, 0, e, v) for e, v in zip(range(6), [0.7, 0.7, None, 0.1, 0.1, 0.1], strict=True) if v is not None]
    df = spark.createDataFrame(rows, "r int, c int, epoch int, ndvi double")
    assert series.persistence(series.full_grid(df, list(range(6)))).first().frequency == 0


def test_ndvi_is_null_where_it_means_nothing(spark):
    got = one(spark, a=indices.ndvi(F.lit(0.0), F.lit(1.0)), b=indices.ndvi(F.lit(1.0), F.lit(3.0)), c=indices.norm_diff(F.lit(0.0), F.lit(0.0)))
    assert (got.a, got.b, got.c) == (None, 0.5, None)


def test_coverage_is_exact(spark):
    f = spark.createDataFrame([(1, 5.0, 5.0, 25.0, 15.0)], "k int, x0 double, y0 double, x1 double, y1 double")
    got = {(x.r, x.c): x.area for x in parcels.coverage(f, "k").collect()}
    assert sum(got.values()) == 200.0 and got[(0, 0)] == 25.0 and got[(0, 1)] == 50.0 and len(got) == 6


def test_lot_texts(spark):
    df = spark.createDataFrame([("산 12-3 임",), ("1-1 전",), ("3 대",), ("x",)], "t string")
    got = [tuple(r) for r in df.select(*(c.alias(k) for k, c in keys.lot_parts(F.col("t")).items())).collect()]
    assert got == [(True, 12, 3, "임"), (False, 1, 1, "전"), (False, 3, 0, "대"), (False, None, None, None)]


def test_dates(spark):
    df = spark.createDataFrame([("19950230",), ("19950228",), ("1995-02-28",), ("1995",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(keys.any_date(F.col("t"))).collect()]
    assert got == [None, date(1995, 2, 28), date(1995, 2, 28), date(1995, 1, 1), None, None]


def test_register_date_wins(spark):
    def kind(ratio, near, matched, approved):
        return one(spark, k=evidence.change_type(F.lit(ratio), F.lit(near), F.lit(matched), F.lit(approved).cast("date"), date(2022, 1, 1), date(2024, 1, 1))).k

    assert kind(0.0, True, False, None) == "OTHER_CHANGE"
    assert kind(0.0, False, False, None) is None
    assert kind(0.1, False, True, date(2023, 1, 1)) == "NEW_BUILDING"
    assert kind(0.9, False, True, date(2001, 1, 1)) == "EXPANSION_OR_RECONSTRUCTION"
    assert kind(0.9, False, False, None) == "NEW_BUILDING"


def test_confusion_counts_each_case(spark):
    df = spark.createDataFrame([(True, True)] * 4 + [(False, True)] * 3 + [(True, False)] * 2 + [(False, False)], "t boolean, p boolean")
    x = statistics.confusion(df, F.col("t"), F.col("p")).first()
    assert (x.tp, x.fp, x.fn, x.tn) == (4, 3, 2, 1)


def test_neighbours_widen_their_ring(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 0.0), (3, 1000.0, 0.0)], "id int, x double, y double")
    got = {(x.id, x["rank"]): x.other for x in statistics.neighbours(df, 2, 2.0).collect()}
    assert got == {(1, 1): 2, (1, 2): 3, (2, 1): 1, (2, 2): 3, (3, 1): 2, (3, 2): 1}


def test_neighbours_in_small_pieces_equal_brute_force(spark, monkeypatch):
    """Few rows a task and few distances at a time, places shared by several, one point far away, keys that are text."""
    monkeypatch.setattr(statistics, "TASK_ROWS", 50)
    monkeypatch.setattr(statistics, "DISTANCES", 64)
    rng = random.Random(5)
    at = {f"p{k:03d}": (float(rng.randrange(30)), float(rng.randrange(30))) for k in range(120)} | {"far": (900.0, 900.0)}
    got = {(r.id, r["rank"]): (r.other, r.d2) for r in statistics.neighbours(spark.createDataFrame([(k, *v) for k, v in at.items()], "id string, x double, y double"), 4, 4.0).collect()}
    far = lambda a, b: (at[a][0] - at[b][0]) ** 2 + (at[a][1] - at[b][1]) ** 2
    want = {(a, i + 1): (b, far(a, b)) for a in at for i, b in enumerate(sorted((b for b in at if b != a), key=lambda b: (far(a, b), b))[:4])}
    assert got == want


def test_route_walks_each_tier(spark):
    rows = [(7, 4, "MEDIUM", 0.2, 9.0, 0.0), (7, 1, "MEDIUM", 0.9, 2.0, 0.0), (7, 2, "HIGH", 0.1, 1.0, 0.0), (7, 3, "HIGH", 0.6, 6.0, 0.0), (7, 9, "HIGH", 1.0, None, None), (7, 8, "LOW", 1.0, None, 0.0), (8, 5, "LOW", 0.3, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "project int, site_id int, tier string, score double, x double, y double")
    got = {r.site_id: r.route_order for r in reporting.routed(df, "project").collect()}
    assert got == {3: 1, 2: 2, 1: 3, 4: 4, 8: 5, 9: 6, 5: 1}


def test_long_route_is_the_plain_one(spark):
    """Thousands of sites of one project, with places shared by several and some without a y: each step the least by tier, distance and id."""
    rng = random.Random(3)
    rows = [(1, k, rng.choice(["HIGH", "LOW"]), rng.random(), float(rng.randrange(80)), None if k % 97 == 0 else float(rng.randrange(400))) for k in range(4000)]
    got = [r.site_id for r in reporting.routed(spark.createDataFrame(rows, "project int, site_id int, tier string, score double, x double, y double"), "project").orderBy("route_order").collect()]
    want, here = [], None
    for tier in ("HIGH", "LOW"):
        left = {k: (x, y) for _, k, t, _, x, y in rows if t == tier}
        while left:
            if not want:
                k = min((-r[3], r[1]) for r in rows if r[2] == tier)[1]
            else:
                far = lambda p: float("inf") if p[1] is None or here[1] is None else (p[0] - here[0]) ** 2 + (p[1] - here[1]) ** 2  # noqa: B023,E731
                k = min(left, key=lambda k: (far(left[k]), k))  # noqa: B023
            here = left.pop(k)
            want.append(k)
    assert got == want


def test_numbers_within_groups_and_over_all(spark):
    df = spark.createDataFrame([(k % 3, (k * 37) % 101) for k in range(101)], "g int, v int").repartition(7)
    every = {r.v: r.n for r in numbered(df, [F.desc("v")], "n").collect()}
    assert every == {v: 101 - v for v in range(101)}
    for g in range(3):
        got = sorted((r.v, r.n) for r in numbered(df, [F.col("v")], "n", ["g"]).where(F.col("g") == g).collect())
        assert [n for _, n in got] == list(range(1, len(got) + 1))


def test_unknown_threshold_method_is_an_error(spark):
    with pytest.raises(ValueError, match="unknown"):
        scoring.masked(spark.range(1), "id", "best", 0.5)
