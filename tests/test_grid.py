"""The grid of cells and epochs against plain Python, and the Spark form of the pixels against the adapter's text."""

import datetime as dt
import random

from pyspark.sql import functions as F

from groundshift.operators.series import full_grid
from groundshift.sources.tables import ADAPTERS, pixels


def test_grid_has_every_epoch_once_and_collects_nothing(spark):
    rng = random.Random(2)
    seen = {(r, c, e): (rng.random(), None if rng.random() < 0.2 else e) for r in range(9) for c in range(7) for e in range(2010, 2022) if rng.random() < 0.25}
    df = spark.createDataFrame([(*k, *v) for k, v in seen.items()], "r int, c int, epoch int, a double, b int")
    for epochs in ([], [2015], [2012, 2013, 2016, 2019], list(range(2008, 2024))):
        got = full_grid(df, epochs)
        want = sorted((r, c, e, k, *seen.get((r, c, e), (None, None))) for r, c in {x[:2] for x in seen} for k, e in enumerate(epochs))
        assert sorted(map(tuple, got.collect()), key=lambda x: x[:4]) == want
    assert got.columns == ["r", "c", "epoch", "k", "a", "b"]
    plan = full_grid(df, epochs)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_pixels_equal_the_text(spark):
    rng = random.Random(7)
    odd = [0.49999999999999994, 0.5, 2.5, -2.5, -0.5, 1.005, 28.499999999999996, 4503599627370497.5, 1e16, -7.0, 0.285, 1e-300]
    lines = [(p, rng.randrange(99), rng.choice([dt.date(1995, 3, 1), dt.date(1998, 1, 1), None]), *(rng.choice(odd[:7] + odd[9:] + [rng.uniform(-5, 90), None]) for _ in range(4))) for p in [*range(0, 160, 3)] * 6]
    lines += [(1000 + i, 5, dt.date(1996, 1, 1), 1.0, x, 0.1, 0.2) for i, x in enumerate(odd[:7] + odd[9:])]
    df = spark.createDataFrame(lines, "l_partkey bigint, l_suppkey bigint, l_shipdate date, l_quantity double, l_extendedprice double, l_tax double, l_discount double")
    want = spark.sql(ADAPTERS["pixels"].replace("FROM lineitem", "FROM {lineitem}"), lineitem=df)
    got = pixels(df)
    assert got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    one = spark.createDataFrame([(x,) for x in odd + [None]], "x double")
    from groundshift.sources.tables import _whole
    assert not [r for r in one.select("x", _whole(F.col("x")).alias("a"), F.round("x").cast("bigint").alias("b")).collect() if r.a != r.b]


def test_cell_types_have_their_grid_made_once(spark, sf_dir):
    """Shifts, events and types read one written grid; none of them goes back to the lines."""
    from groundshift.plans.composite import _types

    assert not [f for f in _types(spark, sf_dir).inputFiles() if "lineitem" in f]
