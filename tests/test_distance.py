"""Distances of cells to reference cells against all pairs."""

import random

from pyspark.sql import functions as F

from groundshift.operators.distance import distance_transform
from groundshift.operators.quarry import related


def test_equals_all_pairs(spark):
    rng = random.Random(3)
    for n in (1, 2, 9, 60):
        cells = {(rng.randrange(-5, 40), rng.randrange(-30, 60)) for _ in range(400)}
        ref = {(rng.randrange(-9, 45), rng.randrange(-40, 70)) for _ in range(n)}
        got = distance_transform(spark.createDataFrame(list(cells) * 2, "r int, c int"), spark.createDataFrame(list(ref), "r int, c int")).collect()
        assert {(x.r, x.c): x.d2 for x in got} == {(r, c): min((r - a) ** 2 + (c - b) ** 2 for a, b in ref) for r, c in cells}
        assert len(got) == len(cells)


def test_without_reference_or_cells(spark):
    cells = spark.createDataFrame([(1, 2), (3, 4)], "r int, c int")
    assert {x.d2 for x in distance_transform(cells, cells.limit(0)).collect()} == {None}
    assert distance_transform(cells.limit(0), cells).count() == 0


def test_components_are_connected_by_size_and_distance(spark):
    exposed = [(0, 0), (1, 1), (2, 2), (0, 9), (0, 10), (9, 0), (9, 1), (9, 2)]
    cells = spark.createDataFrame([(r, c, (r, c) in exposed) for r in range(10) for c in range(12)], "r int, c int, e boolean")
    ref = spark.createDataFrame([(4, 4), (0, 11)], "r int, c int")
    got = {(x.r, x.c): x for x in related(cells, F.col("e"), ref, 10.0, adjacency=30.0, least=3).collect()}
    assert {k for k, x in got.items() if x.connected} == {(0, 0), (1, 1), (2, 2)}
    assert got[4, 4].inside and got[4, 4].distance == 0 and got[2, 2].comp == 0 and got[5, 5].comp is None
