"""Polygons: areas, overlays and distances of small shapes whose results are known, and of random ones against a fine lattice."""

import math
import random

import pytest
from pyspark.sql import functions as F

from groundshift.operators import polygons as pg

SQUARE = [(0, 0), (20, 0), (20, 20), (0, 20)]


def points(spark, shapes, key="k"):
    rows = [(k, ring, i, float(x), float(y)) for k, rings in shapes.items() for ring, corners in enumerate(rings) for i, (x, y) in enumerate(corners)]
    return spark.createDataFrame(rows, f"{key} bigint, ring int, i int, x double, y double")


def shapes(spark, given, key="k", size=10.0):
    return pg.Shapes(points(spark, given, key), key, size)


def inside(x, y, rings):
    """Even-odd rule."""
    return sum(1 for r in rings for (xa, ya), (xb, yb) in zip(r, r[1:] + r[:1], strict=True) if (ya > y) != (yb > y) and x < xa + (y - ya) / (yb - ya) * (xb - xa)) % 2 == 1


def star(rng, x, y, n=7, wide=25):
    turn = sorted(rng.random() * 2 * math.pi for _ in range(n))
    return [(x + d * math.cos(t), y + d * math.sin(t)) for t in turn for d in [rng.uniform(0.3, 1) * wide]]


def test_areas_of_known_shapes(spark):
    given = {1: [SQUARE], 2: [SQUARE[::-1], [(5, 5), (15, 5), (15, 15), (5, 15)]], 3: [[(0, 0), (30, 0), (0, 30)]], 4: [[(3, 3), (7, 3)]], 5: [[(-15, -15), (-5, -15), (-5, -5), (-15, -5)]]}
    s = shapes(spark, given)
    got = {r.k: r.a for r in s.cover.groupBy("k").agg(F.sum("area").alias("a")).collect()}
    assert got == pytest.approx({1: 400, 2: 300, 3: 450, 5: 100})
    cells = {(r.r, r.c): r.area for r in s.cover.where("k = 3").collect()}
    assert cells == pytest.approx({(0, 0): 100, (0, 1): 100, (1, 0): 100, (0, 2): 50, (1, 1): 50, (2, 0): 50})
    m = {r.k: (r.area, r.x, r.y) for r in pg.measures(s.points, "k").collect()}
    assert m[2] == pytest.approx((300, 10, 10)) and m[3] == pytest.approx((450, 10, 10))


def test_interior_cells_need_no_edges(spark):
    s = shapes(spark, {1: [[(0.5, 0.25), (399.5, 3), (396, 398), (2, 391)]]})
    exact = pg.measures(s.points, "k").first().area
    assert s.cover.agg(F.sum("area")).first()[0] == pytest.approx(exact, rel=1e-12)
    assert s.cover.where("area > 99.999999").count() > 1300


def test_random_overlays_against_a_lattice(spark):
    rng = random.Random(5)
    a = {i: [star(rng, rng.uniform(0, 90), rng.uniform(0, 90))] for i in range(12)}
    b = {i: [star(rng, rng.uniform(0, 90), rng.uniform(0, 90))] for i in range(9)}
    sa, sb = shapes(spark, a), shapes(spark, b, "j")
    step = 0.5
    lattice = [(x * step + 0.21, y * step + 0.17) for x in range(-60, 240) for y in range(-60, 240)]
    of_a = {k: {p for p in lattice if inside(*p, r)} for k, r in a.items()}
    of_b = {k: {p for p in lattice if inside(*p, r)} for k, r in b.items()}
    any_b = set().union(*of_b.values())
    near = lambda n, area: abs(n * step * step - area) < 12
    for r in pg.overlaid(sa, sb).groupBy("k").agg(F.sum("area").alias("area"), F.sum("both").alias("both")).collect():
        assert near(len(of_a[r.k]), r.area) and near(len(of_a[r.k] & any_b), r.both)
    pairs = {(r.k, r.j): r.overlap for r in pg.overlaps(sa, sb).collect()}
    for k in a:
        for j in b:
            assert near(len(of_a[k] & of_b[j]), pairs.get((k, j), 0.0))
    group = spark.createDataFrame([(i, i % 2) for i in a], "k bigint, g int")
    for r in pg.union_area(sa, group, "g").collect():
        assert near(len(set().union(*(of_a[k] for k in a if k % 2 == r.g))), r.area_union)


def test_equal_shapes_count_once(spark):
    s = shapes(spark, {i: [[(1, 2), (17, 4), (12, 19)]] for i in range(5)})
    group = spark.createDataFrame([(i, 1) for i in range(5)], "k bigint, g int")
    r = pg.union_area(s, group, "g").first()
    assert r.area_sum == pytest.approx(5 * r.area_union)
    assert pg.overlaid(s, s.renamed("j")).agg(F.sum("area") - F.sum("both")).first()[0] == pytest.approx(0, abs=1e-6)


def test_distances(spark):
    a = {1: [SQUARE], 2: [[(4, 4), (6, 4), (6, 6), (4, 6)]], 3: [[(200, 0), (210, 3), (203, 9)]], 4: [SQUARE, [(1, 1), (19, 1), (19, 19), (1, 19)]]}
    b = {1: [[(23, 0), (30, 0), (30, 10)]], 2: [[(8, 8), (9, 8), (9, 9)]]}
    got = {(r.k, r.j): r.distance for r in pg.touching(shapes(spark, a), shapes(spark, b, "j"), 5.0).collect()}
    assert got == pytest.approx({(1, 1): 3, (1, 2): 0, (2, 2): math.hypot(2, 2), (4, 1): 3})
    own = pg.sides(points(spark, a), "k").drop("ring")
    other = pg.sides(points(spark, b, "j"), "j").select("j", F.col("xa").alias("pa"), F.col("ya").alias("qa"), F.col("xb").alias("pb"), F.col("yb").alias("qb"))
    far = {r.k: (r.distance, r.j) for r in pg.nearest_side(own, other, "k", ["j"], reach=2.0).collect()}
    assert far[3] == pytest.approx((170, 1)) and far[1] == pytest.approx((3, 1)) and far[2] == pytest.approx((math.hypot(2, 2), 2))
    assert {r.distance for r in pg.nearest_side(own, other.limit(0), "k", ["j"]).collect()} == {None}


def test_nearest_sides_far_away_are_not_all_measured(spark, monkeypatch):
    """Squares in a long column and a short row of sides at its foot: what is measured grows with the squares, not with squares times sides times rounds."""
    rng = random.Random(8)
    a = {k: [[(x + rng.uniform(0, 60), y + 400 * k) for x, y in SQUARE]] for k in range(60)}
    b = spark.createDataFrame([(i, 3.0 * i, -10.0 * i, 3.0 * i + 2, -10.0 * i - 1) for i in range(50)], "j int, pa double, qa double, pb double, qb double")
    own, measured, real = pg.sides(points(spark, a), "k").drop("ring"), spark.sparkContext.accumulator(0), pg.side_distance
    counted = F.udf(lambda d: (measured.add(1), d)[1], "double")
    exact = own.crossJoin(b).withColumn("distance", real()).groupBy("k").agg(F.min(F.struct("distance", "j")).alias("m")).select("k", "m.*")
    want = {tuple(r) for r in exact.collect()}
    monkeypatch.setattr(pg, "side_distance", lambda: counted(real()))
    assert {tuple(r) for r in pg.nearest_side(own, b, "k", ["j"], reach=4.0).collect()} == want
    assert measured.value <= 8 * len(a)


def test_distances_made_column_by_column_are_those_of_one_expression(spark):
    """Crossing, touching, parallel and upright sides, and sides without length; what a pair is told is equal to the last bit, and the plan holds no expression with parts repeated in each other."""
    rng = random.Random(12)
    side = lambda: [rng.choice((0.0, 1.0, rng.uniform(-9, 9))) for _ in range(4)]
    pairs = spark.createDataFrame([(k, *side(), *side()) for k in range(400)], "k int, xa double, ya double, xb double, yb double, pa double, qa double, pb double, qb double")
    got = pg.measured(pairs)
    assert got.columns == [*pairs.columns, "distance"]
    assert {r.k: r.distance for r in got.collect()} == {r.k: r.d for r in pairs.withColumn("d", pg.side_distance()).collect()}
    near = pg.near_sides(pairs.select("k", "xa", "ya", "xb", "yb"), pairs.select(F.col("k").alias("j"), "pa", "qa", "pb", "qb"), 2.0, ["k", "j"])
    plan = near._jdf.queryExecution().optimizedPlan().toString()
    assert max(map(len, plan.splitlines())) < 5000


def test_random_nearest_sides(spark):
    rng = random.Random(3)
    place = lambda: (rng.choice((-3000, 0, 700)) + rng.uniform(-60, 60), rng.choice((-900, 0, 5000)) + rng.uniform(-60, 60))
    own = pg.sides(points(spark, {k: [star(rng, *place())] for k in range(40)}), "k").drop("ring")
    other = pg.sides(points(spark, {k: [star(rng, *place(), wide=400 if k < 2 else 9)] for k in range(25)}, "j"), "j").select("j", F.col("xa").alias("pa"), F.col("ya").alias("qa"), F.col("xb").alias("pb"), F.col("yb").alias("qb"))
    want = {r.k: r.d for r in own.crossJoin(other).withColumn("d", pg.side_distance()).groupBy("k").agg(F.min("d").alias("d")).collect()}
    for reach in (1.0, 64.0, 100000.0):
        assert {r.k: r.distance for r in pg.nearest_side(own, other, "k", ["j"], reach).collect()} == pytest.approx(want)


def test_empty_layers(spark):
    s, none = shapes(spark, {1: [SQUARE]}), shapes(spark, {9: [[(0, 0)]]}, "j")
    assert none.cover.count() == 0
    assert pg.overlaid(s, none).agg(F.sum("both")).first()[0] == 0
    assert pg.overlaps(s, none).count() == 0 and pg.touching(s, none, 9.0).count() == 0


def test_corners_meet_the_polygons_of_their_cell_only(spark):
    """A hundred squares one above another share their columns: a corner meets its own square, not all of them."""
    many = {k: [[(x + 3, y + 40 * k + 3) for x, y in SQUARE]] for k in range(100)}
    b = shapes(spark, many, "j")
    corners = spark.createDataFrame([(k, 13.0, 40.0 * k + (13 if k % 2 else 33)) for k in range(100)], "k bigint, x double, y double")
    assert pg.covering(corners, b).count() == 50
    assert {tuple(r) for r in pg.corners_inside(corners, "k", b).collect()} == {(k, k) for k in range(1, 100, 2)}


def test_overlap_that_rounds_to_nothing_names_no_site(spark, tmp_path):
    """Slivers of less than half a digit: the SQL has no site and no score for them."""
    import duckdb

    from groundshift.queries import oracle_sql, queries

    c = duckdb.connect()
    for table, key, ids in (("customer", "c_custkey", (1591, 3440, 10186)), ("supplier", "s_suppkey", (100, 239, 678, 679))):
        c.execute(f"COPY (SELECT CAST(unnest({list(ids)}) AS BIGINT) AS {key}) TO '{tmp_path}/{table}.parquet'")
        c.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet'")
    got = queries()["J12_shape_overlay"](spark, str(tmp_path))
    want = c.execute(f"SELECT {', '.join(got.columns)} FROM ({oracle_sql()['J12_shape_overlay']}) ORDER BY bld_id").fetchall()
    assert [tuple(r) for r in got.orderBy("bld_id").collect()] == want
    assert want[0][3:5] == (None, None)


def test_cells_are_swept_in_tasks_that_grow_in_number(spark, monkeypatch):
    """Twice the pieces, twice the tasks; each cell is swept in one of them and its areas are those of a single task."""
    rng = random.Random(6)
    places = [(rng.uniform(0, 300), rng.uniform(0, 300)) for _ in range(60)]
    s = shapes(spark, {k: [star(rng, x, y)] for k, (x, y) in enumerate(places)})
    few = {k: [star(rng, x, y, wide=9)] for k, (x, y) in enumerate(places[:9])}
    cells = s.cover.select("r", "c").distinct().crossJoin(s.cover.select("k").distinct())
    piece = s.cutting(cells, [], 0).union(shapes(spark, few).cutting(cells, [], 1))
    n = piece.count()
    areas = lambda d: {(r.r, r.c): pytest.approx((r.a, r.b, r.both, r.either)) for r in d.collect()}
    monkeypatch.setattr(pg, "TASK_PIECES", 10 * n)
    once = pg.swept(piece, [])
    monkeypatch.setattr(pg, "TASK_PIECES", n // 40)
    dealt = pg.swept(piece, [])
    assert once.rdd.getNumPartitions() == 1 and dealt.rdd.getNumPartitions() >= 40
    assert {(r.r, r.c): (r.a, r.b, r.both, r.either) for r in dealt.collect()} == areas(once)
