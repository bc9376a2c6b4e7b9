"""Exact quantiles, greedy suppression, permutation tests and cell statistics against plain Python."""

import hashlib
import random

import numpy as np
import pytest

from groundshift.operators import permutations as pm
from groundshift.operators import raster, selection


@pytest.mark.parametrize("few", [3, 10_000])
def test_quantiles_equal_numpy(spark, monkeypatch, few):
    monkeypatch.setattr(selection, "FEW", few)
    monkeypatch.setattr(selection, "BINS", 5)
    rng = random.Random(2)
    rows = [(g, rng.choice([rng.gauss(0, 1e3), 7.0, -7.0, float("nan"), None])) for g in ("a", "b", None) for _ in range(150)] + [("one", 3.5), ("none", None), ("same", 2.0), ("same", 2.0), ("big", 1e300), ("big", -1e300), ("big", 0.0)]
    shares = [0.0, 0.005, 0.25, 0.5, 0.99, 1.0]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r.g, r.p): (r.n, r.value) for r in selection.quantiles(df, ["g"], shares).collect()}
    groups = {}
    for g, v in rows:
        if v is not None and v == v:
            groups.setdefault(g, []).append(v)
    assert {g for g, _ in got} == set(groups)
    for g, v in groups.items():
        for p in shares:
            assert got[g, p][0] == len(v) and got[g, p][1] == pytest.approx(float(np.quantile(v, p)), rel=1e-12, abs=1e-9)
    assert selection.quantiles(df.drop("g"), [], [0.5]).first().n == sum(map(len, groups.values()))
    assert selection.quantiles(df.limit(0), ["g"], [0.5]).count() == 0


def test_suppression_equals_the_loop(spark):
    rng = random.Random(4)
    rows = []
    for g in range(3):
        for rank in range(120):
            x, y, side = rng.uniform(0, 100), rng.uniform(0, 100), rng.choice([8, 20, 30])
            rows.append((g * 1000 + rng.randrange(10**6) * 10**4 + rank, g, rank, x, y, x + side, y + side))
    want = set()
    for g in range(3):
        kept = []
        for key, _, _, x0, y0, x1, y1 in sorted((r for r in rows if r[1] == g), key=lambda r: r[2]):
            over = lambda k: max(0, min(x1, k[2]) - max(x0, k[0])) * max(0, min(y1, k[3]) - max(y0, k[1])) / ((x1 - x0) * (y1 - y0))  # noqa: B023, E731
            if not any(over(k) >= 0.5 for k in kept):
                kept.append((x0, y0, x1, y1))
                want.add(key)
    df = spark.createDataFrame(rows, "id bigint, g int, rank int, x0 double, y0 double, x1 double, y1 double")
    assert {r.id for r in selection.suppressed(df, "id", "g", "rank").collect()} == want
    assert selection.suppressed(df.limit(0), "id", "g", "rank").count() == 0


def plain_places(ids):
    return {i: k for k, i in enumerate(sorted(ids, key=lambda i: (hashlib.sha256(str(i).encode()).hexdigest(), i)))}


@pytest.mark.parametrize("few", [0, 10**6])
def test_permutations_equal_plain_python(spark, monkeypatch, few):
    monkeypatch.setattr(pm, "BROADCAST", few)
    rng = random.Random(1)
    n, k, perms = 31, 4, 19
    v = {i: rng.gauss(0, 1) + (i // 8) for i in range(n)}
    near = {i: sorted(set(range(n)) - {i}, key=lambda j: (abs(i - j), j))[:k] for i in range(n)}
    points = spark.createDataFrame(list(v.items()), "id bigint, v double")
    edges = spark.createDataFrame([(i, j, r + 1) for i, js in near.items() for r, j in enumerate(js)], "id bigint, other bigint, rank int")
    place = plain_places(v)
    at = {p: v[i] - sum(v.values()) / n for i, p in place.items()}
    stat = lambda a, b: sum(at[(place[i] * a + b) % n] * sum(at[(place[j] * a + b) % n] for j in near[i]) / k for i in v) / sum(x * x for x in at.values())
    moran, sims = stat(1, 0), [stat(a, b) for a, b in pm.multipliers(n, perms, 7)]
    above = sum(x >= moran for x in sims)
    got = pm.morans_i(points, edges, "v", permutations=perms, seed=7).first()
    assert got.moran_i == pytest.approx(moran) and got.p_sim == pytest.approx((min(above, perms - above) + 1) / (perms + 1))
    assert got.z_sim == pytest.approx((moran - np.mean(sims)) / np.std(sims))
    raw = {p: v[i] for i, p in place.items()}
    for r in pm.getis_ord(points, edges, "v", permutations=perms, seed=7).collect():
        own = sum(v[j] for j in near[r.id])
        draws = [[(place[r.id] + 1 + (m * a + b + place[r.id] * 7) % (n - 1)) % n for m in range(1, k + 1)] for a, b in pm.multipliers(n - 1, perms, 7)]
        assert all(len(set(d)) == k and place[r.id] not in d for d in draws)
        assert r.above == sum(round(sum(raw[x] for x in d), 9) >= round(own, 9) for d in draws)


def test_clusters_are_significant_and_few_points_are_null(spark):
    points = spark.createDataFrame([(i, float(i // 200)) for i in range(600)], "id bigint, v double")
    edges = spark.createDataFrame([(i, j, 1) for i in range(600) for j in (i - 1, i + 1) if 0 <= j < 600], "id bigint, other bigint, rank int")
    assert pm.morans_i(points, edges, "v", permutations=99).first().p_sim == pytest.approx(0.01)
    few = pm.morans_i(points.limit(1), edges, "v", permutations=9).first()
    assert few.moran_i is None and few.p_sim is None
    assert {r.p_sim for r in pm.getis_ord(points.limit(2), edges, "v", permutations=9).collect()} == {None}


def test_offset_of_two_dates(spark):
    rng = np.random.default_rng(3)
    wide = rng.normal(size=(40, 40))
    smooth = sum(np.roll(np.roll(wide, i, 0), j, 1) for i in (-1, 0, 1) for j in (-1, 0, 1))
    rows = [(1, r, c, float(smooth[r, c]), float(smooth[r - 1, c + 1])) for r in range(2, 38) for c in range(2, 38)]
    rows += [(2, r, c, float(wide[r, c]), float(wide[r - 2, c])) for r in range(2, 38) for c in range(2, 38)]
    got = {x.k: x for x in raster.offsets(spark.createDataFrame(rows, "k int, r int, c int, v double, w double"), 10.0).collect()}
    assert abs(got[1].dy - 1) < 0.1 and abs(got[1].dx + 1) < 0.1 and got[1].quality > 0.99 and abs(got[1].displacement - 14.14) < 1
    assert got[2].dy is None and got[2].displacement is None


def test_permutations_do_not_depend_on_blocks_and_groups(spark, monkeypatch):
    points = spark.createDataFrame([(i, float(i * 37 % 41)) for i in range(60)], "id int, v double")
    edges = spark.createDataFrame([(i, (i + d) % 60, d) for i in range(60) for d in (1, 2, 3)], "id int, other int, rank int")

    def told():
        m = pm.morans_i(points, edges, "v", permutations=29, seed=3).first()
        return m.n, round(m.moran_i, 9), m.p_sim, round(m.z_sim, 9), sorted((r.id, r.above) for r in pm.getis_ord(points, edges, "v", permutations=29, seed=3).collect())

    one = told()
    for name, value in (("VALUES", 7), ("ROWS", 3), ("GROUPS", 5)):
        monkeypatch.setattr(pm, name, value)
    assert told() == one
