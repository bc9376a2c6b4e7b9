"""Product codes against plain Python and their SQL, on odd rows."""

import hashlib
import math

import duckdb
import numpy as np
import pytest

from groundshift.llm import vector_codes


def plain(rows, parts=8, entries=16, rounds=6):
    kept = [(i, label, [math.floor(4096 * np.float32(x).item()) for x in v]) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    w = max(1, -(-max(len(v) for _, _, v in kept) // parts))
    kept = [(i, label, v + [0] * (parts * w - len(v))) for i, label, v in kept]
    cut = lambda v, p: v[p * w : p * w + w]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    book = [[cut(v, p) for _, _, v in first] for p in range(parts)]

    def near(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(v, e, strict=True)), k) for k, e in enumerate(book[p]))

    for _ in range(rounds):
        own = [[[cut(v, p) for _, _, v in kept if near(cut(v, p), p)[1] == k] for k in range(len(first))] for p in range(parts)]
        book = [[[sum(c) // len(members) for c in zip(*members, strict=True)] if members else book[p][k] for k, members in enumerate(own[p])] for p in range(parts)]
    sha = hashlib.sha256(",".join(str(x) for part in book for e in part for x in e).encode()).hexdigest()
    out = []
    for i, label, v in kept:
        found = [near(cut(v, p), p) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
    return [(i, code, e, sum(x[2] for x in out if x[3] == label), sha) for i, code, e, label in out]


def rows(n=150, dims=16, seed=4, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(int(i) * 3 % (2 * n), [float(x) for x in rng.normal(size=dims).astype(np.float32) * spread], None if i % 7 == 0 else int(i % 4)) for i in range(n)]


ODD = [(900, None, 1), (901, [0.5, None] * 8, 1), (902, [float("nan")] * 16, 1), (903, [float("-inf")] + [0.0] * 15, 1), (None, [0.25] * 16, 2), (905, [0.1] * 5, 2), (906, [], None), (907, [0.1] * 16, 2), (907, [0.1] * 16, 2), (0, [-0.3] * 16, 1)]


def frame(spark, data):
    return spark.createDataFrame([(*r, "c") for r in data], "vec_id bigint, embedding array<float>, label int, code string")


def told(df):
    return sorted((tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


@pytest.mark.parametrize("data", [rows() + ODD, rows(9) + ODD, rows(40, 19), ODD, rows(60, spread=0.0)], ids=["many", "few", "padded", "odd", "equal"])
def test_equals_plain_python(spark, data):
    assert told(vector_codes.compressed(frame(spark, data))) == sorted(plain(data), key=str)


def test_salted_label_sums(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", 0)
    data = rows(50)
    assert told(vector_codes.compressed(frame(spark, data))) == sorted(plain(data), key=str)


def test_equals_sql(spark):
    data = [r for i, r in enumerate(rows(200))]
    df = frame(spark, data)
    c = duckdb.connect()
    embeddings = df.select("vec_id", "embedding", "label").toPandas()
    embeddings["label"] = embeddings["label"].astype("Int64")
    c.register("embeddings", embeddings.drop_duplicates("vec_id"))
    q = c.execute(vector_codes.SQL)
    names = [d[0] for d in q.description]
    want = sorted((tuple(dict(zip(names, r, strict=True))[k] for k in ("vec_id", "code", "error", "label_error", "codebooks_sha256")) for r in q.fetchall()), key=str)
    assert told(vector_codes.compressed(df.dropDuplicates(["vec_id"]))) == want


def test_nothing_to_code(spark):
    assert vector_codes.compressed(frame(spark, ODD).limit(0)).count() == 0
    assert vector_codes.compressed(frame(spark, [(1, None, 1)])).count() == 0


def test_bounds_leave_out_distances_but_no_nearest_entry():
    rng = np.random.default_rng(8)
    entries = rng.integers(-20_000, 20_000, (16, 8))
    x = entries[rng.integers(0, 16, 3000)] + rng.integers(-1500, 1500, (3000, 8))
    x[:50] = entries[3]
    pivots = entries[vector_codes.pivots_of(entries[None])[0]]
    far = np.sqrt(((x[:, None] - pivots[None]) ** 2).sum(2).astype(float)).astype(np.float32)
    gap = np.sqrt(((pivots[:, None] - entries[None]) ** 2).sum(2).astype(float))
    code, d, evaluated = vector_codes.nearest(x, far, entries, gap)
    every = ((x[:, None] - entries[None]) ** 2).sum(2)
    assert (code == every.argmin(1)).all() and (d == every.min(1)).all()
    assert evaluated.mean() < 8
