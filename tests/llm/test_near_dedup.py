"""Near-duplicate classes against all pairs."""

import random
from collections import Counter

import numpy as np
import pytest

from groundshift.llm import near_dedup


def bag(text):
    w = (text or "").encode().split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None


def brute(rows):
    bags = {d: bag(t) for d, t, *_ in rows}
    parent = {d: d for d in bags}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(bags)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if bags[a] and bags[b]:
                both = sum((bags[a] & bags[b]).values())
                if both >= 0.8 * (sum(bags[a].values()) + sum(bags[b].values()) - both):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def test_signature_estimates_weighted_jaccard():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 2**63, 300).astype(np.uint64)
    a = rng.integers(1, 9, 300)
    b = np.where(rng.random(300) < 0.3, a + 4, a)
    sig = near_dedup.signatures(np.r_[np.zeros(300, int), np.ones(300, int)], np.r_[h, h], np.r_[a, b], 2, 8000)
    assert abs((sig[0] == sig[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.03


def test_signature_does_not_depend_on_its_batch():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 2**63, 900).astype(np.uint64)
    row = np.repeat([0, 1, 2], [1, 99, 800])
    every = near_dedup.signatures(row, h, np.ones(900, int), 3)
    for i in range(3):
        alone = near_dedup.signatures(np.zeros((row == i).sum(), int), h[row == i], np.ones((row == i).sum(), int), 1)
        assert (alone[0] == every[i]).all()


def test_classes_match_all_pairs(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for k in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(30, 160))]
        for c in range(rng.randint(1, 6)):
            w = list(base)
            for _ in range(c * rng.randint(0, 2)):
                w[rng.randrange(len(w))] = rng.choice(words)
            rows.append((len(rows) * 5 + 1, " ".join(w), "k"))
    rows += [(900, "a b c", "k"), (901, "a b c", "k"), (902, "", "k"), (903, None, "k"), (904, " ", "k"), (905, "so " * 40, "k"), (906, "so " * 44, "k"), (907, "so " * 90, "k")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, key string")
    got = {r.doc_id: r.class_id for r in near_dedup.classes(df.repartition(3)).collect()}
    assert got == brute(rows)
    kept = sorted(r.doc_id for r in near_dedup.one_of_each(df).collect())
    assert kept == sorted(d for d, c in brute(rows).items() if d == c)


def test_null_ids_repeated_rows_and_an_empty_table(spark):
    df = spark.createDataFrame([(None, "x y", "k"), (1, "x y", "k"), (1, "x y", "k")], "doc_id bigint, text string, key string")
    assert sorted(map(tuple, near_dedup.classes(df).collect()), key=str) == [(1, 1), (1, 1), (None, None)]
    assert near_dedup.classes(df.limit(0)).count() == 0


@pytest.mark.parametrize("block", [2, 1024])
def test_blocks_lose_no_link(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rng = random.Random(11)
    words = [f"w{i}" for i in range(500)]
    base = [rng.choice(words) for _ in range(120)]
    rows = []
    for k in range(60):
        w = list(base)
        for _ in range(rng.randint(1, 9)):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((k, " ".join(w), "k"))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, key string")
    assert {r.doc_id: r.class_id for r in near_dedup.classes(df).collect()} == brute(rows)


def test_a_large_key_tries_pairs_that_share_no_other_band(spark, monkeypatch):
    """All texts share one band and no other: with more of them than a block holds, no pair is lost."""

    def one_band(batches):
        import pyarrow as pa

        from groundshift.llm import near_dedup

        for b in near_dedup._signed(batches):
            keys = [None if not k else [7, *(1000 * doc + i for i in range(1, len(k)))] for doc, k in zip(b.column(0).to_pylist(), b.column(4).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(keys, pa.list_(pa.int64()))], b.schema.names)

    monkeypatch.setattr(near_dedup, "_signed", one_band)
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(500)]
    rows = []
    for _ in range(20):
        base = [rng.choice(words) for _ in range(150)]
        rows += [(len(rows), " ".join(base), "k"), (len(rows) + 1, " ".join([*base[:-1], "other"]), "k")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, key string")
    assert {r.doc_id: r.class_id for r in near_dedup.classes(docs).collect()} == brute(rows)


def test_units_give_all_links_once():
    rng = np.random.default_rng(4)
    n = 40
    shared = rng.integers(-(2**31), 2**31, 100).astype(np.int32)
    bag = [np.unique(np.r_[shared[rng.random(100) < 0.95], rng.integers(-(2**31), 2**31, 8).astype(np.int32)]) for _ in range(n)]
    want = {(i, j) for i in range(n) for j in range(i + 1, n) if len(np.intersect1d(bag[i], bag[j])) >= 0.8 * len(np.union1d(bag[i], bag[j]))}
    zeros = np.zeros((n, near_dedup.SKETCH), np.uint64)
    keys = np.arange(n * 40).reshape(n, 40)
    got = near_dedup._unit_links(np.zeros(n, int), np.zeros(n, int), np.arange(n), np.arange(n), bag, keys, zeros)
    assert set(got) == want and len(got) == len(want)
    block = np.arange(n) % 2
    got = near_dedup._unit_links(block, np.zeros(n, int), np.arange(n), np.arange(n), bag, keys, zeros)
    assert set(got) == {(i, j) for i, j in want if i % 2 != j % 2}


def test_hot_keys_lose_no_row(spark):
    rows = spark.createDataFrame([(k, d) for k, size in ((1, 3000), (2, 40), (3, 1)) for d in range(size)], "key bigint, doc bigint")
    keys = spark.createDataFrame([(1, 3000), (2, 40)], "key bigint, n bigint")
    got = near_dedup.by_key(rows, keys, 3041, "key")
    assert got.columns == ["key", "doc", "n"]
    assert sorted(map(tuple, got.collect())) == [(1, d, 3000) for d in range(3000)] + [(2, d, 40) for d in range(40)]


def test_nothing_that_grows_with_the_input_is_broadcast(spark, monkeypatch):
    """By the size of their files all of these tables are small enough; the one thing sent to all is the list of hot keys, at most a thousand."""
    from groundshift.operators import components as cc

    plans, real = [], cc.written
    tell = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    for module in (cc, near_dedup):
        monkeypatch.setattr(module, "written", lambda df: (tell(df), real(df))[1])
    rng = random.Random(5)
    base = [f"w{rng.randint(0, 300)}" for _ in range(120)]
    rows = [(k, " ".join([*base[: 10 * k], "other", *base[10 * k + 1 :]])) for k in range(10)] + [(90, "a b"), (91, "a b")]
    out = near_dedup.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string"))
    tell(out)
    assert sorted(r.doc_id for r in out.collect()) == [0, 90]
    assert len(plans) > 15 and sum(p.count("SortMergeJoin") for p in plans) > 10
    assert all(p.count("BroadcastHashJoin") <= p.count("AS hot") for p in plans)


def test_recall_on_given_documents_against_all_pairs(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: r.class_id for r in near_dedup.classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == brute(rows)


def test_a_very_long_text_and_clashing_columns(spark):
    rng = random.Random(3)
    long = " ".join(rng.choice("abcdefgh") + str(rng.randint(0, 99)) for _ in range(60_000))
    df = spark.createDataFrame([(1, long, 0, 0), (2, long + " end", 0, 0), (3, long[: len(long) // 2], 0, 0)], "doc_id bigint, text string, label int, n int")
    assert {r.doc_id: r.class_id for r in near_dedup.classes(df).collect()} == {1: 1, 2: 1, 3: 3}
    assert near_dedup.one_of_each(df).columns == df.columns
