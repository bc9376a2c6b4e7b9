"""Substring operators against brute force, with nulls, empty and repeated rows, long words and very repetitive texts."""

import hashlib
import random
import tracemalloc
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest

from groundshift.llm import fm_dedup, repeats, shared, suffix_dedup

SCHEMA = "doc_id bigint, text string, doc string, lo string, spans string"
#: Units that make every bound bite on a small corpus.
TIGHT = dict(flush=40, piece=500, fetch=1500, bucket=16)


def corpus():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, other = prose(60), prose(45)
    texts = [prose(80) + " " + passage + " " + prose(rng.randint(0, 40)) for _ in range(8)]
    texts += [passage, passage + other, other + "\n" + passage, "a" * 700, "ab" * 300, "a" * 350 + "b", "", None, prose(3), " \t\n", texts[0], texts[0], (other + " ") * 4]
    texts += [texts[1][: 50 + 7 * i] + " x " + texts[1][55 + 7 * i :] for i in range(6)]
    texts += [" ".join(["so"] * 90), " ".join(["so", "it"] * 40) + " end", prose(700), passage + " " + prose(500) + " " + other]
    return [(i * 3, t, "x", "y", "z") for i, t in enumerate(texts)]


def repeated(rows, units, width):
    """For each row which units stay."""
    seen, out = set(), {}
    for row in sorted(rows, key=lambda r: r[0]):
        u = units(row[1] or "")
        gone = [False] * len(u)
        for i in range(len(u) - width + 1):
            w = tuple(u[i : i + width])
            if w in seen:
                gone[i : i + width] = [True] * width
            seen.add(w)
        out[row[0]] = (u, gone)
    return out


@pytest.mark.parametrize("bounds", [{}, TIGHT])
def test_bytes(spark, bounds):
    rows = corpus()
    got = {r.doc_id: r for r in suffix_dedup.digest(spark.createDataFrame(rows, SCHEMA).repartition(3), replace(suffix_dedup.BYTES, **bounds)).collect()}
    assert len(got) == len(rows)
    for doc, (u, gone) in repeated(rows, lambda t: list(t.encode()), 100).items():
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(x for x, g in zip(u, gone, strict=True) if not g)
        x = got[doc]
        assert (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) == (len(u), sum(gone), runs, hashlib.sha256(kept).hexdigest()), doc


@pytest.mark.parametrize("bounds", [{}, TIGHT])
def test_words(spark, bounds):
    rows = corpus()
    got = {r.doc_id: r for r in fm_dedup.digest(spark.createDataFrame(rows, SCHEMA).repartition(3), replace(fm_dedup.WORDS, **bounds)).collect()}
    assert len(got) == len(rows)
    for doc, (u, gone) in repeated(rows, lambda t: t.encode().split(), 20).items():
        kept = b" ".join(x for x, g in zip(u, gone, strict=True) if not g)
        x = got[doc]
        assert (x.n_words, x.n_removed, x.kept_sha256) == (len(u), sum(gone), hashlib.sha256(kept).hexdigest()), doc


@pytest.mark.parametrize("operator", [suffix_dedup, fm_dedup])
def test_no_window_is_settled_by_a_hash(monkeypatch, operator):
    """With hashes that are all equal, a bucket's verdicts stay right: the index or the array decides every window by its tokens."""
    unit = suffix_dedup.BYTES if operator is suffix_dedup else fm_dedup.WORDS
    tokens = (lambda t: list(t.encode())) if operator is suffix_dedup else (lambda t: t.encode().split())
    rows = [r for r in corpus() if r[1]]
    table = pa.table({"doc": pa.array([r[0] for r in rows]), "text": pa.array([r[1] for r in rows])})
    places = [[{"lo": i, "n": 0, "off": 0} for i in range(0, len(tokens(r[1])) - unit.window + 1)] for r in rows]
    table = table.append_column("runs", pa.array(places, pa.list_(pa.struct([("lo", pa.int32()), ("n", pa.int32()), ("off", pa.int32())]))))
    whole = [b for x in table.to_batches() for b in repeats._fetch(unit)(iter([x]))]
    monkeypatch.setattr(repeats.Rolling, "spans", lambda self, start, end: np.zeros(len(start), np.uint64))
    with_equal_hashes = [b for x in table.to_batches() for b in repeats._fetch(unit)(iter([x]))] if operator is suffix_dedup else whole
    got = {}
    for b in repeats.compared(unit, operator.kernel(unit), pa.Table.from_batches(with_equal_hashes), 1):
        for doc, lo, hi in zip(*(b.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
            if doc is not None:
                got.setdefault(doc, set()).update(range(lo, hi))
    want = {d: {i for i, g in enumerate(gone) if g} for d, (_, gone) in repeated(rows, tokens, unit.window).items()}
    assert {d: x for d, x in want.items() if x} == got


def test_index_gives_matching_statistics_and_places():
    rng = np.random.default_rng(2)
    text = np.r_[rng.integers(1, 4, 400), 0]
    index = fm_dedup.FMIndex(text)
    order = [len(text), *sorted(range(len(text)), key=lambda i: text[i:].tolist())]
    assert index.locate(np.arange(len(order))).tolist() == order and len(index.places) <= len(text) // fm_dedup.STEP + 1
    start = np.arange(380)
    far, lo, hi = index.search(text, start, 20)
    flat = bytes(text.tolist())
    for p in start.tolist():
        k = 0
        while k < 20 and sum(flat.startswith(flat[p + 19 - k : p + 20], q) for q in range(len(flat))) > 1:
            k += 1
        assert far[p] == k
        want = [q for q in range(len(flat)) if flat.startswith(flat[p + 20 - k : p + 20], q)]
        assert sorted(order[lo[p] : hi[p]]) == want


def test_a_long_document_in_pieces(spark):
    rng = random.Random(5)
    t = "".join(rng.choice("abcdefgh ") for _ in range(4000))
    rows = [(1, t, "", "", ""), (2, "zz" + t + "zz", "", "", "")]
    got = {r.doc_id: r.n_removed for r in suffix_dedup.digest(spark.createDataFrame(rows, SCHEMA), replace(suffix_dedup.BYTES, piece=500)).collect()}
    assert got == {1: 0, 2: 4000}


def test_one_very_long_text(spark):
    t = "the same again and " * 120_000  # 2.3 MB of one period
    got = {r.doc_id: r for r in suffix_dedup.digest(spark.createDataFrame([(1, t, "", "", ""), (2, "x", "", "", "")], SCHEMA)).collect()}
    assert (got[1].n_removed, got[1].n_spans, got[2].n_removed) == (len(t) - 19, 1, 0)
    words = {r.doc_id: r.n_removed for r in fm_dedup.digest(spark.createDataFrame([(1, t, "", "", "")], SCHEMA)).collect()}
    assert words == {1: 480_000 - 4}


def test_repeated_rows_null_ids_and_an_empty_table(spark):
    t = "one two three four five " * 3 + "x" * 120
    df = spark.createDataFrame([(1, t, "", "", ""), (1, t, "", "", ""), (None, t, "", "", ""), (2, None, "", "", "")], SCHEMA)
    n = len(t)
    got = sorted(((r.doc_id, r.n_removed) for r in suffix_dedup.digest(df).collect()), key=str)
    inside = repeated([(0, t)], lambda x: list(x.encode()), 100)[0][1]
    assert got == sorted([(1, n), (1, n), (None, sum(inside)), (2, 0)], key=str)
    for f in (suffix_dedup.digest, fm_dedup.digest, suffix_dedup.remove_repeats):
        assert f(df.limit(0)).count() == 0


def test_remove_repeats_keeps_columns_and_nulls(spark):
    t = "é" * 50 + "ab" + "ü" * 60
    df = spark.createDataFrame([(1, t, "p", "q", "r"), (2, "a" + t, "p", "q", "r"), (3, None, "p", "q", "r")], SCHEMA)
    out = suffix_dedup.remove_repeats(df)
    assert out.columns == df.columns
    kept = {d: bytes(x for x, g in zip(u, gone, strict=True) if not g).decode(errors="ignore") for d, (u, gone) in repeated([(1, t), (2, "a" + t)], lambda x: list(x.encode()), 100).items()}
    assert {r.doc_id: r.text for r in out.collect()} == {**kept, 3: None}


def bucket(unit, n, seed=5):
    """A bucket of n texts around anchors, as it comes from _fetch; a third of them are copies."""
    rng = np.random.default_rng(seed)
    further = rng.integers(0, 31, n)
    off = rng.integers(0, 20, n) if not unit.words else rng.integers(0, 5, n)
    common = rng.integers(97, 123, unit.window + 64)
    texts = [np.r_[common[:40], rng.integers(97, 123, unit.window + x - 40)] if unit.window > 40 else rng.integers(97, 123, unit.window + x) for x in further]
    for i in range(2, n, 3):
        texts[i], further[i], off[i] = texts[i - 2], further[i - 2], off[i - 2]
    kind = np.uint64 if unit.words else np.uint8
    lead = [np.array([t[o + k] for t, o in zip(texts, off, strict=True)], np.int64) % 2 for k in (0, 1)]
    body = pa.array([t.astype(kind).tobytes() for t in texts], pa.binary())
    ints = lambda x: pa.array(x, pa.int32())
    return pa.table([pa.array(lead[0]), pa.array(lead[1]), pa.array(np.arange(n), pa.int64()), ints(np.full(n, 7)), ints(further), ints(off), body, pa.nulls(n, pa.binary())], names=["t0", "t1", "doc", "lo", "n", "off", "body", "more"])


@pytest.mark.parametrize(("unit", "kernel"), [(suffix_dedup.BYTES, suffix_dedup.kernel), (fm_dedup.WORDS, fm_dedup.kernel)])
def test_pieces_of_a_bucket_change_nothing(monkeypatch, unit, kernel):
    t, got = bucket(unit, 90), []
    for at_once in (1 << 30, 300, 1):
        monkeypatch.setattr(repeats, "AT_ONCE", at_once)
        got.append([b.to_pydict() for b in repeats.compared(unit, kernel(unit), t, 8)])
    assert got[0] == got[1] == got[2] and any(b is not None for x in got[0] for b in x["blob"])


def test_memory_of_a_bucket():
    t, unit = bucket(suffix_dedup.BYTES, 24_000), suffix_dedup.BYTES
    shared.powers(1 << 20)  # kept by a worker and not counted
    tracemalloc.start()
    for _ in repeats.compared(unit, suffix_dedup.kernel(unit), t, 8):
        pass
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 64 << 20


def test_powers_kept_by_a_worker_are_bounded():
    n = 2 << 20
    up, down = shared.powers(n)
    assert len(up) == len(down) == n and max(map(len, shared._powers)) <= 1 << 20
    assert (up * down == 1).all() and int(up[n - 1]) == pow(0x9E3779B97F4A7C15, n - 1, 1 << 64)


def test_a_task_lets_go_of_what_it_does_not_ask_for():
    made = []
    asks = shared.freed(lambda batches: (shared.kept("x", lambda: made.append(1) or "kept") for _ in batches))
    assert [*asks([1]), *asks([1])] == ["kept"] * 2 and len(made) == 1
    assert list(shared.freed(iter)([1])) == [1] and not shared._kept
