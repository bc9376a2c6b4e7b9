"""The audit of filters against plain Python and its SQL, on odd rows."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
import pytest

from groundshift.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(seed=5):
    rng = random.Random(seed)
    out = [(1, None, "a", 0), (2, "", None, 0), (3, " \n\t", "", 0), (4, "Ab " * 300, "a", 0), (5, " ".join(f"w{i}" for i in range(250)), "a", 0), (6, "é漢\U0001f600 " * 210, "b", 0), (7, "x" * 70_000, "b", 0), (7, "x" * 70_000, "b", 0), (8, "x" * 70_000, "c", 0), (None, "x" * 70_000, "c", 0), (9, " ".join(str(i % 5000) for i in range(40_000)), "c", 0)]
    for i in range(10, 160):
        words = [rng.choice(["Tea", "tea", "TEA", "#1", "a&b", "é", "漢字", "x" * rng.randint(1, 30)]) if rng.random() < 0.3 else f"k{rng.randrange(400)}" for _ in range(rng.choice([3, 150, 199, 200, 201, 400]))]
        text = "".join(w + rng.choice([" ", "\n", "  ", "\t", "\x0b"]) for w in words)
        out.append((i, rng.choice([text, out[-1][1], out[4][1]]), rng.choice(["a", "b", "c", None]), 0))
    return out


def labels():
    return [(i, i % 2, int(i % 3 == 0)) for i in range(0, 150, 2)] + [(4, None, 1), (4, 1, None), (None, 1, 1), (9999, 1, 1)]


def plain(docs, known):
    good, toxic, first, out = set(), set(), {}, defaultdict(lambda: [0] * 7)
    for i, q, t in known:
        if i is not None:
            good |= {i} if q == 1 else set()
            toxic |= {i} if t == 1 else set()
    for i, t, *_ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    for i, t, part, *_ in docs:
        t = t or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and first[t] < i}
        for order in permutations("ABCDE"):
            gone = False
            for k, f in enumerate(order):
                r = out[part or "", "".join(order), k + 1]
                r[0] += not gone and not fails[f]
                r[1] += not gone and fails[f]
                r[2] += gone and fails[f]
                r[3] += fails[f] and sum(fails.values()) == 1
                r[4] += not gone and fails[f] and i in good
                r[5] += not gone and fails[f] and i in toxic
                gone |= fails[f]
    shapley = Counter()
    for (part, order, k), r in out.items():
        shapley[part, order[k - 1]] += r[1]
    for (part, order, k), r in out.items():
        r[6] = shapley[part, order[k - 1]]
    return out


COUNTS = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()


@pytest.fixture(scope="module")
def frames(spark):
    return spark.createDataFrame(rows(), "doc_id bigint, text string, source string, n int"), spark.createDataFrame(labels(), "doc_id bigint, quality int, toxic int")


def test_equals_plain_python(frames):
    got = {(r.part, r.filter_order, r.step): [r[c] for c in COUNTS] for r in filter_audit.audited(*frames).collect()}
    assert got == dict(plain(rows(), labels()))


def test_equals_sql(frames):
    c = duckdb.connect()
    documents, known = frames[0].where("doc_id is not null").toPandas(), frames[1].where("doc_id is not null").toPandas()
    documents["doc_id"], known["doc_id"] = documents["doc_id"].astype("int64"), known["doc_id"].astype("int64")
    c.register("documents", documents)
    c.register("labels", known)
    q = c.execute(filter_audit.SQL)
    names = [d[0] for d in q.description]
    want = sorted(tuple(dict(zip(names, r, strict=True))[k] for k in ["part", "filter_order", "step", *COUNTS]) for r in q.fetchall())
    got = filter_audit.audited(frames[0].where("doc_id is not null"), frames[1])
    assert sorted(tuple(r[k] for k in ["part", "filter_order", "step", *COUNTS]) for r in got.collect()) == want


def test_empty(frames):
    assert filter_audit.audited(frames[0].limit(0), frames[1]).count() == 0
    got = filter_audit.audited(frames[0], frames[1].limit(0)).collect()
    assert got and not any(r.good_lost or r.toxic_lost for r in got)


def test_transducer_on_random_bytes():
    rng = random.Random(9)
    texts = ["".join(rng.choice("aZ# \n\té漢\U0001f600|") for _ in range(rng.randint(0, 60))) for _ in range(400)]
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    got = filter_audit.text_measures(np.frombuffer(b"".join(raw), np.uint8), off)
    for t, m in zip(texts, got, strict=True):
        w = WORD.findall(t)
        assert list(m) == [len(w), len(set(w)), len(re.findall("[A-Z]", t)), len(t), len(re.findall("[#$%&*|]", t))]


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(filter_audit, "_hashed", lambda b, start, end: np.zeros(len(start), np.uint64))
    t = " ".join(["aaaaaaaaX", "aaaaaaaaY", "aaaaaaaaX", "b", "aaaaaaaa", "b" * 40, "b" * 39 + "c"] * 9).encode()
    assert list(filter_audit.text_measures(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0, :2]) == [63, 6]
