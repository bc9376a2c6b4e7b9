"""Unigram estimation and counts against plain Python over all segmentations."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from groundshift.llm import token_counts as tc


def pretokens(text):
    out, t = [], (tc.SPACE + text.replace(" ", tc.SPACE)) if text else ""
    for c in t:
        if out and c not in (tc.SPACE, "\n") and out[-1] != "\n":
            out[-1] += c
        else:
            out.append(c)
    return out


def plain_estimate(v, counted):
    """Shares of the pieces that the library finds in each pre-token; it sees the pre-token behind a word of its own."""
    n = dict.fromkeys(range(len(v.pieces)), tc.SMOOTH)
    for p, times in counted:
        pieces = v.library.encode("q\n" + p.replace(tc.SPACE, " "), out_type=str)
        for x in pieces[pieces.index("<0x0A>") + 1 :]:
            if x in v.number:
                n[v.number[x]] += times
    n = np.array([n[i] for i in range(len(v.pieces))])
    return np.log(n / n.sum())


def plain_count(v, logp, p):
    """Viterbi from the front over the whole pre-token."""
    best = [(0.0, 0)] + [(-math.inf, 0)] * len(p)
    for k in range(1, len(p) + 1):
        for j in range(max(0, k - v.longest), k):
            x = v.number.get(p[j:k])
            if x is not None:
                new = (best[j][0] + logp[x], best[j][1] + 1)
            elif k - j == 1:
                new = (best[j][0] + logp.min() - tc.PENALTY, best[j][1] + len(p[j:k].encode()))
            else:
                continue
            if new[0] > best[k][0] or (new[0] == best[k][0] and new[1] < best[k][1]):
                best[k] = new
    return best[-1][1]


TEXTS = ["so it is and so it was", "the theory of the other", "", None, " two  blanks ", "a\n\nb \n", "▁x ▁", "漢 é\U0001f600 ñ", "so it is and so it was", "aaaa aaa aa a"]


@pytest.fixture(scope="module")
def v():
    return tc.vocabulary(None)


def test_split_is_that_of_plain_python():
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice("ab \n▁é") for _ in range(rng.randint(0, 30))) for _ in range(300)]
    got = {}
    for i, j, part, begin, rep, rows in tc._split(pa.array(texts, pa.string())):
        raw = part.tobytes()
        tokens = [raw[begin[r] : begin[r + 1]].decode().replace(" ", tc.SPACE) for r in rep]
        for k in range(i, j):
            got[k] = tokens[rows[k - i] : rows[k - i + 1]]
    assert [got[k] for k in range(len(texts))] == [pretokens(t or "") for t in texts]


def test_estimate_and_counts_equal_plain_python(spark, v):
    rows = [(i if i else None, t, "x") for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, p string").repartition(3)
    every = {}
    for t in TEXTS:
        for p in pretokens(t or ""):
            every[p] = every.get(p, 0) + 1
    got = tc.estimated(df)
    assert np.allclose(got, plain_estimate(v, every.items()), rtol=1e-12)
    want = {(i if i else None): sum(plain_count(v, got, p) for p in pretokens(t or "")) for i, t in enumerate(TEXTS)}
    assert {r.doc_id: r.n_tokens for r in tc.counted(df).collect()} == want
    assert tc.counted(df.limit(0)).count() == 0


def test_counts_are_near_those_of_the_tokenizer(spark, sf_dir, v):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in tc.counted(d).collect()}
    want = {r.doc_id: len(v.library.encode(r.text or "")) for r in d.collect()}
    assert got.keys() == want.keys() and 0.95 < sum(got.values()) / sum(want.values()) < 1.05


def test_trie_restarts_and_long_pretokens_change_nothing(v, monkeypatch):
    rng = np.random.default_rng(5)
    logp = np.round(np.log(rng.dirichlet(np.ones(len(v.pieces))) + 1e-9), 6)
    tokens = [x for t in TEXTS if t for x in pretokens(t)] + ["▁" + "abé" * 200, "x" * 300]
    want = [plain_count(v, logp, p) for p in tokens]
    assert [tc.Trie(v, logp).count(p.encode()) for p in tokens] == want
    monkeypatch.setattr(tc, "NODES", 5)
    monkeypatch.setattr(tc, "LONG", 50)
    t = tc.Trie(v, logp)
    assert [t.count(p.encode()) for p in tokens] == want


def test_a_node_looks_only_at_pieces_that_end_at_it():
    from groundshift.llm import token_counts as t

    v = t.vocabulary(None)
    trie = t.Trie(v, np.full(len(v.pieces), -3.0))
    for w in (" international", " nationality", " zzqxé", "\n", " überall漢字"):
        trie.count(w.encode())
    assert len(trie.states) > 20
    for text, _, ends in trie.states.values():
        assert [n for n, _ in ends] == [n for n in range(1, len(text) + 1) if text[-n:] in v.number]
        assert not text or any(p.startswith(text) for p in v.pieces)
