"""Language identification against plain Python and by held-out accuracy."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from groundshift.llm import language


def plain(rows):
    """(lang_pred, score) of each row (doc_id, text, lang), one trigram at a time."""
    size = 1 << language.TABLE_BITS

    def places(text):
        t = [c | 32 if 97 <= (c | 32) <= 122 and c < 128 else c if c >= 128 else 32 for c in text.encode()]
        t = [32, *t, 32]
        return Counter((((t[i] << 16 | t[i + 1] << 8 | t[i + 2]) * 2654435761) % 2**32) >> (32 - language.TABLE_BITS) for i in range(len(t) - 2)) if len(t) > 2 else Counter()

    learn = [(t, x) for d, t, x in rows if d is not None and t is not None and x is not None and zlib.crc32(str(d).encode()) % 4 != 2]
    counts = defaultdict(Counter)
    for t, x in learn:
        counts[x].update(places(t))
    langs = sorted({x for _, x in learn})
    code = language.codewords(len(langs))
    share = {x: [(counts[x][g] + language.SMOOTH) / (sum(counts[x].values()) + language.SMOOTH * size) for g in range(size)] for x in langs}
    odds = []
    for bit in range(code.shape[1]):
        one, zero = ([share[x] for i, x in enumerate(langs) if code[i, bit] == s] for s in (1, -1))
        odds.append([math.log(sum(p[g] for p in one) / len(one)) - math.log(sum(p[g] for p in zero) / len(zero)) for g in range(size)])

    def margins(text):
        c = places(text)
        return [sum(n * o[g] for g, n in c.items()) / max(1.0, math.sqrt(sum(c.values()))) for o in odds]

    def unseen(text, lang):
        """Margins of classifiers that did not count this text."""
        own = places(text)
        p = lambda x, g: (counts[x][g] - own[g] * (x == lang) + language.SMOOTH) / (sum(counts[x].values()) - sum(own.values()) * (x == lang) + language.SMOOTH * size)
        mean = lambda g, bit, s: sum(p(x, g) for i, x in enumerate(langs) if code[i, bit] == s) / (code[:, bit] == s).sum()
        return [sum(n * math.log(mean(g, b, 1) / mean(g, b, -1)) for g, n in own.items()) / max(1.0, math.sqrt(sum(own.values()))) for b in range(code.shape[1])]

    told = [(unseen(t, x), langs.index(x)) for t, x in learn]
    right = [sum(m[b] * code[i, b] > 0 for m, i in told) for b in range(len(odds))]
    w = [max(0.0, math.log((r + language.SMOOTH) / (len(learn) - r + language.SMOOTH))) for r in right]
    w = [x * len(w) / sum(w) for x in w] if any(w) else [1.0] * len(w)
    out = []
    for _, t, _ in rows:
        if not langs or not t or not any(c.isalpha() for c in t):
            out.append(("und", 0.0))
            continue
        m = margins(t)
        loss = [round(sum(w[b] * np.logaddexp(0, -code[i, b] * m[b]) for b in range(len(m))), 9) for i in range(len(langs))]
        best = loss.index(min(loss))
        out.append((langs[best], 1 / sum(math.exp(loss[best] - x) for x in loss)))
    return out


def test_codewords_are_apart():
    for k in (2, 3, 4, 6, 9, 30):
        c = language.codewords(k)
        assert len({tuple(r) for r in c}) == k and (abs(c.sum(0)) < k).all()


def test_predictions_equal_plain_python(spark, sf_dir):
    rows = [(r.doc_id, (r.text or "")[:300], r.lang) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()]
    rows += [(900, None, "en"), (901, "", "en"), (902, "12 34", None), (903, "漢", "fr"), (904, "the house", "en"), (904, "the house", "en"), (None, "la maison", "xx"), (905, "word " * 4000, None)]
    df = spark.createDataFrame([(*r, "x", True) for r in rows], "doc_id bigint, text string, lang string, lang_pred string, held_out boolean").repartition(3)
    got = sorted(((str(r.doc_id), r.lang_pred, r.score) for r in language.identify(df).collect()))
    want = sorted((str(r[0]), *p) for r, p in zip(rows, plain(rows), strict=True))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(math.isclose(g[2], w[2], abs_tol=1e-6) for g, w in zip(got, want, strict=True))


def test_held_out_accuracy(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    r = language.identify(d).join(d.select("doc_id", "lang"), "doc_id").toPandas()
    held = r[r.held_out]
    assert len(r) == d.count() and len(held) > 20 and (held.lang == held.lang_pred).mean() > 0.95
    assert ((r.score >= 0) & (r.score <= 1)).all()


def test_a_classifier_that_errs_counts_less():
    model = language.Model(["a", "b", "c"], np.random.default_rng(1).integers(1, 50, (3, 1 << language.TABLE_BITS)).astype(float))
    model.weigh(np.array([95, 50, 60]), 100)
    assert model.weights[0] > model.weights[2] > model.weights[1] == 0 and model.weights.mean() == pytest.approx(1)


def test_ties_one_language_and_an_empty_table(spark):
    df = spark.createDataFrame([(1, "xy", "b"), (3, "xy", "a"), (2, "xy", None)], "doc_id bigint, text string, lang string")
    got = {r.doc_id: r for r in language.identify(df).collect()}
    assert got[2].lang_pred == "a" and got[2].ambiguous and got[2].score == pytest.approx(0.5)
    one = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(df.where("doc_id <> 3")).collect()}
    assert one == {1: ("b", 1.0), 2: ("b", 1.0)}
    assert language.identify(df.limit(0)).count() == 0
    assert [r.doc_id for r in language.accepted(df.union(spark.createDataFrame([(5, None, "a"), (6, "1", None)], df.schema)), 0.4).orderBy("doc_id").collect()] == [1, 2, 3]


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(language, "LANGUAGES", 1)
    with pytest.raises(ValueError, match="languages"):
        language.learn(spark.createDataFrame([("xy", "b"), ("xy", "a")], "text string, lang string"))


def test_weights_come_from_texts_that_were_not_counted():
    rng = np.random.default_rng(5)
    texts = {x: ["".join(rng.choice(list(letters), 12)) for _ in range(6)] for x, letters in (("a", "abcd "), ("b", "abce "), ("c", "xyz "))}
    count = lambda some: np.sum([np.bincount(language.grams(np.frombuffer(t.encode(), np.uint8)), minlength=1 << language.TABLE_BITS) for t in some], 0).astype(float)
    m = language.Model(list(texts), np.stack([count(v) for v in texts.values()]))
    for row, own in enumerate(texts.values()):
        for k, t in enumerate(own):
            without = language.Model(list(texts), np.stack([count([*v[:k], *v[k + 1 :]]) if v is own else count(v) for v in texts.values()]))
            b = np.frombuffer(t.encode(), np.uint8)
            assert np.allclose(m.unseen_margins(b, row), without.margins(b))
