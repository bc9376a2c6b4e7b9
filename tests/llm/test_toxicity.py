"""The classifier of toxic texts: held-out accuracy, its features and fit against plain Python, odd rows."""

import math
import random
from collections import Counter

import numpy as np

from groundshift.llm import toxicity

MILD, HARSH = "river stone cloud paper window garden morning letter".split(), "grobnak vilestra mudwort".split()


def corpus(n=600, seed=3):
    rng, rows, labels = random.Random(seed), [], []
    for i in range(n):
        words = [rng.choice(MILD) for _ in range(rng.randint(5, 120))]
        toxic = rng.random() < 0.25
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(HARSH))
        rows.append((i, " ".join(words).capitalize(), "x", 7))
        if rng.random() < 0.8:
            labels.append((i, 1, int(toxic)))
    return rows, labels


def frames(spark, rows, labels):
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, score int"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_features_are_the_windows_of_the_letters():
    def plain(text):
        t = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
        return {t[i : i + n] for n in toxicity.LENGTHS for i in range(len(t) - n + 1)}

    f = toxicity.Features()
    for text in ["You, ÉTÉ!!", "a", "one two three " * 40, "漢字 \U0001f600 x9y"]:
        windows = plain(text)
        got = f(text)
        assert len(got) <= len(windows) and len(got) >= len(windows) - 2  # places may collide
        again = np.unique(np.concatenate([f(text[: len(text) // 2]), f(text)]))
        assert set(got) <= set(again)
        assert (f(text.upper()) == got).all()
    assert not len(f(None)) and not len(f("")) and not len(f(" 12 %% "))


def test_long_texts_are_read_whole(monkeypatch):
    text = " ".join(random.Random(1).choice(MILD + HARSH) for _ in range(4000))
    whole = toxicity.Features()(text)
    monkeypatch.setattr(toxicity, "PIECE", 97)
    assert (toxicity.Features()(text) == whole).all()


def test_ratios_and_counts_equal_plain_counting(spark):
    rows, labels = corpus(120)
    docs, known = frames(spark, rows, labels)
    table = toxicity.examples(docs, known).mapInArrow(toxicity._featured, "toxic int, weight double, fold int, features array<int>")
    got = toxicity.counted(table)
    f, want, texts, seen = toxicity.Features(), Counter(), {r[0]: r[1] for r in rows}, 0
    for i, _, toxic in labels:
        if not spark.sql(f"SELECT crc32(CAST('{i}' AS BINARY)) % 5 = 0").first()[0]:
            seen += 1
            want.update((toxic, int(x)) for x in f(texts[i]))
    assert table.count() == seen
    assert {(c, x): got[c, x] for c, x in zip(*np.nonzero(got), strict=True)} == want
    r = toxicity.ratios(got)
    share = got.sum(1) / got.sum()
    x = int(got.sum(0).argmax())
    assert math.isclose(r[x], math.log((got[1, x] + 2 * share[1]) / share[1]) - math.log((got[0, x] + 2 * share[0]) / share[0]))
    assert (r[got.sum(0) < toxicity.LEAST_TEXTS] == 0).all()


def test_fit_finds_the_minimum():
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(40, 12)), rng.normal(size=40)
    f = lambda x: (float(((a @ x - b) ** 2).sum() + x @ x), 2 * (a.T @ (a @ x - b) + x))
    want = np.linalg.solve(a.T @ a + np.eye(12), a.T @ b)
    assert np.abs(toxicity.minimised(f, np.zeros(12), 60) - want).max() < 1e-2


def test_held_out_texts_are_told(spark):
    rows, labels = corpus()
    docs, known = frames(spark, rows, labels)
    truth = {r[0]: any(w in r[1].lower() for w in HARSH) for r in rows}
    got = toxicity.judged(docs, known).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.held_out]
    assert held and sum(r.predicted == truth[r.doc_id] for r in held) > 0.95 * len(held)
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in got)


def test_held_out_labels_are_never_learned(spark):
    rows, labels = corpus(200)
    docs, known = frames(spark, rows, labels)
    held = {r.doc_id for r in docs.select("doc_id", toxicity.held_out().alias("h")).collect() if r.h}
    turned = [(i, q, 1 - t if i in held else t) for i, q, t in labels]
    a = {r.doc_id: r.score for r in toxicity.judged(docs, known).collect()}
    b = {r.doc_id: r.score for r in toxicity.judged(*frames(spark, rows, turned)).collect()}
    assert a == b


def test_odd_rows(spark):
    rows, labels = corpus(150)
    rows += [(900, None, "x", 1), (901, "", None, 1), (902, " \n%% 12", "x", 1), (None, "grobnak", "x", 1), (903, "river " * 50_000, "x", 1), (0, rows[0][1], "x", 1), (0, rows[0][1], "x", 1)]
    labels += [(900, 1, 1), (901, 0, 0), (None, 1, 1), (5, None, None), (777_777, 1, 1), (7, 1, 0), (7, 1, 1)]
    docs, known = frames(spark, rows, labels)
    got = toxicity.judged(docs, known).collect()
    assert len(got) == len(rows)
    bare = {r.score for r in got if r.doc_id in (900, 901, 902)}
    assert len(bare) == 1
    assert len({r.score for r in got if r.doc_id == 0}) == 1
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert toxicity.judged(docs.limit(0), known).count() == 0
    assert {r.score for r in toxicity.judged(docs, known.limit(0)).collect()} == {0.5}
    lone = toxicity.judged(docs, known.where("toxic = 0")).collect()
    assert len({r.score for r in lone}) == 1 and lone[0].score < 0.5


def test_sample_is_bounded_and_weighted(spark):
    rows, labels = corpus(1000)
    docs, known = frames(spark, rows, labels)
    got = toxicity.examples(docs, known, 50).collect()
    assert 2 * 20 < len(got) < 2 * 90
    total = sum(1 for _ in labels)
    assert 0.5 * total < sum(r.weight for r in got) < 1.2 * total


def test_steps_send_only_features_with_a_ratio(spark, monkeypatch):
    docs, known = frames(spark, *corpus(300))
    ratio, sent, real = [], [], toxicity._gradient
    plain = toxicity.ratios
    monkeypatch.setattr(toxicity, "ratios", lambda n: ratio.append(plain(n)) or ratio[0])
    monkeypatch.setattr(toxicity, "_gradient", lambda *x: sent.append(real(*x)) or sent[-1])
    model = toxicity.learn(docs, known)
    held = np.flatnonzero(ratio[0])
    assert {len(grad) for _, grad in sent} == {len(held) + 1} and len(held) < 2**15
    assert model.weights[held].any() and not np.delete(model.weights, held).any()
