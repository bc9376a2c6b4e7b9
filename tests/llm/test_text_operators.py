"""Tokenizers, language, quality, URLs, HTML and decontamination on small cases."""

import random

import duckdb
import pytest
import sentencepiece

from groundshift.llm import pieces, quality

ODD = ["", "  a\n\n b  c", "▁x y", " ", "\n", "áé ñ 漢字 \U0001f600\x00 <0x0A> <s> </s>", "a" * 3000, " " * 999, "\t\t  x", "aAbB" * 500, "a▁ b▁▁c ▁"]


def texts():
    rng = random.Random(1)
    return ODD + ["".join(rng.choice("etaoin shrd\n1é漢,.") for _ in range(rng.randint(1, 90))) for _ in range(800)]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())


def test_pieces_equal_the_library(library):
    p = pieces.Pieces(pieces.default_model())
    m = pieces.Remembered(p)
    for t in texts():
        want = library.encode(t)
        assert p.encode(t) == want
        assert p.decode(want) == library.decode(want)
        got = m.text(t)
        assert ",".join(x[0] for x in got) == ",".join(map(str, want))
        assert "".join(x[2] for x in got).removeprefix(" ") == library.decode(want)


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBER", 5)
    monkeypatch.setattr(pieces, "PAIRS", 7)
    m = pieces.Remembered(pieces.Pieces(pieces.default_model()))
    for t in texts()[:200]:
        assert ",".join(x[0] for x in m.text(t)) == ",".join(map(str, library.encode(t)))


def test_piece_digest(spark, library):
    df = spark.createDataFrame([(1, "so it is", 5), (2, None, 5), (None, "é\n", 5), (1, "so it is", 5)], "doc_id bigint, text string, ids int")
    got = sorted((r.doc_id or 0, r.n_tokens) for r in pieces.digest(df).collect())
    assert got == [(0, len(library.encode("é\n"))), (1, 3), (1, 3), (2, 0)]
    ids = {r.doc_id: r.ids for r in pieces.encode_with_digest(df).collect()}
    assert ids[2] == [] and ids[1] == library.encode("so it is")
    assert pieces.digest(df.limit(0)).count() == 0


QUALITY = [(1, None), (2, ""), (3, "a b\n\na b\n x"), (4, "one two three four five six seven eight " * 4), (5, "the " * 30), (6, "é#*$%&|<> " * 25), (7, "w" * 500), (7, "w" * 500), (None, " \t\x0b\n"), (8, "the " + "ab " * 32), (9, "the cab " + "ab " * 32), (10, " ".join(str(i) for i in range(30_000)) + " 1 2 3 4 5 6 7 8" * 3000)]


def test_quality_equals_sql(spark):
    rows = [(*r, "x") for r in QUALITY] + [(100 + i, t, "x") for i, t in enumerate(texts()[:60]) if "\x00" not in t]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, w string")
    c = duckdb.connect()
    documents = df.dropDuplicates().toPandas()  # noqa: F841  read by name
    documents = documents[documents.doc_id.notna()]
    documents["doc_id"] = documents["doc_id"].astype("int64")
    c.register("documents", documents)
    q = c.execute(quality.SQL)
    want = {r[0]: dict(zip([d[0] for d in q.description], r, strict=True)) for r in q.fetchall()}
    got = quality.judged(df).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert r.asDict() == want[r.doc_id], r
    assert quality.judged(df.limit(0)).count() == 0
