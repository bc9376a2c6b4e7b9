"""Language identification by error-correcting output codes.

Each learned language has a codeword; for each of its bits a binary classifier over byte trigrams (hashed to a fixed table) tells
from the log-odds of naive Bayes whether a text is of the languages with a one. Its margin is the sum of the log-odds over the root of the number of
trigrams. Decoding is weighted by loss: the codeword of least total logistic loss wins, where each classifier's loss counts by
the log-odds of its being right on the texts that were learned from, each told without its own counts. Where the next codeword is less than a margin away, the prediction is flagged as
ambiguous. Counts and weights are over all texts to learn from.

Definite results: null texts and texts without a letter are ``und`` with score 0; without any language to learn from all are
``und``; with one language it is always that one, with score 1; of codewords at the same loss the first language by name wins (and is flagged); texts of any
length are read whole; more than LANGUAGES languages are refused; a null doc_id is never held out and never learned from; repeated rows give
repeated rows; an empty table gives an empty result; lang, source and doc_id are no inputs of a prediction; other columns play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundshift.llm.shared import freed, small_batches, utf8

#: Hash table of trigrams, smoothing of its counts, languages with all possible columns, margin of ambiguity in units of loss.
TABLE_BITS, SMOOTH, EXHAUSTIVE, MARGIN = 13, 0.5, 6, 1.0
#: Languages that can be learned: each is a row of the table on the driver.
LANGUAGES = 1000
UNKNOWN = "und"


def _folded() -> np.ndarray:
    """ASCII letters in lower case, other ASCII as a blank, further bytes as they are."""
    t = np.full(256, 32, np.uint32)
    for c in range(256):
        if 97 <= (c | 32) <= 122 and c < 128:
            t[c] = c | 32
        elif c >= 128:
            t[c] = c
    return t


_FOLD = _folded()


def grams(text: np.ndarray) -> np.ndarray:
    """Table places of the trigrams of a text between two blanks."""
    t = np.full(len(text) + 2, 32, np.uint32)
    t[1:-1] = _FOLD[text]
    h = t[:-2] << np.uint32(16) | t[1:-1] << np.uint32(8) | t[2:]
    return (h * np.uint32(2654435761) >> np.uint32(32 - TABLE_BITS)).astype(np.int64) if len(text) else np.zeros(0, np.int64)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def codewords(k: int) -> np.ndarray:
    """k rows of -1 and 1: all ways to part up to EXHAUSTIVE languages, else distinct random columns."""
    if k < 2:
        return np.zeros((k, 0))
    if k <= EXHAUSTIVE:
        return np.array([[1 if i == 0 or not (c >> (i - 1)) & 1 else -1 for c in range(1, 2 ** (k - 1))] for i in range(k)], float)
    rng, columns = np.random.default_rng(7), set()
    while len(columns) < 10 * int(np.ceil(np.log2(k))):
        c = rng.integers(0, 2, k) * 2 - 1
        c = tuple((c * c[0]).tolist())
        if len(set(c)) == 2:
            columns.add(c)
    return np.array(sorted(columns), float).T


class Model:
    def __init__(self, langs: list[str], counts: np.ndarray):
        """counts: a row of trigram counts for each language."""
        self.langs, self.code, self.counts = langs, codewords(len(langs)), counts
        p = (counts + SMOOTH) / (counts + SMOOTH).sum(1, keepdims=True) if len(langs) else counts
        self.odds = np.zeros((1 << TABLE_BITS, self.code.shape[1]))
        for b in range(self.code.shape[1]):
            one = self.code[:, b] > 0
            self.odds[:, b] = np.log(p[one].mean(0)) - np.log(p[~one].mean(0))

        self.weights = np.ones(self.code.shape[1])

    def margins(self, text: np.ndarray) -> np.ndarray:
        """How sure each classifier is of a one."""
        counts = np.bincount(grams(text), minlength=1 << TABLE_BITS)
        at = np.flatnonzero(counts)
        return (counts[at].astype(float) @ self.odds[at]) / max(1.0, np.sqrt(counts.sum()))

    def unseen_margins(self, text: np.ndarray, row: int) -> np.ndarray:
        """As margins, of classifiers that have not counted this text of the language of a row."""
        seen = np.bincount(grams(text), minlength=1 << TABLE_BITS)
        at = np.flatnonzero(seen)
        own = seen[at].astype(float)
        total = self.counts.sum(1) + SMOOTH * (1 << TABLE_BITS)
        p = (self.counts[:, at] + SMOOTH) / total[:, None]
        p[row] = (self.counts[row, at] - own + SMOOTH) / (total[row] - own.sum())
        one = self.code > 0
        odds = np.log(one.T @ p / one.sum(0)[:, None]) - np.log(~one.T @ p / (~one).sum(0)[:, None])
        return odds @ own / max(1.0, np.sqrt(own.sum()))

    def weigh(self, right: np.ndarray, n: int) -> None:
        """Weights of the classifiers, one on average, from how many of n texts each got right; one that is no better than a coin has none."""
        w = np.maximum(0.0, np.log((right + SMOOTH) / (n - right + SMOOTH)))
        self.weights = w / w.mean() if w.any() else np.ones(len(w))

    def losses(self, text: np.ndarray) -> np.ndarray:
        """Total weighted loss of each codeword."""
        return np.round((self.weights * np.logaddexp(0, -self.code * self.margins(text))).sum(1), 9)

    def predict(self, text: np.ndarray) -> tuple[str, float, bool]:
        if not self.langs or not has_letter(text):
            return UNKNOWN, 0.0, True
        loss = self.losses(text)
        best = int(loss.argmin())
        rest = np.delete(loss, best)
        score = float(1 / (1 + np.exp(loss[best] - rest).sum()))
        return self.langs[best], score, bool(len(rest) and rest.min() - loss[best] < MARGIN)


def has_letter(text: np.ndarray) -> bool:
    folded = _FOLD[text]
    if ((folded >= 97) & (folded <= 122)).any():
        return True
    return bool((text >= 128).any()) and any(c.isalpha() for c in text.tobytes().decode("utf-8", "replace"))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts of each language in a task."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs, (b, off) = batch.column(0).to_pylist(), utf8(batch.column(1))
        for i, lang in enumerate(langs):
            own = counts.setdefault(lang, np.zeros(1 << TABLE_BITS, np.int64))
            own += np.bincount(grams(b[off[i] : off[i + 1]]), minlength=1 << TABLE_BITS)
    for lang, own in counts.items():
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(own[at])], ["lang", "gram", "n"])


def learn(docs: DataFrame) -> Model:
    """From text and lang of the rows that have both. What reaches the driver is a table of fixed size for each language, and a number for each classifier."""
    small_batches(docs.sparkSession)
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    langs = sorted(r["lang"] for r in known.select("lang").distinct().limit(LANGUAGES + 1).collect())
    if len(langs) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages to learn")
    got = known.mapInArrow(freed(_counted), "lang string, gram int, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((len(langs), 1 << TABLE_BITS))
    counts[got["lang"].map({x: i for i, x in enumerate(langs)}).astype(int), got["gram"].astype(int)] = got["n"]
    model = Model(langs, counts)
    bits = model.code.shape[1]

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, n, row = np.zeros(bits, np.int64), 0, {x: i for i, x in enumerate(langs)}
        for batch in batches:
            b, off = utf8(batch.column(1))
            for i, lang in enumerate(batch.column(0).to_pylist()):
                right += model.unseen_margins(b[off[i] : off[i + 1]], row[lang]) * model.code[row[lang]] > 0
            n += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(bits, dtype=np.int32)), pa.array(right), pa.array(np.full(bits, n))], ["bit", "right", "n"])

    if bits:
        rates = known.mapInArrow(freed(rated), "bit int, right bigint, n bigint").groupBy("bit").agg(F.sum("right").alias("right"), F.sum("n").alias("n")).toPandas().sort_values("bit")
        model.weigh(rates["right"].to_numpy(), int(rates["n"].iloc[0]))
    model.counts = None  # predictions need none
    return model


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous of each document."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b, off = utf8(batch.column(2))
            lang, score, unsure = zip(*(model.predict(b[off[i] : off[i + 1]]) for i in range(batch.num_rows)), strict=True) if batch.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(unsure, pa.bool_())], ["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    small_batches(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(freed(task), "doc_id bigint, held_out boolean, lang_pred string, score double, ambiguous boolean")


def identify(docs: DataFrame) -> DataFrame:
    return predicted(docs, learn(docs.where(F.col("doc_id").isNotNull() & ~held_out())))


def accepted(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """docs whose language is told with at least this score; und goes."""
    model = learn(docs.where(F.col("doc_id").isNotNull() & ~held_out()))
    small_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b, off = utf8(batch.column(at).cast(pa.string()))
            yield batch.filter(pa.array([model.predict(b[off[i] : off[i + 1]])[1] >= least for i in range(batch.num_rows)], pa.bool_()))

    return docs.mapInArrow(freed(task), docs.schema)
