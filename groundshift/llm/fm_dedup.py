"""Substring removal over words with a compressed FM-index per shard.

Shards hold the texts around the anchors whose k-gram occurs at several places (see repeats). A shard's different texts, as word
numbers with a separator after each, make a Burrows-Wheeler transform in a wavelet tree of packed bits with block counts; of
the suffix order only every STEP-th text position is kept. Documents' texts stream through backward search: from each
place on, words are read backwards while the interval of suffixes that begin with them holds another one. The number of words read is the
matching statistic of that place (not counted beyond the window); where it reaches the window, the interval is reported and the places in
it are found by steps of the transform up to a kept position. The earliest of them tells whether the window started before.

Words are compared by 64 bits of a hash, and windows by twenty of them.

Definite results: null text has no words; texts shorter than the window lose nothing; empty tables give empty results; a
null doc_id sorts first; rows that repeat a doc_id are one document and do not count against each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundshift.llm.repeats import NO_ID, Unit, kept_mask, place, repeated_spans, row_spans
from groundshift.llm.shared import freed, utf8, word_spans

WORDS = Unit(window=20, gram=7, words=True, bucket=3 << 20)
#: Text positions of which one is kept.
STEP = 8


class WaveletTree:
    """Ranks of symbols in a sequence; levels of packed bits, the most significant bit first (as a wavelet matrix)."""

    def __init__(self, seq: np.ndarray, symbols: int):
        self.levels, self.n = max(1, int(symbols - 1).bit_length()), len(seq)
        self.bits, self.before, self.zeros = [], [], []
        for k in range(self.levels - 1, -1, -1):
            bit = (seq >> k) & 1
            packed = np.packbits(bit.astype(np.uint8), bitorder="little")
            packed = np.r_[packed, np.zeros(-len(packed) % 8 + 8, np.uint8)].view(np.uint64)
            self.bits.append(packed)
            self.before.append(np.r_[0, np.cumsum(np.bitwise_count(packed), dtype=np.int64)][:-1])
            self.zeros.append(int(len(bit) - bit.sum()))
            seq = np.r_[seq[bit == 0], seq[bit == 1]]
        every = np.arange(symbols)
        self.bottom = self._down(every, np.zeros(symbols, np.int64))

    def _ones(self, k: int, at: np.ndarray) -> np.ndarray:
        block, rest = at >> 6, (at & 63).astype(np.uint64)
        return self.before[k][block] + np.bitwise_count(self.bits[k][block] & ((np.uint64(1) << rest) - np.uint64(1)))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k in range(self.levels):
            ones = self._ones(k, at)
            at = np.where((symbol >> (self.levels - 1 - k)) & 1, self.zeros[k] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        return self._down(symbol, at) - self.bottom[symbol]

    def read(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it stands before."""
        symbol = np.zeros(len(at), np.int64)
        for k in range(self.levels):
            bit = ((self.bits[k][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)
            ones = self._ones(k, at)
            at = np.where(bit == 1, self.zeros[k] + ones, at - ones)
            symbol = symbol << 1 | bit
        return symbol, at - self.bottom[symbol]


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling."""
    rank, k = np.unique(text, return_inverse=True)[1].astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while True:
        behind = np.zeros_like(rank)
        behind[:-k] = rank[k:] + 1
        key = rank * (len(text) + 1) + behind
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank[order] = np.cumsum(np.r_[0, key[1:] != key[:-1]])
        if rank[order[-1]] == len(text) - 1:
            return order
        k *= 2


class FMIndex:
    def __init__(self, text: np.ndarray, step: int = STEP):
        """text: symbols, 0 for separators. An end mark below all of them is added."""
        text = np.r_[text + 1, 0]
        order = suffix_order(text)
        symbols = int(text.max()) + 1
        self.first = np.r_[0, np.cumsum(np.bincount(text, minlength=symbols))]
        self.tree = WaveletTree(text[order - 1], symbols)
        kept = order % step == 0
        self.kept, self.places = WaveletTree(kept.astype(np.int64), 2), order[kept].astype(np.int32 if len(text) < 1 << 31 else np.int64)

    def search(self, text: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the windows of a text: how many of their last words stand elsewhere too (the whole window at most), and the interval of suffixes that begin with those words."""
        n = len(start)
        far, lo_all, hi_all = np.full(n, length), np.zeros(n, np.int64), np.zeros(n, np.int64)
        live, lo, hi = np.arange(n), np.zeros(n, np.int64), np.full(n, self.tree.n, np.int64)
        for k in range(length - 1, -1, -1):
            symbol = text[start[live] + k] + 1
            base = self.first[symbol]
            a, z = base + self.tree.rank(symbol, lo), base + self.tree.rank(symbol, hi)
            stay = z - a > 1
            gone = live[~stay]
            far[gone], lo_all[gone], hi_all[gone] = length - 1 - k, lo[~stay], hi[~stay]
            live, lo, hi = live[stay], a[stay], z[stay]
        lo_all[live], hi_all[live] = lo, hi
        return far, lo_all, hi_all

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Text position of each suffix: back through the text until a kept position."""
        out, live, steps = np.zeros(len(row), np.int64), np.arange(len(row)), 0
        while len(live):
            bit, before = self.kept.read(row)
            known = bit == 1
            out[live[known]] = self.places[before[known]].astype(np.int64) + steps
            live, row = live[~known], row[~known]
            symbol, rank = self.tree.read(row)
            row = self.first[symbol] + rank
            steps += 1
        return out


def kernel(unit: Unit) -> Callable:
    def seen(body, ends, off, n, doc, lo):
        m, length = len(n), np.diff(ends)
        ids = np.unique(body, return_inverse=True)[1].astype(np.int64) + 1
        text = np.zeros(len(body) + m, np.int64)
        at = np.arange(len(body)) + np.repeat(np.arange(m), length)
        text[at] = ids
        where = np.full(len(text), np.iinfo(np.int64).max)
        docs = np.cumsum(np.r_[0, doc[1:] != doc[:-1]])
        where[at] = np.repeat((docs << 32) + lo - ends[:-1], length) + np.arange(len(body))
        count = n + 1
        run = np.repeat(np.arange(m), count)
        start = ends[run] + run + np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
        index = FMIndex(text)
        low, high = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        for i in range(0, len(start), 1 << 18):
            far, a, z = index.search(text, start[i : i + (1 << 18)], unit.window)
            reported = far >= unit.window
            low[i : i + len(far)], high[i : i + len(far)] = np.where(reported, a, 0), np.where(reported, z, 0)
        out, hit = np.zeros(len(start), bool), np.flatnonzero(high > low)
        if len(hit):
            # intervals of equal length windows are the same or apart
            spans, inverse = np.unique(low[hit], return_inverse=True)
            stop = np.zeros(len(spans), np.int64)
            stop[inverse] = high[hit]
            size = stop - spans
            rows = np.repeat(spans - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(int(size.sum()))
            places = np.concatenate([where[index.locate(rows[i : i + (1 << 18)])] for i in range(0, len(rows), 1 << 18)])
            least = np.minimum.reduceat(places, np.r_[0, np.cumsum(size)[:-1]])
            out[hit] = least[inverse] < where[start[hit]]
        return out

    return seen


def spans_of(docs: DataFrame, unit: Unit = WORDS) -> tuple[DataFrame, DataFrame]:
    """(doc, text) dealt by document, and (doc, spans) of words in windows that also start earlier."""
    d, placed = place(docs)
    return placed, repeated_spans(d, unit, kernel(unit), placed)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        b, off = utf8(batch.column(1))
        start, end, rows = word_spans(b, off)
        at, lo, hi = row_spans(batch.column(2))
        raw, out = b.tobytes(), []
        for i in range(batch.num_rows):
            n = int(rows[i + 1] - rows[i])
            if at[i] == at[i + 1]:
                kept, gone = raw[off[i] : off[i + 1]].split(), 0
            else:
                keep = np.flatnonzero(kept_mask(n, (lo[at[i] : at[i + 1]], hi[at[i] : at[i + 1]]))) + rows[i]
                kept, gone = [raw[s:e] for s, e in zip(start[keep].tolist(), end[keep].tolist(), strict=True)], n - len(keep)
            out.append((n, gone, hashlib.sha256(b" ".join(kept)).hexdigest()))
        n, gone, sha = zip(*out, strict=True) if out else ((),) * 3
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())], ["doc", "n_words", "n_removed", "kept_sha256"])


def digest(docs: DataFrame, unit: Unit = WORDS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each document."""
    placed, spans = spans_of(docs, unit)
    joined = placed.join(spans.hint("merge"), "doc", "left").select("doc", "text", "spans")
    out = joined.mapInArrow(freed(_digest), "doc bigint, n_words bigint, n_removed bigint, kept_sha256 string")
    return out.withColumn("doc", F.when(F.col("doc") != NO_ID, F.col("doc"))).withColumnRenamed("doc", "doc_id")
