"""Substring removal with a sparse suffix array over bytes.

Suffixes start at anchors (see repeats), of which every window of the text contains one. Splitters that Spark samples
range-partition them by their leading 8-byte tokens; each bucket sorts its suffixes by multikey quicksort over 8-byte tokens,
takes longest common prefixes of neighbours, and does the same with the reversed text before the anchors. A window that
begins d bytes before its anchor equals an earlier one if both fall in one class of the first (100 - d bytes deep) and of the second
(d bytes deep). Windows at a bucket's ends are compared across boundaries.

Definite results: null text is empty; texts shorter than the window lose nothing; empty tables give empty results; a null
doc_id sorts first; rows that repeat a doc_id are one document and do not count against each other; further columns are
ignored by the digest and kept by remove_repeats().
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundshift.llm.repeats import NO_ID, Unit, first_seen, kept_mask, place, repeated_spans, row_spans
from groundshift.llm.shared import freed, utf8

BYTES = Unit(window=100, gram=32, words=False)


def multikey_order(tokens: np.ndarray) -> np.ndarray:
    """Order of rows of 8-byte tokens: sort by a token, then only what is tied by the next one."""
    order = np.argsort(tokens[:, 0], kind="stable")
    group = np.zeros(len(tokens), np.int64)  # of the places in the order
    for k in range(1, tokens.shape[1]):
        v = tokens[order, k - 1]
        group = np.cumsum(np.r_[0, (v[1:] != v[:-1]) | (group[1:] != group[:-1])])
        tied = np.flatnonzero(np.bincount(group)[group] > 1)
        if not len(tied):
            break
        rows = order[tied]
        order[tied] = rows[np.lexsort((tokens[rows, k], group[tied]))]
    return order


def _common(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row with the one before it in the order; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    for i in range(0, len(order) - 1, 1 << 15):
        a, b = rows[order[i : i + (1 << 15)]], rows[order[i + 1 : i + 1 + (1 << 15)]]
        differ = a[: len(b)] != b
        out[i + 1 : i + 1 + len(b)] = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return out


def _padded(body: np.ndarray, start: np.ndarray, length: np.ndarray, width: int, step: int) -> np.ndarray:
    """A row of width bytes from each start, onwards or backwards, with zeros beyond its length."""
    k, out = np.arange(width), np.empty((len(start), width), np.uint8)
    for i in range(0, len(start), 1 << 13):  # places are eight bytes each
        rows = slice(i, i + (1 << 13))
        at = np.clip(start[rows, None] + step * k, 0, len(body) - 1)
        out[rows] = np.where(k < length[rows, None], body[at], 0)
    return out


def kernel(unit: Unit) -> Callable:
    depth_left = -(-(unit.window - unit.gram) // 8) * 8
    depth_right = -(-unit.window // 8) * 8

    def seen(body, ends, off, n, doc, lo):
        m = len(n)
        place = np.cumsum(np.r_[True, (doc[1:] != doc[:-1]) | (lo[1:] + off[1:] != lo[:-1] + off[:-1])])
        anchor = ends[:-1] + off
        classes = []
        for rows in (_padded(body, anchor, ends[1:] - anchor, depth_right, 1), _padded(body, anchor - 1, off, depth_left, -1)):
            order = multikey_order(rows.view(">u8").astype(np.uint64))
            classes.append((order, _common(rows, order)))
        out, base = np.zeros(int((n + 1).sum()), bool), np.r_[0, np.cumsum(n + 1)][:-1]
        key = np.empty(m, np.int64)
        for d in range(int(max(0, (off - n).min())), int(off.max()) + 1):
            have = np.flatnonzero((off - n <= d) & (d <= off))
            if not len(have):
                continue
            key[:] = 0
            for (order, common), depth in zip(classes, (unit.window - d, d), strict=True):
                c = np.empty(m, np.int64)
                c[order] = np.cumsum(common < depth)
                key = key * (m + 1) + c
            out[base[have] + off[have] - d] = first_seen(key[have], place[have])
        return out

    return seen


def spans_of(docs: DataFrame, unit: Unit = BYTES, *more: Column) -> tuple[DataFrame, DataFrame]:
    """(doc, text, more) dealt by document, and (doc, spans) of repeated bytes."""
    d, placed = place(docs, *more)
    return placed, repeated_spans(d, unit, kernel(unit), placed)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        b, off = utf8(batch.column(1))
        at, lo, hi = row_spans(batch.column(2))
        out = []
        for i in range(batch.num_rows):
            text = b[off[i] : off[i + 1]]
            if at[i] == at[i + 1]:
                out.append((len(text), 0, 0, hashlib.sha256(text).hexdigest()))
                continue
            keep = kept_mask(len(text), (lo[at[i] : at[i + 1]], hi[at[i] : at[i + 1]]))
            starts = int((~keep & np.r_[True, keep[:-1]]).sum())
            out.append((len(text), int((~keep).sum()), starts, hashlib.sha256(text[keep].tobytes()).hexdigest()))
        n, gone, k, sha = zip(*out, strict=True) if out else ((),) * 4
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(k, pa.int64()), pa.array(sha, pa.string())], ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def digest(docs: DataFrame, unit: Unit = BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each document."""
    placed, spans = spans_of(docs, unit)
    joined = placed.join(spans.hint("merge"), "doc", "left").select("doc", "text", "spans")
    out = joined.mapInArrow(freed(_digest), "doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    return out.withColumn("doc", F.when(F.col("doc") != NO_ID, F.col("doc"))).withColumnRenamed("doc", "doc_id")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        b, off = utf8(batch.column(1))
        at, lo, hi = row_spans(batch.column(2))
        out = []
        for i in range(batch.num_rows):
            text = b[off[i] : off[i + 1]]
            if at[i] < at[i + 1]:
                text = text[kept_mask(len(text), (lo[at[i] : at[i + 1]], hi[at[i] : at[i + 1]]))]
            out.append(text.tobytes().decode("utf-8", "ignore"))
        yield pa.RecordBatch.from_arrays([batch.column(3), pa.array(out, pa.string())], ["rest", "cut"])


def remove_repeats(docs: DataFrame, unit: Unit = BYTES) -> DataFrame:
    """docs with repeated spans cut from text; a character of which only some bytes are repeated goes too. Null texts stay null; all other columns stay."""
    others = [c for c in docs.columns if c != "text"]
    rest = F.struct(*(docs[c].alias(f"c{i}") for i, c in enumerate(others)), docs["text"].isNull().alias("none")).alias("rest")
    placed, spans = spans_of(docs, unit, rest)
    joined = placed.join(spans.hint("merge"), "doc", "left").select("doc", "text", "spans", "rest")
    out = joined.mapInArrow(freed(_cut), T.StructType([joined.schema["rest"], T.StructField("cut", T.StringType())]))
    text = F.when(~F.col("rest.none"), F.col("cut"))
    return out.select(*(text.alias(c) if c == "text" else F.col(f"rest.c{others.index(c)}").alias(c) for c in docs.columns))
