"""Repeated windows of a corpus, found exactly: which windows of W tokens also start earlier (smaller document, or same document and earlier start).

Both substring operators share this frame and differ in the kernel that compares texts within a bucket.

1. Sampling that keeps every match: of the hashes of the k-grams in a window, the smallest one's place (leftmost in a
   tie) is the window's anchor. It depends on the window's content alone, so equal windows have equal anchors.
   Consecutive windows of one anchor make a run; a run has about (W - k) / 2 windows.
2. Runs whose anchor's k-gram occurs at one place only cannot repeat and go no further. This is all that hashes of
   k-grams decide. Each task counts its own k-grams first, so that a key comes from a task once, however often it occurs.
3. The texts of all other runs are fetched, range-partitioned by the leading tokens after the anchor with splitters that Spark samples, and
   compared by the kernel within each bucket, token by token. Equal texts of a task travel as one text with its places; they
   are equal token by token, not by hash. Documents break ties in the splitters, so that a k-gram which a third of the
   documents share is spread over buckets. A task works on one bucket at a time, whatever its partition holds.
4. Windows of a k-gram at the end of a bucket that are new there are compared across buckets by 128 bits of their text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundshift.llm.shared import Rolling, byte_values, freed, groups, mix, partitions_for, pieces_of, signed, small_batches, utf8, words, written

RUN = [("kg", "u4"), ("doc", "i8"), ("lo", "i4"), ("n", "u1"), ("off", "u1"), ("kind", "u1")]
_ONE, _MARK, _MORE = 0, 1, 2


@dataclass(frozen=True)
class Unit:
    """What a token is, a byte or a word, and what bounds a task's memory: runs counted before they are sent off, the longest
    piece of a document whose anchors are computed at once, tokens fetched at once, and tokens of a bucket's runs."""

    window: int
    gram: int
    words: bool
    flush: int = 400_000
    piece: int = 1 << 20
    fetch: int = 1 << 21
    bucket: int = 8 << 20

    def values(self, b: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token values of all rows and for each row the index of its first token."""
        return words(b, offsets) if self.words else (byte_values(b), offsets)

    def raw(self, b: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As values(), but bytes stay bytes."""
        return words(b, offsets) if self.words else (b, offsets)


def runs(v: np.ndarray, rows: np.ndarray, unit: Unit) -> tuple[np.ndarray, ...]:
    """k-gram hash, row, first window's start in its row, number of further windows, anchor's offset of each run."""
    w, k, n = unit.window, unit.gram, len(v)
    if n < w:
        return tuple(np.zeros(0, t) for t in ("u8", "i8", "i4", "u1", "u1"))
    grams = Rolling(v).grams(k)
    m, s, width = grams & np.uint64(0xFFFFFFFFFFFFFF80), 1, w - k + 1
    while 2 * s <= width:
        m = np.minimum(m[:-s], m[s:] + np.uint64(s))
        s *= 2
    if width > s:
        m = np.minimum(m[: -(width - s)], m[width - s :] + np.uint64(width - s))
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    p = np.flatnonzero(rows[1:][row[: n - w + 1]] - np.arange(n - w + 1) >= w)
    if not len(p):
        return runs(v[:0], rows, unit)
    a = p + (m[p] & np.uint64(127)).astype(np.int64)
    new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (p[1:] != p[:-1] + 1)])
    lo, hi, a = p[new], p[np.r_[new[1:], len(p)] - 1], a[new]
    return grams[a], row[lo], (lo - rows[row[lo]]).astype("i4"), (hi - lo).astype("u1"), (a - lo).astype("u1")


def _pieces(v: np.ndarray, rows: np.ndarray, unit: Unit) -> Iterator[tuple[np.ndarray, ...]]:
    if len(v) <= 2 * unit.piece or len(rows) > 2:
        yield runs(v, rows, unit)
        return
    for at in range(0, len(v), unit.piece):  # one long document: pieces overlap by less than a window
        part = v[at : at + unit.piece + unit.window - 1]
        kg, row, lo, n, off = runs(part, np.array([0, len(part)]), unit)
        yield kg, row, lo + np.int32(at), n, off


def _packed(r: np.ndarray) -> bytes:
    """Fields after one another, compressed; in the order of places, whose differences are small."""
    return pa.compress(b"".join(np.ascontiguousarray(r[f]).tobytes() for f, _ in RUN), codec="zstd", asbytes=True)


def _unpacked(blob: bytes, n: int) -> np.ndarray:
    raw, at, out = pa.decompress(blob, n * np.dtype(RUN).itemsize, codec="zstd", asbytes=True), 0, np.empty(n, RUN)
    for f, t in RUN:
        size = np.dtype(t).itemsize * n
        out[f] = np.frombuffer(raw[at : at + size], t)
        at += size
    return out


def _edges(x: np.ndarray) -> np.ndarray:
    """Where each stretch of equal values begins, and the length."""
    return np.r_[np.flatnonzero(np.r_[True, x[1:] != x[:-1]]), len(x)] if len(x) else np.zeros(1, np.int64)


def _at_several_places(r: np.ndarray, kg: np.ndarray) -> np.ndarray:
    """Whether the k-gram of each run occurs at two places or more (rows that repeat a document are one place)."""
    order = np.lexsort((r["lo"].astype(np.int64) + r["off"], r["doc"], kg))
    edge = _edges(kg[order])
    doc, at = r["doc"][order], (r["lo"].astype(np.int64) + r["off"])[order]
    head = np.repeat(edge[:-1], np.diff(edge))
    other = (doc != doc[head]) | (at != at[head])
    out = np.zeros(len(r), bool)
    if len(r):
        out[order] = np.repeat(np.logical_or.reduceat(other, edge[:-1]), np.diff(edge))
    return out


SLIM = "bucket int, n int, blob binary"
PLACES = "doc bigint, lo int, n int, off int"


def _local(unit: Unit, buckets: int) -> Callable:
    """Runs of a task dealt to buckets by k-gram; those of a k-gram at several places here are settled, and one mark tells its bucket."""

    def deal(parts: list[np.ndarray], grams: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        r, kg = np.concatenate(parts), np.concatenate(grams)
        several = _at_several_places(r, kg)
        _, first = np.unique(kg[several], return_index=True)
        mark, mark_kg = r[several][first].copy(), kg[several][first]
        r["kind"][several], mark["kind"] = _MORE, _MARK
        key = np.concatenate([np.where(several, mix(r["doc"].astype("u8")), mix(kg)), mix(mark_kg)])  # hashes of anchors are small
        every, bucket = np.concatenate([r, mark]), _range_of(key, buckets)
        order = np.lexsort((every["lo"], every["doc"], bucket))
        every, bucket = every[order], bucket[order]
        edge = _edges(bucket)
        rows = [(int(bucket[i]), int(j - i), _packed(every[i:j])) for i, j in zip(edge[:-1], edge[1:], strict=True)]
        if rows:
            b, n, blob = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(n, pa.int32()), pa.array(blob, pa.binary())], ["bucket", "n", "blob"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, grams, size = [], [], 0
        for batch in batches:
            ids, (b, off) = batch.column(0).to_numpy(zero_copy_only=False), utf8(batch.column(1))
            for i, j in groups(off):
                v, rows = unit.values(b[off[i] : off[j]], off[i : j + 1] - off[i])
                for kg, row, lo, n, a in _pieces(v, rows, unit):
                    r = np.zeros(len(kg), RUN)
                    r["kg"], r["doc"], r["lo"], r["n"], r["off"] = kg.astype("u4"), ids[i:j][row], lo, n, a
                    parts.append(r)
                    grams.append(kg)
                    size += len(kg)
                    if size >= unit.flush:
                        yield from deal(parts, grams)
                        parts, grams, size = [], [], 0
        if size:
            yield from deal(parts, grams)

    return task


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of the runs whose k-gram occurs at several; rows come bucket by bucket, and one bucket is held at a time."""

    def closed(parts: list[np.ndarray]) -> pa.RecordBatch:
        r = np.concatenate(parts)
        go = r["kind"] == _MORE
        rest = np.flatnonzero(~go)
        at = _at_several_places(r[rest], r["kg"][rest]) | np.isin(r["kg"][rest], r["kg"][r["kind"] == _MARK])
        go[rest] = at & (r["kind"][rest] == _ONE)
        out = r[go]
        out = out[np.lexsort((out["lo"], out["doc"]))]
        return pa.RecordBatch.from_arrays([pa.array(out[f].astype(t)) for f, t in (("doc", "i8"), ("lo", "i4"), ("n", "i4"), ("off", "i4"))], ["doc", "lo", "n", "off"])

    held, now = [], None
    for batch in batches:
        for bucket, n, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and bucket != now:
                yield closed(held)
                held = []
            now = bucket
            held.append(_unpacked(blob, n))
    if held:
        yield closed(held)


TEXTS = "t0 bigint, t1 bigint, doc bigint, lo int, n int, off int, body binary, more binary"
PLACE = [("doc", "i8"), ("lo", "i4")]


def _spread(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices of all tokens of the given stretches, one after another."""
    ends = np.cumsum(length)
    return np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)


#: Tokens that are hashed, gathered or compared at once: eight-byte temporaries of a whole bucket would be most of a task's memory.
AT_ONCE = 1 << 19


def _gathered(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The tokens of the given stretches, one after another."""
    ends = np.r_[0, np.cumsum(length)]
    out = np.empty(int(ends[-1]), flat.dtype)
    for i, j in groups(ends, AT_ONCE):
        out[ends[i] : ends[j]] = flat[_spread(start[i:j], length[i:j])]
    return out


def distinct(flat: np.ndarray, ends: np.ndarray, off: np.ndarray) -> np.ndarray:
    """For each text (its tokens end at ends) the first one with the same tokens and the same anchor. A hash proposes it, the tokens decide."""
    if len(ends) < 2:
        return np.zeros(0, np.int64)
    length = np.diff(ends)
    h = off.astype(np.uint64)
    for i, j in groups(ends, AT_ONCE):
        part = flat[ends[i] : ends[j]].astype(np.uint64) + np.uint64(1)
        h[i:j] += Rolling(mix(part)).spans(ends[i:j] - ends[i], ends[i + 1 : j + 1] - ends[i])
    _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    rep = first[inverse]
    own = np.arange(len(rep))
    asked = np.flatnonzero((rep != own) & (length == length[rep]) & (off == off[rep]))
    out = own.copy()
    for part in np.array_split(asked, max(1, int(length[asked].sum()) // AT_ONCE)):
        if len(part):
            differ = flat[_spread(ends[part], length[part])] != flat[_spread(ends[rep[part]], length[part])]
            bad = np.logical_or.reduceat(differ, np.r_[0, np.cumsum(length[part])[:-1]])
            out[part[~bad]] = rep[part[~bad]]
    return out


def _binaries(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    ends, width = np.ascontiguousarray(ends, np.int64), flat.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends * width), pa.py_buffer(flat.tobytes())]).cast(pa.binary())


def _fetch(unit: Unit) -> Callable:
    """From (doc, text, runs): the text of each run, once for equal ones, with its places and its two leading 8-byte tokens from the anchor on."""

    def fetched(v, start, lo, n, off, ids):
        length = n + unit.window
        ends = np.r_[0, np.cumsum(length)]
        body = _gathered(v, start, length)
        rep = distinct(body, ends, off)
        order = np.lexsort((lo, ids, rep))
        edge = _edges(rep[order])
        head = order[edge[:-1]]  # the earliest place of each text
        places = np.zeros(len(ids), PLACE)
        places["doc"], places["lo"] = ids[order], lo[order]
        flat, size = _gathered(body, ends[head], length[head]), np.r_[0, np.cumsum(length[head])]
        lead = flat if unit.words else np.r_[flat, np.zeros(16, np.uint8)]
        first = size[:-1] + off[head]
        t = [lead[first], lead[first + 1]] if unit.words else [np.ascontiguousarray(lead[first[:, None] + np.arange(q, q + 8)]).view(">u8").ravel().astype("u8") for q in (0, 8)]
        t = [signed(x ^ np.uint64(1 << 63)) for x in t]
        several = np.diff(edge) > 1
        blobs = pa.array([places[i + 1 : j].tobytes() if more else None for i, j, more in zip(edge[:-1].tolist(), edge[1:].tolist(), several.tolist(), strict=True)], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(t[0]), pa.array(t[1]), pa.array(ids[head]), *(pa.array(x[head].astype("i4")) for x in (lo, n, off)), _binaries(flat, size), blobs], ["t0", "t1", "doc", "lo", "n", "off", "body", "more"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, (b, off) = batch.column(0).to_numpy(zero_copy_only=False), utf8(batch.column(1))
            lists = batch.column(2)
            flat, size = lists.flatten(), np.diff(lists.offsets.to_numpy())
            lo, n, a = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3))
            row = np.repeat(np.arange(len(size)), size)
            for i, j in groups(off, unit.fetch):
                here = slice(*np.searchsorted(row, [i, j]))
                if here.start == here.stop:
                    continue
                v, rows = unit.raw(b[off[i] : off[j]], off[i : j + 1] - off[i])
                start = rows[row[here] - i] + lo[here]
                cut = np.searchsorted(np.cumsum(n[here] + unit.window), np.arange(unit.fetch, int((n[here] + unit.window).sum()), unit.fetch))
                for x, y in zip(np.r_[0, cut], np.r_[cut, len(start)], strict=True):
                    if x < y:
                        part = slice(here.start + x, here.start + y)
                        yield fetched(v, start[x:y], lo[part], n[part], a[part], ids[row[part]])

    return task


FOUND = "bucket int, doc bigint, lo int, hi int, n int, blob binary"
OPEN = [("h0", "u8"), ("h1", "u8"), ("doc", "i8"), ("lo", "i4")]


def _found(rows: list[tuple]) -> pa.RecordBatch:
    """bucket, doc, lo, hi of spans; or bucket, n, blob of windows to be compared across buckets."""
    types = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], ["bucket", "doc", "lo", "hi", "n", "blob"])


def _range_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def _across(unit: Unit) -> Callable:
    """Windows that were new in their bucket, by hash: all but the first of each are spans too. Rows come bucket by bucket, and one is held at a time."""

    def closed(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        r = np.concatenate(parts)
        r = r[np.lexsort((r["lo"], r["doc"], r["h1"], r["h0"]))]
        first = np.r_[True, (r["h0"][1:] != r["h0"][:-1]) | (r["h1"][1:] != r["h1"][:-1])]
        head = r[np.flatnonzero(first)[np.cumsum(first) - 1]]
        r = r[(r["doc"] != head["doc"]) | (r["lo"] != head["lo"])]
        r = r[np.lexsort((r["lo"], r["doc"]))]
        if not len(r):
            return
        new = np.flatnonzero(np.r_[True, (r["doc"][1:] != r["doc"][:-1]) | (r["lo"][1:] > r["lo"][:-1] + unit.window)])
        stop = np.r_[new[1:], len(r)] - 1
        none = [None] * len(new)
        # windows that overlap or touch make one span: all between is covered
        yield _found([np.zeros(len(new), np.int32), r["doc"][new], r["lo"][new], r["lo"][stop] + np.int32(unit.window), none, none])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            spans = batch.filter(batch.column(5).is_null())
            if spans.num_rows:
                yield spans
            packed = batch.filter(batch.column(5).is_valid())
            for bucket, n, blob in zip(*(packed.column(k).to_pylist() for k in (0, 4, 5)), strict=True):
                if held and bucket != now:
                    yield from closed(held)
                    held = []
                now = bucket
                held.append(np.frombuffer(pa.decompress(blob, n * np.dtype(OPEN).itemsize, codec="zstd", asbytes=True), OPEN))
        if held:
            yield from closed(held)

    return task


def _flat(column: pa.ChunkedArray, order: np.ndarray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """Values of binaries in an order, and where each ends."""
    body = pa.concat_arrays([c.cast(pa.large_binary()) for c in column.chunks]).take(pa.array(order))
    _, o, data = body.buffers()
    ends = np.frombuffer(o, np.int64)[body.offset : body.offset + len(body) + 1]
    width = np.dtype(dtype).itemsize
    flat = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if ends[-1] > ends[0] else np.zeros(0, np.uint8)
    return np.ascontiguousarray(flat).view(dtype), (ends - ends[0]) // width


def compared(unit: Unit, kernel: Callable, t: pa.Table, buckets: int) -> Iterator[pa.RecordBatch]:
    """Spans of one bucket, and its open windows.

    kernel(flat, ends, off, n, doc, lo) gets different texts with their earliest places, in the order of the anchors' places, and returns for each
    window of each text whether it also occurs in the bucket at an earlier place.
    """
    t0, t1, doc, lo, n, off = (t.column(k).to_numpy() for k in range(6))
    order = np.lexsort((lo + off, doc))
    t0, t1, doc, lo, n, off = (x[order].astype(np.int64) for x in (t0, t1, doc, lo, n, off))
    flat, ends = _flat(t.column(6), order, np.uint64 if unit.words else np.uint8)
    more, more_ends = _flat(t.column(7).fill_null(b""), order, np.dtype(PLACE))
    rep = distinct(flat, ends, off)  # rows are in the order of places: the first of equal texts is the earliest
    head = np.flatnonzero(rep == np.arange(len(rep)))
    length = np.diff(ends)[head]
    flat, ends = _gathered(flat, ends[head], length), np.r_[0, np.cumsum(length)]
    # all other places of a text are later than its earliest one: what the text shows holds for all their windows
    owner = np.r_[rep, np.repeat(rep, np.diff(more_ends))]
    d, s = np.r_[doc, more["doc"]], np.r_[lo, more["lo"].astype(np.int64)]
    later = (d != doc[owner]) | (s != lo[owner])
    out_d, out_s, out_e = [d[later]], [s[later]], [s[later] + n[owner[later]] + unit.window]
    t0, t1, doc, lo, n, off = (x[head] for x in (t0, t1, doc, lo, n, off))
    seen = kernel(flat, ends, off, n, doc, lo)
    run = np.repeat(np.arange(len(n)), n + 1)
    j = np.arange(len(run)) - np.repeat(np.r_[0, np.cumsum(n + 1)][:-1], n + 1)
    at = np.flatnonzero(seen)
    if len(at):
        begin = np.flatnonzero(np.r_[True, (run[at][1:] != run[at][:-1]) | (at[1:] != at[:-1] + 1)])
        a, z = at[begin], at[np.r_[begin[1:], len(at)] - 1]
        out_d, out_s, out_e = [*out_d, doc[run[a]]], [*out_s, lo[run[a]] + j[a]], [*out_e, lo[run[a]] + j[z] + unit.window]
    d, s, e = map(np.concatenate, (out_d, out_s, out_e))
    # spans of a bucket that overlap are one: fewer rows travel
    order = np.lexsort((s, d))
    d, s, e = d[order], s[order], e[order]
    if len(d):
        _, inverse = np.unique(d, return_inverse=True)
        reach = np.maximum.accumulate(e + inverse * (1 << 32)) - inverse * (1 << 32)
        begin = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (s[1:] > reach[:-1])])
        d, s, e = d[begin], s[begin], reach[np.r_[begin[1:], len(reach)] - 1]
        none = [None] * len(d)
        yield _found([_range_of(mix(d.astype(np.uint64)), buckets), d, s.astype("i4"), e.astype("i4"), none, none])
    # k-grams that may go on in another bucket: those of the smallest and the largest leading tokens
    ranked = np.lexsort((t1, t0))
    touch = np.zeros(len(n), bool)
    for x in (ranked[0], ranked[-1]):
        touch |= (t0 == t0[x]) & (t1 == t1[x])
    free = np.flatnonzero(~seen & touch[run])
    r = np.zeros(len(free), OPEN)
    from_ = ends[run[free]] + j[free]
    for i, k in groups(ends, AT_ONCE):
        x, y = np.searchsorted(run[free], [i, k])
        if x < y:
            part, at = flat[ends[i] : ends[k]], from_[x:y] - ends[i]
            values = part if unit.words else byte_values(part)
            r["h0"][x:y], r["h1"][x:y] = Rolling(values).spans(at, at + unit.window), Rolling(mix(values + np.uint64(1))).spans(at, at + unit.window)
    r["doc"], r["lo"] = doc[run[free]], lo[run[free]] + j[free]
    to = _range_of(r["h0"], buckets)
    order = np.argsort(to, kind="stable")
    r, to = r[order], to[order]
    edge = _edges(to)
    blobs = [pa.compress(r[i:k].tobytes(), codec="zstd", asbytes=True) for i, k in zip(edge[:-1], edge[1:], strict=True)]
    if blobs:
        none = [None] * len(blobs)
        yield _found([to[edge[:-1]], none, none, none, np.diff(edge).astype("i4"), blobs])


def _bucketed(unit: Unit, kernel: Callable, buckets: int) -> Callable:
    """Rows come in the order of leading tokens; they are cut into buckets where the tokens change, or at twice the size, and one bucket is held at a time."""

    def tokens(t: pa.RecordBatch | pa.Table) -> int:
        return (pc.sum(t.column(4)).as_py() or 0) + t.num_rows * unit.window

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += tokens(batch)
            while size >= unit.bucket:
                t = pa.Table.from_batches(held)
                t0, t1 = t.column(0).to_numpy(), t.column(1).to_numpy()
                change = np.flatnonzero((t0[1:] != t0[:-1]) | (t1[1:] != t1[:-1])) + 1
                if not len(change) and size < 2 * unit.bucket:
                    break
                cut = int(change[-1]) if len(change) else t.num_rows
                yield from compared(unit, kernel, t.slice(0, cut), buckets)
                rest = t.slice(cut)
                held, size = rest.to_batches(), tokens(rest)
        if size:
            yield from compared(unit, kernel, pa.Table.from_batches(held), buckets)

    return task


def repeated_spans(docs: DataFrame, unit: Unit, kernel: Callable, placed: DataFrame) -> DataFrame:
    """(doc, spans array<struct<lo, hi>>): token ranges of each document whose windows also start earlier. docs: (doc, text); placed: docs, partitioned by doc."""
    small_batches(docs.sparkSession)
    parts, buckets = partitions_for(docs, 4 << 20), 4 * pieces_of(docs, 4 << 20)
    slim = docs.mapInArrow(freed(_local(unit, buckets)), SLIM)
    merged = written(slim.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(freed(_merge), PLACES))
    wanted = merged.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("lo", "n", "off"))).alias("runs"))
    columns = ["doc", "text", "runs", *(c for c in placed.columns if c not in ("doc", "text"))]
    texts = placed.join(wanted.hint("merge"), "doc").select(*columns).mapInArrow(freed(_fetch(unit)), TEXTS)
    texts = texts.repartitionByRange(parts, "t0", "t1", "doc", "lo").sortWithinPartitions("t0", "t1", "doc", "lo")
    found = texts.mapInArrow(freed(_bucketed(unit, kernel, buckets)), FOUND)
    found = found.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(freed(_across(unit)), FOUND)
    return found.groupBy("doc").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


def kept_mask(length: int, spans) -> np.ndarray:
    """Which tokens stay of a document of this length. spans: arrays of starts and ends."""
    d = np.bincount(np.minimum(spans[0], length), minlength=length + 1) - np.bincount(np.minimum(spans[1], length), minlength=length + 1)
    return np.cumsum(d[:-1]) == 0


NO_ID = -(1 << 63)


def place(docs: DataFrame, *more: Column) -> tuple[DataFrame, DataFrame]:
    """(doc, text) of documents as they are read, and the same with more columns dealt by document, an exchange that two later joins share. A null doc_id sorts before all others; rows that repeat a doc_id are one document."""
    d = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)
    return d.select("doc", "text"), d.repartition(partitions_for(docs, 4 << 20), "doc")


def first_seen(key: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether each key has occurred before; keys are in the order of places, and equal places do not count as before."""
    _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
    return place[first[inverse]] != place


def row_spans(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets of the rows, starts and ends of a column of spans (null: none)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat, size = column.flatten(), column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.r_[0, np.cumsum(size)], *(flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
