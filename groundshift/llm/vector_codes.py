"""Product codes of vectors: eight parts, sixteen codebook entries a part, all arithmetic in whole numbers.

LAESA: a few fixed pivots of each part position have their distances to every vector's part computed once and kept in the written table. In each
round the distances from pivots to the current entries (a handful of numbers) bound every part-to-entry distance from below by the triangle inequality. Entries are
taken in the order of their bounds, exact squared distances are computed for the parts whose bound does not exceed the best so far, and
a part is done when its next bound does. Bounds are lowered by more than the rounding of the kept distances, so no nearest entry and no tie is missed.

A round is one pass over the table: tasks send the sums of each entry (a number for each component), and Spark adds them. What the driver holds is the codebook.

Definite results: vectors that are null or hold a null, a NaN or an infinity are dropped; components beyond 65,536 count as that; vectors are padded with
zeros at their end to the longest length and a multiple of eight; fewer kept vectors than entries give fewer entries (none give an empty result);
of equal vec_ids the smaller vector comes first, null vec_ids come last and stay null; repeated rows count and come back as often as they occur; ties of
distance go to the lower index; other columns play no part, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundshift.llm.shared import small_batches, written

PARTS, ENTRIES, ROUNDS, PIVOTS = 8, 16, 6, 4
SCALE, LIMIT = 4096, 1 << 28
#: By how much of the distances that it is made from a bound is lowered: more than float32 rounds them by.
SLACK = 1e-6
#: Labels whose sums are sent to all tasks; beyond it the sums are joined with salted rows.
BROADCAST_LABELS, SALTS = 100_000, 32
#: Rows that are compared at once.
ROWS = 4096


def kept(vectors: DataFrame) -> DataFrame:
    """vec_id, label, x: whole numbers, of the vectors that count."""
    e = F.col("embedding")
    finite = F.coalesce(F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))
    whole = F.transform(e.cast("array<double>"), lambda x: F.greatest(F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)), F.floor(x * SCALE).cast("double"))).cast("int"))
    return vectors.where(finite).select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("string").alias("label"), whole.alias("x"))


def _lists(col: pa.Array) -> np.ndarray:
    """Rows of a list column, all of one length."""
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1).astype(np.int64) if len(col) else np.zeros((0, 0), np.int64)


def pivots_of(book: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """For each part the places of n entries far from each other; the first entry is one."""
    out = []
    for entries in book:
        far, chosen = np.full(len(entries), np.inf), [0]
        while len(chosen) < min(n, len(entries)):
            far = np.minimum(far, ((entries - entries[chosen[-1]]).astype(float) ** 2).sum(1))
            chosen.append(int(far.argmax()))
        out.append(chosen)
    return np.array(out)


def nearest(x: np.ndarray, to_pivot: np.ndarray, entries: np.ndarray, pivot_entry: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entry of each row of x, its squared distance, and how many distances were evaluated for it.

    to_pivot: distances of the rows to the pivots; pivot_entry: of the pivots to the entries.
    """
    n, k = len(x), len(entries)
    bound = np.zeros((n, k))
    for p in range(pivot_entry.shape[0]):
        a, b = to_pivot[:, p, None].astype(float), pivot_entry[p][None, :]
        np.maximum(bound, np.abs(a - b) - SLACK * (a + b), out=bound)
    order = np.argsort(bound, 1, kind="stable")
    best, code, evaluated, live = np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int64), np.zeros(n, np.int32), np.arange(n)
    for step in range(k):
        e = order[live, step]
        if step:
            stays = bound[live, e] <= np.sqrt(best[live].astype(float)) * (1 + SLACK)
            live, e = live[stays], e[stays]
        if not len(live):
            break
        evaluated[live] += 1
        d = ((x[live] - entries[e]) ** 2).sum(1)
        better = (d < best[live]) | ((d == best[live]) & (e < code[live]))
        best[live[better]], code[live[better]] = d[better], e[better]
    return code, best, evaluated


class Codebook:
    """Entries of all parts (part, entry, component), and the distances from the fixed pivots to them."""

    def __init__(self, entries: np.ndarray, pivots: np.ndarray):
        self.entries, self.pivots = entries, pivots
        gap = (pivots[:, :, None, :] - entries[:, None, :, :]).astype(float)
        self.to_pivots = np.sqrt((gap**2).sum(3))

    def codes(self, x: np.ndarray, to_pivot: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each part: its number, the codes of the rows, their squared distances, distances evaluated."""
        for p, entries in enumerate(self.entries):
            yield p, *nearest(x[:, p], to_pivot[:, p], entries, self.to_pivots[p])

    def moved(self, sums: dict[tuple[int, int], tuple[int, list[int]]]) -> Codebook:
        """Each used entry at the floor of the mean of its parts."""
        entries = self.entries.copy()
        for (p, e), (n, total) in sums.items():
            entries[p, e] = [t // n for t in total]
        return Codebook(entries, self.pivots)

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _prepared(table: DataFrame, pivots: np.ndarray) -> DataFrame:
    """table with the distances to the pivots, once."""
    parts, count, wide = pivots.shape

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _lists(batch.column(2)).reshape(-1, parts, 1, wide)
            far = np.sqrt(((x - pivots[None]) ** 2).sum(3).astype(float)).astype(np.float32).reshape(batch.num_rows, -1)
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * (parts * count))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(ends, pa.array(far.ravel()))], ["vec_id", "label", "x", "far"])

    return table.mapInArrow(task, "vec_id bigint, label string, x array<int>, far array<float>")


def _pieces(batch: pa.RecordBatch, book: Codebook) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """A batch in pieces: its rows, their components by part, their distances to the pivots by part."""
    parts, _, wide = book.entries.shape
    for i in range(0, batch.num_rows, ROWS):
        some = batch.slice(i, ROWS)
        far = some.column("far").flatten().to_numpy(zero_copy_only=False).reshape(some.num_rows, parts, -1)
        yield some, _lists(some.column("x")).reshape(-1, parts, wide), far


def _sums(table: DataFrame, book: Codebook) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """By part and entry: how many parts are nearest to it, and the sums of their components."""
    shape = book.entries.shape

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(shape, np.int64), np.zeros(shape[:2], np.int64)
        for batch in batches:
            for _, x, far in _pieces(batch, book):
                for p, code, _, _ in book.codes(x, far):
                    count[p] += np.bincount(code, minlength=shape[1])
                    np.add.at(total[p], code, x[:, p])
        p, e, c = (a.ravel() for a in np.indices(shape))
        used = np.repeat(count.ravel() > 0, shape[2])
        cols = (p, e, c, np.repeat(count.ravel(), shape[2]), total.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(v[used].astype(np.int64)) for v in cols], ["part", "entry", "place", "n", "total"])

    rows = table.select("x", "far").mapInArrow(task, "part bigint, entry bigint, place bigint, n bigint, total bigint").groupBy("part", "entry", "place")
    out: dict[tuple[int, int], tuple[int, list[int]]] = {}
    for r in sorted(rows.agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()):  # as many rows as the codebook has numbers
        out.setdefault((r["part"], r["entry"]), (r["n"], []))[1].append(r["total"])
    return out


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebook | None]:
    """The kept vectors as a written table with their distances to the pivots, and the codebook after all rounds."""
    small_batches(vectors.sparkSession)
    whole = kept(vectors)
    longest = whole.agg(F.max(F.size("x"))).first()[0]
    if longest is None:
        return whole, None
    wide = max(1, -(-longest // parts))
    padded = whole.withColumn("x", F.concat("x", F.array_repeat(F.lit(0), F.lit(parts * wide) - F.size("x"))))
    first = padded.where(F.col("vec_id").isNotNull()).orderBy("vec_id", "x").limit(entries).select("x").collect()
    if len(first) < entries:
        first += padded.where(F.col("vec_id").isNull()).orderBy("x").limit(entries - len(first)).select("x").collect()
    start = np.array([r["x"] for r in first], np.int64).reshape(len(first), parts, wide).transpose(1, 0, 2)
    pivots = np.stack([start[p][at] for p, at in enumerate(pivots_of(start))])
    table, book = written(_prepared(padded, pivots)), Codebook(start, pivots)
    for _ in range(rounds):
        book = book.moved(_sums(table, book))
    return table, book


def encoded(table: DataFrame, book: Codebook) -> DataFrame:
    """vec_id, label, code (a byte for each part), error, evaluated (exact distances that were needed)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, x, far in _pieces(batch, book):
                code, error, evaluated = np.zeros((len(x), len(book.entries)), np.uint8), np.zeros(len(x), np.int64), np.zeros(len(x), np.int32)
                for p, c, d, k in book.codes(x, far):
                    code[:, p], error, evaluated = c, error + d, evaluated + k
                columns = [some.column("vec_id"), some.column("label"), pa.array([r.tobytes() for r in code], pa.binary()), pa.array(error), pa.array(evaluated)]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error", "evaluated"])

    return table.mapInArrow(task, "vec_id bigint, label string, code binary, error bigint, evaluated int")


def with_label_error(codes: DataFrame) -> DataFrame:
    """codes with label_error, the sum of error over rows of an equal label, nulls together."""
    sums = written(codes.groupBy("label").agg(F.sum("error").alias("label_error")))
    if sums.count() <= BROADCAST_LABELS:
        return codes.join(F.broadcast(sums.withColumnRenamed("label", "other")), F.col("label").eqNullSafe(F.col("other"))).drop("other")
    sums = sums.select(F.col("label").alias("other"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("place"))
    salted = codes.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    return salted.join(sums, F.col("label").eqNullSafe(F.col("other")) & (F.col("salt") == F.col("place"))).drop("other", "salt", "place")


def compressed(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256."""
    table, book = train(vectors)
    if book is None:
        return table.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"), F.lit(0).cast("bigint").alias("label_error"), F.lit("").alias("codebooks_sha256")).limit(0)
    out = with_label_error(written(encoded(table, book)))
    return out.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(book.digest()).alias("codebooks_sha256"))


def _sql() -> str:
    """The rounds written out one after another."""
    place = f"part * w + 1 : part * w + w"
    steps = [
        "v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 4096) AS BIGINT)) AS x FROM embeddings "
        "WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"q AS (SELECT vec_id, part, x[{place}] AS x FROM (SELECT *, CAST(len(x) / 8 AS BIGINT) AS w FROM v), range(0, 8) AS r(part))",
        "b0 AS (SELECT part, i - 1 AS entry, x AS c FROM q JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS i FROM v) USING (vec_id) WHERE i <= 16)",
    ]
    near = "SELECT vec_id, q.part, any_value(x) AS x, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (SELECT vec_id, q.part, x, entry, CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d FROM q JOIN b{k} b ON q.part = b.part) q GROUP BY vec_id, q.part"
    for k in range(ROUNDS):
        steps.append(f"a{k} AS ({near.format(k=k)})")
        steps.append(f"m{k} AS (SELECT part, entry, list(c ORDER BY i) AS c FROM (SELECT part, entry, i, CAST(floor(CAST(sum(x[i]) AS DOUBLE) / count(*)) AS BIGINT) AS c FROM a{k}, range(1, (SELECT max(len(x)) FROM q) + 1) AS r(i) GROUP BY part, entry, i) GROUP BY part, entry)")
        steps.append(f"b{k + 1} AS (SELECT b.part, b.entry, coalesce(m.c, b.c) AS c FROM b{k} b LEFT JOIN m{k} m ON b.part = m.part AND b.entry = m.entry)")
    steps.append(f"z AS ({near.format(k=ROUNDS)})")
    steps.append("e AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM z GROUP BY vec_id)")
    steps.append(f"s AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{ROUNDS})")
    return "WITH " + ",\n".join(steps) + "\nSELECT e.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM e JOIN v USING (vec_id), s"


SQL = _sql()
