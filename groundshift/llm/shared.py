"""What several operators of this subpackage need: table access, UTF-8 views of Arrow columns, rolling hashes."""

from __future__ import annotations

import ctypes
import math
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import groundshift
from groundshift.operators.components import written  # noqa: F401  shared by all that cut lineage

#: Rows of one Arrow batch. Texts can be long; a batch stays a few megabytes.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a session: their Python need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(groundshift.__file__).parent
    at = Path(tempfile.mkdtemp()) / "groundshift.zip"
    with zipfile.ZipFile(at, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(str(at))
    _shipped.add(context.applicationId)


def small_batches(spark: SparkSession) -> None:
    """What Arrow tasks of this subpackage need of the session."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


_kept: dict[str, object] = {}
_asked: set[str] = set()


def kept(key: str, make: Callable):
    """What a worker keeps for later tasks that ask for it too. It goes with the first freed() task that does not."""
    _asked.add(key)
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]


def freed(task: Callable) -> Callable:
    """A task over Arrow batches that gives its memory back to the system when it ends, with what a worker kept and the task did not ask for:
    workers live on, and what one stage took would stay with them through all later ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            for key in _kept.keys() - _asked:
                del _kept[key]
            _asked.clear()
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return run


def pieces_of(df: DataFrame, bytes_each: int) -> int:
    """Into how many pieces of this size df's volume goes by Catalyst's estimate; the session's shuffle partitions at least."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # no classic plan, as over Spark Connect
        return n
    return max(n, min(1 << 28, math.ceil(size / bytes_each))) if size < 1 << 60 else n


def partitions_for(df: DataFrame, bytes_each: int = 8 << 20) -> int:
    """Partitions of a shuffle of df's volume. Their number is what a driver can follow; beyond it partitions grow, so what
    works on them goes through a partition piece by piece."""
    return min(pieces_of(df, bytes_each), 100_000)


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its offsets (one more than rows); null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    _, off, data = col.buffers()
    o = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1] if off else np.zeros(1, np.int64)
    b = np.frombuffer(data, np.uint8)[o[0] : o[-1]] if data and len(o) and o[-1] > o[0] else np.zeros(0, np.uint8)
    return b, o - o[0]


def groups(offsets: np.ndarray, target: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) of about target bytes; a longer row is alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + target, "right")) - 1)
        yield i, min(j, n)
        i = j


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h *= _M1
    h ^= h >> np.uint64(27)
    h *= _M2
    return h ^ (h >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


#: Powers that a worker keeps: workers live through all stages, and what they keep counts in each of them.
KEPT_POWERS = 1 << 20


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64. More than KEPT_POWERS are made anew and not kept."""
    if len(_powers[0]) < n:
        made = []
        for x in (_BASE, _INVERSE):
            a = np.full(max(n, KEPT_POWERS), x, np.uint64)
            a[0] = 1
            made.append(np.multiply.accumulate(a, out=a))
        if n > KEPT_POWERS:
            return made[0], made[1]
        _powers[:] = made
    return _powers[0][:n], _powers[1][:n]


class Rolling:
    """Hashes of any spans of a sequence of 64-bit values, by prefix sums."""

    def __init__(self, v: np.ndarray):
        up, self.down = powers(len(v) + 1)
        self.sums = np.zeros(len(v) + 1, np.uint64)
        np.cumsum(v * up[: len(v)], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def grams(self, k: int) -> np.ndarray:
        """Of the k values from each position on."""
        return mix((self.sums[k:] - self.sums[:-k]) * self.down[: len(self.sums) - k])


def byte_values(b: np.ndarray) -> np.ndarray:
    return _BYTE[b]


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_spans(b: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word ``[^\\x20\\x09-\\x0D]+`` in the bytes, and for each row the index of its first word (one more at the end)."""
    inside = ~_SPACE[b]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = offsets[(offsets > 0) & (offsets < len(b))]
    first[cut] |= inside[cut]
    start = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, offsets)


def words(b: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, and for each row the index of its first word (one more at the end)."""
    start, end, rows = word_spans(b, offsets)
    return Rolling(byte_values(b)).spans(start, end) if len(start) else np.zeros(0, np.uint64), rows


def signed(h: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(h).view(np.int64)


def text_or_empty(c: str = "text"):
    return F.coalesce(F.col(c).cast("string"), F.lit(""))
