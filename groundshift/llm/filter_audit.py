"""What five text filters remove, in every order, and how they overlap.

Each text is read once by a byte transducer: its state is the class of the byte before, its table gives for each state and each
class of byte what is counted (a code point, a capital, a symbol) and whether a word begins or ended. As the next state is the class of the
byte read, the pass is one lookup for each byte, whatever its place. Word spans go into an open-addressing hash table of a group of texts; a span
that meets an entry of the same document is compared with it byte by byte, so distinct words are exact.

Equal texts are found by their SHA-256. A document is then a pattern of five failures, and all that the orders need is how many documents of
each part have each of the 32 patterns: the table of 120 orders is computed from those numbers.

Definite results: null and empty texts hold no words and are equal to each other; very long texts are read whole; a repeated row (equal
doc_id and text) counts as often as it comes and is no copy of itself; a row without doc_id has no smaller doc_id and no labels; a null source and a source of no characters are
one part; of several labels of a document any 1 counts; an empty table gives an empty result; other columns play no part, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundshift.llm.shared import Rolling, byte_values, groups, small_batches, utf8

FILTERS = "ABCDE"
#: Bounds of the filters: least words, least percentage of distinct words, most percentage of capitals.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 2
SYMBOLS = b"#$%&*|"
#: Classes of bytes, which are also the states of the transducer.
SPACE, PLAIN, CAPITAL, SYMBOL, TRAIL = range(5)
#: What a step may report, as bits.
POINT, UPPER, MARK, BEGIN, END = 1, 2, 4, 8, 16
#: Bytes of text that share a hash table.
GROUP = 1 << 19


def _classes() -> np.ndarray:
    t = np.full(256, PLAIN, np.uint8)
    t[[0x20, *range(0x09, 0x0E)]] = SPACE
    t[65:91] = CAPITAL
    t[list(SYMBOLS)] = SYMBOL
    t[0x80:0xC0] = TRAIL
    return t


def _reports() -> np.ndarray:
    """Row: state (the class before), column: class of the byte."""
    t = np.zeros((5, 5), np.uint8)
    t[:, [SPACE, PLAIN, CAPITAL, SYMBOL]] |= POINT
    t[:, CAPITAL] |= UPPER
    t[:, SYMBOL] |= MARK
    t[SPACE, 1:] |= BEGIN
    t[1:, SPACE] |= END
    return t


CLASS, REPORT = _classes(), _reports()


def transduced(b: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The report of each byte; each text begins in the state SPACE."""
    now = CLASS[b]
    state = np.empty_like(now)
    state[1:] = now[:-1]
    state[offsets[:-1][offsets[:-1] < len(b)]] = SPACE
    return REPORT.ravel()[state * np.uint8(5) + now]


def _eights(b: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one word (zeros follow the end)."""
    padded = np.zeros(len(b) + 8, np.uint8)
    padded[: len(b)] = b
    return np.lib.stride_tricks.as_strided(padded, (len(b), 8), (1, 1))


def equal_spans(b8: np.ndarray, at: np.ndarray, to: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the size bytes from at equal those from to; all spans by eight bytes a round."""
    same, done = np.ones(len(at), bool), 0
    live = np.flatnonzero(size > 0)
    while len(live):
        x, y = (np.ascontiguousarray(b8[p[live] + done]).view(np.uint64).ravel() for p in (at, to))
        left = np.minimum(size[live] - done, 8).astype(np.uint64)
        same[live] &= ((x ^ y) << (np.uint64(64) - np.uint64(8) * left)) == 0
        done += 8
        live = live[same[live] & (size[live] > done)]
    return same


def first_of_each(b: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Spans that are entered: one for each distinct (row, bytes). A table of at least twice as many places takes each span at its hash's place or the next free one."""
    if not len(start):
        return np.zeros(0, np.int64)
    places = 1 << int(2 * len(start) - 1).bit_length()
    table = np.full(places, -1, np.int64)
    slot = ((hashes + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(7)).astype(np.int64) & (places - 1)
    b8, size, live, entered = _eights(b), end - start, np.arange(len(start)), []
    while len(live):
        s = slot[live]
        free = table[s] < 0
        table[s[free]] = live[free]
        met = table[s]
        mine = met == live
        entered.append(live[mine])
        equal = ~mine & (row[met] == row[live]) & (size[met] == size[live])
        at = np.flatnonzero(equal)
        equal[at] = equal_spans(b8, start[live[at]], start[met[at]], size[live[at]])
        live = live[~mine & ~equal]
        slot[live] = (slot[live] + 1) & (places - 1)
    return np.concatenate(entered)


def _hashed(b: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return Rolling(byte_values(b)).spans(start, end)


def text_measures(b: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Words, distinct words, capitals, code points and symbols of each text."""
    rows = len(offsets) - 1
    out = np.zeros((rows, 5), np.int64)
    if not len(b):
        return out
    report = transduced(b, offsets)
    start = np.flatnonzero(report & BEGIN)
    stop = np.flatnonzero(report & END)
    row = np.searchsorted(offsets, start, "right") - 1
    # a word ends at the next blank or at the end of its text
    ends = np.append(stop, len(b))
    end = np.minimum(ends[np.searchsorted(stop, start)], offsets[row + 1])
    out[:, 0] = np.bincount(row, minlength=rows)
    out[:, 1] = np.bincount(row[first_of_each(b, start, end, row, _hashed(b, start, end))], minlength=rows)
    for k, bit in ((2, UPPER), (3, POINT), (4, MARK)):
        total = np.concatenate([[0], np.cumsum((report & bit) != 0)])
        out[:, k] = total[offsets[1:]] - total[offsets[:-1]]
    return out


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        b, off = utf8(batch.column(2))
        for i, j in groups(off, GROUP):
            own = b[off[i] : off[j]]
            m = text_measures(own, off[i : j + 1] - off[i])
            sha = [hashlib.sha256(own[x - off[i] : y - off[i]].data).digest() for x, y in zip(off[i:j], off[i + 1 : j + 1], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(sha, pa.binary()), *(pa.array(m[:, k]) for k in range(5))],
                ["doc_id", "part", "digest", "n_words", "n_distinct", "n_capitals", "n_points", "n_symbols"],
            )


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest of the text and its measures."""
    small_batches(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(_measured, "doc_id bigint, part string, digest binary, n_words bigint, n_distinct bigint, n_capitals bigint, n_points bigint, n_symbols bigint")


def patterns(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, pattern (a bit for each filter that a document fails), n, good, toxic: numbers of documents.

    Whether a text has an earlier copy is told from groups of equal texts: all their documents fail E but those of the least doc_id.
    """
    fails = {"A": F.col("n_words") < LEAST_WORDS, "B": 100 * F.col("n_distinct") < LEAST_DISTINCT * F.col("n_words"), "C": 100 * F.col("n_capitals") > MOST_CAPITALS * F.col("n_points"), "D": F.col("n_symbols") > 0}
    bits = sum((F.when(x, F.lit(1 << FILTERS.index(k))).otherwise(F.lit(0)) for k, x in fails.items()), F.lit(0))
    rows = measured(docs).withColumn("bits", bits).groupBy("doc_id", "part", "digest", "bits").agg(F.count(F.lit(1)).alias("n"))
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    known = known.agg(*(F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(f"is_{c}") for c in ("quality", "toxic")))
    rows = rows.join(known, "doc_id", "left").na.fill(0, ["is_quality", "is_toxic"])
    # rows of one text in one part with the same labels; 'at_least' are those of its least doc_id
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    alike = rows.groupBy("digest", "bits", "part", "is_quality", "is_toxic").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNotNull(), F.col("n")).otherwise(0)).alias("numbered"), F.max("doc_id").alias("last"), least.alias("least"))
    # a doc_id may hold the same text in several parts: its rows are copies of none
    first = alike.groupBy("digest").agg(F.min("least.doc_id").alias("first"), F.max("last").alias("last"))
    first = first.where(F.col("first") < F.col("last")).select("digest", "first")
    copies = F.when(F.col("first").isNull(), F.lit(0)).otherwise(F.col("numbered") - F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0))
    told = alike.join(first, "digest", "left").withColumn("copies", copies)
    e = 1 << FILTERS.index("E")
    both = F.explode(F.array(F.struct(F.col("bits").alias("pattern"), (F.col("n") - F.col("copies")).alias("k")), F.struct((F.col("bits") + e).alias("pattern"), F.col("copies").alias("k"))))
    told = told.select("part", "is_quality", "is_toxic", both.alias("x")).where("x.k > 0")
    return told.groupBy("part", F.col("x.pattern").alias("pattern")).agg(F.sum("x.k").alias("n"), F.sum(F.col("x.k") * F.col("is_quality")).alias("good"), F.sum(F.col("x.k") * F.col("is_toxic")).alias("toxic"))


def _steps() -> list[tuple[str, int, int, int]]:
    """filter_order, step, the filters before as a mask, its own bit: all orders of the five."""
    out = []
    for order in permutations(FILTERS):
        mask = 0
        for k, f in enumerate(order):
            bit = 1 << FILTERS.index(f)
            out.append(("".join(order), k + 1, mask, bit))
            mask |= bit
    return out


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    count = lambda c, k: F.coalesce(F.sum(F.when(F.col("pattern") == k, F.col(c))), F.lit(0)).cast("bigint")
    size = 1 << len(FILTERS)
    parts = patterns(docs, labels).groupBy("part").agg(*(F.array(*(count(c, k) for k in range(size))).alias(c) for c in ("n", "good", "toxic")))
    steps = F.from_json(F.lit("[" + ",".join(f'{{"o":"{o}","s":{s},"m":{m},"b":{b}}}' for o, s, m, b in _steps()) + "]"), "array<struct<o:string,s:int,m:int,b:int>>")
    each = parts.withColumn("x", F.explode(steps)).select("*", F.col("x.o").alias("filter_order"), F.col("x.s").alias("step"), F.col("x.m").alias("before"), F.col("x.b").alias("own"))

    def total(c: str, holds) -> Column:
        picked = F.transform(F.col(c), lambda x, i: F.when(holds(i.cast("int")), x).otherwise(F.lit(0).cast("bigint")))
        return F.aggregate(picked, F.lit(0).cast("bigint"), lambda a, x: a + x)

    before, own = F.col("before"), F.col("own")
    met = lambda i: (i.bitwiseAND(own) != 0) & (i.bitwiseAND(before) == 0)
    # of the orders, the filter is the first of a pattern's failures in one out of as many as there are failures
    orders = len(list(permutations(FILTERS)))
    share = F.transform(F.col("n"), lambda x, i: F.when(i.cast("int").bitwiseAND(own) != 0, (x * orders / F.bit_count(i)).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return each.select(
        "part",
        "filter_order",
        "step",
        total("n", lambda i: i.bitwiseAND(before.bitwiseOR(own)) == 0).alias("kept"),
        total("n", met).alias("removed"),
        total("n", lambda i: (i.bitwiseAND(own) != 0) & (i.bitwiseAND(before) != 0)).alias("redundant"),
        total("n", lambda i: i == own).alias("unique_fails"),
        total("good", met).alias("good_lost"),
        total("toxic", met).alias("toxic_lost"),
        F.aggregate(share, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("shapley"),
    )


_WORDS = "list_filter(regexp_split_to_array(t, '[ \\t-\\r]+'), lambda x: x <> '')"
SQL = f"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, {_WORDS} AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM t),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS q, max(CAST(toxic = 1 AS INT)) AS x FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(q, 0) AS q, coalesce(x, 0) AS x,
             len(w) < {LEAST_WORDS} AS "A", 100 * len(list_distinct(w)) < {LEAST_DISTINCT} * len(w) AS "B",
             100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > {MOST_CAPITALS} * length(t) AS "C",
             regexp_matches(t, '[#$%&*|]') AS "D", coalesce(doc_id > first, false) AS "E" FROM w LEFT JOIN l USING (doc_id)),
p AS (SELECT part, CAST("A" AS INT) + 2 * CAST("B" AS INT) + 4 * CAST("C" AS INT) + 8 * CAST("D" AS INT) + 16 * CAST("E" AS INT) AS k,
             count(*) AS n, sum(q) AS good, sum(x) AS toxic FROM f GROUP BY 1, 2),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS b),
o AS (SELECT v.c || w.c || x.c || y.c || z.c AS filter_order, [v.b, w.b, x.b, y.b, z.b] AS bits FROM letter v, letter w, letter x, letter y, letter z
      WHERE v.b + w.b + x.b + y.b + z.b = 31 AND v.b | w.b | x.b | y.b | z.b = 31),
s AS (SELECT filter_order, i AS step, bits[i] AS own, CAST(list_sum(bits[1:i]) AS INT) - bits[i] AS before FROM o, range(1, 6) AS r(i)),
r AS (SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (k & (before | own) = 0), 0) AS kept,
             coalesce(sum(n) FILTER (k & own <> 0 AND k & before = 0), 0) AS removed, coalesce(sum(n) FILTER (k & own <> 0 AND k & before <> 0), 0) AS redundant,
             coalesce(sum(n) FILTER (k = own), 0) AS unique_fails, coalesce(sum(good) FILTER (k & own <> 0 AND k & before = 0), 0) AS good_lost,
             coalesce(sum(toxic) FILTER (k & own <> 0 AND k & before = 0), 0) AS toxic_lost FROM p, s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r
"""
