"""Near-duplicate classes by BagMinHash signatures of weighted shingles.

A text is the multiset of its five-word shingles. Each shingle carries Poisson processes over its discretised weight: levels
(0, 1], (1, 2], (2, 4], (4, 8] and so on have a process each, of a rate as wide as the level; points of the level that holds the
weight count if their place in it is below the weight. A point falls into one of the signature's slots, and a slot keeps its
earliest point, so two slots are equal with the weighted Jaccard similarity as probability. A horizon that lets all slots fill is
tried first and doubled where it does not.

Texts with equal multisets are one node. Signatures are cut into bands; nodes that share a band's key are candidates, and pairs
are verified by the overlap of their multisets, kept as 32-bit hashes (bags of 20,000 words that share nothing seem to share a tenth of an element). Each
node is first tried with its smallest partner, then with the smallest of each shared key, and at last all pairs of a key that are still in
different classes are tried, block of rows by block of rows, unless sketches of their signatures differ too much (a pair of similarity 0.8
does so with probability 2e-8). Of a key with more members than a block the blocks meet by their sketches alone, and the pairs that these leave are verified; both ways try the
same pairs. Pairs within a class that is already known are never made, and there is no cap on partners. A pair of
similarity 0.8 shares no band with probability 5e-6. Hot keys are salted wherever rows meet by key.

Definite results: texts of one to four words are one shingle; null texts and texts without words are classes of their own; very long texts are compared
whole; of a class's members the least doc_id names it, so ties cannot arise; a null doc_id has a null class; repeated rows get equal classes; an
empty table gives an empty result; other columns play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundshift.llm.shared import Rolling, freed, groups, mix, partitions_for, signed, small_batches, utf8, words, written
from groundshift.operators.components import components, unsent

WORDS, SIMILAR, BANDS, BAND_ROWS = 5, 0.8, 40, 6
SLOTS = BANDS * BAND_ROWS
#: Rows of a key in one block; a task compares two blocks at a time.
BLOCK = 1024
#: A key with more than this share of all rows is hot (so there are at most as many hot keys as one over it), and is dealt to so many places.
HOT, SALTS = 1e-3, 64
#: Bytes of text whose signatures are made at once, and rows of a partition whose units are compared.
GROUP = 1 << 18
UNIT_ROWS = 20_000
#: Words of a sketch (two bits a slot), and bits that may differ: 5.5 standard deviations above the mean of a pair of similarity 0.8.
SKETCH = 8
APART = int(SLOTS * (1 - SIMILAR) + 5.5 * (SLOTS * (1 - SIMILAR) * (0.5 + SIMILAR)) ** 0.5)
_U = np.uint64


def shingles(b: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and count of each distinct shingle, by row; rows without words have none."""
    v, first = words(b, offsets)
    n = np.diff(first)
    if not len(v):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(n)), n)
    left = first[1:][row] - np.arange(len(v))
    start = np.flatnonzero((left >= WORDS) | ((left == n[row]) & (left < WORDS)))
    h = Rolling(v).spans(start, np.minimum(start + WORDS, first[1:][row[start]]))
    row = row[start]
    key = mix(h + row.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
    ordered = np.sort(key)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    count = np.ones(len(h), np.int64)
    if len(twice):
        at = np.flatnonzero(np.isin(key, twice))
        _, lead, k = np.unique(key[at], return_index=True, return_counts=True)
        keep = np.ones(len(h), bool)
        keep[at] = False
        keep[at[lead]] = True
        count[at[lead]] = k
        row, h, count = row[keep], h[keep], count[keep]
    return row, h, count


def _uniform(seed: np.ndarray, j) -> np.ndarray:
    """In (0, 1], from the seed of a process and a point's number."""
    return ((mix(seed + _U(0xA24BAED4963EE407) * np.asarray(j, np.uint64)) >> _U(11)).astype(np.float64) + 1) / (1 << 53)


def _points(seed, rate, low, weight, row, horizon, sig, slots):
    """Lower the signatures by all points of the processes up to their rows' horizons."""

    def put(seed, j, t, low, rate, weight, row):
        h = mix(seed + _U(0xD6E8FEB86659FD93) * (np.asarray(j, np.uint64) + _U(1)))
        inside = low + rate * ((h & _U(0xFFFFFFFF)).astype(np.float64) / (1 << 32)) < weight
        slot = ((h >> _U(32)) * _U(slots) >> _U(32)).astype(np.int64)
        np.minimum.at(sig.ravel(), (row * slots + slot)[inside], t[inside])

    expected = rate * horizon[row]
    many = expected > 24
    t, j = np.zeros(len(seed)), np.zeros(len(seed), np.uint64)
    for size in (64, 512, 4096):
        pick = np.flatnonzero(many & (j == 0) & (expected + 6 * np.sqrt(expected) < size))
        step = max(1, (1 << 18) // size)
        for i in range(0, len(pick), step):
            p = pick[i : i + step]
            number = np.arange(1, size + 1, dtype=np.uint64)[None, :]
            times = np.cumsum(-np.log(_uniform(seed[p][:, None], number)) / rate[p][:, None], 1)
            a, z = np.nonzero(times <= horizon[row[p]][:, None])
            q = p[a]
            put(seed[q], z + 1, times[a, z], low[q], rate[q], weight[q], row[q])
            t[p], j[p] = times[:, -1], size
    live = np.flatnonzero(t <= horizon[row])
    while len(live):
        j[live] += _U(1)
        t[live] -= np.log(_uniform(seed[live], j[live])) / rate[live]
        live = live[t[live] <= horizon[row[live]]]
        put(seed[live], j[live], t[live], low[live], rate[live], weight[live], row[live])


def signatures(row: np.ndarray, h: np.ndarray, count: np.ndarray, rows: int, slots: int = SLOTS) -> np.ndarray:
    """BagMinHash signatures (times of the earliest points) of weighted elements; infinite for rows without any."""
    sig = np.full((rows, slots), np.inf)
    if not len(h):
        return sig
    parts, low, wide, k = [], 0.0, 1.0, 0
    at = np.arange(len(h))
    while len(at):
        parts.append((mix(h[at] + _U(0xBF58476D1CE4E5B9 * k % 2**64)), np.full(len(at), wide), np.full(len(at), low), count[at].astype(np.float64), row[at]))
        low, wide, k = low + wide, (1.0 if k == 0 else 2 * wide), k + 1
        at = at[count[at] > low]
    seed, rate, lows, weight, where = (np.concatenate(x) for x in zip(*parts, strict=True))
    total = np.bincount(row, count, rows)
    horizon = np.where(total > 0, slots * (np.log(slots) + 3) / np.maximum(total, 1), 0.0)
    pending = total > 0
    while pending.any():
        use = pending[where]
        _points(seed[use], rate[use], lows[use], weight[use], where[use], horizon, sig, slots)
        pending &= ~np.isfinite(sig).all(1)
        horizon[pending] *= 2
    return sig


def band_keys(sig: np.ndarray, bands: int = BANDS, band_rows: int = BAND_ROWS) -> np.ndarray:
    v = sig.view(np.uint64).reshape(len(sig), bands, band_rows)
    out = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), (len(sig), bands)).copy()
    for k in range(band_rows):
        out = mix(out * _U(0x9E3779B97F4A7C15) + v[:, :, k])
    return out


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        b, off = utf8(batch.column(1))
        for i, j in groups(off, GROUP):
            row, h, count = shingles(b[off[i] : off[j]], off[i : j + 1] - off[i])
            rows = j - i
            have = np.bincount(row, minlength=rows) > 0
            digest = [np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)]
            for k, add in enumerate((0x632BE59BD9B4E019, 0x9FB21C651E98DF25)):
                np.add.at(digest[k], row, mix(h + _U(add)) * count.astype(np.uint64))
            keys = signed(band_keys(signatures(row, h, count, rows)))[have]
            ends = np.r_[0, np.cumsum(have * BANDS)].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel()))
            n = np.bincount(row, count, rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, rows), pa.array(n), pa.array(signed(digest[0])), pa.array(signed(digest[1])), lists], ["doc", "n", "d0", "d1", "keys"])


def sketches(sig: np.ndarray) -> np.ndarray:
    """Two bits of every slot, packed into SKETCH words a row. Slots that differ have each bit equal with probability a half."""
    v = mix(sig.view(np.uint64)).reshape(len(sig), SKETCH // 2, -1)
    weight = _U(1) << np.arange(v.shape[2], dtype=np.uint64)
    return np.stack([(((v >> _U(k)) & _U(1)) * weight).sum(2) for k in range(2)], 2).reshape(len(sig), SKETCH)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bags as sets: an element (32 bits of a hash) for each occurrence of a shingle; their sizes and sketches."""
    for batch in batches:
        b, off = utf8(batch.column(1))
        for i, j in groups(off, GROUP):
            row, h, count = shingles(b[off[i] : off[j]], off[i : j + 1] - off[i])
            sketch = signed(sketches(signatures(row, h, count, j - i)))
            nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            row, h = np.repeat(row, count), mix(np.repeat(h, count) + nth.astype(np.uint64) * _U(0xA24BAED4963EE407))
            h = (h >> _U(32)).astype(np.uint32).view(np.int32)
            order = np.lexsort((h, row))
            row, h = row[order], h[order]
            new = np.r_[True, (row[1:] != row[:-1]) | (h[1:] != h[:-1])] if len(h) else np.zeros(0, bool)
            row, h = row[new], h[new]
            ends = np.searchsorted(row, np.arange(j - i + 1)).astype(np.int32)
            bag = pa.ListArray.from_arrays(pa.array(ends), pa.array(h))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), bag, pa.array(np.diff(ends).astype(np.int32)), *(pa.array(sketch[:, k]) for k in range(SKETCH))], ["doc", "bag", "size", *(f"s{k}" for k in range(SKETCH))])


def similar() -> Column:
    """Whether the bags of a row, bag_a and bag_b of sizes size_a and size_b, overlap enough; sizes tell first."""
    few, many = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    both = F.size(F.array_intersect("bag_a", "bag_b"))
    return (few >= SIMILAR * many) & (both >= SIMILAR * (F.col("size_a") + F.col("size_b") - both))


def _linked(bag: list[np.ndarray], a: int, others: np.ndarray) -> np.ndarray:
    """Which of the others overlap enough with a."""
    mine, sizes = bag[a], np.array([len(bag[k]) for k in others])
    flat = np.concatenate([bag[k] for k in others])
    at = np.minimum(np.searchsorted(mine, flat), len(mine) - 1)
    both = np.add.reduceat((mine[at] == flat).astype(np.int64), np.r_[0, np.cumsum(sizes)[:-1]])
    return others[both >= SIMILAR * (len(mine) + sizes - both)]


def _unit_links(block, band, label, doc, bag, keys, sketch) -> list[tuple[int, int]]:
    """Links of a unit: rows of one key, of one block or of two. Of the keys that a pair shares, only the first looks at its bags."""
    one = block[0] == block[-1] and (block == block[0]).all()
    size = np.array([len(x) for x in bag])
    out = []
    for a in range(len(doc)):
        others = np.flatnonzero((doc > doc[a]) & (label != label[a]) & (one | (block != block[a])) & (np.minimum(size, size[a]) >= SIMILAR * np.maximum(size, size[a])))
        if len(others):
            others = others[np.bitwise_count(sketch[others] ^ sketch[a]).sum(1) <= APART]
        if len(others) and band[a]:
            others = others[~(keys[others, : band[a]] == keys[a, : band[a]]).any(1)]
        if len(others):
            out.extend((int(doc[a]), int(doc[b])) for b in _linked(bag, a, others))
    return out


def _unit_close(block, label, doc, size, sketch) -> list[tuple[int, int]]:
    """Pairs of a unit of a large key that their sketches do not part; their bags are still to be compared."""
    one = block[0] == block[-1] and (block == block[0]).all()
    out = []
    for a in range(len(doc)):
        others = np.flatnonzero((doc > doc[a]) & (label != label[a]) & (one | (block != block[a])) & (np.minimum(size, size[a]) >= SIMILAR * np.maximum(size, size[a])))
        if len(others):
            others = others[np.bitwise_count(sketch[others] ^ sketch[a]).sum(1) <= APART]
            out.extend((int(doc[a]), int(doc[b])) for b in others)
    return out


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the units of a partition, which come one after another; a unit has two blocks of rows at most. Of rows without bags: the pairs that sketches leave."""

    def closed(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows)
        block, label, doc = (t[c].to_numpy() for c in ("block", "label", "doc"))
        sketch = np.stack([t[f"s{k}"].to_numpy() for k in range(SKETCH)], 1).view(np.uint64)
        unit = np.stack([t[c].to_numpy().astype(np.int64) for c in ("key", "i", "j")])
        edge = np.r_[0, np.flatnonzero((unit[:, 1:] != unit[:, :-1]).any(0)) + 1, len(doc)]
        several = [(i, j) for i, j in zip(edge[:-1], edge[1:], strict=True) if j > i + 1]
        if "bag" in t.column_names:
            band, lists = t["band"].to_numpy(), t["bag"].combine_chunks()
            flat, ends = lists.flatten().to_numpy(), np.r_[0, np.cumsum(lists.value_lengths().to_numpy())]
            bag = [flat[x:y] for x, y in zip(ends[:-1], ends[1:], strict=True)]
            keys = t["keys"].combine_chunks().flatten().to_numpy().reshape(len(doc), -1)
            found = [x for i, j in several for x in _unit_links(block[i:j], band[i:j], label[i:j], doc[i:j], bag[i:j], keys[i:j], sketch[i:j])]
        else:
            size = t["size"].to_numpy()
            found = [x for i, j in several for x in _unit_close(block[i:j], label[i:j], doc[i:j], size[i:j], sketch[i:j])]
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in range(2)], ["a", "b"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        unit = np.stack([batch[c].to_numpy().astype(np.int64) for c in ("key", "i", "j")])
        last = unit[:, -1]
        if held and not (unit[:, 0] == [held[-1][c][len(held[-1]) - 1].as_py() for c in ("key", "i", "j")]).all():
            yield closed(held)
            held = []
        start = int((unit == last[:, None]).all(0).argmax())  # rows of the last unit wait for the next batch
        if start:
            yield closed([*held, batch.slice(0, start)])
            held = []
        held.append(batch.slice(start))
    if held:
        yield closed(held)


def by_key(rows: DataFrame, keys: DataFrame, total: int, *on: str) -> DataFrame:
    """rows (total in number) joined with keys (on, n: how many rows have it); rows of hot keys are spread over SALTS places by document."""
    hot = F.col("n") > max(BLOCK, int(HOT * total))
    marked = rows.join(F.broadcast(keys.where(hot).select(*on, F.lit(True).alias("hot"))), list(on), "left")
    marked = marked.withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("doc"), F.lit(SALTS))).otherwise(F.lit(0).cast("bigint"))).drop("hot")
    salts = F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))).cast("array<bigint>"))
    return marked.join(unsent(keys.withColumn("salt", salts)), [*on, "salt"]).drop("salt")


def _relabelled(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Labels after classes that new edges join are merged."""
    a, b = labels.select(F.col("doc").alias("a"), F.col("label").alias("la")), labels.select(F.col("doc").alias("b"), F.col("label").alias("lb"))
    between = edges.join(unsent(a), "a").join(unsent(b), "b").where("la != lb").select(F.col("la").alias("a"), F.col("lb").alias("b"))
    between = written(between)
    if not between.count():
        return labels
    up = components(between.select(F.col("a").alias("node")).union(between.select("b")).distinct(), between)
    return written(labels.join(unsent(up), labels["label"] == up["node"], "left").select("doc", F.coalesce(up["label"], labels["label"]).alias("label")))


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (the least doc_id of the class)."""
    small_batches(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    known = d.where(F.col("doc").isNotNull())
    s = written(known.mapInArrow(freed(_signed), "doc bigint, n bigint, d0 bigint, d1 bigint, keys array<bigint>"))
    have = s.where("n > 0")
    copies = written(have.groupBy("d0", "d1", "n").agg(F.min("doc").alias("node")))
    total = BANDS * copies.count()
    node = have.join(unsent(copies.select(F.col("node").alias("doc"))), "doc", "left_semi").dropDuplicates(["doc"]).select("doc", F.posexplode("keys").alias("band", "key"))
    shared = node.groupBy("key").agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.count(F.lit(1)).alias("n")).where("least < most")
    members = written(by_key(node, written(shared.select("key", "least", "n")), total, "key").select("key", "band", "doc", "least"))
    wanted = members.select("doc").distinct()
    parts = partitions_for(d, 4 << 20)
    bags = written(known.repartition(parts, "doc").join(wanted.hint("shuffle_hash"), "doc", "left_semi").mapInArrow(freed(_bags), "doc bigint, bag array<int>, size int, " + ", ".join(f"s{k} bigint" for k in range(SKETCH))).dropDuplicates(["doc"]))

    def verified(pairs: DataFrame) -> DataFrame:
        x, y = (bags.select(F.col("doc").alias(key), F.col("bag").alias(f"bag_{key}"), F.col("size").alias(f"size_{key}")) for key in ("a", "b"))
        return written(pairs.select("a", "b").distinct().join(unsent(y), "b").join(unsent(x), "a").where(similar()).select("a", "b"))

    labels = wanted.select("doc", F.col("doc").alias("label"))
    first = members.groupBy("doc").agg(F.min("least").alias("a")).where("a < doc").select("a", F.col("doc").alias("b"))
    labels = _relabelled(written(labels), verified(first))

    def met(rows: DataFrame, *on: str) -> DataFrame:
        """Rows of the keys that still meet in several classes, with n, the number of rows of the key."""
        several = rows.groupBy(*on).agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n")).where("low < high").select(*on, "n")
        return written(by_key(rows, written(several), total, *on))

    def open_keys() -> DataFrame:
        return met(written(members.join(unsent(labels), "doc")), "key")

    m = open_keys()
    least = labels.select(F.col("doc").alias("least"), F.col("label").alias("other"))
    labels = _relabelled(labels, verified(m.join(unsent(least), "least").where("label != other").select(F.col("least").alias("a"), F.col("doc").alias("b"))))
    m = open_keys()
    keys = s.select("doc", "keys").dropDuplicates(["doc"])
    marks = [f"s{k}" for k in range(SKETCH)]
    least_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def linked(units: DataFrame, rows: int) -> DataFrame:
        return units.repartition(max(least_parts, -(-rows // UNIT_ROWS)), "key", "i", "j").sortWithinPartitions("key", "i", "j", "doc").mapInArrow(freed(_links), "a bigint, b bigint")

    few, many = m.where(F.col("n") <= BLOCK), m.where(F.col("n") > BLOCK)
    zero = F.lit(0).cast("int")
    units = written(few.select("key", zero.alias("i"), zero.alias("j"), zero.alias("block"), "band", "label", "doc"))
    links = linked(units.join(unsent(bags), "doc").join(unsent(keys), "doc").select("key", "i", "j", "block", "band", "label", "doc", "bag", "keys", *marks), units.count())
    # a large key: every two of its blocks meet, with sketches instead of bags
    many = many.join(unsent(bags.select("doc", "size", *marks)), "doc").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    many = written(many.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "label", "doc", "size", *marks))
    if rows := many.count():
        links = links.union(verified(linked(many, rows)))
    labels = _relabelled(labels, written(links.distinct()))

    of_node = copies.join(unsent(labels), copies["node"] == labels["doc"], "left").select("d0", "d1", "n", F.coalesce("label", "node").alias("class_id"))
    out = s.select("doc", "d0", "d1", "n").join(unsent(of_node), ["d0", "d1", "n"], "left").select(F.col("doc").alias("doc_id"), F.coalesce("class_id", "doc").alias("class_id"))
    return out.unionByName(d.where(F.col("doc").isNull()).select(F.col("doc").alias("doc_id"), F.col("doc").alias("class_id")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """docs without those that are not the first of their class; rows with a null doc_id stay."""
    later = classes(docs).where("doc_id > class_id").select(F.col("doc_id").alias("__later")).distinct()
    return docs.join(later.hint("shuffle_hash"), docs["doc_id"].cast("bigint") == later["__later"], "left_anti")  # neither sent whole nor are texts sorted
