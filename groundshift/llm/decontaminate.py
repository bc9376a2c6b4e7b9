"""Benchmark decontamination by templates, with DataFrame functions only.

Numbers, units and names become typed placeholders; windows of eight template tokens, at least half of them words, are hash-joined with those of
the benchmark. A word with a capital that begins a sentence may be a name or not: windows are made for both readings, on both
sides. For each alignment of a document with an item, the values in the slots of the windows that met must be consistent: one value in the
item stands for one value in the document. So a question with other numbers or names is caught as well as a copy. Places between windows that met play no
part. An item with too few such windows is compared whole: all its windows, or the one of its own length if it is shorter than eight
tokens, must match in one alignment. Then it must hold four words for its values to differ; else they must be equal.

Definite results: null and empty texts match nothing; an item of fewer than eight tokens matches word for word; very long texts are searched whole; repeated
rows count once; an item_id with several texts stands for each of them, and of alignments of a document with an item all count; an empty
documents or benchmark table gives an empty result; other columns play no part, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundshift.llm.shared import written

WINDOW = 8
#: Windows that one alignment must share with an item (all, if the item has fewer or fewer of them are usable).
LEAST = 3
#: Benchmark windows and tokens up to this number (24 bytes each or less) are broadcast; more are joined by a shuffle.
BROADCAST_WINDOWS = 1_000_000
#: Units of measure and of money.
UNITS = "% $ € £ ° mm cm m km in ft yd mi mg g kg lb lbs oz ml l s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years mph kmh hz khz mhz w kw v usd eur gbp dollar dollars cent cents euro euros pound pounds percent degree degrees meter meters metre metres kilometer kilometers mile miles inch inches foot feet gram grams kilogram kilograms liter liters".split()
#: Units only right after a number.
LOOSE = "in l s m g h w v mi sec".split()
_TRIM = ".!?\n\r\t "
_TOKEN = r"(?:[.!?\n]\s*)?[\p{L}\p{N}]+(?:[.,][0-9]+)*|[%$€£°]"
_NUM, _UNIT, _NAME = "<num>", "<unit>", "<name>"


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit(_TOKEN), F.lit(0))


def _digit(x: Column) -> Column:
    return F.ascii(x).between(48, 57)


def _template(x: Column, i: Column, begin: bool = False) -> Column:
    """The typed placeholder of a token, or its lower-case text. What most tokens are comes with the fewest steps. begin: a capital at a sentence's begin makes a name."""
    code = F.ascii(x)
    before = F.ltrim(F.when(i > 0, F.get("tokens", i - 1)), F.lit(_TRIM))

    def unit(word: Column, other: Column) -> Column:
        """A unit or what it is where no number stands before it."""
        return F.when(word.isin(LOOSE), F.when(_digit(before), F.lit(_UNIT)).otherwise(other)).otherwise(F.lit(_UNIT))

    name = F.when(F.lower(x).isin(UNITS), unit(F.lower(x), F.lit(_NAME))).otherwise(F.lit(_NAME))
    begun = F.ltrim(x, F.lit(_TRIM))
    first = F.when(_capital(begun), F.lit(_NAME)).otherwise(F.lower(begun)) if begin else F.lower(begun)
    return (
        F.when((code >= 97) & (code <= 122), F.when(x.isin(UNITS), unit(x, x)).otherwise(F.lower(x)))
        .when(code.isin(46, 33, 63, 10), F.when(_digit(begun), F.lit(_NUM)).otherwise(first))
        .when((code >= 48) & (code <= 57), F.lit(_NUM))
        .when((code >= 65) & (code <= 90), F.when(i == 0, first).otherwise(name))
        .when(x.isin(UNITS), F.lit(_UNIT))
        .when(F.lower(x) != x, F.when(i == 0, first).otherwise(F.lit(_NAME)))
        .otherwise(F.lower(x))
    )


def _capital(x: Column) -> Column:
    return F.lower(x) != x


def _is_slot(t: Column) -> Column:
    return t.isin(_NUM, _UNIT, _NAME)


def _hashes(df: DataFrame, of: str, size: int) -> DataFrame:
    """df with column {of}{size}, hashes of windows of size tokens, from {of}1, those of tokens."""
    n, step = F.size(f"{of}1"), 1
    while step < size:
        wide = min(2 * step, size)
        long, h = n - (wide - 1), f"{of}{step}"
        pairs = F.zip_with(F.slice(h, F.lit(1), long), F.slice(h, F.lit(wide - step + 1), long), lambda a, b: F.xxhash64(a, b))
        df = df.withColumn(f"{of}{wide}", F.when(n >= wide, pairs).otherwise(F.array().cast("array<bigint>")))
        step = wide
    return df


def _windows(df: DataFrame, key: list[str], size: int) -> DataFrame:
    """key, place and hash of each window of size tokens, for both readings of capitals at the begin of sentences, where they differ.

    The outer form keeps the optimizer from testing the array for emptiness beforehand, which would compute it once more.
    """
    plain = F.transform("tokens", lambda x, i: F.xxhash64(_template(x, i)))
    named = F.transform("tokens", lambda x, i: F.xxhash64(_template(x, i, True)))
    df = df.withColumn("a1", plain)
    # the second reading only where there is something to read in two ways
    twofold = F.exists("tokens", lambda x: F.ascii(x).isin(46, 33, 63, 10) & _capital(x)) | _capital(F.get("tokens", F.lit(0)))
    df = df.withColumn("b1", F.when(twofold, named).otherwise(F.array().cast("array<bigint>")))
    df = _hashes(_hashes(df, "a", size), "b", size)
    other = F.zip_with(f"b{size}", f"a{size}", lambda x, y: F.when(x != y, x))
    df = df.select(*key, F.size(f"a{size}").alias("n"), F.posexplode_outer(F.concat(f"a{size}", other)).alias("at", "h"))
    return df.where("h is not null").select(*key, F.when(F.col("at") < F.col("n"), F.col("at")).otherwise(F.col("at") - F.col("n")).alias("at"), "h")


def _tokenized(df: DataFrame, *columns: Column) -> DataFrame:
    return df.select(*columns, _tokens(F.col("text")).alias("tokens"))


def _slots(place: Column, size: Column | int) -> Column:
    """How many slots a window of the template has, whatever begins a sentence being none."""
    return F.size(F.filter(F.slice("template", place + 1, size), _is_slot))


def items_of(benchmark: DataFrame) -> DataFrame:
    """item_id, text_id, tokens, template, n (tokens), size (of windows), needed, whole, exact of each different item."""
    b = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).where(F.col("item_id").isNotNull()).distinct()
    b = _tokenized(b, F.col("item_id"), F.xxhash64("text").alias("text_id")).withColumn("template", F.transform("tokens", lambda x, i: _template(x, i)))
    n = F.size("template")
    usable = F.size(F.filter(F.sequence(F.lit(0), n - WINDOW), lambda p: _slots(p, F.lit(WINDOW)) * 2 <= WINDOW))
    b = b.where(n > 0).withColumn("usable", F.when(n >= WINDOW, usable).otherwise(F.lit(0)))
    most = F.least(n - (WINDOW - 1), F.lit(LEAST))
    b = b.withColumns({"n": n, "whole": (n < WINDOW) | (F.col("usable") < most), "size": F.least(n, F.lit(WINDOW))})
    b = b.withColumn("needed", F.when(F.col("whole"), n - F.col("size") + 1).otherwise(most))
    return b.withColumn("exact", F.col("whole") & ((n < WINDOW) | ((n - _slots(F.lit(0), n)) * 2 < WINDOW))).drop("usable")


def benchmark_windows(items: DataFrame, size: int) -> DataFrame:
    """item_id, text_id, item_at, h, needed, exact of each window of this size to be looked for."""
    b = items.where(F.col("size") == size)
    usable = F.filter(F.sequence(F.lit(0), F.col("n") - size), lambda p: F.col("whole") | (_slots(p, F.lit(size)) * 2 <= WINDOW))
    w = _windows(b.withColumn("usable", usable), ["item_id", "text_id", "needed", "exact", "usable"], size)
    return w.where(F.array_contains("usable", F.col("at"))).select("item_id", "text_id", F.col("at").alias("item_at"), "h", "needed", "exact")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_windows, n_slots, n_alignments of each document that holds (part of) an item."""
    items = written(items_of(benchmark))
    sizes = {r["size"]: r["tokens"] for r in items.groupBy("size").agg(F.sum("n").alias("tokens")).collect()}  # eight at most
    few = sum(sizes.values()) <= BROADCAST_WINDOWS // 2  # a token has two windows at most
    d = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def hits_of(size: int) -> DataFrame:
        slim = benchmark_windows(items, size)
        return _windows(_tokenized(d, F.col("doc_id")), ["doc_id"], size).join(F.broadcast(slim) if few else slim, "h").withColumn("size", F.lit(size))

    hits = reduce(DataFrame.unionByName, [hits_of(size) for size in sorted(sizes) or [WINDOW]])
    key = ["doc_id", "item_id", "text_id", "shift"]
    hits = hits.select("doc_id", "item_id", "text_id", (F.col("at") - F.col("item_at")).alias("shift"), "item_at", "needed", "exact", "size").distinct()
    aligned = hits.groupBy(*key).agg(F.count(F.lit(1)).alias("n_windows"), *(F.max(c).alias(c) for c in ("needed", "exact", "size")), F.collect_set("item_at").alias("met"))
    aligned = written(aligned.where(F.col("n_windows") >= F.col("needed")))
    # the values in the slots of the windows that met, from the texts of the documents concerned only
    found = aligned.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "text_id", "shift", "n_windows", "exact", "size", "met")).alias("found"))
    value = lambda x: F.lower(F.ltrim(x, F.lit(_TRIM)))
    texts = _tokenized(d.join(found.hint("shuffle_hash"), "doc_id"), F.col("doc_id"), F.col("found"))
    parts = texts.withColumn("values", F.transform("tokens", value)).select("doc_id", "values", F.explode_outer("found").alias("f")).select("doc_id", "f.*", "values")
    places = F.array_sort(F.array_distinct(F.flatten(F.transform("met", lambda a: F.sequence(a, a + F.col("size") - 1)))))
    parts = parts.withColumn("places", places).withColumn("theirs", F.transform("places", lambda p: F.get("values", p + F.col("shift")))).drop("values", "met")
    # what may be a name counts as a slot
    ours = items.select("item_id", "text_id", F.transform("tokens", value).alias("ours"), F.transform("tokens", lambda x, i: _is_slot(_template(x, i, True))).alias("slot"))
    parts = parts.join(F.broadcast(ours) if few else ours, ["item_id", "text_id"])
    both = F.zip_with("places", "theirs", lambda p, t: F.struct(F.get("ours", p).alias("o"), t.alias("t"), F.get("slot", p).alias("s")))
    parts = parts.withColumn("both", F.array_distinct(both)).withColumn("pairs", F.filter("both", lambda p: p.s))
    consistent = F.size(F.array_distinct(F.transform("pairs", lambda p: p.o))) == F.size("pairs")
    same = ~F.exists("both", lambda p: p.o != p.t)
    parts = parts.where(F.when(F.col("exact"), same).otherwise(consistent))
    return parts.groupBy("doc_id", "item_id").agg(F.max("n_windows").alias("n_windows"), F.max(F.size("pairs")).cast("bigint").alias("n_slots"), F.countDistinct("shift").alias("n_alignments"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without those that hold an item; rows with a null doc_id or text stay."""
    bad = leaks(docs, benchmark).select(F.col("doc_id").alias("__leaked")).distinct()
    return docs.join(bad, docs["doc_id"].cast("bigint") == bad["__leaked"], "left_anti")
