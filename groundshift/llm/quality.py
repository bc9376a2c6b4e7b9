"""Quality rules as one projection: a table of thresholds compiled into column expressions; nothing but DataFrame functions.

Definite results: null and empty texts have no words and fail the base rule; very long texts are measured whole; a measure equal to its bound
passes; repeated rows give repeated rows; an empty table gives an empty result; other columns play no part, whatever their names. Windows of words are
compared by 64-bit hashes, doubled from words to 2, 4 and 8 of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Common function words of the languages at hand.
STOP_WORDS = "the be to of and that have with is in a it for on as by et de la le les un une des que en du est und der die das ein zu mit den von el los las una por con para es no se".split()

#: name, measure, least, most (null: no bound), and the number of words from which the rule holds.
RULES = [
    ("mean_word_length", "word_chars / nullif(n_words, 0)", 2.0, 15.0, 20),
    ("symbol_word_ratio", "n_symbols / nullif(n_words, 0)", None, 0.3, 20),
    ("duplicate_line_ratio", "n_dup_lines / nullif(n_lines, 0)", None, 0.5, 20),
    ("stop_word_ratio", "n_stop_words / nullif(n_words, 0)", 0.03, None, 20),
    ("repeated_word_ratio", "n_repeat_words / nullif(n_words, 0)", None, 0.3, 20),
]


def _doubled(h: Column, n: Column, step: int) -> Column:
    """Hashes of twice as long windows."""
    return F.when(n >= 2 * step, F.zip_with(F.slice(h, F.lit(1), n - (2 * step - 1)), F.slice(h, F.lit(step + 1), n - (2 * step - 1)), lambda a, b: F.xxhash64(a, b))).otherwise(F.array().cast("array<bigint>"))


def _covered(windows: Column, n: Column, width: int) -> Column:
    """Number of words in windows whose hash occurs twice or more."""
    numbered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    hashes = numbered.getField("h")
    at = numbered.getField("i")
    size = F.size(numbered)
    before = F.concat(F.array(F.lit(None).cast("bigint")), F.slice(hashes, F.lit(1), size - 1))
    after = F.concat(F.slice(hashes, F.lit(2), size - 1), F.array(F.lit(None).cast("bigint")))
    flags = F.zip_with(hashes, before, lambda h, b: F.coalesce(h == b, F.lit(False)))
    flags = F.zip_with(flags, F.zip_with(hashes, after, lambda h, b: F.coalesce(h == b, F.lit(False))), lambda x, y: x | y)
    starts = F.array_sort(F.filter(F.zip_with(at, flags, lambda i, f: F.when(f, i)), lambda i: i.isNotNull()))
    nexts = F.concat(F.slice(starts, F.lit(2), F.greatest(F.size(starts) - 1, F.lit(0))), F.array(F.lit(1 << 30)))
    return F.aggregate(F.zip_with(starts, nexts, lambda i, j: F.least(j - i, F.lit(width)).cast("bigint")), F.lit(0).cast("bigint"), lambda a, x: a + x)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and the measures of its text."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    d = docs.select("doc_id", t.alias("t"))
    d = d.withColumn("w", F.filter(F.split("t", "[ \\t-\\r]+"), lambda x: x != ""))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    d = d.withColumns({"n": F.size("w"), "h1": F.transform("w", lambda x: F.xxhash64(x)), "lines": lines})
    for step in (1, 2, 4):
        d = d.withColumn(f"h{2 * step}", _doubled(F.col(f"h{step}"), F.col("n"), step))
    repeated = F.when(F.size(F.array_distinct("h8")) == F.size("h8"), F.lit(0).cast("bigint")).otherwise(_covered(F.col("h8"), F.col("n"), 8))
    stop = F.size(F.filter("w", lambda x: F.lower(x).isin(STOP_WORDS)))
    return d.select(
        "doc_id",
        F.col("n").cast("bigint").alias("n_words"),
        F.length(F.regexp_replace("t", "[ \\t-\\r]+", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("t", F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        repeated.alias("n_repeat_words"),
        F.size("lines").cast("bigint").alias("n_lines"),
        stop.cast("bigint").alias("n_stop_words"),
    )


def verdict(rules: list[tuple] = RULES) -> Column:
    """Whether every rule of the table holds."""
    parts = []
    for _, measure, least, most, words in rules:
        x = F.expr(measure)
        ok = reduce(lambda a, b: a & b, ([x >= least] if least is not None else []) + ([x <= most] if most is not None else []))
        parts.append(F.coalesce((F.col("n_words") < words) | ok, F.lit(True)))
    return reduce(lambda a, b: a & b, parts)


def judged(docs: DataFrame, rules: list[tuple] = RULES) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept."""
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    m = measured(docs).withColumn("base_failed", base)
    return m.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & verdict(rules)).alias("kept"))


_BOUNDS = " AND ".join(f"(n_words < {words} OR (" + " AND ".join(([f"{x} >= {lo}"] if lo is not None else []) + ([f"{x} <= {hi}"] if hi is not None else [])) + "))" for _, x, lo, hi, words in RULES)
_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[ \\t-\\r]+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: length(regexp_replace(x, '[ \\t-\\r]', '', 'g')) > 0) AS lines FROM t),
g AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) AS g, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8),
r AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS j FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
c AS (SELECT doc_id, CAST(sum(least(coalesce(j - i, 8), 8)) AS BIGINT) AS c FROM r GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[ \\t-\\r]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(c, 0) AS n_repeat_words, len(lines) AS n_lines,
             len(list_filter(w, lambda x: lower(x) IN ({_STOP}))) AS n_stop_words FROM w LEFT JOIN c ON w.doc_id = c.doc_id),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {_BOUNDS} AS kept FROM b
"""
