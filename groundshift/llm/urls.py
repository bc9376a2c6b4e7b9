"""URL filter: rules first, then the ratio of two character language models.

Rules are (verdict, rule) with a rule's host up to its first slash and its path from there; the longest that fits wins. What no rule
decides is judged by smoothed variable-order Markov models of accepted and of rejected URLs (those that rules decide): the share of a
character after a context of up to four characters, interpolated with that after shorter ones, so that the shares after each context
add up to one. Counts are exact, over all URLs that are learned from, and stay a table of the windows of five characters: it grows
with the input, and the windows of the URLs to be judged are joined with it. While it is small by count it is broadcast, else it is joined by a shuffle; both
give the same.

The difference of log-likelihoods per character is compared with a threshold calibrated on one in four of the URLs that rules
decide, dealt by a hash of the URL and not learned from: as many standard deviations from the mean of either label,
but never so high that more than one accepted URL in a hundred (by the normal distribution) would be blocked.

Definite results: a null URL or one without ``://`` has an empty host and path and no rule; null and empty texts are allowed, and so is all
that no rule decides when one of the two labels has no URL to learn from or to calibrate on; a ratio equal to the threshold is allowed; URLs of any length are
judged whole; an empty table gives an empty result; repeated rows give repeated rows (and count as often); other columns play no part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundshift.llm.shared import written

#: The rules.
RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]
#: Characters of a window; weight of the shorter context's share; characters that the shortest share allows for.
ORDERS, STRENGTH, ALPHABET = 5, 2.0, 257
#: Tables of windows up to this number (some 60 bytes each) are broadcast.
BROADCAST_WINDOWS = 1_000_000
#: Of how many labelled URLs one is for calibration; standard deviations below the mean of accepted ones beyond which one in a hundred lies.
FOLD, TAIL = 4, 2.326
LABELS = ("allow", "block")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parsed(pages: DataFrame, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """page_id, url, host, path, rule, ruled (verdict of the rule)."""
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    d = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url")).withColumn("rest", F.coalesce(rest, F.lit("")))
    d = d.withColumn("host", F.translate(F.regexp_extract("rest", r"^[^/?#]*", 0), _UPPER, _LOWER))
    d = d.withColumn("path", F.regexp_extract("rest", r"(?s)^[^/?#]*([^?#]*)", 1))
    rule: Column = F.lit(None).cast("string")
    ruled: Column = F.lit(None).cast("string")
    for verdict, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, path = text[: text.index("/")], text[text.index("/") :]
        fits = ((F.col("host") == name) | F.col("host").endswith("." + name)) & F.col("path").startswith(path)
        rule, ruled = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(verdict)).otherwise(ruled)
    return d.withColumns({"rule": rule, "ruled": ruled}).drop("rest")


def windows(d: DataFrame, *keep: str) -> DataFrame:
    """keep and g, the window of ORDERS characters that ends at each character of url and at its end. URLs are preceded by blanks."""
    t = F.split(F.concat(F.lit(" " * (ORDERS - 1)), F.col("url"), F.lit("\n")), "")
    d = d.select(*keep, F.filter(t, lambda c: c != "").alias("t"))
    return d.select(*keep, F.explode(F.transform(F.sequence(F.lit(0), F.size("t") - ORDERS), lambda i: F.concat(*(F.get("t", i + k) for k in range(ORDERS))))).alias("g"))


def shares(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """g, p_allow, p_block of the wanted windows. counts: g, allow, block."""
    w = wanted.withColumns({f"p_{x}": F.lit(1.0 / ALPHABET) for x in LABELS})
    for k in range(1, ORDERS + 1):
        # the context of k - 1 characters, and with the character itself
        sums = [F.sum(x).cast("double").alias(x) for x in LABELS]
        whole = counts.groupBy(F.right("g", F.lit(k)).alias("s")).agg(*sums)
        before = whole.groupBy(F.left("s", F.lit(k - 1)).alias("c")).agg(*(F.sum(x).alias(f"{x}_c") for x in LABELS))
        whole = whole.withColumn("c", F.left("s", F.lit(k - 1)))
        before = F.broadcast(before) if k == 1 else before  # one row
        w = w.withColumns({"s": F.right("g", F.lit(k)), "c": F.left(F.right("g", F.lit(k)), F.lit(k - 1))})
        w = w.join(whole.drop("c"), "s", "left").join(before, "c", "left")
        n = lambda x: F.coalesce(F.col(x), F.lit(0.0))
        w = w.select("g", *((n(x) + STRENGTH * F.col(f"p_{x}")).alias(f"a_{x}") for x in LABELS), *((n(f"{x}_c") + STRENGTH).alias(f"b_{x}") for x in LABELS))
        w = w.select("g", *((F.col(f"a_{x}") / F.col(f"b_{x}")).alias(f"p_{x}") for x in LABELS))
    return w


def ratios(d: DataFrame, learned: DataFrame) -> DataFrame:
    """url and ratio, the log-likelihood of accepted less that of rejected, per character, of the different URLs of d. learned: (ruled, url)."""
    counts = windows(learned, "ruled").groupBy("g").agg(*(F.count(F.when(F.col("ruled") == x, 1)).alias(x) for x in LABELS))
    asked = d.select("url").distinct()
    wanted = windows(asked).distinct()
    table = written(shares(written(counts), wanted).select("g", F.log(F.col("p_allow") / F.col("p_block")).alias("x")))
    small = table.count() <= BROADCAST_WINDOWS
    scored = windows(asked, "url").groupBy("url", "g").agg(F.count(F.lit(1)).alias("n")) if not small else windows(asked, "url").withColumn("n", F.lit(1))
    scored = scored.join(F.broadcast(table) if small else table, "g")
    return scored.groupBy("url").agg(F.round(F.sum(F.col("x") * F.col("n")) / F.sum("n"), 9).alias("ratio"))


def threshold(calibration: DataFrame) -> float | None:
    """From (ruled, ratio) of URLs that were not learned from; None where a label has none."""
    spread = {r["ruled"]: r for r in calibration.groupBy("ruled").agg(F.avg("ratio").alias("mean"), F.stddev_pop("ratio").alias("sd")).collect()}  # two rows
    if set(spread) != set(LABELS):
        return None
    (a, sa), (b, sb) = ((spread[x]["mean"], spread[x]["sd"] + 1e-6) for x in LABELS)
    return round(min((a * sb + b * sa) / (sa + sb), a - TAIL * sa), 9)


def judged(pages: DataFrame, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, ratio (null where a rule decides or no model could be learned)."""
    d = parsed(pages, rules)
    ruled = d.where("ruled is not null").select("ruled", "url", (F.pmod(F.crc32(F.col("url").cast("binary")), F.lit(FOLD)) == 0).alias("held"))
    learned = ruled.where("not held")
    open_ = d.where("ruled is null and length(url) > 0").select("url")
    have = {r["ruled"] for r in learned.select("ruled").distinct().collect()}  # two rows
    if have != set(LABELS):
        return d.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.lit("allow")).alias("verdict"), F.lit(None).cast("double").alias("ratio"))
    scored = written(ratios(open_.union(ruled.where("held").select("url")), learned))
    least = threshold(ruled.where("held").join(scored, "url"))
    least = float("-inf") if least is None else least
    d = d.join(scored.withColumnRenamed("url", "__url"), F.col("ruled").isNull() & (F.col("url") == F.col("__url")), "left")
    verdict = F.coalesce("ruled", F.when(F.col("ratio") < least, "block").otherwise("allow"))
    return d.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "ratio")
