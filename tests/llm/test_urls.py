"""URL rules, and the ratio of language models against plain Python."""

import math
import statistics
import zlib
from collections import Counter

import pytest

from groundshift.llm import urls


def plain(rows):
    """Verdict and ratio of each (page_id, url), one character at a time."""

    def ruled(url):
        if not url or "://" not in url:
            return None
        rest = url[url.index("://") + 3 :]
        cut = min([rest.index(c) for c in "/?#" if c in rest] + [len(rest)])
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = path[: min([path.index(c) for c in "?#" if c in path] + [len(path)])]
        best = None
        for verdict, rule in urls.RULES:
            name, _, tail = rule.partition("/")
            if (host == name or host.endswith("." + name)) and path.startswith("/" + tail) and (best is None or len(rule) > len(best[1])):
                best = (verdict, rule)
        return best

    held = lambda u: zlib.crc32(u.encode()) % urls.FOLD == 0
    grams = {x: Counter() for x in urls.LABELS}
    padded = lambda u: " " * (urls.ORDERS - 1) + u + "\n"
    for _, u in rows:
        r = ruled(u)
        if r and not held(u):
            t = padded(u)
            for i in range(urls.ORDERS - 1, len(t)):
                for k in range(urls.ORDERS):
                    grams[r[0]][t[i - k : i], t[i]] += 1
    context = {x: Counter() for x in urls.LABELS}
    for x in urls.LABELS:
        for (c, _), n in grams[x].items():
            context[x][c] += n

    def ratio(u):
        t, total = padded(u), 0.0
        for i in range(urls.ORDERS - 1, len(t)):
            p = dict.fromkeys(urls.LABELS, 1 / urls.ALPHABET)
            for x in urls.LABELS:
                for k in range(urls.ORDERS):
                    p[x] = (grams[x][t[i - k : i], t[i]] + urls.STRENGTH * p[x]) / (context[x][t[i - k : i]] + urls.STRENGTH)
            total += math.log(p["allow"] / p["block"])
        return total / (len(t) - urls.ORDERS + 1)

    if not all(any(ruled(u) and ruled(u)[0] == x and not held(u) for _, u in rows) for x in urls.LABELS):
        return {i: (ruled(u)[0] if ruled(u) else "allow", None) for i, u in rows}
    seen = {x: [ratio(u) for _, u in rows if ruled(u) and ruled(u)[0] == x and held(u)] for x in urls.LABELS}
    least = -math.inf
    if all(seen.values()):
        (a, sa), (b, sb) = ((statistics.mean(seen[x]), statistics.pstdev(seen[x]) + 1e-6) for x in urls.LABELS)
        least = min((a * sb + b * sa) / (sa + sb), a - urls.TAIL * sa)
    out = {}
    for i, u in rows:
        r = ruled(u)
        x = None if r or not u else ratio(u)
        out[i] = (r[0] if r else "allow" if x is None or x >= least - 1e-9 else "block", x)
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for i, (verdict, ratio) in want.items():
        assert got[i].verdict == verdict, i
        assert (got[i].ratio is None) == (ratio is None) and (ratio is None or math.isclose(got[i].ratio, ratio, abs_tol=1e-8)), i


ROWS = [(1, None), (2, "abc"), (3, "http://A.B.com/en/7?x"), (4, "http://example.com/en/77"), (5, "x://example.com"), (6, "http://EXAMPLE.net/de/8#a"), (7, "http://a.org?/es/"), (8, "http://org/es/1"), (9, "http://xnet/de/"), (10, "ftp://net/de/://q"), (11, "")]
MANY = ROWS + [(100 + i, f"http://a{i}.net/de/{i}") for i in range(60)] + [(200 + i, f"http://b{i}.org/es/{i}") for i in range(60)] + [(300, "http://a9.net/dx/9"), (301, "http://b9.org/ex/9"), (302, "x" * 5000), (303, "http://a9.net/dx/9")]


def test_rules(spark):
    df = spark.createDataFrame([(i, u, "a", "b") for i, u in ROWS], "page_id bigint, url string, host string, ratio string")
    got = {r.page_id: (r.host, r.path, r.rule) for r in urls.judged(df).collect()}
    assert got[1] == got[2] == got[11] == ("", "", None)
    assert got[3] == ("a.b.com", "/en/7", "com/en/") and got[4] == ("example.com", "/en/77", "example.com/en/7")
    assert got[5] == ("example.com", "", None) and got[6] == ("example.net", "/de/8", "example.net/de/8")
    assert got[7] == ("a.org", "", None) and got[8][2] == "org/es/" and got[9][2] is None and got[10] == ("net", "/de/://q", "net/de/")
    assert urls.judged(df.limit(0)).count() == 0


@pytest.mark.parametrize("windows", [urls.BROADCAST_WINDOWS, 0])
def test_verdicts_equal_plain_python(spark, monkeypatch, windows):
    monkeypatch.setattr(urls, "BROADCAST_WINDOWS", windows)
    df = spark.createDataFrame(MANY, "page_id bigint, url string").repartition(3)
    got = {r.page_id: r for r in urls.judged(df).collect()}
    same(got, plain(MANY))
    assert got[300].verdict == "allow" and got[301].verdict == "block" and got[300].ratio > got[301].ratio


def test_one_label_only_allows_the_rest(spark):
    rows = [(i, f"http://a{i}.net/de/{i}") for i in range(9)] + [(20, "http://q.de/")]
    same({r.page_id: r for r in urls.judged(spark.createDataFrame(rows, "page_id bigint, url string")).collect()}, plain(rows))


def test_given_pages_and_few_accepted_ones_blocked(spark, sf_dir):
    rows = [(r.page_id, r.url) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    got = {r.page_id: r for r in urls.judged(spark.read.parquet(f"{sf_dir}/pages.parquet")).collect()}
    same(got, plain(rows))
