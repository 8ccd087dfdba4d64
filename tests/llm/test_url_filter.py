import math
import re
from collections import Counter

from shopflow.llm import url_filter

ROWS = [
    (0, "http://a.com/x"), (1, "https://WWW.Example.COM/en/1?q=1"), (2, "https://m.example.com/en/2#t"), (3, "http://b.net/es/3"), (4, "http://b.net/fr/4"),
    (5, "http://b.net/de/5"), (6, "http://c.org/en/6.html"), (7, None), (8, "no scheme"), (9, "http://a.com"), (10, "http://a.com?x=/en/"), (11, "ftp://net/es/1"),
    (12, "http://xexample.com/en/"), (13, "http://h.org/p?u=http://a.com/"), (14, "://"), (15, "http://x.www.example.com/en/y"), (15, "http://x.www.example.com/en/y"),
]


def brute(rows, threshold=None):
    """Verdicts with models and threshold computed by plain counting."""
    judged = []
    for i, url in rows:
        m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
        host, path = ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")
        fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, rule, verdict = max(fits, default=(0, None, None))
        judged.append([i, host, path, rule, verdict])
    grams = lambda t: [("^^^^" + t + "$")[k : k + 5] for k in range(len(t) + 1)]
    n = {"allow": Counter(), "block": Counter()}
    for _, host, path, _, verdict in judged:
        if verdict:
            for g in grams(host + path):
                for k in range(5):
                    n[verdict][k, "gram", g[4 - k :]] += 1
                    n[verdict][k, "context", g[4 - k : 4]] += 1

    def score(g):
        out = []
        for c in ("allow", "block"):
            p = 1 / 256
            for k in range(5):
                p = (n[c][k, "gram", g[4 - k :]] + 2 * p) / (n[c][k, "context", g[4 - k : 4]] + 2)
            out.append(math.log(p))
        return round((out[0] - out[1]) * 1e6)

    scores = [sum(map(score, grams(h + p))) / 1e6 / len(grams(h + p)) for _, h, p, _, _ in judged]
    stats = {}
    for c in ("allow", "block"):
        s = [x for x, j in zip(scores, judged) if j[4] == c]
        mean = sum(s) / len(s)
        stats[c] = mean, math.sqrt(sum((x - mean) ** 2 for x in s) / len(s))
    (ma, sa), (mb, sb) = stats["allow"], stats["block"]
    threshold = (ma * sb + mb * sa) / (sa + sb)
    return [(i, h, p, r, v or ("allow" if s >= threshold else "block"), round(s, 4)) for (i, h, p, r, v), s in zip(judged, scores)]


def test_against_plain_counting(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string").selectExpr("*", "1 AS score", "'x' AS text", "0 AS gram")
    got = sorted(tuple(r) for r in url_filter.judge(pages).collect())
    assert got == sorted(brute(ROWS), key=lambda r: (r[0], r[1]))


def test_one_class_or_nothing(spark):
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0
    got = url_filter.judge(spark.createDataFrame([(1, "http://a.com/"), (2, "http://a.org/"), (None, None)], "page_id long, url string")).collect()
    assert {r.verdict for r in got} == {"allow"} and len(got) == 3


def test_long_url_and_no_python(spark):
    df = url_filter.judge(spark.createDataFrame([(1, "http://a.com/" + "x" * 20000), (2, "http://b.net/es/")], "page_id long, url string"))
    assert df.count() == 2
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
