import math
import random
from collections import Counter

from pyspark.sql import functions as F

from sluicework.llm.queries import URL_RULES
from sluicework.llm.url_filter import block_probability, filter_urls, fit, lexical_features

URLS = [
    "http://www.ththti.example.com/en/231?page=2&ref=x", "https://Example.COM/en/1", "http://www.example.com/en/", "http://a.www.example.com/en/x#top",
    "http://www.example.com/de/", "http://notexample.com/en/", "http://example.net/es/1", "http://EXAMPLE.net/fr", "http://example.net/fr/", "http://example.org/en/9",
    "http://com/", "http://x.com", "http://x.com?a/en/", "nothing here", "", None, "ftp://u:p@host.com:80/en/?q", "x://ÄHOST.com/a\nb?c", "a://b://c.com/en/", "http://x.com/" + "p" * 100_000,
]


def plain(url):
    """Host, path, rule and its verdict by string functions."""
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best.text if best else None, best.verdict if best else None


def _labelled(spark, n=600):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        bad = rng.random() < 0.4
        name = "".join(rng.choice("0123456789xqz-") for _ in range(24)) if bad else "".join(rng.choice("aeioutrn") for _ in range(8))
        rows.append((f"http://{name}.{'biz' if bad and rng.random() < 0.7 else 'org'}/{i % 50}", int(bad)))
    return spark.createDataFrame(rows, "url string, blocked int")


def test_rules(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)] + [(None, URLS[0])], "page_id long, url string")
    pages = pages.selectExpr("*", "'h' AS html", "1 AS host", "2 AS suffix", "3 AS f_depth", "4 AS rule")
    found = filter_urls(pages, spark.createDataFrame([], "url string, blocked int"), URL_RULES).collect()
    assert len(found) == len(URLS) + 1
    for r in found:
        host, path, rule, verdict = plain(r.url)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow")


def test_held_out_urls(spark):
    labelled = _labelled(spark)
    train, held = labelled.limit(400), labelled.exceptAll(labelled.limit(400))
    scored = block_probability(held, fit(train)).collect()
    assert sum((r.block_probability >= 0.5) == bool(r.blocked) for r in scored) / len(scored) > 0.95


def test_model_judges_the_rest(spark):
    pages = spark.createDataFrame([(1, "http://9x9q-z0-1x2z8q-00xz7q1.biz/3"), (2, "http://tearoni.org/3"), (3, "http://9x9q-z0.com/3"), (4, None)], "page_id long, url string")
    found = {r.page_id: (r.rule, r.verdict) for r in filter_urls(pages, _labelled(spark), URL_RULES).collect()}
    assert found[1] == (None, "block") and found[2] == (None, "allow") and found[3] == ("com/", "allow") and found[4][0] is None


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    plan = filter_urls(pages, _labelled(spark), URL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_features(spark):
    url = "https://a-b.example.com/x/1?q=1&r=2#f"
    row = spark.createDataFrame([(url,), (None,)], "url string").select(*(c.alias(n) for n, c in lexical_features(F.col("url")).items())).collect()
    shares = [n / len(url) for n in Counter(url).values()]
    assert abs(row[0].entropy + sum(s * math.log2(s) for s in shares)) < 1e-9
    assert (row[0].depth, row[0].parameters, row[0].labels, row[0].longest_label, row[0].hyphens) == (2, 2, 3, 7, 1)
    assert row[0].digit_ratio == 3 / len(url)
    assert row[1].url_length == 0 and row[1].entropy == 0


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert filter_urls(none, spark.createDataFrame([], "url string, blocked int")).collect() == []
    assert filter_urls(none, _labelled(spark)).collect() == []
