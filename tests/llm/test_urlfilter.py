import re

from rootloom.llm import urlfilter
from rootloom.llm.queries import URL_RULES

URLS = ["http://a.example.org/es/x", "https://EXAMPLE.org/en/1?x", "https://example.org/en/2#f", "http://x.com/fr/1", "http://x.com/de/", "http://com/de/a",
        "http://xcom/de/", "no scheme", "", None, "http://org", "http://org/", "ftp://b.org?/es/", "http://a://b.com/fr/", "http://x.com/fr/1", "http://É.Com/fr/ü",
        "http://y.net/" + "long/" * 9000, "http://example.org/es/", "http://.org/x", "http://a\nb.org/\nx"]
RULES = [*URL_RULES, ("", "/", "block"), (None, "/", "block"), ("net", None, "block"), ("net", "/long/", "block"), ("net", "/long/", "allow")]


def brute(url, rules):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fit = [(len(h + p), len(h), v, h + p) for h, p, v in rules
           if h and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *((max(fit)[3], max(fit)[2]) if fit else (None, "allow")))


def test_against_brute_force(spark):
    rows = [(i % 17, u, "h", "clash") for i, u in enumerate(URLS)] + [(None, URLS[0], None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, h string, verdict string")
    got = urlfilter.judge(pages, spark.createDataFrame(RULES, "host string, path string, verdict string")).collect()
    want = [(i, *brute(u, RULES)) for i, u, _, _ in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_a_full_filter_still_gives_exact_results(spark):
    rules = [(f"h{i}.org", "/", "block") for i in range(2000)]
    pages = spark.createDataFrame([(i, f"http://h{i}.org/x") for i in range(0, 4000, 7)], "page_id long, url string")
    got = urlfilter.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string"), max_bytes=64).collect()
    assert all((r.verdict == "block") == (r.page_id < 2000) for r in got) and len(got) == pages.count()


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(5000).selectExpr("xxhash64(id) as h")
    table = urlfilter.build_filter(keys)
    assert urlfilter.possible(keys, table).count() == 5000
    assert urlfilter.possible(spark.range(10_000, 60_000).selectExpr("xxhash64(id) as h"), table).count() < 1500


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://x.org/")], "page_id long, url string")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    assert urlfilter.judge(pages.limit(0), rules).collect() == []
    assert [r.verdict for r in urlfilter.judge(pages, rules.limit(0)).collect()] == ["allow"]
