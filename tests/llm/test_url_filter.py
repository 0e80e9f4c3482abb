import duckdb
import pytest

from caseweave.llm.queries import ORACLE_SQL
from caseweave.llm.url_filter import RULES, judge_urls, rule_table

URLS = [
    None, "", "no scheme", "http://", "https://A.Example.NET/en/1?x#y", "http://net/", "http://net", "http://x.net/a",
    "http://notexample.net/en/1", "http://example.net/en", "http://example.com/de/x", "http://xexample.com/de/x",
    "http://b.example.com/de/", "ftp://a.org/fr/", "http://a.org/fr", "http://a.org?/fr/", "http://a.org#/fr/",
    "http://u:p@x.org:80/fr/", "a://b://c/", "http://" + "a." * 60 + "net/" + "d/" * 2000, "http://É.net/", "http://x.net/\ny",
]


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fit = [
        (len(h + p), len(h), v, h + p)
        for v, h, p in rules
        if h and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fit, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


@pytest.fixture
def pages(spark):
    return lambda urls: spark.createDataFrame(
        [(i, u, "x", "y") for i, u in enumerate(urls)], "page_id bigint, url string, rule string, hit string"
    )


def test_against_brute_force(spark, pages, rows):
    rules = [*RULES, ("block", "a.org", "/fr/x"), ("block", "a.org", ""), ("allow", "a.org", ""), ("block", "", "/")]
    for given in (RULES, rules):
        got = judge_urls(pages(URLS), rule_table(spark, given))
        assert rows(got) == sorted(((i, *brute(u, given)) for i, u in enumerate(URLS)), key=str)


def test_sql_says_the_same(spark, pages, rows):
    frame = duckdb.connect()
    frame.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    frame.executemany("INSERT INTO pages VALUES (?, ?)", list(enumerate(URLS)))
    want = frame.sql(ORACLE_SQL["op10_url_filter"]).fetchall()
    assert rows(judge_urls(pages(URLS), rule_table(spark))) == sorted(want, key=str)


def test_no_rules_no_pages_and_repeated_rows(spark, pages, rows):
    none = rule_table(spark, [])
    assert rows(judge_urls(pages(["http://x.net/"]), none), "rule", "verdict") == [(None, "allow")]
    assert rows(judge_urls(pages([]), rule_table(spark))) == []
    twice = pages(["http://x.net/"]).union(pages(["http://x.net/"]))
    assert rows(judge_urls(twice, rule_table(spark)), "page_id", "verdict") == [(0, "block")] * 2
