from __future__ import annotations

import pytest

from quitanda.llm.oracle import oracle_sql
from quitanda.llm.urls import judge_urls


def by_sql(urls):
    import duckdb

    with duckdb.connect() as connection:
        connection.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
        connection.executemany("INSERT INTO pages VALUES (?, ?)", list(enumerate(urls)))
        return connection.execute(oracle_sql()["op5_url_filter"]).fetchall()


def judged(spark, urls, **options):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    return sorted(judge_urls(pages, **options).collect())


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("no scheme.com/en/", "", "", None, "allow"),
        ("http://Example.COM/en/x", "example.com", "/en/x", "example.com/en/", "block"),
        ("http://www.example.com/en/x?q#f", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
        ("http://a.www.example.com/en/", "a.www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("http://badexample.com/en/", "badexample.com", "/en/", "com/", "allow"),
        ("http://casino.com/", "casino.com", "/", "com/", "allow"),
        ("http://x.com", "x.com", "", None, "allow"),
        ("http://x.com:80/", "x.com:80", "/", None, "allow"),
        ("http://x.net/es/1", "x.net", "/es/1", "net/es/", "block"),
        ("http://x.net/ES/1", "x.net", "/ES/1", None, "allow"),
        ("http://x.net/a://b/es/", "x.net", "/a://b/es/", None, "allow"),
        ("http://casino.org/", "casino.org", "/", None, "block"),
        ("http://casinos.org/", "casinos.org", "/", None, "allow"),
        ("http://x.org/CASINO", "x.org", "/CASINO", None, "block"),
        ("http://free.org/free/free", "free.org", "/free/free", None, "allow"),
        ("http://free.org/bets", "free.org", "/bets", None, "block"),
        ("http://spam-farm.org/", "spam-farm.org", "/", None, "block"),
        ("http://x.org/?casino", "x.org", "/", None, "block"),
        ("https://x.org/search?q=porn", "x.org", "/search", None, "block"),
        ("https://x.org/a#casino", "x.org", "/a", None, "block"),
        ("http://x.org/%70or%4E", "x.org", "/%70or%4E", None, "block"),
        ("http://x.org/%6%61", "x.org", "/%6%61", None, "allow"),
        ("casino.org/xxx", "", "", None, "block"),
        ("http://x.org/ésex", "x.org", "/ésex", None, "block"),
        ("http://x.org/sex٣", "x.org", "/sex٣", None, "block"),
        ("http://x.org/sexy", "x.org", "/sexy", None, "allow"),
        ("http://free.org/win", "free.org", "/win", None, "allow"),
        ("http://free.org/win?click", "free.org", "/win", None, "block"),
        ("http://poker.org/poker#poker", "poker.org", "/poker", None, "allow"),
    ],
)
def test_rules_and_vocabulary(spark, url, host, path, rule, verdict):
    row = judged(spark, [url])[0]
    assert (row.host, row.path, row.rule, row.verdict) == (host, path, rule, verdict)
    assert by_sql([url]) == [(0, host, path, rule, verdict)]


def test_weights_terms_and_repeats(spark):
    rows = judged(spark, ["http://free.org/win"] * 2, soft={"free": 1, "win": 2}, limit=3)
    assert [r.soft_terms for r in rows] == [["free", "win"]] * 2
    assert {r.verdict for r in rows} == {"block"}
    assert judged(spark, []) == []
    assert judged(spark, ["http://casino.org/"], strict=(), soft={})[0].verdict == "allow"


def test_clashing_columns_and_a_very_long_url(spark):
    rows = [(1, "http://h.org/" + "a/" * 50_000 + "casino", "x", "y")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, verdict string")
    assert judge_urls(pages).first().strict_terms == ["casino"]
