"""URL filters: validity intervals and odd captures."""

import datetime

from pyspark.sql import functions as F

from gridloom.llm import urlfilter

D = datetime.date


def test_lists_active_at_fetch_time(spark):
    entries = [
        ("ads", "domain", "example.com", True, D(2024, 1, 10)), ("ads", "domain", "example.com", False, D(2024, 1, 20)), ("ads", "domain", "example.com", True, D(2024, 2, 1)),
        ("ads", "domain", "example.com", True, D(2024, 2, 1)), ("bad", "prefix", "a.example.com/x", True, D(2024, 1, 1)), ("odd", "domain", "b.org", True, D(2024, 1, 5)),
        ("odd", "domain", "b.org", False, D(2024, 1, 5)), (None, "domain", "c.org", True, D(2024, 1, 1)), ("n", "domain", "c.org", True, None),
    ]
    e = spark.createDataFrame(entries, "list string, kind string, value string, listed boolean, at date")
    cases = [
        ("http://A.Example.com:80/x/y", D(2024, 1, 10), ["ads", "bad"]), ("https://u@a.example.com./x?q", D(2024, 1, 20), ["bad"]), ("http://example.com", D(2024, 1, 9), []),
        ("http://example.com#f", D(2024, 2, 1), ["ads"]), ("http://notexample.com/", D(2024, 1, 12), []), ("http://b.org/", D(2024, 1, 6), []), ("http://c.org/", D(2024, 1, 6), []),
        (None, D(2024, 1, 12), []), ("", D(2024, 1, 12), []), ("mailto:x", D(2024, 1, 12), []), ("http://example.com/", None, []), ("http://example.com/" + "p" * 200_000, D(2024, 1, 12), ["ads"]),
    ]
    rows = [(i, u, f, "x") for i, (u, f, _) in enumerate(cases)] + [(0, *cases[0][:2], "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, fetched date, value string").withColumn("lists", F.lit(1))
    df = df.selectExpr("*", "map('a', 1) AS kind", "1 AS `row`", "2 AS `_key`", "3 AS start")
    got = sorted((r.page_id, r.lists) for r in urlfilter.match_lists(df, e).collect())
    assert got == sorted([(i, want) for i, (_, _, want) in enumerate(cases)] + [(0, cases[0][2])])


def test_shuffled_join_gives_the_same(spark, sf, monkeypatch):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    before = sorted(map(tuple, urlfilter.op2(pages).collect()))
    monkeypatch.setattr(urlfilter, "BROADCAST_KEYS", 0)
    assert sorted(map(tuple, urlfilter.op2(pages).collect())) == before and any(r[4] for r in before)
