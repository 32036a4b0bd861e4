from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.llm import urllists


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_entries_count_while_they_are_active(spark):
    entries = [
        ("spam", "bad.example", day(2), True), ("spam", "BAD.example", day(5), False), ("spam", "bad.example", day(7), True), ("spam", "bad.example", day(7), False),
        ("adult", "a.example/x/y", day(0), True), ("good", "ok.bad.example", day(0), True), (None, "a.example", day(0), True), ("spam", "a.example", None, True),
        ("spam", "never.example", day(3), False), ("adult", "a.example/x/y", day(0), True),
    ]
    captures = [
        ("http://bad.example/", 1), ("http://bad.example/", 2), ("http://www.bad.example", 4), ("http://bad.example/q", 5), ("http://bad.example/q", 9), ("http://ok.bad.example/", 3),
        ("https://a.example/x/y/z?q#f", 0), ("https://a.example/x/yy", 0), ("https://A.example:80/x//y", 3), ("no url", 3), (None, 3), ("http://bad.example/", None), ("http://notbad.example/", 3),
        ("http://bad.example/", 2), ("http://never.example/", 4), ("http://" + "a." * 30 + "bad.example/" + "s/" * 300, 8),
    ]
    df = spark.createDataFrame([(u, None if d is None else day(d), "x") for u, d in captures], "url string, day date, pattern string")
    got = urllists.judged(df, spark.createDataFrame(entries, "list string, pattern string, day date, added boolean"), allow="good").collect()
    found = sorted(((r.url or "", str(r.day), ",".join(r.lists), r.blocked) for r in got))
    on = {("http://bad.example/", 2): "spam", ("http://www.bad.example", 4): "spam", ("http://bad.example/q", 9): "spam", ("http://ok.bad.example/", 3): "good,spam", ("https://a.example/x/y/z?q#f", 0): "adult", ("https://A.example:80/x//y", 3): "adult", (captures[-1][0], 8): "spam"}
    want = sorted((u or "", str(None if d is None else day(d)), on.get((u, d), ""), on.get((u, d), "") not in ("", "good,spam")) for u, d in captures)
    assert found == want
    assert urllists.judged(df.limit(0), spark.createDataFrame([], "list string, pattern string, day date, added boolean")).count() == 0


def test_hosts_without_user_port_and_closing_dot(spark):
    urls = {"http://user:pw@bad.example/": "bad.example", "http://Bad.example.:8080/x": "bad.example", "http://[::1]:80/": "[::1]", "ftp://a@b@c.example?u@v": "c.example", "http://c.example/@x": "c.example", "http://": "", "mailto:a@b": "", None: ""}
    got = spark.createDataFrame([(u,) for u in urls], "u string").select("u", urllists.host_of(F.col("u")).alias("h")).collect()
    assert {r.u: r.h for r in got} == urls


def test_columns_of_any_name_travel_along(spark):
    entries = spark.createDataFrame([("spam", "bad.example", day(0), True)], "list string, pattern string, day date, added boolean")
    df = spark.createDataFrame([("http://u:p@bad.example/", day(1), "a", 2, True, "n", "s")], "url string, day date, lists string, n_entries int, blocked boolean, names string, `si.nce` string")
    got = urllists.judged(df, entries)
    assert got.columns == ["url", "day", "names", "si.nce", "lists", "n_entries", "blocked"]
    assert tuple(got.first())[2:] == ("n", "s", ["spam"], 1, True)
