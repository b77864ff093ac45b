"""URL lists and line removal: the queries against their SQL, odd rows, and plans without Python."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF_DIR
from tests.oracle import connect, difference
from tidelane.llm import lines, urls
from tidelane.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", ["op6_listed_urls", "op7_site_lines"])
@pytest.mark.parametrize("sf", [SF_DIR, "/root/testdata/sf0.01"])
def test_query(spark, name, sf):
    frame = QUERIES[name](spark, sf)
    assert difference(frame, connect(sf), ORACLES[name]) is None
    assert "Python" not in frame._jdf.queryExecution().toString() and "Arrow" not in frame._jdf.queryExecution().toString()


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(n)


ENTRIES = [
    ("bad", "Example.com", "add", day(5)), ("bad", "example.com", "add", day(6)), ("bad", "example.com", "remove", day(10)), ("bad", "example.com", "add", day(20)),
    ("ads", "a.example.com", "remove", day(1)), ("ads", "a.example.com", "add", day(3)), ("ads", "a.example.com", "add", day(4)), ("ads", "a.example.com", "remove", day(4)),
    ("path", "b.org/x/y", "add", day(0)), ("path", "b.org/x/y", "add", day(0)), (None, "b.org", "add", day(0)), ("bad", None, "add", day(0)), ("bad", "b.org", "other", day(0)), ("bad", "b.org", "add", None),
]


def brute(entries, keys, when):
    events = {}
    for name, key, action, at in entries:
        if None not in (name, key, at) and action in ("add", "remove"):
            k = (name, key.lower())
            events.setdefault(k, {})
            events[k][at] = events[k].get(at, False) or action == "remove"
    found = []
    for (name, key), days in events.items():
        past = [at for at in days if when is not None and at <= when]
        if key in keys and past and not days[max(past)]:
            found.append(name)
    return len(found), ",".join(sorted(set(found)))


def test_lists_as_of_each_day(spark):
    entries = spark.createDataFrame(ENTRIES, "list string, key string, action string, day date")
    cases = {
        "http://A.Example.com./p?q=//z#f": ["a.example.com", "example.com", "com", "a.example.com/p"],
        "https://u:p@b.org:8080/x/y/z": ["b.org", "org", "b.org/x", "b.org/x/y", "b.org/x/y/z"],
        "b.org/x//y": ["b.org", "org", "b.org/x", "b.org/x/y"], "": [], None: [], "http:///x": [], "http://notexample.com": ["notexample.com", "com"],
    }
    rows = [(i, url, day(n)) for i, (url, n) in enumerate((u, n) for u in cases for n in range(0, 25))] + [(900, "http://example.com", None), (None, "http://example.com", day(7)), (0, "http://A.Example.com./p?q=//z#f", day(0))]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, fetched date, key string")
    keyed = urls.with_keys(spark.createDataFrame([(u, 1) for u in cases], "url string, url_depth int"), "url", "k").collect()
    assert sorted((r.url, r.k) for r in keyed) == sorted((u, k) for u, keys in cases.items() for k in keys)
    want = sorted((str(i), url, *brute(ENTRIES, cases.get(url, ["example.com", "com"]), at)) for i, url, at in set(rows) if url is not None)
    found = urls.listed(frame, entries).collect()
    assert sorted((str(r.page_id), r.url, r.n_entries, r.lists) for r in found if r.url is not None) == want
    assert all(r.blocked == (r.n_entries > 0) for r in found) and not any(r.blocked for r in found if r.url is None)
    assert urls.listed(frame, entries.limit(0)).where("blocked").count() == 0 and urls.listed(frame.limit(0), entries).count() == 0


def test_very_long_urls(spark):
    """90 KB of path steps, of host labels and of query: only depths that the lists have are looked up."""
    rows = [(1, "http://long.org/" + "/".join(["ab"] * 30_000)), (2, "http://" + "a." * 30_000 + "long.org/x"), (3, "http://long.org/ab?" + "q/" * 45_000), (4, "long.org" + "/" * 90_000 + "ab")]
    captures = spark.createDataFrame([(i, u, day(9)) for i, u in rows], "page_id long, url string, fetched date")
    keys = ["long.org/ab", "long.org/ab/ab/ab", "long.org/" + "/".join(["ab"] * 29_999), "long.org", "a.long.org", "a." * 20_000 + "long.org", "x.org/a/b/c/d/e"]
    entries = spark.createDataFrame([("l", k, "add", day(0)) for k in keys], "list string, key string, action string, day date")
    assert {r.page_id: r.n_entries for r in urls.listed(captures, entries).collect()} == {1: 4, 2: 3, 3: 2, 4: 2}


def test_lines_by_site(spark):
    rows = [(i, f"menu\nown {i}\n\n  \nmenu", "a", 1) for i in range(6)] + [(6, "menu\nother", "b", 1), (7, "copy", "c", 1), (8, "copy", "c", 1), (9, None, "c", 1), (10, "", None, 1), (11, "x", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, line int")
    found = {r.doc_id: r for r in lines.drop_boilerplate(docs, "found", ratio=0.5, least_pages=2).collect()}
    assert [found[i].text for i in range(12)] == [*(f"own {i}\n\n  " for i in range(6)), "menu\nother", "", "", None, "", "x"]
    assert [tuple(found[i].found) for i in (0, 6, 7, 9, 10)] == [(5, 2), (2, 0), (1, 1), (1, 0), (1, 0)]
    whole = {r.doc_id: r.text for r in lines.drop_boilerplate(docs, "found", ratio=0.5, least_pages=2, keep_whole=True).collect()}
    assert whole[7] == whole[8] == "copy" and whole[0] == "own 0\n\n  "
    alone = spark.createDataFrame([(1, "copy\nmenu", "c"), (2, "copy\nmenu\n", "c"), (3, "menu", "c"), (4, "menu", "d"), (5, "other", "d")], "doc_id long, text string, source string")
    whole = {r.doc_id: r.text for r in lines.drop_boilerplate(alone, "found", ratio=0.5, least_pages=2, keep_whole=True).collect()}
    assert whole == {1: "", 2: "", 3: "", 4: "menu", 5: "other"}  # the same text on another site stays there


def test_odd_rows(spark, odd, nothing):
    out = lines.drop_boilerplate(odd, "found", ratio=0.2, least_pages=2)
    assert out.columns == [*(c for c in odd.columns if c != "found"), "found"] and out.count() == odd.count()
    assert out.where("doc_id = 4 AND text = ''").count() == 2
    assert out.where("doc_id = 8").join(odd.where("doc_id = 8"), "text").count() == 1
    assert lines.drop_boilerplate(nothing, "found").count() == 0
