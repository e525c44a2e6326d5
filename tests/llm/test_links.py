"""Links of every form, and a header of any length."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamina.llm import urls, warc


def test_links_of_every_form(spark):
    forms = {
        "next.html": "h.net/a/b/next.html", "./n": "h.net/a/b/n", "../x": "h.net/a/x", "../../../x": "h.net/x", "..": "h.net/a/", "?p=2": "h.net/a/b/c?p=2", "/r": "h.net/r", "/a/../s": "h.net/s", "//o.net/t": "o.net/t", "HTTPS://o.net/u": "o.net/u",
        "/go?u=http://x.com/de/1": "h.net/go?u=http://x.com/de/1", "y?u=http://x.com/": "h.net/a/b/y?u=http://x.com/",
    }
    links = spark.createDataFrame([(x,) for x in [*forms, "#f", "mailto:a@b.c"]], "to string")
    full = urls.resolve(F.col("to"), urls.host_of(F.lit("http://h.net/a/b/c?q#f")), urls.path_of(F.lit("http://h.net/a/b/c?q#f")))
    assert {r.to: r.place for r in links.select("to", urls.place_of(full).alias("place")).collect()} == forms | {"#f": None, "mailto:a@b.c": None}


def test_relative_links_pass_blocks_on(spark):
    page = '<link rel="canonical" href="{}">'
    data = [(1, "http://a.net/d/x", page.format("../bad/y")), (2, "http://b.net/d/x", page.format("/go?u=http://x.com/de/1")), (3, "http://c.net", page.format("bad/y"))]
    rules = [("block", "a.net/bad/"), ("block", "x.com/de/"), ("block", "c.net/bad/")]
    got = urls.judge_urls(spark.createDataFrame(data, "page_id long, url string, html string"), rules).collect()
    assert {r.page_id: r.verdict for r in got} == {1: "block", 2: "allow", 3: "block"}


def test_warc_of_a_very_long_url(spark):
    pages = spark.createDataFrame([(1, "http://a/" + "x" * 70_000, "one"), (2, "http://b", "three")], "page_id long, url string, html string")
    assert sorted(r[:2] for r in warc.archive_round_trip(pages).collect()) == [(1, 3), (2, 5)]
