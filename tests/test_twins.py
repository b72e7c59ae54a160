"""Queries over pages against their SQL twins on odd pages."""

import duckdb
import pytest

import catloom.plans.extract_queries
import catloom.plans.scalar_queries  # noqa: F401
from catloom.plans.registry import ORACLES, QUERIES

HEADS = [
    "a &amp;amp; b &quot;c&quot;", "cut off &amp", "cut &quot", "&lt;b&gt; x &#39;y&#x27; &#65 &#128; &#0; &#xD800; &#1114112; &#31; &#99999999999999999999;", "&notit; &ampx &copy &copy;&hellip; &nosuch; & &;",
    "&am<b>p;</b> &amp<i>;</i>x", "two&nbsp;words.  And more", "", "  ", "x &NotEqualTilde; &fjlig;. y", "é&eacute&eacute;\n z,;", "&#xfdd0;a&#11;b", "a &amp; b &gt c",
]
URLS = ["https://a.org/x", "https://a.org/x?page=7", "https://a.org/x?page=&country=Chile", "https://a.org/x?a=1&page=x&country=", "https://a.org/x?page=1.5#page=3", "https://a.org/x#?page=4"]


@pytest.mark.parametrize("name", ["e_page_text", "e_section_designs"])
def test_odd_pages(spark, tmp_path, name):
    pages = [(i, URLS[i % len(URLS)], f'<div class="ad">{ad}</div><h1 class=x>{h}</h1><img alt="i &amp; {i}">') for i, (h, ad) in enumerate((h, ad) for h in HEADS for ad in ("plain", h or "blank"))]
    pages += [(100, URLS[0], "<p>none</p>"), (101, URLS[2], '<link rel="canonical" href="https://a.org/?country=Peru"><h1> </h1>'), (102, URLS[0], '<link rel="canonical" href="https://a.org/?country=Peru">')]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    df = QUERIES[name](spark, str(tmp_path))
    duck = duckdb.connect()
    duck.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    duck.execute("create table want as " + ORACLES[name])
    want = duck.execute("select " + ", ".join(f'"{c}"' for c in df.columns) + " from want").fetchall()
    got = sorted(map(tuple, df.collect()), key=str)
    assert got == sorted(want, key=str) and len(got) > 15
