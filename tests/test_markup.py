"""The tokenizer of tags and attributes, and what is made of its rows."""

from pyspark.sql import functions as F

from catloom.operators import extract, markup

PAGE = """<html><head><link href='x.css'><script>var a = "<a href='/no'>no</a>";</script><style>a{}</style></head><body>
<!-- <a href="/comment">no</a> -->
<div id="catalog-list"><div class='pages top'><a href='?a=1&amp;page=3'>3</a> <a href = "/list?page=x#f">x</a> <a href=/list?a=1>one <b>&lt;b&gt;</b></a><a>none</a><a href>blank</a></div></div>
<a href="http://[bad">bad</a><a HREF='/list?a=1' title="a > b">again</a>
<ul><li>one<ol><li>in<li>in 2</ol><li>two</ul><img src='s.jpg' alt="Obverse 'x'"><img data-src=d.jpg srcset="a,b.jpg 1x, c.jpg 2x"/></body>"""


def elements(spark, html, tags, **options):
    pages = spark.createDataFrame([(1, "https://host.example/list?page=2&a=1", html), (2, None, None), (3, "https://host.example/", "")], "page_id long, url string, html string")
    return markup.page_elements(pages, tags, **options), pages


def test_links_of_any_quotes(spark):
    got, pages = elements(spark, PAGE, ["a"])
    rows = [(r["link"], r["page"], r["text"]) for r in markup.links(got).orderBy("pos").collect()]
    assert rows == [("?a=1&page=3", 3, "3"), ("/list?page=x", None, "x"), ("/list?a=1", 1, "one <b>"), ("http://[bad", 1, "bad")]
    got, pages = elements(spark, PAGE, ["a"], url="url")
    rows = {r["link"]: r["page"] for r in markup.page_links(got, pages, within="div.pages", same_query=["a"]).collect()}
    assert rows == {"https://host.example/list?a=1&page=3": 3, "https://host.example/list?a=1": 1}
    assert markup.links(got, within="div#catalog-list").count() == 3 and markup.links(got, within="div.none").count() == 0
    assert {(r["link"], r["page"]) for r in extract.extract_links(pages, "^/list").collect()} == {("/list?page=x", None), ("/list?a=1", 1)}


def test_elements_and_their_parents(spark):
    got, _ = elements(spark, PAGE, ["li", "ul", "ol"])
    assert [(r["tag"], r["text"], r["parent"]) for r in got.orderBy("pos").collect()] == [("ul", "oneinin 2two", -1), ("li", "oneinin 2", 0), ("ol", "inin 2", 1), ("li", "in", 2), ("li", "in 2", 2), ("li", "two", 0)]
    got, _ = elements(spark, "<div><a href=1>open <b>more", ["a", "div"])
    assert [r["text"] for r in got.orderBy("pos").collect()] == ["open more", "open more"]


def test_images_and_srcsets(spark):
    got, _ = elements(spark, PAGE, ["img", "source"], url="url")
    assert [(r["url"], r["alt"]) for r in markup.images(got).orderBy("pos", "n").collect()] == [("https://host.example/s.jpg", "Obverse 'x'"), ("https://host.example/d.jpg", None), ("a,b.jpg", None), ("c.jpg", None)]
    sets = ["a.jpg", "a.jpg 1x,b.jpg 2.5x", " a.jpg 100w , b.jpg", "", None, "data:x,y 1x, z 2x"]
    rows = spark.createDataFrame(list(enumerate(sets)), "i int, s string").orderBy("i").select(markup.srcset(F.col("s")).alias("u")).collect()
    assert [r["u"] for r in rows] == [["a.jpg"], ["a.jpg", "b.jpg"], ["a.jpg", "b.jpg"], [], None, ["data:x,y", "z"]]


def test_choices_and_table_rows(spark):
    html = "<table id='DG'><tr class=h><th>A<th>B<tr><td>a&nbsp;1<br>x</td><td><select name=q><option value=0>no<option value=2 selected>two</select> left</td></tr><tr><td><select id=i><option>first</option><option>second</select><td><table><tr><td>inner</table></tr></table><select name=none></select>"
    got, pages = elements(spark, html, ["tr", "td", "th", "select", "option"])
    assert [(r["name"], r["value"], r["label"]) for r in markup.choices(got).orderBy("pos").collect()] == [("q", "2", "two"), ("i", "first", "first"), ("none", None, None)]
    cells = markup.table_cells(got, within="table#DG")
    assert [r["cells"] for r in cells.orderBy("pos").collect()] == [["A", "B"], ["a 1 x", "two"], ["first", "inner"], ["inner"]]
    assert {(r["page_id"], r["problem"]) for r in markup.table_problems(pages, cells, 2).collect()} == {(2, "no table row"), (3, "no table row")}
    assert {r["problem"] for r in markup.table_problems(pages, cells, 3).where("page_id = 1").collect()} == {"rows are too short"}


def test_longest_place(spark):
    places = spark.createDataFrame([("Congo",), ("Democratic Republic of the Congo",), ("the Congo",), (None,), ("",)], "place string")
    titles = ["1 franc - Lion, Democratic Republic of the Congo", "Lion, congo", "Congo", "Congo lion", None, "", "Lion of the  Congo"]
    rows = spark.createDataFrame(list(enumerate(titles)), "k int, t string")
    got = {r["k"]: (r["place"], r["subject"]) for r in markup.place_at_end(rows, "k", "t", places).collect()}
    assert got == {0: ("Democratic Republic of the Congo", "1 franc - Lion"), 1: ("Congo", "Lion"), 2: ("Congo", ""), 3: (None, None), 4: (None, None), 5: (None, None), 6: ("the Congo", "Lion of")}
    assert markup.place_at_end(rows, "k", "t", places.limit(0)).where("place is not null").count() == 0
