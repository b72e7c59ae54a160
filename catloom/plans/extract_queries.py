"""Extraction over pages and texts of the given tables."""

from __future__ import annotations

from html import unescape
from html.entities import html5

from pyspark.sql import Window
from pyspark.sql import functions as F

from catloom.operators import extract, markup
from catloom.plans.registry import query, spread, table


@query("""
with l as (select page_id, unnest(regexp_extract_all(html, '<li>(.*?)</li>', 1)) as item, generate_subscripts(regexp_extract_all(html, '<li>(.*?)</li>', 1), 1) as n from pages)
select page_id, n as pos, regexp_replace(item, '<[^>]*>', '', 'g') as text, null::varchar as section, 'before any header' as warning from l""")
def e_catalogue_items(spark, sf_dir):
    blocks = extract.page_blocks(table(spark, sf_dir, "pages"), {"item": ("li", ""), "header": ("h1", "")})
    out = extract.catalogue_items(blocks)
    return out.select("page_id", (F.col("pos") + 1).cast("long").alias("pos"), "text", "section", "warning")


@query("""
with l as (select page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) as link, generate_subscripts(regexp_extract_all(html, 'href="([^"]*)"', 1), 1) - 1 as pos from pages)
select page_id, link, min(pos) as pos, 1 as page from l where regexp_matches(link, '^/[a-z]') group by 1, 2""")
def e_links(spark, sf_dir):
    return extract.extract_links(table(spark, sf_dir, "pages"), "^/[a-z]")


@query("select p_partkey, p_name as \"Name\", p_brand as \"Brand\", p_size::varchar as \"Size\" from part")
def e_labelled(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    text = F.concat(F.lit("Name: "), "p_name", F.lit(" Brand: "), "p_brand", F.lit("\nSize: "), F.col("p_size").cast("string"))
    return p.select("p_partkey", extract.labelled(text, ["Name", "Brand", "Size"]).alias("x")).select("p_partkey", "x.*")


def _texts(spark, sf_dir):
    """For each order a text that numbers its lines."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_quantity")
    rows = spread(table(spark, sf_dir, "lineitem"), "l_orderkey").withColumn("n", F.row_number().over(w))
    return rows.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("n", "l_partkey"))).alias("rows"))


_NUMBERED = "with l as (select l_orderkey, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_quantity) as n, l_partkey from lineitem)"


@query(_NUMBERED + " select l_orderkey, 1 as list, n, 'part ' || l_partkey || case when n = 2 then ' 7 more' else '' end as entry from l")
def e_numbered(spark, sf_dir):
    entry = lambda r: F.concat(r["n"].cast("string"), F.lit(". part "), r["l_partkey"].cast("string"), F.when(r["n"] == 2, " 7) more,").otherwise(","))
    docs = _texts(spark, sf_dir).select("l_orderkey", F.concat(F.lit("Designs: "), F.array_join(F.transform("rows", entry), " ")).alias("text"))
    return extract.numbered(docs, "l_orderkey", "text")


@query(_NUMBERED + " select l_orderkey, 1 as list, n, 'part ' || l_partkey as entry from l where l_orderkey in (select l_orderkey from lineitem group by 1 having count(*) >= 2)")
def e_line_lists(spark, sf_dir):
    docs = _texts(spark, sf_dir).select("l_orderkey", F.concat(F.lit("Head\n"), F.array_join(F.transform("rows", lambda r: F.concat(F.when(r["n"] > 2, r["n"] + 10).otherwise(r["n"]).cast("string"), F.lit(") part "), r["l_partkey"].cast("string"))), "\n")).alias("text"))
    return extract.line_lists(docs, "l_orderkey", "text")


@query("select o_custkey, o_orderkey % 3 + 1 as n, coalesce(min('f' || o_totalprice) filter (where o_orderstatus = 'F') || ' / ' || min('p' || o_totalprice) filter (where o_orderstatus = 'P'), min('f' || o_totalprice) filter (where o_orderstatus = 'F'), min('p' || o_totalprice) filter (where o_orderstatus = 'P')) as entry from orders where o_orderstatus <> 'O' and o_custkey in (select o_custkey from orders where o_orderstatus <> 'O' group by 1 having min(o_orderkey % 3) = 0 and max(o_orderkey % 3) + 1 = count(distinct o_orderkey % 3)) group by 1, 2")
def e_pair_sides(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_orderstatus <> 'O'").select("o_custkey", (F.col("o_orderkey") % 3 + 1).alias("n"), F.when(F.col("o_orderstatus") == "F", "obverse").otherwise("reverse").alias("side"), F.concat(F.lower("o_orderstatus"), F.col("o_totalprice").cast("string")).alias("text"))
    return extract.pair_sides(o, ["o_custkey"], "n", "side", "text")


@query("select p_partkey, i - 1 as option, case i when 1 then case when p_partkey % 2 = 0 then 'gold' end else lower(p_type) end as choice from part, unnest([1, 2]) t(i) where i = 1 or p_partkey % 2 = 0")
def e_explode_options(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("two options (gold and "), F.lower("p_type"), F.lit(")"))).otherwise(F.col("p_name")).alias("text"))
    return extract.explode_options(p, "text").select("p_partkey", "option", "choice")


@query("with c as (select o_orderkey, count(l_orderkey) as found from orders left join lineitem on o_orderkey = l_orderkey group by 1) select o_orderkey, 4 as announced, found from c where found <> 4")
def e_check_complete(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.lit(4).cast("long").alias("announced"))
    return extract.check_complete(table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), o, "o_orderkey", "announced")[1]


@query("select p_partkey, case p_partkey % 3 when 0 then '1957' when 1 then '1960' when 2 then '1960' end as year, case p_partkey % 3 when 0 then 'M' when 1 then p_brand else '' end as mark, case p_partkey % 3 when 2 then 'u' else p_size::varchar end as unc from part")
def e_mintage(spark, sf_dir):
    k, size = F.col("p_partkey") % 3, F.col("p_size").cast("string")
    cells = F.when(k == 0, F.array(F.lit("1957"), size, F.lit("-"), F.lit("+"))).when(k == 1, F.array(F.lit("x"), F.col("p_brand"), size, F.lit("-"), F.lit("+"))).otherwise(F.array(F.lit("x"), F.lit("u"), F.lit("-"), F.lit("+")))
    return table(spark, sf_dir, "part").select("p_partkey", extract.mintage(cells, k == 0, F.lit(" 1960 "), F.lit("M")).alias("m")).select("p_partkey", "m.year", "m.mark", "m.unc")


@query("select page_id, case when page_id % 2 = 0 then 'Subject ' || page_id else 'Middle ' || page_id end as subject from pages")
def e_subject(spark, sf_dir):
    k = F.col("page_id").cast("string")
    headings = F.when(F.col("page_id") % 2 == 0, F.array(F.lit("Coin"), F.lit("Links"), F.concat(F.lit("Subject "), k))).otherwise(F.array(F.lit("links"), F.lit("Coin")))
    return table(spark, sf_dir, "pages").select("page_id", extract.subject(headings, F.lit("Coin"), F.concat(F.lit("1 euro - Middle "), k, F.lit(", Land - Site")), ["Links"]).alias("subject"))


@query("select page_id, case when html like '%Licensed%' then 'blocked' when page_id % 5 = 0 then 'other id' when page_id % 3 = 0 then 'other country' end as reject from pages")
def e_page_identity(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", F.col("page_id").alias("id"), F.lit("Perú").alias("country"), F.col("html").alias("text"))
    e = p.select("page_id", F.when(F.col("page_id") % 5 == 0, -1).otherwise(F.col("id")).alias("id"), F.when(F.col("page_id") % 3 == 0, "Chile").otherwise("peru").alias("country"))
    return extract.page_identity(p, e, "page_id", "Licensed").select("page_id", "reject")


@query("select l_orderkey, case when l_linenumber % 2 = 0 then 'obverse' else 'reverse' end as side, 'http://i.example.com/' || min(l_linenumber) || '-x.jpg' as url from lineitem where l_linenumber <> 3 group by 1, 2")
def e_available_sides(spark, sf_dir):
    n = F.col("l_linenumber")
    images = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(n % 2 == 0, "5 - Obverse").otherwise("5 - Reverse").alias("alt"), F.concat(F.when(n == 3, F.lit("http://other.example.com/")).otherwise(F.lit("http://i.example.com/")), n.cast("string"), F.lit("-x.jpg")).alias("url"))
    return extract.available_sides(images, ["l_orderkey"], "url", "alt", "l_linenumber", "^http://i[.]")


@query("""
with p as (select user_id, event_id // 500 as page, event_type, year(ts) as y from events), s as (select user_id, page, list_sort(list_distinct(list(event_type))) as v, bool_or(event_type = 'error') as hit from p group by 1, 2),
f as (select *, coalesce(v = lag(v) over (partition by user_id order by page), false) as same from s), g as (select *, sum(case when hit then 1 else 0 end) over (partition by user_id order by page) as run from f where not same),
m as (select *, sum(case when hit then 0 else 1 end) over (partition by user_id, run order by page) as miss from g), t as (select user_id, min(page) as stop from m where miss >= 2 group by 1)
select m.user_id, m.page from m left join t on m.user_id = t.user_id where stop is null or m.page <= stop""")
def e_trim_repeated(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", F.floor(F.col("event_id") / 500).alias("page"), "event_type", F.when(F.col("event_type") == "error", 2000).otherwise(1900).alias("y"))
    kept, _ = extract.trim_repeated(e, ["user_id"], "page", "event_type", "y", 2000, 2)
    return kept.select("user_id", "page").distinct()


@query()
def e_inventory(spark, sf_dir):
    """Machine slots with settled numbers; the greedy settlement has no SQL form."""
    p = table(spark, sf_dir, "part")
    slot = F.concat_ws(";", F.col("p_partkey").cast("string"), (F.col("p_size") % 5).cast("string"), F.col("p_name"), F.col("p_type"), F.lit("1"))
    pages = p.groupBy(F.col("p_brand").alias("page_id")).agg(F.array_join(F.array_sort(F.collect_list(slot)), "\n").alias("html"))
    return extract.inventory(pages, r"(?m)^(\d+);(\d+);([^;]*);([^;]*);(\d+)$")


# What the standard parser makes of references: names with a semicolon, and the longest old name that a reference without one
# starts with; numbers by code point, with the exceptions of HTML 5. A tag ends a reference, so it leaves a mark until then.
_ENTITY = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_BLANKS = r"[\x09-\x0D\x1C-\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
_quoted = lambda texts: "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in texts) + "]"
_REFERENCES = f"""n as (select map({_quoted("&" + k for k in html5)}, {_quoted(html5.values())}) as names, map({_quoted(str(k) for k in range(128, 160))}, {_quoted(unescape(f"&#{k};") for k in range(128, 160))}) as old)"""
_NUMBER = "case when x[2] <> '#' then null when lower(x[3]) = 'x' then try_cast('0x' || regexp_extract(x, '[0-9a-fA-F]+') as bigint) else coalesce(try_cast(regexp_extract(x, '[0-9]+') as bigint), 1114112) end"
_UNDONE = f"""list_transform(list_transform(regexp_extract_all(t, '{_ENTITY}'), lambda x: {{'x': x, 'n': {_NUMBER}}}), lambda r: case
 when r.x[2] = '#' then case when r.n is null or r.n = 0 or r.n > 1114111 or r.n between 55296 and 57343 then chr(65533) when old[r.n::varchar] is not null then old[r.n::varchar] when r.n = 13 then chr(13)
  when r.n < 9 or r.n = 11 or r.n between 14 and 31 or r.n = 127 or r.n between 64976 and 65007 or r.n & 65534 = 65534 then '' else chr(r.n::integer) end
 else coalesce(names[r.x], list_extract(list_filter(list_transform(range(length(r.x), 2, -1), lambda k: names[left(r.x, k)] || substr(r.x, k + 1)), lambda y: y is not null), 1), r.x) end)"""


@query(f"""
with {_REFERENCES},
r as (select page_id, 0 as part, regexp_extract(html, '(?s)<div class="ad">(.*?)</div>', 1) as t from pages where html like '%<div class="ad">%' union all select page_id, 1, regexp_extract(html, '(?is)<h1\\b[^>]*>(.*?)</h1>', 1) from pages where html like '%<div class="ad">%'),
s as (select page_id, part, string_split_regex(t, '{_ENTITY}') as texts, {_UNDONE} as undone from (select page_id, part, regexp_replace(t, '<[^>]*>', chr(1), 'g') as t from r), n),
u as (select page_id, part, trim(regexp_replace(replace(array_to_string(list_transform(range(1, len(texts) + 1), lambda i: texts[i] || coalesce(undone[i], '')), ''), chr(1), ''), '{_BLANKS}', ' ', 'g')) as t from s)
select a.page_id, a.t as section, 1 as n, regexp_replace(regexp_replace(b.t, '(?s)\\.\\s.*$', ''), '[\\s,;:.-]+$', '') as entry, 1 as layout from u a join u b on a.page_id = b.page_id and a.part = 0 and b.part = 1 where entry <> ''""")
def e_section_designs(spark, sf_dir):
    blocks = extract.page_blocks(table(spark, sf_dir, "pages"), {"header": ("div", "ad"), "item": ("h1", "")})
    return extract.section_designs(blocks).select("page_id", "section", "n", "entry", "layout")

@query(r"""
select page_id, regexp_extract(url, '^[^?#]*', 0) || '?page=' || (page_id % 9 + 1) || '&ref=x' as link, page_id % 9 + 1 as page, 'Next &' as text from pages
where regexp_extract(url, '[?&]ref=([^&#]*)', 1) = 'x'
union all select page_id, regexp_extract(url, '^[^?#]*', 0) || '?page=' || (page_id % 9 + 1), page_id % 9 + 1, 'no filter' from pages where not regexp_matches(url, '[?&]ref=')""")
def e_page_links(spark, sf_dir):
    """Links to further pages, in single quotes and with entities, resolved against the page's address."""
    n = (F.col("page_id") % 9 + 1).cast("string")
    more = F.concat(F.lit("<!-- <a href='?page=77&amp;ref=x'>no</a> --><div class='list pages'><a href=/other>o</a><A HREF='?page="), n, F.lit("&amp;ref=x#top'>Next\n &amp;</A><a href=\"?page="), n, F.lit("\">no filter</a></div>"))
    p = table(spark, sf_dir, "pages").select("page_id", "url", F.concat("html", more).alias("html"))
    out = markup.page_links(markup.page_elements(p, ["a"], url="url"), p, within="div.pages", same_query=["ref"])
    return out.select("page_id", "link", "page", "text")


@query("""
with i as (select page_id, unnest([0, 1, 2]) as n from pages)
select page_id, 'https://i.example.com/c/' || page_id || case n when 0 then '-1/a.jpg?x=1&y=2' when 1 then '-2s/b,c.jpg' else '-2/d.jpg' end as url, case n when 0 then 'obverse' else 'reverse' end as side from i where n < 2""")
def e_page_sides(spark, sf_dir):
    """First image of each side, from img elements and the candidates of a srcset."""
    k = F.col("page_id").cast("string")
    html = F.concat(F.lit("<base><img alt=Obverse src='/c/"), k, F.lit("-1/a.jpg?x=1&amp;y=2'><picture><source srcset=\"https://i.example.com/c/"), k, F.lit("-2s/b,c.jpg 1x,\n https://i.example.com/c/"), k, F.lit("-2/d.jpg 2x\"><img data-src=''></picture>"))
    p = table(spark, sf_dir, "pages").select("page_id", F.lit("https://i.example.com/list").alias("url"), html.alias("html"))
    found = markup.images(markup.page_elements(p, ["img", "source"], url="url")).withColumn("at", F.col("pos") * 1000 + F.col("n"))
    return extract.available_sides(found, ["page_id"], "url", "alt", "at", "^https://i[.]")


@query("""
select page_id, 'Machine ' || page_id || '|' || case page_id % 3 when 0 then 'Gone' when 1 then 'Open' else 'Moved & more' end || '|x' as cells, null::varchar as problem from pages where page_id % 4 <> 0
union all select page_id, null, case when page_id % 8 = 0 then 'no table row' else 'rows are too short' end from pages where page_id % 4 = 0""")
def e_form_rows(spark, sf_dir):
    """Table rows with the option that a form has selected; pages without rows are errors."""
    k, n = F.col("page_id").cast("string"), F.col("page_id") % 3
    chosen = F.when(n == 0, "<option selected>Gone<option>Open").when(n == 1, "<option value=1>Open</option><option>Gone").otherwise("<option>Open<option selected=selected value='m'>Moved &amp; more</option>")
    row = F.concat(F.lit("<table id=t><tr class=r><td>Machine\n"), k, F.lit("<td><select name=s>"), chosen, F.lit("</select></td><td>x</table>"))
    html = F.when(F.col("page_id") % 8 == 0, "<p>none</p>").when(F.col("page_id") % 4 == 0, "<table id='t'><tr><td>only</td></tr></table>").otherwise(row)
    p = table(spark, sf_dir, "pages").select("page_id", html.alias("html"))
    cells = markup.table_cells(markup.page_elements(p, ["tr", "td", "th", "select", "option"]), within="table#t")
    bad = markup.table_problems(p, cells, 3)
    good = cells.join(bad, "page_id", "left_anti").select("page_id", F.array_join("cells", "|").alias("cells"), F.lit(None).cast("string").alias("problem"))
    return good.unionByName(bad.select("page_id", F.lit(None).cast("string").alias("cells"), "problem"))


@query("""
select page_id, case page_id % 4 when 0 then 'Congo' when 1 then 'Democratic Republic of the Congo' when 2 then 'São Tomé' end as place,
 case page_id % 4 when 0 then '1 franc - Lion ' || page_id when 1 then 'Lion, ' || page_id when 2 then page_id || ' - Fish' end as subject from pages""")
def e_place_suffix(spark, sf_dir):
    """The longest place that a title ends with, among places that end alike."""
    k, n = F.col("page_id").cast("string"), F.col("page_id") % 4
    title = F.when(n == 0, F.concat(F.lit("1 franc - Lion "), k, F.lit(", Congo"))).when(n == 1, F.concat(F.lit("Lion, "), k, F.lit(", democratic  republic of the Congo"))).when(n == 2, F.concat(k, F.lit(" - Fish, Sao Tome"))).otherwise(F.concat(F.lit("Congo, Lion "), k))
    p = table(spark, sf_dir, "pages").select("page_id", title.alias("title"))
    places = spark.createDataFrame([("Congo",), ("Republic of the Congo",), ("Democratic Republic of the Congo",), ("São Tomé",), ("",)], "place string")
    return markup.place_at_end(p, "page_id", "title", places)
