"""Scalar functions over text, urls and years of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catloom.functions import records, text, urls, years
from catloom.operators import extract
from catloom.plans.registry import query, table

_FROM, _TO = text._ACCENTED, text._PLAIN
_FOLD = f"translate(lower({{0}}), '{_FROM}', '{_TO}')"
_SLUG = "regexp_replace(regexp_replace(" + _FOLD + ", '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"


@query(f"""
with d as (select doc_id, replace(replace(replace(replace(replace(replace(text, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') as t, text as head from documents)
select doc_id, md5(trim(regexp_replace(t, '[\\s\\x{{A0}}]+', ' ', 'g'))) as clean_md5, md5({_SLUG.format('head')}) as slug,
  md5(trim(regexp_replace(regexp_replace({_FOLD.format('head')}, '[^\\x00-\\x7F]', '', 'g'), '\\s+', ' ', 'g'))) as folded,
  md5(trim(regexp_replace(lower(head), '\\s+', ' ', 'g'))) as visible,
  md5(regexp_replace(regexp_replace(lower(trim(head)), '[^a-z0-9À-ÿ]+', '-', 'g'), '^-+|-+$', '', 'g')) as research from d""")
def n_text_folds(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    folds = {"clean_md5": text.clean_ws, "slug": text.slugify, "folded": text.fold_text, "visible": text.fold_keep_accents, "research": text.research_key}
    return d.select("doc_id", *[F.md5(fold(F.col("text")).cast("binary")).alias(name) for name, fold in folds.items()])


@query("""
with p as (select p_partkey, case p_partkey %% 4 when 0 then p_size || ' Cents' when 1 then p_size || ',5 øre' when 2 then '½ dolar ' || p_name else p_size || ' ½ pence' end as name from part),
t as (select p_partkey, name, regexp_extract_all(replace(translate(lower(name), '%s', '%s'), '½', ' 1 2 '), '\\d+(?:[.,]\\d+)?|[a-zø]+') as toks from p)
select p_partkey, name, array_to_string(list_transform(toks, lambda x: case x when 'cents' then 'cent' when 'øre' then 'ore' when 'dolar' then 'dollar' when 'pence' then 'penny' else x end), ' ') as name_key,
  list_contains(toks, '2') as has_two from t""" % (_FROM, _TO))
def n_normal_keys(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    size = F.col("p_size").cast("string")
    name = F.when(F.col("p_partkey") % 4 == 0, F.concat(size, F.lit(" Cents"))).when(F.col("p_partkey") % 4 == 1, F.concat(size, F.lit(",5 øre"))).when(F.col("p_partkey") % 4 == 2, F.concat(F.lit("½ dolar "), "p_name")).otherwise(F.concat(size, F.lit(" ½ pence")))
    p = p.select("p_partkey", name.alias("name"))
    return p.select("p_partkey", "name", text.normalize_key(F.col("name")).alias("name_key"), text.contains_sequence(text.key_tokens(F.col("name")), F.array(F.lit("2"))).alias("has_two"))


@query("""
with p as (select p_partkey, p_size as n, case p_partkey % 3 when 0 then '1.' || lpad(p_size::varchar, 3, '0') || ' escudos' when 1 then p_size || ',25 euro' else 'no amount' end as name from part)
select p_partkey, case p_partkey % 3 when 0 then '1' || lpad(n::varchar, 3, '0') || ';1.' || lpad(n::varchar, 3, '0') || ';1 ' || lpad(n::varchar, 3, '0') when 1 then n || '25;' || n || ',25;' || n || ' 25' else '' end as variants,
  case p_partkey % 3 when 0 then (1000 + n)::double when 1 then (n + 0.25)::double end as scaled,
  case p_partkey % 3 when 1 then (n + 0.25)::double when 0 then (1 + n / 1000.0)::double end as value,
  case p_partkey % 3 when 0 then 'escudos' when 1 then 'euro' end as unit,
  case p_partkey % 3 when 2 then 'no amount' else name end as label from p""")
def n_amounts(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    padded = F.lpad(F.col("p_size").cast("string"), 3, "0")
    name = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("1."), padded, F.lit(" escudos"))).when(F.col("p_partkey") % 3 == 1, F.concat(F.col("p_size").cast("string"), F.lit(",25 euro"))).otherwise(F.lit("no amount"))
    p = p.select("p_partkey", name.alias("name"))
    parsed = text.parse_amount_unit(F.concat("name", F.lit(", 1957-61")))
    return p.select("p_partkey", F.array_join(F.transform(text.amount_variants(F.col("name")), lambda v: F.array_join(v, " ")), ";").alias("variants"), text.scaled_amount(F.col("name"), F.lit(None).cast("string"), {"escudos": 1.0, "euro": 1.0}).alias("scaled"), parsed["value"].alias("value"), parsed["unit"].alias("unit"), parsed["name"].alias("label"))


@query("""
select p_partkey, lower(p_type) as composition, (p_size + 0.5)::double as grams, p_size::double as millimetres, 'KM' as catalogue, p_partkey::varchar as number, p_brand as category,
 'A' as country, p_name as ruler, 1900 + p_size as first, 1950 + p_size as last, p_name as label,
 case p_partkey % 4 when 0 then 'historical' when 1 then 'withdrawn' when 2 then 'scarce' else 'circulating' end as availability,
 case when p_partkey % 2 = 0 then 'historical' else 'circulating' end as fallback
from part""")
def n_technical(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    size = F.col("p_size").cast("string")
    info = F.concat(F.lower("p_type"), F.lit(", "), size, F.lit(",5 g, ø "), size, F.lit(" mm KM# "), F.col("p_partkey").cast("string"), F.lit(" · "), F.col("p_brand"))
    head = F.concat(F.lit("A › "), F.col("p_name"), F.lit(" › "), (F.col("p_size") + 1900).cast("string"), F.lit(" - "), (F.col("p_size") + 1950).cast("string"))
    t, h = text.parse_technical(info), text.parse_period_header(head, years.parse_years)
    own = F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).otherwise(F.lit(" "))
    k = F.col("p_partkey")
    era = F.when(k % 2 == 0, "Old Realm of the North").otherwise("Republic")
    return p.select(
        "p_partkey", t["composition"].alias("composition"), F.round(t["grams"], 2).alias("grams"), t["millimetres"].alias("millimetres"), t["catalogue"].alias("catalogue"), t["number"].alias("number"), t["category"].alias("category"),
        h["country"].alias("country"), h["ruler"].alias("ruler"), h["first"].alias("first"), h["last"].alias("last"), text.group_label(own, F.lit(None).cast("string"), head).alias("label"),
        text.availability(k % 4 == 0, k % 4 == 1, k % 4 == 2).alias("availability"), text.fallback_availability(era, ["old realm"]).alias("fallback"),
    )


@query("""
with u as (select page_id, url, regexp_extract(url, '^(https?)://', 1) as scheme, lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) as host, regexp_extract(regexp_replace(url, '[?#].*$', ''), '^https?://[^/]+(.*)$', 1) as path, regexp_extract(url, '\\?([^#]*)', 1) as q from pages),
v as (select *, regexp_replace(path, '/+$', '') as p, array_to_string(list_sort(list_filter(string_split(q, '&'), lambda x: x <> '' and x <> 'page=' and x <> 'page=1')), '&') as sq from u)
select page_id, scheme || '://' || host || p || case when sq <> '' then '?' || sq else '' end as canonical,
 try_cast(nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') as bigint) as page,
 regexp_replace(regexp_replace(lower(regexp_replace(regexp_extract(p, '([^/]*)$', 1), '\\.[A-Za-z0-9]+$', '')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') as stem,
 regexp_replace(url, '#.*$', '') as bare, true as was_markdown, scheme <> '' as is_http, nullif(regexp_extract(p, '([^/]*)$', 1), '') as record_id from v""")
def n_urls(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    u = F.col("url")
    md = urls.unwrap_markdown(F.concat(F.lit("[page]("), u, F.lit(")")))
    return p.select("page_id", urls.canonical_page_url(u).alias("canonical"), urls.query_int(u, "page").alias("page"), urls.url_stem(u).alias("stem"), md["url"].alias("bare"), md["was_markdown"].alias("was_markdown"), urls.is_http_url(u).alias("is_http"), urls.record_id(F.lit(None).cast("string"), u).alias("record_id"))


@query("""
with s as (select page_id, regexp_replace(regexp_replace(lower(regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') as lang, page_id % 3 as k from pages)
select page_id, lang || '-coin' as stripped, k <> 1 as compatible, page_id::varchar as asset, case when page_id % 2 = 0 then 'obverse' else 'reverse' end as side, 'https://i.example.com/c/' || page_id || case when page_id % 2 = 0 then '-2/' else '-1/' end || lang || '-1957.jpg' as other_side, 1957 as year,
 'https://x.example.com/r/' || page_id || '#p' || page_id as reference from s""")
def n_slugs_images(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    lang = F.regexp_extract("url", r"^https?://[^/]+/([a-z]+)/", 1)
    slug = F.concat(text.slugify(lang), F.lit("-coin-1957-1961"))
    other = F.when(F.col("page_id") % 3 == 0, F.lit("")).when(F.col("page_id") % 3 == 1, F.lit("another-thing")).otherwise(F.concat(lang, F.lit("-coin")))
    image = urls.image_parts(F.concat(F.lit("https://i.example.com/c/"), F.col("page_id").cast("string"), F.when(F.col("page_id") % 2 == 0, "-1s/").otherwise("-2/"), lang, F.lit("-1957.jpg")))
    return p.select("page_id", urls.strip_trailing_years(slug).alias("stripped"), urls.slug_compatible(slug, other).alias("compatible"), image["asset"].alias("asset"), image["side"].alias("side"), image["other_side"].alias("other_side"), image["year"].alias("year"), urls.reference_url("https://x.example.com/r/", F.col("page_id"), fragment=F.concat(F.lit("p"), F.col("page_id").cast("string"))).alias("reference"))


@query("""
with o as (select o_orderkey, year(o_orderdate) as y, o_orderkey % 7 as d from orders)
select o_orderkey, y as first, y + d as last, y as least, y + d as greatest, y as sort_first, y + d as sort_last, d > 3 as extends,
 case when d = 0 and o_orderkey % 2 = 1 then y end as single from o""")
def n_years(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"), (F.col("o_orderkey") % 7).alias("d"))
    last = F.col("y") + F.col("d")
    span = F.concat("y", F.lit(" - "), last)
    a, b, k = years.parse_years(span), years.year_bounds(F.concat(F.lit("ab "), span, F.lit(" 12345"))), years.issue_sort_key(span)
    url = F.when(F.col("o_orderkey") % 2 == 1, F.concat(F.lit("https://x.example.com/coin-"), last)).otherwise(F.lit("https://x.example.com/coin"))
    short = F.concat("y", F.lit("-"), F.col("y") + 3)
    return o.select("o_orderkey", a["first"].alias("first"), a["last"].cast("bigint").alias("last"), b["first"].alias("least"), b["last"].cast("bigint").alias("greatest"), k["first"].alias("sort_first"), k["last"].cast("bigint").alias("sort_last"), years.safe_year_extension(short, span).alias("extends"), years.single_year(url, F.col("y"), last).cast("bigint").alias("single"))


@query("""
select l_orderkey, l_linenumber, l_partkey, l_shipdate,
 case when l_linenumber % 3 = 0 then false else l_quantity > 0 end as quantity_known,
 case when l_linenumber % 2 = 0 then case when l_returnflag = 'N' then 'no mark' else l_returnflag end else trim(year(l_shipdate) || ' ' || case when l_returnflag = 'N' then '' else l_returnflag end) end as tag,
 case l_returnflag when 'N' then 0 else 50 end as rank, l_linenumber + 4 as total,
 case when l_linestatus = 'O' then 'open' else 'closed' end as kind,
 case when l_linenumber % 100 between 11 and 13 then l_linenumber || 'th' when l_linenumber % 10 = 1 then l_linenumber || 'st' when l_linenumber % 10 = 2 then l_linenumber || 'nd' when l_linenumber % 10 = 3 then l_linenumber || 'rd' else l_linenumber || 'th' end as nth,
 case when l_linestatus = 'O' then l_returnflag || ' / ' || l_linestatus else l_returnflag end as notes,
 sha256('{"a":' || l_orderkey || ',"b":"' || l_returnflag || '"}') as hash
from lineitem""")
def n_marks(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    n = F.col("l_linenumber")
    mark = F.when(F.col("l_returnflag") == "N", F.lit(" ")).otherwise(F.col("l_returnflag"))
    return l.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", text.has_quantity(F.when(n % 3 == 0, F.lit("-")).otherwise(F.col("l_quantity").cast("string"))).alias("quantity_known"),
        text.variant_tag(F.year("l_shipdate"), mark, n % 2 == 0).alias("tag"), text.variant_rank(F.trim(mark)).alias("rank"), text.sum_counts(F.concat(n.cast("string"), F.lit("e 4t"))).alias("total"),
        text.kind_of(F.col("l_linestatus"), (("^o$", "open"),), "closed").alias("kind"), text.ordinal(n).alias("nth"), text.join_nonblank(" / ", F.col("l_returnflag"), F.when(F.col("l_linestatus") == "O", F.col("l_linestatus")).otherwise(F.lit(" "))).alias("notes"),
        records.row_hash(F.col("l_returnflag"), F.col("l_orderkey"), names=["b", "a"]).alias("hash"),
    )


_LINE = r"""trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_extract(text, '^[^\n]*', 0), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[\s\x{A0}]+', ' ', 'g'))"""


@query(
    r"with d as (select *, " + _LINE + r""" as line from documents),
t as (select *, coalesce(nullif(regexp_extract(line, '"([^"]+)"', 1), ''), regexp_replace(line, '(?i),? with .*$', '')) as subject from d)
select doc_id, case length(trim(coalesce(lang, ''))) when 0 then 0 else 1 end + case length(trim(coalesce(source, ''))) when 0 then 0 else 1 end + 1 as filled,
 case when length(subject) > 40 then regexp_replace(substr(subject, 1, 40), '\s+\S*$', '') || '…' else subject end as title,
 regexp_replace(regexp_replace(text, '(?s)(?:\.\s|\n).*$', ''), '[\s,;:.-]+$', '') as description,
 case doc_id % 3 when 0 then 'H' when 1 then 'V' end as orientation, 'Side ' || doc_id as side from t"""
)
def n_titles(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    side = F.concat(F.when(F.col("doc_id") % 3 == 0, "(H) ").otherwise(""), F.lit("Side "), F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 3 == 1, " (vertical)").otherwise(""))
    o = text.extract_orientation(side)
    title = text.short_title(F.regexp_extract("text", r"^[^\n]*", 0), 40)
    return d.select("doc_id", (records.completeness(d, ["lang", "source"]) + 1).alias("filled"), title.alias("title"), text.cut_at_stop(F.col("text"), [r"\.\s", r"\n"]).alias("description"), o["orientation"].alias("orientation"), o["text"].alias("side"))


@query("""
select page_id, case page_id % 5 when 0 then 'bronze' when 1 then 'Nickel (' when 2 then 'Lot 5#3' when 3 then null else 'x' || page_id end as composition,
 case page_id % 5 when 0 then 1.5 when 1 then 5 when 2 then 4 when 4 then 2.5 end::double as grams, case page_id % 5 when 0 then 19 when 1 then page_id % 90 when 4 then 20.5 end::double as millimetres,
 case page_id % 5 when 0 then 'KM' when 2 then 'KM' when 3 then 'KM' when 4 then 'Y' end as catalogue, case page_id % 5 when 0 then '7' when 2 then page_id::varchar when 3 then 'A' || page_id when 4 then '1#' || page_id end as number,
 case page_id % 5 when 0 then 'Circulation' when 3 then 'Coin' end as category from pages""")
def n_technical_shapes(spark, sf_dir):
    """Technical lines of five shapes: glued units, either case of the sign, digits before '#', numbers that hold '#'."""
    k, n = F.col("page_id") % 5, F.col("page_id").cast("string")
    shapes = F.when(k == 0, F.lit("bronze, 1,5 g, ø 19 mm · KM# 7 · Circulation")).when(k == 1, F.concat(F.lit("Nickel (5 g), Ø"), (F.col("page_id") % 90).cast("string"), F.lit(" mm")))
    shapes = shapes.when(k == 2, F.concat(F.lit("Lot 5#3, 4 g KM#"), n)).when(k == 3, F.concat(F.lit("KM# A"), n, F.lit("·Coin"))).otherwise(F.concat(F.lit("x"), n, F.lit(" 2.5g ø 20,5mm Y#1#"), n, F.lit(", · ")))
    return table(spark, sf_dir, "pages").select("page_id", text.parse_technical(shapes).alias("t")).select("page_id", "t.*")


@query("""
select p_partkey, case p_type when 'ECONOMY' then 'normal' when 'SMALL' then 'collection' else 'unknown' end as category, case when position(' ' in p_name) > 0 then split_part(p_name, ' ', 1) end as prefix from part""")
def n_aliases(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    named = F.when(F.instr("p_name", " ") > 0, F.split_part("p_name", F.lit(" "), F.lit(1)))
    return p.select("p_partkey", text.classify_alias(F.when(F.col("p_type") == "ECONOMY", F.lit("Circulação  normal")).when(F.col("p_type") == "SMALL", F.lit("Moeda de Coleção")).otherwise(F.col("p_type")), text.CIRCULATION_ALIASES).alias("category"), named.alias("prefix"))


def _plain(html: str) -> str:
    """SQL for extract.html_to_text: scripts, styles, comments and tags out, entities undone, blanks single."""
    for pattern, to, flags in ((r"<(script|style)\b[^>]*>.*?</(script|style)>", " ", "gis"), ("<!--.*?-->", " ", "gs"), (r"<br\s*/?>", " ", "gi"), ("<[^>]*>", "", "g")):
        html = f"regexp_replace({html}, '{pattern}', '{to}', '{flags}')"
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        html = f"replace({html}, '{entity}', '{char}')"
    return rf"coalesce(trim(regexp_replace({html}, '[\x09-\x0D \x{{A0}}]+', ' ', 'g')), '')"


_CANONICAL = r"""regexp_extract(html, '(?is)<link\b[^>]*rel="canonical"[^>]*href="([^"]*)"', 1)"""


def _param(url: str, key: str) -> str:
    """SQL for the first such parameter of an address, null without one."""
    pattern = f"'^[^?#]*[?](?:[^#]*?&)?{key}=([^&#]*)'"
    return f"case when regexp_matches({url}, {pattern}) then regexp_extract({url}, {pattern}, 1) end"


@query(rf"""
select page_id, md5({_plain("html")}) as text_md5,
 coalesce(nullif({_plain(r"regexp_extract(html, '(?is)<h1\b[^>]*>(.*?)</h1>', 1)")}, ''), {_param("url", "country")}, {_param(_CANONICAL, "country")}, nullif(trim(regexp_extract(html, '(?is)<img\b[^>]*alt="([^"]*)"', 1)), '')) as country,
 coalesce(try_cast(nullif(regexp_extract({_param("url", "page")}, '^[+-]?[0-9]+$'), '') as bigint), 1) as page from pages""")
def e_page_text(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", F.md5(extract.html_to_text(F.col("html")).cast("binary")).alias("text_md5"), extract.extract_country(F.col("html"), F.col("url")).alias("country"), extract.page_number(F.col("url")).alias("page"))
