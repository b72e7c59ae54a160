"""Joins, matching, findings, contracts, plans and increments over the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from catloom.functions import records
from catloom.functions.text import fold_text
from catloom.operators import contracts, findings, incremental, match, relate, sets, similar, updates
from catloom.plans.registry import query, scratch, spread, table
from catloom.sources import digest_tree, readers, writers


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")


@query("select o.o_orderkey, coalesce(string_agg(l_linenumber || ':' || l_partkey, ',' order by l_linenumber, l_partkey), '') as lines from orders o left join lineitem on o_orderkey = l_orderkey and l_linestatus = o_orderstatus group by 1")
def j_attach_children(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    out = relate.attach_children(o, table(spark, sf_dir, "lineitem"), ["o_orderkey", "o_orderstatus"], ["l_orderkey", "l_linestatus"], ["l_linenumber", "l_partkey"], "lines")
    return out.select("o_orderkey", F.array_join(F.transform("lines", lambda x: F.concat_ws(":", x["l_linenumber"].cast("string"), x["l_partkey"].cast("string"))), ",").alias("lines"))


@query("""
with r as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, p_partkey as a, s_suppkey as b from lineitem left join (select p_partkey from part where p_partkey % 3 = 0) p on p_partkey = l_partkey left join (select s_suppkey from supplier where s_suppkey % 2 = 0) s on s_suppkey = l_suppkey)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, case when a is not null and b is not null and a <> b then null else coalesce(a, b) end as target, case when a <> b then 'targets disagree' when a is null and b is null then 'no target' end as reason from r""")
def j_resolve_dual_fk(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return relate.resolve_dual_fk(l, ("l_partkey", table(spark, sf_dir, "part").where("p_partkey % 3 = 0"), "p_partkey"), ("l_suppkey", table(spark, sf_dir, "supplier").where("s_suppkey % 2 = 0"), "s_suppkey"))


@query("select l_orderkey, l_linenumber, 'no order' as reason from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderkey % 7 <> 0)")
def j_orphans(spark, sf_dir):
    return relate.orphans(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders").where("o_orderkey % 7 <> 0"), "l_orderkey", "o_orderkey", "no order").select("l_orderkey", "l_linenumber", "reason")


@query("""
with d as (select doc_id, case when doc_id % 11 = 0 then ' ' else md5(text) end as key from documents), n as (select *, row_number() over (partition by key order by doc_id) as n from d), e as (select md5(text) as key, count(*) as c from documents where doc_id % 2 = 0 group by 1)
select doc_id, case when trim(n.key) = '' then 'missing_key' when n > 1 then 'duplicate_input' when c > 1 then 'multiple_existing' when c = 1 then 'exists' else 'to_create' end as status from n left join e on n.key = e.key""")
def j_classify_import(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("key"))
    rows = d.withColumn("key", F.when(F.col("doc_id") % 11 == 0, " ").otherwise(F.col("key")))
    return relate.classify_import(rows, d.where("doc_id % 2 = 0"), ["key"], "doc_id").select("doc_id", "status")


@query("""
with c as (select c_custkey, case when c_custkey % 3 <> 0 then c_name end as strong, c_nationkey || c_mktsegment as fallback from customer), e as (select * from c where c_custkey % 40 = 0 or c_custkey % 41 = 0)
select c_custkey, coalesce(strong in (select strong from e where strong is not null), false) or case when strong is null then fallback in (select fallback from e) else fallback in (select fallback from e where strong is null) end as found from c""")
def j_partition_missing(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).alias("strong"), F.concat(F.col("c_nationkey").cast("string"), "c_mktsegment").alias("fallback"))
    return relate.partition_missing(c, c.where("c_custkey % 40 = 0 or c_custkey % 41 = 0").drop("c_custkey"), "strong", "fallback").select("c_custkey", "found")


@query(r"""
select page_id, case when regexp_extract(url, '[?&]page=([0-9]*)', 1) <> '' then 'page:' || regexp_extract(url, '[?&]page=([0-9]*)', 1)
 when regexp_extract(url, '([^/]*)\.html', 1) <> '' then 'name:' || regexp_extract(url, '([^/]*)\.html', 1) else 'row:' || page_id end as identity from pages""")
def j_identity_key(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", relate.identity_key([("page", F.regexp_extract("url", r"[?&]page=([0-9]*)", 1)), ("name", F.when(F.col("url").contains(".html"), F.regexp_extract("url", r"([^/]*)\.html", 1))), ("row", F.col("page_id"))]).alias("identity"))


@query("""
with s as (select s_nationkey, count(*) as n, min(s_suppkey) as k from supplier where s_suppkey % 3 = 0 group by 1)
select n_nationkey, coalesce(n, 0) as matches, case when n = 1 then k end as record_id, coalesce(n, 0) <> 1 as violation from nation left join s on s_nationkey = n_nationkey""")
def j_exactly_one(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").where("s_suppkey % 3 = 0").withColumnRenamed("s_nationkey", "n_nationkey")
    return relate.exactly_one(table(spark, sf_dir, "nation").select("n_nationkey"), s, ["n_nationkey"], "s_suppkey")


@query("select c_nationkey, count(*) as untracked from customer where c_custkey not in (select o_custkey from orders) group by 1")
def j_untracked(spark, sf_dir):
    return relate.untracked(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"], "c_nationkey")


@query("""
with i as (select page_id as pos, 's' || page_id as slug, case when page_id % 2 = 0 then 'front' else 'back' end as side, regexp_extract(url, '^https?://([^/]*)', 1) as url from pages), e as (select pos, slug, side, 'x' || (pos % 50) as url from i where pos % 3 = 0),
l as (select i.url, i.slug, i.side, e.url as external, row_number() over (partition by i.url order by i.pos desc) as n from i left join e on i.slug = e.slug and i.side = e.side), f as (select *, row_number() over (partition by url order by pos) as n from e)
select url, slug, side, external from l where n = 1 union all select url, slug, side, url from f where n = 1""")
def j_reverse_map(spark, sf_dir):
    i = table(spark, sf_dir, "pages").select(F.col("page_id").alias("pos"), F.concat(F.lit("s"), F.col("page_id").cast("string")).alias("slug"), F.when(F.col("page_id") % 2 == 0, "front").otherwise("back").alias("side"), F.regexp_extract("url", "^https?://([^/]*)", 1).alias("url"))
    return relate.reverse_map(i, i.where("pos % 3 = 0").withColumn("url", F.concat(F.lit("x"), (F.col("pos") % 50).cast("string"))))


@query("""
with s as (select 'left' as side, o_custkey as id, list_sort(list_distinct(list(o_orderpriority))) as v from orders where o_orderstatus = 'O' group by 2 union all select 'right', o_custkey, list_sort(list_distinct(list(o_orderpriority))) from orders where o_orderstatus = 'F' group by 2)
select side, id, len(v) as n, array_to_string(v, '|') as class, count(*) filter (where side = 'left') over (partition by v) as lefts, count(*) filter (where side = 'right') over (partition by v) as rights from s""")
def j_set_match(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return relate.set_match(o.where("o_orderstatus = 'O'"), o.where("o_orderstatus = 'F'"), "o_custkey", "o_custkey", "o_orderpriority")


@query("""
select c_custkey, case when c_custkey % 5 = 0 and c_custkey % 3 = 0 then case when c_custkey % 15 = 0 then 'conflict' end when c_custkey % 5 = 0 or c_custkey % 3 = 0 then 'matched' else 'missing' end as status,
 case when c_custkey % 15 = 0 then null when c_custkey % 5 = 0 then c_custkey when c_custkey % 3 = 0 then c_custkey + 1 end as owner from customer""")
def j_lookup_by_two_keys(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return relate.lookup_by_two_keys(c, c.where("c_custkey % 5 = 0").select(F.col("c_custkey").alias("key"), F.col("c_custkey").alias("owner")), c.where("c_custkey % 3 = 0").select(F.col("c_name").alias("key"), (F.col("c_custkey") + 1).alias("owner")), "c_custkey", "c_name").select("c_custkey", "status", "owner")


@query("select s_suppkey, case when n_regionkey in (0, 1) then 100 + n_regionkey else s_nationkey end as s_nationkey, case when n_regionkey in (0, 1) then 'moved' else s_name end as s_name, n_regionkey in (0, 1) as relinked from supplier join nation on s_nationkey = n_nationkey")
def j_relink(spark, sf_dir):
    m = table(spark, sf_dir, "nation").where("n_regionkey in (0, 1)").select(F.col("n_nationkey").alias("old"), (F.col("n_regionkey") + 100).alias("new"))
    return relate.relink(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_name"), m, "s_nationkey", {"s_name": F.lit("moved")})


@query("""
with c as (select p_name as image, p_partkey as item_id from part), o as (select image, count(*) as n, min(item_id) as i from c group by 1), r as (select p_partkey as record_id, p_name as image from part),
m as (select record_id, r.image, case when record_id % 50 = 0 then 1 else case when n = 1 then i end end as item_id, coalesce(n > 1 and record_id % 50 <> 0, false) as ambiguous from r left join o on r.image = o.image)
select record_id, image, item_id, ambiguous, item_id is not null and count(*) over (partition by item_id) > 1 as contested from m""")
def j_image_link_match(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("image"))
    r = p.withColumnRenamed("p_partkey", "record_id")
    fixed = r.where("record_id % 50 = 0").select("record_id", F.lit(1).cast("long").alias("item_id"))
    return relate.image_link_match(r, p.withColumnRenamed("p_partkey", "item_id"), "image", fixed)


@query("""
with i as (select p_partkey as id, p_name, p_brand, p_size from part where p_partkey % 2 = 1), r as (select p_partkey as id, p_name, p_brand, p_size from part where p_partkey % 2 = 0),
a as (select min(id) as r, count(*) as n, p_name, p_brand, p_size from r group by 3, 4, 5), b as (select min(id) as r, count(*) as n, p_name, p_brand from r group by 3, 4)
select i.id as item_id, case when a.r is not null then a.r when b.n = 1 then b.r end as record_id, case when a.r is not null then a.n when b.n = 1 then 1 else 0 end as candidates, case when a.r is not null then 'exact' when b.n = 1 then 'name' else 'not_found' end as stage
from i left join a on i.p_name = a.p_name and i.p_brand = a.p_brand and i.p_size = a.p_size left join b on i.p_name = b.p_name and i.p_brand = b.p_brand""")
def m_match_cascade(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "id")
    exact, name = F.concat_ws("|", "p_name", "p_brand", F.col("p_size").cast("string")), F.concat_ws("|", "p_name", "p_brand")
    return match.match_cascade(p.where("id % 2 = 1"), p.where("id % 2 = 0"), [("exact", exact, exact), ("name", name, name)], item_id="id", record_id="id", unique=("name",))


@query("""
with c as (select p_name, p_brand, p_partkey, p_size = 11 as ok from part), n as (select *, count(*) over (partition by p_name, p_brand) as n, count(*) filter (where ok) over (partition by p_name, p_brand) as m from c)
select p_partkey from n where n = 1 or (m = 1 and ok)""")
def m_disambiguate(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("key", F.concat_ws("|", "p_name", "p_brand"))
    return match.disambiguate(p, "key", F.col("p_size") == 11).select("p_partkey")


@query("select p_partkey, array_to_string(list_filter([case when p_partkey % 7 = 0 then 'host' end, case when p_partkey % 2 = 0 or p_partkey % 3 = 0 then 'name' end, case when p_partkey % 5 = 0 then 'years' end], lambda x: x is not null), ',') as mismatches from part")
def m_url_identity(spark, sf_dir):
    k, n = F.col("p_partkey"), F.col("p_size").cast("string")
    amount, unit, year = F.when(k % 2 == 0, F.lit("777")).otherwise(n), F.when(k % 3 == 0, "euro").otherwise("cent"), F.when(k % 5 == 0, "1800").otherwise("1957")
    url = F.concat(F.when(k % 7 == 0, F.lit("http://elsewhere.org")).otherwise(F.lit("https://en.Example.com")), F.lit("/coin/"), F.concat_ws("-", F.lit("land"), amount, unit, year), F.lit("/?tid=1"))
    found = match.url_identity_mismatch(url, F.concat(n, F.lit(" Cents")), F.lit("1957"), r"(^|\.)example\.com$", ["cent", "euro"])
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(found, ",").alias("mismatches"))


@query("""
with i as (select * from part where p_partkey % 2 = 1), r as (select * from part where p_partkey % 2 = 0),
s as (select i.p_partkey as item_id, r.p_partkey as record_id, case when i.p_name = r.p_name then 5.0 else 3 * (1 - levenshtein(i.p_name, r.p_name) / greatest(length(i.p_name), length(r.p_name))::double) end as base, i.p_name = r.p_name as eq, 1 - levenshtein(i.p_name, r.p_name) / greatest(length(i.p_name), length(r.p_name))::double as ratio, i.p_type = r.p_type as same
  from i join r on i.p_brand = r.p_brand and i.p_size = r.p_size),
p as (select item_id, record_id, case when not eq and ratio < 0.7 then 0 else base + case when same then 5.0 else 0 end end as points from s)
select item_id, record_id, round(points, 6) as points, rank from (select *, row_number() over (partition by item_id order by points desc, record_id) as rank from p where points > 0) where rank <= 3""")
def m_top_candidates(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", "p_type", F.col("p_size").cast("string").alias("amount"))
    points = match.score(F.col("i_amount"), F.col("r_amount"), F.col("i_p_name"), F.col("r_p_name"), F.col("i_p_type"), F.col("r_p_type"), ratio=match.levenshtein_ratio(F.col("i_p_name"), F.col("r_p_name")))
    out = match.top_candidates(p.where("p_partkey % 2 = 1"), p.where("p_partkey % 2 = 0"), ["p_brand"], "amount", points, 3, item_id="p_partkey", record_id="p_partkey")
    return out.withColumn("points", F.round("points", 6))


@query()
def m_top_candidates_difflib(spark, sf_dir):
    """The same with the asymmetric similarity, which SQL has no function for."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", "p_type", F.col("p_size").cast("string").alias("amount"))
    points = match.score(F.col("i_amount"), F.col("r_amount"), F.col("i_p_name"), F.col("r_p_name"), F.col("i_p_type"), F.col("r_p_type"))
    return match.top_candidates(p.where("p_partkey % 2 = 1"), p.where("p_partkey % 2 = 0"), ["p_brand"], "amount", points, 3, item_id="p_partkey", record_id="p_partkey")


@query("""
select c_custkey as item_id, case when c_custkey % 2 = 0 and c_custkey % 5 <> 0 then c_custkey * 10 when c_custkey % 3 = 0 then 7 when c_custkey % 7 = 0 and c_custkey % 5 <> 0 then c_custkey * 10 end as record_id,
 case when c_custkey % 2 = 0 and c_custkey % 5 <> 0 then 'association' when c_custkey % 3 = 0 then 'found_before' when c_custkey % 7 = 0 and c_custkey % 5 <> 0 then 'direct_url' else 'unresolved' end as stage from customer""")
def m_resolve_missing(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("item_id"))
    to = c.withColumn("record_id", F.col("item_id") * 10)
    owners = to.where("item_id % 5 = 0").withColumn("item_id", F.col("item_id") + 1)
    return match.resolve_missing(c, to.where("item_id % 2 = 0"), c.where("item_id % 3 = 0").withColumn("record_id", F.lit(7).cast("long")), to.where("item_id % 7 = 0"), owners)


@query("select c_custkey as item_id, c_custkey * 10 as record_id, c_custkey % 2 = 0 and c_custkey % 3 <> 0 as blocked from customer")
def m_confirm_equivalence(spark, sf_dir):
    u = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("item_id"), (F.col("c_custkey") * 10).alias("record_id"))
    ok, blocked = match.confirm_equivalence(u, u.where("item_id % 2 = 0"), u.where("item_id % 3 = 0"))
    return ok.withColumn("blocked", F.lit(False)).unionByName(blocked.withColumn("blocked", F.lit(True)))


@query("with b as (select p_brand, max(p_size) as m from part where p_type <> 'SMALL' group by 1), c as (select p.p_brand, min(p_partkey) as k, count(*) as n from part p join b on p.p_brand = b.p_brand and p_size = m where p_type <> 'SMALL' group by 1) select p_brand, k as p_partkey from c where n = 1")
def m_unique_best(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("points", F.when(F.col("p_type") != "SMALL", F.col("p_size")))
    return match.unique_best(p, "p_brand", "points").select("p_brand", "p_partkey")


def _found(spark, sf_dir):
    """Findings about documents: no label, short text, language by source."""
    d = _docs(spark, sf_dir)
    rules = [("missing_label", "quality", F.col("quality").isNull(), None, F.lit("label")), ("short_text", "text", F.col("n_chars") < 200, F.col("n_chars"), F.lit(200)), ("low_quality", "quality", F.col("quality") == 0, F.col("quality"), F.lit(1)), ("foreign", "lang", F.col("lang") != "en", F.col("lang"), F.lit("en"))]
    return findings.findings(d, ["doc_id", "source"], rules)


_FOUND = """
f as (select d.doc_id, source, unnest(list_filter([case when quality is null then {'type': 'missing_label', 'field': 'quality', 'value': '', 'missing_value': 'label'} end, case when n_chars < 200 then {'type': 'short_text', 'field': 'text', 'value': n_chars::varchar, 'missing_value': '200'} end,
 case when quality = 0 then {'type': 'low_quality', 'field': 'quality', 'value': '0', 'missing_value': '1'} end, case when lang <> 'en' then {'type': 'foreign', 'field': 'lang', 'value': lang, 'missing_value': 'en'} end], lambda x: x is not null)) as r from documents d left join labels l on d.doc_id = l.doc_id),
found as (select doc_id, source, r.type as type, r.field as field, r.value as value, r.missing_value as missing_value from f)"""


@query("with " + _FOUND + " select * from found")
def reconcile_documents(spark, sf_dir):
    return _found(spark, sf_dir)


@query("with " + _FOUND + " select * from found where doc_id not in (select doc_id from documents where source = 'src0')")
def d_unmatched_findings(spark, sf_dir):
    d = _docs(spark, sf_dir)
    rules = [("missing_label", "quality", F.col("quality").isNull(), None, F.lit("label")), ("short_text", "text", F.col("n_chars") < 200, F.col("n_chars"), F.lit(200)), ("low_quality", "quality", F.col("quality") == 0, F.col("quality"), F.lit(1)), ("foreign", "lang", F.col("lang") != "en", F.col("lang"), F.lit("en"))]
    return findings.unmatched_findings(d, d.where("source = 'src0'"), "doc_id", ["doc_id", "source"], rules)


@query("with " + _FOUND + " select type, count(*) as findings, count(distinct doc_id) as items from found group by 1")
def d_summarise(spark, sf_dir):
    return findings.summarise(_found(spark, sf_dir), ["doc_id"])


@query("with " + _FOUND + " select doc_id, array_to_string(list_sort(list_distinct(list(type))), ',') as labels, count(*) as findings from found group by 1")
def d_labels_per_item(spark, sf_dir):
    return findings.labels_per_item(_found(spark, sf_dir), ["doc_id"])


@query("with " + _FOUND + " select doc_id, array_to_string(list_sort(list_distinct(list(case field when 'quality' then 'front' when 'lang' then 'back' end))), ',') as sides, count(distinct field) = 2 as all_sides from found where field in ('quality', 'lang') group by 1")
def d_missing_sides(spark, sf_dir):
    return findings.missing_sides(_found(spark, sf_dir), ["doc_id"], {"quality": "front", "lang": "back"})


@query("with " + _FOUND + ", o as (select doc_id, value from found where type = 'foreign') (select doc_id, value, null::bigint as more from o order by doc_id, value limit 10) union all select null, null, count(*) - 10 from o having count(*) > 10")
def d_detail_rows(spark, sf_dir):
    return findings.detail_rows(_found(spark, sf_dir), "foreign", ["doc_id", "value"], 10)


def _two_snapshots(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return o.where("o_orderkey % 11 <> 0"), o.where("o_orderkey % 7 <> 0").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 13 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))


_SNAP = "with o as (select o_orderkey as k, o_orderkey % 11 <> 0 as b, o_orderkey % 7 <> 0 as a, o_orderkey % 13 = 0 as m, o_totalprice as p from orders)"


@query(_SNAP + " select k as o_orderkey, case when not b then 'created' when not a then 'deleted' when m then 'modified' else 'unchanged' end as status, case when a and b and m then 'o_totalprice' else '' end as changed from o where a or b")
def d_snapshot_diff(spark, sf_dir):
    out = findings.snapshot_diff(*_two_snapshots(spark, sf_dir), ["o_orderkey"], ["o_custkey", "o_orderstatus", "o_totalprice"])
    return out.select("o_orderkey", "status", F.array_join("changed", ",").alias("changed"))


@query(_SNAP + " select k as o_orderkey, 'o_totalprice' as field from o where a and b and m union all select k, unnest(['o_custkey', 'o_orderstatus', 'o_totalprice']) from o where b and not a")
def d_field_diff(spark, sf_dir):
    b, a = _two_snapshots(spark, sf_dir)
    return findings.field_diff(b, a, ["o_orderkey"], ["o_custkey", "o_orderstatus", "o_totalprice"]).select("o_orderkey", "field")


@query(_SNAP + " select k as o_orderkey, case when not a then 'missing' when not b then 'unexpected' else 'changed' end as problem, case when a and b then 'o_totalprice' else '' end as fields from o where (a or b) and not (a and b and not m)")
def d_same_set(spark, sf_dir):
    return findings.same_set(*_two_snapshots(spark, sf_dir), ["o_orderkey"], ["o_custkey", "o_orderstatus", "o_totalprice"])


@query(_SNAP + " select k as o_orderkey, field from (select k, 'o_custkey' as field from o where b and not a union all select k, 'o_orderstatus' from o where b and not a)")
def d_protected_unchanged(spark, sf_dir):
    b, a = _two_snapshots(spark, sf_dir)
    return findings.protected_unchanged(b, a, ["o_orderkey"], ["o_totalprice"]).select("o_orderkey", "field")


@query(_SNAP + """ select k as o_orderkey, case when a and m then 'conflict' when a and k % 5 = 0 then 'conflict' when not a and k % 5 = 0 then 'conflict' when a then 'existing' else 'pending' end as status,
 case when a and m then 'payload differs' when a and k % 5 = 0 then 'another id recorded' when not a and k % 5 = 0 then 'recorded but gone' end as reason from o where b""")
def d_reconcile(spark, sf_dir):
    b, a = _two_snapshots(spark, sf_dir)
    live = a.withColumn("id", F.col("o_orderkey") * 2)
    state = b.where("o_orderkey % 5 = 0").select("o_orderkey", (F.col("o_orderkey") * 2 + 1).alias("id"))
    return findings.reconcile(b, live, ["o_orderkey"], ["o_custkey", "o_totalprice"], state)


@query("select o_orderkey, case when o_orderkey % 4 = 0 then 'conflict' when o_orderkey % 4 = 1 then 'complete' when o_orderkey % 4 = 2 then 'pending' else 'conflict' end as status from orders")
def d_reconcile_three_state(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    k = F.col("o_orderkey") % 4
    plan = o.select("o_orderkey", "o_custkey", F.lit("old").alias("source_s"), F.lit("new").alias("target_s"))
    live = o.select("o_orderkey", F.when(k == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")).alias("o_custkey"), F.when(k == 1, "new").when(k == 2, "old").when(k == 3, "else").otherwise("new").alias("s"))
    return findings.reconcile_three_state(plan, live, ["o_orderkey"], ["s"], ["o_custkey"])


@query("""
with e as (select o_orderkey as k, unnest(range(1, 5)) as tag from orders), e2 as (select k, tag, tag - 1 as pos from e), l as (select l_orderkey as k, l_linenumber as tag, min(l_linenumber) - 1 + (l_orderkey % 2) as pos from lineitem group by 1, 2), b as (select coalesce(e2.k, l.k) as k, e2.tag as e, l.tag as a, e2.pos as ep, l.pos as ap from e2 full join l on e2.k = l.k and e2.tag = l.tag)
select k as l_orderkey, count(e) as expected, count(a) as existing, count(*) filter (where a is null) as missing, count(*) filter (where e is null) as unexpected, count(*) filter (where ep <> ap) as order_updates from b group by 1""")
def d_children_gap(spark, sf_dir):
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    spec = orders.select(F.col("o_orderkey").alias("l_orderkey"), F.explode(F.sequence(F.lit(1), F.lit(4))).alias("tag")).withColumn("pos", (F.col("tag") - 1).cast("long"))
    live = lines.select("l_orderkey", F.col("l_linenumber").alias("tag"), (F.col("l_linenumber") - 1 + F.col("l_orderkey") % 2).alias("pos"))
    n = max(4 * orders.count(), lines.count())  # both sides into the same tasks, the lines before equal ones become one
    spec, live = (spread(x, "l_orderkey", "tag", n=n) for x in (spec, live))
    return findings.children_gap(spec, live.distinct(), "l_orderkey", "tag", "pos")


@query("select p_partkey, p_size as desired, case when p_partkey % 3 = 0 then p_size + 1 else p_size end as stored, case when p_partkey % 3 = 0 then 'update' else 'unchanged' end as status from part where p_partkey % 2 = 0")
def d_order_gap(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    return findings.order_gap(p, p.where("p_partkey % 2 = 0").withColumn("p_size", F.when(F.col("p_partkey") % 3 == 0, F.col("p_size") + 1).otherwise(F.col("p_size"))), "p_partkey", "p_size")


@query("select p_partkey, p_type as desired, case when p_partkey % 2 = 0 then 'SMALL' end as stored, case when p_partkey % 2 <> 0 then 'missing' when p_type = 'SMALL' then 'right' else 'wrong' end as status from part")
def d_type_gap(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return findings.type_gap(p, p.where("p_partkey % 2 = 0").withColumn("p_type", F.lit("SMALL")), "p_partkey", "p_type")


@query("with " + _FOUND + " select doc_id, array_to_string(list(field || '=' || value order by field), ',') as current, array_to_string(list(field || '=' || missing_value order by field), ',') as expected from found where field in ('quality', 'lang') group by 1")
def d_values_by_field(spark, sf_dir):
    out = findings.values_by_field(_found(spark, sf_dir), ["doc_id"], ["quality", "lang"])
    text = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return out.select("doc_id", text("current").alias("current"), text("expected").alias("expected"))


@query("select d.doc_id, unnest(list_filter([case when quality is null then 'quality is blank' end, case when lang not in ('en', 'de') then 'lang is not allowed' end, case when n_chars < 100 then 'long enough' end], lambda x: x is not null)) as problem from documents d left join labels l on d.doc_id = l.doc_id")
def q_check_required(spark, sf_dir):
    return contracts.check_required(_docs(spark, sf_dir), ["doc_id"], required=["quality"], allowed={"lang": ["en", "de"]}, tests={"long enough": F.col("n_chars") >= 100})


@query("select md5(text) as key, count(*) as rows from documents group by 1 having count(*) > 1")
def q_check_unique(spark, sf_dir):
    return contracts.check_unique(table(spark, sf_dir, "documents").select(F.md5(F.col("text").cast("binary")).alias("key")), ["key"])


@query("select * from (values ('c_phone', 'missing'), ('c_acctbal', 'forbidden'), ('c_mktsegment', 'not allowed')) t(\"column\", problem)")
def q_check_schema(spark, sf_dir):
    return contracts.check_schema(table(spark, sf_dir, "customer"), required=["c_custkey", "c_name", "c_phone"], optional=["c_nationkey"], forbidden=["c_acctbal"])


@query("select l_orderkey, l_linenumber, e as expected from (select *, row_number() over (partition by l_orderkey order by l_linenumber) as e from lineitem) where l_linenumber <> e")
def q_check_sequence(spark, sf_dir):
    return contracts.check_sequence(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey"], "l_linenumber", first=1)


@query("""
with t as (select o_custkey, list(o_orderpriority) filter (where o_orderstatus = 'F') as a, list(o_orderpriority) filter (where o_orderstatus = 'P') as b from orders group by 1)
select o_custkey, array_to_string(list_filter([case when len(list_distinct(coalesce(a, []))) < len(coalesce(a, [])) then 'repeated tag' end, case when list_has_any(coalesce(a, []), coalesce(b, [])) then 'included and excluded' end, case when len(coalesce(a, [])) = 0 then 'flag differs' end], lambda x: x is not null), ',') as problems from t""")
def q_check_tags(spark, sf_dir):
    t = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))).alias("a"), F.collect_list(F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority"))).alias("b")).withColumn("flag", F.lit(True))
    return t.select("o_custkey", F.array_join(contracts.check_tags(t, "a", "b", "flag"), ",").alias("problems"))


@query("select doc_id, lang from documents where lang <> 'en'")
def q_check_category(spark, sf_dir):
    return contracts.check_category(table(spark, sf_dir, "documents"), "lang", "en").select("doc_id", "lang")


@query("select coalesce(n_regionkey, 9) as n_regionkey, count(*) as actual, 5 as expected from nation where n_regionkey <> 4 group by 1 having count(*) <> 5 union all select 4, count(*), 0 from nation where n_regionkey = 4 having count(*) > 0")
def q_check_counts(spark, sf_dir):
    contract = table(spark, sf_dir, "region").where("r_regionkey <> 4").select(F.col("r_regionkey").alias("n_regionkey"), F.lit(5).cast("long").alias("expected"))
    return contracts.check_counts(table(spark, sf_dir, "nation"), ["n_regionkey"], contract)


@query("select o_custkey as key, 'no parent' as problem from orders where o_custkey % 10 = 0 union all select c_custkey, 'flag differs' from customer where c_custkey % 10 <> 0 and (c_custkey % 2 = 0) <> (c_custkey in (select o_custkey from orders))")
def q_check_fk(spark, sf_dir):
    c = table(spark, sf_dir, "customer").where("c_custkey % 10 <> 0").withColumn("flag", F.col("c_custkey") % 2 == 0)
    return contracts.check_fk(table(spark, sf_dir, "orders"), c, "o_custkey", "c_custkey", "flag")


@query("select 'orphans' as \"check\", 0 as expected, (select count(*) from lineitem where l_orderkey not in (select o_orderkey from orders)) as actual, case when (select count(*) from lineitem where l_orderkey not in (select o_orderkey from orders)) = 0 then 'ok' else 'blocked' end as status union all select 'nations', 25, (select count(*) from nation), 'ok' union all select 'empty', 1, 0, 'blocked'")
def q_audit(spark, sf_dir):
    o, l, n = (table(spark, sf_dir, x) for x in ("orders", "lineitem", "nation"))
    return contracts.audit({"orphans": (relate.orphans(l, o, "l_orderkey", "o_orderkey", ""), 0), "nations": (n, 25), "empty": (n.where("n_nationkey < 0"), 1)})


@query("select c_custkey from customer where c_custkey % 2 = 0 and c_custkey not in (select o_custkey from orders)")
def q_cleanup_candidates(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return contracts.cleanup_candidates(c, c.where("c_custkey % 2 = 0"), table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey").select("c_custkey")


@query("select s_nationkey as nation, count(distinct s_suppkey % 3) as places, array_to_string(list_sort(list_distinct(list((s_suppkey % 3)::varchar))), ',') as which from supplier group by 1 having count(distinct s_suppkey % 3) > 1")
def q_check_one_place(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), (F.col("s_suppkey") % 3).alias("place"))
    return contracts.check_one_place(s, "nation", "place")


@query("select doc_id, case when doc_id % 10 = 0 then 'not returned' when quality = 0 then 'value not allowed' when doc_id % 9 = 0 then 'source changed' end as problem from labels where doc_id % 10 = 0 or quality = 0 or doc_id % 9 = 0")
def q_check_roundtrip(spark, sf_dir):
    l = table(spark, sf_dir, "labels").withColumn("hash", records.row_hash("doc_id"))
    back = l.where("doc_id % 10 <> 0").withColumn("hash", F.when(F.col("doc_id") % 9 == 0, "x").otherwise(F.col("hash")))
    return contracts.check_roundtrip(l, back, ["doc_id"], "quality", [1], "hash")


@query("with " + _FOUND + " select doc_id::varchar as key, 'kind' as problem from found where type = 'foreign' union all select doc_id::varchar, 'field not allowed' from found where field = 'text' union all select count(*)::varchar, 'number of rows' from found")
def q_check_approved_plan(spark, sf_dir):
    plan = _found(spark, sf_dir).withColumn("kind", F.when(F.col("type") == "foreign", "other").otherwise("fix")).withColumn("status", F.lit("approved"))
    return contracts.check_approved_plan(plan, id_col="doc_id", kind="fix", expected_rows=-1, fields=["quality", "lang"])


def _patches(spark, sf_dir):
    f = _found(spark, sf_dir).withColumn("record_id", F.when(F.col("type") != "missing_label", F.col("doc_id").cast("string")))
    return updates.build_plan(f, table(spark, sf_dir, "documents"), "doc_id", "missing_label")


@query("with " + _FOUND + " select doc_id::varchar as record_id, field, value as current, missing_value as proposed from found where type <> 'missing_label' union all select doc_id::varchar, 'create', '', '' from found where type = 'missing_label'")
def u_build_plan(spark, sf_dir):
    patches, creates = _patches(spark, sf_dir)
    return patches.unionByName(creates.select(F.col("doc_id").cast("string").alias("record_id"), F.lit("create").alias("field"), F.lit("").alias("current"), F.lit("").alias("proposed")))


@query("""
with p as (select source as record_id, lang as field, (n_chars % 3)::varchar as proposed from documents union all select '', 'lang', 'x')
select record_id, field, 'c' as current, case when count(distinct proposed) = 1 then min(proposed) end as proposed, case when count(distinct proposed) > 1 then array_to_string(list_sort(list_distinct(list(proposed))), ' | ') end as conflict from p where record_id <> '' group by 1, 2""")
def u_consolidate(spark, sf_dir):
    p = table(spark, sf_dir, "documents").select(F.col("source").alias("record_id"), F.col("lang").alias("field"), F.lit("c").alias("current"), (F.col("n_chars") % 3).cast("string").alias("proposed"))
    return updates.consolidate(p.unionByName(spark.sql("select '' as record_id, 'lang' as field, 'c' as current, 'x' as proposed")))


@query("""
with p as (select doc_id, source as country, case doc_id % 3 when 0 then 'years' when 1 then 'notes' else 'name' end as field, '1950 - 1955' as current, case when doc_id % 2 = 0 then '1950 - 1960' else '1951 - 1960' end as proposed from documents)
select doc_id, country, field, current, proposed from p where (field = 'years' and proposed = '1950 - 1960') or (field = 'name' and country = 'src1') or (field = 'notes' and country = 'src0' and proposed = '1950 - 1960')""")
def u_restrict(spark, sf_dir):
    k = F.col("doc_id")
    p = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("country"), F.when(k % 3 == 0, "years").when(k % 3 == 1, "notes").otherwise("name").alias("field"), F.lit("1950 - 1955").alias("current"), F.when(k % 2 == 0, "1950 - 1960").otherwise("1951 - 1960").alias("proposed"))
    known = spark.sql("select 'src0' as country, '1950 - 1960' as proposed")
    return updates.restrict(p, fields=["years", "notes", "name"], only_for={"name": ["src1"]}, known={"notes": known}, safe_years="years")


@query("select source, count(*) as rows, count(quality) as filled, case when count(quality) = 0 then 'none' when count(quality) = count(*) then 'complete' else 'partial' end as state from documents d left join labels l on d.doc_id = l.doc_id group by 1")
def u_coverage_state(spark, sf_dir):
    return updates.coverage_state(_docs(spark, sf_dir), "source", "quality")


@query("select c_custkey as record_id, case when c_custkey % 4 = 0 then 'applied' when c_custkey % 4 = 1 then 'already_correct' else 'not_applied' end as status from customer")
def u_apply_optimistic(spark, sf_dir):
    k = F.col("c_custkey") % 4
    c = table(spark, sf_dir, "customer")
    plan = c.select(F.col("c_custkey").alias("record_id"), F.lit("name").alias("field"), F.lit("a").alias("current"), F.lit("b").alias("proposed"))
    now = c.where("c_custkey % 4 <> 3").select(F.col("c_custkey").alias("record_id"), F.lit("name").alias("field"), F.when(k == 0, "a").when(k == 1, "b").otherwise("c").alias("stored"))
    return updates.apply_optimistic(plan, now).select("record_id", "status")


@query("select c_custkey, case when c_custkey % 3 = 0 then 'open' when c_custkey % 2 = 0 then 'applied' else 'partial' end as outcome from customer")
def u_apply_status(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey")
    memory = c.withColumn("fields", F.array(F.lit("name"), F.lit("years")))
    results = c.where("c_custkey % 3 <> 0").select("c_custkey", F.lit("name").alias("field"), F.lit("applied").alias("status")).unionByName(c.where("c_custkey % 3 <> 0").select("c_custkey", F.lit("years").alias("field"), F.when(F.col("c_custkey") % 2 == 0, "already_correct").otherwise("not_applied").alias("status")))
    return updates.apply_status(memory, results, "c_custkey").select("c_custkey", "outcome")


@query("""
with d as (select source, source || '/' || lang as v, lang from documents), f as (select distinct source, v as current, 'x' || v as proposed from d where lang <> 'en'), u as (select distinct v, lang, source from d), m as (select v as current, count(*) as hits from (select v from u union all select v from u where lang = 'de') group by 1)
select source, f.current, proposed, coalesce(hits, 0) as hits, coalesce(hits, 0) = 1 as usable from f left join m on f.current = m.current""")
def u_source_replacements(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    place = F.concat_ws("/", "source", "lang")
    f = d.select("source", place.alias("value"), F.concat(F.lit("x"), place).alias("missing_value"))
    pages = d.select("source", "lang", place.alias("url")).distinct()
    return updates.source_replacements(f, pages.unionByName(pages.where("lang = 'de'")).select("url"), ~F.col("value").endswith("/en"), ["source"])


@query("select d.doc_id, case when quality = 1 then 'approved' when quality = 0 then 'rejected' else 'pending' end as status from documents d left join labels l on d.doc_id = l.doc_id")
def u_review_merge(spark, sf_dir):
    old = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "approved").otherwise("rejected").alias("status"))
    return updates.review_merge(table(spark, sf_dir, "documents").select("doc_id"), old, ["doc_id"], "status")


@query("select source, count(*) as items, count(*) filter (where quality is null) as pending, count(*) filter (where quality is null) = 0 as ready from documents d left join labels l on d.doc_id = l.doc_id group by 1")
def u_review_summary(spark, sf_dir):
    d = _docs(spark, sf_dir).withColumn("status", F.when(F.col("quality").isNull(), "pending").otherwise("done"))
    return updates.review_summary(d, "source", "status")


@query("select c_mktsegment, c_custkey % 2 = 0 as status, count(*) as rows from customer group by 1, 2")
def u_plan_summary(spark, sf_dir):
    return updates.plan_summary(table(spark, sf_dir, "customer").withColumn("status", F.col("c_custkey") % 2 == 0), "c_mktsegment", "status")


@query("select c_custkey, (row_number() over (partition by c_nationkey order by c_custkey) - 1) // 10 as batch from customer")
def k_assign_batches(spark, sf_dir):
    return updates.assign_batches(table(spark, sf_dir, "customer"), 10, ["c_custkey"], ["c_nationkey"]).select("c_custkey", "batch")


@query("select c_custkey, case when c_custkey % 3 = 0 and c_custkey % 2 = 0 then upper(c_mktsegment) || '!' else c_mktsegment end as c_mktsegment from customer where c_custkey % 2 = 0 union all select c_custkey, upper(c_mktsegment) || '!' from customer where c_custkey % 3 = 0 and c_custkey % 2 <> 0")
def k_upsert(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return updates.upsert(c.where("c_custkey % 2 = 0"), c.where("c_custkey % 3 = 0").withColumn("c_mktsegment", F.concat(F.upper("c_mktsegment"), F.lit("!"))), ["c_custkey"])


@query("select c_custkey, case when c_nationkey = 3 then 'new' else c_name end as c_name, c_nationkey from customer where c_custkey % 10 <> 0")
def k_replace_and_delete(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    out = updates.replace_by_key(c, c.where("c_nationkey = 3").withColumn("c_name", F.lit("new")), ["c_nationkey"])
    return updates.delete_keys(out, c.where("c_custkey % 10 = 0"), ["c_custkey"])


@query("select 'AFRICA' as r_name, 5 as expected_rows, 4 as actual_rows where false union all select r_name, count(*), count(*) - 1 from nation join region on n_regionkey = r_regionkey where r_regionkey = (select n_regionkey from nation where n_nationkey = 7) group by 1")
def k_manifest(spark, sf_dir):
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return writers.verify_manifest(writers.manifest(n, ["r_name"]), writers.manifest(n.where("n_nationkey <> 7"), ["r_name"]), ["r_name"])


@query("select n_nationkey, case when n_nationkey % 5 = 0 then 'not in the manifest' when n_nationkey % 5 = 1 then 'several entries' when n_nationkey % 5 = 2 then 'not complete' when n_nationkey % 5 = 3 then 'checksum' end as problem from nation")
def s_verified_entries(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.lit(1).cast("long").alias("rows"), F.lit("a").alias("checksum"))
    k = F.col("n_nationkey") % 5
    m = n.where(k != 0).select("n_nationkey", "rows", F.when(k == 3, "b").otherwise("a").alias("checksum"), F.when(k == 2, "open").otherwise("complete").alias("status"))
    return readers.verified_entries(m.unionByName(m.where(k == 1)), n, ["n_nationkey"])


@query("select regexp_replace(url, '[^/]*$', '') as folder from pages group by 1 having bool_or(page_id % 3 = 0) and not bool_or(page_id % 3 = 1)")
def s_discover_ready(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    files = p.select(F.regexp_replace("url", "[^/]*$", "").alias("folder"), F.when(F.col("page_id") % 3 == 0, "pending").when(F.col("page_id") % 3 == 1, "final").otherwise("other").alias("name"))
    return readers.discover_ready(files, "pending", "final")


@query("select event_type, count(*) as rows from events where ts::date = (select max(ts::date) from events) group by 1")
def s_resolve_latest(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("snapshot_id", F.to_date("ts"))
    return readers.resolve_latest(e).groupBy("event_type").agg(F.count("*").alias("rows"))


@query("""
with l as (select o_custkey, row_number() over (partition by o_custkey order by o_orderkey) as n, o_orderkey, o_orderstatus from orders), h as (select *, max(case when o_orderstatus = 'F' then n end) over (partition by o_custkey order by n rows unbounded preceding) as sec from l)
select o_custkey as source_file, n as pos, 'k' || (select o_orderkey from l where l.o_custkey = h.o_custkey and l.n = h.sec) as slug, 'front' as side, 'http://x/' || o_orderkey as url from h where o_orderstatus <> 'F' and sec is not null""")
def s_link_lines(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    line = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("k"), F.col("o_orderkey").cast("string"), F.lit(":"))).otherwise(F.concat(F.lit("  front: http://x/"), F.col("o_orderkey").cast("string")))
    lines = o.select(F.col("o_custkey").alias("source_file"), F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).alias("pos"), line.alias("line"))
    return readers.link_lines(lines)


@query(_SNAP + " select k as o_orderkey, case when not b then 'created' when not a then 'deleted' else 'common' end as kind from o where a or b")
def x_key_sets(spark, sf_dir):
    return sets.key_sets(*_two_snapshots(spark, sf_dir), ["o_orderkey"])


@query("""
with t as (select o_custkey, list_sort(list_distinct(list(o_orderpriority) filter (where o_orderstatus = 'F'))) as a, list_sort(list_distinct(list(o_orderpriority) filter (where o_orderstatus = 'O'))) as b from orders group by 1)
select o_custkey, array_to_string(list_filter(coalesce(a, []), lambda x: not list_contains(coalesce(b, []), x)), ',') as only_a, array_to_string(list_filter(coalesce(b, []), lambda x: not list_contains(coalesce(a, []), x)), ',') as only_b, array_to_string(list_filter(coalesce(a, []), lambda x: list_contains(coalesce(b, []), x)), ',') as both, list_has_all(coalesce(b, []), coalesce(a, [])) as subset from t""")
def x_array_setops(spark, sf_dir):
    t = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_set(F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))).alias("a"), F.collect_set(F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority"))).alias("b"))
    out = sets.array_setops(t, "a", "b")
    return out.select("o_custkey", *[F.array_join(c, ",").alias(c) for c in ("only_a", "only_b", "both")], "subset")


@query("select c_custkey as id, c_mktsegment as report, case when c_custkey % 10 = 0 then 'bad' end as error from customer where c_mktsegment in ('MACHINERY', 'HOUSEHOLD')")
def x_union_reports(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    own = lambda s: c.where(F.col("c_mktsegment") == s).select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 10 == 0, "bad").alias("error"))
    good, bad = sets.union_reports({s: own(s) for s in ("MACHINERY", "HOUSEHOLD")})
    return good.unionByName(bad)


@query("select user_id, 'todo' as part from events group by 1 having min(ts) >= timestamp '2024-01-02' union all select user_id, 'kept' from events where ts < timestamp '2024-01-02' group by 1")
def t_todo(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    left, kept = incremental.todo(e.select("user_id").distinct(), e.where("ts < timestamp_ntz'2024-01-02'").select("user_id").distinct(), ["user_id"])
    return left.withColumn("part", F.lit("todo")).unionByName(kept.withColumn("part", F.lit("kept")))


@query("select count(distinct user_id) as expected, count(distinct user_id) filter (where ts < timestamp '2024-01-02') as completed from events")
def t_progress(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return incremental.progress(e, e.where("ts < timestamp_ntz'2024-01-02'"), ["user_id"])


@query("""
with i as (select user_id, min(event_id) as event_id from events group by 1), c as (select user_id, max(ts) as made from events where event_type <> 'error' and ts >= (select max(ts) from events) - interval 3 day group by 1)
select i.user_id, event_id, made, made is not null as reused from i left join c on i.user_id = c.user_id""")
def t_reuse_cache(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    cache = e.select("user_id", F.col("ts").alias("made"), "event_type").crossJoin(F.broadcast(e.agg(F.max("ts").alias("last"))))  # one row
    out = incremental.reuse_cache(e.select("user_id", "event_id"), cache, ["user_id"], "event_id", "made", F.col("last"), 3, F.col("event_type") != "error")
    return out.select("user_id", "event_id", "made", "reused")


@query("select c_custkey, case when c_custkey % 3 = 0 then case when c_custkey % 9 = 0 then 'another plan' when c_custkey % 7 = 0 then 'target is gone' else 'verified' end else case when c_custkey % 2 = 0 then 'another plan' end end as status from customer where c_custkey % 3 = 0 or c_custkey % 2 = 0")
def t_checkpoint_merge(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").alias("id"))
    state = c.where("c_custkey % 2 = 0").withColumn("plan_hash", F.lit("old"))
    results = c.where("c_custkey % 3 = 0").withColumn("plan_hash", F.when(F.col("c_custkey") % 9 == 0, "old").otherwise("new"))
    return incremental.checkpoint_merge(state, results, c.where("c_custkey % 7 <> 0"), ["c_custkey"], "new").select("c_custkey", "status")


@query("select n1.n_nationkey as a, n2.n_nationkey as b, true as same from nation n1 join nation n2 on n1.n_nationkey + 1 = n2.n_nationkey")
def m_name_rules(spark, sf_dir):
    a = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("a"), F.col("n_name").alias("x"))
    b = a.select((F.col("a") - 1).alias("a"), F.col("a").alias("b"), F.lit("5  CENTS").alias("y"))
    same = match.same_visible_name(F.concat(F.lit("5 "), F.lit("Cents")), F.col("y")) & match.name_years_agree(F.lit("5 cts"), F.lit("1957-61"), F.col("y"), F.lit("1957 61")) & (fold_text(F.col("x")) != "")
    return a.join(b, "a").select("a", "b", same.alias("same"))


@query("""
select doc_id, 'deleted' as status, '' as changed from documents where doc_id % 100 = 3
union all select doc_id, 'modified', 'n_chars' from documents where doc_id % 100 = 7 union all select doc_id, 'modified', 'lang,source' from documents where doc_id % 100 = 9
union all select -1 - doc_id, 'created', '' from documents where doc_id % 100 = 5""")
def d_tree_diff(spark, sf_dir):
    """Two snapshots of the documents' fields, compared from the roots of their digest trees down."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    k = F.col("doc_id") % 100
    after = d.where(k != 3).withColumns({"n_chars": F.when(k == 7, F.col("n_chars") + 1).otherwise(F.col("n_chars")), "lang": F.when(k != 9, F.col("lang")), "source": F.when(k == 9, F.col("lang")).otherwise(F.col("source"))})
    after = after.unionByName(d.where(k == 5).withColumn("doc_id", -1 - F.col("doc_id")))
    paths = [scratch(spark, "tree"), scratch(spark, "tree")]
    for rows, path in zip((d, after), paths, strict=True):
        digest_tree.write_tree(rows, path, ["doc_id"], leaves=64, fanout=4)
    out = digest_tree.tree_diff(spark, *paths, ["lang", "source", "n_chars"])
    return out.select("doc_id", "status", F.array_join("changed", ",").alias("changed"))


@query("""
select * from (values ('no text', 0), ('no language', 0), ('short', 5), ('long', 0), ('several lines', 0), ('amps', 1), ('negative', 0), ('sizes', 0), ('digits', 0), ('sources', 0)) v("check", expected)
join (select 'no text' as "check", count(*) filter (where text is null) as actual from documents union all select 'no language', count(*) filter (where lang is null) from documents
union all select 'short', count(*) filter (where n_chars < 20) from documents union all select 'long', count(*) filter (where n_chars > 20000) from documents union all select 'several lines', count(*) filter (where contains(text, chr(10))) from documents
union all select 'amps', count(*) filter (where contains(text, '&')) from documents union all select 'negative', count(*) filter (where doc_id < 0) from documents union all select 'sizes', count(*) filter (where n_chars <> length(text)) from documents
union all select 'digits', count(*) filter (where regexp_matches(text, '[0-9]')) from documents union all select 'sources', count(*) filter (where source = 'src0') from documents) c using ("check")""".replace("select * from (values", "select \"check\", expected, actual, case when expected = actual then 'ok' else 'blocked' end as status from (values"))
def q_audit_scan(spark, sf_dir):
    """Ten checks of the documents in one scan."""
    t, n = F.col("text"), F.col("n_chars")
    tests = {"no text": t.isNull(), "no language": F.col("lang").isNull(), "short": n < 20, "long": n > 20000, "several lines": t.contains("\n"), "amps": t.contains("&"), "negative": F.col("doc_id") < 0, "sizes": n != F.length(t), "digits": t.rlike("[0-9]"), "sources": F.col("source") == "src0"}
    expected = {"short": 5, "amps": 1}
    return contracts.audit_scan(table(spark, sf_dir, "documents"), {k: (c, expected.get(k, 0)) for k, c in tests.items()})


@query()
def m_similar_names(spark, sf_dir):
    """The three parts of other brands whose names are most alike by the asymmetric ratio, without any block; no SQL has that ratio."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_brand")
    own = p.select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("name"), F.lit("").alias("amount"), F.col("p_brand").alias("years"))
    other = own.withColumnRenamed("item_id", "record_id").withColumn("name", F.regexp_replace("name", "^(.)(.)", "$2$1"))
    return similar.top_similar(own, other, 3)
