"""Filters, shapes, order and statistics over the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from catloom.functions import years
from catloom.operators import filters, folds, order, ranges, shape, stats
from catloom.plans.registry import query, spread, table


@query("select o_orderkey, o_custkey from orders where year(o_orderdate) >= 1998")
def f_from_year(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("y", F.year("o_orderdate"))
    return filters.from_year(o, "y", 1998).select("o_orderkey", "o_custkey")


@query("select o_orderstatus as category, count(*) as found, o_orderstatus = 'F' as selected from orders group by 1")
def f_of_category(spark, sf_dir):
    kept, counts = filters.of_category(table(spark, sf_dir, "orders"), "o_orderstatus", "F")
    return counts


@query("select p_brand, count(*) as n, false as unknown from part where p_brand in ('Brand#2', 'Brand#4') group by 1 union all select 'Brand#none', 0, true")
def f_of_groups(spark, sf_dir):
    titles = spark.sql("select explode(array('Brand#2', 'Brand#4', 'Brand#none')) as title")
    kept, unknown = filters.of_groups(table(spark, sf_dir, "part"), "p_brand", titles)
    return kept.groupBy("p_brand").agg(F.count("*").alias("n")).withColumn("unknown", F.lit(False)).unionByName(unknown.select(F.col("title").alias("p_brand"), F.lit(0).cast("long").alias("n"), F.lit(True).alias("unknown")))


@query("select p_partkey, case p_brand when 'Brand#4' then 0 else 1 end as request_pos from part where p_brand in ('Brand#2', 'Brand#4')")
def f_in_requested_order(spark, sf_dir):
    kept, _ = filters.in_requested_order(table(spark, sf_dir, "part"), "p_brand", ["Brand#4", "Brand#2", "Brand#4"])
    return kept.select("p_partkey", "request_pos")


@query("select o_orderkey from orders where o_orderstatus = 'P' and o_custkey > 0")
def f_by_status(spark, sf_dir):
    return filters.by_status(table(spark, sf_dir, "orders"), "active", status="o_orderstatus", count="o_custkey", active="P").select("o_orderkey")


@query("select d.doc_id, case when quality is null then 'pending' when quality = 1 then 'passed' end as state from documents d left join labels l on d.doc_id = l.doc_id where quality is null or quality = 1")
def f_reviewed(spark, sf_dir):
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    d = d.withColumn("status", F.when(F.col("quality") == 1, "approved").when(F.col("quality") == 0, "rejected"))
    passed, waits = filters.reviewed(d, "status")
    return passed.select("doc_id", F.lit("passed").alias("state")).unionByName(waits.select("doc_id", F.lit("pending").alias("state")))


@query("select source, count(*) as items, count(*) - count(quality) as pending from documents d left join labels l on d.doc_id = l.doc_id group by source")
def f_pending_counts(spark, sf_dir):
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return filters.pending_counts(d, "source", "quality", "-1")


@query("select c_mktsegment in ('MACHINERY', 'HOUSEHOLD') as selected, count(*) as n from customer group by 1")
def f_by_membership(spark, sf_dir):
    a, b = filters.by_membership(table(spark, sf_dir, "customer"), "c_mktsegment", ["MACHINERY", "HOUSEHOLD"])
    return a.withColumn("selected", F.lit(True)).unionByName(b.withColumn("selected", F.lit(False))).groupBy("selected").agg(F.count("*").alias("n"))


def _orders_nested(spark, sf_dir):
    """Customers with groups (orders) of items (lines), in order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_quantity"))).alias("lines"))
    rows = o.join(lines, o["o_orderkey"] == lines["l_orderkey"])
    return rows.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority", "lines"))).alias("groups"))


@query("""
with o as (select *, row_number() over (partition by o_custkey order by o_orderkey) - 1 as group_pos from orders where o_orderkey in (select l_orderkey from lineitem))
select o_custkey, group_pos, o_orderkey as group_o_orderkey, o_orderpriority as group_o_orderpriority, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_quantity) - 1 as item_pos, l_linenumber, l_partkey, l_quantity,
 'p' || (group_pos + 1) || '-c' || (row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_quantity)) as item_id from o join lineitem on o_orderkey = l_orderkey""")
def g_flatten(spark, sf_dir):
    return order.item_ids(shape.flatten(_orders_nested(spark, sf_dir), "groups", "lines", ["o_custkey"]))


@query("""
with o as (select *, row_number() over (partition by o_custkey order by o_orderkey) as g from orders where o_orderkey in (select l_orderkey from lineitem))
select o_custkey, count(distinct o_orderkey) as n_groups, count(*) as n_items, sum(g * l_partkey)::bigint as check_sum from o join lineitem on o_orderkey = l_orderkey group by 1""")
def g_regroup(spark, sf_dir):
    flat = shape.flatten(_orders_nested(spark, sf_dir), "groups", "lines", ["o_custkey"])
    back = shape.regroup(flat, ["o_custkey"], ["group_o_orderkey"], ["l_linenumber", "l_partkey"])
    add = lambda a, x: a + x
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), add)
    return back.select("o_custkey", F.size("groups").alias("n_groups"), total(F.transform("groups", lambda g: F.size(g["items"]).cast("long"))).alias("n_items"), total(F.transform("groups", lambda g, i: (i + 1) * total(F.transform(g["items"], lambda x: x["l_partkey"])))).alias("check_sum"))


@query("select event_id, json_extract_string(props, '$.k')::bigint as k, event_type as kind, value from events")
def g_flatten_item(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("props", F.from_json("props", "k long"))
    return shape.flatten_item(e, {"event_id": "event_id", "k": "props.k", "kind": "event_type", "value": "value"})


@query("select doc_id, source from (select *, row_number() over (partition by md5(text) order by doc_id) as n from documents) where n = 1")
def g_dedup_first(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("key", F.md5(F.col("text").cast("binary")))
    return shape.dedup_first(d, ["key"], [F.col("doc_id")])[0].select("doc_id", "source")


@query("select md5(text) as key, count(*) as rows, count(distinct lang) = 1 as agree from documents group by 1")
def g_dedup_strict(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("key", F.md5(F.col("text").cast("binary")))
    return shape.dedup_strict(d, ["key"], ["lang"]).select("key", "rows", "agree")


@query("""
with e as (select user_id, event_type, event_id, case when event_id % 3 = 0 then null else event_type || (event_id % 5) end as a, case when event_id % 4 = 0 then '' else 'b' || (event_id % 7) end as b from events),
first_rows as (select user_id, event_type, list({'i': event_id, 'a': a, 'b': b} order by event_id) as l from e group by 1, 2),
folded as (select user_id, event_type, len(l) as rows, list_reduce(l, lambda acc, r: case when (case when coalesce(r.a, '') <> '' then 1 else 0 end + case when coalesce(r.b, '') <> '' then 1 else 0 end) > (case when coalesce(acc.a, '') <> '' then 1 else 0 end + case when coalesce(acc.b, '') <> '' then 1 else 0 end)
  then {'i': acc.i, 'a': case when coalesce(r.a, '') <> '' then r.a else acc.a end, 'b': case when coalesce(r.b, '') <> '' then r.b else acc.b end}
  else {'i': acc.i, 'a': case when coalesce(acc.a, '') <> '' then acc.a else r.a end, 'b': case when coalesce(acc.b, '') <> '' then acc.b else r.b end} end) as m from first_rows)
select user_id, event_type, rows, m.a as a, m.b as b from folded""")
def g_dedup_merge(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    e = e.withColumn("a", F.when(F.col("event_id") % 3 != 0, F.concat("event_type", (F.col("event_id") % 5).cast("string")))).withColumn("b", F.when(F.col("event_id") % 4 == 0, "").otherwise(F.concat(F.lit("b"), (F.col("event_id") % 7).cast("string"))))
    return shape.dedup_merge(e, ["user_id", "event_type"], "event_id", ["a", "b"])


@query("""
with e as (select user_id, event_id, event_type, case when event_id % 3 = 0 then event_type end as mark from events),
f as (select user_id, arg_min(mark, event_id) filter (where mark is not null) as mark from e group by 1),
s as (select user_id, event_type, min(event_id) as seen from e group by 1, 2)
select f.user_id, mark, (select string_agg(event_type, ',' order by seen) from s where s.user_id = f.user_id) as kinds from f""")
def g_merge_groups(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("mark", F.when(F.col("event_id") % 3 == 0, F.col("event_type")))
    out = shape.merge_groups(e, ["user_id"], "event_id", ["mark"], "event_type")
    return out.select("user_id", "mark", F.array_join("event_types", ",").alias("kinds"))


@query("""
with o as (select o_orderkey, o_totalprice as price, 0 as g from orders where o_orderkey % 3 <> 0 union all select o_orderkey, o_totalprice + 1, 1 from orders where o_orderkey % 2 = 0)
select o_orderkey, arg_max(price, g) as price from o where o_orderkey % 5 <> 0 group by 1 having o_orderkey % 7 <> 0""")
def g_merge_last_wins(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    k = F.col("o_orderkey")
    return shape.merge_last_wins(o.where(k % 3 != 0), o.where(k % 2 == 0).withColumn("price", F.col("price") + 1), ["o_orderkey"], excluded=o.where(k % 5 == 0), drop=k % 7 == 0)


@query("select c_custkey, c_name from customer where c_custkey % 2 = 0 union all select c_custkey, upper(c_name) from customer where c_custkey % 2 <> 0 and c_custkey % 3 = 0")
def g_union_prefer_existing(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return shape.union_prefer_existing(c.where("c_custkey % 2 = 0"), c.where("c_custkey % 3 = 0").withColumn("c_name", F.upper("c_name")), ["c_custkey"])


@query("select s_suppkey, case when n_regionkey > 1 then n_name else s_name end as s_name from supplier left join nation on s_nationkey = n_nationkey")
def g_copy_by_key(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").alias("n_nationkey"))
    n = table(spark, sf_dir, "nation").where("n_regionkey > 1").select("n_nationkey", F.col("n_name").alias("s_name"))
    return shape.copy_by_key(s, n, ["n_nationkey"], ["s_name"]).select("s_suppkey", "s_name")


@query("""
with l as (select l_orderkey, l_shipdate, year(l_shipdate) as y, case l_returnflag when 'N' then '' else l_returnflag end as m, l_linestatus = 'O' as unc from lineitem),
t as (select l_orderkey, trim(y || ' ' || m) as tag, max(case when unc then 1 else 0 end) as kind, min(y) as y, min(m) as m from l group by 1, 2)
select l_orderkey, case when count(*) filter (where kind = 1) >= 2 then string_agg(tag, ',' order by y, case m when '' then 0 else 50 end, m) filter (where kind = 1) else '' end as variants,
 coalesce(string_agg(tag, ',' order by y, case m when '' then 0 else 50 end, m) filter (where kind = 0), '') as proof_only,
 case when count(*) filter (where kind = 1) >= 2 then 'collected' else 'no_multiple_variants' end as status from t group by 1""")
def g_build_variants(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").withColumn("y", F.year("l_shipdate").cast("string")).withColumn("m", F.when(F.col("l_returnflag") == "N", "").otherwise(F.col("l_returnflag")))
    l = l.withColumn("unc", F.when(F.col("l_linestatus") == "O", "1,000").otherwise("-")).withColumn("bu", F.lit("-")).withColumn("proof", F.lit("+")).withColumn("one", F.lit(False))
    out = shape.build_variants(l, ["l_orderkey"], year="y", mark="m", unc="unc", bu="bu", proof="proof", single_year="one")
    return out.select("l_orderkey", F.array_join(F.transform("variants", lambda v: v["tag"]), ",").alias("variants"), F.array_join("proof_only", ",").alias("proof_only"), "status")


@query("select p_partkey, p_name as name, case p_type when 'ECONOMY' then 'common' when 'SMALL' then 'rare' end as rarity, coalesce(case when p_size > 25 then p_size end, p_partkey) as ordinal, case when p_name like 'red %' then 'red' when p_name like 'blue %' then 'azure' end as prefix, substr(p_name, position(' ' in p_name) + 1) as subject from part")
def g_build_record(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("stored", F.when(F.col("p_size") > 25, F.col("p_size").cast("long")))
    n = shape.split_name(F.col("p_name"), {"red": "red", "blue": "azure"}, " ")
    return shape.build_record(p, {"p_partkey": F.col("p_partkey"), "name": F.col("p_name"), "prefix": n["prefix"], "subject": n["subject"]}, rank_by="p_type", ranks={"ECONOMY": "common", "SMALL": "rare"}, order="stored", fallback="p_partkey")


@query("select p_partkey, case when p_size < 10 then 'SMALL' else p_type end as p_type, p_size < 10 and p_type <> 'SMALL' as repaired from part")
def g_repair_field(spark, sf_dir):
    return shape.repair_field(table(spark, sf_dir, "part"), "p_type", F.col("p_size") < 10, F.lit("SMALL")).select("p_partkey", "p_type", "repaired")


_LINES = "with l as (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_quantity) as pos from lineitem)"


def _lines(spark, sf_dir):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_quantity")
    return spread(table(spark, sf_dir, "lineitem"), "l_orderkey").withColumn("pos", F.row_number().over(w))


@query(_LINES + """, g as (select *, min(pos) over (partition by l_orderkey, l_returnflag) as gp, min(pos) over (partition by l_orderkey, l_returnflag, l_linestatus) as lp from l)
select l_orderkey, pos, row_number() over (partition by l_orderkey order by gp, lp, year(l_shipdate), pos) as place from g""")
def w_catalogue_order(spark, sf_dir):
    out = order.catalogue_order(_lines(spark, sf_dir), ["l_orderkey"], F.col("l_returnflag"), F.col("l_linestatus"), years.issue_sort_key(F.year("l_shipdate").cast("string")), "pos")
    return out.select("l_orderkey", "pos", "place")


@query(_LINES + """, f as (select l_orderkey, pos, case when l_returnflag = 'N' then pos else min(pos) over (partition by l_orderkey, l_returnflag) end as first from l)
select l_orderkey, pos, dense_rank() over (partition by l_orderkey order by first) as rank from f""")
def w_gapless_rank(spark, sf_dir):
    rows = _lines(spark, sf_dir).withColumn("key", F.when(F.col("l_returnflag") == "N", " ").otherwise(F.col("l_returnflag")))
    return order.gapless_rank(rows, ["l_orderkey"], "key", "pos").select("l_orderkey", "pos", "rank")


@query("""select o_orderkey, row_number() over (partition by o_custkey order by year(o_orderdate), o_orderpriority, o_orderkey) as sequence, max(c) over (partition by o_custkey) + row_number() over (partition by o_custkey order by o_orderkey) as appended
from (select *, count(*) over (partition by o_custkey) as c from orders)""")
def w_resequence(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    done = order.resequence(o, ["o_custkey"], [F.year("o_orderdate"), "o_orderpriority", "o_orderkey"])
    more = order.append_after(done, o.select("o_orderkey", "o_custkey"), ["o_custkey"], "sequence", ["o_orderkey"])
    return done.select("o_orderkey", "sequence").join(more.select("o_orderkey", F.col("sequence").alias("appended")), "o_orderkey")


@query("""
with e as (select *, row_number() over (partition by user_id order by ts, event_id) as pos from events),
f as (select *, case when event_type = lag(event_type) over (partition by user_id order by pos) then 0 else 1 end as new from e),
r as (select *, sum(new) over (partition by user_id order by pos)::bigint as run from f)
select user_id, run, event_type, min(pos) as start, max(pos) as "end", count(*) as length from r group by 1, 2, 3""")
def w_runs(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("pos", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    return order.runs(e, ["user_id"], ["event_type"], ["pos"])


@query("""
with e as (select *, case when event_type = 'error' then event_id end as mark from events)
select event_id, last_value(mark ignore nulls) over (partition by user_id order by event_id rows unbounded preceding) as section from e""")
def w_forward_fill(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("mark", F.when(F.col("event_type") == "error", F.col("event_id")))
    return order.forward_fill(e, ["user_id"], "mark", "event_id", "section").select("event_id", "section")


@query("select * from (select p_brand, p_partkey, row_number() over (partition by p_brand order by p_retailprice desc, p_partkey) as rank from part) where rank <= 3")
def w_top_rows(spark, sf_dir):
    return filters.top_rows(table(spark, sf_dir, "part"), ["p_brand"], [F.desc("p_retailprice"), F.col("p_partkey")], 3).select("p_brand", "p_partkey", "rank")


@query("select c_custkey, row_number() over (partition by c_nationkey order by lower(c_mktsegment), lower(c_name), c_custkey) as place from customer")
def w_stable_sort(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumn("k", order.stable_sort_key(F.col("c_mktsegment"), F.col("c_name")))
    return order.resequence(c, ["c_nationkey"], ["k", "c_custkey"]).select("c_custkey", F.col("sequence").alias("place"))


@query("""
with c as (select unnest(['circulating', 'scarce', 'withdrawn', 'historical']) as category), s as (select distinct source from documents),
d as (select source, case when quality = 0 then 'withdrawn' when toxic = 1 then 'scarce' when quality = 1 then 'circulating' else 'unknown' end as category, 1900 + n_chars % 100 as y from documents d left join labels l on d.doc_id = l.doc_id)
select s.source, c.category, count(d.y) as items, min(d.y) as first, max(d.y) + 5 as last from s cross join c left join d on d.source = s.source and d.category = c.category group by 1, 2""")
def a_availability_stats(spark, sf_dir):
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    category = F.when(F.col("quality") == 0, "withdrawn").when(F.col("toxic") == 1, "scarce").when(F.col("quality") == 1, "circulating").otherwise("unknown")
    d = d.select("source", category.alias("category"), (F.col("n_chars") % 100 + 1900).alias("first")).withColumn("last", F.col("first") + 5)
    return stats.availability_stats(d, ["source"], "category", "first", "last")


@query("""
with d as (select o_custkey, o_orderpriority, case when o_orderkey % 9 <> 0 then year(o_orderdate) end as y from orders), m as (select *, max(y) over (partition by o_custkey) as top from d)
select o_custkey, min(y) as first, max(y) + 2 as last, coalesce(string_agg(distinct o_orderpriority, ',' order by o_orderpriority) filter (where y = top), '') as labels, count(*) filter (where y is null) as without_years from m group by 1""")
def a_year_coverage(spark, sf_dir):
    y = F.year("o_orderdate")
    o = table(spark, sf_dir, "orders").withColumn("years", F.when(F.col("o_orderkey") % 9 != 0, F.concat(y.cast("string"), F.lit(" - "), (y + 2).cast("string"))))
    return stats.year_coverage(o, "o_custkey", "years", "o_orderpriority")


@query("with c as (select user_id, event_type, count(*) as rows, min(event_id) as seen from events group by 1, 2) select user_id, event_type, rows from (select *, row_number() over (partition by user_id order by rows desc, seen) as n from c) where n = 1")
def a_mode_first(spark, sf_dir):
    return stats.mode_first(table(spark, sf_dir, "events"), ["user_id"], "event_type", "event_id")


@query("select o_orderpriority, count(*) as rows, count(*) filter (where o_orderstatus = 'F') as done, count(*) filter (where o_orderstatus in ('O', 'P')) as open from orders group by 1")
def a_status_counts(spark, sf_dir):
    return stats.status_counts(table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_orderstatus", {"done": ["F"], "open": ["O", "P"]})


@query("select c_nationkey, count(distinct c_mktsegment) as groups, count(*) as items, sum(n)::bigint as variants, count(*) filter (where n > 0) as with_variants, sum(m)::bigint as excluded from (select c_nationkey, c_mktsegment, c_custkey, count(o_orderkey) as n, count(*) filter (where o_orderstatus = 'F') as m from customer left join orders on c_custkey = o_custkey group by 1, 2, 3) group by 1")
def a_catalogue_summary(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("m"))
    c = table(spark, sf_dir, "customer").join(o, "c_custkey", "left").na.fill(0, ["n", "m"])
    return stats.catalogue_summary(c, ["c_nationkey"], "c_mktsegment", F.col("n"), F.col("m"))


@query("select l_linestatus, count(*) as total, count(*) filter (where l_orderkey % 7 <> 0) as linked, count(*) filter (where l_orderkey % 7 = 0) as unmatched from lineitem group by 1")
def a_relationship_summary(spark, sf_dir):
    return stats.relationship_summary(table(spark, sf_dir, "lineitem"), "l_linestatus", F.col("l_orderkey") % 7 != 0)


@query("select p_brand, count(distinct p_size) as machines, count(*) filter (where p_type = 'SMALL') as active, count(*) filter (where p_type <> 'SMALL') as retired, array_to_string(list_sort(list_distinct(list(p_size))), ',') as numbers from part group by 1")
def a_design_summary(spark, sf_dir):
    return stats.design_summary(table(spark, sf_dir, "part"), ["p_brand"], "p_size", F.col("p_type") == "SMALL")


@query("select source, count(*) as rows, count(*) - count(quality) as missing_quality, count(*) - count(toxic) as missing_toxic from documents d left join labels l on d.doc_id = l.doc_id group by 1")
def a_missing_by_field(spark, sf_dir):
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return stats.missing_by_field(d, "source", ["quality", "toxic"])


@query("select doc_id, row_number() over (order by lang, n_chars desc, doc_id) as place from documents")
def w_range_numbers(spark, sf_dir):
    """All documents as one group."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return ranges.numbered(d, [], ["lang", F.desc("n_chars"), "doc_id"], "place").select("doc_id", "place")


@query("""
with d as (select doc_id, case when doc_id % 7 <> 0 then lang || source end as k from documents), f as (select *, case when k is null then doc_id else min(doc_id) over (partition by k) end as first from d)
select doc_id, dense_rank() over (order by first) as rank from f""")
def w_range_first(spark, sf_dir):
    """Documents by first appearance of language and source, all in one group; blank keys have ranks of their own."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 7 != 0, F.concat("lang", "source")).alias("k"))
    return ranges.rank_by_first(d, [], "k", "doc_id").select("doc_id", "rank")


@query("""
with d as (select doc_id, doc_id // 3000 as part, lang from documents), f as (select *, case when lang = lag(lang) over (partition by part order by doc_id) then 0 else 1 end as new from d),
r as (select *, sum(new) over (partition by part order by doc_id)::bigint as run from f)
select part, run, lang, min(doc_id) as start, max(doc_id) as "end", count(*) as length from r group by 1, 2, 3""")
def w_range_runs(spark, sf_dir):
    """Runs of a language, in parts of thousands of documents."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.floor(F.col("doc_id") / 3000).alias("part"), "lang")
    return ranges.runs(d, ["part"], ["lang"], ["doc_id"])


@query("select doc_id, last_value(case when n_chars > 15000 then doc_id end ignore nulls) over (order by doc_id rows unbounded preceding) as section from documents")
def w_range_fill(spark, sf_dir):
    """The last long document before each one; all are one group."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("n_chars") > 15000, F.col("doc_id")).alias("mark"))
    return ranges.forward_fill(d, [], "mark", "doc_id", "section").select("doc_id", "section")


@query("""
with e as (select lang, doc_id, case when doc_id % 3 = 0 then null else lang || (doc_id % 5) end as a, case when doc_id % 4 <> 0 then source when doc_id % 8 = 0 then '' end as b from documents where doc_id is not null),
l as (select lang, list({'a': a, 'b': b} order by doc_id) as l from e group by 1),
f as (select lang, len(l) as rows, list_reduce(l, lambda m, r: case when (case when coalesce(r.a, '') <> '' then 1 else 0 end + case when coalesce(r.b, '') <> '' then 1 else 0 end) > (case when coalesce(m.a, '') <> '' then 1 else 0 end + case when coalesce(m.b, '') <> '' then 1 else 0 end)
  then {'a': case when coalesce(r.a, '') <> '' then r.a else m.a end, 'b': case when coalesce(r.b, '') <> '' then r.b else m.b end} else {'a': case when coalesce(m.a, '') <> '' then m.a else r.a end, 'b': case when coalesce(m.b, '') <> '' then m.b else r.b end} end) as m from l),
s as (select lang, source, min(doc_id) as seen from documents group by 1, 2)
select f.lang, rows, m.a as a, m.b as b, (select string_agg(source, ',' order by seen) from s where s.lang = f.lang) as sources from f""")
def g_fold_stream(spark, sf_dir):
    """Documents folded in order for each language, one record at a time, and their sources by first appearance."""
    k = F.col("doc_id")
    d = table(spark, sf_dir, "documents").select("lang", "doc_id", "source", F.when(k % 3 != 0, F.concat("lang", (k % 5).cast("string"))).alias("a"), F.when(k % 4 != 0, F.col("source")).when(k % 8 == 0, "").alias("b"))
    merged = folds.dedup_merge_stream(d, ["lang"], "doc_id", ["a", "b"])
    groups = folds.merge_groups_stream(d, ["lang"], "doc_id", ["a"], "source")
    return merged.join(groups.select("lang", F.array_join("sources", ",").alias("sources")), "lang")
