"""Readers and sinks: given tables written in the layout that a reader expects, and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloom.operators import extract
from catloom.plans.registry import query, scratch, table
from catloom.sources import readers, snapshots, writers


def _suppliers(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return table(spark, sf_dir, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"))


def _catalogues(spark, sf_dir) -> str:
    """A document for each nation below region and nation; those of every seventh nation have no periods."""
    s = _suppliers(spark, sf_dir)
    items = F.array_sort(F.collect_list(F.struct(F.col("s_name").alias("denomination"), F.col("s_acctbal").alias("value"))))
    period = F.array(F.struct(F.lit("all").alias("title"), items.alias("coins")))
    docs = s.groupBy("r_name", "n_name", "n_nationkey").agg(period.alias("periods"))
    body = F.struct(F.col("n_name").alias("country"), F.when(F.col("n_nationkey") % 7 != 0, F.col("periods")).alias("periods"))
    root = scratch(spark, "catalogues")
    docs.select("r_name", F.col("n_name").alias("land"), F.to_json(body).alias("value")).write.partitionBy("r_name", "land").text(root)
    return root


@query("""
select n_name as country, case when n_nationkey % 7 <> 0 then count(*) end as items, n_nationkey % 7 <> 0 as good from supplier join nation on s_nationkey = n_nationkey group by n_name, n_nationkey""")
def s_read_catalogue(spark, sf_dir):
    good, bad = readers.read_catalogue(spark, f"{_catalogues(spark, sf_dir)}/*/*/part-*")
    items = F.size(F.flatten(F.transform("periods", lambda p: p["coins"]))).cast("long")
    land = F.regexp_extract(F.url_decode("source_file"), "land=([^/]*)", 1)
    return good.select("country", items.alias("items"), F.lit(True).alias("good")).unionByName(bad.select(land.alias("country"), F.lit(None).cast("long").alias("items"), F.lit(False).alias("good")))


@query("""
select 'r_name=' || r_name as continent, 'land=' || n_name as folder, n_name as country, s_name as name, s_acctbal as value from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey where n_nationkey % 7 <> 0""")
def s_catalogue_tree(spark, sf_dir):
    tree = readers.read_catalogue_tree(spark, _catalogues(spark, sf_dir), "part-*")
    coins = tree.select(F.col("continent_dir").alias("continent"), F.col("country_dir").alias("folder"), "country", F.explode(F.flatten(F.transform("periods", lambda p: p["coins"]))).alias("c"))
    return coins.select("continent", "folder", "country", F.col("c.denomination").alias("name"), F.col("c.value").alias("value"))


def _snapshot(spark, sf_dir) -> DataFrame:
    """Customers and suppliers as entities; every fiftieth customer has no id."""
    root = scratch(spark, "snapshot")
    c = table(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 50 != 0, F.col("c_custkey")).alias("id"), F.col("c_name").alias("name"))
    s = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 40).alias("id"), F.col("s_name").alias("name"))
    for entity, rows in (("customer", c), ("supplier", s)):
        rows.select(F.to_json(F.struct("id", "name")).alias("value")).write.text(f"{root}/{entity}.json")
    return readers.read_entity_snapshot(spark, root, ["customer", "supplier"])


_ENTITIES = """
with e as (select 'customer' as entity, case when c_custkey % 50 <> 0 then c_custkey::varchar end as id, c_name as name from customer union all select 'supplier', (s_suppkey % 40)::varchar, s_name from supplier)"""


@query(_ENTITIES + " select * from e")
def s_entity_snapshot(spark, sf_dir):
    return _snapshot(spark, sf_dir).select("entity", "id", F.try_variant_get("payload", "$.name", "string").alias("name"))


@query(_ENTITIES + " select entity, id, count(*) as rows from e group by entity, id having id is null or count(*) > 1")
def s_snapshot_problems(spark, sf_dir):
    return readers.snapshot_problems(_snapshot(spark, sf_dir))


@query("select o_orderkey, o_orderstatus from orders where o_orderkey % 9 <> 0")
def s_read_tracking(spark, sf_dir):
    """Memory with broken lines, and one that is not there."""
    path = scratch(spark, "tracking")
    good = F.to_json(F.struct("o_orderkey", "o_orderstatus"))
    table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 9 == 0, F.lit('{"o_orderkey": ')).otherwise(good).alias("value")).write.text(path)
    schema = "o_orderkey long, o_orderstatus string"
    return readers.read_tracking(spark, path, schema).unionByName(readers.read_tracking(spark, f"{path}-none", schema))


@query("""
with r as (select s_nationkey, s_suppkey as id, s_name as name, row_number() over (partition by s_nationkey order by s_suppkey) - 1 as pos from supplier)
select s_nationkey::varchar as part, pos::bigint as pos, id::bigint as id, name from r where s_nationkey % 4 <> 1 or pos = 0""")
def s_read_reports(spark, sf_dir):
    """A file for each nation: a list, one report, or an object with reports or countries."""
    s = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.array_sort(F.collect_list(F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")))).alias("r"))
    k = F.col("s_nationkey") % 4
    body = F.when(k == 0, F.to_json("r")).when(k == 1, F.to_json(F.element_at("r", 1))).when(k == 2, F.to_json(F.struct(F.col("r").alias("reports")))).otherwise(F.to_json(F.struct(F.col("r").alias("countries"))))
    root = scratch(spark, "reports")
    s.select("s_nationkey", body.alias("value")).write.partitionBy("s_nationkey").text(root)
    got = readers.read_reports(spark, f"{root}/*/part-*", "id long, name string")
    return got.select(F.regexp_extract("source_file", "s_nationkey=([0-9]+)", 1).alias("part"), F.col("pos").cast("long").alias("pos"), "id", "name")


@query("""
select c_mktsegment, case when c_mktsegment in ('BUILDING', 'MACHINERY') then null else count(*) end as rows,
 case c_mktsegment when 'BUILDING' then 'not complete' when 'MACHINERY' then 'number of rows' end as problem from customer group by 1""")
def s_read_verified(spark, sf_dir):
    """An export read behind its manifest: one entry is open, one lacks a row of what is there."""
    c = table(spark, sf_dir, "customer")
    root = scratch(spark, "verified")
    c.write.partitionBy("c_mktsegment").parquet(root)
    drop = c.where("c_mktsegment = 'MACHINERY'").agg(F.max("c_custkey").alias("_k"))  # one row
    entries = c.join(F.broadcast(drop), c["c_custkey"] == drop["_k"], "left_anti")
    entries = writers.manifest(entries, ["c_mktsegment"]).withColumn("status", F.when(F.col("c_mktsegment") == "BUILDING", "open").otherwise("complete"))
    good, bad = readers.read_verified(spark, root, entries, ["c_mktsegment"])
    good = good.groupBy("c_mktsegment").agg(F.count("*").alias("rows")).withColumn("problem", F.lit(None).cast("string"))
    return good.unionByName(bad.withColumn("rows", F.lit(None).cast("long")))


@query("select o_orderpriority, count(*) as orders, min(o_orderkey)::bigint as first from orders group by 1")
def k_write_statistics(spark, sf_dir):
    path = scratch(spark, "statistics")
    writers.write_statistics(table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("orders"), F.min("o_orderkey").alias("first")), path)
    return spark.read.schema("o_orderpriority string, orders long, first long").json(path)


@query("select c_custkey::varchar as \"Number\", c_name as \"Name\", c_mktsegment as \"Segment\" from customer")
def k_write_tabular(spark, sf_dir):
    path = scratch(spark, "tabular")
    writers.write_tabular(table(spark, sf_dir, "customer"), path, {"c_custkey": "Number", "c_name": "Name", "c_mktsegment": "Segment"})
    return spark.read.schema("Number string, Name string, Segment string").option("header", True).csv(path)


@query("""
select least(greatest(max(length(p_name)) + 2, 12), 80)::bigint as "Name", least(greatest(max(length(p_type)) + 2, 12), 80)::bigint as "Type", least(greatest(max(length(p_size::varchar)) + 2, 12), 80)::bigint as "Size" from part""")
def k_tabular_widths(spark, sf_dir):
    widths = writers.write_tabular(table(spark, sf_dir, "part"), scratch(spark, "tabular"), {"p_name": "Name", "p_type": "Type", "p_size": "Size"})
    return widths.select(*[F.col(c).cast("long").alias(c) for c in widths.columns])


@query("""
select l_orderkey as page_id, row_number() over (partition by l_orderkey order by l_linenumber, l_returnflag)::bigint - 1 as n, l_linenumber::varchar || '|' || l_returnflag as cells from lineitem""")
def e_table_rows(spark, sf_dir):
    """The lines of an order as a table of a page."""
    row = F.concat(F.lit("<tr><td>"), F.col("l_linenumber").cast("string"), F.lit("</td> | <td>"), F.col("l_returnflag"), F.lit("</td></tr>"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", row.alias("h")))), lambda x: x["h"])
    pages = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("page_id")).agg(F.concat(F.lit("<table>"), F.array_join(lines, "\n"), F.lit("</table>")).alias("html"))
    return extract.table_rows(pages).select("page_id", F.col("row").cast("long").alias("n"), F.array_join("cells", "|").alias("cells"))


_LABELS = snapshots.Relation("labels", "doc_id", "documents", "doc_id")


def _snapshots(spark, sf_dir) -> str:
    """Two finished snapshots of documents and labels below a root, and a third that died before its manifest."""
    d, l = table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels")
    root = scratch(spark, "snapshots")
    snapshots.write_snapshot(spark, root, "first", {"documents": d.where("doc_id % 2 = 0"), "labels": l}, [_LABELS])
    snapshots.write_snapshot(spark, root, "second", {"documents": d, "labels": l.where("quality = 1")}, [_LABELS])
    d.write.parquet(f"{root}/third/entities/documents")
    return root


@query("""
select 'entity' as kind, 'documents' as name, count(*) as rows, 0 as parents, 0 as orphans, 0 as childless from documents
union all select 'entity', 'labels', count(*), 0, 0, 0 from labels where quality = 1
union all select 'totals', '*', (select count(*) from documents) + (select count(*) from labels where quality = 1), 0, 0, 0
union all select 'relation', 'labels.doc_id -> documents.doc_id', (select count(doc_id) from labels where quality = 1), (select count(doc_id) from documents),
 (select count(doc_id) from labels where quality = 1 and doc_id not in (select doc_id from documents)), (select count(*) from documents where doc_id not in (select doc_id from labels where quality = 1))""")
def s_snapshot_pointer(spark, sf_dir):
    """The manifest of the snapshot that the pointer names: the last finished one, with totals and relations."""
    root = _snapshots(spark, sf_dir)
    said = snapshots.read_manifest(spark, root, snapshots.resolve_pointer(spark, root))
    return said.select("kind", "name", "rows", "parents", "orphans", "childless")


@query("""
select 'totals' as kind, '*' as name, 'number of rows' as problem union all select 'entity', 'labels', 'number of rows'
union all select 'relation', 'labels.doc_id -> documents.doc_id', 'number of rows'""")
def s_snapshot_verdicts(spark, sf_dir):
    """Rows that came into a finished snapshot afterwards contradict its totals."""
    root = _snapshots(spark, sf_dir)
    table(spark, sf_dir, "labels").where("quality = 0").write.mode("append").parquet(f"{root}/second/entities/labels")
    return snapshots.snapshot_verdicts(spark, root, "second", [_LABELS])


@query("""
with p as (select page_id, case page_id % 4 when 0 then url when 1 then 'snap-' || page_id when 2 then '..' else ' ' end as pointer from pages)
select page_id, case when trim(pointer) = '' then 'blank' when pointer = '..' or contains(pointer, '/') then 'outside the root' end as problem from p""")
def s_pointer_problems(spark, sf_dir):
    k = F.col("page_id") % 4
    pointer = F.when(k == 0, F.col("url")).when(k == 1, F.concat(F.lit("snap-"), "page_id")).when(k == 2, "..").otherwise(" ")
    return table(spark, sf_dir, "pages").select("page_id", snapshots.pointer_problem(pointer).alias("problem"))
