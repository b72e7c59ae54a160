"""Structured Streaming over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catloom.plans.registry import query, scratch, table
from catloom.sources import keyed_table, writers
from catloom.streaming import upserts


@query("select event_type, count(*) as rows, count(distinct user_id) as users from events group by 1")
def t_stream_upsert(spark, sf_dir):
    """The events file as a stream that is merged into a keyed table, then read back."""
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    target = scratch(spark, "stream-table")
    upserts.stream_upsert(stream, target, ["event_id"], scratch(spark, "stream-state")).awaitTermination()
    return upserts.latest(spark, target).groupBy("event_type").agg(F.count("*").alias("rows"), F.count_distinct("user_id").alias("users"))


@query("""
with r as (select *, row_number() over (partition by conv_id order by turn desc) as n from conversations)
select conv_id, turn, role, length(text) as size from r where n = 1""")
def t_keyed_batches(spark, sf_dir):
    """The last turn of each conversation: files in any order flow into a keyed table batch by batch, late turns change nothing."""
    c = table(spark, sf_dir, "conversations")
    landed, target = scratch(spark, "landed"), scratch(spark, "keyed-table")
    c.repartition(4, F.pmod(F.col("turn") * 7 + 3, F.lit(5))).write.parquet(landed)
    stream = spark.readStream.schema(c.schema).option("maxFilesPerTrigger", 2).parquet(landed)
    upserts.stream_upsert(stream, target, ["conv_id"], scratch(spark, "stream-state"), order=["turn"], buckets=16).awaitTermination()
    return upserts.latest(spark, target).select("conv_id", "turn", "role", F.length("text").cast("long").alias("size"))


@query("""
select k, vec_id, label from (select vec_id % 5000 as k, vec_id, label, row_number() over (partition by vec_id % 5000 order by vec_id) as n from embeddings) where n = 1""")
def t_keyed_skip(spark, sf_dir):
    """Two merges that skip known keys: the first row of each key stays."""
    e = table(spark, sf_dir, "embeddings").select((F.col("vec_id") % 5000).alias("k"), "vec_id", F.col("label").cast("long").alias("label"), (-F.col("vec_id")).alias("turn"))
    target = scratch(spark, "keyed-table")
    half = e.agg(F.max("vec_id").alias("top"))  # one row
    both = e.join(F.broadcast(half))
    first = both.where("2 * vec_id <= top").drop("top")
    for rows in (both.where("2 * vec_id <= top"), both.where("2 * vec_id > top")):
        keyed_table.merge(spark, target, rows.drop("top"), ["k"], order=["turn"], replace=False, buckets=16)
    return keyed_table.read(spark, target).select("k", "vec_id", "label")


@query("select s_nationkey, count(*) as rows, case s_nationkey % 5 when 0 then 'AFRICA' end as continent from supplier where s_nationkey % 5 = 0 group by 1")
def k_country_exports(spark, sf_dir):
    """Exports partitioned by place, written and read back with the partition pruned."""
    s = table(spark, sf_dir, "supplier").withColumn("continent", F.when(F.col("s_nationkey") % 5 == 0, "AFRICA").otherwise("OTHER")).withColumn("country", F.col("s_nationkey").cast("string")).withColumn("kind", F.lit("supplier"))
    root = scratch(spark, "exports")
    writers.write_country_exports(s, root)
    return spark.read.parquet(root).where("continent = 'AFRICA'").groupBy("s_nationkey").agg(F.count("*").alias("rows"), F.first("continent").alias("continent"))


@query("select o_custkey, count(*) as n_items, min(o_orderkey) as first from orders group by 1")
def k_write_catalogue(spark, sf_dir):
    """Nested documents written as JSON and read back with their schema."""
    o = table(spark, sf_dir, "orders").select("o_custkey", F.lit(0).alias("group_pos"), F.col("o_orderstatus").alias("title"), F.col("o_orderkey").alias("item_pos"), "o_orderkey")
    path = scratch(spark, "catalogue")
    writers.write_catalogue(o, path, ["o_custkey"], ["title"], ["o_orderkey"])
    back = spark.read.schema("o_custkey long, groups array<struct<title:string,items:array<struct<o_orderkey:long>>>>").json(path)
    items = F.flatten(F.transform("groups", lambda g: g["items"]))
    return back.select("o_custkey", F.size(items).cast("long").alias("n_items"), F.array_min(F.transform(items, lambda x: x["o_orderkey"])).alias("first"))
