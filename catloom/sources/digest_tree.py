"""Snapshots with a tree of digests (D6): two of them are compared by reading only the ranges that differ.

Rows are dealt to ``leaves`` ranges by a hash of the key, each a folder of its own. A leaf's digest is that of its rows'
manifest (canonical JSON, so nulls count, and no order). ``fanout`` nodes of a level make one of the next, up to a single
root; each level is a small table. Two trees are compared from the root down: only below nodes that differ are the next
level's digests looked at, and only rows of leaves that differ are read and compared.

Defined cases: equal snapshots read no rows; a leaf without rows has no digest and no folder; snapshots with another key,
number of leaves or fanout cannot be compared and raise an error; null keys are a key; empty tables make a tree of a root.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from catloom.operators.findings import snapshot_diff
from catloom.sources.writers import manifest

_LEVEL = "node int, rows long, digest string"
_ABOUT = "key string, leaves int, fanout int, levels int, schema string"


def write_tree(df: DataFrame, path: str, key: list[str], *, leaves: int = 1024, fanout: int = 16) -> None:
    """Write rows by leaf, then the levels from the leaves up, and last what the tree is: a reader needs that record."""
    spark, levels = df.sparkSession, 1
    while fanout**levels < leaves:
        levels += 1
    rows = df.withColumn("_leaf", F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in key]), F.lit(leaves)).cast("int"))
    rows.repartition("_leaf").write.partitionBy("_leaf").parquet(f"{path}/data")
    there = spark.read.schema(rows.schema).parquet(f"{path}/data")
    level = manifest(there, ["_leaf"]).select(F.col("_leaf").alias("node"), "rows", F.col("checksum").alias("digest"))
    for k in range(levels + 1):
        level.coalesce(1).write.parquet(f"{path}/levels/level={k}")
        level = spark.read.schema(_LEVEL).parquet(f"{path}/levels/level={k}")
        children = F.array_sort(F.collect_list(F.struct("node", "digest")))  # at most fanout
        level = level.groupBy(F.floor(F.col("node") / fanout).cast("int").alias("node")).agg(F.sum("rows").alias("rows"), F.sha2(F.to_json(children), 256).alias("digest"))
    spark.createDataFrame([(",".join(key), leaves, fanout, levels, df.schema.json())], _ABOUT).coalesce(1).write.json(f"{path}/about")


def _about(spark: SparkSession, path: str):
    return spark.read.schema(_ABOUT).json(f"{path}/about").first()


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    both = a.select("node", F.col("digest").alias("a")).join(b.select("node", F.col("digest").alias("b")), "node", "full_outer")
    return both.where(~F.col("a").eqNullSafe(F.col("b"))).select("node", F.col("a").isNotNull().alias("in_a"), F.col("b").isNotNull().alias("in_b"))


def changed_leaves(spark: SparkSession, before: str, after: str) -> list[tuple[int, bool, bool]]:
    """Leaves that differ, and whether either side has rows there: at most the tree's leaves."""
    x, y = _about(spark, before), _about(spark, after)
    if (x["key"], x["leaves"], x["fanout"]) != (y["key"], y["leaves"], y["fanout"]):
        raise ValueError("trees of another key or shape")
    found = None
    for k in range(x["levels"], -1, -1):
        a, b = (spark.read.schema(_LEVEL).parquet(f"{p}/levels/level={k}") for p in (before, after))
        if found is not None:
            below = F.floor(F.col("node") / x["fanout"]).isin([r["node"] for r in found])
            a, b = a.where(below), b.where(below)
        found = _differing(a, b).collect()
        if not found:
            return []
    return sorted((r["node"], r["in_a"], r["in_b"]) for r in found)


def _leaf_rows(spark: SparkSession, path: str, leaves: list[int]) -> DataFrame:
    schema = StructType.fromJson(json.loads(_about(spark, path)["schema"]))
    return spark.read.schema(schema).parquet(*[f"{path}/data/_leaf={n}" for n in leaves]) if leaves else spark.createDataFrame([], schema)


def tree_diff(spark: SparkSession, before: str, after: str, cols: list[str]) -> DataFrame:
    """What snapshot_diff gives for the keys that are not the same in both: created, deleted and modified ones."""
    leaves = changed_leaves(spark, before, after)
    key = _about(spark, before)["key"].split(",")
    a, b = _leaf_rows(spark, before, [n for n, there, _ in leaves if there]), _leaf_rows(spark, after, [n for n, _, there in leaves if there])
    return snapshot_diff(a, b, key, cols).where("status <> 'unchanged'")


def unchanged_rows(spark: SparkSession, before: str, after: str) -> int:
    """Rows of the leaves that are the same in both, told by the digests alone."""
    differ = [n for n, _, _ in changed_leaves(spark, before, after)]
    return spark.read.schema(_LEVEL).parquet(f"{before}/levels/level=0").where(~F.col("node").isin(differ or [-1])).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
