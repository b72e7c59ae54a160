"""Folders that all executors share: below spark.checkpoint.dir, or a local one where that is unset in local mode (tests)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path; unset on a cluster is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not base:
        base = _local.setdefault("dir", "") or _local.update(dir="file://" + tempfile.mkdtemp(prefix="catloom-")) or _local["dir"]
    return f"{base.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(rows: DataFrame, *key: str, each: int = 500_000, n: int | None = None) -> DataFrame:
    """Rows dealt by key into tasks of about so many rows, however many rows there are, and the session's partitions at least.

    What partitions by the key afterwards (windows, groups) stays in these tasks. n: the number of rows, if it is known.
    """
    n = rows.count() if n is None else n
    return rows.repartition(max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // each)), *key)
