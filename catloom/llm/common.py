"""Helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a maximal run of characters other than space and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or a local one where it is unset in local mode (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if "dir" not in _local:
        _local["dir"] = "file://" + tempfile.mkdtemp(prefix="catloom-")
    return _local["dir"]


def fresh_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str, path: str | None = None) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = path or fresh_path(spark, tag)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(df: DataFrame, text_col: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(df[text_col].cast("string"), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python in batches of a few MB, however long they are, unless the session has its own limit.

    The limit is the session's, as Spark reads it when the job runs; without one, 10,000 whole texts are a batch.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(4 << 20))


def steps(batches: Iterator, rows: int = 1000) -> Iterator:
    """Arrow batches in parts of so many rows, so that few texts are Python objects at a time."""
    for batch in batches:
        for i in range(0, len(batch), rows):
            yield batch.slice(i, rows)


def free_prefix(df: DataFrame, prefix: str) -> str:
    """A prefix that no column of df starts with."""
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix = "_" + prefix
    return prefix


def one_each(rows: DataFrame, key: list[Column], p: str) -> DataFrame:
    """One of the rows of each key, chosen by a hash of all columns."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    columns = [F.col(f"`{c}`").cast("string") if "map<" in t else F.col(f"`{c}`") for c, t in kinds.items()]  # maps have no hash
    order = Window.partitionBy(*key).orderBy(F.xxhash64(*columns))
    return rows.withColumn(f"{p}n", F.row_number().over(order)).where(F.col(f"{p}n") == 1).drop(f"{p}n")
