"""Streaming form of the resumable merge (T5): landed files flow into a keyed table, bucket by bucket."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloom.sources import keyed_table


def new_rows(stream: DataFrame, key: list[str], time: str, delay: str) -> DataFrame:
    """Rows of a stream, the first of each key within the delay."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(key)


def _base(spark, target: str, note: str) -> int:
    """The version that a checkpoint's first batch commits: noted beside the checkpoint when it is first used."""
    try:
        return spark.read.schema("base long").parquet(note).first()["base"]
    except AnalysisException as gone:
        if gone.getCondition() != "PATH_NOT_FOUND":
            raise
    known = keyed_table.versions(spark, target)
    base = known[-1] + 1 if known else 0
    spark.range(1).select(F.lit(base).cast("long").alias("base")).write.mode("overwrite").parquet(note)
    return base


def stream_upsert(stream: DataFrame, target: str, key: list[str], checkpoint: str, *, order: list[str] = (), replace: bool = True, time: str | None = None, delay: str = "1 hour", buckets: int = 64):
    """Start a query that merges each micro-batch into the keyed table at target and commits it (see ``sources.keyed_table``).

    Only the buckets that a batch touches are written again. replace: rows of a known key overwrite it, else known keys are
    skipped (the batch form of todo). order: of two rows of a key, in one batch or in two, the last by it stays, so a late
    older row changes nothing; without it a later batch wins. A batch that runs again after a failure is skipped if it was
    committed, and else made anew from the table before it. A new checkpoint over a table that is there goes on from its
    newest version.
    """
    base = _base(stream.sparkSession, target, f"{checkpoint.rstrip('/')}-base")
    rows = new_rows(stream, key, time, delay) if time else stream

    def add(batch: DataFrame, number: int) -> None:
        keyed_table.merge(batch.sparkSession, target, batch, key, order=order, buckets=buckets, replace=replace, version=base + number)

    return rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def latest(spark, target: str) -> DataFrame:
    """The newest version of a table that stream_upsert writes."""
    return keyed_table.read(spark, target)
