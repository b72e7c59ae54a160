"""Resumable work (T1-T3): what is still to do, what a cache still answers, and how a checkpoint moves on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catloom.operators.shape import last_of, merge_last_wins


def todo(items: DataFrame, checkpoint: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """Items that the checkpoint lacks, and the checkpoint's rows whose key is still there."""
    return items.join(checkpoint.select(*key).distinct(), key, "left_anti"), checkpoint.join(items.select(*key).distinct(), key, "left_semi")


def progress(items: DataFrame, checkpoint: DataFrame, key: list[str]) -> DataFrame:
    done = checkpoint.select(*key).distinct().withColumn("_d", F.lit(True))
    return items.select(*key).distinct().join(done, key, "left").agg(F.count("*").alias("expected"), F.count("_d").alias("completed"))


def reuse_cache(inputs: DataFrame, cache: DataFrame, key: list[str], pos: str, made: str, now: Column, max_age_days: int, valid: Column) -> DataFrame:
    """One row per key in order of the inputs: its cached row where that is valid and young enough, else to be asked again."""
    first = inputs.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(pos))).where("_n = 1").drop("_n")
    good = cache.where(valid & (F.col(made) >= now - F.make_dt_interval(F.lit(max_age_days))))
    good = last_of(good, key, [made])
    keep = [c for c in good.columns if c not in key and c not in first.columns]
    return first.join(good.select(*key, *keep, F.lit(True).alias("reused")), key, "left").withColumn("reused", F.coalesce("reused", F.lit(False)))


def checkpoint_merge(state: DataFrame, results: DataFrame, live: DataFrame, key: list[str], plan_hash: str, *, order: list[str] = ()) -> DataFrame:
    """State (key, id, plan_hash) with new results, the last of a key by order; a recorded id that is gone, or another
    plan's hash, is a conflict.
    """
    rows = merge_last_wins(state, results, key, order=order)
    rows = rows.join(live.select("id").distinct().withColumn("_l", F.lit(True)), "id", "left")
    status = F.when(F.col("plan_hash") != plan_hash, "another plan").when(F.col("_l").isNull(), "target is gone").otherwise("verified")
    return rows.withColumn("status", status).drop("_l")
