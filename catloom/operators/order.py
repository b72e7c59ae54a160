"""Ordering, ranking and runs (W1-W8). Windows are always partitioned, by the catalogue or the source file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catloom.functions.text import fold_keep_accents


def catalogue_order(items: DataFrame, part: list[str], group: Column, label: Column, years: Column, pos: str, *, value: Column | None = None) -> DataFrame:
    """Place 1..n in each part: by first appearance of the folded group, then of the label within it (or by value, then the
    label), then by years (a struct), then by position.
    """
    rows = items.withColumn("_g", fold_keep_accents(group)).withColumn("_l", fold_keep_accents(label))
    rows = rows.withColumn("_gp", F.min(pos).over(Window.partitionBy(*part, "_g"))).withColumn("_lp", F.min(pos).over(Window.partitionBy(*part, "_g", "_l")))
    mid = [value, F.col("_l")] if value is not None else [F.col("_lp")]
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*part).orderBy("_gp", *mid, years, pos))).drop("_g", "_l", "_gp", "_lp")


def gapless_rank(items: DataFrame, part: list[str], key: str, pos: str) -> DataFrame:
    """1..n by first appearance; equal keys share a number and each blank key has its own."""
    blank = F.trim(F.coalesce(F.col(key).cast("string"), F.lit(""))) == ""
    rows = items.withColumn("_own", F.when(blank, F.col(pos)))
    rows = rows.withColumn("_first", F.when(blank, F.col(pos)).otherwise(F.min(pos).over(Window.partitionBy(*part, key, "_own"))))
    return rows.withColumn("rank", F.dense_rank().over(Window.partitionBy(*part).orderBy("_first"))).drop("_own", "_first")


def resequence(items: DataFrame, part: list[str], order: list[Column | str]) -> DataFrame:
    return items.withColumn("sequence", F.row_number().over(Window.partitionBy(*part).orderBy(*order)))


def append_after(items: DataFrame, new: DataFrame, part: list[str], order: str, by: list[str]) -> DataFrame:
    """new rows numbered on from each part's greatest order."""
    top = items.groupBy(*part).agg(F.max(order).alias("_top"))
    return new.join(top, part, "left").withColumn(order, (F.coalesce("_top", F.lit(0)) + F.row_number().over(Window.partitionBy(*part).orderBy(*by))).cast("long")).drop("_top")


def runs(items: DataFrame, part: list[str], cols: list[str], pos: list[str]) -> DataFrame:
    """Runs of equal cols in order: number, first and last position (of pos[0]) and length."""
    w = Window.partitionBy(*part).orderBy(*pos)
    same = F.lit(True)
    for c in cols:
        same = same & F.col(c).eqNullSafe(F.lag(c).over(w))
    rows = items.withColumn("_new", F.when((F.row_number().over(w) > 1) & same, 0).otherwise(1))
    rows = rows.withColumn("run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*part, "run", *cols).agg(F.min(pos[0]).alias("start"), F.max(pos[0]).alias("end"), F.count("*").alias("length"))


def forward_fill(rows: DataFrame, part: list[str], col: str, pos: str, name: str) -> DataFrame:
    return rows.withColumn(name, F.last(col, ignorenulls=True).over(Window.partitionBy(*part).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)))


def stable_sort_key(*cols: Column) -> Column:
    """Folded columns as one sortable struct."""
    return F.struct(*[fold_keep_accents(c).alias(f"k{i}") for i, c in enumerate(cols)])


def item_ids(items: DataFrame, group_pos: str = "group_pos", item_pos: str = "item_pos") -> DataFrame:
    """Positional ids p{i}-c{j}, both from 1."""
    return items.withColumn("item_id", F.concat(F.lit("p"), F.col(group_pos) + 1, F.lit("-c"), F.col(item_pos) + 1))
