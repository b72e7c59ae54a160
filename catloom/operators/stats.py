"""Aggregations (A1-A8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catloom.functions.text import blank_to_null
from catloom.functions.years import year_bounds

CATEGORIES = ("circulating", "scarce", "withdrawn", "historical")


def availability_stats(items: DataFrame, by: list[str], category: str, first: str, last: str, categories: tuple = CATEGORIES) -> DataFrame:
    """Per group and category: items, earliest start and latest end; every category appears, others are ignored."""
    counts = items.where(F.col(category).isin(*categories)).groupBy(*by, category).agg(F.count("*").alias("items"), F.min(first).alias("first"), F.max(last).alias("last"))
    every = items.select(*by).distinct().withColumn(category, F.explode(F.array(*map(F.lit, categories))))
    return every.join(counts, [*by, category], "left").withColumn("items", F.coalesce("items", F.lit(0)))


def year_coverage(records: DataFrame, by: str, years: str, label: str) -> DataFrame:
    """Per group: first and last year, the labels of the rows that reach the last, and rows without years."""
    rows = records.withColumn("_y", year_bounds(F.col(years)))
    rows = rows.withColumn("_last", F.max("_y.last").over(Window.partitionBy(by)))
    return rows.groupBy(by).agg(F.min("_y.first").alias("first"), F.max("_y.last").alias("last"), F.array_join(F.array_sort(F.collect_set(F.when(F.col("_y.last") == F.col("_last"), F.col(label)))), ",").alias("labels"), F.count_if(F.col("_y.last").isNull()).alias("without_years"))


def mode_first(df: DataFrame, by: list[str], col: str, pos: str) -> DataFrame:
    """The most common non-blank value of each group; ties go to the one seen first."""
    counts = df.where(blank_to_null(F.col(col).cast("string")).isNotNull()).groupBy(*by, col).agg(F.count("*").alias("rows"), F.min(pos).alias("_seen"))
    best = Window.partitionBy(*by).orderBy(F.desc("rows"), "_seen")
    return counts.withColumn("_n", F.row_number().over(best)).where("_n = 1").select(*by, col, "rows")


def status_counts(df: DataFrame, by: list[str], status: str, roll: dict[str, list[str]]) -> DataFrame:
    """Per group: rows in each roll-up of statuses."""
    return df.groupBy(*by).agg(F.count("*").alias("rows"), *[F.count_if(F.col(status).isin(*values)).alias(name) for name, values in roll.items()])


def catalogue_summary(items: DataFrame, by: list[str], group: str, n_variants: Column, n_excluded: Column) -> DataFrame:
    return items.groupBy(*by).agg(F.count_distinct(group).alias("groups"), F.count("*").alias("items"), F.sum(n_variants).alias("variants"), F.count_if(n_variants > 0).alias("with_variants"), F.sum(n_excluded).alias("excluded"))


def relationship_summary(children: DataFrame, relation: str, linked: Column) -> DataFrame:
    return children.groupBy(relation).agg(F.count("*").alias("total"), F.count_if(linked).alias("linked"), F.count_if(~linked).alias("unmatched"))


def design_summary(items: DataFrame, by: list[str], machine: str, active: Column) -> DataFrame:
    """Per group: distinct machines, active and retired items, and the machines' numbers in order."""
    return items.groupBy(*by).agg(F.count_distinct(machine).alias("machines"), F.count_if(active).alias("active"), F.count_if(~active).alias("retired"), F.array_join(F.transform(F.array_sort(F.collect_set(machine)), lambda x: x.cast("string")), ",").alias("numbers"))


def missing_by_field(records: DataFrame, by: str, fields: list[str]) -> DataFrame:
    """Group by field: rows that lack it."""
    blank = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == ""
    return records.groupBy(by).agg(F.count("*").alias("rows"), *[F.count_if(blank(c)).alias(f"missing_{c}") for c in fields])
