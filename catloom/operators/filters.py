"""Filters and selections (F1-F8). What a selection asks for and lacks comes back as rows, not as an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def from_year(items: DataFrame, year: str, least: int) -> DataFrame:
    """Items that start in least or later; an unknown start is out."""
    return items.where(F.col(year) >= least)


def of_category(items: DataFrame, category: str, wanted: str, unknown: str = "unknown") -> tuple[DataFrame, DataFrame]:
    """Items of one category (an unknown one never counts), and the number found in each with whether it was kept."""
    own = F.coalesce(F.col(category), F.lit(unknown))
    kept = items.where((own == wanted) & (own != unknown))
    counts = items.groupBy(own.alias("category")).agg(F.count("*").alias("found")).withColumn("selected", (F.col("category") == wanted) & (F.col("category") != unknown))
    return kept, counts


def of_groups(items: DataFrame, group: str, titles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items of the groups named in titles (column title), and the titles that no item has."""
    wanted = titles.select(F.col("title").alias(group)).distinct()
    return items.join(wanted, group, "left_semi"), wanted.join(items.select(group).distinct(), group, "left_anti").withColumnRenamed(group, "title")


def in_requested_order(items: DataFrame, key: str, keys: list) -> tuple[DataFrame, DataFrame]:
    """Items of the requested keys with their place in the request (first mention counts), and the keys not found."""
    spark = items.sparkSession
    asked = spark.range(1).select(F.posexplode(F.array(*map(F.lit, keys))).alias("pos", key)).groupBy(key).agg(F.min("pos").alias("request_pos"))
    return items.join(F.broadcast(asked), key), asked.join(items.select(key).distinct(), key, "left_anti")  # as long as the request


def by_status(items: DataFrame, mode: str, *, status: str = "status", count: str = "count", failed: str = "failed", active: str = "active") -> DataFrame:
    """all, failed, or active with a count above 0."""
    tests = {"all": F.lit(True), "failed": F.col(status) == failed, "active": (F.col(status) == active) & (F.col(count) > 0)}
    return items.where(tests[mode])


def reviewed(items: DataFrame, status: str, *, out: tuple[str, ...] = ("rejected", "skipped"), open_: str = "pending") -> tuple[DataFrame, DataFrame]:
    """Items that review let through, and those that still wait for it (violations)."""
    own = F.coalesce(F.col(status), F.lit(open_))
    return items.where(~own.isin(*out, open_)), items.where(own == open_)


def pending_counts(items: DataFrame, by: str, value: str, placeholder: str) -> DataFrame:
    """Per group: all items and those whose classification is still the placeholder."""
    waits = F.coalesce(F.col(value), F.lit(placeholder)) == placeholder
    return items.groupBy(by).agg(F.count("*").alias("items"), F.count_if(waits).alias("pending"))


def by_membership(items: DataFrame, value: Column | str, members: list) -> tuple[DataFrame, DataFrame]:
    own = F.coalesce((F.col(value) if isinstance(value, str) else value).isin(*members), F.lit(False))
    return items.where(own), items.where(~own)


def top_rows(items: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    return items.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)
