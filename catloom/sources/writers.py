"""Sinks (K1-K5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloom.functions.records import canonical_json
from catloom.operators.contracts import check_one_place
from catloom.operators.shape import regroup


def write_country_exports(df: DataFrame, root: str, *, country: str = "country", continent: str = "continent", kind: str = "kind") -> DataFrame:
    """Write rows by continent, country and kind, rows without a country to __global__; returns the countries that lie on
    two continents, and writes nothing if there are any.
    """
    bad = check_one_place(df.where(F.col(country).isNotNull()), country, continent)
    if bad.isEmpty():
        rows = df.withColumns({country: F.coalesce(country, F.lit("__global__")), continent: F.coalesce(continent, F.lit("__global__"))})
        rows.write.mode("overwrite").partitionBy(continent, country, kind).parquet(root)
    return bad


def manifest(df: DataFrame, by: list[str]) -> DataFrame:
    """Per export: rows, bytes of their canonical JSON, and a checksum that does not depend on their order."""
    body = canonical_json(*sorted(df.columns))
    rows = df.select(*by, F.octet_length(body).alias("_b"), F.sha2(body, 256).alias("_h"))
    parts = [F.conv(F.substring("_h", 1 + 8 * i, 8), 16, 10).cast("decimal(38,0)") for i in range(4)]
    sums = F.concat_ws("-", *[F.sum(p).cast("string") for p in parts])
    return rows.groupBy(*by).agg(F.count("*").alias("rows"), F.sum("_b").alias("bytes"), F.sha2(sums, 256).alias("checksum"))


def verify_manifest(expected: DataFrame, actual: DataFrame, by: list[str]) -> DataFrame:
    """Exports whose manifest is not the same on both sides; null keys are equal."""
    cols = ["rows", "bytes", "checksum"]
    sides = expected.select(F.struct(*by).alias("_e"), F.struct(*cols).alias("e")), actual.select(F.struct(*by).alias("_a"), F.struct(*cols).alias("a"))
    both = sides[0].join(sides[1], F.col("_e").eqNullSafe(F.col("_a")), "full_outer").withColumn("_by", F.coalesce("_e", "_a"))
    return both.where(~F.col("e").eqNullSafe(F.col("a"))).select(*[F.col("_by")[c].alias(c) for c in by], F.col("e.rows").alias("expected_rows"), F.col("a.rows").alias("actual_rows"))


def write_catalogue(rows: DataFrame, path: str, keep: list[str], group: list[str], fields: list[str]) -> None:
    """Flat rows as nested documents in position order; the committer swaps files in as a whole."""
    regroup(rows, keep, group, fields).write.mode("overwrite").json(path)


def write_statistics(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_tabular(df: DataFrame, path: str, cols: dict[str, str]) -> DataFrame:
    """Chosen columns under their headers as CSV; returns the width of each column (longest value plus 2, 12 to 80)."""
    rows = df.select(*[F.col(c).alias(h) for c, h in cols.items()])
    rows.write.mode("overwrite").option("header", True).csv(path)
    width = lambda h: F.least(F.greatest(F.coalesce(F.max(F.length(F.col(h).cast("string"))), F.lit(0)) + 2, F.lit(len(h) + 2), F.lit(12)), F.lit(80))
    return rows.agg(*[width(h).alias(h) for h in cols.values()])
