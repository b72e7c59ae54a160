"""Set operations (X1-X3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_sets(before: DataFrame, after: DataFrame, key: list[str]) -> DataFrame:
    """Every key with whether it is in either side: created, deleted or common."""
    a, b = before.select(*key).distinct().withColumn("_a", F.lit(True)), after.select(*key).distinct().withColumn("_b", F.lit(True))
    kind = F.when(F.col("_a").isNull(), "created").when(F.col("_b").isNull(), "deleted").otherwise("common")
    return a.join(b, key, "full_outer").select(*key, kind.alias("kind"))


def array_setops(df: DataFrame, a: str, b: str) -> DataFrame:
    """Per row: values only in a, only in b, in both, and whether a is a subset of b."""
    return df.withColumns({"only_a": F.array_sort(F.array_except(a, b)), "only_b": F.array_sort(F.array_except(b, a)), "both": F.array_sort(F.array_intersect(a, b)), "subset": F.size(F.array_except(a, b)) == 0})


def union_reports(reports: dict[str, DataFrame], error: str = "error") -> tuple[DataFrame, DataFrame]:
    """All reports' rows with their name; rows with an error come apart."""
    out = None
    for name, df in reports.items():
        one = df.withColumn("report", F.lit(name))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    bad = F.col(error).isNotNull() if error in out.columns else F.lit(False)
    return out.where(~bad), out.where(bad)
