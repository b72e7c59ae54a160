"""Data-quality contracts (Q1-Q12): violations are rows; a contract that holds gives none."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


def check_required(df: DataFrame, keep: list[str], *, required: list[str] = (), allowed: dict[str, list] | None = None, tests: dict[str, Column] | None = None) -> DataFrame:
    """keep and problem, for each field that is blank, each value outside its list, each test that fails."""
    blank = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == ""
    problems = [F.when(blank(c), F.lit(f"{c} is blank")) for c in required]
    problems += [F.when(~F.coalesce(F.col(c).isin(*values), F.lit(False)), F.lit(f"{c} is not allowed")) for c, values in (allowed or {}).items()]
    problems += [F.when(~F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in (tests or {}).items()]
    return df.select(*keep, F.explode(F.array_compact(F.array(*problems))).alias("problem"))


def check_unique(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that are blank or occur twice, with their number."""
    blank = F.lit(False)
    for k in key:
        blank = blank | (F.trim(F.coalesce(F.col(k).cast("string"), F.lit(""))) == "")
    return df.groupBy(*key).agg(F.count("*").alias("rows")).where(blank | (F.col("rows") > 1))


def check_schema(df: DataFrame, *, required: list[str], optional: list[str] = (), block: list[str] = (), forbidden: list[str] = ()) -> DataFrame:
    """Columns that are missing, not allowed, forbidden or nested; the optional block must be there in whole or not at all."""
    have = set(df.columns)
    problems = [(c, "missing") for c in required if c not in have]
    problems += [(c, "forbidden") for c in forbidden if c in have]
    problems += [(c, "not allowed") for c in df.columns if c not in {*required, *optional, *block, *forbidden}]
    problems += [(f.name, "nested") for f in df.schema.fields if f.dataType.typeName() in ("struct", "map")]
    if have & set(block) and not set(block) <= have:
        problems += [(c, "block is not whole") for c in block if c not in have]
    return df.sparkSession.createDataFrame(problems, "column string, problem string")


def check_sequence(df: DataFrame, part: list[str], col: str, *, first: int = 0) -> DataFrame:
    """Rows whose order is not that of a gapless sequence from first, in each part."""
    place = F.row_number().over(Window.partitionBy(*part).orderBy(col)) - 1 + first
    return df.withColumn("expected", place).where(~F.col(col).eqNullSafe(F.col("expected")))


def check_tags(df: DataFrame, included: str, excluded: str, flag: str) -> Column:
    """Problems of a row's tags: repeated, in both lists, or a flag that does not tell whether there are any."""
    return F.array_compact(F.array(F.when(F.size(F.array_distinct(included)) < F.size(included), "repeated tag"), F.when(F.arrays_overlap(included, excluded), "included and excluded"), F.when(F.col(flag) != (F.size(included) > 0), "flag differs")))


def check_category(df: DataFrame, category: str, expected: str) -> DataFrame:
    return df.where(~F.col(category).eqNullSafe(F.lit(expected)))


def check_counts(df: DataFrame, by: list[str], expected: DataFrame) -> DataFrame:
    """Groups whose number of rows is not that of the contract (by, expected)."""
    rows = df.groupBy(*by).agg(F.count("*").alias("actual")).join(expected, by, "full_outer")
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("actual", "expected")})
    return rows.where("actual <> expected")


def check_fk(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str, flag: str | None = None) -> DataFrame:
    """Children without their parent and, where flag is given, parents whose flag does not tell whether they have children."""
    gone = children.join(parents.select(F.col(parent_key).alias(child_key)).distinct(), child_key, "left_anti").select(F.col(child_key).alias("key"), F.lit("no parent").alias("problem"))
    if flag is None:
        return gone
    own = children.select(F.col(child_key).alias(parent_key)).distinct().withColumn("_has", F.lit(True))
    wrong = parents.join(own, parent_key, "left").where(F.col(flag) != F.coalesce("_has", F.lit(False)))
    return gone.unionByName(wrong.select(F.col(parent_key).alias("key"), F.lit("flag differs").alias("problem")))


def audit(checks: dict[str, tuple[DataFrame, int]]) -> DataFrame:
    """A row for each named check (rows that speak against it, number expected): ok or blocked."""
    out = None
    for name, (rows, expected) in checks.items():
        one = rows.agg(F.count("*").alias("actual")).select(F.lit(name).alias("check"), F.lit(expected).cast("long").alias("expected"), "actual")
        out = one if out is None else out.unionByName(one)
    return out.withColumn("status", F.when(F.col("expected") == F.col("actual"), "ok").otherwise("blocked"))


def cleanup_candidates(records: DataFrame, migrated: DataFrame, references: DataFrame, key: str) -> DataFrame:
    """Records whose key was migrated and that nothing references any more."""
    return records.join(migrated.select(key).distinct(), key, "left_semi").join(references.select(key).distinct(), key, "left_anti")


def check_one_place(df: DataFrame, key: str, place: str) -> DataFrame:
    """Keys that lie in more than one place."""
    return df.groupBy(key).agg(F.count_distinct(place).alias("places"), F.array_join(F.array_sort(F.collect_set(F.col(place).cast("string"))), ",").alias("which")).where("places > 1")


def check_roundtrip(sent: DataFrame, returned: DataFrame, key: list[str], value: str, allowed: list, hash_: str) -> DataFrame:
    """Keys that a returned batch misses, adds, repeats, gives a value that is not allowed, or sends with another hash."""
    r = returned.groupBy(*key).agg(F.count("*").alias("_n"), F.min(value).alias("_v"), F.min(hash_).alias("_h"))
    rows = sent.select(*key, F.col(hash_).alias("_sent")).join(r, key, "full_outer")
    problem = F.when(F.col("_n").isNull(), "not returned").when(F.col("_sent").isNull(), "not sent").when(F.col("_n") > 1, "repeated").when(~F.coalesce(F.col("_v").isin(*allowed), F.lit(False)), "value not allowed").when(F.col("_h") != F.col("_sent"), "source changed")
    return rows.select(*key, problem.alias("problem")).where("problem is not null")


def check_approved_plan(plan: DataFrame, *, id_col: str, kind: str, expected_rows: int, fields: list[str], field_col: str = "field", status_col: str = "status", status: str = "approved", kind_col: str = "kind") -> DataFrame:
    """Problems of an approved plan in long form: kind, status, number of rows, repeated (id, field), fields not allowed."""
    rows = plan.select(F.col(id_col).cast("string").alias("key"), F.explode(F.array_compact(F.array(F.when(F.col(kind_col) != kind, "kind"), F.when(F.col(status_col) != status, "status"), F.when(~F.col(field_col).isin(*fields), "field not allowed")))).alias("problem"))
    twice = plan.groupBy(id_col, field_col).agg(F.count("*").alias("_n")).where("_n > 1").select(F.col(id_col).cast("string").alias("key"), F.lit("repeated").alias("problem"))
    size = plan.agg(F.count("*").alias("_n")).where(F.col("_n") != expected_rows).select(F.col("_n").cast("string").alias("key"), F.lit("number of rows").alias("problem"))
    return rows.unionByName(twice).unionByName(size)


def audit_scan(df: DataFrame, checks: dict[str, tuple[Column, int]]) -> DataFrame:
    """audit of checks on the rows of one table, in one scan: each is the condition that speaks against a row, and the number
    expected. Conditions that are null do not hold.
    """
    counts = df.agg(*[F.count_if(F.coalesce(test, F.lit(False))).alias(f"_{i}") for i, (test, _) in enumerate(checks.values())])
    rows = F.array(*[F.struct(F.lit(name).alias("check"), F.lit(expected).cast("long").alias("expected"), F.col(f"_{i}").alias("actual")) for i, (name, (_, expected)) in enumerate(checks.items())])
    return counts.select(F.inline(rows)).withColumn("status", F.when(F.col("expected") == F.col("actual"), "ok").otherwise("blocked"))


def observed(df: DataFrame, checks: dict[str, tuple[Column, int]]) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """df with the checks riding on it, and a function that gives the audit once an action over that df has run: no scan of
    their own. (The function waits for the action.)
    """
    watch = Observation()
    out = df.observe(watch, *[F.count_if(F.coalesce(test, F.lit(False))).alias(name) for name, (test, _) in checks.items()])

    def result() -> DataFrame:
        got = watch.get
        rows = [(name, expected, got[name], "ok" if got[name] == expected else "blocked") for name, (_, expected) in checks.items()]
        return df.sparkSession.createDataFrame(rows, "check string, expected long, actual long, status string")

    return out, result
