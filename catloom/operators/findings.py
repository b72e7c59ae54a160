"""Findings, differences and reconciliation (D1-D15)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def findings(rows: DataFrame, keep: list[str], rules: list[tuple[str, str, Column, Column | None, Column | None]]) -> DataFrame:
    """A row for each rule that holds. A rule: type, field, condition, value found, value missing."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit("")) if c is not None else F.lit("")
    hits = F.array_compact(F.array(*[F.when(test, F.struct(F.lit(t).alias("type"), F.lit(f).alias("field"), text(v).alias("value"), text(m).alias("missing_value"))) for t, f, test, v, m in rules]))
    return rows.select(*keep, F.inline(hits))


def unmatched_findings(records: DataFrame, matched: DataFrame, key: str, keep: list[str], rules: list) -> DataFrame:
    """Findings of the records that nothing matched."""
    return findings(records.join(matched.select(key).distinct(), key, "left_anti"), keep, rules)


def summarise(found: DataFrame, item: list[str]) -> DataFrame:
    """Per type: findings, and items that have it."""
    return found.groupBy("type").agg(F.count("*").alias("findings"), F.count_distinct(F.struct(*item)).alias("items"))


def labels_per_item(found: DataFrame, item: list[str]) -> DataFrame:
    return found.groupBy(*item).agg(F.array_join(F.array_sort(F.collect_set("type")), ",").alias("labels"), F.count("*").alias("findings"))


def missing_sides(found: DataFrame, item: list[str], sides: dict[str, str]) -> DataFrame:
    """Per item, which sides lack an image (fields by side) and whether all do."""
    side = F.coalesce(*[F.when(F.col("field") == f, s) for f, s in sides.items()])
    rows = found.withColumn("side", side).where("side is not null").groupBy(*item).agg(F.array_join(F.array_sort(F.collect_set("side")), ",").alias("sides"), F.count_distinct("side").alias("_n"))
    return rows.withColumn("all_sides", F.col("_n") == len(sides)).drop("_n")


def detail_rows(found: DataFrame, kind: str, order: list[str], most: int) -> DataFrame:
    """The first rows of a type in order, and one more row that tells how many are left out."""
    own = found.where(F.col("type") == kind)
    first = own.orderBy(*order).limit(most).select(*order, F.lit(None).cast("long").alias("more"))
    rest = own.agg((F.count("*") - most).alias("more")).where("more > 0")
    return first.unionByName(rest.select(*[F.lit(None).cast(own.schema[c].dataType).alias(c) for c in order], "more"))


def changed_fields(cols: list[str], a: str = "a", b: str = "b") -> Column:
    return F.array_compact(F.array(*[F.when(~F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")), F.lit(c)) for c in cols]))


def snapshot_diff(before: DataFrame, after: DataFrame, key: list[str], cols: list[str]) -> DataFrame:
    """Per key: created, deleted, modified or unchanged, with the changed fields and both rows."""
    side = lambda df, n: df.select(*key, F.struct(*cols).alias(n))
    both = side(before, "before").join(side(after, "after"), key, "full_outer")
    names = changed_fields(cols, "before", "after")
    status = F.when(F.col("before").isNull(), "created").when(F.col("after").isNull(), "deleted").when(F.size(names) > 0, "modified").otherwise("unchanged")
    return both.withColumn("status", status).withColumn("changed", F.when(status == "modified", names).otherwise(F.array().cast("array<string>")))


def field_diff(expected: DataFrame, actual: DataFrame, key: list[str], cols: list[str], false_for_null: list[str] = ()) -> DataFrame:
    """A row for each field that differs, over the keys that are expected (a missing row is null throughout)."""
    own = lambda df, c: (F.coalesce(df[c], F.lit(False)) if c in false_for_null else df[c]).cast("string")
    e = expected.select(*key, *[own(expected, c).alias(f"e_{c}") for c in cols])
    a = actual.select(*key, *[own(actual, c).alias(f"a_{c}") for c in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"e_{c}").alias("expected"), F.col(f"a_{c}").alias("actual")) for c in cols])
    return e.join(a, key, "left").select(*key, F.inline(F.filter(rows, lambda r: ~r["expected"].eqNullSafe(r["actual"]))))


def same_set(expected: DataFrame, actual: DataFrame, key: list[str], cols: list[str]) -> DataFrame:
    """What keeps two sets of rows from being the same: missing, unexpected and changed keys. No rows: they are."""
    rows = snapshot_diff(expected, actual, key, cols)
    kind = F.when(F.col("status") == "deleted", "missing").when(F.col("status") == "created", "unexpected").when(F.col("status") == "modified", "changed")
    return rows.select(*key, kind.alias("problem"), F.array_join("changed", ",").alias("fields")).where("problem is not null")


def reconcile(plan: DataFrame, live: DataFrame, key: list[str], cols: list[str], state: DataFrame) -> DataFrame:
    """Planned rows against live ones (with id) and the checkpoint (key, id): pending, existing or conflict with its reason."""
    counts = live.groupBy(*key).agg(F.count("*").alias("_n"), F.min(F.struct(*cols)).alias("live"), F.min("id").alias("_id"))
    rows = plan.select(*key, F.struct(*cols).alias("plan")).join(counts, key, "left").join(state.select(*key, F.col("id").alias("_done")), key, "left")
    reason = (
        F.when(F.col("_n") > 1, "several live rows")
        .when(F.col("_n").isNull() & F.col("_done").isNotNull(), "recorded but gone")
        .when((F.size(changed_fields(cols, "plan", "live")) > 0) & F.col("_n").isNotNull(), "payload differs")
        .when(F.col("_done") != F.col("_id"), "another id recorded")
    )
    status = F.when(reason.isNotNull(), "conflict").when(F.col("_n") == 1, "existing").otherwise("pending")
    return rows.select(*key, status.alias("status"), reason.alias("reason"))


def reconcile_three_state(plan: DataFrame, live: DataFrame, key: list[str], cols: list[str], fixed: list[str]) -> DataFrame:
    """Live rows equal to the target are complete, to the source pending, others conflict; fixed fields must not change.

    plan: key, source_<col> and target_<col> for cols, and fixed. live: key, cols and fixed.
    """
    rows = plan.join(live.select(*key, *[F.col(c).alias(f"_l_{c}") for c in [*cols, *fixed]]), key, "left").withColumn("_has", F.coalesce(*[F.col(f"_l_{c}").isNotNull() for c in [*cols, *fixed]]))
    same = lambda p: reduce(lambda a, c: a & F.col(f"{p}_{c}").eqNullSafe(F.col(f"_l_{c}")), cols, F.lit(True))
    steady = reduce(lambda a, c: a & F.col(c).eqNullSafe(F.col(f"_l_{c}")), fixed, F.lit(True))
    return rows.select(*key, F.when(~steady, "conflict").when(same("target"), "complete").when(same("source"), "pending").otherwise("conflict").alias("status"))


def children_gap(spec: DataFrame, live: DataFrame, parent: str, tag: str, order: str) -> DataFrame:
    """Per parent: tags expected, there, missing and unexpected, and how many need another order."""
    both = spec.select(parent, tag, F.col(order).alias("_e"), F.lit(True).alias("_s")).join(live.select(parent, tag, F.col(order).alias("_a"), F.lit(True).alias("_l")), [parent, tag], "full_outer")
    return both.groupBy(parent).agg(F.count("_s").alias("expected"), F.count("_l").alias("existing"), F.count_if(F.col("_l").isNull()).alias("missing"), F.count_if(F.col("_s").isNull()).alias("unexpected"), F.count_if(F.col("_e") != F.col("_a")).alias("order_updates"))


def order_gap(specs: DataFrame, live: DataFrame, key: str, order: str) -> DataFrame:
    rows = specs.select(key, F.col(order).alias("desired")).join(live.select(key, F.col(order).alias("stored")), key)
    return rows.withColumn("status", F.when(F.col("desired").eqNullSafe(F.col("stored")), "unchanged").otherwise("update"))


def type_gap(desired: DataFrame, existing: DataFrame, key: str, field: str) -> DataFrame:
    """missing, wrong or right, for each desired row."""
    rows = desired.select(key, F.col(field).alias("desired")).join(existing.select(key, F.col(field).alias("stored"), F.lit(True).alias("_l")), key, "left")
    return rows.withColumn("status", F.when(F.col("_l").isNull(), "missing").when(F.col("desired").eqNullSafe(F.col("stored")), "right").otherwise("wrong")).drop("_l")


def values_by_field(found: DataFrame, item: list[str], fields: list[str]) -> DataFrame:
    """Per item with findings in fields: maps of found and expected values."""
    rows = found.where(F.col("field").isin(*fields))
    entries = lambda c: F.map_from_entries(F.array_sort(F.collect_set(F.struct("field", c))))
    one = Window.partitionBy(*item, "field").orderBy("value", "missing_value")
    return rows.withColumn("_n", F.row_number().over(one)).where("_n = 1").groupBy(*item).agg(entries("value").alias("current"), entries("missing_value").alias("expected"))


def protected_unchanged(before: DataFrame, after: DataFrame, key: list[str], allowed: list[str]) -> DataFrame:
    """Differences outside the allowed fields, over the keys that were there before."""
    cols = [c for c in before.columns if c not in key and c not in allowed]
    return field_diff(before, after, key, cols)
