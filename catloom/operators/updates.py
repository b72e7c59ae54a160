"""Update planning and merging (U1-U9), and upserts (K7, K8). Patches are long: record_id, field, current, proposed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catloom.functions.years import safe_year_extension
from catloom.operators import ranges
from catloom.operators.shape import last_of


def build_plan(found: DataFrame, catalogue: DataFrame, item: str, not_found: str) -> tuple[DataFrame, DataFrame]:
    """Patches from the findings of matched records, and creations: items not found that the catalogue has."""
    patches = found.where((F.col("type") != not_found) & F.col("record_id").isNotNull()).select("record_id", "field", F.col("value").alias("current"), F.col("missing_value").alias("proposed"))
    missing = found.where(F.col("type") == not_found).select(item).distinct()
    return patches, catalogue.join(missing, item, "left_semi")


def consolidate(patches: DataFrame) -> DataFrame:
    """One row per record and field: the proposal, or a conflict with the sorted proposals. Blank record ids never meet."""
    named = patches.where(F.trim(F.coalesce(F.col("record_id").cast("string"), F.lit(""))) != "")
    rows = named.groupBy("record_id", "field").agg(F.min("current").alias("current"), F.array_sort(F.collect_set("proposed")).alias("_all"))
    one = F.size("_all") == 1
    return rows.select("record_id", "field", "current", F.when(one, F.element_at("_all", 1)).alias("proposed"), F.when(~one, F.array_join("_all", " | ")).alias("conflict"))


def restrict(patches: DataFrame, *, fields: list[str] | None = None, only_for: dict[str, list[str]] | None = None, group: str = "country", known: dict[str, DataFrame] | None = None, safe_years: str | None = None) -> DataFrame:
    """Patches of chosen fields; a field only in chosen groups; a field only with texts its group already has (group,
    proposed); years only as safe extensions.
    """
    out = patches if fields is None else patches.where(F.col("field").isin(*fields))
    for field, groups in (only_for or {}).items():
        out = out.where((F.col("field") != field) | F.col(group).isin(*groups))
    for field, texts in (known or {}).items():
        ok = texts.select(group, "proposed").distinct().withColumn("_ok", F.lit(True))
        out = out.join(ok, [group, "proposed"], "left").where((F.col("field") != field) | F.col("_ok")).drop("_ok")
    if safe_years:
        out = out.where((F.col("field") != safe_years) | safe_year_extension(F.col("current"), F.col("proposed")))
    return out


def coverage_state(records: DataFrame, by: str, col: str) -> DataFrame:
    """Per group: rows, filled rows, and none, partial or complete."""
    filled = F.trim(F.coalesce(F.col(col).cast("string"), F.lit(""))) != ""
    rows = records.groupBy(by).agg(F.count("*").alias("rows"), F.count_if(filled).alias("filled"))
    return rows.withColumn("state", F.when(F.col("filled") == 0, "none").when(F.col("filled") == F.col("rows"), "complete").otherwise("partial"))


def apply_optimistic(plan: DataFrame, current: DataFrame) -> DataFrame:
    """Status of each patch against current values (record_id, field, stored): applied, already_correct or not_applied."""
    rows = plan.join(current.select("record_id", "field", "stored", F.lit(True).alias("_has")), ["record_id", "field"], "left")
    status = F.when(F.col("_has").isNull(), "not_applied").when(F.col("stored").eqNullSafe(F.col("proposed")), "already_correct").when(F.col("stored").eqNullSafe(F.col("current")), "applied").otherwise("not_applied")
    return rows.withColumn("status", status).drop("_has")


def apply_status(memory: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """memory (key, fields requested) with the outcome: applied if every requested field was applied or already right."""
    good = results.where(F.col("status").isin("applied", "already_correct")).groupBy(key).agg(F.collect_set("field").alias("_done"))
    rows = memory.join(good, key, "left")
    full = F.size(F.array_except("fields", F.coalesce("_done", F.array().cast("array<string>")))) == 0
    return rows.withColumn("outcome", F.when(F.col("_done").isNull(), "open").when(full, "applied").otherwise("partial")).drop("_done")


def source_replacements(found: DataFrame, link_map: DataFrame, official: Column, keep: list[str]) -> DataFrame:
    """Distinct replacements of values that are not official by ones that are, with the map rows that each hits."""
    own = found.where(official & (F.col("value") != F.col("missing_value"))).select(*keep, F.col("value").alias("current"), F.col("missing_value").alias("proposed")).distinct()
    hits = link_map.groupBy(F.col("url").alias("current")).agg(F.count("*").alias("hits"))
    return own.join(hits, "current", "left").withColumn("hits", F.coalesce("hits", F.lit(0))).withColumn("usable", F.col("hits") == 1)


def review_merge(current: DataFrame, previous: DataFrame, key: list[str], status: str, pending: str = "pending", *, order: list[str] = ()) -> DataFrame:
    """current with the decisions that previous has on the same keys, the last of a key by order; others are pending."""
    old = last_of(previous.where(F.col(status) != pending), key, order).select(*key, F.col(status).alias("_old"))
    return current.join(old, key, "left").withColumn(status, F.coalesce("_old", F.lit(pending))).drop("_old")


def review_summary(items: DataFrame, by: str, status: str, pending: str = "pending") -> DataFrame:
    rows = items.groupBy(by).agg(F.count("*").alias("items"), F.count_if(F.col(status) == pending).alias("pending"))
    return rows.withColumn("ready", F.col("pending") == 0)


def plan_summary(plan: DataFrame, by: str, status: str) -> DataFrame:
    return plan.groupBy(by, status).agg(F.count("*").alias("rows"))


def assign_batches(rows: DataFrame, n: int, order: list[str], by: list[str]) -> DataFrame:
    """batch 0, 1, ... of n rows each in order, within each group of by; a group may be any size."""
    return ranges.numbered(rows, by, order, "batch").withColumn("batch", F.floor((F.col("batch") - 1) / n))


def upsert(target: DataFrame, patches: DataFrame, key: list[str], *, order: list[str] = (), insert: bool = True) -> DataFrame:
    """target with the non-null fields of patches written over it, and (insert) the rows whose key it lacks.

    Of several patches of a key the last by order counts.
    """
    patches = last_of(patches, key, order)
    cols = [c for c in patches.columns if c not in key]
    rows = target.join(patches.select(*key, *[F.col(c).alias(f"_p_{c}") for c in cols]), key, "left")
    out = rows.withColumns({c: F.coalesce(f"_p_{c}", c) for c in cols}).select(*target.columns)
    return out.unionByName(patches.join(target.select(*key), key, "left_anti"), allowMissingColumns=True) if insert else out


def replace_by_key(target: DataFrame, rows: DataFrame, key: list[str]) -> DataFrame:
    """target's rows of the keys in rows give way to rows."""
    return target.join(rows.select(*key).distinct(), key, "left_anti").unionByName(rows)


def delete_keys(target: DataFrame, keys: DataFrame, key: list[str]) -> DataFrame:
    return target.join(keys.select(*key).distinct(), key, "left_anti")
