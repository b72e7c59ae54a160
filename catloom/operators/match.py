"""Entity resolution (M1-M8)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catloom.functions.records import difflib_ratio
from catloom.functions.text import amount_variants, contains_sequence, fold_keep_accents, key_tokens, normalize_key
from catloom.functions.urls import detail_stem
from catloom.sources.shared import stored


def match_cascade(items: DataFrame, records: DataFrame, stages: list[tuple[str, Column, Column]], *, item_id: str = "item_id", record_id: str = "record_id", unique: tuple[str, ...] = ()) -> DataFrame:
    """Item to record by the first stage that matches. A stage: name, the items' key, the records' key.

    Stages named in unique need exactly one record; others take the least record_id and say how many there were. Each stage is
    one left join; rows that repeat an item_id are matched each by itself.
    """
    rows, kind = items, records.schema[record_id].dataType.simpleString()
    for i, (name, a, b) in enumerate(stages):
        own = records.select(b.alias(f"_k{i}"), F.col(record_id).alias("_r")).where(f"_k{i} is not null").groupBy(f"_k{i}").agg(F.min("_r").alias("record_id"), F.count("*").alias("candidates"))
        if name in unique:
            own = own.where("candidates = 1")
        rows = rows.join(own.select(f"_k{i}", F.struct("record_id", "candidates", F.lit(name).alias("stage")).alias(f"_m{i}")), a == F.col(f"_k{i}"), "left")
    none = F.struct(F.lit(None).cast(kind).alias("record_id"), F.lit(0).cast("long").alias("candidates"), F.lit("not_found").alias("stage"))
    return rows.select(F.col(item_id).alias("item_id"), F.coalesce(*[f"_m{i}" for i in range(len(stages))], none).alias("m")).select("item_id", "m.*")


def disambiguate(candidates: DataFrame, item: str, agrees: Column) -> DataFrame:
    """Candidates of an item: a single one stays; of several, the one that agrees if it is the only one, else none."""
    w = Window.partitionBy(item)
    rows = candidates.withColumn("_ok", F.coalesce(agrees, F.lit(False))).withColumn("_n", F.count("*").over(w)).withColumn("_m", F.count_if(F.col("_ok")).over(w))
    return rows.where("_n = 1 or (_m = 1 and _ok)").drop("_ok", "_n", "_m")


def name_years_agree(name_a: Column, years_a: Column, name_b: Column, years_b: Column) -> Column:
    return (normalize_key(name_a) == normalize_key(name_b)) & (normalize_key(years_a) == normalize_key(years_b))


def same_visible_name(a: Column, b: Column) -> Column:
    return fold_keep_accents(a) == fold_keep_accents(b)


def url_identity_mismatch(url: Column, name: Column, years: Column, host: str, units: list[str]) -> Column:
    """Parts of an item's identity that its url contradicts: host (a pattern), name (amount and first unit), years."""
    tokens = key_tokens(detail_stem(url))
    amounts = amount_variants(name)
    unit = F.try_element_at(F.array_intersect(key_tokens(name), F.array(*map(F.lit, units))), F.lit(1))
    named = (F.size(amounts) == 0) | (F.exists(amounts, lambda v: contains_sequence(tokens, v)) & (unit.isNull() | F.array_contains(tokens, unit)))
    host_ok = F.coalesce(F.lower(F.try_parse_url(url, F.lit("HOST"))).rlike(host), F.lit(False))
    return F.array_compact(F.array(F.when(~host_ok, "host"), F.when(~named, "name"), F.when(~contains_sequence(tokens, key_tokens(years)), "years")))


def score(amount_a: Column, amount_b: Column, name_a: Column, name_b: Column, years_a: Column, years_b: Column, *, ratio: Column | None = None) -> Column:
    """0 where amounts differ or names are too unlike; else 5 for equal names or three times their ratio, and 5 for equal
    years or 2.5 for years that hold one another. ratio: similarity in 0..1, by default difflib's (argument order counts).
    """
    blank = (name_a == "") | (name_b == "")
    equal = name_a == name_b
    like = F.when(blank, 0.0).otherwise(difflib_ratio(name_a, name_b) if ratio is None else ratio)
    both = (years_a != "") & (years_b != "")
    year = F.when(both & (years_a == years_b), 5.0).when(both & (F.contains(years_a, years_b) | F.contains(years_b, years_a)), 2.5).otherwise(0.0)
    amounts = F.coalesce((amount_a != amount_b) & (amount_a != "") & (amount_b != ""), F.lit(False))
    return F.when(amounts, 0.0).when(~equal & (like < 0.7), 0.0).otherwise(F.when(equal & ~blank, 5.0).otherwise(3 * like) + year)


def levenshtein_ratio(a: Column, b: Column) -> Column:
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))


def top_of_classes(items: DataFrame, records: DataFrame, k: int, pairs: Callable[[DataFrame, DataFrame], DataFrame], points: Column, *, item_id: str, record_id: str) -> DataFrame:
    """item_id, record_id, points, rank of the k best records with points above 0 for each item. Ties go to the smaller record_id.

    Rows that differ in their id alone have the same points and make one class. Classes of items are scored against classes of
    records, of which only the k smallest ids can be among the best, so the pairs grow with the classes and not with their rows.
    pairs: of items (columns i_<column>) and records (r_<column>), without ids, the candidates; points may use these columns.
    """
    ci, cr = [c for c in items.columns if c != item_id], [c for c in records.columns if c != record_id]
    i = items.select(*[F.col(c).alias(f"i_{c}") for c in ci]).groupBy(*[f"i_{c}" for c in ci]).agg(F.lit(1).alias("_one")).drop("_one")
    own = Window.partitionBy(*[f"r_{c}" for c in cr]).orderBy("_r")
    r = records.select(F.col(record_id).alias("_r"), *[F.col(c).alias(f"r_{c}") for c in cr]).withColumn("_n", F.row_number().over(own)).where(F.col("_n") <= k)
    r = stored(r.groupBy(*[f"r_{c}" for c in cr]).agg(F.sort_array(F.collect_list("_r")).alias("_ids"), F.count(F.when(F.col("_r").isNull(), 1)).alias("_nulls")), "record-classes")
    rows = pairs(i, r).withColumn("points", points).where("points > 0")
    # the classes' best by their first ids, then these classes' ids: a class has one place at least before any that it goes after
    best = Window.partitionBy(*[f"i_{c}" for c in ci]).orderBy(F.desc("points"), "_first")
    rows = rows.withColumn("_first", F.when(F.col("_nulls") == 0, F.get("_ids", F.lit(0)))).withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k)
    ids = F.concat(F.array_repeat(F.lit(None).cast(records.schema[record_id].dataType), F.col("_nulls").cast("int")), "_ids")
    tops = rows.select(*[f"i_{c}" for c in ci], "points", F.explode(ids).alias("_r"))
    tops = tops.withColumn("_n", F.row_number().over(Window.partitionBy(*[f"i_{c}" for c in ci]).orderBy(F.desc("points"), "_r"))).where(F.col("_n") <= k).drop("_n")
    tops = stored(tops, "class-tops")
    same = reduce(lambda x, y: x & y, [items[c].eqNullSafe(tops[f"i_{c}"]) for c in ci])
    each = Window.partitionBy("item_id").orderBy(F.desc("points"), "record_id")  # rows may repeat an item_id
    out = items.join(tops, same).select(items[item_id].alias("item_id"), F.col("_r").alias("record_id"), "points")
    return out.withColumn("rank", F.row_number().over(each)).where(F.col("rank") <= k)


def top_candidates(items: DataFrame, records: DataFrame, block: list[str], amount: str, points: Column, k: int, *, item_id: str = "item_id", record_id: str = "record_id") -> DataFrame:
    """The k best records with points above 0 for each item. Candidates share the block and the amount, or lack an amount.

    points may use i_<column> and r_<column>, but not the ids. Ties go to the smaller record_id. Give only columns that block,
    amount and points use: rows that are equal in them are scored once.
    """

    def pairs(i: DataFrame, r: DataFrame) -> DataFrame:
        same = [i[f"i_{b}"] == r[f"r_{b}"] for b in block]
        blank_i, blank_r = F.coalesce(i[f"i_{amount}"], F.lit("")) == "", F.coalesce(r[f"r_{amount}"], F.lit("")) == ""
        equal = F.coalesce(i[f"i_{amount}"], F.lit("")) == F.coalesce(r[f"r_{amount}"], F.lit(""))  # both may lack it
        return i.join(r, [*same, equal]).unionByName(i.where(blank_i).join(r.where(~blank_r), same)).unionByName(i.where(~blank_i).join(r.where(blank_r), same))

    return top_of_classes(items, records, k, pairs, points, item_id=item_id, record_id=record_id)


def resolve_missing(items: DataFrame, associations: DataFrame, found: DataFrame, direct: DataFrame, owners: DataFrame) -> DataFrame:
    """Record for each missing item (item_id), by stage: association and direct url need that no other item owns the
    record; what was found before does not; else unresolved. All tables: item_id, record_id.
    """
    owned = owners.groupBy("record_id").agg(F.collect_set("item_id").alias("_owners"))

    def sole(df: DataFrame) -> DataFrame:
        free = F.col("_owners").isNull() | (F.size(F.array_except("_owners", F.array("item_id"))) == 0)
        return df.join(owned, "record_id", "left").where(free).drop("_owners")

    out, left = None, items.select("item_id").distinct()
    for name, rows in (("association", sole(associations)), ("found_before", found), ("direct_url", sole(direct))):
        one = rows.groupBy("item_id").agg(F.min("record_id").alias("record_id"), F.count_distinct("record_id").alias("_n")).where("_n = 1").drop("_n")
        hit = left.join(one, "item_id").withColumn("stage", F.lit(name))
        out = hit if out is None else out.unionByName(hit)
        left = left.join(one.select("item_id"), "item_id", "left_anti")
    return out.unionByName(left.select("item_id", F.lit(None).cast(direct.schema["record_id"].dataType).alias("record_id"), F.lit("unresolved").alias("stage")))


def confirm_equivalence(updates: DataFrame, flagged: DataFrame, memory: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Updates (item_id, record_id) of flagged items go through only if memory holds the pair; the rest is blocked."""
    risky = updates.join(flagged.select("item_id").distinct(), "item_id", "left_semi")
    pair = ["item_id", "record_id"]
    blocked = risky.join(memory.select(*pair).distinct(), pair, "left_anti")
    return updates.join(blocked.select(*pair).distinct(), pair, "left_anti"), blocked


def unique_best(pairs: DataFrame, item: str, points: str) -> DataFrame:
    """The best pair of each item, if no other has as many points; null points never count."""
    w = Window.partitionBy(item)
    rows = pairs.where(F.col(points).isNotNull()).withColumn("_best", F.max(points).over(w)).where(F.col(points) == F.col("_best"))
    return rows.withColumn("_n", F.count("*").over(w)).where("_n = 1").drop("_best", "_n")
