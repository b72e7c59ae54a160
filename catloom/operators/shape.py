"""Flatten, regroup, deduplicate and merge (G1-G14). Spark rows have no order: 'first' and 'last' always name a column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catloom.functions.text import blank_to_null, has_quantity, lit_map, variant_rank, variant_tag


def flatten(catalogue: DataFrame, groups: str, items: str, keep: list[str]) -> DataFrame:
    """A row for each item, with its group's other fields and both positions."""
    inner = next(f for f in catalogue.schema[groups].dataType.elementType.fields if f.name == items)
    rest = [f.name for f in catalogue.schema[groups].dataType.elementType.fields if f.name != items]
    rows = catalogue.select(*keep, F.posexplode(groups).alias("group_pos", "g"))
    rows = rows.select(*keep, "group_pos", *[F.col(f"g.{c}").alias(f"group_{c}") for c in rest], F.posexplode(f"g.{items}").alias("item_pos", "i"))
    return rows.select(*keep, "group_pos", *[f"group_{c}" for c in rest], "item_pos", *[F.col(f"i.{f.name}").alias(f.name) for f in inner.dataType.elementType.fields])


def regroup(rows: DataFrame, keep: list[str], group: list[str], fields: list[str]) -> DataFrame:
    """The inverse: per keep, an array of groups in order of group_pos, each with its items in order of item_pos."""
    item = F.struct("item_pos", *fields)
    inner = rows.groupBy(*keep, "group_pos", *group).agg(F.array_sort(F.collect_list(item)).alias("items"))
    items = F.transform("items", lambda x: F.struct(*[x[f].alias(f) for f in fields]))
    outer = inner.select(*keep, F.struct("group_pos", *group, items.alias("items")).alias("g"))
    groups = F.transform(F.array_sort(F.collect_list("g")), lambda g: F.struct(*[g[c].alias(c) for c in group], g["items"].alias("items")))
    return outer.groupBy(*keep).agg(groups.alias("groups"))


def flatten_item(items: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Nested fields (name: path) as columns."""
    return items.select(*[F.col(path).alias(name) for name, path in fields.items()])


def dedup_first(df: DataFrame, key: list[str], order: list[Column], blank: str = "keep") -> tuple[DataFrame, DataFrame]:
    """The first row of each key. Rows with a blank key: all kept, skipped, or violations, which is the second result."""
    empty = F.lit(False)
    for k in key:
        empty = empty | (F.trim(F.coalesce(F.col(k).cast("string"), F.lit(""))) == "")
    first = df.where(~empty).withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_n = 1").drop("_n")
    blanks = df.where(empty)
    return (first.unionByName(blanks) if blank == "keep" else first), (blanks if blank == "violation" else blanks.limit(0))


def dedup_strict(df: DataFrame, key: list[str], payload: list[str]) -> DataFrame:
    """Per key: rows, and whether their payloads agree (a row for each key; the first payload is the least)."""
    body = F.struct(*payload)
    return df.groupBy(*key).agg(F.count("*").alias("rows"), F.min(body).alias("payload"), (F.min(F.to_json(body, {"ignoreNullFields": "false"})) == F.max(F.to_json(body, {"ignoreNullFields": "false"}))).alias("agree"))


def dedup_merge(df: DataFrame, key: list[str], order: str, fields: list[str], *, guard: str | None = None) -> DataFrame:
    """Ordered fold of a key's rows. The base is the record that is strictly more complete than what was merged so far (a
    tie leaves the earlier), and the other fills its blanks, also inside structs, one level deep. A record whose guard
    differs from that of what was merged is left out. The fold depends on order, so it runs over the ordered rows of a key
    (few, by nature: pages that repeat an item); keys are spread over tasks.
    """
    nested = {f: [x.name for x in df.schema[f].dataType.fields] if df.schema[f].dataType.typeName() == "struct" else None for f in fields}
    has = lambda c: F.coalesce(c.cast("string"), F.lit("")) != ""
    leaves = lambda r: [r[f][x] for f in fields for x in nested[f] or ()] + [r[f] for f in fields if nested[f] is None]
    filled = lambda r: sum((F.when(has(c), 1).otherwise(0) for c in leaves(r)), F.lit(0))

    def fill(a: Column, b: Column) -> Column:
        def one(f: str) -> Column:
            if nested[f] is None:
                return F.when(has(a[f]), a[f]).otherwise(b[f])
            inner = F.struct(*[F.when(has(a[f][x]), a[f][x]).otherwise(b[f][x]).alias(x) for x in nested[f]])
            return F.when(a[f].isNull(), b[f]).when(b[f].isNull(), a[f]).otherwise(inner)

        return F.struct(*[one(f).alias(f) for f in fields])

    def step(acc: Column, r: Column) -> Column:
        out = F.when(filled(r) > filled(acc), fill(r, acc)).otherwise(fill(acc, r))
        return out if guard is None else F.when(has(acc[guard]) & has(r[guard]) & (acc[guard] != r[guard]), acc).otherwise(out)

    rows = df.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("_order"), *fields))).alias("rows"))
    plain = F.transform("rows", lambda r: F.struct(*[r[f].alias(f) for f in fields]))
    merged = F.reduce(F.slice(plain, 2, F.greatest(F.size(plain), F.lit(1))), F.element_at(plain, 1), step)
    return rows.select(*key, F.size("rows").alias("rows"), merged.alias("m")).select(*key, "rows", *[F.col(f"m.{f}").alias(f) for f in fields])


def merge_groups(df: DataFrame, key: list[str], order: str, first: list[str], union: str) -> DataFrame:
    """One row per group key: first non-blank of each field in order, and the union's values in order of appearance."""
    w = Window.partitionBy(*key, union)
    rows = df.withColumn("_seen", F.min(order).over(w))
    pick = [F.min_by(F.col(c), F.when(blank_to_null(F.col(c).cast("string")).isNotNull(), F.col(order))).alias(c) for c in first]
    return rows.groupBy(*key).agg(*pick, F.transform(F.array_sort(F.collect_set(F.struct("_seen", union))), lambda x: x[union]).alias(f"{union}s"))


def last_of(rows: DataFrame, key: list[str], order: list[str] = ()) -> DataFrame:
    """The last row of each key by order; rows that tie in it go by a hash of their columns, so that reruns agree."""
    columns = [F.col(f.name).cast("string") if "map<" in f.dataType.simpleString() else F.col(f.name) for f in rows.schema]  # maps have no hash
    w = Window.partitionBy(*key).orderBy(*[F.desc(c) for c in order], F.desc(F.xxhash64(*columns)))
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def merge_last_wins(old: DataFrame, new: DataFrame, key: list[str], *, order: list[str] = (), excluded: DataFrame | None = None, drop: Column | None = None) -> DataFrame:
    """old overlaid by new rows of the same key, without excluded keys and dropped states. order: which of several new rows is the last."""
    rows = old.withColumn("_gen", F.lit(0)).unionByName(new.withColumn("_gen", F.lit(1)), allowMissingColumns=True)
    rows = last_of(rows, key, ["_gen", *order]).drop("_gen")
    if excluded is not None:
        rows = rows.join(excluded.select(*key).distinct(), key, "left_anti")
    return rows if drop is None else rows.where(~F.coalesce(drop, F.lit(False)))


def union_prefer_existing(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    return a.unionByName(b.join(a.select(*key).distinct(), key, "left_anti"))


def copy_by_key(target: DataFrame, source: DataFrame, key: list[str], cols: list[str], *, order: list[str] = ()) -> DataFrame:
    """target with cols taken from source where it has the key, from the last row of the key by order."""
    own = last_of(source, key, order).select(*key, F.lit(True).alias("_has"), *[F.col(c).alias(f"_new_{c}") for c in cols])
    rows = target.join(own, key, "left")
    put = {c: F.when(F.col("_has"), F.col(f"_new_{c}")).otherwise(F.col(c) if c in target.columns else F.lit(None)) for c in cols}
    return rows.withColumns(put).drop("_has", *[f"_new_{c}" for c in cols])


def build_variants(rows: DataFrame, item: list[str], *, year: str, mark: str, unc: str, bu: str, proof: str, single_year: str, labels: dict[str, str] | None = None) -> DataFrame:
    """Per item: ordered tags with a quantity outside proof, tags that only proof has, and the status; one tag is none."""
    rows = rows.withColumn("tag", variant_tag(F.col(year), F.col(mark), F.col(single_year), labels))
    kind = F.when(has_quantity(F.col(unc)) | has_quantity(F.col(bu)), 1).when(has_quantity(F.col(proof)), 0)
    tags = rows.withColumn("_kind", kind).where("_kind is not null").groupBy(*item, "tag").agg(F.max("_kind").alias("kind"), F.min(F.struct(F.col(year).cast("int").alias("y"), variant_rank(F.col(mark)).alias("r"), F.coalesce(F.col(mark), F.lit("")).alias("m"))).alias("at"))
    pick = lambda k: F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.struct("at", "tag")))), lambda x: x["tag"])
    out = tags.groupBy(*item).agg(pick(1).alias("tags"), pick(0).alias("proof_only"))
    several = F.size("tags") >= 2
    variants = F.when(several, F.transform("tags", lambda t, i: F.struct(t.alias("tag"), i.alias("order")))).otherwise(F.array().cast("array<struct<tag:string,order:int>>"))
    return out.select(*item, variants.alias("variants"), "proof_only", F.when(several, "collected").otherwise("no_multiple_variants").alias("status"))


def build_record(items: DataFrame, mapping: dict[str, Column], *, rank_by: str, ranks: dict[str, str], order: str, fallback: str) -> DataFrame:
    """Store payload: mapped fields, the category's rank by table (null: not allowed), and the stored order or the fallback."""
    return items.select(*[c.alias(n) for n, c in mapping.items()], F.try_element_at(lit_map(ranks), F.col(rank_by)).alias("rarity"), F.coalesce(F.col(order), F.col(fallback)).alias("ordinal"))


def split_name(c: Column, prefixes: dict[str, str], sep: str = " - ") -> Column:
    """'Prefix - subject': mapped prefix (null: unknown) and subject."""
    return F.struct(F.try_element_at(lit_map(prefixes), F.split_part(c, F.lit(sep), F.lit(1))).alias("prefix"), F.when(F.instr(c, sep) > 0, F.substr(c, F.instr(c, sep) + len(sep))).alias("subject"))


def repair_field(items: DataFrame, field: str, rule: Column, value: Column) -> DataFrame:
    """field set to value where the rule proves it, with a flag that it changed."""
    changes = F.coalesce(rule, F.lit(False)) & ~F.col(field).eqNullSafe(value)
    return items.withColumn("repaired", changes).withColumn(field, F.when(F.col("repaired"), value).otherwise(F.col(field)))
