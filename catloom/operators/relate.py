"""Joins and relations (J1-J13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def attach_children(parents: DataFrame, children: DataFrame, parent_key: list[str], child_key: list[str], fields: list[str], name: str) -> DataFrame:
    """parents with an ordered array of their children; keys include the parent's kind, so that ids of two kinds never meet."""
    own = children.groupBy(*[F.col(c).alias(p) for c, p in zip(child_key, parent_key, strict=True)]).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))
    kind = f"array<{children.select(F.struct(*fields).alias('x')).schema['x'].dataType.simpleString()}>"
    return parents.join(own, parent_key, "left").withColumn(name, F.coalesce(name, F.array().cast(kind)))


def resolve_dual_fk(children: DataFrame, first: tuple[str, DataFrame, str], second: tuple[str, DataFrame, str]) -> DataFrame:
    """Two foreign keys: target, and the reason where there is none (they disagree, or neither is found).

    first and second: column, parents, and the parents' key column.
    """
    out = children
    for n, (col, parents, key) in (("_a", first), ("_b", second)):
        own = parents.select(F.col(key).alias(n)).distinct()
        out = out.join(own, out[col] == own[n], "left")
    clash = F.col("_a") != F.col("_b")
    reason = F.when(clash, "targets disagree").when(F.col("_a").isNull() & F.col("_b").isNull(), "no target")
    return out.withColumn("target", F.when(~F.coalesce(clash, F.lit(False)), F.coalesce("_a", "_b"))).withColumn("reason", reason).drop("_a", "_b")


def orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str, reason: str) -> DataFrame:
    return children.join(parents.select(F.col(parent_key).alias(child_key)).distinct(), child_key, "left_anti").withColumn("reason", F.lit(reason))


def classify_import(rows: DataFrame, existing: DataFrame, key: list[str], order: str) -> DataFrame:
    """Status of each row: missing_key, duplicate_input, multiple_existing, exists or to_create."""
    blank = F.lit(False)
    for k in key:
        blank = blank | (F.coalesce(F.trim(F.col(k).cast("string")), F.lit("")) == "")
    counts = existing.groupBy(*key).agg(F.count("*").alias("_there"))
    deal = F.when(blank, F.xxhash64(order))  # rows without a key are no group
    numbered = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*key, deal).orderBy(order)))
    status = F.when(blank, "missing_key").when(F.col("_n") > 1, "duplicate_input").when(F.col("_there") > 1, "multiple_existing").when(F.col("_there") == 1, "exists").otherwise("to_create")
    return numbered.join(counts, key, "left").withColumn("status", status).drop("_n", "_there")


def partition_missing(new: DataFrame, existing: DataFrame, strong: str, fallback: str) -> DataFrame:
    """found: by the strong key; else by the fallback, where either side lacks the strong key."""
    strongs = existing.where(F.col(strong).isNotNull()).select(strong).distinct().withColumn("_s", F.lit(True))
    weak = existing.groupBy(fallback).agg(F.bool_or(F.col(strong).isNull()).alias("_w"))
    rows = new.join(strongs, strong, "left").join(weak, fallback, "left")
    by_weak = F.when(F.col(strong).isNull(), F.col("_w").isNotNull()).otherwise(F.coalesce("_w", F.lit(False)))
    return rows.withColumn("found", F.coalesce("_s", F.lit(False)) | by_weak).drop("_s", "_w")


def identity_key(strategies: list[tuple[str, Column]]) -> Column:
    """The first identity that applies, with the name of its strategy in front."""
    return F.coalesce(*[F.when(F.trim(c.cast("string")) != "", F.concat(F.lit(f"{n}:"), c.cast("string"))) for n, c in strategies])


def exactly_one(specs: DataFrame, records: DataFrame, key: list[str], record_id: str) -> DataFrame:
    """Each spec with its record; matches other than one are violations."""
    own = records.groupBy(*key).agg(F.count("*").alias("matches"), F.min(record_id).alias("record_id"))
    rows = specs.join(own, key, "left").withColumn("matches", F.coalesce("matches", F.lit(0)))
    return rows.withColumn("record_id", F.when(F.col("matches") == 1, F.col("record_id"))).withColumn("violation", F.col("matches") != 1)


def untracked(records: DataFrame, specs: DataFrame, key: list[str], by: str) -> DataFrame:
    """Per group: records that no spec names."""
    return records.join(specs.select(*key).distinct(), key, "left_anti").groupBy(by).agg(F.count("*").alias("untracked"))


def reverse_map(internal: DataFrame, external: DataFrame) -> DataFrame:
    """url to slug, side and external url, from two link maps (pos, slug, side, url).

    Internal urls: the last one counts; external urls, which stand for themselves: the first one.
    """
    pair = internal.join(external.select("slug", "side", F.col("url").alias("external"), F.col("pos").alias("_epos")), ["slug", "side"], "left")
    last = pair.withColumn("_n", F.row_number().over(Window.partitionBy("url").orderBy(F.desc("pos"), "_epos"))).where("_n = 1").select("url", "slug", "side", "external", F.lit(0).alias("_p"))
    first = external.withColumn("_n", F.row_number().over(Window.partitionBy("url").orderBy("pos"))).where("_n = 1").select("url", "slug", "side", F.col("url").alias("external"), F.lit(1).alias("_p"))
    both = last.unionByName(first)
    return both.withColumn("_n", F.row_number().over(Window.partitionBy("url").orderBy("_p"))).where("_n = 1").select("url", "slug", "side", "external")


def set_match(left: DataFrame, right: DataFrame, left_id: str, right_id: str, value: str) -> DataFrame:
    """Classes of ids whose non-empty sets of values are equal: side, id, n (values), class (the set), and how many ids of
    either side are in it. A class that has ids of both sides is a match; pairs are not written out.
    """
    sets = lambda df, i, n: df.where(F.col(value).isNotNull()).groupBy(F.col(i).alias(n)).agg(F.array_sort(F.collect_set(value)).alias("values"))
    rows = sets(left, left_id, "id").withColumn("side", F.lit("left")).unionByName(sets(right, right_id, "id").withColumn("side", F.lit("right")))
    sizes = rows.groupBy("values").agg(F.count_if(F.col("side") == "left").alias("lefts"), F.count_if(F.col("side") == "right").alias("rights"))
    return rows.join(sizes, "values").select("side", "id", F.size("values").alias("n"), F.array_join(F.transform("values", lambda v: v.cast("string")), "|").alias("class"), "lefts", "rights")


def lookup_by_two_keys(rows: DataFrame, by_id: DataFrame, by_url: DataFrame, id_key: str, url_key: str) -> DataFrame:
    """Owners by id and by url (columns key, owner) must agree: owner, and the status matched, conflict or missing."""
    a, b = by_id.select(F.col("key").alias(id_key), F.col("owner").alias("_a")), by_url.select(F.col("key").alias(url_key), F.col("owner").alias("_b"))
    out = rows.join(a, id_key, "left").join(b, url_key, "left")
    clash = F.coalesce(F.col("_a") != F.col("_b"), F.lit(False))
    owner = F.coalesce("_a", "_b")
    return out.withColumn("status", F.when(clash, "conflict").when(owner.isNull(), "missing").otherwise("matched")).withColumn("owner", F.when(~clash, owner)).drop("_a", "_b")


def relink(children: DataFrame, key_map: DataFrame, key: str, patch: dict[str, Column]) -> DataFrame:
    """Children with their parent's key replaced through key_map (old, new) and the fields in patch set; others untouched."""
    rows = children.join(key_map.select(F.col("old").alias(key), F.col("new").alias("_new")), key, "left")
    moved = F.col("_new").isNotNull()
    return rows.withColumn("relinked", moved).withColumns({**{c: F.when(moved, v).otherwise(F.col(c)) for c, v in patch.items()}, key: F.coalesce("_new", key)}).drop("_new")


def image_link_match(records: DataFrame, catalogue: DataFrame, image: str, overrides: DataFrame) -> DataFrame:
    """Catalogue item of each record: by the override table (record_id, item_id), else by image if exactly one item has it."""
    own = catalogue.groupBy(image).agg(F.count("*").alias("_n"), F.min("item_id").alias("_i"))
    rows = records.join(overrides.select("record_id", F.col("item_id").alias("_o")), "record_id", "left").join(own, image, "left")
    item = F.coalesce("_o", F.when(F.col("_n") == 1, F.col("_i")))
    rows = rows.withColumn("item_id", item).withColumn("ambiguous", F.coalesce((F.col("_n") > 1) & F.col("_o").isNull(), F.lit(False))).drop("_n", "_i", "_o")
    # one record each: an item that two records claim is no match for either
    claims = rows.where("item_id is not null").groupBy("item_id").agg((F.count("*") > 1).alias("contested"))
    return rows.join(claims, "item_id", "left").select(*rows.columns, F.coalesce("contested", F.lit(False)).alias("contested"))
