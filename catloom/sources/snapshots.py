"""Snapshots of several entities behind a pointer (S6, K2).

A snapshot is a folder below the root: ``<name>/entities/<entity>/`` with the rows, and ``<name>/manifest/``, written when all
rows are there: for each entity its rows, bytes and a checksum that does not depend on order, a row of totals, and for each
relation how many children and parents there are, children without a parent and parents without children. The pointer is
written last: ``LATEST/seq=<n>/``, one small file with a name for each snapshot that was finished. Readers follow the newest
pointer and refuse one that is blank, leads outside the root, or names a folder without a manifest; a plain text file
``LATEST`` with a name in it is read as well.

Defined cases: a snapshot without rows of an entity has a manifest row with 0 for it; a root without a pointer has no
snapshot (None); a snapshot that died on the way has no manifest and no pointer, and changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catloom.sources.readers import list_files
from catloom.sources.writers import manifest

TOTALS = "*"
_MANIFEST = "kind string, name string, rows long, bytes long, checksum string, parents long, orphans long, childless long"


@dataclass(frozen=True)
class Relation:
    """Rows of child refer by child_key to those of parent by parent_key."""

    child: str
    child_key: str
    parent: str
    parent_key: str

    @property
    def name(self) -> str:
        return f"{self.child}.{self.child_key} -> {self.parent}.{self.parent_key}"


def pointer_problem(c: Column) -> Column:
    """Why a pointer's text names no folder of its root: null if it does."""
    name = F.trim(F.coalesce(c, F.lit("")))
    return F.when(name == "", "blank").when(name.isin(".", "..") | F.contains(name, F.lit("/")) | F.contains(name, F.lit("\\")) | name.rlike("[\\x00-\\x1F:]"), "outside the root")


def relation_summary(entities: dict[str, DataFrame], relation: Relation) -> DataFrame:
    """One row: children that have a key, parents, children whose parent is not there, parents without children."""
    children = entities[relation.child].groupBy(F.col(relation.child_key).cast("string").alias("k")).agg(F.count("*").alias("c")).where("k is not null")
    parents = entities[relation.parent].groupBy(F.col(relation.parent_key).cast("string").alias("k")).agg(F.count("*").alias("p")).where("k is not null")
    both = children.join(parents, "k", "full_outer")
    return both.agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(n) for x, n in ((F.col("c"), "rows"), (F.col("p"), "parents"), (F.when(F.col("p").isNull(), F.col("c")), "orphans"), (F.when(F.col("c").isNull(), F.col("p")), "childless"))])


def snapshot_manifest(entities: dict[str, DataFrame], relations: list[Relation] = ()) -> DataFrame:
    """kind (entity, totals or relation), name and figures: what a snapshot of these rows says of itself."""
    nothing = {c: F.lit(0).cast("long") for c in ("parents", "orphans", "childless")}
    cols = [x.split()[0] for x in _MANIFEST.split(", ")]
    found = []
    for name, df in entities.items():
        one = manifest(df.withColumn("_e", F.lit(name)), ["_e"]).select("rows", "bytes", "checksum")
        base = df.sparkSession.range(1).select(F.lit("entity").alias("kind"), F.lit(name).alias("name"))
        found.append(base.join(one, how="left").select("kind", "name", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"), F.coalesce("checksum", F.lit("")).alias("checksum")))
    rows = reduce(DataFrame.unionByName, found)
    totals = rows.agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "name", "checksum"))), "\n"), 256).alias("checksum"))  # a row for each entity
    out = rows.unionByName(totals.select(F.lit("totals").alias("kind"), F.lit(TOTALS).alias("name"), "rows", "bytes", "checksum")).withColumns(nothing).select(*cols)
    for r in relations:
        one = relation_summary(entities, r).select(F.lit("relation").alias("kind"), F.lit(r.name).alias("name"), F.col("rows").cast("long").alias("rows"), F.lit(0).cast("long").alias("bytes"), F.lit("").alias("checksum"), *[F.col(c).cast("long").alias(c) for c in nothing])
        out = out.unionByName(one)
    return out


def write_snapshot(spark: SparkSession, root: str, name: str, entities: dict[str, DataFrame], relations: list[Relation] = ()) -> str:
    """Write rows, then the manifest of what was written, then the pointer; returns the snapshot's folder."""
    if spark.range(1).select(pointer_problem(F.lit(name)).alias("p")).first()["p"] or name == "LATEST":
        raise ValueError(f"no name of a snapshot: {name!r}")
    folder = f"{root.rstrip('/')}/{name}"
    for entity, df in entities.items():
        df.write.mode("error").parquet(f"{folder}/entities/{entity}")
    there = {e: spark.read.schema(df.schema).parquet(f"{folder}/entities/{e}") for e, df in entities.items()}
    snapshot_manifest(there, relations).coalesce(1).write.mode("error").json(f"{folder}/manifest")
    point(spark, root, name)
    return folder


def _listed(spark: SparkSession, path: str, pattern: str) -> list[str] | None:
    """The files below a path, which may be a file itself; None where there is no such path."""
    from pyspark.errors import AnalysisException

    try:
        return [r["path"] for r in list_files(spark, path, pattern).select("path").collect()]
    except AnalysisException as gone:
        if gone.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def point(spark: SparkSession, root: str, name: str) -> None:
    """Let the root's newest pointer name a snapshot."""
    taken = [int(p.split("/seq=")[1].split("/")[0]) for p in _listed(spark, f"{root}/LATEST", "part-*") or () if "/seq=" in p]  # one for each snapshot
    spark.createDataFrame([(name,)], "value string").coalesce(1).write.mode("error").text(f"{root}/LATEST/seq={max(taken, default=-1) + 1}")


def resolve_pointer(spark: SparkSession, root: str) -> str | None:
    """The name that the newest pointer gives, None without one; raises ValueError where it names no finished snapshot of the root."""
    root = root.rstrip("/")
    files = _listed(spark, f"{root}/LATEST", "*")
    if files is None:
        return None
    seq = [int(p.split("/seq=")[1].split("/")[0]) for p in files if "/seq=" in p]
    text = spark.read.text(f"{root}/LATEST/seq={max(seq)}" if seq else f"{root}/LATEST", wholetext=True).agg(F.max("value").alias("value"))
    row = text.select(F.trim(F.regexp_replace("value", r"\s+$", "")).alias("name")).select("name", pointer_problem(F.col("name")).alias("problem")).first()
    if row["problem"]:
        raise ValueError(f"the pointer below {root} is {row['problem']}: {row['name']!r}")
    if not _listed(spark, f"{root}/{row['name']}/manifest", "part-*"):
        raise ValueError(f"{row['name']!r} is no finished snapshot below {root}")
    return row["name"]


def read_manifest(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(_MANIFEST).json(f"{root.rstrip('/')}/{name}/manifest")


def read_latest(spark: SparkSession, root: str, entity: str) -> DataFrame | None:
    """The rows of an entity in the snapshot that the pointer names."""
    name = resolve_pointer(spark, root)
    return None if name is None else spark.read.parquet(f"{root.rstrip('/')}/{name}/entities/{entity}")


def snapshot_verdicts(spark: SparkSession, root: str, name: str, relations: list[Relation] = ()) -> DataFrame:
    """kind, name and problem of each entity, relation and of the totals where the manifest and the rows that are there differ."""
    said = read_manifest(spark, root, name)
    entities = [r["name"] for r in said.where("kind = 'entity'").select("name").collect()]  # one for each entity
    is_there = {e: spark.read.parquet(f"{root.rstrip('/')}/{name}/entities/{e}") for e in entities if _listed(spark, f"{root.rstrip('/')}/{name}/entities/{e}", "part-*")}
    found = snapshot_manifest(is_there, [r for r in relations if r.child in is_there and r.parent in is_there])
    figures = ["rows", "bytes", "checksum", "parents", "orphans", "childless"]
    both = said.select("kind", "name", F.struct(*figures).alias("s")).join(found.select("kind", "name", F.struct(*figures).alias("f")), ["kind", "name"], "full_outer")
    problem = F.when(F.col("s").isNull(), "not in the manifest").when(F.col("f").isNull(), "nothing there")
    for c, text in zip(figures, ("number of rows", "bytes", "checksum", "parents", "orphans", "childless"), strict=True):
        problem = problem.when(~F.col(f"s.{c}").eqNullSafe(F.col(f"f.{c}")), text)
    checked = both.where((F.col("kind") != "relation") | F.col("name").isin([r.name for r in relations] or [""]))
    return checked.select("kind", "name", problem.alias("problem")).where("problem is not null")
