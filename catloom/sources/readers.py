"""Sources (S1-S9). Readers keep positions and paths, as array order is part of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catloom.sources import writers

ITEM = "denomination:string,value:double,unit:string,issuePeriod:string,startYear:int,endYear:int,availability:string,detailUrl:string,obverseImage:string,reverseImage:string,variants:array<struct<tag:string,order:int>>"
CATALOGUE = f"country string, catalogType string, periods array<struct<title:string,ruler:string,startYear:int,endYear:int,coins:array<struct<{ITEM}>>>>, _corrupt string"


def _path() -> Column:
    return F.col("_metadata.file_path")


def read_catalogue(spark: SparkSession, path: str, schema: str = CATALOGUE, groups: str = "periods", items: str = "coins") -> tuple[DataFrame, DataFrame]:
    """Catalogue documents that are objects with groups of items, and the files that are not."""
    rows = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path).withColumn("source_file", _path())
    good = F.col("_corrupt").isNull() & F.col(groups).isNotNull() & F.forall(groups, lambda g: g[items].isNotNull())
    return rows.where(good).drop("_corrupt"), rows.where(~F.coalesce(good, F.lit(False))).select("source_file")


def read_catalogue_tree(spark: SparkSession, root: str, filename: str, **options) -> DataFrame:
    """root/<continent>/<country>/<filename>, with both parts as columns."""
    good, _ = read_catalogue(spark, f"{root}/*/*/{filename}", **options)
    part = lambda i: F.url_decode(F.element_at(F.split("source_file", "/"), F.lit(i)))
    return good.withColumn("continent_dir", part(-3)).withColumn("country_dir", part(-2))


def list_files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """path, folder, name and size of the files below root; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root).select("path", "length", "modificationTime")
    return files.withColumn("name", F.substring_index("path", "/", -1)).withColumn("folder", F.expr("left(path, length(path) - length(name) - 1)"))


def discover_ready(files: DataFrame, pending: str, final: str) -> DataFrame:
    """Folders that hold the pending file and not the final one. files: folder, name."""
    return files.where(F.col("name") == pending).select("folder").distinct().join(files.where(F.col("name") == final).select("folder").distinct(), "folder", "left_anti")


def read_link_map(spark: SparkSession, path: str) -> DataFrame:
    """Sectioned text, 'key:' and below it indented 'side: url' lines: source_file, pos, slug, side, url."""
    lines = spark.read.text(path, wholetext=True).select(_path().alias("source_file"), F.posexplode(F.split("value", "\n")).alias("pos", "line"))
    return link_lines(lines)


def link_lines(lines: DataFrame, part: str = "source_file") -> DataFrame:
    header = F.nullif(F.regexp_extract("line", r"^(\S[^:]*):\s*$", 1), F.lit(""))
    rows = lines.withColumn("_h", header).withColumn("slug", F.last("_h", ignorenulls=True).over(Window.partitionBy(part).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("side", F.nullif(F.regexp_extract("line", r"^\s+(\w+):\s*\S+", 1), F.lit(""))).withColumn("url", F.regexp_extract("line", r"^\s+\w+:\s*(\S+)", 1))
    return rows.where("side is not null and slug is not null").select(part, "pos", "slug", "side", "url")


def repeated_headers(lines: DataFrame, part: str = "source_file") -> DataFrame:
    """Headers that a file has twice: the strict reader's violations."""
    header = F.nullif(F.regexp_extract("line", r"^(\S[^:]*):\s*$", 1), F.lit(""))
    return lines.withColumn("slug", header).where("slug is not null").groupBy(part, "slug").agg(F.count("*").alias("rows")).where("rows > 1")


def read_entity_snapshot(spark: SparkSession, root: str, entities: list[str]) -> DataFrame:
    """entity, id, and every field as it came (a variant), from root/<entity>.json with a JSON object on each line."""
    out = None
    for e in entities:
        rows = spark.read.text(f"{root}/{e}.json").select(F.lit(e).alias("entity"), F.get_json_object("value", "$.id").alias("id"), F.try_parse_json("value").alias("payload"))
        out = rows if out is None else out.unionByName(rows)
    return out


def snapshot_problems(snapshot: DataFrame) -> DataFrame:
    """Records without an id, and ids that an entity has twice."""
    return snapshot.groupBy("entity", "id").agg(F.count("*").alias("rows")).where("id is null or rows > 1")


def resolve_latest(snapshots: DataFrame, col: str = "snapshot_id") -> DataFrame:
    """The rows of the newest snapshot."""
    return snapshots.join(F.broadcast(snapshots.agg(F.max(col).alias(col))), col)  # one row


def read_tracking(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Memory of earlier runs; absent or broken files count as empty."""
    from pyspark.errors import AnalysisException

    try:
        rows = spark.read.schema(f"{schema}, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)
    return rows.where("_corrupt is null").drop("_corrupt")


def read_reports(spark: SparkSession, path: str, report: str) -> DataFrame:
    """Reports from files that hold a list of them, one of them, or an object with reports or countries. report: its DDL."""
    fields = T.StructType.fromDDL(report).fieldNames()
    text = spark.read.text(path, wholetext=True)
    one = f"array<struct<{report.replace(' ', ':', 1) if ',' not in report else ','.join(x.strip().replace(' ', ':', 1) for x in report.split(','))}>>"
    kind = F.ltrim("value")
    wrapped = F.from_json("value", f"reports {one}, countries {one}")
    rows = F.when(F.startswith(kind, F.lit("[")), F.from_json("value", one)).otherwise(F.coalesce(wrapped["reports"], wrapped["countries"], F.array(F.from_json("value", report))))
    return text.select(_path().alias("source_file"), F.posexplode(rows).alias("pos", "r")).select("source_file", "pos", *[f"r.{c}" for c in fields])


def verified_entries(manifest: DataFrame, found: DataFrame, key: list[str]) -> DataFrame:
    """Manifest entries (key, status, rows, checksum) against what is there (key, rows, checksum): problem, null if none."""
    once = manifest.groupBy(*key).agg(F.count("*").alias("_n"), F.min("status").alias("_s"), F.min("rows").alias("_r"), F.min("checksum").alias("_c"))
    rows = found.join(once, key, "left")
    problem = F.when(F.col("_n").isNull(), "not in the manifest").when(F.col("_n") > 1, "several entries").when(F.col("_s") != "complete", "not complete").when(F.col("_r") != F.col("rows"), "number of rows").when(F.col("_c") != F.col("checksum"), "checksum")
    return rows.select(*key, problem.alias("problem"))


def read_verified(spark: SparkSession, root: str, manifest: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of the exports below root that are as their manifest entry says, and by, problem of the others.

    manifest: by, status, rows, checksum (as writers.manifest makes them). Entries without rows below root are problems too.
    """
    rows = spark.read.parquet(root)
    judged = verified_entries(manifest, writers.manifest(rows, by), by)
    absent = manifest.select(*by).distinct().join(rows.select(*by).distinct(), by, "left_anti").withColumn("problem", F.lit("nothing there"))
    return rows.join(judged.where("problem is null").select(*by), by, "left_semi"), judged.where("problem is not null").unionByName(absent)
