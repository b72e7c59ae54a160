"""A keyed table that is updated bucket by bucket (T1, T5): only the buckets that rows fall into are written again.

Below a table's path:

* ``data/<version>-<id>/bucket=<b>/``: the rows of some buckets, a bucket being a hash of the key;
* ``commits/version=<n>/``: one small file with a row for each bucket: the folder of its live rows and their number.

A merge reads the live files of the buckets it touches, writes these buckets to a new folder, and then the commit. Readers
follow the newest commit and nothing else, so a merge that dies before its commit leaves the old table, and the folder it
left is among ``stale``. A commit is one file, which the committer moves in as a whole; a version that is there already
is an error for a second writer.

``order`` is kept with the rows: of two rows of a key the one that is last by order stays, whichever came first, so late
older rows do not win. Rows that tie go by arrival, those within a merge by a hash of all columns.

Defined cases: null keys are a key; a merge of no rows commits the table as it is; columns that either side lacks are null;
the number of buckets and the key belong to the table, and another key is an error.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catloom.operators.shape import last_of
from catloom.sources.readers import list_files

_COMMIT = "bucket int, folder string, rows long, buckets int, key string, schema string"


def _version_of(path: Column) -> Column:
    return F.regexp_extract(path, "/version=([0-9]+)/", 1).cast("long")


def versions(spark: SparkSession, path: str) -> list[int]:
    """The committed versions, ascending (a number for each commit that was kept)."""
    from pyspark.errors import AnalysisException

    try:
        files = list_files(spark, f"{path}/commits", "part-*")
    except AnalysisException as gone:
        if gone.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(r["v"] for r in files.select(_version_of(F.col("path")).alias("v")).distinct().collect())


def commit_record(spark: SparkSession, path: str, version: int | None = None) -> list[dict]:
    """The rows of a commit, by default the newest: one for each bucket that has rows; none for a new table."""
    known = versions(spark, path)
    if not known or version is not None and version not in known:
        return []
    rows = spark.read.schema(_COMMIT).json(f"{path}/commits/version={known[-1] if version is None else version}").collect()
    return [r.asDict() for r in rows]


def bucket_of(key: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _rows(spark: SparkSession, record: list[dict], only: set[int] | None = None) -> DataFrame | None:
    """The live rows of a commit's buckets; files of other buckets are not listed."""
    named = [r for r in record if r["folder"] and (only is None or r["bucket"] in only)]
    if not named:
        return None
    return spark.read.schema(record[0]["schema"]).parquet(*[f"{r['folder']}/bucket={r['bucket']}" for r in named])


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """The table as of a commit, by default the newest; None where nothing was committed or nothing is in it."""
    return _rows(spark, commit_record(spark, path, version))


def read_keys(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame | None:
    """The rows of the given keys; only their buckets are read."""
    record = commit_record(spark, path)
    if not record:
        return None
    key = record[0]["key"].split(",")
    wanted = keys.select(*key).distinct()
    only = {r["b"] for r in wanted.select(bucket_of(key, record[0]["buckets"]).alias("b")).distinct().collect()}  # at most the buckets
    rows = _rows(spark, record, only)
    return None if rows is None else rows.join(wanted, key, "left_semi")


def merge(spark: SparkSession, path: str, rows: DataFrame, key: list[str], *, order: list[str] = (), buckets: int = 64, replace: bool = True, version: int | None = None) -> int:
    """Merge rows into the table and commit; returns the version. replace: known keys are overwritten, else they are skipped.

    buckets counts for a new table only. version: the number to commit (a version that is there is left as it is, so a batch
    that runs again changes nothing), by default the next one.
    """
    known = versions(spark, path)
    if version is not None and version in known:
        return version
    record = commit_record(spark, path)
    if record and record[0]["key"] != ",".join(key):
        raise ValueError(f"the table's key is {record[0]['key']}")
    buckets = record[0]["buckets"] if record else buckets
    number = (known[-1] + 1 if known else 0) if version is None else version
    new = rows.withColumn("bucket", bucket_of(key, buckets))
    touched = {r["bucket"] for r in new.select("bucket").distinct().collect()}
    old = _rows(spark, record, touched)
    merged = new.withColumn("_gen", F.lit(1 if replace else 0))
    if old is not None:
        merged = old.withColumn("bucket", bucket_of(key, buckets)).withColumn("_gen", F.lit(0 if replace else 1)).unionByName(merged, allowMissingColumns=True)
    # replace: last by order, then the newer one; else a known row stays whatever its order
    merged = last_of(merged, key, [*order, "_gen"] if replace else ["_gen", *order]).drop("_gen")
    folder, live = f"{path}/data/{number}-{uuid.uuid4().hex}", [r for r in record if r["bucket"] not in touched and r["folder"]]
    if touched:
        merged.repartition("bucket", F.pmod(F.xxhash64(*key, F.lit(7)), F.lit(4))).write.partitionBy("bucket").parquet(folder)  # a bucket is four tasks'
        counts = spark.read.parquet(folder).groupBy("bucket").agg(F.count("*").alias("rows")).collect()
        live += [{"bucket": r["bucket"], "folder": folder, "rows": r["rows"]} for r in counts]
    fields = {f.name: f for f in T.StructType.fromDDL(record[0]["schema"]).fields} if record else {}
    fields |= {f.name: f for f in rows.schema.fields if f.name not in fields}
    schema = ", ".join(f"`{name}` {f.dataType.simpleString()}" for name, f in fields.items())
    commit(spark, path, number, [{**r, "buckets": buckets, "key": ",".join(key), "schema": schema} for r in live or [{"bucket": -1, "folder": None, "rows": 0}]])
    return number


def commit(spark: SparkSession, path: str, version: int, record: list[dict]) -> None:
    names = [x.split()[0] for x in _COMMIT.split(", ")]
    spark.createDataFrame([tuple(r[n] for n in names) for r in record], _COMMIT).coalesce(1).write.mode("error").json(f"{path}/commits/version={version}")


def stale(spark: SparkSession, path: str, keep: int = 1) -> DataFrame:
    """folder of the data folders that none of the newest commits names: leavings of failed merges and of old versions."""
    live = {r["folder"] for v in versions(spark, path)[-keep:] for r in commit_record(spark, path, v)}
    folders = list_files(spark, f"{path}/data", "part-*").select(F.regexp_replace("folder", "/bucket=[^/]*$", "").alias("folder")).distinct()
    own = F.regexp_extract("folder", "([^/]*)$", 1)
    return folders.where(~own.isin([f.rsplit("/", 1)[-1] for f in live if f] or [""]))
