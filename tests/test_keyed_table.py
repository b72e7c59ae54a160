"""The keyed table: buckets, commits, late rows, failures."""

import pytest
from pyspark.sql import functions as F

from catloom.sources import keyed_table
from catloom.sources.readers import list_files
from catloom.streaming import upserts

ROWS = "k string, v long, at long"


def content(df):
    return {r["k"]: r["v"] for r in df.collect()}


def files(spark, path):
    return {r["path"] for r in list_files(spark, f"{path}/data", "part-*").collect()}


def test_a_batch_of_one_key_writes_one_bucket(spark, tmp_path):
    path = str(tmp_path / "t")
    assert keyed_table.read(spark, path) is None and keyed_table.versions(spark, path) == []
    keyed_table.merge(spark, path, spark.range(200).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v"), F.lit(1).cast("long").alias("at")), ["k"], order=["at"], buckets=8)
    before = files(spark, path)
    assert keyed_table.merge(spark, path, spark.createDataFrame([("k7", 700, 2)], ROWS), ["k"], order=["at"]) == 1
    new = files(spark, path) - before
    assert {p.split("bucket=")[1].split("/")[0] for p in new} == {next(p.split("bucket=")[1].split("/")[0] for p in new)}
    got = content(keyed_table.read(spark, path))
    assert len(got) == 200 and got["k7"] == 700 and got["k8"] == 8
    assert content(keyed_table.read(spark, path, 0))["k7"] == 7  # older commits can be read
    assert sum(r["rows"] for r in keyed_table.commit_record(spark, path)) == 200
    some = keyed_table.read_keys(spark, path, spark.createDataFrame([("k7",), ("none",)], "k string"))
    assert content(some) == {"k7": 700} and len(some.inputFiles()) <= 8
    assert keyed_table.stale(spark, path, keep=2).collect() == [] and keyed_table.stale(spark, path).collect() == []  # other buckets still live in the first folder


def test_late_older_rows_ties_and_null_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    put = lambda rows, **o: keyed_table.merge(spark, path, spark.createDataFrame(rows, ROWS), ["k"], order=["at"], buckets=4, **o)
    put([("a", 1, 5), ("a", 2, 9), (None, 3, 1)])
    put([("a", 4, 7), ("b", 5, 1), (None, 6, 2)])  # an older row of a
    assert content(keyed_table.read(spark, path)) == {"a": 2, "b": 5, None: 6}
    put([("a", 8, 9)])  # a tie: the newer one
    put([])
    put([("a", 9, 99), ("c", 1, 1)], replace=False)
    assert content(keyed_table.read(spark, path)) == {"a": 8, "b": 5, "c": 1, None: 6}
    with pytest.raises(ValueError, match="key"):
        keyed_table.merge(spark, path, spark.createDataFrame([("a", 1, 1)], ROWS), ["v"])
    wider = spark.createDataFrame([("a", 10, 100, "x")], ROWS + ", more string")
    keyed_table.merge(spark, path, wider, ["k"], order=["at"])
    put([("z1", 1, 1), ("z2", 1, 1)])  # narrower rows, also in buckets without any
    keyed_table.merge(spark, path, spark.createDataFrame([("z1",), ("z2",)], "k string").withColumn("at", F.lit(5).cast("long")), ["k"], order=["at"])
    assert {r["k"] for r in keyed_table.read(spark, path).where("more is null and at = 5 and v is null").collect()} == {"z1", "z2"}
    keyed_table.merge(spark, path, spark.createDataFrame([("z1", -1, 9), ("z2", -1, 9)], ROWS), ["k"], order=["at"])
    assert {(r["k"], r["more"]) for r in keyed_table.read(spark, path).collect()} == {("a", "x"), ("b", None), ("c", None), (None, None), ("z1", None), ("z2", None)}


def test_a_failure_between_files_and_commit_leaves_the_old_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    keyed_table.merge(spark, path, spark.createDataFrame([("a", 1, 1)], ROWS), ["k"])
    with monkeypatch.context() as m:
        m.setattr(keyed_table, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            keyed_table.merge(spark, path, spark.createDataFrame([("a", 2, 2)], ROWS), ["k"], version=1)
    assert content(keyed_table.read(spark, path)) == {"a": 1} and keyed_table.stale(spark, path).count() == 1
    assert keyed_table.merge(spark, path, spark.createDataFrame([("a", 3, 3)], ROWS), ["k"], version=1) == 1
    assert keyed_table.merge(spark, path, spark.createDataFrame([("a", 4, 4)], ROWS), ["k"], version=1) == 1  # committed: left as it is
    assert content(keyed_table.read(spark, path)) == {"a": 3}
    with pytest.raises(Exception, match="(?i)exist"):
        keyed_table.commit(spark, path, 1, keyed_table.commit_record(spark, path))


def test_stream_of_several_batches(spark, tmp_path):
    landed, target = str(tmp_path / "in"), str(tmp_path / "t")
    for i, at in enumerate((3, 9, 6)):
        spark.range(20).select(F.concat(F.lit("k"), F.col("id") % 10).alias("k"), (F.col("id") + 100 * i).alias("v"), F.lit(at).cast("long").alias("at")).coalesce(1).write.mode("append").parquet(landed)
    stream = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(landed)
    upserts.stream_upsert(stream, target, ["k"], str(tmp_path / "c"), order=["at"], buckets=4).awaitTermination()
    assert keyed_table.versions(spark, target) == [0, 1, 2]
    assert all(100 <= v < 120 for v in content(upserts.latest(spark, target)).values())
    upserts.stream_upsert(stream, target, ["k"], str(tmp_path / "c"), order=["at"], buckets=4).awaitTermination()  # nothing new
    assert keyed_table.versions(spark, target) == [0, 1, 2]
