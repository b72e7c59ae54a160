"""Snapshots compared by their digest trees."""

import pytest
from pyspark.sql import functions as F

from catloom.operators.findings import snapshot_diff
from catloom.sources import digest_tree
from catloom.sources.digest_tree import changed_leaves, tree_diff, unchanged_rows, write_tree

COLS = ["a", "b"]


def table(spark, n=500):
    return spark.range(n).select(F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("a"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("b"), "id")).alias("b"))


def rows(df):
    return sorted((str(r["k"]), r["status"], r["changed"], str(r["before"]), str(r["after"])) for r in df.collect())


def test_one_changed_row_reads_one_range(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    df = table(spark)
    after = df.withColumn("a", F.when(F.col("k") == 77, "new").otherwise(F.col("a")))
    for d, p in ((df, a), (after, b)):
        write_tree(d, p, ["k"], leaves=32, fanout=4)
    got = tree_diff(spark, a, b, COLS)
    assert rows(got) == rows(snapshot_diff(df, after, ["k"], COLS).where("status <> 'unchanged'")) and len(rows(got)) == 1
    assert len(changed_leaves(spark, a, b)) == 1 and {f.split("_leaf=")[1].split("/")[0] for f in got.inputFiles()} == {str(changed_leaves(spark, a, b)[0][0])} and len(got.inputFiles()) == 2
    assert 400 < unchanged_rows(spark, a, b) < 500
    assert changed_leaves(spark, a, a) == [] and tree_diff(spark, a, a, COLS).collect() == [] and unchanged_rows(spark, a, a) == 500


def test_all_kinds_of_changes(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    df = table(spark).unionByName(spark.createDataFrame([(None, "x", None)], "k long, a string, b string"))
    swapped = df.withColumns({"a": F.when(F.col("k") == 15, F.col("b")).when(F.col("k").isNull(), None).otherwise(F.col("a")), "b": F.when(F.col("k").isNull(), "x").otherwise(F.col("b"))})  # a null that changes places
    after = swapped.where("k is null or k % 50 <> 1").unionByName(table(spark, 520).where("k >= 500"))
    for d, p in ((df, a), (after, b)):
        write_tree(d.repartition(3), p, ["k"], leaves=300, fanout=16)
    got, want = rows(tree_diff(spark, a, b, COLS)), rows(snapshot_diff(df, after, ["k"], COLS).where("status <> 'unchanged'"))
    assert got[:-1] or got
    assert [r for r in got if r[0] != "None"] == [r for r in want if r[0] != "None"]
    assert {r[1] for r in got if r[0] == "None"} == {"created", "deleted"}  # null keys never meet in a join, as in snapshot_diff


def test_empty_and_other_shapes(spark, tmp_path):
    a, b, c = (str(tmp_path / x) for x in "abc")
    write_tree(table(spark).limit(0), a, ["k"], leaves=8, fanout=2)
    write_tree(table(spark, 3), b, ["k"], leaves=8, fanout=2)
    write_tree(table(spark, 3), c, ["k"], leaves=16, fanout=2)
    assert [r[1] for r in rows(tree_diff(spark, a, b, COLS))] == ["created"] * 3 and tree_diff(spark, a, a, COLS).collect() == []
    with pytest.raises(ValueError, match="shape"):
        changed_leaves(spark, b, c)
    assert digest_tree.unchanged_rows(spark, a, b) == 0
