"""Folds as a stream against the array forms, and audits that ride on one scan."""

import random
import resource

import pytest
from pyspark.sql import functions as F

from catloom.operators import contracts, folds, match, shape


def table(spark, n=300):
    rng = random.Random(2)
    pick = lambda *x: rng.choice([None, "", *x])
    rows = [(rng.choice(["a", "a", "a", "b", None]), i, pick("p", "q"), pick("r"), rng.choice([None, (pick("x"), rng.choice([None, 1.5]))]), pick("g1", "g1", "g1", "g2"), 1) for i in range(n)]
    return spark.createDataFrame(rows, "k string, pos long, a string, b string, s struct<x:string,y:double>, g string, rows int").repartition(3)


@pytest.mark.parametrize("guard", [None, "g"])
def test_merges_are_those_of_the_array_form(spark, guard):
    df = table(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    try:
        got = folds.dedup_merge_stream(df, ["k"], "pos", ["a", "b", "s", "g"], guard=guard).collect()
        groups = folds.merge_groups_stream(df, ["k"], "pos", ["a", "b"], "g").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(str, got)) == sorted(map(str, shape.dedup_merge(df, ["k"], "pos", ["a", "b", "s", "g"], guard=guard).collect()))
    want = shape.merge_groups(df.where("g is not null"), ["k"], "pos", ["a"], "g").collect()
    assert {r["k"]: r["gs"] for r in groups} == {r["k"]: r["gs"] for r in want}
    assert folds.dedup_merge_stream(df.limit(0), ["k"], "pos", ["a"]).collect() == []


def test_a_key_of_many_rows_in_flat_memory(spark):
    df = spark.range(1_000_000).select(F.lit("hot").alias("k"), F.col("id").alias("pos"), F.when(F.col("id") == 999_000, "late").alias("a"), F.when(F.col("id") == 7, "early").alias("b"))

    def begin(row):
        return [1, row, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss]

    def step(state, row):
        state[0] += 1
        state[1] = {"a": state[1]["a"] or row["a"], "b": state[1]["b"] or row["b"]}
        return state

    end = lambda s: {"n": s[0], "a": s[1]["a"], "b": s[1]["b"], "grown_mb": (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - s[2]) // 1024}
    r = folds.ordered_fold(df, ["k"], ["pos"], ["a", "b"], begin, step, end, "n long, a string, b string, grown_mb long").first()
    assert (r["n"], r["a"], r["b"]) == (1_000_000, "late", "early") and r["grown_mb"] < 100
    assert tuple(folds.dedup_merge_stream(df.where("pos > 980000"), ["k"], "pos", ["a", "b"]).first()) == ("hot", 19_999, "late", None)


def test_audits_of_one_scan(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    checks = {f"check {i}": (F.col("k") > i, 2) for i in range(9)} | {"null": (F.col("v") == "zz", 0)}
    want = contracts.audit({n: (df.where(c), e) for n, (c, e) in checks.items()})
    one = contracts.audit_scan(df, checks)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, want.collect()))
    assert one._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Scan") == 1
    rows, result = contracts.observed(df, checks)
    assert rows.count() == 3
    assert sorted(map(tuple, result().collect())) == sorted(map(tuple, want.collect()))


def test_cascade_takes_the_first_stage(spark):
    items = spark.createDataFrame([(1, "a", "x"), (2, "q", "x"), (3, None, "y"), (4, None, None), (4, "a", None)], "item_id long, p string, q string")
    records = spark.createDataFrame([(10, "a", "x"), (11, "b", "y"), (12, "c", "y"), (9, "a", "z")], "record_id long, p string, q string")
    got = match.match_cascade(items, records, [("p", F.col("p"), F.col("p")), ("q", F.col("q"), F.col("q"))], unique=("q",)).collect()
    assert sorted(map(tuple, got), key=str) == [(1, 9, 2, "p"), (2, 10, 1, "q"), (3, None, 0, "not_found"), (4, 9, 2, "p"), (4, None, 0, "not_found")]
