"""Order-dependent operators over ranges against the window forms, with groups and runs over many ranges."""

import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from catloom.operators import order, ranges

SCHEMA = "g string, pos long, v string, x double, part int"


def table(spark, n=400, seed=1, groups=("a", "b", None, "c")):
    rng = random.Random(seed)
    rows = [(rng.choices(groups, [12, 1, 2, 1])[0], i, rng.choices(["p", "q", None], [9, 1, 1])[0], rng.choice([None, None, None, 1.5, float("nan"), 2.0]), i % 3) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def rows(df, *cols):
    return sorted((tuple(str(r[c]) for c in cols) for r in df.collect()))


@pytest.fixture(autouse=True)
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("parts", [1, 9])
@pytest.mark.parametrize("group", [["g"], [], ["g", "part"]])
def test_same_as_windows(spark, parts, group):
    df = table(spark)
    w = Window.partitionBy(*group or [F.lit(1)])
    want = df.withColumn("n", F.row_number().over(w.orderBy(F.desc("pos"))))
    assert rows(ranges.numbered(df, group, [F.desc("pos")], "n", parts=parts), "pos", "n") == rows(want, "pos", "n")
    want = df.withColumn("f", F.last("x", ignorenulls=True).over(w.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)))
    assert rows(ranges.forward_fill(df, group, "x", "pos", "f", parts=parts), "pos", "f") == rows(want, "pos", "f")
    cols = [*group, "run", "v", "start", "end", "length"]
    assert rows(ranges.runs(df, group, ["v"], ["pos"], parts=parts), *cols) == rows(order.runs(df.withColumn("one", F.lit(1)), group or ["one"], ["v"], ["pos"]), *cols)
    assert rows(ranges.runs(df, group, ["x", "v"], ["pos"], parts=parts), *cols) == rows(order.runs(df.withColumn("one", F.lit(1)), group or ["one"], ["x", "v"], ["pos"]), *cols)
    assert rows(ranges.rank_by_first(df, group, "v", "pos", parts=parts), "pos", "rank") == rows(order.gapless_rank(df.withColumn("one", F.lit(1)), group or ["one"], "v", "pos"), "pos", "rank")


def test_a_run_over_all_ranges_and_even_tasks(spark):
    df = spark.range(5000).select(F.lit("g").alias("g"), F.col("id").alias("pos"), F.lit("same").alias("v"), F.when(F.col("id") == 3, 7).alias("mark"))
    assert [tuple(r) for r in ranges.runs(df, ["g"], ["v"], ["pos"], parts=8).collect()] == [("g", 1, "same", 0, 4999, 5000)]
    assert ranges.forward_fill(df, ["g"], "mark", "pos", "f", parts=8).where("f = 7").count() == 4997
    assert ranges.numbered(df, ["g"], ["pos"], "n", parts=8).where("n = pos + 1").count() == 5000
    sizes = [r["count"] for r in df.repartitionByRange(8, "g", "pos").groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * statistics.median(sizes)  # one group, and no task above twice the median


def test_ties_are_told_apart_and_empty_tables(spark):
    df = table(spark).withColumn("pos", F.lit(1).cast("long")).withColumn("m", F.create_map(F.lit("a"), "part"))
    a, b = (rows(ranges.numbered(df.repartition(k), ["g"], ["pos"], "n", parts=5).withColumn("m", F.to_json("m")), "g", "n", "v", "x", "part", "m") for k in (2, 6))
    assert a == b and len(a) == 400
    empty = df.limit(0)
    assert ranges.numbered(empty, ["g"], ["pos"]).collect() == [] and ranges.runs(empty, [], ["v"], ["pos"]).collect() == []
