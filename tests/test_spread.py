"""Rows dealt into tasks of a stated size, however many there are."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from catloom.plans import extract_queries, shape_queries
from catloom.sources.shared import spread


def test_tasks_have_so_many_rows_and_whole_keys(spark):
    rows = spark.range(0, 20_000, 1, 3).select((F.col("id") % 5_000).alias("k"), "id")
    parts = spread(rows, "k", each=1_000).withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("id"))).withColumn("p", F.spark_partition_id())
    sizes = parts.groupBy("p").agg(F.count("*").alias("c"), F.count_if(F.col("n") == 4).alias("keys")).collect()
    assert len(sizes) == 20 and max(r["c"] for r in sizes) < 1_300 and sum(r["keys"] for r in sizes) == 5_000
    assert spread(rows.limit(9), "k").rdd.getNumPartitions() == 4 and spread(rows, "k", each=10, n=500).rdd.getNumPartitions() == 50


@pytest.mark.parametrize("name", ["w_catalogue_order", "w_gapless_rank", "e_line_lists"])
def test_lines_stay_in_their_tasks(spark, name, monkeypatch):
    monkeypatch.setattr(shape_queries, "spread", lambda rows, *key: spread(rows, *key, each=500))
    monkeypatch.setattr(extract_queries, "spread", lambda rows, *key: spread(rows, *key, each=500))
    module = extract_queries if name.startswith("e_") else shape_queries
    assert getattr(module, name)(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == 12  # 6,000 lines, no later exchange
