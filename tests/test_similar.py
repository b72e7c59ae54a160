"""Names alike without a block against the ratio of all pairs."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from catloom.operators import match, similar


def ratio(a, b):
    return SequenceMatcher(None, a, b).ratio()


@pytest.mark.parametrize("least", [0.5, 0.7, 0.9])
def test_no_pair_is_left_out(spark, least):
    rng = random.Random(7)
    base = ["".join(rng.choice("aabcde ") for _ in range(rng.randrange(1, 14))) for _ in range(40)] + ["2 euro", "20 euro", "5 satang", "5 baht", "é" * 9, "x"]
    names = base + ["".join(rng.sample(n, len(n))) for n in base[:20]] + [n + rng.choice("xyz") for n in base[:20]] + [None, " ", ""]
    a, b = (spark.createDataFrame([(n,) for n in rng.sample(names, len(names))], "name string") for _ in range(2))
    want = {(x, y) for x in names for y in names if x and y and x.strip() and y.strip() and ratio(x, y) >= least}
    got = {(r["a"], r["b"]): r["ratio"] for r in similar.similar_names(a, b, "name", "name", least=least).collect()}
    assert set(got) == want and all(abs(got[p] - ratio(*p)) < 1e-12 for p in got)
    assert len(want) <= similar.candidate_pairs(a, b, "name", "name", least=least).count() <= len(set(names)) ** 2


def test_all_pairs_of_the_part_table(spark, capsys):
    p = spark.read.parquet("/root/testdata/sf0.001/part.parquet").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.when(F.col("p_partkey") % 3 > 0, (F.col("p_size") % 3).cast("string")).alias("amount"), F.concat(F.col("p_brand")).alias("years"))
    own, other = p.withColumnRenamed("id", "item_id"), p.withColumnRenamed("id", "record_id").withColumn("name", F.regexp_replace("name", "^(.)(.)", "$2$1"))
    got = similar.top_similar(own, other, 4)
    one = lambda df: df.withColumn("all", F.lit(1))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    points = match.score(text("i_amount"), text("r_amount"), F.col("i_name"), F.col("r_name"), text("i_years"), text("r_years"))
    want = match.top_candidates(one(own), one(other), ["all"], "amount", points, 4)  # every pair is scored
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 100
    scored, names = similar.candidate_pairs(own, other, "name", "name").count(), own.select("name").distinct().count()
    with capsys.disabled():
        print(f"\npairs scored: {scored} of {names * other.select('name').distinct().count()}")


def test_equal_rows_are_scored_once(spark):
    """Copies of a few rows, repeated and null ids: the rows of all pairs, from the pairs of what differs."""
    rng, scored = random.Random(9), spark.sparkContext.accumulator(0)
    kinds = [(b, s, n, t) for b in "xy" for s in ("1", "2", None, "") for n in ("2 euro", "2 euros", "euro 2", None) for t in ("a", "ab")]
    rows = lambda: [(rng.choice([None, rng.randrange(200), rng.randrange(5000)]), *rng.choice(kinds)) for _ in range(800)]
    schema = "id long, brand string, amount string, name string, type string"
    items, records = spark.createDataFrame(rows(), schema), spark.createDataFrame(rows(), schema)

    @F.udf("double")
    def points(a, b, x, y):
        scored.add(1)
        return None if a is None or b is None else float(len({*a} & {*b}) - 2 * (a != b) + (x == y))

    got = match.top_candidates(items, records, ["brand"], "amount", points("i_name", "r_name", "i_type", "r_type"), 3, item_id="id", record_id="id")
    got = sorted(map(str, got.collect()))
    assert scored.value <= 4 * len(kinds) ** 2 and len(got) > 300  # a UDF that is filtered and shown may run more than once
    every, fits = [], lambda a, b: a["brand"] == b["brand"] and (not a["amount"] or not b["amount"] or a["amount"] == b["amount"])
    best = {}
    own, other = items.collect(), records.collect()
    for a in own:
        for b in other:
            if fits(a, b) and a["name"] is not None and b["name"] is not None:
                p = float(len({*a["name"]} & {*b["name"]}) - 2 * (a["name"] != b["name"]) + (a["type"] == b["type"]))
                if p > 0:
                    best.setdefault(a["id"], []).append((-p, b["id"] is not None, b["id"] or 0, b["id"]))
    for a, found in best.items():
        every += [f"Row(item_id={a}, record_id={r[3]}, points={-r[0]}, rank={n})" for n, r in enumerate(sorted(found, key=lambda r: r[:3])[:3], 1)]
    assert got == sorted(every)
