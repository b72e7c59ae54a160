"""The pipeline's near-duplicate stage against all pairs by brute force."""

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from catloom.llm import near_copies, simhash
from catloom.llm.common import table

SF = "/root/testdata/sf0.01"


def brute_kept(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a == b or (min(len(a), len(b)) * 5 >= max(len(a), len(b)) * 4 and len(a & b) * 5 >= len(a | b) * 4):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    least: dict = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted(least.values())


def stage(spark, docs):
    return dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, SF)


def test_stage_of_the_tables(spark):
    docs = table(spark, SF, "documents")
    want = brute_kept([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sorted(r["doc_id"] for r in stage(spark, docs).collect()) == want


def test_stage_drops_every_near_copy(spark):
    rng = random.Random(1)
    rows = []
    for n in (8, 40, 300):  # chains of copies, each with another few words changed
        w = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        for _ in range(40):
            rows.append((len(rows) + 1, " ".join(w)))
            for k in rng.sample(range(n), max(1, n // 60)):
                w[k] = f"w{rng.randrange(10**6)}"
    rows += [(1000, None), (1001, ""), (1002, "one two"), (1003, "One  two"), (1004, "one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(r["doc_id"] for r in stage(spark, docs).collect()) == brute_kept(rows)


@pytest.mark.parametrize("radius", [0, 5, 9])
def test_links_of_any_radius(spark, radius):
    rng = random.Random(radius)
    fps = [rng.getrandbits(62) for _ in range(30)]
    fps += [f ^ sum(1 << b for b in rng.sample(range(62), rng.randrange(1, 12))) for f in fps for _ in range(3)]
    links = simhash.near_links(spark.createDataFrame([(f,) for f in fps], "fp long"), radius=radius)
    got = {frozenset((r["a"], r["b"])) for r in links.collect()}
    assert all((a ^ b).bit_count() <= radius for a, b in got)
    near = {f for i, f in enumerate(fps) for g in fps if g != f and (f ^ g).bit_count() <= radius}
    assert near == {f for x in got for f in x}


@pytest.mark.parametrize("shard", [16, 1024])
def test_large_buckets_lose_no_pair(spark, monkeypatch, shard):
    monkeypatch.setattr(near_copies, "SHARD", shard)
    rng, rows = random.Random(5), []
    common = [f"c{i}" for i in range(60)]  # a passage that all share
    for _ in range(40):
        own = [f"w{rng.randrange(10**6)}" for _ in range(90)]
        for _ in range(3):
            w = list(own)
            w[rng.randrange(90)] = f"w{rng.randrange(10**6)}"
            rows.append((len(rows) + 1, " ".join(common + w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    groups = near_copies.copy_groups(docs, few=2).groupBy("root").agg(F.min("doc_id").alias("least"))
    assert sorted(r["least"] for r in groups.collect()) == brute_kept(rows)


def test_copies_around_the_threshold_in_a_large_bucket(spark):
    rng, rows = random.Random(7), []
    for _ in range(3):
        own = [f"w{rng.randrange(10**6)}" for _ in range(150)]
        for _ in range(60):  # two of them are 0.6 to 0.95 alike; many sets' nearest is not alike enough
            w = list(own)
            for k in rng.sample(range(150), rng.randrange(1, 7)):
                w[k] = f"w{rng.randrange(10**6)}"
            rows.append((len(rows) + 1, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    groups = near_copies.copy_groups(docs, few=2).groupBy("root").agg(F.min("doc_id").alias("least"))
    assert sorted(r["least"] for r in groups.collect()) == brute_kept(rows)


def test_sketches_tell_what_cannot_be_alike():
    rng = random.Random(3)
    for n in (1, 5, 40, 400, 4000):
        for keep, want in ((1.0, True), (0.9, True), (0.3, False if n > 40 else None)):
            a = [rng.getrandbits(63) - 2**62 for _ in range(n)]
            b = a[: round(n * keep)] + [rng.getrandbits(63) - 2**62 for _ in range(n - round(n * keep))]
            u, v = (near_copies.np.frombuffer(near_copies.sketch(near_copies.np.unique(near_copies.np.array(s))), "u1")[None] for s in (a, b))
            shown, may = near_copies.estimated(u, v)
            assert want is None or bool(may[0]) == want, (n, keep)
            assert keep < 1 or shown[0] == 1
