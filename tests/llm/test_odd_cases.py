"""Cases that once went wrong: odd characters, empty arrays, repeated ids, hot keys, null item ids."""

import time
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from catloom.llm import decontaminate, factorisation, hilbert, mixing, ngram_lm, quality_rules, simhash, token_ids


def test_encoder_agrees_with_the_library():
    enc, rng = token_ids.Encoder(None), random.Random(1)
    assert enc.in_pieces
    chars = [chr(i) for i in range(256)]
    texts = chars + [a + b for a in chars for b in rng.sample(chars, 25)] + ["".join(rng.choices(chars, k=rng.randrange(1, 300))) for _ in range(1500)]
    texts += ["\x00Ü\x00\x9c", "!\x00a", "!\x00", "it's", "<|endoftext|>", "naïve Ω text", "é x"]
    want = [e.ids for e in enc.tok.encode_batch(texts, add_special_tokens=False)]
    got = [ids.tolist() for i in range(0, len(texts), 997) for ids in enc.encode(texts[i : i + 997])]
    assert got == want


def test_other_tokenizers_get_whole_texts():
    import public_tokenizers

    enc = token_ids.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["A b, c's \x00!", "", "Über 12"]
    assert not enc.in_pieces and [x.tolist() for x in enc.encode(texts)] == [e.ids for e in enc.tok.encode_batch(texts, add_special_tokens=False)]


def test_repeated_and_null_ids_are_numbered_across_shards(spark, monkeypatch):
    rows = [(None, f"t {i % 3}") for i in range(200)] + [(7, "aa bb")] * 150 + [(i, "x \x00 y\x00Ü\x00\x9c") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    keys_of = token_ids.keys_of
    monkeypatch.setattr(token_ids, "keys_of", lambda d, c="doc_id": keys_of(d, c, part=60))
    got = sorted(token_ids.token_ids(docs, block_ids=100, shards=6).collect(), key=lambda r: r["start"])
    tok = token_ids.encoder(None).tok
    assert Counter((r["doc_id"], r["ids_crc32"]) for r in got) == Counter((d, zlib.crc32(np.array(tok.encode(t, add_special_tokens=False).ids + [1], "<u4").tobytes())) for d, t in rows)
    assert got[0]["start"] == 0 and all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(got, got[1:]))


def test_keys_that_share_a_hash_part_by_the_second():
    keys = np.random.default_rng(0).integers(0, 2**64, (2, 500), dtype=np.uint64)
    keys[0, :40] = keys[0, 0]
    sizes, bits, slot = token_ids.build_mph(keys)
    assert sorted(slot) == list(range(500)) and (token_ids.probe_mph(sizes, bits, keys) == slot).all()


def test_mixing_keeps_rows_without_sources(spark):
    rows = spark.createDataFrame([(1, "a b c", ["a"]), (2, "x y", []), (3, "z z z z", None), (4, "q w", [None, "a"])], "doc_id long, text string, source array<string>")
    got = {r["doc_id"]: r for r in mixing.mix_digest(rows).collect()}
    assert sorted(got) == [1, 2, 3, 4] and got[2]["source_size"] == got[3]["source_size"] == 8


def test_mixing_of_many_patterns_keeps_their_memberships(spark):
    rows = spark.range(2000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 7).cast("int")).alias("text"), F.array((F.col("id") % 40).cast("string"), ((F.col("id") * 7 + 3) % 41).cast("string")).alias("source"))
    got = mixing.mix(rows).agg(F.count("*").alias("n"), F.sum("taken").alias("t"), F.max(F.col("taken") - 3 * F.col("size")).alias("over"), F.min(F.size("pattern")).alias("least")).first()
    total = rows.agg(F.sum(mixing.n_words(F.col("text")))).first()[0]
    assert got["n"] == 2000 and got["over"] <= 0 and got["t"] > 0.95 * total and got["least"] == 1  # both sources the same
    assert abs(mixing.repeated(rows).agg(F.sum(mixing.n_words(F.col("text")))).first()[0] - got["t"]) <= 50
    with pytest.raises(ValueError, match="patterns"):
        mixing.mix(rows, max_patterns=50)


def test_flow_is_the_cheapest_and_fast():
    def plain(supply, members, quotas, costs):
        """Total and cost by trying every single word along the cheapest way (Bellman-Ford), on tiny graphs."""
        n_p, n_s = len(supply), len(quotas)
        arcs = [[0, 1 + p, supply[p], c] for p in range(n_p) for c in costs] + [[1 + p, 1 + n_p + s, 10**6, 0] for p in range(n_p) for s in members[p]] + [[1 + n_p + s, 1 + n_p + n_s, quotas[s], 0] for s in range(n_s)]
        arcs = [x for a, b, c, w in arcs for x in ([a, b, c, w], [b, a, 0, -w])]
        total = cost = 0
        while True:
            best = {0: (0, [])}
            for _ in range(n_p + n_s + 2):
                for k, (a, b, c, w) in enumerate(arcs):
                    if c and a in best and (b not in best or best[a][0] + w < best[b][0]):
                        best[b] = (best[a][0] + w, [*best[a][1], k])
            if 1 + n_p + n_s not in best:
                return total, cost
            w, way = best[1 + n_p + n_s]
            total, cost = total + 1, cost + w
            for k in way:
                arcs[k][2] -= 1
                arcs[k ^ 1][2] += 1

    rng = random.Random(5)
    for _ in range(40):
        n_s = rng.randrange(1, 5)
        members = [sorted(rng.sample(range(n_s), rng.randrange(1, n_s + 1))) for _ in range(rng.randrange(1, 5))]
        supply, quotas, costs = [rng.randrange(5) for _ in members], [rng.randrange(9) for _ in range(n_s)], (0, 1, 3)
        flow = mixing.min_cost_flow(supply, members, quotas, costs)
        assert all(sum(f[own.index(s)] for f, own in zip(flow, members, strict=True) if s in own) <= q for s, q in enumerate(quotas))
        cost = sum(sum(w * min(n, max(0, sum(f) - k * n)) for k, w in enumerate(costs)) for f, n in zip(flow, supply, strict=True))
        assert all(sum(f) <= 3 * n for f, n in zip(flow, supply, strict=True)) and (sum(map(sum, flow)), cost) == plain(supply, members, quotas, costs)
    n = 100_000
    began = time.perf_counter()
    assert mixing.min_cost_flow([5] * n, [[i] for i in range(n)], [7] * n, (0.0, 1.0, 3.0)) == [[7]] * n and time.perf_counter() - began < 20


@pytest.mark.parametrize("parts", [1, 3])
def test_the_row_that_leads_its_group_stays(spark, parts):
    a, b, c = "one two three four five six", "seven eight nine ten eleven twelve", "red green blue black white pink"
    rows = [(3, a), (5, a), (5, b), (5, c), (5, c), (None, a)]
    docs = spark.createDataFrame([(d, t, {"k": t}) for d, t in rows], "doc_id long, text string, m map<string,string>").repartition(parts)
    kept = simhash.drop_near(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == sorted([(3, a), (5, b), (5, c), (0, a)])


def test_a_labelled_id_on_many_rows_brings_one(spark):
    docs = spark.range(5000).select(F.lit(2).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit(1).alias("_label_id"))
    labels = spark.createDataFrame([(2, 1), (2, 0)], "doc_id long, quality int")
    got = quality_rules.labelled_stats(docs, labels, max_labelled=10)
    assert len(got) == 1 and got["quality"][0] == 0
    assert quality_rules.quality_digest(docs, labels).count() == 5000 and factorisation.classify_digest(docs, labels).count() == 5000


def test_rows_without_text_or_id_are_several_units(spark):
    rows = spark.range(6000).select(F.when(F.col("id") % 3 == 0, F.col("id")).alias("doc_id"), F.when(F.col("id") % 2 == 0, F.concat(F.lit("t"), "id")).alias("text"), F.lit("s").alias("source"), F.lit("en").alias("lang"))
    got = hilbert.shard_digest(rows).groupBy("shard").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), F.max("slot").alias("last"), F.count_distinct("slot").alias("slots")).collect()
    sizes = [r["bytes"] for r in got]
    assert sum(r["n"] for r in got) == 6000 and all(r["last"] + 1 == r["slots"] == r["n"] for r in got) and max(sizes) < 1.1 * min(sizes)


def test_a_null_item_id_stays_null(spark):
    item = "the quick brown fox jumps over the lazy dog while nine small cats look on from a warm window"
    bench = spark.createDataFrame([(None, item), (-1, item), (-1, item)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "see " + item)], "doc_id long, text string")
    assert sorted((r["item_id"] is None, r["item_id"] or 0) for r in decontaminate.leaks(docs, bench).collect()) == [(False, -1), (True, 0)]


def test_changed_parameters_are_found_and_wrong_ones_are_not():
    rng, names = random.Random(4), "Alice Boris Clara Denis Elena Felix Greta Hugo Irene Jonas".split()
    nouns = "apples pears chairs books lamps stones tickets bottles".split()
    found = other = 0
    for k in range(100):
        rest = " ".join(rng.choice(("walks", "buys", "sells", "keeps", "under", "before", "slowly", "market", "winter", "letter")) for _ in range(10))
        make = lambda who, n, m, rest=rest, noun=nouns[k % 8]: f"On Monday {who} has {n} {noun} and gives {m} to a friend who {rest} then {who} counts what is left of the {n} {noun}"
        item = make(rng.choice(names), rng.randrange(10, 99), rng.randrange(1, 9))
        w = decontaminate.Windows([(1, item)], 8)
        found += bool(w.leaks("Intro text. " + make(rng.choice(names), rng.randrange(10, 99), rng.randrange(1, 9)), 13, 8))
        other += bool(w.leaks(" ".join(rng.sample(item.split(), len(item.split()))), 13, 8))
    assert found >= 90 and other == 0


def test_the_mixture_by_brute_force(spark):
    """score: each token's two estimates by plain counts, mixed with the weights that plain EM learns from the bins' ratios."""
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choices(vocab, weights=[1 / (j + 1) for j in range(30)], k=rng.randrange(1, 60)))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in ngram_lm.lm_scores(docs, block_tokens=900, slices=3).collect()}
    toks = {d: [*t.split(), None] for d, t in rows}
    kind = {d: ngram_lm.fold(d) for d, _ in rows}
    before = lambda t: ["<", *t[:-1]]
    count = lambda keep: (Counter(w for d, t in toks.items() if keep(kind[d]) for w in t), Counter(p for d, t in toks.items() if keep(kind[d]) for p in zip(before(t), t)))
    uni, two = count(lambda k: k != ngram_lm.HELD_OUT)
    uni0, two0 = count(lambda k: k == ngram_lm.TRAINING)
    n, v = sum(uni.values()), len(uni)
    follows = lambda w, two: sum(c for (a, _), c in two.items() if a == w)
    seen, seen0 = {w: follows(w, two) for w in [*vocab, "<"]}, {w: follows(w, two0) for w in [*vocab, "<"]}
    bucket = lambda c: int(np.floor(np.log2(c))) + 1 if c else 0
    counts, hist = np.zeros(ngram_lm.BUCKETS), np.zeros((ngram_lm.BUCKETS, ngram_lm.BINS))
    for d, t in toks.items():
        if kind[d] == ngram_lm.TUNING:
            for a, b in zip(before(t), t):
                k = bucket(seen0[a])
                counts[k] += 1
                if two0[a, b]:
                    ratio = np.float32(two0[a, b] / max(1, seen0[a])) / ((uni0[b] + 0.1) / (n + 0.1 * (v + 1)))
                    hist[k, int(np.clip(np.floor(np.log(ratio) / ngram_lm.BIN_WIDTH) + ngram_lm.BINS // 2, 0, ngram_lm.BINS - 1))] += 1
    weight = ngram_lm._maximise(counts, hist)
    assert counts.sum() > 0 and weight.max() > 0
    for d, t in toks.items():
        own = 0.0
        for a, b in zip(before(t), t):
            lam = weight[bucket(seen[a])]
            own += np.log10(lam * two[a, b] / max(1, seen[a]) + (1 - lam) * (uni[b] + 0.1) / (n + 0.1 * (v + 1)))
        assert abs(own - got[d]) < 1e-6 * max(1, abs(own))
