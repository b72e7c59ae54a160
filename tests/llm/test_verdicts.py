"""Verdicts over whole given tables, each worked out again the plain way: rules, scores, shards and slots, slots of items."""

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from catloom.llm import decontaminate, factorisation, hilbert, quality_rules, simhash
from catloom.llm.common import WORD

SF = "/root/testdata/sf0.001"


def given(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def ratios(t):
    words = re.findall(WORD, t)
    chars, n = sum(map(len, words)), max(1, len(words))
    lines = [x for x in t.split("\n") if re.search(WORD, x)]
    w = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    held = Counter(w)
    repeated = {j for i, x in enumerate(w) if held[x] > 1 for j in range(i, i + 8)}
    letters = [x for x in words if any(c.isalpha() for c in x)]
    return {
        "n_words": len(words), "symbol_ratio": len(re.findall(r"[#*$%&|<>]", t)) / max(1, chars), "upper_ratio": sum("A" <= c <= "Z" or "À" <= c <= "Þ" and c != "×" for c in t) / max(1, chars),
        "repeat_ratio": len(repeated) / n, "distinct_ratio": len(set(words)) / n, "dup_line_ratio": (len(lines) - len(set(lines))) / max(1, len(lines)), "word_length": chars / n,
        "short_ratio": sum(len(x) <= 3 for x in words) / n, "alpha_ratio": len(letters) / n,
    }


def test_kept_is_what_the_list_says(spark):
    docs, labels = (given(spark, n, "/root/testdata/sf0.01") for n in ("documents", "labels"))
    rules = quality_rules.learn(docs, labels)
    assert rules
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    seen = Counter()
    for r in quality_rules.quality_digest(docs, labels).collect():
        x = ratios(texts[r["doc_id"]])
        hit = next((k for k, rule in enumerate(rules, 1) if all((x[t.feature] >= t.threshold) == t.at_least for t in rule)), 0)
        assert (r["rule"], r["kept"]) == (hit, not r["base_failed"] and hit == 0)
        seen[bool(hit)] += 1
    assert len(seen) == 2


def test_scores_of_a_table_are_sums_over_pairs(spark):
    docs, labels = given(spark, "documents"), given(spark, "labels")
    model = factorisation.fit(docs, labels)
    got = {r["doc_id"]: r["score"] for r in factorisation.classify_digest(docs, labels).collect()}
    for r in docs.collect():
        slots, x, stats = factorisation.raw_features(r["text"] or "")
        i, x = np.concatenate([slots, model.bins(stats)]), np.concatenate([x, np.full(factorisation.N_STATS, 0.35)]).astype(np.float64)
        vx = model.v[i].astype(np.float64) * x[:, None]
        z = model.w0 + float(model.w[i] @ x) + float(np.triu(vx @ vx.T, 1).sum())
        assert abs(got[r["doc_id"]] - 1 / (1 + math.exp(-max(-30, min(30, z))))) < 1e-3


def curve_at(point, bits):
    """Index of a point on the curve, one level at a time, in whole numbers."""
    n = len(point)
    entry, way, inverse = hilbert.curve_tables(n)
    mask, h, e, d = (1 << n) - 1, 0, 0, 0
    right = lambda x, k: (x >> k | x << (n - k)) & mask
    left = lambda x, k: (x << k | x >> (n - k)) & mask
    for level in reversed(range(bits)):
        corner = sum((p >> level & 1) << i for i, p in enumerate(point))
        w = inverse[right(corner ^ e, (d + 1) % n)]
        h, e, d = h << n | w, e ^ left(entry[w], (d + 1) % n), (d + way[w] + 1) % n
    return h


@pytest.mark.parametrize("options", [{}, {"hot": 2}, {"hot": 20, "many_rows": 2, "parts": 7}, {"hot": 20, "many_bytes": 9000, "shards": 5}])
def test_shards_and_slots_follow_the_curve(spark, options):
    docs = given(spark, "documents")
    docs = docs.unionByName(docs.where("doc_id % 9 = 0").withColumn("doc_id", F.col("doc_id") + 100_000)).unionByName(docs.where("doc_id = 5").withColumn("doc_id", F.explode(F.sequence(F.lit(200_000), F.lit(200_029)))))
    shards, parts = options.get("shards", 8), options.get("parts", 256)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).alias("size"), F.crc32(text.cast("binary")).alias("crc"), F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), text).alias("h2"), F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(parts)).alias("deal"), "source", "lang").collect()
    groups = defaultdict(list)
    for r in rows:
        groups[r["h"], r["h2"]].append(r)
    code = lambda s: int.from_bytes((s or "").encode()[:7].ljust(7, b"\0"), "big")
    dims = {g: (own[0]["size"], min(code(r["source"]) for r in own), min(code(r["lang"]) for r in own)) for g, own in groups.items()}

    def rank(k, v):
        held = sorted(d[k] for d in dims.values())
        cuts = sorted({held[max(0, math.ceil(q / 32 * len(held)) - 1)] for q in range(1, 32)})
        return min(31, bisect_left(cuts, v))

    total, n_rows, units = sum(r["size"] for r in rows), len(rows), defaultdict(list)
    for g, own in groups.items():
        at = curve_at([rank(k, v) for k, v in enumerate(dims[g])], 5)
        large = sum(r["size"] for r in own) > min(total / (4 * shards), options.get("many_bytes", 1 << 30)) or len(own) > min(n_rows / (4 * shards), options.get("many_rows", 10**6))
        for r in own:
            units[at, g[0] % parts, *g, r["deal"] if large else 0].append(r)
    want, before, slots = set(), 0, Counter()
    for unit in sorted(units):
        own = sorted(units[unit], key=lambda r: (r["doc_id"], r["crc"]))
        size = sum(r["size"] for r in own)
        shard = min(shards - 1, int((before + size / 2) * shards / total))
        for r in own:
            want.add((r["doc_id"], unit[0], shard, slots[shard]))
            slots[shard] += 1
        before += size
    got = hilbert.hilbert_shards(docs, **options).collect()
    assert len(got) == len(rows) and {(r["doc_id"], r["curve"], r["shard"], r["slot"]) for r in got} == want


def plain_leaks(text, item, window=8, least=13, literal=8):
    """Whether an item leaks into a text: windows compared token by token, values of a slot counted."""
    (codes, values), flipped = decontaminate.template(text), decontaminate.template(item, flip=True)[0].tolist()
    own, mine = decontaminate.template(item)
    codes, own = codes.tolist(), own.tolist()
    size = min(window, len(own))
    if not size:
        return False
    same = lambda p, q: codes[p] == own[q] or codes[p] == flipped[q] and values[p] == mine[q]
    held = set()
    for shift in range(-len(own), len(codes)):
        places = [q for q in range(len(own) - size + 1) if 0 <= shift + q <= len(codes) - size and all(same(shift + q + i, q + i) for i in range(size))]
        if not places:
            continue
        cover = lambda starts: {q + i for q in starts for i in range(size)}
        if all(c <= 15 for c in own):
            if cover(places) == set(range(len(own))) and [values[shift + x] for x in range(len(own))] == mine:
                held |= cover(places)
            continue
        slots = defaultdict(list)
        for x in sorted(cover(places)):
            if own[x] <= 15:
                slots[own[x], mine[x]].append(x)
        bad = set()
        for xs in slots.values():
            (top, n), *others = Counter(values[shift + x] for x in xs).most_common()
            if others:
                bad |= {x for x in xs if 2 * n <= len(xs) or values[shift + x] != top}
        held |= cover([q for q in places if not bad & set(range(q, q + size))])
    plain = sum(own[x] > 15 for x in held)
    return bool(held) and len(held) >= min(least, len(own)) and plain >= min(literal, sum(c > 15 for c in own))


def test_items_of_the_table_with_other_values(spark):
    bench = given(spark, "benchmark").limit(12)
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    base = [(r["doc_id"], (r["text"] or "")[:600]) for r in given(spark, "documents").orderBy("doc_id").limit(40).collect()]
    rows = list(base)
    for k, (i, item) in enumerate(items):
        numbers = sorted(set(re.findall(r"\d+", item)))
        other = re.sub(r"\d+", lambda m, n=numbers: str(700 + 3 * n.index(m[0])), item)  # one new value for each old one
        mixed = re.sub(r"\d+", lambda m, c=iter(range(400, 900)): str(next(c)), item)  # one for each place
        half = " ".join(item.split()[: len(item.split()) // 2])
        rows += [(10_000 + 10 * k + j, f"{base[k][1]} {x} {base[k + 1][1]}") for j, x in enumerate((item, other, mixed, half, item.lower()))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench).collect()}
    assert got == {(d, i) for d, t in rows for i, item in items if plain_leaks(t, item)}
    assert {(10_000 + 10 * k + j, i) for k, (i, _) in enumerate(items) for j in (0, 1)} <= got


@pytest.mark.parametrize("nodes", [2, 20])
def test_pairs_of_shards_of_a_hot_bucket_are_dealt_out(spark, nodes):
    rng = np.random.default_rng(3)
    low = rng.integers(0, 1 << 38, 400)  # the first two blocks of 13 bits are equal: one bucket holds all
    fps = sorted({int(x << 26) for x in low} | {int(x << 26) ^ (1 << 30) for x in low[::5]})
    fps = [f - (1 << 64) if f >= 1 << 63 else f for f in fps]
    links = simhash.near_links(spark.createDataFrame([(f,) for f in fps], "fp long"), tree_nodes=nodes)
    near = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    got = {(r["a"], r["b"]) for r in links.collect()}
    assert got <= near and len(near) >= 80
    root = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    assert all(root.get(a, a) == root.get(b, b) for a, b in near)
