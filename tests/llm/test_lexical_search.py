"""Ranked lexical search against brute force over every pair of document and item."""

import math
import random
import re
from collections import Counter

from catloom.llm import lexical_search
from catloom.llm.lexical_search import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS, ITEMS = "doc_id long, text string, term int, n long, rank int, item_id long, score long", "item_id long, text string, terms int, doc_id long"


def of(text):
    return Counter(TERM.findall((text or "").translate(LOWER)))


def brute(docs, items, top=20):
    counts = [(d, of(t)) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, all_terms = len(counts), sum(c.total() for _, c in counts)
    df = Counter(w for _, c in counts for w in c)
    merged = {}
    for i, t in set(items):
        merged.setdefault(i, Counter()).update(of(t))
    out = []
    for i, own in merged.items():
        scored = []
        for d, c in counts:
            m = 75 + 25 * c.total() * n_docs // all_terms
            s = sum(r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (1_000_000_000 * c[w] // (1000 * c[w] + 12 * m)) for w, r in own.items() if w in c)
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out += [(i, k + 1, None if null else d, -s) for k, (s, null, d) in enumerate(sorted(scored)[:top])]
    return out


def key(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, 1, 2, 3, 4, 5) for i, t in docs], DOCS).repartition(5)
    b = spark.createDataFrame([(i, t, 1, 2) for i, t in items], ITEMS)
    return key([tuple(r) for r in search(d, b, **options).collect()])


def made(n=160, seed=4):
    rng = random.Random(seed)
    vocab = ["The", "of", "naïve", "x1", "été", "ß", "rare"] + [f"w{i}" for i in range(60)]
    seps = [" ", "-", ", ", "\n", "...", "_", "\x00", "\x7f"]
    text = lambda k: "".join(rng.choice(vocab[: rng.randrange(3, len(vocab))]) + rng.choice(seps) for _ in range(k))
    docs = [(i, text(rng.randrange(0, 60))) for i in range(n)]
    docs += [(1000 + i, docs[i][1]) for i in range(40)]  # ties
    docs += [(None, docs[5][1]), (None, docs[5][1]), (3, docs[7][1]), (2000, None), (2001, ""), (2002, " -- "), (2003, "the " * 40_000 + "rare")]
    items = [(i, text(12)) for i in range(30)] + [(0, "extra w5"), (1, None), (77, ""), (78, "unknownterm"), (None, docs[5][1] or "w1"), (5, "w7"), (5, "w7")]
    return docs, items


def test_against_brute_force(spark):
    docs, items = made()
    want = key(brute(docs, items))
    assert run(spark, docs, items) == want
    assert any(r[2] is None for r in want) and any(r[0] is None for r in want)


def test_blocks_of_items_and_small_steps_give_the_same(spark, monkeypatch):
    docs, items = made(seed=9)
    want = key(brute(docs, items, top=3))
    monkeypatch.setattr(lexical_search, "CELLS", 64)
    assert run(spark, docs, items, top=3, block_entries=20, block_items=4) == want


def test_terms_are_whole_ones(spark):
    docs = [(1, "cat category concat"), (2, "category"), (3, "Cat-cat_cat"), (4, "cát cat"), (5, "")]
    got = run(spark, docs, [(0, "CAT")])
    assert got == key(brute(docs, [(0, "cat")])) and {r[2] for r in got} == {1, 3, 4}


def test_empty_tables(spark):
    assert run(spark, [], [(0, "a")]) == [] and run(spark, [(1, "a")], []) == [] and run(spark, [(1, None)], [(0, "a")]) == []
