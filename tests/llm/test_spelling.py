"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest

from catloom.llm.spelling import Acceptor, near_words, occurrences, spelling_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, word string, n long, part string, size int, rest string"


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a != b and (a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :])


def brute(docs, least=6, min_n=5, ratio=5, every=199):
    counts = Counter()
    for d, t in docs:
        for run in RUN.findall(t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            counts[run if h % every else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least and n >= min_n}
    links = {w: [] for w in words}
    for a, b in combinations(words, 2):
        if abs(len(a) - len(b)) < 2 and near(a, b):
            links[a].append(b)
            links[b].append(a)
    form = {}
    for w, own in links.items():
        if own:
            best = min(own, key=lambda x: (-words[x], x))
            if words[best] >= ratio * words[w]:
                form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(links[w]), words.get(form.get(w))))
    return sorted(out)


def run(spark, docs, parts=4, **options):
    df = spark.createDataFrame([(d, t, "w", 1, "p", 2, "r") for d, t in docs], SCHEMA).repartition(parts)
    return sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in spelling_variants(df, **options).collect())


def made(seed, letters="ab", n=120):
    rng = random.Random(seed)
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(4, 10))) for _ in range(160)] + ["straße", "Straßen", "STRASSE", "naïvety", "naivety", "×÷×÷×÷", "a" * 300, "a" * 301]
    weigh = [1 / (1 + i % 40) ** 1.5 for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, weigh, k=rng.randrange(80))).replace("b ", "B, ")) for i in range(n)]
    return docs + [(None, "abababab " * 30), (3, "abababaa " * 4), (3, "abababaa " * 4), (500, None), (501, ""), (502, "日本語 Ωmega ababab'baba")]


@pytest.mark.parametrize("most", [4096, 3])
def test_against_brute_force(spark, most):
    docs = made(most)
    want = brute(docs, every=7, ratio=2)
    assert len(want) > 30 and any(r[2] not in (r[0], r[1]) for r in want)  # forms of forms
    assert run(spark, docs, most=most, every=7, ratio=2) == want


def test_hot_words_and_other_alphabets(spark):
    docs = made(5, "abcé", 60) + [(1000 + i, "hotword " * 200 + "hotwort") for i in range(30)]
    assert run(spark, docs, parts=9) == brute(docs)
    assert run(spark, docs, least=4, min_n=2, ratio=2, most=2) == brute(docs, least=4, min_n=2, ratio=2)


def test_composition_gives_each_pair_once():
    rng = random.Random(1)
    for r in range(200):
        words = sorted({"".join(rng.choice("ab" if r % 3 else "abcdé") for _ in range(rng.randrange(8))) for _ in range(rng.randrange(1, 80))})
        want = {(i, j) for i, j in combinations(range(len(words)), 2) if near(words[i], words[j])}
        got = [tuple(sorted(p)) for p in Acceptor(words).near()]
        assert len(got) == len(want) and set(got) == want
        first = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert sorted(tuple(sorted(p)) for p in Acceptor(words).near(2)) == sorted((i, j) for i, j in want if first(words[i], words[j]) < 2)
    assert near_words(["aab", "ab"], ["aab", "ab"], [5, 9], 2, 0) == [("aab", 1, 9, "ab"), ("ab", 1, 5, "aab")]


def test_empty(spark):
    assert run(spark, []) == [] and run(spark, [(1, "short"), (2, None)]) == [] and run(spark, [(1, "lonely word " * 9)]) == brute([(1, "lonely word " * 9)])


def test_a_changed_run_is_not_changed_again(spark):
    """Of one text, a run whose hash asks for a deletion and what it becomes, which the hash asks for too, in either order."""
    chain = lambda d, every: [(r, s) for r in ("a" * k for k in range(8, 40)) for s in (r[1:],) if not any(zlib.crc32(f"{d}:{x}".encode()) % every for x in (r, s))]
    d, (long, short) = next((d, c[0]) for d in range(100_000) if (c := chain(d, 199)))
    docs = [(d, f"{long} {short} " * 6)]
    assert dict(+occurrences(*docs[0], 6, 199)) == {short.encode(): 6, short[1:].encode(): 6}
    assert run(spark, docs) == brute(docs) and run(spark, [(d, f"{short} {long} " * 6)]) == brute(docs)
    rng = random.Random(4)
    texts = [(i, " ".join("".join(rng.choice("aé") for _ in range(rng.randrange(4, 10))) for _ in range(200))) for i in range(40)]
    assert run(spark, texts, every=3) == brute(texts, every=3)
