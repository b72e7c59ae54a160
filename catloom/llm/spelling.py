"""Spelling variants by finite-state composition: near words of a vocabulary, each word's form and the root of its forms.

Words come from the texts with their numbers of occurrences, summed in the tasks first. Two words are near if one inserted,
deleted or replaced code point makes them equal. All near pairs are the paths that the composition of the vocabulary's
acceptor, a transducer of one edit and the acceptor again accepts. As long as nothing is edited both acceptors are in one
state, so the pairs are enumerated apart for each initial state, that is the words that share a part:

* A pair whose shorter word has c code points shares its first h = c // 2 ones or its last h ones. The words of each length
  c and c + 1 are dealt out by both halves, and a pair that shares the first half counts there only.
* Partitions of more than ``most`` words are dealt out again by halves of what is left of the words, until each has at
  most that many or only one code point is left in its shorter words; the alphabet bounds the latter to some thousands.
  So no task gets an unbounded group, and no pair of words that share less is looked at.
* Within a partition the rests of the words make a minimal acceptor whose states number the words below them. For each
  state, edits there are followed through pairs of states, which gives pairs of numbers once for all words that pass
  through the state; each way to the state shifts them.

A task returns for each word of a partition how many near words it has there and the best of them, not pairs. As every
pair counts in one partition only, sums over partitions are exact. Forms are followed by doubling: the number of
occurrences grows by ``ratio`` with each step, so there are at most 63 for 64-bit counts.

Defined cases: a null text has no words; a null id stands as an empty text in the hash; rows that repeat an id count each;
equal counts go by code-point order; words of any length are compared whole; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloom.llm.common import shuffle_partitions, small_batches, steps, stored, text_of

MOST = 4096  # words of a partition
HELD = 200_000  # different words that a task counts before it gives them

#: Latin-1: A-Z lower-cased, a-z and U+00C0 to U+00FF as they are, all else as blanks.
_PLAIN = bytes(b + 32 if 65 <= b < 91 else b if 97 <= b < 123 or b >= 0xC0 else 32 for b in range(256))


def occurrences(doc_id: int | None, text: str, least: int, every: int) -> Counter:
    """The words of at least so many code points of a text, as Latin-1 bytes, after the deletions that the hash asks for."""
    found = Counter(text.encode("latin-1", "replace").translate(_PLAIN).split())
    found = Counter({w: n for w, n in found.items() if len(w) >= least})
    start, plain = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()), text.isascii()
    hashes = ((w, zlib.crc32(w if plain or w.isascii() else w.decode("latin-1").encode(), start)) for w in found)
    # all that change leave before any is counted as what it became: that may be a word which the hash asks for too
    changed = [(w, found[w], h % len(w)) for w, h in hashes if h % every == 0]
    for w, _, _ in changed:
        del found[w]
    for w, n, at in changed:
        if len(w) > least:
            found[w[:at] + w[at + 1 :]] += n
    return found


def vocabulary(docs: DataFrame, *, least: int = 6, min_n: int = 5, every: int = 199, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word and n of the words with at least so many code points and occurrences."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def given() -> pa.RecordBatch:
            words = [w for w, n in held.items() if n]
            return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in words], pa.string()), pa.array([held[w] for w in words], pa.int64())], ["word", "n"])

        held = Counter()
        for batch in steps(batches):
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                for w, n in occurrences(doc_id, text, least, every).items():
                    held[w] += n
                if len(held) >= HELD:
                    yield given()
                    held.clear()
        if held:
            yield given()

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col).alias("text")).where("text <> ''")
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_n)


class Acceptor:
    """The minimal deterministic acceptor of some words, ascending and distinct.

    State s: final[s], arcs[s] (letter: next state and how many words below s come before its own), size[s] (words below).
    A state's number is larger than those of the states after it; the last one is the first to be in.
    """

    def __init__(self, words: list[str]):
        self.final, self.arcs, self.size, self.known = [], [], [], {}
        path, before = [(False, [])], ""
        for w in words:
            same = 0
            for x, y in zip(before, w, strict=False):
                if x != y:
                    break
                same += 1
            self._close(path, before, same)
            path += [(False, []) for _ in range(len(w) - same)]
            path[-1] = (True, path[-1][1])
            before = w
        self._close(path, before, 0)
        self._state(*path[0])

    def _close(self, path: list, word: str, depth: int) -> None:
        """States of the word beyond the depth can change no more: each becomes a known equal one or a new one."""
        while len(path) > depth + 1:
            at = self._state(*path.pop())
            path[-1][1].append((word[len(path) - 1], at))

    def _state(self, final: bool, arcs: list) -> int:
        key = (final, tuple(arcs))
        if key not in self.known:
            n, own = int(final), {}
            for letter, at in arcs:
                own[letter] = (at, n)
                n += self.size[at]
            self.known[key] = len(self.final)
            self.final.append(final)
            self.arcs.append(own)
            self.size.append(n)
        return self.known[key]

    def common(self, p: int, q: int) -> list[tuple[int, int]]:
        """Numbers, below p and below q, of the words that both accept."""
        out, todo = [], [(p, q, 0, 0)]
        while todo:
            p, q, i, j = todo.pop()
            if p == q:
                out += [(i + k, j + k) for k in range(self.size[p])]
                continue
            if self.final[p] and self.final[q]:
                out.append((i, j))
            a, b = self.arcs[p], self.arcs[q]
            todo += [(a[x][0], b[x][0], i + a[x][1], j + b[x][1]) for x in (a.keys() & b.keys() if a and b else ())]
        return out

    def edits(self, p: int) -> list[tuple[int, int]]:
        """Numbers below p of the pairs of words that are equal after one edit of their first letter, and differ in it."""
        own, out = self.arcs[p], []
        arcs = list(own.items())
        for k, (x, (at, i)) in enumerate(arcs):
            for _, (to, j) in arcs[k + 1 :]:  # one letter for another
                out += [(i + a, j + b) for a, b in self.common(at, to)]
            if self.final[at] and self.final[p]:  # one letter less
                out.append((i, 0))
            for y, (then, a) in self.arcs[at].items():
                if y != x and y in own:
                    out += [(i + a + c, own[y][1] + d) for c, d in self.common(then, own[y][0])]
        return out

    def near(self, apart: int = 0) -> Iterator[tuple[int, int]]:
        """The numbers of each two words that are near; apart: only those that differ in their first so many letters."""
        last = len(self.final) - 1
        ways = [[] for _ in self.final]  # to a state: the number of the first word that goes there, and the letters so far
        ways[last].append((0, 0))
        for s in range(last, -1, -1):
            if apart:
                ways[s] = [w for w in ways[s] if w[1] < apart]
            if not ways[s] or self.size[s] < 2:
                continue
            for at, i in self.arcs[s].values():
                ways[at] += [(first + i, depth + 1) for first, depth in ways[s]]
            found = self.edits(s)
            for first, _ in ways[s] if found else ():
                for i, j in found:
                    yield first + i, first + j


def near_words(words: list[str], rests: list[str], counts: list[int], size: int, apart: int) -> list[tuple[str, int, int, str]]:
    """Of a partition's words, by ascending rest: those with near ones, how many, and count and word of the best.

    size: code points of the shorter rests; two of the longer ones are another partition's pair.
    """
    number, best = [0] * len(words), [None] * len(words)
    for i, j in Acceptor(rests).near(apart):
        if len(rests[i]) > size and len(rests[j]) > size:
            continue
        for a, b in ((i, j), (j, i)):
            number[a] += 1
            rank = (-counts[b], words[b])
            if best[a] is None or rank < best[a]:
                best[a] = rank
    return [(w, n, -b[0], b[1]) for w, n, b in zip(words, number, best, strict=True) if n]


def _halves(rows: DataFrame) -> DataFrame:
    """Each row under the first and the last half of the shorter rests of its partition.

    rows: part, size (code points of the shorter rests), apart, rest, word, n.
    """
    half, rest, apart = F.floor(F.col("size") / 2).cast("int"), F.col("rest"), F.col("apart")
    cut = lambda a, n: F.substring(rest, a, n)
    part = lambda side, held: F.md5(F.concat("part", F.lit(side), held))
    first = F.struct(part("<", cut(F.lit(1), half)).alias("part"), F.when(apart > 0, apart - half).otherwise(0).alias("apart"), cut(half + 1, F.length(rest)).alias("rest"))
    last = F.struct(part(">", cut(F.length(rest) - half + 1, half)).alias("part"), half.alias("apart"), cut(F.lit(1), F.length(rest) - half).alias("rest"))
    both = F.array(F.when((apart == 0) | (apart > half), first), last)
    out = rows.select("word", "n", (F.col("size") - half).alias("size"), F.explode(F.array_compact(both)).alias("x"))
    return out.select("word", "n", "size", "x.*")


def partitions(words: DataFrame, least: int, most: int = MOST) -> DataFrame:
    """part, size, apart, rest, word, n: the partitions, each of at most so many words where halves can divide it."""
    length = F.length("word")
    rows = words.select("word", "n", F.col("word").alias("rest"), F.lit(0).alias("apart"), F.explode(F.array(length, length - 1)).alias("size")).where(F.col("size") >= least)
    rows, out = stored(_halves(rows.withColumn("part", F.col("size").cast("string"))), "spelling-parts"), None
    while True:
        full = rows.where("size > 1").groupBy("part").agg(F.count("*").alias("c")).where(F.col("c") > most).select("part")
        full = stored(full, "spelling-full")
        fit = rows.join(full, "part", "left_anti")
        out = fit if out is None else out.unionByName(fit)
        if full.isEmpty():
            return out
        rows = stored(_halves(rows.join(full, "part", "left_semi")), "spelling-parts")


def compose(parts: DataFrame) -> DataFrame:
    """word, n_near, best_n, best: of each partition."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def given() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["word", "n_near", "best_n", "best"])

        def end() -> None:
            if len(held) > 1:
                words, rests, counts = zip(*held, strict=True)
                found.extend(near_words(words, rests, counts, *place[1:]))
            held.clear()

        place, held, found = None, [], []
        for batch in steps(batches, 10_000):
            part, size, apart, rest, word, n = (batch[c].to_pylist() for c in ("part", "size", "apart", "rest", "word", "n"))
            for here, *row in zip(zip(part, size, apart, strict=True), word, rest, n, strict=True):
                if here != place:
                    end()
                    place = here
                held.append(row)
            if len(found) > 10_000:
                yield given()
                found.clear()
        end()
        if found:
            yield given()

    rows = parts.repartition(shuffle_partitions(parts.sparkSession), "part").sortWithinPartitions("part", "rest")
    return rows.select("part", "size", "apart", "rest", "word", "n").mapInArrow(search, "word string, n_near long, best_n long, best string")


def roots(forms: DataFrame) -> DataFrame:
    """word and root: forms (word, form) followed to the last; words without a form are not among the rows."""
    out = stored(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-roots")
    while not out.where("moved").isEmpty():
        step = out.select(F.col("word").alias("at"), F.col("root").alias("to"))
        out = stored(out.join(step, F.col("root") == F.col("at"), "left").select("word", F.coalesce("to", "root").alias("root"), F.col("to").isNotNull().alias("moved")), "spelling-roots")
    return out.select("word", "root")


def spelling_variants(docs: DataFrame, *, least: int = 6, min_n: int = 5, ratio: int = 5, every: int = 199, most: int = MOST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of each word of the vocabulary. least: 2 at least; ratio: above 1."""
    words = stored(vocabulary(docs, least=least, min_n=min_n, every=every, id_col=id_col, text_col=text_col), "spelling-words")
    found = compose(partitions(words, least, most))
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("least"), "best")).alias("b"))
    ok = -F.col("b.least") >= ratio * F.col("n")
    rows = words.join(found, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(ok, F.col("b.best")).alias("form"), F.when(ok, -F.col("b.least")).alias("form_n"))
    rows = stored(rows, "spelling-forms")
    return rows.join(roots(rows.where("form is not null")), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
