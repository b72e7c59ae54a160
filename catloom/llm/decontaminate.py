"""Benchmark decontamination by template canonicalisation.

Words become template tokens: numbers, units and names (capitalised words inside a sentence) turn into typed
placeholders, all others into their lower-cased letters. Windows of ``window`` tokens of the benchmark are hashed; a
document's windows are looked up in them where the document lies. Matched windows on one diagonal (same offset between
document and item) are aligned. Each value that the item has in a slot stands for the one that most of its places on the
diagonal have in the document; windows that hold another are dropped, and all windows with the slot where no value has
more than half of its places. An item leaks into a document when the windows that are left cover enough of its tokens.

Whether a capitalised word starts a sentence depends on the text and line breaks before it. An item's windows are
therefore looked up with such words under either code; under the other one the word itself must be the same.

The benchmark goes to the tasks in blocks of about ``block_windows`` windows (counted with those under the other code), each searched in all documents; a usual
benchmark is one block. Items that are equal in id and text are one; items are dealt to blocks by a hash.

Defined cases: null and empty texts match nothing; an item with a null id is reported with a null id; an item with fewer tokens than a window is one window of its own
length; items of placeholders alone match where all of them stand in a row with equal values; items without tokens match
nothing; repeated rows and null ids are each reported; ties do not arise, as every
pair that leaks is returned; empty tables give no rows.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloom.llm.common import small_batches, steps, text_of

_TOKENS = re.compile(r"\n|[^\x20\x09-\x0D]+")
_NUMBER = re.compile(r"[+-]?\d[\d.,:/]*")
_NUMBER_UNIT = re.compile(r"([+-]?\d[\d.,]*)(%|[^\W\d_]+)")
_EDGES = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127), 0xA1, 0xAB, 0xBB, 0xBF, 0x2018, 0x2019, 0x201C, 0x201D, 0x2026]))
UNITS = frozenset("mm cm m km in ft yd mi mg g kg t lb oz ml cl l s sec min h hr hrs hour hours day days week weeks month months year years minute minutes second seconds metre metres meter meters mile miles gram grams kilogram kilograms litre litres liter liters dollar dollars euro euros cent cents percent usd eur mph kmh w kw j kj pa k hz".split())
NUM, UNIT, NAME, NUM_UNIT = range(1, 5)  # token codes of the placeholders
_MASK = (1 << 64) - 1
_known: dict[str, tuple[int, int, str, bool]] = {}


def _literal(core: str) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(core.encode("utf-8", "surrogatepass"), 7) | 16


def token(word: str) -> tuple[int, int, str, bool]:
    """Code inside a sentence, code at its start (0: no token), the value without edges, and whether it ends a sentence."""
    got = _known.get(word)
    if got is None:
        core = word.strip(_EDGES)
        lower = core.lower()
        ends = word.rstrip("\"')]}»”’")[-1:] in (".", "!", "?", ":")
        if not core:
            got = (0, 0, "", ends)
        elif _NUMBER.fullmatch(core):
            got = (NUM, NUM, core, ends)
        elif (m := _NUMBER_UNIT.fullmatch(core)) and (m[2] == "%" or m[2].lower() in UNITS):
            got = (NUM_UNIT, NUM_UNIT, lower, ends)
        elif lower in UNITS and len(lower) > 1:
            got = (UNIT, UNIT, lower, ends)
        else:
            code = _literal(lower)
            got = (NAME if len(core) > 1 and core[0].isupper() and core[1:].islower() else code, code, lower, ends)
        if len(_known) > 500_000:
            _known.clear()
        _known[word] = got
    return got


def template(text: str, flip: bool = False) -> tuple[np.ndarray, list[str]]:
    """Token codes and values of a whole text; flip: codes as if starts of sentences were inside and the others starts."""
    codes, values, start = [], [], True
    for word in _TOKENS.findall(text):
        if word == "\n":
            start = True
            continue
        inside, first, value, ends = _known.get(word) or token(word)
        if inside:
            codes.append(first if start is not flip else inside)
            values.append(value)
            start = ends
        elif ends:
            start = True
    return np.array(codes, np.uint64), values


def windows(codes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of size tokens; of each column, where codes has two dimensions."""
    n = len(codes) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    h = np.zeros((n, *codes.shape[1:]), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            h = (h ^ codes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
    return h


def either(codes: np.ndarray, other: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of all windows in which one token or more has its other code."""
    rows, places = [], []
    differs = np.flatnonzero(codes != other).tolist()
    for p in sorted({p for x in differs for p in range(max(0, x - size + 1), min(x, len(codes) - size) + 1)}):
        at = [x - p for x in differs if p <= x < p + size]
        for n in range(1, len(at) + 1):
            for some in combinations(at, n):
                row = codes[p : p + size].copy()
                row[list(some)] = other[p : p + size][list(some)]
                rows.append(row)
                places.append(p)
    h = windows(np.array(rows, np.uint64).T, size)[0] if rows else np.zeros(0, np.uint64)
    return h, np.array(places, np.int64)


def _covered(at: np.ndarray, size: int) -> np.ndarray:
    """The tokens that windows of size tokens cover, from the places where they start."""
    own = np.zeros(len(at), bool)
    for x in np.flatnonzero(at).tolist():
        own[x : x + size] = True
    return own


class Windows:
    """The windows of a block of items, by size: sorted hashes with item and position."""

    def __init__(self, items: list[tuple[int | None, str]], window: int):
        self.ids = [i for i, _ in items]
        self.codes, self.values = zip(*[template(t) for _, t in items], strict=True) if items else ((), ())
        self.other = [template(t, flip=True)[0] for _, t in items]
        found: dict[int, list] = defaultdict(list)
        for k, codes in enumerate(self.codes):
            if len(codes):
                h = windows(codes, size := min(window, len(codes)))
                found[size].append((h, np.full(len(h), k), np.arange(len(h))))
                h, at = either(codes, self.other[k], size)
                found[size].append((h, np.full(len(h), k), at))
        self.by_size = {}
        for size, parts in found.items():
            h, k, q = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(h, kind="stable")
            self.by_size[size] = (h[order], k[order], q[order])
        self.n = sum(len(h) for h, _, _ in self.by_size.values())

    def leaks(self, text: str, least: int, literal: int) -> list[tuple[int | None, int, int, int]]:
        """item, tokens covered, tokens of the item and slots, of each item that leaks into a text."""
        codes, values = template(text)
        starts: dict[tuple[int, int], tuple[int, np.ndarray]] = {}
        for size, (h, k, q) in self.by_size.items():
            own = windows(codes, size)
            if not len(own):
                continue
            at = np.searchsorted(h, own)
            hits = np.flatnonzero(h[np.minimum(at, len(h) - 1)] == own)
            for p in hits.tolist():
                j = int(at[p])
                while j < len(h) and h[j] == own[p]:
                    item, pos = int(k[j]), int(q[j])
                    if self._same(item, pos, codes, values, p, size):
                        key = (item, p - pos)
                        if key not in starts:
                            starts[key] = (size, np.zeros(len(self.codes[item]), bool))
                        starts[key][1][pos] = True
                    j += 1
        union: dict[int, np.ndarray] = {}
        for (item, shift), (size, at) in starts.items():
            if (self.codes[item] > 15).any():
                own = self._consistent(item, shift, size, at, values)
            else:  # placeholders alone: the item as it is, or nothing
                own = _covered(at, size)
                own &= own.all() and values[shift : shift + len(own)] == self.values[item]
            union[item] = union[item] | own if item in union else own
        out = []
        for item, own in union.items():
            n, plain = int(own.sum()), int((own & (self.codes[item] > 15)).sum())
            if n >= min(least, len(own)) and plain >= min(literal, int((self.codes[item] > 15).sum())) and n:
                out.append((self.ids[item], n, len(own), int((self.codes[item] <= 15).sum())))
        return out

    def _same(self, item: int, pos: int, codes: np.ndarray, values: list[str], p: int, size: int) -> bool:
        """Whether the window at p of a text is the item's at pos; a token with its other code must be the same word."""
        got = codes[p : p + size]
        return all(got[x] == self.other[item][pos + x] and values[p + x] == self.values[item][pos + x] for x in np.flatnonzero(got != self.codes[item][pos : pos + size]).tolist())

    def _consistent(self, item: int, shift: int, size: int, at: np.ndarray, values: list[str]) -> np.ndarray:
        """The item's tokens that windows at these places cover, without windows whose slots do not agree."""
        codes, mine = self.codes[item], self.values[item]
        slots: dict[tuple[int, str], list[int]] = defaultdict(list)
        for x in np.flatnonzero(_covered(at, size) & (codes <= 15)).tolist():
            slots[int(codes[x]), mine[x]].append(x)
        for places in slots.values():
            found = Counter(values[x + shift] for x in places)
            if len(found) > 1:
                most, n = found.most_common(1)[0]
                for x in places:
                    if 2 * n <= len(places) or values[x + shift] != most:
                        at[max(0, x - size + 1) : x + 1] = False
        return _covered(at, size)


def _blocks(benchmark: DataFrame, window: int, block_windows: int, item_col: str, item_text_col: str) -> Iterator:
    """Broadcasts of the benchmark's windows, about block_windows in each."""
    spark = benchmark.sparkSession
    small_batches(spark)
    items = benchmark.select(benchmark[item_col].cast("long").alias("item_id"), text_of(benchmark, item_text_col).alias("text")).where("text <> ''").distinct()
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            yield pa.RecordBatch.from_arrays([pa.array([Windows([(None, t)], window).n for t in batch["text"].to_pylist()], pa.int64())], ["n"])

    made = items.select("text").mapInArrow(count, "n long").agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-made // block_windows))
    for b in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        yield spark.sparkContext.broadcast(Windows(sorted(((r["item_id"], r["text"]) for r in own), key=lambda x: (x[0] is None, x[0] or 0, x[1])), window))


def leaks(docs: DataFrame, benchmark: DataFrame, *, window: int = 8, least: int = 13, literal: int = 8, block_windows: int = 1_000_000, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, item_id, covered, n_tokens and n_slots of every document and benchmark item that leaks into it.

    least: tokens to be covered (or the whole item, if shorter); literal: how many of them must not be placeholders.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col).alias("text"))
    out = None
    for held in _blocks(benchmark, window, block_windows, item_col, item_text_col):

        def find(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in steps(batches):
                got = [(d, *x) for d, t in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True) for x in held.value.leaks(t, least, literal)]
                cols = list(zip(*got, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "item_id", "covered", "n_tokens", "n_slots"])

        part = rows.mapInArrow(find, "doc_id long, item_id long, covered long, n_tokens long, n_slots long")
        out = part if out is None else out.unionByName(part)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, *, window: int = 8, least: int = 13, literal: int = 8, block_windows: int = 1_000_000, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """docs without the rows that an item leaks into; each row is judged by its own text, where it lies."""
    for held in _blocks(benchmark, window, block_windows, item_col, item_text_col):

        def clean(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in steps(batches):
                yield batch.filter(pa.array([not (t and held.value.leaks(t, least, literal)) for t in batch[text_col].to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
