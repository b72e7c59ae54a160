"""Ranked lexical search without a document index: an Aho-Corasick scan of the texts for the items' terms.

A term is a maximal run of ASCII letters, digits and characters beyond ASCII, with only A-Z lower-cased. The terms of all
items make one automaton; each is guarded by a separator on both sides, and texts have all separators as one character, so
that a term is found only where it is a whole one, and the occurrences of each term are counted straight from the text.
The automaton's outputs are term numbers, and a table maps these to items and their repeats.

The texts are scanned once for each block of items, where they lie: a document leaves its length and the counts of the
terms found in it (written to the shared folder). From these come N, L and the document frequencies, by sums of small
rows; then every document is scored for all items at once, again where it lies, and each task keeps the best ``top`` of
each item (with equal scores the smaller ids). The last step ranks what the tasks kept, in two steps so that no task gets
the rows of all.

What is broadcast is a block of items: their terms and postings, at most ``block_entries`` pairs of item and term and
``block_items`` items (an item with more terms than that is a block of its own). More items take more passes.

Defined cases: a null or empty text has no terms, is not counted in N and is in no result; an item with a null or empty
text has no rows; several rows of an item_id are one item with the terms of all its different texts, null being an id like
any other; rows of documents that repeat an id rank each by itself, null ids after all others at equal scores; fewer
documents with a score above 0 than ``top`` are all returned; empty tables give no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catloom.llm.common import small_batches, steps, stored, text_of

TOP = 20
CELLS = 1 << 20  # scores of documents and items that a task holds at a time
SALT = 64  # parts that the kept rows of an item are ranked in before the last step

#: Bytes of UTF-8: A-Z lower-cased, other ASCII characters that are no digit or letter as blanks.
_PLAIN = bytes(b + 32 if 65 <= b < 91 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text (UTF-8), in order."""
    return text.translate(_PLAIN).split()


@dataclass
class Block:
    """Some items: their ids, the terms of all of them, and for each term the items that hold it and how often."""

    ids: list[int | None]
    words: list[bytes]
    starts: np.ndarray  # of each term's part in the two arrays below, and their end
    items: np.ndarray
    repeats: np.ndarray

    @staticmethod
    def of(items: list[tuple[int | None, Counter]]) -> Block:
        words = sorted({w for _, own in items for w in own})
        at = {w: i for i, w in enumerate(words)}
        rows = np.array(sorted((at[w], k, n) for k, (_, own) in enumerate(items) for w, n in own.items()), np.int64).reshape(-1, 3)
        return Block([i for i, _ in items], words, np.searchsorted(rows[:, 0], np.arange(len(words) + 1)), rows[:, 1], rows[:, 2])

    def automaton(self):
        """Guarded terms; the automaton works on characters, so each byte stands as one."""
        import ahocorasick

        made = ahocorasick.Automaton()
        for i, w in enumerate(self.words):
            made.add_word(f" {w.decode('latin-1')} ", i)
        made.make_automaton()
        return made

    def scores(self, rows: np.ndarray, found: np.ndarray, gain: np.ndarray, n: int) -> np.ndarray:
        """n documents by items: for each term found in a row, its gain for every item that holds the term."""
        size = self.starts[found + 1] - self.starts[found]
        part = np.repeat(self.starts[found] - np.cumsum(size) + size, size) + np.arange(size.sum())
        out = np.zeros(n * len(self.ids), np.int64)
        np.add.at(out, np.repeat(rows, size) * len(self.ids) + self.items[part], np.repeat(gain, size) * self.repeats[part])
        return out.reshape(n, len(self.ids))


def blocks(items: DataFrame, block_entries: int, block_items: int, item_col: str, text_col: str) -> Iterator[Block]:
    """The items by ascending id in blocks; the driver holds one block at a time."""
    rows = items.select(items[item_col].cast("long").alias("item_id"), text_of(items, text_col).alias("text")).where("text <> ''").distinct()
    held, entries, last = [], 0, object()
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        own = Counter(terms(row["text"].encode("utf-8", "surrogatepass")))
        if not own:
            continue
        if row["item_id"] == last:  # another text of the same item
            before = len(held[-1][1])
            held[-1][1].update(own)
            entries += len(held[-1][1]) - before
            continue
        if held and (entries + len(own) > block_entries or len(held) >= block_items):
            yield Block.of(held)
            held, entries = [], 0
        held.append((row["item_id"], own))
        entries, last = entries + len(own), row["item_id"]
    if held:
        yield Block.of(held)


def counted(rows: DataFrame, held) -> DataFrame:
    """doc_id, n (terms of the text) and the block's terms in it with their occurrences; rows: doc_id, text; held: a Block."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = held.value.automaton()
        for batch in steps(batches):
            sizes, which, often = [], [], []
            for text in batch["text"].cast(pa.binary()):
                plain = text.as_py().translate(_PLAIN)
                sizes.append(len(plain.split()))
                found = np.fromiter((i for _, i in automaton.iter(f" {plain.decode('latin-1')} ")), np.int32)
                found, n = np.unique(found, return_counts=True)
                which.append(found)
                often.append(n)
            ends = pa.array(np.cumsum([0, *map(len, which)]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x).astype(t))) for x, t in ((which, np.int32), (often, np.int64))]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "tf"])

    return rows.mapInArrow(scan, "doc_id long, n long, terms array<int>, tf array<long>")


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)


def best(item: np.ndarray, score: np.ndarray, doc: np.ndarray, null: np.ndarray, top: int) -> np.ndarray:
    """Which rows are among the top of their item."""
    order = np.lexsort((doc, null, -score, item))
    first = np.searchsorted(item[order], item[order])
    return order[np.arange(len(order)) - first < top]


def ranked(counts: DataFrame, held, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """item (its place in the block), doc_id, score: what each task keeps; held: a Block and the weights of its terms."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, w = held.value
        least = np.ones(len(block.ids), np.int64)  # a score that a row must have to be among the best so far
        kept = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)]
        for batch in steps(batches, max(1, CELLS // len(block.ids))):
            n = batch["n"].to_numpy().astype(np.int64)
            found, tf = (batch[c].flatten().to_numpy().astype(np.int64) for c in ("terms", "tf"))
            rows = np.repeat(np.arange(len(batch)), np.diff(batch["terms"].offsets.to_numpy()))
            m = 75 + 25 * n * n_docs // n_terms
            gain = w[found] * (1_000_000_000 * tf // (1000 * tf + 12 * m[rows]))
            scores = block.scores(rows, found, gain, len(batch))
            at, item = np.nonzero(scores >= least)
            null = batch["doc_id"].is_null().to_numpy(zero_copy_only=False)
            doc = batch["doc_id"].fill_null(0).to_numpy()
            more = (item, scores[at, item], doc[at], null[at])
            kept = [np.concatenate(x) for x in zip(kept, more, strict=True)]
            keep = best(*kept, top)
            kept = [x[keep] for x in kept]
            full = np.flatnonzero(np.bincount(kept[0], minlength=len(least)) == top)
            least[full] = kept[1][np.searchsorted(kept[0], full, side="right") - 1]
        item, score, doc, null = kept
        if len(item):
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc, mask=null), pa.array(score)], ["item", "doc_id", "score"])

    return counts.where("n > 0").mapInArrow(search, "item int, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, *, top: int = TOP, block_entries: int = 200_000, block_items: int = 4096, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the top documents of each item."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col).alias("text"))
    out = None
    for block in blocks(items, block_entries, block_items, item_col, item_text_col):
        counts = stored(counted(rows, spark.sparkContext.broadcast(block)), "term-counts")
        n_docs, n_terms = counts.where("n > 0").agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            continue
        own = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow()  # a row for each term of the block
        df = np.zeros(len(block.words), np.int64)
        df[own["term"].to_numpy()] = own["df"].to_numpy()
        kept = ranked(counts, spark.sparkContext.broadcast((block, weights(n_docs, df))), n_docs, n_terms, top)
        order = (F.desc("score"), F.col("doc_id").isNull(), "doc_id")
        salted = kept.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALT))).withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order)))
        salted = salted.where(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
        names = spark.createDataFrame([(k, i) for k, i in enumerate(block.ids)], "item int, item_id long")
        part = salted.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")  # at most block_items rows
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out
