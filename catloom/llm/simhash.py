"""SimHash near-duplicates: fingerprints, BK-trees within shared bit blocks, connected components.

A fingerprint is computed from a whole text in one pass over its own partition. Fingerprints are made distinct first, so
a group of exact copies is one from here on. Two fingerprints that differ in at most 3 of 64 bits agree on at least two
of five bit blocks (of radius + 2 blocks for other radii); each of the block pairs with its bits is a bucket, and whoever may link meets in one. The members
of a bucket form BK-trees of a bounded number of nodes (children keyed by Hamming distance to the parent); a larger bucket
becomes several shard trees, and every pair of shards is searched, so that no link is lost; pairs of shards are told from
the shards' numbers and dealt to tasks one by one, so that no task holds a large bucket. The trees go to the tasks by the
shuffle rather than by a broadcast, as together they grow with the data. A search reports one link
to a root for each member that has any (union by search), never all pairs. Components then come from alternating
large-star and small-star steps, each written to the shared folder.

Defined cases: null and empty texts have fingerprint zero and link to each other; texts of one or two words use the whole
sequence; each row counts by its own text, also where doc_ids repeat; null ids keep their row and take the smallest
non-null id of their group; an empty table gives no rows. drop_near keeps one row for each group, the one whose own text
leads it, so of a repeated id with two texts that stand apart both stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloom.llm.common import free_prefix, one_each, shuffle_partitions, small_batches, steps, stored, text_of

RADIUS = 3
TREE_NODES = 2048


def blocks(radius: int) -> list[tuple[int, int]]:
    """Start and width of blocks of the 64 bits, radius + 2 or more: two of them stay whole within the radius."""
    n = max(5, radius + 2)
    if not 0 <= radius <= 62:
        raise ValueError("two blocks of a bit or more must stay whole within the radius")
    at = [-(-64 * i // n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(at, at[1:])]


def fingerprint(text: str, size: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of the word shingles of a whole text; 0 for a text without words."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six spaces only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    last = ends[min(size, len(words)) - 1 :].tolist()
    first = [0, *(ends + 1).tolist()][: len(last)]
    return majority(np.fromiter((xxh64_intdigest(joined[a:b], seed) for a, b in zip(first, last, strict=True)), np.uint64, len(last)))


def majority(h: np.ndarray) -> int:
    """The bits that more than half of the 64-bit hashes have."""
    total = np.zeros(64, np.int64)
    for i in range(0, len(h), 100_000):
        total += np.unpackbits(h[i : i + 100_000].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > len(h), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """doc_id, mark (a hash of the text) and fp (signed 64 bits) of each row."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            fp = np.fromiter((fingerprint(t, size) for t in batch["text"].to_pylist()), np.uint64, len(batch))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["mark"], pa.array(fp.view(np.int64))], ["doc_id", "mark", "fp"])

    small_batches(docs.sparkSession)
    text = text_of(docs, text_col)
    return docs.select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text")).mapInArrow(make, "doc_id long, mark long, fp long")


class BKTree:
    """Children keyed by Hamming distance to the parent; a search follows only edges within the radius of its distance."""

    def __init__(self, items: np.ndarray):
        self.items = items  # distinct
        # built level by level: all items below a node are dealt to its children by their distance
        self.edges: list[dict[int, int]] = [{} for _ in items]
        stack = [(0, np.arange(1, len(items)))] if len(items) else []
        while stack:
            node, below = stack.pop()
            if not len(below):
                continue
            apart = np.bitwise_count(items[below] ^ items[node])
            for d in np.unique(apart):
                own = below[apart == d]
                self.edges[node][int(d)] = int(own[0])
                stack.append((int(own[0]), own[1:]))

    def within(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, int]]:
        """For each node that has any: the queries at most radius apart, and the node; all queries walk the tree together."""
        stack = [(0, np.arange(len(queries)))] if len(self.items) else []
        while stack:
            node, who = stack.pop()
            apart = np.bitwise_count(queries[who] ^ self.items[node]).astype(np.int16)
            near = who[apart <= radius]
            if len(near):
                yield near, node
            for d, child in self.edges[node].items():
                on = who[np.abs(apart - d) <= radius]
                if len(on):
                    stack.append((child, on))


def _links(trees: np.ndarray, queries: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between two sets of fingerprints (or within one, given twice)."""
    both = np.unique(np.concatenate([trees, queries]))
    label = np.arange(len(both))
    a, b = np.searchsorted(both, queries), np.searchsorted(both, trees)
    out = []
    for q, node in BKTree(trees.view(np.uint64)).within(queries.view(np.uint64), radius):
        t = b[node]
        others, at = np.unique(label[a[q]], return_index=True)
        new = others != label[t]
        if new.any():
            out += [(int(both[a[q[i]]]), int(both[t])) for i in at[new]]
            label[np.isin(label, others)] = label[t]
    return out


def near_links(distinct: DataFrame, *, radius: int = RADIUS, tree_nodes: int = TREE_NODES) -> DataFrame:
    """distinct: fp. Links a < b whose transitive closure is that of all pairs at most radius bits apart."""
    own = blocks(radius)
    part = lambda i: F.call_function("shiftrightunsigned", F.col("fp"), F.lit(own[i][0])).bitwiseAND(F.lit((1 << own[i][1]) - 1))
    wide = max(w for _, w in own)
    few = (len(own) * (len(own) - 1) // 2).bit_length()
    keys = [(F.call_function("shiftleft", part(i) * (1 << wide) + part(j), F.lit(few)) + k) for k, (i, j) in enumerate(combinations(range(len(own)), 2))]
    keyed = distinct.select("fp", F.explode(F.array(*keys)).alias("key"))
    counts = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shards = keyed.join(counts, "key").withColumn("k", F.ceil(F.col("n") / tree_nodes).cast("int")).withColumn("shard", F.pmod(F.xxhash64("fp"), F.col("k")).cast("int"))
    trees = stored(shards.groupBy("key", "k", "shard").agg(F.collect_list("fp").alias("fps")), "simhash-trees")  # about tree_nodes at most
    # a bucket of one tree is searched where it lies; of larger ones each pair of shards is dealt to a task by itself
    alone = trees.where("k = 1").select(F.col("fps").alias("tree"), F.col("fps").alias("queries"))
    several = trees.where("k > 1")
    other = several.select("key", F.col("shard").alias("s"), F.explode(F.sequence("shard", F.col("k") - 1)).alias("t"))
    sides = [several.select("key", F.col("shard").alias(c), F.col("fps").alias(f)) for c, f in (("s", "tree"), ("t", "queries"))]
    dealt = other.join(sides[0], ["key", "s"]).join(sides[1], ["key", "t"]).repartition(shuffle_partitions(distinct.sparkSession), "key", "s", "t").select("tree", "queries")
    pairs = alone.unionByName(dealt)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out: list[tuple[int, int]] = []
            for tree, queries in zip(pdf["tree"], pdf["queries"], strict=True):
                if len(tree) == len(queries) == 2 and tree[0] == queries[0]:  # one tree of one edge; two trees share no member
                    if ((int(tree[0]) ^ int(tree[1])) & (2**64 - 1)).bit_count() <= radius:
                        out.append((int(tree[0]), int(tree[1])))
                else:
                    out += _links(np.sort(np.asarray(tree, np.int64)), np.sort(np.asarray(queries, np.int64)), radius)
            ab = np.array(out, np.int64).reshape(-1, 2)
            yield pd.DataFrame({"a": ab.min(axis=1), "b": ab.max(axis=1)})

    return pairs.mapInPandas(search, "a long, b long").distinct()


def components(links: DataFrame, *, tag: str = "links") -> DataFrame:
    """links: a < b. node and root (the least node it reaches) of every node in a link that is no root; alternating star steps, until they settle."""
    edges = stored(links.select("a", "b").where("a < b").distinct(), tag)
    last = None
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        # small star: each node's lesser neighbours move to the least of them
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b")
        small = small.select(F.col("m").alias("a"), F.col("a").alias("b")).where("a < b").unionByName(low.select(F.col("m").alias("a"), "b")).distinct()
        edges = stored(small, tag)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == last:
            break
        last = now
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))


def near_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 3, radius: int = RADIUS) -> DataFrame:
    """doc_id, mark, fp, root (the same within a group) and component_id (smallest doc_id of the group) of each row."""
    marks = stored(fingerprints(docs, id_col=id_col, text_col=text_col, size=size), "simhash")
    distinct = marks.groupBy("fp").agg(F.min("doc_id").alias("first"))
    links = near_links(distinct.select("fp"), radius=radius)
    roots = components(links)
    groups = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    firsts = groups.groupBy("root").agg(F.min("first").alias("component_id"))
    return marks.join(groups.select("fp", "root").join(firsts, "root").select("fp", "root", "component_id"), "fp").select("doc_id", "mark", "fp", "root", "component_id")


def near_digest(docs: DataFrame, **options) -> DataFrame:
    return near_groups(docs, **options).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def leaders(docs: DataFrame, groups: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs for each group, one with its smallest id and a text that is in it; rows without an id are kept.

    groups: doc_id, mark (hash of the text) and root of each row. Equal rows count as one.
    """
    p = free_prefix(docs, "_near_")
    lead = groups.where("doc_id is not null").groupBy("root").agg(F.min(F.struct("doc_id", "mark")).alias("lead"))
    lead = lead.select(F.col("lead.doc_id").alias(f"{p}id"), F.col("lead.mark").alias(f"{p}mark"))
    rows = docs.withColumn(f"{p}own", F.xxhash64(text_of(docs, text_col)))
    rows = rows.join(lead, (rows[id_col].cast("long") == lead[f"{p}id"]) & (rows[f"{p}own"] == lead[f"{p}mark"]), "left_semi")
    return one_each(rows, [rows[id_col], rows[f"{p}own"]], p).select(*[rows[c] for c in docs.columns]).unionByName(docs.where(docs[id_col].isNull()))


def drop_near(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The row that leads each group of near fingerprints, with docs' columns; rows without an id are kept."""
    return leaders(docs, near_groups(docs, id_col=id_col, text_col=text_col, **options), id_col=id_col, text_col=text_col)
