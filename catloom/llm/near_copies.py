"""SimHash near-dedup at a stated similarity, for the pipeline's stage: fingerprints first, then what they miss.

Two texts are near copies where the Jaccard similarity of their sets of five-word shingles (64-bit hashes) is 0.8 or
more; groups are connected components. At 0.8 about ten of 64 SimHash bits differ, too many for a search that prunes. So
the links come in steps, and each candidate is verified on the whole sets:

1. SimHash fingerprints of the sets, linked within three bits by BK-trees (``simhash.near_links``). Large groups of close
   copies are joined here.
2. A prefix index for the rest, which loses no pair: each set is put into one order that holds for all texts, and two sets
   that are alike share a shingle among the first n - ceil(0.8 n) + 1 of each. Any order finds the same pairs; shingles
   that are frequent in a sample of texts come last, so that buckets stay small. A set without a link from step 1 is held
   against the one set that tops most of its buckets; the top differs from bucket to bucket.
3. Sets in a bucket that are still not connected: all their pairs that sizes, places of the shared shingle and fingerprints
   leave possible. A bucket of more than 8 sets is cut into shards, and its pairs are told apart inside tasks, by sketches
   (one-permutation MinHash) as well: first each set's nearest, which connect most; then all that may be alike and are
   still of different components.

Sizes and places exclude no pair at 0.8. Fingerprints and sketches are estimates: a pair of long texts at 0.8 differs in more
than 24 bits about three times in a million, and then is missed unless others connect it; short ones are not told apart by
bits at all. A sketch lies six standard deviations below 0.8 less than once in a hundred million; one of a short text holds
nearly all of its shingles.

Equal sets are one from the start. A large group of near copies thus costs about its size and not its square.
Verification counts common shingles by the low 32 bits of their hashes: two that differ are taken for one once in 2^32.

Defined cases: null and empty texts are equal; texts of fewer words than a shingle are one shingle; each row counts by its
own text, also where doc_ids repeat; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catloom.llm.common import shuffle_partitions, small_batches, steps, stored, text_of
from catloom.llm.simhash import components, leaders, majority, near_links

SIZE, ALIKE = 5, (4, 5)  # similarity as a fraction
FEW, SHARD = 8, 1024  # sets of a bucket whose pairs come from a join, and of the shards that a task holds of larger ones
MANY = 1_000_000  # pairs that a task gathers before it gives them
BINS, SPREAD = 256, 6  # of a sketch; standard deviations that its estimate may lie below 0.8
WIDE = 24  # bits: at a similarity of 0.8 a bit differs with chance 0.15, more than 24 of 64 do with chance 3 in a million
LONG = 64  # shingles that both sets must have for their bits to tell anything: few shingles differ by chance in more bits
SAMPLE, FREQUENT = 20_000, 1_000_000  # texts that tell which shingles are frequent, and how many of these go to the tasks
SLOTS = 1 << 21  # of the bitmap that tells which texts are no candidates


def shingles(text: str, size: int = SIZE) -> np.ndarray:
    """The distinct 64-bit hashes of the word shingles of a whole text, ascending."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six spaces only
    if not words:
        return np.zeros(0, np.int64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    last = ends[min(size, len(words)) - 1 :].tolist()
    first = [0, *(ends + 1).tolist()][: len(last)]
    h = np.fromiter((xxh64_intdigest(joined[a:b], 42) for a, b in zip(first, last, strict=True)), np.uint64, len(last))
    return np.unique(h.view(np.int64))


def sketch(s: np.ndarray) -> bytes:
    """The low byte (at least 1) of the least hash in each of 256 equal ranges, 0 for an empty one; s: distinct, ascending."""
    edges = (np.arange(BINS) - BINS // 2) << 56
    at = np.searchsorted(s, edges)
    least = np.append(s, 0)[at]
    held = (at < len(s)) & (least >> 56 == edges >> 56)
    return np.where(held, np.maximum(least & 255, 1), 0).astype(np.uint8).tobytes()


def estimated(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The similarity that rows of sketches show, and whether 0.8 or more is possible."""
    held = ((u != 0) | (v != 0)).sum(axis=1)
    same = ((u == v) & (u != 0)).sum(axis=1)
    p = ALIKE[0] / ALIKE[1]
    return same / np.maximum(held, 1), same >= p * held - SPREAD * np.sqrt(p * (1 - p) * held)


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two sets of distinct hashes is 0.8 or more."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return ALIKE[1] * both >= ALIKE[0] * (len(a) + len(b) - both)


def _lists(arrays: list[np.ndarray], kind: type = np.int64) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, kind), *arrays])))


def _frequent(rows: DataFrame, size: int) -> np.ndarray:
    """Shingles that two texts or more of a sample hold; they come last in the order, whatever they are."""
    n = rows.count()
    some = rows.where(F.pmod(F.xxhash64("text"), F.lit(max(1, -(-n // SAMPLE)))) == 0)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            for t in batch["text"].to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingles(t, size))], ["h"])

    counts = some.select("text").mapInArrow(make, "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    got = counts.orderBy(F.desc("n"), "h").limit(FREQUENT).select("h").toArrow()["h"]
    return np.sort(got.to_numpy().astype(np.int64))


def _sets(rows: DataFrame, size: int) -> DataFrame:
    """doc_id, mark, fp (a hash of the set), n, bits (its SimHash), its sketch, and its first shingles in the order of the index."""
    from xxhash import xxh64_intdigest

    held = rows.sparkSession.sparkContext.broadcast(_frequent(rows, size))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = held.value
        for batch in steps(batches, 500):
            fps, sizes, bits, drawn, firsts = [], [], [], [], []
            for t in batch["text"].to_pylist():
                s = shingles(t, size)
                fps.append(xxh64_intdigest(s.tobytes(), 7))
                bits.append(majority(s))
                drawn.append(sketch(s))
                if len(late):
                    is_late = late[np.minimum(np.searchsorted(late, s), len(late) - 1)] == s
                    s = np.concatenate([s[~is_late], s[is_late]])
                sizes.append(len(s))
                firsts.append(s[: len(s) - -(-len(s) * ALIKE[0] // ALIKE[1]) + 1])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["mark"], pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()), pa.array(np.array(bits, np.uint64).view(np.int64)), pa.array(drawn, pa.binary()), _lists(firsts)], ["doc_id", "mark", "fp", "n", "bits", "sketch", "keys"])

    return rows.mapInArrow(make, "doc_id long, mark long, fp long, n long, bits long, sketch binary, keys array<long>")


def _verified(pairs: DataFrame, marks: DataFrame, rows: DataFrame, size: int) -> DataFrame:
    """The pairs a < b of fps whose whole sets are alike. marks: fp and the mark of a text that has it."""
    pairs = stored(pairs, "copy-pairs")
    asked = pairs.select(F.col("a").alias("fp")).unionByName(pairs.select(F.col("b").alias("fp"))).distinct()
    asked = stored(asked.join(marks.select("fp", "mark"), "fp"), "copy-asked")
    on = np.zeros(SLOTS, bool)
    on[asked.select(F.pmod("mark", F.lit(SLOTS)).alias("slot")).distinct().toArrow()["slot"].to_numpy().astype(np.int64)] = True
    held = rows.sparkSession.sparkContext.broadcast(np.packbits(on))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        may, task, seen = np.unpackbits(held.value).view(bool), TaskContext.get().partitionId(), set()
        for batch in steps(batches, 500):
            batch = batch.filter(pa.array(may[batch["mark"].to_numpy() % SLOTS]))
            new = [m not in seen and not seen.add(m) for m in batch["mark"].to_pylist()]
            batch = batch.filter(pa.array(new, pa.bool_()))
            sets = [np.unique(shingles(t, size).astype(np.int32)) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["mark"], pa.array(np.full(len(batch), task, np.int32)), _lists(sets, np.int32)], ["mark", "task", "shingles"])

    sets = rows.select("mark", "text").mapInArrow(make, "mark long, task int, shingles array<int>").join(asked, "mark").select("fp", "task", "shingles")
    sets = stored(sets, "copy-sets")
    # equal texts in several tasks: one of them, by a narrow aggregate; within a task they are one already
    one = sets.groupBy("fp").agg(F.min("task").alias("own"))
    sets = sets.join(one, "fp").where("task = own").select("fp", "shingles")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            x, y = batch["x"], batch["y"]
            ok = pa.array([alike(x[i].values.to_numpy(), y[i].values.to_numpy()) for i in range(len(batch))], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["a"].filter(ok), batch["b"].filter(ok)], ["a", "b"])

    x, y = sets.select(F.col("fp").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("fp").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(keep, "a long, b long")


def _may(x: str, y: str) -> Column:
    """Whether sets can be alike, by their sizes (n) and fingerprints (bits); x, y: how the columns of either begin."""
    n, m = F.col(f"{x}n"), F.col(f"{y}n")
    return (ALIKE[1] * F.least(n, m) >= ALIKE[0] * F.greatest(n, m)) & ((F.least(n, m) < LONG) | (F.bit_count(F.col(f"{x}bits").bitwiseXOR(F.col(f"{y}bits"))) <= WIDE))


def _possible(pairs: DataFrame, named: DataFrame) -> DataFrame:
    """The pairs (a, b) that _may allows."""
    ends = [named.select(F.col("fp").alias(c), F.col("n").alias(f"{c}_n"), F.col("bits").alias(f"{c}_bits")) for c in ("a", "b")]
    return pairs.join(ends[0], "a").join(ends[1], "b").where(_may("a_", "b_")).select(*pairs.columns)


def _places(n: Column, m: Column, i: Column, j: Column) -> Column:
    """Whether sets of n and m shingles that share the ones at places i and j can be alike.

    Two sets in one order that have o in common share one among the first n - o + 1 and m - o + 1; and at any shared shingle
    no more than min(i, j) can be common before it and min(n - i, m - j) from it on.
    """
    o = F.ceil((n + m) * ALIKE[0] / (ALIKE[0] + ALIKE[1]))
    return (i <= n - o) & (j <= m - o) & (F.least(i, j) + F.least(n - i, m - j) >= o)


def _within(members: DataFrame, nearest: bool) -> DataFrame:
    """a < b: pairs of a bucket with different roots that may be alike, all or each set's nearest, shard by shard.

    members: key, c (members of the bucket), least (the least fp of them), fp, n, bits, sketch, root, at (place of the key).
    Buckets that one passage makes mostly have the same least member, so they go to the same task, which gives a pair once.
    """
    names = ("fp", "n", "bits", "root", "at", "sketch")
    shards = members.withColumn("shard", F.pmod(F.xxhash64("fp"), F.ceil(F.col("c") / SHARD)).cast("int"))
    shards = shards.groupBy("key", "least", "shard").agg(*[F.collect_list(c).alias(c) for c in names])  # about SHARD at most
    x, y = shards.alias("x"), shards.alias("y")
    pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.shard") <= F.col("y.shard")))
    pairs = pairs.select(*[F.col(f"{t}.{c}").alias(f"{t}_{c}") for t in "xy" for c in names], F.col("x.least").alias("least"), F.col("x.shard").alias("s"), F.col("y.shard").alias("t"))
    pairs = pairs.repartition(shuffle_partitions(members.sparkSession), "least", "s", "t").sortWithinPartitions("least", "s", "t")

    def hits(row: tuple) -> np.ndarray:
        (fp, n, bits, root, i), (gp, m, cits, soot, j) = ([np.asarray(v) for v in row[k : k + 5]] for k in (0, 6))
        u, v = (np.frombuffer(b"".join(row[k]), np.uint8).reshape(-1, BINS) for k in (5, 11))
        ok = np.bitwise_count(bits.view(np.uint64)[:, None] ^ cits.view(np.uint64)[None, :]) <= WIDE
        ok |= np.minimum(n[:, None], m[None, :]) < LONG
        ok &= root[:, None] != soot[None, :]
        x, y = np.nonzero(ok)
        n, m, i, j = n[x], m[y], i[x], j[y]
        o = -(-(n + m) * ALIKE[0] // sum(ALIKE))
        may = (ALIKE[1] * np.minimum(n, m) >= ALIKE[0] * np.maximum(n, m)) & (i <= n - o) & (j <= m - o) & (np.minimum(i, j) + np.minimum(n - i, m - j) >= o)
        x, y, shown = x[may], y[may], [np.zeros(0)]
        may = [np.zeros(0, bool)]
        for k in range(0, len(x), 50_000):
            part = estimated(u[x[k : k + 50_000]], v[y[k : k + 50_000]])
            shown.append(part[0])
            may.append(part[1])
        may, shown = np.concatenate(may), np.concatenate(shown)
        x, y, shown = x[may], y[may], shown[may]
        if nearest:
            rising, best = np.argsort(shown, kind="stable"), []
            for side, size in ((x, len(fp)), (y, len(gp))):
                top = np.full(size, -1)
                top[side[rising]] = rising  # the last one stays
                best.append(top[top >= 0])
            best = np.unique(np.concatenate(best))
            x, y = x[best], y[best]
        return np.sort(np.stack([fp[x], gp[y]], axis=1), axis=1)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def made() -> pd.DataFrame:
            ab = np.unique(np.concatenate(found), axis=0)
            return pd.DataFrame({"a": ab[:, 0], "b": ab[:, 1]})

        place, found, size = None, [], 0
        for pdf in batches:
            for row in pdf.itertuples(index=False, name=None):
                if found and (row[12:] != place or size > MANY):
                    yield made()
                    found, size = [], 0
                place = row[12:]
                found.append(hits(row))
                size += len(found[-1])
        if found:
            yield made()

    return pairs.mapInPandas(search, "a long, b long")


def _open(own: DataFrame) -> DataFrame:
    """Members of buckets that hold two roots, with c (members) and least (the least fp) of the bucket."""
    found = (F.min("root").alias("lo"), F.max("root").alias("hi"), F.max("early").alias("any"), F.count("*").alias("c"), F.min("fp").alias("least"))
    return own.join(own.groupBy("key").agg(*found).where("lo <> hi and any").select("key", "c", "least"), "key")


def copy_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, few: int = FEW) -> DataFrame:
    """doc_id, mark (a hash of the text) and root (the same within a group) of each row."""
    small_batches(docs.sparkSession)
    text = text_of(docs, text_col)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("mark"))
    marks = stored(_sets(rows, size).withColumn("row", F.monotonically_increasing_id()), "copies")
    one = stored(marks.where("n > 0").groupBy("fp").agg(F.min("row").alias("row")), "copy-one")
    distinct = marks.join(one, ["fp", "row"])
    named = stored(distinct.select("fp", "mark", "n", "bits", "sketch"), "copy-named")
    pair = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    # fingerprints within three bits: each set with the first of its bits, and the first of any bits with one of a link
    own = named.select("fp", "bits")
    first = own.groupBy("bits").agg(F.min("fp").alias("first"))
    linked = near_links(first.select(F.col("bits").alias("fp"))).groupBy("b").agg(F.min("a").alias("a"))
    ends = [first.select(F.col("bits").alias(c), F.col("first").alias(f"first_{c}")) for c in ("a", "b")]
    near = linked.join(ends[0], "a").join(ends[1], "b").select(F.col("first_b").alias("fp"), F.col("first_a").alias("other"))
    near = stored(near.unionByName(own.join(first, "bits").where("fp <> first").select("fp", F.col("first").alias("other"))), "copy-near")
    # the prefix index; the top of a bucket is the set with the least fp after a turn by the key
    keyed = distinct.select("fp", F.posexplode("keys").alias("at", "key"))
    turned = F.col("fp").bitwiseXOR(F.xxhash64("key"))
    tops = keyed.groupBy("key").agg(F.count("*").alias("c"), F.min(turned).alias("top")).where("c > 1").select("key", F.col("top").bitwiseXOR(F.xxhash64("key")).alias("top"))
    shared = stored(keyed.join(tops, "key"), "copy-keys")
    stars = shared.where("fp <> top").groupBy(F.col("fp").alias("a"), F.col("top").alias("b")).agg(F.count("*").alias("c"))
    stars = _possible(stars.join(near.select(F.col("fp").alias("a")), "a", "left_anti"), named).groupBy("a").agg(F.max(F.struct("c", "b")).alias("best"))
    stars = stars.select(F.col("a").alias("fp"), F.col("best.b").alias("other"))
    tried = stored(near.unionByName(stars).select(*pair("fp", "other")).distinct(), "copy-tried")
    links = stored(_verified(tried, named, rows, size), "copy-links")
    roots = components(links)
    # what is not connected yet, in buckets that still hold two components
    own = shared.select("key", "fp", F.col("at").cast("long").alias("at")).join(named.select("fp", "n", "bits"), "fp").join(roots, F.col("fp") == F.col("node"), "left").drop("node").withColumn("root", F.coalesce("root", "fp"))
    early = F.col("at") <= F.col("n") - F.ceil(F.col("n") * 2 * ALIKE[0] / sum(ALIKE))  # where the smaller of two must have it
    own = stored(_open(own.withColumn("early", early)), "copy-open")
    x, y = own.where(F.col("c") <= few).alias("x"), own.where(F.col("c") <= few).alias("y")
    cross = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.fp") < F.col("y.fp")) & (F.col("x.root") != F.col("y.root")) & _may("x.", "y.") & _places(*[F.col(c) for c in ("x.n", "y.n", "x.at", "y.at")]))
    large, drawn = own.where(F.col("c") > few), named.select("fp", "sketch")
    cross = cross.select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b")).unionByName(_within(large.join(drawn, "fp"), nearest=True))
    cross = stored(cross.distinct().join(tried, ["a", "b"], "left_anti"), "copy-cross")
    links = stored(links.unionByName(_verified(cross, named, rows, size)), "copy-links")
    # what the nearest ones leave unconnected: all pairs that may be alike
    roots = components(links)
    large = large.drop("root", "c", "least").join(roots, F.col("fp") == F.col("node"), "left").drop("node").withColumn("root", F.coalesce("root", "fp"))
    rest = stored(_within(_open(large).join(drawn, "fp"), nearest=False), "copy-rest").distinct()
    rest = rest.join(tried, ["a", "b"], "left_anti").join(cross, ["a", "b"], "left_anti")
    roots = components(links.unionByName(_verified(rest, named, rows, size)))
    return marks.select("doc_id", "mark", "fp").join(roots, F.col("fp") == F.col("node"), "left").select("doc_id", "mark", F.coalesce("root", "fp").alias("root"))


def drop_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The row with the smallest id of each group, with docs' columns; rows without an id are kept."""
    return leaders(docs, copy_groups(docs, id_col=id_col, text_col=text_col, **options), id_col=id_col, text_col=text_col)
