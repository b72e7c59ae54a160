"""Exact substring deduplication: removes every byte that a string of ``length`` bytes covers which also starts elsewhere.

Equal strings must meet in one shard. The leftmost k-gram of least hash inside a string depends on the string alone, so
each start position of a document has one anchor, consecutive starts with the same anchor form a run, and the anchor's
hash says where the run goes. Runs whose anchor hash occurs once in the corpus hold no repeat and go no further. The
pieces of text under the other runs (a run's starts plus length - 1 bytes) are made distinct with their number; a piece
that occurs twice is repeated as a whole. Where an anchor has several different pieces, its shard sorts the suffixes of
those pieces (Larsson-Sadakane refinement in numpy: ranks by twice the prefix, only where groups are not yet single),
takes common prefixes of neighbours as Kasai does, all pieces in step, and marks the starts with a common prefix of
length bytes. The pieces of an anchor with more than ``shard_pieces`` of them are spread over several shards; each reports
128-bit digests of its distinct strings, and strings that two shards hold are found by a join on the digests: Spark sorts
both sides by digest and merges them. (A binary search of each shard in each other one would grow with the square of
their number.)

A document is known by two hashes of its id and text, rid and rid2; only the first travels with its pieces. Where two
documents share it, each keeps to the pieces that it has.

Defined cases: null and empty texts have no bytes; repeated rows repeat each other's strings; null ids keep their rows;
texts shorter than length lose nothing; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloom.llm.common import shuffle_partitions, small_batches, stored, text_of

GRAM = 64
_CHUNK = 900_000
_POS_BITS = np.uint64((1 << 20) - 1)
_TABLE = np.random.default_rng(9).integers(0, 2**64, 256, dtype=np.uint64)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all GRAM-byte strings, by doubling."""
    with np.errstate(over="ignore"):
        h, size, m = _TABLE[data], 1, 0x9E3779B97F4A7C15
        while size < GRAM:
            h = h[:-size] * np.uint64(m) + h[size:]
            size, m = size * 2, m * m % 2**64
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(29))


def window_min(key: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    return np.minimum(key[: len(key) - (width - size)], key[width - size :])


def runs_of(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First starts, numbers of starts and anchor hashes of the runs in documents that lie end to end."""
    n = len(data) - length + 1
    if n < 1:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.int64),)
    g = gram_hashes(data)
    anchor = (window_min((g & ~_POS_BITS) | np.arange(len(g), dtype=np.uint64), length - GRAM + 1) & _POS_BITS).astype(np.int64)
    sizes = np.diff(ends, prepend=0)
    starts = np.flatnonzero((np.repeat(ends, sizes) - np.arange(len(data)) >= length)[:n])
    if not len(starts):
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.int64),)
    own = anchor[starts]
    new = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (np.diff(starts) != 1)]))
    return starts[new], np.diff(new, append=len(starts)), g[own[new]].view(np.int64)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its offsets."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), at


def batch_runs(column: pa.Array, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Row, first start, number of starts and anchor hash of all runs of a column of texts, a bounded chunk at a time."""
    data, at = _bytes_of(column)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(at, at[a] + _CHUNK, side="right")) - 1)
        if at[b] - at[a] <= _CHUNK:
            first, count, fp = runs_of(data[at[a] : at[b]], at[a + 1 : b + 1] - at[a], length)
            row = a + np.searchsorted(at[a + 1 : b + 1] - at[a], first, side="right")
            yield row, first - (at[row] - at[a]), count, fp
        else:  # one long text, in parts that overlap by length - 1 bytes
            for c in range(int(at[a]), int(at[b]), _CHUNK - length):
                part = data[c : min(c + _CHUNK - 1, int(at[b]))]
                first, count, fp = runs_of(part, np.array([len(part)]), length)
                yield np.full(len(first), a), first + c - at[a], count, fp
        a = b


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Suffixes of codes (below 512) in order. Kasai's bound needs the whole order, so no depth is set."""
    n = len(codes)
    padded = np.concatenate([codes, np.zeros(8, codes.dtype)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(7):
        key = (key << np.uint64(9)) | padded[i : i + n]
    order = np.argsort(key, kind="stable")
    new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    first = np.flatnonzero(new)
    sa, rank = order, np.empty(n + 1, np.int64)
    rank[order] = np.repeat(first, np.diff(first, append=n))
    rank[n] = -1
    sizes = np.diff(first, append=n)
    open_ = np.repeat(sizes > 1, sizes)
    at, h = np.flatnonzero(open_), 7  # places in sa whose groups are not yet single
    while len(at):
        pos = sa[at]
        key = (rank[pos].astype(np.uint64) << np.uint64(32)) | (rank[np.minimum(pos + h, n)] + 1).astype(np.uint64)
        o = np.argsort(key, kind="stable")
        pos, key = pos[o], key[o]
        sa[at] = pos  # groups are contiguous and in order, so sorting by rank first keeps them in place
        new = np.concatenate([[True], key[1:] != key[:-1]])
        first = np.flatnonzero(new)
        sizes = np.diff(first, append=len(at))
        rank[pos] = np.repeat(at[first], sizes)
        keep = np.repeat(sizes > 1, sizes)
        at, h = at[keep], h * 2
    return sa


def common_prefixes(codes: np.ndarray, sa: np.ndarray, begins: np.ndarray, counts: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix (to cap) of each start with the suffix before it in the order; -1 at other positions.

    Kasai's bound: the next start of a piece shares at least one code less. All pieces take their steps together.
    """
    n = len(codes)
    padded = np.concatenate([codes, np.full(cap + 1, 511, codes.dtype)])
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    out, lane, shared = np.full(n, -1, np.int64), np.arange(len(begins)), np.zeros(len(begins), np.int64)
    for t in range(int(counts.max(initial=0))):
        lane = lane[counts[lane] > t]
        i = begins[lane] + t
        j = before[i]
        own = np.maximum(shared[lane] - 1, 0)
        own[j < 0] = 0
        go = np.flatnonzero((j >= 0) & (own < cap))
        while len(go):
            same = padded[i[go] + own[go]] == padded[np.minimum(j[go] + own[go], n + cap)]
            go = go[same]
            own[go] += 1
            go = go[own[go] < cap]
        shared[lane] = own
        out[i] = own
    return out


def repeated_starts(bodies: list[bytes], length: int) -> list[np.ndarray]:
    """For each of several distinct pieces, which starts have a string of length bytes that starts elsewhere in them."""
    sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
    begins = np.cumsum(sizes + 1) - sizes - 1
    codes = np.full(int((sizes + 1).sum()), 300, np.uint16)
    inside = np.ones(len(codes), bool)
    inside[begins + sizes] = False
    codes[inside] = np.frombuffer(b"".join(bodies), np.uint8)
    counts = sizes - length + 1
    sa = suffix_array(codes)
    prefix = common_prefixes(codes, sa, begins, counts, length)
    hit = np.zeros(len(codes) + 1, bool)
    full = prefix >= length
    hit[: len(codes)] = full
    before = np.full(len(codes), -1, np.int64)
    before[sa[1:]] = sa[:-1]
    hit[before[np.flatnonzero(full)]] = True
    return [hit[b : b + c] for b, c in zip(begins.tolist(), counts.tolist(), strict=True)]


def _spans(flags: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Byte ranges that the marked starts cover."""
    at = np.flatnonzero(flags)
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > length)
    return [(int(a), int(b) + length) for a, b in zip(at[np.concatenate([[0], cut + 1])], at[np.concatenate([cut, [len(at) - 1]])], strict=True)]


def _pieces(batch: pa.RecordBatch, length: int) -> Iterator[tuple[int, dict[tuple[int, int], list[int]], np.ndarray, dict[tuple[int, int], int]]]:
    """Each document of a batch (rid, text, fps: the anchors that count): its row, the starts of each of its distinct
    pieces by (anchor hash, digest), its bytes, and the pieces' sizes.
    """
    from xxhash import xxh3_64_intdigest

    data, at = _bytes_of(batch["text"])
    chosen = [set(x) for x in batch["fps"].to_pylist()]
    by_row: dict[int, list] = {}
    for row, first, count, fp in batch_runs(batch["text"], length):
        for k, p, n, f in zip(row.tolist(), first.tolist(), count.tolist(), fp.tolist(), strict=True):
            if f in chosen[k]:
                by_row.setdefault(k, []).append((p, n, f))
    for k in range(len(batch)):
        text, places, sizes = data[at[k] : at[k + 1]], {}, {}
        for p, n, f in by_row.get(k, ()):
            key = (f, xxh3_64_intdigest(text[p : p + n + length - 1].tobytes()) - 2**63)
            places.setdefault(key, []).append(p)
            sizes[key] = n + length - 1
        yield k, places, text, sizes


def _members(rows: DataFrame, length: int) -> DataFrame:
    """fp, d, rid, times and size of the distinct pieces of each document."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids = batch["rid"].to_pylist()
            out = [(f, d, rids[k], len(at), sizes[f, d]) for k, places, _, sizes in _pieces(batch, length) for (f, d), at in places.items()]
            cols = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], ["fp", "d", "rid", "times", "size"])

    return rows.mapInArrow(members, "fp long, d long, rid long, times int, size int")


def _bodies(rows: DataFrame, length: int) -> DataFrame:
    """fp, d and body of the pieces that a document is asked for. rows: rid, text, fps, wanted (array of fp, d)."""

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted, out = batch["wanted"].to_pylist(), []
            for k, places, text, sizes in _pieces(batch, length):
                for w in wanted[k]:
                    if (w["fp"], w["d"]) not in places:  # of the other document with this rid
                        continue
                    p = places[w["fp"], w["d"]][0]
                    out.append((w["fp"], w["d"], text[p : p + sizes[w["fp"], w["d"]]].tobytes()))
            cols = list(zip(*out, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary()), strict=True)], ["fp", "d", "body"])

    return rows.mapInArrow(bodies, "fp long, d long, body binary")


_MARK = "fp long, d long, shard int, first int, last int, w1 long, w2 long"


def _mark(pieces: DataFrame, length: int, chunk_bytes: int) -> DataFrame:
    """Marks in the pieces of each (fp, shard): byte ranges (w1 null), and for anchors over several shards the digests of
    distinct strings (w1, w2), with their start where the shard holds the string once, else -1.
    """

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for r in zip(*[batch[c].to_pylist() for c in ("fp", "shard", "d", "several", "body")], strict=True):
                if size >= chunk_bytes and r[:2] != held[-1][:2]:
                    yield emit(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[4])
        if held:
            yield emit(held)

    def emit(held: list[tuple]) -> pa.RecordBatch:
        from xxhash import xxh3_128_intdigest

        out = []
        found = repeated_starts([r[4] for r in held], length)
        seen: dict[tuple, list] = {}
        for (fp, shard, d, several, body), flags in zip(held, found, strict=True):
            out += [(fp, d, shard, a, b, None, None) for a, b in _spans(flags, length)]
            if several:
                for p in range(len(flags)):
                    w = xxh3_128_intdigest(body[p : p + length])
                    seen.setdefault((fp, shard, (w >> 64) - 2**63, (w & (2**64 - 1)) - 2**63), [d, -1 if flags[p] else p])
        out += [(fp, d, shard, p, p + length if p >= 0 else -1, w1, w2) for (fp, shard, w1, w2), (d, p) in seen.items()]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
        cols = list(zip(*out, strict=True)) or [[]] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["fp", "d", "shard", "first", "last", "w1", "w2"])

    n = shuffle_partitions(pieces.sparkSession)
    return pieces.select("fp", "shard", "d", "several", "body").repartition(n, "fp", "shard").sortWithinPartitions("fp", "shard").mapInArrow(mark, _MARK)


def repeat_marks(docs: DataFrame, *, length: int = 200, shard_pieces: int = 4096, chunk_bytes: int = 1_000_000) -> tuple[DataFrame, DataFrame]:
    """docs: rid, rid2, text. What repeats cover of each piece, by document (rid, fp, d, first, last), and the documents with such
    anchors (rid, rid2, text, fps).
    """

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid = batch["rid"].to_numpy(zero_copy_only=False)
            for row, _, _, fp in batch_runs(batch["text"], length):
                order = np.lexsort((fp, row))
                row, fp = row[order], fp[order]
                first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (fp[1:] != fp[:-1])])) if len(row) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(fp[first]), pa.array(rid[row[first]]), pa.array(np.diff(first, append=len(row)), pa.int32())], ["fp", "rid", "times"])

    small_batches(docs.sparkSession)
    own = docs.select("rid", "text").mapInArrow(anchors, "fp long, rid long, times int")
    twice = own.groupBy("fp").agg(F.sum("times").alias("n")).where("n > 1").select("fp")
    chosen = own.select("fp", "rid").join(twice, "fp").groupBy("rid").agg(F.collect_set("fp").alias("fps"))  # of one text
    rows = stored(docs.join(chosen, "rid").select("rid", "rid2", "text", "fps"), "repeat-docs")
    members = stored(_members(rows.select("rid", "text", "fps"), length), "repeat-members")
    classes = members.groupBy("fp", "d").agg(F.sum("times").alias("times"), F.min("size").alias("size"), F.min("rid").alias("rid"))
    several = classes.groupBy("fp").agg(F.count("*").alias("kinds")).where("kinds > 1")
    spread = F.ceil(F.col("kinds") / shard_pieces)
    mixed = stored(classes.join(several, "fp").select("fp", "d", "rid", F.pmod("d", spread).cast("int").alias("shard"), (spread > 1).alias("several")), "repeat-mixed")
    wanted = mixed.groupBy("rid").agg(F.collect_list(F.struct("fp", "d")).alias("wanted"))  # of one text
    bodies = _bodies(rows.join(wanted, "rid").dropDuplicates(["rid", "rid2"]).drop("rid2"), length)
    marks = stored(_mark(bodies.join(mixed, ["fp", "d"]), length, chunk_bytes), "repeat-marks")
    strings = marks.where("w1 is not null")
    across = strings.groupBy("fp", "w1", "w2").agg(F.count("*").alias("shards")).where("shards > 1")
    whole = classes.where("times > 1").select("fp", "d", F.lit(0).alias("first"), F.col("size").alias("last"))
    spans = whole.unionByName(marks.where("w1 is null").select("fp", "d", "first", "last"))
    spans = spans.unionByName(strings.where("first >= 0").join(across, ["fp", "w1", "w2"]).select("fp", "d", "first", "last"))
    return members.select("fp", "d", "rid").join(spans, ["fp", "d"]), rows


def _removal(rows: DataFrame, length: int) -> DataFrame:
    """rows: rid, rid2, text, fps, spans (array of fp, d, first, last). Bytes and ranges removed, and what is left."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, removed, ranges, left = batch["spans"].to_pylist(), [], [], []
            for k, places, text, _ in _pieces(batch, length):
                cover = np.zeros(len(text) + 1, np.int64)
                for s in spans[k]:
                    for p in places.get((s["fp"], s["d"]), ()):
                        cover[p + s["first"]] += 1
                        cover[p + s["last"]] -= 1
                gone = np.cumsum(cover)[:-1] > 0
                removed.append(int(gone.sum()))
                ranges.append(int((gone & ~np.concatenate([[False], gone[:-1]])).sum()))
                left.append(text[~gone].tobytes())
            yield pa.RecordBatch.from_arrays([batch["rid"], batch["rid2"], pa.array(removed, pa.int64()), pa.array(ranges, pa.int64()), pa.array(left, pa.binary()), pa.array([hashlib.sha256(x).hexdigest() for x in left], pa.string())], ["rid", "rid2", "n_removed", "n_spans", "kept", "kept_sha256"])

    return rows.select("rid", "rid2", "text", "fps", "spans").mapInArrow(remove, "rid long, rid2 long, n_removed long, n_spans long, kept binary, kept_sha256 string")


def without_repeats(docs: DataFrame, *, length: int = 200, **options) -> DataFrame:
    """docs: rid, rid2, text. rid, rid2, n_removed, n_spans, kept (bytes) and kept_sha256 of the texts that lose any byte."""
    spans, rows = repeat_marks(docs, length=length, **options)
    per_text = spans.distinct().groupBy("rid").agg(F.collect_list(F.struct("fp", "d", "first", "last")).alias("spans"))  # of one text
    return _removal(rows.join(per_text, "rid").dropDuplicates(["rid", "rid2"]), length)


def repeats_digest(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each row."""
    rows = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("text"))
    rid = lambda seed: F.xxhash64(F.lit(seed), F.col("doc_id").isNull(), "doc_id", "text")
    rows = rows.withColumn("rid", rid(0)).withColumn("rid2", rid(1))
    removed = without_repeats(rows.select("rid", "rid2", "text"), **options).drop("kept")
    all_rows = rows.select("doc_id", "rid", "rid2", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("own"))
    return all_rows.join(removed, ["rid", "rid2"], "left").select("doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("kept_sha256", "own").alias("kept_sha256"))
