"""Token-ID output: raw id payloads in ordered shards, and a minimal perfect hash index over document keys.

File format. ``shards/``: one row per block of a shard; ``payload`` holds the ids of the block's documents end to end as
little-endian unsigned integers (16 bits where the vocabulary fits, else 32), ``doc_ids``, ``starts`` and ``lens`` say
which document lies where. Shards are ranges of doc_id and blocks are in order within a shard, so the concatenation of
all payloads is the corpus in ascending doc_id order. The payloads sit in Parquet because Spark's committer then keeps
the files whole when a task is tried again, on any file system. ``index/``: one row per key bucket, a minimal perfect
hash (levels of bit arrays; a key's slot is the rank of its first bit that no other key shares), 32-bit fingerprints and
locations in slot order. A lookup hashes the key, reads one bucket row, and needs no search.

Defined cases: null text is empty (only the end id is written); null doc_id sorts first and is a key of its own; repeated
doc_ids are told apart by their number ``rep`` within the doc_id; tokenizers other than the lower-casing word one get
whole texts; an empty table gives empty shards and index.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catloom.llm.common import fresh_path, shuffle_partitions, small_batches, text_of

#: How the tokenizer must fold and split texts for the pieces below to be its own; texts go to any other one whole.
_FOLDS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLITS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Latin-1 letters, number characters and the rest of lower-cased text.
_PIECES = re.compile(
    r"[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
    r"|[^\x09-\x0d\x20\x85\xa0a-z0-9\xaa\xb2\xb3\xb5\xb9\xba\xbc-\xbe\xdf-\xf6\xf8-\xff]+"
)
_UNSAFE = re.compile("[^\x00-\xff]|'|<\\|")
_CACHE_PIECES = 1_000_000
_TEXT_STEP = 2_000_000
_encoders: dict[str, "Encoder"] = {}


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Known(dict):
    """Pieces and their numbers; a piece asked for the first time takes the next number and waits in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        self.new.append(piece)
        return number


class Encoder:
    """tokenizers' encoding, each distinct piece of plain Latin-1 text encoded once (bounded memory)."""

    def __init__(self, path: str | None):
        import json
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path or tokenizer_path())
        made = json.loads(self.tok.to_str())
        vocab = self.tok.get_vocab()
        steps = (made.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.in_pieces = (
            (made.get("normalizer") or {}).get("normalizers") == _FOLDS
            and steps[0].get("pattern") == {"Regex": _SPLITS}
            and [x["type"] for x in steps] == ["Split", "ByteLevel"]
            and made["model"].get("end_of_word_suffix") == "</w>"
            and all(t["content"].startswith("<|") for t in made["added_tokens"])
        )
        self.dtype = np.dtype("<u2" if max(vocab.values()) < 2**16 else "<u4")
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.known = _Known()
        self.at, self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, self.dtype)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self) -> None:
        """Encode the new pieces many at a time; each piece's last id carries the end-of-word mark."""
        found: list[np.ndarray] = []
        for i in range(0, len(self.known.new), 2000):
            part = self.known.new[i : i + 2000]
            ids = self.whole([" ".join(part)])[0]
            cuts = np.flatnonzero(self.ends[ids]) + 1
            found += np.split(ids, cuts[:-1]) if len(cuts) == len(part) and cuts[-1] == len(ids) else self.whole(part)
        self.known.new.clear()
        size = np.fromiter(map(len, found), np.int64, len(found))
        self.at = np.concatenate([self.at, len(self.ids) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, *found])

    def plain(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.known) > _CACHE_PIECES:
            self.clear()
        pieces: list[str] = []
        n = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            got = _PIECES.findall(text.lower())
            n[i] = len(got)
            pieces += got
        if not pieces:
            return [np.zeros(0, self.dtype)] * len(texts)
        slot = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        if self.known.new:
            self.learn()
        size = self.size[slot]
        ends = np.cumsum(size)
        ids = self.ids[np.repeat(self.at[slot] - ends + size, size) + np.arange(ends[-1])]
        cuts = np.concatenate([[0], ends])[np.cumsum(n)]
        return np.split(ids, cuts[:-1])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.in_pieces:
            return self.whole(texts)
        unsafe = [i for i, t in enumerate(texts) if _UNSAFE.search(t)]
        if not unsafe:
            return self.plain(texts)
        out = dict(zip(unsafe, self.whole([texts[i] for i in unsafe]), strict=True))
        rest = [i for i in range(len(texts)) if i not in out]
        out |= dict(zip(rest, self.plain([texts[i] for i in rest]), strict=True))
        return [out[i] for i in range(len(texts))]


def encoder(path: str | None) -> Encoder:
    if str(path) not in _encoders:
        _encoders[str(path)] = Encoder(path)
    return _encoders[str(path)]


def write_shards(docs: DataFrame, path: str, *, id_col="doc_id", text_col="text", tokenizer: str | None = None, end_id: int = 1, shards: int | None = None, block_ids: int = 1_000_000) -> None:
    """Encode every whole text, append end_id, and write the blocks of shards in ascending doc_id order."""

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        shard, enc, block = TaskContext.get().partitionId(), encoder(tokenizer), 0
        last, rep = object(), 0
        keys: list = []
        reps: list[int] = []
        ids: list[np.ndarray] = []
        held = 0

        def row() -> pd.DataFrame:
            size = np.fromiter(map(len, ids), np.int64, len(ids))
            return pd.DataFrame({"shard": [shard], "block": [block], "n_ids": [int(size.sum())], "id_bytes": [enc.dtype.itemsize], "doc_ids": [keys], "reps": [reps], "starts": [(np.cumsum(size) - size).tolist()], "lens": [size.tolist()], "payload": [np.concatenate(ids).tobytes()]})

        def steps(texts: list[str]) -> Iterator[tuple[int, int]]:
            a, n = 0, 0
            for b, text in enumerate(texts, 1):
                n += len(text)
                if n >= _TEXT_STEP or b == len(texts):
                    yield a, b
                    a, n = b, 0

        for pdf in batches:
            texts, doc_ids = pdf["text"].tolist(), [None if pd.isna(x) else int(x) for x in pdf["doc_id"]]
            for a, b in steps(texts):
                for key, got in zip(doc_ids[a:b], enc.encode(texts[a:b]), strict=True):
                    last, rep = key, rep + 1 if key == last else 0
                    keys.append(key)
                    reps.append(rep)
                    ids.append(np.append(got, enc.dtype.type(end_id)))
                    held += len(ids[-1])
                    if held >= block_ids:
                        yield row()
                        keys, reps, ids, held, block = [], [], [], 0, block + 1
        if keys:
            yield row()

    small_batches(docs.sparkSession)
    n = shards or shuffle_partitions(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col).alias("text")).withColumn("h", F.xxhash64("text"))
    (
        rows.repartitionByRange(n, "doc_id", "h")
        .sortWithinPartitions("doc_id", "h")
        .select("doc_id", "text")
        .mapInPandas(blocks, "shard int, block int, n_ids long, id_bytes int, doc_ids array<long>, reps array<long>, starts array<long>, lens array<long>, payload binary")
        .write.mode("overwrite")
        .option("compression", "zstd")
        .parquet(f"{path}/shards")
    )


def _keyed(df: DataFrame, buckets: int) -> DataFrame:
    key = lambda seed: F.xxhash64(F.lit(seed), F.col("doc_id").isNull(), "doc_id", "rep")
    return df.withColumn("key", key(0)).withColumn("key2", key(1)).withColumn("bucket", F.pmod("key", F.lit(buckets)))


def _hashes(pdf: pd.DataFrame) -> np.ndarray:
    """Two independent 64-bit hashes of each key."""
    return np.stack([pdf[c].to_numpy(np.int64).view(np.uint64) for c in ("key", "key2")])


def _prints(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys[-1], 99) >> np.uint64(32)).astype("<u4")


def entries(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, rep, shard, block, start in the block, n, and start in the corpus, of every document in the files.

    A doc_id that fills several shards goes on counting from the shards before; that takes one row per shard.
    """
    blocks = spark.read.parquet(f"{path}/shards").select("shard", "block", "n_ids", "doc_ids", "reps", "starts", "lens")
    last = F.max_by(F.struct(F.element_at("doc_ids", -1).alias("id"), (F.element_at("reps", -1) + 1).alias("n")), "block")
    per_shard = blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids"), F.min_by(F.col("doc_ids")[0], "block").alias("first_id"), last.alias("last"))
    run = F.sum("last.n").over(Window.partitionBy("last.id").orderBy("shard"))
    order = Window.orderBy("shard")  # one row per shard
    goes_on = F.lag("last.id").over(order).eqNullSafe(F.col("first_id"))
    shards = per_shard.withColumn("run", run).select("shard", "first_id", (F.sum("ids").over(order) - F.col("ids")).alias("before"), F.when(goes_on, F.coalesce(F.lag("run").over(order), F.lit(0))).otherwise(0).alias("earlier"))
    within = F.sum("n_ids").over(Window.partitionBy("shard").orderBy("block")) - F.col("n_ids")
    starts = blocks.select("shard", "block", within.alias("within")).join(shards, "shard").select("shard", "block", "first_id", "earlier", (F.col("before") + F.col("within")).alias("corpus_start"))
    rows = blocks.select("shard", "block", F.inline(F.arrays_zip("doc_ids", "reps", "starts", "lens"))).toDF("shard", "block", "doc_id", "rep", "start", "n")
    rep = F.col("rep") + F.when(F.col("doc_id").eqNullSafe(F.col("first_id")), F.col("earlier")).otherwise(0)
    return rows.join(starts, ["shard", "block"]).select("doc_id", rep.alias("rep"), "shard", "block", "start", "n", (F.col("corpus_start") + F.col("start")).alias("corpus_start"))


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64(seed + 1) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def build_mph(keys: np.ndarray) -> tuple[list[int], bytes, np.ndarray]:
    """Level sizes, packed bits of all levels, and each key's slot in 0..n-1.

    Keys are 64-bit hashes, or several of each key (a row each), which levels take in turn: keys that share one part later.
    """
    keys = np.atleast_2d(keys)
    n = keys.shape[1]
    sizes, bits, slot, rest, used = [], [], np.full(n, -1, np.int64), np.arange(n), 0
    while len(rest):
        size = max(8, len(rest) + len(rest) // 4)
        at = (_mix(keys[len(sizes) % len(keys), rest], len(sizes)) % np.uint64(size)).astype(np.int64)
        own = np.bincount(at, minlength=size) == 1
        rank = np.cumsum(own) - 1 + used
        hit = own[at]
        slot[rest[hit]] = rank[at[hit]]
        used += int(own.sum())
        sizes.append(size)
        bits.append(own)
        rest = rest[~hit]
    return sizes, np.packbits(np.concatenate(bits)).tobytes() if bits else b"", slot


def probe_mph(sizes: list[int], bits: bytes, keys: np.ndarray) -> np.ndarray:
    """The slot of each key, -1 where no level has its bit (surely absent)."""
    keys = np.atleast_2d(keys)
    n = keys.shape[1]
    flat = np.unpackbits(np.frombuffer(bits, np.uint8), count=int(sum(sizes))).astype(bool)
    rank, slot, rest, base = np.cumsum(flat) - 1, np.full(n, -1, np.int64), np.arange(n), 0
    for level, size in enumerate(sizes):
        at = base + (_mix(keys[level % len(keys), rest], level) % np.uint64(size)).astype(np.int64)
        hit = flat[at]
        slot[rest[hit]] = rank[at[hit]]
        rest, base = rest[~hit], base + size
    return slot


_PLACE = ("shard", "block", "start", "n", "corpus_start")


def write_index(spark: SparkSession, path: str, *, bucket_keys: int = 2000) -> int:
    """Build the minimal perfect hash index of the files at path; returns its number of buckets."""
    n = spark.read.parquet(f"{path}/shards").select(F.sum(F.size("doc_ids"))).first()[0] or 0
    buckets = max(1, -(-n // bucket_keys))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = _hashes(pdf)
        sizes, bits, slot = build_mph(keys)
        order = np.argsort(slot)
        prints = _prints(keys)[order]
        return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "sizes": [sizes], "bits": [bits], "prints": [prints.tobytes()], **{c: [pdf[c].to_numpy(np.int64)[order].tolist()] for c in _PLACE}})

    rows = _keyed(entries(spark, path), buckets).select("bucket", "key", "key2", *_PLACE)
    rows.groupBy("bucket").applyInPandas(build, "bucket long, sizes array<long>, bits binary, prints binary, " + ", ".join(f"{c} array<long>" for c in _PLACE)).write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/index")
    return buckets


def lookup(keys: DataFrame, path: str, buckets: int) -> DataFrame:
    """Locations of keys (doc_id, rep) through the index; keys that the index does not hold have null locations."""

    def probe(keys: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        out = keys[["doc_id", "rep"]].copy()
        hashed = _hashes(keys)
        if len(index):
            row = index.iloc[0]
            slot = probe_mph(list(row["sizes"]), row["bits"], hashed)
            prints = np.frombuffer(row["prints"], "<u4")
            good = (slot >= 0) & (prints[slot] == _prints(hashed))
        else:
            slot, good = np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        for c in _PLACE:
            out[c] = pd.array(np.asarray(row[c])[slot], dtype="Int64") if len(index) else pd.array([None] * len(keys), dtype="Int64")
            out.loc[~good, c] = pd.NA
        return out.astype({"doc_id": "Int64"})

    index = keys.sparkSession.read.parquet(f"{path}/index")
    hashed = _keyed(keys.select(F.col("doc_id").cast("long"), F.col("rep").cast("long")), buckets)
    return hashed.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(probe, "doc_id long, rep long, " + ", ".join(f"{c} long" for c in _PLACE))


def payload_checksums(spark: SparkSession, path: str) -> DataFrame:
    """shard, block, start, n and the CRC-32 of the ids as little-endian 32-bit integers, from the payloads."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zlib

        for pdf in batches:
            for r in pdf.itertuples():
                ids = np.frombuffer(r.payload, f"<u{r.id_bytes}").astype("<u4")
                starts, lens = np.asarray(r.starts), np.asarray(r.lens)
                yield pd.DataFrame({"shard": r.shard, "block": r.block, "start": starts, "ids_crc32": [zlib.crc32(ids[a : a + n]) for a, n in zip(starts, lens, strict=True)]})

    return spark.read.parquet(f"{path}/shards").select("shard", "block", "id_bytes", "starts", "lens", "payload").mapInPandas(sums, "shard long, block long, start long, ids_crc32 long")


def keys_of(docs: DataFrame, id_col: str = "doc_id", part: int = 100_000) -> DataFrame:
    """doc_id and rep of each row; a doc_id of very many rows is numbered in parts, by several tasks."""
    counts = docs.groupBy(docs[id_col].cast("long").alias("doc_id")).agg(F.count("*").alias("n"))
    parts = counts.select("doc_id", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {part}"))).alias("part")).repartition("doc_id", "part")
    return parts.select("doc_id", F.explode(F.sequence(F.col("part") * part, F.least((F.col("part") + 1) * part, "n") - 1)).alias("rep"))


def token_ids(docs: DataFrame, *, path: str | None = None, **options) -> DataFrame:
    """Write docs as token-ID shards with their index and read them back by key.

    One row per row of docs: doc_id, start, n_tokens, ids_crc32, shard, block, block_start. Keys go through the index;
    checksums come from the payloads.
    """
    spark = docs.sparkSession
    path = path or fresh_path(spark, "token-ids")
    write_shards(docs, path, **options)
    buckets = write_index(spark, path)
    found = lookup(keys_of(docs, options.get("id_col", "doc_id")), path, buckets)
    return found.join(payload_checksums(spark, path), ["shard", "block", "start"], "left").select(
        "doc_id", F.col("corpus_start").alias("start"), F.col("n").alias("n_tokens"), "ids_crc32", "shard", "block", F.col("start").alias("block_start")
    )
