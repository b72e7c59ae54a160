"""Language-model scores by deleted interpolation.

The model mixes the maximum-likelihood estimate of a word after its predecessor with a smoothed unigram estimate. The
weight of the first depends on how often the predecessor was seen (a bucket for each power of two); the weights are
learned by expectation-maximisation on counts of a held-out tenth of the training documents, against estimates from the
other training documents, and then applied to estimates from all of them.

Counts travel packed. A task turns its documents into blocks of about a million tokens, which are stored once, and sends
for each block and slice (a hash range of words; a pair belongs to its first word's slice) the block's distinct words and
pairs with their numbers. A slice adds up the numbers over all blocks and answers each block in the block's own order, so a
frequent word costs one entry a block, not one row a token. There is a slice for every few blocks, so that what one task
adds up stays the same size; packets are then blocks times slices, and get small (about a kilobyte) beyond a few TB.
Held-out pairs go on to the slices of their second words to meet its count, and leave as a histogram of fixed size, on
which the driver runs the maximisation.

Defined cases: null and empty texts consist of the end token; null ids count as training documents; repeated rows count
each; without training documents the base score is that of an unseen word; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloom.llm.common import shuffle_partitions, small_batches, steps, stored, text_of

END, BEGIN = np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC949D7C7509E6557)
ALPHA = 0.1
BUCKETS, BINS, BIN_WIDTH = 48, 256, 0.25
HELD_OUT, TUNING, TRAINING = 0, 1, 2
BLOCKS_A_SLICE = 8


def fold(doc_id: int | None, folds: int = 10) -> int:
    """Held out where crc32 of the id as text modulo folds is 0, for tuning where it is 1, else for training."""
    return TRAINING if doc_id is None else min(TRAINING, zlib.crc32(str(doc_id).encode()) % folds)


def _small(x: np.ndarray) -> bytes:
    """Counts in as few bytes each as they need; the first byte tells how many."""
    most = int(x.max(initial=0))
    size = 1 if most < 256 else 2 if most < 65536 else 4 if most < 2**32 else 8
    return bytes([size]) + x.astype(f"<u{size}").tobytes()


def _large(b: bytes) -> np.ndarray:
    return np.frombuffer(b, f"<u{b[0]}", offset=1).astype(np.int64)


def _six(x: np.ndarray) -> bytes:
    return np.ascontiguousarray((x >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unsix(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(b, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8")


def _mix(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (h * np.uint64(0x9E3779B97F4A7C15)) ^ w
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


class Block:
    """Documents' tokens as places in the distinct words, and their pairs as places in the sorted distinct pairs.

    words: the sorted distinct words and BEGIN; tokens: places in them. They are put in order of their slices here.
    """

    def __init__(self, name: int, ids: list, folds: np.ndarray, sizes: np.ndarray, words: np.ndarray, tokens: np.ndarray, slices: int):
        self.name, self.ids, self.folds, self.sizes = name, ids, folds, sizes
        part = (words % np.uint64(slices)).astype(np.int64)
        order = np.lexsort((words, part))
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        self.words, self.part = words[order], part[order]
        self.token, begin = rank[tokens], rank[np.searchsorted(words, BEGIN)]
        before = np.empty(len(self.token), np.int64)
        before[1:] = self.token[:-1]
        before[np.cumsum(sizes) - sizes] = begin
        self.before = before
        pairs, self.pair = np.unique((before << 32) | self.token, return_inverse=True)
        self.first, self.second = pairs >> 32, pairs & 0xFFFFFFFF
        fold = np.repeat(folds, sizes)
        count = lambda at, n, keep: np.bincount(at[keep], minlength=n)
        train, tune = fold != HELD_OUT, fold == TUNING
        self.word_train, self.word_tune = count(self.token, len(words), train), count(self.token, len(words), tune)
        self.pair_train, self.pair_tune = count(self.pair, len(pairs), train), count(self.pair, len(pairs), tune)

    def packets(self, slices: int) -> Iterator[tuple]:
        """block, slice, words, their counts for training and tuning, pairs per word, pairs, their counts, second words of tuning pairs."""
        cut, edge = np.searchsorted(self.part, np.arange(slices + 1)), np.searchsorted(self.first, np.searchsorted(self.part, np.arange(slices + 1)))
        keys = _mix(self.words[self.first], self.words[self.second])
        for s in np.unique(self.part).tolist():
            a, b, c, d = cut[s], cut[s + 1], edge[s], edge[s + 1]
            tune = self.pair_tune[c:d]
            yield self.name, s, self.words[a:b].tobytes(), _small(self.word_train[a:b]), _small(self.word_tune[a:b]), _small(np.bincount(self.first[c:d] - a, minlength=b - a)), _six(keys[c:d]), _small(self.pair_train[c:d]), _small(tune), self.words[self.second[c:d][tune > 0]].tobytes()


_BLOCK = "block long, ids binary, folds binary, sizes binary, tokens binary, words binary"


def _blocks(batches: Iterator[pa.RecordBatch], folds: int, block_tokens: int) -> Iterator[pa.RecordBatch]:
    """Documents in blocks of about block_tokens tokens, as rows of _BLOCK."""
    from xxhash import xxh64_intdigest

    def row() -> pa.RecordBatch:
        words, at = np.unique(np.append(np.concatenate(tokens), BEGIN), return_inverse=True)
        keys = b"".join(b"\0" * 9 if i is None else b"\1" + int(i).to_bytes(8, "little", signed=True) for i in ids)
        parts = [keys, np.array(kinds, np.uint8).tobytes(), np.array(sizes, "<u4").tobytes(), at[:-1].astype("<u4").tobytes(), words.tobytes()]
        name = xxh64_intdigest(b"".join(parts)) - 2**63
        return pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), *[pa.array([x], pa.binary()) for x in parts]], [x.split()[0] for x in _BLOCK.split(", ")])

    ids, kinds, sizes, tokens, held = [], [], [], [], 0
    for batch in steps(batches):
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
            words = text.encode("utf-8", "surrogatepass").lower().split()
            own = np.empty(len(words) + 1, np.uint64)
            own[:-1] = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
            own[-1] = END
            ids.append(doc_id)
            kinds.append(fold(doc_id, folds))
            sizes.append(len(own))
            tokens.append(own)
            held += len(own)
            if held >= block_tokens:
                yield row()
                ids, kinds, sizes, tokens, held = [], [], [], [], 0
    if ids:
        yield row()


def _block(name: int, ids: bytes, folds: bytes, sizes: bytes, tokens: bytes, words: bytes, slices: int) -> Block:
    keys = [int.from_bytes(ids[k + 1 : k + 9], "little", signed=True) if ids[k] else None for k in range(0, len(ids), 9)]
    return Block(name, keys, np.frombuffer(folds, np.uint8).astype(np.int64), np.frombuffer(sizes, "<u4").astype(np.int64), np.frombuffer(words, "<u8"), np.frombuffer(tokens, "<u4"), slices)


_PACKET = "block long, slice int, words binary, word_train binary, word_tune binary, per_word binary, pairs binary, pair_train binary, pair_tune binary, seconds binary"
_ANSWER = "kind string, block long, slice int, words binary, train binary, tune binary, pairs binary, buckets binary, ratios binary, n_tokens long, n_types long, bucket_counts array<long>"


def _bucket(n: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + log2 of its count."""
    return np.where(n > 0, np.floor(np.log2(np.maximum(n, 1))).astype(np.int64) + 1, 0)


def _add_up(pdf: pd.DataFrame, slices: int) -> Iterator[dict]:
    """The answers of a slice, its word counts, and its tuning pairs dealt to the slices of their second words."""
    pdf = pdf.sort_values("block", kind="stable")
    words = [np.frombuffer(b, "<u8") for b in pdf["words"]]
    n_words = [len(w) for w in words]
    distinct, at = np.unique(np.concatenate(words), return_inverse=True)
    total = lambda parts, at, n: np.bincount(at, weights=np.concatenate([_large(b) for b in parts]), minlength=n).astype(np.int64)
    train, tune = total(pdf["word_train"], at, len(distinct)), total(pdf["word_tune"], at, len(distinct))
    per_word = np.concatenate([_large(b) for b in pdf["per_word"]])
    context = np.repeat(at, per_word)
    pairs = [_unsix(b) for b in pdf["pairs"]]
    n_pairs = [len(p) for p in pairs]
    keys = np.concatenate(pairs)
    _, pair_at = np.unique(keys, return_inverse=True)
    n = int(pair_at.max(initial=-1)) + 1
    pair_train, own_tune = total(pdf["pair_train"], pair_at, n), np.concatenate([_large(b) for b in pdf["pair_tune"]])
    pair_tune = np.bincount(pair_at, weights=own_tune, minlength=n).astype(np.int64)
    a = c = 0
    for block, nw, np_ in zip(pdf["block"], n_words, n_pairs, strict=True):
        yield {"kind": "answer", "block": block, "train": _small(train[at[a : a + nw]]), "pairs": _small(pair_train[pair_at[c : c + np_]])}
        a, c = a + nw, c + np_
    # contexts seen in training without tuning: a word as often as it occurs, a text's begin as often as there are texts
    follows = np.bincount(context, weights=np.concatenate([_large(b) for b in pdf["pair_train"]]) - own_tune, minlength=len(distinct)).astype(np.int64)
    real = distinct != BEGIN
    yield {"kind": "words", "words": distinct.tobytes(), "train": _small(train), "tune": _small(tune), "n_tokens": int(train.sum()), "n_types": int((train[real] > 0).sum())}
    tuned = own_tune > 0
    seconds, ctx, pa_, amount = np.concatenate([np.frombuffer(b, "<u8") for b in pdf["seconds"]]), follows[context[tuned]], pair_at[tuned], own_tune[tuned]
    bucket = _bucket(ctx)
    rest = pair_train[pa_] - pair_tune[pa_]
    yield {"kind": "buckets", "bucket_counts": np.bincount(bucket, weights=amount, minlength=BUCKETS).astype(np.int64).tolist()}
    seen = rest > 0
    to = (seconds[seen] % np.uint64(slices)).astype(np.int64)
    ratio = (rest[seen] / np.maximum(ctx[seen], 1)).astype("<f4")
    for s in np.unique(to).tolist():
        own = to == s
        yield {"kind": "tuning", "slice": s, "words": seconds[seen][own].tobytes(), "buckets": bucket[seen][own].astype(np.uint8).tobytes(), "ratios": ratio[own].tobytes(), "tune": _small(amount[seen][own])}


def _maximise(counts: np.ndarray, hist: np.ndarray, steps: int = 60) -> np.ndarray:
    """Weight of the pair estimate in each bucket. hist[b, i]: tuning tokens whose two estimates have a log ratio in bin i."""
    ratio = np.exp((np.arange(BINS) - BINS // 2 + 0.5) * BIN_WIDTH)
    weight = np.full(BUCKETS, 0.5)
    for _ in range(steps):
        share = weight[:, None] * ratio / (weight[:, None] * ratio + 1 - weight[:, None] + 1e-300)
        weight = np.where(counts > 0, (hist * share).sum(axis=1) / np.maximum(counts, 1), 0.0).clip(0, 0.999)
    return weight


def lm_scores(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", folds: int = 10, block_tokens: int = 1_200_000, slices: int | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of each row."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col).alias("text"))
    blocks = stored(rows.mapInArrow(lambda batches: _blocks(batches, folds, block_tokens), _BLOCK), "lm-blocks")
    slices = slices or max(8, shuffle_partitions(spark), blocks.count() // BLOCKS_A_SLICE)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _PACKET.split(", ")]
        kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 8]
        for batch in steps(batches, 1):
            cols = list(zip(*_block(*[c[0].as_py() for c in batch.columns], slices).packets(slices), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    def add_up(pdf: pd.DataFrame) -> pd.DataFrame:
        own = int(pdf["slice"].iloc[0])
        rows = list(_add_up(pdf, slices))
        out = pd.DataFrame([{"slice": own, **r} for r in rows])
        out["block"] = pd.array([r.get("block") for r in rows], dtype="Int64")  # not by way of floats
        out["bucket_counts"] = [x if isinstance(x, list) else None for x in out["bucket_counts"]]
        return out.reindex(columns=[x.split()[0] for x in _ANSWER.split(", ")]).astype({"n_tokens": "Int64", "n_types": "Int64"})

    found = stored(blocks.mapInArrow(send, _PACKET).groupBy("slice").applyInPandas(add_up, _ANSWER), "lm-counts")
    totals = found.where("kind = 'words'").agg(F.sum("n_tokens").alias("n"), F.sum("n_types").alias("v")).first()
    n, v = totals["n"] or 0, totals["v"] or 0

    def bins(tuning: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        hist = np.zeros(BUCKETS * BINS, np.int64)
        if len(words) and len(tuning):
            keys = np.frombuffer(words["words"].iloc[0], "<u8")
            rest = _large(words["train"].iloc[0]) - _large(words["tune"].iloc[0])
            for r in tuning.itertuples():
                at = np.searchsorted(keys, np.frombuffer(r.words, "<u8"))
                low = (rest[at] + ALPHA) / (n + ALPHA * (v + 1))
                i = np.clip(np.floor(np.log(np.frombuffer(r.ratios, "<f4") / low) / BIN_WIDTH).astype(np.int64) + BINS // 2, 0, BINS - 1)
                hist += np.bincount(np.frombuffer(r.buckets, np.uint8).astype(np.int64) * BINS + i, weights=_large(r.tune), minlength=BUCKETS * BINS).astype(np.int64)
        at = np.flatnonzero(hist)
        return pd.DataFrame({"cell": at, "n": hist[at]})

    tuning = found.where("kind = 'tuning'").select("slice", "words", "buckets", "ratios", "tune")
    words = found.where("kind = 'words'").select("slice", "words", "train", "tune")
    cells = tuning.groupBy("slice").cogroup(words.groupBy("slice")).applyInPandas(bins, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    hist = np.zeros(BUCKETS * BINS)
    for r in cells.collect():  # BUCKETS * BINS at most
        hist[r["cell"]] = r["n"]
    counted = found.where("kind = 'buckets'").select([F.sum(F.col("bucket_counts")[b]).alias(f"b{b}") for b in range(BUCKETS)]).first()
    weight = _maximise(np.array([x or 0 for x in counted], float), hist.reshape(BUCKETS, BINS))

    def score(blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        by_slice = {r.slice: r for r in answers.itertuples()}
        for r in blocks.itertuples():
            b = _block(r.block, r.ids, r.folds, r.sizes, r.tokens, r.words, slices)
            parts = np.unique(b.part).tolist()
            train = np.concatenate([_large(by_slice[s].train) for s in parts])
            pairs = np.concatenate([_large(by_slice[s].pairs) for s in parts])
            low = (train[b.token] + ALPHA) / (n + ALPHA * (v + 1))
            # a context is followed as often as it occurs; the begin as often as the end occurs
            follows = np.where(b.words == BEGIN, train[b.words == END][0], train)[b.before]
            lam = weight[np.minimum(_bucket(follows), BUCKETS - 1)]
            p = lam * pairs[b.pair] / np.maximum(follows, 1) + (1 - lam) * low
            cut = np.cumsum(b.sizes) - b.sizes
            out.append(pd.DataFrame({"doc_id": pd.array(b.ids, dtype="Int64"), "held_out": b.folds == HELD_OUT, "n_tokens": b.sizes, "n_known": np.add.reduceat((train[b.token] > 0).astype(np.int64), cut), "train_tokens": n, "base_score": np.add.reduceat(np.log10(low), cut), "score": np.add.reduceat(np.log10(p), cut)}))
        return pd.concat(out) if out else pd.DataFrame(columns=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    right = found.where("kind = 'answer'").select("block", "slice", "train", "pairs")
    return blocks.groupBy("block").cogroup(right.groupBy("block")).applyInPandas(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
