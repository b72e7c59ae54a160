"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata of the text.

score(x) = sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j); the pairwise part is computed in linear time as half
of (sum v_i x_i)^2 - sum v_i^2 x_i^2 for each latent factor. Features come from the text alone: words by hash with their
damped frequencies, and the quantile bins of structure statistics and of the text's size, one indicator each.

Training reads at most ``max_labelled`` labelled rows (a bounded sample by hash of doc_id, one row for each) on the
driver; every row is scored from its whole text, where it lies, with no shuffle. The model has a fixed size.

Defined cases: null and empty texts have no words and are scored by their statistics; null ids and repeated rows keep
their rows (a null id counts as not held out); without usable labels every score is 0.5.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catloom.llm.common import small_batches, steps, text_of
from catloom.llm.quality_rules import labelled_sample, text_stats

WORD_BITS = 15
BINS = 12
STEP = 200  # texts whose features lie in memory at a time
N_STATS = 9  # symbols, upper case, repeats, distinct words, repeated lines, word length, short words, words with letters, size

_STAT_WEIGHTS = np.full(N_STATS, 0.35, np.float32)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo folds, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def raw_features(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed word slots, their weights (unit length in all) and the statistics of a whole text."""
    counts = Counter(text.encode("utf-8", "surrogatepass").lower().split())
    slots = np.fromiter((zlib.crc32(w) & ((1 << WORD_BITS) - 1) for w in counts), np.int32, len(counts))
    x = np.log1p(np.fromiter(counts.values(), np.float32, len(counts)))
    stats = text_stats(text)
    return slots, (x / max(1e-9, float(np.sqrt((x * x).sum())))).astype(np.float32), np.array([*stats[5:], np.log1p(len(text))], np.float32)


@dataclass
class Model:
    w0: float
    w: np.ndarray
    v: np.ndarray
    cuts: np.ndarray = field(default_factory=lambda: np.zeros((N_STATS, BINS - 1), np.float32))

    def bins(self, stats: np.ndarray) -> np.ndarray:
        """Slots of the statistics' indicators, after those of the words; stats: of one text or of several."""
        return ((1 << WORD_BITS) + np.arange(N_STATS) * BINS + (self.cuts < stats[..., None]).sum(axis=-1)).astype(np.int32)

    def scores(self, texts: list[str]) -> np.ndarray:
        """The scores of some texts: their features lie end to end, and each sum is taken over a text's own part."""
        if not texts:
            return np.zeros(0)
        made = [raw_features(t) for t in texts]
        bins = self.bins(np.stack([stats for *_, stats in made]))
        i = np.concatenate([part for (slots, _, _), own in zip(made, bins, strict=True) for part in (slots, own)])
        x = np.concatenate([part for _, own, _ in made for part in (own, _STAT_WEIGHTS)])
        cut = np.cumsum([0, *(len(slots) + N_STATS for slots, _, _ in made[:-1])])
        vx = self.v[i] * x[:, None]
        total = np.add.reduceat(vx, cut, axis=0)
        z = self.w0 + np.add.reduceat(self.w[i] * x, cut) + 0.5 * ((total**2).sum(axis=1) - np.add.reduceat((vx * vx).sum(axis=1), cut))
        return (1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))).astype(np.float64)

    def score(self, text: str) -> float:
        return float(self.scores([text])[0])


def train(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], y: np.ndarray, *, factors: int = 6, epochs: int = 6, batch: int = 128, rate: float = 0.15, decay: float = 1e-5, seed: int = 5) -> Model:
    """Adagrad on the log loss, in a fixed order."""
    rng = np.random.default_rng(seed)
    size = (1 << WORD_BITS) + N_STATS * BINS
    model = Model(0.0, np.zeros(size, np.float32), rng.normal(0, 0.02, (size, factors)).astype(np.float32))
    if not len(rows) or y.min() == y.max():
        model.v[:] = 0
        return model
    model.cuts = np.quantile(np.stack([r[2] for r in rows]), np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T.astype(np.float32)
    data = [(np.concatenate([s, model.bins(t)]), np.concatenate([x, _STAT_WEIGHTS])) for s, x, t in rows]
    # both classes weigh the same, so that a score of 0.3 leans to the rarer one whatever its share
    balance = np.where(y == 1, len(y) / (2 * max(1, (y == 1).sum())), len(y) / (2 * max(1, (y == 0).sum()))).astype(np.float32)
    gw, gv, g0 = np.full(size, 1e-6, np.float32), np.full((size, factors), 1e-6, np.float32), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for a in range(0, len(order), batch):
            own = [data[k] for k in order[a : a + batch]]
            n = np.fromiter((len(i) for i, _ in own), np.int64)
            cut = np.cumsum(n) - n
            i, x = np.concatenate([i for i, _ in own]), np.concatenate([x for _, x in own])
            vx = model.v[i] * x[:, None]
            total = np.add.reduceat(vx, cut, axis=0)
            z = model.w0 + np.add.reduceat(model.w[i] * x, cut) + 0.5 * ((total**2).sum(axis=1) - np.add.reduceat((vx * vx).sum(axis=1), cut))
            err = (((1 / (1 + np.exp(-np.clip(z, -30, 30)))) - y[order[a : a + batch]]) * balance[order[a : a + batch]]).astype(np.float32) / len(own)
            e = np.repeat(err, n)
            used, at = np.unique(i, return_inverse=True)
            dw = np.bincount(at, weights=e * x, minlength=len(used)).astype(np.float32) + decay * model.w[used]
            dv = np.stack([np.bincount(at, weights=e * x * (np.repeat(total[:, f], n) - vx[:, f]), minlength=len(used)) for f in range(factors)], axis=1).astype(np.float32) + decay * model.v[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            model.w[used] -= rate * dw / np.sqrt(gw[used])
            model.v[used] -= 0.2 * rate * dv / np.sqrt(gv[used])
            g0 += float(err.sum()) ** 2
            model.w0 -= rate * float(err.sum()) / np.sqrt(g0)
    return model


def fit(docs: DataFrame, labels: DataFrame, *, max_labelled: int = 8_000, folds: int = 5, seed: int = 11, id_col: str = "doc_id", text_col: str = "text", **training) -> Model:
    """Learn from labelled rows that are not held out, at most max_labelled of them."""
    small_batches(docs.sparkSession)
    own = labels.where("quality is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("_label_id"), F.col("quality").cast("int").alias("quality"))
    own = own.where(~held_out(F.col("_label_id"), folds)).groupBy("_label_id").agg(F.min("quality").alias("quality"))
    chosen = labelled_sample(docs, own, max_labelled, seed, id_col, text_col)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            rows = [raw_features(t) for t in batch["text"].to_pylist()]
            packed = [pa.array([r[k].tobytes() for r in rows], pa.binary()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *packed, batch["quality"]], ["doc_id", "slots", "x", "stats", "quality"])

    got = chosen.select("doc_id", "text", "quality").mapInArrow(features, "doc_id long, slots binary, x binary, stats binary, quality int").toPandas()
    got = got.sort_values(["doc_id", "x"]).reset_index(drop=True)
    rows = [(np.frombuffer(s, np.int32), np.frombuffer(x, np.float32), np.frombuffer(t, np.float32)) for s, x, t in zip(got["slots"], got["x"], got["stats"], strict=True)]
    return train(rows, got["quality"].to_numpy(np.float32), **training)


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of each row."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, STEP):
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(held.value.scores(batch["text"].to_pylist()))], ["doc_id", "score"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col).alias("text")).mapInArrow(scores, "doc_id long, score double")


def classify_digest(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3, folds: int = 5, **options) -> DataFrame:
    model = fit(docs, labels, folds=folds, **options)
    keys = {k: v for k, v in options.items() if k in ("id_col", "text_col")}
    return score(docs, model, **keys).select("doc_id", held_out(F.col("doc_id"), folds).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3, text_col: str = "text", **options) -> DataFrame:
    """docs without the rows that the classifier rejects; each row is judged where it lies."""
    held = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, text_col=text_col, **options))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, STEP):
            yield batch.filter(pa.array(held.value.scores([t or "" for t in batch[text_col].to_pylist()]) >= threshold))

    return docs.mapInArrow(keep, docs.schema)
