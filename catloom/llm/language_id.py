"""Language identification by hyperdimensional profiles.

Each letter has a random vector of ``DIM`` signs, drawn from a seed. A trigram's vector binds those of its letters: the
first one permuted twice, the second once, the third not (a permutation turns the vector by one place), multiplied sign by
sign. A text's vector bundles (adds up) the vectors of all its trigrams, a language's prototype those of all trigrams of
its training texts. As all languages share much, the mean direction of the prototypes is taken away from them; a text goes
to the prototype with the largest cosine.

Letters are the characters that are letters by Unicode, in lower case; all between two of them is one blank, and a text
begins and ends with one. Letters from U+1000 on share the vectors of 4,096 places by their code point.

Training takes one pass: each task bundles the trigrams of its rows for each language, and sums over tasks are a grouped
sum by language and place. All sums are of whole numbers, so they agree whatever the order. Scoring is a second pass, with
every text where it lies. The model is the prototypes, at most ``max_languages`` of them; more raise an error.

Defined cases: a null text, one without a letter, and any text where nothing was learned are ``und`` with score 0; null
languages, ids and texts are not learned from; rows with a null id are not held out; repeated rows each count and are each
scored; languages with equal cosines go by the smaller name; long texts are taken in pieces that overlap by a trigram's
rest; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catloom.llm.common import small_batches, steps, text_of

DIM, PLACES, SEED = 1024, 1 << 12, 20
PIECE = 1 << 20  # letters that are bundled at a time
UNKNOWN = "und"


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    """crc32 of the id as text, modulo folds, is fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


@lru_cache(1)
def _letters() -> np.ndarray:
    """For each code point: its place among the letter vectors, 0 where it is no letter."""
    cp = np.arange(0x110000)
    is_letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return np.where(is_letter, np.maximum(cp % PLACES, 1), 0).astype(np.int32)


@lru_cache(1)
def _vectors() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letter vectors permuted twice, once and not at all."""
    own = np.random.default_rng(SEED).integers(0, 2, (PLACES, DIM), np.int8) * 2 - 1
    return np.roll(own, 2, axis=1), np.roll(own, 1, axis=1), own


def letters(text: str) -> np.ndarray:
    """The places of a text's letters, with single blanks (0) between words and around; empty without any letter."""
    s = _letters()[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
    s = np.concatenate([[0], s, [0]])
    s = s[(s != 0) | np.append(True, s[:-1] != 0)]
    return s if len(s) > 2 else s[:0]


def _ranks(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes below size, and where each code is among them."""
    if size > 1 << 22:
        return np.unique(codes, return_inverse=True)
    seen = np.zeros(size, bool)
    seen[codes] = True
    return np.flatnonzero(seen), (np.cumsum(seen) - 1)[codes]


def bundles(texts: list[np.ndarray], owner: list[int], n: int) -> np.ndarray:
    """n vectors: that of owner k bundles the trigrams of its texts (as places of letters)."""
    out = np.zeros((n, DIM), np.int64)
    held, size = [], 0

    def add() -> None:
        used, row = np.unique([k for k, _ in held], return_inverse=True)
        letter, s = _ranks(np.concatenate([s for _, s in held]), PLACES)
        code = (s[:-2] * len(letter) + s[1:-1]) * len(letter) + s[2:]
        size = np.array([len(s) for _, s in held])
        inside = np.ones(len(code), bool)  # not across two texts
        inside[(np.cumsum(size)[:-1, None] - [2, 1]).ravel()] = False
        found, at = _ranks(code[inside], len(letter) ** 3)
        counts = np.bincount(at + np.repeat(row, size - 2) * len(found), minlength=len(used) * len(found)).reshape(len(used), -1).astype(np.float32)
        a, b, c = _vectors()
        for i in range(0, len(found), 2048):
            f = found[i : i + 2048]
            bound = a[letter[f // len(letter) ** 2]] * b[letter[f // len(letter) % len(letter)]] * c[letter[f % len(letter)]]
            out[used] += (counts[:, i : i + 2048] @ bound.astype(np.float32)).astype(np.int64)  # whole numbers below 2^24

    for k, s in zip(owner, texts, strict=True):
        for i in range(0, max(0, len(s) - 2), PIECE):
            held.append((k, s[i : i + PIECE + 2]))
            size += len(held[-1][1])
            if size >= PIECE:
                add()
                held, size = [], 0
    if held:
        add()
    return out


def profiles(rows: DataFrame, max_languages: int = 1000) -> dict[str, np.ndarray]:
    """The bundle of each language over all rows (text, lang)."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in steps(batches):
            langs = batch["lang"].to_pylist()
            own = sorted(set(langs))
            made = bundles([letters(t) for t in batch["text"].to_pylist()], [own.index(x) for x in langs], len(own))
            for x, v in zip(own, made, strict=True):
                sums[x] = sums[x] + v if x in sums else v
        for x, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([x]), pa.array([v.tolist()], pa.list_(pa.int64()))], ["lang", "v"])

    parts = rows.mapInArrow(learn, "lang string, v array<long>").select("lang", F.posexplode("v").alias("at", "x"))
    sums = parts.groupBy("lang", "at").agg(F.sum("x").alias("x")).groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("v"))
    got = sums.limit(max_languages + 1).collect()
    if len(got) > max_languages:
        raise ValueError(f"more than {max_languages} languages to learn")
    return {r["lang"]: np.array([p["x"] for p in r["v"]], np.float64) for r in got}


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=-1, keepdims=True), 1e-12)


class Model:
    """Names of languages, ascending, their prototypes, and the direction that all share."""

    def __init__(self, found: dict[str, np.ndarray]):
        self.names = sorted(x for x, v in found.items() if v.any())
        own = unit(np.stack([found[x] for x in self.names])) if self.names else np.zeros((0, DIM))
        self.shared = own.mean(axis=0) if len(own) > 1 else np.zeros(DIM)
        self.prototypes = unit(own - self.shared)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """For each text the language and a score of 0 to 1: half of 1 plus the cosine."""
        own = [letters(t or "") for t in texts]
        known = np.array([len(s) > 0 for s in own], bool)
        if not self.names or not known.any():
            return [UNKNOWN] * len(own), np.zeros(len(own))
        v = unit(bundles(own, list(range(len(own))), len(own)).astype(np.float64))
        cosines = np.round(unit(v - self.shared) @ self.prototypes.T, 12)
        top = cosines.argmax(axis=1)
        score = np.clip((1 + cosines[np.arange(len(own)), top]) / 2, 0, 1)
        return [self.names[k] if ok else UNKNOWN for k, ok in zip(top, known, strict=True)], np.where(known, score, 0.0)


def fit(docs: DataFrame, *, folds: int = 4, fold: int = 2, max_languages: int = 1000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from the rows with text, language and id that are not held out."""
    small_batches(docs.sparkSession)
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"), docs[lang_col].cast("string").alias("lang"))
    rows = rows.where(F.col("id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("id"), folds, fold))
    return Model(profiles(rows.select("text", "lang"), max_languages))


def predictions(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of each row."""
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)  # at most max_languages prototypes

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            names, scores = held.value.predict(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col).alias("text")).mapInArrow(predict, "doc_id long, lang_pred string, score double")


def language_digest(docs: DataFrame, *, folds: int = 4, fold: int = 2, **options) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each row, with a model learned from the rows that are not held out."""
    model = fit(docs, folds=folds, fold=fold, **options)
    keys = {k: v for k, v in options.items() if k in ("id_col", "text_col")}
    return predictions(docs, model, **keys).select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "lang_pred", "score")
