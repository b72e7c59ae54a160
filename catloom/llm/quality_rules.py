"""Quality rules: text statistics and a learned decision list.

The base rules are fixed. On top of them a decision list is learned from labelled statistics by sequential covering: a
rule grows, one threshold test at a time, on two thirds of the labelled rows while its gain in information rises, is
pruned on the last third by dropping final tests while that does not lower its worth, and is kept if it is precise there;
the rows it covers go, and the next rule grows. A rule that is not precise gives its first test up, and the next best rule
is tried. The list is a Spark conditional expression over the statistics, in order.

Learning reads at most ``max_labelled`` labelled rows (a bounded sample by hash of doc_id; the rest is not needed for a
few dozen thresholds; of several rows of an id one counts, and of several labels the least); statistics, base rules and verdicts are made for every row from its whole text.

Defined cases: null and empty texts have zero statistics and fail the base rule on words; null ids and repeated rows keep
their rows; a table without usable labels gives an empty list, which keeps all that the base keeps.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catloom.llm.common import WORD, small_batches, steps, text_of

_WORDS = re.compile(WORD)
_SYMBOLS = re.compile(r"[#*$%&|<>]")
_UPPER = re.compile(r"[A-Z\xC0-\xD6\xD8-\xDE]")
_ALPHA_WORD = re.compile(r"[^\W\d_]")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATIOS = ("symbol_ratio", "upper_ratio", "repeat_ratio", "distinct_ratio", "dup_line_ratio", "word_length", "short_ratio", "alpha_ratio")
FEATURES = ("n_words", *RATIOS)


def repeat_words(codes: np.ndarray, size: int = 8) -> int:
    """Words inside windows of size words that the text holds twice or more."""
    n = len(codes) - size + 1
    if n < 2:
        return 0
    windows = np.lib.stride_tricks.sliding_window_view(codes, size)
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            h = h * np.uint64(0x9E3779B97F4A7C15) + codes[i : i + n].astype(np.uint64) + np.uint64(1)
            h ^= h >> np.uint64(29)
    order = np.argsort(h, kind="stable")
    same = np.zeros(n, bool)
    eq = h[order[1:]] == h[order[:-1]]
    if not eq.any():
        return 0
    if not (windows[order[1:][eq]] == windows[order[:-1][eq]]).all():  # a collision: compare the windows themselves
        _, inverse, counts = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
        same = counts[inverse.ravel()] > 1
    else:
        same[order[1:][eq]] = same[order[:-1][eq]] = True
    cover = np.zeros(len(codes) + 1, np.int64)
    np.add.at(cover, np.flatnonzero(same), 1)
    np.add.at(cover, np.flatnonzero(same) + size, -1)
    return int((np.cumsum(cover) > 0).sum())


def text_stats(text: str) -> tuple[float, ...]:
    """COUNTS and RATIOS of a whole text."""
    words = _WORDS.findall(text)
    n = len(words)
    chars = sum(map(len, words))
    symbols = len(_SYMBOLS.findall(text))
    seen: set[str] = set()
    lines = dup = 0
    for line in text.split("\n"):
        if _WORDS.search(line):
            lines += 1
            dup += line in seen
            seen.add(line)
    ids: dict[str, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    repeats = repeat_words(codes)
    short = sum(len(w) <= 3 for w in words)
    upper, alpha = len(_UPPER.findall(text)), sum(1 for w in words if _ALPHA_WORD.search(w))
    one = max(1, n)
    return n, chars, symbols, dup, repeats, symbols / max(1, chars), upper / max(1, chars), repeats / one, len(ids) / one, dup / max(1, lines), chars / one, short / one, alpha / one


def with_stats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, COUNTS (long) and RATIOS (double) of each row, and columns to keep."""

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            rows = [text_stats(t) for t in batch["text"].to_pylist()]
            cols = list(zip(*rows, strict=True)) or [[]] * (len(COUNTS) + len(RATIOS))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *[pa.array(c, pa.int64()) for c in cols[:5]], *[pa.array(c, pa.float64()) for c in cols[5:]], *[batch[c] for c in keep]], ["doc_id", *COUNTS, *RATIOS, *keep])

    small_batches(docs.sparkSession)
    kept = docs.select(*keep).schema
    schema = ", ".join(["doc_id long", *[f"{c} long" for c in COUNTS], *[f"{c} double" for c in RATIOS], *[f"{f.name} {f.dataType.simpleString()}" for f in kept]])
    return docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col).alias("text"), *keep).mapInArrow(stats, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


@dataclass(frozen=True)
class Test:
    feature: str
    at_least: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        v = x[self.feature]
        return v >= self.threshold if self.at_least else v < self.threshold

    def column(self) -> Column:
        c = F.col(self.feature)
        return c >= F.lit(self.threshold) if self.at_least else c < F.lit(self.threshold)


def _all(tests: tuple[Test, ...], x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for t in tests:
        out &= t.holds(x)
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, thresholds: dict[str, np.ndarray], most: int, barred: set[Test]) -> tuple[Test, ...]:
    """The tests of one rule, none of those barred as its first."""
    tests: tuple[Test, ...] = ()
    covered = np.ones(len(bad), bool)
    while len(tests) < most:
        p, n = int((covered & bad).sum()), int((covered & ~bad).sum())
        if not p or not n:
            break
        best, old = (0.0, None), np.log2(p / (p + n))
        for f, cuts in thresholds.items():
            for at_least in (True, False):
                for c in cuts:
                    t = Test(f, at_least, float(c))
                    if not tests and t in barred:
                        continue
                    own = covered & t.holds(x)
                    q = int((own & bad).sum())
                    if q:
                        gain = q * (np.log2(q / int(own.sum())) - old)
                        if gain > best[0] + 1e-9:
                            best = (gain, t)
        if best[1] is None:
            break
        tests, covered = (*tests, best[1]), covered & best[1].holds(x)
    return tests


def learn_list(x: dict[str, np.ndarray], bad: np.ndarray, fold: np.ndarray, *, most_rules: int = 12, most_tests: int = 3, precision: float = 0.97, cuts: int = 24, least: int = 8, most_failures: int = 30) -> list[tuple[Test, ...]]:
    """Ordered rules that cover rows of poor quality. fold: rows of the pruning third."""
    rules: list[tuple[Test, ...]] = []
    barred: set[Test] = set()  # first tests of rules that were not precise
    left = np.ones(len(bad), bool)
    cut = lambda keep: {f: v[keep] for f, v in x.items()}
    thresholds = {f: np.unique(np.round(np.quantile(v, np.linspace(0.01, 0.99, cuts)), 4)) for f, v in x.items() if len(v)}
    while len(rules) < most_rules and len(barred) < most_failures:
        grow, prune = left & ~fold, left & fold
        if (bad & grow).sum() < least:
            break
        tests = grown = _grow(cut(grow), bad[grow], thresholds, most_tests, barred)
        if not tests:
            break
        px, pb = cut(prune), bad[prune]

        def worth(t: tuple[Test, ...], px=px, pb=pb) -> float:
            own = _all(t, px, len(pb))
            p, n = (own & pb).sum(), (own & ~pb).sum()
            return float(p - n) / max(1, p + n)

        while len(tests) > 1 and worth(tests[:-1]) >= worth(tests):
            tests = tests[:-1]
        own = _all(tests, px, len(pb))
        if not own.any() or (own & pb).sum() < precision * own.sum():
            barred.add(grown[0])
            continue
        rules.append(tests)
        left &= ~_all(tests, x, len(bad))
    return rules


def labelled_sample(docs: DataFrame, own: DataFrame, most: int, seed: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text and quality of at most ``most`` labelled rows. own: _label_id and quality, one row for each id.

    The labels are cut by hash of the id; of the rows of an id the one with the least hash of its text counts, so that an
    id on very many rows brings no more.
    """
    own = own.orderBy(F.xxhash64("_label_id", F.lit(seed)), "_label_id").limit(most)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col).alias("text")).join(F.broadcast(own), F.col("doc_id") == F.col("_label_id"))  # most rows at most
    rows = rows.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("quality").alias("quality"))
    return rows.withColumn("_h", F.xxhash64("doc_id", F.lit(seed)))


def labelled_stats(docs: DataFrame, labels: DataFrame, *, max_labelled: int = 20_000, seed: int = 7, id_col: str = "doc_id", text_col: str = "text"):
    """Statistics and labels of a bounded sample of labelled rows, as pandas, in a fixed order."""
    own = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_label_id")).agg(F.min(F.col("quality").cast("int")).alias("quality"))
    chosen = labelled_sample(docs, own, max_labelled, seed, id_col, text_col)
    stats = with_stats(chosen, keep=("quality", "_h"))
    return stats.toPandas().sort_values(["_h", "doc_id", *COUNTS]).reset_index(drop=True)


def learn(docs: DataFrame, labels: DataFrame, **options) -> list[tuple[Test, ...]]:
    rows = labelled_stats(docs, labels, **options)
    bad = (rows["quality"] == 0).to_numpy(bool)
    return learn_list({f: rows[f].to_numpy(float) for f in FEATURES}, bad, np.arange(len(rows)) % 3 == 2) if len(rows) else []


def decision(rules: list[tuple[Test, ...]]) -> Column:
    """The number of the first rule that holds, 0 for none: a chain of conditions in order."""
    out = None
    for i, tests in enumerate(rules, 1):
        both = tests[0].column()
        for t in tests[1:]:
            both = both & t.column()
        out = F.when(both, i) if out is None else out.when(both, i)
    return F.lit(0) if out is None else out.otherwise(0)


def quality_digest(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and the number of the rule that decided (0: none)."""
    rules = learn(docs, labels, **options)
    keys = {k: v for k, v in options.items() if k in ("id_col", "text_col")}
    rows = with_stats(docs, **keys).withColumn("base_failed", base_failed()).withColumn("rule", decision(rules))
    return rows.select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"), "rule")
