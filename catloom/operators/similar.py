"""Names alike without a common block (M4, M5): an inverted index that leaves out no pair the score could accept.

The similarity of two names is the asymmetric ratio of ``functions.records.difflib_ratio``: twice the characters in matching
blocks over both lengths. No block can match more characters than both names have in common, counted with repeats. So a pair
of ratio r has at least r / 2 of both lengths in common, and the lengths differ at most by the factor (2 - r) / r. Each
name is the set of its characters, numbered where they repeat ('e1', 'e2', ...), the rarest over all names first; pairs that
have enough in common share one of the first few of each (the prefix of a set similarity join). What shares one is held
against the places of the shared character, then against the whole sets, and only what is left is scored.

Work is on distinct names; rows of equal names share their scores. Names that are alike by their letters alone cannot be told
apart by such an index: candidates grow with the square of the number of names that share rare characters, and more so the
smaller the ratio.

Defined cases: null and blank names are like nothing; names are compared as they are given (fold them first).
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catloom.functions.records import difflib_ratio
from catloom.operators.match import score, top_of_classes
from catloom.sources.shared import stored


@F.pandas_udf(T.ArrayType(T.StringType()))
def numbered_characters(names: pd.Series) -> pd.Series:
    """Each character with the number of its occurrence so far."""

    def of(name: str) -> list[str]:
        seen: Counter = Counter()
        return [f"{c}{seen.update(c) or seen[c]}" for c in name]

    return names.map(of)


def _least_common(n: Column, m: Column, least: float) -> Column:
    """Characters that names of n and m must have in common for a ratio of least."""
    return F.ceil(F.lit(least / 2 - 1e-9) * (n + m))


def _side(names: DataFrame, order: DataFrame, least: float) -> DataFrame:
    """name, n, tokens (rarest first)."""
    rows = names.select("name", F.explode(numbered_characters("name")).alias("t")).join(order, "t")
    tokens = F.transform(F.array_sort(F.collect_list(F.struct("c", "t"))), lambda x: x["t"])
    return rows.groupBy("name").agg(tokens.alias("tokens"), F.count("*").cast("int").alias("n"))


def candidate_pairs(items: DataFrame, records: DataFrame, item_name: str, record_name: str, *, least: float = 0.7) -> DataFrame:
    """a, b: the distinct names of items and records whose ratio may be least or more; no such pair is left out."""
    named = lambda df, c: df.select(F.col(c).cast("string").alias("name")).where(F.trim("name") != "").distinct()
    a, b = stored(named(items, item_name), "names-a"), stored(named(records, record_name), "names-b")
    both = a.unionByName(b).distinct()
    order = both.select(F.explode(numbered_characters("name")).alias("t")).groupBy("t").agg(F.count("*").alias("c"))
    sides = [stored(_side(x, order, least), "names") for x in (a, b)]
    shortest = F.ceil(F.col("n") * (least / (2 - least) - 1e-9))  # a name must be at least so long to be alike
    first = F.col("n") - _least_common(F.col("n"), shortest, least) + 1
    keyed = [s.select("name", "n", F.posexplode(F.slice("tokens", F.lit(1), first.cast("int"))).alias("at", "t")) for s in sides]
    x, y = keyed[0].alias("x"), keyed[1].alias("y")
    common = _least_common(F.col("x.n"), F.col("y.n"), least)
    reach = F.least("x.at", "y.at") + F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at"))  # most they can share, given this place
    pairs = x.join(y, (F.col("x.t") == F.col("y.t")) & (reach >= common)).select(F.col("x.name").alias("a"), F.col("y.name").alias("b")).distinct()
    sets = [s.select(F.col("name").alias(c), F.col("tokens").alias(f"_{c}"), F.col("n").alias(f"_n{c}")) for s, c in zip(sides, "ab", strict=True)]
    full = pairs.join(sets[0], "a").join(sets[1], "b")
    return full.where(F.size(F.array_intersect("_a", "_b")) >= _least_common(F.col("_na"), F.col("_nb"), least)).select("a", "b")


def similar_names(items: DataFrame, records: DataFrame, item_name: str, record_name: str, *, least: float = 0.7) -> DataFrame:
    """a, b, ratio of the distinct names of items and records that are alike by least or more."""
    pairs = stored(candidate_pairs(items, records, item_name, record_name, least=least), "names-pairs")
    return pairs.withColumn("ratio", difflib_ratio("a", "b")).where(F.col("ratio") >= least)


def top_similar(items: DataFrame, records: DataFrame, k: int, *, item_id: str = "item_id", record_id: str = "record_id", name: str = "name", amount: str = "amount", years: str = "years", least: float = 0.7) -> DataFrame:
    """item_id, record_id, points, rank: the k best records with points above 0 for each item, over all records.

    What match.top_candidates with the asymmetric score gives without a block, for names that are not blank: items with a
    blank name, which are only told apart by their years, have no candidates here.
    """
    alike = stored(similar_names(items, records, name, name, least=least), "names-alike")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    side = lambda df, key: df.select(key, *[text(c).alias(c) for c in (name, amount, years)]).where(F.trim(name) != "")
    pairs = lambda i, r: i.join(alike, F.col(f"i_{name}") == F.col("a")).join(r, F.col("b") == F.col(f"r_{name}"))
    i, r = ([f"{p}_{c}" for c in (amount, name, years)] for p in "ir")
    points = score(F.col(i[0]), F.col(r[0]), F.col(i[1]), F.col(r[1]), F.col(i[2]), F.col(r[2]), ratio=F.col("ratio"))
    return top_of_classes(side(items, item_id), side(records, record_id), k, pairs, points, item_id=item_id, record_id=record_id)
