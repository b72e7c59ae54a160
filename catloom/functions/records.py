"""Functions of whole records, and the two Arrow UDFs for what no built-in expresses."""

from __future__ import annotations

import unicodedata
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def completeness(df: DataFrame, cols: list[str] | None = None) -> Column:
    """Number of leaves, structs opened, that are neither null nor blank."""

    def leaves(c: Column, kind: T.DataType) -> list[Column]:
        if isinstance(kind, T.StructType):
            return [x for f in kind.fields for x in leaves(c[f.name], f.dataType)]
        filled = c.isNotNull() & (F.trim(c) != "") if isinstance(kind, T.StringType) else c.isNotNull()
        return [F.when(filled, 1).otherwise(0)]

    out = F.lit(0)
    for f in df.schema.fields:
        if cols is None or f.name in cols:
            for x in leaves(df[f.name], f.dataType):
                out = out + x
    return out


def canonical_json(*cols: Column | str, names: list[str] | None = None) -> Column:
    """JSON with keys in order and nulls kept."""
    names = names or [c for c in cols if isinstance(c, str)]
    pairs = sorted(zip(names, cols, strict=True), key=lambda x: x[0])
    return F.to_json(F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in pairs]), {"ignoreNullFields": "false"})


def row_hash(*cols: Column | str, names: list[str] | None = None) -> Column:
    return F.sha2(canonical_json(*cols, names=names), 256)


@lru_cache(1 << 16)  # names repeat within a task
def _ratio(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()


@F.pandas_udf(T.DoubleType())
def difflib_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Similarity of two names; the order of the arguments matters, and nulls count as blank."""
    return pd.Series([_ratio(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype=float)


@F.pandas_udf(T.StringType())
def nfkd_fold(c: pd.Series) -> pd.Series:
    """Compatibility decomposition without marks, case-folded, single spaces."""
    return c.map(lambda x: None if x is None else " ".join("".join(k for k in unicodedata.normalize("NFKD", x) if not unicodedata.combining(k)).casefold().split()))
