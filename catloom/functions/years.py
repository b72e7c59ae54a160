"""Year functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LAST = 1_000_000_000


def _ints(c: Column, pattern: str) -> Column:
    return F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(pattern), F.lit(0)), lambda x: x.cast("int"))


def parse_years(c: Column) -> Column:
    """The first 'YYYY' or 'YYYY - YYYY': first and last year."""
    first = F.nullif(F.regexp_extract(c, r"(\d{4})(?:\s*-\s*(\d{4}))?", 1), F.lit(""))
    last = F.nullif(F.regexp_extract(c, r"(\d{4})(?:\s*-\s*(\d{4}))?", 2), F.lit(""))
    return F.struct(first.cast("int").alias("first"), F.coalesce(last, first).cast("int").alias("last"))


def year_bounds(c: Column) -> Column:
    """Least and greatest of all numbers of exactly four digits."""
    years = _ints(c, r"\b\d{4}\b")
    return F.struct(F.array_min(years).alias("first"), F.array_max(years).alias("last"))


def issue_sort_key(c: Column) -> Column:
    """First and last number of three or four digits; blank sorts last."""
    years = _ints(c, r"\d{3,4}")
    return F.struct(F.coalesce(F.try_element_at(years, F.lit(1)), F.lit(LAST)).alias("first"), F.coalesce(F.try_element_at(years, F.lit(-1)), F.lit(LAST)).alias("last"))


def single_year(url: Column, first: Column, last: Column) -> Column:
    """The year at the end of the url's slug, for an item of one year; null where the range is longer or the url has none."""
    path = F.regexp_replace(F.coalesce(url, F.lit("")), "[?#].*$", "")
    return F.when(first == last, F.nullif(F.regexp_extract(path, r"-(\d{4})/?$", 1), F.lit("")).cast("int"))


def safe_year_extension(current: Column, proposed: Column) -> Column:
    """Both hold exactly two years, the first agrees and the second is later."""
    a, b = _ints(current, r"\b\d{4}\b"), _ints(proposed, r"\b\d{4}\b")
    at = lambda x, i: F.try_element_at(x, F.lit(i))
    return F.coalesce((F.size(a) == 2) & (F.size(b) == 2) & (at(a, 1) == at(b, 1)) & (at(b, 2) > at(a, 2)), F.lit(False))
