"""URL functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catloom.functions.text import slugify


def _part(c: Column, part: str) -> Column:
    return F.try_parse_url(c, F.lit(part))


def unwrap_markdown(c: Column) -> Column:
    """'[text](http...)' as its url, with a flag that it was one; fragments go."""
    inner = F.nullif(F.regexp_extract(F.trim(c), r"(?i)^\[[^\]]+\]\((https?://[^)]+)\)$", 1), F.lit(""))
    return F.struct(F.regexp_replace(F.coalesce(inner, F.trim(c)), "#.*$", "").alias("url"), inner.isNotNull().alias("was_markdown"))


def is_http_url(c: Column) -> Column:
    return F.coalesce(F.lower(_part(c, "PROTOCOL")).isin("http", "https") & (F.coalesce(_part(c, "HOST"), F.lit("")) != ""), F.lit(False))


def query_param(c: Column, key: str) -> Column:
    return F.try_parse_url(c, F.lit("QUERY"), F.lit(key))


def query_int(c: Column, key: str) -> Column:
    return query_param(c, key).try_cast("bigint")


def sorted_query(c: Column, drop_first_page: bool = True) -> Column:
    """The query's items in order, without a blank or first page number."""
    items = F.filter(F.split(F.coalesce(_part(c, "QUERY"), F.lit("")), "&"), lambda x: x != "")
    if drop_first_page:
        items = F.filter(items, lambda x: ~x.isin("page=", "page=1"))
    return F.array_join(F.array_sort(items), "&")


def canonical_page_url(c: Column) -> Column:
    """Host in lower case, no closing slash, sorted query without a first page; null for what is no url."""
    host, path, query = F.lower(_part(c, "HOST")), F.regexp_replace(F.coalesce(_part(c, "PATH"), F.lit("")), "/+$", ""), sorted_query(c)
    base = F.concat(F.lower(_part(c, "PROTOCOL")), F.lit("://"), host, path)
    return F.when(query != "", F.concat(base, F.lit("?"), query)).otherwise(base)


def url_stem(c: Column) -> Column:
    """Slug of the last part of the path, without its extension."""
    path = F.regexp_replace(F.coalesce(F.try_url_decode(_part(c, "PATH")), F.lit("")), "/+$", "")
    return slugify(F.regexp_replace(F.regexp_extract(path, "([^/]*)$", 1), r"\.[A-Za-z0-9]+$", ""))


def detail_stem(c: Column) -> Column:
    """Slug of the path below /coin/, of the page that a login link refers to if it is one."""
    own = F.regexp_replace(F.coalesce(F.try_url_decode(_part(c, "PATH")), F.lit("")), "^/+|/+$", "")
    target = F.try_url_decode(query_param(c, "ref"))
    named = F.regexp_replace(F.coalesce(F.try_url_decode(_part(target, "PATH")), target, F.lit("")), "^/+|/+$", "")
    return slugify(F.regexp_replace(F.when((own == "login") & target.isNotNull(), named).otherwise(own), "^coin/", ""))


def strip_trailing_years(c: Column) -> Column:
    return F.regexp_replace(c, r"(^|-)\d{4}(-\d{4})*$", "")


def slug_compatible(a: Column, b: Column) -> Column:
    """Equal, or one holds the other, once years at the end are gone; a blank one agrees with all."""
    x, y = strip_trailing_years(F.coalesce(a, F.lit(""))), strip_trailing_years(F.coalesce(b, F.lit("")))
    return (x == "") | (y == "") | F.contains(x, y) | F.contains(y, x)


def image_parts(c: Column) -> Column:
    """Asset number, side, the other side's url, the url in full size, and the example year of '.../123-1s/name-1957.jpg'."""
    url = F.trim(F.coalesce(c, F.lit("")))
    side = F.nullif(F.regexp_extract(url, "-([12])s?/", 1), F.lit(""))
    name = F.regexp_extract(F.coalesce(_part(c, "PATH"), F.lit("")), "([^/]*)$", 1)
    other = F.when(side.isNotNull(), F.concat(F.regexp_extract(url, "^(.*?)-[12]s?/", 1), F.when(side == "1", "-2/").otherwise("-1/"), F.regexp_extract(url, "^.*?-[12]s?/(.*)$", 1)))
    return F.struct(
        F.nullif(F.regexp_extract(url, "/([0-9]+)-[12]s?/", 1), F.lit("")).alias("asset"),
        F.when(side == "1", "obverse").when(side == "2", "reverse").alias("side"),
        other.alias("other_side"),
        F.regexp_replace(url, "-([12])s/", "-$1/").alias("full_size"),
        F.nullif(F.regexp_extract(name, r"(?i)(?:^|-)(\d{4})\.[a-z0-9]+$", 1), F.lit("")).try_cast("int").alias("year"),
    )


def record_id(explicit: Column, url: Column) -> Column:
    """An id that is given, else the last part of the url's path."""
    return F.coalesce(F.nullif(F.trim(explicit), F.lit("")), F.nullif(F.regexp_extract(F.regexp_replace(F.coalesce(_part(url, "PATH"), F.lit("")), "/+$", ""), "([^/]*)$", 1), F.lit("")))


def reference_url(base: str, *parts: Column, fragment: Column | None = None) -> Column:
    url = F.concat_ws("/", F.lit(base.rstrip("/")), *[F.url_encode(p.cast("string")) for p in parts])
    return url if fragment is None else F.concat(url, F.lit("#"), F.url_encode(fragment.cast("string")))
