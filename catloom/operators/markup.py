"""Elements of pages (E3, E14, E16, E18): one tokenizer of tags and attributes for links, images and form tables.

``page_elements`` reads a page with the standard parser: attributes in any quotes or none, entities undone, comments, scripts
and styles left out. What it gives is rows, and links, images and choices are DataFrame functions over them.

Defined cases: a null page has no elements; an attribute without a value is blank; of several attributes of a name the first
counts; elements that nothing closes end with the page; a page number that is no number is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catloom.functions.text import clean_ws, fold_text
from catloom.functions.urls import query_int, query_param

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_ENDS = {"option": ("select",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "li": ("ul", "ol")}
_URLS = ("href", "src", "data-src", "data-original")
_ELEMENTS = "pos long, tag string, attrs map<string,string>, text string, inside array<string>, parent long"


class _Elements(HTMLParser):
    """Wanted elements in order of their start tags: tag, attributes, text, the classes of what is around, the wanted element around."""

    def __init__(self, wanted: frozenset[str], around: frozenset[str]):
        super().__init__(convert_charrefs=True)
        self.wanted, self.around, self.out, self.open, self.skip = wanted, around, [], [], 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        own: dict[str, str] = {}
        for name, value in attrs:
            own.setdefault(name, value or "")
        for kind in (tag, {"td": "th", "th": "td"}.get(tag)):  # what is open of a kind in the same list or table ends here
            if kind in _ENDS:
                self._close(kind, until=_ENDS[kind])
        at = -1
        if tag in self.wanted:
            inside = [x for name, names, _ in self.open if name in self.around for x in names]
            parent = next((k for _, _, k in reversed(self.open) if k >= 0), -1)
            at = len(self.out)
            self.out.append([tag, own, [], inside, parent])
        if tag in ("script", "style"):
            self.skip += 1
        if tag == "br":
            self.handle_data("\n")
        if tag not in _VOID:
            self.open.append((tag, [tag, *(f"{tag}.{x}" for x in own.get("class", "").split()), *([f"{tag}#{own['id']}"] if own.get("id") else [])], at))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def _close(self, tag: str, until: tuple[str, ...] = ()) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                return
            if self.open[k][0] in until:
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        self._close(tag)

    def handle_data(self, data: str) -> None:
        if not self.skip:
            for _, _, k in self.open:
                if k >= 0:
                    self.out[k][2].append(data)


def page_elements(pages: DataFrame, tags: list[str], *, page_id: str = "page_id", html: str = "html", url: str | None = None, around: list[str] = ("div", "nav", "ul", "table", "article", "form", "select")) -> DataFrame:
    """page_id, pos, tag, attrs, text, inside, parent of the elements of these tags, in document order.

    inside: the elements of the tags in around that an element stands in, outermost first, each as its tag, tag.class and
    tag#id; parent: pos of the nearest of the given elements around it, -1 without one. url: a column with the page's address;
    addresses in attributes are then resolved against it.
    """
    wanted, outer, kind = frozenset(tags), frozenset(around), pages.schema[page_id].dataType.simpleString()

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for i, base, source in zip(pdf["page_id"], pdf["base"], pdf["html"], strict=True):
                p = _Elements(wanted, outer)
                p.feed(source or "")
                p.close()
                for pos, (tag, attrs, text, inside, parent) in enumerate(p.out):
                    if base:
                        attrs = attrs | {k: _resolved(base, attrs[k]) for k in _URLS if attrs.get(k)}
                    out.append((i, pos, tag, attrs, " ".join("".join(text).split()), inside, parent))
            yield pd.DataFrame(out, columns=["page_id", "pos", "tag", "attrs", "text", "inside", "parent"])

    base = F.col(url) if url else F.lit(None).cast("string")
    return pages.select(F.col(page_id).alias("page_id"), base.alias("base"), F.col(html).alias("html")).mapInPandas(walk, f"page_id {kind}, {_ELEMENTS}")


def _resolved(base: str, link: str) -> str:
    try:
        return urljoin(base, link.strip())
    except ValueError:  # no address at all
        return link.strip()


def links(elements: DataFrame, pattern: str = ".", *, within: str | None = None) -> DataFrame:
    """Distinct link targets of a page that match, in order of their first place: page_id, link, pos, page, text of the first.

    within: only links inside such an element (a tag, tag.class or tag#id). page: the link's page parameter, 1 without one.
    """
    rows = elements.where((F.col("tag") == "a") & F.col("attrs")["href"].rlike(pattern))
    if within:
        rows = rows.where(F.array_contains("inside", within))
    rows = rows.withColumn("link", F.regexp_replace(F.trim(F.col("attrs")["href"]), "#.*$", "")).where("link <> ''")
    rows = rows.groupBy("page_id", "link").agg(F.min(F.struct("pos", "text")).alias("f"))
    has = query_param(F.col("link"), "page")
    return rows.select("page_id", "link", F.col("f.pos").alias("pos"), F.when(F.coalesce(has, F.lit("")) == "", F.lit(1)).otherwise(query_int(F.col("link"), "page")).cast("long").alias("page"), F.col("f.text").alias("text"))


def page_links(elements: DataFrame, addresses: DataFrame, *, within: str | None = None, same_query: list[str] = (), url: str = "url") -> DataFrame:
    """Links to further pages of the list that a page is part of: same host and path, and the same filters in the query.

    addresses: page_id and the page's address. The links must be absolute (page_elements with url).
    """
    rows = links(elements, within=within).join(addresses.select("page_id", F.col(url).alias("_u")), "page_id")
    part = lambda c, p: F.regexp_replace(F.lower(F.coalesce(F.try_parse_url(F.col(c), F.lit(p)), F.lit(""))), "/+$", "")
    for p in ("HOST", "PATH"):
        rows = rows.where(part("link", p) == part("_u", p))
    for k in same_query:
        rows = rows.where(query_param(F.col("link"), k).eqNullSafe(query_param(F.col("_u"), k)))
    return rows.drop("_u")


def srcset(c: Column) -> Column:
    """The addresses of a srcset: candidates end with a comma and a blank, or a comma after a width or density."""
    parts = F.split(F.regexp_replace(F.trim(c), r"(\s[0-9.]+[wx])\s*,\s*", "$1, "), r",\s+")
    return F.filter(F.transform(parts, lambda x: F.rtrim(F.split_part(F.trim(x), F.lit(" "), F.lit(1)), F.lit(","))), lambda x: x != "")


def images(elements: DataFrame) -> DataFrame:
    """page_id, pos, n, url, alt, title: candidate addresses of img and source elements, the plain ones first."""
    own = F.col("attrs")
    plain = F.array_compact(F.array(*[F.nullif(F.trim(own[a]), F.lit("")) for a in ("src", "data-src", "data-original")]))
    several = F.concat(*[F.coalesce(srcset(own[a]), F.array().cast("array<string>")) for a in ("srcset", "data-srcset")])
    rows = elements.where(F.col("tag").isin("img", "source"))
    rows = rows.select("page_id", "pos", F.posexplode(F.array_distinct(F.concat(plain, several))).alias("n", "url"), own["alt"].alias("alt"), own["title"].alias("title"))
    return rows.withColumn("n", F.col("n").cast("long"))


def choices(elements: DataFrame) -> DataFrame:
    """page_id, pos, name, value, label of each select (at pos): the option that is selected, else the first one.

    elements: of tags select and option. A value that is not given is the label; of several selected options the last counts.
    """
    options = elements.where("tag = 'option'").select("page_id", F.col("parent").alias("_s"), F.struct(F.col("attrs")["selected"].isNotNull().cast("int").alias("s"), F.when(F.col("attrs")["selected"].isNotNull(), F.col("pos")).otherwise(-F.col("pos")).alias("p"), F.coalesce(F.col("attrs")["value"], "text").alias("value"), F.col("text").alias("label")).alias("o"))
    best = options.groupBy("page_id", "_s").agg(F.max("o").alias("o"))
    selects = elements.where("tag = 'select'").select("page_id", "pos", F.coalesce(F.col("attrs")["name"], F.col("attrs")["id"]).alias("name"))
    rows = selects.join(best.withColumnRenamed("_s", "pos"), ["page_id", "pos"], "left")
    return rows.select("page_id", "pos", "name", F.col("o.value").alias("value"), F.col("o.label").alias("label"))


def table_cells(elements: DataFrame, *, within: str | None = None) -> DataFrame:
    """page_id, pos (of the row), cells: a table row's texts; a cell with a select has the label of its choice instead.

    elements: of tags tr, td, th, select, option. within: only rows inside such an element, as in links. Rows of a table
    inside a cell are rows of their own.
    """
    rows = elements.where("tag = 'tr'")
    if within:
        rows = rows.where(F.array_contains("inside", within))
    picked = choices(elements).join(elements.where("tag = 'select'").select("page_id", "pos", F.col("parent").alias("_cell")), ["page_id", "pos"])
    picked = picked.groupBy("page_id", F.col("_cell").alias("pos")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "label"))), lambda x: F.coalesce(x["label"], F.lit(""))), " ").alias("picked"))
    cells = elements.where("tag in ('td', 'th')").join(picked, ["page_id", "pos"], "left").select("page_id", F.col("parent").alias("_row"), F.struct("pos", F.coalesce("picked", "text").alias("text")).alias("c"))
    cells = cells.groupBy("page_id", "_row").agg(F.transform(F.array_sort(F.collect_list("c")), lambda x: x["text"]).alias("cells"))
    return rows.select("page_id", "pos").join(cells.withColumnRenamed("_row", "pos"), ["page_id", "pos"], "left").select("page_id", "pos", F.coalesce("cells", F.array().cast("array<string>")).alias("cells"))


def table_problems(pages: DataFrame, cells: DataFrame, least: int = 1, *, page_id: str = "page_id") -> DataFrame:
    """page_id and problem of the pages without a row of that many cells: an empty page is an error, not an empty result."""
    found = cells.groupBy("page_id").agg(F.max(F.size("cells")).alias("_n"))
    problem = F.when(F.col("_n").isNull(), "no table row").when(F.col("_n") < least, "rows are too short")
    return pages.select(F.col(page_id).alias("page_id")).join(found, "page_id", "left").select("page_id", problem.alias("problem")).where("problem is not null")


def place_at_end(rows: DataFrame, key: str, text: str, places: DataFrame, place: str = "place") -> DataFrame:
    """key, place and subject: the longest known place that a text ends with, and what stands before it; nulls without one.

    Every run of words at the end of a text is looked up among the places (folded: case, accents and spacing do not count), by
    a join, so there may be any number of places. Of places that fold alike the least counts.
    """
    own = places.where(fold_text(F.col(place)) != "").groupBy(fold_text(F.col(place)).alias("_f")).agg(F.min(place).alias("place"))
    words = rows.select(F.col(key), F.split(clean_ws(F.col(text)), " ").alias("_w"))
    ends = words.select(key, "_w", F.explode(F.sequence(F.lit(1), F.size("_w"))).alias("_i")).withColumn("_f", fold_text(F.array_join(F.expr("slice(_w, _i, size(_w))"), " ")))
    best = ends.join(own, "_f").groupBy(key).agg(F.min(F.struct("_i", "place", F.expr("slice(_w, 1, _i - 1)").alias("w"))).alias("b"))
    subject = F.regexp_replace(F.array_join("b.w", " "), r"[\s,;-]+$", "")
    return rows.select(key).join(best, key, "left").select(key, F.col("b.place").alias("place"), F.when(F.col("b").isNotNull(), subject).alias("subject"))
