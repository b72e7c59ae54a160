"""Extraction jobs over pages and texts (E1-E20). Regular expressions first; the standard parser only where nesting counts."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catloom.functions.text import blank_to_null, clean_ws, cut_at_stop, fold_text
from catloom.functions.urls import canonical_page_url, query_int, query_param
from catloom.operators import markup


def html_to_text(c: Column) -> Column:
    """Text without scripts, styles, comments and tags; breaks become blanks."""
    c = F.regexp_replace(c, r"(?is)<(script|style)\b[^>]*>.*?</(script|style)>", " ")
    c = F.regexp_replace(c, r"(?s)<!--.*?-->", " ")
    return clean_ws(F.regexp_replace(F.regexp_replace(c, r"(?i)<br\s*/?>", " "), r"<[^>]*>", ""))


class _Blocks(HTMLParser):
    """Text and attributes of the elements that match, in document order; nested matches belong to the outer one."""

    def __init__(self, wanted: dict[str, tuple[str, str]]):
        super().__init__(convert_charrefs=True)
        self.wanted, self.out, self.depth, self.open = wanted, [], 0, None
        self.tags = frozenset(name for name, _ in wanted.values())

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.open is None and tag in self.tags:
            classes = (dict(attrs).get("class") or "").split()
            for kind, (name, css) in self.wanted.items():
                if tag == name and (not css or css in classes):
                    self.open, self.depth = [tag, kind, [], {k: v or "" for k, v in attrs}], 0
                    break
        if self.open is not None and tag == self.open[0]:
            self.depth += 1

    def handle_endtag(self, tag: str) -> None:
        if self.open is not None and tag == self.open[0]:
            self.depth -= 1
            if not self.depth:
                self.out.append((self.open[1], " ".join("".join(self.open[2]).split()), self.open[3]))
                self.open = None

    def handle_data(self, data: str) -> None:
        if self.open is not None:
            self.open[2].append(data)


def page_blocks(pages: DataFrame, wanted: dict[str, tuple[str, str]], *, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """page_id, pos, kind, text and attrs of the elements named in wanted (kind: tag and class, '' for any)."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for i, source in zip(pdf["page_id"], pdf["html"], strict=True):
                p = _Blocks(wanted)
                p.feed(source or "")
                out += [(i, pos, kind, text, attrs) for pos, (kind, text, attrs) in enumerate(p.out)]
            yield pd.DataFrame(out, columns=["page_id", "pos", "kind", "text", "attrs"])

    kind = pages.schema[page_id].dataType.simpleString()
    return pages.select(F.col(page_id).alias("page_id"), F.col(html).alias("html")).mapInPandas(walk, f"page_id {kind}, pos long, kind string, text string, attrs map<string,string>")


def catalogue_items(blocks: DataFrame, *, fallback: Column | None = None, own: Column | None = None, header: str = "header", hint: str = "hint", item: str = "item") -> DataFrame:
    """Items of a page with the section they stand in: the last header before them, or the fallback with a warning.

    own: the section that an item itself names; where it disagrees with the open one it wins, with a warning.
    """
    w = Window.partitionBy("page_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = blocks.withColumn("_s", F.last(F.when(F.col("kind") == header, F.col("text")), ignorenulls=True).over(w)).withColumn("hint", F.last(F.when(F.col("kind") == hint, F.col("text")), ignorenulls=True).over(w))
    rows = rows.where(F.col("kind") == item)
    named = own if own is not None else F.lit(None).cast("string")
    moved = named.isNotNull() & ~named.eqNullSafe(F.col("_s")) & F.col("_s").isNotNull()
    section = F.coalesce(named, F.col("_s"), fallback if fallback is not None else F.lit(None).cast("string"))
    warning = F.when(moved, "section differs").when(F.col("_s").isNull(), "before any header")
    return rows.withColumn("section", section).withColumn("warning", warning).drop("_s")


def section_items(blocks: DataFrame, opens: Column, own_id: Column, *, header: str = "header", hint: str = "hint", item: str = "item") -> DataFrame:
    """Items with the number and id of the section they belong to. opens: which headers open one (section 0 is the fallback
    before any). A section's id is the first own_id among its items; an item with another one goes to the earliest section
    before it that has this id, else to a section of its own for that id (number null), with a warning.
    """
    w = Window.partitionBy("page_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    starts = (F.col("kind") == header) & F.coalesce(opens, F.lit(False))
    rows = blocks.withColumn("open_no", F.sum(F.when(starts, 1).otherwise(0)).over(w)).withColumn("title", F.last(F.when(starts, F.col("text")), ignorenulls=True).over(w))
    note = Window.partitionBy("page_id", "open_no").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("hint", F.last(F.when((F.col("kind") == hint) & (F.col("open_no") > 0), F.col("text")), ignorenulls=True).over(note))
    rows = rows.where(F.col("kind") == item).withColumn("own_id", own_id)
    ids = rows.where("own_id is not null").groupBy("page_id", "open_no").agg(F.min_by("own_id", "pos").alias("section_id"))
    rows = rows.join(ids, ["page_id", "open_no"], "left")
    moved = F.col("own_id").isNotNull() & (F.col("own_id") != F.col("section_id"))
    earlier = ids.select("page_id", F.col("section_id").alias("own_id"), F.col("open_no").alias("_no"))
    homes = rows.where(moved).join(earlier, ["page_id", "own_id"]).where("_no < open_no").groupBy("page_id", "pos").agg(F.min("_no").alias("_home"))
    rows = rows.join(homes, ["page_id", "pos"], "left")
    warning = F.when(moved, "section differs").when(F.col("open_no") == 0, "before any header")
    return rows.select("page_id", "pos", "text", F.when(moved, F.col("_home")).otherwise(F.col("open_no")).alias("section"), F.when(moved, F.col("own_id")).otherwise(F.col("section_id")).alias("section_id"), F.when(~F.coalesce(moved, F.lit(False)), F.col("title")).alias("title"), "hint", warning.alias("warning"))


def extract_links(pages: DataFrame, pattern: str, *, page_id: str = "page_id", html: str = "html", url: str = "url", same_query: list[str] = ()) -> DataFrame:
    """Distinct links of a page that match, in order of their first place, with page number; filters of the url must agree.

    Links are as written, entities undone; ``markup.page_links`` resolves them.
    """
    rows = markup.links(markup.page_elements(pages, ["a"], page_id=page_id, html=html), pattern)
    if same_query:
        rows = rows.join(pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("_u")), "page_id")
        for k in same_query:
            rows = rows.where(query_param(F.col("link"), k).eqNullSafe(query_param(F.col("_u"), k)))
    return rows.select(F.col("page_id").alias(page_id), "link", "pos", "page")


def labelled(text: Column, labels: list[str]) -> Column:
    """From 'A: x B: y' the value of each label, up to the next known one."""
    stop = "|".join(f"{x}:" for x in labels)
    return F.struct(*[blank_to_null(F.regexp_extract(text, rf"(?s)(?:^|\b){x}:\s*(.*?)\s*(?=(?:{stop})|$)", 1)).alias(x) for x in labels])


def design_description(c: Column, stops: list[str] = ()) -> Column:
    """A design's description with single spaces, cut at the earliest of the stop patterns (in either case), if any."""
    text = clean_ws(c)
    return F.regexp_replace(cut_at_stop(text, [f"(?i:{p})" for p in stops]) if stops else text, r"^[ ,;.]+|[ ,;.]+$", "")


_MARK = r"(?:^|[\s;:(])(\d{1,3})[).:]\s+"
_CHUNK = 64  # marks that a fold gathers before it adds them to the others


def numbered(docs: DataFrame, doc_id: str, text: str, shared: str | None = None, stops: list[str] = ()) -> DataFrame:
    """Numbered lists in running text: doc_id, list, n, entry. A list starts at each 1; only its last number plus 1 goes on
    with it, other numbers are text. Lists with an empty entry are out; text after `shared` in the last entry is all entries'.
    """
    marks = F.regexp_extract_all(text, F.lit(_MARK), F.lit(1))
    kept_type = "array<struct<list:int,n:int,i:int>>"
    state = lambda lst, n, kept: F.struct(lst.alias("list"), n.alias("n"), kept.alias("kept"))

    def step(acc: Column, x: Column) -> Column:
        opens, goes = x["m"] == 1, (acc["list"] > 0) & (x["m"] == acc["n"] + 1)
        lst = F.when(opens, acc["list"] + 1).otherwise(acc["list"])
        own = F.struct(lst.alias("list"), x["m"].alias("n"), x["i"].alias("i"))
        return F.when(opens | goes, state(lst, x["m"], F.concat(acc["kept"], F.array(own)))).otherwise(acc)

    def chunk(acc: Column, c: Column) -> Column:
        # what a chunk keeps is gathered apart, so that the whole is copied once for each chunk and not for each mark
        some = F.slice(F.col("_marks"), c * _CHUNK + 1, F.lit(_CHUNK))
        got = F.reduce(some, state(acc["list"], acc["n"], F.array().cast(kept_type)), step)
        return state(got["list"], got["n"], F.concat(acc["kept"], got["kept"]))

    placed = docs.select(doc_id, F.split(text, _MARK, -1).alias("_parts"), F.transform(marks, lambda m, i: F.struct(m.cast("int").alias("m"), (i + 1).alias("i"))).alias("_marks")).where(F.size("_marks") > 0)
    chunks = F.sequence(F.lit(0), F.floor((F.size("_marks") - 1) / _CHUNK).cast("int"))
    placed = placed.withColumn("_kept", F.reduce(chunks, state(F.lit(0), F.lit(0), F.array().cast(kept_type)), chunk)["kept"])
    # an entry reaches to the next mark that is kept; marks between are text
    pieces = F.transform(F.col("_marks"), lambda x: F.concat(x["m"].cast("string"), F.lit(" "), F.element_at("_parts", x["i"] + 1)))
    placed = placed.withColumn("_pieces", pieces)

    def entry(x: Column, k: Column) -> Column:
        end = F.when(k + 1 < F.size("_kept"), F.get("_kept", k + 1)["i"]).otherwise(F.size("_marks") + 1)
        words = F.concat(F.array(F.element_at("_parts", x["i"] + 1)), F.slice("_pieces", x["i"] + 1, end - x["i"] - 1))
        return F.struct(x["list"].alias("list"), x["n"].alias("n"), F.array_join(words, " ").alias("entry"))

    rows = placed.select(doc_id, F.inline(F.transform("_kept", entry))).withColumn("entry", design_description(F.col("entry"), stops))
    w = Window.partitionBy(doc_id, "list")
    if shared:
        tail = F.last(F.nullif(F.regexp_extract("entry", rf"(?i)\s+({shared}.*)$", 1), F.lit("")), ignorenulls=True).over(w.orderBy("n").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        rows = rows.withColumn("_t", tail).withColumn("entry", F.regexp_replace("entry", rf"(?i)\s+{shared}.*$", "")).withColumn("entry", F.concat_ws(" / ", "entry", "_t")).drop("_t")
    return rows.withColumn("_m", F.min(F.length("entry")).over(w)).where("_m > 0").drop("_m")


def line_lists(docs: DataFrame, doc_id: str, text: str, stops: list[str] = ()) -> DataFrame:
    """Numbered lines that follow each other: doc_id, list, n (by place, whatever number is written), entry; two at least."""
    lines = docs.select(doc_id, F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    own = F.nullif(F.regexp_extract("line", r"^\s*([1-9]\d{0,8})(?:\s*[).,]\s*|\s+)\S", 1), F.lit("")).cast("int")
    rows = lines.withColumn("number", own).where("number is not null").withColumn("entry", design_description(F.regexp_extract("line", r"^\s*[1-9]\d{0,8}(?:\s*[).,]\s*|\s+)(.+?)\s*$", 1), stops))
    w = Window.partitionBy(doc_id).orderBy("pos")
    rows = rows.withColumn("_new", F.when((F.col("number") == 1) | F.lag("pos").over(w).isNull() | (F.col("pos") != F.lag("pos").over(w) + 1), 1).otherwise(0))
    rows = rows.withColumn("list", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    part = Window.partitionBy(doc_id, "list")
    return rows.withColumn("n", F.row_number().over(part.orderBy("pos"))).withColumn("_c", F.count("*").over(part)).withColumn("_m", F.min(F.length("entry")).over(part)).where("_c >= 2 and _m > 0").select(doc_id, "list", "n", "entry")


def pair_sides(tokens: DataFrame, key: list[str], n: str, side: str, text: str, sides: tuple[str, str] = ("obverse", "reverse")) -> DataFrame:
    """Texts of both sides joined for each number; keys whose numbers are not 1..k are out."""
    rows = tokens.groupBy(*key, n).pivot(side, list(sides)).agg(F.min(text))
    w = Window.partitionBy(*key)
    rows = rows.withColumn("_a", F.min(n).over(w)).withColumn("_b", F.max(n).over(w)).withColumn("_c", F.count("*").over(w)).where("_a = 1 and _b = _c")
    return rows.select(*key, n, F.concat_ws(" / ", *sides).alias("entry"))


def explode_options(rows: DataFrame, text: str) -> DataFrame:
    """'... (gold and silver)' gives a row for each option; other rows stay as they are, with option 0."""
    inside = F.regexp_extract(text, r"\(([^()]*(?:,| and | or )[^()]*)\)", 1)
    options = F.when(inside != "", F.transform(F.split(inside, r"\s*,\s*|\s+and\s+|\s+or\s+"), lambda x: F.trim(x))).otherwise(F.array(F.lit(None).cast("string")))
    return rows.select("*", F.posexplode(options).alias("option", "choice"))


def inventory(pages: DataFrame, pattern: str, *, page_id: str = "page_id", text: str = "html") -> DataFrame:
    """Form slots (slot, number, name, status, quantity from a pattern's five groups): the public number is the written one;
    where two machines of a status claim it, the later takes its slot, or the next number that is free. Machines of a slot
    go by number, name and quantity; one without slot and number has no public number.
    """
    groups = [F.regexp_extract_all(text, F.lit(pattern), F.lit(i)) for i in range(1, 6)]
    rows = pages.select(page_id, F.inline(F.arrays_zip(*[g.alias(f"g{i}") for i, g in enumerate(groups)]))).toDF("page", "slot", "number", "name", "status", "quantity")
    rows = rows.select("page", F.col("slot").try_cast("int").alias("slot"), F.col("number").try_cast("int").alias("number"), "name", "status", F.when(F.col("quantity").try_cast("int") > 0, F.col("quantity").try_cast("int")).alias("quantity"))

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        taken: set[int] = set()
        out = []
        pdf = pdf.sort_values(["slot", "number", "name", "quantity"])
        for r in pdf.itertuples():
            if pd.isna(r.slot) and pd.isna(r.number):
                out.append(None)
                continue
            n = int(r.number) if pd.notna(r.number) else int(r.slot)
            if n in taken and pd.notna(r.slot):
                n = int(r.slot)
            while n in taken:
                n += 1
            taken.add(n)
            out.append(n)
        return pdf.assign(public=pd.array(out, "Int64"))

    page = rows.schema["page"].dataType.simpleString()
    return rows.groupBy("page", "status").applyInPandas(settle, f"page {page}, slot int, number int, name string, status string, quantity int, public int")


def first_layout(layouts: list[DataFrame], key: str) -> DataFrame:
    """Rows of the first layout that found any for a key."""
    out = None
    for i, df in enumerate(layouts):
        one = df.withColumn("layout", F.lit(i))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out.withColumn("_p", F.min("layout").over(Window.partitionBy(key))).where("layout = _p").drop("_p")


def section_designs(blocks: DataFrame, *, header: str = "header", item: str = "item") -> DataFrame:
    """Numbered designs below each header of a page, with a one-design description as the fallback."""
    rows = catalogue_items(blocks, header=header, item=item).where("section is not null").withColumn("key", F.concat_ws("|", F.col("page_id").cast("string"), F.col("section"), F.col("pos").cast("string")))
    lists = numbered(rows, "key", "text").select("key", F.col("n").cast("long").alias("n"), "entry")
    single = rows.select("key", F.lit(1).cast("long").alias("n"), cut_at_stop(F.col("text"), [r"\.\s"]).alias("entry")).where("entry <> ''")
    return first_layout([lists, single], "key").join(rows.select("key", "page_id", "section"), "key").drop("key")


def check_complete(extracted: DataFrame, announced: DataFrame, key: str, count: str) -> tuple[DataFrame, DataFrame]:
    """Rows of the keys that are complete, and an error row for each that is not (never a part of the rows)."""
    have = extracted.groupBy(key).agg(F.count("*").alias("found"))
    rows = announced.select(key, F.col(count).alias("announced")).join(have, key, "left").withColumn("found", F.coalesce("found", F.lit(0)))
    bad = rows.where("found <> announced")
    return extracted.join(rows.where("found = announced").select(key), key, "left_semi"), bad


def table_rows(pages: DataFrame, **options) -> DataFrame:
    """Cells of each table row: page_id, row, cells."""
    key, source = options.get("page_id", "page_id"), options.get("html", "html")
    wanted, kind = {"row": ("tr", "")}, pages.schema[key].dataType.simpleString()

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = _Blocks(wanted)
        for batch in batches:
            at, row, texts = [], [], []
            for i, text in enumerate(batch["html"].to_pylist()):
                p.reset()
                p.out, p.depth, p.open = [], 0, None
                p.feed(text or "")
                at += [i] * len(p.out)
                row += range(len(p.out))
                texts += [t for _, t, _ in p.out]
            yield pa.RecordBatch.from_arrays([batch["page_id"].take(pa.array(at, pa.int64())), pa.array(row, pa.int64()), pa.array(texts, pa.string())], ["page_id", "row", "text"])

    rows = pages.select(F.col(key).alias("page_id"), F.col(source).cast("string").alias("html")).mapInArrow(walk, f"page_id {kind}, row long, text string")
    return rows.select("page_id", "row", F.split("text", r"\s*\|\s*").alias("cells"))


def mintage(cells: Column, multi: Column, period: Column, mark: Column) -> Column:
    """Year, mark and the three quantities of a table row, by its layout; null for a row that fits none."""
    at = lambda i: F.try_element_at(cells, F.lit(i))
    row = lambda y, m, i: F.struct(y.alias("year"), m.alias("mark"), at(i).alias("unc"), at(i + 1).alias("bu"), at(i + 2).alias("proof"))
    n = F.size(cells)
    return F.when(multi & (n >= 4) & at(1).rlike(r"^\d{4}$"), row(at(1), mark, 2)).when(~multi & (n >= 5), row(F.trim(period), at(2), 3)).when(~multi & (n >= 4), row(F.trim(period), F.lit(""), 2))


def subject(headings: Column, h1: Column, title: Column, ignored: list[str]) -> Column:
    """The first heading that is neither ignored nor the h1; else the middle of '<label> - <subject>, <place> - <site>'."""
    first = F.try_element_at(F.filter(headings, lambda h: ~fold_text(h).isin(*map(str.lower, ignored)) & (h != h1) & (F.trim(h) != "")), F.lit(1))
    return F.coalesce(first, blank_to_null(F.regexp_extract(title, r"^.*? - (.*), [^,]* - [^-]*$", 1)))


def page_identity(pages: DataFrame, expected: DataFrame, key: str, blocked: str) -> DataFrame:
    """Reason to reject each page: blocked page, other id, other country; null if it is the expected item's.

    pages: key, id, country, text. expected: key, id, country.
    """
    e = expected.select(key, F.col("id").alias("_i"), F.col("country").alias("_c"))
    reason = F.when(F.col("text").rlike(blocked), "blocked").when(~F.col("id").eqNullSafe(F.col("_i")), "other id").when(fold_text(F.col("country")) != fold_text(F.col("_c")), "other country")
    return pages.join(e, key).withColumn("reject", reason).drop("_i", "_c")


def available_sides(images: DataFrame, key: list[str], url: str, alt: str, pos: str, host: str) -> DataFrame:
    """Per key and side (by alt text, else by the url's -1 or -2) the first image url on the host."""
    by_alt = F.when(F.lower(alt).rlike("obverse|anverso|frente"), "obverse").when(F.lower(alt).rlike("reverse|verso"), "reverse")
    by_url = F.when(F.col(url).rlike(r"(?i)/\d+-1[a-z]*/"), "obverse").when(F.col(url).rlike(r"(?i)/\d+-2[a-z]*/"), "reverse")
    rows = images.where(F.col(url).rlike(host)).withColumn("side", F.coalesce(by_alt, by_url)).where("side is not null")
    return rows.groupBy(*key, "side").agg(F.min_by(url, pos).alias("url"))


def extract_country(html: Column, url: Column) -> Column:
    """First of: the h1's text, the url's country parameter, the canonical link's, the first image's alt text."""
    h1 = html_to_text(F.regexp_extract(html, r"(?is)<h1\b[^>]*>(.*?)</h1>", 1))
    canonical = F.regexp_extract(html, r'(?is)<link\b[^>]*rel="canonical"[^>]*href="([^"]*)"', 1)
    return F.coalesce(blank_to_null(h1), query_param(url, "country"), query_param(canonical, "country"), blank_to_null(F.regexp_extract(html, r'(?is)<img\b[^>]*alt="([^"]*)"', 1)))


def trim_repeated(pages: DataFrame, crawl: list[str], pos: str, item: str, year: str, least: int, misses: int) -> tuple[DataFrame, DataFrame]:
    """Rows of pages up to the stop, and the pages dropped. A page with the same set of items as the one before is ignored;
    the crawl stops after `misses` pages in a row without an item of year least or later.
    """
    sets = pages.groupBy(*crawl, pos).agg(F.array_sort(F.collect_set(item)).alias("_set"), F.bool_or(F.col(year) >= least).alias("_hit"))
    w = Window.partitionBy(*crawl).orderBy(pos)
    sets = sets.withColumn("_same", F.coalesce(F.col("_set") == F.lag("_set").over(w), F.lit(False)))
    fresh = sets.where("not _same").withColumn("_hit", F.coalesce("_hit", F.lit(False)))
    fresh = fresh.withColumn("_run", F.sum(F.when(F.col("_hit"), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    fresh = fresh.withColumn("_miss", F.sum(F.when(F.col("_hit"), 0).otherwise(1)).over(Window.partitionBy(*crawl, "_run").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)))
    stop = fresh.where(F.col("_miss") >= misses).groupBy(*crawl).agg(F.min(pos).alias("_stop"))
    kept = fresh.join(stop, crawl, "left").where(F.col("_stop").isNull() | (F.col(pos) <= F.col("_stop"))).select(*crawl, pos)
    return pages.join(kept, [*crawl, pos], "left_semi"), sets.select(*crawl, pos).join(kept, [*crawl, pos], "left_anti")


def page_number(url: Column) -> Column:
    return F.coalesce(query_int(url, "page"), F.lit(1))


def start_page(url: Column) -> Column:
    return canonical_page_url(F.regexp_replace(url, r"([?&])page=\d*", "$1"))
