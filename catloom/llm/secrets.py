"""Secret scans over an incremental blob ledger, in DataFrame operations only.

Every version of a text is addressed by the SHA-256 of its content. The ledger, a Parquet table in the shared folder,
holds for each blob which rule versions have scanned it and what they found. A run scans a blob once however many paths
carry it, and only with the rule versions that the ledger lacks; findings are then joined back to every path.

Defined cases: null text is the empty blob; repeated rows and null ids each keep their row; an empty table gives no
rows; further columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catloom.llm.common import fresh_path, text_of


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of pattern; those whose group is shorter than least are dropped afterwards."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


def _either(word: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join([*map(_either, ("password", "passwd", "secret", "token")), _either("api") + "_?" + _either("key")])
#: The length limits of access and hex may stand in the pattern: what fails is a whole run, which holds no other match.
BASE = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + MORE
_FOUND = "array<struct<start:long,rank:int,kind:string,rule:string,end:long>>"
_LEDGER = f"blob string, rules array<string>, found {_FOUND}"


def _hits(text: Column, todo: Column, rules: tuple[Rule, ...]) -> Column:
    """For each rule that is due and matches: its matches and the pieces of text between them."""
    return F.filter(
        F.array(*[F.when(F.array_contains(todo, r.name) & text.rlike(r.pattern), F.struct(F.lit(i).alias("rank"), F.split(text, r.pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(r.pattern), F.lit(0)).alias("matches"))) for i, r in enumerate(rules)]),
        lambda x: x.isNotNull(),
    )


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blobs: blob, text, todo (names of the rules that are due). One ledger row per blob."""
    hits = blobs.select("blob", F.explode(_hits(F.col("text"), F.col("todo"), rules)).alias("h")).select("blob", "h.rank", F.posexplode(F.arrays_zip("h.gaps", "h.matches")).alias("pos", "x"))
    w = Window.partitionBy("blob", "rank").orderBy("pos")
    size = F.length("x.gaps") + F.coalesce(F.length("x.matches"), F.lit(0))
    ends = hits.select("blob", "rank", F.col("x.matches").alias("match"), F.sum(size).over(w).alias("end")).where("match is not null")
    keep = F.lit(True)
    for i, r in enumerate(rules):
        if r.least:
            keep = keep & ((F.col("rank") != i) | (F.length(F.regexp_extract("match", r.pattern, r.group)) >= r.least))
    kinds, names = (F.array(*map(F.lit, x)) for x in ([r.kind for r in rules], [r.name for r in rules]))
    spans = ends.where(keep).select("blob", F.struct((F.col("end") - F.length("match")).cast("long").alias("start"), "rank", kinds[F.col("rank")].alias("kind"), names[F.col("rank")].alias("rule"), F.col("end").cast("long").alias("end")).alias("span"))
    found = spans.groupBy("blob").agg(F.collect_list("span").alias("found"))
    return blobs.select("blob", F.col("todo").alias("rules")).join(found, "blob", "left").select("blob", "rules", F.coalesce("found", F.array().cast(_FOUND)).alias("found"))


def update_ledger(docs: DataFrame, ledger: str, *, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> None:
    """Scan the blobs of docs with the rule versions that the ledger at this path has not yet applied to them."""
    spark = docs.sparkSession
    text = text_of(docs, text_col)
    # one text per content; equal texts meet before the shuffle where they share a partition
    blobs = docs.select(F.sha2(text, 256).alias("blob"), text.alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
    seen = spark.read.schema(_LEDGER).parquet(ledger).select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    due = F.array(*[F.lit(r.name) for r in rules])
    todo = blobs.join(seen, "blob", "left").withColumn("todo", F.array_except(due, F.coalesce("seen", F.array().cast("array<string>")))).where(F.size("todo") > 0).select("blob", "text", "todo")
    scan_blobs(todo, rules).write.mode("append").option("compression", "zstd").parquet(ledger)


def open_ledger(spark, path: str | None = None) -> str:
    """The path of a ledger, made empty where none is given."""
    if path is None:
        path = fresh_path(spark, "blob-ledger")
        columns = [F.lit(None).cast(kind).alias(name) for name, kind in (("blob", "string"), ("rules", "array<string>"), ("found", _FOUND))]
        spark.range(0).select(*columns).write.parquet(path)
    return path


def scan_secrets(docs: DataFrame, *, ledger: str | None = None, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Each row's id, blob and findings (array of start, rank, kind, rule, end, sorted), after bringing the ledger up to date."""
    spark = docs.sparkSession
    ledger = open_ledger(spark, ledger)
    update_ledger(docs, ledger, text_col=text_col, rules=rules)
    names = [r.name for r in rules]
    found = spark.read.schema(_LEDGER).parquet(ledger).where(F.size("found") > 0).groupBy("blob").agg(F.flatten(F.collect_list("found")).alias("found"))
    found = found.select("blob", F.array_sort(F.filter("found", lambda x: x["rule"].isin(names))).alias("found"))
    paths = docs.select(docs[id_col].alias("doc_id"), F.sha2(text_of(docs, text_col), 256).alias("blob"))
    return paths.join(found, "blob", "left").select("doc_id", "blob", F.coalesce("found", F.array().cast(_FOUND)).alias("found"))


def _joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def secret_digest(docs: DataFrame, **options) -> DataFrame:
    """doc_id, counts of the base kinds, SHA-256 of the base spans, and all spans as text."""
    rows = scan_secrets(docs, **options)
    base = F.filter("found", lambda x: x["rank"] < len(BASE))
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return rows.select("doc_id", *[count(r.kind) for r in BASE], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"))
