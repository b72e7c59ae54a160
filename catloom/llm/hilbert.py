"""Sharding along a Hilbert curve, in DataFrame operations only.

Rows with equal texts form a group, and each group has one point: its size, and the smallest source and language code
point prefix among its rows, each quantised to a few bits. The curve index of the point orders the groups; runs of that
order with equal bytes become shards, so a file covers a small box of the metadata and filters on them skip files.

Prefix sums have levels: bytes per curve cell (their number is fixed by the quantisation), per part of a cell (a fixed
number of hash ranges of the text), per group. A group with more bytes or more rows than a quarter of a shard's, or more
than a stated number of either, is divided over hash parts of its own, as equal sizes come first then; all others stay
whole. Its parts go by doc_id, and by a number of the row where that is null, so that many rows without text or id are not
one task's work. A group that holds more than a 16,384th of all rows is joined with its point by a broadcast; fewer than
16,384 groups can.

Defined cases: null text has size 1 and the checksum of no bytes; null metadata count as empty strings; repeated rows
and null ids each get a slot; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catloom.llm.common import free_prefix, stored, text_of


HOT = 16_384  # groups with more than this part of all rows find their point where they lie
MANY_ROWS, MANY_BYTES = 1_000_000, 1 << 30  # of a group that one task may number


def curve_tables(n: int) -> tuple[list[int], list[int], list[int]]:
    """For each index w of a sub-cube: its entry corner, the direction through it, and the rank of Gray code w."""
    size = 1 << n
    gray = [w ^ (w >> 1) for w in range(size)]
    entry = [0 if w == 0 else gray[2 * ((w - 1) // 2)] for w in range(size)]
    trailing = lambda w: (~w & (w + 1)).bit_length() - 1
    way = [0 if w == 0 else trailing(w - 1) % n if w % 2 == 0 else trailing(w) % n for w in range(size)]
    inverse = [0] * size
    for w, g in enumerate(gray):
        inverse[g] = w
    return entry, way, inverse


def hilbert_index(dims: list[Column], bits: int) -> Column:
    """Index along the Hilbert curve through the cube of integer dims, each in 0..2**bits-1."""
    n = len(dims)
    entry, way, inverse = (F.array(*map(F.lit, t)) for t in curve_tables(n))

    def step(acc: Column, level: Column) -> Column:
        corner = F.lit(0)
        for i in range(n):
            corner = corner.bitwiseOR(F.call_function("shiftleft", F.call_function("shiftright", acc["at"][i], level).bitwiseAND(F.lit(1)), F.lit(i)))
        w = F.element_at(inverse, _turn(corner.bitwiseXOR(acc["e"]), acc["d"] + 1, n, False) + 1)
        e = acc["e"].bitwiseXOR(_turn(F.element_at(entry, w + 1), acc["d"] + 1, n, True))
        return F.struct((acc["h"] * (1 << n) + w).alias("h"), e.alias("e"), ((acc["d"] + F.element_at(way, w + 1) + 1) % n).alias("d"), acc["at"].alias("at"))

    # the coordinates ride along, so that each is computed once and not at every level
    start = F.struct(F.lit(0).cast("long").alias("h"), F.lit(0).alias("e"), F.lit(0).alias("d"), F.array(*dims).alias("at"))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0)), start, step, lambda acc: acc["h"])


def _turn(x: Column, k: Column, n: int, left: bool) -> Column:
    k = k % n
    a, b = ("shiftleft", "shiftright") if left else ("shiftright", "shiftleft")
    return F.call_function(a, x, k).bitwiseOR(F.call_function(b, x, F.lit(n) - k)).bitwiseAND(F.lit((1 << n) - 1))


def _prefix_code(c: Column, n: int = 7) -> Column:
    """Bytes of the first characters as a number that sorts as they do."""
    return F.conv(F.hex(F.rpad(F.substring(F.encode(F.coalesce(c.cast("string"), F.lit("")), "utf-8"), 1, n), n, F.lit(b"\0"))), 16, 10).cast("long")


def _rank(c: Column, cuts: Column, top: int) -> Column:
    """Number of cut points below c: a quantile in 0..top."""
    return F.least(F.size(F.filter(cuts, lambda x: x < c)), F.lit(top))


def hilbert_shards(docs: DataFrame, *, shards: int = 8, bits: int = 5, parts: int = 256, many_rows: int = MANY_ROWS, many_bytes: int = MANY_BYTES, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text", metadata: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """doc_id, size (bytes of the text plus 1), text_crc32, curve index, shard and slot (gapless from 0 in each shard)."""
    top = (1 << bits) - 1
    text = text_of(docs, text_col)
    names = [f"m{i}" for i in range(len(metadata))]
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), text).alias("h2"), *[_prefix_code(docs[c]).alias(n) for c, n in zip(metadata, names, strict=True)])
    # dealt before they are stored, so that a row's part is the same whenever it is read
    deal = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).otherwise(F.xxhash64("doc_id", F.lit(2)))
    rows = rows.withColumn("deal", F.pmod(deal, F.lit(parts)).cast("int"))
    rows = stored(rows, "hilbert-rows")
    group = ["h", "h2"]
    groups = rows.groupBy(*group).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.max("size").alias("each"), *[F.min(n).alias(n) for n in names])
    quantiles = [i / (top + 1) for i in range(1, top + 1)]
    cuts = groups.agg(F.sum("bytes").alias("total"), F.sum("rows").alias("total_rows"), *[F.array_distinct(F.percentile_approx(n, quantiles, 10_000)).alias(f"{n}_cuts") for n in ("each", *names)])
    # one row: the total and at most 2**bits cut points a dimension
    point = groups.crossJoin(F.broadcast(cuts)).select(*group, "bytes", "rows", hilbert_index([_rank(F.col(n), F.col(f"{n}_cuts"), top) for n in ("each", *names)], bits).alias("curve"), ((F.col("bytes") > F.least(F.col("total") / (4 * shards), F.lit(many_bytes))) | (F.col("rows") > F.least(F.col("total_rows") / (4 * shards), F.lit(many_rows)))).alias("large"), (F.col("rows") > F.col("total_rows") / hot).alias("hot"))
    point = stored(point.select(*group, "curve", "large", "hot"), "hilbert-points")
    # fewer than `hot` groups can be hot: their rows find their point where they lie, all others by a shuffle
    broad = F.broadcast(point.where("hot").select(*group, "curve", "large"))
    others = rows.join(broad, group, "left_anti").join(point.where("not hot").select(*group, "curve", "large"), group)
    rows = rows.join(broad, group).unionByName(others).withColumn("part", F.pmod("h", F.lit(parts)))
    rows = rows.withColumn("piece", F.when(F.col("large"), F.col("deal")).otherwise(F.lit(0)))
    unit = ["curve", "part", "h", "h2", "piece"]
    units = rows.groupBy(*unit).agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    cell_parts = units.groupBy("curve", "part").agg(F.sum("bytes").alias("bytes"))
    cells = cell_parts.groupBy("curve").agg(F.sum("bytes").alias("bytes"))
    before = lambda w: F.sum("bytes").over(w) - F.col("bytes")
    cell_at = cells.select("curve", before(Window.orderBy("curve")).alias("cell_at"), F.sum("bytes").over(Window.partitionBy()).alias("total"))
    part_at = cell_parts.select("curve", "part", before(Window.partitionBy("curve").orderBy("part")).alias("part_at"))
    placed = units.withColumn("unit_at", before(Window.partitionBy("curve", "part").orderBy("h", "h2", "piece"))).join(part_at, ["curve", "part"]).join(cell_at, "curve")
    middle = F.col("cell_at") + F.col("part_at") + F.col("unit_at") + F.col("bytes") / 2
    placed = placed.select(*unit, "n", F.least(F.floor(middle * shards / F.col("total")), F.lit(shards - 1)).cast("int").alias("shard"))
    # slots: rows before the cell, the part and the unit within the shard
    n_parts = placed.groupBy("shard", "curve", "part").agg(F.sum("n").alias("n"))
    n_cells = n_parts.groupBy("shard", "curve").agg(F.sum("n").alias("n"))
    earlier = lambda w: F.sum("n").over(w) - F.col("n")
    c = n_cells.select("shard", "curve", earlier(Window.partitionBy("shard").orderBy("curve")).alias("c"))
    p = n_parts.select("shard", "curve", "part", earlier(Window.partitionBy("shard", "curve").orderBy("part")).alias("p"))
    u = placed.withColumn("u", earlier(Window.partitionBy("shard", "curve", "part").orderBy("h", "h2", "piece")))
    first = u.join(p, ["shard", "curve", "part"]).join(c, ["shard", "curve"]).select(*unit, "shard", (F.col("u") + F.col("p") + F.col("c")).alias("first"))
    numbered = rows.withColumn("i", F.row_number().over(Window.partitionBy(*unit).orderBy("doc_id", "text_crc32")) - 1)
    return numbered.join(first, unit).select("doc_id", "size", "text_crc32", "curve", "shard", (F.col("first") + F.col("i")).alias("slot"))


def shard_digest(docs: DataFrame, **options) -> DataFrame:
    out = hilbert_shards(docs, **options)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")


def write_shards(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", **options) -> None:
    """Write docs as Parquet below path, a folder for each shard, rows in order of their slots: each file covers a run of
    the curve, so the ranges of its metadata are narrow and filters on them skip files. Rows that are equal in id and text
    take their slots in any order.
    """
    p = free_prefix(docs, "_shard_")
    placed = hilbert_shards(docs, id_col=id_col, text_col=text_col, **options)
    text = text_of(docs, text_col)
    keys = {f"{p}id": docs[id_col].cast("long"), f"{p}size": (F.octet_length(text) + 1).cast("long"), f"{p}crc": F.crc32(text.cast("binary"))}
    same = Window.partitionBy(f"{p}id", f"{p}size", f"{p}crc")
    rows = docs.withColumns(keys).withColumn(f"{p}rep", F.row_number().over(same.orderBy(f"{p}id")))
    slots = placed.select(F.col("doc_id").alias(f"{p}id2"), F.col("size").alias(f"{p}size"), F.col("text_crc32").alias(f"{p}crc"), F.col("shard").alias(f"{p}shard"), F.col("slot").alias(f"{p}slot"))
    slots = slots.withColumn(f"{p}rep", F.row_number().over(Window.partitionBy(f"{p}id2", f"{p}size", f"{p}crc").orderBy(f"{p}slot")))
    out = rows.join(slots, F.col(f"{p}id").eqNullSafe(F.col(f"{p}id2")) & (rows[f"{p}size"] == slots[f"{p}size"]) & (rows[f"{p}crc"] == slots[f"{p}crc"]) & (rows[f"{p}rep"] == slots[f"{p}rep"]))
    out = out.select(*[docs[c] for c in docs.columns], f"{p}shard", f"{p}slot").repartitionByRange(f"{p}shard", f"{p}slot").sortWithinPartitions(f"{p}shard", f"{p}slot")
    out.drop(f"{p}slot").withColumnRenamed(f"{p}shard", "shard_id").write.mode("overwrite").partitionBy("shard_id").parquet(path)
