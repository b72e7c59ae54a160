"""Order-dependent operators whose groups may be any size (W1-W4, W7, K7): no task gets a whole group.

A window gives each group to one task. Here rows are dealt out by ranges of (group, order), so that a large group lies in as
many ranges as it needs, and each range is scanned once, in order: rows get their number, their number of changes and the
last value seen within the range. What a range carries on to the next one is told by its first and its last row alone: a
table of one row for each range, added up on the driver, and given to the rows that go on with the group that the range
began with. The scanned rows are written to the shared folder, as both steps need the same ranges.

``order.*`` has the window forms, which are cheaper where groups are many and small.

Defined cases: rows that tie in order go by a hash of all columns, so that reruns agree; null groups and null values of
changing columns are equal to each other; group may be empty (all rows are one group); an empty table gives no rows. Group
and changing columns have atomic types.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catloom.sources.shared import stored


def _as_before(columns: list[pa.Array], last: list[pa.Array]) -> np.ndarray:
    """Whether each row has the values of the row before it; last: the row before the first one, empty if there is none."""
    n = len(columns[0]) if columns else 0
    out = np.ones(n, bool)
    for c, before in zip(columns, last, strict=True):
        old = pa.concat_arrays([before if len(before) else pa.nulls(1, c.type), c.slice(0, n - 1)])
        same = pc.fill_null(pc.equal(c, old), False)
        same = pc.or_(same, pc.and_(c.is_null(), old.is_null()))
        if pa.types.is_floating(c.type):
            same = pc.or_(same, pc.and_(pc.fill_null(pc.is_nan(c), False), pc.fill_null(pc.is_nan(old), False)))
        out &= same.to_numpy(zero_copy_only=False)
    if n and (not last or not len(last[0])):
        out[0] = False
    return out


def _scan(group: list[str], change: list[str], fill: str | None):
    """Adds to sorted rows: _part, _at (place in the range), _head (still in its first group), _n, _c and _fill."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at, n, c, head, value = TaskContext.get().partitionId(), 0, 0, 0, True, None
        last: dict[str, pa.Array] = {}
        for batch in batches:
            if not len(batch):
                continue
            i = np.arange(len(batch))
            one = pa.array(np.zeros(len(batch), np.int8))  # so that there is a group and a change column in any case
            cols = lambda names: [*[batch[x] for x in names], one]
            before = lambda names: [last.get(x, one.slice(0, 0)) for x in [*names, "_one"]]
            same = _as_before(cols(group), before(group))
            moved = same & ~_as_before(cols(change), before(change))
            start = np.maximum.accumulate(np.where(same, -1, i))  # where the row's group starts in this batch, -1: before it
            numbers = np.where(start < 0, n + i, i - start) + 1
            sums = np.cumsum(moved)
            changes = sums - np.where(start < 0, 0, sums[np.maximum(start, 0)]) + np.where(start < 0, c, 0)
            breaks = ~same
            breaks[0] &= at > 0
            heads = head & (np.cumsum(breaks) == 0)
            added = {"_part": pa.array(np.full(len(batch), part, np.int32)), "_at": pa.array(at + i), "_head": pa.array(heads), "_n": pa.array(numbers.astype(np.int64)), "_c": pa.array(changes.astype(np.int64))}
            if fill:
                found = np.maximum.accumulate(np.where(batch[fill].is_valid().to_numpy(zero_copy_only=False), i, -1))
                null = pa.nulls(1, batch[fill].type)
                held = pa.concat_arrays([null, null if value is None else value, batch[fill]])
                added["_fill"] = held.take(pa.array(np.where((found >= 0) & (found >= start), found + 2, np.where(start < 0, 1, 0))))
                value = added["_fill"].slice(len(batch) - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, *added.values()], [*batch.schema.names, *added])
            last = {x: a.slice(len(batch) - 1) for x, a in [*((x, batch[x]) for x in [*group, *change]), ("_one", one)]}
            at, n, c, head = at + len(batch), int(numbers[-1]), int(changes[-1]), bool(heads[-1])

    return scan


def _carried(firsts: list, group: list[str], change: list[str], fill: str | None) -> list[tuple]:
    """For each range what it goes on from: rows, changes and last value of its first group in the ranges before."""
    out, before = [], None
    for r in firsts:
        g, v = [r["first"][x] for x in group], [r["first"][x] for x in change]
        goes_on = before is not None and before["group"] == g
        n, c, value = (before["n"], before["c"] + (before["change"] != v), before["fill"]) if goes_on else (0, 0, None)
        out.append((r["_part"], n, c, value))
        e = r["last"]
        before = {"group": [e[x] for x in group], "change": [e[x] for x in change], "n": e["_n"] + n * e["_head"], "c": e["_c"] + c * e["_head"]}
        before["fill"] = None if not fill else e["_fill"] if e["_fill"] is not None or not e["_head"] else value
    return out


def scanned(df: DataFrame, group: list[str], order: list[Column | str], *, change: list[str] = (), fill: str | None = None, parts: int | None = None) -> DataFrame:
    """df with _number (1, 2, ... in order within each group), _changes (rows so far whose changing columns differ from those
    of the row before) and, where fill is given, _filled (its last value that is not null, so far).
    """
    spark, change = df.sparkSession, list(change)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = [F.col(f"`{f.name}`").cast("string") if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in df.schema]  # maps have no hash
    sort = [k if isinstance(k, Column) else F.col(k) for k in (*group, *order, F.xxhash64(*own))]
    rows = df.repartitionByRange(parts, *sort).sortWithinPartitions(*sort)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", _part int, _at long, _head boolean, _n long, _c long" + (f", _fill {df.schema[fill].dataType.simpleString()}" if fill else "")
    rows = stored(rows.mapInArrow(_scan(list(group), change, fill), kinds), "ranges")
    ends = F.struct(*group, *[c for c in change if c not in group], "_n", "_c", "_head", *(["_fill"] if fill else []))
    firsts = rows.groupBy("_part").agg(F.min_by(ends, "_at").alias("first"), F.max_by(ends, "_at").alias("last")).orderBy("_part").collect()  # a row for each range
    kind = df.schema[fill].dataType.simpleString() if fill else "int"
    carried = spark.createDataFrame(_carried(firsts, list(group), change, fill), f"_part int, _more long, _moves long, _value {kind}")
    rows = rows.join(F.broadcast(carried), "_part", "left")  # a row for each range
    more = lambda c: F.when(F.col("_head"), F.col(c)).otherwise(0)
    out = rows.withColumn("_number", F.col("_n") + more("_more")).withColumn("_changes", F.col("_c") + more("_moves"))
    if fill:
        out = out.withColumn("_filled", F.coalesce("_fill", F.when(F.col("_head"), F.col("_value"))))
    return out.drop("_part", "_at", "_head", "_n", "_c", "_fill", "_more", "_moves", "_value")


def numbered(df: DataFrame, group: list[str], order: list[Column | str], name: str = "sequence", **options) -> DataFrame:
    """1, 2, ... in order within each group (row_number)."""
    return scanned(df, group, order, **options).withColumnRenamed("_number", name).drop("_changes")


def rank_by_first(df: DataFrame, group: list[str], key: str, pos: str, name: str = "rank", **options) -> DataFrame:
    """1, 2, ... by first appearance of the key in the group: equal keys share a number and each blank key has its own.

    The first place of a key is a grouped minimum joined back, so a key may have any number of rows.
    """
    blank = F.trim(F.coalesce(F.col(key).cast("string"), F.lit(""))) == ""
    first = df.where(~blank).groupBy(*[F.col(c).alias(f"_g_{c}") for c in group], F.col(key).alias("_k")).agg(F.min(pos).alias("_first"))
    same = reduce(lambda a, c: a & F.col(c).eqNullSafe(F.col(f"_g_{c}")), group, (F.col(key) == F.col("_k")) & ~blank)
    rows = df.join(first, same, "left").withColumn("_first", F.coalesce("_first", pos)).select(*df.columns, "_first")
    out = scanned(rows, group, ["_first"], change=["_first"], **options)
    return out.withColumn(name, F.col("_changes") + 1).drop("_number", "_changes", "_first")


def runs(df: DataFrame, group: list[str], cols: list[str], pos: list[str], **options) -> DataFrame:
    """Runs of equal cols in order: number, first and last position (of pos[0]) and length."""
    rows = scanned(df, group, pos, change=cols, **options).withColumn("run", F.col("_changes") + 1)
    return rows.groupBy(*group, "run", *cols).agg(F.min(pos[0]).alias("start"), F.max(pos[0]).alias("end"), F.count("*").alias("length"))


def forward_fill(df: DataFrame, group: list[str], col: str, pos: str, name: str, **options) -> DataFrame:
    """The last value of col that is not null, so far."""
    return scanned(df, group, [pos], fill=col, **options).withColumnRenamed("_filled", name).drop("_number", "_changes")
