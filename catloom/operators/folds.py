"""Ordered folds as a stream (G6, G7): a key's rows are folded one after another, however many there are.

``shape.dedup_merge`` and ``shape.merge_groups`` gather a key's rows first, which is quick for the few pages that repeat an
item. Here rows are dealt out by key, sorted by key and order, and read through an Arrow iterator that holds one state: the
memory of a task does not grow with a key. A fold that does not associate needs its rows in order, so a key is one task's.

Defined cases: null keys are a key; rows that tie in order go by the fields; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

State, Row = Any, dict[str, Any]
GIVEN = 10_000  # keys that a task gathers before it gives them


def ordered_fold(df: DataFrame, key: list[str], order: list[str], fields: list[str], begin: Callable[[Row], State], step: Callable[[State, Row], State], end: Callable[[State], Row], schema: str, *, parts: int | None = None) -> DataFrame:
    """key and the columns of schema: begin on the first row of a key, step on each later one, end on the last state.

    Rows come as dicts of the fields. Keys have atomic types.
    """
    cols = list(dict.fromkeys([*key, *order, *fields]))
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in key)
    made = to_arrow_schema(StructType.fromDDL(f"{kinds}, {schema}"))
    sort = [f"`{c}`" for c in dict.fromkeys([*key, *order, *[f for f in fields if "map<" not in df.schema[f].dataType.simpleString()]])]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def given() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(out, schema=made)

        place, state, out = None, None, []
        for batch in batches:
            keys = zip(*(batch[k].to_pylist() for k in key), strict=True)
            for here, row in zip(keys, batch.select(list(dict.fromkeys(fields))).to_pylist(), strict=True):
                if here == place:
                    state = step(state, row)
                    continue
                if place is not None:
                    out.append(dict(zip(key, place, strict=True)) | end(state))
                    if len(out) >= GIVEN:
                        yield given()
                        out = []
                place, state = here, begin(row)
        if place is not None:
            out.append(dict(zip(key, place, strict=True)) | end(state))
            yield given()

    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(*cols).repartition(n, *key).sortWithinPartitions(*sort)
    return rows.mapInArrow(fold, f"{kinds}, {schema}")


def has(x: Any) -> bool:
    return x is not None and x != ""


def _leaves(row: Row, fields: list[str], nested: dict[str, list[str]]) -> int:
    return sum(sum(has((row[f] or {}).get(x)) for x in nested[f]) if f in nested else has(row[f]) for f in fields)


def _filled(a: Row, b: Row, fields: list[str], nested: dict[str, list[str]]) -> Row:
    out = {}
    for f in fields:
        if f not in nested:
            out[f] = a[f] if has(a[f]) else b[f]
        elif a[f] is None or b[f] is None:
            out[f] = b[f] if a[f] is None else a[f]
        else:
            out[f] = {x: a[f][x] if has(a[f][x]) else b[f][x] for x in nested[f]}
    return out


def dedup_merge_stream(df: DataFrame, key: list[str], order: str, fields: list[str], *, guard: str | None = None, **options) -> DataFrame:
    """What shape.dedup_merge gives (key, rows and the merged fields), with a state of one record for each task."""
    nested = {f: [x.name for x in df.schema[f].dataType.fields] for f in fields if df.schema[f].dataType.typeName() == "struct"}

    def step(state: tuple[int, Row], row: Row) -> tuple[int, Row]:
        n, held = state
        if guard and has(held[guard]) and has(row[guard]) and held[guard] != row[guard]:
            return n + 1, held
        fuller = _leaves(row, fields, nested) > _leaves(held, fields, nested)
        return n + 1, _filled(row, held, fields, nested) if fuller else _filled(held, row, fields, nested)

    schema = "rows long, " + ", ".join(f"`{f}` {df.schema[f].dataType.simpleString()}" for f in fields)
    return ordered_fold(df, key, [order], fields, lambda row: (1, row), step, lambda s: {"rows": s[0], **s[1]}, schema, **options)


def merge_groups_stream(df: DataFrame, key: list[str], order: str, first: list[str], union: str, **options) -> DataFrame:
    """What shape.merge_groups gives: the first non-blank of each field in order, and the distinct values of union by appearance.

    A key's distinct values are held, as they are its result; null values are left out.
    """

    def blank(x: Any) -> bool:
        return x is None or isinstance(x, str) and not x.strip(" ")

    def begin(row: Row) -> dict:
        return step({"first": dict.fromkeys(first), "seen": {}}, row)

    def step(state: dict, row: Row) -> dict:
        for f in first:
            if blank(state["first"][f]) and not blank(row[f]):
                state["first"][f] = row[f]
        if row[union] is not None:
            state["seen"].setdefault(row[union])
        return state

    schema = ", ".join([*[f"`{f}` {df.schema[f].dataType.simpleString()}" for f in first], f"`{union}s` array<{df.schema[union].dataType.simpleString()}>"])
    return ordered_fold(df, key, [order], [*first, union], begin, step, lambda s: {**s["first"], f"{union}s": list(s["seen"])}, schema, **options)
