"""Every registered query of the library against its SQL twin, on the smallest tables."""

import math
import os

import duckdb
import pytest

import catloom.plans.extract_queries
import catloom.plans.relation_queries
import catloom.plans.scalar_queries
import catloom.plans.shape_queries
import catloom.plans.source_queries
import catloom.plans.stream_queries  # noqa: F401
from catloom.plans.registry import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(x):
    if isinstance(x, bool) or x is None:
        return x
    if isinstance(x, float):
        return None if math.isnan(x) else float(f"{x:.9g}")
    if isinstance(x, int):
        return float(x)
    return x.isoformat() if hasattr(x, "isoformat") else x


def rows(data, at):
    return sorted((tuple(plain(r[i]) for i in at) for r in data), key=lambda r: [(x is None, str(x)) for x in r])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = rows([[r[c] for c in columns] for r in df.collect()], range(len(columns)))
    if name not in ORACLES:
        assert df.columns
        return
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    assert got == rows(cursor.fetchall(), [names.index(c) for c in columns])
