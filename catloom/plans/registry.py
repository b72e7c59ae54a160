"""Queries over the given tables, one or more for each operator, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catloom.sources.shared import scratch, spread  # noqa: F401  (queries take them from here)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Counters and places whose width the two engines choose differently: both sides return them as bigint.
BIGINTS = {
    "e_links": "pos page", "e_numbered": "n", "e_line_lists": "list n", "e_check_complete": "announced", "e_section_designs": "n", "j_set_match": "n",
    "m_top_candidates": "rank", "q_check_sequence": "expected", "q_check_counts": "expected", "q_audit": "expected", "s_link_lines": "pos",
    "n_years": "first least sort_first", "n_marks": "total", "g_flatten": "group_pos item_pos", "g_regroup": "n_groups", "g_dedup_merge": "rows",
    "w_catalogue_order": "pos place", "w_gapless_rank": "pos rank", "w_resequence": "sequence", "w_runs": "start end", "w_top_rows": "rank",
    "w_stable_sort": "place", "a_year_coverage": "first last",
}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name, with the SQL that gives the same rows."""

    def add(f: Query) -> Query:
        wide = BIGINTS.get(f.__name__, "").split()

        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(spark, sf_dir).withColumns({c: F.col(c).cast("bigint") for c in wide}) if wide else f(spark, sf_dir)

        QUERIES[f.__name__] = run
        if oracle is not None:
            casts = ", ".join(f'cast("{c}" as bigint) as "{c}"' for c in wide)
            ORACLES[f.__name__] = f"select * replace ({casts}) from ({oracle})" if wide else oracle
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["reconcile_documents"](spark, sf_dir)

