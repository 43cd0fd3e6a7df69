"""All queries of the core, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.plans import analytics, data_queries, deeper, expressions, ingest, more

_MODULES = [data_queries, expressions, analytics, ingest, more, deeper]


#: Columns that are 32-bit in Spark where SQL's functions give 64 bits.
_INT = {
    "e02_length_between": ["len"], "e28_local_parts": ["dow", "hour", "year", "day_index"], "j14_nearest_year": ["year"], "a03_volume_year": ["year"],
    "a06_theme_year": ["year"], "a10_heatmap": ["dow", "hour"], "a11_cell_sample": ["dow", "hour"], "w01_top_share": ["rn"], "w04_rank_per_item": ["k"],
    "x02_distinct": ["year"], "n05_tfidf": ["doc", "rank"], "theme_multilabel": ["rank"], "k04_full_refresh": ["year"], "bench_top_orders": ["r"],
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in _MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    sql = {k: s for m in _MODULES for k, s in m.SQL.items()}
    for k, columns in _INT.items():
        sql[k] = f"select * replace ({', '.join(f'{c}::integer as {c}' for c in columns)}) from (\n{sql[k]}\n)"
    return sql
