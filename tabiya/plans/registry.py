"""Query registry: one Spark plan per operator of the inventory, plus the
equivalent DuckDB SQL used as the differential oracle."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import apply_sql_conf
from . import oracle_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    """Register a query builder ``fn(spark, sf_dir) -> DataFrame`` under ``key``."""
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_sql_conf(spark)
            return _bigint_positions(fn(spark, sf_dir))
        QUERIES[key] = run
        if oracle is not None:
            ORACLE[key] = oracle_views.with_views(oracle)
        return fn
    return deco


# ranking, position and count columns are BIGINT, as row_number() / count() are in SQL engines
_POSITION_COLS = {"rank", "pick", "rank_opening", "rank_gap", "level_id", "mode", "ply", "n_urls", "n_links"}


def _bigint_positions(df: DataFrame) -> DataFrame:
    if not any(f.name in _POSITION_COLS and isinstance(f.dataType, T.IntegerType) for f in df.schema.fields):
        return df
    return df.select(*[F.col(f.name).cast("long").alias(f.name)
                       if f.name in _POSITION_COLS and isinstance(f.dataType, T.IntegerType) else F.col(f.name)
                       for f in df.schema.fields])


def finalize(df: DataFrame, digits: int = 8) -> DataFrame:
    """Round every double column (engines differ in the last bits of sums)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _load_all() -> None:
    # importing the query modules fills the registry
    from . import queries_core, queries_positions, queries_text, queries_catalog, queries_quality, queries_ml, queries_recommend, queries_stream, queries_misc, queries_train, queries_sources  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)

