"""Registry of every query: name -> ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import configure
from . import checks, connectors, markets, marts, publishing, questions, shaping, streams

QueryFn = Callable[[SparkSession, str], DataFrame]


def _configured(fn: QueryFn) -> QueryFn:
    """Every query runs with the library's session settings (UTC, AQE, dynamic overwrite,
    RocksDB state, a shared checkpoint folder), whatever session the caller passes."""
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(spark, sf_dir)
    return run


def all_queries() -> dict[str, QueryFn]:
    return {name: _configured(fn) for name, fn in _raw_queries().items()}


def _raw_queries() -> dict[str, QueryFn]:
    out: dict[str, QueryFn] = {}
    out.update(questions.QUERIES)
    out.update(marts.QUERIES)
    out.update(publishing.QUERIES)
    out.update(checks.QUERIES)
    out.update(markets.QUERIES)
    out.update(streams.QUERIES)
    out.update(connectors.QUERIES)
    out.update(shaping.QUERIES)
    return out


def all_oracles() -> dict[str, str]:
    from .oracle import ORACLE
    return dict(ORACLE)


FLAGSHIP = "monthly_zone_revenue"
