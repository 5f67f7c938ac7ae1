"""Registry of catalogue queries: name -> (Spark builder, DuckDB oracle SQL).

A builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
supplied tables.  The oracle is the same question in plain SQL over views of
the same names; ``None`` marks an operator with no SQL form (checked by a
brute-force pytest instead).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    survey_ids: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None, ids: str = ""):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql.strip() if sql else None,
                               tuple(i.strip() for i in ids.split(",") if i.strip()))
        return fn
    return deco


def load_all() -> dict[str, Query]:
    """Import every catalogue module (registration happens at import)."""
    from . import (frame_queries, grid_queries, keyed_queries, neighbour_queries,  # noqa: F401
                   record_queries, storage_queries, stream_queries, text_queries,
                   udf_queries)
    return REGISTRY
