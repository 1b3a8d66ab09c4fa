"""Registry of named queries over the driver tables and their DuckDB oracles.

Each query is a function ``(spark, sf_dir) -> DataFrame`` that reads the
driver tables through ``plans.proxy`` and calls library operators; the
oracle is the same computation as plain SQL over the driver views.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir
from ..sources.tables import Tables
from .oracle_views import spark_rounding

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Register ``fn(t: Tables) -> DataFrame`` under ``name``."""

    def deco(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # lookups and training rounds checkpoint into the shared folder
            ensure_checkpoint_dir(spark)
            return fn(Tables(spark, sf_dir))

        run.__name__ = f"q_{name}"
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = spark_rounding(oracle)
        return fn

    return deco


def load_all() -> None:
    """Import every query module so its registrations run."""
    from . import (q_cohort, q_federated, q_files, q_governance, q_qc, q_sources,  # noqa: F401
                   q_streaming, q_variants)
