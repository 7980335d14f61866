"""Registration of queries with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scalars import half_up
from ..session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def stable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded half-up, so that summation order does not show in comparisons."""
    return df.select(*[
        half_up(F.col(f"`{name}`"), digits).alias(name) if kind in ("double", "float") else F.col(f"`{name}`")
        for name, kind in df.dtypes
    ])


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL that gives the same rows."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return stable(build(prepare(spark), sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register
