"""Registry of named queries: a DataFrame plan plus, where SQL can express
it, the equivalent DuckDB SQL used as the correctness oracle.

test tables (or data Spark derives from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    The result is passed through ``finalize`` so both sides agree on
    rounding and on how lists are rendered.
    """
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finalize(fn(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def finalize(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles (and map -0.0 to 0.0); render string lists as
    ``['a', 'b']`` — the comparison rules of SURVEY §5."""
    from emolens.operators.describe import list_literal

    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DoubleType, FloatType)):
            # relative nudge resolves exact ties the same way as the oracle
            c = F.round(c.cast("double") * F.lit(1 + 1e-12), digits) + F.lit(0.0)
        elif isinstance(f.dataType, ArrayType):
            c = list_literal(c.cast("array<string>"))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def load_all() -> None:
    """Import every query module so that its ``@register`` calls run."""
    from emolens.plans import (q_eval, q_features, q_io, q_models, q_pipeline, q_prep,  # noqa: F401
                               q_recommend, q_stats, q_terms)
