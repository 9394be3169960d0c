"""Query registration: a Spark function, and SQL written separately to check it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from loamgrid.session import tune

from .adapters import Tables, sql_ctes

# Sums depend on their order in the last digits.  Both engines nudge values off
# exact decimal ties the same way and round; a convention of these outputs only.
NUDGE, DIGITS = 1e-9, 6


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def tidy(df: DataFrame) -> DataFrame:
    """Every floating column as a rounded double."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floating:
        return df
    return df.selectExpr(
        *[f"round(cast({c} as double) + {NUDGE:.9f}D, {DIGITS}) as {c}" if c in floating else c for c in df.columns]
    )


def _rounded_sql(body: str, doubles: Sequence[str]) -> str:
    if not doubles:
        return f"select * from ({body}) q"
    swaps = ", ".join(f"round(cast({c} as double) + {NUDGE}, {DIGITS}) as {c}" for c in doubles)
    return f"select * replace ({swaps}) from ({body}) q"


def query(
    name: str, *, views: Sequence[str] = (), ctes: Sequence[str] = (), sql: str | None = None, doubles: Sequence[str] = (),
) -> Callable:
    """Register ``fn(tables) -> DataFrame`` and its checking SQL.

    ``views`` are the adapter views the SQL reads, ``ctes`` further named steps,
    ``sql`` the final select, ``doubles`` the columns it rounds.
    """

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        text = None
        if sql is not None:
            steps = [s for s in ([sql_ctes(*views)] if views else []) + list(ctes) if s]
            head = ("with " + ",\n".join(steps) + "\n") if steps else ""
            text = head + _rounded_sql(sql, doubles)

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return tidy(fn(Tables(tune(spark), sf_dir)))

        QUERIES[name] = Query(name, run, text)
        return fn

    return register
