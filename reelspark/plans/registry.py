"""Registered queries: a Spark plan over the adapted corpus, the SQL that says the same, and the types of the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.adapter import SQL, Corpus

PLANS: dict[str, tuple[str, Callable[[Corpus], DataFrame], str | None]] = {}


def query(name: str, columns: str, sql: str | None = None):
    """columns: ``name:type`` with l long, d double (9 digits), s string, b boolean. sql: what follows the corpus; None
    where SQL can't say it."""

    def put(f):
        PLANS[name] = (columns, f, sql)
        return f

    return put


def _fields(columns: str) -> list[tuple[str, str]]:
    return [tuple(c.split(":")) for c in columns.split()]


def _typed(df: DataFrame, columns: str) -> DataFrame:
    made = {"l": lambda c: c.cast("long"), "d": lambda c: F.round(c.cast("double"), 9), "s": lambda c: c.cast("string"), "b": lambda c: c.cast("boolean")}
    return df.select(*[made[t](F.col(n)).alias(n) for n, t in _fields(columns)])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from ..session import ship

    def one(columns, f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return _typed(f(Corpus(spark, sf_dir)), columns)

        return run

    return {name: one(columns, f) for name, (columns, f, _) in PLANS.items()}


def oracle_sql() -> dict[str, str]:
    made = {"l": "CAST({0} AS BIGINT)", "d": "round(CAST({0} AS DOUBLE), 9)", "s": "CAST({0} AS VARCHAR)", "b": "CAST({0} AS BOOLEAN)"}
    out = {}
    for name, (columns, _, sql) in PLANS.items():
        if sql:
            listed = ", ".join(f"{made[t].format(n)} AS {n}" for n, t in _fields(columns))
            ctes, _, body = sql.rpartition("@@")
            out[name] = f"{SQL}{', ' + ctes if ctes.strip() else ''} SELECT {listed} FROM ({body})"
    return out
