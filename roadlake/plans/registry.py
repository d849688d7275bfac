"""The registry of named queries: a Spark callable and, where SQL can say the same, its check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.plans.views import with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = with_views(sql, *views) if views else sql
        return fn

    return register


def q4(value: Column) -> Column:
    """Four decimals for comparison across engines; the nudge keeps exact ties on one side in both."""
    return F.floor(value * F.lit(1e4) + F.lit(0.500001)) / F.lit(1e4)


def s4(expr: str) -> str:
    """`q4` in SQL."""
    return f"floor(({expr})*1e4 + 0.500001e0)/1e4"


def even_sql(expr: str, digits: int) -> str:
    """Decimal rounding of the exact binary value, ties to even, in SQL."""
    s, x = f"1e{digits}", f"({expr})"
    p, hi = f"({x}*{s})", f"({x}*134217729.0e0-({x}*134217729.0e0-{x}))"
    err = f"(({hi}*{s}-{p})+({x}-{hi})*{s})"
    part = f"({p}-floor({p}))"
    return f"((floor({p})+CASE WHEN {part}>0.5e0 OR ({part}=0.5e0 AND ({err}>0 OR ({err}=0 AND floor({p})%2<>0))) THEN 1.0e0 ELSE 0.0e0 END)/{s})"
