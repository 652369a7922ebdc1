"""Numeric helpers shared by queries and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sig_round_sql(expr: str, digits: int = 6) -> str:
    """SQL text rounding ``expr`` to ``digits`` significant digits.

    Written in the common subset of Spark SQL and DuckDB so both engines run
    the same IEEE operations: scale by an exact power of ten, round half away
    from zero, scale back.
    """
    e = f"(floor(log10(abs({expr}))) - {digits - 1})"
    return (
        f"(CASE WHEN {expr} IS NULL THEN NULL "
        f"WHEN {expr} = 0 THEN CAST(0 AS DOUBLE) "
        f"WHEN {e} >= 0 THEN round({expr} / power(10, {e})) * power(10, {e}) "
        f"ELSE round({expr} * power(10, -{e})) / power(10, -{e}) END)"
    )


def sig_round(col: str | Column, digits: int = 6) -> Column:
    """Column version of :func:`sig_round_sql`."""
    c = F.col(col) if isinstance(col, str) else col
    e = F.floor(F.log10(F.abs(c))) - (digits - 1)
    pos = F.round(c / F.pow(F.lit(10.0), e)) * F.pow(F.lit(10.0), e)
    neg = F.round(c * F.pow(F.lit(10.0), -e)) / F.pow(F.lit(10.0), -e)
    return (F.when(c.isNull(), F.lit(None).cast("double"))
            .when(c == 0, F.lit(0.0))
            .when(e >= 0, pos)
            .otherwise(neg))
