"""Registered queries over the driver tables, each with its SQL where one exists."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

DIGITS = 6


def digest_sql(seed: int, *parts: str) -> str:
    """SQL of ``seeded_digest``."""
    texts = [f"CAST({p} AS VARCHAR)" for p in (f"'{seed}'", *parts)]
    return "md5(concat(" + ", ".join(f"coalesce(length({t}) || ':' || {t}, '-')" for t in texts) + "))"


def draw_sql(seed: int, *parts: str) -> str:
    """SQL of ``draw(seeded_digest(...))``."""
    digest = digest_sql(seed, *parts)
    return f"(CAST(('0x' || substr({digest}, 1, 15)) AS BIGINT) * 8 + CAST(('0x' || substr({digest}, 16, 1)) AS BIGINT) // 2)"


def below_sql(seed: int, *parts: str) -> str:
    """SQL of the number whose remainder ``draw_below`` takes."""
    return f"CAST(('0x' || substr({digest_sql(seed, *parts)}, 1, 15)) AS BIGINT)"


def tidy(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles rounded (never -0.0), integers as bigint, decimals as doubles."""
    out = []
    for field in df.schema.fields:
        column, kind = F.col(f"`{field.name}`"), field.dataType.typeName()
        if kind in ("float", "double") or kind.startswith("decimal"):
            column = F.round(column.cast("double"), digits) + F.lit(0.0)
        elif kind in ("integer", "short", "byte", "long"):
            column = column.cast("long")
        out.append(column.alias(field.name))
    return df.select(*out)


def query(name: str, sql: str | None = None, doubles: str = "", ints: str = ""):
    """Register a query; ``doubles`` and ``ints`` are the SQL columns to round or cast."""

    def register(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return tidy(fn(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            changes = [f"round(CAST({c} AS DOUBLE), {DIGITS}) + 0.0 AS {c}" for c in doubles.split()]
            changes += [f"CAST({c} AS BIGINT) AS {c}" for c in ints.split()]
            replaced = f" REPLACE ({', '.join(changes)})" if changes else ""
            ORACLES[name] = f"SELECT *{replaced} FROM (\n{sql.strip()}\n) AS result"
        return fn

    return register
