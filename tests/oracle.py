"""Runs registered queries and their SQL side by side."""

from __future__ import annotations

import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if hasattr(value, "item"):
        return _plain(value.item())
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def normalized(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(body, key=repr)


def compare(df, con, sql) -> list[str]:
    """Differences, empty when both sides agree exactly."""
    mine = normalized(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    theirs = normalized([c[0] for c in found.description], found.fetchall())
    problems = []
    if mine[0] != theirs[0]:
        problems.append(f"columns {mine[0]} != {theirs[0]}")
    if len(mine[1]) != len(theirs[1]):
        problems.append(f"rows {len(mine[1])} != {len(theirs[1])}")
    wrong = [(a, b) for a, b in zip(mine[1], theirs[1], strict=False) if a != b]
    if wrong:
        problems.append(f"{len(wrong)} rows differ, e.g. {wrong[0]}")
    types = [
        (a, type(a).__name__, type(b).__name__)
        for x, y in zip(mine[1], theirs[1], strict=False)
        for a, b in zip(x, y, strict=False)
        if a is not None and b is not None and type(a) is not type(b)
    ]
    if types:
        problems.append(f"types differ, e.g. {types[0]}")
    return problems
