"""Exact top-k by inner product as a Voronoi join.

Data rows belong to the cell of their nearest pivot; a cell's summary is its pivot p, radius
r, largest norm and number of rows. A query q first meets its own block of data, which gives
a score t that its k-th best cannot fall below. Another cell can hold a better row only if
its bound reaches t:

    q.x = q.p + q.(x - p) <= q.p + |q| r,   q.x <= |q| max|x|

Only then is the query sent to the cell's blocks. Data are never copied: the smaller side,
the queries, travels. A cell with many rows is dealt into blocks of about ``BLOCK``
rows, so a vector that a third of the rows share makes no large task. Pivots are
chosen from at most ``SAMPLE`` rows, which changes the work and never the result; there are
at most ``PIVOTS`` summaries, whatever the size of the data.

Defined results: vectors that are null, or hold null or non-finite components, and rows
with a null identifier take no part; a missing component at the end counts as 0; rows that
share an identifier are one candidate with its highest score; empty tables give an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.llm.tables import smallest_hashes, written

PIVOTS, SAMPLE, BLOCK = 64, 4096, 4096
EXACT = 2.0**53


def whole_components(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component; null if the vector takes no part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(vector.isNotNull() & finite, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def matrix(column, width: int) -> np.ndarray:
    """Packed vectors as rows of a matrix, filled up with zeros."""
    out = np.zeros((len(column), width), np.int64)
    for i, raw in enumerate(column):
        values = np.frombuffer(raw, "<i8")
        out[i, : len(values)] = values
    return out


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of all rows, exact: in doubles as long as no sum can leave their whole numbers."""
    most = np.abs(left).max(initial=0).astype(float) * np.abs(right).max(initial=0).astype(float) * left.shape[1]
    if most < EXACT:
        return (left.astype(float) @ right.T.astype(float)).astype(np.int64)
    return left @ right.T


def far_apart(sample: np.ndarray, count: int) -> np.ndarray:
    """Pivots: each the sample row farthest from those before it."""
    chosen, near = [0], ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(sample)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def best(queries: pd.DataFrame, data: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k highest scores of each query among the data, ties to smaller identifiers."""
    out = []
    if len(queries) and len(data):
        data = data.sort_values("id", ignore_index=True)
        width = max(map(len, [*queries["vec"], *data["vec"]])) // 8
        right = matrix(data["vec"], width)
        ids, first = np.unique(data["id"].to_numpy(), return_index=True)
        for begin in range(0, len(queries), 256):
            part = queries.iloc[begin : begin + 256]
            # Vectors that share an identifier are one candidate before k are taken.
            highest = np.maximum.reduceat(products(matrix(part["vec"], width), right), first, axis=1)
            for query, scores in zip(part["id"].to_numpy(), highest, strict=True):
                other = np.flatnonzero(ids != query)
                scores = scores[other]
                if len(other) > k:
                    least = np.partition(scores, -k)[-k]
                    at = np.flatnonzero(scores >= least)
                    at = at[np.argsort(-scores[at], kind="stable")[:k]]
                else:
                    at = np.arange(len(other))
                out.append(pd.DataFrame({"query_id": query, "vec_id": ids[other[at]], "score": scores[at]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding", pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """query_id, rank from 1, vec_id and score."""
    spark = vectors.sparkSession
    named = vectors.select(F.col(id_column).cast("long").alias("id"), whole_components(F.col(vector_column)).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    named = named.filter("id IS NOT NULL AND v IS NOT NULL")
    # Equal rows once; they are combined before the shuffle.
    once = named.groupBy("id", "v").agg(F.max("asks").alias("asks")).select("id", "v", "asks")
    sample = [r["v"] for r in smallest_hashes(named.select("id", "v"), SAMPLE, "id", "v").collect()]
    width = max(map(len, sample), default=1)
    centres = far_apart(matrix([np.array(v, "<i8").tobytes() for v in sample], width).astype(float), pivots) if sample else np.zeros((1, width))
    shared = spark.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = [np.array(v, "<i8").tobytes() for v in batch.column("v").to_pylist()]
            wide = max([shared.value.shape[1], *(len(r) // 8 for r in raws)])
            x, p = matrix(raws, wide).astype(float), np.pad(shared.value, ((0, 0), (0, wide - shared.value.shape[1])))
            distance = np.maximum((x**2).sum(axis=1)[:, None] - 2 * x @ p.T + (p**2).sum(axis=1), 0)
            cell = distance.argmin(axis=1)
            away = np.sqrt(((x - p[cell]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("asks"), pa.array(raws, pa.binary()), pa.array(cell), pa.array(away), pa.array(np.sqrt((x**2).sum(axis=1)))],
                names=["id", "asks", "vec", "cell", "away", "norm"],
            )

    placed = written(once.mapInArrow(assign, "id long, asks boolean, vec binary, cell long, away double, norm double"), "cells")
    found = placed.groupBy("cell").agg(F.max("away").alias("radius"), F.max("norm").alias("norm"), F.ceil(F.count("*") / block).alias("blocks")).collect()
    # One row per pivot.
    cells = {r["cell"]: (r["radius"], r["norm"], r["blocks"]) for r in found}
    blocks = F.create_map(*(F.lit(x) for c, (_, _, n) in (cells or {0: (0.0, 0.0, 1)}).items() for x in (c, n)))[F.col("cell")]
    data = placed.select("id", "vec", "cell", F.pmod(F.xxhash64("id"), blocks).alias("block"))
    queries = placed.filter("asks").select("id", "vec", "cell", F.pmod(F.xxhash64("id"), blocks).alias("block"))

    def solve(asked: DataFrame) -> DataFrame:
        return asked.groupBy("cell", "block").cogroup(data.groupBy("cell", "block")).applyInPandas(lambda q, d: best(q, d, k), "query_id long, vec_id long, score long")

    home = written(solve(queries), "home-results")
    # k candidates, each once: only then is the lowest a score that the k-th best cannot fall below.
    floor = home.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("n"))
    asked = queries.join(floor, queries["id"] == floor["query_id"], "left").select("id", "vec", "cell", "block", F.when(F.col("n") >= k, F.col("least")).alias("least"))
    summaries = spark.sparkContext.broadcast((centres, cells))

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, cells = summaries.value
        order = sorted(cells)
        radius, norm = (np.array([cells[c][i] for c in order]) for i in (0, 1))
        for batch in batches:
            ids, raws, own, own_block, least = (batch.column(i).to_pylist() for i in range(5))
            wide = max([centres.shape[1], *(len(r) // 8 for r in raws)])
            q = matrix(raws, wide).astype(float)
            size = np.sqrt((q**2).sum(axis=1))[:, None]
            bound = np.minimum(q @ np.pad(centres[order], ((0, 0), (0, wide - centres.shape[1]))).T + size * radius, size * norm)
            # Rounding never hides a cell.
            bound = bound + 1e-6 * (1 + np.abs(bound))
            rows = []
            for i in range(len(ids)):
                for at in np.flatnonzero(bound[i] >= (-np.inf if least[i] is None else least[i])):
                    cell = order[at]
                    rows += [(ids[i], raws[i], cell, b) for b in range(cells[cell][2]) if (cell, b) != (own[i], own_block[i])]
            columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64())], names=["id", "vec", "cell", "block"])

    further = solve(asked.mapInArrow(reach, "id long, vec binary, cell long, block long"))
    every = home.union(further).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    # At most k rows per query and block it was sent to, kept in order as k numbers.
    ranked = every.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("below"), F.col("vec_id")))), 1, k).alias("top"))
    return ranked.select("query_id", F.posexplode("top").alias("at", "r")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("r.vec_id"), (-F.col("r.below")).alias("score"))
