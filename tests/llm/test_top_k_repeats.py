"""Top-k where identifiers and rows repeat, against all pairs."""

import numpy as np
from episodica.llm import topk
from pyspark.sql import functions as F


def expected(rows, k):
    best = {}
    for q, v in rows:
        if q % 7 == 0:
            for i, w in rows:
                if i != q:
                    score = int(np.floor(64 * np.array(v)) @ np.floor(64 * np.array(w)))
                    best.setdefault(q, {})[i] = max(score, best.get(q, {}).get(i, score))
    return {(q, rank): (i, s) for q, found in best.items() for rank, (i, s) in enumerate(sorted(found.items(), key=lambda x: (-x[1], x[0]))[:k], 1)}


def found(spark, rows, k, **settings):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    return {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(table, F.col("vec_id") % 7 == 0, k, **settings).collect()}


def test_copies_of_one_identifier_are_one_candidate(spark):
    draw = np.random.default_rng(5)
    rows = [(i, draw.normal(size=4).tolist()) for i in range(60)]
    rows += [(1000, [9.0, 9.0, 9.0, 9.0])] * 30 + [(1001, (8 + draw.normal(size=4)).tolist()) for _ in range(30)]
    for settings in ({}, {"pivots": 4, "block": 8}):
        assert found(spark, rows, 5, **settings) == expected(rows, 5)


def test_a_repeated_query_does_not_prune_cells(spark):
    """Three candidates beside each query, the others in cells that two copies of it must not close."""
    draw = np.random.default_rng(6)
    centres = [(8 * draw.normal(size=4)) for _ in range(12)]
    rows = [(7 * c + i, (centre + draw.normal(size=4) / 8).tolist()) for c, centre in enumerate(centres) for i in range(4)]
    rows += [r for r in rows if r[0] % 7 == 0] * 2
    assert found(spark, rows, 5, pivots=12) == expected(rows, 5)
