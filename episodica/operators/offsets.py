"""Differences of a row to the rows ahead, counted without one row per offset."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.operators.ordered import BLOCK_ROWS, index_block
from episodica.operators.quantiles import CELLS, INFINITE, NAN, match, merged_cells, settle

FLUSH = 2_000_000
"""Differences that a task holds before they are counted."""


def cells_of(values: np.ndarray) -> np.ndarray:
    """A log-linear histogram cell; never falls as the value grows."""
    size = np.abs(values)
    fraction, power = np.frexp(size)
    with np.errstate(invalid="ignore"):
        inside = np.floor((2 * fraction - 1) * CELLS)
        cell = np.where(np.isfinite(size), (power + 1099.0) * CELLS + inside, INFINITE)
    cell = np.where(np.isnan(values), NAN, np.where(size < 1e-300, 0, cell)).astype(np.int64)
    return np.where(values < 0, -cell, cell)


def edges_of(cells: np.ndarray) -> np.ndarray:
    """The lower edge of each cell's sizes; 0 for cells of no number."""
    place = np.abs(cells)
    sound = (place > 0) & (place < INFINITE)
    place = np.where(sound, place, 0)
    return np.where(sound, np.ldexp(1 + place % CELLS / CELLS, (place // CELLS - 1100).astype(np.int32)), 0.0)


class Vectors:
    """Vectors of the open segment as matrices, with what is null in them."""

    def __init__(self, column: pa.Array):
        if column.null_count:
            raise ValueError("a vector is null")
        widths = np.unique(column.value_lengths().to_numpy(zero_copy_only=False))
        if len(widths) > 1:
            raise ValueError("vectors have different widths")
        flat = column.flatten()
        self.values = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
        self.known = pc.is_valid(flat).to_numpy(zero_copy_only=False).reshape(len(column), -1)


def ahead_differences(batches: Iterator[pa.RecordBatch], keys: int, horizon: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, action(t + k) - state(t), whether it is known) of rows with ``horizon`` rows from them on.

    Columns: ``keys`` that tell segments apart, home (whether a row counts itself), action, state.
    Rows come in order; a segment may go on in the next batch.
    """
    held, last = None, None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        changes = np.zeros(n, bool)
        for c in range(keys):
            column = batch.column(c)
            changes[1:] |= pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        first = [batch.column(c)[0].as_py() for c in range(keys)]
        changes[0] = first != last
        last = [batch.column(c)[n - 1].as_py() for c in range(keys)]
        home = batch.column(keys).to_numpy(zero_copy_only=False)
        action, state = Vectors(batch.column(keys + 1)), Vectors(batch.column(keys + 2))
        rows = [home, action.values, action.known, state.values, state.known]
        edges = [*np.flatnonzero(changes).tolist(), n]
        if edges[0]:
            edges = [0, *edges]
        for begin, end in zip(edges[:-1], edges[1:], strict=True):
            part = [r[begin:end] for r in rows]
            if held is not None and not changes[begin]:
                part = [np.concatenate([a, b]) for a, b in zip(held, part, strict=True)]
            full = len(part[0]) - horizon + 1
            if full > 0:
                here = part[0][:full]
                for k in range(horizon):
                    difference = part[1][k : k + full] - part[3][:full]
                    yield k, difference[here], (part[2][k : k + full] & part[4][:full])[here]
            held = [r[-(horizon - 1) :] if horizon > 1 else r[:0] for r in part]


def gathered(differences, flush: Callable) -> Iterator[pa.RecordBatch]:
    """``flush(k, joints, values)`` for each offset, some ``FLUSH`` differences at a time."""
    kept: dict[int, list] = {}
    size = 0

    def counted():
        for k, parts in kept.items():
            values, known = (np.concatenate(p) for p in zip(*parts, strict=True))
            joints = np.broadcast_to(np.arange(values.shape[1]), values.shape)
            yield flush(k, joints[known], values[known])

    for k, values, known in differences:
        kept.setdefault(k, []).append((values, known))
        size += values.size
        # Whole rows of offsets only, so that memory stays in proportion.
        if size >= FLUSH:
            yield from counted()
            kept, size = {}, 0
    yield from counted()


def _cell_rows(k: int, joints: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    cells = cells_of(values)
    order = np.lexsort([cells, joints])
    joints, cells, values = joints[order], cells[order], values[order]
    fresh = np.flatnonzero(np.concatenate([[True], (joints[1:] != joints[:-1]) | (cells[1:] != cells[:-1])])) if len(cells) else np.zeros(0, np.int64)
    n = np.diff(np.append(fresh, len(cells)))
    with np.errstate(invalid="ignore"):
        over = np.abs(values) - edges_of(cells)
        sums = [np.add.reduceat(x, fresh) if len(fresh) else x for x in (values, over, over * over)]
        low = np.minimum.reduceat(values, fresh) if len(fresh) else values
        high = np.maximum.reduceat(values, fresh) if len(fresh) else values
    columns = [joints[fresh].astype(np.int32), np.full(len(fresh), k, np.int32), cells[fresh], n, *sums, low, high]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["joint_index", "k", "_cell", "_m", "_v", "_over", "_over2", "_low", "_high"])


def _value_rows(wanted: dict[int, tuple[np.ndarray, np.ndarray]]):
    def rows(k: int, joints: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        if k in wanted:
            cells = cells_of(values)
            place = np.searchsorted(wanted[k][0], joints.astype(np.int64) << 44 | (cells + (1 << 43)))
            place = np.minimum(place, len(wanted[k][0]) - 1)
            hit = wanted[k][0][place] == (joints.astype(np.int64) << 44 | (cells + (1 << 43)))
        else:
            hit = np.zeros(len(values), bool)
            cells = np.zeros(len(values), np.int64)
        joints, cells, values = joints[hit], cells[hit], values[hit]
        order = np.lexsort([values, joints])
        joints, cells, values = joints[order], cells[order], values[order]
        fresh = np.flatnonzero(np.concatenate([[True], (joints[1:] != joints[:-1]) | (values[1:] != values[:-1])])) if len(cells) else np.zeros(0, np.int64)
        n = np.diff(np.append(fresh, len(cells)))
        columns = [joints[fresh].astype(np.int32), np.full(len(fresh), k, np.int32), cells[fresh], values[fresh], n]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["joint_index", "k", "_cell", "_v", "_n"])

    return rows


def offset_profile(df: DataFrame, action: str, state: str, by, order: str, horizon: int, views) -> DataFrame:
    """``joint_index, k``, moments and quantiles of action(t + k) - state(t), as from ``profile``.

    Blocks of an episode overlap by the horizon, so one shuffle of rows serves all offsets.
    A task walks its blocks once and sends counts per (joint, offset, cell) only; the second
    pass sends the values in the wanted cells. Vectors must not be null and have one width;
    null members are left out.
    """
    by = list(by)
    home = index_block(order, BLOCK_ROWS)
    both = F.when((F.col(order) % BLOCK_ROWS < horizon - 1) & (F.col(order) >= BLOCK_ROWS), F.array(home, home - 1)).otherwise(F.array(home))
    rows = df.select(*by, order, F.col(action).cast("array<double>").alias("_a"), F.col(state).cast("array<double>").alias("_s"), F.explode(both).alias("_block"))
    keys = [*by, "_block"]
    # A fixed number of tasks: few bytes make much work here, so small partitions stay apart.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = rows.repartition(tasks, *keys).sortWithinPartitions(*keys, order)
    laid = laid.select(*keys, (F.col("_block") == home).alias("_home"), "_a", "_s")
    width = len(keys)

    def counted(flush: Callable, schema: str) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return gathered(ahead_differences(batches, width, horizon), flush)

        return laid.mapInArrow(run, schema)

    subject = ["joint_index", "k"]
    partial = counted(_cell_rows, "joint_index int, k int, _cell long, _m long, _v double, _over double, _over2 double, _low double, _high double")

    def values_of(hits: DataFrame) -> DataFrame:
        # At most two cells per joint, offset and quantile.
        wanted: dict[int, list[int]] = {}
        for r in hits.select(*subject, "_cell").distinct().collect():
            wanted.setdefault(r["k"], []).append(r["joint_index"] << 44 | (r["_cell"] + (1 << 43)))
        sought = {k: (np.array(sorted(codes), np.int64), None) for k, codes in wanted.items()}
        found = counted(_value_rows(sought), "joint_index int, k int, _cell long, _v double, _n long")
        return match(found.withColumn("_size", F.abs("_v")), hits, [*subject, "_cell"])

    return settle(merged_cells(partial, subject), subject, views, False, values_of)
