"""Names and fixed values shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Split names, split ratios and the frame-table keys.
SPLITS = ("train", "test", "validation")
RATIOS = {"train": 0.8, "test": 0.1, "validation": 0.1}
EPISODE = ("dataset", "split", "episode_index")
FRAME = (*EPISODE, "frame_index")

Layout = list[tuple[str, int, int]]
"""A modality layout: (key, start, end), half open."""


def columns(names) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def is_finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def finite_or_raise(value: Column, label: str) -> Column:
    """The value itself; the task fails on NaN, infinity or null."""
    return F.when(is_finite(value), value).otherwise(
        F.raise_error(F.lit(f"non-finite value in {label}")).cast("double")
    )
