"""Writing results."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_frames(frames: DataFrame, path: str, by=("split",), mode="errorifexists") -> None:
    """Frames as snappy Parquet, one folder per split."""
    frames.write.mode(mode).partitionBy(*by).parquet(path, compression="snappy")


def write_table_csv(df: DataFrame, path: str, compressed: bool = False, mode="errorifexists") -> None:
    """A result table as CSV with header; predictions are gzip-compressed."""
    df.write.mode(mode).csv(path, header=True, compression="gzip" if compressed else "none")


def write_manifest(summary: DataFrame, records: DataFrame, path: str, mode="errorifexists") -> None:
    """A manifest as one summary object and its records as JSON lines.

    Records stay distributed; no task holds the whole list.
    """
    summary.coalesce(1).write.mode(mode).json(f"{path}/summary")
    records.write.mode(mode).json(f"{path}/episodes", ignoreNullFields=False)


def write_packs(documents: DataFrame, path: str, mode="errorifexists") -> None:
    """Small documents ``(path, content)`` as rows of Parquet packs, byte for byte."""
    documents.select("path", "content").write.mode(mode).parquet(path)
