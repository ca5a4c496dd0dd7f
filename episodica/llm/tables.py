"""Small helpers for the operators: reading tables, written intermediate tables, text batches."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.shared import scratch_path

CHUNK = 2_000_000
"""Characters of text handled at once inside a task."""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the cluster's shared folder and read back: cuts lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def located(docs: DataFrame, by_content: bool = False) -> DataFrame:
    """row (all columns of ``docs``) and locator (file and row in the file): where each row can be read again.

    File names change with every run where ``docs`` is a written table. With ``by_content`` a hash
    of all columns comes first, so that the order of locators is the same in every run, but
    for fully equal rows.
    """
    found = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    try:
        rows = docs.select(F.struct("*").alias("row"), F.struct(*found).alias("locator"))
    except AnalysisException:
        return located(written(docs, "located"), by_content)
    if not by_content:
        return rows
    return rows.select("row", F.struct(F.xxhash64(F.to_json("row")).alias("content"), F.col("locator.file"), F.col("locator.row")).alias("locator"))


def keyed(docs: DataFrame, id_column: str) -> DataFrame:
    """row, and ``key``: the identifier first, then content and locator, so that rows that share it are told apart."""
    return located(docs, by_content=True).select("row", F.struct(F.col(f"row.`{id_column}`").alias("id"), "locator.*").alias("key"))


def only(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The columns of those ``keyed`` rows whose key is the ``id`` of ``keys``."""
    wanted = keys.select(F.col("id.file").alias("_file"), F.col("id.row").alias("_row"))
    return rows.join(wanted, (F.col("key.file") == F.col("_file")) & (F.col("key.row") == F.col("_row")), "left_semi").select("row.*")


def texts_of(column: pa.Array) -> list[str]:
    """A string column as a list, null as the empty text."""
    return [t or "" for t in column.to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], text: int, limit: int = CHUNK) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of batches with about ``limit`` characters in column ``text``, one row at least.

    A text longer than ``limit`` makes a part of its own; no text is cut.
    """
    for batch in batches:
        texts, begin, size = texts_of(batch.column(text)), 0, 0
        for end, value in enumerate(texts):
            if size and size + len(value) > limit:
                yield batch.slice(begin, end - begin), texts[begin:end]
                begin, size = end, 0
            size += len(value)
        if begin < len(texts):
            yield batch.slice(begin), texts[begin:]


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))


def kept_in_worker(key: str, make: Callable[[], object]):
    """What a task leaves for later tasks of the same Python worker, such as an encoder's memo.

    Only the last object of a kind (the text before ``:`` of the key) is kept.
    """
    store = sys.modules.setdefault("_kept_between_tasks", ModuleType("_kept_between_tasks")).__dict__
    kind = key.partition(":")[0]
    if store.get(kind, (None,))[0] != key:
        store[kind] = (key, make())
    return store[kind][1]


def smallest_hashes(rows: DataFrame, limit: int, *columns: str) -> DataFrame:
    """The ``limit`` rows with the smallest hash of ``columns``.

    Rows far beyond the limit are filtered out first, so that partitions send few to the driver.
    """
    share = min(1.0, 2.0 * (limit + 100) / max(1, rows.count()))
    hashed = rows.withColumn("_hash", F.xxhash64(*columns))
    least = -(1 << 63) + int(share * ((1 << 64) - 1))
    return hashed.filter(F.col("_hash") <= min(least, (1 << 63) - 1)).orderBy("_hash", *columns).limit(limit).drop("_hash")
