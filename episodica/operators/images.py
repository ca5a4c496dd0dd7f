"""Packed frames: masks, layouts, chunk statistics.

Pixels are uint8 in FHWC order in ``binary`` columns, or ``array<int>`` where the
work is element-wise and can stay in the JVM. NumPy kernels see one Arrow batch at a
time; Spark does all grouping and summing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episodica.contract import EPISODE
from episodica.operators.checks import set_difference
from episodica.operators.quantiles import exact_quantiles, match
from episodica.operators.statistics import EPISODE_QUANTILES
from episodica.shared import scratch_path

CHUNK_FRAMES = 32
SLICE_BYTES = 1 << 23  # payload that a kernel widens or rewrites at a time


def scale_brightness(pixels: Column, scale: float) -> Column:
    """``floor(p * scale + 0.5)`` clipped to 0..255, over an array of pixels."""
    if not 0 < scale < 1:
        raise ValueError("scale must lie strictly between 0 and 1")

    def dim(p: Column) -> Column:
        return F.least(F.greatest(F.floor(p * F.lit(scale) + 0.5), F.lit(0)), F.lit(255)).cast("int")

    return F.transform(pixels, dim)


def scale_brightness_packed(pixels: Column, scale: float) -> Column:
    """P13 over packed frames."""
    if not 0 < scale < 1:
        raise ValueError("scale must lie strictly between 0 and 1")
    table = np.clip(np.floor(np.arange(256) * scale + 0.5), 0, 255).astype(np.uint8).tobytes()

    @F.pandas_udf(T.BinaryType())
    def dim(frames: pd.Series) -> pd.Series:
        return frames.map(lambda b: None if b is None else bytes(b).translate(table))

    return dim(pixels)


def zero_frame(pixels: Column) -> Column:
    """An all-zero array of the same size."""
    return F.array_repeat(F.lit(0), F.size(pixels))


def zero_frame_packed(pixels: Column) -> Column:
    """An all-zero packed frame of the same size."""
    return F.unhex(F.repeat(F.lit("00"), F.octet_length(pixels)))


@F.pandas_udf(T.BinaryType())
def pack_pixels(pixels: pd.Series) -> pd.Series:
    """uint8 array to packed bytes."""
    return pixels.map(lambda p: None if p is None else np.asarray(p, dtype=np.uint8).tobytes())


def _slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``SLICE_BYTES`` each, one row at least."""
    begin, held = 0, 0
    for i, size in enumerate(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
        if i > begin and held + size > SLICE_BYTES:
            yield begin, i
            begin, held = i, 0
        held += size
    if begin < len(column):
        yield begin, len(column)


def _bytes_at(column: pa.Array, i: int) -> np.ndarray | None:
    """The bytes of one row, without a copy."""
    return np.frombuffer(column[i].as_buffer(), dtype=np.uint8) if column[i].is_valid else None


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def unpack_pixels(frames: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Bytes as whole numbers, four times as wide: a slice of a batch at a time."""
    for batch in frames:
        for begin, end in _slices(batch):
            rows = [_bytes_at(batch, i) for i in range(begin, end)]
            ends = np.cumsum([0, *[0 if r is None else len(r) for r in rows]], dtype=np.int32)
            whole = np.concatenate([np.empty(0, np.uint8), *[r for r in rows if r is not None]]).astype(np.int32)
            missing = pa.array([r is None for r in rows])
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(whole), mask=missing)


def range_mask_frames(
    frames: DataFrame, near: float, far: float, scale: float = 0.001,
    pixels="pixels", depth="depth", height="height", width="width",
) -> DataFrame:
    """Keep a pixel only when its own depth and its four neighbours' lie within
    ``[near, far]`` metres; borders are invalid. Adds ``invalid_pixels`` and
    ``newly_zeroed_pixels``.

    A row is one frame with its depth (``array<int>``, row-major), so no grouping.
    """

    @F.pandas_udf("pixels binary, invalid_pixels long, newly_zeroed_pixels long")
    def mask(images: pd.Series, depths: pd.Series, hs: pd.Series, ws: pd.Series) -> pd.DataFrame:
        out = []
        for image, units, h, w in zip(images, depths, hs, ws, strict=True):
            metres = np.asarray(units, dtype=np.float32).reshape(h, w) * np.float32(scale)
            inside = (metres >= near) & (metres <= far)
            valid = np.zeros_like(inside)
            core = inside[1:-1, 1:-1] & inside[1:-1, :-2] & inside[1:-1, 2:]
            valid[1:-1, 1:-1] = core & inside[:-2, 1:-1] & inside[2:, 1:-1]
            shown = np.frombuffer(image, dtype=np.uint8).reshape(h, w, -1)
            fresh = np.count_nonzero(shown.any(axis=-1) & ~valid)
            kept = np.where(valid[..., None], shown, np.uint8(0))
            out.append((kept.tobytes(), int((~valid).sum()), int(fresh)))
        return pd.DataFrame(out, columns=["pixels", "invalid_pixels", "newly_zeroed_pixels"])

    masked = frames.withColumn("_m", mask(pixels, depth, height, width))
    return masked.withColumns(
        {
            pixels: F.col("_m.pixels"),
            "invalid_pixels": F.col("_m.invalid_pixels"),
            "newly_zeroed_pixels": F.col("_m.newly_zeroed_pixels"),
        }
    ).drop("_m")


def chunk_frames(frames: DataFrame, by=EPISODE, frame="frame_index", pixels="pixels", size=CHUNK_FRAMES):
    """Frames grouped into chunks of ``size`` per episode.

    A group never exceeds ``size`` frames, so gathering it is bounded.
    """
    keys = [*by, "chunk_index"]
    rows = frames.withColumn("chunk_index", F.floor(F.col(frame) / size).cast("int"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col(frame).alias("f"), F.col(pixels).alias("b"))))
    grouped = rows.groupBy(*keys).agg(
        F.min(frame).alias("start_frame"),
        F.count(F.lit(1)).cast("int").alias("frame_count"),
        F.first("height").alias("height"),
        F.first("width").alias("width"),
        F.first("channels").alias("channels"),
        F.transform(ordered, lambda x: x["b"]).alias("_parts"),
    )
    joined = F.unhex(F.array_join(F.transform("_parts", F.hex), ""))
    packed = grouped.withColumn("payload", joined).drop("_parts")
    return packed.withColumns(
        {
            "uncompressed_bytes": F.octet_length("payload").cast("long"),
            "payload_sha256": F.sha2("payload", 256),
        }
    )


def _frames_of(payload, f, h, w, c) -> np.ndarray:
    return np.frombuffer(payload, dtype=np.uint8).reshape(f, h, w, c)


def _layout_udf(change):
    @F.arrow_udf(T.BinaryType())
    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for payloads, *sizes in batches:
            for begin, end in _slices(payloads):
                shapes = zip(*[s[begin:end].to_pylist() for s in sizes], strict=True)
                rows = zip(range(begin, end), shapes, strict=True)
                yield pa.array([change(_bytes_at(payloads, i), *shape).tobytes() for i, shape in rows], pa.binary())

    return run


def _layout(chunks: DataFrame, change, payload: str) -> DataFrame:
    sizes = ["frame_count", "height", "width", "channels"]
    return chunks.withColumn(payload, _layout_udf(change)(payload, *sizes))


def temporal_delta(chunks: DataFrame, payload="payload") -> DataFrame:
    """Difference to the frame before modulo 256; the first frame stays absolute."""

    def change(p, f, h, w, c):
        frames = _frames_of(p, f, h, w, c)
        return np.concatenate([frames[:1], frames[1:] - frames[:-1]])

    return _layout(chunks, change, payload)


def temporal_restore(chunks: DataFrame, payload="payload") -> DataFrame:
    """Exact inverse, a running sum modulo 256."""
    return _layout(
        chunks,
        lambda p, f, h, w, c: np.cumsum(_frames_of(p, f, h, w, c), axis=0, dtype=np.uint8),
        payload,
    )


def planar_layout(chunks: DataFrame, payload="payload") -> DataFrame:
    """FHWC to FCHW."""
    return _layout(chunks, lambda p, f, h, w, c: _frames_of(p, f, h, w, c).transpose(0, 3, 1, 2), payload)


def interleaved_layout(chunks: DataFrame, payload="payload") -> DataFrame:
    """FCHW back to FHWC."""

    def change(p, f, h, w, c):
        return np.frombuffer(p, dtype=np.uint8).reshape(f, c, h, w).transpose(0, 2, 3, 1)

    return _layout(chunks, change, payload)


def layout_comparison(chunks: DataFrame, keys=(*EPISODE, "chunk_index"), compression="lz4_raw") -> DataFrame:
    """Bytes per layout after columnar compression, and whether it restores exactly.

    Each variant is written once as Parquet to the shared folder and read back; the files
    tell their own sizes.
    """
    spark = chunks.sparkSession
    keys = list(keys)
    variants = {
        "plain": (lambda d: d, lambda d: d),
        "planar": (planar_layout, interleaved_layout),
        "temporal_delta": (temporal_delta, temporal_restore),
    }
    original = chunks.select(*keys, F.sha2("payload", 256).alias("sha"))
    rows = []
    for name, (encode, decode) in variants.items():
        path = scratch_path(spark, f"layout-{name}")
        encode(chunks).write.parquet(path, compression=compression)
        written = spark.read.parquet(path)
        restored = decode(written).select(*keys, F.sha2("payload", 256).alias("sha"))
        differ = set_difference(original, restored).agg(F.count(F.lit(1)).alias("n"))
        sizes = written.select("_metadata.file_path", "_metadata.file_size").groupBy("file_path").agg(F.max("file_size").alias("size"))
        rows.append(
            sizes.agg(F.sum("size").alias("file_bytes")).select(
                F.lit(name).alias("layout"), "file_bytes", (differ.scalar() == 0).alias("restores_exactly")
            )
        )
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


def channel_stats(frames: DataFrame, by=EPISODE, pixels="pixels", channels: int = 3) -> DataFrame:
    """Per-episode statistics of each channel, scaled to 0..1.

    Tasks count pixel values per (episode, channel) in 256 bins; the counts are summed
    by Spark and all statistics are exact functions of them.
    """
    by = list(by)
    schema = frames.select(*by).schema.simpleString()[len("struct<") : -1].replace(":", " ")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for key, group in batch.groupby(by, sort=False, dropna=False):
                found = np.zeros((channels, 256), np.int64)
                # One frame and channel at a time: only that much is widened to whole numbers.
                for frame in group[pixels]:
                    planes = np.frombuffer(frame, dtype=np.uint8).reshape(-1, channels)
                    for c in range(channels):
                        found[c] += np.bincount(planes[:, c], minlength=256)
                found = found.ravel()
                at = np.flatnonzero(found)
                part = pd.DataFrame({"channel": at // 256, "level": at % 256, "n": found[at]})
                for name, value in zip(by, key, strict=True):
                    part[name] = value
                parts.append(part)
            if parts:
                yield pd.concat(parts)[[*by, "channel", "level", "n"]]

    counted = frames.select(*by, pixels).mapInPandas(count, f"{schema}, channel int, level int, n long")
    keys = [*by, "channel"]
    tally = counted.groupBy(*keys, "level").agg(F.sum("n").alias("n"))
    tally = tally.withColumn("value", F.col("level") / F.lit(255.0))
    n, x = F.col("n"), F.col("value")
    mean = F.sum(x * n) / F.sum(n)
    basic = tally.groupBy(*keys).agg(
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        mean.alias("mean"),
        F.sqrt(F.greatest(F.sum(x * x * n) / F.sum(n) - mean * mean, F.lit(0.0))).alias("std"),
        F.sum(n).alias("count"),
    )
    return match(basic, exact_quantiles(tally, keys, "value", EPISODE_QUANTILES, weight="n"), keys)


def chunk_actions(chunks: DataFrame, masked: DataFrame, by=EPISODE) -> DataFrame:
    """Chunks whose frames lost no pixel are reused, others rewritten."""
    keys = [*by, "chunk_index"]
    per_chunk = (
        masked.withColumn("chunk_index", F.floor(F.col("frame_index") / CHUNK_FRAMES).cast("int"))
        .groupBy(*keys)
        .agg(
            F.sum("newly_zeroed_pixels").alias("newly_zeroed_pixels"),
            F.sum("invalid_pixels").alias("invalid_pixels"),
        )
    )
    action = F.when(F.col("newly_zeroed_pixels") == 0, "reused").otherwise("rewritten")
    return chunks.join(per_chunk, keys).withColumn("action", action)


def chunk_totals(chunks: DataFrame, by=("dataset", "split")) -> DataFrame:
    """Bytes, frames, reused and rewritten chunks and zeroed pixels per split."""
    return chunks.groupBy(*by).agg(
        F.count(F.lit(1)).alias("chunks"),
        F.sum("frame_count").cast("long").alias("frames"),
        F.sum("uncompressed_bytes").cast("long").alias("uncompressed_bytes"),
        F.sum("compressed_bytes").cast("long").alias("compressed_bytes"),
        F.count_if(F.col("action") == "reused").alias("reused_chunks"),
        F.count_if(F.col("action") == "rewritten").alias("rewritten_chunks"),
        F.sum("newly_zeroed_pixels").cast("long").alias("newly_zeroed_pixels"),
        F.sum("invalid_pixels").cast("long").alias("invalid_pixels"),
    )
