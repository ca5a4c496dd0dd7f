"""Reading datasets."""

from __future__ import annotations

import os
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episodica.functions.labels import name_number
from episodica.operators.checks import all_of, violations
from episodica.shared import checkpointed, sized

TASKS = "task_index long, task string"
EPISODES = "episode_index long, tasks array<string>, length long"
STATS = (
    "episode_index long, stats map<string, struct<min: array<double>, max: array<double>, "
    "mean: array<double>, std: array<double>, count: array<double>, q01: array<double>, "
    "q10: array<double>, q50: array<double>, q90: array<double>, q99: array<double>>>"
)
INFO = (
    "codebase_version string, robot_type string, fps double, total_episodes long, "
    "total_frames long, total_tasks long, total_videos long, total_chunks long, "
    "chunks_size long, data_path string, video_path string, splits map<string,string>, "
    "features map<string, struct<dtype: string, shape: array<int>, names: string>>, "
    "depth_encoding string, raw_depth_encoding string, aligned_depth_encoding string, "
    "surface_normals_encoding string, camera_calibration string, end_effector string"
)
_LIMB = "struct<qpos: array<double>>"
_LIMBS = f"struct<left_arm: {_LIMB}, right_arm: {_LIMB}, left_ee: {_LIMB}, right_ee: {_LIMB}>"
RAW = (
    "info struct<depth: struct<scale_m_per_unit: double>>, text struct<goal: string>, "
    "timing struct<capture_start_utc: string>, data array<struct<idx: long, timestamp_s: double, "
    "colors: struct<color_0: string>, depths: struct<depth_0: string, raw_depth_0: string>, "
    f"states: {_LIMBS}, actions: {_LIMBS}>>"
)
RECORD = (
    "split string, split_episode string, flattened_episode string, source_dataset string, "
    "source_episode string, source_session string, goal string, frame_count long, "
    "data_json_sha256 string, final_episode_index long, final_index_start long, "
    "final_index_end_exclusive long, camera_calibration_fingerprint string"
)
METRICS = ("split", "checkpoint_step", "episodes", "frames", "mae", "mse", "dimensions", "samples")
STATUS = ("stage", "model", "status", "exit_code")


def scan_inventory(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """The files below ``root`` with relative path and size; contents are not read.

    Spark's file sources leave out empty files and names that start with ``_`` or ``.``.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(root).select(relative(F.col("path"), root).alias("path"), F.col("length").alias("size"))


def relative(path: Column, root: str) -> Column:
    """The part of ``path`` below ``root``, whatever scheme either is written with.

    The root is a prefix: only its first place counts, at the beginning of an absolute path, or, for a
    relative root, the path of the working folder comes before it.
    """
    name = root.split("://", 1)[-1].strip("/")
    if "://" not in root and not root.startswith("/"):
        name = os.path.abspath(root).strip("/")
    plain = F.ltrim(F.regexp_replace(path, "^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", ""), F.lit("/"))
    return F.when(plain.startswith(f"{name}/"), F.substr(plain, F.lit(len(name) + 2))).otherwise(path)


def scan_frames(spark, root, columns, max_files: int | None = None, vectors=(), with_file: bool = False) -> DataFrame:
    """Chosen columns of the frame files below ``root``; ``vectors`` become doubles.

    ``max_files`` keeps the first files in path order; only their names reach the driver.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if max_files is not None:
        if max_files <= 0:
            raise ValueError("max_files must be positive")
        names = scan_inventory(spark, root, "*.parquet").orderBy("path").limit(max_files)
        frames = reader.parquet(*[f"{root.rstrip('/')}/{row.path}" for row in names.collect()])
    else:
        frames = reader.parquet(root)
    picked = [F.col(c).cast("array<double>").alias(c) if c in vectors else F.col(c) for c in columns]
    file = [relative(F.col("_metadata.file_path"), root).alias("file")] if with_file else []
    return frames.select(*picked, *file)


def scan_metadata(spark, path, schema) -> DataFrame:
    """One JSON object per non-blank line; anything else fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def scan_info(spark, path, schema=INFO) -> DataFrame:
    """S3: one JSON record per file; nested parts named as strings keep their JSON text."""
    return spark.read.schema(schema).option("multiLine", "true").option("mode", "FAILFAST").json(path)


def raw_documents(spark, root, pattern="data.json", packed: bool = False) -> DataFrame:
    """Path below ``root`` and content of each raw document: a file each, or a row each of Parquet packs.

    Opening and listing cost some milliseconds a file whatever its size, so sources of many small
    documents are kept in packs (``sinks.write_packs``).
    """
    if packed:
        return spark.read.schema("path string, content binary").parquet(root)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = files.option("pathGlobFilter", pattern).load(root)
    return files.select(relative(F.col("path"), root).alias("path"), "content")


def scan_raw_episodes(spark, root, pattern="data.json", once: bool = False, packed: bool = False) -> DataFrame:
    """Raw episodes with goal, frame count, hash, capture start and session.

    Also keeps the parsed ``data`` for P11 and V3. With ``once`` the files are read and parsed
    once into a checkpointed table with nested frames, for callers that read it several times.
    """
    parts = F.split("path", "/")
    rows = raw_documents(spark, root, pattern, packed).select(
        "path",
        F.try_element_at(parts, F.lit(-2)).alias("episode"),
        F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 2, F.lit(0))), "/").alias("source_session"),
        F.sha2("content", 256).alias("data_json_sha256"),
        F.from_json(F.decode("content", "utf-8"), RAW, {"mode": "FAILFAST"}).alias("j"),
    )
    out = rows.select(
        "path",
        "episode",
        name_number(F.col("episode")).alias("episode_number"),
        F.when(F.col("source_session") == "", F.col("episode")).otherwise(F.col("source_session")).alias("source_session"),
        F.trim(F.coalesce("j.text.goal", F.lit(""))).alias("goal"),
        F.size("j.data").alias("frame_count"),
        "data_json_sha256",
        F.col("j.timing.capture_start_utc").alias("capture_start_utc"),
        F.col("j.info.depth.scale_m_per_unit").alias("depth_scale"),
        F.col("j.data").alias("data"),
    )
    return checkpointed(out) if once else out


def raw_frames(episodes: DataFrame) -> DataFrame:
    """Exploded raw frames with their position."""
    rows = episodes.select("episode", "episode_number", "goal", F.posexplode("data").alias("position", "f"))
    return rows.select(
        "episode", "episode_number", "goal", "position", "f.idx", "f.timestamp_s", "f.states", "f.actions",
        F.array("f.colors.color_0", "f.depths.depth_0", "f.depths.raw_depth_0").alias("media"),
    )


def raw_to_frames(frames: DataFrame, tasks: DataFrame, numbered: DataFrame) -> DataFrame:
    """Flat frame rows with 28-wide state and action and all indices.

    ``numbered``: ``episode, new_episode_index, first_index``; ``tasks``: task per goal.
    """
    def vector(section: str) -> Column:
        return F.concat(*[F.col(f"{section}.{p}.qpos") for p in ("left_arm", "right_arm", "left_ee", "right_ee")])

    named = tasks.select("task_index", F.col("task").alias("goal"))
    rows = frames.join(sized(named), "goal").join(numbered, "episode")
    return rows.select(
        F.col("new_episode_index").alias("episode_index"),
        F.col("position").cast("long").alias("frame_index"),
        (F.col("first_index") + F.col("position")).alias("index"),
        "task_index",
        F.col("timestamp_s"),
        vector("states").alias("state"),
        vector("actions").alias("action"),
    )


def scan_manifest(spark, path, lines: bool = True, schema=RECORD) -> DataFrame:
    """Episode records of a manifest.

    ``lines`` reads the record lines of ``write_manifest``; otherwise ``path`` holds
    JSON documents with an ``episodes`` list.
    """
    if lines:
        return scan_metadata(spark, path, schema)
    inner = "struct<" + ", ".join(f.replace(" ", ": ", 1) for f in schema.split(", ")) + ">"
    whole = scan_info(spark, path, f"version int, strategy string, seed long, episodes array<{inner}>")
    return whole.select(F.explode("episodes").alias("e")).select("e.*")


def manifest_duplicates(records: DataFrame, keys=("split", "final_episode_index")) -> DataFrame:
    """Keys that occur more than once."""
    return records.groupBy(*keys).agg(F.count(F.lit(1)).alias("records")).where("records > 1")


def _text_table(spark, path, names, sep) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    reader = spark.read.schema(schema).option("header", "true").option("sep", sep)
    return reader.option("enforceSchema", "false").option("mode", "FAILFAST").csv(path)


def scan_metric_csv(spark, path, columns=("model", *METRICS)) -> DataFrame:
    """Strict metric rows; the header must match and every cell must parse.

    Numbers are exact decimals or positive integers; others fail the task.
    """
    rows = _text_table(spark, path, columns, ",")

    def strict(name: str, kind: str, minimum: int) -> Column:
        value = F.trim(F.col(name)).try_cast(kind)
        return F.when(value >= minimum, value).otherwise(
            F.raise_error(F.concat(F.lit(f"invalid {name}: "), F.coalesce(F.col(name), F.lit("null")))).cast(kind)
        )

    kinds = {n: ("decimal(38,18)", 0) if n in ("mae", "mse") else ("long", 0 if n == "checkpoint_step" else 1) for n in METRICS}
    return rows.select(
        *[
            strict(c, *kinds[c]).alias(c) if c in kinds and c != "split" else F.trim(F.col(c)).alias(c)
            for c in columns
        ]
    )


def scan_status_tsv(spark, path) -> DataFrame:
    """Run status rows under the exact header."""
    rows = _text_table(spark, path, STATUS, "\t")
    return rows.withColumn("exit_code", F.col("exit_code").cast("int"))


SAFE_NAME = r"^[A-Za-z0-9][A-Za-z0-9._-]*$"
EPISODE_NAME = r"^episode_\d+$"


def discover_collection(inventory: DataFrame, excluded=()) -> tuple[DataFrame, DataFrame]:
    """``(datasets, violations)`` of a collection, from its file paths."""
    parts = F.split("path", "/")
    rows = inventory.select(
        "path",
        F.when(F.size(parts) > 1, F.get(parts, F.lit(0))).alias("dataset"),
        F.when(F.size(parts) > 2, F.get(parts, F.lit(1))).alias("episode"),
        F.slice(parts, 3, F.greatest(F.size(parts) - 3, F.lit(0))).alias("below"),
    ).where("dataset is not null")
    names = inventory.sparkSession.createDataFrame([(n,) for n in excluded], "dataset string")
    kept = rows.join(names, "dataset", "left_anti")
    # At any depth below an episode, directly below it included.
    nested = F.col("episode").rlike(EPISODE_NAME) & F.exists("below", lambda d: d.rlike(EPISODE_NAME))
    found = kept.groupBy("dataset").agg(
        F.count_if(F.col("episode").rlike(EPISODE_NAME)).alias("files"),
        F.count_if(~F.col("episode").rlike(EPISODE_NAME)).alias("wrapped"),
        F.count_if(nested).alias("nested"),
        F.count_distinct(F.when(F.col("episode").rlike(EPISODE_NAME), F.col("episode"))).alias("episodes"),
    )
    every = rows.select("dataset").distinct()
    bad = all_of(
        violations(names.join(every, "dataset", "left_anti"), "excluded dataset is absent", F.col("dataset"), F.lit(None)),
        violations(found.where(F.col("dataset").rlike(EPISODE_NAME)), "direct episode", F.col("dataset"), F.lit(None)),
        violations(found.where(~F.col("dataset").rlike(SAFE_NAME)), "unsafe name", F.col("dataset"), F.lit(None)),
        violations(found.where("wrapped > 0"), "nested wrapper", F.col("dataset"), F.col("wrapped")),
        violations(found.where("nested > 0"), "nested episode", F.col("dataset"), F.col("nested")),
        violations(found.where("files = 0"), "no episodes", F.col("dataset"), F.lit(None)),
    )
    return found.select("dataset", "episodes"), bad


def file_hashes(spark, root, pattern: str | None = None) -> DataFrame:
    """Relative path, size and content hash of every file; hashed where it is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(root).select(
        relative(F.col("path"), root).alias("path"),
        F.col("length").alias("size"),
        F.sha2("content", 256).alias("sha256"),
    )


def tree_digest(files: DataFrame, with_content: bool = True) -> DataFrame:
    """sha256 over ordered ``path NUL size NUL digest`` of all files.

    The hash is sequential by definition. One task streams the sorted file list (a
    path and a digest per file, never contents) through it in constant memory.
    """
    columns = ["path", "size", *(["sha256"] if with_content else [])]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, count, size = hashlib.sha256(), 0, 0
        for batch in batches:
            for row in batch.itertuples(index=False):
                total.update(row.path.encode() + b"\0" + str(row.size).encode() + b"\0")
                if with_content:
                    total.update(bytes.fromhex(row.sha256))
                count, size = count + 1, size + int(row.size)
        yield pd.DataFrame([(count, size, total.hexdigest())], columns=["file_count", "total_bytes", "tree_sha256"])

    ordered = files.select(*columns).repartition(1).sortWithinPartitions("path")
    return ordered.mapInPandas(run, "file_count long, total_bytes long, tree_sha256 string")


def inventory_digest(files: DataFrame) -> DataFrame:
    """The digest over paths and sizes only."""
    return tree_digest(files, with_content=False)
