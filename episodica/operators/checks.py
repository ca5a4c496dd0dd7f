"""Data-contract checks (V2-V8, V12, V13, W13-W16, J3, J7, J9, J10, A28); V1 and W12 are in ``dataset_checks``.

Each returns a violation table ``(check, key, detail)``, empty when the data passes.
"""

from __future__ import annotations

import json
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episodica.contract import EPISODE, SPLITS, is_finite
from episodica.functions.labels import name_number, normalize_split
from episodica.operators.merge import set_difference
from episodica.operators.ordered import index_block, neighbours, previous_row, row_numbers
from episodica.operators.splits import target_sizes
from episodica.shared import checkpointed


def violations(df: DataFrame, check: str, key, detail) -> DataFrame:
    def text(c) -> Column:
        return (F.lit(c) if not isinstance(c, Column) else c).cast("string")

    return df.select(F.lit(check).alias("check"), text(key).alias("key"), text(detail).alias("detail"))


def key_of(*names: str) -> Column:
    return F.concat_ws("/", *[F.col(n).cast("string") for n in names])


def all_of(*tables: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), tables)


def assert_empty(table: DataFrame) -> None:
    """Raise with the first violations, if any."""
    found = table.limit(5).collect()
    if found:
        raise ValueError("; ".join("/".join(str(v) for v in row) for row in found))


CHUNK = ["chunk_index", "start_frame", "frame_count"]
SHAPE = ["height", "width", "channels"]


def check_chunk_index(chunks: DataFrame, lengths: DataFrame, chunk_frames: int = 32, by=EPISODE) -> DataFrame:
    """Chunk numbers and starts are contiguous, sizes and hashes are sound, and
    the frames add up to the episode's ``length``.

    A chunk is compared with the one before it, so a fault is told where the chain breaks.
    Columns ``filename`` and ``lossless_round_trip_verified`` are checked where they exist.
    """
    by = list(by)
    extra = [c for c in ("filename", "lossless_round_trip_verified") if c in chunks.columns]
    rows = chunks.select(*by, *CHUNK, *SHAPE, "uncompressed_bytes", "compressed_sha256", *extra)
    rows = neighbours(rows, by, ["chunk_index"], index_block("chunk_index"), CHUNK)
    number = F.coalesce(F.col("previous_chunk_index") + 1, F.lit(0))
    start = F.coalesce(F.col("previous_start_frame") + F.col("previous_frame_count"), F.lit(0))
    bytes_ = F.col("frame_count") * F.col("height") * F.col("width") * F.col("channels")
    detail = (
        F.when(F.col("chunk_index") != number, "chunk_index")
        .when(F.col("start_frame") != start, "start_frame")
        .when(~F.col("frame_count").between(1, chunk_frames), "frame_count")
        .when(F.col("uncompressed_bytes") != bytes_, "uncompressed_bytes")
        .when(~F.coalesce(F.col("compressed_sha256").rlike("^[0-9a-f]{64}$"), F.lit(False)), "sha256")
    )
    if "filename" in extra:
        detail = detail.when(~F.coalesce(F.col("filename").rlike("^[^/]+$"), F.lit(False)), "filename")
    if "lossless_round_trip_verified" in extra:
        detail = detail.when(~F.coalesce("lossless_round_trip_verified", F.lit(False)), "not verified")
    # The rows are read once; their faults and the totals of episodes come from this.
    rows = checkpointed(rows.select(*by, "chunk_index", "frame_count", F.struct(*SHAPE).alias("_shape"), detail.alias("_d")))
    shapes = rows.groupBy(*by).agg(
        F.min("_shape").alias("a"), F.max("_shape").alias("b"), F.sum("frame_count").alias("frames")
    )
    joined = shapes.join(lengths.select(*by, "length"), by, "full_outer")
    off = F.when(~F.col("frames").eqNullSafe(F.col("length")), F.struct(F.lit("chunk frames").alias("check"), F.col("frames").cast("string").alias("detail")))
    apart = F.when(F.col("a") != F.col("b"), F.struct(F.lit("chunk shape").alias("check"), F.lit("shape differs").alias("detail")))
    episodes = joined.select(key_of(*by).alias("key"), F.explode(F.array_compact(F.array(off, apart))).alias("_f"))
    return all_of(
        violations(rows.where(F.col("_d").isNotNull()), "chunk", key_of(*by, "chunk_index"), F.col("_d")),
        episodes.select("_f.check", "key", "_f.detail"),
    )


def check_timestamps(frames: DataFrame, by=EPISODE, order="frame_index", time="timestamp_s", position: str | None = "idx"):
    """Timestamps are finite and never fall; ``idx`` equals the position."""
    block = index_block(order)
    rows = previous_row(frames, by, [order], [time], block)
    fault = F.when(F.col(time).isNull() | ~is_finite(F.col(time)), "not finite").when(
        F.col(time) < F.col(f"previous_{time}"), "falls"
    )
    if position:
        fault = fault.when(~F.col(position).eqNullSafe(F.col(order)), "idx")
    rows = rows.withColumn("_d", fault).where(F.col("_d").isNotNull())
    return violations(rows, "timestamp", key_of(*by, order), F.col("_d"))


def check_component_order(records: DataFrame, components: list[str], split="split", order="split_number", component="source_dataset"):
    """In every split component ranks never fall, and all components occur.

    Ranks never fall exactly when each component's last number is below the first
    number of the next one, so a small summary per (split, component) suffices.
    """
    rank = F.array_position(F.array(*[F.lit(c) for c in components]), F.col(component))
    spans = records.groupBy(split, component).agg(F.min(order).alias("low"), F.max(order).alias("high"))
    spans = spans.withColumn("rank", rank)
    before = F.lag("high").over(Window.partitionBy(split).orderBy("rank"))
    known = spans.where("rank > 0").withColumn("before", before)
    present = known.groupBy(split).agg(F.count(F.lit(1)).alias("n"))
    return all_of(
        violations(spans.where("rank = 0"), "unknown component", key_of(split, component), F.col("low")),
        violations(
            known.where(F.col("before") >= F.col("low")), "component order",
            key_of(split, component), F.col("low"),
        ),
        violations(
            present.where(F.col("n") < len(components)), "component missing", F.col(split), F.col("n")
        ),
    )


def check_preserved_order(records: DataFrame, manifest: DataFrame, by="split", key="source_episode", order="split_number", old_order="manifest_order", block=None, old_block=None):
    """Order within a split equals the manifest's; no repeated manifest order."""
    now = row_numbers(records, [by], [order], block if block is not None else index_block(order), "_now")
    old = manifest.select(by, key, old_order)
    old = row_numbers(
        old, [by], [old_order, key], old_block if old_block is not None else index_block(old_order), "_old"
    )
    moved = now.select(by, key, "_now").join(old.select(by, key, "_old"), [by, key])
    repeats = manifest.groupBy(by, old_order).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return all_of(
        violations(moved.where("_now <> _old"), "order", key_of(by, key), F.col("_now")),
        violations(repeats, "order repeated", key_of(by, old_order), F.col("n")),
    )


def episode_coverage(episodes: DataFrame, records: DataFrame, keys=EPISODE) -> DataFrame:
    """Episodes without a record, and records without an episode."""
    keys = list(keys)
    left = episodes.select(*keys).distinct().withColumn("_e", F.lit(True))
    right = records.select(*keys).distinct().withColumn("_r", F.lit(True))
    both = left.join(right, keys, "full_outer").where("_e is null or _r is null")
    return violations(
        both, "coverage", key_of(*keys), F.when(F.col("_r").isNull(), "no record").otherwise("no episode")
    )


def missing_media(references: DataFrame, inventory: DataFrame, path="path", key=("episode_index",)) -> DataFrame:
    """Referenced files that are absent or without a path."""
    files = inventory.select(F.col("path").alias(path))
    lost = references.where(F.col(path).isNotNull()).join(files, path, "left_anti")
    unnamed = references.where(F.col(path).isNull())
    return all_of(
        violations(lost, "missing file", key_of(*key), F.col(path)),
        violations(unnamed, "no reference", key_of(*key), F.lit(None)),
    )


def inventory_diff(before: DataFrame, after: DataFrame, key="path", values=("size",)) -> DataFrame:
    """Members missing, added or changed between two snapshots."""
    old = before.select(key, F.struct(*values).alias("_old"))
    new = after.select(key, F.struct(*values).alias("_new"))
    both = old.join(new, key, "full_outer")
    state = (
        F.when(F.col("_new").isNull(), "missing")
        .when(F.col("_old").isNull(), "added")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "changed")
    )
    return both.select(key, state.alias("state")).where("state is not null")


def split_leakage(provenance: DataFrame, digest="data_json_sha256", split="split") -> DataFrame:
    """Content found in train and a held-out split, or in two held-out splits.

    One row per hash and pair kind; records are first reduced to (hash, split).
    """
    owners = provenance.where(F.col(digest).isNotNull()).groupBy(digest, split).agg(
        F.count(F.lit(1)).alias("_n")
    )
    found = owners.groupBy(digest).agg(
        F.max(F.col(split) == "train").alias("in_train"),
        F.sum(F.when(F.col(split) != "train", F.col("_n")).otherwise(0)).alias("held_out"),
        F.count_if(F.col(split) != "train").alias("held_out_splits"),
    )
    kinds = F.array_compact(
        F.array(
            F.when(F.col("in_train") & (F.col("held_out_splits") > 0), F.lit("train and held-out")),
            F.when(F.col("held_out") > 1, F.lit("held-out twice")),
        )
    )
    return found.select(digest, F.explode(kinds).alias("leak"))


def duplicate_content(records: DataFrame, columns=("data_json_sha256", "capture_start_utc"), owner="source_identity") -> DataFrame:
    """Values owned by more than one episode, with every owner as a row.

    Owners are joined back rather than collected: a value may have very many.
    """
    parts = [
        records.where(F.col(c).isNotNull()).select(
            F.lit(c).alias("kind"), F.col(c).alias("value"), F.col(owner).alias("owner")
        )
        for c in columns
    ]
    rows = all_of(*parts)
    many = rows.groupBy("kind", "value").agg(
        F.count(F.lit(1)).alias("owners"), F.min("owner").alias("first_owner")
    )
    return rows.join(many.where("owners > 1"), ["kind", "value"])


def validate_tasks(tasks: DataFrame, by=("dataset",)) -> DataFrame:
    """V2: indices contiguous from 0, text present and unique."""
    by = list(by)
    span = tasks.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.min("task_index").alias("low"), F.max("task_index").alias("high")
    )
    twice = tasks.groupBy(*by, "task_index").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    texts = tasks.where("task is not null").groupBy(*by, "task").agg(F.count(F.lit(1)).alias("n"))
    return all_of(
        violations(
            span.where((F.col("low") != 0) | (F.col("high") != F.col("n") - 1)),
            "task indices", key_of(*by), F.format_string("%d in %d..%d", "n", "low", "high"),
        ),
        violations(twice, "task index repeated", key_of(*by, "task_index"), F.col("n")),
        violations(tasks.where("task is null"), "task text", key_of(*by, "task_index"), "missing"),
        violations(texts.where("n > 1"), "task text repeated", key_of(*by, "task"), F.col("n")),
    )


PARTS = ("left_arm", "right_arm", "left_ee", "right_ee")


def audit_raw_source(
    frames: DataFrame, episodes: DataFrame, inventory: DataFrame | None, goal: str, width: int = 7,
    members: DataFrame | None = None, totals: tuple[int, int] | None = None,
):
    """V3: membership, totals, goal, non-empty frames, W14, finite vectors of the exact width, media.

    ``frames`` are exploded raw frames ``(episode, position, idx, timestamp_s, states,
    actions, media)``; ``states`` and ``actions`` are structs of the four parts.
    ``members`` (``episode``) are the expected episodes, ``totals`` the expected number of
    episodes and frames. The rules of a frame are an array, exploded once.
    """
    keys = [
        F.when(~F.col("goal").eqNullSafe(F.lit(goal)), F.struct(F.lit("goal").alias("check"), F.col("goal").cast("string").alias("detail"))),
        F.when(F.coalesce("frame_count", F.lit(0)) == 0, F.struct(F.lit("no frames").alias("check"), F.lit(None).cast("string").alias("detail"))),
    ]
    of_episodes = episodes.select(F.col("episode").alias("key"), F.explode(F.array_compact(F.array(*keys))).alias("_f"))
    out = [of_episodes.select("_f.check", "key", "_f.detail"), check_timestamps(frames, ("episode",), "position")]
    wrong = []
    for section in ("states", "actions"):
        for part in PARTS:
            values = F.col(f"{section}.{part}.qpos")
            sound = (F.size(values) == width) & F.forall(values, is_finite)
            told = F.struct(F.lit(f"{section}.{part}").alias("check"), F.size(values).cast("string").alias("detail"))
            wrong.append(F.when(~F.coalesce(sound, F.lit(False)), told))
    of_frames = frames.select(key_of("episode", "position").alias("key"), F.explode(F.array_compact(F.array(*wrong))).alias("_f"))
    out.append(of_frames.select("_f.check", "key", "_f.detail"))
    if members is not None:
        both = set_difference(members.select("episode"), episodes.select("episode"))
        out.append(violations(both, "membership", F.col("episode"), F.col("side")))
    if totals is not None:
        found = episodes.agg(F.count(F.lit(1)).alias("episodes"), F.coalesce(F.sum("frame_count"), F.lit(0)).alias("frames"))
        apart = [
            F.when(F.col(n) != want, F.struct(F.lit(f"total {n}").alias("check"), F.lit(None).cast("string").alias("key"), F.col(n).cast("string").alias("detail")))
            for n, want in zip(("episodes", "frames"), totals, strict=True)
        ]
        out.append(found.select(F.explode(F.array_compact(F.array(*apart))).alias("_f")).select("_f.*"))
    if inventory is not None:
        files = frames.select("episode", "position", F.explode("media").alias("file"))
        named = files.withColumn("file", F.concat_ws("/", "episode", "file"))
        out.append(missing_media(named, inventory, "file", ("episode", "position")))
    return all_of(*out)


def validate_source(records: DataFrame, expected: DataFrame, goals: DataFrame, by=("source_dataset",)):
    """V4: totals and goals of each source equal the expected ones; hashes are unique."""
    by = list(by)
    actual = records.groupBy(*by).agg(
        F.count(F.lit(1)).alias("episodes"), F.sum("frame_count").cast("long").alias("frames")
    )
    sizes = set_difference(
        expected.select(*by, "episodes", "frames"), actual.select(*by, "episodes", "frames")
    )
    found = records.select(*by, "goal").distinct()
    kinds = set_difference(goals.select(*by, "goal"), found)
    twice = records.groupBy("data_json_sha256").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return all_of(
        violations(sizes, "totals", key_of(*by), F.concat_ws(" ", "side", "episodes", "frames")),
        violations(kinds, "goals", key_of(*by), F.concat_ws(" ", "side", "goal")),
        violations(twice, "duplicate hash", F.col("data_json_sha256"), F.col("n")),
    )


def validate_split_manifest(records: DataFrame, components: DataFrame | None = None) -> DataFrame:
    """V5: names, hashes, frame counts, uniqueness, T1 totals and component sums."""
    number = name_number(F.col("split_episode"))
    detail = (
        F.when(normalize_split(F.col("split")).isNull(), "split")
        .when(number.isNull(), "split_episode")
        .when(~F.coalesce(F.col("data_json_sha256").rlike("^[0-9a-f]{64}$"), F.lit(False)), "hash")
        .when(~F.coalesce(F.col("frame_count") > 0, F.lit(False)), "frame_count")
    )
    bad = records.withColumn("_d", detail).where(F.col("_d").isNotNull())

    def twice(*names: str) -> DataFrame:
        many = records.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        return violations(many, "repeated " + "/".join(names), key_of(*names), F.col("n"))

    counts = records.groupBy("source_dataset").agg(
        *[F.count_if(F.col("split") == s).alias(s) for s in SPLITS], F.count(F.lit(1)).alias("n")
    )
    out = [
        violations(bad, "record", key_of("split", "split_episode"), F.col("_d")),
        twice("split", "split_episode"),
        twice("data_json_sha256"),
        twice("source_dataset", "source_episode"),
    ]
    large = counts.where("n >= 3")
    wanted = target_sizes(F.col("n"))
    off = reduce(lambda a, b: a | b, [F.col(s) != wanted[s] for s in SPLITS])
    out.append(violations(large.where(off), "split sizes", F.col("source_dataset"), F.col("n")))
    if components is not None:
        both = counts.join(
            components.select("source_dataset", *[F.col(s).alias(f"_{s}") for s in SPLITS]),
            "source_dataset", "full_outer",
        )
        differ = reduce(
            lambda a, b: a | b, [~F.col(s).eqNullSafe(F.col(f"_{s}")) for s in SPLITS]
        )
        out.append(violations(both.where(differ), "component sums", F.col("source_dataset"), F.col("n")))
    return all_of(*out)


def manifest_matches(records: DataFrame, converted: DataFrame, keys=("split", "split_episode")) -> DataFrame:
    """V5: manifest and converted episodes agree on length and goal."""
    keys = list(keys)
    both = records.select(*keys, "frame_count", "goal").join(
        converted.select(*keys, "length", F.col("goal").alias("_goal")), keys, "full_outer"
    )
    detail = F.when(~F.col("frame_count").eqNullSafe(F.col("length")), "length").when(
        ~F.col("goal").eqNullSafe(F.col("_goal")), "goal"
    )
    both = both.withColumn("_d", detail).where(F.col("_d").isNotNull())
    return violations(both, "manifest", key_of(*keys), F.col("_d"))


def reconcile_manifest(
    manifest: DataFrame, raw: DataFrame, converted: DataFrame, infos: DataFrame | None = None, keys=("split", "split_episode")
) -> DataFrame:
    """V5: manifest, raw and converted episodes agree, in one pass over the three.

    All have ``keys, frame_count, goal`` (``length`` in ``converted``, which also has
    ``episode_index``); manifest and raw have ``data_json_sha256``. An episode must occur
    once on every side with equal frames and goal, raw bytes must have the recorded hash,
    names must be numbered from 1 and converted indices must follow the names. ``infos``
    (``split, total_frames``) must add up.
    """
    keys = list(keys)
    sides = {
        "manifest": manifest.select(*keys, "frame_count", "goal", "data_json_sha256"),
        "raw": raw.select(*keys, "frame_count", "goal", "data_json_sha256"),
        "converted": converted.select(*keys, F.col("length").alias("frame_count"), "goal", F.col("episode_index").cast("long").alias("_index")),
    }
    rows = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [df.withColumn("_side", F.lit(name)) for name, df in sides.items()],
    )

    def of(name: str, column: str, what=F.max) -> Column:
        return what(F.when(F.col("_side") == name, F.col(column))).alias(f"{name}_{column.lstrip('_')}")

    met = rows.groupBy(*keys).agg(
        *[F.count_if(F.col("_side") == n).alias(f"{n}_rows") for n in sides],
        *[of(n, c) for n in sides for c in ("frame_count", "goal")],
        *[of(n, "data_json_sha256") for n in ("manifest", "raw")],
        of("converted", "_index"),
    )
    met = checkpointed(met.withColumn("_number", name_number(F.col(keys[-1]))))
    key = key_of(*keys)

    def fault(test: Column, check: str, detail: Column) -> Column:
        row = F.struct(F.lit(check).alias("check"), key.alias("key"), detail.cast("string").alias("detail"))
        return F.when(test, row)

    present = {n: F.col(f"{n}_rows") > 0 for n in sides}
    faults = [fault(~p, "missing", F.lit(n)) for n, p in present.items()]
    faults += [fault(F.col(f"{n}_rows") > 1, "repeated", F.lit(n)) for n in sides]
    for n in ("raw", "converted"):
        both = present["manifest"] & present[n]
        for column in ("frame_count", "goal"):
            apart = ~F.col(f"manifest_{column}").eqNullSafe(F.col(f"{n}_{column}"))
            faults.append(fault(both & apart, f"{n} {column}", F.col(f"{n}_{column}")))
    changed = ~F.col("manifest_data_json_sha256").eqNullSafe(F.col("raw_data_json_sha256"))
    faults.append(fault(present["manifest"] & present["raw"] & changed, "raw hash", F.col("raw_data_json_sha256")))
    faults.append(fault(present["manifest"] & F.col("_number").isNull(), "name", F.col(keys[-1])))
    # Converted episodes follow the order of names, so the index is the number less one.
    moved = present["manifest"] & present["converted"] & (F.col("converted_index") != F.col("_number") - 1)
    faults.append(fault(moved, "converted index", F.col("converted_index")))
    out = met.select(F.explode(F.array_compact(F.array(*faults))).alias("_f")).select("_f.*")

    by = keys[:-1]
    totals = met.groupBy(*by).agg(
        F.min("_number").alias("low"), F.max("_number").alias("high"),
        F.count(F.when(present["manifest"], 1)).alias("n"),
        F.sum("converted_frame_count").alias("frames"),
    )
    tables = [out, violations(totals.where("low <> 1 OR high <> n"), "names not contiguous", key_of(*by), F.format_string("%d in %d..%d", "n", "low", "high"))]
    if infos is not None:
        sums = infos.select(*by, "total_frames").join(totals, by, "full_outer").where(~F.col("total_frames").eqNullSafe(F.col("frames")))
        tables.append(violations(sums, "total_frames", key_of(*by), F.col("frames")))
    return all_of(*tables)


def table_fingerprint(df: DataFrame, by, columns=None) -> DataFrame:
    """V6: ``by, rows, fingerprint`` of a multiset of rows: equal for equal rows in any order.

    Rows are hashed twice and the hashes added up as decimals, so repeated rows count and
    partial sums combine before the shuffle; what is moved is one row per key and task.
    """
    by = list(by)
    columns = [c for c in df.columns if c not in by] if columns is None else list(columns)
    # Nulls change no hash, so that a row also says which of its columns are null.
    marks = [F.col(c).isNull() for c in columns]
    sums = [
        F.sum(F.xxhash64(F.lit(seed), *[F.col(c) for c in columns], *marks).cast("decimal(20,0)")).cast("string")
        for seed in (1, 2)
    ]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.concat_ws(":", *sums).alias("fingerprint"))


def unchanged(before: DataFrame, after: DataFrame, by, columns=None, check: str = "held-out statistics") -> DataFrame:
    """V6: keys whose rows differ between two tables, such as held-out statistics after an append.

    ``before`` may be a table of fingerprints kept from an earlier run.
    """
    by = list(by)
    old = before if "fingerprint" in before.columns and columns is None else table_fingerprint(before, by, columns)
    new = table_fingerprint(after, by, columns)
    both = old.select(*by, F.struct("rows", "fingerprint").alias("_old")).join(
        new.select(*by, F.struct("rows", "fingerprint").alias("_new")), by, "full_outer"
    )
    detail = (
        F.when(F.col("_new").isNull(), "missing").when(F.col("_old").isNull(), "unexpected")
        .when(F.col("_old") != F.col("_new"), "changed")
    )
    both = both.withColumn("_d", detail).where(F.col("_d").isNotNull())
    return violations(both, check, key_of(*by), F.col("_d"))


def validate_stats(
    stats: DataFrame, expected: DataFrame | None = None, keys=("feature", "dim"),
    held_out: tuple[DataFrame, DataFrame] | None = None, held_out_by=("split",),
) -> DataFrame:
    """V6: finite numbers, std >= 0, min <= q01 <= q99 <= max, current fingerprints.

    ``expected``: ``feature, width, fingerprint``; the set of features and their widths
    must match exactly. ``held_out`` has the statistics of the other splits before and
    after; they must be untouched.
    """
    names = ["mean", "std", "min", "max", "q01", "q99"]
    finite = reduce(lambda a, b: a & b, [F.coalesce(is_finite(F.col(n)), F.lit(False)) for n in names])
    detail = (
        F.when(~finite, "not finite")
        .when(F.col("std") < 0, "negative std")
        .when(
            (F.col("min") > F.col("q01")) | (F.col("q01") > F.col("q99")) | (F.col("q99") > F.col("max")),
            "order of min, q01, q99, max",
        )
    )
    bad = stats.withColumn("_d", detail).where(F.col("_d").isNotNull())
    out = [violations(bad, "statistics", key_of(*keys), F.col("_d"))]
    if expected is not None:
        found = stats.groupBy("feature").agg(
            F.count(F.lit(1)).alias("n"), F.max("fingerprint").alias("fingerprint")
        )
        want = expected.select("feature", "width", F.col("fingerprint").alias("_f"))
        both = found.join(want, "feature", "full_outer")
        stale = (
            F.when(F.col("n").isNull(), "missing")
            .when(F.col("width").isNull(), "unexpected")
            .when(F.col("n") != F.col("width"), "shape")
            .when(~F.col("fingerprint").eqNullSafe(F.col("_f")), "stale fingerprint")
        )
        both = both.withColumn("_d", stale).where(F.col("_d").isNotNull())
        out.append(violations(both, "feature", F.col("feature"), F.col("_d")))
    if held_out is not None:
        out.append(unchanged(*held_out, held_out_by))
    return all_of(*out)


def schema_fingerprint(feature: Column, dtype: Column, shape: Column) -> Column:
    """Hash of the canonical JSON of one feature's dtype, name and shape."""
    text = F.concat(
        F.lit('{"dtype":'), F.to_json(F.array(dtype)).substr(F.lit(2), F.length(F.to_json(F.array(dtype))) - 2),
        F.lit(',"feature":'), F.to_json(F.array(feature)).substr(F.lit(2), F.length(F.to_json(F.array(feature))) - 2),
        F.lit(',"shape":'), F.to_json(shape), F.lit("}"),
    )
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


@F.pandas_udf(T.StringType())
def canonical_json(texts: pd.Series) -> pd.Series:
    """JSON text with sorted keys and no spaces; null when it is not finite JSON."""

    def refuse(name: str):
        raise ValueError(name)

    def canonical(text):
        if text is None:
            return None
        try:
            value = json.loads(text, parse_constant=refuse)
        except ValueError:
            return None
        return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))

    return texts.map(canonical)


def calibration_fingerprint(payload: Column) -> Column:
    """V7: fingerprint of a calibration, given as JSON text without its fingerprint."""
    return F.concat(F.lit("sha256:"), F.sha2(canonical_json(payload), 256))


def validate_calibration(infos: DataFrame, by=("dataset",)) -> DataFrame:
    """V7: over ``(dataset, split, calibration, fingerprint, compact_fingerprint)``.

    ``calibration`` is JSON text without its fingerprint, null when untagged. Checks
    the fingerprint, that full and compact forms agree, and one calibration for all
    splits, with tagged and untagged splits not mixed.
    """
    by = list(by)
    tagged = infos.where(F.col("calibration").isNotNull())
    detail = (
        F.when(~F.coalesce(F.col("fingerprint").rlike("^sha256:[0-9a-f]{64}$"), F.lit(False)), "form")
        .when(F.col("fingerprint") != F.col("_actual"), "does not match its payload")
        .when(
            F.col("compact_fingerprint").isNotNull()
            & (F.col("compact_fingerprint") != F.col("fingerprint")),
            "full and compact differ",
        )
    )
    bad = tagged.withColumn("_actual", calibration_fingerprint(F.col("calibration")))
    bad = bad.withColumn("_d", detail).where(F.col("_d").isNotNull())
    orphan = infos.where("calibration is null and compact_fingerprint is not null")
    groups = infos.groupBy(*by).agg(
        F.min("fingerprint").alias("low"),
        F.max("fingerprint").alias("high"),
        F.count("calibration").alias("tagged"),
        F.count(F.lit(1)).alias("n"),
    )
    return all_of(
        violations(bad, "calibration", key_of(*by, "split"), F.col("_d")),
        violations(orphan, "compact without full", key_of(*by, "split"), F.col("compact_fingerprint")),
        violations(groups.where("low <> high"), "several calibrations", key_of(*by), F.col("high")),
        violations(
            groups.where("tagged > 0 and tagged < n"), "tagged and untagged", key_of(*by), F.col("tagged")
        ),
    )


def validate_population(episodes: DataFrame, expected: DataFrame, keys=("part", "split")) -> DataFrame:
    """V8: (episodes, frames) per split equal the expected ones, for base and component;
    the final part must equal base plus component."""
    keys = list(keys)
    actual = episodes.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("episodes"), F.sum("length").cast("long").alias("frames")
    )
    want = expected.select(*keys, F.col("episodes").alias("_e"), F.col("frames").alias("_f"))
    both = actual.join(want, keys, "full_outer")
    same = F.col("episodes").eqNullSafe(F.col("_e")) & F.col("frames").eqNullSafe(F.col("_f"))
    sums = actual.groupBy("split").agg(
        *[
            F.sum(F.when(F.col("part") == "final", F.col(c)).otherwise(-F.col(c))).alias(c)
            for c in ("episodes", "frames")
        ],
        F.count_if(F.col("part") == "final").alias("finals"),
    )
    off = sums.where("finals > 0 and (episodes <> 0 or frames <> 0)")
    return all_of(
        violations(both.where(~same), "population", key_of(*keys), F.concat_ws("/", "episodes", "frames")),
        violations(off, "final is not base plus component", F.col("split"), F.concat_ws("/", "episodes", "frames")),
    )


def required_features(features: DataFrame, required: list[str], by=("dataset", "split")) -> DataFrame:
    """Required features absent from a dataset split; robot types that differ."""
    by = list(by)
    present = features.groupBy(*by).agg(
        *[F.max((F.col("feature") == f).cast("int")).alias(f"_has{i}") for i, f in enumerate(required)],
        F.min("robot_type").alias("low"), F.max("robot_type").alias("high"),
    )
    lacking = F.array_compact(
        F.array(*[F.when(F.col(f"_has{i}") == 0, F.lit(f)) for i, f in enumerate(required)])
    )
    lost = present.withColumn("_d", F.explode(lacking))
    kinds = present.groupBy(by[0]).agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return all_of(
        violations(lost, "feature", key_of(*by), F.col("_d")),
        violations(kinds.where("low <> high"), "robot type", F.col(by[0]), F.concat_ws(",", "low", "high")),
    )
