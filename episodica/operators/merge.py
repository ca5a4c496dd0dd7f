"""Merging datasets and checking the merge."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.functions.labels import numbered_name
from episodica.operators.numbering import renumber_episodes, renumber_frames
from episodica.operators.ordered import index_block, row_numbers, running_maxima
from episodica.shared import sized


def merged_tasks(tasks: DataFrame, by=(), source="source_rank") -> DataFrame:
    """One index per task text, in order of first appearance over the sources.

    ``tasks``: ``source_rank, task_index, task``; the destination has rank 0 and
    keeps its indices.
    """
    by = list(by)
    first = tasks.groupBy(*by, "task").agg(F.min(F.struct(source, "task_index")).alias("_at"))
    first = first.select(*by, "task", f"_at.{source}", "_at.task_index")
    numbered = row_numbers(
        first, by, [source, "task_index"], [F.col(source), index_block("task_index")], "new_task_index", 0
    )
    return numbered.select(*by, F.col("new_task_index").alias("task_index"), "task")


def task_map(tasks: DataFrame, merged: DataFrame, by=(), source="source_rank") -> DataFrame:
    """Old index of each source to the merged index."""
    new = merged.select(*by, "task", F.col("task_index").alias("new_task_index"))
    return tasks.join(new, [*by, "task"]).select(*by, source, "task_index", "new_task_index")


def remap_tasks(frames: DataFrame, mapping: DataFrame, by=(), source="source_rank") -> DataFrame:
    """Frames with merged task indices; a frame without one fails the task."""
    out = frames.join(sized(mapping), [*by, source, "task_index"], "left")
    found = F.when(F.col("new_task_index").isNotNull(), F.col("new_task_index")).otherwise(
        F.raise_error(F.lit("frame refers to a missing task_index")).cast("long")
    )
    return out.withColumn("task_index", found).drop("new_task_index")


def missing_tasks(frames: DataFrame, tasks: DataFrame, keys=("dataset", "task_index")) -> DataFrame:
    """Task indices used by frames and absent from the task table, with their frames.

    Frames are counted per task before the join.
    """
    used = frames.groupBy(*keys).agg(F.count(F.lit(1)).alias("frames"))
    return used.join(tasks.select(*keys), list(keys), "left_anti")


def append_datasets(frames: DataFrame, episodes: DataFrame, tasks: DataFrame, by=()):
    """Destination then sources. Returns merged ``(frames, episodes, tasks)``.

    All inputs carry ``source_rank`` (0 is the destination). Episodes are renumbered,
    global indices rebuilt and tasks remapped; statistics (A4, A5) and totals (A7)
    follow from the results.
    """
    by = list(by)
    merged = merged_tasks(tasks, by)
    numbered = renumber_episodes(episodes, by)
    keys = [*by, "source_rank", "episode_index"]
    out = renumber_frames(remap_tasks(frames, task_map(tasks, merged, by), by), numbered, keys)
    new_episodes = numbered.withColumn("source_episode_index", F.col("episode_index"))
    new_episodes = new_episodes.withColumn("episode_index", F.col("new_episode_index"))
    if "tasks" in episodes.columns:
        new_episodes = new_episodes.withColumn("tasks", F.array_distinct("tasks"))
    return out, new_episodes.drop("new_episode_index"), merged


def append_split_roots(frames, episodes, tasks):
    """U1 split by split in one pass; a split missing in a source adds nothing."""
    return append_datasets(frames, episodes, tasks, by=("split",))


def fold_train_validation(frames, episodes, tasks, validation: str = "validation"):
    """All train, then all validation episodes as one training set."""
    rank = F.when(F.col("split") == validation, 1).otherwise(0)

    def ranked(df: DataFrame) -> DataFrame:
        held = df.where(F.col("split").isin("train", validation))
        return held.withColumn("source_rank", rank).drop("split")

    return append_datasets(ranked(frames), ranked(episodes), ranked(tasks))


def combined_view(frames, episodes, tasks, name: str | None = None):
    """Logical union of datasets, split by split, one index per task text.

    A source listed twice fails. Nothing is written; ``name`` registers temp views.
    """
    repeats = episodes.groupBy("split", "source_rank").agg(F.count_distinct("dataset").alias("n"))
    guarded = episodes.join(repeats, ["split", "source_rank"]).withColumn(
        "source_rank",
        F.when(F.col("n") == 1, F.col("source_rank")).otherwise(
            F.raise_error(F.lit("source listed twice")).cast("int")
        ),
    )
    out = append_split_roots(frames, guarded.drop("n"), tasks)
    if name:
        for part, df in zip(("frames", "episodes", "tasks"), out, strict=True):
            df.createOrReplaceTempView(f"{name}_{part}")
    return out


def share_tasks(frames: DataFrame, tasks: DataFrame, split_rank: Column, key="split"):
    """One task table for all splits, and frames with its indices."""
    ranked = tasks.withColumn("source_rank", split_rank)
    merged = merged_tasks(ranked)
    return remap_tasks(frames.withColumn("source_rank", split_rank), task_map(ranked, merged)), merged


def subset_episodes(frames: DataFrame, chosen: DataFrame, keys=("dataset", "episode_index"), order="position"):
    """Frames of chosen episodes with new indices in requested order, and totals."""
    keys = list(keys)
    kept = frames.join(chosen.select(*keys, order), keys)
    lengths = kept.groupBy(*keys, order).agg(F.count(F.lit(1)).alias("length"))
    numbered = renumber_episodes(lengths.withColumn("_one", F.lit(0)), [], "_one", order)
    numbered = numbered.select(*keys, "new_episode_index", "first_index", "length")
    out = frames.join(numbered.drop("length"), keys).withColumns(
        {"index": F.col("first_index") + F.col("frame_index"), "episode_index": F.col("new_episode_index")}
    )
    totals = numbered.agg(
        F.count(F.lit(1)).alias("total_episodes"), F.sum("length").cast("long").alias("total_frames")
    )
    return out.drop("new_episode_index", "first_index"), totals


def merge_provenance(episodes: DataFrame, provenance: DataFrame, by=("split",)) -> DataFrame:
    """V9: local to final indices and frame ranges for every merged episode.

    ``provenance``: ``split, source_rank, episode_index`` and the carried fields.
    Episodes without a record are kept with nulls.
    """
    keys = [*by, "source_rank", "episode_index"]
    numbered = renumber_episodes(episodes, by)
    out = numbered.join(provenance, keys, "left")
    return out.withColumns(
        {
            "final_episode_index": F.col("new_episode_index"),
            "final_index_start": F.col("first_index"),
            "final_index_end_exclusive": F.col("first_index") + F.col("length"),
            "split_episode": numbered_name(F.col("new_episode_index"), 6),
        }
    ).drop("new_episode_index", "first_index")


def provenance_coverage(
    episodes: DataFrame, records: DataFrame, fingerprints: DataFrame | None = None, by=("split",)
) -> DataFrame:
    """V9: faults ``(check, key, detail)`` of provenance records against the merged episodes.

    ``episodes``: ``by, episode_index, length``. ``records``: ``by, final_episode_index,
    frame_count, final_index_start, final_index_end_exclusive`` and, where ``fingerprints``
    (``by, fingerprint``) is given, ``camera_calibration_fingerprint``. Every episode has
    one record of its length, no record lies outside, and the frame ranges cover the split
    without gap or overlap.

    Episodes and records meet in one aggregation; the ranges are swept in sorted order with
    the furthest end so far carried across blocks, so no task holds a split.
    """
    by = list(by)
    listed = episodes.select(*by, F.col("episode_index").cast("long").alias("episode_index"), F.col("length").cast("long").alias("length"))
    told = records.select(
        *by, F.col("final_episode_index").cast("long").alias("episode_index"), F.col("frame_count").cast("long").alias("frame_count"),
        F.lit(1).cast("long").alias("_record"),
    )
    met = listed.unionByName(told, allowMissingColumns=True).groupBy(*by, "episode_index").agg(
        F.max("length").alias("length"), F.sum("_record").alias("n"),
        F.min("frame_count").alias("low"), F.max("frame_count").alias("high"),
    )
    known, n = F.col("length").isNotNull(), F.coalesce("n", F.lit(0))
    place = F.concat_ws("/", *[F.col(c).cast("string") for c in [*by, "episode_index"]])

    def fault(test: Column, check: str, key: Column, detail: Column) -> Column:
        return F.when(test, F.struct(F.lit(check).alias("check"), key.alias("key"), detail.cast("string").alias("detail")))

    of_episodes = [
        fault(known & (n == 0), "no record", place, F.col("length")),
        fault(~known, "out of range", place, n),
        fault(n > 1, "repeated index", place, n),
        fault(known & (n > 0) & ((F.col("low") != F.col("length")) | (F.col("high") != F.col("length")) | F.col("low").isNull()), "length", place, F.col("high")),
    ]
    out = [met.select(F.explode(F.array_compact(F.array(*of_episodes))).alias("_f")).select("_f.*")]
    ranges = records.select(*by, F.col("final_index_start").alias("start"), F.col("final_index_end_exclusive").alias("end"), F.col("final_episode_index").alias("_at"))
    sizes = listed.groupBy(*by).agg(F.sum("length").alias("total"))
    out.append(interval_faults(ranges, sizes, by))
    if fingerprints is not None:
        declared = records.select(*by, "final_episode_index", F.col("camera_calibration_fingerprint").alias("_f")).where("_f IS NOT NULL")
        both = declared.join(sized(fingerprints.select(*by, "fingerprint")), by, "left")
        form = ~F.col("_f").rlike("^sha256:[0-9a-f]{64}$")
        key = F.concat_ws("/", *[F.col(c).cast("string") for c in [*by, "final_episode_index"]])
        detail = F.when(form, "form").when(~F.col("_f").eqNullSafe(F.col("fingerprint")), "differs from info")
        both = both.select(F.lit("calibration").alias("check"), key.alias("key"), detail.alias("detail"))
        out.append(both.where("detail IS NOT NULL"))
    return reduce(lambda a, b: a.unionByName(b), out)


def interval_faults(ranges: DataFrame, totals: DataFrame, by) -> DataFrame:
    """Ranges ``(by, start, end, _at)`` that leave gaps, overlap, are empty or lie outside ``0 .. total``.

    A range is compared with the furthest end of all that begin before it.
    """
    by = list(by)
    bad = F.col("start").isNull() | F.col("end").isNull() | (F.col("end") <= F.col("start")) | (F.col("start") < 0)
    sound = ranges.where(~bad)
    swept = running_maxima(sound, by, ["start", "end", "_at"], index_block("start"), {"reach": F.col("end")})
    joined = swept.join(sized(totals), by, "left")
    reach = F.coalesce("reach", F.lit(0))
    key = F.concat_ws("/", *[F.col(c).cast("string") for c in [*by, "_at"]])
    spans = [
        F.when(F.col("start") > reach, F.struct(F.lit("gap").alias("check"), F.concat_ws("-", reach.cast("string"), F.col("start").cast("string")).alias("detail"))),
        F.when(F.col("start") < reach, F.struct(F.lit("overlap").alias("check"), F.concat_ws("-", F.col("start").cast("string"), F.least(reach, F.col("end")).cast("string")).alias("detail"))),
        F.when(F.coalesce(F.col("end") > F.col("total"), F.lit(True)), F.struct(F.lit("outside").alias("check"), F.col("end").cast("string").alias("detail"))),
    ]
    found = joined.select(key.alias("key"), F.explode(F.array_compact(F.array(*spans))).alias("_f")).select("_f.check", "key", "_f.detail")
    empty = ranges.where(bad).select(F.lit("empty range").alias("check"), key.alias("key"), F.concat_ws("-", F.col("start").cast("string"), F.col("end").cast("string")).alias("detail"))
    ends = totals.join(sound.groupBy(*by).agg(F.max("end").alias("last")), by, "left")
    last = F.coalesce("last", F.lit(0))
    open_end = ends.where(last < F.col("total")).select(
        F.lit("gap").alias("check"), F.concat_ws("/", *[F.col(c).cast("string") for c in by], F.lit("end")).alias("key"),
        F.concat_ws("-", last.cast("string"), F.col("total").cast("string")).alias("detail"),
    )
    return found.unionByName(empty).unionByName(open_end)


def provenance_faults(provenance: DataFrame, digest="data_json_sha256", fingerprint="camera_calibration_fingerprint"):
    """V9: bad or repeated content hashes, and more than one calibration."""
    known = provenance.where(F.col(digest).isNotNull())
    bad = known.where(~F.col(digest).rlike("^[0-9a-f]{64}$")).select(
        F.lit("invalid hash").alias("check"), F.col(digest).alias("key")
    )
    twice = (
        known.groupBy(digest).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        .select(F.lit("duplicate hash").alias("check"), F.col(digest).alias("key"))
    )
    out = bad.unionByName(twice)
    if fingerprint in provenance.columns:
        many = provenance.agg(
            F.min(fingerprint).alias("low"), F.max(fingerprint).alias("high")
        ).where("low <> high")
        out = out.unionByName(
            many.select(F.lit("calibrations differ").alias("check"), F.col("high").alias("key"))
        )
    return out


def preserve_assignment(episodes: DataFrame, manifest: DataFrame, keys=("source_episode",)) -> DataFrame:
    """Current episodes against an old manifest.

    ``state``: missing, unexpected or kept; for kept ones the old split and order, and
    whether hash or frame count changed.
    """
    old = manifest.select(
        *keys,
        F.col("split").alias("old_split"),
        F.col("split_order").alias("old_order"),
        F.col("data_json_sha256").alias("old_sha256"),
        F.col("frame_count").alias("old_frame_count"),
        F.lit(True).alias("_old"),
    )
    new = episodes.select(*keys, "data_json_sha256", "frame_count", F.lit(True).alias("_new"))
    both = new.join(old, list(keys), "full_outer")
    return both.select(
        *keys,
        F.when(F.col("_old").isNull(), "missing in manifest")
        .when(F.col("_new").isNull(), "unexpected in manifest")
        .otherwise("kept").alias("state"),
        F.col("old_split").alias("split"),
        F.col("old_order").alias("preserved_order"),
        (F.col("_old") & F.col("_new") & ~F.col("data_json_sha256").eqNullSafe(F.col("old_sha256")))
        .alias("hash_changed"),
        (F.col("_old") & F.col("_new") & ~F.col("frame_count").eqNullSafe(F.col("old_frame_count")))
        .alias("frame_count_changed"),
    )


def verify_merge_order(parts: DataFrame, merged: DataFrame, by=("split",)) -> DataFrame:
    """Base then component in order must equal the merged records.

    ``parts``: ``split, source_rank, order, data_json_sha256, frame_count``. Returns
    one row per position that differs in hash, frame count or frame range.
    """
    renamed = parts.withColumnsRenamed({"order": "episode_index", "frame_count": "length"})
    expected = renumber_episodes(renamed, by).select(
        *by,
        F.col("new_episode_index").alias("final_episode_index"),
        F.col("data_json_sha256").alias("expected_sha256"),
        F.col("length").alias("expected_frames"),
        F.col("first_index").alias("expected_start"),
    )
    both = expected.join(merged, [*by, "final_episode_index"], "full_outer")
    fault = (
        F.when(F.col("expected_sha256").isNull(), "unexpected episode")
        .when(F.col("data_json_sha256").isNull(), "missing episode")
        .when(F.col("expected_sha256") != F.col("data_json_sha256"), "hash")
        .when(~F.col("expected_frames").eqNullSafe(F.col("frame_count")), "frame count")
        .when(
            ~F.col("final_index_start").eqNullSafe(F.col("expected_start"))
            | ~F.col("final_index_end_exclusive").eqNullSafe(
                F.col("expected_start") + F.col("expected_frames")
            ),
            "frame range",
        )
    )
    return both.select(*by, "final_episode_index", fault.alias("fault")).where("fault is not null")


def embedded_prefix_check(base: DataFrame, incoming: DataFrame, merged: DataFrame, index="episode_index", by=("split",)):
    """Merged rows must be base rows unchanged, then incoming rows reindexed.

    All frames share their columns. Returns ``side`` (missing or unexpected) rows.
    """
    by = list(by)
    sizes = base.groupBy(*by).agg(F.count(F.lit(1)).alias("_shift"))
    moved = incoming.join(sized(sizes), by, "left") if by else incoming.withColumn("_shift", sizes.scalar())
    moved = moved.withColumn(index, F.col(index) + F.coalesce("_shift", F.lit(0)))
    expected = base.unionByName(moved.select(*base.columns))
    return set_difference(expected, merged.select(*base.columns))


def set_difference(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """U4: members missing from and unexpected in ``actual``; one pass, duplicates count."""
    keys = expected.columns
    marked = expected.withColumn("_w", F.lit(1)).unionByName(
        actual.select(*keys).withColumn("_w", F.lit(-1))
    )
    net = marked.groupBy(*keys).agg(F.sum("_w").alias("_w")).where(F.col("_w") != 0)
    side = F.when(F.col("_w") > 0, "missing").otherwise("unexpected")
    return net.select(side.alias("side"), *keys, F.abs("_w").cast("long").alias("rows"))


def compatible_differences(infos: DataFrame, reference: Column, fields, by=()) -> DataFrame:
    """Fields in which a dataset differs from the reference dataset of its group.

    ``fields`` maps a field to a comparable column (JSON text for nested ones; see
    ``without_key`` for parts that are ignored). The infos of a group meet their one
    reference row.
    """
    by = list(by)
    compared = infos.select(
        *by, "dataset", reference.alias("_reference"), *[c.alias(n) for n, c in fields.items()]
    )
    chosen = compared.where("_reference").select(*by, *[F.col(n).alias(f"_r_{n}") for n in fields])
    joined = compared.join(chosen, by) if by else compared.withColumns(
        {f"_r_{n}": chosen.select(f"_r_{n}").scalar() for n in fields}
    )
    different = F.array_compact(
        F.array(*[F.when(~F.col(n).eqNullSafe(F.col(f"_r_{n}")), F.lit(n)) for n in fields])
    )
    return joined.select(*by, "dataset", F.explode(different).alias("field"))


def completed_runs(status: DataFrame, metrics: DataFrame, key="model") -> DataFrame:
    """Metrics of runs whose evaluation passed."""
    passed = status.where((F.col("stage") == "evaluation") & (F.col("status") == "PASS"))
    return metrics.join(passed.select(key).distinct(), key, "left_semi")


def stacked(*parts: DataFrame) -> DataFrame:
    """Datasets under each other with ``source_rank`` in argument order."""
    ranked = [p.withColumn("source_rank", F.lit(i)) for i, p in enumerate(parts)]
    return reduce(lambda a, b: a.unionByName(b), ranked)
