"""All rules of a dataset over one scan of each table.

Every table is turned into facts: rows ``(root, kind, episode, task, text)`` with counts and
extremes. Facts of one subject meet in one aggregation, combined before the shuffle; the
result has a row per episode, task and task text and is checkpointed. Each row then tells
its faults as an array of structs, exploded once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.contract import EPISODE
from episodica.operators.checks import all_of, check_chunk_index, key_of, violations
from episodica.operators.ordered import index_block, running_total
from episodica.shared import checkpointed

FAULT = "struct<check:string,key:string,detail:string>"
TOTALS = {"total_episodes": "episodes", "total_frames": "frames", "total_tasks": "tasks"}
DEPTH = ("raw_depth", "aligned_depth")
"""Kinds of files that come once per frame and are counted in ``info``."""
LOSSLESS = "lossless_png"

# The measures of a fact and how they add up.
MEASURES = {
    "rows": (F.sum, "long"), "repeats": (F.sum, "long"), "low": (F.min, "long"), "high": (F.max, "long"),
    "shift_low": (F.min, "long"), "shift_high": (F.max, "long"), "known": (F.sum, "long"),
    "untitled": (F.sum, "long"), "episodes": (F.sum, "long"), "length": (F.sum, "long"), "stats": (F.sum, "long"),
}


def fault(test: Column, check: str, key: Column, detail: Column) -> Column:
    """One fault as a struct, null where the test does not hold."""
    row = F.struct(F.lit(check).alias("check"), key.cast("string").alias("key"), detail.cast("string").alias("detail"))
    return F.when(test, row)


def told(rows: DataFrame, *faults: Column) -> DataFrame:
    """The faults of each row as a violation table."""
    return rows.select(F.explode(F.array_compact(F.array(*[f.cast(FAULT) for f in faults]))).alias("_f")).select("_f.*")


def _facts(df: DataFrame, roots, kind, **columns) -> DataFrame:
    """Facts of one kind; missing subjects and measures are null."""
    subject = {"episode": "long", "task": "long", "text": "string"}
    kinds = subject | {n: t for n, (_, t) in MEASURES.items()}
    values = [columns[n].cast(t).alias(f"_{n}") if n in columns else F.lit(None).cast(t).alias(f"_{n}") for n, t in kinds.items()]
    return df.select(*roots, F.lit(kind).alias("_kind"), *values)


def _met(facts: DataFrame, roots) -> DataFrame:
    subject = [*roots, "_kind", "_episode", "_task", "_text"]
    return facts.groupBy(*subject).agg(*[f(f"_{n}").alias(f"_{n}") for n, (f, _) in MEASURES.items()])


def frame_facts(frames: DataFrame, roots, episode: str, order: str, index: str | None, task_roots=None) -> DataFrame:
    """Facts of episodes and of used tasks from one scan of the frames.

    Frames are first counted per (episode, position), which finds repeated positions; the
    tasks that they use travel as rows of their own, combined before the shuffle.
    """
    shift = (F.col(index) - F.col(order)).cast("long") if index else F.lit(None).cast("long")
    none = F.lit(None).cast("long")

    def part(kind: str, of_episode: Column, item: Column, moved: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), of_episode.cast("long").alias("episode"), item.cast("long").alias("item"), moved.alias("shift"))

    parts = [part("episode", F.col(episode), F.col(order), shift)]
    if task_roots is not None:
        parts.append(part("task", none, F.col("task_index"), none))
    rows = frames.select(*roots, F.explode(F.array(*parts)).alias("_p")).select(*roots, "_p.*")
    if task_roots is not None:
        # Tasks are told apart by the columns that the task table has.
        rows = rows.withColumns({r: F.when(F.col("kind") != "task", F.col(r)) for r in roots if r not in task_roots})
    once = rows.groupBy(*roots, "kind", "episode", "item").agg(F.count(F.lit(1)).alias("n"), F.min("shift").alias("a"), F.max("shift").alias("b"))
    of_frames = F.col("kind") == "episode"
    place = F.when(of_frames, F.col("item"))
    facts = _facts(
        once, roots, None, episode=F.col("episode"), task=F.when(~of_frames, F.col("item")), rows=F.col("n"),
        repeats=F.when(of_frames & (F.col("n") > 1), 1), low=place, high=place, shift_low=F.col("a"), shift_high=F.col("b"),
    )
    return facts.withColumn("_kind", F.when(F.col("_episode").isNotNull(), "episode").otherwise("task"))


def task_facts(tasks: DataFrame, roots, task_roots) -> DataFrame:
    """Facts of tasks and of task texts from one scan of the task table."""
    rows = tasks.select(*[(F.col(r) if r in task_roots else F.lit(None)).alias(r) for r in roots], "task_index", "task")
    texts = F.array(F.struct(F.lit("task").alias("kind"), F.lit(None).cast("string").alias("text")), F.struct(F.lit("text").alias("kind"), F.col("task").alias("text")))
    rows = rows.select(*roots, "task_index", "task", F.explode(texts).alias("_t")).where("_t.kind = 'task' OR _t.text IS NOT NULL")
    of_task = F.col("_t.kind") == "task"
    facts = _facts(
        rows, roots, None, task=F.when(of_task, F.col("task_index")), text=F.col("_t.text"), known=F.lit(1),
        untitled=F.when(of_task & F.col("task").isNull(), 1),
    )
    return facts.withColumn("_kind", F.when(F.col("_text").isNull(), "task").otherwise("text"))


def _episode_key(roots) -> Column:
    return key_of(*roots, "_episode")


def _frame_faults(roots) -> list[Column]:
    """W12 of an episode row."""
    n, low, high = F.col("_rows"), F.col("_low"), F.col("_high")
    key = _episode_key(roots)
    return [
        fault((n > 0) & ((low != 0) | (high != n - 1)), "frame_index", key, F.format_string("%d rows in %d..%d", n, low, high)),
        fault(F.col("_repeats") > 0, "frame_index repeated", key, F.col("_repeats")),
    ]


def _index_fault(roots) -> Column:
    apart = (F.col("_shift_low") != F.col("_shift_high")) | (F.col("_shift_low") != F.col("_start"))
    return fault((F.col("_rows") > 0) & apart, "global index", _episode_key(roots), F.col("_start"))


def _used_task_fault(task_roots) -> Column:
    lost = (F.col("_kind") == "task") & F.col("_known").isNull()
    return fault(lost, "task_index", key_of(*task_roots, "_task"), F.col("_rows"))


def check_contiguous(
    frames: DataFrame, by=EPISODE, order: str = "frame_index", index: str | None = "index", tasks: DataFrame | None = None
) -> DataFrame:
    """frame_index is 0..L-1; the global index continues; the task exists.

    Positions come from counts, not from an ordered scan: L distinct values with minimum 0
    and maximum L-1 are 0..L-1. The running index is checked against the frames of the
    episodes before. Frames and tasks are scanned once.
    """
    *roots, episode = by
    shared = None if tasks is None else [c for c in roots if c in tasks.columns]
    facts = frame_facts(frames, roots, episode, order, index, shared)
    if tasks is not None:
        facts = facts.unionByName(task_facts(tasks.withColumn("task", F.lit(None).cast("string")), roots, shared))
    met = checkpointed(_met(facts, roots))
    faults = _frame_faults(roots)
    if tasks is not None:
        faults.append(_used_task_fault(shared))
    if not index:
        return told(met, *faults)
    of_frames = met.where("_kind = 'episode'")
    rows = running_total(of_frames, roots, ["_episode"], index_block("_episode"), F.col("_rows"), "_start")
    rows = rows.unionByName(met.where("_kind <> 'episode'"), allowMissingColumns=True)
    return told(rows, *faults, _index_fault(roots))


def expected_media(info: DataFrame, episodes: DataFrame, templates: dict[str, Column], frame_templates: dict[str, Column], by=("dataset", "split")) -> DataFrame:
    """The files that a dataset should have: ``by, episode_index, kind, path``.

    ``templates`` gives a path per kind and episode (data file, one per camera),
    ``frame_templates`` a path per kind and ``frame_index``; both may use columns of
    ``info``. A null path is no file.
    """
    rows = episodes.select(*by, "episode_index", "length").join(info, list(by))
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), p.alias("path")) for k, p in templates.items()])
    out = rows.select(*by, "episode_index", F.explode(kinds).alias("_k")).select(*by, "episode_index", "_k.*")
    if frame_templates:
        steps = rows.where("length > 0").withColumn("frame_index", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length").cast("long") - 1)))
        kinds = F.array(*[F.struct(F.lit(k).alias("kind"), p.alias("path")) for k, p in frame_templates.items()])
        out = out.unionByName(steps.select(*by, "episode_index", F.explode(kinds).alias("_k")).select(*by, "episode_index", "_k.*"))
    return out.where("path IS NOT NULL")


def _media(references: DataFrame, inventory: DataFrame, roots) -> DataFrame:
    """Missing files one by one, and the number of found ones per root and kind; one scan of both tables."""
    files = inventory.select(F.col("path").alias("_path")).distinct().withColumn("_there", F.lit(True))
    # References without a path must not meet in one task.
    named = references.withColumn("_key", key_of(*roots, "episode_index"))
    named = named.withColumn("_path", F.coalesce("path", F.concat(F.lit("?"), "_key")))
    joined = named.join(files, "_path", "left")
    found = F.col("path").isNotNull() & F.col("_there").isNotNull()
    kind = F.when(F.col("path").isNull(), "no reference").when(~found, "missing file")
    lost = F.struct(kind.alias("check"), F.col("_key").alias("key"), F.col("path").alias("detail"))
    met = F.struct(F.lit(None).cast("string").alias("check"), F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("detail"))
    rows = joined.select(*roots, "kind", F.when(found, met).otherwise(lost).alias("_f")).select(*roots, "kind", "_f.*")
    return rows.groupBy(*roots, "kind", "check", "key", "detail").agg(F.count(F.lit(1)).alias("files"))


def _root_faults(roots, info_columns, with_media: bool) -> list[Column]:
    """Rules of a whole dataset split: totals of ``info`` and contiguous episodes and tasks."""
    key = key_of(*roots)
    wrong = [fault(~F.col(declared).eqNullSafe(F.col(f"_{actual}")), "info", key, F.lit(declared)) for declared, actual in TOTALS.items()]
    low, high, n = F.col("_low"), F.col("_high"), F.col("_episodes")
    wrong.append(fault((low != 0) | (high != n - 1), "episode indices", key, high))
    low, high, n = F.col("_task_low"), F.col("_task_high"), F.col("_tasks")
    wrong.append(fault((n > 0) & ((low != 0) | (high != n - 1)), "task indices", key, F.format_string("%d in %d..%d", n, low, high)))
    for kind in DEPTH:
        declared, storage = f"{kind}_files", f"{kind}_storage"
        if declared not in info_columns:
            continue
        coded = F.col(declared).isNotNull()
        frames = F.col("total_frames")
        wrong.append(fault(coded & ~F.col(declared).eqNullSafe(frames), f"{kind} total", key, F.col(declared)))
        if storage in info_columns:
            wrong.append(fault(coded & ~F.col(storage).eqNullSafe(F.lit(LOSSLESS)), f"{kind} storage", key, F.col(storage)))
        if with_media:
            there = F.coalesce(F.col(f"_found_{kind}"), F.lit(0))
            wrong.append(fault(coded & (there != frames), f"{kind} files", key, there))
    return wrong


def validate_dataset(
    info, tasks, episodes, stats, frames, by=("dataset", "split"),
    references: DataFrame | None = None, inventory: DataFrame | None = None,
    chunks: DataFrame | None = None, chunk_frames: int = 32,
) -> DataFrame:
    """V1: counts of ``info`` against the tables, with V2, J3, W12, J10, W13 and encoding totals.

    ``references`` (``by, episode_index, kind, path``, as from ``expected_media``) and
    ``inventory`` (``path``) add missing files; ``info`` may declare ``raw_depth_files`` and
    ``aligned_depth_files`` with their ``_storage``: one file per frame. ``chunks`` adds W13.
    """
    roots = list(by)
    keys = [*roots, "episode_index"]
    facts = [
        frame_facts(frames, roots, "episode_index", "frame_index", "index", roots),
        task_facts(tasks, roots, roots),
        _facts(episodes, roots, "episode", episode=F.col("episode_index"), length=F.col("length"), episodes=F.lit(1)),
        _facts(stats, roots, "episode", episode=F.col("episode_index"), stats=F.lit(1)),
    ]
    met = checkpointed(_met(all_of(*facts), roots))
    of_episode, of_task = F.col("_kind") == "episode", F.col("_kind") == "task"
    listed, recorded = F.col("_episodes").isNotNull(), F.col("_stats").isNotNull()
    key = _episode_key(roots)
    repeated = F.col("_known") > 1
    faults = [
        fault(of_episode & listed & ~recorded, "coverage", key, F.lit("no record")),
        fault(of_episode & ~listed & recorded, "coverage", key, F.lit("no episode")),
        fault(F.col("_episodes") > 1, "episode repeated", key, F.col("_episodes")),
        fault(F.col("_stats") > 1, "record repeated", key, F.col("_stats")),
        fault(
            of_episode & (listed | (F.col("_rows") > 0)) & ~F.col("_length").eqNullSafe(F.col("_rows")),
            "length", key, F.col("_rows"),
        ),
        *_frame_faults(roots),
        _index_fault(roots),
        _used_task_fault(roots),
        fault(of_task & repeated, "task index repeated", key_of(*roots, "_task"), F.col("_known")),
        fault(of_task & (F.col("_untitled") > 0), "task text", key_of(*roots, "_task"), F.lit("missing")),
        fault((F.col("_kind") == "text") & repeated, "task text repeated", key_of(*roots, "_text"), F.col("_known")),
    ]
    with_frames = met.where(of_episode & (F.col("_rows") > 0))
    rows = running_total(with_frames, roots, ["_episode"], index_block("_episode"), F.col("_rows"), "_start")
    rows = rows.unionByName(met.where(~(of_episode & F.coalesce(F.col("_rows") > 0, F.lit(False)))), allowMissingColumns=True)
    out = [told(rows, *faults)]

    totals = met.groupBy(*roots).agg(
        F.sum(F.when(of_episode, F.col("_episodes"))).alias("_episodes"),
        F.sum(F.when(of_episode, F.col("_length"))).alias("_frames"),
        F.sum(F.when(of_task, F.col("_known"))).alias("_tasks"),
        F.min(F.when(of_episode & listed, F.col("_episode"))).alias("_low"),
        F.max(F.when(of_episode & listed, F.col("_episode"))).alias("_high"),
        F.min(F.when(of_task & (F.col("_known") > 0), F.col("_task"))).alias("_task_low"),
        F.max(F.when(of_task & (F.col("_known") > 0), F.col("_task"))).alias("_task_high"),
    )
    with_media = references is not None
    if with_media:
        files = checkpointed(_media(references, inventory, roots))
        out.append(files.where("check IS NOT NULL").select("check", "key", "detail"))
        found = files.where("check IS NULL").groupBy(*roots).agg(*[F.sum(F.when(F.col("kind") == k, F.col("files"))).alias(f"_found_{k}") for k in DEPTH])
        totals = totals.join(found, roots, "left")
    out.append(told(info.join(totals, roots, "full_outer"), *_root_faults(roots, info.columns, with_media)))
    if chunks is not None:
        lengths = met.where(of_episode & listed).select(*roots, F.col("_episode").alias("episode_index"), F.col("_length").alias("length"))
        out.append(check_chunk_index(chunks, lengths, chunk_frames, keys))
    return all_of(*out)
