"""Text labels and small rules on one row (P7-P10, P12, S9, W10 names)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cohort names that differ from the source name.
COHORT_RENAMES = {
    "pick_three_cups_right_only_1408": "right_only_1408",
    "stack_cups_09_08": "stack_09_08",
}
# Canonical depth scale, its recorded float32 spelling, tolerance.
DEPTH_SCALE = 0.001
RECORDED_DEPTH_SCALE = 0.0010000000474974513
DEPTH_SCALE_TOLERANCE = 1e-15


def task_label(tasks: Column, required: bool = True) -> Column:
    """Distinct non-empty tasks in order, joined by ``" / "``."""
    kept = F.array_distinct(F.filter(tasks, lambda t: t.isNotNull() & (t != "")))
    label = F.array_join(kept, " / ")
    if not required:
        return F.coalesce(label, F.lit(""))
    return F.when(F.coalesce(label, F.lit("")) != "", label).otherwise(
        F.raise_error(F.lit("episode has no task text")).cast("string")
    )


def task_filter(episodes: DataFrame, labels, column: str = "task") -> DataFrame:
    """Episodes whose exact label is requested; all of them without a request."""
    labels = list(labels or [])
    return episodes.where(F.col(column).isin(labels)) if labels else episodes


def cohort(source: Column, renames: dict[str, str] | None = None) -> Column:
    """Provenance source to cohort; no provenance is ``base``."""
    renamed = F.when(source.isNull(), F.lit("base"))
    for old, new in (COHORT_RENAMES if renames is None else renames).items():
        renamed = renamed.when(source == old, F.lit(new))
    return renamed.otherwise(source)


def normalize_split(split: Column) -> Column:
    """P10: ``validate`` becomes ``validation``; unknown names become null."""
    named = F.when(split == "validate", F.lit("validation")).otherwise(split)
    return F.when(named.isin("train", "validation", "test"), named)


def split_name_faults(df: DataFrame, split: str = "split", root: str = "dataset") -> DataFrame:
    """P10: unknown split names, one row per root and name, and roots that use both spellings."""
    unknown = (
        df.where(normalize_split(F.col(split)).isNull())
        .groupBy(root, split)
        .agg(F.lit(1).alias("_one"))
        .select(F.lit("unknown split").alias("check"), F.col(root).alias("key"), F.col(split).alias("detail"))
    )
    both = (
        df.where(F.col(split).isin("validate", "validation"))
        .groupBy(root)
        .agg(F.count_distinct(split).alias("n"))
        .where(F.col("n") > 1)
        .select(
            F.lit("both spellings").alias("check"),
            F.col(root).alias("key"),
            F.lit("validate,validation").alias("detail"),
        )
    )
    return unknown.unionByName(both)


def depth_scale(scale: Column, strict: bool = False) -> Column:
    """The canonical scale when the recorded one is its float32 spelling, else null.

    ``strict`` accepts only the recorded spelling within the absolute tolerance.
    """
    if strict:
        same = F.abs(scale - F.lit(RECORDED_DEPTH_SCALE)) <= F.lit(DEPTH_SCALE_TOLERANCE)
    else:
        same = scale.cast("float") == F.lit(DEPTH_SCALE).cast("float")
    return F.when(same, F.lit(DEPTH_SCALE))


def canonical_depth_scale(raw: DataFrame, scale: str = "scale", payload: str = "payload") -> DataFrame:
    """Rewrite the scale in the JSON payload; keep old and new hashes.

    ``payload`` is the episode's JSON text and ``scale`` its recorded number as text.
    """
    value = F.col(scale).cast("double")
    accepted = depth_scale(value)
    pattern = F.concat(F.lit(r'("scale_m_per_unit"\s*:\s*)'), F.lit(r"[-+0-9.eE]+"))
    rewritten = F.regexp_replace(F.col(payload), pattern, F.lit("$1" + str(DEPTH_SCALE)))
    return raw.withColumns(
        {
            "canonical_scale": accepted,
            "original_sha256": F.sha2(payload, 256),
            "canonical_sha256": F.when(accepted.isNotNull(), F.sha2(rewritten, 256)),
            "canonical_payload": F.when(accepted.isNotNull(), rewritten),
        }
    )


def numbered_name(number: Column, width: int = 4) -> Column:
    return F.format_string(f"episode_%0{width}d", number)


def name_number(name: Column) -> Column:
    """The number in an ``episode_NNNN`` name, or null."""
    digits = F.regexp_extract(name, r"^episode_(\d+)$", 1)
    return F.when(digits != "", digits).try_cast("long")


def payload_path(
    template: str, episode: Column, chunks_size: Column, **fields: Column
) -> Column:
    """Expand ``{episode_chunk:03d}``-style fields of a path template."""
    import re

    values = {
        "episode_index": episode,
        "episode_chunk": F.floor(episode / chunks_size).cast("long"),
        **fields,
    }
    parts, at = [], 0
    for found in re.finditer(r"\{(\w+)(?::0?(\d*)d)?\}", template):
        parts.append(F.lit(template[at : found.start()]))
        name, width = found.groups()
        form = f"%0{width}d" if width else "%s"
        parts.append(F.format_string(form, values[name]))
        at = found.end()
    parts.append(F.lit(template[at:]))
    return F.concat(*parts)


def path_fault(path: Column) -> Column:
    """Why a path is refused: absolute, or leaving its root; null if fine."""
    return F.when(path.startswith("/"), F.lit("absolute")).when(
        F.array_contains(F.split(path, "/"), ".."), F.lit("escapes root")
    )
