"""Donor episodes and frames for counterfactual inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.functions.phases import (
    CURRENT_FRAME, OFFSETS, PHASES, ROUNDING_RULE, offset_frame, phase_frame, phase_progress, progress,
)
from episodica.functions.seeds import seeded_digest
from episodica.operators.ordered import hash_block, next_row


def attach_provenance(episodes: DataFrame, provenance: DataFrame, keys=("split", "episode_index")):
    """Episodes with their provenance; episodes without one are kept."""
    return episodes.join(provenance.withColumnRenamed("final_episode_index", keys[-1]), list(keys), "left")


def provenance_duplicates(provenance: DataFrame, keys=("split", "final_episode_index")) -> DataFrame:
    """Keys with more than one provenance record."""
    return provenance.groupBy(*keys).agg(F.count(F.lit(1)).alias("records")).where("records > 1")


def donor_feasibility(episodes: DataFrame, task="task") -> DataFrame:
    """Tasks with fewer than two episodes, which have no donor."""
    return episodes.groupBy(task).agg(F.count(F.lit(1)).alias("episodes")).where("episodes < 2")


def donor_derangement(
    episodes: DataFrame, seed: int, repeats: int = 1, task="task", episode="episode_index", length="length", by=()
) -> DataFrame:
    """In each task a seeded circle of episodes; each takes the next as donor.

    ``by`` names the columns, such as dataset and split, within which episodes are numbered.

    The circle is the order of a digest, cut into blocks by its first digits, so a
    task of any size is spread out. A task with one episode fails the job.
    """
    by = list(by)
    rows = episodes.select(*by, task, episode, length)
    rows = rows.withColumn("shuffle_repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    rows = rows.withColumn("_digest", seeded_digest(seed, "shuffle_repeat", *by, task, episode))
    circle = next_row(
        rows,
        ["shuffle_repeat", *by, task],
        ["_digest", episode],
        [episode, length],
        hash_block("_digest"),
        circular=True,
    )
    donor = F.when(
        F.col(f"next_{episode}") != F.col(episode), F.col(f"next_{episode}")
    ).otherwise(F.raise_error(F.lit("task has one episode; no donor")).cast("long"))
    return circle.select(
        "shuffle_repeat",
        *by,
        task,
        F.col(episode).alias("recipient_episode_index"),
        F.col(length).alias("recipient_length"),
        donor.alias("donor_episode_index"),
        F.col(f"next_{length}").alias("donor_length"),
    )


def anchors(frames: DataFrame, horizon: int, frame="frame_index") -> DataFrame:
    """Frames 0, H, 2H, ... of every episode, taken from the frame table itself."""
    return frames.where(F.col(frame) % horizon == 0)


def frame_mappings(
    anchor_frames: DataFrame, donors: DataFrame | None, interventions, repeats: int = 1,
    brightness_scale: float | None = None, by=(),
) -> DataFrame:
    """Which donor frame replaces the input of each anchor frame, for several interventions.

    ``anchor_frames``: ``by, task, episode_index, length, frame_index``. Cross-episode
    interventions read ``donors`` from ``donor_derangement``; an anchor whose episode has no
    donor fails the job. Anchors are read once: the donors of an episode (one per repeat)
    come by one join, and all interventions are an array of structs, exploded once.
    """
    by = list(by)
    unknown = [i for i in interventions if i not in (*PHASES, *OFFSETS, *CURRENT_FRAME)]
    if unknown:
        raise ValueError(f"unknown intervention {unknown[0]!r}")
    if "brightness_scale" in interventions and brightness_scale is None:
        raise ValueError("brightness_scale needs its numeric scale")
    t, size = F.col("recipient_frame"), F.col("recipient_length")
    rows = anchor_frames.select(
        *by,
        "task",
        F.col("episode_index").alias("recipient_episode_index"),
        F.col("length").alias("recipient_length"),
        F.col("frame_index").alias("recipient_frame"),
    )
    phases = [i for i in interventions if i in PHASES]
    if phases:
        given = donors.groupBy(*by, "recipient_episode_index").agg(
            F.collect_list(F.struct("shuffle_repeat", "donor_episode_index", "donor_length")).alias("_donors")
        )
        rows = rows.join(given, [*by, "recipient_episode_index"], "left")

    def replaced(intervention: str, repeat: Column, source: str, at: Column, donor: Column, length: Column, frame: Column) -> Column:
        bright = intervention == "brightness_scale"
        return F.struct(
            F.lit(intervention).alias("intervention"),
            repeat.cast("int").alias("shuffle_repeat"),
            F.lit(source).alias("replacement_source"),
            at.cast("double").alias("donor_progress"),
            donor.cast("long").alias("donor_episode_index"),
            length.cast("long").alias("donor_length"),
            frame.cast("long").alias("donor_frame"),
            F.lit(brightness_scale if bright else None).cast("double").alias("brightness_scale"),
            F.lit(ROUNDING_RULE if bright else None).cast("string").alias("rounding_rule"),
        )

    def of_donor(intervention: str) -> Column:
        def one(x: Column) -> Column:
            frame = phase_frame(t, size, x["donor_length"], intervention)
            return replaced(
                intervention, x["shuffle_repeat"], "same_task_donor", phase_progress(t, size, intervention),
                x["donor_episode_index"], x["donor_length"], frame,
            )

        missing = F.raise_error(F.lit("episode of an anchor has no donor"))
        found = F.transform("_donors", one)
        return F.when(F.col("_donors").isNotNull(), found).otherwise(missing.cast(_MAPPED))

    def of_self(intervention: str) -> Column:
        none = F.lit(None)

        def one(repeat: Column) -> Column:
            if intervention in OFFSETS:
                moved = offset_frame(t, size, OFFSETS[intervention])
                return replaced(intervention, repeat, "same_episode", progress(moved, size), F.col("recipient_episode_index"), size, moved)
            return replaced(intervention, repeat, CURRENT_FRAME[intervention], none, none, none, none)

        return F.transform(F.sequence(F.lit(0), F.lit(repeats - 1)), one)

    every = F.concat(*[of_donor(i) if i in PHASES else of_self(i) for i in interventions])
    return rows.withColumn("recipient_progress", progress(t, size)).withColumn("_m", F.explode(every)).select(
        "_m.intervention", "_m.shuffle_repeat", *by, "task", "recipient_episode_index", "recipient_length",
        "recipient_frame", "recipient_progress", "_m.replacement_source", "_m.donor_progress",
        "_m.donor_episode_index", "_m.donor_length", "_m.donor_frame", "_m.brightness_scale", "_m.rounding_rule",
    )


_MAPPED = (
    "array<struct<intervention:string,shuffle_repeat:int,replacement_source:string,donor_progress:double,"
    "donor_episode_index:bigint,donor_length:bigint,donor_frame:bigint,brightness_scale:double,rounding_rule:string>>"
)


def frame_mapping(
    anchor_frames: DataFrame, donors: DataFrame | None, intervention: str, repeats: int = 1,
    brightness_scale: float | None = None, by=(),
) -> DataFrame:
    """W5 for one intervention."""
    return frame_mappings(anchor_frames, donors, [intervention], repeats, brightness_scale, by)


def fetch_donor_frame(mapping: DataFrame, frames: DataFrame, view: str, by=()) -> DataFrame:
    """Anchors with the donor's frame; an equi-join on (by, episode, frame).

    Only mapped frames meet payloads: the mapping holds one row in ``horizon``. Anchors
    without a donor, such as those of brightness changes, are left out; a donor frame that
    is named but not there fails the job.
    """
    by = list(by)
    donor = frames.select(
        *by,
        F.col("episode_index").alias("donor_episode_index"),
        F.col("frame_index").alias("donor_frame"),
        F.col(view).alias("replacement"),
        F.lit(True).alias("_found"),
    )
    named = mapping.where(F.col("donor_episode_index").isNotNull())
    joined = named.join(donor, [*by, "donor_episode_index", "donor_frame"], "left")
    missing = F.raise_error(F.lit("donor frame is not in the frame table")).cast(frames.schema[view].dataType)
    return joined.withColumn("replacement", F.when(F.col("_found"), F.col("replacement")).otherwise(missing)).drop("_found")


def replace_view(df: DataFrame, view: str, replacement: Column) -> DataFrame:
    """One view replaced, all other columns unchanged; the size must agree."""
    kind = df.schema[view].dataType
    measure = F.octet_length if kind.typeName() == "binary" else F.size
    same = measure(replacement) == measure(F.col(view))
    return df.withColumn(
        view,
        F.when(same, replacement).otherwise(
            F.raise_error(F.lit(f"replacement of {view} has another size")).cast(kind)
        ),
    )
