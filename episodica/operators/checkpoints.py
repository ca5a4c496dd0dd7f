"""Checkpoint metrics, retention and run status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from episodica.operators.checks import all_of, key_of, violations

# Checkpoint steps that must have metrics, and those always kept.
TARGET_STEPS = (5000, 10000, 15000, 20000, 25000)
ALWAYS_KEEP = (20000, 25000)


def best_step(metrics: DataFrame, by=("model",)) -> DataFrame:
    """The step with the lowest MAE, then the lowest number, over validation rows."""
    rows = metrics.where((F.col("split") == "validation") & (F.col("checkpoint_step") > 0))
    return rows.groupBy(*by).agg(
        F.min_by("checkpoint_step", F.struct("mae", "checkpoint_step")).alias("best_step")
    )


def best_steps_with_ties(metrics: DataFrame, by=("model",), value="mse") -> DataFrame:
    """All steps whose exact decimal value equals the minimum."""
    low = metrics.groupBy(*by).agg(F.min(value).alias("best_value"))
    return metrics.join(low, list(by)).where(F.col(value) == F.col("best_value"))


def latest_scores(metrics: DataFrame, model="model") -> DataFrame:
    """Metrics at each model's largest validation step; score = best / value x 100."""
    rows = metrics.where(F.col("split") == "validation")
    last = rows.groupBy(model).agg(
        F.max_by(F.struct("checkpoint_step", "mae", "mse"), "checkpoint_step").alias("_l")
    ).select(model, "_l.*")
    best = last.agg(F.min("mae").alias("mae"), F.min("mse").alias("mse"))
    return last.withColumns(
        {
            f"{m}_score_best_100": F.try_divide(best.select(m).scalar().cast("double"), F.col(m).cast("double")) * 100
            for m in ("mae", "mse")
        }
    )


def retention_action(step: Column, is_best: Column, exists: Column, always=ALWAYS_KEEP) -> tuple[Column, Column]:
    """P20: ``(action, reason)`` of one checkpoint; a kept one must exist."""
    kept = step.isin(*always)
    present = lambda text: F.when(exists, F.lit(text)).otherwise(
        F.raise_error(F.lit("a checkpoint to keep is missing")).cast("string")
    )
    action = F.when(kept | is_best, present("keep")).when(exists, "delete").otherwise("absent")
    reason = (
        F.when(kept & is_best, "always_keep_and_best")
        .when(kept, "always_keep")
        .when(is_best, "canonical_validation_mse_best")
        .when(exists, "early_non_best")
        .otherwise("early_non_best_already_absent")
    )
    return action, reason


def retention_plan(metrics: DataFrame, inventory: DataFrame, steps=TARGET_STEPS, always=ALWAYS_KEEP, model="model"):
    """Per model and target step the action, its reason, files and bytes.

    ``inventory``: one row per file with ``model, checkpoint_step, size``. A target
    step without validation metrics appears with action ``incomplete``.
    """
    wanted = metrics.where((F.col("split") == "validation") & F.col("checkpoint_step").isin(*steps))
    models = metrics.groupBy(model).agg(F.lit(1).alias("_one")).select(
        model, F.explode(F.array(*[F.lit(s) for s in steps])).alias("checkpoint_step")
    )
    rows = models.join(wanted.select(model, "checkpoint_step", "mse"), [model, "checkpoint_step"], "left")
    rows = rows.withColumn("_best", F.min("mse").over(Window.partitionBy(model)))
    sizes = inventory.groupBy(model, "checkpoint_step").agg(
        F.count(F.lit(1)).alias("files_before"), F.sum("size").cast("long").alias("bytes_before")
    )
    rows = rows.join(sizes, [model, "checkpoint_step"], "left")
    best, exists = F.col("mse") == F.col("_best"), F.col("files_before").isNotNull()
    action, reason = retention_action(F.col("checkpoint_step"), best, exists, always)
    known = F.col("mse").isNotNull()
    return rows.select(
        model, "checkpoint_step", "mse",
        F.coalesce(best, F.lit(False)).alias("is_best"),
        exists.alias("existed_before"),
        F.coalesce("files_before", F.lit(0).cast("long")).alias("files_before"),
        F.coalesce("bytes_before", F.lit(0).cast("long")).alias("bytes_before"),
        F.when(known, action).otherwise("incomplete").alias("action"),
        F.when(known, reason).otherwise("metrics_missing").alias("reason"),
    )


def retention_totals(plan: DataFrame) -> DataFrame:
    """Planned deletions and their bytes."""
    delete = F.col("action") == "delete"
    return plan.agg(
        F.count_if(delete).alias("planned_deletion_count"),
        F.coalesce(F.sum(F.when(delete, F.col("bytes_before"))), F.lit(0).cast("long")).alias("planned_deletion_bytes"),
    )


def validate_metric_rows(metrics: DataFrame, steps=TARGET_STEPS, cohort: dict[str, int] | None = None, by=("model",)):
    """Unique (split, step), consistent counts, the expected cohort, all steps."""
    by = list(by)
    twice = metrics.groupBy(*by, "split", "checkpoint_step").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = metrics.where((F.col("split") == "validation") & F.col("checkpoint_step").isin(*steps))
    key = key_of(*by, "checkpoint_step")
    bad_numbers = rows.where("mae is null or mae < 0 or mse is null or mse < 0")
    out = [
        violations(twice, "duplicate row", key_of(*by, "split", "checkpoint_step"), F.col("n")),
        violations(rows.where("frames * dimensions <> samples"), "sample count", key, F.col("samples")),
        violations(bad_numbers, "mae or mse", key, F.col("mse")),
    ]
    if cohort:
        for name, value in cohort.items():
            out.append(violations(rows.where(F.col(name) != value), f"cohort {name}", key, F.col(name)))
    found = metrics.groupBy(*by).agg(F.lit(1).alias("_one"))
    wanted = found.select(*by, F.explode(F.array(*[F.lit(s) for s in steps])).alias("checkpoint_step"))
    lost = wanted.join(rows.select(*by, "checkpoint_step"), [*by, "checkpoint_step"], "left_anti")
    out.append(violations(lost, "step missing", key, F.lit(None)))
    return all_of(*out)


def pass_gate(status: DataFrame, model="model") -> DataFrame:
    """Models without exactly one training and one evaluation row that passed."""
    sound = (F.col("status") == "PASS") & (F.col("exit_code") == 0)
    counts = status.groupBy(model).agg(
        *[F.count_if(F.col("stage") == s).alias(s) for s in ("training", "evaluation")],
        F.count_if(F.col("stage").isin("training", "evaluation") & ~sound).alias("failed"),
    )
    bad = counts.where("training <> 1 or evaluation <> 1 or failed > 0")
    return violations(bad, "pass gate", F.col(model), F.concat_ws("/", "training", "evaluation", "failed"))
