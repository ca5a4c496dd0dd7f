"""Checkpoint metric and retention queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from episodica.catalog.base import METRICS, STATUS, metrics, status, table, with_
from episodica.catalog.registry import query
from episodica.operators import checkpoints as ck
from episodica.operators import merge
from episodica.shared import scratch_path
from episodica.sources import scans, sinks


@query(
    "A20_best_step",
    f"""{with_(METRICS)} SELECT model, checkpoint_step AS best_step FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY mae, checkpoint_step) AS r
        FROM metrics WHERE split = 'validation' AND checkpoint_step > 0) WHERE r = 1""",
    ints="best_step",
)
def best(spark, d):
    return ck.best_step(metrics(spark, d))


@query(
    "A21_best_steps_with_ties",
    f"""{with_(METRICS)} SELECT model, checkpoint_step, mse FROM (SELECT *, min(mse) OVER (PARTITION BY model) AS low FROM metrics WHERE split = 'validation') WHERE mse = low""",
    "mse", "checkpoint_step",
)
def ties(spark, d):
    out = ck.best_steps_with_ties(metrics(spark, d).where("split = 'validation'"))
    return out.select("model", "checkpoint_step", "mse")


@query(
    "A22_latest_scores",
    f"""{with_(METRICS)}, l AS (SELECT model, checkpoint_step, CAST(mae AS DOUBLE) AS mae, CAST(mse AS DOUBLE) AS mse FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY checkpoint_step DESC) AS r
          FROM metrics WHERE split = 'validation') WHERE r = 1)
        SELECT *, min(mae) OVER () / mae * 100 AS mae_score_best_100, min(mse) OVER () / mse * 100 AS mse_score_best_100 FROM l""",
    "mae mse mae_score_best_100 mse_score_best_100", "checkpoint_step",
)
def latest(spark, d):
    return ck.latest_scores(metrics(spark, d))


PLAN = METRICS + """,
target AS (SELECT m.model, CAST(s AS BIGINT) AS checkpoint_step FROM (SELECT DISTINCT model FROM metrics) m, (VALUES (5000), (10000), (15000), (20000), (25000)) AS v(s)),
low AS (SELECT model, min(mse) AS low FROM metrics WHERE split = 'validation' AND checkpoint_step <= 25000 GROUP BY model),
files AS (SELECT model, checkpoint_step, frames AS size FROM metrics JOIN low USING (model) WHERE split = 'validation' AND (mse = low OR frames % 2 = 0)
  UNION ALL SELECT p_brand, CAST(20000 AS BIGINT), p_partkey FROM part UNION ALL SELECT p_brand, CAST(25000 AS BIGINT), p_partkey FROM part),
plan0 AS (SELECT t.model, t.checkpoint_step, m.mse, min(m.mse) OVER (PARTITION BY t.model) AS low, f.files_before, f.bytes_before
  FROM target t LEFT JOIN metrics m ON m.model = t.model AND m.checkpoint_step = t.checkpoint_step AND m.split = 'validation'
  LEFT JOIN (SELECT model, checkpoint_step, count(*) AS files_before, sum(size) AS bytes_before FROM files GROUP BY ALL) f ON f.model = t.model AND f.checkpoint_step = t.checkpoint_step),
plan AS (SELECT model, checkpoint_step, mse, coalesce(mse = low, false) AS is_best, files_before IS NOT NULL AS existed_before,
    coalesce(files_before, 0) AS files_before, coalesce(bytes_before, 0) AS bytes_before,
    CASE WHEN mse IS NULL THEN 'incomplete' WHEN checkpoint_step >= 20000 OR mse = low THEN 'keep' WHEN files_before IS NOT NULL THEN 'delete' ELSE 'absent' END AS action,
    CASE WHEN mse IS NULL THEN 'metrics_missing' WHEN checkpoint_step >= 20000 AND mse = low THEN 'always_keep_and_best' WHEN checkpoint_step >= 20000 THEN 'always_keep'
      WHEN mse = low THEN 'canonical_validation_mse_best' WHEN files_before IS NOT NULL THEN 'early_non_best' ELSE 'early_non_best_already_absent' END AS reason
  FROM plan0)"""


def plan(spark, d):
    """Files exist for the best, the always kept and every other step with even frames."""
    wanted = metrics(spark, d).where("split = 'validation'")
    best = ck.best_steps_with_ties(wanted.where("checkpoint_step <= 25000")).select("model", "checkpoint_step", F.lit(True).alias("best"))
    files = wanted.join(best, ["model", "checkpoint_step"], "left").where("best or frames % 2 = 0")
    files = files.select("model", "checkpoint_step", F.col("frames").alias("size"))
    part = table(spark, d, "part").select(F.col("p_brand").alias("model"), F.col("p_partkey").alias("size"))
    for step in (20000, 25000):
        files = files.unionByName(part.withColumn("checkpoint_step", F.lit(step).cast("long")))
    return ck.retention_plan(metrics(spark, d), files)


@query(
    "T9_retention_plan", f"{with_(PLAN)} SELECT * FROM plan",
    "mse", "checkpoint_step files_before bytes_before",
)
def retention(spark, d):
    return plan(spark, d)


@query(
    "P20_retention_action",
    f"{with_(PLAN)} SELECT action, reason, count(*) AS checkpoints FROM plan GROUP BY ALL", ints="checkpoints",
)
def actions(spark, d):
    return plan(spark, d).groupBy("action", "reason").agg(F.count(F.lit(1)).alias("checkpoints"))


@query(
    "T9_retention_totals",
    f"""{with_(PLAN)} SELECT count(*) FILTER (action = 'delete') AS planned_deletion_count,
        coalesce(sum(CASE WHEN action = 'delete' THEN bytes_before END), 0) AS planned_deletion_bytes FROM plan""",
    ints="planned_deletion_count planned_deletion_bytes",
)
def totals(spark, d):
    return ck.retention_totals(plan(spark, d))


@query(
    "V10_validate_metric_rows",
    f"""{with_(METRICS)}, faulty AS (SELECT model, split, checkpoint_step, episodes, frames, dimensions, samples + CASE WHEN frames % 5 = 0 THEN 1 ELSE 0 END AS samples FROM metrics
          WHERE NOT (checkpoint_step = 15000 AND frames % 3 = 0)),
        twice AS (SELECT * FROM faulty UNION ALL SELECT * FROM faulty WHERE frames % 7 = 0),
        v AS (SELECT * FROM twice WHERE split = 'validation' AND checkpoint_step <= 25000)
        SELECT 'duplicate row' AS "check", model || '/' || split || '/' || checkpoint_step AS key, CAST(count(*) AS VARCHAR) AS detail FROM twice GROUP BY model, split, checkpoint_step HAVING count(*) > 1
        UNION ALL SELECT 'sample count', model || '/' || checkpoint_step, CAST(samples AS VARCHAR) FROM v WHERE frames * dimensions <> samples
        UNION ALL SELECT 'cohort dimensions', model || '/' || checkpoint_step, CAST(dimensions AS VARCHAR) FROM v WHERE dimensions <> 28
        UNION ALL SELECT 'step missing', m.model || '/' || s, NULL FROM (SELECT DISTINCT model FROM twice) m, (VALUES (5000), (10000), (15000), (20000), (25000)) AS t(s)
          WHERE (m.model, s) NOT IN (SELECT (model, checkpoint_step) FROM v)""",
)
def metric_faults(spark, d):
    rows = metrics(spark, d)
    rows = rows.where(~((F.col("checkpoint_step") == 15000) & (F.col("frames") % 3 == 0)))
    rows = rows.withColumn("samples", F.col("samples") + F.when(F.col("frames") % 5 == 0, 1).otherwise(0))
    rows = rows.unionByName(rows.where("frames % 7 = 0"))
    return ck.validate_metric_rows(rows, cohort={"dimensions": 28})


@query(
    "V11_pass_gate",
    f"""{with_(STATUS)} SELECT 'pass gate' AS "check", model AS key, count(*) FILTER (stage = 'training') || '/' || count(*) FILTER (stage = 'evaluation') || '/' ||
        count(*) FILTER (status <> 'PASS' OR exit_code <> 0) AS detail FROM status GROUP BY model HAVING count(*) FILTER (status <> 'PASS' OR exit_code <> 0) > 0""",
)
def gate(spark, d):
    return ck.pass_gate(status(spark, d))


@query(
    "J16_completed_runs",
    f"""{with_(METRICS, STATUS)} SELECT model, split, checkpoint_step, frames FROM metrics WHERE model IN
        (SELECT model FROM status WHERE stage = 'evaluation' AND status = 'PASS')""",
    ints="checkpoint_step frames",
)
def completed(spark, d):
    out = merge.completed_runs(status(spark, d), metrics(spark, d))
    return out.select("model", "split", "checkpoint_step", "frames")


@query(
    "S6_scan_metric_csv",
    f"{with_(METRICS)} SELECT * FROM metrics",
    "mae mse", "checkpoint_step episodes frames dimensions samples",
)
def metric_csv(spark, d):
    """Metrics written as CSV text and read back under the strict rules."""
    path = scratch_path(spark, "metrics")
    rows = metrics(spark, d).select("model", *scans.METRICS)
    sinks.write_table_csv(rows, path)
    return scans.scan_metric_csv(spark, path)


@query("S7_scan_status_tsv", f"{with_(STATUS)} SELECT * FROM status", ints="exit_code")
def status_tsv(spark, d):
    path = scratch_path(spark, "status")
    status(spark, d).select(*scans.STATUS).write.csv(path, sep="\t", header=True)
    return scans.scan_status_tsv(spark, path)
