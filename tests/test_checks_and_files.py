"""Planted defects, strict scans, digests, packed frames and checkpoint plans."""

import hashlib
import json
import os
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from episodica.functions import labels
from episodica.operators import checkpoints, checks, dataset_checks, images
from episodica.sources import scans, sinks
from tests.conftest import rows


def test_assert_empty(spark):
    checks.assert_empty(spark.range(0))
    with pytest.raises(ValueError, match="7"):
        checks.assert_empty(spark.range(7, 8))


def test_contiguous_faults(spark):
    data = [("d", "s", 0, 0, 0), ("d", "s", 0, 2, 2), ("d", "s", 1, 0, 9), ("d", "s", 1, 0, 9)]
    df = spark.createDataFrame(data, "dataset string, split string, episode_index long, frame_index long, index long")
    kinds = {r.check for r in dataset_checks.check_contiguous(df).collect()}
    assert kinds == {"frame_index", "frame_index repeated", "global index"}


def test_chunk_index(spark):
    sha = "a" * 64
    data = [(0, 0, 0, 32, sha), (0, 1, 32, 8, sha), (1, 0, 0, 32, sha), (1, 2, 31, 3, "bad")]
    df = spark.createDataFrame(data, "episode_index long, chunk_index int, start_frame long, frame_count long, compressed_sha256 string")
    df = df.withColumns({"dataset": F.lit("d"), "split": F.lit("s"), "height": F.lit(2), "width": F.lit(2), "channels": F.lit(3)})
    df = df.withColumn("uncompressed_bytes", F.col("frame_count") * 12)
    lengths = spark.createDataFrame([("d", "s", 0, 40), ("d", "s", 1, 36)], "dataset string, split string, episode_index long, length long")
    got = {(r.check, r.key) for r in checks.check_chunk_index(df, lengths).collect()}
    assert got == {("chunk", "d/s/1/2"), ("chunk frames", "d/s/1")}


def test_statistics_bounds(spark):
    data = [("f", 0, 0.0, 0.25, -1.0, 1.0, -0.5, 0.5), ("f", 1, 0.0, 0.25, -1.0, 1.0, 2.0, 0.5), ("f", 2, float("nan"), 0.25, -1.0, 1.0, -0.5, 0.5)]
    df = spark.createDataFrame(data, "feature string, dim int, mean double, std double, min double, max double, q01 double, q99 double")
    got = {r.key: r.detail for r in checks.validate_stats(df).collect()}
    assert got == {"f/1": "order of min, q01, q99, max", "f/2": "not finite"}


def test_fingerprints_match_canonical_json(spark):
    payload = {"b": [1, 2.5], "a": {"y": "ü", "x": None}}
    text = json.dumps(payload, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    df = spark.createDataFrame([(json.dumps(payload, indent=2),), ('{"a": NaN}',)], "t string")
    got = [r.f for r in df.select(checks.calibration_fingerprint(F.col("t")).alias("f")).collect()]
    assert got == ["sha256:" + hashlib.sha256(text.encode()).hexdigest(), None]
    feature = json.dumps({"feature": 'a"b', "dtype": "float32", "shape": [26]}, sort_keys=True, separators=(",", ":"))
    one = spark.range(1).select(checks.schema_fingerprint(F.lit('a"b'), F.lit("float32"), F.array(F.lit(26))).alias("f"))
    assert one.first().f == "sha256:" + hashlib.sha256(feature.encode()).hexdigest()


def test_leakage_and_duplicates(spark):
    data = [("train", "h1", "a/1"), ("test", "h1", "b/1"), ("test", "h2", "b/2"), ("validation", "h2", "b/3"), ("train", "h3", "a/2")]
    df = spark.createDataFrame(data, "split string, data_json_sha256 string, source_identity string")
    assert rows(checks.split_leakage(df)) == [("h1", "train and held-out"), ("h2", "held-out twice")]
    got = checks.duplicate_content(df, ["data_json_sha256"])
    assert rows(got, "value", "owner") == [("h1", "a/1"), ("h1", "b/1"), ("h2", "b/2"), ("h2", "b/3")]


@pytest.mark.parametrize(("scale", "want"), [(0.001, 0.001), (0.0010000000474974513, 0.001), (0.002, None)])
def test_depth_scale(spark, scale, want):
    assert spark.range(1).select(labels.depth_scale(F.lit(scale)).alias("s")).first().s == want


def test_paths(spark):
    path = labels.payload_path("data/chunk-{episode_chunk:03d}/episode_{episode_index:06d}.parquet", F.lit(1234), F.lit(1000))
    assert spark.range(1).select(path.alias("p")).first().p == "data/chunk-001/episode_001234.parquet"
    df = spark.createDataFrame([("/a",), ("a/../b",), ("a/b..c",)], "p string").select(labels.path_fault(F.col("p")).alias("f"))
    assert [r.f for r in df.collect()] == ["absolute", "escapes root", None]


def test_metric_csv_is_strict(spark, tmp_path):
    header = "model,split,checkpoint_step,episodes,frames,mae,mse,dimensions,samples\n"
    good = "m,validation,5000,65,22719,0.01,0.0086,26,590694\n"
    for name, text in {"good": header + good, "number": header + good.replace("0.0086", "nan"), "header": header.replace("mse", "rmse") + good}.items():
        (tmp_path / f"{name}.csv").write_text(text)
    row = scans.scan_metric_csv(spark, str(tmp_path / "good.csv")).first()
    assert row.mse == Decimal("0.0086") and row.samples == 590694
    for name in ("number", "header"):
        with pytest.raises(Exception):  # noqa: B017
            scans.scan_metric_csv(spark, str(tmp_path / f"{name}.csv")).collect()


def test_metadata_lines_must_be_objects(spark, tmp_path):
    (tmp_path / "tasks.jsonl").write_text('{"task_index": 0, "task": "a"}\n\n{"task_index": 1, "task": "b"}\n')
    assert scans.scan_metadata(spark, str(tmp_path / "tasks.jsonl"), scans.TASKS).count() == 2
    (tmp_path / "bad.jsonl").write_text('{"task_index": 0, "task": "a"}\n[1]\nnot json\n')
    with pytest.raises(Exception):  # noqa: B017
        scans.scan_metadata(spark, str(tmp_path / "bad.jsonl"), scans.TASKS).collect()


def test_manifest_in_both_forms(spark, tmp_path):
    record = {"split": "train", "split_episode": "episode_0001", "frame_count": 3}
    (tmp_path / "m.json").write_text(json.dumps({"version": 1, "episodes": [record, record]}, indent=1))
    assert scans.scan_manifest(spark, str(tmp_path / "m.json"), lines=False).count() == 2
    df = spark.createDataFrame([("train", "episode_0001", 3)], "split string, split_episode string, frame_count long")
    sinks.write_manifest(df.agg(F.count(F.lit(1)).alias("episode_count")), df, str(tmp_path / "out"))
    assert scans.scan_manifest(spark, str(tmp_path / "out/episodes")).first().frame_count == 3


def test_digests_equal_plain_hashing(spark, tmp_path):
    files = {"b/x.bin": b"1", "a/y.bin": b"22", "top": b"333"}
    for name, content in files.items():
        os.makedirs(tmp_path / os.path.dirname(name), exist_ok=True)
        (tmp_path / name).write_bytes(content)
    total = hashlib.sha256()
    for name in sorted(files):
        content = files[name]
        total.update(name.encode() + b"\0" + str(len(content)).encode() + b"\0" + hashlib.sha256(content).digest())
    got = scans.tree_digest(scans.file_hashes(spark, str(tmp_path))).first()
    assert (got.file_count, got.total_bytes, got.tree_sha256) == (3, 6, total.hexdigest())
    assert rows(scans.scan_inventory(spark, str(tmp_path))) == [("a/y.bin", 2), ("b/x.bin", 1), ("top", 3)]


def test_range_mask(spark):
    depth = np.full((6, 8), 500)
    depth[2, 3] = 0
    depth[4, 6], depth[4, 5], depth[3, 6] = 1001, 1000, 250
    shown = np.full((6, 8, 3), 7, dtype=np.uint8)
    df = spark.createDataFrame(
        [(bytearray(shown.tobytes()), [int(v) for v in depth.ravel()], 6, 8)], "pixels binary, depth array<int>, height int, width int"
    )
    r = images.range_mask_frames(df, 0.25, 1.0).first()
    kept = np.frombuffer(r.pixels, dtype=np.uint8).reshape(6, 8, 3).any(axis=-1)
    want = np.zeros((6, 8), dtype=bool)
    inside = (depth >= 250) & (depth <= 1000)
    for y in range(1, 5):
        for x in range(1, 7):
            want[y, x] = inside[y, x] and inside[y, x - 1] and inside[y, x + 1] and inside[y - 1, x] and inside[y + 1, x]
    assert (kept == want).all()
    assert r.invalid_pixels == (~want).sum() == r.newly_zeroed_pixels


def test_layouts_restore(spark):
    draw = np.random.default_rng(0)
    frames = draw.integers(0, 256, (40, 2, 4, 3), dtype=np.uint8)
    df = spark.createDataFrame([("d", "s", 0, i, bytearray(f.tobytes())) for i, f in enumerate(frames)], "dataset string, split string, episode_index long, frame_index long, pixels binary")
    df = df.withColumns({"height": F.lit(2), "width": F.lit(4), "channels": F.lit(3)}).repartition(3)
    chunks = images.chunk_frames(df)
    assert rows(chunks, "chunk_index", "start_frame", "frame_count") == [(0, 0, 32), (1, 32, 8)]
    first = images.planar_layout(chunks).where("chunk_index = 0").first().payload
    assert bytes(first) == frames[:32].transpose(0, 3, 1, 2).tobytes()
    got = images.layout_comparison(chunks)
    assert got.count() == 3 and got.where("not restores_exactly").count() == 0
    stats = {r.channel: r for r in images.channel_stats(df).collect()}
    assert stats[1].mean == pytest.approx(frames[..., 1].mean() / 255)
    assert stats[2].q90 == pytest.approx(np.quantile(frames[..., 2] / 255, 0.9))


def metric_table(spark, values):
    data = [("m", "validation", s, 65, 22719, Decimal("0.01"), Decimal(v), 26, 590694) for s, v in values.items()]
    return spark.createDataFrame(
        data, "model string, split string, checkpoint_step long, episodes long, frames long, mae decimal(38,18), mse decimal(38,18), dimensions long, samples long"
    )


def test_retention(spark):
    table = metric_table(spark, {5000: "0.019", 10000: "0.0086", 15000: "0.0086", 20000: "0.0087", 25000: "0.0086"})
    assert checkpoints.best_steps_with_ties(table).count() == 3
    files = spark.createDataFrame([("m", s, 10) for s in (5000, 10000, 15000, 20000, 25000)] + [("m", 5000, 5)], "model string, checkpoint_step long, size long")
    plan = checkpoints.retention_plan(table, files)
    got = {r.checkpoint_step: (r.action, r.reason) for r in plan.collect()}
    assert got[5000] == ("delete", "early_non_best")
    assert got[10000] == got[15000] == ("keep", "canonical_validation_mse_best")
    assert got[20000] == ("keep", "always_keep") and got[25000] == ("keep", "always_keep_and_best")
    assert tuple(checkpoints.retention_totals(plan).first()) == (1, 15)
    with pytest.raises(Exception, match="missing"):
        checkpoints.retention_plan(table, files.where("checkpoint_step <> 25000")).collect()
    cohort = {"episodes": 65, "frames": 22719, "dimensions": 26, "samples": 590694}
    assert checkpoints.validate_metric_rows(table, cohort=cohort).count() == 0
    bad = checkpoints.validate_metric_rows(table.where("checkpoint_step <> 5000").unionByName(table.where("checkpoint_step = 10000")), cohort=cohort)
    assert {r.check for r in bad.collect()} == {"duplicate row", "step missing"}
