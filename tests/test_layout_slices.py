"""Layout kernels hand out their rows in slices, whatever an Arrow batch holds."""

import numpy as np
import pyarrow as pa

from episodica.operators import images


def test_slices_bound_the_bytes_of_a_step(monkeypatch):
    monkeypatch.setattr(images, "SLICE_BYTES", 10)
    column = pa.array([b"1234", b"12345", None, b"12", b"x" * 30, b"1"], pa.binary())
    assert list(images._slices(column)) == [(0, 3), (3, 4), (4, 5), (5, 6)]


def test_kernels_keep_nulls_and_order(spark, monkeypatch):
    monkeypatch.setattr(images, "SLICE_BYTES", 50)
    draw = np.random.default_rng(1)
    data = [(n, draw.integers(0, 256, 2 * 2 * 3 * 3, dtype=np.uint8).tobytes(), 2, 2, 3, 3) for n in range(9)]
    chunks = spark.createDataFrame(data, "n int, payload binary, frame_count int, height int, width int, channels int").coalesce(1)
    want = {n: bytes(p) for n, p, *_ in data}
    for there, back in ((images.planar_layout, images.interleaved_layout), (images.temporal_delta, images.temporal_restore)):
        assert {r.n: bytes(r.payload) for r in there(chunks).collect()} != want
        assert {r.n: bytes(r.payload) for r in back(there(chunks)).collect()} == want
    packed = spark.createDataFrame([(0, b"\x00\xff"), (1, None), (2, b""), (3, b"\x07")], "n int, b binary").coalesce(1)
    assert {r.n: r.v for r in packed.select("n", images.unpack_pixels("b").alias("v")).collect()} == {0: [0, 255], 1: None, 2: [], 3: [7]}
