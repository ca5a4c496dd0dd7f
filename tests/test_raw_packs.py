"""Raw episodes from packs and from files of their own are the same rows."""

import json

from pyspark.sql import functions as F

from episodica.catalog import files
from episodica.sources import scans, sinks


def test_packs_hold_the_files(spark, tmp_path):
    texts = {f"session_{n % 2}/episode_{n:04d}/data.json": json.dumps({"text": {"goal": f" gré {n} "}, "data": [{"idx": i} for i in range(n)]}) for n in range(5)}
    for name, text in texts.items():
        place = tmp_path / "plain" / name
        place.parent.mkdir(parents=True)
        place.write_text(text, encoding="utf-8")
    plain = scans.scan_raw_episodes(spark, str(tmp_path / "plain"))
    sinks.write_packs(scans.raw_documents(spark, str(tmp_path / "plain")), str(tmp_path / "packs"))
    packed = scans.scan_raw_episodes(spark, str(tmp_path / "packs"), packed=True)
    assert plain.count() == 5 and sorted(map(str, plain.collect())) == sorted(map(str, packed.collect()))


def test_raw_source_has_fewer_files_than_documents(spark):
    path = files.raw_folder(spark, "/root/testdata/sf0.001")
    packs = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    documents = scans.raw_documents(spark, path, packed=True)
    assert documents.count() == documents.select(F.count_distinct("path")).first()[0] > 3 * packs.count()
