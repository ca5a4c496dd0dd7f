"""The same documents give the same rows in every run of the pipeline."""

import random
from collections import Counter

import corpus_pipeline
from episodica.llm import mixing


def words(n, draw):
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 7))) for _ in range(n))


def documents():
    """Identifiers shared by different rows, and fully equal rows."""
    draw = random.Random(4)
    rows = [(i // 3, words(draw.randint(5, 90), draw), "en", f"s{i % 4}") for i in range(240)]
    return rows + rows[:30] + [(i, text, lang, "s9") for i, text, lang, _ in rows[:60]]


COLUMNS = "doc_id long, text string, lang string, source string"


def test_mixing_does_not_depend_on_the_files(spark):
    runs = [spark.createDataFrame(documents()[:: step], COLUMNS).repartition(parts) for step, parts in ((1, 2), (-1, 5))]
    first, second = (Counter(map(tuple, mixing.mix_documents(docs, shard_rows=40).collect())) for docs in runs)
    assert first == second and len(first) > 50


def test_two_runs_of_the_pipeline_give_the_same_rows(spark, tmp_path):
    spark.createDataFrame(documents(), COLUMNS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(12)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    first, second = (Counter(map(str, corpus_pipeline.run(spark, str(tmp_path)).collect())) for _ in range(2))
    assert first == second and len(first) > 20
