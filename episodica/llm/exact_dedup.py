"""Exact dedup by a stateful stream over digests.

The stream keeps, for each digest and for ever, the identifier of the row that stays, the
locator of its content (file and row in the file) and the number of rows. The state lives
in RocksDB on the executors' disks, its log in the shared folder, so a lost executor only
restores its part. Equal digests of one task are combined before they reach the state: a
group with a third of all rows sends one row per task. A hit counts as a copy only after its
bytes were compared with those of the row that stays.

Defined results: a null text is the empty text; a null identifier is below all others; of
rows that also share the identifier one stays, the last by locator; an empty table gives
an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.llm.tables import located, text_or_empty, written
from episodica.shared import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STREAM = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # Else each state partition takes some 4 MB of disk in advance, whatever it holds.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
FILES_PER_BATCH = 200


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def class_states(ledger: DataFrame, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """One row per digest: ``kept`` (identifier, locator) and ``group_size``.

    ``ledger`` is a written table with columns digest, id and locator; the stream takes
    its files in micro-batches and adds every changed state to a table.
    """
    spark: SparkSession = ledger.sparkSession
    out, log = scratch_path(spark, "states"), scratch_path(spark, "stream")
    before = {key: spark.conf.get(key, None) for key in STREAM}
    for key, value in STREAM.items():
        spark.conf.set(key, value)
    try:
        folder = ledger.inputFiles()[0].rpartition("/")[0]
        stream = spark.readStream.schema(ledger.schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
        states = stream.groupBy("digest").agg(F.max(F.struct("id", "locator")).alias("kept"), F.count("*").alias("group_size"))
        running = (
            states.writeStream.outputMode("update")
            .option("checkpointLocation", log)
            .trigger(availableNow=True)
            .foreachBatch(lambda changed, batch: changed.write.mode("overwrite").parquet(f"{out}/batch={batch}"))
            .start()
        )
        running.awaitTermination()
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    changes = spark.read.schema(states.schema).parquet(f"{out}/batch=*")
    # A later state of a digest has counted more rows.
    return changes.groupBy("digest").agg(F.max(F.struct("group_size", "kept")).alias("last")).select("digest", "last.kept", "last.group_size")


def exact_classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", digest=sha256, by_content: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, digest, keep_id, group_size, kept and its locator.

    ``digest`` maps the text to the key of the state. Weak digests give right results too:
    where the bytes of a hit differ, the rows of that digest are told apart by their text.
    """
    spark = docs.sparkSession
    rows = located(docs, by_content).select(F.col(f"row.`{id_column}`").alias("id"), "locator", text_or_empty(f"row.`{text_column}`").alias("text"))
    rows = rows.withColumn("digest", digest(F.col("text")))
    ledger = written(rows.select("digest", "id", "locator"), "ledger")
    if not ledger.inputFiles():
        return ledger.select("id", "digest", "locator", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    states = written(class_states(ledger), "classes")

    # Only rows of groups move on with their texts; hits are compared with the row that stays.
    groups = states.filter("group_size > 1").select("digest", F.col("kept.locator").alias("keep_locator"))
    copies = written(rows.join(groups, "digest"), "copies")
    keepers = copies.filter("locator = keep_locator").select("digest", F.col("text").alias("keep_text"))
    wrong = copies.filter("locator != keep_locator").join(keepers, "digest").filter("text != keep_text").select("digest").distinct()
    wrong = written(wrong, "collisions")
    apart = ledger.join(states, "digest").select("id", "digest", "locator", "kept", "group_size")
    if not wrong.isEmpty():
        mixed = copies.join(wrong, "digest").select("digest", "text", "id", "locator")
        told = mixed.groupBy("digest", "text").agg(F.max(F.struct("id", "locator")).alias("kept"), F.count("*").alias("group_size"))
        apart = apart.join(wrong, "digest", "left_anti").unionByName(
            mixed.join(told, ["digest", "text"]).select("id", "digest", "locator", "kept", "group_size")
        )
    return apart.select("id", "digest", "locator", F.col("kept.id").alias("keep_id"), "group_size", F.expr("locator = kept.locator").alias("kept"))


def drop_exact_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; which of those that share text and identifier, their content says."""
    here = located(docs)
    stay = exact_classes(docs, id_column, text_column, by_content=True).filter("kept").select(F.col("locator.file").alias("_file"), F.col("locator.row").alias("_row"))
    return here.join(stay, (F.col("locator.file") == F.col("_file")) & (F.col("locator.row") == F.col("_row")), "left_semi").select("row.*")
