"""Merging chat files as they arrive, and resumable generation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import merge_chats
from ..sources.jsonl import exists


def stream_merge(spark: SparkSession, folder: str, output: str, checkpoint: str, ids: str):
    """Merges the new files of ``folder`` into ``output`` (JSON lines) and stops; returns the query.

    Each micro-batch is merged as by the batch operator; chats whose id was accepted by an earlier
    one (kept in ``ids``) are left out. Ids of a batch are written under its number, so a batch that
    runs again after a crash writes the same folders again.
    """
    lines = spark.readStream.format("text").option("wholetext", True).load(folder).select(F.col("_metadata.file_path").alias("file"), "value")

    def batch(rows: DataFrame, number: int) -> None:
        text = F.regexp_replace(F.regexp_replace("value", "\r\n?", "\n"), "\n\\z", "")
        found = rows.select("file", F.posexplode(F.split(text, "\n", -1)).alias("line", "value")).withColumn("line", (F.col("line") + 1).cast("long"))
        chats, _ = merge_chats(found)
        session = rows.sparkSession
        if exists(session, f"{ids}/batch=*"):
            old = session.read.schema("id string, batch int").parquet(ids).filter(F.col("batch") < number)
            chats = chats.join(old, F.col("chat_key") == F.col("id"), "left_anti")
        chats = chats.drop("file", "line")
        chats.drop("chat_key").write.mode("overwrite").option("ignoreNullFields", "false").json(f"{output}/batch={number}")
        written = session.read.schema("chat_id variant").json(f"{output}/batch={number}")
        written.select(F.to_json("chat_id").alias("id")).write.mode("overwrite").parquet(f"{ids}/batch={number}")

    return lines.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_generate(spark: SparkSession, folder: str, schema: str, output: str, checkpoint: str, make: Callable[[DataFrame], DataFrame]):
    """Runs ``make`` on new records (JSON lines of ``schema``, a struct type) of ``folder`` once each; progress is the checkpoint, so a rerun goes on where it stopped."""
    rows = spark.readStream.text(folder).select(F.from_json("value", schema).alias("r")).filter("r is not null").select("r.*")

    def batch(part: DataFrame, number: int) -> None:
        make(part).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{output}/batch={number}")

    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
