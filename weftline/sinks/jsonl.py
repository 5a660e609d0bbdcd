"""Writers of JSON lines; nulls are kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.jsonl import newest_file


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def overwrite_jsonl(df: DataFrame, path: str, one_file: bool = False) -> None:
    """Replaces ``path``; ``one_file`` for small results that must be a single file."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_processed_ids(ids: DataFrame, path: str) -> None:
    """One JSON object with all ids in order, as :func:`..sources.jsonl.read_processed_ids` reads it."""
    whole = ids.select(F.col(ids.columns[0]).alias("id")).distinct().agg(F.array_sort(F.collect_set("id")).alias("processed_experience_ids"))
    whole.coalesce(1).write.mode("overwrite").json(path)


def publish(df: DataFrame, path: str) -> None:
    """A dataset as Parquet; sending it anywhere is left to the caller."""
    df.write.mode("overwrite").parquet(path)


def publish_newest(spark, pattern: str, target: str, path: str | None = None) -> str:
    """The named or else the newest merged file as ``target``/data.jsonl; returns which."""
    chosen = path or newest_file(spark, pattern)
    if chosen is None:
        raise FileNotFoundError(f"nothing matches {pattern}")
    spark.read.text(chosen).coalesce(1).write.mode("overwrite").text(f"{target}/data.jsonl")
    return chosen
