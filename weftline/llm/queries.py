"""The queries ``opN_<name>`` that ``__spark_entry__`` registers; each runs over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audio, decontaminate, langid, licenses, lines, mixing, quality, repeats, sharding, simhash
from .common import table

N_SHARDS = 24


def _crc(column: str):
    return F.crc32(F.col(column).cast("string"))


def op1_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleave_shards(table(spark, sf_dir, "documents"), N_SHARDS)


def op2_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op3_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(table(spark, sf_dir, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return out.select("doc_id", "n_lines", "n_chunks", F.size("removed").cast("long").alias("removed_chunks"), gone.alias("removed_lines"), F.length("kept").cast("long").alias("kept_bytes"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = _crc("doc_id") % 3 == 1
    known = table(spark, sf_dir, "labels").filter(~held).select("doc_id", "quality")
    out = quality.score_quality(table(spark, sf_dir, "documents").select("doc_id", "text"), known)
    return out.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", "predicted")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = _crc("doc_id") % 5 == 0
    learn = docs.filter(F.coalesce(~held, F.lit(False)) & F.col("lang").isNotNull())
    out = langid.identify(docs.select("doc_id", "text"), learn)
    return out.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op9_benchmark_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_audio_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No table holds sound: a text's UTF-8 bytes are played as 8-bit samples, so copies and edits of texts are those of recordings."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.encode("text", "UTF-8").alias("recording"))
    return audio.search_recordings(docs, "doc_id", "recording")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_interleaved_shards, op2_pivotal_mix, op3_repeated_bytes, op4_line_chunks, op5_quality, op6_licenses, op7_simhash, op8_language, op9_benchmark_matches, op10_audio_alignment)}
