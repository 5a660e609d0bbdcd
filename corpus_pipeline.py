"""A training corpus from ``documents``: language ID, near-dedup, decontamination, mixing, sharding.

``STAGES`` are applied in order; each function takes (spark, docs, sf_dir) and returns a DataFrame
that is written and read again as the next one's ``docs``. All but the last return the columns of
``documents``, whatever further columns ``docs`` has. No stage fails on nulls in any column, repeated rows, very long
texts or an empty table (which gives an empty one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import decontaminate, langid, mixing, sharding, simhash
from weftline.llm.common import fresh, stored, table

#: A document is rejected if its text has no letter or no language reaches this pooled probability.
LEAST_CONFIDENCE = 0.4
N_SHARDS = 24


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in one of the languages that the labelled documents have.

    Null texts and those without a letter go. Rows of null ``lang`` are judged like others and teach nothing; repeated rows
    stay or go together; without any label nothing stays. Ties between languages take the first by code point.
    """
    pred, score = fresh(docs, "_pred", "_score")
    found = langid.identify(docs, docs.filter(F.col("lang").isNotNull()), pred_col=pred, score_col=score)
    kept = found.filter((F.col(pred) != langid.UNKNOWN) & (F.col(score) >= LEAST_CONFIDENCE))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of least id, null first, then of least hash.

    Blank texts are one group. Of equal rows one stays; a row with a null id stands for its group only if that group has no other id.
    """
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage; passages count whatever their id.

    Null and wordless texts stay, rows with a null id are judged by their text, repeated rows stay or go together, an empty
    benchmark keeps all.
    """
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), null_ids=True)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, 0 to 3 times.

    A null source is a source; texts without words are not taken; rows equal in all columns are taken together.
    """
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every document of the mix; each of equal rows has a slot of its own."""
    return sharding.interleave_shards(docs, N_SHARDS)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mix", mix), ("shard", shard)]

#: SQL can't express the network and the pivotal rounding; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``; what is between them is written to the checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs)
    return docs
