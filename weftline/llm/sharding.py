"""Sharding by proportional stratified interleaving, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import cut, repeated, summed_before

#: Rows that one window partition holds on average.
BUCKET_ROWS = 4096


def _uniform(seed: int, *cols: str) -> Column:
    """A reproducible 60-bit integer; ``md5`` so that other engines can recompute it."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])), 1, 15), 16, 10).cast("long")


def interleave_shards(docs: DataFrame, n_shards: int, seed: int = 7, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with its shard; each shard holds the sources in the corpus' proportions.

    Rows are shuffled within their source by a seeded hash and ranked there. A row's fractional
    rank (rank - 1/2) / rows of its source is its place in the mixture; rows sorted by it are cut
    into ``n_shards`` runs whose lengths differ by one at most (law ``rows``).

    No rank is taken in one task. Equal rows are counted first, map-side, and take their ranks in a row from the first one's, so
    any number of them is one row until the ranks are known. Hash prefixes split each source into buckets of about
    ``BUCKET_ROWS`` rows and fractional ranks split the whole order likewise; counts per bucket
    are summed up, in two levels, to give the rank at which a bucket starts; these short tables are written first, as
    the plan of the rows would else hold theirs several times, and the driver a copy for each of its stages. A source of a third of all rows is
    spread over as many buckets as its rows need.

    Returns id, ``size`` (UTF-8 bytes of the text, null: none, plus 8), ``text_crc32`` (null text:
    that of the empty string, 0), ``law``, ``shard``, ``slot`` (place in the shard from 0) and
    ``grown_shard`` (null for this law). A null source is a source of its own; null ids, null texts, empty and very long texts are
    rows like others (a text is only measured). Equal rows are
    interchangeable; each gets its own slot. An empty table gives no rows. Other columns, whatever their names, are ignored.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("_source"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col(text_col)), F.lit(0)).cast("long").alias("text_crc32"),
    )
    kinds = cut(rows.groupBy("doc_id", "_source", "size", "text_crc32").agg(F.count("*").alias("_m")).withColumn("_u", _uniform(seed, "doc_id", "text_crc32", "size")))
    sums = kinds.agg(F.sum("_m").alias("n"), F.max("_m").alias("most")).first()
    total, most = sums["n"] or 0, sums["most"] or 0
    n_buckets = max(1, -(-total // BUCKET_ROWS))
    tie = [F.col("_u"), F.col("doc_id"), F.col("size"), F.col("text_crc32")]

    kinds = kinds.withColumn("_b", (F.col("_u") % n_buckets).cast("int"))
    # Within a bucket rows are ranked by the rest of the hash: the order is (bucket, hash).
    per = kinds.groupBy("_source", "_b").agg(F.sum("_m").alias("_n"))
    of_source = kinds.groupBy(F.col("_source").alias("_as")).agg(F.sum("_m").alias("_all"))
    per = summed_before(per, ["_source"], "_b", "_n", "_before").select(F.col("_source").alias("_s"), F.col("_b").alias("_sb"), "_before")
    per = cut(per.join(of_source, F.col("_s").eqNullSafe(F.col("_as"))).drop("_as"))
    inner = Window.partitionBy("_source", "_b").orderBy(*tie).rowsBetween(Window.unboundedPreceding, -1)
    ranked = kinds.withColumn("_r", F.coalesce(F.sum("_m").over(inner), F.lit(0))).join(
        per, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_b") == F.col("_sb")))
    ranked = repeated(ranked, "_m", "_j", most)
    place = ranked.withColumn("_f", (F.col("_before") + F.col("_r") + F.col("_j") - F.lit(0.5)) / F.col("_all")) \
        .withColumn("_g", F.least(F.floor(F.col("_f") * n_buckets), F.lit(n_buckets - 1)).cast("int")) \
        .select("doc_id", "size", "text_crc32", "_source", "_f", "_g")

    starts = summed_before(cut(place.groupBy("_g").agg(F.count("*").alias("_n"))), [], "_g", "_n", "_start").select(F.col("_g").alias("_gg"), "_start")
    order = Window.partitionBy("_g").orderBy("_f", F.col("_source").asc_nulls_last())  # no two rows of a source are equal in it
    at = place.withColumn("_p", F.row_number().over(order)).join(starts, F.col("_g") == F.col("_gg")) \
        .withColumn("_pos", (F.col("_start") + F.col("_p") - 1).cast("long"))
    shard = F.expr(f"_pos * {n_shards} div {max(1, total)}")
    return at.withColumn("_shard", shard).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("_shard").cast("int").alias("shard"),
        (F.col("_pos") - F.expr(f"(_shard * {max(1, total)} + {n_shards - 1}) div {n_shards}")).cast("long").alias("slot"),
        F.lit(None).cast(T.IntegerType()).alias("grown_shard"),
    )
