"""Readers of JSON lines and of JSON documents, with explicit schemas and line numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas

REQUIRED = {"persona": ["name", "age", "traits", "background", "chatting_style", "model", "id"], "experience": ["persona1", "persona2", "relationship", "situation", "topic", "id"]}


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` (or a glob) has files, in any store that Spark reads."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    return bool(found)


def read_lines(spark: SparkSession, paths: str | list[str], whole: bool = True) -> DataFrame:
    """``file``, ``line`` (from 1) and ``value`` of every line of text files.

    With ``whole`` each file is one row that is split at LF, CRLF or CR, which gives exact line numbers
    for files that fit a row (2 GB). For larger files ``whole=False`` splits them over tasks; ``line`` is then
    an order only: the place of the line's block in the file, and its place among the block's lines.
    """
    if whole:
        text = F.regexp_replace(F.regexp_replace("value", "\r\n?", "\n"), "\n\\z", "")
        rows = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.when(F.length("value") > 0, F.split(text, "\n", -1)).otherwise(F.array().cast("array<string>")).alias("lines"))
        return rows.select("file", F.posexplode("lines").alias("line", "value")).withColumn("line", (F.col("line") + 1).cast("long"))
    rows = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_nth"), "value")
    # Blocks are numbered by their start; within a task, and so within a block, the running number rises with the line.
    return rows.select("file", (F.col("_start") * F.lit(1 << 20) + F.col("_nth").bitwiseAND(F.lit((1 << 33) - 1))).alias("line"), "value")


def parse(lines: DataFrame, schema: str, required: list[str], mode: str = "skip") -> DataFrame:
    """The records of ``lines`` as columns, with ``file`` and ``line``.

    Blank lines and lines that aren't JSON objects are skipped. A record without a required field
    is skipped too (``skip``) or raises when the plan runs (``failfast``).
    """
    rec = F.from_json("value", schema, {"mode": "PERMISSIVE"})
    good = F.coalesce(F.startswith(F.ltrim("value"), F.lit("{")) & F.try_parse_json("value").isNotNull(), F.lit(False))
    whole = F.lit(True)
    for field in required:
        whole = whole & F.col(f"rec.{field}").isNotNull()
    rows = lines.filter(good).withColumn("rec", rec)
    if mode == "skip":
        rows = rows.filter(whole)
    else:
        rows = rows.filter(F.when(whole, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("missing field in line "), F.col("line").cast("string"))).cast("boolean")))
    return rows.select("file", "line", "rec.*")


def read_personas(spark: SparkSession, path: str, mode: str = "failfast") -> DataFrame:
    """Personas of a JSON-lines file; a missing file raises."""
    return parse(read_lines(spark, path), schemas.PERSONA, REQUIRED["persona"], mode)


def read_seed_experiences(spark: SparkSession, path: str, mode: str = "failfast") -> DataFrame:
    """Seed experiences; those without an id get a new one."""
    rows = parse(read_lines(spark, path), schemas.EXPERIENCE, REQUIRED["experience"][:-1], mode)
    return rows.withColumn("id", F.coalesce("id", F.replace(F.uuid(), F.lit("-"), F.lit(""))))


def read_experiences(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Experiences of several files in the order given (``file_no``); missing files and bad lines are skipped."""
    found = [(i, p) for i, p in enumerate(paths) if exists(spark, p)]
    out = None
    for i, path in found:
        one = parse(read_lines(spark, path), schemas.EXPERIENCE, REQUIRED["experience"]).withColumn("file_no", F.lit(i))
        out = one if out is None else out.unionByName(one)
    if out is None:
        return parse(spark.createDataFrame([], "file string, line long, value string"), schemas.EXPERIENCE, []).withColumn("file_no", F.lit(0))
    return out


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """``category``, ``pos``, ``value``, ``weight`` of a JSON object of weighted lists; malformed JSON raises."""
    text = spark.read.text(path, wholetext=True)
    rec = F.from_json("value", schemas.VOCABULARY, {"mode": "FAILFAST"})
    return text.select(F.explode(rec).alias("category", "items")).select("category", F.posexplode("items").alias("pos", "item")).select("category", "pos", "item.value", "item.weight")


def read_processed_ids(spark: SparkSession, path: str) -> DataFrame:
    """``id``: experiences done before; none if there is no such file or it can't be read."""
    if not exists(spark, path):
        return spark.createDataFrame([], "id string")
    rec = F.from_json("value", schemas.PROCESSED, {"mode": "PERMISSIVE"})
    return spark.read.text(path, wholetext=True).select(F.explode(rec["processed_experience_ids"]).alias("id")).distinct()


def read_dataset(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A published dataset at a path: Parquet, or JSON lines with ``schema``."""
    return spark.read.schema(schema).json(path) if schema else spark.read.parquet(path)


def choose_personas(spark: SparkSession, file: str | None, dataset: str) -> DataFrame:
    """Personas of ``file`` if one is named, else of the dataset."""
    return read_personas(spark, file) if file else read_dataset(spark, dataset)


def newest_file(spark: SparkSession, pattern: str) -> str | None:
    """The path that was modified last among those that match; None without one."""
    if not exists(spark, pattern):
        return None
    files = spark.read.format("binaryFile").load(pattern)
    return files.agg(F.max_by("path", F.struct("modificationTime", "path"))).first()[0]


def require_rows(df: DataFrame, least: int, what: str) -> None:
    """Raises unless ``df`` has ``least`` rows; reads no more than those."""
    if df.limit(least).count() < least:
        raise ValueError(f"{what}: at least {least} needed")


