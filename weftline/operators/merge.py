"""Merging chat files: classify every line, keep the first of each chat, clean its messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import scrub_names, split_tags
from ..sources.jsonl import read_lines

STATUSES = ("written", "duplicate", "empty", "malformed", "error")


def _kind(v: Column) -> Column:
    """The JSON type of a variant: STRING, BIGINT, ARRAY<...>, OBJECT<...>, VOID (JSON null) and so on; null where nothing is."""
    return F.schema_of_variant(v)


def _is(kind: Column, *names: str) -> Column:
    found = F.lit(False)
    for name in names:
        found = found | F.startswith(kind, F.lit(name))
    return F.coalesce(found, F.lit(False))


def _falsy(v: Column) -> Column:
    """Missing, null, "", 0, false or an empty list or object; "0" and "false" are not."""
    kind, said = _kind(v), F.to_json(v)
    return kind.isNull() | _is(kind, "VOID") | said.isin('""', "false", "[]", "{}") | (_is(kind, "BIGINT", "DECIMAL", "DOUBLE", "FLOAT") & (F.try_variant_get(v, "$", "double") == 0))


def classify(lines: DataFrame) -> DataFrame:
    """``lines`` (file, line, value) with ``chat_key`` (its id as JSON, so that 5 and "5" differ), ``turns``, ``named`` (both personas are
    there and not empty), ``broken`` and ``faulty``.

    ``broken`` marks JSON that isn't an object, or whose id is a list or object with something in it; ``faulty`` chats whose parts
    can't be read: one isn't an object, or its messages aren't a list. Such lines get the status ``error`` and harm no others.
    A ``chat_id`` that is null, empty, 0, false or an empty list or object makes a line malformed.
    ``turns`` is 0 where ``chat_parts`` isn't a list.
    A line is parsed once: what is found goes through a generator, as Spark would repeat the parsing in every filter of a later step.
    """
    v = F.try_parse_json("value")
    loose = F.from_json("value", "struct<chat_id:string,chat_parts:array<string>,_bad:string>", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "allowNonNumericNumbers": "true"})
    rows = lines.withColumn("v", v).withColumn("loose", F.when(F.col("v").isNull() & F.startswith(F.ltrim("value"), F.lit("{")), loose))
    at = lambda path: F.try_variant_get("v", path, "variant")
    rows = rows.withColumn("_id", at("$.chat_id")).withColumn("_p1", at("$.experience.persona1")).withColumn("_p2", at("$.experience.persona2")).withColumn("_parts", F.try_variant_get("v", "$.chat_parts", "array<variant>"))
    whole = F.coalesce(F.col("loose").isNotNull() & F.col("loose._bad").isNull(), F.lit(False))  # numbers like NaN, or a key given twice
    key = F.when(F.col("v").isNotNull(), F.when(_is(_kind(F.col("v")), "OBJECT") & ~_falsy(F.col("_id")), F.to_json("_id"))).when(whole & (F.coalesce("loose.chat_id", F.lit("")) != ""), F.to_json(F.col("loose.chat_id").cast("variant")))
    odd_id = _is(_kind(F.col("_id")), "ARRAY", "OBJECT") & ~_falsy(F.col("_id"))
    messages = lambda p: _kind(F.try_variant_get(p, "$.messages", "variant"))
    faulty = F.exists("_parts", lambda p: ~_is(_kind(p), "OBJECT") | ~(messages(p).isNull() | _is(messages(p), "ARRAY", "VOID")))
    found = F.struct(
        key.alias("chat_key"), F.greatest(F.coalesce(F.size("_parts"), F.size("loose.chat_parts"), F.lit(0)), F.lit(0)).alias("turns"),
        F.when(F.col("v").isNotNull(), ~_falsy(F.col("_p1")) & ~_falsy(F.col("_p2"))).alias("named"),
        ((F.col("v").isNotNull() & ~_is(_kind(F.col("v")), "OBJECT")) | odd_id).alias("broken"), F.coalesce(faulty, F.lit(False)).alias("faulty"))
    return rows.select("file", "line", "value", F.inline(F.array(found)))


def keep_first(records: DataFrame, id_col: str, order: list[str], eligible: Column, malformed: Column | None = None) -> DataFrame:
    """``records`` with ``status``: of each id the first eligible record is written, later ones are duplicates.

    Records before it, and those of ids without an eligible one, are empty; a null id is malformed.
    The first place of an id comes from an aggregation, combined before its shuffle, and goes back by an
    equi-join, so one id with many records is not gathered in one task.
    """
    at = F.struct(*[F.col(c) for c in order])
    rows = records.withColumn("_at", at).withColumn("_ok", eligible)
    first = rows.filter(F.col("_ok") & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.min("_at").alias("_first"))
    status = F.when(F.col(id_col).isNull(), F.lit("malformed")).when(F.col("_at") == F.col("_first"), F.lit("written")).when(F.col("_at") > F.col("_first"), F.lit("duplicate")).otherwise(F.lit("empty"))
    if malformed is not None:
        status = F.when(malformed, F.lit("error")).otherwise(status)
    return rows.join(first, F.col(id_col) == F.col("_id"), "left").withColumn("status", status).drop("_at", "_ok", "_id", "_first")


def report(classified: DataFrame) -> DataFrame:
    """One row: files, lines, and lines by status."""
    return classified.agg(F.count_distinct("file").alias("files"), F.count("*").alias("lines"), *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES])


def clean_parts(parts: Column, experience: Column, named: Column | None = None, raw: bool = False) -> Column:
    """The turns with names scrubbed and messages split at tags.

    Turns stay even if all their messages vanish. Unless ``named`` (by default: neither persona is null) the turns are left as they
    are; without any name only tags are split. Null messages stay; with ``raw`` messages are variants, and those that aren't strings stay.
    """
    p1, p2 = experience["persona1"], experience["persona2"]
    names, users = [p1["name"], p2["name"]], [p1["username"], p2["username"]]

    def cleaned(m: Column) -> Column:
        if not raw:
            return F.when(m.isNull(), F.array(m)).otherwise(split_tags(scrub_names(m, names, users)))
        pieces = split_tags(scrub_names(F.try_variant_get(m, "$", "string"), names, users))
        return F.when(_is(_kind(m), "STRING"), F.transform(pieces, lambda x: x.cast("variant"))).otherwise(F.array(m))

    done = F.transform(parts, lambda p: F.struct(p["sender"].alias("sender"), F.flatten(F.transform(p["messages"], cleaned)).alias("messages")))
    return F.when(p1.isNotNull() & p2.isNotNull() if named is None else named, done).otherwise(parts)


def merge_chats(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(chats, classified): accepted chats, cleaned, with ``file``, ``line`` and ``chat_key``; and every line with its status.

    Only accepted lines are parsed in full and cleaned. A chat's id and messages are variants: they are written as they were read.
    """
    found = classify(lines)
    marked = keep_first(found, "chat_key", ["file", "line"], (F.col("turns") >= 2) & ~F.col("faulty"), F.col("broken"))
    marked = marked.withColumn("status", F.when((F.col("status") == "empty") & (F.col("turns") >= 2) & F.col("faulty"), F.lit("error")).otherwise(F.col("status")))
    return cleaned(marked.filter("status = 'written'")).drop("status"), marked


def cleaned(marked: DataFrame) -> DataFrame:
    """The classified lines parsed in full and cleaned, with ``file``, ``line``, ``chat_key`` and ``status``; nulls where ``value`` is null."""
    kept = ["file", "line", "chat_key", "status", "named"]
    rows = marked.select(*kept, F.from_json("value", schemas.RAW_CHAT).alias("c")).select(*kept, "c.*")
    return rows.withColumn("chat_parts", clean_parts(F.col("chat_parts"), F.col("experience"), F.coalesce("named", F.lit(True)), raw=True)).drop("named")


def merge_files(spark: SparkSession, pattern: str, output: str, shuffle: bool = True, seed: int = 0) -> DataFrame:
    """Merges all matching files into ``output`` and returns the report. Files of any size are split over tasks; their lines keep their order."""
    chats, marked = merge_chats(read_lines(spark, pattern, whole=False))
    chats = chats.orderBy(F.rand(seed)) if shuffle else chats.orderBy("file", "line")
    chats.drop("file", "line", "chat_key").write.mode("overwrite").option("ignoreNullFields", "false").json(output)
    return report(marked)


def messages_of(chats: DataFrame) -> DataFrame:
    """One row for each message: ``chat_id``, ``turn``, ``sender``, ``message_no``, ``message``."""
    turns = chats.select("chat_id", F.posexplode("chat_parts").alias("turn", "part"))
    return turns.select("chat_id", "turn", F.col("part.sender").alias("sender"), F.posexplode("part.messages").alias("message_no", "message"))


def chat_sizes(parts: Column) -> tuple[Column, Column]:
    """(turns, messages) of a chat."""
    return F.size(parts), F.aggregate(parts, F.lit(0), lambda n, p: n + F.size(p["messages"]))
