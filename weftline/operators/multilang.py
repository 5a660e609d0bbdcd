"""Multilingual records: wrapping texts in language maps, gathering work, translating, putting back."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import prompts
from ..functions.text import BLANKS, strip
from ..travel import by_value

SOURCE = "en"
PERSONA_TEXTS = ("background", "chatting_style")
SCENE_TEXTS = ("relationship", "situation", "topic")


def wrap_message(message: Column) -> Column:
    """``{tag: m}`` for a message that begins with ``<`` (its caption goes with it), else ``{en: m}``."""
    return F.when(F.startswith(message, F.lit("<")), F.create_map(F.lit("tag"), message)).otherwise(F.create_map(F.lit(SOURCE), message))


def is_multilingual(chats: DataFrame) -> bool:
    return isinstance(chats.schema["experience"].dataType["topic"].dataType, T.MapType)


def wrap(chats: DataFrame) -> DataFrame:
    """Chats with every text in a map by language; multilingual ones as they are."""
    if is_multilingual(chats):
        return chats
    en = lambda c: F.create_map(F.lit(SOURCE), c)
    x = F.col("experience")

    def persona(name: str) -> Column:
        out = x[name].withField("traits", en(x[name]["traits"]))
        for field in PERSONA_TEXTS:
            out = out.withField(field, en(x[name][field]))
        return out

    experience = x.withField("persona1", persona("persona1")).withField("persona2", persona("persona2"))
    for field in SCENE_TEXTS:
        experience = experience.withField(field, en(x[field]))
    parts = F.transform("chat_parts", lambda p: F.struct(p["sender"].alias("sender"), F.transform(p["messages"], wrap_message).alias("messages")))
    return chats.withColumn("experience", experience).withColumn("chat_parts", parts)


def gather(chats: DataFrame, id_col: str = "chat_id") -> DataFrame:
    """The English texts of wrapped chats as rows: id, ``kind``, ``field``, ``idx1``, ``idx2``, ``text``."""
    x = F.col("experience")
    none = F.lit(-1)
    item = lambda kind, field, i, j, text: F.struct(F.lit(kind).alias("kind"), F.lit(field).alias("field"), i.cast("int").alias("idx1"), j.cast("int").alias("idx2"), text.alias("text"))
    lists = []
    traits = lambda name: F.transform(x[name]["traits"][SOURCE], lambda t, i: item(name, "traits", i, none, t))
    for name in ("persona1", "persona2"):
        lists.append(traits(name))
        lists.append(F.array(*[item(name, f, none, none, x[name][f][SOURCE]) for f in PERSONA_TEXTS]))
    lists.append(F.array(*[item("scene", f, none, none, x[f][SOURCE]) for f in SCENE_TEXTS]))
    lists.append(F.flatten(F.transform("chat_parts", lambda p, i: F.filter(F.transform(p["messages"], lambda m, j: F.when(F.map_contains_key(m, SOURCE), item("message", "messages", i, j, m[SOURCE]))), lambda r: r.isNotNull()))))
    lists = [F.coalesce(a, F.array().cast("array<struct<kind:string,field:string,idx1:int,idx2:int,text:string>>")) for a in lists]
    return chats.select(id_col, F.explode(F.concat(*lists)).alias("w")).select(id_col, "w.*")


def translatable(text: Column) -> Column:
    """Not null, not blank, and not a tag after blanks; other texts pass as they are."""
    s = strip(text)
    return F.coalesce((s != "") & ~F.startswith(s, F.lit("<")), F.lit(False))


class Translator(Protocol):
    """A translation model: texts in, as many texts out, in order."""

    def __call__(self, texts: list[str], language: str) -> list[str]: ...


class PromptTranslator:
    """A translator that asks a chat model: a prompt for each text, in the model's own template, all of a language in one call.

    ``complete`` takes finished prompts and gives as many answers; ``template`` turns messages (role, content) into a prompt.
    """

    def __init__(self, complete: Callable[[list[str]], list[str]], template: Callable[[list[dict]], str] = prompts.chat_template):
        self.complete, self.template = complete, template

    def __call__(self, texts: list[str], language: str) -> list[str]:
        name, own = schemas.LANGUAGES[language]
        asked = [self.template([{"role": "user", "content": prompts.translation_text(t, name, own)}]) for t in texts]
        return [x.strip(BLANKS) for x in self.complete(asked)]


def upper(texts: list[str], language: str) -> list[str]:
    """A translator for tests."""
    return [f"{language}:{t.upper()}" for t in texts]


def translate(items: DataFrame, languages: list[str], translator: Translator) -> DataFrame:
    """Work items for each language with ``language`` and ``translated``; only translatable texts reach the translator, in batches."""
    rows = items.withColumn("language", F.explode(F.array(*[F.lit(x) for x in languages])))
    given, rest = rows.filter(translatable(F.col("text"))), rows.filter(~translatable(F.col("text"))).withColumn("translated", F.col("text"))

    def run(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts, langs = batch.column("text").to_pylist(), batch.column("language").to_pylist()
            out: list = [None] * len(texts)
            for lang in sorted(set(langs)):
                at = [i for i, x in enumerate(langs) if x == lang]
                for i, t in zip(at, translator([texts[i] for i in at], lang), strict=True):
                    out[i] = t
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, "translated"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields), "translated string"])
    return given.mapInArrow(by_value(run), schema).unionByName(rest)


def put(languages: Column, language: Column, value: Column) -> Column:
    """The map with ``value`` for ``language``; an old one is replaced."""
    return F.map_concat(F.map_filter(languages, lambda k, _: k != language), F.create_map(language, value))


def _counts(flags: Column) -> Column:
    """How many of ``flags`` (integers) add up before each place, and in all at the end."""
    return F.aggregate(flags, F.array(F.lit(0)), lambda n, x: F.concat(n, F.array(F.element_at(n, -1) + x)))


def merge_translations(chats: DataFrame, translated: DataFrame, id_col: str = "chat_id") -> DataFrame:
    """Wrapped chats with the translations of all that :func:`gather` gave put back; one join by id.

    A chat's translated messages are one array in order of place, so each is found by counting the English messages before it. Rows of
    one id must be equal (see :func:`with_key`). A chat that misses some of its messages' translations raises.
    """
    texts = translated.groupBy(F.col(id_col).alias("_id"), "kind", "field", "idx1", "idx2").agg(F.array_sort(F.collect_set(F.struct(F.col("language").alias("k"), F.col("translated").alias("v")))).alias("es"))
    said = F.col("kind") == "message"
    by_chat = texts.groupBy("_id").agg(
        F.map_from_entries(F.collect_list(F.when(~said, F.struct(F.concat_ws("/", "kind", "field", "idx1"), F.map_from_entries("es"))))).alias("t"),
        F.array_sort(F.collect_list(F.when(said, F.struct("idx1", "idx2", "es")))).alias("ms"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.transform("es", lambda e: e["k"]))))).alias("langs"))
    rows = chats.join(by_chat, F.col(id_col) == F.col("_id"), "left")
    langs = F.coalesce("langs", F.array().cast("array<string>"))
    at = lambda kind, field, i=F.lit(-1): F.col("t")[F.concat_ws("/", F.lit(kind), F.lit(field), i)]

    def filled(m: Column, new: Column) -> Column:
        return F.when(new.isNull(), m).otherwise(F.map_concat(F.map_filter(m, lambda k, _: ~F.map_contains_key(new, k)), new))

    x = F.col("experience")

    def persona(name: str) -> Column:
        traits = x[name]["traits"]
        made = F.map_from_entries(F.transform(langs, lambda g: F.struct(g, F.transform(traits[SOURCE], lambda _, i: F.coalesce(at(name, "traits", i)[g], F.lit(""))))))
        out = x[name].withField("traits", filled(traits, made))
        for field in PERSONA_TEXTS:
            out = out.withField(field, filled(x[name][field], at(name, field)))
        return out

    experience = x.withField("persona1", persona("persona1")).withField("persona2", persona("persona2"))
    for field in SCENE_TEXTS:
        experience = experience.withField(field, filled(x[field], at("scene", field)))
    english = lambda m: F.map_contains_key(m, SOURCE)
    flags = F.transform("chat_parts", lambda p: F.transform(p["messages"], lambda m: english(m).cast("int")))
    # Counts within each part, and over the parts before it.
    rows = rows.withColumn("_in", F.transform(flags, lambda f: _counts(F.coalesce(f, F.array().cast("array<int>")))))
    rows = rows.withColumn("_before", _counts(F.transform("_in", lambda n: F.element_at(n, -1))))
    place = lambda i, j: F.get("_before", i) + F.get(F.get("_in", i), j)
    put_back = lambda m, i, j: F.when(english(m), filled(m, F.map_from_entries(F.get("ms", place(i, j))["es"]))).otherwise(m)
    parts = F.transform("chat_parts", lambda p, i: F.struct(p["sender"].alias("sender"), F.transform(p["messages"], lambda m, j: put_back(m, i, j)).alias("messages")))
    whole = F.col("ms").isNull() | (F.size("ms") == F.element_at("_before", -1))
    parts = F.when(F.coalesce(whole, F.lit(True)), parts).otherwise(F.raise_error(F.concat(F.lit("translations of messages are missing in "), F.col(id_col).cast("string"))))
    return rows.withColumn("experience", experience).withColumn("chat_parts", parts).drop("_id", "t", "ms", "langs", "_in", "_before")


def with_key(chats: DataFrame) -> DataFrame:
    """``chats`` with ``_key``, a hash of all that is in a row: chats that share an id stay apart, equal ones have equal keys."""
    return chats.withColumn("_key", F.sha2(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}), 256))


def read_chats(spark: SparkSession, path: str) -> DataFrame:
    """Chats of a JSON-lines file, plain or in maps by language, as its first record's background is; lines without an id are left out."""
    lines = spark.read.text(path)
    v = F.try_parse_json("value")
    first = lines.filter(F.startswith(F.ltrim("value"), F.lit("{"))).select(F.schema_of_variant(F.try_variant_get(v, "$.experience.persona1.background", "variant")).alias("k")).first()
    schema = schemas.MULTI_CHAT if first and (first["k"] or "").startswith("OBJECT") else schemas.CHAT
    return lines.select(F.from_json("value", schema).alias("c")).select("c.*").filter("chat_id is not null")


def language_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, *v) for k, v in schemas.LANGUAGES.items()], "code string, name string, native_name string")


def check_languages(codes: list[str]) -> None:
    """Raises for codes that aren't registered."""
    unknown = [c for c in codes if c not in schemas.LANGUAGES]
    if unknown:
        raise ValueError(f"unknown languages: {', '.join(unknown)}")


def conflicts(chats: DataFrame, targets: list[str]) -> list[str]:
    """Targets other than English that the first chat's background or topic already has."""
    x = F.col("experience")
    keys = F.array_union(F.map_keys(x["persona1"]["background"]), F.map_keys(x["topic"]))
    row = chats.limit(1).select(F.array_sort(F.array_except(F.array_intersect(keys, F.array(*[F.lit(t) for t in targets])), F.array(F.lit(SOURCE)))).alias("c")).first()
    return list(row["c"] or []) if row else []


def translate_chats(chats: DataFrame, targets: list[str], translator: Translator, overwrite: bool = False) -> DataFrame:
    """Chats with all texts in all target languages; raises on unknown languages, and on present ones unless ``overwrite``.

    Chats may be plain or in maps by language. They are identified by their content, so repeated ids are no matter.
    """
    check_languages(targets)
    wrapped = with_key(wrap(chats))
    present = conflicts(wrapped, targets)
    if present and not overwrite:
        raise ValueError(f"already translated to {', '.join(present)}")
    items = gather(wrapped.dropDuplicates(["_key"]), "_key")
    return merge_translations(wrapped, translate(items, targets, translator), "_key").drop("_key")
