"""Small tables that hold what breaks operators."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "river stone light winter garden bridge paper market silver window letter morning forest shadow music engine harbor lantern copper meadow".split()


def prose(seed: int, n: int, words=WORDS) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))


def odd_rows():
    """Null in any column, empty, blank, very long, repeated, tied and non-ASCII rows."""
    long = prose(1, 30_000)
    return [
        (None, "no id here at all", "en", "a", 1), (None, None, None, None, None), (1, None, "en", "a", 0), (2, "", "de", "a", 0),
        (3, " \t\n ", None, "b", 3), (4, long, "en", None, len(long)), (5, "same text twice in a row", "en", "b", 9), (5, "same text twice in a row", "en", "b", 9),
        (6, "same text twice in a row", "en", "b", 9), (7, "Ünïcödé täxt 漢字 \U0001f600 mixed", "fr", "é", 9), (8, "123 456 !!", "en", "c", 9), (9, "x", "en", "c", 1),
    ]


def docs(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema).repartition(3)


def clashing(df):
    """``df`` with columns that are called as operators call theirs."""
    from pyspark.sql import functions as F

    for name in ("row", "_row", "_kept", "_text", "_b", "_r", "_j", "_copies", "size", "shard", "slot", "score", "predicted", "lang_pred", "fp", "z", "bucket", "component_id", "key", "p", "copies", "_src", "target", "class_id", "prints"):
        df = df.withColumn(name, F.lit(name))
    return df
