import pytest
from pyspark.sql import functions as F

from weftline import schemas
from weftline.operators import multilang, rollout, sampling

PERSON = lambda n: (n, None, 30, ["kind", "calm"], "from afar", "short", "m", n)


def experiences(spark, n=3):
    rows = [(PERSON(f"a{i}"), PERSON(f"b{i}"), "friends", f"scene {i}", "tea", f"e{i}") for i in range(n)]
    return spark.createDataFrame(rows, schemas.EXPERIENCE[len("struct<"):-1])


def test_stop_rules(spark):
    rows = [("a", 1, ["x y z w"]), ("a", 2, ["bye <end/>"]), ("a", 3, ["late"]), ("b", 1, ["x"]), ("b", 2, []), ("b", 3, ["y"]), ("c", 1, None), ("d", 1, ["one two three four"]), ("d", 2, ["five six seven eight"]), ("d", 3, ["no"])]
    turns = spark.createDataFrame(rows, "id string, turn int, messages array<string>")
    kept = rollout.stop_turns(turns, "id", "turn", "messages", max_tokens=6).collect()
    assert sorted((r["id"], r["turn"]) for r in kept) == [("a", 1), ("a", 2), ("b", 1), ("d", 1), ("d", 2)]


def test_generated_chats(spark):
    chats = rollout.generate_chats(experiences(spark), rollout.scripted, 7, "org/tiny", pause=0).collect()
    assert len(chats) == 3
    for c in chats:
        senders = [p["sender"] for p in c["chat_parts"]]
        assert c["model"] == "tiny" and senders[0] == c["experience"]["persona1"]["id"] and all(a != b for a, b in zip(senders, senders[1:]))
        assert "<end/>" in c["chat_parts"][-1]["messages"][-1] and len(senders) > 4


def test_translation_round(spark):
    chats = rollout.generate_chats(experiences(spark), rollout.scripted, 7, pause=0).cache()
    out = multilang.translate_chats(chats, ["de", "fr"], multilang.upper).cache()
    row = out.first()
    x = row["experience"]
    assert x["topic"] == {"en": "tea", "de": "de:TEA", "fr": "fr:TEA"} and x["persona1"]["traits"]["de"] == ["de:KIND", "de:CALM"]
    assert set(row["chat_parts"][0]["messages"][0]) == {"en", "de", "fr"}
    with pytest.raises(ValueError):
        multilang.translate_chats(out, ["de"], multilang.upper)
    with pytest.raises(ValueError):
        multilang.translate_chats(chats, ["xx"], multilang.upper)


def test_draws_follow_weights(spark):
    items = spark.createDataFrame([(0, "a", 1), (1, "b", 0), (2, "c", 3)], "pos int, v string, w int")
    draws = spark.range(1000).select(((F.col("id") + 0.5) / 1000).alias("u"))
    got = dict(sampling.weighted_pick(draws, items, "u", "w", ["pos"]).groupBy("v").count().collect())
    assert got == {"a": 250, "c": 750}
    people = spark.createDataFrame([(i, 20 + i % 4) for i in range(12)], "pos int, age int")
    drawn = sampling.draw_pairs(spark.range(300).select("id", ((F.col("id") * 7919 % 307) / 307).alias("u1"), ((F.col("id") * 104729 % 311) / 311).alias("u2")), people, "pos", "age", "u1", "u2").collect()
    assert len(drawn) == 300 and all(r["p1"] < r["p2"] for r in drawn)


def test_language_names_are_joined(spark):
    """J6: codes get their English and own names."""
    codes = spark.createDataFrame([("fi",), ("cs",)], "code string").join(multilang.language_table(spark), "code").orderBy("code")
    assert [(r["name"], r["native_name"]) for r in codes.collect()] == [("Czech", "Čeština"), ("Finnish", "Suomi")]
