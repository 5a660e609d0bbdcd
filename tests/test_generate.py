"""Sources, sinks and the generation commands, end to end on files."""

import json

import pytest

from weftline import cli, schemas
from weftline.functions import prompts
from weftline.operators import generate, multilang, rollout
from weftline.sinks import jsonl as sinks
from weftline.sources import jsonl


def person(k, **more):
    return {"name": f"P{k}", "username": None, "age": 20 + k % 5, "traits": ["calm"], "background": "b", "chatting_style": "s", "model": "m", "id": f"p{k}"} | more


def experience(k, **more):
    return {"persona1": person(2 * k), "persona2": person(2 * k + 1), "relationship": "r", "situation": "s", "topic": f"t{k}", "id": f"e{k}"} | more


def lines(path, rows):
    path.write_text("".join((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in rows))
    return str(path)


def vocabulary(path):
    words = {c: [{"value": f"{c} {i}", "weight": i} for i in range(3)] for c in [*generate.PLACES.values(), generate.TRIGGERS]}
    words[generate.TEMPLATES] = [{"value": "met on {platform}", "weight": 2}, {"value": "friends", "weight": 1}]
    path.write_text(json.dumps(words))
    return str(path)


def test_sources(spark, tmp_path):
    """S1 to S6: bad lines are skipped, missing fields raise where the reader is strict, files come in the order given."""
    people = lines(tmp_path / "people.jsonl", [person(0), "", "no json", person(1)])
    assert [r["name"] for r in jsonl.read_personas(spark, people).orderBy("line").collect()] == ["P0", "P1"]
    short = lines(tmp_path / "short.jsonl", [person(0), {"name": "x"}])
    with pytest.raises(Exception, match="missing field in line 2"):
        jsonl.read_personas(spark, short).collect()
    with pytest.raises(Exception):
        jsonl.read_personas(spark, str(tmp_path / "none.jsonl")).collect()
    seeds = jsonl.read_seed_experiences(spark, lines(tmp_path / "seeds.jsonl", [{k: v for k, v in experience(0).items() if k != "id"}, experience(1)])).cache().orderBy("line").collect()
    assert len(seeds[0]["id"]) == 32 and seeds[1]["id"] == "e1"
    a, b = lines(tmp_path / "a.jsonl", [experience(5), {"id": "x"}]), lines(tmp_path / "b.jsonl", [experience(6)])
    found = jsonl.read_experiences(spark, [b, str(tmp_path / "missing.jsonl"), a]).orderBy("file_no", "line").collect()
    assert [r["id"] for r in found] == ["e6", "e5"] and jsonl.read_experiences(spark, []).count() == 0
    words = jsonl.read_vocabulary(spark, vocabulary(tmp_path / "v.json"))
    assert words.count() == 17 and words.filter("category = 'fandoms' and pos = 2").first()["weight"] == 2
    (tmp_path / "broken.json").write_text("{nope")
    with pytest.raises(Exception):
        jsonl.read_vocabulary(spark, str(tmp_path / "broken.json")).collect()
    sinks.publish(jsonl.read_personas(spark, people), str(tmp_path / "set"))
    assert jsonl.read_dataset(spark, str(tmp_path / "set")).count() == jsonl.choose_personas(spark, "", str(tmp_path / "set")).count() == 2
    assert jsonl.choose_personas(spark, people, "unused").count() == 2


def test_guards_ids_and_newest(spark, tmp_path):
    """S8 to S10, K4, K8."""
    assert jsonl.read_processed_ids(spark, str(tmp_path / "none.json")).count() == 0
    ids = str(tmp_path / "ids.json")
    sinks.write_processed_ids(spark.createDataFrame([("b",), ("a",), ("b",)], "id string"), ids)
    assert sorted(r["id"] for r in jsonl.read_processed_ids(spark, ids).collect()) == ["a", "b"]
    (tmp_path / "bad.json").write_text("{nope")
    assert jsonl.read_processed_ids(spark, str(tmp_path / "bad.json")).count() == 0
    with pytest.raises(ValueError, match="at least 2"):
        jsonl.require_rows(spark.range(1), 2, "personas")
    jsonl.require_rows(spark.range(2), 2, "personas")
    assert jsonl.newest_file(spark, str(tmp_path / "merged_*")) is None
    import os

    for k, name in enumerate(("merged_b.jsonl", "merged_a.jsonl")):
        os.utime(lines(tmp_path / name, [{"k": k}]), (1000 + k, 1000 + k))
    assert jsonl.newest_file(spark, f"{tmp_path}/merged_*").endswith("merged_a.jsonl")
    sinks.publish_newest(spark, f"{tmp_path}/merged_*", str(tmp_path / "pub"))
    assert spark.read.json(str(tmp_path / "pub" / "data.jsonl")).first()["k"] == 1
    with pytest.raises(FileNotFoundError):
        sinks.publish_newest(spark, f"{tmp_path}/nothing_*", str(tmp_path / "pub"))


def test_appended_nulls_are_kept(spark, tmp_path):
    """K1, K2: records are added, a null field keeps its key."""
    for k in (1, None):
        sinks.append_jsonl(spark.createDataFrame([(k,)], "k int"), str(tmp_path / "out"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()) == ['{"k":1}', '{"k":null}']


def test_experiences_command(spark, tmp_path):
    """Draws, prompts, batches, pool and target, with a model that fails at times."""
    people, seeds = lines(tmp_path / "people.jsonl", [person(k) for k in range(8)]), lines(tmp_path / "seeds.jsonl", [experience(90), experience(91)])
    out = str(tmp_path / "made")
    made = generate.generate_experiences(jsonl.read_personas(spark, people), jsonl.read_seed_experiences(spark, seeds), jsonl.read_vocabulary(spark, vocabulary(tmp_path / "v.json")), flaky, out, target=11, batch=4, reset_every=5)
    rows = made.collect()
    assert len(rows) == 11 and len({r["id"] for r in rows}) == 11
    for r in rows:
        assert int(r["persona1"]["name"][1:]) < int(r["persona2"]["name"][1:]) and r["relationship"] in ("friends", "met on online_platforms 1", "met on online_platforms 2") and r["situation"].startswith("scene")
    assert len(list((tmp_path / "made").glob("batch=*"))) >= 3
    with pytest.raises(ValueError):
        generate.generate_experiences(jsonl.read_personas(spark, people).limit(1), jsonl.read_seed_experiences(spark, seeds), jsonl.read_vocabulary(spark, vocabulary(tmp_path / "v.json")), flaky, out)
    cli.main(["experiences", "--personas", people, "--seeds", seeds, "--vocabulary", vocabulary(tmp_path / "v.json"), "--target", "3", "-o", str(tmp_path / "cli")], spark)
    assert spark.read.json(str(tmp_path / "cli") + "/batch=*").count() == 3


def flaky(messages, max_tokens, temperature, response_format):
    """A model that answers every third prompt by nonsense and another by an error; it expects whole prompts."""
    body = messages[1]["content"]
    assert response_format is not None and (max_tokens, temperature) == (768, 0.8) and body.count("Reference") == 2 and "Spark:" in body and '"id"' not in body
    code = sum(map(ord, body.partition("First:")[2])) % 3
    if code == 0:
        raise RuntimeError("busy")
    return rollout.scripted(messages, response_format=response_format) if code == 1 else "no json"


def test_scenes_see_the_right_pool(spark, tmp_path):
    """T7: numbers that are multiples of the reset see the seeds alone, others earlier rows too."""
    calls = []

    def draw(pool, numbers):
        ns, known = sorted(r["n"] for r in numbers.collect()), pool.count()
        calls.append((ns, known))
        return spark.createDataFrame([(n,) for n in ns], "v long")

    out = rollout.grow_pool(spark.createDataFrame([(-1,)], "v long"), draw, 10, 4, str(tmp_path / "pool"), reset_every=3)
    assert sorted(r["v"] for r in out.collect()) == list(range(10))
    assert calls == [([0, 1, 2], 1), ([3], 1), ([4, 5, 7], 5), ([6], 1), ([8], 9), ([9], 1)]


def test_chats_command(spark, tmp_path):
    """First the target, then the rest; ids are kept after each batch; a third run has nothing to do."""
    files = [lines(tmp_path / "a.jsonl", [experience(0), experience(1), experience(2)]), lines(tmp_path / "b.jsonl", [experience(3), experience(4)])]
    run = lambda n: generate.generate_pending_chats(spark, files, str(tmp_path / "done"), str(tmp_path / "chats"), rollout.scripted, 7, "org/tiny", n, batch=2, pause=0)
    assert run(3) == 3
    chats = lambda: sorted(r["experience"]["id"] for r in spark.read.json(str(tmp_path / "chats")).collect())
    assert chats() == ["e0", "e1", "e2"]
    assert run(100) == 2 and chats() == [f"e{k}" for k in range(5)] and run(100) == 0
    cli.main(["chats", *files, "--processed", str(tmp_path / "done2"), "-o", str(tmp_path / "cli"), "--target", "1"], spark)
    assert spark.read.json(str(tmp_path / "cli")).first()["chat_id"].startswith("p0_p1_")


def test_turn_prompt_is_the_same_in_a_plan(spark):
    """The prompt that the rollout makes turn by turn is that of the column expression."""
    from pyspark.sql import functions as F

    x = experience(1)
    chat = {"chat_id": "c", "experience": x, "chat_parts": [{"sender": "p2", "messages": ["hi", "you?"]}, {"sender": "p3", "messages": ["yes"]}], "model": "m"}
    df = spark.createDataFrame([(json.dumps(chat),)], "j string").select(F.from_json("j", schemas.CHAT).alias("c")).select("c.*")
    got = df.select(prompts.turn_prompt(F.col("chat_parts"), F.col("experience"), F.col("experience.persona1")).alias("p")).first()["p"]
    want = prompts.turn_messages(chat["chat_parts"], x, x["persona1"])
    assert [m.asDict() for m in got] == want and "P2: hi\nP2: you?\nP3: yes" in want[1]["content"] and '"username"' not in want[1]["content"]


def test_failing_turns_end_a_chat():
    """T2: a failure or an empty answer ends the chat with what came before; calls are told the format."""
    said = iter(['{"messages": ["a"]}', '{"messages": [" ", "b<end/>"]}', "no json"])
    chat = rollout.roll(experience(0), lambda m, n, t, f: next(said), 7, "org/tiny", pause=0)
    assert [p["messages"] for p in chat["chat_parts"]] == [["a"], ["b"]] and chat["chat_id"] == "p0_p1_7" and chat["model"] == "tiny"
    assert rollout.roll(experience(0), lambda m, n, t, f: '{"messages": []}', 7, "m")["chat_parts"] == []


def test_calls_run_at_once(spark):
    """T6: a partition has several calls under way."""
    import time

    def slow(messages, max_tokens, temperature, response_format):
        import time
        time.sleep(0.5)
        raise RuntimeError

    rows = spark.createDataFrame([([{"role": "user", "content": str(k)}],) for k in range(20)], "prompt array<map<string,string>>").coalesce(1)
    began = time.time()
    assert rollout.generate_scenarios(rows, "prompt", slow).filter("scenario is null").count() == 20
    assert time.time() - began < 8  # one after the other: 10


def test_translate_command(spark, tmp_path, capsys):
    """Plain files, files that are in maps already, conflicts, and a model asked by prompts in its own template."""
    chats = [{"chat_id": "same", "experience": experience(k), "chat_parts": [{"sender": "p0", "messages": [f"hi {k}", "<gif>x</gif>"]}], "model": "m"} for k in (0, 1, 1)]
    source, first, second = lines(tmp_path / "c.jsonl", chats), str(tmp_path / "de"), str(tmp_path / "fi")
    cli.main(["translate", source, first, "--languages", "de"], spark)
    cli.main(["translate", first, second, "--languages", "fi,da"], spark)
    rows = sorted((r["experience"]["topic"]["fi"], r["chat_parts"][0]["messages"][0]["de"], sorted(r["chat_parts"][0]["messages"][0])) for r in multilang.read_chats(spark, second).collect())
    assert rows == [("fi:T0", "de:HI 0", ["da", "de", "en", "fi"])] + [("fi:T1", "de:HI 1", ["da", "de", "en", "fi"])] * 2
    with pytest.raises(ValueError, match="already translated to de"):
        cli.main(["translate", first, str(tmp_path / "x"), "--languages", "de"], spark)
    cli.main(["translate", "--list-languages"], spark)
    assert set("da no fi cs hu".split()) <= {x.split()[0] for x in capsys.readouterr().out.splitlines() if x}
    model = multilang.PromptTranslator(lambda asked: [f" {x.splitlines()[-1]} {'Suomi' in x} " for x in asked], lambda m: m[0]["content"])
    out = multilang.translate_chats(multilang.read_chats(spark, source), ["fi"], model)
    assert {r["experience"]["topic"]["fi"] for r in out.collect()} == {"t0 True", "t1 True"}


def test_generation_goes_on_where_it_stopped(spark, tmp_path):
    """K6, T10: a stream makes each record once, over restarts."""
    from weftline.streaming.merge import stream_generate

    (tmp_path / "in").mkdir()
    run = lambda: stream_generate(spark, str(tmp_path / "in"), schemas.EXPERIENCE, str(tmp_path / "out"), str(tmp_path / "cp"), lambda part: rollout.generate_chats(part, rollout.scripted, 7, pause=0)).awaitTermination()
    for name, ks in (("a", (0, 1)), ("b", (2,))):
        lines(tmp_path / "in" / f"{name}.jsonl", [experience(k) for k in ks])
        run()
    run()
    assert sorted(r["experience"]["id"] for r in spark.read.json(str(tmp_path / "out")).collect()) == ["e0", "e1", "e2"]
