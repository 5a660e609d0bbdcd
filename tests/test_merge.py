import json

from weftline.operators import merge
from weftline.streaming.merge import stream_merge


def chat(chat_id, turns):
    person = lambda n: {"name": n, "username": None, "age": 30, "traits": [], "background": "", "chatting_style": "", "model": "m", "id": n}
    return {"chat_id": chat_id, "experience": {"persona1": person("Ann"), "persona2": person("Bob"), "relationship": "r", "situation": "s", "topic": "t", "id": "e"},
            "chat_parts": [{"sender": "Ann", "messages": ["Ann: hi <delay/> x"]}] * turns, "model": "m"}


def write(folder):
    folder.mkdir(parents=True, exist_ok=True)
    a = [json.dumps(chat(*x)) for x in (("k", 0), ("k", 3), ("k", 0), ("k", 4), ("one", 1), (None, 2))]
    (folder / "chats_a.jsonl").write_text("\n".join([*a, "", "[1]", "not json"]) + "\n")
    (folder / "chats_b.jsonl").write_text(json.dumps(chat("k", 5)) + "\n" + json.dumps(chat("z", 2)) + "\n")


def test_merge_files(spark, tmp_path):
    write(tmp_path / "in")
    out = str(tmp_path / "out")
    got = merge.merge_files(spark, f"{tmp_path}/in/chats_*.jsonl", out, shuffle=False).first().asDict()
    assert got == {"files": 2, "lines": 11, "written": 2, "duplicate": 3, "empty": 2, "malformed": 3, "error": 1}
    rows = {r["chat_id"]: r for r in spark.read.json(out).collect()}
    assert set(rows) == {"k", "z"} and len(rows["k"]["chat_parts"]) == 3
    assert rows["k"]["chat_parts"][0]["messages"] == ["hi", "<delay/>", "x"]


def test_stream_is_the_batch(spark, tmp_path):
    write(tmp_path / "in")
    run = lambda: stream_merge(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"), str(tmp_path / "ids")).awaitTermination()
    run()
    (tmp_path / "in" / "chats_c.jsonl").write_text(json.dumps(chat("z", 9)) + "\n" + json.dumps(chat("new", 2)) + "\n")
    run()
    assert sorted(r["chat_id"] for r in spark.read.json(str(tmp_path / "out")).collect()) == ["k", "new", "z"]


def test_ids_and_messages_keep_their_types(spark, tmp_path):
    """What isn't a string stays as it is in the merged file; 5 and "5" are two chats."""
    odd = chat("q", 2)
    odd["chat_parts"][0]["messages"] = ["Ann: a", None, 7, {"k": [1]}, "<delay/>b"]
    rows = [odd, chat(5, 2), chat("5", 2), chat(5, 3), chat(["list"], 2)]
    (tmp_path / "chats_a.jsonl").write_text("\n".join(map(json.dumps, rows)) + "\n")
    got = merge.merge_files(spark, f"{tmp_path}/chats_*.jsonl", str(tmp_path / "out"), shuffle=False).first()
    assert (got["written"], got["duplicate"], got["error"]) == (3, 1, 1)
    out = [json.loads(x["value"]) for x in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(str(type(x["chat_id"])) for x in out) == ["<class 'int'>", "<class 'str'>", "<class 'str'>"]
    assert next(x for x in out if x["chat_id"] == "q")["chat_parts"][0]["messages"] == ["a", None, 7, {"k": [1]}, "<delay/>", "b"]


def test_shuffle_keeps_the_chats(spark, tmp_path):
    """R4: another order for another seed, the same rows."""
    (tmp_path / "chats_a.jsonl").write_text("\n".join(json.dumps(chat(f"c{i}", 2)) for i in range(60)) + "\n")
    orders = []
    for seed in (1, 2):
        out = str(tmp_path / f"out{seed}")
        merge.merge_files(spark, f"{tmp_path}/chats_*.jsonl", out, seed=seed)
        orders.append([json.loads(r["value"])["chat_id"] for f in sorted((tmp_path / f"out{seed}").glob("part-*")) for r in spark.read.text(str(f)).collect()])
    assert orders[0] != orders[1] and sorted(orders[0]) == sorted(orders[1]) and len(orders[0]) == 60


def test_lines_of_large_files_keep_their_order(spark, tmp_path):
    """Without whole files, lines of many blocks are still in order."""
    from weftline.sources.jsonl import read_lines

    (tmp_path / "big.txt").write_text("".join(f"line {i} {'x' * 200}\n" for i in range(3000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        got = [r["value"] for r in read_lines(spark, str(tmp_path / "big.txt"), whole=False).orderBy("file", "line").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [int(x.split()[1]) for x in got] == list(range(3000))


def test_lines_are_parsed_once(spark):
    """For the aggregation of first places and for what is joined with it; filters above don't parse again."""
    from weftline.plans import catalog

    plan = catalog.queries()["merge_odd"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") <= 3 and plan.count("Join ") == 1
