"""Chat rollouts: the rules of a turn-by-turn dialogue, replayed over given turns or driven by a generator."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import schemas
from ..functions import prompts, text
from ..sinks.jsonl import overwrite_jsonl
from ..travel import by_value

MAX_TURNS, MAX_TOKENS, OPEN_TURNS = 200, 32_000, 4
END = "<end/>"
_BLANK = "[" + re.escape(text.BLANKS) + "]+"


def stop_turns(turns: DataFrame, id_col: str, turn_col: str, messages_col: str, max_tokens: int = MAX_TOKENS, max_turns: int = MAX_TURNS) -> DataFrame:
    """The turns that a rollout keeps, with ``tokens`` and ``cum_tokens``.

    In order of ``turn_col``: a null turn or one without messages ends the chat and is left out; an end
    tag, or reaching ``max_tokens``, ends it and is kept; no chat has more than ``max_turns``.
    """
    w = Window.partitionBy(id_col).orderBy(turn_col)
    messages = F.col(messages_col)
    rows = turns.withColumn("tokens", F.coalesce(text.token_estimate(messages), F.lit(0))) \
        .withColumn("cum_tokens", F.sum("tokens").over(w.rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumn("_out", messages.isNull() | (F.size(messages) < 1)) \
        .withColumn("_stop", F.col("_out") | F.coalesce(F.contains(F.array_join(messages, " "), F.lit(END)), F.lit(False)) | (F.col("cum_tokens") >= max_tokens)) \
        .withColumn("_before", F.coalesce(F.sum(F.col("_stop").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) \
        .withColumn("_n", F.row_number().over(w))
    return rows.filter((F.col("_before") == 0) & ~F.col("_out") & (F.col("_n") <= max_turns)).drop("_out", "_stop", "_before", "_n")


def parse_turn(content: Column, turn: Column) -> Column:
    """A model's JSON answer as messages, blank ones dropped; null if it isn't such JSON. ``turn`` counts from 1."""
    cleaned = text.drop_premature_end(content, turn, OPEN_TURNS)
    messages = F.from_json(cleaned, schemas.TURN)["messages"]
    return F.filter(messages, lambda m: text.strip(m) != "")


def violations(turns: DataFrame, id_col: str, turn_col: str, sender_col: str) -> DataFrame:
    """``id_col`` and ``violations``: turns whose sender is that of the turn before."""
    w = Window.partitionBy(id_col).orderBy(turn_col)
    same = F.col(sender_col) == F.lag(sender_col).over(w)
    return turns.withColumn("_same", F.coalesce(same.cast("int"), F.lit(0))).groupBy(id_col).agg(F.sum("_same").alias("violations"))


class Generator(Protocol):
    """A language model: JSON text of the given format for a prompt, or an exception."""

    def __call__(self, messages: list[dict], max_tokens: int, temperature: float, response_format: dict) -> str: ...


def scripted(messages: list[dict], max_tokens: int = 512, temperature: float = 0.8, response_format: dict | None = None) -> str:
    """A generator for tests: what it answers depends on the prompt alone."""
    import zlib

    code = zlib.crc32(json.dumps(messages, sort_keys=True).encode())
    if (response_format or {}).get("name") == "scenario":
        return json.dumps({"situation": f"scene {code % 97}", "topic": f"subject {code % 89}"})
    said = messages[-1]["content"].count(": line ") + 1
    return json.dumps({"messages": [f"line {code % 1000}" + (END if said > 4 + code % 5 else "")]})


def _tokens(messages: list[str]) -> int:
    return int(len([w for w in re.split(_BLANK, " ".join(messages)) if w]) * 0.75)


def roll(experience: dict, generate: Generator, now: int, model: str, pause: float = 2.0, max_turns: int = MAX_TURNS, max_tokens: int = MAX_TOKENS) -> dict:
    """One chat: the personas speak in turns, the first one opens, until a stop rule of :func:`stop_turns`."""
    pair = [experience["persona1"], experience["persona2"]]
    parts: list[dict] = []
    total = 0
    for turn in range(1, max_turns + 1):
        me = pair[(turn - 1) % 2]
        try:
            content = generate(prompts.turn_messages(parts, experience, me), 512, 0.8, prompts.TURN_FORMAT)
            if turn <= OPEN_TURNS:
                content = content.replace(END, "")
            messages = [m for m in json.loads(content).get("messages", []) if m.strip(text.BLANKS)]
        except Exception:  # a failed turn ends the chat, which is saved as far as it came
            time.sleep(pause)
            break
        if not messages:
            break
        parts.append({"sender": me["id"], "messages": messages})
        total += _tokens(messages)
        if END in " ".join(messages) or total >= max_tokens:
            break
    return {"chat_id": f"{pair[0]['id']}_{pair[1]['id']}_{now}", "experience": experience, "chat_parts": parts, "model": prompts.short_name(model)}


def generate_chats(experiences: DataFrame, generate: Generator, now: int, model: str = "scripted", pause: float = 2.0, in_flight: int = 10) -> DataFrame:
    """A chat for each experience; a partition has up to ``in_flight`` of them under way at once, each waiting for its own model calls.

    Model calls can't be repeated alike: store the result before using it twice.
    """
    def one(x: str) -> str:
        return json.dumps(roll(json.loads(x), generate, now, model, pause))

    def run(batches) -> Iterator:
        import pyarrow as pa

        with ThreadPoolExecutor(in_flight) as calls:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array(list(calls.map(one, batch.column(0).to_pylist())), pa.string())], names=["chat"])

    given = experiences.select(F.to_json(F.struct(*[F.col(c) for c in ("persona1", "persona2", "relationship", "situation", "topic", "id")]), {"ignoreNullFields": "false"}).alias("x"))
    return given.mapInArrow(by_value(run), "chat string").select(F.from_json("chat", schemas.CHAT).alias("c")).select("c.*")


def generate_scenarios(drawn: DataFrame, prompt_col: str, generate: Generator, in_flight: int = 20, pause: float = 0.0) -> DataFrame:
    """``drawn`` with ``scenario`` (struct of situation and topic; null where the model failed); up to ``in_flight`` calls at once in a partition."""
    def one(prompt) -> str | None:
        try:
            return generate(prompt, 768, 0.8, prompts.SCENARIO_FORMAT)
        except Exception:  # a failed draw is counted out by its null
            time.sleep(pause)
            return None

    def run(batches) -> Iterator:
        import pyarrow as pa

        with ThreadPoolExecutor(in_flight) as calls:
            for batch in batches:
                got = list(calls.map(one, batch.column(batch.num_columns - 1).to_pylist()))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(got, pa.string())], names=[*batch.schema.names[:-1], "_answer"])

    kept = drawn.drop(prompt_col)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields), "_answer string"])
    out = drawn.select(*kept.columns, prompt_col).mapInArrow(by_value(run), schema)
    return out.withColumn("scenario", F.from_json("_answer", schemas.SCENARIO)).drop("_answer")


def grow_pool(seeds: DataFrame, draw: Callable[[DataFrame, DataFrame], DataFrame], target: int, batch: int, output: str, reset_every: int = 100, max_batches: int = 1000) -> DataFrame:
    """Rows drawn in batches until ``target`` succeed; each batch has seeds and earlier rows as its pool.

    ``draw(pool, numbers)`` gives rows like those of ``seeds``, one at most for each of ``numbers`` (column ``n``, counted over the run).
    Numbers that are multiples of ``reset_every`` are drawn with the seeds alone. Each batch is written to ``output`` (JSON lines,
    a folder of its own) before the next is drawn, so nothing is generated twice.
    """
    spark, schema = seeds.sparkSession, seeds.schema
    count = number = 0
    for k in range(max_batches):
        if count >= target:
            break
        pool = seeds if not k else seeds.unionByName(spark.read.schema(schema).json(f"{output}/batch=*"))
        n = min(batch, target - count)
        numbers = spark.range(number, number + n).select(F.col("id").alias("n"))
        alone = (F.col("n") > 0) & (F.col("n") % reset_every == 0)
        rows = draw(pool, numbers.filter(~alone))
        if any(i % reset_every == 0 for i in range(max(1, number), number + n)):
            rows = rows.unionByName(draw(seeds, numbers.filter(alone)))
        overwrite_jsonl(rows, f"{output}/batch={k}")
        count += spark.read.schema(schema).json(f"{output}/batch={k}").count()
        number += n
    return spark.read.schema(schema).json(f"{output}/batch=*") if number else seeds.limit(0)
