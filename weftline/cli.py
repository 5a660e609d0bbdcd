"""Commands: generate experiences and chats, merge chat files, translate chats, publish the newest file."""

from __future__ import annotations

import argparse
import time

from pyspark.sql import SparkSession

from . import schemas
from .operators import generate, merge, multilang, rollout
from .functions.prompts import short_name
from .sinks.jsonl import overwrite_jsonl, publish_newest
from .sources import jsonl


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="weftline")
    commands = top.add_subparsers(dest="command", required=True)
    m = commands.add_parser("merge", help="merge, clean and deduplicate chat files")
    m.add_argument("--input-pattern", default="data/chats/chats_*.jsonl")
    m.add_argument("-o", "--output")
    m.add_argument("--no-shuffle", action="store_true")
    m.add_argument("--seed", type=int, default=0)
    m.add_argument("--debug", action="store_true", help="print the plan's report by status")
    t = commands.add_parser("translate", help="add languages to chats")
    t.add_argument("source", nargs="?")
    t.add_argument("target", nargs="?")
    t.add_argument("--languages", default="de", help="comma-separated codes")
    t.add_argument("--overwrite", action="store_true")
    t.add_argument("--list-languages", action="store_true")
    p = commands.add_parser("publish", help="write the newest merged file to a folder")
    p.add_argument("target")
    p.add_argument("--file-path")
    p.add_argument("--pattern", default="data/chats/merged_*.jsonl")
    e = commands.add_parser("experiences", help="draw personas and generate their scenarios")
    e.add_argument("--personas", default="", help="a JSON-lines file; without it the dataset is read")
    e.add_argument("--dataset", default="data/personas")
    e.add_argument("--seeds", default="data/seed/experiences.jsonl")
    e.add_argument("--vocabulary", default="data/seed/experience_components.json")
    e.add_argument("-o", "--output")
    e.add_argument("--target", type=int, default=generate.TARGET_SCENARIOS)
    e.add_argument("--seed", type=int, default=0)
    e.add_argument("--model", default="scripted")
    c = commands.add_parser("chats", help="generate chats of experiences that have none yet")
    c.add_argument("experiences", nargs="+")
    c.add_argument("--processed", default="data/chats/processed_experiences.json")
    c.add_argument("-o", "--output")
    c.add_argument("--target", type=int, default=generate.TARGET_CHATS)
    c.add_argument("--model", default="scripted")
    return top


def main(args: list[str] | None = None, spark: SparkSession | None = None, translator: multilang.Translator = multilang.upper, generator: rollout.Generator = rollout.scripted) -> int:
    a = parser().parse_args(args)
    if a.command == "translate" and a.list_languages:
        for code, (name, own) in schemas.LANGUAGES.items():
            print(code, name, own)
        return 0
    spark = spark or SparkSession.builder.appName("weftline").getOrCreate()
    if a.command == "merge":
        out = a.output or f"data/chats/merged_{int(time.time())}.jsonl"
        for key, n in merge.merge_files(spark, a.input_pattern, out, not a.no_shuffle, a.seed).first().asDict().items():
            print(f"{key}: {n}")
    elif a.command == "translate":
        if not a.source or not a.target:
            raise SystemExit("a source and a target are needed")
        chats = multilang.read_chats(spark, a.source)
        if chats.isEmpty():
            print("the source is empty")
            return 0
        overwrite_jsonl(multilang.translate_chats(chats, a.languages.split(","), translator, a.overwrite), a.target)
    elif a.command == "experiences":
        now = int(time.time())
        personas = jsonl.choose_personas(spark, a.personas, a.dataset)
        order = ["file", "line"] if a.personas else ["id"]
        out = a.output or f"data/experiences/experiences_{short_name(a.model)}_{now}.jsonl"
        made = generate.generate_experiences(personas, jsonl.read_seed_experiences(spark, a.seeds), jsonl.read_vocabulary(spark, a.vocabulary), generator, out, a.target, seed=a.seed, order=order)
        print(f"{made.count()} experiences in {out}")
    elif a.command == "chats":
        now = int(time.time())
        out = a.output or f"data/chats/chats_{short_name(a.model)}_{now}.jsonl"
        print(f"{generate.generate_pending_chats(spark, a.experiences, a.processed, out, generator, now, a.model, a.target)} chats in {out}")
    else:
        print(publish_newest(spark, a.pattern, a.target, a.file_path))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
