"""Generation in two stages: scenarios of drawn personas, then chats of scenarios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import prompts
from ..sinks.jsonl import append_jsonl, write_processed_ids
from ..sources import jsonl
from . import rollout, sampling

# Categories of the vocabulary file, those of places by the placeholder that they fill.
PLACES = {"platform": "online_platforms", "community": "online_communities", "fandom": "fandoms", "gaming": "gaming_contexts"}
TEMPLATES, TRIGGERS = "relationship_types", "conversation_triggers"
# Sizes of a run.
TARGET_SCENARIOS, FLUSH_EVERY, RESET_EVERY, TARGET_CHATS = 950, 50, 100, 1200


def uniform(seed: int, number: Column, what: int) -> Column:
    """In [0, 1), from a hash of the seed, a draw's number and what is drawn."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), number, F.lit(what)), 11).cast("double") / F.lit(float(1 << 53))


def numbered_people(personas: DataFrame, order: list[str]) -> DataFrame:
    """``pos`` (from 0, in ``order``), ``age`` and ``persona`` (struct)."""
    fields = [f.name for f in personas.schema.fields if f.name not in ("file", "line")]
    return personas.select((F.row_number().over(Window.orderBy(*order)) - 1).alias("pos"), "age", F.struct(*fields).alias("persona"))


def draw_scenes(draws: DataFrame, people: DataFrame, vocabulary: DataFrame, pool: DataFrame, seed: int = 0) -> DataFrame:
    """For each draw (``n``): ``persona1``, ``persona2``, ``relationship`` and ``prompt``.

    A pair by likeness of ages, one value of each category by weight, the relationship's placeholder filled, and two different experiences
    of ``pool`` as examples. All come from hashes of the seed and ``n``.
    """
    n = F.col("n")
    pairs = sampling.draw_pairs(draws.select("n", uniform(seed, n, 1).alias("u1"), uniform(seed, n, 2).alias("u2")), people, "pos", "age", "u1", "u2")
    who = lambda k: people.select(F.col("pos").alias(f"_p{k}"), F.col("persona").alias(f"persona{k}"))
    pairs = pairs.join(who(1), F.col("p1") == F.col("_p1")).join(who(2), F.col("p2") == F.col("_p2")).select("n", "persona1", "persona2")
    names = [*PLACES.values(), TEMPLATES, TRIGGERS]
    wanted = draws.select("n", F.explode(F.array(*[F.struct(F.lit(c).alias("category"), uniform(seed, n, 10 + k).alias("u")) for k, c in enumerate(names)])).alias("d")).select("n", "d.*")
    picked = sampling.weighted_pick(wanted, vocabulary, "u", "weight", ["pos"], ["category"])
    said = picked.groupBy("n").agg(F.map_from_entries(F.collect_list(F.struct("category", "value"))).alias("v"))
    h = lambda k: F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("draw"), F.lit(k)), 1)
    shots = sampling.few_shot(draws.select(F.col("n").alias("draw")), pool, "draw", ["id"], h(30), h(31))
    example = F.struct("n", F.struct("persona1", "persona2", "relationship", "situation", "topic").alias("x"))
    shown = shots.groupBy(F.col("draw").alias("_draw")).agg(F.array_sort(F.collect_list(example), lambda a, b: a["n"] - b["n"]).alias("e")).select("_draw", F.transform("e", lambda e: e["x"]).alias("examples"))
    rows = pairs.join(said, "n").join(shown, F.col("n") == F.col("_draw"))
    relationship = sampling.resolve_template(F.col("v")[TEMPLATES], {name: F.col("v")[category] for name, category in PLACES.items()})
    rows = rows.withColumn("relationship", relationship)
    prompt = prompts.scenario_prompt(F.col("persona1"), F.col("persona2"), F.col("relationship"), F.col("v")[TRIGGERS], prompts.example_block(F.col("examples")))
    return rows.select("n", "persona1", "persona2", "relationship", prompt.alias("prompt"))


def generate_experiences(personas: DataFrame, seeds: DataFrame, vocabulary: DataFrame, generate: rollout.Generator, output: str, target: int = TARGET_SCENARIOS, batch: int = FLUSH_EVERY, reset_every: int = RESET_EVERY, seed: int = 0, order: list[str] | None = None) -> DataFrame:
    """Experiences of drawn personas in ``output`` (JSON lines, a folder for each batch), until ``target`` succeeded; returns them.

    Each batch is written before the next is drawn, and takes its examples from seeds and batches before it; draws whose number
    is a multiple of ``reset_every`` see the seeds alone, against drift. Draws of which the model gives no scenario are left out and
    others drawn instead. Raises with fewer than two personas or without seeds.
    """
    jsonl.require_rows(personas, 2, "personas")
    jsonl.require_rows(seeds, 1, "seed experiences")
    people = numbered_people(personas, order or ["id"]).persist()
    pool = seeds.select(*EXPERIENCE)

    def draw(examples: DataFrame, numbers: DataFrame) -> DataFrame:
        drawn = draw_scenes(numbers, people, vocabulary, examples, seed)
        made = rollout.generate_scenarios(drawn, "prompt", generate).filter("scenario.situation is not null and scenario.topic is not null")
        return made.select("persona1", "persona2", "relationship", "scenario.situation", "scenario.topic", prompts.new_id().alias("id"))

    return rollout.grow_pool(pool, draw, target, batch, output, reset_every)


EXPERIENCE = ["persona1", "persona2", "relationship", "situation", "topic", "id"]


def generate_pending_chats(spark: SparkSession, experiences: list[str], processed: str, output: str, generate: rollout.Generator, now: int, model: str, target: int = TARGET_CHATS, batch: int = FLUSH_EVERY, pause: float = 2.0) -> int:
    """Chats of the first ``target`` experiences (in order of file and line) that weren't processed before; returns how many.

    After each batch the chats are appended to ``output`` and then the ids to ``processed``, so a run that breaks off goes on where it
    stopped, with at most one batch's chats written twice.
    """
    done = jsonl.read_processed_ids(spark, processed)
    waiting = sampling.unprocessed(jsonl.read_experiences(spark, experiences), done)
    chosen = sampling.prefix(waiting, target, "file_no", "line").persist()
    count = chosen.count()
    ids = [r["id"] for r in done.collect()]  # ids alone, of at most some runs' targets
    for i in range(0, count, batch):
        part = chosen.orderBy("file_no", "line").offset(i).limit(batch)
        chats = rollout.generate_chats(part, generate, now, model, pause).persist()
        append_jsonl(chats, output)
        ids += [r["id"] for r in chats.select("experience.id").collect()]
        chats.unpersist()
        write_processed_ids(spark.createDataFrame([(x,) for x in ids], "id string"), processed)
    chosen.unpersist()
    return count
