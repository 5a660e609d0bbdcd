"""Weighted draws, persona pairs and few-shot picks as relational operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def cumulative(items: DataFrame, weight_col: str, order: list[str], by: list[str] | None = None) -> DataFrame:
    """``items`` with ``lo``, ``hi`` (half-open share of the running weight) and ``total``, within ``by``."""
    w = Window.partitionBy(*[F.col(c) for c in by or []]) if by else Window.partitionBy(F.lit(0))
    running = w.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    hi = F.sum(weight_col).over(running)
    return items.withColumn("hi", hi).withColumn("lo", F.col("hi") - F.col(weight_col)).withColumn("total", F.sum(weight_col).over(w))


def weighted_pick(draws: DataFrame, items: DataFrame, u_col: str, weight_col: str, order: list[str], by: list[str] | None = None) -> DataFrame:
    """Each draw with the item whose share of the weights holds its ``u`` in [0, 1); weight 0 is never picked.

    Items are bucketed along the line of weights, so a draw is compared only with those of its bucket
    (an equi-join), not with all.
    """
    bins = max(64, items.count())  # so that a cell holds about one item
    ranged = cumulative(items, weight_col, order, by).filter(F.col(weight_col) > 0)
    cell = lambda x: F.floor(x * bins / F.col("total")).cast("int")
    ranged = ranged.withColumn("_cell", F.explode(F.sequence(cell(F.col("lo")), F.least(cell(F.col("hi")), F.lit(bins - 1)))))
    on = [*(by or []), "_cell"]
    placed = draws.withColumn("_cell", F.least(F.floor(F.col(u_col) * bins), F.lit(bins - 1)).cast("int"))
    joined = placed.join(ranged, on)
    at = F.col(u_col) * F.col("total")
    return joined.filter((at >= F.col("lo")) & (at < F.col("hi"))).drop("_cell", "lo", "hi", "total")


def age_weight(age1: Column, age2: Column, strength: float = 2.0) -> Column:
    """Falls with the difference of ages: (1 / (difference + 1)) ** strength."""
    return F.pow(F.lit(1.0) / (F.abs(age1 - age2) + 1), F.lit(float(strength)))


def weighted_pairs(people: DataFrame, pos_col: str, age_col: str, strength: float = 2.0) -> DataFrame:
    """Every pair of ``people`` (the one of lower position first) with its weight: n (n - 1) / 2 rows, for pools of some thousands."""
    a, b = people.alias("a"), people.alias("b")
    return a.join(b, F.col(f"a.{pos_col}") < F.col(f"b.{pos_col}")).select(
        F.struct("a.*").alias("p1"), F.struct("b.*").alias("p2"), age_weight(F.col(f"a.{age_col}"), F.col(f"b.{age_col}"), strength).alias("weight"))


def pair_classes(people: DataFrame, age_col: str, strength: float = 2.0) -> DataFrame:
    """``age1`` <= ``age2``, ``pairs`` and ``mass`` (pairs times weight) of every pair of ages.

    A pair's weight depends on its ages alone, so pools of any size are drawn from in two steps: a
    class by mass, then a pair within it. Rows grow with the square of distinct ages only.
    """
    ages = people.groupBy(F.col(age_col).alias("age")).agg(F.count("*").alias("n"))
    a, b = ages.select(F.col("age").alias("age1"), F.col("n").alias("n1")), ages.select(F.col("age").alias("age2"), F.col("n").alias("n2"))
    pairs = F.when(F.col("age1") == F.col("age2"), F.expr("n1 * (n1 - 1) div 2")).otherwise(F.col("n1") * F.col("n2"))
    out = a.join(b, F.col("age1") <= F.col("age2")).withColumn("pairs", pairs).filter("pairs > 0")
    return out.select("age1", "age2", "pairs", (F.col("pairs") * age_weight(F.col("age1"), F.col("age2"), strength)).alias("mass"))


def draw_pairs(draws: DataFrame, people: DataFrame, pos_col: str, age_col: str, u1: str, u2: str, strength: float = 2.0) -> DataFrame:
    """Each draw with positions ``p1`` < ``p2``: a class of ages by ``u1``, a pair in it by ``u2``, the same odds as over all pairs."""
    classes = pair_classes(people, age_col, strength)
    picked = weighted_pick(draws, classes, u1, "mass", ["age1", "age2"])
    w = Window.partitionBy(age_col)
    ranked = people.select(F.col(pos_col).alias("pos"), F.col(age_col).alias("age"), (F.row_number().over(w.orderBy(pos_col)) - 1).alias("k"), F.count("*").over(w).alias("n"))
    k = F.least(F.floor(F.col(u2) * F.col("pairs")), F.col("pairs") - 1).cast("long")
    sized = picked.withColumn("k", k).join(ranked.groupBy("age").agg(F.max("n").alias("n2")).withColumnRenamed("age", "_g"), F.col("age2") == F.col("_g")).drop("_g")
    same = F.col("age1") == F.col("age2")
    # Within one age: pair k of the triangle i < j, by its larger member.
    j = F.floor((F.lit(1.0) + F.sqrt(F.lit(8.0) * F.col("k") + F.lit(1.0))) / 2).cast("long")
    i = F.col("k") - F.expr("j * (j - 1) div 2")
    sized = sized.withColumn("j", j).withColumn("ka", F.when(same, i).otherwise(F.expr("k div n2"))).withColumn("kb", F.when(same, F.col("j")).otherwise(F.col("k") % F.col("n2")))
    a = ranked.select(F.col("age").alias("_a"), F.col("k").alias("_ka"), F.col("pos").alias("pa"))
    b = ranked.select(F.col("age").alias("_b"), F.col("k").alias("_kb"), F.col("pos").alias("pb"))
    out = sized.join(a, (F.col("age1") == F.col("_a")) & (F.col("ka") == F.col("_ka"))).join(b, (F.col("age2") == F.col("_b")) & (F.col("kb") == F.col("_kb")))
    return out.select(*[F.col(c) for c in draws.columns], F.least("pa", "pb").alias("p1"), F.greatest("pa", "pb").alias("p2"))


def resolve_template(template: Column, picks: dict[str, Column]) -> Column:
    """The template with its first known placeholder (in the order of ``picks``) filled in; others stay."""
    out = None
    for name, value in picks.items():
        holder = "{" + name + "}"
        filled = F.replace(template, F.lit(holder), value)
        out = F.when(F.contains(template, F.lit(holder)), filled) if out is None else out.when(F.contains(template, F.lit(holder)), filled)
    return template if out is None else out.otherwise(template)


def few_shot(draws: DataFrame, pool: DataFrame, draw_col: str, order: list[str], h1: Column, h2: Column, k: int = 2) -> DataFrame:
    """``k`` (1 or 2; all if there are fewer) different rows of ``pool`` for each draw, with ``n`` from 1.

    ``h1`` and ``h2`` are non-negative integers of the draw: the first place is h1 modulo the pool's
    size, the second is 1 + h2 modulo (size - 1) places further. Places are joined by number.
    """
    if k not in (1, 2):
        raise ValueError("k must be 1 or 2")
    size = pool.count()
    if not size:
        return draws.select(draw_col).withColumn("n", F.lit(1)).join(pool, F.lit(False))
    numbered = pool.withColumn("_place", F.row_number().over(Window.orderBy(*order)) - 1)
    first = (h1 % size).cast("int")
    places = [first] if min(k, size) == 1 else [first, ((first + 1 + h2 % (size - 1)) % size).cast("int")]
    rows = draws.select(draw_col, F.posexplode(F.array(*places)).alias("n", "_p")).withColumn("n", F.col("n") + 1)
    return rows.join(numbered, F.col("_p") == F.col("_place")).drop("_p", "_place")


def prefix(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in ``order``."""
    return df.orderBy(*order).limit(n)


def shuffled(df: DataFrame, seed: int) -> DataFrame:
    return df.orderBy(F.rand(seed))


def unprocessed(experiences: DataFrame, processed: DataFrame, id_col: str = "id") -> DataFrame:
    """Experiences whose id was not processed before."""
    return experiences.join(processed.select(F.col(processed.columns[0]).alias("_done")), F.col(id_col) == F.col("_done"), "left_anti")
