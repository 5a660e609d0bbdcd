"""Mixing sources to target weights by pivotal dependent rounding, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, fresh, repeated, row_hash, whole_row_hash

#: Rows that one fold of the reduction tree reads on average.
FAN_IN = 48
#: Copies of a document at most.
MAX_COPIES = 3
#: Sources up to which their table of targets is broadcast; beyond it, a shuffled join is used.
BROADCAST_SOURCES = 5000
WORDS = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, source_col: str, size_col: str, cap: float = MAX_COPIES, share: float = 1.0) -> DataFrame:
    """Each source with ``source_size``, ``weight`` and ``target``.

    Sources by code point, null last, weigh 1, 2, 3, 1, ...; they share ``share`` of all sizes by
    weight. A target stops at ``cap`` times its source's size and the excess goes to the others by
    weight until none is above: the target is least(cap * size, level * weight), where the level is
    found from sums over the sources in order of cap * size / weight. One row per source is all
    that is ever gathered.
    """
    per = sizes.groupBy(F.col(source_col).alias("_src")).agg(F.sum(size_col).cast("long").alias("source_size"))
    by_name = Window.orderBy(F.col("_src").asc_nulls_last())
    per = per.withColumn("weight", (F.row_number().over(by_name) - 1) % 3 + 1).withColumn("_cap", F.col("source_size") * F.lit(float(cap)))
    fill = Window.orderBy((F.col("_cap") / F.col("weight")).asc(), F.col("_src").asc_nulls_last())
    whole = Window.partitionBy(F.lit(1))
    per = per.withColumn("_want", F.sum("source_size").over(whole) * F.lit(float(share))) \
        .withColumn("_spent", F.coalesce(F.sum("_cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))) \
        .withColumn("_left", F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing))) \
        .withColumn("_level", (F.col("_want") - F.col("_spent")) / F.col("_left")) \
        .withColumn("_open", F.when(F.col("_level") * F.col("weight") <= F.col("_cap"), F.struct(F.col("_cap") / F.col("weight"), F.col("_level"))))
    level = F.min("_open").over(whole)["_level"]
    return per.withColumn("_at", level).select(
        "_src", "source_size", "weight",
        F.least(F.col("_cap"), F.coalesce(F.col("_at") * F.col("weight"), F.col("_cap"))).alias("target"))


def _uniform(*cols: Column) -> Column:
    """In [0, 1), from a hash, so that reruns agree."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / F.lit(float(1 << 53))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _fold(seed: int, level: int):
    """One step of the pivotal method: the carried row meets ``x``; mass moves until one is whole."""
    def step(acc: Column, x: Column) -> Column:
        carry = acc["carry"]

        def moved(m: Column) -> Column:
            p, q, s, t = carry["p"], x["p"], carry["size"], x["size"]
            up = m["u"] * (m["a"] + m["b"]) < m["b"]  # the carried row gains
            p2 = F.when(up, p + m["a"] / s).otherwise(p - m["b"] / s)
            q2 = F.when(up, q - m["a"] / t).otherwise(q + m["b"] / t)
            return _let(F.struct(p2.alias("p2"), q2.alias("q2")), settled)

        def settled(m: Column) -> Column:
            eps = F.lit(1e-9)
            near = lambda v: F.when(v <= eps, F.lit(0.0)).when(v >= 1 - eps, F.lit(1.0)).otherwise(v)
            one = lambda row, v: F.struct(row["key"].alias("key"), near(v).alias("p"), row["size"].alias("size"))
            pw = (m["p2"] <= eps) | (m["p2"] >= 1 - eps)
            return F.struct(
                F.when(pw, one(x, m["q2"])).otherwise(one(carry, m["p2"])).alias("carry"),
                F.concat(acc["out"], F.array(F.when(pw, one(carry, m["p2"])).otherwise(one(x, m["q2"])))).alias("out"))

        s, t, p, q = carry["size"], x["size"], carry["p"], x["p"]
        mass = F.struct(
            F.least((1 - p) * s, q * t).alias("a"), F.least(p * s, (1 - q) * t).alias("b"),
            _uniform(F.lit(seed), F.lit(level), carry["key"], x["key"]).alias("u"))
        whole = (p <= 0) | (p >= 1)
        return F.when(carry.isNull(), F.struct(x.alias("carry"), acc["out"].alias("out"))) \
            .when(whole, F.struct(x.alias("carry"), F.concat(acc["out"], F.array(carry)).alias("out"))) \
            .otherwise(_let(mass, moved))
    return step


def pivotal_round(items: DataFrame, group_col: str, key_col: str, p_col: str, size_col: str, seed: int = 11, fan_in: int = FAN_IN) -> DataFrame:
    """``group_col``, ``key_col`` and ``up`` (0 or 1) for every row, by pivotal sampling in a tree.

    Each row has a probability in (0, 1) and a positive size; ``key_col`` is a unique long within
    the group. Rows meet in small buckets. A fold lets the carried row and the next exchange
    mass p * size until one of them is 0 or 1, up or down with the odds that keep both
    expectations. So every bucket keeps its sum of p * size and leaves one unsettled row, and
    those meet again a level higher until each group has one, which a coin settles. A group's
    sum of sizes taken thus differs from its expectation by less than one size. A fold takes
    large sizes first: they settle among themselves and what is left over is a small one.

    Bucket numbers are hashes of the key, so a level's buckets are of about ``fan_in`` rows
    whatever the group's size, and each level is a shuffle of 1 / ``fan_in`` of the one before.
    """
    live = items.select(F.col(group_col).alias("grp"), F.col(key_col).alias("key"), F.col(p_col).cast("double").alias("p"), F.col(size_col).cast("double").alias("size"))
    groups = live.groupBy("grp").agg(F.count("*").alias("n"))
    most = groups.agg(F.max("n")).first()[0] or 0
    done, level = None, 0
    empty = F.expr("cast(null as struct<key:bigint,p:double,size:double>)")
    start = F.struct(empty.alias("carry"), F.expr("cast(array() as array<struct<key:bigint,p:double,size:double>>)").alias("out"))
    while most >= 1:
        n_buckets = max(1, -(-most // fan_in))
        if most <= 2 * fan_in:
            n_buckets = 1
        bucket = F.pmod(F.xxhash64(F.lit(seed), F.lit(level), F.col("key")), F.lit(n_buckets))
        folded = live.withColumn("b", bucket).groupBy("grp", "b").agg(F.sort_array(F.collect_list(F.struct((-F.col("size")).alias("big"), "key", "p", "size"))).alias("xs")) \
            .select("grp", F.aggregate(F.transform("xs", lambda x: F.struct(x["key"].alias("key"), x["p"].alias("p"), x["size"].alias("size"))), start, _fold(seed, level)).alias("acc"))
        if n_buckets == 1:  # the root: a coin settles what is left
            last = F.col("acc.carry")
            coin = F.struct(last["key"].alias("key"), (_uniform(F.lit(seed), F.lit(-1), last["key"]) < last["p"]).cast("double").alias("p"), last["size"].alias("size"))
            part = folded.select("grp", F.explode(F.concat(F.col("acc.out"), F.array(coin))).alias("x"))
            part = part.select("grp", F.col("x.key").alias("key"), F.col("x.p").alias("p"))
            return part if done is None else done.unionByName(part)
        folded = cut(folded)
        part = folded.select("grp", F.explode("acc.out").alias("x")).select("grp", F.col("x.key").alias("key"), F.col("x.p").alias("p"))
        done = part if done is None else done.unionByName(part)
        live = folded.select("grp", F.col("acc.carry.key").alias("key"), F.col("acc.carry.p").alias("p"), F.col("acc.carry.size").alias("size"))
        most, level = n_buckets, level + 1
    return live.select("grp", "key", "p")


def mix_sources(docs: DataFrame, seed: int = 11, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """Every row of ``docs`` with the words that the mix takes from it.

    Size: words of the text (null: 0). With r = target / size of its source, a document is taken
    floor(r) times and once more with probability r - floor(r), rounded by :func:`pivotal_round`
    so that a source's taken words miss its target by less than one document.

    Returns id, ``size``, ``source_size``, ``target`` (its source's), ``taken``, ``copies``,
    ``source``, ``row`` (hash of id and text, or ``row_col``) and ``j`` (a number from 1 among equal rows).
    Rows are first counted by (id, text, source), map-side, so rows repeated any number of times are told
    apart by a running number and spread over buckets like others. A null source is a source of
    its own, null ids are allowed, documents without words are taken 0 words, very long texts are taken by the same rule (their words
    are counted in the JVM). Ties between sources of equal caps go by name. An empty table gives
    no rows; other columns are ignored. Reruns agree: all choices are hashes of ids and the seed.
    """
    rows = docs.select(
        (F.col(row_col) if row_col else row_hash(id_col, text_col)).alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(text_col, F.lit(WORDS)), F.lit(0)).cast("long").alias("size"))
    kinds = cut(rows.groupBy("row", "doc_id", "source", "size").agg(F.count("*").alias("m")))
    targets = cut(source_targets(kinds.select("source", (F.col("size") * F.col("m")).alias("words")), "source", "words"))
    n_sources = targets.count()
    if n_sources <= BROADCAST_SOURCES:
        targets = F.broadcast(targets.coalesce(1))
    most = kinds.agg(F.max("m")).first()[0] or 0
    each = repeated(kinds, "m", "j", most).drop("m")
    each = each.join(targets, F.col("source").eqNullSafe(F.col("_src")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    each = each.withColumn("rate", rate).withColumn("whole", F.floor(F.col("rate") + 1e-12)).withColumn("p", F.greatest(F.col("rate") - F.col("whole"), F.lit(0.0))) \
        .withColumn("key", F.xxhash64(F.lit(seed), "row", "doc_id", "source", "size", "j")).withColumn("grp", F.xxhash64("source"))
    open_rows = each.filter((F.col("p") > 1e-12) & (F.col("size") > 0))
    settled = pivotal_round(open_rows, "grp", "key", "p", "size", seed)
    copies = F.least(F.col("whole") + F.coalesce(F.col("up"), F.lit(0)), F.lit(MAX_COPIES)).cast("long")
    return each.join(settled.select(F.col("grp").alias("_g"), F.col("key").alias("_k"), F.col("p").cast("long").alias("up")),
                     (F.col("key") == F.col("_k")) & (F.col("grp") == F.col("_g")), "left") \
        .withColumn("copies", copies) \
        .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies", "row", "j")


def mixed(docs: DataFrame, seed: int = 11, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, each as often as :func:`mix_sources` takes it (0 to 3 times).

    Rows are identified by a hash of all their columns, so only rows equal in all of them are interchangeable; these are
    taken as often as all of them together. Rows with nulls in any column are rows like others; those without words (null, empty and blank texts) are
    not taken. Columns may have any names. An empty table gives no rows.
    """
    row, own, copies, copy = fresh(docs, "_row", "_own", "_copies", "_copy")
    marked = docs.withColumn(row, whole_row_hash(docs))
    taken = cut(mix_sources(marked, seed, id_col, source_col, text_col, row).groupBy(F.col("row").alias(own)).agg(F.sum("copies").alias(copies), F.count("*").alias("m")).filter(F.col(copies) > 0))
    most = taken.agg(F.max("m"), F.max(copies)).first()
    if (most[0] or 0) > 1:
        marked = marked.dropDuplicates([row, id_col])
    out = repeated(marked.join(taken.drop("m"), F.col(row) == F.col(own)), copies, copy, most[1] or 0)
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
