"""Near-duplicates by SimHash fingerprints and pigeonhole blocks."""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh, map_batches, merge_join, row_hash, rows_of, spread
from .components import connected_components

BITS = 64
#: Differing bits at most.
DISTANCE = 4
#: Distinct fingerprints in a block bucket up to which its pairs are compared; larger ones go by midpoints.
PAIRED = 256
SHINGLE = 4


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the text as a signed 64-bit integer.

    A-Z are lower-cased, words are runs of other than ASCII blanks, shingles of ``shingle`` words
    are joined by single spaces and hashed by XXH64 (seed 42). With fewer words the whole sequence
    is the one shingle; without words (or null) the fingerprint is 0. Repeated shingles count.
    """
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return 0
    digest = xxhash.xxh64_intdigest
    if n < shingle:
        parts = [digest(b" ".join(words), 42)]
    else:
        joined, ends, at = b" ".join(words), [], -1
        for w in words:
            at += len(w) + 1
            ends.append(at)
        starts = [0, *(e + 1 for e in ends)]
        parts = [digest(joined[a:b], 42) for a, b in zip(starts, ends[shingle - 1:])]
    return fingerprint_of_hashes(np.array(parts, dtype=">u8"))


def fingerprint_of_hashes(hashes: np.ndarray) -> int:
    """Bits that are set in over half the hashes (big-endian ``>u8``)."""
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 14):
        part = np.unpackbits(hashes[i:i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1)
        ones += np.add.reduce(part, axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``row`` (see :func:`.common.rows_of`), ``doc_id`` and ``fp`` (signed long) of every row."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            fps = [fingerprint(t, shingle) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(fps, pa.int64())], names=["row", "doc_id", "fp"])

    return map_batches(rows_of(docs, id_col, text_col), run, "row long, doc_id long, fp long")


def block_masks(n_blocks: int, distance: int = DISTANCE) -> list[int]:
    """Signed masks of every choice of ``n_blocks - distance`` of ``n_blocks`` blocks.

    Fingerprints that differ in at most ``distance`` bits agree on one of these masks at least.
    """
    edges = [round(i * BITS / n_blocks) for i in range(n_blocks + 1)]
    blocks = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(n_blocks)]
    masks = [sum(blocks[i] for i in kept) for kept in combinations(range(n_blocks), n_blocks - distance)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def n_blocks_for(n: int, distance: int = DISTANCE) -> int:
    """Blocks so that a bucket of random fingerprints is expected to hold under 1/4 of a row besides its own.

    Any number finds all links; more blocks trade rows (one for each mask) for pairs compared.
    """
    for m in range(distance + 2, distance + 8):
        if BITS * (m - distance) / m >= np.log2(max(2, n)) + 2:
            return m
    return distance + 8


def within(value: str, distance: int) -> str:
    """SQL of the array of all longs within ``distance`` bits of the column ``value``, each once.

    Bits are chosen in ascending order, ``BITS`` standing for none. The thousands of masks written out would be in every copy
    of the plan that the driver keeps.
    """
    if not distance:
        return f"array({value})"
    changed = " ^ ".join([value, *(f"if(i{k} = {BITS}, 0L, shiftleft(1L, i{k}))" for k in range(distance))])
    for k in range(distance - 1, -1, -1):
        changed = f"transform(sequence({f'least(i{k - 1} + 1, {BITS}), {BITS}' if k else f'0, {BITS - 1}'}), i{k} -> {changed})"
    return f"concat(array({value}), {'flatten(' * (distance - 1)}{changed}{')' * (distance - 1)})"


def close_links(fps: DataFrame, distance: int = DISTANCE, paired: int = PAIRED, n_blocks: int | None = None) -> DataFrame:
    """``a``, ``b``: pairs of distinct fingerprints (column ``fp``, distinct) that join all within ``distance`` bits.

    Buckets of equal blocks with up to ``paired`` rows compare their pairs. The fingerprints of
    larger buckets, wherever they are, instead list all values within half the distance: two
    fingerprints share such a value exactly if they are within the (even) distance, so each is
    linked to the least one of each of its values. That has the same components, costs a fixed
    number of rows for each fingerprint and drops no link's connection. Those rows are made by all tasks, and no join
    gathers a side on the driver.
    """
    if distance % 2:
        raise ValueError("distance must be even")
    n = fps.count()
    masks = block_masks(n_blocks or n_blocks_for(n, distance), distance)
    keyed = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("k")) for i, m in enumerate(masks)])).alias("key")).select("fp", "key.i", "key.k")
    counts = keyed.groupBy("i", "k").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("i").alias("ci"), F.col("k").alias("ck"), "n")
    shared = cut(merge_join(keyed, counts, (F.col("i") == F.col("ci")) & (F.col("k") == F.col("ck"))).select("fp", "i", "k", "n"))
    few = shared.filter(F.col("n") <= paired).select("fp", "i", "k")
    other = few.select(F.col("fp").alias("b"), F.col("i").alias("i2"), F.col("k").alias("k2"))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("b"))) <= distance
    pairs = merge_join(few, other, (F.col("i") == F.col("i2")) & (F.col("k") == F.col("k2")) & (F.col("fp") < F.col("b")) & near).select(F.col("fp").alias("a"), "b")
    hot = spread(shared.filter(F.col("n") > paired).select("fp"), "fp").distinct()
    around = hot.select("fp", F.explode(F.expr(within("fp", distance // 2))).alias("mid"))
    least = around.groupBy("mid").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).filter("a < z").select(F.col("mid").alias("m2"), "a")
    stars = merge_join(around, least, F.col("mid") == F.col("m2")).filter("a < fp").select("a", F.col("fp").alias("b"))
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE, paired: int = PAIRED) -> DataFrame:
    """``row``, ``doc_id``, ``fp`` and ``component_id`` (least id reachable by links, itself included) of every row.

    Rows of equal fingerprints are one class, whose least id stands for it; links are sought
    between the distinct fingerprints. Null or blank texts have fingerprint 0 and are linked like
    any other; a row with a null id gets its class' id (null if it is alone). Repeated rows are
    kept. Of very long texts all shingles are hashed, a row at a time. An empty table gives no rows; other columns, whatever their names, are ignored.
    """
    prints = cut(fingerprints(docs, id_col, text_col))
    classes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    links = close_links(classes.select("fp"), distance, paired)
    of = connected_components(links)
    named = merge_join(classes, of.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    roots = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = merge_join(named, roots, "root").select(F.col("fp").alias("f2"), "component_id")
    return merge_join(prints, named, F.col("fp") == F.col("f2")).select("row", "doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE) -> DataFrame:
    """One row of ``docs``, with all columns, of each component of :func:`near_duplicates`.

    It is the one of least id (null first), then of least hash of id and text; of rows that repeat
    it one stays. Null, empty and blank texts are one component. An empty table gives no rows; columns may have any names.
    """
    found = cut(near_duplicates(docs, id_col, text_col, distance).select("row", "doc_id", "component_id"))
    row, one = fresh(docs, "_row", "_kept")
    kept = found.groupBy("component_id").agg(F.min(F.struct("doc_id", "row")).alias("one")).filter("component_id is not null").select(F.col("one.row").alias(one))
    alone = found.filter("component_id is null").select(F.col("row").alias(one))
    again = not found.groupBy("row").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()
    marked = docs.withColumn(row, row_hash(id_col, text_col))
    out = merge_join(marked, kept.unionByName(alone).distinct(), F.col(row) == F.col(one), "left_semi")
    return (out.dropDuplicates([row]) if again else out).drop(row)
