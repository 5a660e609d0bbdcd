"""Removal of repeated byte strings: sampled suffixes in q-gram buckets, refined by identifiers of later offsets."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, packed, rows_of, stored, unpack

#: Bytes of a string that counts as repeated, and of the q-grams that sort suffixes into buckets.
LENGTH, GRAM = 200, 64
#: Starts in a run of each refinement after the first.
STEPS = (16, 4, 1)
#: String starts of one text that are worked on at a time.
BLOCK = 1 << 17
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


class Prefixes:
    """Identifiers of the q-grams of a text's bytes, from sums of bytes times powers modulo 2 ** 64."""

    powers = inverses = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data)
        if n + 1 > len(Prefixes.powers):
            Prefixes.powers, Prefixes.inverses = _powers(_BASE, n + 1024), _powers(_INVERSE, n + 1024)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[:n], out=self.sums[1:])

    def grams(self, q: int) -> np.ndarray:
        n = len(self.sums) - q
        h = (self.sums[q:] - self.sums[:n]) * self.inverses[:n]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        return h


def anchors(pieces: list[np.ndarray], length: int = LENGTH, gram: int = GRAM, whole: bool = True) -> tuple[np.ndarray, ...]:
    """Sampled suffixes of pieces of texts, each of ``length`` bytes or more: (piece, place, first start, last start, bucket, identifier of the stretch).

    Every string of ``length`` bytes is kept by the least of its q-grams (leftmost on ties), so
    equal strings are kept by equal q-grams at equal offsets. A sampled suffix at ``place`` keeps
    the strings of its piece that start from ``first`` to ``last``; the stretch is all their bytes (not made unless ``whole``).
    """
    data = np.concatenate(pieces)
    sizes = np.array([len(p) for p in pieces])
    offset = np.cumsum(sizes) - sizes
    g = Prefixes(data).grams(gram)
    low = np.uint64(0xFFFFFFFF)
    least = (g & ~low) | np.arange(len(g), dtype=np.uint64)
    width, want = 1, length - gram + 1
    while width < want:
        step = min(width, want - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    owner = np.repeat(np.arange(len(pieces)), sizes - length + 1)  # of each string that lies in one piece
    start = np.arange(len(owner)) + owner * (length - 1)
    at = (least[start] & low).astype(np.int64)
    new = np.flatnonzero((at[1:] != at[:-1]) | (owner[1:] != owner[:-1])) + 1
    begin = np.concatenate([[0], new])
    first, last, place, piece = start[begin], start[np.append(new, len(start)) - 1], at[begin], owner[begin]
    stretch = refined(data.tobytes(), g, first, last + length, gram) if whole else None
    return piece, place - offset[piece], first - offset[piece], last - offset[piece], g[place], stretch


def refined(data: bytes, buckets: np.ndarray, starts: np.ndarray, ends: np.ndarray, gram: int) -> np.ndarray:
    """Identifiers of the stretches ``starts`` to ``ends``, by the ``buckets`` of the q-grams at their later offsets.

    A stretch is ordered by the bucket of its first q-gram, then by those ``gram`` bytes further each, and by that of its last one, so
    all its bytes count. As nothing compares the bytes themselves, the order is mixed with XXH3 of them, a second kind of identifier.
    """
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    out = buckets[starts]
    for k in range(1, -(-int((ends - starts).max(initial=0)) // gram)):
        later = np.minimum(starts + k * gram, ends - gram)
        out = (out * np.uint64(0x9E3779B97F4A7C15)) ^ (out >> np.uint64(32)) ^ buckets[later]
    return out ^ np.fromiter((digest(data[a:b]) for a, b in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts))


def _blocks(data: np.ndarray, length: int):
    """(offset, bytes): blocks whose string starts cover all of the text's, each once."""
    for i in range(0, len(data) - length + 1, BLOCK):
        yield i, data[i:i + BLOCK + length - 1]


def sampled_suffixes(docs: DataFrame, length: int, gram: int, whole: bool = True) -> DataFrame:
    """Rows of all texts' anchors: ``row``, ``place``, ``reach`` (starts before the place: first and last), ``bucket``, ``stretch``; the bucket alone unless ``whole``."""
    def run(batches):
        import pyarrow as pa

        def found(rows, offs, pieces):
            piece, place, first, last, bucket, stretch = anchors(pieces, length, gram, whole)
            if not whole:
                return pa.RecordBatch.from_arrays([pa.array(bucket.view(np.int64))], names=["bucket"])
            columns = np.array(rows, np.int64)[piece], place + np.array(offs)[piece], (place - first) * 1024 + place - last, bucket.view(np.int64), stretch.view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["row", "place", "reach", "bucket", "stretch"])

        for batch in batches:
            rows, offs, pieces, size = [], [], [], 0
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
                for off, block in _blocks(data, length):
                    rows.append(row)
                    offs.append(off)
                    pieces.append(block)
                    size += len(block)
                    if size >= BLOCK:
                        yield found(rows, offs, pieces)
                        rows, offs, pieces, size = [], [], [], 0
            if pieces:
                yield found(rows, offs, pieces)

    return map_batches(docs.select("row", "text"), run, "row long, place long, reach long, bucket long, stretch long" if whole else "bucket long")


def starts_of_repeats(docs: DataFrame, id_col: str, text_col: str, length: int, gram: int, texts: DataFrame) -> DataFrame:
    """``row``, ``a``, ``b``: runs of starts (both included) of strings that also start elsewhere."""
    rows = rows_of(docs, id_col, text_col)
    buckets, suffixes = sampled_suffixes(rows, length, gram, whole=False), sampled_suffixes(rows, length, gram)
    # Stored, so that both sides of the join come by plain exchanges, whose skewed partitions are split.
    shared = stored(buckets.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("bucket").alias("_b")))
    live = stored(suffixes.join(shared, F.col("bucket") == F.col("_b")).drop("_b"))
    # First refinement: buckets split by the identifier of the whole stretch around the place.
    classes = stored(live.groupBy("bucket", "reach", "stretch").agg(F.count("*").alias("n"), F.min(F.struct("row", "place")).alias("one")))
    whole = classes.filter("n > 1").select(F.col("bucket").alias("_b"), F.col("reach").alias("_r"), F.col("stretch").alias("_s"))
    first, last = F.expr("place - reach div 1024"), F.expr("place - reach % 1024")
    runs = live.join(whole, (F.col("bucket") == F.col("_b")) & (F.col("reach") == F.col("_r")) & (F.col("stretch") == F.col("_s"))) \
        .select("row", first.alias("a"), last.alias("b")).distinct()
    # Next refinements, where a bucket has places left alone, against one of each class.
    ask = _left(classes, ["bucket"]).select(F.col("one.row").alias("row"), F.struct(F.col("one.place").alias("place"), "reach", "bucket").alias("ask"))
    ask = ask.groupBy("row").agg(F.collect_set("ask").alias("asks")).withColumnRenamed("row", "_row")

    def around(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for row, z, asks in zip(*(c.to_pylist() for c in batch.columns)):
                data = unpack(z)
                for x in asks:
                    lead, tail = divmod(x["reach"], 1024)
                    rows.append((row, x["place"], lead, tail, x["bucket"], data[x["place"] - lead:x["place"] - tail + length]))
            cols = [*zip(*rows)] or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k < 5 else pa.binary()) for k, c in enumerate(cols)], names=["row", "place", "lead", "tail", "bucket", "body"])

    bodies = map_batches(texts.select("row", "z").join(ask, F.col("row") == F.col("_row")).select("row", "z", "asks"), around, "row long, place long, lead long, tail long, bucket long, body binary")
    bodies = stored(bodies.dropDuplicates(["row", "place", "lead", "tail"]).withColumn("ask", F.xxhash64("row", "place", "lead", "tail")))
    part = bodies.withColumn("offs", F.lit(None).cast("array<long>"))
    last_size = None
    for size in STEPS:
        level = stored(map_batches(part.select("ask", "row", "place", "lead", "tail", "bucket", "body", "offs"), _splitter(size, last_size, length, gram), "ask long, row long, start long, n long, off long, core_of long, core long, stretch long"))
        classes = stored(level.groupBy("core_of", "core", "n", "off", "stretch").agg(F.count("*").alias("m"), F.min(F.struct("ask")).alias("one")).withColumnRenamed("m", "n_rows"))
        same = classes.filter("n_rows > 1").select(*[F.col(c).alias(f"_{c}") for c in ("core_of", "core", "n", "off", "stretch")])
        on = [F.col(c) == F.col(f"_{c}") for c in ("core_of", "core", "n", "off", "stretch")]
        runs = runs.unionByName(level.join(same, on).select("row", F.col("start").alias("a"), (F.col("start") + F.col("n") - 1).alias("b")))
        if size == 1:
            break
        left = _left(classes.withColumnRenamed("n", "starts").withColumnRenamed("n_rows", "n"), ["core_of", "core"])
        left = left.groupBy(F.col("one.ask").alias("_ask")).agg(F.collect_set("off").alias("offs"))
        part, last_size = bodies.join(left, F.col("ask") == F.col("_ask")), size
    return runs


def _left(classes: DataFrame, bucket: list[str]) -> DataFrame:
    """One of each class (``n`` members, one of them ``one``) of the buckets with several classes, some of them alone."""
    some = classes.groupBy(*bucket).agg(F.min("n").alias("least"), F.count("*").alias("m")).filter("least = 1 and m > 1")
    return classes.join(some.select(*[F.col(c).alias(f"_{c}") for c in bucket]), [F.col(c) == F.col(f"_{c}") for c in bucket])


def _splitter(size: int, last_size: int | None, length: int, gram: int):
    """Cuts stretches into runs of up to ``size`` starts, aligned to the place.

    Only those within the runs of ``last_size`` starts that ``offs`` names, if it names any. The core
    of an aligned run is what all strings that start in it have in common: strings can only be
    equal where cores are, so it is the bucket of the next refinement.
    """
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            ask, row, place, lead, tail, bucket = (np.array(c.to_pylist(), np.int64) for c in batch.columns[:6])
            bodies, offs = batch.column(6).to_pylist(), batch.column(7).to_pylist()
            data = b"".join(bodies)
            sizes = np.array([len(x) for x in bodies])
            zero = np.cumsum(sizes) - sizes + lead  # where the place of each body stands in the data
            grams = Prefixes(np.frombuffer(data, np.uint8)).grams(gram)
            if last_size is None:
                of, a = np.arange(len(bodies)), -lead
                b = 1 - tail
            else:
                of, a = np.repeat(np.arange(len(bodies)), [len(x) for x in offs]), np.array([o for x in offs for o in x], np.int64)
                b = np.minimum((a // last_size + 1) * last_size, 1 - tail[of])
            # Each stretch from a to b is cut at multiples of size.
            n_cuts = 1 + np.maximum(0, -(-b // size) - (a // size + 1))
            nth = np.arange(n_cuts.sum()) - np.repeat(np.cumsum(n_cuts) - n_cuts, n_cuts)
            of, a = np.repeat(of, n_cuts), np.repeat(a, n_cuts)
            cuts = np.where(nth == 0, a, (a // size + nth) * size)
            ends = np.minimum((cuts // size + 1) * size, 1 - tail[of])
            base, at = cuts // size * size, zero[of]
            core = refined(data, grams, at + base + size - 1, at + base + length, gram).view(np.int64) if size > 1 else np.zeros(len(cuts), np.int64)
            own = refined(data, grams, at + cuts, at + ends - 1 + length, gram).view(np.int64)
            columns = ask[of], row[of], cuts + place[of], ends - cuts, cuts, bucket[of] ^ (base * 0x9E3779B9), core, own
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["ask", "row", "start", "n", "off", "core_of", "core", "stretch"])

    return run


def merged(runs: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal covered byte ranges (end excluded) of runs of starts."""
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b + length)
        else:
            out.append([a, b + length])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Every row of ``docs`` without the bytes that lie in repeated strings.

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in
    another row or the same one; overlaps count, and all is judged on the texts as given. Texts are
    UTF-8 bytes, null is empty, and no string crosses rows. Repeated rows repeat each other.

    Suffixes are sorted into buckets by their first q-gram; only those at sampled places, about one in (length - gram) / 2 bytes,
    chosen by content so that equal strings choose alike. A sampled suffix stands for the strings around it, and its bucket is refined by
    the bucket identifiers at the later offsets of the stretch that these cover (:func:`refined`), which resolves copies at once. Where
    suffixes are left alone in a bucket with others, their stretches are cut into ever shorter runs of starts: the identifier of what all strings of a run share is
    the bucket that is refined next, again by later offsets, down to single strings. What a level has settled, alone
    or not, isn't looked at again. Counts are combined before shuffles; hot buckets only meet in equi-joins, which are
    split when skewed. Strings count as equal if two 64-bit identifiers of different kinds agree: their bucket's, a weighted sum of the q-gram's bytes,
    and their own, into which XXH3 of all their bytes is mixed; the bytes themselves are not moved to be compared.

    Returns ``doc_id``, ``n_bytes``, ``spans`` (array of start and end, end excluded) and ``kept``
    (binary). Very long texts are worked on in blocks of ``BLOCK`` starts and held whole only as bytes, one at a time; a null id is
    returned as such; ties between equal q-grams go to the leftmost. An empty table gives no rows; other columns, whatever their names, are ignored.
    """
    texts = packed(docs, id_col, text_col)
    runs = starts_of_repeats(docs, id_col, text_col, length, gram, texts)
    of = runs.groupBy("row").agg(F.collect_list(F.struct("a", "b")).alias("runs")).withColumnRenamed("row", "_row")

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            sizes, spans, kept = [], [], []
            for z, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = unpack(z)
                cover = merged([(x["a"], x["b"]) for x in found or ()], length)
                at, parts = 0, []
                for a, b in cover:
                    parts.append(data[at:a])
                    at = b
                kept.append(b"".join([*parts, data[at:]]))
                sizes.append(len(data))
                spans.append([{"start": a, "end": b} for a, b in cover])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    joined = texts.join(of, F.col("row") == F.col("_row"), "left").select("doc_id", "z", "runs")
    return map_batches(joined, run, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
