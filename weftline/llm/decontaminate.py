"""Benchmark decontamination: CGK embeddings, bit-sampling LSH over item-sized windows, edit verification."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, map_batches, row_hash, stored

#: Edit similarity over words: 1 - edits / words of the item.
SIMILARITY = 0.8
#: Random walks (embeddings) of a window, samples taken of each, and steps of a walk in a sample.
WALKS, SAMPLES, SAMPLED = 2, 16, 5
#: Windows of a text start at every so many'th part of the least size of their class; steps of a walk for each word of that size
#: (one for each word in classes under ``SMALL``, whose walks mustn't leave the item).
STRIDES, REACH, SMALL = 2.5, 1.5, 8
#: Windows whose keys are held at once, and bytes of texts that are read together (a longer text is read alone, in parts of so many).
TOGETHER, BYTES = 1 << 14, 1 << 20
#: The table that tells which keys items have: two of 2 ** ``SLOT_BITS`` bits are set for each key. 8 MB, whatever the benchmark's size.
SLOT_BITS = 26
BETWEEN = re.compile(r"[\W_]+")
_GOLD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def line_of(text: str | None) -> str:
    """The words of a text, joined by single spaces: lower-cased runs of letters and digits."""
    return BETWEEN.sub(" ", (text or "").lower()).strip(" ")


def words_of(text: str | None) -> list[str]:
    return line_of(text).split()


def _scatter(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def class_of(n: int) -> int:
    """The size class of an item of ``n`` words: the power of two not above it."""
    return 1 << (n.bit_length() - 1)


def stride_of(least: int) -> int:
    return 1 if least < SMALL else round(least / STRIDES)


def sampled_steps(least: int, seed: int = 17) -> tuple[np.ndarray, np.ndarray]:
    """Of a class: (walks, samples, steps), at which different steps a walk is sampled; and an odd factor for each."""
    rng = np.random.default_rng(seed + least)
    reach = least if least < SMALL else int(REACH * least)
    steps = np.array([[np.sort(rng.permutation(reach)[:SAMPLED]) for _ in range(SAMPLES)] for _ in range(WALKS)])
    return steps, rng.integers(0, 1 << 63, steps.shape, np.uint64) * np.uint64(2) + np.uint64(1)


def moves(codes: np.ndarray, walk: int, steps: int) -> list[np.ndarray]:
    """For each 64 steps of a walk: a bit for each step by which word it moves on; never from the 0 that ends a text."""
    out = []
    for j in range(0, steps, 64):
        bits = _scatter(codes + _GOLD * np.full(1, 1 + walk + 64 * j, np.uint64))
        bits[codes == 0] = 0
        out.append(bits)
    return out


def embedding(codes: np.ndarray, starts: np.ndarray, bits: list[np.ndarray], steps: int) -> np.ndarray:
    """(steps, windows): what a random walk (Chakraborty, Goldenberg, Koucky) writes from each of ``starts``.

    At step j it writes the word it stands on and moves on if bit j of that word's hash for the walk is set (see :func:`moves`). A 0 among
    ``codes`` ends a text: the walk stays there and writes blanks. Texts within few edits are written alike in most steps, for once
    both walks stand on the same word of a common part they go together.
    """
    out, at, one = np.empty((steps, len(starts)), np.uint64), starts.copy(), np.uint64(1)
    for j in range(steps):
        np.take(codes, at, out=out[j])
        at += ((bits[j // 64][at] >> np.uint64(j % 64)) & one).view(np.int64)
    return out


def window_keys(codes: np.ndarray, starts: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray]]:
    """(number of the first window, keys (keys, windows)) for some ``TOGETHER`` windows after the other: a key for each sample of each walk.

    Two windows meet if they agree in all steps of a sample. The key is 0 for samples of blanks only.
    """
    samples, factors = sampled_steps(least)
    reach = int(samples.max()) + 1
    bits = [moves(codes, walk, reach) for walk in range(WALKS)]
    for i in range(0, len(starts), TOGETHER):
        own = starts[i:i + TOGETHER]
        keys, part = np.empty((WALKS * SAMPLES, len(own)), np.uint64), np.empty(len(own), np.uint64)
        for walk in range(WALKS):
            written = embedding(codes, own, bits[walk], reach)
            for k, (steps, odd) in enumerate(zip(samples[walk], factors[walk])):
                h = keys[walk * SAMPLES + k]
                np.multiply(written[steps[0]], odd[0], out=h)
                for step, factor in zip(steps[1:], odd[1:]):
                    h += np.multiply(written[step], factor, out=part)
        yield i, _scatter(keys)


def slots_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two places in the table for each key."""
    return keys >> np.uint64(64 - SLOT_BITS), (keys >> np.uint64(64 - 2 * SLOT_BITS)) & np.uint64((1 << SLOT_BITS) - 1)


class Lines:
    """Texts as :func:`line_of` gives them, one after the other, with a code for each word and a 0 after each text.

    A word's code is the same in every process: its bytes' weighted sum, scattered. ``firsts`` are the texts' places among the
    codes, ``sizes`` their words.
    """

    powers = np.ones(1, np.uint64)

    def __init__(self, lines: list[str]):
        parts = [x.encode("utf-8", "surrogatepass") for x in lines]
        self.data = b"".join(x + b" \n" if x else b"\n" for x in parts)  # each word, and each text, has a byte after it
        flat = np.frombuffer(self.data, np.uint8)
        self.ends = np.flatnonzero((flat == 32) | (flat == 10))
        self.begins = np.concatenate([[0], self.ends[:-1] + 1]) if len(self.ends) else self.ends
        self.codes = np.zeros(len(self.ends), np.uint64)
        at = 0
        while at < len(self.ends):  # words of about BYTES bytes at a time
            stop = max(at + 1, int(np.searchsorted(self.ends, self.begins[at] + BYTES)))
            self.codes[at:stop] = self._codes(flat, self.begins[at:stop], self.ends[at:stop])
            at = stop
        stops = np.flatnonzero(flat[self.ends] == 10)
        self.codes[stops] = 0
        self.firsts = np.concatenate([[0], stops[:-1] + 1]) if len(stops) else np.zeros(0, np.int64)
        self.sizes = stops - self.firsts

    @staticmethod
    def _codes(flat: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sizes = ends - begins
        longest = int(sizes.max()) + 1
        if longest > len(Lines.powers):
            Lines.powers = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(longest + 64, _GOLD)]))
        own = flat[begins[0]:ends[-1] + 1]
        place = np.arange(len(own)) - np.repeat(begins - begins[0], sizes + 1)
        return _scatter(np.add.reduceat((own.astype(np.uint64) + np.uint64(1)) * Lines.powers[place], begins - begins[0])) | np.uint64(1)

    def part(self, text: int, first: int, last: int) -> str:
        """Words ``first`` to ``last``, excluded, of a text."""
        at, last = int(self.firsts[text]), min(last, int(self.sizes[text]))
        return self.data[self.begins[at + first]:self.ends[at + last - 1]].decode("utf-8", "surrogatepass")


def edit_scores(item: list, text: list, anchored: bool) -> list[int]:
    """Edits from ``item`` to the best part of ``text`` that ends before each place; ``anchored`` parts begin where the text does.

    A column of the table of edit distances is kept as two integers of a bit for each word (Myers).
    """
    m, at = len(item), {}
    for i, w in enumerate(item):
        at[w] = at.get(w, 0) | 1 << i
    full, last, up, down, score, first = (1 << m) - 1, 1 << (m - 1), (1 << m) - 1, 0, m, int(anchored)
    out = [m]
    for w in text:
        eq = at.get(w, 0)
        across = (((eq & up) + up) ^ up) | eq
        more, less = down | (full & ~(across | up)), up & across
        score += bool(more & last) - bool(less & last)
        more, less = ((more << 1) | first) & full, (less << 1) & full
        up, down = less | (full & ~((eq | down) | more)), more & (eq | down)
        out.append(score)
    return out


def best_alignment(item: list, window: list) -> tuple[int, int, int]:
    """(edits, start, end) of the part of ``window`` with the fewest word edits from ``item``; that of earliest end, then of earliest start."""
    scores = edit_scores(item, window, False)
    edits = min(scores)
    end = scores.index(edits)
    back = edit_scores(item[::-1], window[:end][::-1], True)
    return edits, end - max(j for j, s in enumerate(back) if s == edits), end


def benchmark_items(benchmark: DataFrame, id_col: str, text_col: str, null_ids: bool) -> tuple[DataFrame, DataFrame]:
    """(items, keys). Items: ``it`` (a number of the row), ``item_id``, ``n``, ``least`` (its class), ``words``; keys: ``it``, ``origin`` (first word of the window) and ``key``.

    Windows of an item start at each word up to two strides of its class, so some window of a text starts with one of them.
    """
    def words(batches):
        import pyarrow as pa

        for batch in batches:
            many = [line_of(t) for t in batch.column(2).to_pylist()]
            keep = pa.array([k for k, x in enumerate(many) if x], pa.int64())
            many = [x for x in many if x]
            sizes = [x.count(" ") + 1 for x in many]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep), pa.array(sizes, pa.int32()), pa.array(map(class_of, sizes), pa.int32()), pa.array(many, pa.string())], names=["it", "item_id", "n", "least", "words"])

    def keyed(batches):
        import pyarrow as pa

        for batch in batches:
            its, origins, keys = [], [], []
            for it, text in zip(*(c.to_pylist() for c in batch.columns)):
                item = Lines([text])
                n = int(item.sizes[0])
                least = class_of(n)
                starts = np.arange(min(n, 2 * stride_of(least)))
                found = np.concatenate([keys for _, keys in window_keys(item.codes, starts, least)], axis=1)
                some = found != 0
                its.append(np.full(int(some.sum()), it))
                origins.append(np.broadcast_to(starts, found.shape)[some])
                keys.append(found[some].view(np.int64))
            if its:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), k) for c, k in ((its, pa.int64()), (origins, pa.int32()), (keys, pa.int64()))], names=["it", "origin", "key"])

    number = F.col(id_col).try_cast("long") if null_ids else F.col(id_col).cast("long")
    given = benchmark.select(F.monotonically_increasing_id().alias("it"), number.alias("item_id"), F.col(text_col).cast("string").alias("text"))
    items = stored(map_batches(given if null_ids else given.filter("item_id is not null"), words, "it long, item_id long, n int, least int, words string"))
    return items, stored(map_batches(items.select("it", "words"), keyed, "it long, origin int, key long").distinct())


def key_table(keys: DataFrame) -> np.ndarray:
    """The bits of :func:`slots_of` of all keys. Of the same size for any benchmark; a fuller one lets more windows through to the join."""
    first, second = F.shiftrightunsigned("key", 64 - SLOT_BITS), F.shiftrightunsigned("key", 64 - 2 * SLOT_BITS).bitwiseAND(F.lit((1 << SLOT_BITS) - 1))
    parts = keys.select(F.explode(F.array(first + 1, second + 1)).alias("s")).groupBy(F.bitmap_bucket_number("s").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("bits"))
    out = np.zeros(1 << (SLOT_BITS - 3), np.uint8)
    for r in parts.collect():  # 4 KB each, and never more than the table's size in all
        at = (r["b"] - 1) * len(r["bits"])
        out[at:at + len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)
    return out


def grouped(texts: list[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    """(number of the first, texts): groups of about ``BYTES`` characters, or of one longer text."""
    first = size = 0
    for k, text in enumerate(texts):
        if size and size + len(text or "") > BYTES:
            yield first, texts[first:k]
            first, size = k, 0
        size += len(text or "")
    if first < len(texts):
        yield first, texts[first:]


def candidate_windows(docs: DataFrame, id_col: str, text_col: str, classes: list[tuple[int, int]], table: Callable[[], np.ndarray]) -> DataFrame:
    """Windows of whole texts that have a key of ``table``: ``rid`` (of the row), ``row``, ``doc_id``, ``least`` (the class), ``at`` (its first
    word), ``keys``, ``base`` and ``part`` (words around it, enough for any item of the class, the first one's place being ``base``)."""
    def run(batches):
        import pyarrow as pa

        bits = table()
        for batch in batches:
            rows = []
            for first_row, texts in grouped(batch.column(3).to_pylist()):
                lines = Lines([line_of(t) for t in texts])
                owner = np.repeat(np.arange(len(lines.sizes)), lines.sizes)
                word = np.arange(len(owner)) + owner  # among the codes
                place = word - lines.firsts[owner]
                for least, most in classes:
                    own = np.flatnonzero(place % stride_of(least) == 0)
                    for i, found in window_keys(lines.codes, word[own], least):
                        first, second = slots_of(found)
                        hit = (bits[first >> np.uint64(3)] >> (first & np.uint64(7)).astype(np.uint8)) & np.uint8(1)
                        some = np.nonzero(hit)
                        hit[some] = (bits[second[some] >> np.uint64(3)] >> (second[some] & np.uint64(7)).astype(np.uint8)) & np.uint8(1)
                        for k in np.flatnonzero(hit.any(axis=0)):
                            doc, at = int(owner[own[i + k]]), int(place[own[i + k]])
                            base = max(0, at - 2 * stride_of(least) - most)
                            rows.append((first_row + doc, least, at, found[hit[:, k] == 1, k].view(np.int64).tolist(), base, lines.part(doc, base, at + 2 * most)))
            at, *cols = zip(*rows) if rows else [()] * 6
            kinds = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(at, pa.int64())) for c in batch.columns[:3]), *(pa.array(c, k) for c, k in zip(cols, kinds))], names=["rid", "row", "doc_id", "least", "at", "keys", "base", "part"])

    given = docs.select(F.monotonically_increasing_id().alias("rid"), row_hash(id_col, text_col).alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(given, run, "rid long, row long, doc_id long, least int, at long, keys array<long>, base long, part string")


def _matches(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_id_col: str, item_text_col: str, similarity: float, null_ids: bool) -> DataFrame:
    """Verified windows: ``rid``, ``row``, ``doc_id``, ``it``, ``item_id``, ``edits``, ``first_word``, ``end_word``, ``similarity``."""
    spark = docs.sparkSession
    items, keys = benchmark_items(benchmark, item_id_col, item_text_col, null_ids)
    sizes = items.groupBy("least").agg(F.max("n").alias("n")).collect()
    classes = sorted((r["least"], r["n"]) for r in sizes)  # one row for each power of two
    bits = spark.sparkContext.broadcast(key_table(keys))
    windows = stored(candidate_windows(docs, id_col, text_col, classes, lambda: bits.value))
    asked = windows.select("rid", "least", "at", F.explode("keys").alias("_key"))
    pairs = asked.join(keys, F.col("_key") == F.col("key")).select("rid", "least", "at", "it").distinct()
    pairs = pairs.join(items.select(F.col("it").alias("_it"), "item_id", "words"), F.col("it") == F.col("_it")).drop("_it")
    sides = pairs.join(windows.drop("keys"), ["rid", "least", "at"]).select("rid", "row", "doc_id", "it", "item_id", "words", "base", "part")

    def verified(batches):
        import pyarrow as pa

        for batch in batches:
            at, rows = [], []
            for k, (words, base, part) in enumerate(zip(*(c.to_pylist() for c in batch.columns[5:]))):
                item, window = words.split(" "), part.split(" ")
                most = int((1 - similarity) * len(item) + 1e-9)
                present = set(window)
                if sum(w not in present for w in item) > most:  # each missing word is an edit
                    continue
                edits, first, end = best_alignment(item, window)
                if edits <= most:
                    at.append(k)
                    rows.append((edits, base + first, base + end, 1 - edits / len(item)))
            cols = [*zip(*rows)] or [()] * 4
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(at, pa.int64())) for c in batch.columns[:5]), *(pa.array(c, pa.int32() if k < 3 else pa.float64()) for k, c in enumerate(cols))], names=["rid", "row", "doc_id", "it", "item_id", "edits", "first_word", "end_word", "similarity"])

    return map_batches(sides, verified, "rid long, row long, doc_id long, it long, item_id long, edits int, first_word int, end_word int, similarity double")


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row for each document and benchmark item that a part of the document resembles.

    Words are lower-cased runs of letters and digits. An item of n words is found where some part of the text is within
    (1 - similarity) n word edits of it. Windows are found by locality-sensitive hashing: random walks map a window to
    an embedding in which word edits become differing steps, samples of steps are its keys, and windows of a text that
    share a key with a window of an item are compared with it by exact edit distance. Windows start at every word of items up to two
    strides and at every stride of texts, so that unchanged passages always share all keys; of changed ones some may be
    missed (the tests measure recall). Items are classed by size, in powers of two.

    The benchmark may be of any size: texts are read once, a table of fixed size tells which keys are worth
    moving, and keys meet items in a join. Texts of any length are read whole.

    Returns ``doc_id``, ``item_id``, ``edits``, ``first_word``, ``end_word``, ``similarity`` (of the places found the one of fewest edits, then
    the earliest). Null or wordless texts and items match nothing, nor do items whose id is null; a document with a null id is
    matched like others. An item of few words, even one, is found wherever these stand. Repeated rows each
    give their own; items of equal id give the better one. Empty tables give no rows; other columns are ignored.
    """
    found = _matches(docs, benchmark, id_col, text_col, item_id_col, item_text_col, similarity, False)
    best = found.groupBy("rid", "doc_id", "item_id").agg(F.min(F.struct("edits", "first_word", "end_word", "similarity")).alias("b"))
    return best.select("doc_id", "item_id", "b.edits", "b.first_word", "b.end_word", "b.similarity")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", null_ids: bool = False, item_id_col: str = "item_id", item_text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, all columns, whose text matches no benchmark item by :func:`benchmark_matches`.

    With ``null_ids`` items count whatever their id, null or no integer included; without, those with a
    null id are left out. Rows with a null id are judged by the text too; null, empty and wordless texts stay; repeated rows
    go or stay together; an empty benchmark leaves all rows. Columns of ``docs`` may have any names. Rows that match are told by a hash of id and text.
    """
    found = _matches(docs, benchmark, id_col, text_col, item_id_col, item_text_col, similarity, null_ids)
    row, gone = fresh(docs, "_row", "_gone")
    bad = stored(found.select(F.col("row").alias(gone)).distinct())
    return docs.withColumn(row, row_hash(id_col, text_col)).join(bad, F.col(row) == F.col(gone), "left_anti").drop(row)
