"""Chroma audio fingerprints of media columns, and the alignment of recordings by them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, map_batches, stored

#: 8-bit mono samples a second; samples of a frame, and from one frame to the next.
RATE, FRAME, HOP = 8000, 256, 32
PITCHES, SPAN = 12, 8
#: (kind, first pitch, pitches, frames): areas of the pitch-time image that are compared.
FILTERS = [
    (0, 0, 3, 8), (0, 3, 3, 8), (0, 6, 3, 8), (0, 9, 3, 8), (1, 0, 12, 4), (1, 0, 6, 8), (1, 6, 6, 8), (2, 0, 4, 8),
    (2, 4, 4, 8), (2, 8, 4, 8), (3, 0, 8, 8), (3, 4, 8, 8), (4, 0, 12, 8), (4, 3, 6, 8), (5, 0, 6, 6), (5, 6, 6, 6),
]
#: Quantizer steps of a filter's log ratio; areas of kind 0 are compared with the mean area.
STEP = 0.08
#: Integers of a matched stretch at least; share of wrong bits in it at most.
LEAST_RUN, BIT_ERRORS = 16, 0.05
#: Successive integers that make a key of the index.
KEYED = 3
#: Places of a segment. A recording is cut into segments so that every stretch of the least length lies in one of them.
SEGMENT = 176
#: Segments that a task remembers, so as to hand on copies once.
REMEMBERED = 500_000
#: Bits of segment numbers, of keys, and of a hash of the integer before a key, where they are moved.
ID_BITS, KEY_BITS, LEAD_BITS = 40, 48, 16
#: Queries are fingerprinted from these samples on, so that what lies between two hops of a recording meets its frames.
STARTS = (0, 8, 16, 24)


def samples_of(data: bytes | None) -> np.ndarray:
    """Unsigned 8-bit mono samples; of a RIFF file with 8 or 16-bit PCM, its first channel. Silence is 128."""
    data = data or b""
    if data[:4] == b"RIFF" and data[8:12] == b"WAVE":
        channels, bits, at = 1, 8, 12
        while at + 8 <= len(data):
            kind, size = data[at:at + 4], int.from_bytes(data[at + 4:at + 8], "little")
            body = data[at + 8:at + 8 + size]
            if kind == b"fmt ":
                channels, bits = max(1, int.from_bytes(body[2:4], "little")), int.from_bytes(body[14:16], "little")
            if kind == b"data":
                if bits == 16:
                    wide = np.frombuffer(body[:len(body) // 2 * 2], "<i2")[::channels]
                    return ((wide.astype(np.int32) >> 8) + 128).astype(np.uint8)
                return np.frombuffer(body, np.uint8)[::channels]
            at += 8 + size + size % 2
    return np.frombuffer(data, np.uint8)


def _pitch_matrix() -> np.ndarray:
    freq = np.arange(1, FRAME // 2 + 1) * RATE / FRAME
    note = (12 * np.log2(freq / 440.0)).round().astype(int) % PITCHES
    out = np.zeros((FRAME // 2 + 1, PITCHES), np.float32)
    out[np.arange(1, FRAME // 2 + 1), note] = 1
    return out


_PITCH, _HANN = _pitch_matrix(), np.hanning(FRAME).astype(np.float32)


def n_frames(n: int) -> int:
    """Frames of ``n`` samples: whole ones, and at least as many as one integer needs (padded by silence); 0 for none."""
    return max(SPAN, (n - FRAME) // HOP + 1) if n else 0


def chroma(samples: np.ndarray) -> np.ndarray:
    """(frames, 12): energy of each pitch class, each frame's sum 1 (0 in silence)."""
    frames = n_frames(len(samples))
    need = (frames - 1) * HOP + FRAME
    if len(samples) < need:
        samples = np.concatenate([samples, np.full(need - len(samples), 128, np.uint8)])
    x = samples.astype(np.float32) - 128
    windows = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP][:frames]
    out = np.empty((frames, PITCHES), np.float32)
    for i in range(0, frames, 4096):
        f = np.fft.rfft((windows[i:i + 4096] - windows[i:i + 4096].mean(axis=1, keepdims=True)) * _HANN, axis=1)
        out[i:i + 4096] = (f.real.astype(np.float32) ** 2 + f.imag.astype(np.float32) ** 2) @ _PITCH
    return out / np.maximum(out.sum(axis=1, keepdims=True), 1e-6)


def integers(image: np.ndarray) -> np.ndarray:
    """Packed 32-bit integers of a pitch-time image, one for each place of ``SPAN`` frames.

    Sums over any area come from the integral image with four reads. Each of the 16 filters
    compares two sums; the log of their ratio is quantized to two bits in Gray code.
    """
    n = len(image) - SPAN + 1
    total = np.zeros((len(image) + 1, PITCHES + 1))
    total[1:, 1:] = image.cumsum(0, dtype=np.float64).cumsum(1)
    at = np.arange(n)

    def area(t0: int, t1: int, p0: int, p1: int) -> np.ndarray:
        return total[at + t1, p1] - total[at + t0, p1] - total[at + t1, p0] + total[at + t0, p0]

    out = np.zeros(n, np.uint32)
    for kind, p, h, w in FILTERS:
        end, mid, half = p + h, w // 2, p + h // 2
        if kind == 0:
            a, b = area(0, w, p, end), area(0, w, 0, PITCHES) * h / PITCHES
        elif kind == 1:
            a, b = area(0, mid, p, end), area(mid, w, p, end)
            if h == PITCHES:  # a frame's pitches sum to 1: compare its lower half over time
                a, b = area(0, mid, 0, 6), area(mid, w, 0, 6)
        elif kind == 2:
            a, b = area(0, w, p, half), area(0, w, half, end)
        elif kind == 3:
            a, b = area(0, mid, p, half) + area(mid, w, half, end), area(0, mid, half, end) + area(mid, w, p, half)
        elif kind == 4:
            third = h // 3
            a, b = area(0, w, p + third, end - third), (area(0, w, p, p + third) + area(0, w, end - third, end)) / 2
        else:
            third = w // 3
            a, b = area(third, w - third, p, end), (area(0, third, p, end) + area(w - third, w, p, end)) / 2
        v = np.log((1 + a) / (1 + b)).round(9)
        two = (v > -STEP).astype(np.uint32) + (v > 0) + (v > STEP)
        out = (out << np.uint32(2)) | (two ^ (two >> 1)).astype(np.uint32)
    return out


def fingerprint(data: bytes | None) -> np.ndarray:
    samples = samples_of(data)
    return integers(chroma(samples)) if len(samples) else np.zeros(0, np.uint32)


def fingerprints_of(many: list[bytes | None]) -> list[np.ndarray]:
    """As :func:`fingerprint`, for many short recordings at once: one image, places across recordings are dropped."""
    images = [chroma(s) if len(s) else np.zeros((0, PITCHES), np.float32) for s in map(samples_of, many)]
    out: list[np.ndarray] = []
    i = 0
    while i < len(images):
        j, rows = i, 0
        while j < len(images) and (j == i or rows + len(images[j]) <= 40_000):
            rows += len(images[j])
            j += 1
        if rows < SPAN:
            out += [np.zeros(0, np.uint32)] * (j - i)
        else:
            whole = integers(np.concatenate(images[i:j]))
            at = 0
            for image in images[i:j]:
                out.append(whole[at:at + max(0, len(image) - SPAN + 1)])
                at += len(image)
        i = j
    return out


def segments_of(prints: np.ndarray, least_run: int) -> list[tuple[int, np.ndarray]]:
    """(first place, integers): parts of up to ``SEGMENT + least_run - 1`` integers; a stretch of ``least_run`` that starts at
    place i lies in part i // ``SEGMENT``, and in no other from its first integer on."""
    return [(i, prints[i:i + SEGMENT + least_run - 1]) for i in range(0, max(1, len(prints) - least_run + 1), SEGMENT)]


def media_segments(media: DataFrame, id_col: str, data: Column | str, is_query: Column | None = None, least_run: int = LEAST_RUN) -> DataFrame:
    """The fingerprint of every row, cut into segments.

    ``doc_id``, ``q`` (whether the row is a query), ``c1`` and ``n`` (hash and number of its integers: its class), ``place`` (of the
    segment's first integer), ``prints`` (32-bit integers, little endian) and, of queries, ``plays`` (the prints from each of
    ``STARTS`` there; null where a start has none). A row of place 0 stands for each recording, however short; of copies that one task reads only the
    first has ``prints`` that aren't null, so a group of copies is combined before it is moved.
    """
    def run(batches):
        import pyarrow as pa
        import xxhash

        seen: set = set()
        for batch in batches:
            if len(seen) > REMEMBERED:
                seen.clear()
            sound, asked = batch.column(2).to_pylist(), batch.column(1).to_pylist()
            whole = fingerprints_of(sound)
            asking = [k for k, q in enumerate(asked) if q]
            later = fingerprints_of([samples_of(sound[k])[s:].tobytes() for k in asking for s in STARTS[1:]])
            cut_up = lambda prints: {place: part.astype("<u4").tobytes() for place, part in segments_of(prints, least_run)}
            played = {k: [cut_up(p) if len(p) >= least_run else {} for p in later[i * (len(STARTS) - 1):(i + 1) * (len(STARTS) - 1)]] for i, k in enumerate(asking)}
            rows = []
            for k, prints in enumerate(whole):
                digest = xxhash.xxh3_64_intdigest(prints.tobytes())
                c1 = digest - (1 << 64) if digest >> 63 else digest
                for place, body in cut_up(prints).items():
                    plays = (body, *(p.get(place) for p in played[k])) if k in played else None
                    known = (c1, place, plays)
                    if known not in seen or not place:
                        rows.append((k, c1, len(prints), place, *((None, None) if known in seen else (body, plays))))
                    seen.add(known)
            at, *cols = zip(*rows) if rows else [()] * 6
            at = pa.array(at, pa.int64())
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *(pa.array(c, k) for c, k in zip(cols, kinds))], names=["doc_id", "q", "c1", "n", "place", "prints", "plays"])

    data = F.col(data) if isinstance(data, str) else data
    asks = F.lit(False) if is_query is None else F.coalesce(is_query, F.lit(False))
    given = media.select(F.col(id_col).cast("long").alias("doc_id"), asks.alias("q"), data.cast("binary").alias("data"))
    return map_batches(given, run, "doc_id long, q boolean, c1 long, n int, place int, prints binary, plays array<binary>")


def index_keys(prints: np.ndarray, keyed: int = KEYED) -> tuple[np.ndarray, np.ndarray]:
    """(keys, leads): the distinct hashes of each ``keyed`` successive integers; of the integer before the first such place a hash from 1 on, or 0 at the start."""
    n = len(prints) - keyed + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    for k in range(keyed):
        h = (h ^ prints[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    keys, first = np.unique(h >> np.uint64(64 - KEY_BITS), return_index=True)
    before = (prints.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - LEAD_BITS)
    return keys.view(np.int64), np.where(first > 0, before[first - 1].view(np.int64) + 1, 0)


def window_errors(a: np.ndarray, b: np.ndarray, least_run: int) -> np.ndarray:
    """Wrong bits of ``least_run`` integers of ``a`` from place i on against as many of ``b`` from place j on, for all i and j."""
    rows, cols = len(a) - least_run + 1, len(b) - least_run + 1
    span, size, total, at, left = np.bitwise_count(a[:, None] ^ b[None, :]).astype(np.uint16 if least_run < 2048 else np.uint32), 1, None, 0, least_run
    while left:  # spans of 1, 2, 4, ... integers along the diagonals; those in least_run add up
        if left & 1:
            x = span[at:at + rows, at:at + cols]
            total = x.copy() if total is None else total + x
            at += size
        left >>= 1
        if left:
            span = span[:-size, :-size] + span[size:, size:]
            size *= 2
    return total


def offset_histogram(a: np.ndarray, b: np.ndarray) -> dict[int, int]:
    """Equal integers of both by shift (place in ``b`` minus place in ``a``)."""
    i, j = np.nonzero(a[:, None] == b[None, :])
    shifts, votes = np.unique(j - i, return_counts=True)
    return dict(zip(shifts.tolist(), votes.tolist()))


def aligned(a: np.ndarray, b: np.ndarray, least_run: int = LEAST_RUN, most_errors: float = BIT_ERRORS) -> tuple[float, int, int, int, int] | None:
    """(errors, start, windows, shift, votes) of the best shift of two segments; None where none aligns.

    Bit errors are taken at every shift. ``errors`` is the share of wrong bits in the best window of ``least_run`` integers; of
    the shifts that have it the one with most votes in the offset histogram is the best, then the least. ``start`` is the first
    place in ``a`` of a window with ``most_errors`` or less there, ``windows`` the number of such windows.
    """
    if min(len(a), len(b)) < least_run:
        return None
    wrong = window_errors(a, b, least_run)
    least = int(wrong.min())
    if least > most_errors * 32 * least_run:
        return None
    i, j = np.nonzero(wrong == least)
    votes = offset_histogram(a, b)
    shift = min(np.unique(j - i).tolist(), key=lambda s: (-votes.get(s, 0), s))
    good = np.flatnonzero(np.diagonal(wrong, shift) <= most_errors * 32 * least_run)
    return least / (32 * least_run), int(good[0]) + max(0, -shift), len(good), shift, votes.get(shift, 0)


def align_recordings(segments: DataFrame, least_run: int = LEAST_RUN, most_errors: float = BIT_ERRORS) -> tuple[DataFrame, DataFrame]:
    """(membership, links) of recordings as :func:`media_segments` gives them.

    A class is all recordings of equal integers, named by their hash and number (``c1``, ``n``), so recordings that share an id stay
    apart. Membership: ``doc_id``, ``q``, ``c1``, ``n`` of every row. Links: for each class with a query and each other class that
    aligns with it: ``c1``, ``n``, ``m1``, ``mn`` (the other class), ``shift`` (place in the match minus place in the query), ``start``
    (first place in the query), ``run`` (windows at that shift plus ``least_run`` - 1), ``votes`` and ``errors`` (see :func:`aligned`).

    The index holds every ``KEYED`` successive integers of every recording: two segments with ``KEYED`` equal integers in a row
    have a common key, from any of the query's ``STARTS``, and such segments are compared at every shift with the query played from each of its ``STARTS``
    (up to the first without a wrong bit). A stretch
    whose wrong bits leave no ``KEYED`` equal integers in a row in its segments is not nominated. Of a run of common keys only the
    first nominates: a pair is passed over at a key before whose first places both segments have equal integers, as those make
    a common key further ahead (unequal ones that agree in ``LEAD_BITS`` bits of a hash count as equal, which may lose one run in 65,000). Keys that
    several starts have nominate once for them all. Classes stand for any number of
    copies, so equal recordings are never paired. Recordings under ``least_run`` integers are members without links.
    Only keys, segment numbers and the segments of nominated pairs are moved, none longer than ``SEGMENT`` + ``least_run`` - 1.
    """
    membership = segments.filter("place = 0").select("doc_id", "q", "c1", "n")
    long = segments.filter((F.col("n") >= least_run) & F.col("prints").isNotNull())
    # One segment of each class and place; of queries one for each different end, which the later starts may hear.
    number = lambda *of: F.shiftrightunsigned(F.xxhash64(*of), 64 - ID_BITS)  # noqa: E731  numbers that two segments share by chance only add pairs to compare
    index = long.withColumn("y", number("c1", "n", "place")).repartition("y").dropDuplicates(["y", "c1", "n", "place"]).select("y", "c1", "n", "place", "prints")
    asked = long.filter("plays is not null").dropDuplicates(["c1", "n", "place", "plays"]).select(number("c1", "n", "place", "plays").alias("x"), "c1", "n", "place", "plays")

    def keyed(batches):
        import pyarrow as pa

        for batch in batches:
            many = [index_keys(np.frombuffer(p, "<u4")) for p in batch.column(1).to_pylist()]
            moved = np.repeat(np.array(batch.column(0)), [len(k) for k, _ in many]) * (2 << LEAD_BITS) + np.concatenate([lead for _, lead in many])
            yield pa.RecordBatch.from_arrays([pa.array(moved), pa.array(np.concatenate([k for k, _ in many]))], names=["yid", "ykey"])

    def asking(batches):
        import pyarrow as pa

        for batch in batches:
            rows: set[tuple[int, int]] = set()
            for x, plays in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for p in plays:
                    rows.update((x * (2 << LEAD_BITS) + lead, key) for key, lead in zip(*(c.tolist() for c in index_keys(np.frombuffer(p or b"", "<u4")))))
            yield pa.RecordBatch.from_arrays([pa.array([at[i] for at in rows], pa.int64()) for i in (0, 1)], names=["xid", "xkey"])

    keys = map_batches(index.select("y", "prints"), keyed, "yid long, ykey long")
    asks = map_batches(asked.select("x", "plays"), asking, "xid long, xkey long")
    split = lambda c: (F.shiftright(c, LEAD_BITS + 1), F.col(c).bitwiseAND(F.lit((2 << LEAD_BITS) - 1)))  # noqa: E731  number and lead are moved as one
    (x, xlead), (y, ylead) = split("xid"), split("yid")
    pairs = asks.join(keys, (F.col("xkey") == F.col("ykey")) & ((xlead != ylead) | (xlead == 0))).select(x.alias("x"), y.alias("y")).distinct()
    sides = pairs.join(asked.select(F.col("x").alias("_x"), "c1", "n", F.col("place").alias("xplace"), "plays"), F.col("x") == F.col("_x")).select("y", "c1", "n", "xplace", "plays")
    # The index is dealt by segment number for this join already.
    sides = sides.join(index.select(F.col("y").alias("_y"), F.col("c1").alias("m1"), F.col("n").alias("mn"), F.col("place").alias("yplace"), F.col("prints").alias("yprints")), F.col("y") == F.col("_y"))
    sides = sides.filter((F.col("c1") != F.col("m1")) | (F.col("n") != F.col("mn"))).select("c1", "n", "m1", "mn", "xplace", "yplace", "plays", "yprints")

    def verified(batches):
        import pyarrow as pa

        for batch in batches:
            at, rows = [], []
            for i, (xplace, yplace, plays, y) in enumerate(zip(*(c.to_pylist() for c in batch.columns[4:]))):
                for k, play in enumerate(plays):
                    if found := aligned(np.frombuffer(play or b"", "<u4"), np.frombuffer(y, "<u4"), least_run, most_errors):
                        wrong, start, windows, shift, votes = found
                        at.append(i)
                        rows.append((k, shift + yplace - xplace, start + xplace, windows, votes, wrong))
                        if not wrong:
                            break
            cols = [*zip(*rows)] or [()] * 6
            kinds = [pa.int32(), *[pa.int64()] * 4, pa.float64()]
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(at, pa.int64())) for c in batch.columns[:4]), *(pa.array(c, k) for c, k in zip(cols, kinds))], names=["c1", "n", "m1", "mn", "k", "shift", "start", "windows", "votes", "errors"])

    found = map_batches(sides, verified, "c1 long, n int, m1 long, mn int, k int, shift long, start long, windows long, votes long, errors double")
    by_shift = found.groupBy("c1", "n", "m1", "mn", "k", "shift").agg(F.min("errors").alias("errors"), F.sum("windows").alias("windows"), F.min("start").alias("start"), F.max("votes").alias("votes"))
    best = by_shift.groupBy("c1", "n", "m1", "mn").agg(F.min(F.struct("errors", (-F.col("windows")).alias("w"), "shift", "start", "votes")).alias("b"))
    return membership, best.select("c1", "n", "m1", "mn", "b.shift", "b.start", (F.lit(least_run - 1) - F.col("b.w")).alias("run"), "b.votes", "b.errors")


def search_recordings(media: DataFrame, id_col: str, data: Column | str, every: int = 50, least_run: int = LEAST_RUN, most_errors: float = BIT_ERRORS) -> DataFrame:
    """One row for each recording whose id is divisible by ``every``, searched against all recordings.

    Returns ``doc_id``, ``n_prints``, ``class_id`` (least id of the recordings with the same integers), ``copies`` (other rows
    with the same integers), ``links`` (other classes that align) and the best of them: ``match_id`` (its least id), ``shift``,
    ``run``, ``errors`` (longest run, then fewest errors, then least id; null without links).

    Null and empty recordings have no integers: they form one class without links. Rows with a null id are no queries; they are
    not searched for. Rows of one id with different recordings are different classes and each give their rows; repeated rows each
    count. Ties go to the least id. Recordings of any length are read whole and compared in segments. An empty table gives no
    rows; other columns, whatever their names, are ignored.
    """
    given = media.filter(F.col(id_col).isNotNull())
    segments = stored(media_segments(given, id_col, data, F.col(id_col) % every == 0, least_run))
    membership, links = align_recordings(segments, least_run, most_errors)
    classes = cut(membership.groupBy("c1", "n").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("size")))
    of = classes.select(F.col("c1").alias("_c1"), F.col("n").alias("_n"), "class_id", "size")
    named = links.join(classes.select(F.col("c1").alias("m1"), F.col("n").alias("mn"), F.col("class_id").alias("match_id")), ["m1", "mn"])
    best = named.groupBy(F.col("c1").alias("_l1"), F.col("n").alias("_ln")).agg(F.count("*").alias("links"), F.min(F.struct((-F.col("run")).alias("r"), "errors", "match_id", "shift")).alias("b"))
    rows = membership.filter("q").join(of, (F.col("c1") == F.col("_c1")) & (F.col("n") == F.col("_n"))).join(best, (F.col("c1") == F.col("_l1")) & (F.col("n") == F.col("_ln")), "left")
    return rows.select("doc_id", F.col("n").cast("long").alias("n_prints"), "class_id", (F.col("size") - 1).alias("copies"), F.coalesce("links", F.lit(0)).alias("links"), "b.match_id", "b.shift", (-F.col("b.r")).alias("run"), "b.errors")
