import struct

import numpy as np
from pyspark.sql import functions as F

from weftline.llm import audio, queries

from .fixtures import clashing, docs, odd_rows


def tune(seed, seconds=3.0):
    """8-bit notes of a seeded melody."""
    rng = np.random.default_rng(seed)
    t = np.arange(int(seconds * audio.RATE)) / audio.RATE
    notes = 220 * 2 ** (rng.integers(0, 24, 400) / 12)
    f = notes[(t / 0.11).astype(int)]
    return (128 + 90 * np.sin(2 * np.pi * np.cumsum(f) / audio.RATE)).astype(np.uint8)


def media(spark, rows):
    return spark.createDataFrame([(i, bytearray(b) if b is not None else None) for i, b in rows], "doc_id long, recording binary").repartition(3)


def test_integral_image_is_plain_sums():
    image = audio.chroma(tune(3, 0.5))
    got = audio.integers(image)
    kind, p, h, w = audio.FILTERS[0]
    at = 7
    a, b = image[at:at + w, p:p + h].sum(), image[at:at + w].sum() * h / 12
    v = np.log((1 + a) / (1 + b))
    two = int(v > -audio.STEP) + int(v > 0) + int(v > audio.STEP)
    assert len(got) == len(image) - audio.SPAN + 1 and got[at] >> 30 == two ^ (two >> 1)
    many = audio.fingerprints_of([tune(1, 0.4).tobytes(), b"", None, tune(2, 0.3).tobytes()])
    assert np.array_equal(many[0], audio.fingerprint(tune(1, 0.4).tobytes())) and len(many[1]) == len(many[2]) == 0
    assert np.array_equal(many[3], audio.fingerprint(tune(2, 0.3).tobytes()))


def test_wave_files():
    x = tune(1, 0.2)
    head = b"RIFF" + struct.pack("<I", 36 + len(x)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, 8000, 8000, 1, 8) + b"data" + struct.pack("<I", len(x))
    assert np.array_equal(audio.samples_of(head + x.tobytes()), x)
    wide = ((x.astype(np.int16) - 128) << 8).tobytes()
    head = b"RIFF" + struct.pack("<I", 36 + len(wide)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, 8000, 16000, 2, 16) + b"data" + struct.pack("<I", len(wide))
    assert np.array_equal(audio.samples_of(head + wide), x)


def align(spark, rows, least_run=audio.LEAST_RUN, ask="doc_id % 50 = 0"):
    """({(query, match): link}, {id: class}) with classes by their least id."""
    segments = audio.media_segments(media(spark, rows), "doc_id", "recording", F.expr(ask), least_run).cache()
    membership, links = audio.align_recordings(segments, least_run)
    least, of = {}, {}
    for r in sorted(membership.collect(), key=lambda r: r["doc_id"]):
        of[r["doc_id"]] = least.setdefault((r["c1"], r["n"]), r["doc_id"])
    return {(least[r["c1"], r["n"]], least[r["m1"], r["mn"]]): r for r in links.collect()}, of


def test_alignment(spark):
    """An excerpt, a noisy copy and an exact copy are found with their shift; other tunes are not."""
    rng = np.random.default_rng(5)
    base = tune(7)
    noisy = np.clip(base.astype(int) + rng.integers(-2, 3, len(base)), 0, 255).astype(np.uint8)
    rows = [(50, base), (51, base), (52, base[audio.HOP * 200:audio.HOP * 600]), (53, noisy), (54, base[5000 + 13:]), *((100 + k, tune(20 + k)) for k in range(30)), (60, b""), (61, None)]
    rows = [(i, x.tobytes() if isinstance(x, np.ndarray) else x) for i, x in rows]
    links, of = align(spark, rows, 100, "doc_id = 50")  # longer than a few common notes
    links = {i: r for (_, i), r in links.items()}
    assert set(links) == {52, 53, 54} and links[52]["shift"] == -200 and links[53]["shift"] == 0 and links[54]["shift"] in (-156, -157)
    assert links[52]["run"] == 400 - audio.SPAN + 1 - (audio.FRAME // audio.HOP - 1) and links[52]["errors"] == 0
    assert of[51] == 50
    found = audio.search_recordings(media(spark, rows), "doc_id", "recording", least_run=100).collect()
    assert sorted(r["doc_id"] for r in found) == [50, 100] and {r["doc_id"]: r["copies"] for r in found}[50] == 1


def test_one_id_with_two_recordings(spark):
    """Classes go by content: each recording of an id is a member of its own class, and no match is lost."""
    a, b, c = tune(1).tobytes(), tune(2).tobytes(), tune(3).tobytes()
    rows = [(50, a), (50, b), (7, a[640:]), (8, b), (9, b[3200:]), (9, c)]
    found = audio.search_recordings(media(spark, rows), "doc_id", "recording", least_run=100).collect()
    got = sorted((r["class_id"], r["copies"], r["links"], r["match_id"]) for r in found)
    assert got == [(8, 1, 1, 9), (50, 0, 1, 7)]


def test_segments_hold_every_window_once():
    for n in (3, 16, 17, 175, 176, 177, 190, 191, 192, 193, 700):
        prints = np.arange(n, dtype=np.uint32)
        seen = [int(p[i]) for _, p in audio.segments_of(prints, 16) for i in range(len(p) - 15)]
        assert seen == list(range(max(0, n - 15)))


def brute_links(rows, asks, least_run=audio.LEAST_RUN, most_errors=audio.BIT_ERRORS):
    """Pairs of different recordings with a stretch of few enough wrong bits at any shift at all, the query from any start."""
    prints, found = {i: audio.fingerprint(b) for i, b in rows}, set()
    for q, sound in ((i, b) for i, b in rows if i in asks):
        for x in (audio.fingerprint(sound[start:]) for start in audio.STARTS):
            for i, y in prints.items():
                if i == q or (q, i) in found or np.array_equal(y, prints[q]) or min(len(y), len(x)) < least_run:
                    continue
                wrong = np.bitwise_count(x[:, None] ^ y[None, :]).astype(np.int32)
                sums = np.zeros((wrong.shape[0] + 1, wrong.shape[1] + 1), np.int32)
                for k in range(len(wrong)):
                    sums[k + 1, 1:] = sums[k, :-1] + wrong[k]
                if (sums[least_run:, least_run:] - sums[:-least_run, :-least_run]).min() <= most_errors * 32 * least_run:
                    found.add((q, i))
    return found


def test_recall_over_a_table(spark):
    """Against brute force over all shifts of all pairs, the index finds at least nine of ten, and nothing else."""
    rows = [(r["doc_id"], r["text"].encode()) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    texts = dict(rows)
    for k in range(12):  # copies with a few edits, cut at any byte
        text = texts[50 * k]
        rows.append((100_001 + k, b"lead-in %d " % k + text[7 * k:400] + b"edit" + text[400:]))
    want = brute_links(rows, {i for i, _ in rows if i % 50 == 0})
    links, of = align(spark, rows)
    want = {(of[q], of[i]) for q, i in want}
    print("recall", len(want & links.keys()), len(want))
    assert len(want) >= 8 and len(want & links.keys()) >= 0.9 * len(want) and links.keys() <= want
    found = queries.op10_audio_alignment(spark, "/root/testdata/sf0.01").collect()
    assert {r["doc_id"] for r in found} == {i for i in texts if i % 50 == 0}


def test_odd_rows(spark):
    df = clashing(docs(spark, odd_rows())).withColumn("recording", F.encode("text", "UTF-8"))
    found = audio.search_recordings(df, "doc_id", "recording", every=1).collect()
    ids = [r[0] for r in odd_rows() if r[0] is not None]
    assert sorted(r["doc_id"] for r in found) == sorted(ids)
    for r in found:
        if r["doc_id"] in (1, 2):
            assert (r["n_prints"], r["copies"], r["links"], r["match_id"]) == (0, 1, 0, None)
        if r["doc_id"] in (5, 6):
            assert r["n_prints"] == 1 and r["copies"] >= 2
    assert audio.search_recordings(df.limit(0), "doc_id", "recording").collect() == []


def test_copies_displaced_by_any_number_of_bytes(spark):
    """What lies between two hops of the query is found from the start that meets it."""
    texts = [r["text"].encode() for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect() if r["text"] and 1500 <= len(r["text"]) <= 4000]
    rows = []
    for k, text in enumerate(texts[:72:3]):
        rows += [(50 * k + 50, text), (50 * k + 51, text[12 + k % 9:])]
    want = {(q, i) for q, i in brute_links(rows, {i for i, _ in rows if i % 50 == 0}) if i == q + 1}
    links, _ = align(spark, rows)
    print("displaced copies", len(want & links.keys()), "of", len(want))
    assert len(want) >= 23 and len(want & links.keys()) >= 23
    found = {r["doc_id"]: r["links"] for r in audio.search_recordings(media(spark, rows), "doc_id", "recording").collect()}
    assert sum(n > 0 for n in found.values()) >= 23


def nominated(a, b):
    """The rule of the join: a common key whose integers before it differ or are missing."""
    first, second = (dict(zip(*(c.tolist() for c in audio.index_keys(x)))) for x in (a, b))
    return [k for k in first.keys() & second.keys() if first[k] != second[k] or first[k] == 0]


def test_every_run_of_integers_is_indexed():
    """Two segments that share three successive integers are nominated, once for a run."""
    rng = np.random.default_rng(9)
    a, b = rng.integers(0, 1 << 32, (2, 120), dtype=np.uint32)
    assert len(audio.index_keys(a)[0]) == 118 and not nominated(a, b)
    for at in range(0, 118, 7):
        c = b.copy()
        c[at:at + 3] = a[at:at + 3]
        assert len(nominated(a, c)) == 1
        c[at:at + 12] = a[at:at + 12]
        assert len(nominated(a, c)) == 1
    assert len(nominated(a, a)) == 1


def test_segments_that_share_a_key_are_nominated():
    """With few different integers, so that keys repeat within a segment: the rule passes over no pair with a common key."""
    rng = np.random.default_rng(10)
    for _ in range(2000):
        a, b = (rng.integers(0, 4, rng.integers(3, 30)).astype(np.uint32) for _ in range(2))
        common = np.intersect1d(audio.index_keys(a)[0], audio.index_keys(b)[0])
        assert bool(len(common)) == bool(nominated(a, b))


def test_every_shift_is_verified():
    """A qualifying stretch is found although another shift of the same segments has more equal integers."""
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 1 << 32, (2, 120), dtype=np.uint32)
    b[20:28] = a[60:68]  # equal, too short a stretch
    b[100:116] = a[10:26]
    b[99], b[116] = ~a[9], ~a[26]
    b[100:104] ^= np.uint32(1)
    b[110:116] ^= np.uint32(2)  # six equal integers, ten wrong bits
    errors, start, windows, shift, votes = audio.aligned(a, b)
    assert (start, windows, shift, votes) == (10, 1, 90, 6) and abs(errors - 10 / 512) < 1e-12
    assert audio.offset_histogram(a, b)[-40] == 8


def test_window_errors_are_brute_force():
    rng = np.random.default_rng(6)
    for k, run in enumerate((1, 3, 13, 16, 20)):
        a, b = rng.integers(0, 4, 37 + k, dtype=np.uint32), rng.integers(0, 4, 29, dtype=np.uint32)
        got = audio.window_errors(a, b, run)
        assert got.tolist() == [[int(np.bitwise_count(a[i:i + run] ^ b[j:j + run]).sum()) for j in range(len(b) - run + 1)] for i in range(len(a) - run + 1)]
    assert audio.aligned(a[:3], b, 16) is None
