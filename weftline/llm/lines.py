"""Line deduplication by content-defined chunks of lines."""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, packed, rows_of, stored, unpack

#: A line ends a chunk if the rolling hash of its last ``WINDOW`` lines is 0 modulo ``MEAN``; chunks have ``LEAST`` lines or more.
WINDOW, MEAN, LEAST = 2, 3, 2
BASE, _M = 0x9E3779B97F4A7C15, (1 << 64) - 1


def line_hash(line: bytes) -> int:
    """60 bits of MD5, which other engines have too."""
    return int.from_bytes(md5(line, usedforsecurity=False).digest()[:8], "big") >> 4


def chunks(data: bytes, window: int = WINDOW, mean: int = MEAN, least: int = LEAST) -> list[tuple[int, int, int, int]]:
    """(first line, end line, first byte, end byte) of each chunk; the line feeds belong to their lines.

    Boundaries depend on the last ``window`` lines only, so they shift with their lines: text put in
    or taken out elsewhere leaves later chunks as they were.
    """
    lines = data.split(b"\n")
    top = pow(BASE, window, 1 << 64)
    out, hashes, roll, line0, byte0, at = [], [], 0, 0, 0, 0
    for i, line in enumerate(lines):
        h = line_hash(line)
        hashes.append(h)
        roll = (roll * BASE + h - (hashes[i - window] * top if i >= window else 0)) & _M
        at += len(line) + 1
        if (roll >> 33) % mean == 0 and i + 1 - line0 >= least:
            out.append((line0, i + 1, byte0, min(at, len(data))))
            line0, byte0 = i + 1, at
    if line0 < len(lines):
        out.append((line0, len(lines), min(byte0, len(data)), len(data)))
    return out


def units(spans: list[tuple[int, int, int, int]], least: int) -> list[tuple[int, int, int]]:
    """(number, first chunk, end chunk) of what is compared: chunks of ``least`` or more lines, and a shorter last one with the chunk before it."""
    out = [(k, k, k + 1) for k, (i, j, _, _) in enumerate(spans) if j - i >= least]
    if len(spans) > 1 and spans[-1][1] - spans[-1][0] < least:
        out.append((len(spans), len(spans) - 2, len(spans)))
    return out


def _key(data: bytes) -> tuple[int, int]:
    import xxhash

    x = xxhash.xxh3_128_intdigest(data)
    sign = lambda v: v - (1 << 64) if v >> 63 else v
    return sign(x >> 64), sign(x & _M)


def _body(data: bytes) -> bytes:
    """A chunk's bytes as compared: without the last line feed, so that a chunk at a text's end equals others."""
    return data[:-1] if data.endswith(b"\n") else data


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, mean: int = MEAN, least: int = LEAST) -> DataFrame:
    """Every row of ``docs`` without chunks of ``least`` or more lines that stand earlier in the corpus.

    A rolling hash over line hashes cuts each text into chunks. Where the last one is shorter it is also compared together with the
    chunk before it, so exact copies go whole. Of chunks with equal bytes the
    first (by id, null first, then place in the text) stays and the others go, in whatever rows.
    128-bit hashes nominate; before a chunk goes its bytes are compared with the first one's.

    Returns ``doc_id``, ``n_lines``, ``n_chunks``, ``removed`` (array of line ranges, end excluded)
    and ``kept`` (binary). Null texts are empty ones (one empty line). Rows of equal id and text
    are one document given repeatedly: each keeps what it would alone. Blank lines are lines; very long texts and lines are read whole, a
    row at a time; ties between chunks of one id and place go to the row of least hash. An
    empty table gives no rows; other columns, whatever their names, are ignored. Hot chunks are counted before the
    shuffle and meet their first in an equi-join, which is split when skewed.
    """
    def hashed(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for row, doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                data = (text or "").encode("utf-8", "surrogatepass")
                spans = chunks(data, window, mean, least)
                rows += [(row, doc, k, *_key(_body(data[spans[i][2]:spans[j - 1][3]]))) for k, i, j in units(spans, least)]
            cols = [*zip(*rows)] or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["row", "doc_id", "chunk", "h1", "h2"])

    all_chunks = map_batches(rows_of(docs, id_col, text_col), hashed, "row long, doc_id long, chunk long, h1 long, h2 long")
    again = all_chunks.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "row", "chunk")).alias("one")).filter("n > 1") \
        .select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), F.col("one.row").alias("_row"), F.col("one.chunk").alias("_chunk"))
    found = all_chunks.join(again, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))) \
        .select("row", F.struct("chunk", "h1", "h2", ((F.col("row") == F.col("_row")) & (F.col("chunk") == F.col("_chunk"))).alias("first")).alias("ask"))
    asks = found.groupBy("row").agg(F.collect_set("ask").alias("asks")).withColumnRenamed("row", "_row")

    def spoken(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for row, z, wanted in zip(*(c.to_pylist() for c in batch.columns)):
                data = unpack(z)
                spans = chunks(data, window, mean, least)
                at = {k: (spans[i][2], spans[j - 1][3]) for k, i, j in units(spans, least)}
                rows += [(row, x["chunk"], x["h1"], x["h2"], x["first"], _body(data[slice(*at[x["chunk"]])])) for x in wanted]
            cols = [*zip(*rows)] or [()] * 6
            kinds = [pa.int64()] * 4 + [pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["row", "chunk", "h1", "h2", "first", "body"])

    texts = packed(docs, id_col, text_col)
    bodies = stored(map_batches(texts.select("row", "z").join(asks, F.col("row") == F.col("_row")).select("row", "z", "asks"), spoken, "row long, chunk long, h1 long, h2 long, first boolean, body binary"))
    firsts = bodies.filter("first").groupBy("h1", "h2").agg(F.min("body").alias("_body")).select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "_body")
    gone = bodies.filter("not first").join(firsts, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")) & (F.col("body") == F.col("_body"))).select("row", "chunk")
    gone = gone.groupBy("row").agg(F.collect_set("chunk").alias("gone")).withColumnRenamed("row", "_row")

    def rest(batches):
        import pyarrow as pa

        ranges = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            rows = []
            for doc, z, out in zip(*(c.to_pylist() for c in batch.columns)):
                data, out = unpack(z), set(out or ())
                spans = chunks(data, window, mean, least)
                out = {c for k, i, j in units(spans, least) if k in out for c in range(i, j)}
                kept = b"".join(data[a:b] for k, (_, _, a, b) in enumerate(spans) if k not in out)
                rows.append((doc, spans[-1][1], len(spans), [{"start": spans[k][0], "end": spans[k][1]} for k in sorted(out)], kept))
            cols = [*zip(*rows)] or [()] * 5
            kinds = [pa.int64()] * 3 + [ranges, pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "n_lines", "n_chunks", "removed", "kept"])

    joined = texts.join(gone, F.col("row") == F.col("_row"), "left").select("doc_id", "z", "gone")
    return map_batches(joined, rest, "doc_id long, n_lines long, n_chunks long, removed array<struct<start:long,end:long>>, kept binary")
