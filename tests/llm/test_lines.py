import hashlib

from weftline.llm import lines, queries

from .fixtures import SCHEMA, clashing, docs, odd_rows, prose


def plain_chunks(data):
    """(first line, end line, bytes) of each chunk: a line ends one if the weighted sum of its and the last lines' hashes says so."""
    parts, out, first = data.split(b"\n"), [], 0
    hashes = [int(hashlib.md5(x).hexdigest()[:15], 16) for x in parts]
    for i in range(len(parts)):
        value = sum(hashes[i - k] * pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(min(lines.WINDOW, i + 1))) % (1 << 64)
        if (value >> 33) % lines.MEAN == 0 and i + 1 - first >= lines.LEAST or i == len(parts) - 1:
            out.append((first, i + 1, b"\n".join(parts[first:i + 1]) + (b"\n" if i < len(parts) - 1 else b"")))
            first = i + 1
    return out


def brute(rows):
    """Kept bytes of each (id, text): chunks of several lines go if an earlier row or place holds the same bytes; a short last one goes with the chunk before it."""
    seen, out = set(), []
    for _, text in sorted(rows, key=lambda r: r[0]):
        parts, gone = plain_chunks((text or "").encode()), set()
        compared = [(k,) for k, (i, j, _) in enumerate(parts) if j - i >= lines.LEAST]
        if len(parts) > 1 and parts[-1][1] - parts[-1][0] < lines.LEAST:
            compared.append((len(parts) - 2, len(parts) - 1))
        for which in compared:
            body = b"".join(parts[k][2] for k in which).removesuffix(b"\n")
            if body in seen:
                gone.update(which)
            seen.add(body)
        out.append((b"".join(whole for k, (_, _, whole) in enumerate(parts) if k not in gone), len(gone)))
    return out


def table():
    menu = [prose(500 + k, 4) for k in range(8)]
    rows = []
    for i in range(40):
        body = [prose(i * 10 + k, 5) for k in range(i % 6)]
        rows.append((i, "\n".join(body + menu[i % 3:] + [prose(900 + i, 3)] * (i % 4) + (menu if i % 5 == 0 else []))))
    return rows + [(100, rows[7][1]), (101, rows[7][1] + "\n"), (102, "\n\n\n\n\n"), (103, "\n\n\n\n\n")]


def test_against_brute_force(spark):
    rows = table()
    found = sorted(lines.dedup_lines(docs(spark, [(i, t, "en", "a", 1) for i, t in rows])).collect(), key=lambda r: r["doc_id"])
    want = brute(rows)
    assert [(bytes(r["kept"]), len(r["removed"])) for r in found] == want
    assert sum(n for _, n in want) >= 10


def test_chunks_cover_and_shift():
    data = "\n".join(prose(k, 3) for k in range(200)).encode()
    spans = lines.chunks(data)
    assert b"".join(data[a:b] for _, _, a, b in spans) == data
    assert [s[1] for s in spans[:-1]] == [s[0] for s in spans[1:]] and spans[-1][1] == 200
    more = b"new line\nanother one\n" + data
    bodies = lambda d: {d[a:b] for _, _, a, b in lines.chunks(d)}
    assert len(bodies(data) - bodies(more)) <= 2  # boundaries move with their lines


def test_query_over_a_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = sorted(queries.op4_line_chunks(spark, sf).collect(), key=lambda r: r["doc_id"])
    assert [(r["kept_sha256"], r["removed_chunks"]) for r in found] == [(hashlib.sha256(k).hexdigest(), n) for k, n in brute(rows)]


def test_odd_rows(spark):
    found = lines.dedup_lines(clashing(docs(spark, odd_rows()))).collect()
    assert len(found) == len(odd_rows())
    assert all(bytes(r["kept"]) == b"" and r["n_lines"] == 1 for r in found if r["doc_id"] in (1, 2))
    assert lines.dedup_lines(spark.createDataFrame([], SCHEMA)).collect() == []
    twice = lines.dedup_lines(docs(spark, [(1, "a\nb\nc\nd\ne\nf", "en", "a", 1)] * 2)).collect()
    assert len({(r["doc_id"], bytes(r["kept"])) for r in twice}) == 1 and len(twice) == 2


def test_exact_copies_go_whole(spark):
    """Copies of texts of several lines leave nothing, whatever their last chunk; those that differ in the last line keep it alone or with its chunk."""
    texts = ["\n".join(prose(100 * k + i, 4) for i in range(2 + k % 9)) for k in range(30)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(100 + k, t) for k, t in enumerate(texts)] + [(200 + k, t + " more") for k, t in enumerate(texts)]
    found = {r["doc_id"]: bytes(r["kept"]) for r in lines.dedup_lines(docs(spark, [(i, t, "en", "a", 1) for i, t in rows])).collect()}
    assert all(found[k] == t.encode() and found[100 + k] == b"" for k, t in enumerate(texts))
    assert all(found[200 + k].endswith(b" more") for k in range(30)) and sum(len(found[200 + k].split(b"\n")) == 1 for k in range(30)) >= 3
