import hashlib
import random

import numpy as np
import pytest

from weftline.llm import repeats

from .fixtures import SCHEMA, clashing, docs, odd_rows, prose


def brute(texts, length):
    """(bytes, removed, spans, kept) of each text, by counting every string."""
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d in data:
        for i in range(len(d) - length + 1):
            seen[d[i:i + length]] = seen.get(d[i:i + length], 0) + 1
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = True
        gone = gone[:-1]
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(d), int(gone.sum()), spans, bytes(np.frombuffer(d, np.uint8)[~gone]) if len(d) else b""))
    return out


def check(spark, texts, length=40, gram=16):
    df = docs(spark, [(i, t, "en", "a", 1) for i, t in enumerate(texts)])
    found = {r["doc_id"]: r for r in repeats.remove_repeats(df, length=length, gram=gram).collect()}
    assert len(found) == len(texts)
    for i, (n, removed, spans, kept) in enumerate(brute(texts, length)):
        r = found[i]
        assert (r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["spans"]), bytes(r["kept"])) == (n, removed, spans, kept), i


def test_planted_passages(spark):
    rng = random.Random(4)
    shared = [prose(100 + k, 12 + k) for k in range(6)]
    texts = []
    for i in range(60):
        parts = [prose(i, rng.randrange(3, 30))]
        for _ in range(rng.randrange(3)):
            s = rng.choice(shared)
            a = rng.randrange(len(s) // 2)
            parts += [s[a:a + rng.randrange(20, len(s))], prose(1000 + i, rng.randrange(1, 6))]
        texts.append(" ".join(parts))
    texts += [texts[3], texts[3][5:], "ü" + texts[4] + "é", texts[5] + texts[5]]
    check(spark, texts)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_small_alphabets(spark, seed):
    """Periodic and dense repeats, overlapping themselves."""
    rng = random.Random(seed)
    texts = ["a" * 150, "ab" * 70, "abc" * 45 + "x" + "abc" * 30, "a" * 39, "b" * 40, "c" * 41]
    texts += ["".join(rng.choice("ab") for _ in range(rng.randrange(300))) for _ in range(20)]
    block = "".join(rng.choice("abcd") for _ in range(200))
    texts += [block[rng.randrange(100):][:rng.randrange(30, 100)] + "".join(rng.choice("abcd") for _ in range(50)) for _ in range(30)]
    check(spark, texts)


def test_production_length(spark):
    p = prose(9, 60)
    check(spark, [prose(1, 80), prose(2, 40) + p + prose(3, 50), p[7:] + prose(4, 20), prose(5, 10), p[:199], p[:200] + "!" + prose(6, 30)], repeats.LENGTH, repeats.GRAM)


def test_blocks_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK", 64)
    check(spark, [prose(1, 60) + " " + prose(2, 9), prose(3, 20) + prose(2, 9) + prose(1, 5)])


def test_odd_rows(spark):
    df = clashing(docs(spark, odd_rows()))
    found = repeats.remove_repeats(df).collect()
    assert len(found) == len(odd_rows())
    assert all(r["n_bytes"] == 0 and bytes(r["kept"]) == b"" and r["spans"] == [] for r in found if r["doc_id"] in (1, 2))
    assert repeats.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []
    twice = repeats.remove_repeats(docs(spark, [(1, prose(1, 90), "en", "a", 1)] * 2)).collect()
    assert len(twice) == 2 and all(bytes(r["kept"]) == b"" and len(r["spans"]) == 1 for r in twice)


def test_query(spark):
    from weftline.llm import queries

    sf = "/root/testdata/sf0.001"
    rows = sorted(spark.read.parquet(f"{sf}/documents.parquet").collect(), key=lambda r: r["doc_id"])
    found = sorted(queries.op3_repeated_bytes(spark, sf).collect(), key=lambda r: r["doc_id"])
    want = brute([r["text"] for r in rows], 200)
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found] == [(n, g, s, hashlib.sha256(k).hexdigest()) for n, g, s, k in want]
