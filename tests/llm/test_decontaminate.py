import random

import numpy as np

from weftline.llm import decontaminate, queries

from .fixtures import SCHEMA, clashing, docs, odd_rows, prose


def brute(text, item, similarity=decontaminate.SIMILARITY):
    """Fewest word edits from the item to any part of the text; None over the limit."""
    a, b = decontaminate.words_of(item), decontaminate.words_of(text)
    if not a or not b:
        return None
    row = np.zeros(len(b) + 1, int)
    for i, x in enumerate(a, 1):
        new = np.empty_like(row)
        new[0] = i
        for j, y in enumerate(b, 1):
            new[j] = min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1)
        row = new
    best = int(row.min())
    return best if best <= int((1 - similarity) * len(a) + 1e-9) else None


def edited(text, edits, rng):
    words = text.split()
    for _ in range(edits):
        i = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words[i] = "altered"
        elif kind == 1:
            del words[i]
        else:
            words.insert(i, "added")
    return " ".join(words)


def test_against_brute_force(spark):
    rng = random.Random(8)
    items = [(k, prose(300 + k, 10 + 3 * k)) for k in range(12)]
    rows = []
    for i in range(150):
        _, text = rng.choice(items)
        n = len(text.split())
        passage = edited(text, rng.randrange(0, n // 4 + 2), rng)
        rows.append((i, f"{prose(i, rng.randrange(0, 30))} {passage.title()}, {prose(i + 999, rng.randrange(0, 30))}"))
    found = decontaminate.benchmark_matches(docs(spark, [(i, t, "en", "a", 1) for i, t in rows]), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in found}
    want = {(i, k): e for i, t in rows for k, x in items if (e := brute(t, x)) is not None}
    assert got.items() <= want.items()  # what is found is exact
    assert len(got) >= 0.98 * len(want) and len(want) > 90
    for r in found:
        n = len(decontaminate.words_of(dict(items)[r["item_id"]]))
        assert abs(r["similarity"] - (1 - r["edits"] / n)) < 1e-12 and r["similarity"] >= 0.8
        assert 0 <= r["first_word"] <= r["end_word"]


def test_full_table_of_keys(spark, monkeypatch):
    """A table so small that nearly all its bits are set lets windows through and changes nothing."""
    items = spark.createDataFrame([(k, prose(300 + k, 20)) for k in range(9)], "item_id long, text string")
    df = docs(spark, [(k, prose(300 + k, 20), "en", "a", 1) for k in range(12)])
    whole = {tuple(r) for r in decontaminate.benchmark_matches(df, items).collect()}
    monkeypatch.setattr(decontaminate, "SLOT_BITS", 15)
    assert whole == {tuple(r) for r in decontaminate.benchmark_matches(df, items).collect()} and len(whole) == 9
    assert sorted(r["doc_id"] for r in decontaminate.decontaminate(df, items).collect()) == [9, 10, 11]


def test_texts_in_parts(spark, monkeypatch):
    """Reading few bytes and few windows at a time changes nothing."""
    items = spark.createDataFrame([(k, prose(300 + k, 5 + 9 * k)) for k in range(9)], "item_id long, text string")
    df = docs(spark, [(k, prose(k, 40) + " " + prose(300 + k % 12, 5 + 9 * (k % 12)) + " " + prose(k + 50, 90), "en", "a", 1) for k in range(40)] + [(99, "", "en", "a", 1), (98, None, "en", "a", 1)])
    whole = {tuple(r) for r in decontaminate.benchmark_matches(df, items).collect()}
    monkeypatch.setattr(decontaminate, "BYTES", 300)
    monkeypatch.setattr(decontaminate, "TOGETHER", 7)
    assert whole == {tuple(r) for r in decontaminate.benchmark_matches(df, items).collect()} and len(whole) >= 30
    assert [(i, len(t)) for i, t in decontaminate.grouped(["a" * 200, None, "b" * 200, "c" * 900, "", "d"])] == [(0, 2), (2, 1), (3, 1), (4, 2)]


def test_walks_keep_near_texts_near():
    """Embeddings of texts within few edits agree in far more steps than those of others."""
    def walks(words):
        codes = decontaminate.Lines([" ".join(words)]).codes
        return np.concatenate([decontaminate.embedding(codes, np.zeros(1, np.int64), decontaminate.moves(codes, w, 100), 100)[:60, 0] for w in range(20)])

    words = prose(1, 60).split()
    near, far = words[:10] + words[11:] + ["end"], prose(2, 60).split()
    agree = lambda a, b: np.mean(walks(a) == walks(b))
    assert agree(words, words) == 1 and agree(words, near) > 0.5 > 0.1 > agree(words, far)


def test_codes_and_parts():
    """Equal words have equal codes wherever they stand; parts are the words' own bytes."""
    texts = ["", "a bb ccc", "Ünïcödé_bb ccc--A", "", "1", "bb"]
    lines = decontaminate.Lines([decontaminate.line_of(t) for t in texts])
    words = [w for t in texts for w in [*decontaminate.words_of(t), None]]
    assert lines.sizes.tolist() == [0, 3, 4, 0, 1, 1] and len(lines.codes) == len(words)
    seen = {}
    for w, c in zip(words, lines.codes.tolist()):
        assert (c == 0) == (w is None) and seen.setdefault(w, c) == c
    assert len(set(seen.values())) == len(seen) and lines.part(2, 1, 9) == "bb ccc a" and lines.part(1, 0, 2) == "a bb"
    assert len(decontaminate.Lines([]).codes) == 0 and len(decontaminate.Lines(["", ""]).codes) == 2


def test_edit_distance():
    """Against the whole table of distances, in edits and in place."""
    rng = random.Random(3)
    for _ in range(300):
        item, window = ([rng.choice("abc") for _ in range(rng.randrange(1, k))] for k in (9, 14))
        row = [(0, j) for j in range(len(window) + 1)]
        for i, x in enumerate(item, 1):
            new = [(i, 0)]
            for j, y in enumerate(window, 1):
                new.append(min((row[j - 1][0] + (x != y), row[j - 1][1]), (row[j][0] + 1, row[j][1]), (new[j - 1][0] + 1, new[j - 1][1])))
            row = new
        edits, end = min((c, j) for j, (c, _) in enumerate(row))
        assert decontaminate.best_alignment(item, window) == (edits, row[end][1], end)


def test_recall_of_items_of_every_size(spark):
    """Against brute force; passages of up to the allowed edits, those of none are all found."""
    rng = random.Random(12)
    items = [(n, prose(500 + n, n)) for n in (1, 2, 3, 5, 7, 8, 13, 16, 24, 40, 63, 64, 100)]
    rows = []
    for i in range(390):
        n, text = items[i % len(items)]
        rows.append((i, f"{prose(i, rng.randrange(30))} {edited(text, rng.randrange(int(0.2 * n + 1e-9) + 1), rng) if i % 2 else text} {prose(i + 999, rng.randrange(30))}"))
    found = decontaminate.benchmark_matches(docs(spark, [(i, t, "en", "a", 1) for i, t in rows]), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r["doc_id"], r["item_id"]) for r in found}
    want = {(i, n): e for i, t in rows for n, x in items if (e := brute(t, x)) is not None}
    print("recall", len(got), len(want))
    assert got <= want.keys() and len(got) >= 0.95 * len(want)
    assert got >= {k for k, e in want.items() if e == 0}


def test_query_finds_every_passage(spark):
    sf = "/root/testdata/sf0.01"
    found = {(r["doc_id"], r["item_id"]) for r in queries.op9_benchmark_matches(spark, sf).collect()}
    norm = lambda t: " " + " ".join(decontaminate.words_of(t)) + " "
    items = [(r["item_id"], norm(r["text"])) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {(r["doc_id"], k) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() for k, x in items if x in norm(r["text"])}
    assert want <= found and len(want) > 10


def test_odd_rows(spark):
    df = clashing(docs(spark, odd_rows()))
    bench = spark.createDataFrame([(1, "same text twice in a row"), (2, None), (None, "no id here at all"), (3, ""), (1, "other words of the same id")], "item_id long, text string")
    found = decontaminate.benchmark_matches(df, bench).collect()
    assert sorted(r["doc_id"] for r in found) == [5, 5, 6] and all(r["edits"] == 0 for r in found)
    kept = decontaminate.decontaminate(df, bench)
    assert kept.columns == df.columns and kept.count() == len(odd_rows()) - 3
    empty = spark.createDataFrame([], SCHEMA)
    assert decontaminate.benchmark_matches(empty, bench).collect() == [] and decontaminate.decontaminate(empty, bench).collect() == []
    assert decontaminate.benchmark_matches(df, bench.limit(0)).collect() == [] and decontaminate.decontaminate(df, bench.limit(0)).count() == len(odd_rows())


def test_items_without_an_integer_id_count_in_the_pipeline(spark, tmp_path):
    import corpus_pipeline

    passages = [prose(70 + k, 40) for k in range(3)]
    given = docs(spark, [(k, prose(80 + k, 20) + " " + p + " " + prose(90 + k, 20), "en", "a", 1) for k, p in enumerate([*passages, prose(99, 40)])])
    for k, ids in enumerate(([None, "x-1", "7"], [None, None, 7])):
        kind = "string" if k == 0 else "long"
        spark.createDataFrame([*zip(ids, passages)], f"item_id {kind}, text string").write.parquet(f"{tmp_path}/{k}/benchmark.parquet")
        assert [r["doc_id"] for r in corpus_pipeline.decontamination(spark, given, f"{tmp_path}/{k}").collect()] == [3]
