import re
from collections import Counter

import corpus_pipeline
from weftline.llm import decontaminate, langid, queries, simhash

from .fixtures import SCHEMA, clashing, docs, odd_rows
from .test_sharding import check_law

SF = "/root/testdata/sf0.01"


def test_stages(spark, tmp_path):
    """Each stage on what the one before kept; what each may drop is held against brute force."""
    at = spark.read.parquet(f"{SF}/documents.parquet")
    columns, bench = at.columns, [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    norm = lambda t: " " + " ".join(decontaminate.words_of(t)) + " "
    leaks = lambda t: any(norm(b) in norm(t) for b in bench)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "mix", "shard"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r for r in at.collect()}
        out = stage(spark, at, SF)
        out.write.parquet(path := str(tmp_path / name))
        out = spark.read.parquet(path)
        rows = out.collect()
        if k < 4:
            assert out.columns == columns
            assert all(r == before[r["doc_id"]] for r in rows)
        kept = {r["doc_id"] for r in rows}
        gone = set(before) - kept
        print(name, len(before), len(rows))
        if name == "language_id":
            assert all(i in gone for i, r in before.items() if not langid.has_letter(r["text"]))
            assert len(gone) < 0.02 * len(before)
        elif name == "near_dedup":
            groups = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(at).collect()}
            assert Counter(groups[i] for i in kept) == Counter(set(groups.values()))
        elif name == "decontamination":
            assert gone >= {i for i, r in before.items() if leaks(r["text"])} and len(gone) < 0.05 * len(before)
        elif name == "mix":
            sizes, taken = Counter(), Counter()
            for r in before.values():
                sizes[r["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
            for r in rows:
                taken[r["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
            assert max(Counter(r["doc_id"] for r in rows).values()) <= 3
            assert abs(sum(taken.values()) - sum(sizes.values())) < 0.1 * sum(sizes.values())
        else:
            assert len(rows) == at.count()
            check_law(rows, corpus_pipeline.N_SHARDS)
        at = out


def test_odd_rows(spark):
    at = clashing(docs(spark, odd_rows()))
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, at, SF)
        assert out.columns == at.columns
        at = out.cache()
    assert corpus_pipeline.STAGES[4][1](spark, at, SF).count() == at.count()
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).collect() == []


def test_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {f"op{n}" for n in range(1, 11)} == {m[0] for x in names if (m := re.match(r"op\d+", x))} and "pipeline" in names
    assert set(queries.queries()) <= names and set(__spark_entry__.oracle_sql()) <= names
