import random
import re
from itertools import combinations

import pytest
import xxhash

from weftline.llm import queries, simhash
from weftline.llm.components import connected_components

from .fixtures import SCHEMA, clashing, docs, odd_rows, prose


def fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, ids, distance=4):
    """Smallest id reachable, by comparing all pairs."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                parent[find(i)] = find(j)
    least = {}
    for i, x in enumerate(ids):
        least[find(i)] = min(least.get(find(i), x), x)
    return [least[find(i)] for i in range(len(prints))]


def near_prints(n, seed=3):
    rng = random.Random(seed)
    seeds = [rng.getrandbits(64) for _ in range(n // 4)]
    out = []
    for _ in range(n):
        x = rng.choice(seeds)
        for _ in range(rng.randrange(7)):
            x ^= 1 << rng.randrange(64)
        out.append(x)
    return out


@pytest.mark.parametrize(("paired", "blocks"), [(256, None), (1, 6), (3, 8)])
def test_links_join_what_all_pairs_join(spark, paired, blocks):
    """Whatever goes by pairs and whatever by midpoints, the components are those of all links."""
    prints = sorted(set(near_prints(250)))
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    links = simhash.close_links(spark.createDataFrame([(x,) for x in signed], "fp long"), paired=paired, n_blocks=blocks)
    root = {r["node"]: r["root"] for r in connected_components(links).collect()}
    assert [root.get(x, x) for x in signed] == components(prints, signed)


def test_near_duplicates(spark):
    given = []
    for i in range(120):
        words = prose(i % 30, 1500).split()
        if i >= 30:
            words[i] = "changed"
        given.append((1000 - i, " ".join(words), "en", "a", 1))
    given += [(2000, "", "en", "a", 1), (2001, None, "en", "a", 1), (2002, " \n", "en", "a", 1), (2003, "One Two", "en", "a", 1), (2004, "one\ttwo", "en", "a", 1)]
    prints = [fingerprint(r[1]) for r in given]
    want = components(prints, [r[0] for r in given])
    found = {r["doc_id"]: r for r in simhash.near_duplicates(docs(spark, given)).collect()}
    for r, p, c in zip(given, prints, want):
        assert found[r[0]]["fp"] % (1 << 64) == p and found[r[0]]["component_id"] == c
    assert len(set(want)) < len(given) / 2
    kept = [r["doc_id"] for r in simhash.keep_one(docs(spark, given)).collect()]
    assert sorted(kept) == sorted(set(want))


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    prints = [fingerprint(r["text"]) for r in rows]
    want = {r["doc_id"]: (f"{p:016x}", c) for r, p, c in zip(rows, prints, components(prints, [r["doc_id"] for r in rows]))}
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op7_simhash(spark, sf).collect()} == want


def test_odd_rows(spark):
    df = clashing(docs(spark, odd_rows()))
    found = simhash.near_duplicates(df).collect()
    assert len(found) == len(odd_rows())
    assert {r["component_id"] for r in found if r["fp"] == 0} == {1}
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert kept.count() == len({r["component_id"] for r in found if r["component_id"] is not None}) + sum(r["component_id"] is None for r in found)
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).collect() == [] and simhash.keep_one(empty).collect() == []


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100), (7, 7), (200, 201), (201, 200)] + [(300, 300 + k) for k in range(1, 50)]
    root = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert {root[i] for i in range(41)} == {0} and root[201] == 200 and {root[300 + k] for k in range(50)} == {300}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_values_around(spark, distance):
    value = -(1 << 63) + 12345
    found = spark.createDataFrame([(value,)], "fp long").selectExpr(f"{simhash.within('fp', distance)} as x").first()["x"]
    masks = [sum(1 << b for b in c) for r in range(distance + 1) for c in combinations(range(64), r)]
    assert sorted(x % (1 << 64) for x in found) == sorted(value % (1 << 64) ^ m for m in masks)


def test_plans_of_links_are_short(spark):
    """The driver keeps a copy for each stage."""
    links = simhash.close_links(spark.createDataFrame([(x,) for x in range(50)], "fp long"))
    assert len(links._jdf.queryExecution().toString()) < 40_000


def test_joins_stay_off_the_driver(spark):
    """Midpoints of a large bucket are thousands of rows for each fingerprint, which Spark takes for few and would broadcast."""
    fps = spark.createDataFrame([(x,) for x in range(40)], "fp long")
    links = simhash.close_links(fps, paired=4)
    assert {(r["a"], r["b"]) for r in links.collect()}
    found = simhash.near_duplicates(spark.createDataFrame([(i, f"one two three four {i}") for i in range(40)], "doc_id long, text string"))
    assert found.count() == 40
    for df in (links, found):
        df._jdf.queryExecution().toRdd().count()
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
