import hashlib
import zlib
from collections import Counter, defaultdict

import pytest

from weftline.llm import common, sharding

from .fixtures import SCHEMA, clashing, docs, odd_rows


def rows_of(n):
    return [(i, f"t{i % 97}", "en", "hot" if i % 3 == 0 else f"s{i % 7}", 1) for i in range(n)]


def run(df, n_shards=6):
    return sharding.interleave_shards(df, n_shards).collect()


def check_law(found, n_shards):
    shards = defaultdict(list)
    for r in found:
        assert 0 <= r["shard"] < n_shards and r["law"] == "rows" and r["grown_shard"] is None
        shards[r["shard"]].append(r["slot"])
    for slots in shards.values():
        assert sorted(slots) == list(range(len(slots)))
    sizes = [len(shards[s]) for s in range(n_shards)]
    assert max(sizes) - min(sizes) <= 1


def test_law_and_mixture(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 64)  # many buckets
    given = rows_of(2000)
    found = run(docs(spark, given))
    assert len(found) == 2000
    check_law(found, 6)
    source = {r[0]: r[3] for r in given}
    whole = Counter(source.values())
    for s in range(6):
        part = Counter(source[r["doc_id"]] for r in found if r["shard"] == s)
        for name, n in whole.items():
            assert abs(part[name] - n / 6) <= 2, (s, name)


def test_digest_columns(spark):
    for r, g in zip(sorted(run(docs(spark, rows_of(50))), key=lambda r: r["doc_id"]), rows_of(50)):
        assert r["size"] == len(g[1].encode()) + 8 and r["text_crc32"] == zlib.crc32(g[1].encode())


def brute(given, n_shards, n_buckets, seed=7):
    """(id, crc, size, shard, slot) by plain sorts: rank within the source, then one order of all fractional ranks."""
    rows = defaultdict(list)
    for doc_id, text, _, source, _ in given:
        data = (text or "").encode()
        crc, size = zlib.crc32(data), len(data) + 8
        u = int(hashlib.md5("|".join([str(seed), "" if doc_id is None else str(doc_id), str(crc), str(size)]).encode()).hexdigest()[:15], 16)
        rows[source].append((u % n_buckets, u, doc_id is not None, doc_id or 0, size, crc, doc_id))
    ranks = [((k + 0.5) / len(part), source is None, source or "", r[6], r[5], r[4]) for source, part in rows.items() for k, r in enumerate(sorted(part))]
    total, out, slots = len(given), [], Counter()
    for pos, (_, _, _, doc_id, crc, size) in enumerate(sorted(ranks, key=lambda r: r[:3])):
        shard = pos * n_shards // total
        out.append((doc_id, crc, size, shard, slots[shard]))
        slots[shard] += 1
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket_rows", [16, 64, 1 << 30])
def test_same_as_a_sort(spark, monkeypatch, bucket_rows):
    """Against one global sort, with one bucket and with many, repeated rows and null sources included."""
    monkeypatch.setattr(sharding, "BUCKET_ROWS", bucket_rows)
    monkeypatch.setattr(common, "REPEATS", 50)
    given = rows_of(400) + [(7000 + i, "x", "en", None, 1) for i in range(30)] + [(9, "again", "en", "hot", 1)] * 170 + odd_rows()
    found = run(docs(spark, given).repartition(5))
    assert sorted(((r["doc_id"], r["text_crc32"], r["size"], r["shard"], r["slot"]) for r in found), key=repr) == brute(given, 6, max(1, -(-len(given) // bucket_rows)))


def test_sums_before_in_two_levels(spark):
    rows = [(s, b, b % 7 + 1) for s in ("a", None, "b") for b in range(0, 60, 1 if s else 3)]
    per = spark.createDataFrame(rows, "s string, b int, n long")
    found = common.summed_before(per, ["s"], "b", "n", "out", fan=4).collect()
    assert len(found) == len(rows)
    assert all(r["out"] == sum(n for s, b, n in rows if s == r["s"] and b < r["b"]) for r in found)


def test_odd_rows(spark):
    df = clashing(docs(spark, odd_rows()))
    found = run(df, 5)
    assert len(found) == len(odd_rows())
    check_law(found, 5)
    assert all(r["size"] == 8 and r["text_crc32"] == 0 for r in found if r["doc_id"] in (1, 2))
    assert run(spark.createDataFrame([], SCHEMA)) == []
    check_law(run(docs(spark, rows_of(3)), 24), 24)


def test_plan_of_rows_is_short(spark):
    """It holds no copies of the plans of counts; the driver keeps one for each stage."""
    df = sharding.interleave_shards(docs(spark, rows_of(500)), 5)
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange") <= 12
