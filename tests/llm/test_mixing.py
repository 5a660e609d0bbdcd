import re
from collections import Counter

from pyspark.sql import functions as F

from weftline.llm import mixing

from .fixtures import SCHEMA, clashing, docs, odd_rows, prose


def water_level(sizes, cap=3.0):
    """Targets by repeated resharing: what goes over its cap is fixed there, the rest is dealt anew."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    want, fixed = float(sum(sizes.values())), {}
    while True:
        left = [s for s in names if s not in fixed]
        rest = want - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = [s for s in left if share[s] > cap * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: cap * sizes[s] for s in over}


def table(n=1500):
    return [(i, prose(i, 1 + i * 7 % 60), "en", "hot" if i % 3 else f"s{i % 11}" if i % 11 else None, 1) for i in range(n)]


def test_targets_and_taken(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FAN_IN", 8)
    given = table()
    found = mixing.mix_sources(docs(spark, given)).collect()
    assert len(found) == len(given)
    sizes, taken, target = Counter(), Counter(), {}
    texts = {r[0]: r for r in given}
    for r in found:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", texts[r["doc_id"]][1]))
        s = texts[r["doc_id"]][3]
        assert r["size"] == n and r["taken"] <= 3 * n and r["taken"] == n * r["copies"]
        sizes[s] += n
        taken[s] += r["taken"]
        target[s] = r["target"]
    want = water_level(sizes)
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 * max(1, want[s])
        assert abs(taken[s] - want[s]) <= 60, s


def test_reruns_agree(spark):
    one = {(r["doc_id"], r["taken"]) for r in mixing.mix_sources(docs(spark, table(300))).collect()}
    assert one == {(r["doc_id"], r["taken"]) for r in mixing.mix_sources(docs(spark, table(300)).repartition(11)).collect()}


def test_expectation_is_kept(spark):
    """Over many groups a row is taken up as often as its probability says."""
    n, p, size = 400, [0.1 + 0.05 * i for i in range(12)], [float(1 + i % 3) for i in range(12)]
    rows = [(f"g{g}", g * 12 + i, p[i], size[i]) for g in range(n) for i in range(12)]
    ups, mass = Counter(), Counter()
    for r in mixing.pivotal_round(spark.createDataFrame(rows, "g string, k long, p double, s double"), "g", "k", "p", "s").collect():
        assert r["p"] in (0.0, 1.0)
        ups[r["key"] % 12] += r["p"]
        mass[r["grp"]] += r["p"] * size[r["key"] % 12]
    assert len(mass) == n and all(abs(m - sum(map(float.__mul__, p, size))) <= 3 for m in mass.values())
    assert all(abs(ups[i] / n - p[i]) < 0.1 for i in range(12))


def test_tree_keeps_every_row(spark):
    items = spark.range(2000).select(F.lit("g").alias("g"), F.col("id").alias("k"), F.lit(0.3).alias("p"), (F.col("id") % 5 + 1).cast("double").alias("s"))
    out = mixing.pivotal_round(items, "g", "k", "p", "s", 3, fan_in=6).collect()
    assert sorted(r["key"] for r in out) == list(range(2000))
    mass = sum(r["p"] * (r["key"] % 5 + 1) for r in out)
    assert abs(mass - 0.3 * 6000) <= 5


def test_odd_rows(spark):
    df = clashing(docs(spark, odd_rows()))
    found = mixing.mix_sources(df).collect()
    assert len(found) == len(odd_rows())
    assert all(r["taken"] == 0 for r in found if r["doc_id"] in (1, 2, 3))
    assert mixing.mix_sources(spark.createDataFrame([], SCHEMA)).collect() == []
    out = mixing.mixed(df)
    assert out.columns == df.columns
    assert out.count() == sum(r["copies"] for r in found)
    assert mixing.mixed(spark.createDataFrame([], SCHEMA)).collect() == []


def test_hot_copies(spark):
    """One text repeated thousands of times under one id is spread like any other."""
    df = docs(spark, [(7, "one two three", "en", "a", 1)] * 3000 + [(i, "four five", "en", "b", 1) for i in range(1000)])
    found = mixing.mix_sources(df).collect()
    assert len(found) == 4000
    for s in ("a", "b"):
        part = [r for r in found if r["source"] == s]
        assert abs(sum(r["taken"] for r in part) - part[0]["target"]) <= 3


def test_mixed_takes_each_row_by_all_its_columns(spark, monkeypatch):
    """Rows that differ in any column are told apart, equal ones together taken as often as the mix says, and reruns agree."""
    from weftline.llm import common

    monkeypatch.setattr(common, "REPEATS", 20)
    given = [(7, "one two three", "en", "a", 1)] * 90 + [(7, "one two three", "de", "a", 1)] * 30 + [(7, "one two three", None, "a", None)] * 30 + [(i, prose(i, 4), "en", "b", 1) for i in range(200)]
    out = [Counter(tuple(r) for r in mixing.mixed(docs(spark, given).repartition(n)).collect()) for n in (3, 8)]
    assert out[0] == out[1] and set(out[0]) <= set(given)
    times = Counter(given)
    assert all(n <= 3 * times[row] for row, n in out[0].items())
    words = Counter()
    for row, n in out[0].items():
        words[row[3]] += n * len(row[1].split())
    target = {r["source"]: r["target"] for r in mixing.mix_sources(docs(spark, given)).collect()}
    assert all(abs(words[s] - target[s]) <= 4 for s in target)
