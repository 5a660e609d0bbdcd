from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from weftline.llm import common
from weftline.llm.components import connected_components


def test_a_cluster_needs_a_shared_folder():
    def session(master, named=None):
        made = []
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: made[-1] if made else None, setCheckpointDir=made.append)
        return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda key, other: named))

    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://host"):
        with pytest.raises(RuntimeError):
            common.shared_folder(session(master))
        assert common.shared_folder(session(master, "hdfs://store/shared")) == "hdfs://store/shared"
    assert "weftline" in common.shared_folder(session("local[2]"))


def test_components_leave_one_table(spark):
    """Each round's files go once the next is written; a chain is one component; the edges given may repeat or be loops."""
    folder = Path(common.shared_folder(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (7, 7), (7, 8)]
    found = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {100: 100, 101: 100}
    assert len(set(folder.iterdir()) - before) == 1
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_components_run_few_stages(spark):
    """No round that changes nothing: the driver keeps every stage and its tasks."""
    def stages(pairs):
        edges = spark.createDataFrame(pairs, "a long, b long")
        spark.sparkContext.setJobGroup("components", "")
        found = {r["node"]: r["root"] for r in connected_components(edges).collect()}
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("components")
        spark.sparkContext.setJobGroup("others", "")
        return found, jobs

    star = [(0, k) for k in range(1, 30)]
    found, first = stages(star)
    assert found == {k: 0 for k in range(30)} and len(first) <= 10
    found, second = stages([(k, k + 1) for k in range(9)] + star)
    assert found == {k: 0 for k in range(30)} and len(second) - len(first) <= 20


def test_batches_are_bounded(spark):
    """Whatever the session says of Arrow batches; what it says stays, what it doesn't say is lowered."""
    def run(batches):
        for batch in batches:
            import pyarrow as pa
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    def sizes():
        return [r["n"] for r in common.map_batches(spark.range(3000).coalesce(1), run, "n long").collect()]

    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(rows, "2000")
    found = sizes()
    assert sum(found) == 3000 and max(found) <= common.ARROW_ROWS and spark.conf.get(rows) == "2000"
    spark.conf.unset(rows)
    found = sizes()
    assert sum(found) == 3000 and max(found) <= common.ARROW_ROWS and spark.conf.get(rows) == str(common.ARROW_ROWS)


@pytest.mark.parametrize("limit", [3, 1000])
def test_repeated_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(common, "REPEATS", limit)
    df = spark.createDataFrame([("a", 1), ("b", 0), ("c", 17), ("d", 3)], "v string, times int")
    found = sorted((r["v"], r["i"]) for r in common.repeated(df, "times", "i", 17).collect())
    assert found == sorted([("a", 1), *(("c", i) for i in range(1, 18)), *(("d", i) for i in range(1, 4))])


def test_row_hashes_tell_nulls_apart(spark):
    df = spark.createDataFrame([(None, "x"), ("x", None), ("x", "x"), (None, None)], "a string, b string").withColumn("m", F.create_map(F.lit("k"), "a"))
    assert df.select(common.whole_row_hash(df).alias("h")).distinct().count() == 4
