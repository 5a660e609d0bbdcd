"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import re
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

# Functions travel to the executors by value, so these need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__.rpartition(".")[0]])

#: Rows in an Arrow batch handed to Python. Bounds a worker's memory to this many texts at a time.
ARROW_ROWS = 512
#: What a session gets that says nothing about Arrow batches.
ARROW_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(ARROW_ROWS), "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back, so that lineage ends here.

    The files outlive executors; Spark removes them with the result where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``.

    Where it is unset, a session whose driver and tasks are one process (``local[...]``, as in tests) gets a
    temporary folder; on a cluster that would be machine-local, so there this raises.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="weftline-"))
    return sc.getCheckpointDir()


def spread(df: DataFrame, by: str) -> DataFrame:
    """``df`` dealt over all shuffle partitions by a column: for few rows that each make very many, which Spark would leave in one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), by)


def merge_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """An equi-join that never gathers a side on the driver.

    Spark takes a side that explodes rows to be no larger than what it explodes, also once it has measured that, and so
    broadcasts tables of any size; the driver then has to hold them.
    """
    return left.join(right.hint("merge"), on, how)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until no column of ``df`` is called so (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def with_results(fields: list[T.StructField], *results: tuple[str, T.DataType]) -> T.StructType:
    """The schema of ``fields`` followed by the named results."""
    return T.StructType([*(T.StructField(f.name, f.dataType) for f in fields), *(T.StructField(n, t) for n, t in results)])


def with_text(df: DataFrame, kept: list[T.StructField], text_col: str) -> tuple[DataFrame, int]:
    """(the columns ``kept`` of ``df``, place of the text among them); a text that isn't kept, or no string, is put at the end as one."""
    for i, f in enumerate(kept):
        if f.name == text_col and isinstance(f.dataType, T.StringType):
            return df.select(*[F.col(f"`{k.name}`") for k in kept]), i
    return df.select(*[F.col(f"`{k.name}`") for k in kept], F.col(text_col).cast("string").alias(fresh(df, "_text")[0])), len(kept)


def map_batches(df: DataFrame, function: Callable[[Iterator], Iterator], schema: str | T.StructType) -> DataFrame:
    """``mapInArrow``, ``function`` being given at most ``ARROW_ROWS`` rows at a time.

    Spark fills a batch of 64 MB before a task sees it, which costs an executor several times that outside its heap. So the session's
    two settings of Arrow batches are lowered, unless the session sets them itself: then they stay as they are. A worker that is kept for later
    tasks gives back the memory of its batches.
    """
    conf = df.sparkSession.conf
    for key, value in ARROW_BATCHES.items():
        if conf.get(key, None) is None:
            conf.set(key, value)

    def run(batches):
        import pyarrow as pa

        yield from function(part for batch in batches for part in slices(batch))
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def slices(batch) -> Iterator:
    """A record batch in parts of at most ``ARROW_ROWS`` rows."""
    for i in range(0, batch.num_rows, ARROW_ROWS):
        yield batch.slice(i, ARROW_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row`` (hash of id and text), ``doc_id`` and ``z`` (the text's UTF-8 bytes, compressed) of every row.

    For shuffles of whole texts: they move and spill a third of the bytes. A null text is packed
    as an empty one. ``row`` is the same for rows of equal id and text and tells others apart.
    """
    def run(batches):
        import pyarrow as pa
        import zstandard

        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            z = [press.compress((t or "").encode("utf-8", "surrogatepass")) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(z, pa.binary())], names=["row", "doc_id", "z"])

    return map_batches(rows_of(docs, id_col, text_col), run, "row long, doc_id long, z binary")


def row_hash(id_col: str, text_col: str):
    """A hash of a row's id and text."""
    text, key = F.col(text_col).cast("string"), F.col(id_col).cast("long")
    return F.xxhash64(F.coalesce(key, F.lit(-(1 << 62))), key.isNull(), F.coalesce(text, F.lit("")))


def rows_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row``, ``doc_id`` and ``text``; see :func:`packed`."""
    return docs.select(row_hash(id_col, text_col).alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def unpack(z: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(z)


#: Repeats of one row that one task writes at most, where a row is repeated more often.
REPEATS = 10_000


def repeated(df: DataFrame, times: str, number: str, most: int) -> DataFrame:
    """Each row as often as column ``times`` says (0: never), numbered from 1 in the new column ``number``.

    ``most`` is the largest of ``times``. Beyond ``REPEATS`` a row is dealt over tasks in parts of that many.
    """
    one = F.lit(1).cast("long")
    if most <= REPEATS:
        return df.filter(F.col(times) > 0).withColumn(number, F.explode(F.sequence(one, F.col(times).cast("long"))))
    [part] = fresh(df, "_part")
    parts = df.filter(F.col(times) > 0).withColumn(part, F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(`{times}` - 1) div {REPEATS}"))))
    parts = parts.repartition(F.col(part), F.col(times))
    first = F.col(part) * REPEATS
    return parts.withColumn(number, F.explode(F.sequence(first + 1, F.least(first + REPEATS, F.col(times).cast("long"))))).drop(part)


def summed_before(per: DataFrame, by: list[str], bucket: str, n: str, out: str, fan: int = 4096) -> DataFrame:
    """``per`` (one row for each of ``by`` and ``bucket``) with ``out``, the sum of ``n`` over the smaller buckets of the same ``by``.

    In two levels, so that no task reads more than ``fan`` buckets, or one row for each ``fan`` of them.
    """
    rows = per.withColumn("_top", F.expr(f"`{bucket}` div {fan}"))
    tops = rows.groupBy(*by, "_top").agg(F.sum(n).alias("_sum"))
    whole = lambda w: F.coalesce(F.sum("_sum" if w else n).over((Window.partitionBy(*by).orderBy("_top") if w else Window.partitionBy(*by, "_top").orderBy(bucket)).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tops = tops.select(*[F.col(c).alias(f"_t{c}") for c in by], F.col("_top").alias("_t"), whole(True).alias("_base"))
    same = F.col("_top") == F.col("_t")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_t{c}"))
    return rows.withColumn(out, whole(False)).join(tops, same).withColumn(out, F.col(out) + F.col("_base")).select(*per.columns, out)


def whole_row_hash(df: DataFrame):
    """A hash of all columns of a row, nulls told apart."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        parts += [F.to_json(F.struct(c)) if "map" in f.dataType.simpleString() or "variant" in f.dataType.simpleString() else c, c.isNull()]
    return F.xxhash64(*parts)


def stored(df: DataFrame) -> DataFrame:
    """``df`` as Parquet in the shared checkpoint folder: for larger tables than :func:`cut` is meant for. See :func:`discard`."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes the files of a table that :func:`stored` returned, where nothing reads it any more."""
    spark = df.sparkSession
    root = shared_folder(spark)
    folders = {path.rpartition("/")[0] for path in df.inputFiles()}
    for folder in folders:
        if folder.rpartition("/")[0].split(":")[-1].lstrip("/") == root.split(":")[-1].lstrip("/"):
            where = spark._jvm.org.apache.hadoop.fs.Path(folder)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
