"""Shared pieces: the word class, the shared folder, saved tables, table reads."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


#: A key of at least 1/HUBS of all rows is a hub, so there are HUBS of them at most, whatever the input.
HUBS = 5_000
#: Fewer rows than these fit in any task, so their hubs need no care.
FEW_ROWS = 100_000
#: Most bytes of an Arrow batch where the session sets no bound of its own; a task holds one batch in the JVM and one in Python.
BATCH_BYTES = 4 << 20
#: Spark's setting to delete the shuffle files of a query at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def bounded_batches(spark: SparkSession) -> None:
    """Small Arrow batches for texts; a bound that the session has set stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, str(BATCH_BYTES))


def trimmed() -> None:
    """Give free memory back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def lean(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function for mapInArrow, with free memory given back to the system at its end, as the worker process lives on beside later tasks."""

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(incoming)
        trimmed()

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; null text counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir); where none is set, as in tests, a folder of the warehouse."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        if known.isEmpty():
            spark.sparkContext.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints")
            known = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = known.get()
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/dialoom-{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write the table to the shared folder and read it back; what the write shuffled is deleted with it."""
    spark = df.sparkSession
    bounded_batches(spark)
    path, before = new_path(spark, name), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def discard(saved: DataFrame) -> None:
    """Delete the files of a saved table that nothing reads any more; lazy plans over it must not be left."""
    spark = saved.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in saved.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def packed(docs: DataFrame, *used: str) -> DataFrame:
    """The used columns and all others in one struct, so that no column of an operator can meet one of the same name."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in used]
    return docs.select(*used, (F.struct(*others) if others else F.lit(None).cast("int")).alias("other_columns"))


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of a table before ``packed``, in their order."""
    return df.select(*[F.col(c) if c in df.columns and c != "other_columns" and not _inside(df, c) else F.col("other_columns")[c].alias(c) for c in columns])


def _inside(df: DataFrame, column: str) -> bool:
    kind = df.schema["other_columns"].dataType
    return hasattr(kind, "names") and column in kind.names


def hub_join(left: DataFrame, right: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """Inner join on ``key`` that leaves no task with all rows of a hub.

    ``right`` has one row for each key and says in ``weight`` how many rows of ``left`` the key has (``total`` in all).
    Rows of hubs meet a broadcast of ``HUBS`` rows at most, the others are shuffled.
    """
    if total <= FEW_ROWS:
        return left.join(right, key)
    least = max(FEW_ROWS // 200, ceil(total / HUBS))
    hubs = right.filter(F.col(weight) >= least)
    marked = left.join(F.broadcast(hubs.select(key).withColumn("is_hub", F.lit(True))), key, "left")
    hot = marked.filter("is_hub").drop("is_hub").join(F.broadcast(hubs), key)
    return hot.unionByName(marked.filter("is_hub is null").drop("is_hub").join(right.filter(F.col(weight) < least), key))


def crc32_of(value: Column) -> Column:
    return F.crc32(value.cast("string").cast("binary"))


def unit_hash(seed: str, key: Column) -> Column:
    """A uniform number in [0, 1) from md5 of seed and key, alike in every engine; a null key counts as 'null'."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
