"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What separates words: space and the five ASCII control characters of white space.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


#: Rows that Spark hands to Python at once; of long texts Spark's default is too many.
ARROW_ROWS = 2000


def small_batches(spark: SparkSession) -> None:
    """Hand fewer rows at once to Python from now on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def drop_finished(spark: SparkSession) -> None:
    """Spark drops the shuffle files of what went before when the driver collects
    its garbage, which has little of it: ask for that, lest the files of all steps
    stay side by side."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def work_folder(spark: SparkSession) -> str:
    """A new path that all executors reach: below ``spark.checkpoint.dir``, or
    below the warehouse where that is unset (tests)."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/llm-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


#: Where tables are stored that are deleted once a step has ended; none outside of one.
_passing: ContextVar[str | None] = ContextVar("passing", default=None)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables stored inside go when the block ends, but for those stored by the
    function given; so no table kept may still read another one by then."""
    folder = work_folder(spark)
    before = _passing.get()
    mark = _passing.set(folder)
    try:
        yield lambda df: _written(df, f"{before}/{uuid.uuid4().hex}" if before else work_folder(spark))
    finally:
        _passing.reset(mark)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared folder and read back: later steps
    that lose an executor reread it instead of computing it anew.  Runs a job."""
    folder = _passing.get()
    return _written(df, f"{folder}/{uuid.uuid4().hex}" if folder else work_folder(df.sparkSession))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ZIPPED = "_zipped_text"


def zipped(df: DataFrame, text: str) -> DataFrame:
    """``df`` with a text column compressed (null as it is) and its size in bytes, as
    (other columns, ``ZIPPED``, ``ZIPPED``_size): what Spark then shuffles is a third less."""
    kept = [name for name in df.columns if name != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if each is None else each.encode() for each in batch.column(text).to_pylist()]
            packed = [None if each is None else pa.compress(each, codec="zstd", asbytes=True) for each in texts]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in kept), pa.array(packed, pa.binary()), pa.array([len(each or b"") for each in texts], pa.int64())],
                names=[*kept, ZIPPED, f"{ZIPPED}_size"],
            )

    fields = [df.schema[name] for name in kept]
    added = [T.StructField(ZIPPED, T.BinaryType()), T.StructField(f"{ZIPPED}_size", T.LongType())]
    return df.mapInArrow(lean(run), T.StructType([*fields, *added]))


#: Rows of a batch that Python works on at once.
BATCH_ROWS = 4000


def lean(function: Callable) -> Callable:
    """``function`` over Arrow batches, given smaller ones; after the last, freed
    memory goes back to the system, as the idle worker stays beside other stages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batch.slice(at, BATCH_ROWS) for batch in batches for at in range(0, batch.num_rows, BATCH_ROWS))
        _give_back()

    return run


def lean_group(function: Callable) -> Callable:
    """``function`` of a group's table, giving freed memory back after each group."""

    def run(table: pa.Table) -> pa.Table:
        result = function(table)
        _give_back()
        return result

    return run


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def utf8_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
