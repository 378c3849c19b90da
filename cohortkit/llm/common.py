"""Helpers shared by the operators: written stages and batch text iteration."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import cohortkit.llm
from cohortkit.sources.io import stage_path

# Functions sent to tasks travel by value: executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(cohortkit.llm)

#: Bytes of text worked on at once inside a task (bounds numpy's scratch arrays).
CHUNK_BYTES = 1 << 20


def read_docs(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared ``spark.checkpoint.dir`` and read it back.

    Lineage starts at the files, so losing an executor costs a reread, and
    row numbers drawn while writing stay fixed for every later use.
    """
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stage(df: DataFrame) -> None:
    """Delete the files of a stage that a later, finished stage has replaced."""
    spark = df.sparkSession
    for f in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Ask the JVM to collect garbage, so that Spark's cleaner drops the shuffle files of finished stages now."""
    spark.sparkContext._jvm.System.gc()


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker, across its tasks (functions by value are new in each)."""
    return sys.modules.setdefault("_cohortkit_worker", types.ModuleType("_cohortkit_worker")).__dict__


def text_of(df: DataFrame, text_col: str):
    """The text column as a non-null string."""
    return F.coalesce(df[text_col].cast("string"), F.lit(""))


def text_chunks(batch: pa.RecordBatch, column: int, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, list[str]]]:
    """(from row, to row, texts) runs of a batch of about ``limit`` bytes; a longer text is a run of its own."""
    col = batch.column(column)
    n, start = batch.num_rows, 0
    sizes = pc.binary_length(col).to_pylist()
    while start < n:
        stop, total = start, 0
        while stop < n and (stop == start or total + (sizes[stop] or 0) <= limit):
            total += sizes[stop] or 0
            stop += 1
        yield start, stop, ["" if t is None else t for t in col.slice(start, stop - start).to_pylist()]
        start = stop
