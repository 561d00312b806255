"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import bound_arrow_batches, ensure_checkpoint_dir

# Rows that a Python worker turns into objects at a time; a batch that Spark
# hands over may hold thousands of whole documents.
SLICE_ROWS = 512

_FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# of glibc; elsewhere freed memory stays with the worker
_MALLOC_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table, whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_text(text_col: str) -> Column:
    """The text column with null as the empty text."""
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def drop_exchanges(spark: SparkSession) -> None:
    """From now on an execution of the session deletes its exchange files at its
    end, not at some later collection of the driver's garbage."""
    spark.conf.set(_FILE_CLEANUP, "true")


@contextmanager
def dropped_exchanges(spark: SparkSession) -> Iterator[None]:
    """``drop_exchanges`` for what is planned and run inside."""
    before = spark.conf.get(_FILE_CLEANUP, "false")
    drop_exchanges(spark)
    try:
        yield
    finally:
        spark.conf.set(_FILE_CLEANUP, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder of ``spark.checkpoint.dir``; the
    exchanges it was made from leave no files."""
    ensure_checkpoint_dir(df.sparkSession)
    with dropped_exchanges(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # a plan takes the setting when it is made


def bound_batches(df: DataFrame) -> DataFrame:
    """Lower the session's Arrow batch to ``session.BATCH_ROWS`` where it is larger."""
    bound_arrow_batches(df.sparkSession)
    return df


def release_memory() -> None:
    """Workers outlive a task: what it has freed goes back to the system."""
    pa.default_memory_pool().release_unused()
    if _MALLOC_TRIM is not None:
        _MALLOC_TRIM(0)


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches cut into views of at most ``rows`` rows (nothing is copied)."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
    release_memory()


def texts(batch: pa.RecordBatch, name: str) -> list[str]:
    """A string column as Python strings; null becomes the empty text."""
    return ["" if t is None else t for t in batch.column(name).to_pylist()]
