"""Parquet table access and table-exists scans (A3, A5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


# Declared schemas of the tables the queries read: a declared schema skips
# the footer read of schema inference on every scan.
TABLE_SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


# Partitions that the scan of a text table is dealt to. Unset (the default):
# the scan's own splits, which large tables have in plenty. Tables of one row
# group are read by one task; where CPU-heavy work follows, set this setting.
SCAN_PARTITIONS = "spark.papertriage.scanPartitions"

# Text tables whose per-row work (regex, hashing, HTML parsing) is CPU-bound.
TEXT_TABLES = {"documents", "pages"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one parquet table. Column pruning and filters reach the scan."""
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    df = reader.parquet(table_path(sf_dir, name))
    n = int(spark.conf.get(SCAN_PARTITIONS, "0"))
    return df.repartition(n) if n and name in TEXT_TABLES else df


def _jvm_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system (works for HDFS/S3/local)."""
    fs, jpath = _jvm_fs(spark, path)
    return bool(fs.exists(jpath))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Existing table, or an empty frame of ``schema`` when it is absent (A3).

    Read errors on an existing table propagate: a silent empty frame would
    make every row look new.
    """
    if path_exists(spark, path):
        if fmt == "csv":  # columns by header name, quoted multi-line fields
            from .csv import read_paper_csv

            return read_paper_csv(spark, path).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        return spark.read.format(fmt).schema(schema).load(path)
    return spark.createDataFrame([], schema)
