"""Paper CSV source and sink.

The original tables are CSV files written by pandas: a header row, fields
quoted only when needed, quotes doubled, newlines inside quoted fields. Spark's
own reader takes such a file as a whole (``multiLine``); here files are cut
into records in parallel (``sources.quoted``) and each record is parsed by
Spark's CSV parser with the same options, so one large file has many tasks.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import quoted

PAPER_COLUMNS = ["title", "abstract", "url"]

# Header aliases accepted on read (A2).
HEADER_ALIASES = {"Title": "title", "Abstract": "abstract"}

# Strings pandas.read_csv reads as missing by default.
PANDAS_NA_VALUES = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# File names of per-venue tables: ``<conference>_<yy>.csv``.
VENUE_FILE_PATTERN = r"([A-Za-z0-9]+)_([0-9]{2})\.csv$"


_OPTIONS = {"escape": '"', "quote": '"', "multiLine": "true", "mode": "PERMISSIVE"}


def _columns_of(head: str) -> list[str]:
    """Column names of a header record, aliases applied where the plain name
    is not there as well."""
    names = next(csv.reader(io.StringIO(head.lstrip("\ufeff"), newline="")), [])
    return [HEADER_ALIASES[n] if n in HEADER_ALIASES and HEADER_ALIASES[n] not in names else n for n in names]


def _parsed(rows: DataFrame, layouts: list[str]) -> DataFrame:
    """The paper columns that any layout has, by each record's own header."""
    named = {head: _columns_of(head.rstrip("\r")) for head in layouts}
    cols = [c for c in PAPER_COLUMNS if any(c in names for names in named.values())]
    fields = None
    for head, names in named.items():
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
        record = F.from_csv("record", F.lit(schema.simpleString()[len("struct<") : -1].replace(":", " ")), _OPTIONS)
        mine = F.transform(F.array(record), lambda r: F.struct(*((r[f"c{names.index(c)}"] if c in names else F.lit(None).cast("string")).alias(c) for c in cols)))[0]
        fields = mine if len(named) == 1 else F.when(F.col("head") == head, mine) if fields is None else fields.when(F.col("head") == head, mine)
    return rows.select(fields.alias("f"), F.col("file").alias("_file")).select(*[F.col(f"f.{c}").alias(c) for c in cols], "_file")


def read_paper_csv(spark: SparkSession, path: str, pandas_missing: bool = False, with_source: bool = False) -> DataFrame:
    """A1/A2: paper rows from CSV; header names decide the columns, with the
    ``Title``/``Abstract`` aliases; every column is a string.

    ``pandas_missing`` maps pandas' default missing-value strings to NULL
    (Spark keeps ``NA``/``None`` as text). ``with_source`` adds
    ``venue``/``year`` from ``<conference>_<yy>.csv`` file names (A7)."""
    out = _parsed(*quoted.records(spark, path))
    cols = [c for c in PAPER_COLUMNS if c in out.columns]
    extra = ["_file"] if with_source else []
    out = out.select(*cols, *extra)
    if pandas_missing:
        out = out.select(*[missing_to_null(F.col(c)).alias(c) for c in cols], *extra)
    if with_source:
        src = F.col("_file")
        out = out.withColumn("venue", F.lower(F.regexp_extract(src, VENUE_FILE_PATTERN, 1))).withColumn(
            "year", F.regexp_extract(src, VENUE_FILE_PATTERN, 2).cast("int")
        ).drop("_file")
    return out


def missing_to_null(c: Column) -> Column:
    return F.when(c.isin(PANDAS_NA_VALUES), F.lit(None).cast("string")).otherwise(c)


def write_paper_csv(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Header, minimal quoting, doubled quotes (pandas style).

    ``mode='append'`` adds files next to the existing ones: each batch is one
    write, never a rewrite of the whole table per row."""
    w = (
        df.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("quote", '"')
        # Spark's CSV writer trims values by default; pandas keeps them
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def land_as_parquet(
    spark: SparkSession, csv_path: str, out_path: str, pandas_missing: bool = False, mode: str = "overwrite"
) -> DataFrame:
    """Read per-venue paper CSVs once and write them as parquet partitioned by ``venue`` and ``year`` (A7), so
    later jobs get split reads, pushdown and partition pruning."""
    df = read_paper_csv(spark, csv_path, pandas_missing=pandas_missing, with_source=True)
    df.write.mode(mode).partitionBy("venue", "year").parquet(out_path)
    return spark.read.parquet(out_path)
