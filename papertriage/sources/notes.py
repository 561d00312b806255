"""Submission-note source (A4): exported nested notes, read with an explicit
schema so only the projected nested fields are parsed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _value_field(name: str) -> T.StructField:
    return T.StructField(name, T.StructType([T.StructField("value", T.StringType())]))


NOTE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField(
            "content",
            T.StructType([_value_field("title"), _value_field("venue"), _value_field("abstract")]),
        ),
    ]
)


def read_notes(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines (or parquet) note dumps with the nested note schema."""
    if path.endswith(".parquet"):
        return spark.read.schema(NOTE_SCHEMA).parquet(path)
    return spark.read.schema(NOTE_SCHEMA).json(path)


# Venue strings assigned to test documents by ``doc_id % 8``;
# together they cover every decision branch, an empty and a missing venue.
TEST_VENUES = [
    "ICLR 2024 oral",
    "ICLR 2024 Spotlight",
    "ICLR 2024 poster",
    "ICLR 2024 Conference Withdrawn Submission",
    "ICLR 2024 Conference Desk Rejected Submission",
    "Submitted to ICLR 2024",
    "",
    None,
]


def notes_from_documents(docs: DataFrame) -> DataFrame:
    """Nested notes derived from ``documents``: title = first line,
    abstract = the rest, venue chosen by ``doc_id % 8``."""
    venues = F.array(*[F.lit(v).cast("string") for v in TEST_VENUES])
    text = F.col("text")
    pos = F.instr(text, "\n")
    return docs.select(
        F.concat(F.lit("n"), F.col("doc_id").cast("string")).alias("id"),
        F.struct(
            F.struct(F.substring_index(text, "\n", 1).alias("value")).alias("title"),
            F.struct(F.element_at(venues, (F.pmod(F.col("doc_id"), F.lit(8)) + 1).cast("int")).alias("value")).alias(
                "venue"
            ),
            F.struct(F.when(pos > 0, text.substr(pos + F.lit(1), F.lit(1 << 30))).alias("value")).alias("abstract"),
        ).alias("content"),
        F.col("source"),
    )
