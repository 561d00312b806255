"""Nested notes -> flat rows -> decision -> accepted papers (B3, B4, B5, H3,
C1, A14, A15, E7). One narrow stage; the decision filter is a plain
predicate, so nothing is shuffled until the optional per-venue counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as TX


def flatten_notes(notes: DataFrame) -> DataFrame:
    """B4 + H3 + B3: ``(id, title, venue, decision, abstract, url)``."""
    extra = [c for c in notes.columns if c not in ("id", "content")]
    return notes.select(
        "id",
        F.col("content.title.value").alias("title"),
        F.col("content.venue.value").alias("venue"),
        TX.venue_decision(F.col("content.venue.value")).alias("decision"),
        F.col("content.abstract.value").alias("abstract"),
        TX.forum_url("id").alias("url"),
        *extra,
    )


def accepted(flat: DataFrame) -> DataFrame:
    """C1 + B5: decisions containing ``Accepted``; the decision column is
    dropped before saving."""
    return flat.filter(F.col("decision").contains("Accepted")).drop("decision")


def note_rejects(flat: DataFrame) -> DataFrame:
    """A missing venue stops the original run; here it is a reject row."""
    return flat.filter(F.col("decision").isNull()).select("id", "title", F.lit("missing venue").alias("reason"))


def decision_counts(flat: DataFrame, by: list[str]) -> DataFrame:
    """Found vs accepted per group (partial aggregation)."""
    return flat.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_notes"),
        F.count_if(F.col("decision").contains("Accepted")).alias("n_accepted"),
        F.count_if(F.col("decision").isNull()).alias("n_missing_venue"),
    )
