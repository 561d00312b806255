"""Triage output tables under one root.

Fixed table names replace the original's derived file names; an empty result
still writes an empty table with its schema (the original writes nothing).
JSON is written as JSON lines, one object per paper, with the reference
similarities as a map ordered by similarity (Spark keeps entry order).
"""

from __future__ import annotations

import time
import uuid
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.score import ReferenceSet
from .tables import read_or_empty

# Fixed output table names under the output root.
OUTPUT_TABLES = ("scored", "related", "related_detailed", "rejects", "report")


def similarity_map(detail_col: str, refs: ReferenceSet | None) -> Column:
    """``map<ref_title, similarity>`` in detail order. A title that
    repeats keeps its first (highest) entry, so map keys are unique; only
    titles that stand twice in the reference set are looked up again.

    Without ``refs`` the detail entries carry their ``ref_title``, and one
    entry a title (the job collapses equal titles beforehand)."""
    if refs is None:
        name = lambda d: F.coalesce(d["ref_title"], d["ref_id"].cast("string"))
        return F.map_from_entries(F.transform(F.col(detail_col), lambda d: F.struct(name(d).alias("k"), d["similarity"].alias("v"))))
    titles = F.array(*[F.lit(t).cast("string") for t in refs.titles])
    ids = [int(i) for i in refs.ref_ids]
    index = F.create_map(*[x for i, ref in enumerate(ids) for x in (F.lit(ref), F.lit(i + 1))])
    met = Counter(str(i) if t is None else t for i, t in zip(ids, refs.titles))
    named = F.transform(
        F.col(detail_col),
        lambda d: F.struct(
            F.coalesce(F.element_at(titles, F.element_at(index, d["ref_id"])), d["ref_id"].cast("string")).alias("k"),
            d["similarity"].alias("v"),
        ),
    )
    twice = [t for t, n in met.items() if n > 1]
    if not twice:
        return F.map_from_entries(named)
    keys = F.transform(named, lambda e: e["k"])
    first_only = F.filter(named, lambda e, i: ~e["k"].isin(twice) | ~F.array_contains(F.slice(keys, 1, i), e["k"]))
    return F.map_from_entries(first_only)


class Publication:
    """Output tables that appear together: they are written to a folder of
    their own version, and ``commit`` adds one manifest row that names it. A run
    that ends before leaves the former version's tables as they are."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root = spark, root.rstrip("/")
        self.version = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        self.paths: dict[str, str] = {}

    def write(self, tables: dict[str, DataFrame], fmt: dict[str, str] | None = None) -> dict[str, str]:
        written = write_outputs(f"{self._root}/versions/{self.version}", tables, fmt)
        self.paths.update(written)
        return written

    def commit(self) -> None:
        row = [(self.version, sorted(self.paths.items()))]
        manifest = self._spark.createDataFrame(row, "version string, tables array<struct<name:string,path:string>>")
        manifest.coalesce(1).write.mode("append").parquet(f"{self._root}/published")


def published(spark: SparkSession, root: str) -> dict[str, str]:
    """Paths of the last version that was committed; none yet: empty."""
    schema = T.StructType([T.StructField("version", T.StringType()), T.StructField("tables", T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("path", T.StringType())])))])
    last = read_or_empty(spark, f"{root.rstrip('/')}/published", schema).orderBy(F.desc("version")).first()
    return {} if last is None else {t["name"]: t["path"] for t in last["tables"]}


def write_outputs(root: str, tables: dict[str, DataFrame], fmt: dict[str, str] | None = None) -> dict[str, str]:
    """Write each named table to ``root/<name>`` (overwrite). Returns paths."""
    fmt = fmt or {}
    paths = {}
    for name, df in tables.items():
        if name not in OUTPUT_TABLES:
            raise ValueError(f"unknown output table {name}")
        path = f"{root.rstrip('/')}/{name}"
        kind = fmt.get(name, "parquet")
        w = df.write.mode("overwrite")
        if kind == "csv":
            w.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
                "ignoreTrailingWhiteSpace", False
            ).csv(path)
        elif kind == "json":
            w.json(path)
        else:
            w.parquet(path)
        paths[name] = path
    return paths
