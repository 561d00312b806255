"""Records of quoted CSV files, read in parallel inside each file.

A line break belongs to a field when it stands between quotes, so where a
record starts depends on all quotes before it. Each byte range of a file is
scanned on its own: one pass reports the parity of its quotes, a prefix sum
over the ranges of a file (one row each) tells which of them begin inside a
field, and a second pass cuts records accordingly. Records that cross a range
come out as fragments, which are the only rows that are exchanged.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

QUOTE = '"'
# so many ranges that begin inside a field are sent to every task as a set;
# more of them are joined to the lines instead
INSIDE_LIMIT = 100_000

WHOLE, HEAD, TAIL = 0, 1, 2  # a record, the end of one, the beginning of one


def lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, start, value)``: lines in order within the byte range
    ``start`` of a file; a line belongs to the range in which it starts."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _ranges(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Array, pa.RecordBatch]]:
    """Each batch cut at the ends of byte ranges."""
    for b in batches:
        if b.num_rows == 0:
            continue
        file, start = b.column("file"), b.column("start")
        new = pc.or_(pc.not_equal(file.slice(1), file.slice(0, len(file) - 1)), pc.not_equal(start.slice(1), start.slice(0, len(start) - 1)))
        cuts = [0, *(np.flatnonzero(new.to_numpy(zero_copy_only=False)) + 1).tolist(), b.num_rows]
        for i, j in zip(cuts, cuts[1:]):
            part = b.slice(i, j - i)
            yield file[i].as_py(), start[i].as_py(), part.column("value"), part


def _odd(values: pa.Array) -> np.ndarray:
    return pc.count_substring(values, QUOTE).to_numpy(zero_copy_only=False) & 1


_SCAN_DDL = "file string, start long, odd int, head string"


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per range: parity of its quotes, and the file's first record."""

    def row(r: list) -> pa.RecordBatch:
        head = "\n".join(r[3]) if r[1] == 0 else None
        return pa.RecordBatch.from_arrays([pa.array([r[0]]), pa.array([r[1]], pa.int64()), pa.array([r[2]], pa.int32()), pa.array([head], pa.string())], names=["file", "start", "odd", "head"])

    held: list | None = None  # file, start, parity, header lines, header closed
    for file, start, values, _ in _ranges(batches):
        if held is None or (held[0], held[1]) != (file, start):
            if held is not None:
                yield row(held)
            held = [file, start, 0, [], start != 0]
        for v in values if not held[4] else ():  # as a rule one line
            held[3].append(v.as_py())
            held[4] = "\n".join(held[3]).count(QUOTE) % 2 == 0
            if held[4]:
                break
        held[2] = (held[2] + int(_odd(values).sum())) & 1
    if held is not None:
        yield row(held)


def _cutter(inside: set[tuple[str, int]] | None):
    """Records and fragments; ``inside`` names the ranges that begin in a
    field, or the lines carry it in a column of that name."""
    names = ["file", "start", "kind", "record"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None
        open_lines: list[str] = []  # of the record that has not ended
        parity, begun, header = 0, False, False

        def out(kinds: list[int], records: list) -> pa.RecordBatch:
            n = len(kinds)
            return pa.RecordBatch.from_arrays([pa.array([at[0]] * n), pa.array([at[1]] * n, pa.int64()), pa.array(kinds, pa.int32()), pa.array(records, pa.string())], names=names)

        def last() -> Iterator[pa.RecordBatch]:
            if at is not None and open_lines and not header:
                yield out([TAIL if begun else HEAD], ["\n".join(open_lines)])

        for file, start, values, part in _ranges(batches):
            if at != (file, start):
                yield from last()
                at, open_lines = (file, start), []
                parity = int((file, start) in inside if inside is not None else part.column("inside")[0].as_py())
                begun, header = parity == 0, start == 0
            after = (parity + np.cumsum(_odd(values))) & 1
            ends = np.flatnonzero(after == 0)  # lines that end a record
            text = values.to_pylist()
            kinds, records, i = [], [], 0
            for e in ends.tolist():
                record = text[e] if i == e and not open_lines else "\n".join([*open_lines, *text[i : e + 1]])
                i, open_lines = e + 1, []
                if header:  # the first record names the columns
                    header = False
                else:
                    kinds.append(WHOLE if begun else HEAD)
                    records.append(record)
                begun = True
            open_lines += text[i:]
            parity = int(after[-1])
            if kinds:
                yield out(kinds, records)
        yield from last()

    return run


def records(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """``(file, record, head)`` of all CSV records, and the distinct headers.

    A record's line ends are kept as they are, but for its own. Empty lines are
    no records. The headers come from each file's first range; they reach the
    driver once each, as many as there are layouts."""
    source = lines(spark, path)
    store = scratch_path(spark, f"csv-ranges-{uuid.uuid4().hex}")
    source.mapInArrow(_scan, _SCAN_DDL).write.parquet(store)
    in_file = Window.partitionBy("file").orderBy("start")
    before = F.coalesce(F.sum("odd").over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = spark.read.schema(_SCAN_DDL).parquet(store).select("file", "start", (before % 2 == 1).alias("inside"), F.first("head").over(in_file).alias("head"))
    layouts = sorted(r[0] for r in ranges.where("start = 0").select("head").distinct().collect())

    began = [tuple(r) for r in ranges.where("inside").select("file", "start").limit(INSIDE_LIMIT + 1).collect()]
    ddl = "file string, start long, kind int, record string"
    if len(began) <= INSIDE_LIMIT:
        cut = source.mapInArrow(_cutter(set(began)), ddl)
    else:
        placed = source.withColumn("at", F.monotonically_increasing_id()).join(ranges.select("file", "start", "inside"), ["file", "start"])
        cut = placed.sortWithinPartitions("file", "start", "at").drop("at").mapInArrow(_cutter(None), ddl)
    whole = cut.where(F.col("kind") == WHOLE).select("file", "record")
    if began:
        order = Window.partitionBy("file").orderBy("start", "kind")
        parts = cut.where(F.col("kind") != WHOLE).withColumn("n", F.sum((F.col("kind") == TAIL).cast("long")).over(order))
        in_order = F.sort_array(F.collect_list(F.struct("start", "kind", "record")))
        joined = parts.groupBy("file", "n").agg(F.array_join(F.transform(in_order, lambda p: p["record"]), "\n").alias("record"))
        whole = whole.unionByName(joined.select("file", "record"))
    bare = F.when(F.endswith("record", F.lit("\r")), F.expr("substr(record, 1, length(record) - 1)")).otherwise(F.col("record"))
    whole = whole.select("file", bare.alias("record")).where("record <> ''")
    if len(layouts) == 1:
        return whole.withColumn("head", F.lit(layouts[0])), layouts
    heads = ranges.where("start = 0").select("file", "head")
    return whole.join(heads, "file"), layouts
