"""Exact global numbering without a single-partition window.

``row_number() OVER (ORDER BY ...)`` with no partition key moves every row to
one task. Here the rows are range-partitioned and sorted in parallel, each
partition numbers its rows locally (``monotonically_increasing_id`` holds the
partition index and the in-partition position), and a table with one row per
partition supplies the offsets. Range partitioning samples its input, so the
rows are written once before it: whatever made them (scoring, a model) runs a
single time. The sorted rows are checkpointed to the shared checkpoint folder,
so a lost executor cannot renumber them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir, scratch_path

_LOCAL_BITS = 33  # monotonically_increasing_id: partition index << 33 | position


def _sorted_once(df: DataFrame, order_cols: list[Column], n: int) -> DataFrame:
    """The rows evaluated once, range-partitioned and sorted, in shared storage."""
    path = scratch_path(df.sparkSession, f"to-sort-{uuid.uuid4().hex}")
    df.write.parquet(path)
    landed = df.sparkSession.read.schema(df.schema).parquet(path)
    return landed.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)


def global_row_number(
    df: DataFrame,
    order_cols: list[Column],
    out_col: str = "row_no",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add a 1-based ``out_col`` in ``order_cols`` order (ties in input order
    are broken by the sort, so pass a unique key last for determinism)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    mid = F.monotonically_increasing_id()
    numbered = (
        _sorted_once(df, order_cols, n)
        .withColumn("_mid", mid)
        .withColumn("_pid", F.shiftright(F.col("_mid"), _LOCAL_BITS))
        .withColumn("_pos", F.col("_mid") - F.shiftleft(F.col("_pid"), _LOCAL_BITS))
        .drop("_mid")
    )
    tagged = numbered.checkpoint(eager=True)
    # one row per non-empty partition: bounded by the partition count
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return (
        tagged.join(F.broadcast(offsets), "_pid")
        .withColumn(out_col, F.col("_off") + F.col("_pos") + F.lit(1))
        .drop("_pid", "_pos", "_off")
    )


def _runs(b: pa.RecordBatch | pa.Table, cols: list[str]) -> list[int]:
    """Starts of the runs of rows with equal values; null equals null and NaN NaN."""
    new = np.zeros(b.num_rows, bool)
    new[:1] = True
    for c in cols:
        col = b.column(c)
        col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
        x, y = col.slice(1), col.slice(0, len(col) - 1)
        differ = pc.fill_null(pc.not_equal(x, y), False).to_numpy(zero_copy_only=False)
        if pa.types.is_floating(col.type):
            differ &= ~pc.fill_null(pc.and_(pc.is_nan(x), pc.is_nan(y)), False).to_numpy(zero_copy_only=False)
        new[1:] |= differ | (x.is_null().to_numpy(zero_copy_only=False) != y.is_null().to_numpy(zero_copy_only=False))
    return np.flatnonzero(new).tolist()


def _name(b: pa.RecordBatch, i: int, cols: list[str]) -> str:
    return repr([b.column(c)[i].as_py() for c in cols])


_EDGE = "pid int, place int, grp string, n long, head string, head_n long, tail string, tail_n long"


def _edges(group_cols: list[str], tie_cols: list[str]):
    """First and last group of a partition: rows, and the ties at both ends."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        for b in batches:
            starts = _runs(b, group_cols + tie_cols) + [b.num_rows]
            for i, j in zip(starts, starts[1:]):
                grp, tie = _name(b, i, group_cols), _name(b, i, tie_cols)
                if last is None or last["grp"] != grp:
                    last = {"pid": b.column("_pid")[i].as_py(), "grp": grp, "n": 0, "head": tie, "head_n": 0, "tail": tie, "tail_n": 0}
                    first = last if first is None else first
                if tie != last["tail"]:
                    last["tail"], last["tail_n"] = tie, 0
                last["n"] += j - i
                last["tail_n"] += j - i
                if last["head"] == last["tail"] and last["tail_n"] == last["n"]:
                    last["head_n"] = last["n"]
        rows = [] if first is None else [first | {"place": 0}] if first is last else [first | {"place": 0}, last | {"place": 1}]
        names = ["pid", "place", "grp", "n", "head", "head_n", "tail", "tail_n"]
        types = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(names, types)], names=names)

    return run


def _continued(edges: list) -> dict[tuple[int, int], tuple[int, int, int]]:
    """(rows of the group in earlier partitions, rows of the whole group, rank
    of the first tie) of each partition's end groups that other partitions share."""
    out, chain = {}, []

    def close() -> None:
        total, before, tie, tie_rank = sum(e["n"] for e in chain), 0, None, 1
        for e in chain:
            rank = tie_rank if e["head"] == tie else before + 1
            out[e["pid"], e["place"]] = before, total, rank
            # the rank of the tie that the next partition may go on with
            tie_rank = rank if e["head_n"] == e["n"] else before + e["n"] - e["tail_n"] + 1
            tie, before = e["tail"], before + e["n"]

    for e in sorted(edges, key=lambda e: (e["pid"], e["place"])):
        if chain and chain[-1]["grp"] != e["grp"]:
            close()
            chain = []
        chain.append(e)
    close()
    return out


def _ranker(group_cols: list[str], tie_cols: list[str], shared: dict[tuple[int, int], tuple[int, int, int]]):
    def ranked(t: pa.Table, place: int) -> pa.Table:
        """One group's rows of this partition."""
        before, total, head_rank = shared.get((t.column("_pid")[0].as_py(), place), (0, t.num_rows, 1))
        number = before + np.arange(1, t.num_rows + 1, dtype=np.int64)
        starts = _runs(t, tie_cols)
        rank = np.repeat(number[starts], np.diff([*starts, t.num_rows]))
        rank[: (starts + [t.num_rows])[1]] = head_rank
        share = (rank - 1) / (total - 1) if total > 1 else np.zeros(len(rank))
        t = t.drop_columns(["_pid"])
        for name, values in (("group_n", np.full(len(rank), total)), ("row_no", number), ("rank", rank), ("percent_rank", share)):
            t = t.append_column(name, pa.array(values))
        return t

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, groups = None, 0
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            starts = _runs(held, group_cols)
            for i, j in zip(starts, starts[1:]):
                yield from ranked(held.slice(i, j - i), 0 if groups == 0 else 2).combine_chunks().to_batches()
                groups += 1
            held = held.slice(starts[-1]) if starts else held
        if held is not None and held.num_rows:
            yield from ranked(held, 0 if groups == 0 else 1).combine_chunks().to_batches()

    return run


def grouped_rank(
    df: DataFrame,
    group_cols: list[str],
    order_cols: list[Column],
    tie_cols: list[str],
    unique_col: str,
) -> DataFrame:
    """Per-group ``row_no``, ``rank`` (ties share the lowest), ``group_n`` and
    ``percent_rank`` without moving a whole group into one task.

    Rows are range-partitioned and sorted once in (group, order, unique) order,
    which is the only exchange of rows. A boundary between partitions cuts at
    most one group; each partition reports its first and last group (two rows),
    and from those follow the numbers that a cut group goes on with. All other
    groups are numbered within their partition. Null and NaN keys equal
    themselves."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = [F.col(c) for c in group_cols] + list(order_cols) + [F.col(unique_col)]
    dealt = _sorted_once(df, keyed, n).withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    edges = dealt.select("_pid", *dict.fromkeys([*group_cols, *tie_cols])).mapInArrow(_edges(group_cols, tie_cols), _EDGE).collect()
    added = [T.StructField("group_n", T.LongType()), T.StructField("row_no", T.LongType()), T.StructField("rank", T.LongType()), T.StructField("percent_rank", T.DoubleType())]
    return dealt.mapInArrow(_ranker(group_cols, tie_cols, _continued(edges)), T.StructType([*df.schema.fields, *added]))
