"""Best-fit decreasing packing of token sequences, exact and global.

Best-fit decreasing looks at lengths only, and there are at most ``capacity``
different lengths, so the plan is made on the *histogram of lengths* (at most
``capacity`` rows, whatever the input). A segment tree over remaining
capacities finds the tightest open bin for a length in logarithmic time; equal
pieces fall into equal bins as a block, because after a piece has gone into the
tightest bin, that bin stays the tightest for the next equal piece until it no
longer fits. The result is bin for bin that of piece-by-piece best fit.

The plan is a short list of blocks (length, rank range, first bin, pieces per
bin, offset). Every piece gets its rank among the pieces of its length from
counts per (task, length), and finds its bin by a binary search in the blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import worker_encoder
from .common import bound_batches, cut_lineage, slices, texts

CAPACITY = 2048
TOKENIZER = "byte_bpe_50k.json"
END_ID = 0

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"
_PIECE_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
     ("ids_crc32", pa.int64()), ("task", pa.int32()), ("nth", pa.int64())]
)


class SpaceTree:
    """Segment tree over remaining capacities 0..capacity; a leaf is set when
    an open bin has that much room left."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.any = np.zeros(2 * self.size, bool)

    def set(self, room: int, present: bool) -> None:
        i = room + self.size
        self.any[i] = present
        while i > 1:
            i >>= 1
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def tightest(self, need: int) -> int | None:
        """The smallest set room that is at least ``need``."""
        i = need + self.size
        if self.any[i]:
            return need
        while i > 1:
            if i % 2 == 0 and self.any[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None


def plan_blocks(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Blocks (length, first rank, first bin, pieces per bin, offset) of best-fit
    decreasing, in order of (length, first rank)."""
    tree = SpaceTree(capacity)
    open_bins: dict[int, list[tuple[int, int]]] = {}  # room -> [(first bin, bins)]
    blocks: list[tuple[int, int, int, int, int]] = []
    bins = 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in open_bins:
                open_bins[room] = []
                tree.set(room, True)
            open_bins[room].append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, each = capacity, capacity // length
                first, have = bins, -(-left // each)
                bins += have
            else:
                first, have = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
                    tree.set(room, False)
                each = room // length
            full = min(have, left // each)
            rest = left - full * each if full < have else 0
            blocks.append((length, rank, first, each, capacity - room))
            placed = full * each + rest
            put(room - each * length, first, full)
            if rest:
                put(room - rest * length, first + full, 1)
            put(room, first + full + bool(rest), have - full - bool(rest))
            left, rank = left - placed, rank + placed
    blocks.sort()
    return np.array(blocks, np.int64).reshape(-1, 5)


def _cutter(tokenizer: str, capacity: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(public_tokenizers.path(tokenizer))
        task = TaskContext.get().partitionId()
        met = np.zeros(capacity + 1, np.int64)
        end = END_ID.to_bytes(4, "little")
        for b in slices(batches):
            cols: list[list[int]] = [[] for _ in range(6)]
            row: list[int] = []
            for at, t in enumerate(texts(b, "text")):
                ids = encoder.ids(t) + end
                n = len(ids) // 4
                start, stop = 0, (n - 1) % capacity + 1  # only the first piece may be shorter
                piece = 0
                while start < n:
                    size = stop - start
                    row.append(at)
                    for c, v in zip(cols, (piece, start, size, zlib.crc32(ids[4 * start : 4 * stop]), task, int(met[size]))):
                        c.append(v)
                    met[size] += 1
                    piece, start, stop = piece + 1, stop, stop + capacity
            ids_ = b.column("doc_id").take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids_, *(pa.array(c, f.type) for c, f in zip(cols, list(_PIECE_ARROW)[1:]))], schema=_PIECE_ARROW)
        encoder.forget()

    return run


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """Token pieces with their running number ``nth`` per (task, length)."""
    rows = bound_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_cutter(tokenizer, capacity), _PIECE)


_OUT = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def _placer(blocks: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one sorted key (length, first rank); ranks stay below 2**50
        key = (blocks[:, 0] << 50) + blocks[:, 1]
        for b in batches:
            length = b.column("length").to_numpy()
            rank = b.column("rank").to_numpy()
            at = np.searchsorted(key, (length << 50) + rank, side="right") - 1
            _, first_rank, first, each, offset = blocks[at].T
            nth = rank - first_rank
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(first + nth // each), pa.array(offset + nth % each * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids followed by id 0; null text is empty, so it is the
    single id 0. Only documents over ``capacity`` are cut, into pieces of
    ``capacity`` ids of which the first may be shorter. Pieces of equal length
    are interchangeable, ties go by task and position. Null or repeated
    identifiers are carried through: every row is packed. An empty table gives
    no rows; other columns are not read.
    """
    if not 1 <= capacity < 1 << 13:
        raise ValueError("capacity must be in 1..8191")
    cut = cut_lineage(pieces(docs, id_col, text_col, capacity, tokenizer))
    # at most one row per (task, length); the prefix sums run per length
    per_task = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    starts = per_task.select("length", "task", F.coalesce(before, F.lit(0)).alias("before"))
    # at most `capacity` rows reach the driver
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    ranked = cut.join(starts, ["length", "task"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"))
    return ranked.mapInArrow(_placer(plan_blocks(histogram, capacity)), _OUT)
