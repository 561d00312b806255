"""Benchmark decontamination by greedy string tiling.

Seeds are runs of five words (fewer for shorter items) that a document shares
with a benchmark item. A seeded pair is tiled: running Karp-Rabin finds the
matches of at least the seed length, the longest are marked first and may not
overlap, and what a tile leaves of another match is a match again, in its place
by length. An item is leaked when marked words cover at least ``threshold``
of it, wherever in the document and in whatever order its passages stand.

The benchmark's distinct items are read in blocks of bounded size, measured
against ``BLOCK_BYTES`` before a block is collected (an item is not cut, so one
above it makes a larger block); a block's seed table goes to every task and the documents are
passed over once per block, so a benchmark of any size is handled and nothing
of the documents is exchanged.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, cut_lineage, slices, texts, whole_text

SEED_WORDS = 5
THRESHOLD = 0.8
# text of one benchmark block (its index is about ten times as large)
BLOCK_BYTES = 8 * 1024 * 1024

_WORD = re.compile(r"\w+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: str) -> list[str]:
    """Lower-cased runs of letters, digits and underscores."""
    return _WORD.findall(text.lower())


def window_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hashes (modulo 2**64) of all windows of ``n`` ids."""
    if len(ids) < n:
        return np.empty(0, np.uint64)
    x = ids.astype(np.uint64) + np.uint64(1)
    h = np.zeros(len(ids) - n + 1, np.uint64)
    for k in range(n):  # n is at most an item's length
        h = h * _BASE + x[k : k + len(h)]
    return h


def _free_windows(marked: np.ndarray, n: int) -> np.ndarray:
    """Starts of the windows of ``n`` words without a marked one."""
    if len(marked) < n:
        return np.empty(0, np.int64)
    c = np.concatenate(([0], np.cumsum(marked)))
    return np.flatnonzero(c[n:] == c[:-n])


def maximal_matches(item: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(length, item start, document start) of all matches of at least
    ``least`` words that cannot be made longer on either side: neighbouring
    Karp-Rabin hits on one diagonal."""
    of_item, of_doc = window_hashes(item, least), window_hashes(doc, least)
    order = np.argsort(of_item, kind="stable")
    first, last = (np.searchsorted(of_item[order], of_doc, side=side) for side in ("left", "right"))
    times = last - first
    d = np.repeat(np.arange(len(of_doc)), times)
    s = order[np.arange(len(d)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first, times)]
    real = np.ones(len(d), bool)
    for k in range(least):  # else the hashes agree by chance
        real &= item[s + k] == doc[d + k]
    s, d = s[real], d[real]
    order = np.lexsort((s, d - s))
    s, d = s[order], d[order]
    new = np.flatnonzero(np.concatenate(([True], (s[1:] != s[:-1] + 1) | (d[1:] != d[:-1] + 1)))) if len(s) else s
    size = np.diff(np.concatenate((new, [len(s)]))) + least - 1
    return list(zip(size.tolist(), s[new].tolist(), d[new].tolist()))


def greedy_tiles(item: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Tiles (item start, document start, length) of greedy string tiling.

    Strictly longest first, each word in at most one tile, none shorter than
    ``least``; of equally long matches the one earliest in the item, then in
    the document. A match that earlier tiles overlap goes back into the queue
    as what is left of it.
    """
    in_item, in_doc = np.zeros(len(item), bool), np.zeros(len(doc), bool)
    queue = [(-n, s, d) for n, s, d in maximal_matches(item, doc, least)]
    heapq.heapify(queue)
    tiles: list[tuple[int, int, int]] = []
    while queue:
        n, s, d = heapq.heappop(queue)
        free = ~(in_item[s : s - n] | in_doc[d : d - n])
        if free.all():
            in_item[s : s - n] = in_doc[d : d - n] = True
            tiles.append((s, d, -n))
            continue
        edge = np.flatnonzero(np.diff(np.concatenate(([0], free.view(np.int8), [0]))))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if b - a >= least:
                heapq.heappush(queue, (a - b, s + a, d + a))
    return tiles


class BenchmarkIndex:
    """Seed table of one block of items."""

    def __init__(self, items: list[tuple[int, str]], seed_words: int = SEED_WORDS, threshold: float = THRESHOLD):
        self.threshold = threshold
        self.ids: dict[str, int] = {}
        self.items: list[tuple[int, np.ndarray, int]] = []
        for item_id, text in items:
            w = np.array([self.ids.setdefault(x, len(self.ids)) for x in words(text)], np.int64)
            if len(w):  # an item without words matches nothing
                self.items.append((item_id, w, min(seed_words, len(w))))
        self.seeds: dict[int, tuple[np.ndarray, list[list[tuple[int, int]]]]] = {}
        for n in sorted({n for _, _, n in self.items}):
            places: dict[int, list[tuple[int, int]]] = defaultdict(list)
            for k, (_, w, m) in enumerate(self.items):
                if m == n:
                    for s, h in enumerate(window_hashes(w, n).tolist()):
                        places[h].append((k, s))
            keys = np.array(sorted(places), np.uint64)
            self.seeds[n] = keys, [places[h] for h in keys.tolist()]

    def leaks(self, text: str) -> list[tuple[int, float, int, int]]:
        """(item_id, coverage, tiles, longest tile) of the leaked items, by item_id."""
        w = words(text)
        ids = np.fromiter((self.ids.get(x, -1) for x in w), np.int64, len(w))
        seeded: dict[int, set[int]] = defaultdict(set)
        for n, (keys, places) in self.seeds.items():
            free = _free_windows(ids < 0, n)
            if not len(free) or not len(keys):
                continue
            h = np.unique(window_hashes(ids, n)[free])
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            for i in at[keys[at] == h].tolist():
                for k, s in places[i]:
                    seeded[k].update(range(s, s + n))
        out = []
        for k, covered in seeded.items():
            item_id, item, least = self.items[k]
            # words of tiles lie in shared seeds: what seeds do not cover tiles cannot
            if len(covered) < self.threshold * len(item):
                continue
            tiles = greedy_tiles(item, ids, least)
            coverage = sum(n for _, _, n in tiles) / len(item)
            if coverage >= self.threshold:
                out.append((item_id, coverage, len(tiles), max(n for _, _, n in tiles)))
        return sorted(out)


def benchmark_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, named: bool = True) -> Iterator[list[tuple[int, str, int]]]:
    """Distinct (item_id, text, number of rows) in blocks of at most
    ``block_bytes`` of text, one at a time. Rows without an identifier are left
    out; with ``named=False`` identifiers are not read and texts are distinct."""
    if named:
        items = benchmark.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("item_id"), whole_text(text_col).alias("text"))
    else:
        items = benchmark.select(F.lit(0).cast("long").alias("item_id"), whole_text(text_col).alias("text"))
    items = cut_lineage(items.groupBy("item_id", "text").agg(F.count("*").alias("n_rows")))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bucket = F.pmod(F.xxhash64("item_id", "text"), F.lit(16 * max(1, -(-total // block_bytes))))
    # neighbouring buckets are joined up to the bound
    blocks: list[list[int]] = []  # first bucket, last bucket, bytes
    for k, size in items.groupBy(bucket.alias("k")).agg(F.sum(F.octet_length("text"))).orderBy("k").collect():
        if blocks and blocks[-1][2] + size <= block_bytes:
            blocks[-1][1:] = k, blocks[-1][2] + size
        else:
            blocks.append([k, k, size])
    for first, last, _ in blocks or [[0, 0, 0]]:
        yield [(r["item_id"], r["text"], r["n_rows"]) for r in items.where(bucket.between(first, last)).collect()]


_OUT = "doc_id long, item_id long, coverage double, n_tiles int, longest_tile int, n_rows long"
_ARROW = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("coverage", pa.float64()), ("n_tiles", pa.int32()), ("longest_tile", pa.int32()), ("n_rows", pa.int64())])


def _finder(items: list[tuple[int, str, int]], seed_words: int, threshold: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = BenchmarkIndex([(k, text) for k, (_, text, _) in enumerate(items)], seed_words, threshold)
        for b in slices(batches):
            row, cols = [], [[], [], [], [], []]
            for at, t in enumerate(texts(b, "text")):
                for k, *leak in index.leaks(t):
                    row.append(at)
                    for c, v in zip(cols, (items[k][0], *leak, items[k][2])):
                        c.append(v)
            ids = b.column("doc_id").take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, f.type) for c, f in zip(cols, list(_ARROW)[1:]))], schema=_ARROW)

    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, seed_words: int = SEED_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per leaked (document row, item): doc_id, item_id, coverage,
    n_tiles, longest_tile. Documents without leak give no row.

    Null texts count as empty and leak nothing; items without words or with
    null identifiers are left out; an item of fewer than ``seed_words`` words
    must stand in one piece. Items with equal texts are each reported, as are
    repeated rows. Empty tables give no rows; other columns are not read.
    """
    rows = bound_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for items in benchmark_blocks(benchmark, block_bytes=block_bytes):
        part = rows.mapInArrow(_finder(items, seed_words, threshold), _OUT)
        out = part if out is None else out.unionByName(part)
    # a repeated benchmark row is compared once and reported as often as it stands
    return out.withColumn("n_rows", F.explode(F.sequence(F.lit(1).cast("long"), "n_rows"))).drop("n_rows")


def _dropper(items: list[tuple[int, str, int]], text_col: str, seed_words: int, threshold: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = BenchmarkIndex([(k, text) for k, text, _ in items], seed_words, threshold)
        for b in slices(batches):
            yield b.filter(pa.array([not index.leaks(t) for t in texts(b, text_col)], pa.bool_()))

    return run


def drop_leaked(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, seed_words: int = SEED_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that leak no item, with all their columns; one
    narrow pass per benchmark block. Items without an identifier count too.
    Null and empty texts leak nothing and stay, repeated rows share their fate,
    items without words match nothing and an empty benchmark keeps every row;
    coverage of exactly ``threshold`` is a leak."""
    for items in benchmark_blocks(benchmark, block_bytes=block_bytes, named=False):
        docs = bound_batches(docs).mapInArrow(_dropper(items, text_col, seed_words, threshold), docs.schema)
    return docs
