"""Similarity join of documents on word shingles (Jaccard), exact.

Two sets can only reach the threshold when their sizes are close and few
shingles differ, so every set is filed into *tiles*: a size band and a part of
the hash range in which it must agree with a partner. A tile's band fixes the
largest number ``k`` of differing shingles; the hash range is cut into more
than ``k`` parts, so two similar sets agree on all shingles of some part, and
the hash of that part is the key under which they meet. A passage that many
otherwise different documents share does not bring them together.

Sets that meet are compared by hashed bitmaps of ``BITS`` bits (each shingle
flips one): every bit that differs needs a differing shingle, which bounds the
overlap from above. Pairs within the bound are settled by intersecting the
sorted shingle arrays, made again from the texts, which travel packed.

Work inside a tile stays linear where sets are linked: first each member is
held against the tile's smallest and largest member, and members already in
one component are not compared again. Only members of different components
are, block against block, in tasks that hold two blocks of bitmaps; pairs that
the bound rules out are never made into rows. A large tile of different
components (texts from one template) is cut by further parts first.

Equal sets are one node, so copies cost one row each.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import bound_batches, cut_lineage, dropped_exchanges, slices, texts, whole_text
from .components import connected_components

SHINGLE_WORDS = 3
THRESHOLD = 90  # percent
BITS = 1024
BLOCK_ROWS = 256  # members of a tile compared at a time
BROADCAST_IDS = 2_000_000  # identifiers (16 MB) sent to the texts; more go through an exchange
KEPT_SETS = 64  # sets that a worker keeps of the texts it has unpacked
REFINE_LEVELS = 6  # how often a large mixed tile is cut by further parts

_WORD64 = (1 << 64) - 1
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


# ---- sets ------------------------------------------------------------------


class _WordHashes(dict):
    """64-bit hash of each word met, emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 150_000:
            self.clear()
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= 64:
            self[word] = value
        return value


_HASH_OF = _WordHashes()


def shingle_set(text: str, n: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles.

    Words are runs of other than space and U+0009 to U+000D, A-Z lower-cased;
    fewer than ``n`` words are one shingle, no word gives the empty set.
    """
    words = text.encode("utf-8").lower().split()  # on bytes both touch ASCII only
    h = np.fromiter(map(_HASH_OF.__getitem__, words), np.uint64, len(words))
    if not len(h):
        return h
    k = min(n, len(h))
    s = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        s = _mix(s * _M1 + h[i : i + len(s)])
    return np.unique(s)


def set_key(s: np.ndarray) -> tuple[int, int]:
    """128-bit digest of a set as two signed longs; the first is its node."""
    return tuple(int(x) for x in np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64))


def bitmap(s: np.ndarray) -> np.ndarray:
    """Parity bitmap: bit i tells whether an odd number of shingles hash to i."""
    odd = np.bincount((_mix(s) & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def similar(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    """Exact test on sorted arrays."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= threshold * (len(a) + len(b) - both)


# ---- tiles -----------------------------------------------------------------


def band_growth(threshold: int) -> float:
    """Ratio of neighbouring bands' sizes with the fewest keys a set: wide
    bands cost parts, narrow ones cost more bands a set."""
    return 1.4 if threshold >= 85 else 1.25


@lru_cache(maxsize=8)
def band_edges(limit: int, growth: float) -> np.ndarray:
    """First size of each band, up to the one that holds ``limit``."""
    edges = [1]
    while edges[-1] <= limit:
        edges.append(max(edges[-1] + 1, int(edges[-1] * growth)))
    return np.array(edges, np.int64)


def tiles_of(size: int, threshold: int) -> list[tuple[int, int]]:
    """(band, k) of the tiles a set of ``size`` is filed into: its own band,
    and each lower band that holds sizes it can be similar to. ``k`` is the
    largest number of shingles in which two sets that meet there may differ."""
    edges = band_edges(1 << max(10, int(size).bit_length()), band_growth(threshold))
    own = int(np.searchsorted(edges, size, side="right")) - 1
    smallest = -(-threshold * size // 100)  # of a similar set
    out = []
    for band in range(own, -1, -1):
        top = int(edges[band + 1]) - 1
        if top < smallest:
            break
        # |A|+|B|-2|I| <= (100-t)/(100+t) * (|A|+|B|), the smaller one is in the band
        out.append((band, (100 - threshold) * (top + 100 * top // threshold) // (100 + threshold)))
    return out


def _part_hashes(s: np.ndarray, parts: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, size) of the set's share in each part of the hash range."""
    h = _mix(s ^ np.uint64(salt)) if salt else s
    at = ((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    at = at.astype(np.int64)
    size = np.bincount(at, minlength=parts)
    total = np.zeros(parts, np.uint64)
    if salt:
        np.add.at(total, at, _mix(h))
    else:  # s is sorted, so the parts are runs
        c = np.concatenate(([np.uint64(0)], np.cumsum(_mix(h))))
        end = np.cumsum(size)
        total = c[end] - c[end - size]
    return total, size


def tile_keys(s: np.ndarray, threshold: int = THRESHOLD) -> np.ndarray:
    """The 64-bit keys under which a set meets every set similar to it.

    With ``spare`` parts more than ``k + 1``, similar sets agree on more parts
    than either has empty ones, unless it has more than ``spare``; so empty
    parts give no key. A set with more files each empty part under the keys of
    a second partition (similar sets with that part empty differ in at most
    ``k`` places elsewhere), which keeps those keys selective too.
    """
    out = [keys for _, keys in _keys_by_tile(s, threshold)]
    return np.unique(np.concatenate(out)).view(np.int64) if out else np.empty(0, np.int64)


def _keys_by_tile(s: np.ndarray, threshold: int) -> Iterator[tuple[int, np.ndarray]]:
    """(k, keys) of each tile of the set."""
    for band, k in tiles_of(len(s), threshold):
        spare = k // 12
        parts = k + 1 + spare
        total, size = _part_hashes(s, parts, 0)
        salt = (band + 1) * int(_M1) & _WORD64
        key = _mix(total + _mix(np.arange(parts, dtype=np.uint64) * _M2 + np.uint64(salt)))
        yield k, key[size > 0]
        empty = np.flatnonzero(size == 0)
        if len(empty) > spare:
            total2, size2 = _part_hashes(s, k + 1, 0x5DEECE66D)
            inner = np.arange(k + 1, dtype=np.uint64) * _M3
            for p in empty.tolist():
                place = np.uint64((salt ^ (p + 1) * int(_M2)) & _WORD64)
                yield k, _mix(_mix(total2 + inner) + place)


def refined_keys(s: np.ndarray, key: int, level: int, threshold: int) -> np.ndarray:
    """Keys that cut the tile ``key`` of a set by a further partition: similar
    sets of the tile differ in at most ``k`` places, so they agree on one of
    ``k + 1`` new parts as well (empty parts included)."""
    of_key = np.full(1, key & _WORD64, np.uint64)
    # the widest tile, should two give one key; it is the same for all members
    k = max(k for k, keys in _keys_by_tile(s, threshold) if (keys == of_key).any())
    salt = 0x632BE59BD9B4E019 * (2 * level + 3) & _WORD64
    total, size = _part_hashes(s, k + 1, salt)
    return _mix(total + _mix(np.arange(k + 1, dtype=np.uint64) * _M2 + _mix(of_key + np.uint64(salt)))).view(np.int64)


# ---- Spark -----------------------------------------------------------------

_SETS = [("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("check", pa.int64()), ("bits", pa.list_(pa.int64()))]


def _digester(words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out = []
            for t in texts(b, "text"):
                s = shingle_set(t, words)
                out.append((len(s), *set_key(s), bitmap(s)) if len(s) else (0, None, None, None))
            carried = [f for f in b.schema if f.name == "sha"]
            columns = [b.column("doc_id"), *(pa.array(c, t) for c, (_, t) in zip(zip(*out), _SETS[1:])), *(b.column(f.name) for f in carried)]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema([*_SETS, *carried]))
        _HASH_OF.clear()

    return run


def _filer(words: int, threshold: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()  # copies in one input split are filed once
        for b in slices(batches):
            nodes, keys = [], []
            for t in texts(b, "text"):
                s = shingle_set(t, words)
                if not len(s):
                    continue
                node = set_key(s)[0]
                if node in met:
                    continue
                met.add(node)
                k = tile_keys(s, threshold)
                keys.append(k)
                nodes.append(np.full(len(k), node, np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(nodes))], names=["key", "node"])
        _HASH_OF.clear()

    return run


_WHOLE = pa.schema([("node", pa.int64()), ("packed", pa.binary())])


def _whole(words: int):
    """A set travels as its text, packed: its hashes, which do not pack, take
    several times as much in every exchange."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor()
        for b in slices(batches, 128):
            sets = [(set_key(s)[0], pack.compress(t.encode("utf-8"))) for t in texts(b, "text") if len(s := shingle_set(t, words))]
            columns = zip(*sets) if sets else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _WHOLE)], schema=_WHOLE)
        _HASH_OF.clear()  # a worker waits for its next task without them

    return run


def _unpacker(words: int):
    """Sets of packed texts; the last ``KEPT_SETS`` are kept, for rows of one
    set stand near each other."""
    unpack = zstandard.ZstdDecompressor()
    return lru_cache(maxsize=KEPT_SETS)(lambda packed: shingle_set(unpack.decompress(packed).decode("utf-8"), words))


def _within_bound(threshold: int):
    """Column test on (n_a, n_b, bits_a, bits_b): the differing bits bound the
    symmetric difference from below, which bounds the overlap from above."""
    differ = F.aggregate(F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda a, x: a + x)
    both = F.col("n_a") + F.col("n_b")
    return (100 - threshold) * both >= (100 + threshold) * differ


def _settle(threshold: int, words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = _unpacker(words)
        for b in slices(batches, 256):
            keep = [similar(whole(x), whole(y), threshold) for x, y in zip(b.column("packed_a").to_pylist(), b.column("packed_b").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
        _HASH_OF.clear()

    return run


@dataclass
class _Corpus:
    """What the steps look up: texts, the sets' first documents, and each
    node's size and bitmap (a row of 150 bytes)."""

    rows: DataFrame
    groups: DataFrame
    light: DataFrame
    threshold: int
    words: int

    def sets(self, nodes: DataFrame) -> DataFrame:
        """(node, packed text) of the nodes, from the text of one document each.
        The wanted identifiers are written and counted; the texts go through an
        exchange only when they are more than ``BROADCAST_IDS``."""
        named = self.groups.join(nodes.distinct(), "node", "left_semi")
        wanted = _landed(named.select(F.coalesce("first_id", F.lit(0)).alias("doc_id"), F.col("first_id").isNull().alias("no_id")).distinct())
        wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
        texts = self.rows.withColumn("no_id", F.col("doc_id").isNull()).withColumn("doc_id", F.coalesce("doc_id", F.lit(0)))
        fetched = texts.join(wanted, ["doc_id", "no_id"], "left_semi").mapInArrow(_whole(self.words), "node long, packed binary")
        return cut_lineage(fetched.dropDuplicates(["node"]))

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are similar: bitmaps first, arrays for the rest."""
        side = lambda df, x: df.select(F.col("node").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in df.columns[1:]))
        close = pairs.join(side(self.light, "a"), "a").join(side(self.light, "b"), "b").where(_within_bound(self.threshold)).select("a", "b")
        close = cut_lineage(close)
        whole = self.sets(close.select(F.col("a").alias("node")).union(close.select("b")))
        return close.join(side(whole, "a"), "a").join(side(whole, "b"), "b").mapInArrow(_settle(self.threshold, self.words), "a long, b long")


def _landed(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, f"jaccard-{uuid.uuid4().hex}")
    with dropped_exchanges(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _near(n: np.ndarray, m: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: int) -> np.ndarray:
    """Matrix of the bound's test between two blocks of members."""
    differ = np.zeros((len(a), len(b)), np.int64)
    for w in range(a.shape[1]):
        differ += np.bitwise_count(a[:, w, None] ^ b[None, :, w])
    return (100 - threshold) * (n[:, None] + m[None, :]) >= (100 + threshold) * differ


_MEMBER = ["key", "i", "j"]


def _compare_blocks(threshold: int):
    """Pairs of different components within the bound, in a stream of members
    sorted by (key, block pair); one block pair is held at a time."""

    def pairs(t: pa.Table) -> Iterator[pa.RecordBatch]:
        node, comp, n, block = (t.column(c).to_numpy() for c in ("node", "component", "n", "block"))
        bits = t.column("bits").combine_chunks().flatten().to_numpy().reshape(len(node), -1).view(np.uint64)
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        ok = _near(n[left], n[right], bits[left], bits[right], threshold) & (comp[left][:, None] != comp[right][None, :])
        if i == j:
            ok = np.triu(ok)
        x, y = np.nonzero(ok)
        if len(x):
            p, q = node[left[x]], node[right[y]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(p, q)), pa.array(np.maximum(p, q))], names=["a", "b"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t])
            if t.num_rows == 0:
                continue
            marks = [t.column(c).to_numpy() for c in _MEMBER]
            cut = np.flatnonzero(np.logical_or.reduce([m[1:] != m[:-1] for m in marks])) + 1
            start = 0
            for c in cut.tolist():
                yield from pairs(t.slice(start, c - start))
                start = c
            held = t.slice(start)
        if held is not None and held.num_rows:
            yield from pairs(held)

    return run


def _refiner(level: int, threshold: int, words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = _unpacker(words)
        for b in slices(batches, 256):
            out = [[], [], []]
            for first, key, node, packed in zip(*(b.column(c).to_pylist() for c in ("first_key", "key", "node", "packed"))):
                parts = refined_keys(whole(packed), first, level, threshold)
                # a part's name includes the tile it cuts
                parts = _mix(parts.view(np.uint64) + _mix(np.full(1, key & _WORD64, np.uint64))).view(np.int64)
                for c, v in zip(out, (np.full(len(parts), first), parts, np.full(len(parts), node))):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.int64), *c])) for c in out], names=["first_key", "key", "node"])
        _HASH_OF.clear()

    return run


def _mixed(members: DataFrame, comp: DataFrame, settled: int = 1) -> DataFrame:
    """Members (first_key, key, node, component, size) of the tiles that hold
    several components and more than ``settled`` members."""
    placed = members.join(comp, "node", "left").select("first_key", "key", "node", F.coalesce("component", "node").alias("component"))
    tiles = placed.groupBy("key").agg(F.count("*").alias("size"), F.min("component").alias("c1"), F.max("component").alias("c2")).where((F.col("c1") != F.col("c2")) & (F.col("size") > settled))
    return placed.join(tiles.select("key", "size"), "key")


def _worth_refining(mixed: DataFrame, corpus: _Corpus) -> DataFrame:
    """Tiles whose block copies take more than their parts: a set is repeated
    for each block or for each part, and a copy with its bitmap counts twice."""
    t = corpus.threshold
    largest = mixed.where(F.col("size") > BLOCK_ROWS).join(corpus.light.select("node", "n"), "node").groupBy("key").agg(F.max("n").alias("n"), F.first("size").alias("size"))
    parts = (100 - t) * (F.col("n") + 100 * F.col("n") / t) / (100 + t) + 1
    return cut_lineage(largest.where(2 * F.col("size") > BLOCK_ROWS * parts).select("key"))


def _leftover_pairs(members: DataFrame, comp: DataFrame, corpus: _Corpus) -> DataFrame:
    """Pairs within the bound of members of one tile in different components.

    A tile is cut by further parts, level by level, where comparing it block
    against block would repeat a member more often than it has parts; what
    stays large after ``REFINE_LEVELS`` is compared block against block."""
    # a tile of two members has been settled as its ends; the two of a tile's
    # part have only met here
    mixed = cut_lineage(_mixed(members.select(F.col("key").alias("first_key"), "key", "node"), comp, 2))
    done, large, sets = None, mixed, None
    for level in range(REFINE_LEVELS):
        worth = _worth_refining(large, corpus)
        rest = large.join(worth, "key", "left_anti")
        done = rest if done is None else done.unionByName(rest)
        large = cut_lineage(large.join(worth, "key", "left_semi"))
        if large.isEmpty():
            break
        sets = corpus.sets(large.select("node")) if sets is None else sets
        # two sets meet at a level only if they have met at all levels before
        named = large.join(sets, "node").select("first_key", "key", "node", "packed")
        parts = named.mapInArrow(_refiner(level, corpus.threshold, corpus.words), "first_key long, key long, node long")
        large = cut_lineage(_mixed(parts.distinct(), comp))
    done = done.unionByName(large)
    blocks = F.ceil(F.col("size") / BLOCK_ROWS).cast("int")
    spread = (
        done.withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "component")
    )
    with_bits = spread.join(corpus.light, "node")
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = with_bits.repartition(n, *_MEMBER).sortWithinPartitions(*_MEMBER)
    return dealt.mapInArrow(_compare_blocks(corpus.threshold), "a long, b long").distinct()


def _rows(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    return bound_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *more)


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, words: int = SHINGLE_WORDS) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    Documents link when 100 * intersection >= threshold * union of their
    distinct shingles of ``words`` words; component_id is the smallest doc_id reachable by
    links. Null and wordless texts have the empty set and link with nothing
    (component_id is their own doc_id). A row with a null doc_id links like
    any other but names no component (null where all of a component are null).
    Repeated rows are equal sets. An empty table gives no rows; other columns
    are not read. ``threshold`` is in percent, 50 to 100.
    """
    keys, named = _placed(_rows(docs, id_col, text_col), threshold, words)
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of_set = named.join(smallest, "component").select("node", "check", "component_id")
    filled = keys.join(of_set, ["node", "check"], "left")
    return filled.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _placed(rows: DataFrame, threshold: int, words: int) -> tuple[DataFrame, DataFrame]:
    """The set of each row (doc_id, n, node, check, and sha where ``rows`` has
    it), and the component of each set (node, check, first_id, n, component)."""
    if not 50 <= threshold <= 100:
        raise ValueError("threshold must be in 50..100")
    carried = ", sha binary" if "sha" in rows.columns else ""
    keys = cut_lineage(rows.mapInArrow(_digester(words), f"doc_id long, n long, node long, check long, bits array<long>{carried}"))
    rows = rows.select("doc_id", "text")
    some = keys.where("n > 0")
    groups = some.groupBy("node", "check").agg(F.min("doc_id").alias("first_id"), F.first("n").alias("n"))
    corpus = _Corpus(rows, groups, cut_lineage(some.select("node", "n", "bits").dropDuplicates(["node"])), threshold, words)

    # one exchange serves the tiles' ends and their members: files are made once
    filed = rows.mapInArrow(_filer(words, threshold), "key long, node long").repartition("key")
    tiles = filed.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("size")).where("low <> high")
    met = filed.join(tiles.hint("shuffle_hash"), "key")
    # of a tile of two only the pair is wanted, whatever its key
    pair = F.col("size") == 2
    members = met.where(~pair | (F.col("node") == F.col("low"))).select(F.when(~pair, F.col("key")).alias("key"), "node", "low", "high")
    members = cut_lineage(members.distinct())

    ends = members.select(F.least("node", "low").alias("a"), F.greatest("node", "low").alias("b")).union(members.select(F.least("node", "high"), F.greatest("node", "high")))
    links = cut_lineage(corpus.verified(ends.where("a <> b").distinct()))
    comp = cut_lineage(connected_components(links))
    more = corpus.verified(_leftover_pairs(members.where("key IS NOT NULL"), comp, corpus))
    comp = connected_components(links.union(more))

    return keys, groups.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, words: int = SHINGLE_WORDS) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: that of
    the smallest doc_id, and of several texts with that doc_id in the component
    the one with the smallest digest. A doc_id whose texts are in several
    components can so stay once in each. Texts without words (null, empty,
    white space) stay, and of repeated rows (one doc_id, one text) one; rows
    without a doc_id all stay, since they cannot be told apart by it. An empty
    table stays empty; ``docs`` may have columns of any names."""
    sha = F.unhex(F.sha2(whole_text(text_col), 256))
    keys, named = _placed(_rows(docs, id_col, text_col, sha.alias("sha")), threshold, words)
    keys = keys.where("doc_id IS NOT NULL")
    first = keys.where("n > 0").join(named.select("node", "check", "component"), ["node", "check"]).groupBy("component").agg(F.min(F.struct("doc_id", "sha")).alias("kept"))
    chosen = first.select("kept.doc_id", "kept.sha").union(keys.where("n = 0").select("doc_id", "sha")).distinct()
    packed = docs.select(F.col(id_col).cast("long").alias("doc_id"), sha.alias("sha"), F.struct(*(F.col(c) for c in docs.columns)).alias("row"))
    kept = packed.where("doc_id IS NOT NULL").join(_landed(chosen), ["doc_id", "sha"], "left_semi").dropDuplicates(["doc_id", "sha"])
    return kept.select("row.*").unionByName(packed.where("doc_id IS NULL").select("row.*"))


SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE_WORDS} THEN [list_aggregate(w, 'string_agg', ' ')]
    ELSE list_transform(range(1, len(w) - {SHINGLE_WORDS} + 2), lambda i: list_aggregate(w[i:i + {SHINGLE_WORDS} - 1], 'string_agg', ' ')) END) AS g
  FROM w
),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS MATERIALIZED (
  SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b
  WHERE 100 * i >= {THRESHOLD} * (na.n + nb.n - i)
),
r AS (SELECT doc_id, doc_id AS seen FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.seen)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.seen) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""
