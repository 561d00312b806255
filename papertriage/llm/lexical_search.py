"""Ranked lexical search of all documents, by branch-and-bound over FP-trees.

One pass over the texts writes each document's term vector, restricted to the
items' terms by a bit table of fixed size (terms that share a bit by chance are
sorted out later), together with partial document frequencies. The vectors are
then searched for one block of items at a time; texts are not read again.

A task collects vectors into chunks of bounded size and builds an FP-tree of
each: a vector's terms are put in order of falling document frequency, so
vectors share the paths of their frequent terms. Equal vectors are one path
that names its ``k`` smallest documents (the others cannot rank). A node stores
the largest frequency of every term and the smallest length norm ``m`` below
it. The score grows with the frequency and falls with ``m``, so these give an
upper bound of all scores in the subtree. Each item walks the tree depth first,
best bound first, and leaves out subtrees whose bound is below the score of its
``k``-th document so far, which a task carries from chunk to chunk. The best
``k`` of every task are merged by one ranking per item.
"""

from __future__ import annotations

import hashlib
import heapq
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import bound_batches, cut_lineage, slices, whole_text

K = 10
FILTER_BITS = 1 << 20
BLOCK_BYTES = 256 * 1024  # text of the items of one block
CHUNK_DOCS, CHUNK_TERMS = 4096, 600_000  # vectors and their entries in one tree
LEAF_DOCS = 48  # paths of one leaf
FREQ_ENTRIES = 200_000  # partial document frequencies a task holds

_B = 1_000_000_000
# fixed values: words are runs of ASCII digits, letters and all above ASCII
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def terms_of(text: str) -> list[bytes]:
    """The text's terms in UTF-8, only A-Z lower-cased."""
    return text.encode("utf-8").translate(_FOLD).split()


def term_hash(term: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(term, digest_size=8).digest(), "little", signed=True)


class _Known(dict):
    """Hash of each term met that has its bit set in the table, else None."""

    def __init__(self, table: bytes):
        self.table = table

    def __missing__(self, term: bytes) -> int | None:
        if len(self) >= 150_000:
            self.clear()
        h = term_hash(term)
        bit = h % FILTER_BITS
        value = h if self.table[bit >> 3] >> (bit & 7) & 1 else None
        if len(term) <= 64:
            self[term] = value
        return value


# ---- term vectors --------------------------------------------------------------

_VECTOR = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int64())), ("tfs", pa.list_(pa.int64()))])
_VECTOR_DDL = "doc_id long, n long, terms array<long>, tfs array<long>"


def _vectors(table: bytes):
    """Term vectors; rows with n = -1 hold partial document frequencies."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = _Known(table), Counter()

        def frequencies():
            return pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([-1], pa.int64()), pa.array([list(seen)], _VECTOR[2].type), pa.array([list(seen.values())], _VECTOR[3].type)], schema=_VECTOR)

        for b in slices(batches):
            ids, ns, terms, tfs = [], [], [], []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                words = terms_of(text or "")
                if not words:
                    continue
                tf = Counter(map(known.__getitem__, words))
                tf.pop(None, None)
                seen.update(tf.keys())
                ids.append(doc_id)
                ns.append(len(words))
                terms.append(list(tf))
                tfs.append(list(tf.values()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((ids, ns, terms, tfs), _VECTOR)], schema=_VECTOR)
            if len(seen) > FREQ_ENTRIES:
                yield frequencies()
                seen.clear()
        if seen:
            yield frequencies()

    return run


def _bits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        met = {term_hash(t) % FILTER_BITS for text in b.column("text").to_pylist() for t in set(terms_of(text))}
        yield pa.RecordBatch.from_arrays([pa.array(sorted(met), pa.int64())], names=["bit"])


def bit_table(items: DataFrame) -> bytes:
    """The bit table of the items' terms; at most FILTER_BITS numbers come to
    the driver, whatever the number of items."""
    table = np.zeros(FILTER_BITS, np.uint8)
    for (bit,) in items.select("text").mapInArrow(_bits, "bit long").distinct().collect():
        table[bit] = 1
    return np.packbits(table, bitorder="little").tobytes()


# ---- FP-tree -------------------------------------------------------------------


def gain(w: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term of weight ``w`` adds to the score, in 64-bit integers."""
    return w * ((_B * tf) // np.maximum(1000 * tf + 8 * m, 1))


@dataclass
class Path:
    """Documents of one term vector: ranks (rising: falling frequency), their
    frequencies, the norm and the smallest identifiers."""

    ranks: np.ndarray
    tfs: np.ndarray
    m: int
    ids: list


class FpTree:
    """Trie of paths in the order of their terms. A node is a range of paths
    that share a prefix; ``largest`` maps (node, rank) to the largest frequency
    below the node and ``least_m`` holds the smallest norm."""

    def __init__(self, paths: list[Path], width: int):
        order = sorted(range(len(paths)), key=lambda i: paths[i].ranks.astype(">u4").tobytes())
        self.paths = [paths[i] for i in order]
        self.width = width
        sizes = np.array([len(p.ranks) for p in self.paths], np.int64)
        owner = np.repeat(np.arange(len(self.paths)), sizes)
        ranks = np.concatenate([p.ranks for p in self.paths]).astype(np.int64)
        tfs = np.concatenate([p.tfs for p in self.paths]).astype(np.int64)
        self.entry, self.tf = owner * width + ranks, tfs  # rising: paths, then ranks
        self.m = np.array([p.m for p in self.paths], np.int64)
        self.low: list[int] = []
        self.high: list[int] = []
        self.children: list[list[int]] = []
        self._grow(0, len(self.paths), 0)
        self._summarise(owner, ranks, tfs)

    def _grow(self, low: int, high: int, depth: int) -> int:
        """The node of paths low..high, which share ``depth`` terms."""
        node = len(self.low)
        self.low.append(low)
        self.high.append(high)
        self.children.append([])
        if high - low <= LEAF_DOCS:
            return node
        first, last = self.paths[low].ranks, self.paths[high - 1].ranks
        n = min(len(first), len(last))
        differ = np.flatnonzero(first[:n] != last[:n])
        depth = int(differ[0]) if len(differ) else n  # paths are sorted: what the ends share all share
        head = [int(p.ranks[depth]) if len(p.ranks) > depth else -1 for p in self.paths[low:high]]
        cuts = [low] + [low + i for i in range(1, high - low) if head[i] != head[i - 1]] + [high]
        if len(cuts) == 2:  # paths that end here, which differ in frequencies only
            cuts = list(range(low, high, LEAF_DOCS)) + [high]
        at = 0
        while at + 1 < len(cuts):  # small neighbours make one leaf
            end = at + 1
            while end + 1 < len(cuts) and cuts[end + 1] - cuts[at] <= LEAF_DOCS:
                end += 1
            self.children[node].append(self._grow(cuts[at], cuts[end], depth + 1))
            at = end
        return node

    def _summarise(self, owner: np.ndarray, ranks: np.ndarray, tfs: np.ndarray) -> None:
        n = len(self.low)
        leaf_of = np.zeros(len(self.paths), np.int64)
        for v in range(n):
            if not self.children[v]:
                leaf_of[self.low[v] : self.high[v]] = v
        keys, most = _largest(leaf_of[owner] * self.width + ranks, tfs)
        per: list[tuple[np.ndarray, np.ndarray]] = [None] * n
        self.least_m = np.zeros(n, np.int64)
        for v in range(n - 1, -1, -1):  # children have larger numbers
            self.least_m[v] = self.m[self.low[v] : self.high[v]].min()
            if not self.children[v]:
                a, b = np.searchsorted(keys, [v * self.width, (v + 1) * self.width])
                per[v] = keys[a:b] - v * self.width, most[a:b]
            else:
                below = [per[c] for c in self.children[v]]
                per[v] = _largest(np.concatenate([k for k, _ in below]), np.concatenate([x for _, x in below]))
        self.largest = np.concatenate([k + v * self.width for v, (k, _) in enumerate(per)]), np.concatenate([x for _, x in per])

    def bounds(self, ranks: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Upper bound of the scores below each node for an item."""
        nodes = np.arange(len(self.low), dtype=np.int64)
        tf = _find(*self.largest, nodes[:, None] * self.width + ranks[None, :])
        return gain(w[None, :], tf, self.least_m[:, None]).sum(axis=1)

    def search(self, ranks: np.ndarray, w: np.ndarray, best: "Best") -> int:
        """Depth-first branch-and-bound; returns the number of paths scored."""
        bound = self.bounds(ranks, w)
        scored, stack = 0, [0]
        while stack:
            v = stack.pop()
            if bound[v] <= 0 or bound[v] < best.least:
                continue
            if self.children[v]:
                stack += sorted(self.children[v], key=bound.__getitem__)  # the best is on top
                continue
            at = np.arange(self.low[v], self.high[v], dtype=np.int64)
            scored += len(at)
            tf = _find(self.entry, self.tf, at[:, None] * self.width + ranks[None, :])
            score = gain(w[None, :], tf, self.m[at, None]).sum(axis=1)
            for i in np.flatnonzero((score > 0) & (score >= best.least)).tolist():
                best.add(int(score[i]), self.paths[self.low[v] + i].ids)
        return scored


def _largest(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the largest value of each."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    if not len(keys):
        return keys, values
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[at], np.maximum.reduceat(values, at)


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Values of the wanted keys, 0 where there is none."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


def _id_order(doc_id: int | None) -> tuple[bool, int]:
    return doc_id is None, doc_id or 0  # null identifiers come last


class Best:
    """The ``k`` best (score, identifier) of an item so far."""

    def __init__(self, k: int):
        self.k, self.rows, self.least = k, [], 1

    def add(self, score: int, ids: list) -> None:
        self.rows += [(score, i) for i in ids]
        if len(self.rows) >= self.k:
            self.rows = heapq.nsmallest(self.k, self.rows, key=lambda r: (-r[0], _id_order(r[1])))
            self.least = self.rows[-1][0]


# ---- Spark ---------------------------------------------------------------------


@dataclass
class Block:
    """Items of one block: their keys, and each one's terms as ranks with weights.
    ``hashes`` are the block's terms in order of their hash, ``rank`` their
    place in the order of falling document frequency."""

    keys: list[int]
    hashes: np.ndarray
    rank: np.ndarray
    items: list[tuple[np.ndarray, np.ndarray]]


def _chunks(batches: Iterable[pa.RecordBatch], block: Block, n_docs: int, length: int, k: int) -> Iterator[list[Path]]:
    held: dict[tuple, Path] = {}
    entries = 0
    for b in slices(batches):
        terms, tfs = b.column("terms"), b.column("tfs")
        ends = np.asarray(terms.offsets) - terms.offsets[0].as_py()
        flat, freq = terms.flatten().to_numpy(), tfs.flatten().to_numpy()
        at = np.minimum(np.searchsorted(block.hashes, flat), max(len(block.hashes) - 1, 0))
        known = block.hashes[at] == flat if len(block.hashes) else np.zeros(len(flat), bool)
        for i, (doc_id, n) in enumerate(zip(b.column("doc_id").to_pylist(), b.column("n").to_pylist())):
            mine = slice(ends[i], ends[i + 1])
            ok = known[mine]
            if not ok.any():
                continue
            ranks, f = block.rank[at[mine][ok]], freq[mine][ok]
            order = np.argsort(ranks)
            ranks, f = ranks[order], f[order]
            key = n, ranks.tobytes(), f.tobytes()
            path = held.get(key)
            if path is None:
                path = held[key] = Path(ranks, f, 10 + 90 * n * n_docs // length, [])
                entries += len(ranks)
            path.ids.append(doc_id)
            if len(path.ids) > 4 * k:
                path.ids = heapq.nsmallest(k, path.ids, key=_id_order)
            if len(held) >= CHUNK_DOCS or entries >= CHUNK_TERMS:
                yield list(held.values())
                held, entries = {}, 0
    if held:
        yield list(held.values())


_FOUND = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _searcher(block: Block, n_docs: int, length: int, k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in block.keys]
        for paths in _chunks(batches, block, n_docs, length, k):
            for p in paths:
                p.ids = heapq.nsmallest(k, p.ids, key=_id_order)
            tree = FpTree(paths, len(block.hashes))
            for (ranks, w), found in zip(block.items, best):
                if len(ranks):
                    tree.search(ranks, w, found)
        rows = [(key, i, s) for key, found in zip(block.keys, best) for s, i in found.rows]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(3)], schema=_FOUND)

    return run


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list]:
    """Rows (item, item_id, text) in blocks of about ``block_bytes`` of text,
    one at a time on the driver; a longer item is a block by itself."""
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bucket = F.pmod(F.xxhash64("text", "item"), F.lit(16 * max(1, -(-total // block_bytes))))
    groups: list[list[int]] = []
    for k, size in items.groupBy(bucket.alias("k")).agg(F.sum(F.octet_length("text"))).orderBy("k").collect():
        if groups and groups[-1][2] + size <= block_bytes:
            groups[-1][1:] = k, groups[-1][2] + size
        else:
            groups.append([k, k, size])
    for first, last, _ in groups:
        yield items.where(bucket.between(first, last)).collect()


def search_documents(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", k: int = K, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank, doc_id, score.

    Only scores above 0 rank; equal scores by ascending doc_id, null ones last.
    Null and termless texts are no documents; an item without terms, or whose
    terms no document has, gives no rows. An item is a distinct (item_id, text):
    repeated rows count once, a null item_id is an identifier like any other.
    Repeated documents each rank. Empty tables give no rows; other columns are
    not read. Whole texts are read, all statistics are over all documents.
    """
    spark = docs.sparkSession
    wanted = items.select(F.col(item_col).cast("long").alias("item_id"), whole_text(item_text_col).alias("text")).distinct()
    wanted = cut_lineage(wanted.withColumn("item", F.monotonically_increasing_id()))
    rows = bound_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    path = scratch_path(spark, f"term-vectors-{uuid.uuid4().hex}")
    rows.mapInArrow(_vectors(bit_table(wanted)), _VECTOR_DDL).write.parquet(path)
    vectors = spark.read.schema(_VECTOR_DDL).parquet(path)
    n_docs, length = vectors.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    frequency = vectors.where("n < 0").select(F.explode(F.arrays_zip("terms", "tfs")).alias("x")).groupBy(F.col("x.terms").alias("term")).agg(F.sum("x.tfs").alias("df"))
    found = None
    for rows_of_block in _blocks(wanted, block_bytes) if n_docs else ():
        block = _block(spark, rows_of_block, frequency, n_docs)
        part = vectors.where("n > 0").mapInArrow(_searcher(block, n_docs, length, k), "item long, doc_id long, score long")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))).where(F.col("rank") <= k)
    return ranked.join(wanted.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _block(spark, rows: list, frequency: DataFrame, n_docs: int) -> Block:
    terms = [{term_hash(t) for t in terms_of(r["text"])} for r in rows]
    mine = spark.createDataFrame([(h,) for h in sorted(set().union(*terms))], "term long")
    df = {r["term"]: r["df"] for r in frequency.join(mine, "term", "left_semi").collect()}  # the block's terms only
    hashes = np.array(sorted(df), np.int64)
    by_df = sorted(df, key=lambda h: (-df[h], h))
    rank_of = {h: i for i, h in enumerate(by_df)}
    weight = {h: int(np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df[h] + 1)))) for h in by_df}
    picked = [sorted(t & df.keys(), key=rank_of.__getitem__) for t in terms]
    items = [(np.array([rank_of[h] for h in t], np.int64), np.array([weight[h] for h in t], np.int64)) for t in picked]
    return Block([r["item"] for r in rows], hashes, np.array([rank_of[h] for h in hashes.tolist()], np.int64), items)


def _words_sql(column: str) -> str:
    return f"regexp_extract_all(translate({column}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, w, len(w) AS n FROM (SELECT doc_id, {_words_sql("text")} AS w FROM documents WHERE text IS NOT NULL) WHERE len(w) > 0),
total AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM d),
tf AS MATERIALIZED (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY r, t),
i AS MATERIALIZED (SELECT row_number() OVER () AS item, item_id, text FROM (SELECT DISTINCT item_id, coalesce(text, '') AS text FROM benchmark)),
q AS (SELECT DISTINCT item, unnest({_words_sql("text")}) AS t FROM i),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
w AS (SELECT q.item, q.t, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM q JOIN df ON df.t = q.t, total),
s AS (
  SELECT w.item, d.doc_id, d.r, CAST(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (10 + (90 * d.n * nd) // l)))) AS BIGINT) AS score
  FROM w JOIN tf ON tf.t = w.t JOIN d ON d.r = tf.r, total GROUP BY ALL
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT item, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0
) JOIN i USING (item) WHERE rank <= {K}
"""
