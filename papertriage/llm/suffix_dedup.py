"""Repeated substrings by prefix-free parsing and suffix order.

Bytes are removed where they belong to a string of ``LENGTH`` bytes that starts
anywhere else as well, in the same document or another.

*Parse.* A rolling (Karp-Rabin) hash over ``TRIGGER`` bytes chooses triggers:
the smallest hash of a window of ``LENGTH`` bytes, the leftmost of equal ones.
Every window has exactly one trigger and equal windows have it at the same
place, so triggers cut all texts into phrases in the same way wherever the same
bytes stand. (A hash that is 0 modulo some number, the usual trigger, leaves
windows without one.) The windows of one trigger are a run of neighbouring starts.

*Dictionary.* All windows of a run hold a common core (the trigger and 100
bytes to its right, or 100 to its left for windows that reach further left). A
run whose core stands nowhere else holds no repeated window; that is the bulk
of a corpus, and only hashes of it are exchanged. Runs that are equal from end
to end are one dictionary entry with a count: two or more settle all of its
windows, so a passage copied a million times costs one entry.

*Corpus order.* What is left are different runs around one core. Their left
contexts (read backwards) and right contexts are put in suffix order, each with
the common prefix of neighbours; a window that takes ``a`` bytes of the left
context and the rest from the right one is repeated where both orders keep it
together with another run. A whole corpus order would have to pass through one
task; equal windows share their core, so the order within each core is enough.
A core with more than ``GROUP_RUNS`` different runs is not ordered in a task:
its windows are counted by their digests in one aggregation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, cut_lineage, slices, whole_text

LENGTH = 200
TRIGGER = 16
REACH = LENGTH - TRIGGER + 1  # trigger starts in a window
HALF = LENGTH // 2
BUFFER = 1 << 21  # bytes parsed at a time
GROUP_RUNS = 50_000  # runs of one core that are ordered in a task

# a run of kind 0 has the core [i, i + TRIGGER + HALF), i being the trigger's
# start; one of kind 1 [i + TRIGGER - HALF - 1, i + TRIGGER); what its windows
# hold besides is ``MARGIN`` bytes, split between the left and the right side
CORE = (TRIGGER + HALF, HALF + 1)
SHIFT = (0, HALF + 1 - TRIGGER)  # from the core's start to the trigger's
MARGIN = tuple(LENGTH - c for c in CORE)

_PLACE = np.uint64((1 << 22) - 1)
_MULT = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * _MULT)


def rolling_hashes(data: np.ndarray) -> np.ndarray:
    """Mixed Karp-Rabin hashes (modulo 2**64) of all windows of TRIGGER bytes."""
    h, base = _BYTE[data], 0x2545F4914F6CDD1D
    for k in (1, 2, 4, 8):
        h = h[:-k] * np.uint64(base) + h[k:]
        base = base * base & (1 << 64) - 1
    return _mix(h)


def _window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbouring keys, by blocks' running minima."""
    n = len(keys) - width + 1
    rows = -(-len(keys) // width)
    a = np.full(rows * width, ~np.uint64(0), np.uint64)
    a[: len(keys)] = keys
    a = a.reshape(rows, width)
    ahead = np.minimum.accumulate(a, axis=1).ravel()
    behind = np.minimum.accumulate(a[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def _folded(h: np.ndarray, seed: np.ndarray | int, places: Iterable[np.ndarray]) -> np.ndarray:
    out = np.asarray(seed, np.uint64)
    for at in places:
        out = _mix(out * _MULT + h[at])
    return out


def parse(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of the windows inside [start, end) of each text in ``data``:
    (text, first window, number of windows - 1, trigger - first window, hash of
    the core, hash of the run)."""
    h = rolling_hashes(data)
    keys = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    trigger = (_window_minima(keys, REACH) & _PLACE).astype(np.int64)
    del keys
    edge = np.zeros(len(data) + 1, np.int8)
    long = ends - starts >= LENGTH
    edge[starts[long]] += 1
    edge[ends[long] - LENGTH + 1] -= 1
    p = np.flatnonzero(np.cumsum(edge[:-1], dtype=np.int8))
    if not len(p):
        return tuple(np.empty(0, np.int64) for _ in range(4)) + (np.empty(0, np.uint64),) * 2
    t = trigger[p]
    kind = t - p >= SHIFT[1]
    new = np.flatnonzero((p[1:] != p[:-1] + 1) | (t[1:] != t[:-1]) | (kind[1:] != kind[:-1])) + 1
    first, last = np.concatenate(([0], new)), np.concatenate((new, [len(p)])) - 1
    lo, hi, t, kind = p[first], p[last], t[first], kind[first]
    core = np.empty(len(lo), np.uint64)
    for k in (0, 1):
        i = t[kind == k] - SHIFT[k]
        steps = [*range(0, CORE[k] - TRIGGER, TRIGGER), CORE[k] - TRIGGER]
        core[kind == k] = _folded(h, k + 1, (i + s for s in steps))
    span, off = hi - lo, t - lo
    final = hi + LENGTH - TRIGGER
    run = _folded(h, (span * 256 + off).astype(np.uint64), (np.minimum(lo + s, final) for s in range(0, LENGTH + HALF + TRIGGER, TRIGGER)))
    text = np.searchsorted(starts, lo, side="right") - 1
    return text, lo - starts[text], span, off, core, run


# ---- suffix order within cores -------------------------------------------------


def _suffix_order(group: np.ndarray, context: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, common) of contexts by (group, bytes): ``common[j]`` is the
    length shared with the one before in order, -1 across groups."""
    raw = np.frombuffer(b"".join(c.ljust(width, b"\0") for c in context), np.uint8).reshape(len(context), width)
    as_key = np.ascontiguousarray(raw).view(f"V{width}").ravel() if width else np.zeros(len(context), "V1")
    order = np.array(sorted(range(len(context)), key=lambda j: (group[j], as_key[j].tobytes())), np.int64)
    s = raw[order]
    differ = s[1:] != s[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width) if width else np.zeros(len(s) - 1, np.int64)
    common = np.where(group[order][1:] == group[order][:-1], common, -1)
    return order, np.concatenate(([-1], common))


def repeated_windows(group: np.ndarray, left: list[bytes], right: list[bytes], low: np.ndarray, high: np.ndarray, twice: np.ndarray, margin: int) -> np.ndarray:
    """Matrix (run, a): the run's window with ``a`` bytes of its left context
    stands in another run of its group too, or in one that stands ``twice``.
    Left contexts are read backwards from the core; a run has windows for
    low <= a <= high."""
    n = len(group)
    hit = np.zeros((n, margin + 1), bool)
    l_order, l_common = _suffix_order(group, left, margin)
    r_order, r_common = _suffix_order(group, right, margin)
    l_class, r_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for a in range(margin + 1):
        has = np.flatnonzero((low <= a) & (a <= high))
        if len(has) == 0:
            continue
        l_class[l_order] = np.cumsum(l_common < a)
        r_class[r_order] = np.cumsum(r_common < margin - a)
        key = l_class[has] * (n + 1) + r_class[has]
        order = np.argsort(key, kind="stable")
        at = np.flatnonzero(np.concatenate(([True], key[order][1:] != key[order][:-1])))
        size = np.diff(np.concatenate((at, [len(has)])))
        known = (size > 1) | np.logical_or.reduceat(twice[has][order], at)
        hit[has[order], a] = np.repeat(known, size)
    return hit


# ---- Spark ---------------------------------------------------------------------


def text_key(data: bytes) -> int:
    """Equal texts share their results, so a text is named by its digest; the
    number of bytes, which goes with it everywhere, must agree as well."""
    return int.from_bytes(hashlib.sha256(data).digest()[:8], "little", signed=True)


def _packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    for b in slices(batches):
        data = [(t or "").encode("utf-8") for t in b.column("text").to_pylist()]
        columns = [pa.array([text_key(d) for d in data], pa.int64()), b.column("doc_id"), pa.array([len(d) for d in data], pa.int64()), pa.array([pack.compress(d) for d in data], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "doc_id", "n", "packed"])


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes]]:
    """(key, offset, bytes) of texts, very long ones in overlapping pieces."""
    step = BUFFER // 2
    for b in slices(batches):
        for t in b.column("text").to_pylist():
            data = (t or "").encode("utf-8")
            if len(data) < LENGTH:
                continue
            key = text_key(data)
            for at in range(0, len(data) - LENGTH + 1, step):
                yield key, at, data[at : at + step + LENGTH - 1]


_RUN = [("core", pa.int64()), ("run", pa.int64()), ("key", pa.int64()), ("place", pa.int64())]


def _place(lo, span, off):
    """First window, number of windows - 1 and the trigger's offset as one number."""
    return lo * 65536 + span * 256 + off


def _runs(cores_only: bool):
    def parsed(pieces: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        sizes = np.array([len(d) for _, _, d in pieces], np.int64)
        ends = np.cumsum(sizes)
        text, lo, span, off, core, run = parse(np.frombuffer(b"".join(d for _, _, d in pieces), np.uint8), ends - sizes, ends)
        if cores_only:
            return pa.RecordBatch.from_arrays([pa.array(core.view(np.int64))], names=["core"])
        keys, base = np.array([k for k, _, _ in pieces], np.int64), np.array([a for _, a, _ in pieces], np.int64)
        columns = core.view(np.int64), run.view(np.int64), keys[text], _place(lo + base[text], span, off)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=pa.schema(_RUN))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for piece in _pieces(batches):
            held.append(piece)
            size += len(piece[2])
            if size >= BUFFER // 2:
                yield parsed(held)
                held, size = [], 0
        if held:
            yield parsed(held)

    return work


_CONTEXT = pa.schema(
    [("core", pa.int64()), ("run", pa.int64()), ("twice", pa.bool_()), ("crowded", pa.bool_()), ("kind", pa.int32()), ("low", pa.int32()), ("high", pa.int32()), ("left", pa.binary()), ("right", pa.binary())]
)
_CONTEXT_DDL = "core long, run long, twice boolean, crowded boolean, kind int, low int, high int, left binary, right binary"


def _contexts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Left contexts (backwards) and right contexts of the chosen runs."""
    unpack = zstandard.ZstdDecompressor()
    done: tuple | None = None  # copies of one text stand next to each other
    for b in slices(batches, 64):
        out = []
        for key, packed, chosen in zip(b.column("key").to_pylist(), b.column("packed").to_pylist(), b.column("chosen").to_pylist()):
            if done == key:
                continue
            done = key
            data = unpack.decompress(packed)
            for c in chosen:
                lo, span, off = c["place"] >> 16, c["place"] >> 8 & 255, c["place"] & 255
                kind = int(off - span >= SHIFT[1])
                high = off - SHIFT[kind]  # bytes between the first window's start and the core
                core_end = lo + high + CORE[kind]
                right = data[core_end : lo + span + LENGTH]
                out.append((c["core"], c["run"], c["twice"], c["crowded"], kind, high - span, high, data[lo : lo + high][::-1], right))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _CONTEXT)], schema=_CONTEXT)


_HIT_DDL = "core long, run long, first long, last long"


def _intervals(core: np.ndarray, run: np.ndarray, high: np.ndarray, hit: np.ndarray) -> pa.RecordBatch:
    """Hits as stretches of windows, counted from the run's first one."""
    wide = np.zeros((hit.shape[0], hit.shape[1] + 2), np.int8)
    wide[:, 1:-1] = hit
    step = np.diff(wide, axis=1)
    row, a = np.nonzero(step == 1)
    _, after = np.nonzero(step == -1)
    # a larger a starts further left
    columns = core[row], run[row], high[row] - (after - 1), high[row] - a
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["core", "run", "first", "last"])


def _ordered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hits of runs that come sorted by core; whole cores are held."""

    def settle(t: pa.Table) -> Iterator[pa.RecordBatch]:
        kind = t.column("kind").to_numpy()
        for k in (0, 1):
            part = t.filter(pa.array(kind == k))
            if part.num_rows == 0:
                continue
            core, run, low, high = (part.column(c).to_numpy() for c in ("core", "run", "low", "high"))
            twice = part.column("twice").to_numpy()
            hit = repeated_windows(core, part.column("left").to_pylist(), part.column("right").to_pylist(), low, high, twice, MARGIN[k])
            hit[twice] = False  # these are settled
            yield _intervals(core, run, high, hit)

    held: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b])
        held = t if held is None else pa.concat_tables([held, t])
        if held.num_rows < 20_000:
            continue
        core = held.column("core").to_numpy()
        cut = int(np.searchsorted(core, core[-1], side="left"))
        if cut:
            yield from settle(held.slice(0, cut))
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield from settle(held)


_WINDOW = pa.schema([("core", pa.int64()), ("run", pa.int64()), ("twice", pa.bool_()), ("at", pa.int64()), ("digest", pa.binary())])


def _windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of the runs by a digest of its contexts."""
    for b in slices(batches):
        out = []
        for r in b.to_pylist():
            for a in range(r["low"], r["high"] + 1):
                rest = MARGIN[r["kind"]] - a
                digest = hashlib.blake2b(r["left"][:a] + r["right"][:rest], digest_size=15, salt=bytes([a])).digest()
                out.append((r["core"], r["run"], r["twice"], r["high"] - a, digest))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _WINDOW)], schema=_WINDOW)


_DONE = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary()), ("spans", pa.list_(pa.int64()))])


def _removed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for b in slices(batches, 64):
        out = []
        for doc_id, packed, marks in zip(b.column("doc_id").to_pylist(), b.column("packed").to_pylist(), b.column("marks").to_pylist()):
            data = unpack.decompress(packed)
            spans: list[int] = []
            for m in sorted((m["first"], m["last"] + LENGTH) for m in marks or ()):
                if spans and m[0] <= spans[-1]:
                    spans[-1] = max(spans[-1], m[1])
                else:
                    spans += m
            keep = [0, *spans, len(data)]
            kept = b"".join(data[keep[j] : keep[j + 1]] for j in range(0, len(keep), 2))
            out.append((doc_id, len(data), len(data) - len(kept), len(spans) // 2, hashlib.sha256(kept).hexdigest(), kept, spans))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _DONE)], schema=_DONE)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_runs: int = GROUP_RUNS) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256,
    kept (the remaining bytes) and spans (starts and ends of the removed runs).

    Null text is empty; texts under ``LENGTH`` bytes keep everything. Repeated
    rows are copies of each other. Null and repeated identifiers are carried
    through. An empty table gives no rows; other columns are not read. Bytes
    are removed one by one, so what remains need not be valid UTF-8.
    """
    rows = bound_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    counts = rows.mapInArrow(_runs(True), "core long").groupBy("core").agg(F.count("*").alias("met")).where("met > 1").select("core")
    runs = rows.mapInArrow(_runs(False), "core long, run long, key long, place long")
    met = cut_lineage(runs.join(counts, "core"))

    entries = cut_lineage(met.groupBy("core", "run").agg(F.count("*").alias("n"), F.min(F.struct("key", "place")).alias("where")))
    mixed = entries.groupBy("core").agg(F.count("*").alias("runs")).where("runs > 1")
    chosen = entries.join(mixed, "core").select(
        F.col("where.key").alias("key"), F.struct(F.col("core"), F.col("run"), F.col("where.place").alias("place"), (F.col("n") > 1).alias("twice"), (F.col("runs") > group_runs).alias("crowded")).alias("c")
    )
    # one exchange of the packed texts serves the contexts and the result
    texts = rows.mapInArrow(_packed, "key long, doc_id long, n long, packed binary")
    asked = texts.join(chosen.groupBy("key").agg(F.collect_list("c").alias("chosen")), "key").select("key", "doc_id", "n", "packed", "chosen")
    contexts = cut_lineage(asked.mapInArrow(_contexts, _CONTEXT_DDL).dropDuplicates(["core", "run"]))

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = contexts.where("NOT crowded").repartition(n, "core").sortWithinPartitions("core").mapInArrow(_ordered, _HIT_DDL)
    windows = contexts.where("crowded").mapInArrow(_windows, "core long, run long, twice boolean, at long, digest binary")
    repeated = windows.groupBy("core", "digest").agg(F.count("*").alias("n"), F.max("twice").alias("twice")).where("n > 1 OR twice").select("core", "digest")
    crowded = windows.where("NOT twice").join(repeated, ["core", "digest"]).select("core", "run", F.col("at").alias("first"), F.col("at").alias("last"))
    whole = entries.where("n > 1").select("core", "run", F.lit(0).cast("long").alias("first"), F.lit(255).cast("long").alias("last"))
    hits = whole.unionByName(ordered).unionByName(crowded)

    lo, span = F.shiftright("place", 16), F.shiftright("place", 8).bitwiseAND(255)
    marks = met.join(hits, ["core", "run"]).select("key", (lo + F.col("first")).alias("first"), (lo + F.least("last", span)).alias("last")).distinct()
    marked = marks.groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("marks"))
    return texts.join(marked, "key", "left").select("key", "doc_id", "n", "packed", "marks").mapInArrow(
        _removed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans array<long>"
    )


def repeat_digests(docs: DataFrame) -> DataFrame:
    """What the registered query returns: the rows without the bytes and spans."""
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


SQL = f"""
WITH b AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
c AS MATERIALIZED (SELECT r, n, q, substr(h, CAST(2 * q + 1 AS BIGINT), {2 * (256 + LENGTH - 1)}) AS h FROM (SELECT r, n, h, unnest(range(0, n - {LENGTH - 1}, 256)) AS q FROM b)),
w AS MATERIALIZED (SELECT r, q + j AS p, md5_number(substr(h, CAST(2 * j + 1 AS BIGINT), {2 * LENGTH})) AS k FROM (SELECT r, q, h, unnest(range(0, least(256, n - {LENGTH - 1} - q))) AS j FROM c)),
d AS (SELECT r, p FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)),
g AS (SELECT r, p, sum(fresh) OVER (PARTITION BY r ORDER BY p) AS g FROM (
  SELECT r, p, CASE WHEN p - lag(p) OVER (PARTITION BY r ORDER BY p) <= {LENGTH} THEN 0 ELSE 1 END AS fresh FROM d)),
s AS (SELECT r, min(p) AS a, max(p) + {LENGTH} AS z FROM g GROUP BY r, g),
k AS (
  SELECT b.r, string_agg(substr(h, CAST(2 * e.a + 1 AS BIGINT), CAST(2 * (e.z - e.a) AS BIGINT)), '' ORDER BY e.a) AS kept, count(*) - 1 AS n_spans, sum(e.z - e.a) AS n_kept
  FROM b JOIN (
    SELECT r, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS a, a AS z FROM (SELECT r, a, z FROM s UNION ALL SELECT r, n, n FROM b)
  ) e ON e.r = b.r GROUP BY b.r
)
SELECT b.doc_id, b.n AS n_bytes, CAST(b.n - n_kept AS BIGINT) AS n_removed, n_spans, sha256(unhex(kept)) AS kept_sha256 FROM b JOIN k USING (r)
"""
