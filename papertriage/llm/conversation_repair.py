"""Structure repair of conversations by a lightest-derivation agenda (Knuth).

A conversation is well formed when its role initials read ``(s?(ua)+)?``. Its
repairs are derivations in a weighted hypergraph:

* an *edit* item ``(i, q, r)`` says that row ``i`` can be treated so that the
  reading goes from state ``q`` to ``r`` (Keep, Rerole or Delete);
* a *prefix* item ``(i, q)`` says that the first ``i`` rows can be repaired so
  that the reading is in state ``q``; it follows from a prefix and an edit
  item together, or from a prefix by an Insert;
* the goal is the prefix of all rows in an accepting state.

A weight is ``(cost, audit)``: costs add, audits (the edits' initials) are
joined. Items leave the agenda in the order (cost, rows read, audit), in which
no deduction is smaller than what it is made from, so an item is final when it
leaves and the first goal to leave is the lightest repair. Two audits of one
item at one cost are never prefixes of each other, so joining keeps the order.

Rows are sorted by a range partitioning whose key ends in a salt, so a long
conversation, or one row repeated very often, is cut over tasks. Each cut piece
gives the lightest derivations between all pairs of states; these are the edit
items of the same agenda one level up. Only the digest of a cut conversation
reads its rows in one stream (a digest has no other way), a batch at a time.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, cut_lineage, slices

# fixed values: costs, white space, sentence ends, and the states of (s?(ua)+)?
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SPACE = " \t\n\x0b\x0c\r"
END = ".!?"
START, SYSTEM, USER, DONE = 0, 1, 2, 3
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): DONE, (DONE, "u"): USER}
ACCEPTING = (START, DONE)
LEGAL = ("su", "ua", "au")

BLOCK = 128  # rows of one agenda; longer stretches are joined level by level
FAN_IN = 16

Weight = tuple[int, str]
Piece = dict[tuple[int, int], Weight]  # (state before, state after) -> lightest


# ---- the agenda --------------------------------------------------------------


@lru_cache(maxsize=4096)
def edits_of(code: str) -> tuple[tuple[int, int, int, str], ...]:
    """Edit items (before, after, cost, audit) of a row. Its code is ``-`` for
    one to be deleted, else its role initial, in upper case when truncated and
    ``?`` or ``!`` (truncated) when it is none of s, u and a."""
    out = [(q, q, DELETE, "D") for q in range(4)]
    if code != "-":
        extra = TRUNCATED if code.isupper() or code == "!" else 0
        for (q, c), r in STEP.items():
            if c == code.lower():
                out.append((q, r, extra, "K"))
            elif c in "ua":
                out.append((q, r, REROLE + extra, "R"))
    return tuple(out)


_INSERTS = [(q, r) for (q, c), r in STEP.items() if c in "ua"]


def lightest(edits: list[Iterable[tuple[int, int, int, str]]], start: int, goals: tuple[int, ...] | None, insert: bool) -> dict[int, Weight]:
    """Lightest weights of the prefixes of all rows, by state. With ``goals``
    the agenda ends with the first of them; without, when it is empty."""
    n = len(edits)
    agenda: list[tuple[int, int, str, int, int, int]] = [(0, 1, "", 0, start, -1)]
    agenda += [(c, 0, a, i, q, r) for i, row in enumerate(edits) for q, r, c, a in row]
    heapq.heapify(agenda)
    prefix: dict[tuple[int, int], Weight] = {}
    edit: dict[tuple[int, int], dict[int, Weight]] = {}
    out: dict[int, Weight] = {}
    while agenda:
        cost, _, audit, i, q, r = heapq.heappop(agenda)
        if r < 0:  # the prefix of i rows in state q
            if (i, q) in prefix:
                continue
            prefix[i, q] = cost, audit
            if i == n:
                out[q] = cost, audit
                if goals and q in goals:
                    return out
            for to, (c, a) in edit.get((i, q), {}).items():
                heapq.heappush(agenda, (cost + c, i + 2, audit + a, i + 1, to, -1))
            if insert:
                for q1, to in _INSERTS:
                    if q1 == q and (i, to) not in prefix:
                        heapq.heappush(agenda, (cost + INSERT, i + 1, audit + "I", i, to, -1))
        else:
            known = edit.setdefault((i, q), {})
            if r in known:
                continue
            known[r] = cost, audit
            if (i, q) in prefix:
                c, a = prefix[i, q]
                heapq.heappush(agenda, (cost + c, i + 2, a + audit, i + 1, r, -1))
    return out


def piece_of(codes: list[str]) -> Piece:
    """Lightest derivations of a stretch of rows between all pairs of states."""
    pieces: list[Piece] = []
    for at in range(0, len(codes), BLOCK):
        rows = [edits_of(c) for c in codes[at : at + BLOCK]]
        pieces.append({(q, r): w for q in range(4) for r, w in lightest(rows, q, None, True).items()})
    return join_pieces(pieces)


def join_pieces(pieces: list[Piece]) -> Piece:
    """Neighbouring stretches as one, ``FAN_IN`` at a time and level by level."""
    while len(pieces) > 1:
        up = []
        for at in range(0, len(pieces), FAN_IN):
            rows = [[(q, r, *w) for (q, r), w in p.items()] for p in pieces[at : at + FAN_IN]]
            up.append({(q, r): w for q in range(4) for r, w in lightest(rows, q, None, False).items()})
        pieces = up
    return pieces[0] if pieces else {(q, q): (0, "") for q in range(4)}


@lru_cache(maxsize=50_000)
def _short_repair(codes: tuple[str, ...]) -> Weight:
    reached = lightest([edits_of(c) for c in codes], START, ACCEPTING, True)
    return next(w for q, w in reached.items() if q in ACCEPTING)


def repair(codes: list[str]) -> Weight:
    """(cost, audit) of the lightest repair; of equally cheap ones that whose
    audit is least in ASCII order."""
    if len(codes) <= BLOCK:
        return _short_repair(tuple(codes))
    whole = piece_of(codes)
    return min(whole[START, q] for q in ACCEPTING if (START, q) in whole)


def fault_of(role: str, text: str, seen: bool) -> str:
    """The first fault of a row: blank, duplicate, truncated or none ("")."""
    bare = text.strip(SPACE)
    if not bare:
        return "blank"
    if seen:
        return "duplicate"
    return "" if bare[-1] in END else "truncated"


def code_of(role: str, fault: str) -> str:
    if fault in ("blank", "duplicate"):
        return "-"
    known = role[:1] in ("s", "u", "a")
    if fault:
        return role[0].upper() if known else "!"
    return role[0] if known else "?"


def apply_audit(audit: str, rows: Iterable[tuple[str, str]], state: int = START) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the repaired rows; ``rows`` are the (role, text)
    that the audit's edits other than Insert go through, from ``state`` on."""
    rows = iter(rows)
    for e in audit:
        role, text = ("", "") if e == "I" else next(rows)
        if e == "D":
            continue
        if e != "K":
            role = "assistant" if state == USER else "user"
        state = STEP[state, role[0]]
        yield e, role, text


# ---- Spark -------------------------------------------------------------------

_FAULTS = ("blank", "duplicate", "truncated")
_SUMMARY = pa.schema(
    [("conv_id", pa.int64()), *((c, pa.int64()) for c in ("gaps", *_FAULTS, "illegal", "cost")), ("audit", pa.string()), ("repaired_sha256", pa.string())]
)
_SUMMARY_DDL = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_PART = pa.schema(
    [("conv_id", pa.int64()), ("seg", pa.int32()), *((c, pa.int64()) for c in _FAULTS), ("illegal", pa.int64()), ("first_role", pa.string()), ("last_role", pa.string())]
    + [("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()), ("moves", pa.list_(pa.struct([("q", pa.int32()), ("r", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))]
)
_PART_DDL = (
    "conv_id long, seg int, blank long, duplicate long, truncated long, illegal long, first_role string, last_role string, low long, high long, turns long, "
    "moves array<struct<q:int,r:int,cost:long,audit:string>>"
)


class _Stretch:
    """Neighbouring rows of one conversation, in order."""

    def __init__(self) -> None:
        self.rows: list[tuple[str, str]] = []
        self.codes: list[str] = []
        self.count = dict.fromkeys(_FAULTS, 0)
        self.illegal = self.turns = 0
        self.low: int | None = None
        self.high: int | None = None
        self.met: set[tuple[str, bytes]] = set()

    def add(self, turn: int | None, role: str, text: str, seen: bool, keep_text: bool) -> None:
        key = role, text.encode() if len(text) < 32 else hashlib.blake2b(text.encode(), digest_size=16).digest()
        fault = fault_of(role, text, seen or key in self.met)
        self.met.add(key)
        if fault:
            self.count[fault] += 1
        if self.rows and self.rows[-1][0][:1] + role[:1] not in LEGAL:
            self.illegal += 1
        self.codes.append(code_of(role, fault))
        self.rows.append((role, text if keep_text else ""))
        if turn is not None:
            if turn != self.high:
                self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def _stretches(batches: Iterable[pa.RecordBatch], keep_text: bool, with_seg: bool) -> Iterator[tuple[int | None, int | None, _Stretch]]:
    at, held = None, None
    for b in slices(batches):
        cols = [b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text")]
        segs = b.column("seg").to_pylist() if with_seg else [None] * b.num_rows
        seen = b.column("seen").to_pylist() if with_seg else [False] * b.num_rows
        for conv, turn, role, text, seg, was in zip(*cols, segs, seen):
            if held is None or at != (conv, seg):
                if held is not None:
                    yield *at, held
                at, held = (conv, seg), _Stretch()
            held.add(turn, role, text, was, keep_text)
    if held is not None:
        yield *at, held


def _packed(rows: Iterable[tuple], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    part: list[tuple] = []
    for r in chain(rows, [None]):
        if r is not None:
            part.append(r)
        if part and (r is None or len(part) >= size):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)
            part = []


def _repair_whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for conv, _, s in _stretches(batches, True, False):
            cost, audit = repair(s.codes)
            sha, first = hashlib.sha256(), True
            for _, role, text in apply_audit(audit, s.rows):
                sha.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
            yield conv, s.gaps, *s.count.values(), s.illegal, cost, audit, sha.hexdigest()

    yield from _packed(rows(), _SUMMARY)


def _repair_parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for conv, seg, s in _stretches(batches, False, True):
            moves = [{"q": q, "r": r, "cost": c, "audit": a} for (q, r), (c, a) in piece_of(s.codes).items()]
            yield conv, seg, *s.count.values(), s.illegal, s.rows[0][0][:1], s.rows[-1][0][:1], s.low, s.high, s.turns, moves

    yield from _packed(rows(), _PART, 1)


_JOINED_DDL = "conv_id long, seg int, state int, slice string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _join_parts(parts):
    """All parts of one conversation (at most one a partition): what they sum
    to, and the edits of each, in the part's own row."""
    parts = parts.sort_values("seg")
    pieces = [{(m["q"], m["r"]): (m["cost"], m["audit"]) for m in ms} for ms in parts["moves"]]
    whole = join_pieces(pieces)
    cost, audit = min(whole[START, q] for q in ACCEPTING if (START, q) in whole)
    # the states between parts: what is left must be derivable from there
    state, rest, begin, cut = START, audit, [], []
    ends: list[dict[int, Weight]] = [{q: (0, "") for q in ACCEPTING}]
    for p in reversed(pieces):
        best: dict[int, Weight] = {}
        for (q, r), (c, a) in p.items():
            if r in ends[-1]:
                w = c + ends[-1][r][0], a + ends[-1][r][1]
                best[q] = min(best.get(q, w), w)
        ends.append(best)
    ends.reverse()
    for k, p in enumerate(pieces):
        begin.append(state)
        state, mine = next((r, a) for (q, r), (c, a) in sorted(p.items()) if q == state and r in ends[k + 1] and a + ends[k + 1][r][1] == rest)
        cut.append(mine)
        rest = rest[len(mine) :]
    role = list(zip(parts["last_role"], parts["first_role"].iloc[1:]))
    illegal = int(parts["illegal"].sum()) + sum(a + b not in LEGAL for a, b in role)
    have = parts[parts["low"].notna()]
    shared = sum(a == b for a, b in zip(have["high"], have["low"].iloc[1:]))
    gaps = int(have["high"].max() - have["low"].min()) + 1 - int(have["turns"].sum()) + shared if len(have) else 0
    out = parts[["conv_id", "seg"]].copy()
    out["state"], out["slice"], out["gaps"] = begin, cut, gaps
    for f in _FAULTS:
        out[f] = int(parts[f].sum())
    out["illegal"], out["cost"] = illegal, cost
    out["audit"] = [audit] + [""] * (len(parts) - 1)
    return out


def _digest_stream(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, repaired_sha256) of a stream of rows sorted by (conv_id, seg,
    mark, order); the row of mark 0 holds the part's edits."""
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])

    def rows():
        at, sha, first, edits, state, place = (), None, True, "", START, 0

        def run(to_row: bool, role: str = "", text: str = ""):
            nonlocal first, state, place
            while place < len(edits):
                e = edits[place]
                if e != "I" and not to_row:
                    return
                place += 1
                r, t = (role, text) if e != "I" else ("", "")
                if e != "D":
                    r = r if e == "K" else ("assistant" if state == USER else "user")
                    state = STEP[state, r[0]]
                    sha.update(f"{'' if first else chr(10)}{r}:{t}".encode())
                    first = False
                if e != "I":
                    return

        for b in slices(batches):
            for conv, mark, role, text, begin in zip(*(b.column(c).to_pylist() for c in ("conv_id", "mark", "role", "text", "state"))):
                if mark == 0:
                    if sha is not None:
                        run(False)
                    if at != (conv,):
                        if sha is not None:
                            yield *at, sha.hexdigest()
                        at, sha, first = (conv,), hashlib.sha256(), True
                    edits, state, place = text, begin, 0
                else:
                    run(True, role, text)
        if sha is not None:
            run(False)
            yield *at, sha.hexdigest()

    yield from _packed(rows(), schema)


_ORDER = ["turn", "role", "text", "salt"]


def _repair_cut(rows: DataFrame, partitions: int) -> DataFrame:
    """Conversations that a range partitioning has cut: parts first, then one
    agenda over the parts of each, then the digest."""
    digest = F.sha2("text", 256)
    first = rows.groupBy("conv_id", "role", digest.alias("sha")).agg(F.min("seg").alias("first_seg"))
    same = F.col("l.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("l.role") == F.col("f.role")) & (F.col("l.sha") == F.col("f.sha"))
    marked = rows.withColumn("sha", digest).alias("l").join(first.alias("f"), same).select("l.*", (F.col("first_seg") < F.col("seg")).alias("seen")).drop("sha")
    dealt = marked.repartition(partitions, "conv_id", "seg").sortWithinPartitions("conv_id", "seg", *_ORDER)
    parts = cut_lineage(dealt.mapInArrow(_repair_parts, _PART_DDL))
    joined = cut_lineage(parts.groupBy("conv_id").applyInPandas(_join_parts, _JOINED_DDL))
    none = F.lit(None).cast("string")
    heads = joined.select("conv_id", "seg", F.lit(0).alias("mark"), "state", F.lit(None).cast("long").alias("turn"), none.alias("role"), F.col("slice").alias("text"), F.lit(0).cast("long").alias("salt"))
    stream = heads.unionByName(rows.select("conv_id", "seg", F.lit(1).alias("mark"), F.lit(0).alias("state"), *_ORDER))
    stream = stream.repartition(partitions, "conv_id").sortWithinPartitions("conv_id", "seg", "mark", *_ORDER)
    sha = stream.mapInArrow(_digest_stream, "conv_id long, repaired_sha256 string")
    totals = joined.groupBy("conv_id").agg(*(F.max(c).alias(c) for c in ("gaps", *_FAULTS, "illegal", "cost", "audit")))
    return totals.alias("t").join(sha.alias("s"), F.col("t.conv_id").eqNullSafe(F.col("s.conv_id"))).select("t.*", "s.repaired_sha256")


def repair_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256 (of the repaired ``role:text`` lines).

    Rows are read by turn, null turns first; rows of one turn by role and text.
    A null role or text counts as one space, so the row is blank or has a role
    that cannot be kept (Rerole or Delete). All rows with a null conv_id are one
    conversation. Repeated rows are duplicates. An empty table gives no rows;
    other columns are not read. A role counts by its first character, which
    must be s, u or a to be kept; an empty role has none.
    """
    n = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plain = bound_batches(rows).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), _spaced(role_col).alias("role"), _spaced(text_col).alias("text"), F.monotonically_increasing_id().alias("salt")
    )
    dealt = plain.repartitionByRange(n, "conv_id", *_ORDER).sortWithinPartitions("conv_id", *_ORDER)
    rows = cut_lineage(dealt.withColumn("seg", F.spark_partition_id()))
    # a boundary between partitions cuts at most one conversation
    cut = [r[0] for r in rows.groupBy("conv_id").agg(F.min("seg").alias("a"), F.max("seg").alias("b")).where("a < b").select("conv_id").collect()]
    if not cut:
        return rows.mapInArrow(_repair_whole, _SUMMARY_DDL)
    is_cut = F.when(F.col("conv_id").isNull(), F.lit(None in cut)).otherwise(F.col("conv_id").isin([c for c in cut if c is not None]))
    whole = rows.where(~is_cut).mapInArrow(_repair_whole, _SUMMARY_DDL)
    return whole.unionByName(_repair_cut(rows.where(is_cut), n))


def _spaced(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damage(rows: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text) with damage by crc32 of
    ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 removes
    its sentence ends, 3 repeats it, 4 sets its role to user. Nulls are one space."""
    kind = F.crc32(F.concat_ws(":", _spaced("conv_id"), _spaced("turn"))) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(_spaced("text"), END, "")).otherwise(_spaced("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(_spaced("role"))
    times = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("time")).drop("time")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """Damage, then repair; a conversation without rows left has zeros, an
    empty audit and the digest of the empty text. Every conv_id gives one row."""
    out = repair_conversations(damage(conversations))
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    filled = ids.alias("i").join(out.alias("o"), F.col("i.conv_id").eqNullSafe(F.col("o.conv_id")), "left")
    zero = [F.coalesce(F.col(f"o.{c}"), F.lit(0).cast("long")).alias(c) for c in ("gaps", *_FAULTS, "illegal", "cost")]
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return filled.select("i.conv_id", *zero, F.coalesce("o.audit", F.lit("")).alias("audit"), F.coalesce("o.repaired_sha256", empty).alias("repaired_sha256"))


# ---- SQL: the same repair as a recursion over rows, weights as sortable text --


def _plus(w: str, cost: str, audit: str) -> str:
    return f"(printf('%010d', CAST(substr({w}, 1, 10) AS BIGINT) + {cost}) || substr({w}, 11) || '{audit}')"


def _take(w: str, initial: str) -> str:
    keep, other = _plus(w, "extra", "K"), _plus(w, f"extra + {REROLE}", "R")
    return f"CASE WHEN gone THEN NULL WHEN initial = '{initial}' THEN {keep} ELSE {other} END"


_BARE = "rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
SQL = f"""
WITH RECURSIVE tab AS MATERIALIZED (
  SELECT list(list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)
),
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
kinds AS (
  SELECT src.*, xor(list_reduce([4294967295] || list_transform(range(1, len(k) + 1), lambda i: CAST(ascii(k[i]) AS BIGINT)),
    lambda c, b: xor(c >> 8, tab.t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM src, tab
),
damaged AS MATERIALIZED (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '{END}', '') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS time FROM kinds WHERE kind <> 0
),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth, substr(role, 1, 1) AS initial
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged)
),
rows AS MATERIALIZED (
  SELECT *, {_BARE} = '' OR nth > 1 AS gone, CASE WHEN substr({_BARE}, -1) IN ('.', '!', '?') THEN 0 ELSE {TRUNCATED} END AS extra,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed
),
stats AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER ({_BARE} = '') AS blank, count(*) FILTER ({_BARE} <> '' AND nth > 1) AS duplicate,
    count(*) FILTER (NOT gone AND extra > 0) AS truncated, count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM rows GROUP BY conv_id
),
moves AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, '0000000000:' AS c0, CAST(NULL AS VARCHAR) AS c1, '{INSERT:010d}:I' AS c2, '{2 * INSERT:010d}:II' AS c3 FROM stats
  UNION ALL
  SELECT conv_id, i, n0, n1, least(n2, {_plus("n0", str(INSERT), "I")}, {_plus("n1", str(INSERT), "I")}, {_plus("n3", str(INSERT), "I")}),
    least(n3, {_plus("n2", str(INSERT), "I")}, {_plus("n0", str(2 * INSERT), "II")}, {_plus("n1", str(2 * INSERT), "II")})
  FROM (
    SELECT m.conv_id, r.i, {_plus("c0", str(DELETE), "D")} AS n0,
      least({_plus("c1", str(DELETE), "D")}, CASE WHEN NOT gone AND initial = 's' THEN {_plus("c0", "extra", "K")} END) AS n1,
      least({_plus("c2", str(DELETE), "D")}, {_take("c0", "u")}, {_take("c1", "u")}, {_take("c3", "u")}) AS n2,
      least({_plus("c3", str(DELETE), "D")}, {_take("c2", "a")}) AS n3
    FROM moves m JOIN rows r ON r.conv_id IS NOT DISTINCT FROM m.conv_id AND r.i = m.i + 1
  )
),
best AS MATERIALIZED (SELECT s.*, least(c0, c3) AS w, substr(least(c0, c3), 12) AS audit FROM moves m JOIN stats s ON s.conv_id IS NOT DISTINCT FROM m.conv_id AND m.i = s.n),
edits AS (
  SELECT conv_id, j, substr(audit, j, 1) AS e, CASE WHEN substr(audit, j, 1) <> 'I' THEN j - (length(substr(audit, 1, j)) - length(replace(substr(audit, 1, j), 'I', ''))) END AS i,
    length(replace(substr(audit, 1, j), 'D', '')) AS k FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS j FROM best)
),
kept AS (
  SELECT e.*, r.role, coalesce(r.text, '') AS text, max(CASE WHEN k = 1 AND e = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS opened
  FROM edits e LEFT JOIN rows r ON r.conv_id IS NOT DISTINCT FROM e.conv_id AND r.i = e.i WHERE e <> 'D'
),
lines AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (k - opened) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS repaired
  FROM kept GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(CAST(substr(w, 1, 10) AS BIGINT), 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM c.conv_id
"""
