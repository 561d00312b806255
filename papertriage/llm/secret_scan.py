"""Secret scan: fixed patterns plus sliding-window entropy per character class.

The base patterns (assign, access, hex) are reported as they match. On top,
candidate strings (long runs of credential characters) are swept by a window
of fixed length; the Shannon entropy of the window under each character class
is kept up to date from the counts of the one character that enters and the
one that leaves. Windows above the class's limit join into one span, and the
allow list suppresses spans that are ordinary text. Base spans are never
suppressed.

Everything is per row: there is no shuffle, and a row's work grows with its
length alone.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, slices, texts

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
KINDS = ("assign", "access", "hex", "entropy")

# a run shorter than the limit holds no match, so the same leftmost runs are found faster
_HEX_LONG = re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)


@dataclass(frozen=True)
class EntropyClass:
    """One character class: windows of ``window`` characters drawn only from
    ``chars`` are hot at ``bits`` of Shannon entropy or more."""

    name: str
    chars: str
    window: int
    bits: float


_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
CLASSES = (
    EntropyClass("hex_upper", _DIGITS + "ABCDEF", 24, 3.0),
    EntropyClass("base32", "234567" + _UPPER, 24, 3.6),
    EntropyClass("alnum", _DIGITS + _LOWER + _UPPER, 20, 3.9),
    EntropyClass("base64", _DIGITS + _LOWER + _UPPER + "+/=_-", 24, 4.1),
)
CANDIDATE = re.compile(r"[A-Za-z0-9+/=_-]{%d,}" % min(c.window for c in CLASSES))

# Allow list: what a hot span may be without being a secret.
ALLOW = (
    re.compile(r"[A-Za-z]+"),  # letters alone: a long word
    re.compile(r"[0-9]+"),  # a number
    re.compile(r"[A-Za-z]+(?:[-_/][A-Za-z]+)+"),  # words in a path or compound
    re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),  # UUID
    re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}(?:[T_-][0-9-]+)?"),  # date
)
_XLOG = [0.0] + [n * math.log2(n) for n in range(1, 65)]


def hot_spans(run: str, cls: EntropyClass) -> list[tuple[int, int]]:
    """Merged windows of ``run`` whose entropy reaches the class's limit.

    H = log2(w) - sum(c*log2 c)/w, so only sum(c*log2 c) has to follow the
    counts: two updates per step, whatever the window's length.
    """
    w, n = cls.window, len(run)
    inside = set(cls.chars)
    out: list[tuple[int, int]] = []
    count: dict[str, int] = {}
    total, start = 0.0, 0
    limit = (math.log2(w) - cls.bits) * w + 1e-9
    for i, ch in enumerate(run):
        if ch not in inside:
            count.clear()
            total, start = 0.0, i + 1
            continue
        c = count.get(ch, 0)
        total += _XLOG[c + 1] - _XLOG[c]
        count[ch] = c + 1
        if i - start >= w:
            gone = run[start]
            c = count[gone]
            total += _XLOG[c - 1] - _XLOG[c]
            count[gone] = c - 1
            start += 1
        if i - start == w - 1 and total <= limit:
            if out and start <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((start, i + 1))
    return out


def allowed(s: str) -> bool:
    """Whether the allow list suppresses a hot string: it is ordinary text, or
    holds too few digits or character changes for a generated credential."""
    if any(p.fullmatch(s) for p in ALLOW):
        return True
    return not any(ch.isdigit() for ch in s) or not any(ch.isalpha() for ch in s)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the base patterns' matches."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), 2, m.end()) for m in _HEX_LONG.finditer(text)]
    return sorted(out)


def entropy_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the hot spans that the allow list leaves;
    spans of several classes that overlap are reported as one."""
    out: list[tuple[int, int]] = []
    for m in CANDIDATE.finditer(text):
        run, at = m.group(), m.start()
        if allowed(run):  # the whole candidate is ordinary text
            continue
        hot = sorted({s for c in CLASSES for s in hot_spans(run, c)})
        joined: list[tuple[int, int]] = []
        for s, e in hot:
            if joined and s <= joined[-1][1]:
                joined[-1] = (joined[-1][0], max(e, joined[-1][1]))
            else:
                joined.append((s, e))
        out += [(at + s, at + e) for s, e in joined if not allowed(run[s:e])]
    return [(s, 3, e) for s, e in out]


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


_OUT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_entropy long"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
     ("base_sha256", pa.string()), ("spans", pa.string()), ("n_entropy", pa.int64())]
)


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        cols: list[list] = [[] for _ in range(6)]
        for t in texts(b, "text"):
            base, more = base_spans(t), entropy_spans(t)
            n = [0, 0, 0]
            for _, k, _e in base:
                n[k] += 1
            for c, v in zip(cols, (*n, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(base + more), len(more))):
                c.append(v)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(cols, list(_ARROW)[1:]))], schema=_ARROW)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, base_sha256,
    spans (``kind:start:end`` in code points, by start then kind), n_entropy.

    Null text counts as empty (no spans: empty ``spans``, digest of the empty
    string). Null or repeated identifiers are carried through; each row is
    scanned by itself. An empty table gives no rows; other columns are not
    read.
    """
    rows = bound_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_scan, _OUT)
