"""Token counts per document by a map-side two-tier lookup.

Tier one is a compact table of the lengths (in tokens) of the most frequent
pre-tokens, sent to every task. It is counted over the whole texts of all
documents: every task keeps a summary of bounded size (its rarest entries go
when it is full), and one aggregation adds the summaries up. Tier two is the
worker's own cache: what the table lacks is encoded once per worker. The
pre-tokens of the texts are never exchanged; counting is one narrow pass.

The table and the cache only decide how fast a count is found, never its value.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import BpeEncoder, split_safe, worker_encoder
from .common import bound_batches, slices, texts

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
# pre-tokens in the table; entries that a task counts at a time, and passes on
TABLE_ENTRIES = 16_384
TASK_ENTRIES = 4 * TABLE_ENTRIES

_OUT = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])


def _summary(entries: int):
    """A task's most frequent pre-tokens; at most four times ``entries`` are held."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for b in slices(batches):
            for t in texts(b, "text"):
                seen.update(split_safe(t) or ())
            if len(seen) > 4 * entries:
                seen = Counter(dict(seen.most_common(2 * entries)))
        top = [(p, n) for p, n in seen.most_common(entries) if len(p) <= 64 and n > 1]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["piece", "n"])

    return run


def frequent_lengths(docs: DataFrame, path: str, text_col: str = "text", entries: int = TABLE_ENTRIES) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of all documents; ``entries`` of
    them (under 1 MB) reach the driver, in one job whatever the number of
    partitions. A summary may miss a pre-token that is rare in every task;
    the table sets speed only, every count is exact with any table."""
    rows = bound_batches(docs).select(F.col(text_col).cast("string").alias("text"))
    counted = rows.mapInArrow(_summary(max(entries, TASK_ENTRIES if entries else 0)), "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    encoder = BpeEncoder(path)
    return {r["piece"]: encoder.count(r["piece"]) for r in counted.orderBy(F.desc("n"), "piece").limit(entries).collect()} if entries else {}


def _pack_table(table: dict[str, int]) -> tuple[str, bytes]:
    """The table as one string and one byte per entry; tokens of 64 characters
    have at most 256 bytes, so lengths over 255 are simply left out."""
    kept = [(p, n) for p, n in table.items() if n < 256 and "\x00" not in p]
    return "\x00".join(p for p, _ in kept), bytes(n for _, n in kept)


def _unpack_table(packed: tuple[str, bytes]) -> dict[str, int]:
    return dict(zip(packed[0].split("\x00"), packed[1])) if packed[1] else {}


def _counter(path_name: str, packed: tuple[str, bytes], limit: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(public_tokenizers.path(path_name))
        lookup = encoder.tiers(_unpack_table(packed))
        for b in slices(batches):
            ts = texts(b, "text")
            n = [encoder.count(t, lookup) for t in ts]
            size = [len(t.encode("utf-8")) for t in ts]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                schema=_ARROW,
            )
        encoder.forget()

    return run


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, limit: int = LIMIT, entries: int = TABLE_ENTRIES) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit.

    Whole texts, no special tokens added; a special token's string inside a
    text counts as the library's default has it (one token). Null text is
    empty: 0 bytes, 0 tokens. Null or repeated identifiers are carried
    through, an empty table gives no rows, other columns are not read.
    """
    packed = _pack_table(frequent_lengths(docs, public_tokenizers.path(tokenizer), text_col, entries))
    rows = bound_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_counter(tokenizer, packed, limit), _OUT)
