"""Exact duplicates by a tree merge of sorted digest runs.

Each input partition is one *run*: its digests in order, each once, with the
identifier that stays and the number of rows. In a binomial round neighbouring
runs meet in pairs: both are dealt by digest bucket, every task puts what it
receives of the two runs in one order and folds equal neighbours, so a digest
leaves a round at most once per pair. After ``ceil(log2(runs))`` rounds one
entry per digest is left, spread over all buckets. (An exchange hands rows over
block by block, so the merge is Spark's sort of the two runs' blocks.) A digest
that a third of all rows share is folded inside its runs first, so no task ever
receives more than ``fan_in`` entries for it, and no task ever holds the whole
table.

Entries count as equal only when digest, byte length and a second, independent
hash of the text agree; this is checked in every fold.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, whole_text

FAN_IN = 2  # runs that meet in a round
KEY = ["digest", "n_bytes", "check_hash"]
_RUN_SCHEMA = "digest binary, n_bytes int, check_hash long, run int, id_key long, n_rows long"
_RUN_ARROW = pa.schema(
    [("digest", pa.binary()), ("n_bytes", pa.int32()), ("check_hash", pa.int64()), ("run", pa.int32()), ("id_key", pa.int64()), ("n_rows", pa.int64())]
)
# identifiers are stored as id_key: the identifier itself (smallest stays) or
# its bitwise complement (largest stays, and the order is reversed without
# overflow), so that every fold keeps the smallest id_key
_ABSENT = np.iinfo(np.int64).max


def _fold_sorted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fold equal neighbours of a stream sorted by (run, KEY)."""
    held: pa.Table | None = None
    keys = ["run", *KEY]
    for b in batches:
        t = pa.Table.from_arrays(b.columns, schema=_RUN_ARROW)
        if held is not None:
            t = pa.concat_tables([held, t])
        if t.num_rows == 0:
            continue
        t = t.combine_chunks()
        new = np.zeros(t.num_rows, bool)
        new[0] = True
        for k in keys:
            c = t.column(k).chunk(0)
            new[1:] |= pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
        at = np.flatnonzero(new)
        folded = t.take(pa.array(at))
        for name, op in (("id_key", np.minimum), ("n_rows", np.add)):
            v = op.reduceat(t.column(name).to_numpy(), at)
            folded = folded.set_column(folded.column_names.index(name), name, pa.array(v, pa.int64()))
        # the last entry may go on in the next batch
        held = folded.slice(folded.num_rows - 1)
        done = folded.slice(0, folded.num_rows - 1)
        if done.num_rows:
            yield from done.to_batches()
    if held is not None:
        yield from held.to_batches()


def _fold(runs: DataFrame) -> DataFrame:
    return runs.sortWithinPartitions("run", *KEY).mapInArrow(_fold_sorted, _RUN_SCHEMA)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, n_bytes, check_hash) of every row; null text is empty."""
    text = whole_text(text_col)
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.octet_length(text).alias("n_bytes"),
        F.xxhash64(text).alias("check_hash"),
    )


def merge_runs(rows: DataFrame, n_runs: int, keep: str = "largest", fan_in: int = FAN_IN) -> DataFrame:
    """One row (KEY, keep_id, group_size) per distinct digest, by rounds of ``fan_in`` runs."""
    if keep not in ("largest", "smallest"):
        raise ValueError("keep must be 'largest' or 'smallest'")
    flip = (lambda c: F.bitwise_not(c)) if keep == "largest" else (lambda c: c)
    runs = _fold(
        rows.select(
            *KEY,
            F.spark_partition_id().alias("run"),
            F.coalesce(flip(F.col("doc_id")), F.lit(int(_ABSENT))).alias("id_key"),
            F.lit(1).cast("long").alias("n_rows"),
        )
    )
    spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while n_runs > 1:
        n_runs = -(-n_runs // fan_in)
        merged = runs.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
        runs = _fold(merged.repartition(spread, "run", "check_hash"))
    kept = F.when(F.col("id_key") != int(_ABSENT), flip(F.col("id_key")))
    return runs.select(*KEY, kept.alias("keep_id"), F.col("n_rows").alias("group_size"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest", fan_in: int = FAN_IN) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after no change; null counts as empty.
    Of equal texts the row with the largest (``keep="smallest"``: smallest)
    identifier stays. A null identifier stays only where all identifiers of
    its group are null (keep_id is then null). Repeated rows with one
    identifier share its fate and each count in ``group_size``. An empty
    table gives no rows. Other columns of ``docs`` are not read, so their
    names do not matter.
    """
    rows = digests(docs, id_col, text_col)
    n_runs = max(1, rows.rdd.getNumPartitions())
    groups = cut_lineage(merge_runs(rows, n_runs, keep, fan_in))
    # groups are as many as distinct texts, rows of a hot digest are split by
    # the adaptive skew join
    return rows.join(groups, KEY).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Of repeated rows (one identifier, one text) exactly one stays; null texts
    are empty ones; of a group without any identifier one row stays; an empty
    table stays empty; ``docs`` may have columns of any names. The text is
    exchanged once: the join and the last deduplication share a partitioning.
    """
    digest = lambda c: F.unhex(F.sha2(c, 256))
    # null identifiers join by a value that no identifier has in common with them
    key = lambda c: [F.coalesce(c, F.lit(0).cast("long")).alias("id"), c.isNull().alias("no_id")]
    winners = exact_duplicates(docs, id_col, text_col, keep).where("kept")
    right = winners.select(F.unhex("text_sha256").alias("sha"), *key(F.col("doc_id"))).distinct()
    row = F.struct(*(F.col(c) for c in docs.columns)).alias("row")
    left = docs.select(digest(whole_text(text_col)).alias("sha"), *key(F.col(id_col).cast("long")), row)
    return left.join(right, ["id", "no_id", "sha"], "left_semi").dropDuplicates(["id", "no_id", "sha"]).select("row.*")


SQL = """
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM (
  SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
         sha256(coalesce(text, '')) AS text_sha256
  FROM documents
  WINDOW w AS (PARTITION BY coalesce(text, ''))
)
"""
