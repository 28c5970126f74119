"""Exact dedup on a sharded cuckoo-filter index of live digests.

A digest is the sha256 of a text without the characters ``[\\x20\\x09-\\x0D]``. Digests
are sharded by prefix, so that a shard holds about ``keys_per_shard`` of them whatever
the corpus; each shard is one cuckoo filter whose slots point at stored entries (whole
digest, the row that stays, group size). A lookup compares the 16-bit fingerprints of two
buckets of four slots and verifies every hit against the stored digest. An insertion that
finds no room after many kicks doubles the buckets and places all stored keys anew. A
deletion takes a row's count off and frees the slot when no row is left.

Rows are combined per task before they move, so a digest that a third of all rows share
reaches its shard as one row a task. ``apply_batch`` takes a stored index and a batch of
insertions and deletions to a new stored index; the query inserts all documents in an
empty one and joins each row with its entry.

Cases. Null text counts as empty; all texts of white space are equal. Of equal texts the
row with most code points, then smallest doc_id stays; null doc_id loses ties. Repeated
rows count each. A deletion of what is not there changes nothing. Deleting the row that
stays leaves its digest live but vacant, and hand_over() names the best of the rows that
remain. Very long texts are read whole. Empty table: no rows. Other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import settle, table

ENTRY = "shard long, digest string, n_chars long, keep_id long, group_size long"
SHARD_TYPES = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())
#: n_chars of an entry whose staying row was deleted.
VACANT = -1
BLANK = r"[\x20\x09-\x0D]+"


class CuckooIndex:
    """Cuckoo filter with four slots a bucket; each slot points at a stored entry."""

    SLOTS = 4
    KICKS = 400

    def __init__(self, buckets: int = 64):
        self.entries: list[list | None] = []  # digest, n_chars, keep_id, group_size
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.buckets = 1 << max(2, (buckets - 1).bit_length())
        self.prints = np.zeros((self.buckets, self.SLOTS), dtype=np.uint16)
        self.where = np.full((self.buckets, self.SLOTS), -1, dtype=np.int64)

    def _places(self, digest: str) -> tuple[int, int, int]:
        print_ = int(digest[16:20], 16) or 1
        first = int(digest[20:28], 16) & (self.buckets - 1)
        return print_, first, self._other(first, print_)

    def _other(self, bucket: int, print_: int) -> int:
        return (bucket ^ (print_ * 0x5BD1E995)) & (self.buckets - 1)

    def find(self, digest: str) -> tuple[int, int] | None:
        """(bucket, slot) of a live digest: fingerprint hits are verified against the stored key."""
        print_, a, b = self._places(digest)
        for bucket in (a, b):
            row = self.prints[bucket]
            for slot in range(self.SLOTS):
                if row[slot] == print_ and self.entries[self.where[bucket, slot]][0] == digest:
                    return bucket, slot
        return None

    def _place(self, digest: str, at: int) -> bool:
        print_, a, b = self._places(digest)
        for bucket in (a, b):
            for slot in range(self.SLOTS):
                if not self.prints[bucket, slot]:
                    self.prints[bucket, slot], self.where[bucket, slot] = print_, at
                    return True
        bucket = a
        for kick in range(self.KICKS):
            slot = kick % self.SLOTS
            out = int(self.prints[bucket, slot]), int(self.where[bucket, slot])
            self.prints[bucket, slot], self.where[bucket, slot] = print_, at
            print_, at = out
            bucket = self._other(bucket, print_)
            for slot in range(self.SLOTS):
                if not self.prints[bucket, slot]:
                    self.prints[bucket, slot], self.where[bucket, slot] = print_, at
                    return True
        return False

    def _grow(self) -> None:
        size = self.buckets
        done = False
        while not done:
            size *= 2
            self._clear(size)
            done = all(self._place(e[0], i) for i, e in enumerate(self.entries) if e)

    def insert(self, digest: str, n_chars: int, keep_id: int | None, rows: int) -> None:
        found = self.find(digest)
        if found:
            e = self.entries[self.where[found]]
            if _better(n_chars, keep_id, e[1], e[2]):
                e[1], e[2] = n_chars, keep_id
            e[3] += rows
            return
        self.entries.append([digest, n_chars, keep_id, rows])
        if not self._place(digest, len(self.entries) - 1):
            self._grow()

    def delete(self, digest: str, rows: int, doc_id: int | None = None) -> None:
        """Take off ``rows`` rows; if ``doc_id`` is the one that stays, its place becomes vacant."""
        found = self.find(digest)
        if not found:
            return
        at = self.where[found]
        self.entries[at][3] -= rows
        if doc_id is not None and doc_id == self.entries[at][2]:
            self.entries[at][1:3] = VACANT, None
        if self.entries[at][3] <= 0:
            self.entries[at] = None
            self.prints[found], self.where[found] = 0, -1


def _better(n: int, doc: int | None, m: int, other: int | None) -> bool:
    return (n, doc is not None, -(doc or 0)) > (m, other is not None, -(other or 0))


def digest_of(text: Column) -> Column:
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), BLANK, "").cast("binary"), 256)


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal digests of a batch become one row."""
    for batch in batches:
        best: dict[str, list] = {}
        for digest, n, doc, rows in zip(*(batch.column(i).to_pylist() for i in range(4))):
            e = best.setdefault(digest, [digest, n, doc, 0])
            e[3] += rows
            if _better(n, doc, e[1], e[2]):
                e[1], e[2] = n, doc
        columns = list(zip(*best.values())) or [()] * 4
        types = (pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["digest", "n_chars", "keep_id", "rows"])


def _update(key: tuple, stored: pa.Table, changes: pa.Table) -> pa.Table:
    """A shard's entries after ``changes``; ids stay 64-bit integers beside nulls."""
    index = CuckooIndex(max(64, (len(stored) + len(changes)) // 3))
    lists = lambda t, *names: zip(*(t[n].to_pylist() for n in names))
    for e in lists(stored, "digest", "n_chars", "keep_id", "group_size"):
        index.insert(*e)
    for digest, n, doc, rows in lists(changes, "digest", "n_chars", "keep_id", "rows"):
        if rows > 0:
            index.insert(digest, n, doc, rows)
    for digest, doc, rows in lists(changes, "digest", "keep_id", "rows"):
        if rows < 0:
            index.delete(digest, -rows, doc)
    live = [(key[0].as_py(), *e) for e in index.entries if e]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*live) if live else [()] * 5, SHARD_TYPES)], names=["shard", "digest", "n_chars", "keep_id", "group_size"])


def empty_index(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ENTRY)


def apply_batch(index: DataFrame, changes: DataFrame, shards: int) -> DataFrame:
    """The index after ``changes`` (digest, n_chars, keep_id, rows); rows < 0 deletes so many.

    The same number of shards must be used for all batches of an index. A deletion's keep_id
    is the row that goes; where it was the one that stays, hand_over() must follow.
    """
    shard = F.pmod(F.conv(F.substring("digest", 1, 12), 16, 10).cast("long"), F.lit(shards)).alias("shard")
    less = changes.select("digest", "n_chars", "keep_id", F.col("rows").cast("long").alias("rows"))
    less = less.where("rows > 0").mapInArrow(_combine, "digest string, n_chars long, keep_id long, rows long").unionByName(less.where("rows < 0"))
    less = less.select(shard, "*")
    return index.groupBy("shard").cogroup(less.groupBy("shard")).applyInArrow(_update, ENTRY)


def hand_over(index: DataFrame, docs: DataFrame) -> DataFrame:
    """``index`` with the best of the remaining rows ``docs`` wherever the row that stayed was deleted.

    Only digests of vacant entries meet rows, combined before they move.
    """
    vacant = index.where(F.col("n_chars") == VACANT).select("digest")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), digest_of(F.col("text")).alias("digest"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n"))
    order = F.struct("n", F.col("id").isNotNull(), -F.col("id"))
    best = rows.join(vacant, "digest", "left_semi").groupBy("digest").agg(F.max_by(F.struct("n", "id"), order).alias("best"))
    filled = (F.col("n_chars") == VACANT) & F.col("best").isNotNull()
    return index.join(best, "digest", "left").select(
        "shard", "digest", F.when(filled, F.col("best.n")).otherwise(F.col("n_chars")).alias("n_chars"), F.when(filled, F.col("best.id")).otherwise(F.col("keep_id")).alias("keep_id"), "group_size"
    )


def exact_classes(docs: DataFrame, keys_per_shard: int = 5000) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of ``docs``."""
    rows = settle(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest_of(F.col("text")).alias("digest"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars")),
        "digests",
    )
    shards = max(1, -(-rows.count() // keys_per_shard))
    changes = rows.select("digest", "n_chars", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("rows"))
    # Only insertions here; apply_batch() also takes deletions.
    index = settle(apply_batch(empty_index(docs.sparkSession), changes, shards), "cuckoo-index")
    entries = index.select("digest", "keep_id", "group_size")
    return rows.join(entries, "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256")
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts in the whole of ``documents``."""
    return exact_classes(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(length(text), 0) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS h FROM documents),
g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY h) AS c FROM d)
SELECT doc_id, keep_id, c::BIGINT AS group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM g
"""
