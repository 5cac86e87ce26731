"""Exact dedup with a sharded cuckoo-filter index of live digests.

Every text is normalised (A-Z to lower case, null is empty) and digested with SHA-256.
A map task first folds the copies it sees into one record per digest, so a text that a
third of all rows share reaches the index as one record per map task: its table of at most
``FOLD_DIGESTS`` digests sheds those seen once and keeps the repeated ones.  The records are
dealt to shards by digest; a shard holds one :class:`CuckooIndex`.  An arriving digest
whose 16-bit fingerprint hits is verified against the content stored in that bucket
(full digest and byte length).  A verified copy with a larger doc_id deletes the live
entry and inserts its own; an overflowing insertion doubles the filter and refills it
from the stored keys.

Defined cases: null text is empty; empty texts equal each other; a null doc_id counts as
the smallest; of rows that repeat one doc_id and text exactly one is kept; an empty table
gives no rows; further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellhealth.llm.common import (blocks, join_groups, numbered_columns, prepare, raw_text, reread,
                                   write_stage)

#: Records of one index shard; the number of shards follows the number of rows.
SHARD_ROWS = 200_000
#: Digests that a map task holds while it folds copies.
FOLD_DIGESTS = 100_000
NO_ID = -(1 << 63)


class CuckooIndex:
    """Cuckoo filter of 4-slot buckets; beside each fingerprint lies the entry it stands for.

    An entry is a list whose first two items, digest and byte length, are its content.
    """

    SLOTS, KICKS = 4, 200

    def __init__(self, buckets: int = 64):
        self.live = self.resizes = 0
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.marks = array("H", bytes(2 * self.SLOTS * buckets))
        self.content: list = [None] * (self.SLOTS * buckets)

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[:2], "little") or 1
        one = int.from_bytes(digest[2:10], "little") & self.mask
        return mark, one, self._other(one, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995 + 1)) & self.mask

    def _slot(self, digest: bytes, n_bytes: int) -> int:
        """The slot of a live entry, verified by its content; -1 if there is none."""
        mark, one, two = self._places(digest)
        for bucket in (one, two):
            for slot in range(bucket * self.SLOTS, (bucket + 1) * self.SLOTS):
                if self.marks[slot] == mark and self.content[slot][0] == digest and self.content[slot][1] == n_bytes:
                    return slot
        return -1

    def find(self, digest: bytes, n_bytes: int) -> list | None:
        slot = self._slot(digest, n_bytes)
        return None if slot < 0 else self.content[slot]

    def delete(self, digest: bytes, n_bytes: int) -> bool:
        slot = self._slot(digest, n_bytes)
        if slot < 0:
            return False
        self.marks[slot], self.content[slot] = 0, None
        self.live -= 1
        return True

    def insert(self, entry: list) -> None:
        left = self._put(entry)
        if left is not None:
            self._grow([x for x in self.content if x is not None] + [left])
        self.live += 1

    def _grow(self, stored: list) -> None:
        """Refill from the stored keys with twice the buckets, or more if need be."""
        buckets = self.mask + 1
        while True:
            buckets *= 2
            self.resizes += 1
            self._clear(buckets)
            if all(self._put(x) is None for x in stored):
                return

    def _put(self, entry: list) -> list | None:
        """None, or the entry that found no place."""
        mark, bucket, two = self._places(entry[0])
        for b in (bucket, two):
            for slot in range(b * self.SLOTS, (b + 1) * self.SLOTS):
                if not self.marks[slot]:
                    self.marks[slot], self.content[slot] = mark, entry
                    return None
        for kick in range(self.KICKS):
            slot = bucket * self.SLOTS + kick % self.SLOTS
            self.marks[slot], mark = mark, self.marks[slot]
            self.content[slot], entry = entry, self.content[slot]
            bucket = self._other(bucket, mark)
            for free in range(bucket * self.SLOTS, (bucket + 1) * self.SLOTS):
                if not self.marks[free]:
                    self.marks[free], self.content[free] = mark, entry
                    return None
        return entry

    def entries(self) -> Iterator[list]:
        return (x for x in self.content if x is not None)


def normalised_digest(raw: bytes) -> bytes:
    return hashlib.sha256(raw.lower()).digest()  # bytes.lower changes A-Z only


def _digests(batches):
    for rest, raws in blocks(batches, "raw", 8 << 20):
        yield pa.RecordBatch.from_arrays(
            [rest["row"], rest["doc_id"], pa.array([normalised_digest(r) for r in raws], pa.binary()),
             pa.array([len(r) for r in raws], pa.int64())], names=["row", "doc_id", "digest", "n_bytes"])


def _columns(batch: pa.RecordBatch):
    return zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True)


def _batch(rows, chunk: int = 50_000):
    rows = list(rows)
    for i in range(0, len(rows), chunk):
        cols = list(zip(*rows[i:i + chunk], strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.binary()), *[pa.array(c, pa.int64()) for c in cols[1:]]],
            names=["digest", "n_bytes", "best", "best_row", "group_size"])


def _fold(batches, bound: int | None = None):
    """The task's copies in one record: largest doc_id, its row, number of copies.

    A full table sheds the digests seen once; when over half of it is repeated, all go.
    """
    bound = bound or FOLD_DIGESTS
    seen: dict = {}
    for batch in batches:
        for row, doc_id, digest, n_bytes in _columns(batch):
            doc_id = NO_ID if doc_id is None else doc_id
            own = seen.get((digest, n_bytes))
            if own is None:
                seen[digest, n_bytes] = [digest, n_bytes, doc_id, row, 1]
            else:
                own[4] += 1
                if (doc_id, row) > (own[2], own[3]):
                    own[2], own[3] = doc_id, row
        if len(seen) >= bound:
            kept = {k: v for k, v in seen.items() if v[4] > 1}
            if 2 * len(kept) > bound:
                kept = {}
            yield from _batch(v for k, v in seen.items() if k not in kept)
            seen = kept
    yield from _batch(seen.values())


def _index(batches):
    """One shard: live digests, the newest (largest) doc_id of equal texts stays."""
    index = CuckooIndex()
    for batch in batches:
        for digest, n_bytes, best, row, size in _columns(batch):
            live = index.find(digest, n_bytes)
            if live is None:
                index.insert([digest, n_bytes, best, row, size])
            elif (best, row) > (live[2], live[3]):
                index.delete(digest, n_bytes)
                index.insert([digest, n_bytes, best, row, live[4] + size])
            else:
                live[4] += size
    yield from _batch(index.entries())


def _judged(rows: DataFrame) -> DataFrame:
    """The outcome for each of ``rows`` (row, doc_id, raw), whose row numbers must be written ones."""
    rows = write_stage(rows.mapInArrow(_digests, "row long, doc_id long, digest binary, n_bytes long"), "digests")
    shards = 1 + rows.count() // SHARD_ROWS
    kind = "digest binary, n_bytes long, best long, best_row long, group_size long"
    groups = write_stage(rows.mapInArrow(_fold, kind).repartition(shards, "digest")
                         .mapInArrow(_index, kind).drop("n_bytes"), "live")
    out = join_groups(rows.drop("n_bytes"), groups, "digest", "group_size", "row")
    return out.select(
        "row", "doc_id", F.when(F.col("best") != NO_ID, F.col("best")).alias("keep_id"), "group_size",
        (F.col("row") == F.col("best_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    prepare(docs, text, doc_id)
    # The row numbers are written with the digests, in the same pass, before anything reads them.
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"),
                       raw_text(text).alias("raw"))
    return _judged(rows).drop("row")


def drop_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that :func:`exact_groups` keeps, with their own columns only."""
    prepare(docs, text, doc_id)
    own = numbered_columns(docs)
    id_, text_ = (f"c{docs.columns.index(c)}" for c in (doc_id, text))
    whole = write_stage(own.select(F.monotonically_increasing_id().alias("row"), "*"), "documents")
    judged = _judged(whole.select("row", F.col(id_).cast("long").alias("doc_id"), raw_text(text_).alias("raw")))
    kept = judged.filter("kept").select("row").hint("shuffle_hash")
    return reread(whole).join(kept, "row", "left_semi").drop("row").toDF(*docs.columns)
