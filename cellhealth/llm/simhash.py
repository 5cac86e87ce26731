"""SimHash near-dedup by meet-in-the-middle ball hashing.

Fingerprints that differ in at most ``2 r`` bits share a value within ``r`` bits of both.
So every distinct fingerprint emits all variants within half the radius (itself and its 64
one-bit neighbours for a radius of 2); the variants are shuffled, and fingerprints that
meet on one are verified by their bit distance.  Copies fall into one fingerprint first, so
no variant gets more than 65 of them however many documents share a text.  Within a variant
every fingerprint is linked to the smallest only: for an even radius all that meet there lie
within the radius of each other, so these links join the same components as all pairs.

Defined cases: null and empty texts have fingerprint 0 and link like any other; a text of
fewer words than a shingle is one shingle; a null doc_id is the smallest id, so its
component has a null id; repeated rows share a component; an empty table gives no rows;
further columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellhealth.llm.common import (blocks, components, drop_stage, join_groups, numbered_columns, prepare,
                                   raw_text, reread, write_stage)

SEED = 42
#: Shingle hashes whose bits are counted at once; bounds the memory of a very long text.
CHUNK = 1 << 18


def shingle_hashes(raw: bytes, width: int) -> list[int]:
    """XXH64 of each word shingle; words are runs without ASCII white space, A-Z lowered."""
    words = raw.lower().split()
    if not words:
        return []
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return [digest(joined[a:b], SEED) for a, b in zip(starts[:len(words) - width + 1].tolist(),
                                                      ends[width - 1:].tolist(), strict=True)]


def fingerprints(raws: list[bytes], width: int) -> np.ndarray:
    """One 64-bit fingerprint per text: a bit is set if over half of the hashes set it."""
    out, counts = np.zeros(len(raws), np.uint64), np.zeros((len(raws), 64), np.int64)
    totals = np.zeros(len(raws), np.int64)
    waiting: list[int] = []
    owners: list[tuple[int, int]] = []

    def add() -> None:
        if waiting:
            bits = np.unpackbits(np.array(waiting, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            at = np.cumsum([0] + [n for _, n in owners[:-1]])
            own = np.array([i for i, _ in owners])
            np.add.at(counts, own, np.add.reduceat(bits, at, axis=0, dtype=np.int32))
        waiting.clear()
        owners.clear()

    for i, raw in enumerate(raws):
        hashes = shingle_hashes(raw, width)
        totals[i] = len(hashes)
        for k in range(0, len(hashes), CHUNK):
            part = hashes[k:k + CHUNK]
            waiting += part
            owners.append((i, len(part)))
            if len(waiting) >= CHUNK:
                add()
    add()
    set_bits = (2 * counts > totals[:, None]).astype(np.uint8)
    out[:] = np.packbits(set_bits, axis=1, bitorder="little").view("<u8").ravel()
    return out


def simhash(docs: DataFrame, width: int = 3, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit integer, one row per row of ``docs``."""
    prepare(docs, text, doc_id)
    return _printed(docs.select(F.col(doc_id).cast("long").alias("doc_id"), raw_text(text).alias("raw")), width)


def _printed(rows: DataFrame, width: int) -> DataFrame:
    """``rows`` (whole numbers and ``raw``) with fp in the place of raw."""
    names = [c for c in rows.columns if c != "raw"]

    def prints(batches):
        for rest, raws in blocks(batches, "raw", 4 << 20):
            yield pa.RecordBatch.from_arrays(
                [*[rest[c] for c in names], pa.array(fingerprints(raws, width).view(np.int64))], names=[*names, "fp"])

    return rows.mapInArrow(prints, ", ".join(f"{c} long" for c in [*names, "fp"]))


def ball(radius: int) -> list[int]:
    """All 64-bit masks of at most ``radius`` bits, as signed integers."""
    masks, last = {0}, {0}
    for _ in range(radius):
        last = {m | 1 << b for m in last for b in range(64)} - masks
        masks |= last
    return sorted(m - (1 << 64) if m >> 63 else m for m in masks)


def near_links(prints: DataFrame, distance: int = 2) -> DataFrame:
    """Verified links (a, b) between distinct fingerprints ``fp`` at most ``distance`` bits apart.

    Not all pairs: enough to join what is connected by such pairs.
    """
    if distance % 2:
        raise ValueError("the bit distance must be even: both halves of the radius are equal")
    masks = F.array(*[F.lit(m) for m in ball(distance // 2)])
    variants = prints.select("fp", F.explode(masks).alias("mask")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))
    # One aggregate over the shuffle: those that meet, as the smallest and the rest of at most a ball's size.
    met = variants.groupBy("variant").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
    pairs = met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a <> b").distinct()
    return pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)


def simhash_groups(docs: DataFrame, width: int = 3, distance: int = 2, text: str = "text",
                   doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id that links of at most ``distance`` bits reach.
    """
    rows = write_stage(simhash(docs, width, text, doc_id), "fingerprints")
    prints = write_stage(rows.groupBy("fp").agg(
        F.min(F.struct(F.col("doc_id"))).getField("doc_id").alias("first"), F.count("*").alias("n")), "distinct")
    links = near_links(prints.select("fp"), distance)
    linked = components(links, "a", "b")
    own = prints.join(linked, prints.fp == linked.node, "left").select(
        "fp", "first", "n", F.coalesce("component", "fp").alias("component"))
    own = write_stage(own, "prints")
    least = own.groupBy("component").agg(F.min(F.struct(F.col("first"))).getField("first").alias("component_id"),
                                         F.count("*").alias("of"))
    least = write_stage(least, "components")
    named = join_groups(own.select("fp", "component", "n"), least, "component", "of", "fp")
    named = write_stage(named.select("fp", "n", "component_id"), "named")
    drop_stage(prints, own, least, linked)
    out = join_groups(rows.withColumn("row", F.monotonically_increasing_id()), named, "fp", "n", "row")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, width: int = 3, distance: int = 2, text: str = "text",
                     doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with exactly one row of each component: of the smallest doc_id, a null one first.

    Of rows that share this id the one that comes first in a written table stays.
    """
    prepare(docs, text, doc_id)
    own = numbered_columns(docs)
    id_, text_ = (f"c{docs.columns.index(c)}" for c in (doc_id, text))
    whole = write_stage(own.select(F.monotonically_increasing_id().alias("row"), "*"), "documents")
    rows = _printed(whole.select("row", F.col(id_).cast("long").alias("doc_id"), raw_text(text_).alias("raw")), width)
    prints = write_stage(rows.groupBy("fp").agg(F.min(F.struct("doc_id", "row")).alias("first")), "distinct")
    linked = components(near_links(prints.select("fp"), distance), "a", "b")
    kept = (prints.join(linked, prints.fp == linked.node, "left")
            .groupBy(F.coalesce("component", "fp").alias("component"))
            .agg(F.min("first").getField("row").alias("row")))
    kept = write_stage(kept.select("row"), "kept")
    drop_stage(prints, linked)
    return reread(whole).join(kept.hint("shuffle_hash"), "row", "left_semi").drop("row").toDF(*docs.columns)
