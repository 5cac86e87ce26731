"""Conflict-constrained best-fit packing of documents into token windows.

A document longer than a window is cut into full windows and a rest, whole and in order; the
pieces are packed by best fit, longest first.  Open bins are ordered by what is left in them
and carry two bitmaps, of the sources and of the duplicate clusters they hold: two pieces of
one source or one cluster never share a bin.  The search takes the tightest bin that fits and
goes on to the next larger residual until one is compatible.  So that a source or a cluster
that fills much of a shard does not make it long, the bins are also told apart by which of
the shard's commonest keys they hold, and those that conflict are stepped over together.

Pieces are dealt to shards of bounded size by a hash of document, piece and, of rows that repeat
id and text, their number; so a hot source or cluster is spread evenly, no task or driver
sees all pieces, and the bins are the same however the rows are partitioned.

Defined cases: a null source conflicts with nothing; a text without words gets one row with a
null bin; of repeated rows each is packed, as copies in different bins; an empty table gives
no rows; further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellhealth.llm.common import blocks, prepare, raw_text, write_stage

#: Tokens of a window; pieces of a shard; how many of a shard's commonest keys tell bins apart.
WINDOW, SHARD_PIECES, COMMON = 2048, 50_000, 8
#: Numbers of alike pieces that are made at once.
COPIES = 10_000


def best_fit(pieces: list[tuple], capacity: int) -> list[int]:
    """The bin of each (length, source, cluster), in the order given; lengths up to ``capacity``.

    None as a source or cluster conflicts with nothing.
    """
    times: tuple[Counter, Counter] = (Counter(p[1] for p in pieces), Counter(p[2] for p in pieces))
    # A bit for each key that can conflict, the commonest first; COMMON of them form the mark of a bin.
    bits: list[dict] = []
    for counted in times:
        keys = [k for k, n in sorted(counted.items(), key=lambda x: -x[1]) if n > 1 and k is not None]
        bits.append({k: 1 << i for i, k in enumerate(keys)})
    common = sorted(((n, side, k) for side in (0, 1) for k, n in times[side].items() if k in bits[side]),
                    key=lambda x: -x[0])[:COMMON]
    marks = {(side, k): 1 << i for i, (_, side, k) in enumerate(common)}
    residuals: list[int] = []
    sources: list[int] = []
    clusters: list[int] = []
    held: list[int] = []  #: the mark of each bin
    occupied: dict[int, int] = {}  #: mark: bitmap of the residuals that its bins have
    at: dict[tuple[int, int], list[int]] = {}  #: (mark, residual): bins
    out = []
    for length, source, cluster in pieces:
        s, c = bits[0].get(source, 0), bits[1].get(cluster, 0)
        own = marks.get((0, source), 0) | marks.get((1, cluster), 0)
        open_ = {m: o >> length << length for m, o in occupied.items() if not m & own and o >> length}
        found = -1
        while open_:
            mark, free = min(open_.items(), key=lambda x: x[1] & -x[1])  # the least residual that is left
            residual = (free & -free).bit_length() - 1
            for b in at[mark, residual]:
                if not (sources[b] & s or clusters[b] & c):
                    found = b
                    break
            if found >= 0:
                at[mark, residual].remove(found)
                if not at[mark, residual]:
                    occupied[mark] &= ~(1 << residual)
                break
            if free & (free - 1):
                open_[mark] = free & (free - 1)
            else:
                del open_[mark]
        if found < 0:
            found = len(residuals)
            residuals.append(capacity)
            sources.append(0)
            clusters.append(0)
            held.append(0)
        residuals[found] -= length
        sources[found] |= s
        clusters[found] |= c
        held[found] |= own
        if residuals[found]:
            place = (held[found], residuals[found])
            at.setdefault(place, []).append(found)
            occupied[place[0]] = occupied.get(place[0], 0) | 1 << place[1]
        out.append(found)
    return out


def _measured(batches):
    """Words of each whole text, and its duplicate cluster: texts equal but for A-Z's case."""
    for rest, raws in blocks(batches, "raw", 8 << 20):
        lowered = [r.lower() for r in raws]
        yield pa.RecordBatch.from_arrays(
            [rest["doc_id"], rest["source"], pa.array([len(r.split()) for r in lowered], pa.int64()),
             pa.array([int.from_bytes(hashlib.blake2b(r, digest_size=8).digest(), "little", signed=True)
                       for r in lowered], pa.int64())], names=["doc_id", "source", "n_tokens", "cluster"])


def pack(docs: DataFrame, capacity: int = WINDOW, text: str = "text", doc_id: str = "doc_id",
         source: str = "source") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, bin_id, bin_tokens.

    ``start`` and ``length`` count words of the whole text; pieces of a document cover it.
    """
    prepare(docs, text, doc_id, source)
    rows = (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
                        raw_text(text).alias("raw"))
            .mapInArrow(_measured, "doc_id long, source string, n_tokens long, cluster long"))
    last = F.greatest(F.ceil(F.col("n_tokens") / capacity).cast("int") - 1, F.lit(0))
    pieces = (rows.withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
              .withColumn("start", F.col("piece").cast("long") * capacity)
              .withColumn("length", F.least(F.col("n_tokens") - F.col("start"), F.lit(capacity).cast("long"))))
    pieces = write_stage(pieces.drop("n_tokens"), "pieces")
    shards = 1 + pieces.count() // SHARD_PIECES

    def packed(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(["length", "doc_id", "piece", "cluster", "source"],
                              ascending=[False, True, True, True, True], ignore_index=True)
        given = zip(own.length.tolist(), own.source.where(own.source.notna(), None).tolist(),
                    own.cluster.tolist(), strict=True)
        bins = pd.Series(best_fit(list(given), capacity), dtype="int64")
        own["bin_tokens"] = own.length.groupby(bins).transform("sum")
        own["bin_id"] = bins + (int(own.shard.iloc[0]) << 32)
        return own[["doc_id", "piece", "start", "length", "bin_id", "bin_tokens"]]

    kind = "doc_id long, piece int, start long, length long, bin_id long, bin_tokens long"
    # Pieces alike in everything are counted and numbered, so that they spread over all shards
    # however many there are, whatever the partitions.
    alike = ["doc_id", "source", "cluster", "piece", "start", "length"]
    runs = pieces.filter("length > 0").groupBy(*alike).agg(F.count("*").alias("n"))
    runs = runs.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES))))
    runs = runs.withColumn("copy", F.explode(F.sequence(
        F.col("run") * COPIES, F.least(F.col("n"), (F.col("run") + 1) * COPIES) - 1))).drop("n", "run")
    full = (runs.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "cluster", "copy"), F.lit(shards)))
            .drop("copy").groupBy("shard").applyInPandas(packed, kind))
    none = pieces.filter("length = 0").select(
        "doc_id", "piece", "start", "length", F.lit(None).cast("long").alias("bin_id"),
        F.lit(None).cast("long").alias("bin_tokens"))
    return full.unionByName(none)
