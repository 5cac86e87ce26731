"""Approximate nearest neighbours by cosine over balanced posting lists.

Equal vectors are one point (it keeps the smallest ids, all that a top-k can show), so no
list is swollen by copies.  Centroids come from a bounded, hash-drawn sample that is cut in
two again and again, the largest part first, which keeps lists balanced.  Their number grows
with the points up to ``MAX_LISTS``; beyond it lists grow and are cut into cells of bounded
size.  Every point goes to its nearest centroid and, near a boundary, to further ones that
are not behind a nearer chosen centroid.  Centroids are searched by best-first search on an
in-memory neighbour graph.  A query visits the lists whose centroid is within a ratio of the
distance to its nearest one.  How many lists the search offers and how wide that ratio is are
measured on every run: a bounded set of probe vectors is compared with all points, and both
are set so that ``RECALL`` of the true neighbours lie in visited lists.  Within a cell all its points are compared with all its queries
by one matrix product per block, in double precision, and the cell's best go on.  A query
whose lists hold fewer points than it has answers to give (outliers, small clusters) is held
against all points afterwards, in blocks of bounded size, so that every query gets k answers.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no
part, nor do vectors of another length than the commonest; ids that are null take no part; of
equal scores the smaller id is first; rows that repeat an id and vector are one candidate; a
query with fewer than k candidates returns them all; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellhealth.llm.common import drop_stage, join_groups, prepare, reread, write_stage

#: Points a list should hold; bound of the number of lists (they are in memory everywhere);
#: sample vectors per list; points and queries of a cell.
LIST_POINTS, MAX_LISTS, SAMPLE_PER_LIST = 256, 4096, 16
CELL_POINTS, CELL_QUERIES = 8192, 8192
#: Replicas of a boundary vector and how much further than the nearest their centroid may be.
REPLICAS, BOUNDARY = 4, 1.15
#: Probe vectors compared with all points, the share of their neighbours to be found, and how
#: much wider than measured the search then is; the least number of lists offered to a query.
PROBES, RECALL, MARGIN, LEAST_BEAM = 64, 0.97, 1.25, 16
NEIGHBOURS = 24
#: Queries with too few answers that are held against all points in one pass.
BLOCK_QUERIES = 1024


def _units(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; the largest component first, so that none under- or overflows."""
    x = np.asarray(x, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def balanced_centroids(sample: np.ndarray, lists: int) -> np.ndarray:
    """``lists`` unit centroids; the part with most vectors is cut in two until there are enough."""
    parts = [np.arange(len(sample))]
    while len(parts) < lists:
        at = max(range(len(parts)), key=lambda i: len(parts[i]))
        rows = parts[at]
        x = sample[rows]
        if len(rows) < 2 or not np.ptp(x, axis=0).any():
            break
        line = x[np.argmax(((x - x[0]) ** 2).sum(1))] - x[0]
        for _ in range(6):  # two means, cut at the median of their line: equal halves
            along = x @ line
            order = np.argsort(along, kind="stable")
            half = len(rows) // 2
            line = x[order[half:]].mean(0) - x[order[:half]].mean(0)
        parts[at:at + 1] = [rows[order[:half]], rows[order[half:]]]
    means = np.array([sample[p].mean(0) for p in parts])
    return means / np.maximum(np.sqrt((means * means).sum(1, keepdims=True)), 1e-12)


class CentroidGraph:
    """Each centroid with its nearest ones and, to reach every part, a few evenly spaced ones."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        n = len(centroids)
        near = min(NEIGHBOURS, n - 1)
        links = []
        for i in range(0, n, 512):
            far = 2 - 2 * centroids[i:i + 512] @ centroids.T
            far[np.arange(len(far)), np.arange(i, i + len(far))] = np.inf
            links.append(np.argpartition(far, near - 1, axis=1)[:, :near] if near else np.zeros((len(far), 0), int))
        jumps = (np.arange(n)[:, None] + np.array([n // 3, n // 2, 2 * n // 3])) % max(n, 1)
        self.links = np.concatenate([np.concatenate(links), jumps], axis=1).astype(np.int64)
        self.starts = np.unique(np.linspace(0, n - 1, min(n, 16)).astype(int))
        self.beam, self.reach = min(n, LEAST_BEAM), 2.0

    def search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """For unit rows ``x``: list numbers and squared distances, nearest first (-1: none)."""
        n, rows = len(self.centroids), np.arange(len(x))[:, None]
        beam = min(beam, n)
        seen = np.zeros((len(x), n), bool)
        ids = np.full((len(x), beam), -1)
        far, open_ = np.full((len(x), beam), np.inf), np.zeros((len(x), beam), bool)

        def offer(new: np.ndarray) -> None:
            nonlocal ids, far, open_
            order = np.sort(new, axis=1)
            fresh = ~seen[rows, order]
            fresh[:, 1:] &= order[:, 1:] != order[:, :-1]
            seen[rows, order] = True
            d = np.where(fresh, 2 - 2 * np.einsum("ijk,ik->ij", self.centroids[order], x), np.inf)
            ids, far = np.concatenate([ids, order], 1), np.concatenate([far, d], 1)
            open_ = np.concatenate([open_, fresh], 1)
            best = np.argsort(far, axis=1, kind="stable")[:, :beam]
            ids, far, open_ = ids[rows, best], far[rows, best], open_[rows, best]

        offer(np.broadcast_to(self.starts, (len(x), len(self.starts))))
        while open_.any():
            pick = np.argmin(np.where(open_, far, np.inf), axis=1)[:, None]
            live = open_[rows, pick]
            open_[rows, pick] = False
            # a row that is done offers its own best again, which is seen already
            offer(np.where(live, self.links[np.maximum(ids[rows, pick], 0)[:, 0]],
                           np.maximum(ids[rows, pick], 0)))
        return np.where(np.isfinite(far), ids, -1), np.maximum(far, 0)

    def postings(self, x: np.ndarray) -> list[list[int]]:
        """The lists of each point: the nearest, and boundary ones not behind a chosen one."""
        ids, far = self.search(x, 2 * REPLICAS)
        out = []
        for own, d in zip(ids, np.sqrt(far), strict=True):
            chosen = [int(own[0])]
            for c, dist in zip(own[1:], d[1:], strict=True):
                if len(chosen) == REPLICAS or c < 0 or dist > BOUNDARY * d[0]:
                    break
                gap = np.sqrt(np.maximum(2 - 2 * self.centroids[chosen] @ self.centroids[c], 0))
                if (gap >= dist).all():
                    chosen.append(int(c))
            out.append(chosen)
        return out

    def tuned(self, probes: np.ndarray, found: list[tuple[int, int, int]]) -> None:
        """Set beam and reach from (probe, neighbour, list) of the probes' true neighbours."""
        far = np.sqrt(np.maximum(2 - 2 * probes @ self.centroids.T, 0))
        order = far.argsort(axis=1, kind="stable")
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(order.shape[1])[None], axis=1)
        least: dict[tuple[int, int], int] = {}
        for probe, point, c in found:  # the first of a neighbour's lists that a search meets
            key = (probe, point)
            if key not in least or rank[probe, c] < rank[probe, least[key]]:
                least[key] = c
        if least:
            ranks = np.array([rank[p, c] for (p, _), c in least.items()])
            ratio = np.array([far[p, c] / max(far[p].min(), 1e-9) for (p, _), c in least.items()])
            share = (1 + RECALL) / 2  # both prune: each may lose half of what may be lost
            self.beam = min(len(self.centroids), max(LEAST_BEAM, int(np.ceil(
                MARGIN * (np.quantile(ranks, share, method="higher") + 1)))))
            self.reach = 1 + MARGIN * float(np.quantile(ratio, share, method="higher") - 1) + 1e-6

    def visits(self, x: np.ndarray) -> list[list[int]]:
        """The lists a query visits: within the ratio of its nearest centroid's distance."""
        ids, far = self.search(x, self.beam)
        near = np.sqrt(far)
        keep = (ids >= 0) & (near <= self.reach * np.maximum(near[:, :1], 1e-9))
        return [row[k].tolist() for row, k in zip(ids, keep, strict=True)]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, embedding as doubles) of the rows that take part."""
    e = F.col("embedding")
    fine = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = (vectors.select(F.col(vec_id).cast("long").alias("vec_id"),
                           F.col(embedding).cast("array<double>").alias("embedding"))
            .filter(F.col("vec_id").isNotNull() & e.isNotNull() & fine & F.exists(e, lambda v: v != 0)))
    return rows


def _points(rows: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector: key, embedding, ids (the k+1 smallest), n (its rows).

    Copies are folded per batch, then by salt, then by key: no group holds all copies.
    """
    def fold(batches):
        for batch in batches:
            seen: dict = {}
            ids, column = batch.column(0).to_pylist(), batch.column(1)
            for i, (vec_id, v) in enumerate(zip(ids, column.to_pylist(), strict=True)):
                key = hashlib.blake2b((np.array(v) + 0.0).tobytes(), digest_size=16).digest()
                own = seen.setdefault(key, [i, set(), 0])
                own[1].add(vec_id)
                own[2] += 1
            if seen:
                firsts, sets, counts = zip(*seen.values(), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(seen), pa.binary()), column.take(pa.array(firsts)),
                     pa.array([sorted(s)[:k + 1] for s in sets], pa.list_(pa.int64())), pa.array(counts, pa.int64())],
                    names=["key", "embedding", "ids", "n"])

    folded = rows.mapInArrow(fold, "key binary, embedding array<double>, ids array<long>, n long")
    for salt in (F.pmod(F.spark_partition_id(), F.lit(64)), F.lit(0)):
        folded = (folded.withColumn("salt", salt).groupBy("key", "salt")
                  .agg(F.first("embedding").alias("embedding"),
                       F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids"),
                       F.sum("n").alias("n")).drop("salt"))
    return folded


def _against_all(queries: DataFrame, width: int, k: int):
    """For a block of ``queries`` (query, embedding): the best points of a task, ties by smallest id."""
    got = queries.toArrow().sort_by("query")
    ids = got.column("query").to_numpy()
    asking = _units(_matrix(got.column("embedding").combine_chunks(), width)) if len(ids) else np.zeros((0, width))
    top = 2 * (k + 1)

    def run(batches):
        score, point = np.zeros((len(ids), 0)), np.zeros((len(ids), 0), np.int64)
        least = np.zeros((len(ids), 0), np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                part = batch.slice(i, 4096)
                own = np.round(asking @ _units(_matrix(part.column(2), width)).T, 12)
                first = np.array([x[0] for x in part.column(1).to_pylist()], np.int64)
                wide = lambda v: np.broadcast_to(v, own.shape)
                score = np.concatenate([score, own], axis=1)
                point = np.concatenate([point, wide(part.column(0).to_numpy())], axis=1)
                least = np.concatenate([least, wide(first)], axis=1)
                keep = np.lexsort((least, -score), axis=1)[:, :top]
                score, point, least = (np.take_along_axis(v, keep, 1) for v in (score, point, least))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(ids, score.shape[1])), pa.array(point.ravel()), pa.array(score.ravel())],
            names=["query", "point", "score"])

    return run


def nearest(vectors: DataFrame, k: int = 5, every: int = 50, vec_id: str = "vec_id",
            embedding: str = "embedding") -> DataFrame:
    """For each row whose id is divisible by ``every``: its k nearest others.

    query_id, rank (from 1), vec_id, score (cosine); ties to the smaller vec_id.
    """
    prepare(vectors, vec_id, embedding)
    spark = vectors.sparkSession
    rows = _usable(vectors, vec_id, embedding)
    common = rows.groupBy(F.size("embedding").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).first()
    width = common.w if common else 1
    rows = rows.filter(F.size("embedding") == width)
    points = write_stage(_points(rows, k).withColumn("point", F.monotonically_increasing_id()), "points")
    n = points.count()
    lists = max(1, min(MAX_LISTS, -(-n // LIST_POINTS)))
    share = min(1.0, SAMPLE_PER_LIST * lists / max(n, 1))
    sample = (points.filter(F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < int(np.ceil(share * 1_000_000)))
              .select("key", "embedding").toArrow().sort_by("key"))
    if not sample.num_rows:  # so small a table that the draw missed it: all of it is still below the bound
        sample = points.limit(SAMPLE_PER_LIST).select("key", "embedding").toArrow().sort_by("key")
    if not sample.num_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    drawn = _units(_matrix(sample.column("embedding").combine_chunks(), width))
    centroids = CentroidGraph(balanced_centroids(drawn, lists))
    graph = spark.sparkContext.broadcast(centroids)
    probes = drawn[:PROBES]  # in order of their digests: a draw by hash

    def assigned(kind, graph):
        def run(batches):
            for batch in batches:
                for i in range(0, batch.num_rows, 1024):
                    part = batch.slice(i, 1024)
                    of = getattr(graph.value, kind)(_units(_matrix(part.column(1), width)))
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(of, pa.list_(pa.int32()))],
                                                     names=["point", "lists"])
        return run

    # Distinct query vectors: a point is asked once however many queries carry its vector.
    queries = rows.filter(F.col("vec_id") % every == 0).select("vec_id", "embedding").distinct()

    def keys(batches):
        for batch in batches:
            got = [hashlib.blake2b((np.array(v) + 0.0).tobytes(), digest_size=16).digest()
                   for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.binary())], names=["query_id", "key"])

    queries = write_stage(queries.mapInArrow(keys, "query_id long, key binary"), "queries")
    asked = queries.groupBy("key").agg(F.count("*").alias("asked"))
    kind = "point long, lists array<int>"
    posted = write_stage(points.select("point", "embedding").mapInArrow(assigned("postings", graph), kind)
                         .select("point", F.explode("lists").alias("list")), "postings")

    def probed(batches):
        """The best of a task for each probe, which itself is its own nearest."""
        best, ids = np.zeros((len(probes), 0)), np.zeros((len(probes), 0), np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                part = batch.slice(i, 4096)
                score = probes @ _units(_matrix(part.column(1), width)).T
                best = np.concatenate([best, score], axis=1)
                ids = np.concatenate([ids, np.broadcast_to(part.column(0).to_numpy(), score.shape)], axis=1)
                top = np.argsort(-best, axis=1, kind="stable")[:, :k + 1]
                best, ids = np.take_along_axis(best, top, 1), np.take_along_axis(ids, top, 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(probes)), best.shape[1])), pa.array(ids.ravel()), pa.array(best.ravel())],
            names=["probe", "point", "score"])

    true = (points.select("point", "embedding").mapInArrow(probed, "probe long, point long, score double")
            .withColumn("at", F.row_number().over(Window.partitionBy("probe").orderBy(F.desc("score"), "point")))
            .filter(F.col("at").between(2, k + 1)))
    centroids.tuned(probes, [tuple(r) for r in true.join(reread(posted), "point")
                             .select("probe", "point", "list").collect()])
    tuned = spark.sparkContext.broadcast(centroids)
    visited = write_stage(points.join(asked, "key", "left_semi").select("point", "embedding")
                          .mapInArrow(assigned("visits", tuned), kind)
                          .select(F.col("point").alias("query"), F.explode("lists").alias("list")), "visits")
    # Cells of bounded size: a list's points cut in n_p parts, its queries in n_q (at most MAX_LISTS rows each).
    cut = (posted.groupBy("list").agg(F.ceil(F.count("*") / CELL_POINTS).cast("int").alias("n_p"))
           .join(visited.groupBy("list").agg(F.ceil(F.count("*") / CELL_QUERIES).cast("int").alias("n_q")), "list"))
    cut = F.broadcast(cut)
    slim = points.select("point", "embedding")
    first = points.select("point", "ids", F.element_at("ids", 1).alias("least"))
    left = (posted.join(cut, "list").withColumn("p", F.pmod(F.xxhash64("point"), F.col("n_p")).cast("int"))
            .withColumn("q", F.explode(F.sequence(F.lit(0), F.col("n_q") - 1))).drop("n_p", "n_q").join(slim, "point").join(first.drop("ids"), "point"))
    right = (visited.join(cut, "list").withColumn("q", F.pmod(F.xxhash64("query"), F.col("n_q")).cast("int"))
             .withColumn("p", F.explode(F.sequence(F.lit(0), F.col("n_p") - 1))).drop("n_p", "n_q")
             .join(reread(points).select(F.col("point").alias("query"), "embedding"), "query"))

    def compare(_, own: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if own.empty or asking.empty:
            return pd.DataFrame({"query": [], "point": [], "score": []}).astype(
                {"query": "int64", "point": "int64", "score": "float64"})
        own = own.sort_values("least", ignore_index=True)
        x, ids, out = _units(np.stack(own.embedding)), own.point.to_numpy(), []
        top = min(2 * (k + 1), len(ids))
        for i in range(0, len(asking), 512):
            block = asking.iloc[i:i + 512]
            score = _units(np.stack(block.embedding)) @ x.T
            # all that reach the top, ties included; then by rounded score and smallest id, as the final order is
            least = np.partition(score, score.shape[1] - top, axis=1)[:, score.shape[1] - top] - 1e-12
            r, c = np.nonzero(score >= least[:, None])
            order = np.lexsort((c, -np.round(score[r, c], 12), r))
            r, c = r[order], c[order]
            keep = np.arange(len(r)) - np.searchsorted(r, r) < top
            r, c = r[keep], c[keep]
            out.append(pd.DataFrame({"query": block["query"].to_numpy()[r], "point": ids[c], "score": score[r, c]}))
        return pd.concat(out)

    found = (left.groupBy("list", "p", "q").cogroup(right.groupBy("list", "p", "q"))
             .applyInPandas(compare, "query long, point long, score double"))
    def exact(batches):
        for batch in batches:
            x, y = _matrix(batch.column(2), width), _matrix(batch.column(3), width)
            u, v = np.abs(x).max(1, keepdims=True), np.abs(y).max(1, keepdims=True)
            x, y = x / u, y / v  # scaled for the sums of squares only; the cosine is that of the originals
            score = (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.clip(score, -1, 1))],
                                             names=["query", "point", "score"])

    def ranked(found: DataFrame) -> DataFrame:
        """(query, best): of what was found for each query the nearest, by exact cosine."""
        found = (found.groupBy("query", "point").agg(F.max(F.round("score", 14)).alias("score"))
                 .join(first.select("point", "least"), "point")
                 .withColumn("at", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "least")))
                 .filter(F.col("at") <= 2 * (k + 1)))
        found = (found.select("query", "point")
                 .join(slim.select(F.col("point").alias("query"), F.col("embedding").alias("x")), "query")
                 .join(reread(points).select("point", F.col("embedding").alias("y")), "point").select("query", "point", "x", "y")
                 .mapInArrow(exact, "query long, point long, score double"))
        # k + 1 distinct points by their smallest ids hold any k answers, the query itself left out.
        return (found.join(first, "point").groupBy("query")
                .agg(F.sort_array(F.flatten(F.collect_list(F.transform(
                    "ids", lambda i: F.struct((-F.col("score")).alias("minus"), i.alias("vec_id")))))).alias("best")))

    best = write_stage(ranked(found), "ranked")
    # Lists that hold too few points: those queries are held against all points, block by block.
    enough = min(k + 1, points.agg(F.sum(F.size("ids"))).first()[0])
    asking = reread(points).join(asked, "key", "left_semi").select(F.col("point").alias("query"), "embedding")
    short = write_stage(asking.join(best.filter(F.size("best") >= enough).select("query"), "query", "left_anti"), "short")
    blocks = -(-short.count() // BLOCK_QUERIES)
    whole = best.filter(F.size("best") >= enough)
    for i in range(blocks):
        mine = short.filter(F.pmod(F.xxhash64("query"), F.lit(blocks)) == i)
        whole = whole.union(write_stage(ranked(points.select("point", "ids", "embedding").mapInArrow(
            _against_all(mine, width, k), "query long, point long, score double")), "ranked"))
    best = write_stage(whole.join(reread(points).select(F.col("point").alias("query"), "key"), "query")
                       .join(asked, "key").select("key", "best", "asked"), "best")
    out = (join_groups(queries, best, "key", "asked", "query_id")
           .select("query_id", F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k).alias("b"))
           .select("query_id", F.posexplode("b").alias("rank", "b")))
    drop_stage(posted, visited, points, short)
    return out.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"),
                      (-F.col("b.minus")).alias("score"))
