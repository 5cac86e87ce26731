"""Quality classifier: a generalised additive model with pairwise interactions.

Features come from the whole text only.  Training takes a bounded, hash-drawn sample of
labelled rows (``TRAIN_ROWS``): shallow trees over one binned feature at a time are boosted
in a cycle, each tree added to that feature's lookup table; then the strongest pairs on what
is left are boosted the same way into two-dimensional tables.  Scoring adds table entries by
bin, vectorised over a batch of documents.

Defined cases: null text is empty and gets a score like any other; rows without a doc_id
cannot be labelled and are never held out; null labels and ids whose labels disagree are left
out; of several texts of one labelled id the one with the least features is learnt from; with
no labelled row every score is 0.5; repeated rows get equal scores; an empty table
gives no rows; further columns of the input are ignored by the query and kept by the filter.
"""

from __future__ import annotations

import math
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellhealth.llm.common import blocks, drop_stage, prepare, raw_text, write_stage

#: Bound of the training sample; all labelled rows when there are fewer.
TRAIN_ROWS = 50_000
#: Steps in which the share of drawn ids is stated: over 10^12, so that no table of labels has a share of 0.
DRAW = 1 << 40
BINS, ROUNDS, PAIRS, PAIR_ROUNDS, RATE, RIDGE = 48, 60, 8, 40, 0.25, 2.0
THRESHOLD = 0.3
WINDOW = 512

FEATURES = ("log_bytes", "log_words", "mean_word", "sd_word", "log_longest", "distinct_words", "repeated_words",
            "upper", "digit", "point", "symbol", "wide", "blank", "window_upper", "window_symbol", "window_point",
            "distinct_lines", "log_line", "short_words")

_KINDS = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "point": b".,;:?'\"-()",
          "symbol": b"!#$%&*+/<=>@[\\]^_`{|}~", "blank": b" \t\n\r\x0b\x0c", "wide": bytes(range(128, 256))}


def features(raws: list[bytes]) -> np.ndarray:
    """One row of FEATURES per text."""
    out = {f: np.zeros(len(raws)) for f in FEATURES}
    sizes = np.array([len(r) for r in raws], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    buffer, safe = np.frombuffer(b"".join(raws), np.uint8), np.maximum(sizes, 1)
    # windows of each text, in order; an empty text has one empty window
    per = np.maximum(1, -(-sizes // WINDOW))
    first = np.cumsum(per) - per
    left = np.repeat(starts, per) + (np.arange(per.sum()) - np.repeat(first, per)) * WINDOW
    right = np.minimum(left + WINDOW, np.repeat(ends, per))
    for kind, members in _KINDS.items():
        lookup = np.zeros(256, np.uint8)
        lookup[list(members)] = 1
        total = np.concatenate(([0], np.cumsum(lookup[buffer], dtype=np.int32)))
        out[kind] = (total[ends] - total[starts]) / safe
        if f"window_{kind}" in out:
            share = (total[right] - total[left]) / np.maximum(right - left, 64)
            out[f"window_{kind}"] = np.maximum.reduceat(share, first) if len(raws) else share
    out["log_bytes"] = np.log1p(sizes)
    for i, raw in enumerate(raws):
        words = raw.split()
        if not words:
            continue
        n, lengths = len(words), np.fromiter(map(len, words), np.int32, len(words))
        lines = raw.split(b"\n")
        out["log_words"][i] = np.log1p(n)
        out["mean_word"][i], out["sd_word"][i] = lengths.mean(), lengths.std()
        out["log_longest"][i] = np.log1p(lengths.max())
        out["short_words"][i] = (lengths == 1).mean()
        out["distinct_words"][i] = np.log1p(len(set(words))) / np.log1p(n)
        out["repeated_words"][i] = sum(map(eq, words, words[1:])) / n
        out["distinct_lines"][i] = len(set(lines)) / len(lines)
        out["log_line"][i] = np.log1p(len(raw) / len(lines))
    return np.column_stack([out[f] for f in FEATURES])


class AdditiveModel:
    """Intercept, one lookup table per feature and one two-dimensional table per chosen pair."""

    def __init__(self):
        self.intercept, self.edges, self.tables, self.pairs, self.pair_tables = 0.0, [], [], [], []

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        if self.edges:
            b = self.bins(x)
            for own, lookup in zip(b, self.tables, strict=True):
                total += lookup[own]
            for (i, j), lookup in zip(self.pairs, self.pair_tables, strict=True):
                total += lookup[b[i], b[j]]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def _leaves(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A two-level tree over one feature's bins: each bin's step."""
    def cut(lo: int, hi: int) -> int:
        cg, ch = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi])
        gain = cg ** 2 / (ch + RIDGE) + (cg[-1] - cg) ** 2 / (ch[-1] - ch + RIDGE)
        return lo + 1 + int(np.argmax(gain[:-1])) if hi - lo > 1 else hi

    step, middle = np.zeros(len(g)), cut(0, len(g))
    for lo, hi in ((0, middle), (middle, len(g))):
        if lo < hi:
            inner = cut(lo, hi)
            for a, b in ((lo, inner), (inner, hi)):
                if a < b:
                    step[a:b] = RATE * g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return step


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, int, int]:
    """The best cut of a pair into four: gain, row and column of the cut."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    top, side, of = (cg[:, -1:], ch[:, -1:]), (cg[-1:], ch[-1:]), (cg[-1, -1], ch[-1, -1])
    parts = [(cg, ch), (top[0] - cg, top[1] - ch), (side[0] - cg, side[1] - ch),
             (of[0] - top[0] - side[0] + cg, of[1] - top[1] - side[1] + ch)]
    gain = sum(a ** 2 / (np.maximum(b, 0) + RIDGE) for a, b in parts)
    best = np.unravel_index(np.argmax(gain[:-1, :-1]), (gain.shape[0] - 1, gain.shape[1] - 1))
    return float(gain[best]), int(best[0]), int(best[1])


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Cyclic boosting of main effects, then of the strongest pairs."""
    model = AdditiveModel()
    if not len(y):
        return model
    model.intercept = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    model.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    b, sizes = model.bins(x), [len(e) + 1 for e in model.edges]
    model.tables = [np.zeros(n) for n in sizes]
    margin = np.full(len(y), model.intercept)

    def residual() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, n in enumerate(sizes):
            if n > 1:
                g, h = residual()
                step = _leaves(np.bincount(b[j], g, n), np.bincount(b[j], h, n))
                model.tables[j] += step
                margin += step[b[j]]
    g, h = residual()

    def grid(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        at, shape = b[i] * sizes[j] + b[j], (sizes[i], sizes[j])
        return (np.bincount(at, g, shape[0] * shape[1]).reshape(shape),
                np.bincount(at, h, shape[0] * shape[1]).reshape(shape))

    able = [j for j, n in enumerate(sizes) if n > 1]
    model.pairs = sorted(combinations(able, 2), key=lambda p: -_quadrants(*grid(*p))[0])[:PAIRS]
    model.pair_tables = [np.zeros((sizes[i], sizes[j])) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), lookup in zip(model.pairs, model.pair_tables, strict=True):
            g, h = residual()
            own, weight = grid(i, j)
            _, r, c = _quadrants(own, weight)
            step = np.zeros_like(lookup)
            for part in (np.s_[:r + 1, :c + 1], np.s_[:r + 1, c + 1:], np.s_[r + 1:, :c + 1], np.s_[r + 1:, c + 1:]):
                step[part] = RATE * own[part].sum() / (weight[part].sum() + RIDGE)
            lookup += step
            margin += step[b[i], b[j]]
    return model


def document_features(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, x): one array of FEATURES per row."""
    prepare(docs, text, doc_id)

    def rows(batches):
        for rest, raws in blocks(batches, "raw", 8 << 20):
            x = features(raws)
            yield pa.RecordBatch.from_arrays(
                [rest["doc_id"], pa.ListArray.from_arrays(np.arange(len(raws) + 1, dtype=np.int32) * x.shape[1],
                                                          x.ravel())], names=["doc_id", "x"])

    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), raw_text(text).alias("raw"))
            .mapInArrow(rows, "doc_id long, x array<double>"))


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def draw(labels: DataFrame, label: str = "quality", bound: int = TRAIN_ROWS) -> DataFrame:
    """(_id, _y): about ``bound`` labelled ids that are not held out, or all, drawn by their hash."""
    known = (labels.filter(F.col(label).isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("_id"))
             .agg(F.min(label).alias("_y"), F.max(label).alias("_max")).filter("_y = _max")
             .filter(~held_out("_id")))
    share = min(1.0, bound / max(1, known.count()))
    return known.filter(F.pmod(F.xxhash64("_id"), F.lit(DRAW)) < math.ceil(share * DRAW)).select("_id", "_y")


def train(rows: DataFrame, drawn: DataFrame) -> AdditiveModel:
    """Fit on the rows (doc_id, x) of the ids of :func:`draw`; they come to the driver."""
    got = rows.join(drawn, rows.doc_id == F.col("_id")).groupBy("doc_id").agg(
        F.min("x").alias("x"), F.first("_y").alias("y")).toArrow().sort_by("doc_id")
    if not got.num_rows:
        return AdditiveModel()
    x = got.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(got.num_rows, -1)
    return fit(x, got.column("y").to_numpy().astype(float))


def quality_scores(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    rows = write_stage(document_features(docs, text, doc_id), "features")
    model = train(rows, draw(labels))

    def scored(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], names=["doc_id", "score"])

    return (rows.mapInArrow(scored, "doc_id long, score double")
            .select("doc_id", held_out().alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def keep_quality(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, all columns kept.

    Features are computed once for the drawn rows, to fit on, and once for all in the pass that
    scores them; the drawn ids (about ``TRAIN_ROWS``) and the fitted tables travel to the rows,
    so no text is shuffled.
    """
    prepare(docs, text, doc_id)
    drawn = write_stage(draw(labels), "drawn")
    few = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).join(
        F.broadcast(drawn.select(F.col("_id").alias("doc_id"))), "doc_id", "left_semi")
    model = train(document_features(few), drawn)
    drop_stage(drawn)
    at = docs.columns.index(text)

    def kept(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                raws = part.column(at).cast(pa.binary()).fill_null(b"").to_pylist()
                yield part.filter(pa.array(model.score(features(raws)) >= THRESHOLD))

    return docs.mapInArrow(kept, docs.schema)
