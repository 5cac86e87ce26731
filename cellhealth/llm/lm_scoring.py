"""Hidden Markov language model: trained by Baum-Welch, scored by the scaled forward recursion.

Tokens are runs without ASCII white space, A-Z lowered, and one end per text.  A state emits
a class and the class a word.  A word with at least 1/``OWN`` of all training tokens is a
class of its own, so there are at most ``OWN`` of these at any size; the others share
``ENDINGS`` classes by a hash of their last bytes.  Within a class a word has probability
(c + 1) / (class tokens + class words + 1), one part being left for unseen words; c is its
count in all training texts.  So the emission tables are bounded, while counts cover the whole
vocabulary and never leave the executors but for the sums by class.

Texts are cut into words once; a written table holds, for a block of documents, its distinct
words and the texts as numbers.  The blocks' distinct words, counted per block, go to shards
by word, which add them up and answer every block; a word reaches a shard once per block, so
the commonest is no larger there than the number of blocks.  A pass of Baum-Welch runs forward and
backward over all training texts, side by side in tasks; expected counts are added up per
task, then across tasks by class, and the bounded sums come to the driver.  States differ by
chance (a fixed seed) before the first pass.  Every pass covers every training text, of any
length; passes go on until the likelihood settles (``SETTLED``).

Defined cases: null and empty texts are one end; a null doc_id is never held out; repeated
rows count and score as often as they occur; with no training text every probability is that
of one unseen word; an empty table gives no rows; further columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellhealth.llm.common import blocks, drop_stage, prepare, raw_text, reread, write_stage

STATES, OWN, ENDINGS = 8, 65_536, 4096
#: Training ends when a pass gains less than this share of the log likelihood; ceiling of passes.
SETTLED, PASSES = 5e-4, 50
#: Strength of the class counts of all states in each state's; chance to stay in a state at first.
BACKOFF, STAY = 50.0, 0.9
#: Text of a block; tokens taken up before they are sorted by length; tokens run side by side.
BLOCK_BYTES, HELD_TOKENS, SIDE_TOKENS = 8 << 20, 4 << 20, 1 << 20
#: Words of all blocks that one shard adds up; the number of shards follows their number.
SHARD_WORDS = 400_000
#: Blocks of documents that meet their counts in one task; the number of tasks follows theirs.
TASK_BLOCKS = 4
END = b""


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 7 == 2, F.lit(False))


def _pack(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers byte plane by byte plane, which compresses well."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


_SHARD = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("words", pa.list_(pa.binary())),
                    ("counts", pa.list_(pa.int64()))])


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random letters, and powers of an odd base and of its inverse, modulo 2**64."""
    base, powers = 0x9E3779B97F4A7C15, []
    for step in (base, pow(base, -1, 1 << 64)):
        with np.errstate(over="ignore"):
            powers.append(np.cumprod(np.full(n, step, np.uint64)))
    return np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64), *powers


def _shards(words: pa.Array, shards: int) -> np.ndarray:
    """The shard of each word by a hash of its bytes, for all words at once."""
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    ends = ends - ends[0]
    letters, power, inverse = _powers(1 << max(16, len(data).bit_length()))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(letters[data] * power[:len(data)])))
    mixed = (total[ends[1:]] - total[ends[:-1]]) * inverse[ends[:-1]]
    return ((mixed ^ (mixed >> np.uint64(31))) % np.uint64(shards)).astype(np.int64)


def _blocks(batches):
    """One row per block: ids, which texts train, lengths, texts as word numbers, distinct words and counts."""
    for rest, raws in blocks(batches, "raw", BLOCK_BYTES):
        number = defaultdict(count().__next__, {})
        number[END]
        texts, sizes = [], []
        for raw in raws:
            words = raw.lower().split()
            words.append(END)
            sizes.append(len(words))
            texts.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
        train = np.array(rest["train"].to_pylist(), bool)
        tokens = np.concatenate(texts)
        counts = np.bincount(tokens[np.repeat(train, sizes)], minlength=len(number))
        order = np.argsort(-np.bincount(tokens, minlength=len(number)), kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        words = list(number)
        yield pa.RecordBatch.from_pydict({
            "ids": [rest["doc_id"].to_pylist()], "train": [train.tolist()], "sizes": [sizes],
            "tokens": [_pack(place[tokens])], "words": [[words[i] for i in order]],
            "counts": [counts[order].tolist()]}, schema=pa.schema([
                ("ids", pa.list_(pa.int64())), ("train", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int32())),
                ("tokens", pa.binary()), ("words", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64()))]))


class Classes:
    """Which class a word belongs to, and each class's tokens and words in training."""

    def __init__(self, own: dict[bytes, int], tokens: np.ndarray, words: np.ndarray):
        self.own, self.tokens, self.words = own, tokens, words

    @staticmethod
    def ending(word: bytes, first: int) -> int:
        return first + zlib.crc32(word[-4:]) % ENDINGS

    def of(self, word: bytes) -> int:
        own = self.own.get(word)
        return self.ending(word, len(self.own)) if own is None else own

    @property
    def shares(self) -> np.ndarray:
        """The class's share of all tokens; a shared class has a part for unseen words.

        So has the end's, should no training text have shown one.
        """
        mass = self.tokens + self.words + ((np.arange(len(self.tokens)) >= len(self.own)) | (self.words == 0))
        return mass / mass.sum()


class Model:
    """Start, transition (state, state) and emission (class, state) probabilities."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def fresh(cls, shares: np.ndarray, states: int) -> Model:
        """States that differ by chance (a fixed seed)."""
        noise = np.exp(np.random.default_rng(7).normal(0, 0.7, (len(shares), states)))
        emit = shares[:, None] * noise
        move = np.full((states, states), (1 - STAY) / max(1, states - 1))
        np.fill_diagonal(move, STAY if states > 1 else 1.0)
        return cls(np.full(states, 1 / states), move, emit / emit.sum(0))

    @classmethod
    def from_counts(cls, counts: Counts, shares: np.ndarray) -> Model:
        start = counts.start + 0.1
        move = counts.move + 0.1
        emit = counts.emit + BACKOFF * shares[:, None]
        return cls(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


class Counts:
    """Expected counts of Baum-Welch."""

    def __init__(self, classes: int, states: int):
        self.start, self.move = np.zeros(states), np.zeros((states, states))
        self.emit, self.score = np.zeros((classes, states)), 0.0


def _side_by_side(sizes: np.ndarray):
    """Document numbers, longest first, in groups of about SIDE_TOKENS tokens."""
    order = np.argsort(-sizes, kind="stable")
    group = (np.cumsum(sizes[order]) - 1) // SIDE_TOKENS
    return np.split(order, np.flatnonzero(np.diff(group)) + 1) if len(order) else []


def _by_time(tokens: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
    """Tokens of documents (longest first) by position: all first ones, all second ones, ...

    Returns them with the offset of each position.
    """
    alive = len(sizes) - np.searchsorted(sizes[::-1], np.arange(sizes[0]), side="right")
    at = np.concatenate(([0], np.cumsum(alive)))
    row = np.arange(at[-1]) - np.repeat(at[:-1], alive)
    return tokens[starts[row] + np.repeat(np.arange(sizes[0]), alive)], at


def forward(model: Model, tokens: np.ndarray, sizes: np.ndarray, counts: Counts | None = None) -> np.ndarray:
    """log10 probability of each document's classes by the scaled forward recursion.

    ``counts`` gets the expected counts of the backward recursion added; that runs in single
    precision (the scaled values stay near 1), sums over positions and tasks in double.
    """
    out, starts = np.zeros(len(sizes)), np.cumsum(sizes) - sizes
    states, kind = len(model.start), np.float64 if counts is None else np.float32
    start, move, table = (x.astype(kind) for x in (model.start, model.move, model.emit))
    ones = np.ones(states, kind)
    for group in _side_by_side(sizes):
        seen, at = _by_time(tokens, starts[group], sizes[group])
        emitted = table[seen]
        scale = np.empty(len(seen), kind)
        kept = np.empty((len(seen), states), np.float32) if counts is not None else None
        state = np.broadcast_to(start, (len(group), states))
        bounds = at.tolist()
        for t, (lo, hi) in enumerate(zip(bounds, bounds[1:], strict=False)):
            state = (state[:hi - lo] @ move if t else state) * emitted[lo:hi]
            total = state @ ones
            state /= total[:, None]
            scale[lo:hi] = total
            if kept is not None:
                kept[lo:hi] = state
        row = np.arange(len(seen)) - np.repeat(at[:-1], np.diff(at))
        out[group] = np.bincount(row, np.log10(scale, dtype=np.float64), len(group))
        if counts is None:
            continue
        # backward; kept turns into the state probabilities of each token
        after, moved, back = np.ones((len(group), states), kind), np.zeros((states, states)), move.T.copy()
        for t in range(len(bounds) - 2, 0, -1):
            lo, hi, low = bounds[t], bounds[t + 1], bounds[t - 1]
            n = hi - lo
            ahead = emitted[lo:hi] * after[:n]
            ahead /= scale[lo:hi, None]
            moved += kept[low:low + n].T @ ahead
            kept[lo:hi] *= after[:n]
            np.matmul(ahead, back, out=after[:n])
        counts.move += moved * model.move
        kept[:bounds[1]] *= after
        counts.start += kept[:bounds[1]].sum(0, dtype=np.float64)
        for k in range(states):
            counts.emit[:, k] += np.bincount(seen, kept[:, k], len(counts.emit))
        counts.score += out[group].sum()
    return out


def _rows(batches, *arrays: str):
    """Rows one by one: lists and binaries as Python values, lists of structs and ``arrays`` as Arrow arrays."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {}
            for name in batch.schema.names:
                value = batch.column(name)[i]
                if name in arrays or pa.types.is_list(value.type) and pa.types.is_struct(value.type.value_type):
                    row[name] = value.values if value.is_valid else None
                else:
                    row[name] = value.as_py()
            yield row


def _texts(batches, training: bool):
    """Documents of the symbol table, HELD_TOKENS at a time: (ids and measures, tokens, sizes)."""
    held, n = [], 0
    for row in _rows(batches):
        tokens, sizes = _unpack(row.pop("tokens")), np.array(row["sizes"], np.int64)
        if training:
            train = np.array(row["train"], bool)
            tokens, sizes = tokens[np.repeat(train, sizes)], sizes[train]
        held.append((row, tokens.astype(np.int32), sizes))
        n += len(tokens)
        if n >= HELD_TOKENS:
            yield [h[0] for h in held], np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            held, n = [], 0
    if held:
        yield [h[0] for h in held], np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])


def baum_welch_pass(symbols: DataFrame, model: Model, shares: np.ndarray) -> tuple[Model, float]:
    """One pass over all training texts: the next model, and the log10 likelihood under ``model``.

    Expected counts are summed per task, then across tasks.
    """
    states, classes = len(model.start), len(shares)
    shared = symbols.sparkSession.sparkContext.broadcast(model)

    def expected(batches):
        counts = Counts(classes, states)
        for _, tokens, sizes in _texts(batches, True):
            forward(shared.value, tokens, sizes, counts)
        found = np.zeros((1, states))
        found[0, 0] = counts.score
        table = np.concatenate([counts.emit, counts.move, counts.start[None], found])
        keys = np.flatnonzero(table.any(1))
        for i in range(0, len(keys), 10_000):
            own = keys[i:i + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(own), *[pa.array(table[own, k]) for k in range(states)]],
                                             names=["key", *[f"s{k}" for k in range(states)]])

    names = [f"s{k}" for k in range(states)]
    got = (symbols.select("train", "sizes", "tokens")
           .mapInArrow(expected, "key long, " + ", ".join(f"{s} double" for s in names))
           .groupBy("key").agg(*[F.sum(s).alias(s) for s in names]).toArrow())
    table = np.zeros((classes + states + 2, states))
    if got.num_rows:
        table[got.column("key").to_numpy()] = np.column_stack([got.column(s).to_numpy() for s in names])
    counts = Counts(classes, states)
    counts.emit, counts.move, counts.start = table[:classes], table[classes:-2], table[-2]
    shared.unpersist()
    return Model.from_counts(counts, shares), float(table[-1, 0])


def trained(symbols: DataFrame, shares: np.ndarray, states: int, passes: int = PASSES) -> tuple[Model, list[float]]:
    """Passes over all training texts until one gains less than SETTLED of the likelihood.

    ``passes`` is a ceiling.  The second result is the log10 likelihood that each pass found.
    """
    model, scores = Model.fresh(shares, states), []
    while len(scores) < passes:
        model, score = baum_welch_pass(symbols, model, shares)
        scores.append(score)
        if len(scores) > 1 and score - scores[-2] < SETTLED * abs(score):
            break
    return model, scores


def hmm_scores(docs: DataFrame, states: int = STATES, passes: int = PASSES, text: str = "text",
               doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    prepare(docs, text, doc_id)
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), (~held_out(doc_id)).alias("train"),
                       raw_text(text).alias("raw"))
    kind = ("ids array<long>, train array<boolean>, sizes array<int>, tokens binary, words array<binary>, "
            "counts array<long>")
    cut = write_stage(rows.mapInArrow(_blocks, kind).select(F.monotonically_increasing_id().alias("block"), "*"),
                      "blocks")  # rows of one block are large: all that reads them takes them one by one
    total, n_words, n_train, n_blocks = cut.agg(
        F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)), F.sum(F.size("words")),
        F.sum(F.size(F.filter("train", lambda t: t))), F.count("*")).first()
    total, n_train, shards = total or 0, n_train or 0, 1 + (n_words or 0) // SHARD_WORDS
    meetings = 1 + n_blocks // TASK_BLOCKS

    def dealt(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                words, counts = batch.column(1)[i].values, batch.column(2)[i].values
                at = _shards(words, shards)
                order = np.argsort(at, kind="stable")
                cuts = np.concatenate(([0], np.flatnonzero(np.diff(at[order])) + 1, [len(order)])).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at[order[cuts[:-1]]]), pa.array(np.full(len(cuts) - 1, batch.column(0)[i].as_py())),
                     pa.ListArray.from_arrays(cuts, words.take(pa.array(order))),
                     pa.ListArray.from_arrays(cuts, counts.take(pa.array(order)))],
                    names=["shard", "block", "words", "counts"])

    def added(part: pa.Table) -> pa.Table:
        """One shard: every word's count in training, for each block and (block -1) for the vocabulary."""
        lists, own = part.column("words").combine_chunks(), part.column("counts").combine_chunks()
        coded = lists.flatten().dictionary_encode()
        places, words = coded.indices.to_numpy(), coded.dictionary
        c = np.bincount(places, own.flatten().to_numpy(), len(words)).astype(np.int64)
        seen = np.flatnonzero(c)
        ends = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy()))).astype(np.int32)
        shard, n = part.column("shard")[0].as_py(), len(lists)
        return pa.table({
            "shard": pa.array(np.full(n + 1, shard)),
            "block": pa.concat_arrays([part.column("block").combine_chunks(), pa.array([-1], pa.int64())]),
            "words": pa.concat_arrays([pa.nulls(n, pa.list_(pa.binary())), pa.ListArray.from_arrays(
                pa.array([0, len(seen)], pa.int32()), words.take(pa.array(seen)))]),
            "counts": pa.concat_arrays([pa.ListArray.from_arrays(pa.array(ends), pa.array(c[places])),
                                        pa.ListArray.from_arrays(pa.array([0, len(seen)], pa.int32()),
                                                                 pa.array(c[seen]))])}, schema=_SHARD)

    kind = "shard long, block long, words array<binary>, counts array<long>"
    summed = write_stage(cut.select("block", "words", "counts").mapInArrow(dealt, kind)
                         .repartition(shards, "shard").groupBy("shard").applyInArrow(added, kind), "counts", batch_rows=1)
    vocabulary = summed.filter("block = -1").select("words", "counts")
    distinct = vocabulary.agg(F.sum(F.size("words"))).first()[0] or 0

    def common(batches):
        for row in _rows(batches):
            out = [w for w, c in zip(row["words"], row["counts"], strict=True) if c * OWN >= total or w == END]
            yield pa.RecordBatch.from_pydict({"word": out}, schema=pa.schema([("word", pa.binary())]))

    # At most OWN words, whatever the size, and the end.
    own = {bytes(r.word): i for i, r in enumerate(sorted(vocabulary.mapInArrow(common, "word binary").collect()))}
    own.setdefault(END, len(own))
    names = spark.sparkContext.broadcast(Classes(own, np.zeros(0), np.zeros(0)))

    def sums(batches):
        tokens, words = np.zeros(len(own) + ENDINGS), np.zeros(len(own) + ENDINGS)
        for row in _rows(batches):
            of = np.array([names.value.of(w) for w in row["words"]], np.int64)
            tokens += np.bincount(of, row["counts"], len(tokens))
            words += np.bincount(of, minlength=len(words))
        some = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(tokens[some]), pa.array(words[some])],
                                         names=["class", "c", "words"])

    by_class = (vocabulary.mapInArrow(sums, "class long, c double, words double").groupBy("class")
                .agg(F.sum("c").alias("c"), F.sum("words").alias("words")).collect())
    tokens_of, words_of = np.zeros(len(own) + ENDINGS), np.zeros(len(own) + ENDINGS)
    for r in by_class:
        tokens_of[r["class"]], words_of[r["class"]] = r.c, r.words
    classes = Classes(own, tokens_of, words_of)
    shares = classes.shares
    shared = spark.sparkContext.broadcast(classes)
    answered = (reread(summed).filter("block >= 0").repartition(meetings, "block").groupBy("block")
                .agg(F.collect_list(F.struct("shard", "counts")).alias("known")))

    def numbered(batches):
        known = shared.value
        within = np.log10(known.tokens + known.words + 1)
        for row in _rows(batches, "words"):
            at = _shards(row["words"], shards)
            order = np.argsort(at, kind="stable")  # as the shards were dealt: by shard, then by place
            answers = row["known"].take(pc.array_sort_indices(row["known"].field("shard")))
            words = row["words"].to_pylist()
            c = np.empty(len(words), np.int64)
            c[order] = answers.field("counts").flatten().to_numpy()
            of = np.array([known.of(w) for w in words], np.int64)
            tokens, sizes = _unpack(row["tokens"]), np.array(row["sizes"], np.int64)
            doc = np.repeat(np.arange(len(sizes)), sizes)
            log_c = np.log10(c + 1)
            inside = np.where(of >= len(known.own), log_c - within[of], 0.0)
            n = len(sizes)
            yield pa.RecordBatch.from_pydict({
                "ids": [row["ids"]], "train": [row["train"]], "sizes": [row["sizes"]],
                "tokens": [_pack(of[tokens])],
                "n_known": [np.bincount(doc, c[tokens] > 0, n).astype(np.int64).tolist()],
                "log_c": [np.bincount(doc, log_c[tokens], n).tolist()],
                "inside": [np.bincount(doc, inside[tokens], n).tolist()]}, schema=pa.schema([
                    ("ids", pa.list_(pa.int64())), ("train", pa.list_(pa.bool_())),
                    ("sizes", pa.list_(pa.int32())), ("tokens", pa.binary()), ("n_known", pa.list_(pa.int64())),
                    ("log_c", pa.list_(pa.float64())), ("inside", pa.list_(pa.float64()))]))

    symbols = write_stage(
        reread(cut).select("block", "ids", "train", "sizes", "tokens", "words").repartition(meetings, "block")
        .join(answered.hint("shuffle_hash"), "block")
        .mapInArrow(numbered, "ids array<long>, train array<boolean>, sizes array<int>, tokens binary, "
                    "n_known array<long>, log_c array<double>, inside array<double>"), "symbols", batch_rows=1)
    drop_stage(cut, summed)
    model, _ = trained(symbols, shares, states, passes if n_train else 0)
    final = spark.sparkContext.broadcast(model)
    unit = float(np.log10(total + distinct + 1))

    def scored(batches):
        for rows, tokens, sizes in _texts(batches, False):
            score = forward(final.value, tokens, sizes)
            column = {c: [x for r in rows for x in r[c]] for c in ("ids", "train", "n_known", "log_c", "inside")}
            yield pa.RecordBatch.from_arrays(
                [pa.array(column["ids"], pa.int64()), pa.array([not t for t in column["train"]]), pa.array(sizes),
                 pa.array(column["n_known"], pa.int64()), pa.array(np.full(len(sizes), total)),
                 pa.array(np.array(column["log_c"]) - sizes * unit), pa.array(score + np.array(column["inside"]))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return symbols.mapInArrow(scored, "doc_id long, held_out boolean, n_tokens long, n_known long, "
                                      "train_tokens long, base_score double, score double")
