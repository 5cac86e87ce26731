"""Spelling variant grouping: words one edit apart, found by PartEnum signatures of their letter multisets.

A word is a binary vector over (letter, how often so far): "banana" has a1 b1 a2 n1 a3 n2.  A
replaced letter changes two of its entries, an inserted or deleted one changes one, so words
one edit apart are vectors of a Hamming distance of at most two.  The entries are dealt by a
hash over parts; where two vectors differ in d entries, at most d parts differ, so the vectors
agree on all other parts for some choice of d parts left out.  Every word sends one signature
for every such choice: of equal lengths two of ``SAME_PARTS`` parts are left out, of lengths
that differ by one, one of ``NEXT_PARTS``.  Signatures are hashes of the remaining parts and the length;
words that share one meet in an equi-join.  In the join a cheap test goes first (one edit leaves
the first or the last half of the shorter word as it is); what passes is verified by the edit distance.

A form is the near word of the largest count (ties: smallest in code-point order) if that is at
least ``lead`` times the word's own; counts rise along forms, so roots are found by pointer
jumping in a few joins.

Words are counted in tasks before the shuffle; a task holds at most ``HELD`` words.  No group is
collected: signatures meet row by row, in a join that can spill and whose skew Spark splits.  Nothing
is broadcast: Spark sizes tables by their compressed files, and signatures like the words that send
them (28 rows a word), so every join here asks for a merge join.

Defined cases: a null text has no words; a null id counts as an empty one where the noise hash
names it; empty texts, an empty table or no frequent word give no rows; repeated rows count as
often as they occur; further columns of the input are ignored.
"""

from __future__ import annotations

import re
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellhealth.llm.common import blocks, drop_stage, prepare, raw_text, reread, write_stage

#: Parts that the entries of a letter multiset are dealt over, for words of equal and of neighbouring lengths.
SAME_PARTS, NEXT_PARTS = 8, 5
#: Distinct words that a task counts up before it passes them on.
HELD = 200_000
SIGNATURE = "sig long, half int, word string, n long"


def word_counts(docs: DataFrame, least_letters: int = 5, least: int = 3, noise: int = 97, text: str = "text",
                doc_id: str = "doc_id") -> DataFrame:
    """(word, n): runs of letters, A-Z lowered, with at least ``least_letters`` letters and ``least`` occurrences.

    A run whose crc32 with its document's id is a multiple of ``noise`` loses the letter that the
    hash points at; 0 leaves all as they are.
    """
    prepare(docs, text, doc_id)
    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), raw_text(text).alias("raw"))
    # A shorter run has no word that is long enough, with or without a letter less.
    runs = re.compile(f"[a-zÀ-ÿ]{{{max(1, least_letters)},}}").finditer

    def counted(batches):
        counts: dict[str, int] = {}
        for rest, raws in blocks(batches, "raw", 4 << 20):
            for own, raw in zip(rest["id"].to_pylist(), raws, strict=True):
                seed = zlib.crc32(f"{own}:".encode())
                for found in runs(raw.lower().decode("utf-8", "replace")):
                    word = found.group()
                    if noise:
                        h = zlib.crc32(word.encode(), seed)
                        if h % noise == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                            if len(word) < least_letters:
                                continue
                    counts[word] = counts.get(word, 0) + 1
                if len(counts) >= HELD:
                    yield pa.RecordBatch.from_pydict({"word": list(counts), "n": list(counts.values())})
                    counts = {}
        if counts:
            yield pa.RecordBatch.from_pydict({"word": list(counts), "n": list(counts.values())})

    return (rows.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= least))


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers spread evenly, each number always to the same one."""
    x = x.astype(np.uint64)
    with np.errstate(over="ignore"):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x + np.uint64(0x9E3779B97F4A7C15)) ^ (x >> np.uint64(shift))
            x = x * np.uint64(factor)
        return x ^ (x >> np.uint64(31))


class Letters:
    """The letters of a batch of words as arrays."""

    def __init__(self, words: list[str]):
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))
        self.own = np.repeat(np.arange(len(words)), self.sizes)
        order = np.lexsort((self.codes, self.own))
        codes, own, at = self.codes[order], self.own[order], np.arange(len(order))
        new = np.ones(len(order), bool)
        new[1:] = (codes[1:] != codes[:-1]) | (own[1:] != own[:-1])
        occurrence = at - np.maximum.accumulate(np.where(new, at, 0))
        self.entries, self.entry_own = _mixed(codes << np.uint64(32) | occurrence.astype(np.uint64)), own
        # Sums of letter hashes times powers of an odd base: hashes of prefixes and suffixes.
        spread = _mixed(self.codes) >> np.uint64(20)
        within = np.arange(len(self.codes)) - np.repeat(self.starts[:-1], self.sizes)
        behind = np.repeat(self.sizes, self.sizes) - 1 - within
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.full(int(self.sizes.max(initial=0)) + 1, 0x9E3779B97F4A7C15, np.uint64))
            self.front = np.concatenate((np.zeros(1, np.uint64), np.cumsum(spread * powers[within])))
            self.back = np.concatenate((np.zeros(1, np.uint64), np.cumsum(spread * powers[behind])))

    def parts(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(words x n) hashes of the entries in each part, and of all parts: sums of entry hashes."""
        out = np.zeros((len(self.sizes), n), np.uint64)
        part = (_mixed(self.entries + np.uint64(n)) % np.uint64(n)).astype(np.int64)
        np.add.at(out, (self.entry_own, part), self.entries)
        return out, out.sum(axis=1, dtype=np.uint64)

    def halves(self, shorter: np.ndarray) -> np.ndarray:
        """16 bits each of the first half and of the last other half of a word of ``shorter`` letters."""
        head, first, last = shorter // 2, self.starts[:-1], self.starts[1:]
        tail = shorter - head
        with np.errstate(over="ignore"):
            a = _mixed(self.front[first + head] - self.front[first]) >> np.uint64(48)
            b = _mixed(self.back[last] - self.back[last - tail]) >> np.uint64(48)
        return (a << np.uint64(16) | b).astype(np.uint32).view(np.int32)


def _signed(word_arrays: tuple[pa.Array, pa.Array], hashes: list[np.ndarray], size: np.ndarray, halves: np.ndarray,
            kind: int):
    """One batch per choice of parts left out: the remaining parts, the choice and the length make the signature."""
    words, n = word_arrays
    for choice, rest in enumerate(hashes):
        tag = _mixed((np.uint64(kind << 56 | choice << 40) | size.astype(np.uint64)))
        with np.errstate(over="ignore"):
            sig = _mixed(rest + tag).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(halves), words, n], names=["sig", "half", "word", "n"])


def _signatures(vocabulary: DataFrame, kind: str) -> DataFrame:
    """One row per word and choice of parts; kind: "same", or "short" and "long" for neighbouring lengths."""

    def signed(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            words, n = batch.column("word"), batch.column("n")
            letters = Letters(words.to_pylist())
            if kind == "same":
                parts, total = letters.parts(SAME_PARTS)
                rest = [total - parts[:, i] - parts[:, j] for i, j in combinations(range(SAME_PARTS), 2)]
                yield from _signed((words, n), rest, letters.sizes, letters.halves(letters.sizes), 1)
            else:
                parts, total = letters.parts(NEXT_PARTS)
                shorter = letters.sizes - (kind == "long")
                yield from _signed((words, n), [total - parts[:, i] for i in range(NEXT_PARTS)], shorter,
                                   letters.halves(shorter), 2)

    return vocabulary.select("word", "n").mapInArrow(signed, SIGNATURE)


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(a, na, b, nb): each pair of words of ``vocabulary`` (word, n; a written table) one edit apart, once."""
    same = _signatures(vocabulary, "same")
    found = []
    for left, right, order in ((same, same, F.col("l.word") < F.col("r.word")),
                               (_signatures(vocabulary, "short"), _signatures(vocabulary, "long"), F.lit(True))):
        apart = F.col("l.half").bitwiseXOR(F.col("r.half"))
        half = (apart.bitwiseAND(F.lit(0xFFFF)) == 0) | (apart.bitwiseAND(F.lit(-0x10000)) == 0)
        pairs = left.alias("l").join(right.alias("r").hint("merge"), (F.col("l.sig") == F.col("r.sig")) & order & half)
        found.append(pairs.select(F.col("l.word").alias("a"), F.col("l.n").alias("na"),
                                  F.col("r.word").alias("b"), F.col("r.n").alias("nb"))
                     .filter(F.levenshtein("a", "b", 1) == 1))
    return found[0].union(found[1]).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every word of ``forms`` (word, form; a written table): follow forms to the last."""
    own = write_stage(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        up = reread(own).filter("word <> root").select(F.col("word").alias("at"), F.col("root").alias("next"))
        step = write_stage(own.join(up.hint("merge"), own.root == up["at"], "left")
                           .select("word", F.coalesce("next", "root").alias("root"),
                                   F.col("next").isNotNull().alias("moved")), "roots")
        drop_stage(own)
        moved = step.filter("moved").limit(1).count()
        own = step.select("word", "root")
        own._llm_stage = step._llm_stage
        if not moved:
            return own


def spelling_groups(docs: DataFrame, least_letters: int = 5, least: int = 3, noise: int = 97, lead: int = 2,
                    text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n (as the module describes them)."""
    vocabulary = write_stage(word_counts(docs, least_letters, least, noise, text, doc_id), "words")
    pairs = write_stage(near_words(vocabulary), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("count")).union(
        pairs.select("b", "a", "na"))
    best = both.groupBy("word").agg(F.count("*").alias("near"),
                                    F.min(F.struct((-F.col("count")).alias("less"), "other")).alias("best"))
    words = reread(vocabulary)
    forms = words.join(best.hint("merge"), "word", "left").select(
        "word", "n", F.coalesce("near", F.lit(0)).cast("long").alias("n_near"),
        F.col("best.other").alias("other"), (-F.col("best.less")).alias("most"))
    led = F.coalesce(F.col("most") >= lead * F.col("n"), F.lit(False))
    forms = write_stage(forms.select("word", F.when(led, F.col("other")).alias("form"), "n", "n_near",
                                     F.when(led, F.col("most")).alias("form_n")), "forms")
    drop_stage(pairs, vocabulary)
    ends = roots(forms)
    return reread(forms).join(ends.hint("merge"), "word").select("word", "form", "root", "n", "n_near", "form_n")
