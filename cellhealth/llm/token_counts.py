"""Word-piece token counts by a linear longest-match automaton.

A trie of the vocabulary gets failure links: where no edge fits, the link gives the node
reached after the longest pieces that can be split off, and a precomputed count says how
many pieces those are.  One pass over a word's bytes then gives the number of greedy
longest-match pieces without building any.  A word is read with ``prefix`` before it; its
first piece is of ``initial``, further ones of ``following``.  A word that cannot be split
counts as one unknown piece.

Defined cases: null and empty texts have no words and no pieces; words are runs without ASCII
white space, case as it is; very long words are read whole; repeated rows are counted alike;
an empty table gives no rows; further columns of the input are ignored.
"""

from __future__ import annotations

import json
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellhealth.llm.common import blocks, prepare, raw_text

#: Words whose counts a Python worker remembers; beyond it the memory is emptied.
REMEMBERED = 300_000


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_vocabulary(path: str) -> list[bytes]:
    """The pieces of a byte-level vocabulary file, without special tokens."""
    with open(path, encoding="utf-8") as f:
        stated = json.load(f)
    alphabet = byte_alphabet()
    special = {t["content"] for t in stated.get("added_tokens", [])}
    return [bytes(alphabet[c] for c in t) for t in stated["model"]["vocab"] if t not in special]


class Automaton:
    """Trie edges (node * 256 + byte), failure links (-1: none) and popped-piece counts."""

    def __init__(self, initial: list[bytes], following: list[bytes], prefix: bytes = b""):
        self.prefix, self.edges, self.fail, self.pops = prefix, {}, [-1, -1], [0, 0]
        whole: set[int] = set()
        for root, pieces in ((0, initial), (1, following)):
            for piece in pieces:
                node = root
                for byte in piece:
                    key = node << 8 | byte
                    if key not in self.edges:
                        self.edges[key] = len(self.fail)
                        self.fail.append(-1)
                        self.pops.append(0)
                    node = self.edges[key]
                if node > 1:
                    whole.add(node)
        below: dict[int, list[tuple[int, int]]] = {}
        for key, child in self.edges.items():
            below.setdefault(key >> 8, []).append((key & 255, child))
        level = [0, 1]
        while level:  # by depth: a link depends on shorter strings only
            after = []
            for parent in level:
                for byte, node in below.get(parent, ()):
                    after.append(node)
                    if node in whole:
                        self.fail[node], self.pops[node] = 1, 1
                        continue
                    at, popped = self.fail[parent], self.pops[parent]
                    while at >= 0 and (at << 8 | byte) not in self.edges:
                        popped += self.pops[at]
                        at = self.fail[at]
                    if at >= 0:
                        self.fail[node], self.pops[node] = self.edges[at << 8 | byte], popped
            level = after

    def __getstate__(self):  # arrays travel smaller than a dictionary
        return (self.prefix, np.fromiter(self.edges.keys(), np.int64), np.fromiter(self.edges.values(), np.int32),
                np.array(self.fail, np.int32), np.array(self.pops, np.int16))

    def __setstate__(self, state):
        self.prefix, keys, values, fail, pops = state
        self.edges = dict(zip(keys.tolist(), values.tolist(), strict=True))
        self.fail, self.pops = fail.tolist(), pops.tolist()

    def count(self, word: bytes) -> int:
        """The number of pieces; 0 for a word that has no split."""
        edges, fail, pops, node, n = self.edges, self.fail, self.pops, 0, 0
        for byte in self.prefix + word:
            while (child := edges.get(node << 8 | byte)) is None:
                if fail[node] < 0:
                    return 0
                n += pops[node]
                node = fail[node]
            node = child
        while node != 1:
            if fail[node] < 0:
                return 0
            n += pops[node]
            node = fail[node]
        return n


def token_counts(docs: DataFrame, vocabulary: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_pieces (an unknown word is one), n_unknown.

    ``vocabulary``: path of a byte-level vocabulary file on the driver; pieces that begin
    with a space start words.  The automaton is broadcast: its size is the vocabulary's.
    """
    prepare(docs, text, doc_id)
    pieces = byte_vocabulary(vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast(Automaton(
        [p for p in pieces if p[:1] == b" "], [p for p in pieces if p[:1] != b" "], b" "))

    def rows(batches):
        automaton, known = shared.value, {}
        for rest, raws in blocks(batches, "raw", 8 << 20):
            out = []
            for raw in raws:
                n = pieces = unknown = 0
                for word, times in Counter(raw.split()).items():
                    of = known.get(word)
                    if of is None:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        of = known[word] = automaton.count(word)
                    n += times
                    pieces += times * (of or 1)
                    unknown += times * (not of)
                out.append((n, pieces, unknown))
            got = np.array(out, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([rest["doc_id"], *[pa.array(got[:, k]) for k in range(3)]],
                                             names=["doc_id", "n_words", "n_pieces", "n_unknown"])

    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), raw_text(text).alias("raw"))
            .mapInArrow(rows, "doc_id long, n_words long, n_pieces long, n_unknown long"))
