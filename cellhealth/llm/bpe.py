"""Byte-level BPE by a streaming transducer with bounded lookahead, and its decoder.

Encoding.  For every prefix of a piece exactly one vocabulary token can end the encoding of
that prefix: the one whose neighbour to the left, the last token of the shorter prefix, stays
apart from it when the two are merged on their own.  The transducer stores, per byte, how far
back that last token reaches.  No token is longer than the lookahead that the merge list
gives (``sufficient_lookahead``), so whatever bytes follow, the final encoding passes through
one of the last ``lookahead`` prefixes.  Tokens before the point where the backward paths of
all these prefixes join are stable and are emitted; only the bytes after it are held.

Decoding.  Token bytes run through an incremental UTF-8 state machine that carries an
incomplete character from one token to the next and writes U+FFFD for invalid bytes.

A text is read in windows: pieces are cut from one window after another, and the pieces at a
window's end, which what follows may change, are cut again with the next.  Ids go to the
digest and to the decoder window by window, so beside the row's own text memory is constant.

Defined cases: null and empty texts have no tokens and decode to the empty text; the string
of a special token in a text is that token; very long pieces go through the transducer in
parts; bytes that are no UTF-8 count as U+FFFD; repeated rows are encoded alike; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from array import array
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellhealth.llm.common import blocks, prepare, raw_text
from cellhealth.llm.token_counts import byte_alphabet

#: Fixed value: how byte-level files of this family cut a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces and neighbour tests a Python worker remembers; beyond it the oldest go.
REMEMBERED_PIECES, REMEMBERED_PAIRS = 400_000, 400_000
#: Characters of a window, and those at its end whose pieces may change with what follows
#: (the longest fixed alternative of PIECES has three; a white-space run looks one further).
WINDOW, OPEN = 1 << 16, 4


class Vocabulary:
    """A byte-level vocabulary file: token bytes, merge ranks and special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            stated = json.load(f)
        model, added = stated["model"], stated.get("added_tokens", [])
        if stated.get("normalizer") or any(model.get(k) for k in (
                "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback")):
            raise ValueError("a plain byte-level BPE file is needed")
        alphabet = byte_alphabet()
        self.special = {t["content"]: t["id"] for t in added}
        self.ids = {bytes(alphabet[c] for c in t): i for t, i in model["vocab"].items() if t not in self.special}
        self.bytes: list[bytes] = [b""] * (1 + max([*self.ids.values(), *self.special.values()]))
        for token, i in self.ids.items():
            self.bytes[i] = token
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(bytes(alphabet[c] for c in a), bytes(alphabet[c] for c in b)): rank
                      for rank, (a, b) in enumerate(merges)}


def sufficient_lookahead(merges: Iterable[tuple[bytes, bytes]]) -> int:
    """Bytes that decide: the length of the longest token that the merge list can make."""
    return max((len(a) + len(b) for a, b in merges), default=1)


def merged(parts: list[bytes], ranks: dict) -> list[bytes]:
    """BPE as defined: the lowest-ranked neighbours first, the leftmost of equals."""
    parts = list(parts)
    while len(parts) > 1:
        rank, at = min((ranks.get(pair, 1 << 60), i) for i, pair in enumerate(zip(parts, parts[1:], strict=False)))
        if rank == 1 << 60:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Recent:
    """A bounded memory: when the young half is full it becomes the old half."""

    def __init__(self, bound: int):
        self.half, self.young, self.old = bound // 2, {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.half:
            self.old, self.young = self.young, {}
        self.young[key] = value


class Transducer:
    """Encodes one piece after another to ids; ``feed`` bytes, take what is stable, then ``end``."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.ids, self.sizes = vocabulary, vocabulary.ids, [len(t) for t in vocabulary.bytes]
        self.lookahead = sufficient_lookahead(vocabulary.ranks)
        ids = vocabulary.ids
        self.ranks = {ids[a] << 20 | ids[b]: rank for (a, b), rank in vocabulary.ranks.items()}
        made = {a + b: (rank, a, b) for (a, b), rank in reversed(vocabulary.ranks.items())}
        if any(made.get(part, (-1,))[0] >= rank for rank, *parts in made.values() for part in parts):
            raise ValueError("a merge must come after the merges that make its parts")
        self.right = {ids[t]: self._edge(t, made, 2) for t in ids}
        self.left = {ids[t]: self._edge(t, made, 1) for t in ids}
        self.apart = Recent(REMEMBERED_PAIRS)
        automaton = ahocorasick.Automaton()
        for token, i in ids.items():
            automaton.add_word(token.decode("latin-1"), i)
        automaton.make_automaton()
        self.scan = automaton.iter("")
        self.reset()

    def _edge(self, token: bytes, made: dict, side: int) -> list[tuple[int, int]]:
        """The tokens at one edge while the token is merged, each with the rank that ends it."""
        edge, ends = [], 1 << 60
        while True:
            edge.append((self.ids[token], ends))
            if token not in made:
                return edge
            ends, token = made[token][0], made[token][side]

    def _stay_apart(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right``, merged on their own bytes, come out as they are.

        Merges run by rank, the leftmost of equals first: they stay apart unless the tokens
        that meet at their border merge before one of them grows into its own side.
        """
        ranks = self.ranks
        for a, a_ends in self.right[left]:
            for b, b_ends in self.left[right]:
                rank = ranks.get(a << 20 | b)
                if rank is not None and rank < a_ends and rank <= b_ends:
                    return False
        return True

    def reset(self) -> None:
        self.held, self.begun = b"", False  #: bytes after the last stable boundary
        self.last = [-1]  #: last[i]: the last token of the first i held bytes; at 0 the one before them
        self.gone = 0  #: bytes of the piece before the held ones

    def feed(self, data: bytes) -> Iterator[int]:
        """Take bytes of the piece; yield the tokens that nothing later can change."""
        window, sizes, longest, recent = 4 * self.lookahead, self.sizes, self.lookahead, self.apart
        for i in range(0, len(data), window):
            part = data[i:i + window]
            self.held += part
            self.scan.set(part.decode("latin-1"), not self.begun)
            self.begun, last, shift = True, self.last, 1 - self.gone
            for end, token in self.scan:  # each vocabulary token that ends here, byte after byte
                end += shift
                if end < len(last):
                    continue
                left = last[end - sizes[token]]
                if left < 0:
                    fits = self._own(token)
                else:
                    key = left << 20 | token
                    fits = recent.young.get(key)
                    if fits is None:
                        fits = recent.get(key)
                        if fits is None:
                            fits = self._stay_apart(left, token)
                            recent.put(key, fits)
                if fits:
                    last.append(token)
            if len(last) <= len(self.held):
                raise ValueError(f"no token ends at {self.held[:len(last)]!r}")
            if len(self.held) >= 2 * window:
                live = set(range(len(self.held) - longest + 1, len(self.held) + 1))
                while len(live) > 1:  # step the furthest prefix back until all paths are one
                    at = max(live)
                    live.remove(at)
                    live.add(at - sizes[last[at]])
                yield from self._emit(live.pop())

    def _own(self, token: int) -> bool:
        """Whether the token's own bytes merge into it."""
        known = self.apart.get(-1 - token)
        if known is None:
            raw = self.vocabulary.bytes[token]
            known = merged([raw[i:i + 1] for i in range(len(raw))], self.vocabulary.ranks) == [raw]
            self.apart.put(-1 - token, known)
        return known

    def _emit(self, end: int) -> Iterator[int]:
        tokens, at = [], end
        while at:
            tokens.append(self.last[at])
            at -= self.sizes[self.last[at]]
        self.held, self.last, self.gone = self.held[end:], self.last[end:], self.gone + end
        yield from reversed(tokens)

    def end(self) -> Iterator[int]:
        tokens = list(self._emit(len(self.held)))
        self.reset()
        yield from tokens


class Encoder:
    """Texts to ids, packed as little-endian unsigned 32-bit integers."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.transducer = vocabulary, Transducer(vocabulary)
        self.pieces = regex.compile(PIECES.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.special = (regex.compile("|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True))))
                        if vocabulary.special else None)
        self.known = Recent(REMEMBERED_PIECES)

    def _piece(self, piece: str) -> bytes:
        raw, stream = piece.encode(), self.transducer
        packed = array("I", [*stream.feed(raw), *stream.end()]).tobytes()
        if len(raw) <= 64:
            self.known.put(piece, packed)
        return packed

    def _run(self, text: str, start: int, end: int) -> int:
        """Where the piece that begins at ``start`` ends; the window doubles until it holds the piece."""
        size = WINDOW
        while True:
            stop = min(end, start + size)
            found = self.pieces.match(text, start, stop).end()
            if stop == end or found <= stop - OPEN:
                return found
            size *= 2

    def _plain(self, text: str, start: int, end: int) -> Iterator[bytes]:
        """The packed ids of ``text[start:end]``, a window or a part of a long piece at a time."""
        get, own, young = self.known.get, self._piece, self.known
        while start < end:
            stop = min(end, start + WINDOW)
            pieces = self.pieces.findall(text, start, stop)
            if stop < end:  # the pieces fill the window: those that reach its last characters are left
                left = 0
                while pieces and left < OPEN:
                    left += len(pieces.pop())
                stop -= left
            if pieces:
                yield b"".join([young.young.get(p) or get(p) or own(p) for p in pieces])
                start = stop
                continue
            stop, stream = self._run(text, start, end), self.transducer
            for i in range(start, stop, WINDOW):
                yield array("I", stream.feed(text[i:min(stop, i + WINDOW)].encode())).tobytes()
            yield array("I", stream.end()).tobytes()
            start = stop

    def stream(self, text: str) -> Iterator[bytes]:
        """The packed ids of ``text``, part after part."""
        at = 0
        if self.special:
            for match in self.special.finditer(text):
                yield from self._plain(text, at, match.start())
                yield self.vocabulary.special[match[0]].to_bytes(4, "little")
                at = match.end()
        yield from self._plain(text, at, len(text))

    def encode(self, text: str) -> bytes:
        return b"".join(self.stream(text))


class Decoder:
    """Ids to text: an incremental byte-to-text state machine between calls."""

    def __init__(self, vocabulary: Vocabulary):
        self.table = vocabulary.bytes
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: np.ndarray) -> str:
        return self.state.decode(b"".join(map(self.table.__getitem__, ids.tolist())))

    def end(self) -> str:
        rest = self.state.decode(b"", final=True)
        self.state.reset()
        return rest

    def decode(self, packed: bytes, step: int = 1 << 16) -> Iterator[str]:
        """The text of packed ids, a part at a time."""
        ids = np.frombuffer(packed, "<u4")
        for i in range(0, len(ids), step):
            yield self.feed(ids[i:i + step])
        yield self.end()


_WORKER: dict = {}


def _tools(shared) -> tuple[Encoder, Decoder]:
    """One encoder per Python worker: its memory of pieces serves all its tasks."""
    if _WORKER.get("id") != shared.id:
        _WORKER.update(id=shared.id, tools=(Encoder(shared.value), Decoder(shared.value)))
    return _WORKER["tools"]


class _Shared:
    """A broadcast vocabulary, told apart from others of the same worker."""

    def __init__(self, spark, path: str):
        self.broadcast, self.id = spark.sparkContext.broadcast(Vocabulary(path)), path

    @property
    def value(self) -> Vocabulary:
        return self.broadcast.value


def encode_documents(docs: DataFrame, vocabulary: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id and ids (packed little-endian unsigned 32-bit integers)."""
    prepare(docs, text, doc_id)
    shared = _Shared(docs.sparkSession, vocabulary)

    def rows(batches):
        encoder, _ = _tools(shared)
        for rest, raws in blocks(batches, "raw", 4 << 20):
            yield pa.RecordBatch.from_arrays(
                [rest["doc_id"], pa.array([encoder.encode(r.decode(errors="replace")) for r in raws], pa.binary())],
                names=["doc_id", "ids"])

    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), raw_text(text).alias("raw"))
            .mapInArrow(rows, "doc_id long, ids binary"))


def round_trip(docs: DataFrame, vocabulary: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    prepare(docs, text, doc_id)
    shared = _Shared(docs.sparkSession, vocabulary)

    def rows(batches):
        encoder, decoder = _tools(shared)
        for rest, raws in blocks(batches, "raw", 4 << 20):
            out = []
            for raw in raws:
                n_bytes, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()
                for packed in encoder.stream(raw.decode(errors="replace")):
                    n_bytes += len(packed)
                    ids.update(packed)
                    decoded.update(decoder.feed(np.frombuffer(packed, "<u4")).encode())
                decoded.update(decoder.end().encode())
                out.append((n_bytes // 4, ids.hexdigest(), decoded.hexdigest()))
            n, ids, decoded = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([rest["doc_id"], pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded)],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), raw_text(text).alias("raw"))
            .mapInArrow(rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))
