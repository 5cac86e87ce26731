"""Removal of long repeated strings with run-length compressed suffix indexes.

A byte goes when a string of ``LENGTH`` bytes that covers it starts anywhere else too, in the
same text or another.  Texts are UTF-8 bytes; strings do not cross texts.

No index of the whole corpus is ever in one place.  Every window of LENGTH bytes names an
anchor, its ``GRAM`` bytes of least hash, so equal windows name equal anchors at equal
offsets.  Runs of windows with one anchor (spans) are counted by anchor and by content, summed
before the shuffle.  A span whose whole content repeats is repeated in all its windows.  What
is left, one span of each content whose anchor also occurs with another content, may share
some windows: these spans meet by anchor, and a block of such groups gets an index:

* the Burrows-Wheeler transform of the block's spans, cut into runs of equal letters;
* suffix-array samples at the ends of the runs, and the match lengths with the neighbours there;
* matching statistics streamed over the block: between samples the longest match with another
  suffix shrinks by one per byte, so the samples give it for every byte.

Windows whose statistic is LENGTH or more are marked.  A group larger than ``GROUP`` is first
split by the bytes that the windows in the left or right half of its range share, again and
again; parts of one member vanish, and parts that a single window is left of are equal in it.
So no group is held in one task, however many texts share a passage.

Defined cases: null text is empty; texts shorter than LENGTH lose nothing; texts are read
whole, long ones in overlapping parts; a null doc_id is kept as it is; repeated rows lose all
windows; overlaps count; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellhealth.llm.common import (blocks, drop_stage, join_groups, numbered_columns, prepare, raw_text,
                                   reread, write_stage)

LENGTH, GRAM = 200, 64
#: Windows of a part of a long text; bytes handled at once; spans of a group; bytes of an index.
PART, AT_ONCE, GROUP, INDEX_BYTES = 1 << 20, 1 << 20, 1000, 1 << 18
_ODD = 0x9E3779B97F4A7C15
_PLACE = 22  #: low bits of a hash that give way to its position: parts stay below 4 MB


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random letters, and powers of the base and of its inverse, modulo 2**64."""
    letters = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = []
    for base in (_ODD, pow(_ODD, -1, 1 << 64)):
        power, done, step = np.ones(n, np.uint64), 1, base
        while done < n:
            more = min(done, n - done)
            power[done:done + more] = power[:more] * np.uint64(step)
            done, step = done + more, step * step % (1 << 64)
        out.append(power)
    return letters, out[0], out[1]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def spans(parts: list[tuple[int, int, bytes]], length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Runs of windows with one anchor, for parts (row, offset, bytes) of texts.

    a: the anchor's hash; g: the span's; s: its first window in the text; n: its further
    windows; d: the anchor's distance from its first window.
    """
    sizes = np.array([len(p[2]) for p in parts], np.int64)
    ends = np.cumsum(sizes)
    buffer = np.frombuffer(b"".join(p[2] for p in parts), np.uint8)
    none = {k: np.zeros(0, np.int64) for k in ("a", "g", "row", "s", "n", "d")}
    if len(buffer) < length:
        return none
    letters, power, inverse = _powers(max(1 << 21, 1 << int(len(buffer)).bit_length()))
    prefix = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(letters[buffer] * power[:len(buffer)], out=prefix[1:])
    hashes = _mix((prefix[gram:] - prefix[:-gram]) * inverse[:len(buffer) - gram + 1])
    low, width, reach = np.uint64(_PLACE), length - gram + 1, 1
    least = hashes >> low << low | np.arange(len(hashes), dtype=np.uint64)
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[:reach - width], least[width - reach:])
    starts = np.concatenate([np.arange(b - z, max(b - z, b - length + 1)) for b, z in zip(ends, sizes, strict=True)])
    if not len(starts):
        return none
    anchors = (least[starts] & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (np.diff(anchors) != 0) | (np.diff(starts) != 1))))
    first, last = starts[new], starts[np.concatenate((new[1:], [len(starts)])) - 1]
    part = np.searchsorted(ends, first, side="right")
    begin = (ends - sizes)[part]
    of = np.array([p[0] for p in parts], np.int64)[part]
    offset = np.array([p[1] for p in parts], np.int64)[part]
    content = (prefix[last + length] - prefix[first]) * inverse[first] + (last - first).astype(np.uint64) * np.uint64(_ODD)
    return {"a": hashes[anchors[new]].view(np.int64), "g": _mix(content).view(np.int64), "row": of,
            "s": first - begin + offset, "n": last - first, "d": anchors[new] - first}


def _parts(row: int, raw: bytes, length: int):
    """A text as overlapping parts: every window in exactly one."""
    for i in range(0, max(1, len(raw) - length + 1), PART):
        yield row, i, raw[i:i + PART + length - 1]


def _ranks(text: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Suffix array by prefix doubling, and the ranks by the first k letters for each k on the way."""
    n = len(text)
    low = np.concatenate((np.minimum(text, 255), np.zeros(8, np.int64))).astype(np.uint64)
    key, clean = np.zeros(n, np.uint64), np.ones(n, bool)
    for i in range(8):  # what follows a separator does not count: separators differ, in order of place
        key = key << np.uint64(8) | np.where(clean, low[i:n + i], 0)
        clean &= low[i:n + i] != 255
    array = np.argsort(key)
    ends = np.flatnonzero(~clean[array])  # keys with a separator equal only their like: order by place
    array[ends] = array[ends][np.lexsort((array[ends], key[array[ends]]))]
    sorted_key, sorted_clean = key[array], clean[array]
    change = np.concatenate(([True], (np.diff(sorted_key) != 0) | ~sorted_clean[1:] | ~sorted_clean[:-1]))
    levels, k = [], 8
    while True:
        group = np.maximum.accumulate(np.where(change, np.arange(n), 0))
        rank = np.empty(n + 1, np.int64)
        rank[array], rank[n] = group, -1
        levels.append((k, rank))
        tied = np.flatnonzero(~change | ~np.concatenate((change[1:], [True])))
        if not len(tied):
            return array, levels
        own = array[tied]
        pair = rank[own] * (n + 2) + rank[np.minimum(own + k, n)] + 1
        order = np.argsort(pair)
        array[tied] = own[order]
        pair = pair[order]
        change[tied] = np.concatenate(([True], pair[1:] != pair[:-1]))
        k *= 2


class RunLengthIndex:
    """Run-compressed transform of a few strings, with samples at the ends of its runs."""

    def __init__(self, strings: list[bytes]):
        sizes = np.array([len(s) + 1 for s in strings], np.int64)
        self.starts = np.cumsum(sizes) - sizes
        text = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.int64)
        # letters below 255 as they are (UTF-8 has no byte 255); each string's end is a letter of its own
        text[self.starts + sizes - 1] = 255 + np.arange(len(strings))
        self.text, n = text, len(text)
        array, levels = _ranks(text)
        transform = text[array - 1]
        heads = np.flatnonzero(np.concatenate(([True], transform[1:] != transform[:-1])))
        tails = np.concatenate((heads[1:] - 1, [n - 1]))
        self.runs = len(heads)
        # samples: text positions at run ends with the match length to the suffix beyond the run
        self.samples = []
        for at, step in ((heads, -1), (tails, 1)):
            inner = at[(at + step >= 0) & (at + step < n)]
            edge = at[(at + step < 0) | (at + step >= n)]
            own = np.concatenate((array[inner], array[edge]))
            match = np.concatenate((self._common(array[inner], array[inner + step], levels), np.zeros(len(edge), np.int64)))
            self.samples.append((own, match))

    def _common(self, x: np.ndarray, y: np.ndarray, levels) -> np.ndarray:
        """Length of the common prefix of suffixes, by the ranks of halving lengths."""
        n, done = len(self.text), np.zeros(len(x), np.int64)
        for k, rank in reversed(levels):
            # equal ranks: equal in k letters; a suffix that ends in its separator has a rank of its own
            same = rank[np.minimum(x + done, n)] == rank[np.minimum(y + done, n)]
            done += np.where(same & (x + done < n) & (y + done < n), k, 0)
        for _ in range(7):
            a, b = x + done, y + done
            done += (self.text[np.minimum(a, n - 1)] == self.text[np.minimum(b, n - 1)]) & (a < n) & (b < n) & (a != b)
        return done

    def statistics(self) -> np.ndarray:
        """For every position: the longest match of its suffix with any other suffix."""
        n, best = len(self.text), None
        for own, match in self.samples:
            length = np.full(n, -1, np.int64)
            length[own] = match
            last = np.maximum.accumulate(np.where(length >= 0, np.arange(n), 0))
            streamed = np.maximum(length[last], 0) - (np.arange(n) - last)
            best = streamed if best is None else np.maximum(best, streamed)
        return best


def repeated_windows(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each string the starts of windows that occur anywhere else among the strings."""
    index = RunLengthIndex(strings)
    found = index.statistics() >= length
    return [np.flatnonzero(found[a:a + len(s)]) for a, s in zip(index.starts, strings, strict=True)]


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """Runs of consecutive numbers as (first, last)."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) != 1)
    return list(zip(starts[np.concatenate(([0], cut + 1))].tolist(),
                    starts[np.concatenate((cut, [len(starts) - 1]))].tolist(), strict=True))


def _intervals(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    got = np.array(rows, np.int64).reshape(-1, 3)
    return pa.RecordBatch.from_arrays([pa.array(got[:, i]) for i in range(3)], names=["row", "lo", "hi"])


_MEMBER = "key binary, lo int, hi int, row long, s long, n int, d int, content binary"
_SCHEMA = pa.schema([("key", pa.binary()), ("lo", pa.int32()), ("hi", pa.int32()), ("row", pa.int64()),
                     ("s", pa.int64()), ("n", pa.int32()), ("d", pa.int32()), ("content", pa.binary())])


def _resolve(members: DataFrame, length: int, gram: int) -> list[DataFrame]:
    """Written tables of repeated byte ranges (row, lo, hi) of the members of anchor groups.

    A member stands for its windows whose anchor is ``lo`` to ``hi`` bytes in.
    """
    def index(batches):
        held: list[tuple] = []

        def found(rows):
            if len(rows) > 1:
                marked = repeated_windows([r[2] for r in rows], length)
                out = [(r[0], r[1] + a, r[1] + b + length)
                       for r, starts in zip(rows, marked, strict=True) for a, b in _runs(starts)]
                if out:
                    yield _intervals(out)

        last, size, group = None, 0, 0
        for batch in batches:  # sorted by key; a block ends between groups
            for key, row, s, content in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if key != last:
                    last, group = key, len(held)
                    if size >= INDEX_BYTES:
                        yield from found(held)
                        held, size, group = [], 0, 0
                held.append((row, s, content))
                size += len(content)
        yield from found(held)

    def halves(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                middle = (r["lo"] + r["hi"]) // 2
                for lo, hi in ((r["lo"], middle), (middle + 1, r["hi"])):
                    # windows of this member in the half: their first bytes are s .. s + n, the anchor at s + d
                    a, b = max(0, r["d"] - hi), min(r["n"], r["d"] - lo)
                    if a > b:
                        continue
                    shared = r["content"][r["d"] - lo:r["d"] - hi + length]
                    key = hashlib.blake2b(r["key"] + bytes([lo, hi]) + shared, digest_size=16).digest()
                    out.append({"key": key, "lo": lo, "hi": hi, "row": r["row"], "s": r["s"] + a, "n": b - a,
                                "d": r["d"] - a, "content": r["content"][a:b + length]})
            if out:
                yield pa.RecordBatch.from_pylist(out, _SCHEMA)

    results = []
    while True:
        sizes = write_stage(members.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), "sizes")
        sized = write_stage(join_groups(members, sizes, "key", "size", "row").filter("size > 1"), "sized")
        shards = 1 + (sized.agg(F.sum(F.length("content"))).first()[0] or 0) // (8 << 20)
        small = (sized.filter(F.col("size") <= GROUP).select("key", "row", "s", "content")
                 .repartition(shards, "key").sortWithinPartitions("key"))
        results.append(write_stage(small.mapInArrow(index, "row long, lo long, hi long"), "matched"))
        large = sized.filter(F.col("size") > GROUP)
        if not large.limit(1).count():
            drop_stage(sizes, sized)
            return results
        # one window left: all members of the part are equal in it
        results.append(write_stage(large.filter("lo = hi").select(
            "row", F.col("s").alias("lo"), (F.col("s") + length).alias("hi")), "equal"))
        split = write_stage(large.filter("lo < hi").drop("size").mapInArrow(halves, _MEMBER), "halves")
        drop_stage(members, sizes, sized)
        members = split


def repeated_ranges(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> list[DataFrame]:
    """Written tables (row, lo, hi) that cover every repeated byte of written ``texts`` (row, raw)."""
    if not 0 < gram <= length or length - gram > 254:
        raise ValueError("an anchor lies within the string, at most 254 bytes shorter")

    def cut(batches):
        def rows(parts):
            got = spans(parts, length, gram)
            return pa.RecordBatch.from_arrays(
                [pa.array(got["a"]), pa.array(got["g"]), pa.array(got["row"]), pa.array(got["s"]),
                 pa.array(got["n"].astype(np.int32)), pa.array(got["d"].astype(np.int32))],
                names=["a", "g", "row", "s", "n", "d"])

        for rest, raws in blocks(batches, "raw", 8 << 20):
            held, size = [], 0
            for row, raw in zip(rest["row"].to_pylist(), raws, strict=True):
                if len(raw) < length:
                    continue
                for part in _parts(row, raw, length):
                    held.append(part)
                    size += len(part[2])
                    if size >= AT_ONCE:
                        yield rows(held)
                        held, size = [], 0
            if held:
                yield rows(held)

    found = write_stage(texts.select("row", "raw").mapInArrow(
        cut, "a long, g long, row long, s long, n int, d int"), "spans")
    often = write_stage(found.groupBy("a").agg(F.count("*").alias("of")).filter("of > 1"), "anchors")
    marks = write_stage(join_groups(found, often, "a", "of", "row").filter("of > 1").drop("of"), "marks")
    drop_stage(found, often)
    # one member of each content; alone: its content occurs once
    classes = write_stage(marks.groupBy("a", "g").agg(
        F.count("*").alias("copies"), F.min(F.struct("row", "s", "n", "d")).alias("m"))
        .select("a", "copies", "m.*"), "classes")
    whole = write_stage(marks.join(reread(classes).filter("copies = 1").select("row", "s"), ["row", "s"], "left_anti")
                        .select("row", F.col("s").alias("lo"), (F.col("s") + F.col("n") + length).alias("hi")), "whole")
    drop_stage(marks)
    kinds = write_stage(classes.groupBy("a").agg(F.count("*").alias("kinds")).filter("kinds > 1"), "kinds")
    mixed = join_groups(classes, kinds, "a", "kinds", "row").filter("kinds > 1")
    asked = mixed.groupBy("row").agg(F.collect_list(F.struct("a", "s", "n", "d")).alias("asked"))

    def contents(batches):
        for batch in batches:
            for row, raw, asked in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                out = [{"key": x["a"].to_bytes(8, "little", signed=True), "lo": 0, "hi": length - gram, "row": row,
                        "s": x["s"], "n": x["n"], "d": x["d"], "content": raw[x["s"]:x["s"] + x["n"] + length]}
                       for x in asked]
                yield pa.RecordBatch.from_pylist(out, _SCHEMA)

    members = write_stage(texts.select("row", "raw").join(asked.hint("shuffle_hash"), "row")
                          .select("row", "raw", "asked").mapInArrow(contents, _MEMBER), "members")
    drop_stage(classes, kinds)
    return [whole, *_resolve(members, length, gram)]


def _union(ranges) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching ranges."""
    out: list[list[int]] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def kept_bytes(raw: bytes, removed: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for lo, hi in removed:
        out.append(raw[at:lo])
        at = hi
    return b"".join(out + [raw[at:]])


def _with_ranges(texts: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """``texts`` with all ranges of each row; only ranges are gathered, a row's own."""
    ranges = tables[0]
    for t in tables[1:]:
        ranges = ranges.unionByName(t)
    ranges = ranges.groupBy("row").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    return texts.join(ranges.hint("shuffle_hash"), "row", "left")


def remove_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    prepare(docs, text, doc_id)
    texts = write_stage(docs.select(F.monotonically_increasing_id().alias("row"),
                                    F.col(doc_id).cast("long").alias("doc_id"), raw_text(text).alias("raw")), "texts")

    def judged(batches):
        for batch in batches:
            out = []
            for doc, raw, ranges in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                removed = _union((r["lo"], r["hi"]) for r in ranges or ())
                out.append((doc, len(raw), sum(b - a for a, b in removed), len(removed),
                            hashlib.sha256(kept_bytes(raw, removed)).hexdigest()))
            cols = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c, pa.int64()) for c in cols[:4]], pa.array(cols[4], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return (_with_ranges(reread(texts), repeated_ranges(texts, length)).select("doc_id", "raw", "ranges")
            .mapInArrow(judged, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))


def drop_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with repeated strings cut out of the text; all rows and columns stay.

    A character that loses some of its bytes goes; ``n_chars``, if there is such a column, is
    counted anew.
    """
    prepare(docs, text)
    own = numbered_columns(docs)
    whole = write_stage(own.withColumn("row", F.monotonically_increasing_id()), "documents")
    texts = whole.select("row", raw_text(f"c{docs.columns.index(text)}").alias("raw"))
    tables = repeated_ranges(texts, length)
    at, count = docs.columns.index(text), docs.columns.index(n_chars) if n_chars in docs.columns else -1
    schema = docs.schema

    def cut(batches):
        for batch in batches:
            ranges = batch.column(batch.num_columns - 1).to_pylist()
            raws = batch.column(at).cast(pa.binary()).to_pylist()
            out = [raw if raw is None or not r else
                   kept_bytes(raw, _union((x["lo"], x["hi"]) for x in r))
                   for raw, r in zip(raws, ranges, strict=True)]
            out = [None if x is None else x.decode("utf-8", "ignore") for x in out]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns[at] = pa.array(out, columns[at].type)
            if count >= 0:
                columns[count] = pa.array([len(x) if r and x is not None else old for x, r, old in zip(
                    out, ranges, columns[count].to_pylist(), strict=True)], columns[count].type)
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return _with_ranges(reread(whole), tables).select(*own.columns, "ranges").mapInArrow(cut, schema)
