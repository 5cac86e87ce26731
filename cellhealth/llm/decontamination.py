"""Benchmark decontamination by winnowing, in DataFrame functions only.

Of the hashes of all k-word grams in every window of consecutive grams the least is kept as a
fingerprint, in documents and in benchmark items alike.  A window has as many grams as a span of
``span`` words holds, so any shared span of that many words has its least gram kept on both sides:
no shared span is missed.  The fingerprints are joined; around a gram that met, every span of
``span`` words that holds it is cut out of the document and joined to the item spans by all its
words, which extends the hit and rules out chance.  An item of fewer words is one shorter span; each
such length present (there are fewer than ``span``) is winnowed by itself.

A document is one row throughout; it passes once over its words.  A bit table of
the items' fingerprints, of ``TABLE`` bits at most however many there are, first leaves out documents
that share none; those left (a few more than need be) are written with their words, in a table whose
rows are numbered.  Spans of documents are joined to spans of items as they are (no pair of spans
is formed but where all words agree): the items' side is broadcast if it has at most
``BROADCAST_ROWS`` rows, else hot spans go apart (``join_groups``).  Spans of the same items are
one class, and the items' digest is worked out once for each distinct set of classes.

Defined cases: a null text has no words; an item without words matches nothing; an item_id that
repeats is one item with the spans of all its rows; a null item_id counts as one item whose id
reads as empty; null or repeated doc_ids keep their rows; empty tables give no rows or, without
items, clean documents; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellhealth.llm.common import LOWER, UPPER, drop_stage, join_groups, prepare, reread, write_stage

#: Item spans that are broadcast: up to so many rows of about 100 bytes.
BROADCAST_ROWS = 200_000
#: Most bits of the table of fingerprints that documents are held against first; bits set by each.
TABLE, PROBES = 1 << 21, 3
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str | Column) -> Column:
    """Words of a text, A-Z lowered; none for null."""
    t = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    # ``lower`` knows more capitals than A-Z, so it only serves texts that have no others.
    low = F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))
    return F.filter(F.split(low, SEPARATORS), lambda w: w != "")


def gram(length: int) -> int:
    """Words of a gram for spans of ``length`` words: half, so that grams are few and telling."""
    return (length + 1) // 2


def grams(words: str, k: int) -> Column:
    """The hash of the k words from each position on."""
    w = F.col(words)
    whole = F.slice(w, 1, F.greatest(F.size(w) - (k - 1), F.lit(0)))
    return F.transform(whole, lambda x, i: F.xxhash64(x, *[F.get(w, i + j) for j in range(1, k)]))


def least(hashes: str, windows: int) -> Column:
    """Winnowing: the least hash of each window of ``windows`` grams, each value once."""
    h = F.col(hashes)
    if windows == 1:
        return F.array_distinct(h)
    whole = F.slice(h, 1, F.greatest(F.size(h) - (windows - 1), F.lit(0)))
    return F.array_distinct(F.transform(whole, lambda x, i: F.least(x, *[F.get(h, i + j) for j in range(1, windows)])))


def with_prints(rows: DataFrame, lengths: list[int], words: str = "words") -> DataFrame:
    """``rows`` with h{m} (gram hashes) and f{m} (fingerprints) for spans of each of ``lengths`` words."""
    rows = rows.withColumns({f"h{m}": grams(words, gram(m)) for m in lengths})
    return rows.withColumns({f"f{m}": least(f"h{m}", m - gram(m) + 1) for m in lengths})


def _probes(x: Column, bits: int) -> list[Column]:
    """PROBES places in a table of ``bits`` bits, from separate parts of a hash."""
    return [F.shiftrightunsigned(x, 20 * i).bitwiseAND(F.lit(bits - 1)).cast("int") for i in range(PROBES)]


def bit_table(prints: DataFrame) -> tuple[Column, int]:
    """The fingerprints' places, set in a table of at most TABLE bits, and its number of bits."""
    bits = 1 << 12
    while bits < min(TABLE, 64 * prints.limit(TABLE).count()):
        bits *= 2
    places = prints.select(F.explode(F.array(*_probes(F.col("print"), bits))).alias("bit"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit").bitwiseAND(F.lit(63)))
    words = [0] * (bits >> 6)
    for r in places.groupBy(F.shiftright("bit", 6).alias("at")).agg(F.bit_or(one).alias("v")).collect():
        words[r["at"]] = r["v"]  # at most TABLE / 64 rows
    return F.split(F.lit(",".join(map(str, words))), ",").cast("array<long>"), bits


def _known(x: Column, table: tuple[Column, int]) -> Column:
    """Whether the hash has its bits set; wrong only for chance meetings, which the joins undo."""
    words, bits = table
    out = F.lit(True)
    for place in _probes(x, bits):
        out = out & (F.getbit(F.get(words, F.shiftright(place, 6)), place.bitwiseAND(F.lit(63))) == 1)
    return out


def item_spans(items: DataFrame, span: int, text: str, item_id: str) -> DataFrame:
    """(length, span, owner): each distinct span of item words, with the class of the items that hold it."""
    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words_of(text).alias("words"))
    rows = rows.filter(F.size("words") > 0).withColumn("m", F.least(F.size("words"), F.lit(span)))
    starts = F.sequence(F.lit(1), F.size("words") - F.col("m") + 1)
    spans = rows.select("item", "m", F.explode(F.transform(starts, lambda s: F.array_join(
        F.slice("words", s, F.col("m")), " "))).alias("span"))
    # One span's items: what the result lists for a document that holds it.
    return spans.groupBy("m", "span").agg(F.array_sort(F.collect_set("item")).alias("items")).select(
        F.col("m").alias("length"), "span", F.sha2(F.to_json("items"), 256).alias("owner"), "items")


def _hits(marked: DataFrame, spans: DataFrame, prints: DataFrame, lengths: list[int], table: tuple[Column, int],
          few: bool) -> DataFrame:
    """(row, start, length, owner): every span of a document that is a span of an item."""
    found = []
    for m in lengths:
        k, own = gram(m), F.col("words")
        at = F.filter(F.transform(F.col(f"h{m}"), lambda h, i: F.struct(i.alias("at"), h.alias("print"))),
                      lambda g: _known(g["print"], table))
        met = marked.select("row", F.explode(at).alias("g")).select("row", "g.at", "g.print")
        kept = prints.filter(F.col("length") == m).select("print")
        met = met.join(F.broadcast(kept) if few else kept, "print", "left_semi")
        # Extending: a span of m words that holds the gram starts at most m - k words before it.
        met = met.groupBy("row").agg(F.collect_set("at").alias("ats"))
        around = F.array_distinct(F.flatten(F.transform("ats", lambda a: F.sequence(F.greatest(a - (m - k), F.lit(0)), a))))
        cut = marked.select("row", "words").join(met, "row").select("row", "words", F.filter(
            around, lambda s: s + m <= F.size(own)).alias("starts"))
        cut = cut.select("row", F.explode(F.transform("starts", lambda s: F.struct(
            s.alias("start"), F.array_join(F.slice(own, s + 1, m), " ").alias("span")))).alias("c"))
        cut = cut.select("row", "c.start", "c.span")
        mine = spans.filter(F.col("length") == m).select("span", "owner")
        if few:
            cut = cut.join(F.broadcast(mine), "span")
        else:
            cut = write_stage(cut, "cut")
            sizes = write_stage(cut.groupBy("span").agg(F.count("*").alias("n")).join(mine, "span"), "sizes")
            cut = join_groups(cut.withColumn("own", F.struct("row", "start")), sizes, "span", "n", "own")
            cut = cut.filter("owner is not null")
        found.append(cut.select("row", "start", F.lit(m).alias("length"), "owner"))
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out


def covered(runs: str) -> Column:
    """How many positions the (start, length) runs of an array cover together."""
    step = F.aggregate(
        F.array_sort(runs), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, r: F.struct(
            (acc["n"] + F.greatest(r["start"] + r["length"] - F.greatest(r["start"], acc["end"]), F.lit(0))).alias("n"),
            F.greatest(acc["end"], r["start"] + r["length"]).alias("end")))
    return step["n"]


def contamination(docs: DataFrame, items: DataFrame, span: int = 10, text: str = "text", doc_id: str = "doc_id",
                  item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit (words inside an occurrence of a span of an item),
    n_items (items with such spans), items_sha256 (of their ids, sorted, joined by commas), contaminated."""
    prepare(docs, text, doc_id)
    prepare(items, item_text, item_id)
    spans = write_stage(item_spans(items, span, item_text, item_id), "spans")
    lengths = sorted(r.length for r in spans.select("length").distinct().collect())  # at most ``span`` numbers
    rows = docs.select(F.col(doc_id).alias("doc_id"), words_of(text).alias("words"))
    clean = F.sha2(F.lit(""), 256)
    if not lengths:
        return rows.select("doc_id", F.size("words").cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
                           F.lit(0).cast("long").alias("n_items"), clean.alias("items_sha256"),
                           F.lit(False).alias("contaminated"))
    # A span has as many grams as one window: its fingerprint is the least of all.
    prints = [with_prints(spans.filter(F.col("length") == m).select(F.split("span", " ").alias("words")), [m])
              .select(F.lit(m).alias("length"), F.explode(f"f{m}").alias("print")) for m in lengths]
    whole = prints[0]
    for p in prints[1:]:
        whole = whole.union(p)
    prints = write_stage(whole.distinct(), "prints")
    few = spans.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    table = bit_table(prints)
    marked = with_prints(rows, lengths)
    seen = F.lit(False)
    for m in lengths:
        seen = seen | F.exists(f"f{m}", lambda x: _known(x, table))
    marked = marked.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                           F.size("words").cast("long").alias("n_words"), F.when(seen, F.col("words")).alias("words"))
    marked = write_stage(marked, "documents")
    again = reread(marked).filter("words is not null").select("row", "words").withColumns(
        {f"h{m}": grams("words", gram(m)) for m in lengths})
    hits = write_stage(_hits(again, spans.select("length", "span", "owner"), prints, lengths, table, few), "hits")
    per = hits.groupBy("row").agg(F.collect_set(F.struct("start", "length")).alias("runs"),
                                  F.array_sort(F.collect_set("owner")).alias("owners"))
    per = write_stage(per.select("row", covered("runs").cast("long").alias("n_hit"), F.col("owners").alias("set")), "hit")
    # The items of each distinct set of owners, worked out once however many documents share it.
    owners = spans.groupBy("owner").agg(F.first("items").alias("items"))
    sets = per.groupBy("set").agg(F.count("*").alias("docs"))
    sets = sets.withColumn("set_id", F.sha2(F.to_json("set"), 256))
    held = sets.select("set_id", "docs", F.explode("set").alias("owner")).join(owners, "owner").select(
        "set_id", "docs", F.explode("items").alias("item")).groupBy("set_id", "docs").agg(
        F.array_sort(F.collect_set("item")).alias("items"))
    held = write_stage(held.select("set_id", "docs", F.size("items").cast("long").alias("n_items"),
                                   F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256")), "sets")
    per = per.select("row", "n_hit", F.sha2(F.to_json("set"), 256).alias("set_id"))
    per = join_groups(per, held, "set_id", "docs", "row").select("row", "n_hit", "n_items", "items_sha256")
    drop_stage(prints)
    out = reread(marked).select("row", "doc_id", "n_words").join(per, "row", "left")
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select("doc_id", "n_words", hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                      F.coalesce("items_sha256", clean).alias("items_sha256"), (hit > 0).alias("contaminated"))
