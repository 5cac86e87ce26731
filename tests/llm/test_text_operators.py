"""op2, op4, op5, op7 and op10 against brute force, an exact round trip or held-out accuracy."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cellhealth.llm import bpe, html_text, packing, quality, token_counts
from tests.conftest import SF_MID
from tests.llm.helpers import TEXTS, documents, odd

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_bpe_equals_library(vocabulary, library):
    encoder, decoder, rnd = bpe.Encoder(vocabulary), bpe.Decoder(vocabulary), random.Random(1)
    cases = [t for t in TEXTS if t] + ["=-" * 900, "é" * 900, " " * 700 + "x", "it's we'll I'M", "١٢٣ ½ Ⅷ"]
    cases += ["".join(map(chr, range(s, s + 64))) for s in range(0, 0x3000, 64)]
    for alphabet in ("abcdefghij kl", "aeiou th", "01 23.,!?", "é一‍ a", "aab"):
        cases += ["".join(rnd.choice(alphabet) for _ in range(n)) for n in (1, 30, 300, 3000)]
    for text in cases:
        ids = library.encode(text, add_special_tokens=False).ids
        packed = encoder.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == ids
        assert "".join(decoder.decode(packed, 5)) == library.decode(ids, skip_special_tokens=False)
    broken = np.random.default_rng(0).integers(0, 50257, 3000).astype("<u4")
    assert "".join(decoder.decode(broken.tobytes(), 3)) == library.decode(broken.tolist(), skip_special_tokens=False)


def test_transducer_emits_stable_tokens_with_constant_memory(vocabulary):
    stream = bpe.Transducer(vocabulary)
    assert stream.lookahead == max(len(a) + len(b) for a, b in vocabulary.ranks)
    data, early, most = b"abcdefghijklmnop" * 4000, [], 0
    for i in range(0, len(data), 100):
        early += stream.feed(data[i:i + 100])
        most = max(most, len(stream.held))
    assert most <= 10 * 4 * stream.lookahead and len(early) > 0
    whole = [*early, *stream.end()]
    assert b"".join(vocabulary.bytes[t] for t in whole) == data
    again = bpe.Transducer(vocabulary)
    assert whole == [*again.feed(data), *again.end()]


def test_bpe_round_trip_query(spark, library):
    df = odd(spark)
    texts = {r.doc_id: r.text or "" for r in df.collect()}
    got = bpe.round_trip(df, PATH).collect()
    assert len(got) == df.count()
    for r in got:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert bpe.round_trip(df.limit(0), PATH).count() == 0
    assert {r.doc_id for r in bpe.encode_documents(df, PATH).collect()} == set(texts)


def greedy(word, initial, following):
    n, at, known = 0, 0, initial
    while at < len(word):
        size = next((k for k in range(len(word) - at, 0, -1) if word[at:at + k] in known), 0)
        if not size:
            return 0
        n, at, known = n + 1, at + size, following
    return n


def test_automaton_equals_greedy_matching():
    rnd = random.Random(2)
    for _ in range(60):
        pieces = [bytes(rnd.choice(b"abc") for _ in range(rnd.randint(1, 5))) for _ in range(rnd.randint(1, 25))]
        first = [p for p in pieces if rnd.random() < 0.6]
        automaton = token_counts.Automaton(first, pieces)
        for _ in range(60):
            word = bytes(rnd.choice(b"abcd"[:rnd.choice([3, 4])]) for _ in range(rnd.randint(1, 14)))
            assert automaton.count(word) == greedy(word, set(first), set(pieces)), (word, first, pieces)


def test_token_counts(spark, tmp_path):
    df = odd(spark)
    pieces = token_counts.byte_vocabulary(PATH)
    first, rest = {p for p in pieces if p[:1] == b" "}, {p for p in pieces if p[:1] != b" "}
    got = token_counts.token_counts(df, PATH).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in df.collect()}
    for r in got:
        words = texts[r.doc_id].split()
        if len(words) < 2000:
            counts = [greedy(b" " + w, first, rest) for w in words]
            assert (r.n_words, r.n_pieces, r.n_unknown) == (
                len(words), sum(c or 1 for c in counts), sum(not c for c in counts))
    assert len(got) == df.count() and token_counts.token_counts(df.limit(0), PATH).count() == 0
    small = tmp_path / "v.json"
    small.write_text(json.dumps({"model": {"vocab": {"Ġa": 0, "b": 1, "Ġb": 2}}, "added_tokens": []}))
    r = token_counts.token_counts(documents(spark, ["a ab ba abba x"]), str(small)).first()
    assert (r.n_words, r.n_pieces, r.n_unknown) == (5, 1 + 2 + 1 + 1 + 1, 3)


def tightest(pieces, capacity, bins):
    """Every piece lies in a tightest compatible bin of those open when it came."""
    state = {}
    for (length, source, cluster), own in zip(pieces, bins, strict=True):
        fits = {b: room for b, (room, keys) in state.items()
                if room >= length and not keys & ({("s", source), ("c", cluster)} - {("s", None), ("c", None)})}
        room, keys = state.get(own, (capacity, set()))
        if own in state:
            assert own in fits and room == min(fits.values())
        else:
            assert not fits
        state[own] = (room - length, keys | ({("s", source), ("c", cluster)} - {("s", None), ("c", None)}))


def test_best_fit_takes_the_tightest_compatible_bin():
    rnd = random.Random(3)
    for _ in range(120):
        capacity, n = rnd.choice([10, 50]), rnd.choice([0, 1, 5, 60, 200])
        pieces = sorted([(rnd.randint(1, capacity), rnd.choice([None, *["h"] * 4, *range(12)]),
                          rnd.choice([None, 0, 0, *range(30)])) for _ in range(n)], key=lambda x: -x[0])
        tightest(pieces, capacity, packing.best_fit(pieces, capacity))


def test_pack(spark):
    df = odd(spark)
    rows = packing.pack(df, capacity=64).collect()
    size = {r.doc_id: len((r.text or "").lower().encode().split()) for r in df.collect()}
    cover, bins = {}, {}
    for r in rows:
        if r.length:
            bins.setdefault(r.bin_id, []).append(r)
            cover.setdefault(r.doc_id, []).append((r.start, r.length))
        else:
            assert r.bin_id is None and size[r.doc_id] == 0
    for own in bins.values():
        assert sum(r.length for r in own) == own[0].bin_tokens <= 64
    for doc, parts in cover.items():
        times = 2 if doc == 0 else 1
        assert sum(n for _, n in parts) == times * size[doc]
    source = {r.doc_id: r.source for r in df.collect()}
    for own in bins.values():
        named = [source[r.doc_id] for r in own if source[r.doc_id] is not None]
        assert len(named) == len(set(named)) and len({r.doc_id for r in own}) == len(own)
    assert packing.pack(df.limit(0)).count() == 0


def test_quality_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.quality_scores(docs, labels)
    assert scored.count() == docs.count()
    got = scored.join(labels, "doc_id").filter("held_out").collect()
    right = sum(r.predicted == r.quality for r in got)
    assert right >= 0.95 * len(got) and all(0 <= r.score <= 1 for r in got)
    kept = quality.keep_quality(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in scored.filter("predicted = 1").collect()}


def test_quality_odd_cases(spark):
    df = odd(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.quality_scores(df, none).collect()} == {0.5}
    labels = spark.createDataFrame([(0, 1), (0, 0), (None, 1), (3, None), (7, 1), (4, 0), (8, 1), (11, 0)],
                                   "doc_id long, quality int")
    got = quality.quality_scores(df, labels).collect()
    assert len(got) == df.count() and all(0 <= r.score <= 1 and r.held_out is not None for r in got)
    assert quality.quality_scores(df.limit(0), labels).count() == 0
    assert quality.features([b"", b"a b\n" * 9]).shape == (2, len(quality.FEATURES))


def test_additive_model_learns_a_pair():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = quality.fit(x, y)
    assert (0, 1) in model.pairs
    assert ((model.score(x) > 0.5) == (y > 0.5)).mean() > 0.9


PAGE = """<html><head><title>T</title><script>var a="</p>x";</script><style>p{}</style></head><body>
<header class="site-header"><h1>My Site</h1></header><nav><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></nav>
<div class="cookie-notice"><p>We use cookies to make this site better for everybody who visits us.</p></div>
<article><h1>Title &amp;amp; more</h1><p>First&nbsp;paragraph <b>of</b>
 the story<p>Enoipa.<div class="ad">Buy this thing now</div><form><label>Mail</label><input></form>
<ul><li>one<li><a href=z>two</a></ul><section id="comments"><p>A reader says a lot of things about this here</p></section>
</article><aside><p>Other stories that you may want to read some day</p></aside><footer>&copy; 2020</footer></body></html>"""


def test_main_text(spark):
    tree = html_text.block_tree()
    known = np.array(html_text.LABELLED)
    assert np.mean([html_text.decide(tree, r[:-1]) == r[-1] for r in known]) > 0.95
    exp = "Title &amp; more\n\nFirst paragraph of the story\n\nEnoipa.\n\none\n\ntwo"
    assert html_text.main_text(PAGE, tree) == exp
    soup = PAGE.replace("article", "div")
    assert html_text.main_text(soup, tree).startswith("Title")
    long = "<article>" + "<p>some text</p>" * 20_000 + "</article>"
    df = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "y"), (3, "v", "", None),
                                (None, "w", "<nav><a>Home</a></nav>", "z"), (4, "l", long, ""), (5, "b", "<<p <!-- a &#xZ; &lt", "")],
                               "page_id long, url string, html string, text string")
    got = html_text.extract(df).collect()
    assert len(got) == 7 and all(r.n_chars == len(r.text) for r in got)
    by = {r.url: r.text for r in got}
    assert by["u"] == exp and by[None] == "" and by["v"] == "" and by["w"] == ""
    assert by["l"] == "\n\n".join(["some text"] * 20_000)
    assert html_text.extract(df.limit(0)).count() == 0
