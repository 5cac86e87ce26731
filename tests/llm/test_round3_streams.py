"""Encoding in windows, folding per map task, deterministic fits."""

import random
import tracemalloc

import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cellhealth.llm import bpe, exact_dedup, quality

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.Vocabulary(PATH))


@pytest.mark.parametrize("window", [1, 5, 7, 16, 1 << 16])
def test_windows_change_no_token(encoder, monkeypatch, window):
    monkeypatch.setattr(bpe, "WINDOW", window)
    library, rnd = Tokenizer.from_file(PATH), random.Random(window)
    parts = ["don't", "'re", "'ll", "'", "  ", "\n\n \n", "　", "a" * 40, "é", "日本", "12", "!?", "<|endoftext|>",
             " ", "x", "\t", "🙂", "́"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(300)]
    for text in [*texts, "", " " * 50, "ab" * 300, "'r", "'re" * 9]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert list(memoryview(encoder.encode(text)).cast("I")) == ids, text


def test_memory_does_not_grow_with_the_text(encoder):
    def peak(text: str) -> int:
        for _ in encoder.stream(text[:1000]):
            pass
        tracemalloc.start()
        for _ in encoder.stream(text):
            pass
        top = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return top

    few = "some plain words, again; " * 20_000
    assert peak(few * 8) < 1.2 * peak(few) + 100_000
    long = "word" * 100_000
    assert peak(long * 4) < 1.2 * peak(long) + 100_000


def test_bytes_that_are_no_text(spark):
    df = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text UNION ALL SELECT 2L, 'a�b'")
    one, two = bpe.round_trip(df, PATH).orderBy("doc_id").collect()
    assert one[1:] == two[1:] and one.n_tokens > 0


def test_fold_keeps_one_record_of_a_frequent_text():
    digest = [b"hot" if i % 3 == 0 else b"%d" % i for i in range(9000)]
    rows = list(range(9000))
    batches = [pa.RecordBatch.from_arrays(
        [pa.array(rows[i:i + 100]), pa.array(rows[i:i + 100]), pa.array(digest[i:i + 100], pa.binary()),
         pa.array([3] * 100)], names=["row", "doc_id", "digest", "n_bytes"]) for i in range(0, 9000, 100)]
    got = [r for b in exact_dedup._fold(iter(batches), 500) for r in b.to_pylist()]
    hot = [r for r in got if r["digest"] == b"hot"]
    assert [(r["best"], r["best_row"], r["group_size"]) for r in hot] == [(8997, 8997, 3000)]
    assert sum(r["group_size"] for r in got) == 9000 and len(got) == 6001
    # A table of repeated digests only is shed whole; nothing is lost.
    pairs = [b"%d" % (i // 2) for i in range(9000)]
    batches = [pa.RecordBatch.from_arrays(
        [pa.array(rows[i:i + 100]), pa.array([None] * 100, pa.int64()), pa.array(pairs[i:i + 100], pa.binary()),
         pa.array([3] * 100)], names=["row", "doc_id", "digest", "n_bytes"]) for i in range(0, 9000, 100)]
    got = [r for b in exact_dedup._fold(iter(batches), 500) for r in b.to_pylist()]
    assert sum(r["group_size"] for r in got) == 9000 and {r["best"] for r in got} == {exact_dedup.NO_ID}


def test_scores_do_not_depend_on_partitions(spark):
    rnd = random.Random(3)
    rows = [(i % 150, " ".join(rnd.choice(["plain", "words", "of", "a", "text"]) for _ in range(rnd.randint(5, 60)))
             if i % 2 else "".join(rnd.choice("#$%&! ") for _ in range(rnd.randint(5, 200)))) for i in range(600)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(150)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [sorted((r.doc_id, r.score) for r in quality.quality_scores(docs.repartition(n), labels).collect())
           for n in (1, 7)]
    assert got[0] == got[1]
    kept = [sorted((r.doc_id, r.text) for r in quality.keep_quality(docs.repartition(n), labels).collect())
            for n in (1, 7)]
    scored = quality.quality_scores(docs, labels).filter("predicted = 1").count()
    assert kept[0] == kept[1] and len(kept[0]) == scored


def test_a_share_of_labels_is_never_none():
    assert quality.math.ceil(quality.TRAIN_ROWS / 10 ** 11 * quality.DRAW) > 0
