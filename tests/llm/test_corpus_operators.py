"""op1, op3, op9 and the pipeline against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from cellhealth.llm import ann, lm_scoring, packing, substring_dedup
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.helpers import PASSAGE, TEXTS, documents, odd


def brute_windows(strings, n):
    seen = Counter(s[i:i + n] for s in strings for i in range(len(s) - n + 1))
    return [[i for i in range(len(s) - n + 1) if seen[s[i:i + n]] > 1] for s in strings]


def brute_cut(strings, n):
    out = []
    for s, starts in zip(strings, brute_windows(strings, n), strict=True):
        runs = []
        for i in starts:
            if runs and i <= runs[-1][1]:
                runs[-1][1] = i + n
            else:
                runs.append([i, i + n])
        out.append((len(s), sum(b - a for a, b in runs), len(runs),
                    hashlib.sha256(substring_dedup.kept_bytes(s, runs)).hexdigest()))
    return out


def test_run_length_index_equals_counting():
    rnd = random.Random(5)
    for _ in range(300):
        letters, n = rnd.choice([b"a", b"ab", b"abc", bytes(range(97, 117))]), rnd.choice([1, 3, 8, 9, 20])
        base = bytes(rnd.choice(letters) for _ in range(60))
        strings = []
        for _ in range(rnd.choice([1, 2, 6])):
            i = rnd.randint(0, 50)
            strings.append(bytes(rnd.choice(letters) for _ in range(rnd.randint(0, 30)))
                           + base[i:i + rnd.randint(0, 40)] + bytes(rnd.choice(letters) for _ in range(rnd.randint(0, 10))))
        got = [x.tolist() for x in substring_dedup.repeated_windows(strings, n)]
        assert got == brute_windows(strings, n)
    index = substring_dedup.RunLengthIndex([b"abcabcabc" * 30] * 2)
    assert index.runs < len(index.text) / 10


def corpus(rnd):
    words = ["alpha", "béta", "gamma", "delta", "日本", "epsilon", "zeta", "eta"]
    prose = lambda n: " ".join(rnd.choice(words) + str(rnd.randrange(50)) for _ in range(n))
    shared = [prose(60) for _ in range(4)]
    texts = ["", None, "short", "ab" * 700, "x" * 199, "x" * 199, "y" * 200, "y" * 200, shared[0][:220] + "q"]
    for i in range(60):
        s = rnd.choice(shared)
        a, b = sorted(rnd.sample(range(len(s)), 2))
        texts.append(prose(rnd.randint(0, 30)) + s[a:b] + prose(rnd.randint(0, 30)))
    return [*texts, texts[20], texts[20]]


@pytest.mark.parametrize("group, part", [(1000, 1 << 20), (4, 300)])
def test_remove_repeats(spark, monkeypatch, group, part):
    """Also with groups so small that all are split, and texts cut into many parts."""
    monkeypatch.setattr(substring_dedup, "GROUP", group)
    monkeypatch.setattr(substring_dedup, "PART", part)
    texts = corpus(random.Random(9))
    exp = brute_cut([(t or "").encode() for t in texts], 200)
    df = documents(spark, texts)
    got = {r.doc_id: tuple(r)[1:] for r in substring_dedup.remove_repeats(df).collect()}
    assert [got[i] for i in range(len(texts))] == exp
    assert sum(0 < e[1] < e[0] for e in exp) > 20


def test_remove_repeats_odd_cases(spark):
    df = odd(spark)
    rows = df.collect()
    exp = sorted(brute_cut([(r.text or "").encode() for r in rows], 200))
    assert sorted(tuple(r)[1:] for r in substring_dedup.remove_repeats(df).collect()) == exp
    cut = substring_dedup.drop_repeats(df)
    assert cut.columns == df.columns and cut.count() == df.count()
    texts = {r.doc_id: r for r in cut.collect()}
    assert texts[1].text is None and texts[17].text == "" and texts[17].n_chars == 0
    assert PASSAGE not in texts[13].text and texts[13].text.startswith("befo")
    assert substring_dedup.remove_repeats(df.limit(0)).count() == 0
    one = documents(spark, [PASSAGE + "unique middle part, said once" + PASSAGE])
    r = substring_dedup.remove_repeats(one).first()
    assert r.n_removed >= 2 * len(PASSAGE) and r.n_spans == 2


def words_of(text):
    return (text or "").encode().lower().split() + [b""]


def test_hmm_base_score_counts(spark):
    df = odd(spark)
    rows = df.collect()
    train = [r for r in rows if r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 7 != 2]
    c = Counter(w for r in train for w in words_of(r.text))
    n, v = sum(c.values()), len(c)
    exp = sorted((r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2, len(words_of(r.text)),
                  sum(w in c for w in words_of(r.text)), n,
                  round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words_of(r.text)), 6)) for r in rows)
    got = lm_scoring.hmm_scores(df, passes=1)
    assert sorted((r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                  for r in got.collect()) == exp
    assert all(math.isfinite(r.score) and r.score < 0 for r in got.collect())
    assert lm_scoring.hmm_scores(df.limit(0)).count() == 0
    alone = lm_scoring.hmm_scores(documents(spark, ["a b"], [next(
        i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)])).first()
    assert alone.train_tokens == 0 and alone.n_known == 0 and math.isfinite(alone.score)


def test_hmm_learns_held_out(spark):
    got = lm_scoring.hmm_scores(spark.read.parquet(f"{SF_MID}/documents.parquet"))
    out = got.filter("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert (out[0] - out[1]) / out[2] > 0.3


def test_forward_and_counts_equal_plain_recursion(monkeypatch):
    rng = np.random.default_rng(2)
    k, s = 3, 7
    move = rng.random((k, k))
    model = lm_scoring.Model(np.full(k, 1 / k), move / move.sum(1, keepdims=True), rng.random((s, k)) / 3)
    docs = [rng.integers(0, s, n) for n in (5, 1, 9, 3, 9)]
    tokens, sizes = np.concatenate(docs), np.array([len(d) for d in docs])
    for side in (1 << 20, 10):
        monkeypatch.setattr(lm_scoring, "SIDE_TOKENS", side)
        counts = lm_scoring.Counts(s, k)
        got = lm_scoring.forward(model, tokens, sizes)
        lm_scoring.forward(model, tokens, sizes, counts)
        start, emit, moves = np.zeros(k), np.zeros((s, k)), np.zeros((k, k))
        for doc, value in zip(docs, got, strict=True):
            a = [model.start * model.emit[doc[0]]]
            for x in doc[1:]:
                a.append(a[-1] @ model.move * model.emit[x])
            assert value == pytest.approx(math.log10(a[-1].sum()))
            b = [np.ones(k)]
            for x in doc[:0:-1]:
                b.append(model.move @ (model.emit[x] * b[-1]))
            b = b[::-1]
            for t, x in enumerate(doc):
                emit[x] += a[t] * b[t] / a[-1].sum()
                if t:
                    moves += np.outer(a[t - 1], model.emit[x] * b[t]) * model.move / a[-1].sum()
            start += a[0] * b[0] / a[-1].sum()
        assert np.allclose(counts.emit, emit, rtol=1e-4) and np.allclose(counts.move, moves, rtol=1e-4)
        assert np.allclose(counts.start, start, rtol=1e-4)


def test_baum_welch_raises_the_likelihood():
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 10, 40) + 10 * (i % 2) for i in range(60)]
    tokens, sizes, shares = np.concatenate(docs), np.full(60, 40), np.full(20, 0.05)
    model, last = lm_scoring.Model.fresh(shares, 2), -np.inf
    for _ in range(12):
        counts = lm_scoring.Counts(20, 2)
        score = lm_scoring.forward(model, tokens, sizes, counts).sum()
        assert score > last - 1.0
        model, last = lm_scoring.Model.from_counts(counts, shares), score
    assert last > tokens.size * math.log10(0.05) + 500


def brute_nearest(rows, k, every):
    width = Counter(len(v) for _, v in rows).most_common(1)[0][0]
    fine = sorted({(i, tuple(v)) for i, v in rows if len(v) == width})
    x = np.array([v for _, v in fine], float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for j, (i, _) in enumerate(fine):
        if i % every == 0:
            s = np.round(unit @ unit[j], 9)
            order = sorted((-s[m], fine[m][0]) for m in range(len(fine)) if fine[m][0] != i)
            out[i] = [(q, -d) for d, q in order[:k]]
    return out


def check_nearest(spark, rows, least, **kind):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, point long, key string")
    good = [(i, v) for i, v, *_ in rows if i is not None and v and all(a is not None and math.isfinite(a) for a in v) and any(v)]
    exp, got = brute_nearest(good, **kind), {}
    for r in sorted(ann.nearest(df, **kind).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append(r)
    hits = total = 0
    for q, best in exp.items():
        mine = got.get(q, [])
        assert [r["rank"] for r in mine] == list(range(1, len(best) + 1))
        assert all(a.score >= b.score for a, b in zip(mine, mine[1:], strict=False))
        hits += len({r.vec_id for r in mine} & {i for i, _ in best})
        total += len(best)
        if least == 1:
            assert [(r.vec_id, round(r.score, 6)) for r in mine] == [(i, round(s, 6)) for i, s in best]
    assert set(got) == {q for q, b in exp.items() if b} and hits >= least * total


def test_nearest_odd_vectors_and_ties(spark):
    rnd = random.Random(6)
    vec = lambda: [rnd.gauss(0, 1) for _ in range(4)]
    rows = [(i, vec()) for i in range(60)]
    rows += [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(60, 90)] + [(90, [2.0, 4.0, 6.0, 8.0])]
    rows += [(100, None), (110, [0.0] * 4), (120, [1.0, None, 2.0, 3.0]), (130, [float("nan")] + [1.0] * 3),
             (140, [float("inf")] + [1.0] * 3), (150, [1.0, 2.0]), (None, vec()), (160, []), rows[0], (170, [1e-30] * 4)]
    check_nearest(spark, [(*r, 0, 1, "k") for r in rows], 1, k=5, every=10)
    check_nearest(spark, [(0, [1.0, 0.0], 0, 1, "k"), (50, [0.0, 1.0], 0, 1, "k")], 1, k=5, every=50)
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.nearest(none).count() == 0


def test_nearest_recall(spark, monkeypatch):
    """Small lists and cells, so that lists are searched, pruned, cut and merged."""
    monkeypatch.setattr(ann, "LIST_POINTS", 20)
    monkeypatch.setattr(ann, "CELL_POINTS", 15)
    monkeypatch.setattr(ann, "CELL_QUERIES", 7)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16))
    rows = [(i, [float(x) for x in centres[i % 12] + 0.4 * rng.normal(size=16)], 0, 1, "k") for i in range(1500)]
    check_nearest(spark, rows, 0.9, k=5, every=50)


def test_centroid_graph_finds_the_nearest():
    rng = np.random.default_rng(5)
    x = ann._units(rng.normal(size=(3000, 12)))
    c = ann.balanced_centroids(x, 200)
    sizes = np.bincount((x @ c.T).argmax(1), minlength=200)
    assert len(c) == 200 and sizes.max() < 10 * 15
    ids, far = ann.CentroidGraph(c).search(x[:300], 32)
    assert (ids[:, 0] == (x[:300] @ c.T).argmax(1)).mean() > 0.95 and (np.diff(far, axis=1) >= 0).all()


def test_pipeline(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "suffix_array_dedup", "best_fit_packing"]
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    last, cols = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        last = corpus_pipeline.write_stage(stage(spark, last, SF_MID), name)
        assert last.columns == cols and 0 < last.count() <= docs.count()
    texts = {r.doc_id: r.text for r in last.collect()}
    cut = brute_cut([t.encode() for t in texts.values()], 200)
    assert sum(r[1] for r in cut) < 0.05 * sum(r[0] for r in cut)  # what is left hardly repeats
    rows = corpus_pipeline.run(spark, SF_MID).collect()
    size = Counter()
    for r in rows:
        size[r.doc_id] += r.length
    assert size == Counter({d: n for d, t in texts.items() if (n := len(t.encode().split()))} | {
        d: 0 for d, t in texts.items() if not t.split()}) or sum(size.values()) == sum(len(t.encode().split()) for t in texts.values())
    assert all(r.bin_tokens is None or r.bin_tokens <= packing.WINDOW for r in rows)


def test_pipeline_stages_on_empty_and_odd_tables(spark, tmp_path):
    spark.read.parquet(f"{SF_SMALL}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    df = documents(spark, TEXTS).select("doc_id", "text", "lang", "source", "n_chars")
    for given in (df, df.limit(0)):
        last = given
        for name, stage in corpus_pipeline.STAGES:
            last = corpus_pipeline.write_stage(stage(spark, last, str(tmp_path)), name)
        assert (last.count() == 0) == (given is not df)


def test_queries_are_registered_and_sql_agrees(spark):
    names = entry.queries()
    assert [n.split("_")[0] for n in names if n.startswith("op")] == [f"op{i}" for i in range(1, 14)]
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    exp = sorted(con.execute(entry.oracle_sql()["op6_exact_dedup"]).fetchall())
    assert sorted(tuple(r) for r in names["op6_exact_dedup"](spark, SF_SMALL).collect()) == exp
