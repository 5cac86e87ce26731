"""Winnowed decontamination, spelling groups and whitening against brute force, with every awkward case."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cellhealth.llm import decontamination, queries, spelling, whitening
from tests.conftest import SF_SMALL
from tests.llm.helpers import LONG, documents, odd

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = [(1, "the quick brown fox jumps over the lazy dog again and more"), (2, None), (3, " ... "), (4, "SHARED passage"),
         (5, "one"), (6, " ".join(f"word{i}" for i in range(900, 960))), (6, "É ü straße"), (7, "two words"),
         (7, "two words"), (10, "two, words!"), (None, "日本語"), (11, "passage number 3 of many"),
         (12, "a b a b a b a b a b a b a b"), (13, "never to be found in any of these documents at all")]


def items(spark, rows=ITEMS):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "item_id long, text string, row long, words string")


def leaks(docs, bench, span=10):
    spans = {}
    for item, text in bench:
        w = WORD.findall((text or "").translate(LOW))
        m = min(span, len(w))
        for i in range(len(w) - m + 1) if m else ():
            spans.setdefault(tuple(w[i:i + m]), set()).add("" if item is None else str(item))
    out = []
    for r in docs.collect():
        w, hit, found = WORD.findall((r.text or "").translate(LOW)), set(), set()
        for m in {len(s) for s in spans}:
            for i in range(len(w) - m + 1):
                if own := spans.get(tuple(w[i:i + m])):
                    hit.update(range(i, i + m))
                    found |= own
        ids = ",".join(sorted(found))
        out.append((r.doc_id, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("few", [True, False])
def test_decontamination_equals_brute_force(spark, monkeypatch, few):
    if not few:  # the way for more item spans than are broadcast, and a table too small to tell documents apart
        monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 0)
        monkeypatch.setattr(decontamination, "TABLE", 1 << 12)
    docs = odd(spark).union(documents(spark, ["b a b a b a b a b a b a b a b a"] * 40 + ["x one"], [*range(100, 141)]))
    got = decontamination.contamination(docs, items(spark))
    assert sorted(map(tuple, got.collect()), key=str) == leaks(docs, ITEMS)


def test_decontamination_of_empty_tables(spark):
    docs = odd(spark)
    assert decontamination.contamination(docs.limit(0), items(spark)).collect() == []
    for bench in ([], [(2, None), (3, "?!")]):
        got = decontamination.contamination(docs, items(spark, bench)).collect()
        assert sorted(map(tuple, got), key=str) == leaks(docs, bench) and not any(r.contaminated for r in got)


def test_decontamination_plan_is_native(spark):
    plan = queries.op11_benchmark_decontamination(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a != b and (a[i + 1:] == b[i + 1:] if len(a) == len(b) else len(a) + 1 == len(b) and a[i:] == b[i + 1:])


def groups(docs, noise=97):
    n = Counter()
    for r in docs.collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            w = run.translate(LOW)
            h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{w}".encode())
            if h % noise == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {w: min((-n[x], x) for x in near[w])[1] if near[w] and max(n[x] for x in near[w]) >= 2 * n[w] else None for w in n}

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n)


SPELT = [("colour", 50), ("color", 120), ("colours", 20), ("colors", 9), ("coloor", 4), ("banana", 30), ("bananna", 8),
         ("bananb", 8), ("Ébène", 12), ("ébène", 30), ("ÀÉÎÕÜ", 3), ("àéîõü", 3), ("listen", 7), ("silent", 9),
         ("aaaaa", 3), ("aaaaaa", 6), ("aaaaaaa", 12), ("aaaaaaaa", 24), ("abcd", 40), ("abcde", 3), ("x" * 3000, 4),
         ("x" * 2999 + "y", 9), ("twice", 3), ("tvice", 3), ("THERE", 6), ("theré", 3)]


def test_spelling_groups_equal_brute_force(spark):
    docs = odd(spark).union(documents(spark, [f"{w}, " * n for w, n in SPELT] + [" ".join(f"{w} " * n for w, n in SPELT[:9])],
                                      [*range(200, 201 + len(SPELT))]))
    for noise in (97, 3):
        got = sorted(map(tuple, spelling.spelling_groups(docs, noise=noise).collect()))
        assert got == groups(docs, noise) and len(got) > 30
    assert spelling.spelling_groups(docs.limit(0)).collect() == []
    assert spelling.spelling_groups(documents(spark, [None, "", "ab cd"])).collect() == []


def test_spelling_query_equals_brute_force_and_flushes(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = groups(docs)
    assert sorted(map(tuple, queries.op12_spelling_groups(spark, SF_SMALL).collect())) == want
    monkeypatch.setattr(spelling, "HELD", 50)
    got = spelling.word_counts(docs)
    assert sorted(map(tuple, got.collect())) == [(w, n) for w, _, _, n, *_ in want]


def test_spelling_broadcasts_nothing(spark, monkeypatch):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    plans, write = [], spelling.write_stage
    monkeypatch.setattr(spelling, "write_stage", lambda df, name, *a: plans.append(plan(df)) or write(df, name, *a))
    docs = documents(spark, ["colour " * 30 + "color " * 90 + "colours " * 9])
    plans.append(plan(spelling.spelling_groups(docs)))
    joins = [x for p in plans for x in re.findall(r"\w+Join\b|BroadcastExchange", p)]
    assert len(joins) >= 5 and set(joins) == {"SortMergeJoin"}


def test_no_near_word_is_lost_by_the_signatures():
    rng = np.random.default_rng(5)
    for _ in range(300):
        a = "".join(rng.choice(list("abcdeé"), rng.integers(5, 12)))
        i, c = rng.integers(0, len(a)), rng.choice(list("abcdeé"))
        pairs = [(a, a[:i] + c + a[i + 1:], "same"), (a[:i] + a[i + 1:], a, "next")]
        for x, y, kind in pairs:
            if x == y:
                continue
            n = spelling.SAME_PARTS if kind == "same" else spelling.NEXT_PARTS
            parts, _ = spelling.Letters([x, y]).parts(n)
            assert (parts[0] != parts[1]).sum() <= (2 if kind == "same" else 1)
            halves = spelling.Letters([x, y]).halves(np.array([len(x), len(x)])).view(np.uint32)
            apart = int(halves[0] ^ halves[1])
            assert apart & 0xFFFF == 0 or apart >> 16 == 0


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 7, "x") for i, v in rows], "vec_id long, embedding array<float>, n long, z string")


def whitened(rows, k=8, scale=1024, offset=100_000):
    """(ids, n, deviations, eigenvalues, trace, projections) by dense linear algebra."""
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(scale * float(np.float32(c)))) + offset for c in v] for _, v in good], dtype=object)
    n, s = len(x), x.sum(axis=0)
    dev = [int(sum((n * a - b) ** 2 for a, b in zip(row, s))) for row in x]
    y = x.astype(float) - (s / n).astype(float)
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    order = np.argsort(-e)[:k]
    return [i for i, _ in good], n, dev, e[order], np.trace(v), y @ u[:, order] / np.sqrt(e[order])


def test_whitening_equals_dense_algebra(spark):
    rng = np.random.default_rng(2)
    base = (rng.standard_normal((400, 12)) * np.array([3, 2, 2, 1, 1, .5, .4, .3, .2, .1, .1, .05])).tolist()
    rows = [(i, v) for i, v in enumerate(base)] + [(7, base[3]), (None, base[4]), (900, None), (901, [None] + base[0][1:]),
            (902, [float("nan")] + base[0][1:]), (903, [float("inf")] + base[0][1:])]
    rows += [(1000 + i, base[0]) for i in range(200)]
    ids, n, dev, e, trace, z = whitened(rows)
    got = whitening.whiten(vectors(spark, [*rows, (904, [1.0]), (905, []), (906, [1e30] + base[0][1:])])).collect()
    assert len(got) == 8 * n and {r.n for r in got} == {n}
    by = sorted((str(r.vec_id), r.deviation, r.component, r.whitened) for r in got)
    want = sorted((str(i), d, c + 1, zz) for i, d, own in zip(ids, dev, z) for c, zz in enumerate(own))
    assert [(b[0], b[1], b[2]) for b in by] == [(w[0], w[1], w[2]) for w in want]
    for c in range(8):
        a = np.array([b[3] for b in by if b[2] == c + 1])
        b = np.array([w[3] for w in want if w[2] == c + 1])
        assert np.allclose(a, b, atol=1e-8) or np.allclose(a, -b, atol=1e-8)
        assert {r.explained for r in got if r.component == c + 1}.pop() == pytest.approx(e[c] / trace, rel=1e-12)
    assert {r.identity_error for r in got}.pop() < 1e-9


def test_whitening_without_variance_or_vectors(spark):
    for rows in ([], [(1, None)], [(1, []), (2, [])], [(1, [1.0, 2.0])] * 5):
        assert whitening.whiten(vectors(spark, rows)).collect() == []
    got = whitening.whiten(vectors(spark, [(i, [float(i), 2.0 * i, 3.0]) for i in range(10)])).collect()
    assert {r.component for r in got} == {1} and {round(r.explained, 12) for r in got} == {1.0}


def test_deviation_is_exact_or_null():
    xs = np.array([[1 << 40, 5], [-(1 << 40), 7], [3, 3]], np.int64)
    sums = xs.sum(axis=0)
    want = [sum((3 * int(x) - int(s)) ** 2 for x, s in zip(row, sums)) for row in xs]
    assert whitening._deviations(xs, 3, sums) == [v if v < 1 << 63 else None for v in want]


@pytest.mark.parametrize("make", [
    lambda q: np.eye(20), lambda q: np.diag([5, 5, 5, 1, 1, 1, 1, 0.0]), lambda q: np.ones((9, 9)),
    lambda q: q @ np.diag([9] * 5 + [9 - 1e-9] * 5 + [1] * 30) @ q.T,
    lambda q: q @ np.diag(np.r_[1e6, 1e3, 1, np.full(37, 1e-9)]) @ q.T, lambda q: (q + q.T) @ (q + q.T)])
def test_leading_eigenvectors_of_clusters(make):
    q = np.linalg.qr(np.random.default_rng(1).standard_normal((40, 40)))[0]
    a = make(q)
    values, axes = whitening.leading(a, 8)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:len(values)], rtol=0, atol=1e-13 * values[0])
    assert np.abs(axes @ axes.T - np.eye(len(values))).max() < 1e-13
    assert np.abs(a @ axes.T - axes.T * values).max() < 1e-13 * values[0]


def test_long_text_passes_whole(spark):
    docs = documents(spark, [LONG, LONG + " the quick brown fox jumps over the lazy dog again and"])
    got = decontamination.contamination(docs, items(spark, ITEMS[:1])).collect()
    assert sorted((r.doc_id, r.n_hit) for r in got) == [(0, 0), (1, 11)]
