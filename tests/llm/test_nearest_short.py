"""Tight clusters and outliers: every query gets all of its answers."""

import numpy as np
import pytest

from cellhealth.llm import ann


@pytest.mark.parametrize("block", [None, 1])
def test_queries_in_small_lists_get_k_answers(spark, monkeypatch, block):
    monkeypatch.setattr(ann, "LIST_POINTS", 8)
    if block:
        monkeypatch.setattr(ann, "BLOCK_QUERIES", block)
    asked = []
    plain = ann._against_all
    monkeypatch.setattr(ann, "_against_all", lambda *a: (asked.append(1), plain(*a))[1])
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((30, 3))
    x = np.concatenate([np.repeat(centres, 200, axis=0) + 1e-4 * rng.standard_normal((6000, 3)), rng.standard_normal((150, 3)) * 3])
    rng.shuffle(x)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.astype(float).tolist())], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df, k=5, every=20).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert set(got) == set(range(0, len(x), 20)) and all(sorted(g)[-1][0] == 5 == len(g) for g in got.values())
    assert asked                  # the lists alone do not answer all queries
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    found = 0
    for q, g in got.items():
        score = u @ u[q]
        score[q] = -2
        kth = np.sort(score)[-5]
        found += sum(score[v] >= kth - 1e-12 for _, v in g)
    assert found / (5 * len(got)) >= 0.9
