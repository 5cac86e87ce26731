"""The whole score column against a plain recursion over words."""

import math
import random
import zlib
from collections import Counter

import numpy as np

from cellhealth.llm import lm_scoring


def test_every_score_equals_a_plain_recursion(spark, monkeypatch):
    rnd, fitted = random.Random(11), []
    words = [f"w{i}" for i in range(40)] + ["The", "the", "é"]
    rows = [(i, " ".join(rnd.choice(words[: rnd.choice([3, 43])]) for _ in range(rnd.randint(0, 30)))) for i in range(90)]
    rows += [(90, None), (None, "the é unseenword"), (91, "x" * 3000 + " the"), (5, "w1 w2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def kept(symbols, shares, states, passes, plain=lm_scoring.trained):
        fitted.append((plain(symbols, shares, states, passes), shares))
        return fitted[-1][0]

    monkeypatch.setattr(lm_scoring, "trained", kept)
    monkeypatch.setattr(lm_scoring, "OWN", 30)  # most words share a class
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", 700)
    monkeypatch.setattr(lm_scoring, "SHARD_WORDS", 50)
    got = lm_scoring.hmm_scores(docs, states=3, passes=4).collect()
    (model, likelihoods), _ = fitted[0]
    assert len(likelihoods) > 1 and all(b > a for a, b in zip(likelihoods, likelihoods[1:]))

    def tokens(text):
        return (text or "").encode().lower().split() + [b""]

    def out(doc_id):
        return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2

    c = Counter(t for i, text in rows if not out(i) for t in tokens(text))
    total = sum(c.values())
    own = {w: k for k, w in enumerate(sorted(w for w in c if c[w] * 30 >= total or w == b""))}
    of = {w: own.get(w, len(own) + zlib.crc32(w[-4:]) % lm_scoring.ENDINGS) for i, text in rows for w in tokens(text)}
    held, size = Counter(), Counter()
    for w in c:
        held[of[w]] += c[w]
        size[of[w]] += 1

    def score(text):
        state, log = np.array(model.start), 0.0
        for t, w in enumerate(tokens(text)):
            state = (state @ model.move if t else state) * model.emit[of[w]]
            log += math.log10(state.sum())
            state = state / state.sum()
            if w not in own:
                log += math.log10((c[w] + 1) / (held[of[w]] + size[of[w]] + 1))
        return log

    def base(text):
        return sum(math.log10((c[w] + 1) / (total + len(c) + 1)) for w in tokens(text))

    want = sorted((i is None, i or 0, len(tokens(x)), sum(c[w] > 0 for w in tokens(x)), round(base(x), 8),
                   round(score(x), 8), out(i)) for i, x in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, round(r.base_score, 8),
                   round(r.score, 8), r.held_out) for r in got) == want
    assert {r.train_tokens for r in got} == {total}
