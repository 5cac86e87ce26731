"""Operators do the whole job: findings of the second review."""

import numpy as np
import pytest

from cellhealth.llm import html_text, lm_scoring, simhash
from tests.llm.helpers import documents

STORY = "".join(f"<p>{' '.join(f'word{i}x{j}' for j in range(40))}.</p>" for i in range(4))


def test_every_hmm_pass_reads_every_training_text(spark):
    """Long texts and every text shape each step; held-out texts shape none."""
    rng = np.random.default_rng(4)
    sizes = [5000, *rng.integers(1, 60, 2000).tolist()]
    texts = [rng.integers(0, 10, n) + 10 * (i % 2) for i, n in enumerate(sizes)]
    train = [i % 7 != 2 for i in range(len(texts))]
    rows = [(list(range(i, i + 500))[:len(texts) - i], train[i:i + 500], sizes[i:i + 500],
             lm_scoring._pack(np.concatenate(texts[i:i + 500]))) for i in range(0, len(texts), 500)]
    symbols = spark.createDataFrame(rows, "ids array<long>, train array<boolean>, sizes array<int>, tokens binary")
    shares = np.full(20, 0.05)
    got, scores = lm_scoring.trained(symbols, shares, 3)
    own = [t for t, own in zip(texts, train, strict=True) if own]
    tokens, lengths = np.concatenate(own), np.array([len(t) for t in own])
    model, exp = lm_scoring.Model.fresh(shares, 3), []
    for _ in scores:
        counts = lm_scoring.Counts(20, 3)
        exp.append(lm_scoring.forward(model, tokens, lengths, counts).sum())
        model = lm_scoring.Model.from_counts(counts, shares)
    assert np.allclose(scores, exp, rtol=1e-4) and np.allclose(got.emit, model.emit, atol=1e-3)
    gains = np.diff(scores) / np.abs(scores[1:])
    assert len(scores) > 2 and gains[-1] < lm_scoring.SETTLED and (gains[:-1] >= lm_scoring.SETTLED).all()


@pytest.mark.parametrize("before,after", [
    ("<div class='page has-sidebar'><article>", "</article></div>"), ("<div id='layout' class='no-sidebar'>", "</div>"),
    ("<section class='story social-science'>", "</section>"), ("<div class='content share-enabled'>", "</div>"),
    ("<div class='discussion-paper'>", "</div>"), ("<div class='responses'>", "</div>"),
    ("<div class='social'><article>", "</article></div>"), ("<form><main>", "</main></form>"),
    ("<div class='comments'><div itemprop='articleBody'>", "</div></div>")])
def test_doubtful_names_keep_the_article(before, after):
    page = f"<body><nav><a href=x>Home</a></nav>{before}{STORY}{after}<div class='site-footer'>Imprint {STORY}</div></body>"
    text = html_text.main_text(page, html_text.block_tree())
    assert text.count("word") == 160 and "Home" not in text and "Imprint" not in text


@pytest.mark.parametrize("name", ["site-footer", "cookie-banner", "sidebar-left", "comment-body", "post-comments", "adSlot"])
def test_names_of_furniture_still_count(name):
    page = f"<body><article>{STORY}<div class='{name}'><p>away {'gone ' * 50}</p></div></article></body>"
    text = html_text.main_text(page, html_text.block_tree())
    assert text.count("word") == 160 and "gone" not in text


def test_labelled_rows_are_learnt():
    tree = html_text.block_tree()
    assert sum(html_text.decide(tree, r[:-1]) != r[-1] for r in html_text.LABELLED) <= 2


def test_one_row_of_each_near_group_whatever_its_ids(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    df = documents(spark, [a, a, a, b, b, b, "c d e f"], [None, None, 5, 7, 7, 5, 7])
    got = sorted((r.text, r.doc_id) for r in simhash.drop_near_copies(df).collect())
    assert got == [(a, None), (b, 5), ("c d e f", 7)]
