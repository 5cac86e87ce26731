"""No page crashes the extraction, loses its article to broken markup, or takes squared time."""

import random
import time

import pytest

from cellhealth.llm import html_text

STORY = "".join(f"<p>{' '.join(f'word{i}x{j}' for j in range(40))}.</p>" for i in range(4))
TREE = html_text.block_tree()


def words(page):
    return html_text.main_text(page, TREE).count("word")


@pytest.mark.parametrize("bad", ["<![ b", "<![x]>", "<![<p>", "<![CDATA[x]]>", "<![if IE]><![endif]>", "<!>", "<!x", "<?php",
                                 "</>", "</ x>", "<!-", "<!--", "<!DOCTYPE", "<a href='", "&#x110000;", "&#0;", "\x00"])
def test_malformed_markup_keeps_the_rest(bad):
    assert words(f"<body><article>{STORY}</article>{bad}") == 160
    html_text.main_text(bad, TREE)
    html_text.main_text(f"<article>{bad}{STORY}</article>", TREE)


@pytest.mark.parametrize("before,after", [
    ("<html><head><title>t</title><meta charset=utf-8><body>", "</body>"), ("<head><title>t</title><article>", "</article>"),
    ("<head><style>x</style><main>", "</main>"), ("<svg><path d='x'><article>", "</article>"), ("<body><aside>x<article>", "</article>"),
    ("<body><nav><ul><li>x<main>", "</main>"), ("<svg width=1><div><p>", "</div>")])
def test_unclosed_elements_keep_the_article(before, after):
    page = f"{before}{STORY}{after}<div class='site-footer'>Imprint {STORY}</div>"
    text = html_text.main_text(page, TREE)
    assert text.count("word") == 160 and "Imprint" not in text


def test_closed_sidebars_stay_furniture():
    page = f"<body><aside><article>{STORY}</article></aside><article>{STORY.replace('word', 'own')}</article></body>"
    text = html_text.main_text(page, TREE)
    assert "word" not in text and text.count("own") == 160


def test_random_markup_never_raises():
    rng = random.Random(3)
    bits = ["<", ">", "/", "!", "[", "]", "-", "--", "<p>", "</p>", "<div class='ad'>", "</div>", "<![", "<!--", "-->", "<script>",
            "</script>", "<head>", "<svg>", "<a ", "&", "&amp;", "&#", "x", "'", '"', "=", " ", "<article>", "</article>", "<?", "\x00", "é"]
    for _ in range(3000):
        html_text.main_text("".join(rng.choice(bits) for _ in range(rng.randrange(40))), TREE)


@pytest.mark.parametrize("unit", ["<a ", "<!--", "<div><b></p>", "<div>", "</p>", "<![", "&#", "<p"])
def test_a_long_page_takes_linear_time(unit):
    page = f"<article>{STORY}</article>" + unit * ((1 << 20) // len(unit))
    began = time.perf_counter()
    assert words(page) == 160
    assert time.perf_counter() - began < 5
