"""Main text of web pages from flat text blocks and a small decision tree.

A page is read as a flat row of text blocks.  Each block has its number of words and its link
density, those of the blocks before and after it, and what it stands in: an article or main
part, page furniture (menus, headers, footers, sidebars, notices, adverts, forms) or reader
comments, by element, role, class and id; headings are marked.  A name in which such a word is
not the head ("social-science") makes a part only doubtful, "has-" or "no-" before it nothing,
and an article or main part within clears what its surroundings' names said.  A decision tree, grown at
start on the small labelled table ``LABELLED``, says which blocks are main text; they are
joined in page order by an empty line.

Defined cases: null and empty pages give the empty text; a page without markup is one block;
white space inside a block becomes one space; broken or unclosed markup is read as browsers
do for the elements that matter here: a marked section is a comment, a head ends where its page
goes on, an article in a menu or sidebar that is never closed is one, an unfinished tag at the
end is markup; very long pages are read whole; repeated rows give
equal texts; an empty table gives no rows; further columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellhealth.llm.common import prepare

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of the page.
SILENT = frozenset("script style noscript template head title svg math iframe object canvas audio video map".split())
FORM = frozenset("form select option button textarea datalist fieldset label dialog".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var img br wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What may stand in a head; a start of anything else ends it.
IN_HEAD = frozenset("head title meta link style script base noscript template".split())
#: Elements that a page may open and never close, and starts that show that an svg or math is over.
ASIDE = ("nav", "aside", "svg", "math")
BREAKOUT = frozenset("article main section div p h1 h2 h3 h4 h5 h6 ul ol li table body header footer pre blockquote".split())
TAGS = re.compile(r"<(/?(?:nav|aside|svg|math))\b", re.I)
UNFINISHED = re.compile(r"<[a-zA-Z/!?]")
#: A start tag of the key ends open elements of the value.
ENDS = {"li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"),
        "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",)}
#: Words of class, id and role that name page furniture, comments and main parts.
FURNITURE = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner "
                      "cookie cookies consent gdpr privacy notice notices alert popup modal overlay newsletter "
                      "subscribe subscription signup sidebar aside widget widgets related recommended recommendations "
                      "share sharing social menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager "
                      "footer masthead copyright login search toolbar complementary contentinfo dialog skip".split())
COMMENTS = frozenset("comment comments reply replies respond discussion disqus responses".split())
MAIN = frozenset("article main content post entry story articlebody".split())
#: Words that name comments only beside others; parts of a name that say that something is there, or not;
#: last parts of a name that say nothing.
VAGUE = frozenset("responses discussion".split())
ABOUT = frozenset("has have no not non with without is enabled disabled hide hides show shows".split())
PLAIN = frozenset("left right top bottom bar box list container wrapper wrap block section area panel item items link "
                  "links body header head title icon icons button buttons text message group row col column unit "
                  "slot zone inner outer main primary secondary form tabs".split())

#: The labelled table: words and link density of a block, of the one before, of the one after;
#: in a main part (2: an article), in page furniture, in comments (0.5: doubtful), a heading;
#: whether it is main text.
LABELLED = (
    # an article: whatever is not furniture or a comment, links and short blocks too
    (60, .00, 55, .00, 70, .00, 2, 0, 0, 0, 1), (120, .02, 40, .00, 3, .00, 2, 0, 0, 0, 1),
    (1, .00, 45, .00, 60, .00, 2, 0, 0, 0, 1), (2, .00, 1, .00, 1, .00, 2, 0, 0, 0, 1),
    (8, .00, 6, 1.0, 90, .00, 2, 0, 0, 1, 1), (3, .00, 12, .00, 40, .00, 2, 0, 0, 1, 1),
    (1, .00, 2, 1.0, 1, .00, 2, 0, 0, 0, 1), (25, .12, 8, .00, 3, 1.0, 2, 0, 0, 0, 1),
    (6, 1.0, 70, .00, 55, .00, 2, 0, 0, 0, 1), (5, .00, 0, .00, 0, .00, 2, 0, 0, 1, 1),
    (3, .00, 4, 1.0, 3, 1.0, 2, 0, 0, 0, 1), (5, 1.0, 2, 1.0, 6, 1.0, 2, 0, 0, 0, 1),
    (2, 1.0, 60, .00, 3, 1.0, 2, 0, 0, 0, 1), (4, .00, 5, 1.0, 80, .80, 2, 0, 0, 0, 1),
    (1, 1.0, 1, 1.0, 1, 1.0, 2, 0, 0, 0, 1), (9, .00, 30, .90, 20, .70, 2, 0, 0, 0, 1),
    # a main part: text and headings
    (14, .50, 80, .00, 60, .00, 1, 0, 0, 0, 1), (4, .00, 4, .00, 4, .00, 1, 0, 0, 0, 1),
    (300, .01, 8, .00, 12, 1.0, 1, 0, 0, 0, 1), (18, .30, 22, .20, 17, .25, 1, 0, 0, 0, 1),
    (40, .60, 30, .00, 44, .00, 1, 0, 0, 0, 1), (7, 1.0, 40, .00, 90, .00, 1, 0, 0, 1, 1),
    (2, .00, 35, .00, 28, 1.0, 1, 0, 0, 0, 1), (3, .00, 2, 1.0, 4, 1.0, 1, 0, 0, 1, 1),
    (1, .00, 0, .00, 3, .00, 1, 0, 0, 0, 1), (6, .10, 3, 1.0, 2, 1.0, 1, 0, 0, 0, 1),
    # rows of links within a main part
    (3, 1.0, 4, 1.0, 3, 1.0, 1, 0, 0, 0, 0), (5, 1.0, 2, 1.0, 6, 1.0, 1, 0, 0, 0, 0),
    (2, 1.0, 60, .00, 3, 1.0, 1, 0, 0, 0, 0), (4, 1.0, 5, 1.0, 80, .00, 1, 0, 0, 0, 0),
    (8, 1.0, 7, 1.0, 9, 1.0, 1, 0, 0, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0, 0, 0),
    # furniture, within a main part or without
    (5, .00, 60, .00, 55, .00, 2, 1, 0, 0, 0), (40, .00, 60, .00, 70, .00, 2, 1, 0, 0, 0),
    (14, .00, 6, .00, 90, .00, 1, 1, 0, 0, 0), (2, .00, 70, .00, 40, .00, 1, 1, 0, 1, 0),
    (9, .00, 3, 1.0, 8, .00, 0, 1, 0, 0, 0), (2, 1.0, 2, 1.0, 1, 1.0, 0, 1, 0, 0, 0),
    (1, 1.0, 0, .00, 1, 1.0, 0, 1, 0, 0, 0), (11, .00, 70, .00, 0, .00, 0, 1, 0, 0, 0),
    (80, .00, 12, .10, 60, .00, 0, 1, 0, 0, 0), (3, .00, 4, .00, 20, .00, 0, 1, 0, 1, 0),
    (30, .20, 40, .00, 10, .00, 0, 1, 0, 0, 0), (150, .00, 90, .00, 80, .00, 0, 1, 0, 0, 0),
    (16, .00, 1, .00, 1, .00, 1, 1, 0, 1, 0), (1, .00, 30, .00, 2, .00, 0, 1, 0, 0, 0),
    # reader comments
    (35, .00, 28, .00, 40, .00, 0, 0, 1, 0, 0), (6, .00, 35, .00, 50, .00, 0, 0, 1, 0, 0),
    (90, .02, 4, .50, 3, 1.0, 0, 0, 1, 0, 0), (20, .00, 60, .00, 22, .00, 2, 0, 1, 0, 0),
    (55, .00, 1, .00, 60, .00, 2, 0, 1, 0, 0), (30, .00, 25, .00, 20, .00, 1, 0, 1, 0, 0),
    (2, .00, 80, .00, 30, .00, 1, 0, 1, 1, 0), (12, .00, 9, .00, 11, .00, 0, 1, 1, 0, 0),
    # pages without a named main part: text by its length and that of its neighbours
    (70, .00, 60, .00, 65, .00, 0, 0, 0, 0, 1), (45, .05, 8, .00, 3, 1.0, 0, 0, 0, 0, 1),
    (110, .10, 2, 1.0, 4, 1.0, 0, 0, 0, 0, 1), (22, .00, 40, .00, 35, .00, 0, 0, 0, 0, 1),
    (9, .00, 50, .00, 60, .00, 0, 0, 0, 0, 1), (4, .00, 45, .00, 70, .00, 0, 0, 0, 0, 1),
    (7, .00, 3, 1.0, 80, .00, 0, 0, 0, 1, 1), (10, .00, 0, .00, 50, .00, 0, 0, 0, 1, 1),
    (24, .00, 0, .00, 0, .00, 0, 0, 0, 0, 1), (30, .20, 25, .00, 28, .00, 0, 0, 0, 0, 1),
    (18, .00, 5, .00, 20, .00, 0, 0, 0, 0, 1), (6, .00, 30, .00, 26, .00, 0, 0, 0, 1, 1),
    (3, .00, 0, .00, 0, .00, 0, 0, 0, 0, 1), (1, .00, 0, .00, 0, .00, 0, 0, 0, 0, 1),
    (5, .00, 3, 1.0, 4, 1.0, 0, 0, 0, 0, 0), (3, .00, 2, .00, 4, .00, 0, 0, 0, 0, 0),
    (6, .00, 2, 1.0, 3, .00, 0, 0, 0, 0, 0), (4, .00, 1, 1.0, 2, 1.0, 0, 0, 0, 1, 0),
    (2, 1.0, 3, 1.0, 2, 1.0, 0, 0, 0, 0, 0), (12, .90, 8, 1.0, 10, .95, 0, 0, 0, 0, 0),
    (40, .80, 30, .90, 35, .85, 0, 0, 0, 0, 0), (7, .60, 50, .00, 2, 1.0, 0, 0, 0, 0, 0),
    (3, .00, 60, .00, 0, .00, 0, 0, 0, 0, 0), (5, .00, 70, .00, 2, 1.0, 0, 0, 0, 0, 0),
    (6, 1.0, 40, .00, 4, 1.0, 0, 0, 0, 0, 0), (1, .00, 0, .00, 3, 1.0, 0, 0, 0, 0, 0),
    # a doubtful name: long blocks with few links, and what stands between them, are text
    (80, .00, 60, .00, 70, .00, 0, .5, 0, 0, 1), (45, .02, 12, .00, 50, .00, 1, .5, 0, 0, 1),
    (60, .00, 8, .00, 3, 1.0, 2, .5, 0, 0, 1), (150, .05, 0, .00, 90, .00, 0, .5, 0, 0, 1),
    (30, .00, 40, .00, 0, .00, 1, .5, 0, 0, 1), (6, .00, 0, .00, 60, .00, 1, .5, 0, 1, 1),
    (90, .00, 70, .00, 40, .00, 0, 0, .5, 0, 1), (40, .05, 6, .00, 55, .00, 1, 0, .5, 0, 1),
    (30, .00, 45, .00, 3, 1.0, 0, 0, .5, 0, 1), (7, .00, 3, 1.0, 80, .00, 0, 0, .5, 1, 1),
    (3, .00, 2, 1.0, 4, .00, 0, .5, 0, 0, 0), (5, 1.0, 3, 1.0, 6, 1.0, 1, .5, 0, 0, 0),
    (2, 1.0, 60, .00, 3, 1.0, 2, .5, 0, 0, 0), (40, .80, 30, .90, 35, .85, 0, .5, 0, 0, 0),
    (6, .00, 5, .00, 4, .00, 1, .5, 0, 0, 0), (4, .00, 3, .00, 5, .00, 0, 0, .5, 0, 0),
    (3, 1.0, 40, .00, 2, 1.0, 1, 0, .5, 0, 0), (8, .00, 6, .00, 0, .00, 2, .5, 0, 0, 0),
)


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 8):
    """A decision tree by Gini impurity: (column, bound, tree up to it, tree beyond it) or a label."""
    share = labels.mean()
    if depth == 0 or share in (0.0, 1.0):
        return int(share >= 0.5)
    best = (2 * share * (1 - share) - 1e-12, None, None)
    for column in range(rows.shape[1]):
        values = np.unique(rows[:, column])
        for bound in (values[1:] + values[:-1]) / 2:
            low = rows[:, column] <= bound
            own = sum(part.mean() * 2 * labels[part].mean() * (1 - labels[part].mean()) for part in (low, ~low))
            if own < best[0] - 1e-12:
                best = (own, column, float(bound))
    _, column, bound = best
    if column is None:
        return int(share >= 0.5)
    low = rows[:, column] <= bound
    parts = [grow(rows[part], labels[part], depth - 1) for part in (low, ~low)]
    return parts[0] if parts[0] == parts[1] and isinstance(parts[0], int) else (column, bound, *parts)


def block_tree(labelled=LABELLED):
    """The tree grown on a labelled table of blocks; those under a doubtful name have a branch of their own."""
    known = np.array(labelled, float)
    doubt = (known[:, 7:9] == .5).any(1) & (known[:, 7:9] < 1).all(1)
    plain, doubtful = (grow(part[:, :-1], part[:, -1]) if len(part) else 0 for part in (known[~doubt], known[doubt]))
    sure = (8, .75, doubtful, plain)
    return (7, .25, (8, .25, plain, sure), (7, .75, sure, plain)) if doubt.any() else plain


def decide(tree, row) -> int:
    while not isinstance(tree, int):
        column, bound, low, high = tree
        tree = low if row[column] <= bound else high
    return tree


class Blocks(HTMLParser):
    """Flat text blocks: (text, words, link density, in main, in furniture, in comments, heading)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple] = []
        self.open: list[tuple] = []  #: (tag, silent, main, furniture, comments, heading)
        self.parts: list[tuple[str, bool]] = []
        self.link = -1  #: how many elements were open where the open link began
        self.held: Counter = Counter()  #: how many elements of each tag are open
        self.unclosed: frozenset = frozenset()  #: tags of ASIDE that the page opens more often than it ends

    def read(self, html: str) -> None:
        """The whole page; an unfinished tag at its end is markup, as in browsers."""
        tags = Counter(t.lower() for t in TAGS.findall(html))
        self.unclosed = frozenset(t for t in ASIDE if tags[t] > tags["/" + t])
        end = html.rfind(">") + 1
        # Behind the last ">" no tag can end: looking for its end from every "<" would take squared time.
        cut = UNFINISHED.search(html, end)
        self.feed(html[:end])
        if not self.rawdata:
            self.handle_data(unescape(html[end:cut.start() if cut else len(html)]))
        else:
            self.feed(html[end:cut.start() if cut else len(html)])
        self.close()

    def parse_html_declaration(self, i: int) -> int:
        """A marked section (``<![``) is a comment up to the next ">", whatever it holds."""
        if self.rawdata.startswith("<![", i):
            return self.parse_bogus_comment(i)
        return super().parse_html_declaration(i)

    def _leave(self, i: int) -> None:
        """End the open elements from the i-th on."""
        for gone in self.open[i:]:
            self.held[gone[0]] -= 1
        del self.open[i:]

    def _left_open(self, tag: str) -> None:
        """End what a start of ``tag`` shows to be over: the head, and asides that are never closed."""
        over = ("head",) if tag not in IN_HEAD and self.held["head"] else ()
        if self.unclosed:
            over += tuple(t for t in self.unclosed if self.held[t] and (
                tag in ("article", "main") if t in ("nav", "aside") else tag in BREAKOUT))
        if over:
            self._leave(min(i for i, x in enumerate(self.open) if x[0] in over))

    def _end_block(self) -> None:
        if self.parts:
            text = " ".join("".join(t for t, _ in self.parts).split())
            if text:
                linked = sum(len(t.split()) for t, link in self.parts if link)
                words = text.count(" ") + 1
                main, furniture, comments, heading = self.state
                self.blocks.append((text, words, min(1.0, linked / words), main, min(1, furniture), comments, int(heading)))
            self.parts = []

    @property
    def state(self) -> tuple:
        return self.open[-1][2:] if self.open else (0, 0, 0, False)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._left_open(tag)
        if tag in INLINE:
            if tag == "a":
                self.link = len(self.open)
            elif tag == "br":
                self.handle_data("\n")
            return
        self._end_block()
        if tag in VOID:
            return
        for ended in ENDS.get(tag, ("p",)):
            if self.open and self.open[-1][0] == ended:
                self._leave(len(self.open) - 1)
        _, silent, main, furniture, comments, heading = self.open[-1] if self.open else ("", *[False] * 5)
        named, hidden = self._named(attrs)
        parts = {p for name in named for p in name}
        article, clears = tag == "article", tag == "main" or ("main",) in named or "articlebody" in parts
        if clears or article:  # 2: an element whose meaning no inner part changes, or hidden
            furniture = furniture if furniture > 1 else 0 if clears or furniture < 1 else .5
            comments = 0 if clears or comments < 1 else .5
        main = max(main, 2 if article or "articlebody" in parts else int(tag == "main" or bool(parts & MAIN)))
        outer = tag not in ("html", "body", "article", "main", "h1")
        furniture = max(furniture, 2 if tag in ("nav", "footer", "aside", "menu") or hidden else int(tag in FORM),
                        self._is(named, FURNITURE) if outer else 0,
                        int(not main and (tag == "header" or (outer and "header" in parts))))
        comments = max(comments, self._is(named, COMMENTS) if outer or article else 0)
        self.held[tag] += 1
        self.open.append((tag, silent or tag in SILENT, main, furniture, comments,
                          heading or tag in HEADINGS))
        if self.link > len(self.open):
            self.link = -1

    @staticmethod
    def _named(attrs: list) -> tuple[set, bool]:
        """The words of each class, id, role and itemprop, and whether the element is hidden."""
        names, hidden = set(), False
        for key, value in attrs:
            if key in ("class", "id", "role", "itemprop"):
                for name in (value or "").split():
                    split = re.sub(r"([a-z0-9])([A-Z])", r"\1 \2", name).lower()
                    words = tuple(w for w in re.findall(r"[a-z]+", split) if len(w) > 1)
                    if words and not ABOUT.intersection(words):
                        names.add(words)
                    if name.lower() == "articlebody":
                        names.add(("articlebody",))
            elif key == "hidden" or (key == "aria-hidden" and value == "true") or (
                    key == "style" and re.search(r"display\s*:\s*none", value or "", re.I)):
                hidden = True
        return names, hidden

    @staticmethod
    def _is(named: set, words: frozenset) -> float:
        """1: a name's head is one of ``words``; 0.5: another part of a name is, or a vague word; else 0."""
        best = 0
        for name in named:
            rest = list(name)
            while len(rest) > 1 and rest[-1] in PLAIN and rest[-1] not in words:
                rest.pop()
            if rest[-1] in words and rest[-1] not in VAGUE:
                return 1
            if words.intersection(name):
                best = .5
        return best

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # as browsers do, except for elements of other name spaces
        if tag in ("svg", "math"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in INLINE:
            if tag == "a":
                self.link = -1
            return
        self._end_block()
        if not self.held[tag]:
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self._leave(i)
                if self.link > len(self.open):
                    self.link = -1
                return

    def handle_data(self, data: str) -> None:
        if not (self.open and self.open[-1][1]):
            self.parts.append((data, self.link >= 0))

    def close(self) -> None:
        super().close()
        self._end_block()


def main_text(html: str, tree) -> str:
    """The blocks that the tree takes for main text, joined by an empty line."""
    page = Blocks()
    page.read(html)
    found = page.blocks
    edge = (0, 0.0)
    near = [edge, *[(b[1], b[2]) for b in found], edge]
    return "\n\n".join(b[0] for i, b in enumerate(found)
                       if decide(tree, (*near[i + 1], *near[i], *near[i + 2], *b[3:])))


def extract(pages: DataFrame, html: str = "html", page_id: str = "page_id", url: str = "url") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars (code points)."""
    prepare(pages, html, page_id, url)
    tree = block_tree()

    def rows(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                texts = [main_text(h, tree) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return (pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                         F.coalesce(F.col(html), F.lit("")).alias("html"))
            .mapInArrow(rows, "page_id long, url string, text string, n_chars long"))
