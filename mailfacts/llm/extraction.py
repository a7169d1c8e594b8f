"""Operator 3: main text of web pages by a tree-structured graphical model.

A page becomes a tree of block elements; inline markup belongs to the block around it. Every block
is content or not. Unary potentials look at the tag, words in class, id and role, the length of
the block's own text and its share of links; parent-child potentials say how strongly a block
follows its parent, by the child's tag. Sum-product messages upward and downward give the exact
marginals, and blocks with text and a marginal of at least one half are kept.

Potentials are trained by exact likelihood on a bounded sample of pages that label themselves: the
page marks its article, and navigation, footers, asides, forms and the like are marked as such.
Blocks outside both stay unlabelled and are summed over. Weights start from, and are drawn to,
fixed prior values, so features that the sample does not show keep a sensible meaning.

Defined results: null, empty and text-free pages give an empty text. Broken markup is closed at
the end of the page or of an enclosing element, an open head where its page's body begins. Equal rows give equal results, one row each. Extra
columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import exp, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_PAGES = 300
EPOCHS, RATE, PULL = 30, 0.1, 0.02

# Kinds of elements, and words of class, id and role with their usual meaning.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("script style noscript template head title svg math iframe object select textarea button canvas video audio".split())
# What can stand in a head; anything else, text included, ends one that is still open.
HEAD = frozenset("html head base link meta title script style noscript template".split())
RAW = frozenset("script style textarea title noscript iframe".split())
BLOCKS = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th "
    "caption blockquote pre figure figcaption nav header footer aside form fieldset address details summary dialog "
    "menu hgroup center search".split()
)
CLOSES_P = BLOCKS - frozenset("html body".split())
SIBLINGS = {
    "li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
}
NOISE_WORDS = frozenset(
    "ad ads adv advert advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice "
    "alert popup modal overlay menu nav navbar navigation breadcrumb breadcrumbs sidebar side footer header masthead "
    "comment comments reply replies discussion disqus share sharing social related recommended newsletter subscribe "
    "subscription signup login search widget pagination pager toolbar skip contentinfo complementary dialog form".split()
)
CONTENT_WORDS = frozenset("article content post entry story body main text prose".split())
NOISE_TAGS = frozenset("nav footer aside form dialog menu search".split())
PRIOR = {
    "tag:article": 4.0, "tag:main": 3.0, "tag:nav": -6.0, "tag:footer": -6.0, "tag:aside": -6.0, "tag:form": -6.0,
    "tag:dialog": -6.0, "tag:menu": -6.0, "tag:search": -6.0, "tag:header": -4.0, "tag:address": -1.0, "tag:h1": 1.0,
    "tag:p": 0.5, "tag:blockquote": 0.5, "tag:pre": 0.5, "tag:html": -0.5, "tag:body": -0.5,
    "words:noise": -6.0, "words:content": 2.0, "size:long": 1.0, "size:middle": 0.3, "size:short": -0.2, "links:most": -3.0,
}
FOLLOW = 3.0

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)"
    r"((?:[^>\"']*+(?:\"[^\"]*\"|'[^']*'))*+[^>\"']*+|[^>]*+)(?:>|\Z)",
    re.S,
)
_MARKS = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z0-9]+")


@dataclass
class Block:
    parent: int
    tag: str
    marks: str
    text: list[str] = field(default_factory=list)
    linked: int = 0



@dataclass
class Page:
    """Blocks in order of their start tags, parents before children; ``runs`` has the blocks'
    own runs of text in page order, one entry whenever the block changes."""

    blocks: list[Block]
    runs: list[tuple[int, str]]


def parse(source: str) -> Page:
    blocks, runs = [Block(-1, "html", "")], []
    stack: list[tuple[str, int]] = [("html", 0)]  # open elements and the block they belong to
    dropped, at, piece, links = 0, 0, [], 0

    def flush() -> None:
        if piece:
            text = " ".join(html.unescape("".join(piece)).split())
            if text:
                runs.append((stack[-1][1], text))
                blocks[stack[-1][1]].text.append(text)
            piece.clear()

    def end_head() -> None:
        if stack[-1][0] == "head":
            close(len(stack) - 1)

    def say(text: str) -> None:
        if dropped and text.strip(" \t\n\f\r"):
            end_head()
        if text and not dropped:
            piece.append(text)
            if links:
                blocks[stack[-1][1]].linked += len(text.strip())

    def close(depth: int) -> None:
        nonlocal dropped, links
        while len(stack) > depth:
            tag, block = stack[-1]
            if tag in BLOCKS:
                flush()
            stack.pop()
            dropped -= tag in DROPPED
            links -= tag == "a"

    def last(tags: tuple[str, ...], limits: tuple[str, ...] = ()) -> int | None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in tags:
                return i
            if stack[i][0] in limits:
                return None
        return None

    while (m := _TOKEN.search(source, at)) is not None:
        say(source[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            i = last((tag,))
            if i is not None:
                close(i)
            continue
        if tag not in HEAD:
            end_head()
        if tag in VOID or tag == "html":
            say(" " if tag in ("br", "hr", "img") else "")
            continue
        if tag in CLOSES_P and (i := last(("p",), ("table", "button"))) is not None:
            close(i)
        if tag in SIBLINGS and (i := last(tuple(SIBLINGS[tag][0].split()), SIBLINGS[tag][1])) is not None:
            close(i)
        if tag in BLOCKS:
            flush()
            marks = " ".join("".join(x) for x in _MARKS.findall(m[3])).lower()
            blocks.append(Block(stack[-1][1], tag, marks))
            stack.append((tag, len(blocks) - 1))
        elif not m[3].endswith("/"):
            stack.append((tag, stack[-1][1]))
        else:
            continue
        dropped += tag in DROPPED
        links += tag == "a"
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(source, at)
            at = end.end() if end else len(source)
            close(len(stack) - 1)
    say(source[at:])
    close(1)
    flush()
    return Page(blocks, runs)


def features(block: Block) -> list[str]:
    out = [f"tag:{block.tag}"]
    words = set(_WORD.findall(block.marks))
    if words & NOISE_WORDS:
        out.append("words:noise")
    elif words & CONTENT_WORDS:
        out.append("words:content")
    out += [f"mark:{w}" for w in sorted(words)]
    n, chars = sum(t.count(" ") + 1 for t in block.text), sum(map(len, block.text))
    if n:
        out.append("size:long" if n >= 20 else "size:middle" if n >= 5 else "size:short")
        if 2 * block.linked >= chars:
            out.append("links:most")
    return out


def labels(page: Page) -> list[int | None] | None:
    """What the page says of its blocks: 1 within its article, 0 within marked noise, else
    unknown. ``None`` if it marks no single article."""
    blocks = page.blocks
    roots = [i for i, b in enumerate(blocks) if b.tag == "article"] or [i for i, b in enumerate(blocks) if b.tag == "main"]
    if len(roots) != 1:
        return None
    out: list[int | None] = []
    for i, b in enumerate(blocks):
        above = out[b.parent] if i else None
        noise = b.tag in NOISE_TAGS or (set(_WORD.findall(b.marks)) & NOISE_WORDS)
        out.append(0 if noise or above == 0 else 1 if i == roots[0] or above == 1 else None)
    return out


@dataclass
class Potentials:
    """Log odds of content by feature, and log weight of following the parent by child tag."""

    unary: dict[str, float]
    follow: dict[str, float]

    def of(self, page: Page) -> tuple[list[float], list[float]]:
        u = [sum(self.unary.get(f, PRIOR.get(f, 0.0)) for f in features(b)) for b in page.blocks]
        return u, [self.follow.get(b.tag, FOLLOW) for b in page.blocks]


def _log_add(a: float, b: float) -> float:
    top = max(a, b)
    return top + log(exp(a - top) + exp(b - top))


def marginals(page: Page, unary: list[float], follow: list[float], known: list[int | None] | None = None) -> tuple[list[float], list[float]]:
    """P(content) of every block, and P(child agrees with parent): sum-product up, then down.
    Messages are log odds of the receiver's two states."""
    n = len(page.blocks)
    own = list(unary)
    if known is not None:
        own = [40.0 if k == 1 else -40.0 if k == 0 else u for u, k in zip(unary, known, strict=True)]
    up = [0.0] * n  # from a block to its parent
    inside = list(own)
    for i in range(n - 1, 0, -1):
        w, s = follow[i], inside[i]
        up[i] = _log_add(s + w, 0.0) - _log_add(s, w)
        inside[page.blocks[i].parent] += up[i]
    belief, agree = list(inside), [1.0] * n
    for i in range(1, n):
        parent = page.blocks[i].parent
        rest, w, s = belief[parent] - up[i], follow[i], inside[i]
        down = _log_add(rest + w, 0.0) - _log_add(rest, w)
        belief[i] = s + down
        same = _log_add(rest + s + w, w)
        agree[i] = 1 / (1 + exp(max(-700.0, min(700.0, _log_add(rest, s) - same))))
    return [1 / (1 + exp(-max(-700.0, min(700.0, b)))) for b in belief], agree


def train(pages: list[str]) -> Potentials:
    """Gradient ascent of the likelihood of the known labels, drawn to the prior values."""
    p = Potentials({}, {})
    cases = []
    for source in pages:
        page = parse(source)
        if (known := labels(page)) is not None:
            cases.append((page, known, [features(b) for b in page.blocks]))
    for _ in range(EPOCHS if cases else 0):
        unary, follow = {}, {}
        for page, known, seen in cases:
            u, w = p.of(page)
            free, free_agree = marginals(page, u, w)
            held, held_agree = marginals(page, u, w, known)
            for i, names in enumerate(seen):
                for name in names:
                    unary[name] = unary.get(name, 0.0) + held[i] - free[i]
                if i:
                    tag = page.blocks[i].tag
                    follow[tag] = follow.get(tag, 0.0) + held_agree[i] - free_agree[i]
        size = RATE * 10 / len(cases)
        for name, g in unary.items():
            mean = PRIOR.get(name, 0.0)
            now = p.unary.get(name, mean)
            p.unary[name] = now + size * g - PULL * (now - mean)
        for tag, g in follow.items():
            now = p.follow.get(tag, FOLLOW)
            p.follow[tag] = now + size * g - PULL * (now - FOLLOW)
    return p


def main_text(source: str, potentials: Potentials) -> str:
    page = parse(source)
    if not page.runs:
        return ""
    content, _ = marginals(page, *potentials.of(page))
    return "\n".join(text for block, text in page.runs if content[block] >= 0.5)


def fit(pages: DataFrame, sample: int = SAMPLE_PAGES) -> Potentials:
    """Train on at most ``sample`` pages that mark an article, chosen by a hash."""
    marked = pages.where(F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    rows = marked.select(F.xxhash64("page_id", "html").alias("h"), "html").orderBy("h").limit(sample)
    return train([r.html for r in rows.collect()])


def extract(pages: DataFrame, potentials: Potentials) -> DataFrame:
    """The main text of each row of ``pages`` (page_id, url, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(source, potentials) for source in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
