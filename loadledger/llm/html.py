"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the DOM.

A page becomes its leaf blocks in order: runs of text that no block element divides. Each block has
the tags, classes, ids and roles of its ancestors and some measures of its text as features; the
field weighs those and the change from one label to the next, and Viterbi gives the likeliest
labelling of the whole page. Blocks labelled as content are the text.

The field is trained on labelled pages. Nothing labels the given ones, so pages are laid out anew
from a bounded sample of their texts: in many layouts, with and without telling tags, each text being
put in as content or as menu, header, footer, sidebar, notice, advert, form or reader comment, which
is its label. Both kinds of text come from the same sample, so that it is the place that tells.

Defined results: a null page is empty, and a page without content gives an empty text. Scripts,
styles, templates, titles and form controls have no text. Character references are decoded; white
space of any kind becomes one space in a block. Pages that end within markup are read as far as they
go. Repeated rows each give a row, an empty table none. Other columns are not read.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Container, Iterator
from dataclasses import dataclass
from html import escape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadledger.llm.registry import bound_batches, load, query

#: Rows whose texts the labelled pages are made of, and how many pages are made.
SAMPLE_ROWS, LABELLED_PAGES = 200, 600
SEED = 11

# Elements of HTML by how they divide text.
_VOID = frozenset("area base br col embed hr iframe img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp"
    " small span strike strong sub sup time tt u var wbr"
    " math merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle"
    " msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
_SILENT = frozenset(
    "script style template title textarea select option button svg annotation annotation-xml audio video canvas".split()
)
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
_PART = re.compile(r"[a-z]+|[0-9]+")
_BINS = (1, 2, 4, 8, 16, 32, 64)


@dataclass(frozen=True)
class Block:
    text: str
    features: frozenset[str]


@dataclass
class _Open:
    tag: str
    features: frozenset[str]
    own: frozenset[str] = frozenset()
    #: The nearest element that is no inline one, if that is another.
    block: _Open | None = None


class _Reader(HTMLParser):
    """Cuts a page into blocks. Ancestors' features outside ``known`` are dropped, if it is given."""

    def __init__(self, known: Container[str] | None = None):
        super().__init__(convert_charrefs=True)
        self.known = known
        self.stack = [_Open("", frozenset())]
        # Open elements from one whose text does not show on, which open and close none outside.
        self.muted: list[str] = []
        self.mutes: Counter[str] = Counter()
        self.counts: Counter[str] = Counter()
        self.parts: list[str] = []
        self.linked = 0
        self.here: _Open | None = None
        self.blocks: list[tuple[str, int, _Open]] = []

    def _end_block(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append((text, self.linked, self.here))
        self.parts, self.linked, self.here = [], 0, None

    def _pop(self, depth: int) -> None:
        for gone in self.stack[depth:]:
            self.counts[gone.tag] -= 1
        del self.stack[depth:]

    def _pop_tag(self, tags: Container[str], scope: Container[str] = ()) -> None:
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag in tags:
                return self._pop(depth)
            if self.stack[depth].tag in scope:
                return None

    def _mute(self, tag: str) -> None:
        self.muted.append(tag)
        self.mutes[tag] += 1

    def _unmute(self, tag: str) -> None:
        while self.muted:
            gone = self.muted.pop()
            self.mutes[gone] -= 1
            if gone == tag:
                break

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.muted or tag in _SILENT:
            if tag not in _VOID:
                self._mute(tag)
            return
        if tag in _INLINE:
            if tag in ("br", "wbr", "img"):
                self.parts.append("" if tag == "wbr" else " ")
                return
        else:
            self._end_block()
            if self.counts["p"]:
                self._pop_tag({"p"})
            if tag == "body":
                self._pop_tag({"head"})
            if tag in _CLOSES:
                self._pop_tag(*_CLOSES[tag])
        if tag in _VOID:
            return
        above = self.stack[-1]
        own = {f"in:{tag}"}
        for name, value in attrs:
            if name in ("class", "id", "role"):
                own.update(f"at:{part}" for part in _PART.findall((value or "").lower()))
            elif name == "hidden":
                return self._mute(tag)
        if self.known is not None:
            own = {feature for feature in own if feature in self.known}
        features = above.features if own <= above.features else above.features | own
        named = frozenset(feature for feature in own if feature.startswith("at:"))
        block = (above.block or above) if tag in _INLINE else None
        # An element without names stands for the one around it.
        self.stack.append(_Open(tag, features, named or above.own, block))
        self.counts[tag] += 1

    def handle_endtag(self, tag: str) -> None:
        if self.muted:
            if self.mutes[tag]:
                return self._unmute(tag)
            if tag in _INLINE or not self.counts[tag]:
                return
            # What holds the silent element ends, and so does that.
            self._unmute("")
        if tag not in _INLINE:
            self._end_block()
        if self.counts[tag]:
            self._pop_tag({tag})

    def handle_data(self, data: str) -> None:
        if self.muted:
            return
        if self.here is None and not data.isspace():
            self.here = self.stack[-1].block or self.stack[-1]
        if self.counts["a"]:
            self.linked += len(data.strip())
        self.parts.append(data)


def _bin(number: float) -> int:
    return sum(number >= limit for limit in _BINS)


def blocks_of(html: str | None, known: Container[str] | None = None) -> list[Block]:
    """The leaf blocks of a page, in order, with their features."""
    reader = _Reader(known)
    reader.feed(html or "")
    reader.close()
    reader._end_block()
    out = []
    last = max(1, len(reader.blocks) - 1)
    for place, (text, linked, parent) in enumerate(reader.blocks):
        words = text.count(" ") + 1
        own = {
            "bias",
            f"parent:{parent.tag}",
            f"words:{_bin(words)}",
            f"links:{min(4, 4 * linked // len(text))}",
            f"ends:{text[-1] in '.!?:;…。'}",
            f"place:{4 * place // (last + 1)}",
            f"digits:{4 * sum(map(text.count, '0123456789')) > len(text)}",
            f"mark:{text[0] in '©&' or text.startswith('(c)')}",
        }
        out.append(Block(text, parent.features | own | {f"nearest:{name}" for name in parent.own}))
    return out


@dataclass
class Field:
    """Weights of the features for content against other text, and scores of label changes."""

    weights: dict[str, float]
    change: np.ndarray

    def content(self, html: str | None) -> list[str]:
        """The blocks of a page that the likeliest labelling calls content."""
        blocks = blocks_of(html, self.weights)
        if not blocks:
            return []
        weight = self.weights.get
        scores = [sum(weight(f, 0.0) for f in block.features) for block in blocks]
        (stay0, to1), (to0, stay1) = self.change.tolist()
        zero, one, back = 0.0, scores[0], []
        for score in scores[1:]:
            from0, from1 = zero + to1 > one + stay1, zero + stay0 >= one + to0
            back.append((0 if from1 else 1, 0 if from0 else 1))
            zero, one = max(zero + stay0, one + to0), max(zero + to1, one + stay1) + score
        label = int(one > zero)
        labels = [label]
        for steps in reversed(back):
            label = steps[label]
            labels.append(label)
        return [block.text for block, label in zip(blocks, reversed(labels)) if label]


def train(pages: list[list[tuple[frozenset[str], int]]], rounds: int = 200, decay: float = 1e-4) -> Field:
    """Fit a field to labelled pages by gradient ascent on the likelihood, with sums over all labellings."""
    names = sorted({f for page in pages for features, _ in page for f in features})
    number = {name: place for place, name in enumerate(names)}
    longest = max(map(len, pages))
    there = np.zeros((longest, len(pages)), bool)
    truth = np.zeros((longest, len(pages)), np.int64)
    row_of, column_of = [], []
    for p, page in enumerate(pages):
        for t, (features, label) in enumerate(page):
            there[t, p], truth[t, p] = True, label
            row_of += [t * len(pages) + p] * len(features)
            column_of += [number[f] for f in features]
    row_of, column_of = np.array(row_of), np.array(column_of)
    pairs = there[1:]
    seen_change = np.array([[(pairs & (truth[:-1] == a) & (truth[1:] == b)).sum() for b in (0, 1)] for a in (0, 1)])
    weights = np.zeros(len(names) + 4)
    mean, spread = np.zeros_like(weights), np.zeros_like(weights)
    total = there.sum()
    for step in range(1, rounds + 1):
        change = weights[-4:].reshape(2, 2)
        score = np.bincount(row_of, weights[:-4][column_of], there.size).reshape(there.shape)
        emit = np.stack([np.zeros_like(score), score], axis=2)
        ahead, behind = np.zeros_like(emit), np.zeros_like(emit)
        ahead[0] = emit[0]
        for t in range(1, longest):
            moved = np.logaddexp.reduce(ahead[t - 1][:, :, None] + change, axis=1) + emit[t]
            ahead[t] = np.where(there[t][:, None], moved, ahead[t - 1])
        for t in range(longest - 2, -1, -1):
            moved = np.logaddexp.reduce(change + (emit[t + 1] + behind[t + 1])[:, None, :], axis=2)
            behind[t] = np.where(there[t + 1][:, None], moved, 0)
        whole = np.logaddexp.reduce(ahead[-1], axis=1)
        chance = np.exp(ahead[:, :, 1] + behind[:, :, 1] - whole)
        off = np.where(there, truth - chance, 0.0).ravel()
        between = (
            ahead[:-1][:, :, :, None] + change + (emit[1:] + behind[1:])[:, :, None, :] - whole[None, :, None, None]
        )
        expected = np.where(pairs[:, :, None, None], np.exp(np.minimum(between, 0)), 0).sum(axis=(0, 1))
        slope = np.concatenate([np.bincount(column_of, off[row_of], len(names)), (seen_change - expected).ravel()])
        slope = slope / total - decay * weights
        mean = 0.9 * mean + 0.1 * slope
        spread = 0.99 * spread + 0.01 * slope**2
        weights += 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
    return Field(dict(zip(names, weights[:-4].tolist())), weights[-4:].reshape(2, 2).copy())


# How pages name their parts: tags, or classes and ids of a plain div.
_NAMES = {
    "header": (("header",), ("header", "masthead", "site-header", "top-bar", "branding", "banner-top", "page-head")),
    "menu": (("nav",), ("nav", "menu", "navbar", "breadcrumbs", "main-menu", "navigation", "toolbar", "tabs", "toc")),
    "footer": (("footer",), ("footer", "site-footer", "copyright", "legal", "bottom", "colophon", "foot")),
    "sidebar": (("aside",), ("sidebar", "side", "widget", "related", "popular", "rail", "trending", "recommended")),
    "notice": ((), ("cookie-notice", "notice", "consent", "gdpr", "alert", "popup", "modal", "paywall", "newsletter")),
    "advert": ((), ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner", "ad-slot", "sponsor")),
    "form": (("form",), ("search-form", "signup", "subscribe", "login", "contact-form", "form")),
    "comments": ((), ("comments", "comment-list", "reader-comments", "responses", "discussion", "replies", "disqus")),
    "share": ((), ("share", "social", "tags", "byline-links", "pagination", "pager")),
    "content": (("article", "main"), ("content", "post", "entry-content", "article-body", "story", "text", "main-content", "body")),
}


def labelled_page(texts: list[str], draw: random.Random) -> tuple[str, list[tuple[str, int]]]:
    """A page made of some of the texts, and the text and label of each of its blocks."""
    blocks: list[tuple[str, int]] = []

    def put(label: int, least: int, most: int, before: str = "") -> str:
        words = draw.choice(texts).split()
        size = min(len(words), draw.randint(least, most))
        at = draw.randrange(len(words) - size + 1)
        text = before + " ".join(words[at : at + size])
        blocks.append((text, label))
        return escape(text)

    def wrap(kind: str, inner: str) -> str:
        tags, classes = _NAMES[kind]
        if tags and draw.random() < 0.5:
            name = f' class="{draw.choice(classes)}"' if draw.random() < 0.3 else ""
            tag = draw.choice(tags)
            return f"<{tag}{name}>{inner}</{tag}>"
        where = draw.choice(("class", "class", "id"))
        tag = draw.choice(("div", "div", "section"))
        return f'<{tag} {where}="{draw.choice(classes)}">{inner}</{tag}>'

    def links(count: int) -> str:
        if draw.random() < 0.7:
            return "<ul>" + "".join(f'<li><a href="#">{put(0, 1, 4)}</a></li>' for _ in range(count)) + "</ul>"
        return "".join(f'<div><a href="#">{put(0, 1, 5)}</a></div>' for _ in range(count))

    def sentence() -> str:
        tag = draw.choice(("p", "div", "span", ""))
        text = put(0, 2, 30)
        return f"<{tag}>{text}</{tag}>" if tag else f"<div>{text}</div>"

    def other(kind: str) -> str:
        if kind == "menu":
            return wrap(kind, links(draw.randint(2, 8)))
        if kind == "sidebar":
            head = f"<h3>{put(0, 1, 5)}</h3>" if draw.random() < 0.6 else ""
            return wrap(kind, head + (links(draw.randint(2, 5)) if draw.random() < 0.6 else sentence()))
        if kind == "form":
            return wrap(kind, f"<label>{put(0, 1, 5)}</label><input><p>{put(0, 1, 12)}</p><button>Go</button>")
        if kind == "comments":
            head = f"<h3>{put(0, 1, 3)}</h3>" if draw.random() < 0.5 else ""
            name = draw.choice(("comment", "reply", "response"))
            return wrap(kind, head + "".join(
                f'<div class="{name}"><p>{put(0, 3, 60)}</p></div>' for _ in range(draw.randint(1, 4))))
        if kind in ("advert", "notice"):
            text = put(0, 2, 30)
            return wrap(kind, text if draw.random() < 0.5 else f"<p>{text}</p>")
        if kind == "footer":
            text = put(0, 2, 20, draw.choice(("", "", "© ", "(c) ")))
            return wrap(kind, f"<p>{text}</p>" if draw.random() < 0.5 else text)
        return wrap(kind, sentence())

    def paragraph() -> str:
        text = put(1, 1, draw.choice((3, 12, 40, 120)))
        shape = draw.random()
        if shape < 0.1:
            return f"<p><b>{text}<br>"
        if shape < 0.2:
            head, _, rest = text.partition(" ")
            return f'<p><a href="#">{head}</a> {rest}</p>'
        if shape < 0.3:
            return f"<{(tag := draw.choice(('blockquote', 'pre', 'div')))}>{text}</{tag}>"
        if shape < 0.4:
            rest = "".join(f"<li>{put(1, 1, 25)}</li>" for _ in range(draw.randint(0, 3)))
            return f"<ul><li>{text}</li>{rest}</ul>"
        if shape < 0.45:
            return f"<table><tr><td>{text}</td><td>{put(1, 1, 6)}</td></tr></table>"
        return f"<p>{text}</p>"

    def plain(inner: str) -> str:
        """Perhaps within elements that tell nothing."""
        for _ in range(draw.choice((0, 0, 1, 1, 2))):
            name = draw.choice(("", ' class="wrapper"', ' id="page"', ' class="container"', ' class="row"', ' class="inner"'))
            inner = f"<div{name}>{inner}</div>"
        return inner

    html = ""
    for kind in ("header", "menu", "notice", "advert", "form"):
        if draw.random() < (0.6 if kind == "menu" else 0.35):
            html += other(kind)
    if draw.random() < 0.25:
        html += other("sidebar")
    inner = ""
    if draw.random() < 0.8:
        tag = draw.choice(("h1", "h1", "h2"))
        inner += f"<{tag}>{put(1, 1, 10)}</{tag}>"
    for _ in range(draw.randint(1, 12)):
        if draw.random() < 0.12:
            tag = draw.choice(("h2", "h3"))
            inner += f"<{tag}>{put(1, 1, 6)}</{tag}>"
        if draw.random() < 0.15:
            inner += other(draw.choice(("advert", "share", "notice", "sidebar", "form")))
        inner += paragraph()
    inner = plain(inner)
    html += inner if draw.random() < 0.12 else plain(wrap("content", inner))
    for kind in ("share", "comments", "sidebar", "advert", "menu", "footer"):
        if draw.random() < (0.7 if kind == "footer" else 0.35):
            html += other(kind)
    return f"<html><head><title>x</title></head><body>{plain(html)}</body></html>", blocks


def labelled_blocks(html: str, blocks: list[tuple[str, int]]) -> list[tuple[frozenset[str], int]]:
    """The blocks a page is read as, with their labels; a text cut in two keeps its label."""
    out, at = [], 0
    for block in blocks_of(html):
        while at < len(blocks) - 1 and block.text not in blocks[at][0]:
            at += 1
        out.append((block.features, blocks[at][1]))
    return out


def fit(texts: list[str], pages: int = LABELLED_PAGES, seed: int = SEED) -> Field:
    """Train a field on pages made of the given texts, or of invented words if there are none."""
    draw = random.Random(seed)
    texts = [text for text in texts if text.split()]
    if not texts:
        word = lambda: "".join(draw.choices("aeinorst", k=draw.randint(1, 9)))
        texts = [" ".join(word() for _ in range(60)) for _ in range(50)]
    return train([labelled_blocks(*labelled_page(texts, draw)) for _ in range(pages)])


def sample_texts(pages: DataFrame, id_col: str, html_col: str, rows: int = SAMPLE_ROWS) -> list[str]:
    """Block texts of about ``rows`` different pages, chosen by a hash of id and page."""
    total = pages.count()
    hashed = pages.select(F.xxhash64(id_col, html_col).alias("_h"), F.col(html_col).alias("html"))
    share = F.pmod("_h", F.lit(1 << 30)) / (1 << 30)
    chosen = hashed.where(share < rows / max(1, total)).groupBy("_h").agg(F.min("html").alias("html"))
    return [block.text for row in sorted(chosen.collect()) for block in blocks_of(row.html)]


def extract(
    pages: DataFrame, field: Field, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: id, URL, the main text, and its length in code points."""
    bound_batches(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    shape = rows.schema
    kinds = f"id {shape['id'].dataType.simpleString()}, url {shape['url'].dataType.simpleString()}"
    shared = pages.sparkSession.sparkContext.broadcast(field)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["\n".join(shared.value.content(html.as_py())) for html in batch.column(2)]
            sizes = pa.array([len(text) for text in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], ["id", "url", "text", "n_chars"]
            )

    found = rows.mapInArrow(work, f"{kinds}, text string, n_chars long")
    return found.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")


@query()
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages", "page_id", "url", "html")
    return extract(pages, fit(sample_texts(pages, "page_id", "html")))
