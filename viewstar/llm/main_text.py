"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

The blocks of a page (``page_blocks``) are a sequence; each is main text or not. Features of a
block are its ancestors' tags and the words of their classes, and its text: length, links,
punctuation, place. Weights of features and of transitions between neighbours are learned by
gradient ascent on the likelihood (forward-backward, numpy) from labelled pages; Viterbi gives
the best sequence for each page.

Labelled pages are made here by a rule: ``labelled_pages`` lays out articles among menus,
headers, footers, sidebars, notices, adverts, forms and comments under many of the names that
sites give them, so the label of each block is known. ``TRAIN_PAGES`` bounds their number.

Defined cases: a null or empty page, or one without main text, gives an empty text; repeated
rows are read each; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import random
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from viewstar.llm.page_blocks import (
    CLOSE_PARAGRAPH, CLOSES, INLINE, RAW, VOID, Chain, TextBlock, text_blocks)

TRAIN_PAGES = 1000
EPOCHS = 8
RATE = 0.3
DECAY = 1e-4
SEED = 23

MAIN = ""

# Words in classes, ids and roles that tell what a part of a page is for.
PURPOSES = {
    "advert": "ad ads advert adverts advertisement adsense banner promo promoted promotion sponsor "
              "sponsored dfp outbrain taboola",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs topbar toc tabs pager pagination "
            "skip links sitemap",
    "header": "header masthead branding logo hero tagline",
    "footer": "footer foot copyright legal colophon credits",
    "side": "side sidebar aside widget rail related recommended recommendations trending popular "
            "more also teaser tags",
    "notice": "cookie cookies consent gdpr notice notices alert warning popup modal overlay banner "
              "announcement paywall privacy",
    "form": "form login signin signup subscribe subscription newsletter search register contact",
    "comments": "comment comments reply replies disqus discussion respond reactions feedback reviews",
    "share": "share sharing social follow tweet buttons toolbar print meta byline",
    "content": "article content entry post story body main text prose maincontent articlebody",
}
_PURPOSE = {word: name for name, words in PURPOSES.items() for word in words.split()}
_SENTENCE = re.compile(r"[.!?…](?:\s|$)")


def _bucket(value: float, edges: Sequence[float]) -> int:
    return sum(value >= edge for edge in edges)


#: Tags whose presence among the ancestors is a feature: those of pages, not made-up ones.
ANCESTORS = INLINE | CLOSE_PARAGRAPH | VOID | RAW | frozenset(CLOSES) | frozenset(
    "html head body title textarea button select legend summary caption thead tbody tfoot".split())


class _Ancestry(NamedTuple):
    """What all blocks under a chain share, and what they share with those below it."""

    features: tuple[str, ...]
    inherited: frozenset[str]
    purposes: frozenset[str]


def _ancestry(chain: Chain, above: _Ancestry | None) -> _Ancestry:
    element = chain.element
    # Names like "post-footer" belong to what they end in.
    purposes = frozenset(_PURPOSE[mark] for mark in element.marks if mark in _PURPOSE)
    own = {f"for:{purpose}" for purpose in purposes}
    if element.tag in ANCESTORS:
        own.add(f"in:{element.tag}")
    if "hidden" in element.marks:
        own.add("hidden")
    inherited = above.inherited if above else frozenset()
    if not own <= inherited:
        inherited |= own
    near = purposes | above.purposes if above else purposes
    found = inherited | {f"near:{purpose}" for purpose in near} | {f"tag:{element.tag}"}
    if element.marks:
        found |= {f"last:{_PURPOSE.get(element.marks[-1], 'other')}"}
    if not inherited & {"in:article", "in:main"}:
        found |= {"outside"}
    return _Ancestry(tuple(sorted(found)), inherited, purposes)


def path_features(chain: Chain | None) -> tuple[str, ...]:
    """Features that all blocks under the same ancestors share; each chain is looked at once."""
    if chain is None:
        return ("outside", "tag:none")
    fresh, at = [], chain
    while at is not None and at.cached is None:
        fresh.append(at)
        at = at.above
    for link in reversed(fresh):
        link.cached = _ancestry(link, link.above.cached if link.above else None)
    return chain.cached.features


def features(blocks: Sequence[TextBlock]) -> list[list[str]]:
    """The features of each block of a page."""
    out = []
    for place, block in enumerate(blocks):
        words = block.text.count(" ") + 1
        links = block.link_chars / max(1, len(block.text))
        found = [
            "always", f"words:{_bucket(words, (2, 4, 8, 16, 32, 64))}",
            f"links:{_bucket(links, (0.05, 0.4, 0.9))}",
            f"sentences:{_bucket(len(_SENTENCE.findall(block.text)), (1, 2, 4))}"]
        found += path_features(block.chain)
        if "©" in block.text or "all rights reserved" in block.text.lower():
            found.append("copyright")
        if place == 0:
            found.append("first")
        if place == len(blocks) - 1:
            found.append("last")
        if place and blocks[place - 1].chain is block.chain:
            found.append("same path")
        out.append(found)
    return out


class Field(NamedTuple):
    """Weights per feature and label, and per pair of neighbouring labels."""

    index: dict[str, int]
    weights: np.ndarray
    steps: np.ndarray

    def scores(self, found: list[list[str]]) -> np.ndarray:
        known = [[self.index[f] for f in block if f in self.index] for block in found]
        flat = np.fromiter((i for block in known for i in block), np.int64)
        owner = np.repeat(np.arange(len(known)), [len(block) for block in known])
        out = np.zeros((len(known), 2))
        for label in (0, 1):
            out[:, label] = np.bincount(owner, self.weights[flat, label], minlength=len(known))
        return out

    def best(self, scores: np.ndarray) -> list[int]:
        """Viterbi: the best sequence of labels; a tie goes to not main."""
        (nn, nm), (mn, mm) = self.steps.tolist()
        rows = scores.tolist()
        no, yes = rows[0]
        back = []
        for score_no, score_yes in rows[1:]:
            to_no = (no + nn, 0) if no + nn >= yes + mn else (yes + mn, 1)
            to_yes = (no + nm, 0) if no + nm >= yes + mm else (yes + mm, 1)
            back.append((to_no[1], to_yes[1]))
            no, yes = to_no[0] + score_no, to_yes[0] + score_yes
        label = int(yes > no)
        labels = [label]
        for pair in reversed(back):
            label = pair[label]
            labels.append(label)
        return labels[::-1]


def expectations(scores: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chance of each label at each place, and expected count of each step (forward-backward).

    Every place is scaled to a sum of one, so long pages neither overflow nor vanish.
    """
    (nn, nm), (mn, mm) = np.exp(steps).tolist()
    local = np.exp(scores - scores.max(axis=1, keepdims=True)).tolist()
    ahead, scales = [], []
    no = yes = None
    for e_no, e_yes in local:
        if no is None:
            no, yes = e_no, e_yes
        else:
            no, yes = (no * nn + yes * mn) * e_no, (no * nm + yes * mm) * e_yes
        scale = no + yes
        no, yes = no / scale, yes / scale
        ahead.append((no, yes))
        scales.append(scale)
    chances = [ahead[-1]]
    c_nn = c_nm = c_mn = c_mm = 0.0
    b_no = b_yes = 1.0
    for t in range(len(local) - 1, 0, -1):
        f_no, f_yes = local[t][0] * b_no / scales[t], local[t][1] * b_yes / scales[t]
        a_no, a_yes = ahead[t - 1]
        c_nn += a_no * nn * f_no
        c_nm += a_no * nm * f_yes
        c_mn += a_yes * mn * f_no
        c_mm += a_yes * mm * f_yes
        b_no, b_yes = nn * f_no + nm * f_yes, mn * f_no + mm * f_yes
        chances.append((a_no * b_no, a_yes * b_yes))
    return np.array(chances[::-1]), np.array([[c_nn, c_nm], [c_mn, c_mm]])


def train(pages: Sequence[tuple[list[list[str]], list[int]]], epochs: int = EPOCHS,
          rate: float = RATE, decay: float = DECAY, seed: int = SEED) -> Field:
    """Stochastic gradient ascent on the likelihood of labelled pages."""
    names = sorted({f for found, _ in pages for block in found for f in block})
    index = {name: number for number, name in enumerate(names)}
    field = Field(index, np.zeros((len(names), 2)), np.zeros((2, 2)))
    ready = []
    for found, labels in pages:
        if labels:
            flat = np.array([index[f] for block in found for f in block])
            owner = np.repeat(np.arange(len(found)), [len(block) for block in found])
            ready.append((flat, owner, np.array(labels)))
    shuffle = random.Random(seed)
    for epoch in range(epochs):
        shuffle.shuffle(ready)
        pace = rate / (1 + epoch)
        for flat, owner, labels in ready:
            scores = np.zeros((len(labels), 2))
            np.add.at(scores, owner, field.weights[flat])
            chances, pairs = expectations(scores, field.steps)
            change = -chances * pace
            change[np.arange(len(labels)), labels] += pace
            np.add.at(field.weights, flat, change[owner])
            np.subtract.at(pairs, (labels[:-1], labels[1:]), 1)
            field.steps[:] -= pace * pairs
            field.weights[:] *= 1 - decay * pace
    return field


# Syllables of the made-up prose in labelled pages.
_SYLLABLES = "ka lo mi ren ta sul ver no pri da esch um tol gra ni be or an ti su".split()
_INNER = ("div", "section", "div", "p", "ul")


class _Maker:
    """Makes one page with marked main text."""

    def __init__(self, seed: int):
        self.random = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        pick = self.random
        return " ".join("".join(pick.choices(_SYLLABLES, k=pick.randint(1, 4)))
                        for _ in range(pick.randint(low, high)))

    def prose(self, sentences: int) -> str:
        return " ".join(self.words(2, 18).capitalize() + self.random.choice(".....!?")
                        for _ in range(sentences))

    def text(self) -> str:
        """A paragraph, long or short; at times one without full stops."""
        kind = self.random.random()
        if kind < 0.1:
            return self.words(1, 3).capitalize() + "."
        if kind < 0.25:
            return self.words(1, 60)
        return self.prose(self.random.randint(1, 6))

    def name(self, purpose: str) -> str:
        words = PURPOSES[purpose].split()
        extra = self.random.choice(["", "", "-box", "-wrap", " clearfix", "-1"])
        kind = self.random.choice(["class", "class", "id"])
        return f' {kind}="{self.random.choice(words)}{extra}"'

    def inside(self, main: bool) -> str:
        """A few blocks: paragraphs, lists, a quote, a table, headings."""
        mark, pick = MAIN if main else "", self.random
        parts = []
        for _ in range(pick.randint(1, 7)):
            kind = pick.random()
            if kind < 0.6:
                close = "</p>" if pick.random() < 0.7 else ""
                bold = "<b>" if pick.random() < 0.15 else ""
                parts.append(f"<p>{bold}{mark}{self.text()}{'<br>' if bold else ''}{close}")
            elif kind < 0.7:
                items = "".join(f"<li>{mark}{self.words(2, 15)}</li>"
                                for _ in range(pick.randint(2, 5)))
                parts.append(f"<ul>{items}</ul>")
            elif kind < 0.8:
                parts.append(f"<blockquote>{mark}{self.text()}</blockquote>")
            elif kind < 0.9:
                level = pick.randint(2, 4)
                parts.append(f"<h{level}>{mark}{self.words(2, 7)}</h{level}>")
            elif kind < 0.95:
                cells = "".join(f"<td>{mark}{self.words(1, 4)}</td>"
                                for _ in range(pick.randint(2, 4)))
                parts.append(f"<table><tr>{cells}</tr></table>")
            else:
                parts.append(f"<div>{mark}{self.text()}</div>")
        return "".join(parts)

    def links(self) -> str:
        one = self.random.randint(2, 8)
        if self.random.random() < 0.7:
            return "<ul>" + "".join(f'<li><a href="/x">{self.words(1, 3)}</a></li>'
                                    for _ in range(one)) + "</ul>"
        return " | ".join(f'<a href="/x">{self.words(1, 3)}</a>' for _ in range(one))

    def part(self, purpose: str) -> str:
        """A part of the page that is not main text."""
        pick = self.random
        tags = {"menu": "nav", "header": "header", "footer": "footer", "side": "aside",
                "form": "form"}
        if purpose in tags and pick.random() < 0.6:
            tag, name = tags[purpose], "" if pick.random() < 0.6 else self.name(purpose)
        else:
            tag, name = pick.choice(("div", "section", "div")), self.name(purpose)
        if purpose in ("notice", "form") and pick.random() < 0.2:
            name += pick.choice((" hidden", ' style="display: none"'))
        if purpose == "menu" or purpose == "share":
            body = self.links()
        elif purpose == "footer":
            body = pick.choice([
                f"&copy; {self.words(1, 4)} &middot; {self.text()}", f"<p>{self.text()}</p>",
                self.links(), f"<p>&copy; {self.words(2, 5)}. All rights reserved.</p>"])
        elif purpose == "form":
            body = (f"<label>{self.words(1, 4)}</label><input name=q><p>{self.text()}</p>"
                    f"<button>{self.words(1, 2)}</button>")
        elif purpose == "header":
            body = f"<h2>{self.words(1, 5)}</h2>" + (self.links() if pick.random() < 0.5 else "")
        elif purpose == "comments":
            body = "<h3>" + self.words(1, 3) + "</h3>" + "".join(
                f'<div{self.name("comments")}><span class="author">{self.words(1, 2)}</span>'
                f"<p>{self.text()}</p></div>" for _ in range(pick.randint(1, 4)))
        elif pick.random() < 0.4:
            body = self.text()
        else:
            body = self.inside(False) + (self.links() if purpose == "side" else "")
        return f"<{tag}{name}>{body}</{tag}>"

    def page(self) -> str:
        pick = self.random
        title = self.words(3, 9)
        heading = f"<h1>{MAIN}{title}</h1>" if pick.random() < 0.9 else ""
        pieces = [heading + self.inside(True)]
        # Now and then an advert, a share bar or a form stands within the article.
        if pick.random() < 0.35:
            pieces.append(self.part(pick.choice(["advert", "share", "side", "form", "notice"])))
            pieces.append(self.inside(True))
        if pick.random() < 0.15:
            pieces.append(self.part("comments"))
        body = "".join(pieces)
        wrap = pick.random()
        if wrap < 0.55:
            name = self.name("content") if pick.random() < 0.3 else ""
            body = f"<article{name}>{body}</article>"
            if pick.random() < 0.3:
                body = f"<main>{body}</main>"
        elif wrap < 0.75:
            body = f"<main>{body}</main>"
        else:
            body = f"<div{self.name('content')}>{body}</div>"
        before = [self.part(p) for p in ("notice", "header", "menu", "advert", "form")
                  if pick.random() < 0.45]
        after = [self.part(p) for p in ("side", "comments", "advert", "share", "form", "footer",
                                        "notice", "menu") if pick.random() < 0.4]
        pick.shuffle(before)
        whole = "".join([*before, body, *after])
        if pick.random() < 0.2:
            whole = f'<div id="page">{whole}</div>'
        return (f"<html><head><title>{title}</title><style>p{{}}</style></head>"
                f"<body>{whole}</body></html>")


def labelled_pages(count: int = TRAIN_PAGES, seed: int = SEED) -> list[str]:
    """Pages whose main text blocks begin with ``MAIN``."""
    return [_Maker(seed * 100_003 + number).page() for number in range(count)]


def labelled_blocks(page: str) -> tuple[list[TextBlock], list[int]]:
    blocks = list(text_blocks(page))
    return ([b._replace(text=b.text.replace(MAIN, "")) for b in blocks],
            [int(MAIN in b.text) for b in blocks])


@functools.cache
def trained(count: int = TRAIN_PAGES) -> Field:
    return train([(features(blocks), labels)
                  for blocks, labels in map(labelled_blocks, labelled_pages(count))])


def main_text(page: str, field: Field) -> str:
    """The main text blocks of a page in order, joined by one space."""
    blocks = list(text_blocks(page))
    if not blocks:
        return ""
    labels = field.best(field.scores(features(blocks)))
    return " ".join(b.text for b, label in zip(blocks, labels) if label)


def extracted(pages: DataFrame, field: Field) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py() or "", field) for page in batch.column("html")]
            yield pa.record_batch({
                "page_id": batch.column("page_id").cast(pa.int64()),
                "url": batch.column("url").cast(pa.string()),
                "text": pa.array(texts, pa.string()),
                "n_chars": pa.array([len(t) for t in texts], pa.int64())})
    return pages.select("page_id", "url", "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
