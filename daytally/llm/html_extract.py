"""The main text of web pages: a linear-chain conditional random field over leaf blocks of the DOM.

A block is the text between two borders of block elements. Its features are its ancestors' tags, the names in their
class and id attributes, and shapes of its text: length, links, punctuation, place. The field is trained with stochastic
gradient steps on labelled pages (`page_templates`) and decoded by Viterbi; blocks labelled as main text are joined.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.llm.common import bounded_batches
from daytally.llm.page_templates import MARK, PARTS, Maker

TRAINING_PAGES = 800
EPOCHS = 6
# Fixed values of the HTML standard: void elements, elements without text of the page, block elements.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = frozenset("script style template noscript title textarea select button iframe object svg".split())
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2"
    " h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th"
    " thead tr ul".split()
)
# A start tag ends an open element of these, up to the nearest of those behind.
_ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr",), ("table",)),
}
_HOLDERS = frozenset("article aside blockquote body dd div dl figure footer form header li main nav section table td th ul ol".split())
_SECTIONS = frozenset("article aside footer form header main nav".split())
_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*")


def _parts() -> dict[str, str]:
    """The part of a page that a word of a name stands for, if it stands for one only."""
    of: dict[str, set[str]] = {}
    for part, names in PARTS.items():
        for word in {w for name in names for w in name.split("-")}:
            of.setdefault(word, set()).add(part)
    return {word: min(parts) for word, parts in of.items() if len(parts) == 1}


_PARTS = _parts()


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    names: frozenset[str]
    linked: int


@dataclass
class _Open:
    tag: str
    names: frozenset[str]


class _Blocks(HTMLParser):
    """Collects the blocks of a page, however broken its markup."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[_Open] = []
        self.found: list[Block] = []
        self.parts: list[str] = []
        self.linked = self.silent = 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts = []
        if text:
            names = frozenset().union(*(o.names for o in self.stack))
            self.found.append(Block(text, tuple(o.tag for o in self.stack), names, self.linked))
        self.linked = 0

    def close_to(self, at: int) -> None:
        for o in self.stack[at:]:
            self.silent -= o.tag in _SILENT
        del self.stack[at:]

    def end_open(self, tags: tuple[str, ...], stop) -> None:
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at].tag in tags:
                self.close_to(at)
                return
            if self.stack[at].tag in stop:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _BLOCKS:
            self.flush()
            self.end_open(("p",), _HOLDERS)
            if tag in _ENDS:
                self.end_open(*_ENDS[tag])
        elif tag == "br":
            self.parts.append(" ")
        if tag in _VOID:
            return
        named = " ".join(v for k, v in attrs if k in ("class", "id", "role") and v)
        self.stack.append(_Open(tag, frozenset(x.lower() for x in _NAME.findall(named)) if named else frozenset()))
        self.silent += tag in _SILENT

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in _BLOCKS:
            self.flush()
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at].tag == tag:
                self.close_to(at)
                return

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.parts.append(data)
            if any(o.tag == "a" for o in self.stack):
                self.linked += len(data.strip())


def blocks(html: str) -> list[Block]:
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser.found


def _bin(x: float, *edges: float) -> int:
    return sum(x >= e for e in edges)


def features(page: list[Block]) -> list[list[str]]:
    """Names of the features that hold, for each block."""
    has_article = any("article" in b.path or "main" in b.path for b in page)
    out = []
    for i, b in enumerate(page):
        n, text = len(b.text), b.text
        own = next((t for t in reversed(b.path) if t in _BLOCKS), "none")
        sections = [t for t in b.path if t in _SECTIONS]
        inside = "article" in sections or "main" in sections
        words = _bin(text.count(" ") + 1, 2, 4, 8, 16, 40)
        link = _bin(b.linked / max(n, 1), 0.01, 0.3, 0.7)
        marks = text.count(".") + text.count(",") + text.count("?") + text.count("!")
        found = [
            "always",
            f"own={own}",
            f"words={words}",
            f"link={link}",
            f"own={own} words={words}",
            f"own={own} link={link}",
            f"end={text[-1] in '.!?…。:;'}",
            f"marks={_bin(marks / n, 0.005, 0.02, 0.05)}",
            f"from_start={_bin(i, 1, 2, 4)}",
            f"to_end={_bin(len(page) - i, 2, 3, 5)}",
            f"inside={inside} page={has_article}",
            f"sections={'>'.join(sections[-3:])}",
            f"last={sections[-1] if sections else 'none'}",
        ]
        if "©" in text or "(c)" in text[:60].lower():
            found.append("copyright")
        found += {f"tag={t}" for t in b.path if t in _BLOCKS}
        found += {f"name={x}" for x in b.names}
        found += {f"stem={x[:4]}" for x in b.names if len(x) > 4}
        found += {f"part={part}" for x in b.names if (part := _PARTS.get(x))}
        out.append(sorted(found))
    return out


@dataclass
class Field:
    """Weights of features for main against other text, and of steps between labels 0 (other) and 1 (main)."""

    weights: dict[str, float] = field(default_factory=dict)
    steps: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    first: np.ndarray = field(default_factory=lambda: np.zeros(2))

    def scores(self, found: list[list[str]]) -> list[float]:
        get = self.weights.get
        return [sum(get(f, 0.0) for f in one) for one in found]

    def decode(self, found: list[list[str]]) -> list[int]:
        """The best labels of a page, by Viterbi."""
        if not found:
            return []
        scores = self.scores(found)
        (s00, s01), (s10, s11) = self.steps.tolist()
        zero, one = self.first[0], self.first[1] + scores[0]
        back = []
        for score in scores[1:]:
            from_zero = (zero + s00 >= one + s10, zero + s01 > one + s11)
            back.append(from_zero)
            zero, one = max(zero + s00, one + s10), max(zero + s01, one + s11) + score
        label = int(one > zero)
        out = [label]
        for from_zero in reversed(back):
            label = 0 if from_zero[label] else 1
            out.append(label)
        return out[::-1]

    def learn(self, found: list[list[str]], right: list[int], rate: float, shrink: float) -> None:
        """One step along the gradient of the page's log-likelihood."""
        n = len(found)
        emit = np.zeros((n, 2))
        emit[:, 1] = self.scores(found)
        ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
        ahead[0] = self.first + emit[0]
        for i in range(1, n):
            ahead[i] = np.logaddexp(ahead[i - 1, 0] + self.steps[0], ahead[i - 1, 1] + self.steps[1]) + emit[i]
        for i in range(n - 2, -1, -1):
            after = emit[i + 1] + behind[i + 1]
            behind[i] = np.logaddexp(self.steps[:, 0] + after[0], self.steps[:, 1] + after[1])
        total = np.logaddexp(*ahead[-1])
        main = np.exp(ahead[:, 1] + behind[:, 1] - total)
        for i, one in enumerate(found):
            by = rate * (right[i] - main[i])
            if abs(by) > 1e-6:
                for f in one:
                    w = self.weights.get(f, 0.0)
                    self.weights[f] = w + by - rate * shrink * w
        if n > 1:
            pairs = np.exp(ahead[:-1, :, None] + self.steps + (emit[1:] + behind[1:])[:, None, :] - total).sum(axis=0)
            seen = np.zeros((2, 2))
            np.add.at(seen, (right[:-1], right[1:]), 1)
            self.steps += rate * (seen - pairs)
        self.first += rate * (np.eye(2)[right[0]] - np.exp(ahead[0] + behind[0] - total))


def labelled_page(html: str) -> tuple[list[Block], list[int]]:
    """Blocks of a page whose main texts carry MARK, without the marks, and their labels."""
    found = blocks(html)
    labels = [int(MARK in b.text) for b in found]
    for b in found:
        b.text = " ".join(b.text.replace(MARK, "").split()) or "."
    return found, labels


def train(pages: int = TRAINING_PAGES, epochs: int = EPOCHS, seed: int = 11) -> Field:
    data = []
    for number in range(pages):
        found, labels = labelled_page(Maker(seed * 100_000 + number).page())
        if found:
            data.append((features(found), labels))
    model, rng = Field(), random.Random(seed)
    for epoch in range(epochs):
        rng.shuffle(data)
        for found, labels in data:
            model.learn(found, labels, 0.2 / math.sqrt(1 + epoch), 0.002)
    return model


def main_text(html: str, model: Field) -> str:
    page = blocks(html)
    return "\n".join(b.text for b, label in zip(page, model.decode(features(page)), strict=True) if label)


def main_texts(pages: DataFrame, model: Field | None = None) -> DataFrame:
    """One row per row of `pages` (page_id, url, html): page_id, url, text, n_chars.

    Character references are decoded, white space within a block is one blank, blocks are joined by a newline.

    - A null or empty html, or one without main text, gives an empty text. Pages of any size are read whole.
    - Rows are read one by one: ids and urls may be null or repeat. An empty table gives an empty result.
    - Other columns, whatever their names, are not read.
    """
    bounded_batches(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(model or train())

    @F.arrow_udf(T.StringType())
    def extracted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for htmls in batches:
            yield pa.array([main_text(h.as_py() or "", model) for h in htmls], pa.string())

    return pages.select("page_id", "url", extracted("html").alias("text")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )
