"""Main text of web pages by a maximum-scoring subsequence.

A page becomes a sequence of words and tags.  Words score above zero and tags below, words
in menus, footers, forms and the like far below; the weights, one per kind of tag and per
kind of block a word lies in, are log odds learned from labelled pages: pages that mark
their content with ``article`` or ``main``, a bounded sample of them (``LABELLED``).  One
linear scan finds the contiguous region with the largest sum.  The region is widened to
the article or container it lies in, and blocks inside that are no content leave.

On a page with ``article`` or ``main``, the side (inside or outside these) that holds fewer
of its words loses the log odds of the two sides, word by word: a mark is evidence, and a
few teaser cards do not outweigh the text beside them.

A text is made of blocks (paragraphs, headings, list items, cells ...): references are
decoded, white space inside a block becomes one space, blocks are joined by a newline.

Edge cases: null or empty html, and pages without words, give the empty text; unclosed
tags end where the markup's rules or their parent end them; a page cut off inside a tag,
comment or script loses that piece; repeated pages are extracted row by row.  Pages are
read one by one, whole, whatever their length.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from caseflow.llm import common as C

LABELLED = 2_000
#: Least score of a word, and least cost of a tag: their signs are given, sizes are learned.
_LEAST, _MOST = 0.1, 4.0
_NOISE_WORD = -4.0
#: Share of a page's words from which a form is the page, not a part of it.
_NEARLY = 0.9

# Elements of the markup language by what they do to the text.
DROPPED = frozenset("script style noscript template svg math iframe object canvas audio video select textarea title head".split())
EXCLUDED = frozenset("nav header footer aside form button dialog menu fieldset".split())
CONTENT = frozenset(["article", "main"])
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol "
    "optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript iframe textarea title svg math template".split())
#: Parts of class names and ids that tell what is not content. Fixed values.
NOTES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice notices alert notification popup modal overlay newsletter "
    "subscribe subscription signup login sidebar aside widget widgets related recommended comment "
    "comments commentlist disqus reply replies responses nav navbar navigation menu menus "
    "breadcrumb breadcrumbs header footer masthead topbar toolbar share sharing social search skip "
    "pagination pager copyright disclaimer hidden".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(>|\Z)",
    re.S,
)
_ATTR = re.compile(r"(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?(?=[\s/]|\Z)", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_ENDS_P = BLOCKS - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "li", "dd", "dt", "option"}
_SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}), "option": ({"option"}, {"select"}),
}


def _noted(attrs: str, name: str) -> tuple[bool, bool]:
    """Whether an element is noted as no content by its names, and whether it is hidden outright."""
    noted = hidden = False
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), html.unescape(m[2] or m[3] or m[4] or "")
        if key == "hidden" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            hidden = True
        elif key == "aria-hidden":
            hidden |= value.strip().lower() == "true"
        elif key == "role":
            noted |= value.strip().lower() in ROLES
        elif key in ("class", "id") and name not in HEADINGS:
            for one in value.split():
                parts = [p.lower() for p in _PARTS.findall(one)]
                # "has-sidebar" tells of the page, not of this element
                noted |= bool(parts) and parts[0] not in ("has", "with", "no") and not NOTES.isdisjoint(parts)
    return noted, hidden


class Page:
    """Elements, blocks and events of a page in one pass.

    elements: (name, parent, kind) with kind 0 plain, 1 noted by its names, 2 no content;
    events: ("t", name) for tags, ("w", block, words, linked) for text;
    blocks: (element, pieces of text with the element each lies in);
    noise: by element, whether it is no content; mark: log odds of words in article or main.
    """

    def __init__(self, source: str):
        self.elements: list[list] = [["html", -1, 0]]
        self.blocks: list[tuple[int, list[tuple[int, str]]]] = []
        self.events: list[tuple] = []
        self.forms: dict[int, int] = {}  # visible forms, and their kind if they were none
        stack, fresh, at, links = [0], True, 0, 0
        skip = None  # end of raw text
        pos, n = 0, len(source)
        while pos < n:
            m = _TOKEN.search(source, pos)
            upto = m.start() if m else n
            if upto > pos and skip is None:
                fresh = self._text(source[pos:upto], stack, fresh, links > 0)
            if not m:
                break
            pos = m.end()
            name = (m[2] or "").lower()
            if not name:
                continue
            if m[4] != ">":
                break  # cut off inside a tag
            closing = m[1] == "/"
            if not closing and name in RAW:
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, pos)
                pos = end.end() if end else n
                continue
            if name == "br":
                self._text(" ", stack, fresh, False)
                continue
            if name in BLOCKS:
                fresh = True
            if closing:
                for k in range(len(stack) - 1, 0, -1):
                    if self.elements[stack[k]][0] == name:
                        links -= sum(self.elements[e][0] == "a" for e in stack[k:])
                        del stack[k:]
                        self.events.append(("t", "/" + name if name in BLOCKS else name))
                        break
                continue
            if name in ("html", "body", "head"):
                continue
            self._imply(name, stack)
            links = sum(self.elements[e][0] == "a" for e in stack)
            if name in VOID:
                self.events.append(("t", name))
                continue
            noted, hidden = _noted(m[3], name) if m[3] else (False, False)
            kind = 2 if hidden or name in EXCLUDED or name in DROPPED else 1 if noted and name not in CONTENT else 0
            self.elements.append([name, stack[-1], kind])
            at = len(self.elements) - 1
            if name == "form" and not hidden:
                self.forms[at] = int(noted)
            stack.append(at)
            links += name == "a"
            self.events.append(("t", name))
            if m[3].rstrip().endswith("/") and name not in BLOCKS:
                stack.pop()
                links -= name == "a"
        self._judge()

    def _held(self, noise: list[bool]) -> list[int]:
        """Words in each element and below it, without those in noise."""
        held = [0] * len(self.elements)
        for e in self.events:
            if e[0] == "w" and not noise[e[4]]:
                held[e[4]] += e[2]
        for k in range(len(held) - 1, 0, -1):
            held[self.elements[k][1]] += held[k]
        return held

    def _below(self, own: list[bool]) -> list[bool]:
        """True at and below elements that are noise of their own."""
        out = list(own)
        for k in range(1, len(out)):
            out[k] |= out[self.elements[k][1]]
        return out

    def _judge(self) -> None:
        """Tell noise from content once all words are known."""
        kinds = [e[2] for e in self.elements]
        if self.forms:
            held = self._held(self._below([kind == 2 and k not in self.forms for k, kind in enumerate(kinds)]))
            for k, kind in self.forms.items():
                if held[k] > _NEARLY * held[0]:
                    kinds[k] = self.elements[k][2] = kind
        content = [k for k, e in enumerate(self.elements) if e[0] in CONTENT]
        inner = {a for k in content for a in self.above(k)} if 1 in kinds else set()
        noted = [kind == 2 or kind == 1 and k not in inner for k, kind in enumerate(kinds)]
        self.noise = self._below(noted)
        if inner:  # a noted container stays content only around most of the page's words
            held = self._held(self.noise)
            inner = {a for k in content if 2 * held[k] > held[0] for a in self.above(k)}
            self.noise = self._below([kind == 2 or kind == 1 and k not in inner for k, kind in enumerate(kinds)])
        self.marked = self._below([e[0] in CONTENT for e in self.elements])
        sides = [0, 0]
        for e in self.events:
            if e[0] == "w" and not self.noise[e[4]]:
                sides[self.marked[e[4]]] += e[2]
        odds = math.log((sides[1] + 1) / (sides[0] + 1)) if sides[1] else 0.0
        self.mark = min(_MOST, max(-_MOST, odds))

    def _imply(self, name: str, stack: list[int]) -> None:
        """End what this tag ends without saying so."""
        ends, within = _SIBLINGS.get(name, (frozenset(), frozenset()))
        if name in _ENDS_P:
            ends, within = {"p"}, {"table", "td", "th", "li", "article", "main", "section", "body"}
        for k in range(len(stack) - 1, 0, -1):
            known = self.elements[stack[k]][0]
            if known in ends:
                del stack[k:]
                return
            if known in within:
                return

    def _text(self, raw: str, stack: list[int], fresh: bool, linked: bool) -> bool:
        text = html.unescape(raw)
        words = len(text.split())
        if fresh and not words:
            return True
        if fresh:
            home = next(e for e in reversed(stack) if e == 0 or self.elements[e][0] in BLOCKS)
            self.blocks.append((home, []))
        self.blocks[-1][1].append((stack[-1], text))
        if words:
            self.events.append(("w", len(self.blocks) - 1, words, linked, stack[-1]))
        return False

    def _line(self, block: int) -> str:
        """The text of a block, without words of elements inside the line that are noise."""
        home, pieces = self.blocks[block]
        kept = (t for e, t in pieces if self.noise[home] or not self.noise[e] or not t.strip())
        return " ".join("".join(kept).split())

    def home(self, element: int) -> int:
        """The nearest article or main around an element, itself included; 0 if none."""
        while element > 0 and self.elements[element][0] not in CONTENT:
            element = self.elements[element][1]
        return element

    def above(self, element: int) -> list[int]:
        path = [element]
        while path[-1] > 0:
            path.append(self.elements[path[-1]][1])
        return path[::-1]

    def kind(self, event: tuple) -> str:
        """What a weight is learned for."""
        if event[0] == "t":
            name = event[1].lstrip("/")
            return "<" + (event[1] if name in BLOCKS or name in VOID or name in ("a", "b", "i", "em", "strong", "span") else "other")
        name = self.elements[self.blocks[event[1]][0]][0]
        return ("link in " if event[3] else "word in ") + (name if name in BLOCKS else "other")

    def counts(self) -> dict[str, tuple[int, int]]:
        """Per kind, how often it lies in marked content and elsewhere; empty without a mark on most words."""
        if self.mark <= 0:
            return {}
        out: dict[str, list[int]] = {}
        inside = False
        for e in self.events:
            if e[0] == "w":
                inside = self.marked[e[4]] and not self.noise[e[4]]
            row = out.setdefault(self.kind(e), [0, 0])
            row[not inside] += e[2] if e[0] == "w" else 1
        return {k: (a, b) for k, (a, b) in out.items()}

    def main_text(self, weights: dict[str, float]) -> str:
        scores = [0.0] * len(self.blocks)
        gains = []
        for e in self.events:
            if e[0] == "t":
                gains.append(weights.get(self.kind(e), -1.0))
            elif self.noise[e[4]]:
                gains.append(_NOISE_WORD * e[2])
            else:
                against = max(0.0, -self.mark if self.marked[e[4]] else self.mark)
                gains.append((weights.get(self.kind(e), 1.0) - against) * e[2])
                scores[e[1]] += gains[-1]
        best, low, high, total, start = 0.0, 0, -1, 0.0, 0
        for i, gain in enumerate(gains):
            if total <= 0:
                total, start = 0.0, i
            total += gain
            if total > best:
                best, low, high = total, start, i
        core = sorted({e[1] for e, g in zip(self.events[low : high + 1], gains[low : high + 1]) if e[0] == "w" and g > 0})
        if not core:
            return ""
        paths = [self.above(self.blocks[b][0]) for b in core]
        depth = 0
        while all(len(p) > depth + 1 for p in paths) and len({p[depth + 1] for p in paths}) == 1:
            depth += 1
        around = self.home(paths[0][depth]) or paths[0][depth]
        if around:
            chosen = [b for b in range(len(self.blocks)) if around in self.above(self.blocks[b][0])]
        else:  # nothing holds the region but the page
            homes = {self.home(p[-1]) for p in paths} - {0}
            whole = [b for b in range(len(self.blocks)) if self.home(self.blocks[b][0]) in homes]
            chosen = sorted({*range(core[0], core[-1] + 1), *whole})
            while chosen[0] and self.elements[self.blocks[chosen[0] - 1][0]][0] in HEADINGS:
                chosen.insert(0, chosen[0] - 1)
        chosen = [b for b in chosen if not self.noise[self.blocks[b][0]] and scores[b] >= 0]
        lines = [self._line(b) for b in chosen]
        return "\n".join(x for x in lines if x)


def learned(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Log odds of lying in content, with the sign its kind prescribes."""
    ins, outs = (sum(c[k] for c in counts.values()) + 1 for k in (0, 1))
    weights = {}
    for kind, (a, b) in counts.items():
        odds = math.log((a + 1) / ins) - math.log((b + 1) / outs)
        odds = -min(_MOST, max(_LEAST, -odds)) if kind[0] == "<" else min(_MOST, max(_LEAST, odds))
        weights[kind] = odds
    return weights


def fit_weights(pages: DataFrame, id_col: str, html_col: str, most: int = LABELLED) -> dict[str, float]:
    """Weights from ``most`` pages with article or main, first in a fixed pseudo-random order."""
    known = pages.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(html_col).alias("html"))
    sample = C.bounded_rows(known.where(F.col("html").rlike("(?i)<(article|main)[\\s>]")), "id", most).select("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(k, *c) for h in b.column(0).to_pylist() for k, c in Page(h).counts().items()]
            cols = list(zip(*rows)) or [[], [], []]
            kinds = [pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["kind", "a", "b"])

    sums = sample.mapInArrow(run, "kind string, a bigint, b bigint").groupBy("kind").agg(F.sum("a"), F.sum("b"))
    return learned({r[0]: (r[1], r[2]) for r in sums.collect()})


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: the id) and the main text of every page."""
    weights = fit_weights(pages, id_col, html_col)
    schema = T.StructType([T.StructField("text", T.StringType())])
    return C.map_text(
        pages, keep or [id_col], html_col, schema,
        lambda sources: {"text": [Page(s).main_text(weights) if s else "" for s in sources]},
    )
