"""Main text of web pages: gradient-boosted trees over DOM-node features, decoded down the tree.

A page is parsed into block nodes (inline tags belong to the block around them).  Every node gets features: its kind of tag, tokens of
its class, id and role by topic, and of its ancestors', text, links, sentence marks and controls in its subtree, depth, place and size
among its siblings.  Boosted trees give the log-odds that a node holds part of the article.  Decoding chooses the best consistent
labelling: a node is kept only if all its ancestors are, and the kept nodes are those with the largest sum of log-odds, so a
dropped ancestor never has a kept descendant.

The trees are fitted here, on ``pages`` generated pages of random words whose labels are known from their making; the number is a
documented bound and no page of the input is used for fitting.

Text: character references decoded, white space inside a block (``br`` too) one blank, blocks trimmed and joined by one line feed
in page order.  Text in script, style, head and other hidden elements is never text.

Defined results: null and empty html give the empty text; html without tags is one block and is kept; unclosed tags and comments
end where HTML ends them, at the latest with the page; pages are used whole; repeated rows give repeated results; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: Element names by role in a document.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe xmp noembed noframes svg math object canvas audio video head title textarea select option button datalist".split())
RAW_TEXT = frozenset("script style iframe xmp noembed noframes title textarea".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCKS - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "legend"} | {"hr"}
SCOPE = frozenset("html table td th caption".split())
ENDED_BY = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
CONTROLS = frozenset("input button select textarea label".split())
KINDS = ("article main", "section", "div", "p", "blockquote pre", "h1 h2 h3 h4 h5 h6 hgroup", "ul ol dl menu dir", "li dt dd", "nav", "header", "footer", "aside", "form fieldset", "table tbody thead tfoot tr td th caption", "figure figcaption", "html body")
KIND_OF = {tag: i for i, line in enumerate(KINDS) for tag in line.split()}

#: Attribute tokens by topic; the first topic speaks for the article, the others against it.
TOPICS = (
    "article content contents post entry story main body text prose page blog news copy document detail",
    "nav navigation navbar menu menus links breadcrumb breadcrumbs pagination pager toc tabs",
    "header masthead banner logo branding topbar top hero",
    "footer foot bottom copyright contentinfo legal colophon imprint",
    "sidebar side aside widget widgets related recommended recommendations more popular trending complementary rail teaser",
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner commercial dfp outbrain taboola",
    "comment comments discussion disqus reply replies respond reactions feedback reviews",
    "cookie cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe subscription signup message warning paywall",
    "share sharing social facebook twitter follow tags tag meta author byline rating print tools toolbar login search form hidden",
)
TOPIC_OF: dict[str, int] = {}
for _i, _line in enumerate(TOPICS):
    for _w in _line.split():
        TOPIC_OF.setdefault(_w, _i)

_NAME = re.compile(r"""/?([a-zA-Z][^\s/>"']*)""")
_STOP = re.compile("[>\"']")
_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_MARKS = re.compile(r"[.!?,;:]")


class Node:
    __slots__ = ("tag", "parent", "depth", "topics", "hidden", "children", "own_chars", "own_links", "marks", "controls", "at", "order", "chars", "links", "sum_marks", "sum_controls", "paras", "nodes")

    def __init__(self, tag: str, parent: int, depth: int, topics: tuple, hidden: bool, at: int, order: int = 0):
        self.tag, self.parent, self.depth, self.topics, self.hidden, self.at, self.order = tag, parent, depth, topics, hidden, at, order
        self.children: list[int] = []
        self.own_chars = self.own_links = self.marks = self.controls = 0


def _read_attributes(raw: str) -> tuple[tuple, bool]:
    topics, hidden = [0] * len(TOPICS), False
    for name, value in _ATTR.findall(raw):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            hidden = True
        elif name in ("class", "id", "role", "aria-label"):
            for token in _TOKEN.findall(value):
                topic = TOPIC_OF.get(token.lower())
                if topic is not None:
                    topics[topic] += 1
    return tuple(topics), hidden


_short_attributes = lru_cache(4096)(_read_attributes)


def _attributes(raw: str) -> tuple[tuple, bool]:
    """Topics of an element's attributes and whether they hide it; those of usual length are remembered."""
    return _short_attributes(raw) if len(raw) <= 200 else _read_attributes(raw)


def _tag_end(page: str, at: int, failed: set[int]) -> int:
    """The place after the ``>`` that ends a tag, quoted values passed over; -1 if an open quote leaves it without end.

    ``failed`` holds the opening quotes that an earlier call found to lead nowhere, so that no stretch of a page is walked again and again.
    """
    seen: list[int] = []
    while m := _STOP.search(page, at):
        here = m.start()
        if m[0] == ">":
            return here + 1
        if here in failed:
            break
        seen.append(here)
        close = page.find(m[0], here + 1)
        if close < 0:
            break
        at = close + 1
    failed.update(seen)
    return -1


def tags(page: str):
    """(start, end, name, closing, attributes) of each tag and comment, by one walk over the page; the name is empty for what is skipped.

    The consumer may send a place from which to go on.
    """
    failed: set[int] = set()
    last, at = page.rfind(">"), 0
    while (start := page.find("<", at)) >= 0:
        if page.startswith("<!--", start):
            close = page.find("-->", start + 4)
            found = (start, close + 3 if close >= 0 else len(page), "", False, "")
        elif start > last:  # no tag can end any more, only a comment could
            at = start + 1
            continue
        elif page[start + 1 : start + 2] in ("!", "?"):
            found = (start, page.index(">", start) + 1, "", False, "")
        elif m := _NAME.match(page, start + 1):
            end = _tag_end(page, m.end(), failed)
            if end > 0:
                found = (start, end, m[1].lower(), m[0][0] == "/", page[m.end() : end - 1])
            else:
                found = (start, page.index(">", start) + 1, "", False, "")
        else:
            at = start + 1
            continue
        onward = yield found
        at = found[1] if onward is None else onward


@lru_cache(None)
def _closing(tag: str) -> re.Pattern:
    """Of the bounded number of raw elements."""
    return re.compile(rf"</{tag}\s*>", re.I)


def parse(page: str) -> tuple[list[Node], list[tuple[int, int, str]]]:
    """Block nodes in page order, and the text pieces (node, block, decoded text)."""
    nodes = [Node("html", -1, 0, (0,) * len(TOPICS), False, 0)]
    pieces: list[tuple[int, int, str]] = []
    stack: list[tuple[str, int]] = [("html", 0)]
    depths: dict[str, list[int]] = {"html": [0]}
    here, block, links, chars, at = 0, 0, 0, 0, 0

    def text(raw: str) -> None:
        nonlocal chars
        if not raw:
            return
        got = entities.unescape(raw) if "&" in raw else raw
        pieces.append((here, block, got))
        n = len(got) if not got.isspace() else 0
        node = nodes[here]
        node.own_chars += n
        node.marks += len(_MARKS.findall(got))
        if links:
            node.own_links += n
        chars += n

    def drop_to(depth: int) -> None:
        """Close all open elements from ``depth`` on."""
        nonlocal here, block, links
        for tag, _ in stack[depth:]:
            links -= tag == "a"
            block += tag in BLOCKS
            depths[tag].pop()
        del stack[depth:]
        here = stack[-1][1] if stack else 0

    def push(tag: str) -> None:
        depths.setdefault(tag, []).append(len(stack))
        stack.append((tag, here))

    def deepest(names) -> int:
        return max((depths[x][-1] for x in names if depths.get(x)), default=0)

    def find(names, stop) -> int:
        """Depth of the innermost open element of ``names``, 0 if there is none or one of ``stop`` is open inside it."""
        d = deepest(names)
        return d if d and d >= deepest(stop) else 0

    unclosed: set[str] = set()

    def closing(tag: str, at: int):
        """The closing tag of a raw element from ``at`` on; once there is none, there is none later."""
        if tag in unclosed:
            return None
        m = _closing(tag).search(page, at)
        if not m:
            unclosed.add(tag)
        return m

    end, walk, onward = 0, tags(page), None
    while True:
        try:
            start, after, tag, ends, raw = walk.send(onward)
        except StopIteration:
            break
        onward = None
        if start > end:
            text(page[end:start])
        end = after
        if not tag:
            continue
        if ends:
            d = find((tag,), SCOPE - {tag} if tag in ("p", "li", "a", "b", "i", "em", "span") else ())
            if d and tag not in ("body", "html"):
                drop_to(d)
            continue
        if tag in RAW:
            if tag in CONTROLS:
                nodes[here].controls += 1
            if raw.endswith("/"):
                continue
            m = closing(tag, end)
            if m or tag in RAW_TEXT:
                end = onward = m.end() if m else len(page)
            continue
        if tag in CONTROLS:
            nodes[here].controls += 1
        if tag in VOID:
            if tag == "br":
                text(" ")
            elif tag == "hr":
                block += 1
            continue
        if tag in ("html", "body"):
            if tag == "body" and len(nodes) == 1:
                topics, hidden = _attributes(raw)
                nodes.append(Node("body", 0, 1, topics, False, chars))
                nodes[0].children.append(1)
                here = 1
                push("body")
            continue
        if tag in CLOSES_P and (d := find(("p",), SCOPE)):
            drop_to(d)
        if tag in ENDED_BY and (d := find(*ENDED_BY[tag])):
            drop_to(d)
        if tag in BLOCKS:
            block += 1
            topics, hidden = _attributes(raw) if raw else (nodes[0].topics, False)
            nodes.append(Node(tag, here, nodes[here].depth + 1, topics, hidden, chars, len(nodes[here].children)))
            nodes[here].children.append(len(nodes) - 1)
            here = len(nodes) - 1
        if not raw.endswith("/") or tag in BLOCKS:
            links += tag == "a"
            push(tag)
    if end < len(page):
        text(page[end:])
    for node in nodes:
        node.chars, node.links, node.sum_marks, node.sum_controls, node.paras, node.nodes = node.own_chars, node.own_links, node.marks, node.controls, int(node.tag == "p"), 1
    for node in reversed(nodes):
        if node.parent >= 0:
            up = nodes[node.parent]
            up.chars += node.chars
            up.links += node.links
            up.sum_marks += node.sum_marks
            up.sum_controls += node.sum_controls
            up.paras += node.paras
            up.nodes += node.nodes
    return nodes, pieces


def features(nodes: list[Node]) -> list[list[float]]:
    """A row for each node."""
    total = max(nodes[0].chars, 1)
    rows: list[list[float]] = []
    above: list[tuple[list[int], int, int, int]] = []
    for i, x in enumerate(nodes):
        kind = KIND_OF.get(x.tag, len(KINDS))
        if i:
            up_topics, up_kinds, up_place, up_hidden = above[x.parent]
            family = nodes[x.parent].children
            parent_chars = max(nodes[x.parent].chars, 1)
        else:
            up_topics, up_kinds, up_place, up_hidden, family, parent_chars = [0] * len(TOPICS), 0, 0, 0, [0], total
        above.append(([a + b for a, b in zip(up_topics, x.topics, strict=True)], up_kinds | 1 << kind, 0, up_hidden | x.hidden))
        place = x.at / total
        n = len(family)
        chars = x.chars
        rows.append([
            kind, *x.topics, sum(up_topics[1:]), up_topics[0], up_topics[4], up_topics[6],
            float(up_kinds >> 0 & 1), float(up_kinds >> 8 & 1), float(up_kinds >> 9 & 1), float(up_kinds >> 10 & 1), float(up_kinds >> 11 & 1), float(up_kinds >> 12 & 1),
            math.log1p(chars), x.links / max(chars, 1), x.sum_marks / max(chars, 1), math.log1p(chars / x.nodes), math.log1p(x.paras), chars / total, chars / parent_chars,
            x.sum_controls, x.depth, place, n, x.order / n, float(x.hidden or up_hidden), math.log1p(x.nodes), math.log1p(x.own_chars),
        ])
    kinds = len(KINDS) + 1
    return [[float(r[0] == k) for k in range(kinds)] + r[1:] for r in rows]


class BoostedTrees:
    """Binary gradient boosting on quantile bins; trees of fixed depth, stored as arrays."""

    def __init__(self, rounds: int = 60, depth: int = 4, rate: float = 0.25, bins: int = 32, least: float = 8.0, l2: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.least, self.l2 = rounds, depth, rate, bins, least, l2

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = self._bin(x)
        rate = y.mean()
        self.start = float(np.log(rate / (1 - rate)))
        score = np.full(len(y), self.start)
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        width, wide = 1 << self.depth, self.bins + 1
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            grad, hess = y - p, p * (1 - p)
            node = np.zeros(len(y), dtype=np.int64)
            feature, cut = np.zeros(width, dtype=np.int64), np.full(width, self.bins, dtype=np.int64)
            for level in range(self.depth):
                count = 1 << level
                best = np.full(count, 1e-6)
                which, where = np.zeros(count, dtype=np.int64), np.full(count, self.bins, dtype=np.int64)
                for j in range(x.shape[1]):
                    cell = node * wide + binned[:, j]
                    g = np.bincount(cell, grad, count * wide).reshape(count, wide).cumsum(1)
                    h = np.bincount(cell, hess, count * wide).reshape(count, wide).cumsum(1)
                    gr, hr = g[:, -1:] - g, h[:, -1:] - h
                    gain = g**2 / (h + self.l2) + gr**2 / (hr + self.l2) - g[:, -1:] ** 2 / (h[:, -1:] + self.l2)
                    gain[(h < self.least) | (hr < self.least)] = 0
                    at = gain.argmax(1)
                    top = gain[np.arange(count), at]
                    better = top > best
                    best[better], which[better], where[better] = top[better], j, at[better]
                feature[count - 1 : 2 * count - 1], cut[count - 1 : 2 * count - 1] = which, where
                node = node * 2 + (binned[np.arange(len(y)), which[node]] > where[node])
            g, h = np.bincount(node, grad, width), np.bincount(node, hess, width)
            leaf = self.rate * g / (h + self.l2)
            score += leaf[node]
            self.trees.append((feature, cut, leaf))
        return self

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        binned, rows = self._bin(x), np.arange(len(x))
        score = np.full(len(x), self.start)
        for feature, cut, leaf in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            for level in range(self.depth):
                at = node + (1 << level) - 1
                node = node * 2 + (binned[rows, feature[at]] > cut[at])
            score += leaf[node]
        return score


def decode(nodes: list[Node], odds: np.ndarray) -> list[bool]:
    """The consistent labelling with the largest sum of log-odds; the roots are always kept."""
    best = odds.tolist()
    for i in range(len(nodes) - 1, 0, -1):
        if best[i] > 0:
            best[nodes[i].parent] += best[i]
    kept = [True] * len(nodes)
    for i, x in enumerate(nodes):
        if i and x.tag != "body":
            kept[i] = kept[x.parent] and best[i] > 0 and not x.hidden
    return kept


def assemble(pieces: list[tuple[int, int, str]], kept: list[bool]) -> str:
    out: list[str] = []
    run: list[str] = []
    last = None
    for node, block, text in pieces:
        if kept[node]:
            if block != last and run:
                out.append(" ".join("".join(run).split()))
                run = []
            run.append(text)
            last = block
    out.append(" ".join("".join(run).split()))
    return "\n".join(x for x in out if x)


def _make_page(rng: random.Random) -> str:
    """A page of random words; what belongs to the article carries the letter ``ñ`` in each word, so that labels can be read off."""

    def words(n: int, good: bool) -> str:
        made = ["".join(rng.choices("abdeghilmnoprstu", k=rng.randint(2, 9))) + ("ñ" if good else "") for _ in range(n)]
        for i in range(0, len(made), rng.randint(6, 14)):
            made[i] = made[i].capitalize()
            if i:
                made[i - 1] += rng.choice(".,.;.?!.")
        return " ".join(made) + rng.choice([".", ".", ""])

    def attrs(names: str, chance: float = 0.8) -> str:
        if rng.random() > chance:
            return ""
        name = rng.choice(names.split())
        return f' {rng.choice(["class", "class", "id"])}="{rng.choice(["", "site-", "page-", "main-", "l-", "c-"])}{name}{rng.choice(["", "-1", "-wrap", " box", "Area"])}"'

    def links(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{i}">{words(rng.randint(1, 3), False)}</a></li>' for i in range(n)) + "</ul>" if rng.random() < 0.8 else " | ".join(f'<a href="/{i}">{words(rng.randint(1, 2), False)}</a>' for i in range(n))

    def nav() -> str:
        tag = rng.choice(["nav", "nav", "div", "ul"])
        return f"<nav{attrs('menu nav links', 0.4)}>{links(rng.randint(2, 12))}</nav>" if tag == "nav" else f"<div{attrs('nav menu navbar navigation breadcrumb links pagination', 1)}>{links(rng.randint(2, 12))}</div>"

    def form() -> str:
        return f"<form{attrs('search login subscribe newsletter signup', 0.5)}><label>{words(2, False)}</label><input type=text><p>{words(rng.randint(2, 12), False)}</p><button>{words(1, False)}</button></form>"

    def notice() -> str:
        return f"<div{attrs('cookie-notice consent alert notice popup newsletter message', 1)}><p>{words(rng.randint(5, 40), False)}</p>{'<button>ok</button>' * rng.randint(0, 1)}</div>"

    def advert() -> str:
        inner = words(rng.randint(2, 40), False)
        return rng.choice([f"<div{attrs('ad ads advert sponsored promo advertisement', 1)}>{inner}</div>", f"<aside{attrs('ad ads sponsored', 1)}><p>{inner}</p></aside>", f"<div{attrs('ad promo', 1)}><a href=x>{inner}</a></div>", f"<section{attrs('promo sponsored', 1)}><h3>{words(2, False)}</h3><p>{inner}</p></section>"])

    def side() -> str:
        tag = rng.choice(["aside", "aside", "div", "section"])
        inner = "".join(rng.choice([lambda: f"<h3>{words(2, False)}</h3>{links(rng.randint(2, 8))}", lambda: f"<p>{words(rng.randint(4, 40), False)}</p>", form, advert])() for _ in range(rng.randint(1, 4)))
        return f"<{tag}{attrs('sidebar widget related recommended side popular rail', 1 if tag != 'aside' else 0.6)}>{inner}</{tag}>"

    def share() -> str:
        return f"<div{attrs('share social tags tools byline author-box', 1)}>{links(rng.randint(1, 5))}</div>"

    def comments() -> str:
        tag = rng.choice(["section", "div", "div", "ol"])
        each = "".join(f"<{'li' if tag == 'ol' else rng.choice(['div', 'article'])}{attrs('comment reply comment-body', 0.9)}><b>{words(1, False)}</b><p>{words(rng.randint(3, 60), False)}</p></{'li' if tag == 'ol' else 'div'}>" for _ in range(rng.randint(1, 6)))
        return f"<{tag}{attrs('comments discussion comment-list respond reviews', 1)}><h2>{words(rng.randint(1, 2), False)}</h2>{each}{form() if rng.random() < 0.4 else ''}</{tag}>"

    def head() -> str:
        tag = rng.choice(["header", "header", "div"])
        return f"<{tag}{attrs('header masthead banner topbar branding', 1 if tag == 'div' else 0.5)}><a href=/>{words(rng.randint(1, 3), False)}</a>{'<p>' + words(rng.randint(2, 15), False) + '</p>' if rng.random() < 0.5 else ''}{nav() if rng.random() < 0.5 else ''}{form() if rng.random() < 0.2 else ''}</{tag}>"

    def foot() -> str:
        tag = rng.choice(["footer", "footer", "div"])
        inner = rng.choice([f"&copy; {words(rng.randint(2, 60), False)}", f"&copy; {words(1, False)} &middot; {words(rng.choice([1, 4, 15, 40, 90]), False)}", f"<p>{words(rng.randint(3, 40), False)}</p>", links(rng.randint(2, 9)), links(rng.randint(2, 9)) + f"<p>{words(rng.randint(3, 30), False)}</p>"])
        return f"<{tag}{attrs('footer copyright bottom legal imprint', 1 if tag == 'div' else 0.4)}>{inner}</{tag}>"

    def para() -> str:
        text = words(rng.choice([1, 2, 2, 3, 5, 12, 30, 60, 120]), True)
        if rng.random() < 0.2:
            text += f' <a href="/x">{words(2, True)}</a> {words(4, True)}'
        return rng.choice([f"<p>{text}</p>"] * 4 + [f"<p><b>{text}<br>", f"<p>{text}", f"<div>{text}</div>", f"<p><em>{text}</em></p>"])

    def body_part() -> str:
        r = rng.random()
        if r < 0.62:
            return para()
        if r < 0.72:
            return f"<h{k}>{words(rng.randint(1, 6), True)}</h{k}>" if (k := rng.randint(2, 4)) else ""
        if r < 0.80:
            return f"<{(t := rng.choice(['ul', 'ol']))}>" + "".join(f"<li>{words(rng.randint(1, 20), True)}</li>" for _ in range(rng.randint(1, 6))) + f"</{t}>"
        if r < 0.84:
            return f"<blockquote><p>{words(rng.randint(4, 30), True)}</p></blockquote>"
        if r < 0.87:
            return f"<pre>{words(rng.randint(3, 20), True)}</pre>"
        if r < 0.90:
            return "<table>" + "".join("<tr>" + "".join(f"<td>{words(rng.randint(1, 3), True)}</td>" for _ in range(3)) + "</tr>" for _ in range(rng.randint(1, 5))) + "</table>"
        if r < 0.92:
            return f"<figure><img src=x><figcaption>{words(rng.randint(2, 12), True)}</figcaption></figure>"
        return rng.choice([advert, share, side, form, notice])()

    title = rng.choice([f"<h1>{words(rng.choice([1, 2, 3, 6, 12]), True)}</h1>", f"<header><h1>{words(rng.randint(2, 9), True)}</h1></header>", f"<h2>{words(rng.randint(2, 9), True)}</h2>", ""])
    inner = title + "".join(body_part() for _ in range(rng.choice([0, 1, 1, 2, 4, 8, 16] * 3 + [100])))
    tag = rng.choice(["article"] * 4 + ["main", "div", "div", "div", "section"])
    good = attrs("content post entry article story text body article-body post-content main", 1 if tag in ("div", "section") and rng.random() < 0.8 else 0.3)
    inner = f"<{tag}{good}>{inner}" + ("" if rng.random() < 0.05 else f"</{tag}>")
    if rng.random() < 0.3:
        inner = f"<{(t := rng.choice(['main', 'div', 'section']))}{attrs('content main page wrapper container', 0.7)}>{inner}{comments() if rng.random() < 0.3 else ''}</{t}>"
    parts = [x() for x in (head, nav, notice, advert, side) if rng.random() < 0.5]
    rng.shuffle(parts)
    after = [x() for x in (side, comments, advert, nav, form, notice) if rng.random() < 0.3]
    rng.shuffle(after)
    page = "".join(parts) + inner + "".join(after) + (foot() if rng.random() < 0.8 else "")
    if rng.random() < 0.3:
        page = f"<div{attrs('wrapper container page site', 0.7)}>{page}</div>"
    return f"<!DOCTYPE html><html><head><title>{words(3, False)}</title><style>p{{}}</style></head><body>{page}</body></html>"


@lru_cache(2)
def model(pages: int = 1000, seed: int = 7) -> BoostedTrees:
    """Trees fitted on ``pages`` generated pages; fitted once in a process."""
    rng = random.Random(seed)
    rows, labels = [], []
    for _ in range(pages):
        nodes, pieces = parse(_make_page(rng))
        good = [0] * len(nodes)
        for node, _, text in pieces:
            good[node] += "ñ" in text
        for i in range(len(nodes) - 1, 0, -1):
            good[nodes[i].parent] += good[i]
        for i, (x, row) in enumerate(zip(nodes, features(nodes), strict=True)):
            if x.tag not in ("html", "body") and (x.chars or x.nodes > 1):
                rows.append(row)
                labels.append(good[i] > 0)
    return BoostedTrees().fit(np.array(rows), np.array(labels, dtype=float))


def extract_pages(pages: list[str | None], trees: BoostedTrees) -> list[str]:
    """The main text of each page."""
    parsed = [parse(x or "") for x in pages]
    sizes = [len(nodes) for nodes, _ in parsed]
    odds = trees.log_odds(np.array([row for nodes, _ in parsed for row in features(nodes)])) if parsed else np.empty(0)
    out, at = [], 0
    for (nodes, pieces), size in zip(parsed, sizes, strict=True):
        out.append(assemble(pieces, decode(nodes, odds[at : at + size])))
        at += size
    return out


def extract_text(pages: DataFrame, html_col: str = "html", out_col: str = "text", trees: BoostedTrees | None = None) -> DataFrame:
    """``pages`` without ``html_col`` and with ``out_col``, the main text; a column of that name is replaced."""
    small_batches(pages.sparkSession)
    trees = trees or model()
    keep = [c for c in pages.columns if c not in (html_col, out_col)]
    chosen = pages.select(*keep, F.col(html_col).cast("string").alias(html_col))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    schema += ", " * bool(schema) + f"`{out_col}` string"

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = extract_pages(b.column(b.num_columns - 1).to_pylist(), trees)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(made, pa.string())], names=[*b.schema.names[:-1], out_col])

    return chosen.mapInArrow(texts, schema)


def page_digest(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return extract_text(rows).withColumn("n_chars", F.length("text").cast("long"))
