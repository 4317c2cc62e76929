"""Main text of web pages by tag-path ratios.

A page is cut into blocks of text; each has the path of open block elements (tag and classes) from the root. All blocks of
one path are one kind: its ratio is text length per block, raised by punctuation per block and lowered by linked text.
Ratios are smoothed with the ratio of everything under the same parent path, fused into one score, and paths above a
share of the page's text-weighted mean score are content. The weight of their blocks decides between the article and main
elements (with a bonus) and the deepest element with most of the other text. The result is the text of the nodes so
chosen, without paths of low ratio that are mostly linked and without labelled boilerplate, so short lines, headings
and lists of the article stay. An element is labelled by its class or id (hints), its role, or as a form.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Element names of the HTML standard.
RAW = "script style noscript template textarea select option button iframe object svg math canvas audio video title".split()
INLINE = (
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr br"
).split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
SKIPPED = "head nav footer aside dialog menu".split()
HINTS = (
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline-share comment comments commentlist "
    "consent cookie cookies copyright disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter "
    "notice notification notifications pager pagination paywall popup promo promotion recommended related replies respond "
    "share sharing sidebar signup site-header site-footer skip-link social sponsor sponsored subscribe tags toolbar widget"
).split()
LAYOUT = "area bar block box buttons container inner item items link links list message panel section slot unit wrap wrapper".split()
ROLES = "navigation banner contentinfo complementary search form dialog alert menu menubar".split()
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
FENCES = {"ul", "ol", "dl", "table", "div", "article", "section", "main", "blockquote", "body", "html", "aside", "nav", "footer", "header", "form"}
RATIO = 0.25
MOST = 0.8
BONUS = 2.0  # weight of text inside article and main elements
LINKED = 0.5
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
WRAPS = 0.5  # share of the page's text from which a form, or a labelled element around an article, is a wrapper
WHOLE = 0.95  # share from which any other labelled element is

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)",
    re.S | re.I,
)
INSIDE = re.compile(r">|=\s*+([\"'])")
ENDS = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
ATTRIBUTE = re.compile(r"([^\s=\"'/>]++)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？、]")


@dataclass
class Node:
    tag: str
    path: int  # number of the path of tags and classes from the root
    parent: Node | None
    skipped: bool
    content: bool = False  # an article or main element, or inside one
    chars: int = 0
    labelled: bool = False  # a form, or named boilerplate by class, id or role
    around: bool = False  # holds an article or main element
    size: int = 0
    dropped: bool = False
    under: bool = False  # is the chosen node, or lies in it


@dataclass
class Block:
    node: Node
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def _hint(name: str) -> bool:
    """A whole class or id name that is a hint, or is made of hints and words of layout alone (cookie-notice, ad-slot)."""
    parts = re.split(r"[-_]", name)
    return name in HINTS or (not set(parts).isdisjoint(HINTS) and set(parts) <= {*HINTS, *LAYOUT})


def _attributes(text: str) -> tuple[list[str], bool, bool]:
    """Names of class and id, whether the element is hidden, and whether its role labels it."""
    names, hidden, role, seen = [], False, False, set()
    for kind, *values in ATTRIBUTE.findall(text or ""):
        kind, value = kind.lower(), next((v for v in values if v), "")
        if kind in seen:
            continue
        seen.add(kind)
        if kind == "hidden":
            hidden = True
        elif kind == "role":
            role = value.lower() in ROLES
        elif kind in ("class", "id"):
            names += value.lower().split()
    return names, hidden, role


def _open(tag: str, attributes: str, parent: Node, paths: dict[tuple[int, str], int]) -> Node:
    names, hidden, labelled = _attributes(attributes)
    content = parent.content or tag in ("article", "main")
    skipped = tag in SKIPPED or (tag == "header" and not content) or hidden
    if tag not in ("html", "body", "article", "main"):
        labelled |= tag == "form" or any(_hint(n) and not (content and n == "header") for n in names)
    else:
        labelled = False
    step = tag + "".join(f".{n}" for n in sorted(names))
    if tag in ("article", "main"):
        above = parent
        while above and not above.around:
            above.around, above = True, above.parent
    path = paths.setdefault((parent.path, step), len(paths) + 1)
    return Node(tag, path, parent, parent.skipped or skipped, content, labelled=labelled)


def _drop(blocks: list[Block], nodes: list[Node]) -> list[Block]:
    """Blocks outside labelled elements, where an element that holds most of the page's text is no boilerplate."""
    total = 0
    for b in blocks:
        total += len(b.text)
        b.node.size += len(b.text)
    for node in reversed(nodes):  # a node stands behind its parent
        if node.parent:
            node.parent.size += node.size
    for node in nodes:
        found = bool(node.parent) and node.parent.dropped
        if node.labelled and not found:
            inside = node.parent.content
            wraps = (node.tag == "form" or node.around) and node.size >= WRAPS * total
            found = inside or not (wraps or node.size >= WHOLE * total)
        node.dropped = found
    return [b for b in blocks if not b.node.dropped]


class _Tags:
    """Ends of tags in a page: the first ``>`` outside quoted values, found in one pass whatever their length."""

    def __init__(self, page: str) -> None:
        self.page, self.lost = page, set()

    def end(self, at: int) -> int:
        """Place behind the tag whose name ends at ``at``; -1 if nothing ends it."""
        while m := INSIDE.search(self.page, at):
            if not m[1]:
                return m.end()
            close = -1 if m[1] in self.lost else self.page.find(m[1], m.end())
            if close < 0:  # a quote that nothing closes is no quote, here and further on
                self.lost.add(m[1])
                at = m.end()
            else:
                at = close + 1
        return -1


def _blocks(page: str) -> tuple[list[Block], list[Node]]:
    """Blocks of text in page order, and all nodes, parents first."""
    root = Node("", 0, None, False)
    open_, nodes, paths = [root], [root], {}
    counts: Counter = Counter()  # of open elements by tag
    tags = _Tags(page)
    blocks, block, links, at = [], Block(root), 0, 0
    muted, depth = "", 0  # an inline element that is hidden or labelled, and how many of its tag are open in it

    def end() -> None:
        nonlocal block, depth
        depth = 0
        if block.parts:
            text = "".join(block.parts)
            block.text = " ".join((entities.unescape(text) if "&" in text else text).split())
            if block.text:
                blocks.append(block)
        block = Block(open_[-1])

    def close(tags: set[str], fences: set[str]) -> None:
        """Closes the innermost open element among ``tags``, not beyond a fence."""
        if not any(counts[t] for t in tags):
            return
        for k in range(len(open_) - 1, 0, -1):
            if open_[k].tag in tags:
                counts.subtract(n.tag for n in open_[k:])
                del open_[k:]
                return
            if open_[k].tag in fences:
                return

    def add(text: str) -> None:
        if text and not depth and not open_[-1].skipped:
            block.parts.append(text)
            if links:
                block.linked += len(text)

    endless = set()  # raw elements that nothing ends any more
    while token := TOKEN.search(page, at):
        tag = (token[2] or "").lower()
        stop = tags.end(token.end()) if tag else token.end()
        if stop < 0:
            break
        add(page[at : token.start()])
        at = stop
        if not tag:
            continue
        attributes = page[token.end() : stop - 1]
        if tag in ENDS:
            if not token[1]:
                last = None if tag in endless else ENDS[tag].search(page, at)
                if last:
                    at = last.end()
                elif tag in ("script", "style"):
                    at = len(page)
                else:
                    endless.add(tag)
            continue
        if tag in INLINE:
            if tag == "a":
                links = max(0, links + (-1 if token[1] else 1))
            elif tag == "br":
                add(" ")
            if depth:
                depth += (tag == muted) * (-1 if token[1] else 1)
            elif attributes and not token[1] and tag not in VOID:
                names, hidden, role = _attributes(attributes)
                if hidden or role or any(_hint(n) for n in names):
                    muted, depth = tag, 1
            continue
        if token[1]:
            if tag in VOID:
                continue
            close({tag}, set())
        elif tag not in VOID:
            close({"p"}, FENCES)
            if tag in CLOSED_BY:
                close(CLOSED_BY[tag], FENCES)
            open_.append(_open(tag, attributes, open_[-1], paths))
            nodes.append(open_[-1])
            counts[tag] += 1
            if tag in ("article", "body", "div", "p"):
                links = 0
        end()
    add(page[at:])
    end()
    return blocks, nodes


def main_text(page: str | None) -> str:
    """Main text of one page; empty for null, empty or text-free pages."""
    blocks, nodes = _blocks(page or "")
    blocks = _drop([b for b in blocks if not b.node.skipped], nodes)
    if not blocks:
        return ""
    kinds: dict[int, list[float]] = defaultdict(lambda: [0, 0, 0, 0])  # blocks, characters, punctuation, linked characters
    parents: dict[int, list[float]] = defaultdict(lambda: [0, 0, 0, 0])
    for b in blocks:
        size = len(b.text)
        for sums in (kinds[b.node.path], parents[b.node.parent.path if b.node.parent else -1]):
            for i, v in enumerate((1, size, len(PUNCTUATION.findall(b.text)), min(b.linked, size))):
                sums[i] += v

    def ratio(sums: list[float]) -> float:
        n, size, marks, linked = sums
        return size / n * (1 + marks / n) * (1 - linked / size)

    scores = {}
    for b in blocks:
        if b.node.path not in scores:
            above = b.node.parent.path if b.node.parent else -1
            scores[b.node.path] = (ratio(kinds[b.node.path]) + ratio(parents[above])) / 2
    total = sum(k[1] for k in kinds.values())
    mean = sum(scores[p] * k[1] for p, k in kinds.items()) / total
    chosen = [b for b in blocks if scores[b.node.path] >= RATIO * mean]
    notes = {p for p, k in kinds.items() if k[3] >= LINKED * k[1] and ratio(k) < RATIO * mean}
    blocks = [b for b in blocks if b.node.tag in HEADINGS or b.node.path not in notes]
    weight = [0.0, 0.0]
    for b in chosen:
        weight[b.node.content] += len(b.text) * (1 - min(b.linked, len(b.text)) / len(b.text))
    content = bool(weight[1]) and BONUS * weight[1] >= weight[0]
    if content:
        return "\n\n".join(b.text for b in blocks if b.node.content)
    outside = [b for b in chosen if not b.node.content]
    if weight[0]:
        chosen, blocks = outside, [b for b in blocks if not b.node.content]
    held = 0
    for b in chosen:
        held += len(b.text)
        b.node.chars += len(b.text)
    for node in reversed(nodes):
        if node.parent:
            node.parent.chars += node.chars
    first = max(chosen, key=lambda b: len(b.text)).node
    while first.parent and first.chars < MOST * held:
        first = first.parent
    if first.parent and first.tag in ("p", "li", "pre", "h1", "h2", "h3"):
        first = first.parent  # one long paragraph is not the whole node
    for node in nodes:
        node.under = node is first or (bool(node.parent) and node.parent.under)
    return "\n\n".join(b.text for b in blocks if b.node.under)


def extract(col: Column) -> Column:
    """Column of main texts. Null and empty pages, and pages without main text, give the empty text.

    A page's text depends on the page alone, so repeated rows agree; very long pages, values and paths of any depth take
    time in proportion to their length. Equal scores keep the page's order.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(p if isinstance(p, str) else "") for p in pages], dtype=object)

    return F.pandas_udf(run, "string")(col)
