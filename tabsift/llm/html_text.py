"""The main text of web pages by tag-path ratios.

A page's text nodes are grouped by their path of tags from the root. For each path, text length and punctuation per
node are aggregated; both are smoothed over neighbouring blocks with like paths, fused, lowered by the share of linked
text, and compared with their spread and with what the page's text usually has: blocks that reach both pass. What is emitted:

* every block that passes, wherever it stands;
* unlinked blocks, however short, of the regions that the passing ones make out: article and main elements that hold
  some of them, or where there are none, the deepest element with most of their weight;
* headings of what is emitted.

Lists of links never pass. Parts that say what they are, by element, role or label, are left out beforehand: menus,
headers, footers, sidebars, notices, adverts, forms and reader comments. A label counts if all its parts are such words
or mere fillers (``cookie-notice``, ``site-footer``, not ``form-factor``); inside an article its own headers, footers,
forms and searches are no labels.

Defined cases: null, empty and text-free pages give ''; where nothing passes, or labels would leave nothing, they are
not believed; tags left open end with their parent or the page; stray end tags are ignored; repeated rows each get
their result.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A comment, an end tag, a start tag with its attributes, or any other declaration.
MARKUP = re.compile(
    r"""<(?:!--(?P<comment>.*?)(?:-->|--!>|\Z)|/(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"""
    r"""|(?P<start>[a-zA-Z][^\s/>]*+)(?P<attributes>(?>[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=|["'])*+)(?:>|\Z)|[!?][^>]*(?:>|\Z))""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title iframe object svg math canvas select noembed noframes xmp".split())
BLOCKS = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
# Elements that end an open one of the same kind, and where the search for it stops.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table", "thead", "tbody", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
BOUNDS = set("article aside body button caption div footer form header html main nav section table td th blockquote li dd dt figure details".split())
# Elements and labels that are not part of an article.
APART = set("nav footer aside form menu dialog button fieldset head".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
COMMENTS = set("comment comments commentlist disqus reply replies respond discussion".split())
LABELS = COMMENTS | set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar aside footer header masthead share sharing social related recommended recommendations newsletter subscribe "
    "subscription signup login popup modal overlay widget pagination pager toolbar search form disclaimer copyright skip skiplink".split()
)
# Words that say nothing in a label beside those above.
FILLERS = set(
    "box bar block container wrapper wrap slot area item items list section inner outer site page top bottom left right link links button buttons "
    "icons post posts article articles main content global unit text title group js".split()
)
# Inside an article these are the article's own.
OWN = set("header footer masthead form search banner discussion".split())
HOLDERS = {"article", "main"}
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
LISTED = set("li dt dd td th option".split())
LEAVES = HEADINGS | LISTED | {"p", "pre"}
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？]")
# The share of the usual score of a page's text that a block must reach; the spread of the scores is the other bound.
USUAL_SHARE = 0.67
LABEL_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def says(label: str, words: set[str]) -> bool:
    """Whether a class or id is made of such words, and fillers at most."""
    parts = [p.lower() for p in LABEL_PART.findall(label)]
    return any(p in words for p in parts) and all(p in words or p in FILLERS for p in parts)


class Element:
    """An element of a page's list: its parent's place in that list comes before its own."""

    __slots__ = ("tag", "place", "path", "parent", "depth", "apart", "labelled", "inside", "holder", "linked", "block")

    def __init__(self, tag: str, attributes: str, parent: Element | None, place: int, path: int):
        self.tag, self.place, self.path = tag, place, path
        self.parent = parent.place if parent else -1
        self.depth = parent.depth + 1 if parent else 0
        self.apart = parent.apart if parent else False
        self.labelled = parent.labelled if parent else False
        self.linked = tag == "a" or (parent is not None and parent.linked)
        self.block = self if parent is None or tag in BLOCKS else parent.block
        within = parent is not None and parent.inside
        self.holder = tag in HOLDERS
        if tag in APART or (tag == "header" and not within):
            self.apart = True
        if attributes and "=" in attributes:
            labels: list[str] = []
            for name, a, b, c in ATTRIBUTE.findall(attributes):
                name, value = name.lower(), a or b or c
                if name in ("class", "id"):
                    labels += html.unescape(value).split()
                elif name == "role":
                    self.apart |= value.strip().lower() in ROLES
                    self.holder |= value.strip().lower() == "main"
                elif (name == "style" and re.search(r"display\s*:\s*none", value, re.I)) or (name == "aria-hidden" and value == "true"):
                    self.apart = True
            if tag not in ("html", "body", "main"):
                own = OWN if within else set()
                self.apart |= any(says(x, COMMENTS - own) for x in labels)
                self.labelled |= tag != "article" and any(says(x, LABELS - own) for x in labels)
        self.inside = within or self.holder
        if attributes and re.search(r"(?:^|\s)hidden(?:\s|$|=)", attributes):
            self.apart = True


class Block:
    """The text between two block borders, with the nodes that it is made of."""

    __slots__ = ("element", "nodes", "length", "linked")

    def __init__(self, element: Element):
        self.element, self.nodes, self.length, self.linked = element, [], 0, 0

    def add(self, element: Element, text: str) -> None:
        self.nodes.append((element, text))
        size = len(text.strip())
        self.length += size
        self.linked += size if element.linked else 0

    @property
    def text(self) -> str:
        return " ".join("".join(t for _, t in self.nodes).split())

    @property
    def is_heading(self) -> bool:
        return self.element.tag in HEADINGS


def text_nodes(page: str) -> tuple[list[Element], list[tuple[Element, int, str]]]:
    """All elements, and (innermost element, number of the block, raw text) of every text node outside raw ones."""
    top = Element("html", "", None, 0, 0)
    every, paths = [top], {}  # a path is numbered by its parent path and its last tag
    open_, out, block, at = [top], [], 0, 0
    size = len(page)
    while at < size:
        m = MARKUP.search(page, at)
        stop = m.start() if m else size
        if stop > at:
            out.append((open_[-1], block, page[at:stop]))
        if not m:
            break
        at = m.end()
        if (tag := m["start"]) is not None:
            tag, attributes = tag.lower(), m["attributes"]
            if tag in BLOCKS:
                block += 1
            if tag in RAW and not attributes.rstrip().endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
                at = close.end() if close else size
            elif tag == "html":
                continue
            elif tag not in VOID:
                if tag in BLOCKS and tag not in SIBLINGS:  # a block ends an open paragraph
                    _close(open_, {"p"}, BOUNDS)
                elif tag in SIBLINGS:
                    _close(open_, *SIBLINGS[tag])
                path = paths.setdefault((open_[-1].path, tag), len(paths) + 1)
                open_.append(Element(tag, attributes, open_[-1], len(every), path))
                every.append(open_[-1])
        elif (tag := m["end"]) is not None:
            tag = tag.lower()
            if tag in BLOCKS:
                block += 1
            for i in range(len(open_) - 1, 0, -1):
                if open_[i].tag == tag:
                    del open_[i:]
                    break
                if open_[i].tag in BOUNDS and tag not in BLOCKS:
                    break
    return every, out


def _close(open_: list[Element], ended: set[str], bounds: set[str]) -> None:
    for i in range(len(open_) - 1, 0, -1):
        if open_[i].tag in ended:
            del open_[i:]
            return
        if open_[i].tag in bounds:
            return


def blocks_of(nodes: list[tuple[Element, int, str]]) -> list[Block]:
    """The blocks with text, in page order; a block stands in the innermost block element of its first text."""
    found: dict[int, Block] = {}
    for element, number, text in nodes:
        if text.strip() or number in found:
            found.setdefault(number, Block(element.block)).add(element, text)
    return list(found.values())


def path_ratios(blocks: list[Block]) -> tuple[np.ndarray, np.ndarray]:
    """Per block the text length and the punctuation per node of its nodes' paths, weighed by their length."""
    totals: dict[int, list[int]] = {}
    for b in blocks:
        for e, text in b.nodes:
            t = totals.setdefault(e.path, [0, 0, 0])
            t[0] += len(text.strip())
            t[1] += len(PUNCTUATION.findall(text))
            t[2] += bool(text.strip())
    lengths, marks = [], []
    for b in blocks:
        shares = [(len(t.strip()) / b.length, totals[e.path]) for e, t in b.nodes if t.strip()]
        lengths.append(sum(w * t[0] / t[2] for w, t in shares))
        marks.append(sum(w * t[1] / t[2] for w, t in shares))
    return np.array(lengths), np.array(marks)


def likeness(a: Element, b: Element, every: list[Element]) -> float:
    """How alike two paths are: the same, the same but for the last tag, alike above that, or not."""
    if a.path == b.path:
        return 1.0
    up, vp = every[a.parent].path, every[b.parent].path
    if up == vp:
        return 0.7
    return 0.4 if up == b.path or vp == a.path else 0.1


def smoothing(blocks: list[Block], every: list[Element], radius: int = 2) -> list[list[tuple[int, float]]]:
    """Per block the blocks around it with their weights: near ones with like paths weigh most."""
    out = []
    for i, b in enumerate(blocks):
        near = range(max(0, i - radius), min(len(blocks), i + radius + 1))
        weights = [(j, float(np.exp(-0.5 * (i - j) ** 2)) * likeness(b.element, blocks[j].element, every)) for j in near]
        total = sum(w for _, w in weights)
        out.append([(j, w / total) for j, w in weights])
    return out


def linked_shares(blocks: list[Block]) -> np.ndarray:
    """The share of linked text: of all blocks on the same path, of list items and cells within their own list."""
    totals: dict[tuple, list[int]] = {}
    keys = [(b.element.path, b.element.parent if b.element.tag in LISTED else -1) for b in blocks]
    for b, key in zip(blocks, keys, strict=True):
        t = totals.setdefault(key, [0, 0])
        t[0] += b.linked
        t[1] += b.length
    return np.array([0.0 if b.is_heading else totals[key][0] / totals[key][1] for b, key in zip(blocks, keys, strict=True)])


def block_scores(blocks: list[Block], every: list[Element]) -> np.ndarray:
    """Smoothed ratios of length and punctuation, fused, and lowered by the linked share."""
    lengths, marks = path_ratios(blocks)
    around = smoothing(blocks, every)
    smooth = [(sum(w * lengths[j] for j, w in near), sum(w * marks[j] for j, w in near)) for near in around]
    return np.array([np.sqrt(a * (1 + m)) for a, m in smooth]) * (1 - linked_shares(blocks))


def main_text(page: str | None) -> str:
    if not page:
        return ""
    every, found = text_nodes(page)
    nodes = [(e, b, html.unescape(t)) for e, b, t in found if not e.apart]
    blocks = blocks_of([n for n in nodes if not n[0].labelled]) or blocks_of(nodes)
    if not blocks:
        return ""
    kept = selected(blocks, every)
    return " ".join(b.text for b, keep in zip(blocks, kept, strict=True) if keep)


def selected(blocks: list[Block], every: list[Element]) -> list[bool]:
    score = block_scores(blocks, every)
    usual = np.average(score, weights=[b.length for b in blocks])  # where the page's text stands
    passing = score >= min(max(score.std(), USUAL_SHARE * usual), score.max())
    weight = [0.0] * len(every)
    for b, s, passes in zip(blocks, score.tolist(), passing.tolist(), strict=True):
        if passes:
            weight[b.element.place] += s * b.length
    for e in reversed(every[1:]):
        weight[e.parent] += weight[e.place]
    inside = in_regions(blocks, every, weight, passing)
    links = linked_shares(blocks) >= 0.5
    kept = [bool(p or (i and not n)) for p, i, n in zip(passing, inside, links, strict=True)]
    # Headings share the fate of what stands between them and the next one; those of nothing stay in their region.
    any_below, any_kept = False, False
    for i in range(len(blocks) - 1, -1, -1):
        if blocks[i].is_heading:
            kept[i] = any_kept or (inside[i] and not any_below)
            any_below, any_kept = False, kept[i] and not inside[i]
        else:
            any_below, any_kept = True, any_kept or kept[i]
    return kept


def in_regions(blocks: list[Block], every: list[Element], weight: list[float], passing: np.ndarray) -> list[bool]:
    """Which blocks lie in a region of content."""
    regions = content_holders(every, weight)
    if not regions:
        most = [e for e in every if weight[e.place] >= 0.8 * weight[0] and e.tag in BLOCKS and e.tag not in LEAVES]
        root = max(most, key=lambda e: e.depth, default=every[0])
        if root.tag in ("html", "body"):  # no region of its own: what lies between passing blocks
            first, last = int(passing.argmax()), len(blocks) - 1 - int(passing[::-1].argmax())
            return [first <= i <= last for i in range(len(blocks))]
        regions = {root.place}
    flags = [False] * len(every)
    for e in every:
        flags[e.place] = e.place in regions or (e.parent >= 0 and flags[e.parent])
    return [flags[b.element.place] for b in blocks]


def content_holders(every: list[Element], weight: list[float]) -> set[int]:
    """The outermost article and main elements with passing text; of a main, its articles if they hold half of that."""
    outer = [-1] * len(every)  # the outermost holder around an element
    articles: dict[int, list[int]] = {}
    within = [False] * len(every)  # inside an article already
    for e in every:
        up = outer[e.parent] if e.parent >= 0 else -1
        within[e.place] = e.parent >= 0 and (within[e.parent] or every[e.parent].tag == "article")
        outer[e.place] = up if up >= 0 else (e.place if e.holder else -1)
        if outer[e.place] == e.place:
            articles[e.place] = []
        elif up >= 0 and e.tag == "article" and not within[e.place]:
            articles[up].append(e.place)
    out: set[int] = set()
    for place, own in articles.items():
        if weight[place] > 0:
            parts = sum(weight[x] for x in own) >= 0.5 * weight[place]
            out.update([x for x in own if weight[x] > 0] if own and parts else [place])
    return out


def _extract(column: str):
    def run(batches):
        for pdf in batches:
            yield pdf.drop(columns=column).assign(text=[main_text(p) for p in pdf[column]])

    return run


def extract(pages: DataFrame, page_id="page_id", url="url", page="html") -> DataFrame:
    """Per page its id, url, main ``text`` and ``n_chars``."""
    body = pages.select(F.col(f"`{page_id}`").alias("key"), F.col(f"`{url}`").alias("url"), F.col(f"`{page}`").alias("page"))
    kind = {f.name: f.dataType.simpleString() for f in body.schema}
    found = body.mapInPandas(_extract("page"), f"key {kind['key']}, url {kind['url']}, text string")
    return found.select(F.col("key").alias(page_id), F.col("url").alias(url), "text", F.char_length("text").cast("long").alias("n_chars"))
