"""Block trees of web pages and their features."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np

_TOKEN = re.compile(
    # a quote without a partner is a character like others; a tag whose quotes swallow its end, ends at the first ">"
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+|[^>]*+)>|<[!?/][^>]*+>""", re.S
)
#: A comment that the page does not end.
_OPEN = re.compile(r"<!--.*\Z|<!\[CDATA\[.*\Z", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: What stands inside these is no text of the page.
RAW = frozenset("script style template title".split())
_RAW_END = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in RAW}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "html head body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th pre blockquote "
    "figure figcaption nav header footer aside form fieldset legend label button select option textarea address details summary dialog menu center hgroup search".split()
)
#: A start tag on the left ends an open element on the right, looked for up to the bounds.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_BOUNDS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
#: Inside a paragraph these are part of it, although they are blocks elsewhere.
_PHRASING = frozenset("label button select option textarea".split())


@dataclass
class Tree:
    """Block elements in page order: parent (-1 for the root), tag, attribute words, sizes, and runs of text."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    words: list[str] = field(default_factory=list)
    own: list[int] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    #: (node, text) in page order
    runs: list[tuple[int, str]] = field(default_factory=list)

    def add(self, parent: int, tag: str, words: str) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.words.append(words)
        self.own.append(0)
        self.linked.append(0)
        return len(self.tag) - 1


def _attribute_words(text: str) -> str:
    found = []
    for m in _ATTRIBUTE.finditer(text):
        name = m[1].lower()
        if name in ("class", "id", "role", "aria-label", "itemprop"):
            found.append(m[2] or m[3] or m[4] or "")
        elif name == "hidden" or (name == "aria-hidden" and "true" in (m[2] or m[3] or m[4] or "")):
            found.append("hidden")
        elif name == "style" and re.search(r"display\s*:\s*none", m[2] or m[3] or "", re.I):
            found.append("hidden")
    return re.sub(r"([a-z])([A-Z])", r"\1 \2", " ".join(found)).lower()


def parse(page: str) -> Tree:
    """The block tree of a page; ends of elements may be missing, tags stray."""
    tree = Tree()
    stack = [(tree.add(-1, "body", ""), "#root")]
    # how many of a tag are open, so that the stack is searched only for what is there
    open_: Counter[str] = Counter()
    buffer: list[str] = []
    links, link_chars = 0, 0
    at, n = 0, len(page)
    last_end = page.rfind(">")
    raw_ends: dict[str, int] = {}

    def shut(k: int) -> None:
        for _, name in stack[k:]:
            open_[name] -= 1
        del stack[k:]

    def flush() -> None:
        nonlocal link_chars
        if buffer:
            text = " ".join(html.unescape("".join(buffer)).split())
            if text:
                node = stack[-1][0]
                tree.runs.append((node, text))
                tree.own[node] += len(text)
                tree.linked[node] += min(len(text), link_chars)
            buffer.clear()
        link_chars = 0

    while at < n:
        # behind the last ">" only a comment without end is no text
        m = _TOKEN.search(page, at) if at <= last_end else _OPEN.search(page, at)
        end = m.start() if m else n
        if end > at:
            buffer.append(page[at:end])
            if links:
                link_chars += end - at
        if not m:
            break
        at = m.end()
        if m.re is _OPEN or not m[2]:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in RAW:
            if not closing and not m[3].rstrip().endswith("/"):
                if raw_ends.get(tag, at) < 0:
                    continue
                stop = _RAW_END[tag].search(page, at)
                if stop:
                    at = stop.end()
                elif tag in ("script", "style"):
                    at = n
                else:  # no end anywhere: the tag alone is dropped
                    raw_ends[tag] = -1
            continue
        if tag == "a":
            links = max(0, links + (-1 if closing else 1)) if closing else 1
        if tag == "br" or (tag in VOID and tag in ("hr", "img")):
            buffer.append(" ")
            if tag == "hr":
                flush()
            continue
        if tag in VOID or tag not in BLOCK:
            continue
        if closing:
            if open_[tag]:
                flush()
                k = len(stack) - 1
                while stack[k][1] != tag:
                    k -= 1
                shut(k)
                links = 0
            elif tag == "p":
                flush()
            continue
        flush()
        if tag not in _PHRASING and open_["p"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][1] == "p":
                    shut(k)
                    break
                if stack[k][1] in ("td", "th", "button", "li", "div", "section", "article"):
                    break
        if any(open_[t] for t in _CLOSES.get(tag, ())):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][1] in _BOUNDS[tag]:
                    break
                if stack[k][1] in _CLOSES[tag]:
                    shut(k)
                    break
        links = 0
        node = tree.add(stack[-1][0], tag, _attribute_words(m[3]) if m[3] else "")
        if not m[3].rstrip().endswith("/") or tag not in VOID:
            stack.append((node, tag))
            open_[tag] += 1
    flush()
    return tree


_TAGS = (
    ("article", "main"), ("h1",), ("h2", "h3", "h4", "h5", "h6", "hgroup"), ("p", "pre", "blockquote", "figure", "figcaption"),
    ("ul", "ol", "li", "dl", "dt", "dd"), ("table", "tr", "td", "th", "tbody", "thead", "tfoot", "caption"), ("nav", "menu"), ("header",), ("footer",), ("aside",),
    ("form", "fieldset", "legend", "label", "button", "select", "option", "textarea", "search"), ("head",), ("dialog",), ("body", "html"),
)
#: Words of class, id and role, in groups; each group is one feature.
_WORDS = tuple(
    re.compile(rf"(?:^|[\s_-])(?:{p})(?:$|[\s_-])")
    for p in (
        r"articles?|content|contents|post|entry|story|main|body|text|prose|articlebody",
        r"nav|navbar|navigation|menu|breadcrumbs?|pagination|pager|toc|tabs",
        r"header|masthead|banner|topbar|branding|logo",
        r"footer|foot|contentinfo|colophon|copyright|legal",
        r"sidebar|side|aside|complementary|widgets?|rail|related|recommended|more|popular|trending",
        r"ads?|adverts?|advertisement|sponsor|sponsored|sponsors|promo|promoted|promotion|outbrain|taboola",
        r"notice|notices|cookies?|consent|gdpr|alert|popup|modal|overlay|toast|newsletter|subscribe|signup|paywall|disclaimer",
        r"comments?|commentlist|discussion|replies|reply|respond|disqus|reviews?",
        r"form|search|login|register|contact|share|sharing|social|follow|tools|toolbar|buttons?|byline|meta|tags|author",
        r"hidden",
    )
)
N_FEATURES = 1 + len(_TAGS) + len(_WORDS) + 6
_TAG_NUMBER = {t: i for i, group in enumerate(_TAGS) for t in group}


def features(tree: Tree) -> np.ndarray:
    """One row of N_FEATURES for each node."""
    n = len(tree.tag)
    own, linked = np.array(tree.own, float), np.array(tree.linked, float)
    total, links = own.copy(), linked.copy()
    kids = np.zeros(n)
    for i in range(n - 1, 0, -1):
        p = tree.parent[i]
        total[p] += total[i]
        links[p] += links[i]
        kids[p] += 1
    out = np.zeros((n, N_FEATURES), np.float32)
    out[:, 0] = 1
    for i, tag in enumerate(tree.tag):
        if tag in _TAG_NUMBER:
            out[i, 1 + _TAG_NUMBER[tag]] = 1
        if tree.words[i]:
            for k, pattern in enumerate(_WORDS):
                if pattern.search(tree.words[i]):
                    out[i, 1 + len(_TAGS) + k] = 1
    base = 1 + len(_TAGS) + len(_WORDS)
    density = links / np.maximum(1, total)
    out[:, base] = density > 0.5
    out[:, base + 1] = density
    out[:, base + 2] = np.log1p(own) / 5
    out[:, base + 3] = np.log1p(total) / 8
    out[:, base + 4] = own > 100
    out[:, base + 5] = total == 0
    return out
