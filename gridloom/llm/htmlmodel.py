"""A tree-structured model of page content: labels of DOM nodes with parent-child potentials.

Every block element is content (or holds it) or not.  A node has a potential linear in its features,
an edge one for each pair of labels of parent and child.  Messages go from the leaves
up and from the root down (sum-product), which on a tree gives exact marginals; training
follows the gradient of the likelihood of labelled pages, features observed less
features expected under those marginals.  Many pages are one forest, handled by depth.
"""

from __future__ import annotations

import functools
import random
import re

import numpy as np

from . import htmltree


def _lse(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=-1)
    return top + np.log(np.exp(x - top[..., None]).sum(axis=-1))


class Forest:
    """Trees laid end to end, with their nodes by depth."""

    def __init__(self, trees: list[htmltree.Tree]):
        self.first = np.cumsum([0] + [len(t.tag) for t in trees])
        self.parent = np.array([p + b if p >= 0 else -1 for t, b in zip(trees, self.first) for p in t.parent], np.int64)
        depth = np.zeros(len(self.parent), np.int64)
        for i, p in enumerate(self.parent):
            if p >= 0:
                depth[i] = depth[p] + 1
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.cumsum(np.bincount(depth))[:-1]) if len(depth) else []
        self.features = np.concatenate([htmltree.features(t) for t in trees]) if trees else np.zeros((0, htmltree.N_FEATURES), np.float32)


def sum_product(forest: Forest, unary: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of nodes (n x 2) and of edges to the parent (n x 2 x 2, parent first; zero for roots)."""
    n, parent = len(unary), forest.parent
    up, message = unary.copy(), np.zeros((n, 2))
    for level in reversed(forest.levels[1:]):
        message[level] = _lse(edge[None] + up[level][:, None, :])
        np.add.at(up, parent[level], message[level])
    down = np.zeros((n, 2))
    pairs = np.zeros((n, 2, 2))
    for level in forest.levels[1:]:
        p = parent[level]
        rest = up[p] + down[p] - message[level]
        joint = rest[:, :, None] + edge[None] + up[level][:, None, :]
        down[level] = _lse(np.swapaxes(rest[:, :, None] + edge[None], 1, 2))
        flat = joint.reshape(len(level), 4)
        pairs[level] = np.exp(flat - _lse(flat)[:, None]).reshape(-1, 2, 2)
    belief = up + down
    return np.exp(belief - _lse(belief)[:, None]), pairs


class Model:
    def __init__(self, weights: np.ndarray, edge: np.ndarray):
        self.weights, self.edge = weights, edge

    def content(self, trees: list[htmltree.Tree]) -> list[np.ndarray]:
        """The probability of each node of each tree to be content."""
        forest = Forest(trees)
        if not trees:
            return []
        marginal, _ = sum_product(forest, self._unary(forest), self.edge)
        return np.split(marginal[:, 1], forest.first[1:-1])

    def _unary(self, forest: Forest) -> np.ndarray:
        return np.stack([np.zeros(len(forest.parent)), forest.features @ self.weights], 1)


def train(trees: list[htmltree.Tree], labels: list[np.ndarray], steps: int = 150, rate: float = 0.25, decay: float = 5e-5) -> Model:
    """Fit on labelled trees (one 0/1 label for each node) by Adam on the mean log-likelihood."""
    forest = Forest(trees)
    y = np.concatenate(labels).astype(int)
    child = np.flatnonzero(forest.parent >= 0)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[forest.parent[child]], y[child]), 1)
    model = Model(np.zeros(htmltree.N_FEATURES), np.zeros((2, 2)))
    theta = np.zeros(htmltree.N_FEATURES + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        marginal, pairs = sum_product(forest, model._unary(forest), model.edge)
        g = np.concatenate([forest.features.T @ (y - marginal[:, 1]), (seen - pairs.sum(axis=0)).ravel()]) / len(y) - decay * theta
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta + rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        model.weights, model.edge = theta[:-4], theta[-4:].reshape(2, 2)
    return model


# --- labelled pages -----------------------------------------------------------------------

_SYLLABLES = "ba den ki lor mu nes ta ri vo sal pe dun gar li mo fen tu ras ol ith an or es un".split()


def _sentence(r: random.Random, low: int, high: int) -> str:
    words = ["".join(r.choice(_SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(r.randint(low, high))]
    return " ".join(words).capitalize() + r.choice([".", ".", ".", "?", "!", ""])


def _text(r: random.Random, low: int, high: int) -> str:
    return " ".join(_sentence(r, 3, 14) for _ in range(r.randint(low, high)))


def _link_list(r: random.Random) -> str:
    return "<ul>" + "".join(f'<li><a href="/{i}">{_sentence(r, 1, 4)}</a></li>' for i in range(r.randint(2, 8))) + "</ul>"


def _dull(r: random.Random) -> str:
    """Attributes that tell nothing, as generated class names."""
    return f' {r.choice(["class", "class", "id"])}="{r.choice("abcsxy")}{r.choice(["", "-", "_"])}{r.randrange(1 << 20):x}"'


def _boilerplate(r: random.Random) -> str:
    name = lambda *names: f'{r.choice(["class", "id"])}="{r.choice(names)}{r.choice(["", "", " x1", "-box"])}"'
    kinds = [
        lambda: f"<nav>{_link_list(r)}</nav>",
        lambda: f"<div {name('menu', 'nav', 'navbar', 'breadcrumb')}>{_link_list(r)}</div>",
        lambda: f"<header><div>{_sentence(r, 1, 4)}</div>{r.choice(['', _link_list(r)])}<p>{_sentence(r, 2, 8)}</p></header>",
        lambda: f"<div {name('header', 'masthead', 'banner')}><p>{_sentence(r, 2, 10)}</p></div>",
        lambda: f"<footer>{r.choice(['&copy; 2020 ', ''])}{_text(r, 1, 4)}{r.choice(['', _link_list(r)])}</footer>",
        lambda: f"<div {name('footer', 'copyright', 'legal')}><p>{_text(r, 1, 3)}</p></div>",
        lambda: f"<aside><h3>{_sentence(r, 1, 3)}</h3>{r.choice([_link_list(r), '<p>' + _text(r, 1, 5) + '</p>'])}</aside>",
        lambda: f"<div {name('sidebar', 'related', 'widget', 'popular')}><h3>{_sentence(r, 1, 3)}</h3>{r.choice([_link_list(r), '<p>' + _text(r, 1, 5) + '</p>'])}</div>",
        lambda: f"<div {name('ad', 'ads', 'advert', 'sponsored', 'promo')}>{_text(r, 1, 5)}</div>",
        lambda: f"<div {name('ad', 'advertisement', 'promo')}><p>{_text(r, 1, 4)}</p></div>",
        lambda: f"<div {name('cookie-notice', 'notice', 'consent', 'newsletter', 'popup')}><p>{_text(r, 1, 4)}</p><button>{_sentence(r, 1, 2)}</button></div>",
        lambda: f"<form><label>{_sentence(r, 1, 4)}</label><input type=text><p>{_sentence(r, 2, 10)}</p><button>{_sentence(r, 1, 2)}</button></form>",
        lambda: f"<{(t := r.choice(['section', 'div']))} {name('comments', 'comment-list', 'discussion', 'reviews')}><h3>{_sentence(r, 1, 3)}</h3>"
        + "".join(f"<{(c := r.choice(['div', 'article', 'li']))} {r.choice(['class=comment', ''])}><p>{_text(r, 1, 6)}</p></{c}>" for _ in range(r.randint(1, 5)))
        + f"</{t}>",
        lambda: f"<div {name('share', 'social', 'author', 'tags')}>{_sentence(r, 1, 6)}</div>",
        lambda: f"<div class=\"hidden\"><p>{_text(r, 1, 4)}</p></div>",
        lambda: f"<div{r.choice(['', _dull(r)])}>{_link_list(r)}</div>",
        lambda: f"<div{r.choice(['', _dull(r)])}>" + r.choice([" | ", " ", "<br>"]).join(f'<a href="/{i}">{_sentence(r, 1, 3)}</a>' for i in range(r.randint(2, 9))) + "</div>",
        lambda: f"<div role=\"{r.choice(['navigation', 'banner', 'contentinfo', 'complementary', 'search'])}\"{r.choice(['', _dull(r)])}>{r.choice([_link_list(r), _text(r, 1, 2)])}</div>",
    ]
    return r.choice(kinds)()


def _content(r: random.Random) -> str:
    out = [f"<h1>{_sentence(r, 1, 9)}</h1>"] if r.random() < 0.8 else []
    if r.random() < 0.2:  # some pages have next to no text
        return "".join(out) + r.choice(["<p>{}</p>", "<p><b>{}<br>", "<p>{}", "{}"]).format(_sentence(r, 1, 4))
    plain = r.random() < 0.2  # text parted by elements that say nothing
    for _ in range(r.randint(1, 9)):
        kind = r.random()
        if plain and kind < 0.8:
            t = r.choice(["div", "div", "section", "td"])
            text = f"<{t}{r.choice(['', '', _dull(r)])}>{_text(r, 1, 7)}</{t}>"
            out.append(f"<table><tr>{text}</tr></table>" if t == "td" else text)
        elif kind < 0.7:
            text = _text(r, 1, 7)
            if r.random() < 0.2:
                text += f' <a href="/x">{_sentence(r, 1, 4)}</a> {_sentence(r, 2, 9)}'
            out.append(r.choice([f"<p>{text}</p>", f"<p>{text}", f"<p><b>{text}<br>"]))
        elif kind < 0.78:
            out.append(f"<h2>{_sentence(r, 1, 6)}</h2>")
        elif kind < 0.85:
            out.append("<ul>" + "".join(f"<li>{_sentence(r, 3, 12)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
        elif kind < 0.9:
            out.append(f"<blockquote><p>{_text(r, 1, 3)}</p></blockquote>")
        elif kind < 0.94:
            out.append("<table>" + "".join(f"<tr><td>{_sentence(r, 1, 4)}</td><td>{_sentence(r, 1, 4)}</td></tr>" for _ in range(3)) + "</table>")
        elif kind < 0.97:
            out.append(f"<div>{_text(r, 1, 5)}</div>")
        else:
            out.append(f"<pre>{_sentence(r, 2, 8)}</pre>")
    return "".join(out)


def labelled_page(seed: int) -> tuple[htmltree.Tree, np.ndarray]:
    """A generated page and the labels of its nodes: what stands in a ``data-c`` element is
    content, but for page furniture placed inside it."""
    r = random.Random(seed)
    before = "".join(_boilerplate(r) for _ in range(r.randint(0, 3)))
    after = "".join(_boilerplate(r) for _ in range(r.randint(0, 4)))
    inner = _content(r) if r.random() < 0.97 else ""
    if r.random() < 0.35:
        inner = inner + "<!--b-->" + _boilerplate(r) + "<!--/b-->" + (_content(r) if r.random() < 0.5 else "")
    tag, words = r.choice(
        [("article", "")] * 5 + [("main", ""), ("main", 'id="main"'), ("div", 'class="content"'), ("div", 'id="content"'), ("div", 'class="post-body"'), ("section", 'class="entry-content"'), ("div", ""), ("div", _dull(r)), ("div", 'role="main"'), ("div", 'class="wrap k7"'), ("div", 'class="story-text"')]
    )
    if r.random() < 0.1:
        inner = re.sub(r"^(<h1>.*?</h1>)", r"<header>\1</header>", inner)
    wrap = r.random()
    middle = f"<!--c--><{tag} {words}>{inner}</{tag}><!--/c-->"
    if wrap < 0.2:
        middle = f"<div class=\"page\">{middle}</div>"
    elif wrap < 0.3:
        middle = f"<!--c-->{inner}<!--/c-->"
    elif wrap < 0.55:  # a main part that holds more than the content
        t, w = r.choice([("main", ""), ("main", 'id="main"'), ("div", 'class="main"'), ("div", 'id="content"'), ("section", ""), ("div", 'class="wrapper"')])
        around = [_boilerplate(r) for _ in range(r.randint(0, 3))]
        k = r.randint(0, len(around))
        middle = f"<{t} {w}>{''.join(around[:k])}{middle}{''.join(around[k:])}</{t}>"
    page = f"<html><head><title>{_sentence(r, 1, 5)}</title></head><body>{before}{middle}{after}</body></html>"
    if r.random() < 0.15:
        page = before + middle + after
    return label(page)


def label(page: str) -> tuple[htmltree.Tree, np.ndarray]:
    """Read a page whose content stands between <!--c--> and <!--/c-->, less what is between <!--b--> and <!--/b-->."""
    marked = page
    for mark, tag in (("<!--c-->", "<u1>"), ("<!--/c-->", "</u1>"), ("<!--b-->", "<u2>"), ("<!--/b-->", "</u2>")):
        marked = marked.replace(mark, tag)
    tree = htmltree.parse(page)
    state, labels, seen = [0, 0], [0], 0
    counted = htmltree._TOKEN.finditer(marked)
    skip = 0
    for m in counted:
        if m.start() < skip or not m[2]:
            continue
        tag = m[2].lower()
        if tag in ("u1", "u2"):
            state[tag == "u2"] += -1 if m[1] else 1
        elif tag in htmltree.RAW and not m[1]:
            skip = marked.find(f"</{tag}", m.end())
        elif tag in htmltree.BLOCK and not m[1]:
            labels.append(int(state[0] > 0 and state[1] == 0))
            seen += 1
    if len(labels) != len(tree.tag):
        raise ValueError("labels do not fit the tree")
    # what holds content is on its path, the root and body always are: so content hangs together from the root down
    for i in range(len(labels) - 1, 0, -1):
        if labels[i] or tree.tag[i] in ("html", "body"):
            labels[i] = labels[tree.parent[i]] = 1
    labels[0] = 1
    return tree, np.array(labels)


@functools.lru_cache(maxsize=1)
def trained(pages: int = 400) -> Model:
    """The model fitted on generated labelled pages; the same on every run."""
    made = [labelled_page(s) for s in range(pages)]
    return train([t for t, _ in made], [y for _, y in made])
