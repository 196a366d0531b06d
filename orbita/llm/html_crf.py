"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks: runs of text without a block-level tag inside.  Each
block has features of its ancestor tags (element names, what their class, id and role names stand for, and
whether that is said within the innermost article or about it) and of its text; the chain labels
blocks as main or other.  Weights are trained by maximum likelihood on labelled pages, and pages
are decoded by Viterbi.

Labelled pages come from two places: ``TEMPLATES``, page layouts whose blocks are
marked by hand, filled with words of the table's own pages; and up to ``MAX_PAGES``
pages of the table that have one ``article`` element and at most ``MAX_BLOCKS`` blocks, whose blocks are
labelled by it (these also teach ads and menus as this table has them).  Training pages are whole;
decoded pages have no bound.

Text of scripts, styles, templates, frames, the page title, text areas and choice lists is none; text of formulas (``math``),
drawings (``svg``) and ``noscript`` is text where it stands.

Defined cases: a null html gives an empty text; markup that ends too early is read as
far as it goes; pages without main blocks give an empty text; null page_ids and
urls are kept; repeated rows are extracted each; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches

#: Pages of the table that are trained on beside the templates.
MAX_PAGES, MAX_BLOCKS = 200, 256
FILLINGS = 6
ROUNDS, RATE, RIDGE, SEED = 150, 0.15, 1e-3, 5

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)"
                  r"""((?:[^>"'=]|=\s*"[^"]*(?:"|\Z)|=\s*'[^']*(?:'|\Z)|["'=])*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s>"']+)))?""")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")  # parts of camelCase names are words

# Element names of HTML.
RAW = {"script", "style", "template", "textarea", "iframe", "title", "select"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "img", "input", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub",
          "sup", "time", "tt", "u", "var", "wbr",
          "noscript", "svg", "text", "tspan", "g", "defs", "path", "rect", "circle", "line", "math", "mrow", "mi", "mn", "mo", "msup", "msub",
          "mfrac", "msqrt", "mtext", "semantics"}
#: An element that an opening tag of the key closes first.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
          "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
for _block in ("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre "
               "section table ul figure details").split():
    CLOSES[_block] = {"p"}


class Block:
    """Text of a leaf block, the elements above it, what the names of each stand for, and its share of link text."""

    __slots__ = ("text", "path", "names", "linked", "label")

    def __init__(self, text, path, names, linked, label):
        self.text, self.path, self.names, self.linked, self.label = text, path, names, linked, label


def leaf_blocks(page: str | None) -> list[Block]:
    """Blocks of a page in order; script, style and the like are no text."""
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...], str]] = []  # element, groups of its names, label
    parts: list[str] = []
    linked = links = 0

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                label = next((x for *_, x in reversed(stack) if x), "")
                out.append(Block(text, [e for e, *_ in stack], [g for _, g, _ in stack], min(1.0, linked / len(text)), label))
            parts.clear()
        linked = 0

    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        text = page[at:m.start() if m else n]
        if text:
            parts.append(text)
            if links:
                linked += len(text.strip())
        if not m:
            break
        at = max(m.end(), at + 1)
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:  # a closing tag
            if name not in INLINE:
                flush()
            if any(e == name for e, *_ in stack):
                while stack:
                    e = stack.pop()[0]
                    links -= e == "a"
                    if e == name:
                        break
            continue
        if name not in INLINE:
            flush()
            while stack and stack[-1][0] in INLINE and name in CLOSES:  # unclosed inline elements end with their block
                links -= stack.pop()[0] == "a"
            while stack and stack[-1][0] in CLOSES.get(name, ()):
                stack.pop()
        elif name == "br":
            parts.append(" ")
        if name in RAW:
            end = re.compile(f"</{name}", re.I).search(page, at)
            at = end.start() if end else n
            if end:
                close = page.find(">", at)
                at = n if close < 0 else close + 1
            continue
        if name in VOID or m[3].endswith("/"):
            continue
        groups, label = attributes(name, m[3]) if m[3].strip() else ((), "")
        stack.append((name, groups, label))
        links += name == "a"
    flush()
    return out


# Words of class, id and role names, by what they usually hold.
NAME_GROUPS = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs tabs toolbar pagination pager skip toc",
    "head": "header masthead banner topbar logo branding",
    "foot": "footer foot colophon copyright legal bottom contentinfo",
    "side": "sidebar side aside rail complementary widget widgets related recommended popular trending archive tags",
    "notice": "notice cookie cookies consent gdpr alert warning popup modal overlay dialog message",
    "ad": "ad ads adbox adslot advert advertisement adverts advertising sponsor sponsored promo promoted promotion adsense commercial",
    "form": "form search login signin signup subscribe subscription newsletter contact input",
    "comment": "comment comments discussion reply replies respond disqus responses feedback reader",
    "social": "share sharing social follow like tweet",
    "hide": "hidden invisible",
    "main": "article content main post entry story body text prose",
}
_GROUP = {w: g for g, words in NAME_GROUPS.items() for w in words.split()}
_LONG = sorted((w for w in _GROUP if len(w) >= 5), key=lambda w: (_GROUP[w] == "main", -len(w), w))
# Parts of names that say how an element is laid out or built, not what it holds.
HOLDERS = set("list area wrapper wrap container inner outer box block slot links link unit bar item items group panel row col column "
              "holder region zone module component card left right top large small desktop mobile".split())
#: A name that begins with one of these speaks of something else ("has-sidebar", "tag-news"); one that ends with a state too ("comment-open").
ABOUT = set("has no not with without is tag category cat type status format postid hide show supports js".split())
STATES = set("open closed enabled disabled active inactive on off true false visible loaded ready count free".split())


def _single(word: str) -> str | None:
    """What one word stands for; compounds ("commentlist", "topnav") by a known beginning or end."""
    known = _GROUP.get(word)
    if known is None:
        part = next((w for w in _LONG if word.startswith(w) or word.endswith(w)), None)
        known = _GROUP[part] if part else "menu" if word.endswith("nav") else "ad" if word.startswith("ads") else None
    return known


@lru_cache(maxsize=100_000)
def group(name: str) -> str | None:
    """What a whole class, id or role name stands for: the group of its head, the last word that isn't about layout.

    "main-nav" is a menu, "comment-body" a comment (an unspecific head yields to a word before it), "ad-slot-3" an ad; "has-sidebar",
    "tag-news" and "comment-open" are about something else and stand for nothing.
    """
    parts = [w.lower() for w in _WORD.findall(name)]
    if not parts or (len(parts) > 1 and (parts[0] in ABOUT or parts[-1] in STATES)):
        return None
    while len(parts) > 1 and parts[-1] in HOLDERS:
        parts.pop()
    head = _single(parts[-1])
    if head in (None, "main") and len(parts) > 1 and head == "main":
        return next((g for g in map(_single, reversed(parts[:-1])) if g not in (None, "main")), head)
    return head


def attributes(element: str, text: str) -> tuple[tuple[str, ...], str]:
    """Groups of an element's names, and its data-label.  The classes of html and body describe the page."""
    groups, label = [], ""
    for key, *values in _ATTRIBUTE.findall(text):
        value, key = next((v for v in values if v), ""), key.lower()
        if key in ("class", "id", "role") and element not in ("html", "body"):
            groups += [g for g in map(group, value.split()) if g]
        elif key == "hidden" and value.lower() not in ("false", "until-found"):
            groups.append("hide")
        elif key == "style" and _UNSEEN.search(value):
            groups.append("hide")
        elif key == "data-label":
            label = value
    return tuple(dict.fromkeys(groups)), label


_ELEMENTS = ["nav", "header", "footer", "aside", "form", "article", "main", "section", "ul", "ol", "li", "table", "p", "h1",
             "h2", "h3", "h4", "blockquote", "pre", "figure", "figcaption", "dl", "button", "label", "fieldset", "dialog",
             "details", "div", "address", "menu", "td"]
_INDEX = {k: i for i, k in enumerate(
    ["bias"] + [f"in:{e}" for e in _ELEMENTS] + [f"at:{e}" for e in _ELEMENTS] + [f"name:{g}" for g in NAME_GROUPS]
    + ["last:" + g for g in NAME_GROUPS] + ["within:" + g for g in NAME_GROUPS] + ["bare", "links:none", "links:some", "links:all", "chars:20", "chars:60",
       "chars:200", "chars:more", "stop", "commas", "rights", "first", "last", "article:bare"])}
FEATURES = len(_INDEX)


_OTHER = {"nav", "header", "footer", "aside", "form"}


def article_of(b: Block) -> tuple[int, set[str]]:
    """Place in the path of the innermost article, main or element named so (-1: none), and the groups said of it and below."""
    core = max((k for k, (e, g) in enumerate(zip(b.path, b.names)) if e in ("article", "main") or g == ("main",)), default=-1)
    return core, {g for names in b.names[max(core, 0):] for g in names}


def plain_article(b: Block) -> bool:
    """In an article or main element, with no other element from it downwards, and no name anywhere above that says otherwise."""
    core, _ = article_of(b)
    return (bool({"article", "main"} & set(b.path)) and not _OTHER & set(b.path[core:])
            and not {g for names in b.names for g in names} - {"main"})


def featurize(blocks: list[Block]) -> list[list[int]]:
    """Indices of each block's active features."""
    out = []
    known: dict[int, list[int]] = {}
    for k, b in enumerate(blocks):
        key = (tuple(b.path), tuple(b.names))
        top = known.get(key)
        if top is None:
            top = [_INDEX["bias"]]
            inside = set(b.path)
            top += [_INDEX["in:" + e] for e in inside if "in:" + e in _INDEX]
            block = next((e for e in reversed(b.path) if e not in INLINE), "")
            if "at:" + block in _INDEX:
                top.append(_INDEX["at:" + block])
            groups = [g for names in b.names for g in names]
            _, said = article_of(b)
            top += [_INDEX["name:" + g] for g in set(groups)] + [_INDEX["within:" + g] for g in said]
            if groups:
                top.append(_INDEX["last:" + groups[-1]])
            if not inside & {"nav", "header", "footer", "aside", "form", "article", "main"} and not groups:
                top.append(_INDEX["bare"])
            if plain_article(b):
                top.append(_INDEX["article:bare"])
            known[key] = top
        n = len(b.text)
        own = [_INDEX["links:none" if b.linked < 0.1 else "links:some" if b.linked < 0.7 else "links:all"],
               _INDEX["chars:20" if n < 20 else "chars:60" if n < 60 else "chars:200" if n < 200 else "chars:more"]]
        if b.text[-1] in ".!?":
            own.append(_INDEX["stop"])
        if "," in b.text:
            own.append(_INDEX["commas"])
        if "©" in b.text:
            own.append(_INDEX["rights"])
        if not k:
            own.append(_INDEX["first"])
        if k == len(blocks) - 1:
            own.append(_INDEX["last"])
        out.append(top + own)
    return out


class Chain:
    """Two labels (0 other, 1 main): a weight per feature and label, and per pair of neighbouring labels."""

    def __init__(self, weights: np.ndarray, pairs: np.ndarray):
        self.weights, self.pairs = weights, pairs

    def scores(self, rows: list[list[int]]) -> np.ndarray:
        flat = np.fromiter((i for r in rows for i in r), dtype=np.int64)
        begin = np.cumsum([0] + [len(r) for r in rows[:-1]])
        return np.add.reduceat(self.weights[flat], begin, axis=0)

    def decode(self, rows: list[list[int]]) -> list[int]:
        """Viterbi."""
        if not rows:
            return []
        scores, back = self.scores(rows).tolist(), []
        (p00, p01), (p10, p11) = self.pairs.tolist()
        a, b = scores[0]
        for x, y in scores[1:]:
            to0, to1 = a + p00 >= b + p10, a + p01 >= b + p11  # ties: from 0
            back.append((0 if to0 else 1, 0 if to1 else 1))
            a, b = (a + p00 if to0 else b + p10) + x, (a + p01 if to1 else b + p11) + y
        path = [int(b > a)]
        for step in reversed(back):
            path.append(step[path[-1]])
        return path[::-1]


def train(pages: list[tuple[list[list[int]], list[int]]], rounds: int = ROUNDS) -> Chain:
    """Maximum likelihood by gradient ascent (Adam) on forward-backward expectations, pages padded to one array."""
    pages = [p for p in pages if p[0]]
    n, longest = len(pages), max(len(r) for r, _ in pages)
    x = np.zeros((n, longest, FEATURES), dtype=np.float32)
    y = np.zeros((n, longest), dtype=int)
    real = np.zeros((n, longest), dtype=bool)
    for i, (rows, labels) in enumerate(pages):
        for t, r in enumerate(rows):
            x[i, t, r] = 1
        y[i, :len(rows)] = labels
        real[i, :len(rows)] = True
    gold = np.zeros((n, longest, 2))
    np.put_along_axis(gold, y[:, :, None], 1, axis=2)
    gold[~real] = 0
    gold_pairs = np.einsum("nta,ntb->ab", gold[:, :-1], gold[:, 1:])
    w, p = np.zeros((FEATURES, 2)), np.zeros((2, 2))
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(p), np.zeros_like(p)]
    flat = x.reshape(-1, FEATURES)
    for step in range(1, rounds + 1):
        s = (flat @ w).reshape(n, longest, 2)
        s -= s.max(axis=2, keepdims=True)
        e, trans = np.exp(s), np.exp(p)
        alpha, beta = np.zeros_like(e), np.ones_like(e)
        alpha[:, 0] = e[:, 0] / e[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, longest):
            a = (alpha[:, t - 1] @ trans) * e[:, t]
            alpha[:, t] = np.where(real[:, t, None], a / a.sum(axis=1, keepdims=True), alpha[:, t - 1])
        for t in range(longest - 2, -1, -1):
            b = (beta[:, t + 1] * e[:, t + 1]) @ trans.T
            beta[:, t] = np.where(real[:, t + 1, None], b / b.sum(axis=1, keepdims=True), 1.0)
        marg = alpha * beta
        marg /= marg.sum(axis=2, keepdims=True)
        marg[~real] = 0
        both = alpha[:, :-1, :, None] * trans[None, None] * (e * beta)[:, 1:, None, :]
        both /= both.sum(axis=(2, 3), keepdims=True)
        both[~real[:, 1:]] = 0
        grads = [flat.T @ (gold - marg).reshape(-1, 2) / n - RIDGE * w,
                 (gold_pairs - both.sum(axis=(0, 1))) / n - RIDGE * p]
        for k, (value, g) in enumerate(zip((w, p), grads)):
            m, v = state[2 * k], state[2 * k + 1]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            value += RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return Chain(w, p)


# Labelled layouts.  T is a line of a few words, S a sentence, P a paragraph; data-label marks main text.
TEMPLATES = [
    "<header><h1>T</h1><nav><ul><li><a>T</a></li><li><a>T</a></li></ul></nav></header><main data-label=main><h1>T</h1><p>P</p><p>P</p><h2>T</h2><p>S</p></main><aside><h3>T</h3><ul><li><a>T</a></li></ul><p>S</p></aside><footer><p>&copy; T</p></footer>",
    "<div class=topbar><a>T</a><a>T</a></div><div class=menu><a>T</a> <a>T</a></div><div class=content data-label=main><h2>T</h2><p>P</p><p>S</p><ul><li>S</li><li>S</li></ul><p>P</p></div><div class=sidebar><h4>T</h4><p>S</p><a>T</a></div><div class=footer>&copy; T <a>T</a></div>",
    "<nav><a>T</a><a>T</a></nav><div class='cookie-notice'><p>S</p><button>T</button></div><article data-label=main><h1>T</h1><p>S</p><p>P</p><blockquote><p>S</p></blockquote><p>P</p></article><section class=comments id=comments><h3>T</h3><div class=comment><p>S</p></div><div class=comment><p>P</p></div><form><label>T</label><p>S</p></form></section><footer>T</footer>",
    "<div id=header><h1>T</h1><p>S</p></div><div id=nav><ul><li><a>T</a></li></ul></div><div id=main data-label=main><h1>T</h1><p>P</p><p>S</p></div><div class=ad>S</div><div id=comments><p>S</p><p>P</p><p>S</p></div><div id=footer><p>S</p></div>",
    "<header class=site-header><a>T</a><form class=search><label>T</label></form></header><article><div data-label=main><h1>T</h1><p>P</p></div><div class=advert><p>S</p></div><div data-label=main><p>P</p><p>S</p></div><aside class=related><h3>T</h3><a>T</a></aside><div data-label=main><p>S</p></div></article><footer><ul><li><a>T</a></li></ul><p>S</p></footer>",
    "<nav><ul><li><a>T</a></li><li><a>T</a></li></ul></nav><div class=ad>S</div><article data-label=main><h1>T</h1><p><b>P<br><p>P</p><p>S</p><p>T</p></article><footer>&copy; T &middot; S</footer>",
    "<div class=banner><p>S</p></div><div class=alert role=alert>S</div><div class=post data-label=main><h1>T</h1><p>T</p><p>S</p><p>P</p></div><div class=newsletter><p>S</p><form><p>T</p></form></div><div class=share><a>T</a><a>T</a></div><div class=copyright>&copy; S</div>",
    "<table><tr><td class=menu><a>T</a></td><td class=content data-label=main><h2>T</h2><p>P</p><p>S</p></td><td class=sidebar><p>S</p><a>T</a></td></tr></table><div class=footer>S</div>",
    "<header><p>S</p></header><main><article data-label=main><header><h1>T</h1></header><section><h2>T</h2><p>P</p></section><section><h2>T</h2><p>S</p><ol><li>S</li><li>S</li></ol><pre>S</pre></section></article><section id=respond class=reply><h3>T</h3><p>S</p><p>P</p></section></main><dialog class=modal><p>S</p></dialog><footer><p>S</p></footer>",
    "<ul><li><a>T</a></li><li><a>T</a></li></ul><div data-label=main><h1>T</h1><p>P</p><p>P</p><p>S</p></div><div><a>T</a> <a>T</a> <a>T</a></div><div>&copy; T</div>",
    "<nav class=breadcrumb><a>T</a></nav><article data-label=main><h1>T</h1><p>T</p><p>T</p><p>P</p><figure><figcaption>S</figcaption></figure><table><tr><td>T</td><td>T</td></tr></table><p>P</p></article><article class=comment><p>P</p></article><article class=comment><p>S</p></article><aside class=promo><p>P</p></aside><form><p>S</p><label>T</label></form><footer>T</footer>",
    "<body><div class=notice>P</div><header><h2>T</h2></header><div class='story body' data-label=main><p>P</p><p>P</p><dl><dt>T</dt><dd>S</dd></dl></div><section class=sponsored><h3>T</h3><p>P</p></section><aside><p>P</p></aside><div class=discussion><p>P</p><p>P</p></div><footer><address>T</address><p>P</p></footer>",
    "<nav><a>T</a></nav><aside class=notice><p>S</p></aside><article><h1 data-label=main>T</h1><p data-label=main>P</p><p data-label=main>S</p><nav><a>T</a><a>T</a></nav><section class=comments><p>S</p><p>S</p></section><footer><p>S</p></footer></article><form><p>S</p></form><footer>T</footer>",
    "<nav>T</nav><article><div data-label=main><h1>T</h1><p>P</p></div><form><p>S</p><label>T</label></form><p data-label=main>S</p><aside><h3>T</h3><p>P</p></aside><p data-label=main>P</p></article><form><label>T</label><p>S</p></form>",
    "<main><div data-label=main><p>P</p><p>S</p></div><form>T</form><div data-label=main><p>S</p><ul><li>S</li><li>S</li></ul></div><section class=comments><ol><li>P</li><li>S</li></ol></section></main><div hidden><p>P</p></div>",
    "<div class=content><div data-label=main><p>P</p></div><div class=promo><p>S</p></div><div data-label=main><p>S</p></div><form><p>S</p></form><aside><p>S</p></aside></div><ol class=comment><li>P</li><li>S</li></ol>",
    "<article data-label=main><h1>T</h1><p>P</p></article>",
    "<article data-label=main><p>S</p></article>",
    "<nav><a>T</a></nav><article data-label=main><p>T</p></article>",
    "<main data-label=main><p>T</p></main>",
    "<article data-label=main><h1>T</h1><p>T</p></article><footer>&copy; T</footer>",
    "<div class=content data-label=main><p>S</p><p>P</p></div>",
    "<h1 data-label=main>T</h1><p data-label=main>P</p><p data-label=main>S</p>",
]


#: The article with something of each other kind inside it, and beside it.
TEMPLATES += [
    f"<{outer}><div data-label=main><h1>T</h1><p>P</p></div><div class={words.split()[0]}><h3>T</h3><p>S</p><p>P</p></div>"
    f"<p data-label=main>S</p></{outer.split()[0]}><div class={words.split()[-1]}><p>S</p><p>P</p></div>"
    for kind, words in NAME_GROUPS.items() if kind != "main" for outer in ("article class=story", "div class='main content'")]
TEMPLATES += [
    f"<{outer}><div data-label=main><h1>T</h1><p>P</p></div><{e}><h3>T</h3><p>S</p>T</{e}><p data-label=main>S</p>"
    f"</{outer.split()[0]}><{e}><p>P</p></{e}>"
    for e in ("aside", "form", "nav", "footer") for outer in ("article class=story", "div class='main content'", "main")]


#: Names, styles and titles on the article that mention other things.
TEMPLATES += [
    f"<nav class=main-nav><a>T</a></nav><{outer}><h1>T</h1><p>P</p><p>S</p><div class=comment-list><p>S</p><p>P</p></div></{outer.split()[0]}>"
    f"<div class=site-sidebar><p>S</p></div><footer><p>S</p></footer>".replace("<h1>", "<div data-label=main><h1>", 1).replace("<div class=c", "</div><div class=c", 1)
    for outer in ("article style='overflow:hidden'", "article title='The hidden menu'", "article class='post has-sidebar'", "div class='story form-x'",
                  "article class='post tag-news'", "article class='post comment-open category-ads'", "main id=page", "div class='entry no-comments'")]


def fill(template: str, words: list[str], rng: np.random.Generator) -> str:
    def text(m):
        lengths = {"T": (1, 8), "S": (6, 25), "P": (25, 120)}[m[0]]
        pick = rng.choice(len(words), rng.integers(*lengths))
        out = " ".join(words[i] for i in pick).strip(".,")
        return entities.escape(out if m[0] == "T" and rng.random() < 0.7 else out + ".")
    return re.sub(r"(?<=[>; ])[TSP](?=[< ]|$)", text, template)


def labelled(sample: list[str]) -> list[tuple[list[list[int]], list[int]]]:
    """Training pages: filled templates, and those sampled pages that have one article element."""
    pages = []
    words = sorted({w for p in sample for b in leaf_blocks(p) for w in b.text.split()})[:5000] or ["word", "text", "line"]
    rng = np.random.default_rng(SEED)
    for t in TEMPLATES:
        for _ in range(FILLINGS):
            blocks = leaf_blocks(fill(t, words, rng))
            pages.append((featurize(blocks), [int(b.label == "main") for b in blocks]))
    for page in sample:
        if len(re.findall(r"<article\b", page, re.I)) == 1:
            blocks = leaf_blocks(page)
            if len(blocks) <= MAX_BLOCKS:
                pages.append((featurize(blocks), [int("article" in b.path and plain_article(b)) for b in blocks]))
    return pages


def main_text(chain: Chain, page: str | None) -> str:
    blocks = leaf_blocks(page)
    return "\n".join(b.text for b, main in zip(blocks, chain.decode(featurize(blocks))) if main)


def fit(pages: DataFrame, max_pages: int = MAX_PAGES) -> Chain:
    """Train on the templates and at most ``max_pages`` pages of the table."""
    rows = pages.where(F.col("html").isNotNull()).select(F.col("html").cast("string").alias("h")).limit(max_pages).collect()
    return train(labelled([r.h for r in rows]))


def extract(pages: DataFrame, chain: Chain | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    bound_batches(pages.sparkSession, 256)
    chain = chain or fit(pages)

    @F.pandas_udf("string")
    def texts(html: pd.Series) -> pd.Series:
        return pd.Series([main_text(chain, h) for h in html], dtype=object)

    return pages.select("page_id", "url", texts(F.col("html").cast("string")).alias("text")).withColumn(
        "n_chars", F.char_length("text").cast("long"))


#: The article of this table's one layout, cut out by patterns: what the model must find without being told.
ORACLE = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|$)', 1) AS a FROM pages),
b AS (SELECT page_id, url, list_filter(list_transform(regexp_split_to_array(a, '</?(p|h1)>'), lambda x:
        trim(regexp_replace(regexp_replace(x, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))), lambda x: x <> '') AS blocks FROM a),
t AS (SELECT page_id, url, replace(replace(replace(array_to_string(blocks, chr(10)),
        '&quot;', '"'), '&amp;', '&'), '&amp', '&') AS text FROM b)
SELECT page_id, url, text, length(text) AS n_chars FROM t"""
