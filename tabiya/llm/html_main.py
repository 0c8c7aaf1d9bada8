"""Main text of web pages by gradient-boosted trees over DOM nodes.

A page is parsed into a tree; every element gets features of its subtree
(text, links, density), its tag, the words of its class, id and role, its
depth, its siblings and its parent. Boosted trees give each element the
chance that it belongs to the article, and a dynamic programme over the tree
takes the most likely consistent choice: an element is outside, kept or
dropped; what is below a dropped element is dropped, and below a kept one
nothing is outside again.

The trees learn from pages whose labels are known because they are put
together here: paragraphs of a bounded, hash-ordered sample of the given pages
in random layouts, next to menus, notices, adverts, forms and comments. The
sample's size is a parameter; it bounds training only, every page is
extracted whole.

Defined cases: null or empty html, and pages without kept text, give an empty
text; unclosed elements end where HTML ends them or at the page's end;
comments, scripts, styles, templates and form fields have no text; hidden
elements, formulas and drawings are judged as any other element; very long and
deeply nested pages take time linear in their length; of equally likely
choices the first of outside, kept, dropped is taken; repeated rows are
extracted each on its own; an empty table gives an empty table; other columns
of the input, whatever their names, are left out.
"""

from __future__ import annotations

import html as html_lib
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytetext as B
from .common import hashed_sample, ship

SAMPLE_PAGES = 200
TRAINING_PAGES = 1200
ROOT_WEIGHT = 6.0

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[(.*?)(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)|<|[^<]+", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"'>]+)))?")
_ATTRIBUTE_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_SENTENCE = re.compile(r"[.!?,;:]")

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template iframe select option textarea button head title".split())
RAW = frozenset("script style textarea title noscript iframe".split())
BLOCK = frozenset(("address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header "
                   "hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul").split())
#: a start tag of these ends an open p
ENDS_P = BLOCK - frozenset("br body html head option td th tr tbody thead tfoot".split())
#: a start tag ends an open element of these, up to the given container
ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)),
        "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",))}

# Words of class, id and role attributes by what they speak for.
WORDS = {
    "content": "article body content entry hentry main page post prose story text blog news read",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs crumb crumbs tabs toolbar topbar sitemap pager pagination toc skip",
    "frame": "header footer masthead colophon banner copyright legal imprint bottom top logo brand branding",
    "side": "sidebar side aside widget widgets rail related recommended trending popular more teaser secondary complementary archive recent",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted dfp taboola outbrain commercial affiliate",
    "notice": "notice cookie cookies consent gdpr privacy alert popup modal overlay newsletter subscribe subscription signup paywall message warning",
    "form": "form search login register input field contact feedback poll survey",
    "comment": "comment comments commentlist reply replies respond responses disqus discussion thread reader review reviews",
    "share": "share sharing social follow like tweet tags tag meta byline author date print email rating",
}
_KIND_OF = {w: k for k, (_, words) in enumerate(WORDS.items()) for w in words.split()}
TAGS = ("article main section div p h1 h2 h3 ul ol li a nav header footer aside form table tr td blockquote pre figure figcaption span b em dl label body html").split()
_TAG_OF = {t: i for i, t in enumerate(TAGS)}


@dataclass
class Page:
    """Elements in document order and the texts between tags."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    kinds: list[list[int]] = field(default_factory=list)  # kinds of the attribute words
    truth: list[int] = field(default_factory=list)        # training only: 1 article, 0 other, -1 neither
    pieces: list[tuple[int, str]] = field(default_factory=list)  # (element, text); element -1: a block's border


def _attributes(raw: str) -> tuple[list[int], int | None]:
    kinds, truth = [], None
    for m in _ATTRIBUTE.finditer(raw):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id", "role"):
            kinds += [_KIND_OF[w.lower()] for w in _ATTRIBUTE_WORD.findall(value) if w.lower() in _KIND_OF]
        elif name == "data-truth":
            truth = int(value)
    return kinds, truth


def parse(source: str) -> Page:
    """The tree of a page; a stand-in root holds everything."""
    page = Page()
    open_: list[int] = []
    # places in the stack of open elements, by tag
    places: dict[str, list[int]] = {}

    def last(*tags: str) -> int:
        """Place of the innermost open element of these, 0 if there is none."""
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def start(tag: str, raw: str) -> None:
        kinds, truth = _attributes(raw) if raw.strip() else ([], None)
        up = open_[-1] if open_ else -1
        page.tag.append(tag)
        page.parent.append(up)
        page.kinds.append(kinds)
        page.truth.append(truth if truth is not None else (page.truth[up] if up >= 0 else -1))
        places.setdefault(tag, []).append(len(open_))
        open_.append(len(page.tag) - 1)

    def end_to(place: int) -> None:
        for i in open_[place:]:
            places[page.tag[i]].pop()
            if page.tag[i] in BLOCK:
                page.pieces.append((-1, ""))
        del open_[place:]

    start("#root", "")
    at = 0
    while at < len(source):
        m = _TOKEN.match(source, at)
        if m is None:
            at += 1
            continue
        at = m.end()
        name = m[3]
        if name is None:
            text = m[1] if m[1] is not None else m[0]
            if not text.startswith(("<!", "<?")) or m[1] is not None:
                page.pieces.append((open_[-1], text))
            continue
        name = name.lower()
        if m[2]:
            place = last(name)
            if place:
                end_to(place)
            elif name in ("p", "br"):
                page.pieces.append((-1, ""))
            continue
        if name in ("html", "body") and last(name):
            continue
        if name in ENDS_P:
            place = last("p")
            if place > last("td", "th", "button", "object"):
                end_to(place)
        if name in ENDS:
            shut, stop = ENDS[name]
            place = last(*shut)
            if place > last(*stop):
                end_to(place)
        if name == "body" and last("head"):
            end_to(places["head"][0])
        if name in BLOCK:
            page.pieces.append((-1, ""))
        raw = m[4] or ""
        if name in VOID:
            continue
        start(name, raw)
        if raw.rstrip().endswith("/") and name in ("svg", "path", "use"):
            end_to(len(open_) - 1)
        elif name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|$)", re.I).search(source, at)
            at = close.end() if close else len(source)
            end_to(len(open_) - 1)
    return page


N_KINDS = len(WORDS)
#: Elements whose presence above an element is a feature.
REGIONS = "article main nav header footer aside form li blockquote".split()
_REGION_OF = {t: i for i, t in enumerate(REGIONS)}


def features(page: Page) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(elements, features), own text length, and whether an element is silent (it or an ancestor has no readable text)."""
    n = len(page.tag)
    parent = np.array(page.parent)
    silent = np.zeros(n, bool)
    depth = np.zeros(n)
    in_link = np.zeros(n, bool)
    near = np.zeros((n, N_KINDS))
    own_kind = np.zeros((n, N_KINDS))
    above = np.zeros((n, len(REGIONS)))
    place, tag_id = np.zeros(n), np.full(n, -1)
    children = np.zeros(n)
    for i in range(n):
        up = page.parent[i]
        for k in page.kinds[i]:
            own_kind[i, k] += 1
        silent[i] = page.tag[i] in SILENT or (up >= 0 and silent[up])
        in_link[i] = page.tag[i] == "a" or (up >= 0 and in_link[up])
        tag_id[i] = _TAG_OF.get(page.tag[i], -1)
        if up >= 0:
            depth[i] = depth[up] + 1
            near[i] = np.maximum(near[up] * 0.8, own_kind[up])
            above[i] = above[up]
            if page.tag[up] in _REGION_OF:
                above[i, _REGION_OF[page.tag[up]]] = 1
            place[i] = children[up]
            children[up] += 1
    own, marks, seen = np.zeros(n), np.zeros(n), np.zeros(n)
    total = 0.0
    first = np.full(n, -1.0)
    for i, text in page.pieces:
        if i >= 0 and not silent[i]:
            size = len(text.strip())
            if size:
                if first[i] < 0:
                    first[i] = total
                own[i] += size
                marks[i] += len(_SENTENCE.findall(text))
                total += size
    sub = np.stack([own, np.where(in_link, own, 0), marks, np.ones(n), np.array([t == "a" for t in page.tag], float), np.array([t == "p" for t in page.tag], float),
                    np.array([t == "li" for t in page.tag], float), np.where([t == "p" for t in page.tag], own, 0), np.array([t in ("input", "label", "button", "select", "textarea") for t in page.tag], float)], 1)
    for i in range(n - 1, 0, -1):
        sub[parent[i]] += sub[i]
        if first[i] >= 0 and (first[parent[i]] < 0 or first[i] < first[parent[i]]):
            first[parent[i]] = first[i]
    text, linked, mark, tags, links, paras, items, para_text, fields = sub.T
    up = np.maximum(parent, 0)
    before, after = np.full(n, -1), np.full(n, -1)
    last: dict[int, int] = {}
    for i in range(1, n):
        p = page.parent[i]
        if p in last:
            before[i], after[last[p]] = last[p], i
        last[p] = i
    side = lambda v, who: np.where(who >= 0, v[np.maximum(who, 0)], -1)
    density = linked / np.maximum(text, 1)
    columns = [np.log1p(text), density, text / np.maximum(tags, 1), mark / np.maximum(text, 1) * 100, np.log1p(links), np.log1p(paras), np.log1p(items), para_text / np.maximum(text, 1),
               text / max(total, 1), first / max(total, 1), depth, place, children[up], children, np.log1p(own), fields,
               density[up], side(density, before), side(np.log1p(text), before), side(np.log1p(text), after)]
    one_hot = (tag_id[:, None] == np.arange(len(TAGS))).astype(float)
    under = np.zeros((n, N_KINDS))
    np.maximum.at(under, up, own_kind)
    return np.concatenate([np.stack(columns, 1), one_hot, above, own_kind, near, under], 1).astype(np.float32), own, silent


class Boosted:
    """Gradient-boosted trees for a yes-or-no target: logistic loss, histogram splits."""

    def __init__(self, rounds: int = 90, depth: int = 4, rate: float = 0.25, bins: int = 24, least: float = 4.0, ridge: float = 1.0, columns: float = 0.4):
        self.rounds, self.depth, self.rate, self.bins, self.least, self.ridge, self.columns = rounds, depth, rate, bins, least, ridge, columns
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> Boosted:
        """Learn from rows ``x``; each round looks at a random share of the columns."""
        rng = np.random.Generator(np.random.Philox(3))
        weight = np.ones(len(y)) if weight is None else weight
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], 1)
        rate = np.clip(np.average(y, weights=weight), 1e-3, 1 - 1e-3)
        self.base = float(np.log(rate / (1 - rate)))
        score = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            gradient, hessian = weight * (y - p), weight * p * (1 - p)
            tried = np.flatnonzero(rng.random(x.shape[1]) < self.columns)
            feature, border, value = np.full((1 << self.depth) - 1, -1), np.zeros((1 << self.depth) - 1), np.zeros(1 << self.depth)
            node = np.zeros(len(y), np.int64)
            for level in range(self.depth):
                width = 1 << level
                best_gain, best = np.full(width, 1e-6), np.full((width, 2), -1)
                for f in tried:
                    if not len(cuts[f]):
                        continue
                    at = node * self.bins + binned[:, f]
                    g = np.cumsum(np.bincount(at, gradient, width * self.bins).reshape(width, -1), 1)
                    h = np.cumsum(np.bincount(at, hessian, width * self.bins).reshape(width, -1), 1)
                    gl, hl, gr, hr = g[:, :-1], h[:, :-1], g[:, -1:] - g[:, :-1], h[:, -1:] - h[:, :-1]
                    gain = gl ** 2 / (hl + self.ridge) + gr ** 2 / (hr + self.ridge) - g[:, -1:] ** 2 / (h[:, -1:] + self.ridge)
                    gain[(hl < self.least * 0.1) | (hr < self.least * 0.1)] = 0
                    gain[:, len(cuts[f]):] = 0
                    k = gain.argmax(1)
                    top = gain[np.arange(width), k]
                    better = top > best_gain
                    best_gain[better] = top[better]
                    best[better] = np.stack([np.full(width, f), k], 1)[better]
                right = np.zeros(len(y), bool)
                for j in range(width):
                    f, k = best[j]
                    if f >= 0:
                        feature[width - 1 + j], border[width - 1 + j] = f, cuts[f][k]
                        right |= (node == j) & (binned[:, f] > k)
                node = node * 2 + right
            g, h = np.bincount(node, gradient, 1 << self.depth), np.bincount(node, hessian, 1 << self.depth)
            value = self.rate * g / (h + self.ridge)
            score += value[node]
            self.trees.append((feature, border, value))
        return self

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, border, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                k = (1 << level) - 1 + node
                f = feature[k]
                node = node * 2 + ((f >= 0) & (x[rows, np.maximum(f, 0)] > border[k]))
            score += value[node]
        return score


OUTSIDE, KEPT, DROPPED = 0, 1, 2
_MAY = {OUTSIDE: (OUTSIDE, KEPT, DROPPED), KEPT: (KEPT, DROPPED), DROPPED: (DROPPED,)}
#: Cost of a change between an element and its parent: regions stay whole unless the evidence is strong.
CHANGE = 0.7


def decode(page: Page, odds: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The most likely consistent state of every element."""
    n = len(page.tag)
    weight = 0.5 + np.minimum(np.log1p(own) / 3, 2)
    yes, no = -np.logaddexp(0, -odds) * weight, -np.logaddexp(0, odds) * weight
    value = np.stack([np.where(own > 0, no, -0.05), yes, no], 1)
    choice = np.zeros((n, 3), np.int8)
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        for s, options in _MAY.items():
            best, at = max((value[i, o] - (CHANGE if o != s else 0), -o) for o in options)
            value[p, s] += best
            choice[i, s] = -at
    state = np.zeros(n, np.int8)
    state[0] = int(np.argmax(value[0, [OUTSIDE, KEPT]]))
    for i in range(1, n):
        state[i] = choice[i, state[page.parent[i]]]
    return state


def text_of(page: Page, keep: np.ndarray) -> str:
    """The kept elements' blocks: references decoded, white space closed, one line each."""
    blocks, held = [], []
    for i, text in page.pieces:
        if i < 0:
            if held:
                blocks.append("".join(held))
                held = []
        elif keep[i]:
            held.append(text)
    blocks.append("".join(held))
    lines = (" ".join(html_lib.unescape(b).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def main_texts(model: Boosted, pages: list[str | None]) -> list[str]:
    parsed = [parse(p or "") for p in pages]
    parts = [features(p) for p in parsed]
    odds = model.log_odds(np.concatenate([f for f, _, _ in parts])) if parts else np.zeros(0)
    out, at = [], 0
    for page, (f, own, silent) in zip(parsed, parts):
        state = decode(page, odds[at:at + len(f)], own)
        at += len(f)
        out.append(text_of(page, (state == KEPT) & ~silent))
    return out


class Layouts:
    """Random pages with known labels, made of given paragraphs."""

    def __init__(self, paragraphs: list[str], seed: int = 11):
        self.rng = np.random.Generator(np.random.Philox(seed))
        self.paragraphs = paragraphs or ["A few words of an article, for want of others.", "And one more sentence."]
        self.words = [w for p in self.paragraphs for w in p.split()][:50_000] or ["word"]

    def pick(self, *options):
        return options[int(self.rng.integers(len(options)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def phrase(self, least: int = 1, most: int = 5) -> str:
        k = int(self.rng.integers(len(self.words)))
        return html_lib.escape(" ".join(self.words[k:k + int(self.rng.integers(least, most + 1))]))

    def paragraph(self) -> str:
        text = html_lib.escape(self.paragraphs[int(self.rng.integers(len(self.paragraphs)))])
        if self.chance(0.01):  # a very long one
            text = f"{text} " * int(self.rng.integers(5, 100))
        if self.chance(0.15):
            text = f'{self.phrase(2, 8)} <a href="/x">{self.phrase(1, 3)}</a> {text}'
        if self.chance(0.15):
            text = f"<{(t := self.pick('b', 'em', 'strong', 'span'))}>{text}</{t}>"
        if self.chance(0.05):
            text = f"<b>{text}<br>"
        return text

    def mark(self, kind: str) -> str:
        """Class or id words of a kind, at times none or others beside them."""
        if self.chance(0.12):
            return ""
        word = self.pick(*WORDS[kind].split())
        if self.chance(0.4):
            word = f"{self.pick('site', 'c', 'js', 'block', 'box', 'u', 'module', 'x1')}-{word}" if self.chance(0.5) else f"{word}{self.pick('-1', '-wrap', '-box', '-inner', '-list', '_area')}"
        return f' {self.pick("class", "class", "id")}="{word}"'

    def links(self, least: int = 2, most: int = 9) -> str:
        items = [f'<a href="/{k}">{self.phrase(1, 4)}</a>' for k in range(int(self.rng.integers(least, most + 1)))]
        return f"<ul>{''.join(f'<li>{x}</li>' for x in items)}</ul>" if self.chance(0.7) else self.pick(" | ", " ", " &middot; ").join(items)

    def other(self, kind: str) -> str:
        """A block that is not the article."""
        if kind == "menu":
            return self.wrap(self.pick("nav", "nav", "div", "ul"), kind, self.links(3, 10))
        if kind == "frame":
            inner = self.pick(f"&copy; {self.phrase(1, 2)} &middot; {self.phrase(3, 9)}", f"<h2>{self.phrase(1, 3)}</h2><p>{self.phrase(3, 9)}</p>", self.links(), f"{self.phrase(2, 6)}. {self.links(2, 5)}")
            return self.wrap(self.pick("header", "footer", "footer", "div"), kind, inner)
        if kind == "side":
            inner = f"<h3>{self.phrase(1, 4)}</h3>" + self.pick(self.links(), f"<p>{self.phrase(5, 20)}</p>" + self.links(1, 4), f"<p>{self.paragraph()}</p>")
            return self.wrap(self.pick("aside", "aside", "div", "section"), kind, inner)
        if kind == "form":
            inner = "".join(f"<label>{self.phrase(1, 3)}</label><input type=text name=a>" for _ in range(int(self.rng.integers(1, 4)))) + f"<button>{self.phrase(1, 2)}</button>" + (f"<p>{self.phrase(3, 12)}</p>" if self.chance(0.5) else "")
            return self.wrap("form", kind, inner)
        if kind == "comment":
            one = lambda: self.wrap(self.pick("div", "li", "article"), kind, f"<{(t := self.pick('b', 'span', 'h4', 'cite'))}>{self.phrase(1, 2)}</{t}>" + "".join(f"<p>{self.paragraph()}</p>" for _ in range(int(self.rng.integers(1, 3)))))
            inner = (f"<h3>{self.phrase(1, 3)}</h3>" if self.chance(0.6) else "") + "".join(one() for _ in range(int(self.rng.integers(1, 6))))
            word = self.pick("comments", "comments", "comment-list", "respond", "discussion", "reader-comments", "disqus_thread")
            return f'<{(t := self.pick("section", "div", "ol", "aside"))} data-truth="0" {self.pick("class", "id")}="{word}">{inner}</{t}>'
        inner = self.pick(self.phrase(3, 15), f"<p>{self.paragraph()}</p>", f"<p>{self.phrase(4, 14)}</p>{self.links(1, 3)}", self.paragraph())
        flat = "<p" not in inner and "<ul" not in inner
        return self.wrap(self.pick("div", "div", "section", "aside", "p" if flat else "div"), kind, inner)

    def wrap(self, tag: str, kind: str, inner: str) -> str:
        mark = self.mark(kind)
        if not mark and tag in ("div", "section", "p"):  # a plain block must say what it is
            mark = f' class="{self.pick(*WORDS[kind].split())}"'
        return f'<{tag}{mark} data-truth="0">{inner}</{tag}>'

    def article(self) -> str:
        parts = []
        if self.chance(0.85):
            title = f"<{(t := self.pick('h1', 'h1', 'h1', 'h2'))}>{self.phrase(3, 12)}</{t}>"
            parts.append(f"<header>{title}</header>" if self.chance(0.15) else title)
        for _ in range(int(self.rng.integers(1, 14))):
            kind = self.rng.random()
            if kind < 0.72:
                tag = self.pick("p", "p", "p", "p", "p", "div")
                parts.append(f"<{tag}>{self.paragraph()}" + ("" if tag == "p" and self.chance(0.1) else f"</{tag}>"))
            elif kind < 0.80:
                parts.append(f"<h{(k := self.pick(2, 3))}>{self.phrase(2, 8)}</h{k}>")
            elif kind < 0.86:
                parts.append(f"<{(t := self.pick('ul', 'ol'))}>{''.join(f'<li>{self.phrase(3, 14)}</li>' for _ in range(int(self.rng.integers(2, 6))))}</{t}>")
            elif kind < 0.90:
                parts.append(f"<blockquote><p>{self.paragraph()}</p></blockquote>")
            elif kind < 0.93:
                parts.append(f"<table><tr><th>{self.phrase()}</th><td>{self.phrase()}</td></tr><tr><td>{self.phrase()}</td><td>{self.phrase()}</td></tr></table>")
            elif kind < 0.95:
                parts.append(f"<figure><img src=x><figcaption>{self.phrase(3, 10)}</figcaption></figure>")
            elif kind < 0.97:
                parts.append(f"<pre>{self.phrase(3, 10)}</pre>")
            else:
                parts.append(self.other(self.pick("advert", "share", "notice", "side", "form")))
        if self.chance(0.1):
            parts.append(self.other(self.pick("comment", "share", "side")))
        tag = self.pick("article", "article", "article", "main", "div", "div", "div", "section")
        word = self.pick(*WORDS["content"].split())
        if self.chance(0.4):
            word = self.pick(f"{word}-content", f"{word}-body", f"{word}-text", f"post-{word}", f"{word}_main")
        mark = f' {self.pick("class", "class", "id")}="{word}"' if (self.chance(0.8) if tag in ("div", "section") else self.chance(0.3)) else ""
        if tag == "article" and self.chance(0.2):
            return f'<main><article data-truth="1"{mark}>{"".join(parts)}</article></main>'
        return f'<{tag} data-truth="1"{mark}>{"".join(parts)}</{tag}>'

    def page(self) -> str:
        head, tail = [], []
        for kind, p, side in (("menu", 0.8, 0), ("frame", 0.5, 0), ("notice", 0.3, 0), ("advert", 0.5, 0), ("form", 0.25, 0), ("share", 0.25, 1), ("side", 0.5, 1), ("comment", 0.45, 1), ("advert", 0.3, 1), ("notice", 0.25, 1), ("form", 0.2, 1), ("menu", 0.25, 1), ("frame", 0.75, 1)):
            if self.chance(p):
                (tail if side else head).append(self.other(kind))
        article = self.article()
        if self.chance(0.05):  # nothing but the article
            return article if self.chance(0.5) else f"<html><body>{article}</body></html>"
        inner = "".join(head) + article + "".join(tail)
        for _ in range(int(self.rng.integers(0, 3))):
            inner = f"<div{self.pick('', ' class=wrapper', ' id=page', ' class=container', ' class=layout')}>{inner}</div>"
        return f"<!DOCTYPE html><html><head><title>{self.phrase()}</title><script>var a='<p>';</script></head><body>{inner}</body></html>"


def train(paragraphs: list[str], pages: int = TRAINING_PAGES, seed: int = 11) -> Boosted:
    """Trees learned from ``pages`` made layouts."""
    layouts = Layouts(paragraphs, seed)
    x, y, w = [], [], []
    for _ in range(pages):
        page = parse(layouts.page())
        f, _, silent = features(page)
        truth = np.array(page.truth)
        use = (truth >= 0) & ~silent
        x.append(f[use])
        y.append(truth[use])
        # the element a region starts with decides for all below it
        root = truth != truth[np.maximum(page.parent, 0)]
        w.append(np.where(root, ROOT_WEIGHT, 1.0)[use])
    return Boosted().fit(np.concatenate(x), np.concatenate(y).astype(float), np.concatenate(w))


def sample_paragraphs(pages: DataFrame, id_col: str, html_col: str, limit: int) -> list[str]:
    """Paragraph texts of ``limit`` pages, the first by a hash of their id."""
    rows = pages.filter(F.col(html_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(html_col).cast("string").alias("html"))
    out = []
    for r in hashed_sample(rows, "id", limit).collect():
        out += paragraphs_of(r.html)
    return out


def paragraphs_of(source: str) -> list[str]:
    """Texts of a page's p elements, of 20 characters or more."""
    page = parse(source)
    inside = np.zeros(len(page.tag), bool)
    for i in range(1, len(page.tag)):
        inside[i] = page.tag[i] == "p" or inside[page.parent[i]]
    return [x for x in text_of(page, inside & ~features(page)[2]).split("\n") if len(x) >= 20]


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample_pages: int = SAMPLE_PAGES, training_pages: int = TRAINING_PAGES) -> DataFrame:
    """(id, url if there is one, text, n_chars) of every page."""
    spark = ship(pages.sparkSession)
    model = spark.sparkContext.broadcast(train(sample_paragraphs(pages, id_col, html_col, sample_pages), training_pages))

    def run(batches):
        for batch in batches:
            texts, column = [], batch.column("html").to_pylist()
            for i, j in B.slices(np.concatenate(([0], np.cumsum([len(h or "") for h in column])))):
                texts += main_texts(model.value, column[i:j])
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string())], names=["id", "url", "text"])

    kind = pages.schema[id_col].dataType.simpleString()
    url = F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string")
    rows = pages.select(F.col(id_col).alias("id"), url.alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, f"id {kind}, url string, text string").select(F.col("id").alias(id_col), "url", "text", F.length("text").cast("long").alias("n_chars"))
