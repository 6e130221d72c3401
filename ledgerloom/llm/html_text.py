"""Main text of pages by a tree-structured graphical model over the DOM (operator 7).

Every block element and every text block of a page is a node with two states, content or
not. A node has a potential from its features (tag, words of class, id and role, length,
share of links), and each parent-child pair one for every pair of states, so that a part
follows what it stands in unless its own features say otherwise. Sum-product messages go
from the leaves to the root and back; a text block is content if its marginal is above a
half. The potentials are the maximum-likelihood ones of labelled pages (labelled_pages),
found by gradient ascent with the exact marginals that the same messages give.

Text of a block: character references decoded, each run of white space one space, trimmed;
blocks are joined by an empty line in page order. The tree is built as browsers do it for
the common cases: omitted end tags of p, li, td and the like, void elements, comments, an
unfinished tag at the end. Scripts, styles, templates, titles, form controls, frames, svg
drawings and the source notes of formulas are no text of the page: they are skipped, and
what stands around them stays together. Formulas (math) are part of the line they are in.
What object and noscript hold is part of the line within a line, and a node elsewhere.

Pages are independent: one map, no shuffle; the model is a few dozen numbers.

Defined cases: null or empty html gives an empty text; pages without block
elements are one block, which is their text, as there is no tree to weigh it by;
repeated rows are extracted each; other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped
from .labelled_pages import PAGES, varied

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)(>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
# Element kinds (fixed values of HTML).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template textarea svg iframe select title annotation annotation-xml".split())
# Of these, elements that may hold others of their name; and form controls, which are left out too but may be left open.
NESTED = frozenset("svg template".split())
CONTROLS = frozenset("button label".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike "
                    "strong sub sup time tt u var wbr "
                    "math maction menclose merror mfenced mfrac mi mlabeledtr mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace "
                    "msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics").split())
# Elements that belong to a line within one of LINES or a line begun, and are nodes elsewhere.
EITHER = frozenset("object noscript".split())
LINES = frozenset("p h1 h2 h3 h4 h5 h6 pre".split())
# Cells and gaps of a formula, which stand apart.
APART = frozenset("br mtd mspace".split())
# An open element of the values ends when the key begins, up to one of the stops.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
STOP_P = frozenset("html body td th button table caption object".split())
KEEP_P = frozenset("tr td th tbody thead tfoot caption li dt dd option optgroup html head body".split())
# Elements whose name says nothing about their content.
PLAIN = frozenset("html body div section center table tbody tr".split())
# Words of class, id and role by what they tell.
GROUPS = {
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner",
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs toolbar pagination pager tabs",
    "edge": "header footer masthead foot top bottom copyright imprint legal",
    "side": "sidebar side aside related recommended widget complementary rail more popular trending",
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay newsletter subscribe paywall warning",
    "form": "form search login signup contact",
    "comment": "comment comments reply replies respond discussion disqus thread reader feedback",
    "share": "share sharing social",
    "main": "article content main post entry story body text page",
}
GROUP_OF = {word: group for group, words in GROUPS.items() for word in words.split()}
SPLIT = re.compile(r"[^a-z]+")


class Page:
    """Nodes of a page, parents before children: parent, features, text (None for elements), label."""

    def __init__(self, source: str, potential=None):
        self.parent: list[int] = []
        self.features: list = []
        self.text: list[str | None] = []
        self.label: list[int] = []
        self._potential = potential or (lambda tag, attributes: element_features(tag, attributes))
        self._parse(source)

    def _node(self, parent: int, features, text: str | None, label: int) -> int:
        self.parent.append(parent)
        self.features.append(features)
        self.text.append(text)
        self.label.append(label)
        return len(self.parent) - 1

    def _parse(self, source: str) -> None:
        stack = [("", self._node(-1, self._potential("", ""), None, 0), 0)]  # tag, node of the block it is in, label
        run: list[str] = []
        linked = links = 0
        within: list[str] = []  # open elements of EITHER that belong to a line
        opened: Counter[str] = Counter()  # tags on the stack, so that none is looked for in vain

        def cut(at: int) -> None:
            flush()
            opened.subtract(t for t, _, _ in stack[at:])
            del stack[at:]

        def flush() -> None:
            nonlocal run, linked
            if run:
                text = " ".join(html.unescape("".join(run)).split())
                if text:
                    tag = next((t for t, _, _ in reversed(stack) if t not in INLINE), "")
                    self._node(stack[-1][1], text_features(tag, text, linked), text, stack[-1][2])
                run, linked = [], 0

        def close(tags: set[str], stops: set[str]) -> None:
            if not any(opened[t] for t in tags):
                return
            for at in range(len(stack) - 1, 0, -1):
                if stack[at][0] in tags:
                    cut(at)
                    return
                if stack[at][0] in stops:
                    return

        at, end = 0, len(source)
        while at < end:
            match = TOKEN.search(source, at)
            piece = source[at:match.start() if match else end]
            if piece:
                run.append(piece)
                linked += len(piece) if links else 0
            if not match:
                break
            at = match.end()
            name = match[2] or match[6]
            if not name:
                continue
            tag, ending, attributes = name.lower(), match[1] or match[5], match[3] if match[2] else match[7]
            if not match[2] or not match[4]:
                if match.end() == end and source[-1:] != ">":
                    break  # an unfinished tag at the end
            if ending:
                if tag == "a":
                    links = 0
                if tag in INLINE:
                    continue
                if tag in within:
                    within.remove(tag)
                    continue
                if opened[tag]:
                    cut(next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag))
                continue
            if tag in RAW or tag in CONTROLS:
                if not attributes.endswith("/"):
                    at = past(source, tag, at, end if tag in RAW else at)
                continue
            if tag == "a":
                links = 1
            if tag in APART:
                run.append(" ")
            if tag in INLINE:
                continue
            if tag in EITHER and (stack[-1][0] in LINES or any(not piece.isspace() for piece in run)):
                within.append(tag)
                continue
            if tag not in KEEP_P:
                close({"p"}, STOP_P)
            if tag in CLOSES:
                close(*CLOSES[tag])
            flush()
            if tag in VOID:
                continue
            label = 0 if "data-off" in attributes else 1 if "data-main" in attributes else stack[-1][2]
            opened[tag] += 1
            stack.append((tag, self._node(stack[-1][1], self._potential(tag, attributes), None, label), label))
        flush()


def past(source: str, tag: str, at: int, without: int) -> int:
    """Where an element that began before ``at`` ends, with those of the same name within NESTED ones; ``without`` if it has no end."""
    depth = 1
    for match in re.compile(rf"<(/?){tag}(?=[\s/>])[^>]*>?", re.I).finditer(source, at):
        if match[1]:
            depth -= 1
        elif tag in NESTED and not match[0].endswith("/>"):
            depth += 1
        if not depth:
            return match.end()
    return without


def element_features(tag: str, attributes: str) -> list[str]:
    """Names of an element's features."""
    out = ["root"] if not tag else ["element"] if tag in PLAIN else ["element", f"tag {tag}"]
    found = dict((k.lower(), v.strip("\"'").lower()) for k, v in ATTRIBUTE.findall(attributes))
    names = " ".join(found.get(k, "") for k in ("class", "id", "role"))
    groups = {GROUP_OF[w] for w in SPLIT.split(names) if w in GROUP_OF}
    if len(groups) > 1:
        groups.discard("main")  # "article-comments" are comments
    hidden = "display:none" in found.get("style", "").replace(" ", "") or found.get("aria-hidden") == "true" or re.search(r"(?:^|\s)hidden(?:\s|=|$)", attributes)
    return [*out, *(f"name {g}" for g in sorted(groups)), *(["hidden"] if hidden else [])]


def text_features(tag: str, text: str, linked: int) -> list[str]:
    """Names of a text block's features."""
    size = len(text)
    return ["text", f"in {tag}" if tag in {"h1", "h2", "h3", "p", "li", "td"} else "in other", f"size {min(4, size.bit_length() // 2)}",
            "links" if linked > 0.6 * size else "few links", "sentence" if text[-1] in ".!?\"" else "open end"]


def _log_sum(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


class Model:
    """Weights of features and, for parent and child, of each pair of states."""

    def __init__(self, weights: dict[str, float], pair: tuple[float, float, float, float]):
        self.weights, self.pair = weights, pair
        self._known: dict[tuple[str, str], float] = {}

    def potential(self, names: list[str]) -> float:
        return sum(self.weights.get(n, 0.0) for n in names)

    def element(self, tag: str, attributes: str) -> float:
        key = tag, attributes
        if key not in self._known:
            if len(self._known) > 5000:
                self._known.clear()
            self._known[key] = self.potential(element_features(tag, attributes))
        return self._known[key]

    def messages(self, parent: list[int], own: list[float]) -> tuple[list[float], list[float], list[float]]:
        """Log odds of each node from all of the tree, from its subtree, and of its parent without it."""
        w00, w01, w10, w11 = self.pair
        below, up = list(own), [0.0] * len(own)
        for k in range(len(own) - 1, 0, -1):
            x = below[k]
            up[k] = _log_sum(w11 + x, w10) - _log_sum(w01 + x, w00)
            below[parent[k]] += up[k]
        whole, apart = list(below), [0.0] * len(own)
        for k in range(1, len(own)):
            apart[k] = y = whole[parent[k]] - up[k]
            whole[k] += _log_sum(w11 + y, w01) - _log_sum(w10 + y, w00)
        return whole, below, apart

    def extract(self, source: str) -> str:
        page = Page(source, self.element)
        if page.text.count(None) == 1:  # the root alone
            return "\n\n".join(text for text in page.text if text is not None)
        own = [f if text is None else self.potential(f) for f, text in zip(page.features, page.text, strict=True)]
        whole = self.messages(page.parent, own)[0]
        return "\n\n".join(text for text, odds in zip(page.text, whole, strict=True) if text is not None and odds > 0)


@cache
def trained(rounds: int = 150, rate: float = 0.1, penalty: float = 0.01, more: int = 100) -> Model:
    """Maximum-likelihood weights of the labelled pages and as many ``more``, by gradient ascent with a penalty on their squares."""
    pages = [Page(source) for source in [*PAGES, *varied(more, 1)]]
    weights = {n: 0.0 for page in pages for names in page.features for n in names}
    pair = [0.0, 0.0, 0.0, 0.0]
    past: dict = {}

    def step(key, value: float, grad: float) -> float:
        first, second, count = past.get(key, (0.0, 0.0, 0))
        first, second, count = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad * grad, count + 1
        past[key] = first, second, count
        return value + rate * first / (1 - 0.9 ** count) / (math.sqrt(second / (1 - 0.99 ** count)) + 1e-8)

    for _ in range(rounds):
        model = Model(weights, tuple(pair))
        grad = {n: -penalty * w for n, w in weights.items()}
        pair_grad = [-penalty * w for w in pair]
        for page in pages:
            own = [model.potential(f) for f in page.features]
            whole, below, apart = model.messages(page.parent, own)
            for names, label, odds in zip(page.features, page.label, whole, strict=True):
                error = label - 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))
                for n in names:
                    grad[n] += error
            for k in range(1, len(own)):
                logs = [pair[0], pair[1] + below[k], pair[2] + apart[k], pair[3] + below[k] + apart[k]]
                top = max(logs)
                parts = [math.exp(x - top) for x in logs]
                for s in range(4):
                    pair_grad[s] += (2 * page.label[page.parent[k]] + page.label[k] == s) - parts[s] / sum(parts)
        weights = {n: step(n, w, grad[n]) for n, w in weights.items()}
        pair = [step(s, pair[s], pair_grad[s]) for s in range(4)]
    return Model(weights, tuple(pair))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row."""
    model = trained()

    def rows():
        extract = model.extract
        return lambda b: [(i, u, t, len(t)) for i, u, t in zip(b["page_id"], b["url"], map(extract, b["html"]), strict=True)]

    return mapped(pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")), rows, "page_id long, url string, text string, n_chars long")
