"""Main text of HTML pages by a tree-structured graphical model.

A page is parsed into a tree of elements and text blocks. Every node is content or not; a node's
own features and, on each edge, a potential between the labels of parent and child (by the kind
of the child) make a conditional random field on the tree. Sum-product messages go up and then
down, and the marginals say which blocks are content. The weights follow the gradient of the
likelihood (observed minus expected) on labelled pages, which are written by rule below in many
layouts; training pages are a fixed number.

Messages of many pages run together: nodes are sorted by depth and each level is one array step,
so a batch costs as many steps as its deepest tree.

Defined cases: null or empty html gives the empty text; unclosed tags close as browsers close
them, at the latest at the end; a cut tag at the end is dropped; repeated rows are treated alike;
pages of any length are read whole.
"""

from __future__ import annotations

import html as entities
import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from posterion.llm.common import fresh

# fixed values: element names of HTML and the words that class names use
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template head title svg iframe object canvas".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
INLINE = frozenset("a abbr b bdi bdo br big cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr label".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
GROUPS = {
    "article": "article", "main": "main", "nav": "nav menu", "header": "header", "footer": "footer", "aside": "aside", "form": "form button select textarea input label fieldset option",
    "hidden": " ".join(sorted(HIDDEN)), "list": "ul ol dl", "item": "li dt dd", "paragraph": "p pre blockquote", "heading": "h1 h2 h3 h4 h5 h6",
    "table": "table tr td th tbody thead caption", "section": "section", "box": "div center details", "page": "html body", "figure": "figure figcaption", "text": "#text", "other": "#other",
}
GROUP_OF = {name: i for i, names in enumerate(GROUPS.values()) for name in names.split()}
AGAINST = re.compile(r"(?:^|[\s_-])(?:ad|ads|advert\w*|sponsor\w*|promo\w*|banner|cookie\w*|consent|gdpr|notice|alert|comment\w*|reply|replies|respond|discussion|disqus|reader\w*|side|sidebar|rail|widget"
                     r"|nav\w*|menu\w*|breadcrumb\w*|header|masthead|topbar|footer|foot|bottom|share|sharing|social|related|recommend\w*|popular|trending|newsletter|subscri\w*|signup|login|search|tags?|pager|pagination|popup|modal|overlay|meta|byline|copyright|legal|toolbar|skip)(?:$|[\s_-])", re.I)
FOR = re.compile(r"(?:^|[\s_-])(?:article|story|post|entry|content|main|body|text|prose|blog|news|page|maintext)(?:$|[\s_-])", re.I)
ROLE = {"navigation": -1, "banner": -1, "contentinfo": -1, "complementary": -1, "search": -1, "form": -1, "dialog": -1, "alert": -1, "main": 1, "article": 1}
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
SPACE = re.compile(r"\s+")
NODE_FEATURES = len(GROUPS) + 13
THRESHOLD = 0.5


class Page:
    """Nodes of a page in page order: parent, tag group, features; text blocks keep their text."""

    def __init__(self, source: str):
        self.parent: list[int] = [-1]
        self.tag: list[str] = ["html"]
        self.cue: list[int] = [0]
        self.mark: list[str | None] = [None]            # training pages say what a node is
        self.text: list[str | None] = [None]
        self.linked: list[int] = [0]
        self._parse(source)

    def _node(self, parent: int, tag: str, cue: int = 0, mark=None, text=None, linked=0) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.cue.append(cue)
        self.mark.append(mark)
        self.text.append(text)
        self.linked.append(linked)
        return len(self.parent) - 1

    def _parse(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("html", 0)]    # inline elements share the node of their block
        words: list[str] = []
        linked, anchors = 0, 0

        def end_block():
            nonlocal linked
            text = SPACE.sub(" ", entities.unescape("".join(words))).strip()
            if text:
                self._node(stack[-1][1], "#text", text=text, linked=min(linked, len(text)))
            words.clear()
            linked = 0

        def close(tag):
            nonlocal anchors
            for at in range(len(stack) - 1, 0, -1):
                if stack[at][0] == tag:
                    if any(name not in INLINE for name, _ in stack[at:]):
                        end_block()
                    anchors -= sum(name == "a" for name, _ in stack[at:])
                    del stack[at:]
                    return
                if tag in INLINE and stack[at][0] not in INLINE:
                    return

        at, raw, lower = 0, None, None
        while at < len(source):
            if raw:
                lower = lower or source.lower()
                end = lower.find("</" + raw, at)
                if end < 0:
                    end = len(source)
                if raw in ("title", "textarea") or raw == "xmp":
                    words.append(source[at:end])
                at, raw = end, None
                continue
            found = TOKEN.search(source, at)
            piece = source[at:found.start()] if found else source[at:]
            if piece:
                words.append(piece)
                if anchors:
                    linked += len(piece)
            if not found:
                break
            at = found.end()
            name = found[2]
            if not name or not found[4]:
                continue
            name = name.lower()
            if found[1]:
                close(name) if name != "p" or any(n == "p" for n, _ in stack) else end_block()
                continue
            if name == "br" or name == "wbr":
                words.append(" ")
                continue
            if name in VOID:
                if name not in INLINE:
                    end_block()
                continue
            if name in CLOSES_P and any(n == "p" for n, _ in stack):
                close("p")
            if name == "li":
                self._until(stack, "li", ("ul", "ol", "menu"), close)
            elif name in ("dt", "dd"):
                self._until(stack, "dt", ("dl",), close)
                self._until(stack, "dd", ("dl",), close)
            elif name in ("td", "th"):
                self._until(stack, "td", ("table", "tr"), close)
                self._until(stack, "th", ("table", "tr"), close)
            elif name == "tr":
                self._until(stack, "tr", ("table",), close)
            elif name == "option":
                self._until(stack, "option", ("select",), close)
            elif name == "body" and any(n == "head" for n, _ in stack):
                close("head")
            if name in INLINE:
                anchors += name == "a"
                stack.append((name, stack[-1][1]))
            elif name == "html":
                continue
            else:
                end_block()
                cue, mark = self._attributes(found[3])
                stack.append((name, self._node(stack[-1][1], name, cue, mark)))
            if name in RAW and not found[3].endswith("/"):
                raw = name
        end_block()

    @staticmethod
    def _until(stack, tag, bounds, close) -> None:
        for name, _ in reversed(stack):
            if name == tag:
                close(tag)
                return
            if name in bounds:
                return

    @staticmethod
    def _attributes(source: str):
        cue, mark = 0, None
        for m in ATTRIBUTE.finditer(source) if source else ():
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key in ("class", "id"):
                cue += -2 if AGAINST.search(value) else 1 if FOR.search(value) else 0
            elif key == "role":
                cue += 2 * ROLE.get(value.lower(), 0)
            elif key in ("hidden", "aria-hidden") or key == "style" and "display:none" in value.replace(" ", ""):
                cue -= 3
            elif key == "data-is":
                mark = value
        return cue, mark

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """parent, depth, group and node features."""
        n = len(self.parent)
        parent = np.array(self.parent)
        group = np.array([GROUP_OF.get(t, GROUP_OF["#other"]) for t in self.tag])
        depth = np.zeros(n, np.int64)
        own = np.array([len(t) if t else 0 for t in self.text], float)
        link = np.array(self.linked, float)
        inside, inlink = own.copy(), link.copy()
        for i in range(1, n):
            depth[i] = depth[self.parent[i]] + 1
        for i in range(n - 1, 0, -1):
            inside[self.parent[i]] += inside[i]
            inlink[self.parent[i]] += inlink[i]
        cue = np.clip(np.array(self.cue), -3, 2)
        stops = np.array([sum(t.count(c) for c in ".!?") if t else 0 for t in self.text])
        sign = np.array([("©" in t) if t else False for t in self.text])
        ratio = inlink / np.maximum(inside, 1)
        x = np.zeros((n, NODE_FEATURES))
        x[np.arange(n), group] = 1
        extra = [np.ones(n), cue <= -2, cue == -1, cue == 1, cue >= 2, ratio > 0.5, (ratio > 0.2) & (ratio <= 0.5), own > 200, (own > 60) & (own <= 200), (own > 0) & (own <= 20),
                 stops > 0, sign, np.log1p(inside) / 10]
        x[:, len(GROUPS):] = np.array(extra, float).T
        return parent, depth, group, x


@dataclass
class Forest:
    """Nodes of several pages as arrays, in order of depth."""
    parent: np.ndarray
    group: np.ndarray
    x: np.ndarray
    levels: list[slice]
    place: list[np.ndarray]         # per page: where its nodes stand

    @classmethod
    def of(cls, pages: list[Page]) -> "Forest":
        parts = [p.arrays() for p in pages]
        base = np.cumsum([0] + [len(p.parent) for p in pages])
        parent = np.concatenate([np.where(a[0] < 0, -1, a[0] + b) for a, b in zip(parts, base)])
        depth, group, x = (np.concatenate([a[i] for a in parts]) for i in (1, 2, 3))
        order = np.argsort(depth, kind="stable")
        where = np.empty(len(order), np.int64)
        where[order] = np.arange(len(order))
        cuts = np.searchsorted(depth[order], np.arange(depth.max() + 2))
        up = np.where(parent[order] < 0, -1, where[parent[order]])
        return cls(up, group[order], x[order], [slice(a, b) for a, b in zip(cuts, cuts[1:])], [where[a:b] for a, b in zip(base, base[1:])])


@dataclass
class Field:
    """Weights of the node features, and log potentials (parent label, child label) by group of the child."""
    node: np.ndarray
    edge: np.ndarray

    def marginals(self, f: Forest) -> tuple[np.ndarray, np.ndarray]:
        """P(content) of each node and P(parent label, child label) of each edge."""
        unary = np.zeros((len(f.parent), 2))
        unary[:, 1] = f.x @ self.node
        pair = self.edge[f.group]                                   # node i: edge to its parent
        below = unary.copy()                                        # own potential and the messages of the children
        sent = np.zeros_like(unary)
        for level in reversed(f.levels[1:]):                        # upward
            sent[level] = np.logaddexp(pair[level, :, 0] + below[level, None, 0], pair[level, :, 1] + below[level, None, 1])
            np.add.at(below, f.parent[level], sent[level])
        total = below.copy()
        rest = np.zeros_like(unary)
        for level in f.levels[1:]:                                  # downward
            rest[level] = total[f.parent[level]] - sent[level]      # the parent without this child's message
            total[level] += np.logaddexp(rest[level, 0, None] + pair[level, 0, :], rest[level, 1, None] + pair[level, 1, :])
            total[level] -= total[level].max(axis=1, keepdims=True)
            # a message's size does not matter, only the difference of its two entries
        p = np.exp(total - total.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        joint = rest[:, :, None] + pair + below[:, None, :]
        joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        return p[:, 1], joint


def fit(pages: list[tuple[Page, np.ndarray]], steps: int = 240, rate: float = 0.5, decay: float = 2e-5) -> Field:
    """Ascend the likelihood of the labels: observed minus expected counts."""
    f = Forest.of([p for p, _ in pages])
    y = np.empty(len(f.parent), np.int64)
    for place, (_, labels) in zip(f.place, pages):
        y[place] = labels
    model = Field(np.zeros(NODE_FEATURES), np.zeros((len(GROUPS), 2, 2)))
    child = np.flatnonzero(f.parent >= 0)
    seen = np.zeros_like(model.edge)
    np.add.at(seen, (f.group[child], y[f.parent[child]], y[child]), 1)
    g_node, g_edge = np.zeros(NODE_FEATURES), np.zeros_like(model.edge)
    for _ in range(steps):
        p, joint = model.marginals(f)
        expected = np.zeros_like(model.edge)
        np.add.at(expected, f.group[child], joint[child])
        d_node = f.x.T @ (y - p) / len(y) - decay * model.node
        d_edge = (seen - expected) / len(y) - decay * model.edge
        g_node, g_edge = g_node + d_node ** 2, g_edge + d_edge ** 2
        model.node += rate * d_node / np.sqrt(g_node + 1e-9)
        model.edge += rate * d_edge / np.sqrt(g_edge + 1e-9)
    return model


# -- labelled pages -----------------------------------------------------------------

def labelled_page(r: random.Random) -> str:
    """A page in one of many layouts; data-is="1" opens content, data-is="0" closes it again."""
    word = lambda: "".join(r.choice("aeioulmnrstéü") for _ in range(r.randint(1, 9)))       # noqa: E731
    say = lambda a, b: " ".join(word() for _ in range(r.randint(a, b))).capitalize() + r.choice([".", ".", ".", "", "?"])
    link = lambda: f'<a href="/{word()}">{word()} {word()}</a>'        # noqa: E731
    end = lambda tag: "" if r.random() < 0.25 else f"</{tag}>"         # noqa: E731

    def paragraph():
        inner = " ".join(say(3, 25) for _ in range(r.randint(1, 6))) if r.random() < 0.8 else say(1, 3) if r.random() < 0.6 else " ".join([word()] * r.randint(2, 80))
        if r.random() < 0.2:
            inner += f" {link()} {say(3, 12)}"
        if r.random() < 0.15:
            inner = f"<b>{inner}<br>" if r.random() < 0.5 else f"<em>{inner}</em>"
        return f"<p>{inner}{end('p')}"

    def body():
        parts = [f"<h1>{say(2, 9)}</h1>"] if r.random() < 0.85 else []
        for _ in range(r.choice([0, 1, 2, 4, 7, 12])):
            x = r.random()
            parts.append(paragraph() if x < 0.75 else f"<h2>{say(1, 6)}</h2>" if x < 0.82 else f"<blockquote>{say(5, 20)}</blockquote>" if x < 0.87
                         else "<ul>" + "".join(f"<li>{say(2, 12)}{end('li')}" for _ in range(r.randint(2, 5))) + "</ul>" if x < 0.93
                         else f"<pre>{say(4, 14)}</pre>" if x < 0.95 else f"<table><tr><td>{say(1, 4)}<td>{say(1, 4)}</table>" if x < 0.97 else f"<div>{say(6, 30)}</div>")
        if r.random() < 0.08:                            # a long page of one short line or run again and again
            line = r.choice([say(2, 3), say(4, 12), " ".join([word()] * r.randint(5, 60)), f"<b>{say(1, 2)}"])
            parts += [f"<p>{line}{end('p')}" for _ in range(r.randint(30, 250))]
        for _ in range(r.choice([0, 0, 0, 1, 2])):
            parts.insert(r.randint(0, len(parts)), junk(r.choice(["ad", "share", "related", "newsletter", "aside"])))
        return "".join(parts) or paragraph()

    def junk(kind):
        links = "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(r.randint(2, 8))) + "</ul>"
        name = r.choice([kind, f"{kind}-box", f"{kind} wide", f"site-{kind}"])
        box = {
            "nav": lambda: f'<nav data-is="0">{links}</nav>', "menu": lambda: f'<div data-is="0" class="{name}">{links}</div>',
            "header": lambda: f'<header data-is="0"><div>{say(1, 4)}</div>{links if r.random() < 0.5 else ""}</header>',
            "footer": lambda: f'<footer data-is="0">&copy; {say(2, 12)} {say(2, 20)}</footer>',
            "bottom": lambda: f'<div data-is="0" class="footer">&copy; {say(2, 12)}<p>{say(2, 15)}</div>',
            "aside": lambda: f'<aside data-is="0"><h3>{say(1, 3)}</h3>{links if r.random() < 0.5 else "<p>" + say(5, 30) + "</p>"}</aside>',
            "comments": lambda: f'<{(t := r.choice(["div", "section"]))} data-is="0" {r.choice(["id", "class"])}="{r.choice(["comments", "comment-list", "disqus_thread", "reader-comments", "discussion"])}"><h3>{say(1, 3)}</h3>'
                                + "".join(f'<div class="{r.choice(["comment", "reply", "item"])}"><p>{say(3, 40)}</p></div>' for _ in range(r.randint(1, 5))) + f"</{t}>",
            "form": lambda: f'<form data-is="0"><label>{say(1, 3)}</label><input name="q"><button>{word()}</button><p>{say(2, 12)}</p></form>',
            "cookie-notice": lambda: f'<div data-is="0" {r.choice(["id", "class"])}="{r.choice(["cookie-notice", "cookies", "consent", "gdpr-banner", "notice"])}"><p>{say(5, 30)} {say(5, 20)}</p><button>{word()}</button></div>',
            "code": lambda: f'<script>var t = "</p>"; {word()}();</script>',
        }
        return box.get(kind, lambda: f'<div data-is="0" class="{name}">{r.choice([say(2, 25), "<p>" + say(4, 40) + "</p>", links, "<h4>" + say(1, 3) + "</h4>" + links])}</div>')()

    inner = body()
    if r.random() < 0.3:
        inner += junk(r.choice(["comments", "form", "share", "related"]))
    open_, close_ = r.choice([("<article {}>", "</article>")] * 5 + [("<main {}>", "</main>")] * 2 + [('<div class="content" {}>', "</div>"), ('<div id="main" {}>', "</div>"), ('<div class="post-body" {}>', "</div>"),
                              ('<section class="story" {}>', "</section>"), ('<div class="entry-content" {}>', "</div>"), ("<div {}>", "</div>"), ('<div role="main" {}>', "</div>"), ("<main><article {}>", "</article></main>")])
    main = open_.format('data-is="1"') + inner + close_
    lead = "".join(junk(r.choice(["nav", "menu", "header", "ad", "cookie-notice", "breadcrumb", "form", "banner", "code"])) for _ in range(r.randint(1, 4)))
    tail = "".join(junk(r.choice(["footer", "bottom", "aside", "sidebar", "comments", "related", "ad", "form", "newsletter", "popular", "code"])) for _ in range(r.randint(1, 4)))
    style = "<style>p{margin:0}</style>" if r.random() < 0.5 else ""
    page = f"<!DOCTYPE html><html><head><meta charset=utf-8><title>{say(2, 9)}</title>{style}</head><body>{lead}{main}{tail}"
    return page + ("</body></html>" if r.random() < 0.8 else "")


def training_pages(n: int = 400, seed: int = 11) -> list[tuple[Page, np.ndarray]]:
    r, out = random.Random(seed), []
    for _ in range(n):
        page = Page(labelled_page(r))
        y = np.zeros(len(page.parent), np.int64)
        for i in range(1, len(y)):
            y[i] = int(page.mark[i]) if page.mark[i] is not None else y[page.parent[i]]
        out.append((page, y))
    return out


# -- pages ----------------------------------------------------------------------------

def main_texts(model: Field, sources: list[str | None], threshold: float = THRESHOLD) -> list[tuple[str, int, float]]:
    """Text, number of blocks and least certainty of each page."""
    pages = [Page(s or "") for s in sources]
    f = Forest.of(pages)
    p, _ = model.marginals(f)
    out = []
    for page, place in zip(pages, f.place):
        own = p[place].tolist()
        blocks = [(t, q) for t, q in zip(page.text, own) if t is not None]
        chosen = [t for t, q in blocks if q >= threshold]
        out.append(("\n\n".join(chosen), len(chosen), min((max(q, 1 - q) for _, q in blocks), default=1.0)))
    return out


def extracted(pages: DataFrame, model: Field, html: str = "html", name: str = "main") -> DataFrame:
    """The table with struct(text, blocks, certainty) of each page in a new column."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<text:string,blocks:int,certainty:double>")
    def of(values: pa.Array) -> pa.Array:
        found = []
        for at in range(0, len(values), 256):
            found += main_texts(shared.value, [v.as_py() for v in values[at:at + 256]])
        text, blocks, sure = zip(*found) if found else ((), (), ())
        return pa.StructArray.from_arrays([pa.array(text, pa.string()), pa.array(blocks, pa.int32()), pa.array(sure, pa.float64())], names=["text", "blocks", "certainty"])

    return pages.withColumn(fresh(pages, name), of(F.col(f"`{html}`")))
