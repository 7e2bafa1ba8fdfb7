"""Main text of HTML pages by a tree-structured graphical model of the DOM.

Every element and every piece of text is a node with a hidden label, content or boilerplate.  A node has a *node potential*, a
logistic function of what it is (tag, words of its class, id and role, length, links, punctuation), and each parent-child pair an
*edge potential*, how often a child with such a tag has each label given its parent's.  Both are trained from labelled pages.
Sum-product messages run up the tree and down again, which gives the exact marginal of every node in two passes; the text nodes
whose content marginal is at least one half are the main text.

``labelled_pages`` makes the training pages from templates; other labelled pages can be given instead: pages in which the
content's text begins with ``MARK``.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from paralith.llm.common import positional

MARK = "\ue000"
MOST_OF_TEXT = 1.0

# Fixed values of HTML.
VOID = frozenset("area base basefont bgsound br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style template noscript title head svg math iframe object canvas audio video select textarea datalist".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul caption".split()
)
ENDS_P = BLOCK - {"body", "br", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup", "legend"}
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
BARRIERS = frozenset("table td th caption button html body".split())
FOREIGN = frozenset({"svg", "math"})  # in these "/>" closes an element
IN_HEAD = VOID & {"base", "basefont", "bgsound", "link", "meta"} | frozenset("title noscript noframes style script template".split())

_piece = re.compile(r"<!--.*?(?:--!?>|$)|<[!?][^>]*(?:>|$)|</([A-Za-z][^\s/>]*)[^>]*(?:>|$)|<([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.DOTALL)
_attribute = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_named = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


@dataclass
class Node:
    """An element, or with tag '#text' a piece of text."""

    tag: str
    parent: int
    names: tuple[str, ...] = ()
    text: str = ""
    linked: bool = False
    block: int = 0

    @property
    def kind(self) -> str:
        """The kind of edge to the parent: the tag, and whether the element has names."""
        return f"{self.tag}+" if self.names else self.tag


def _self_closed(attributes: str) -> bool:
    """Whether a start tag ends in a slash that is no part of an unquoted value."""
    if not attributes.endswith("/"):
        return False
    values = [a.end() for a in _attribute.finditer(attributes) if a.group(4)]
    return not values or values[-1] < len(attributes)


def parse(page: str) -> list[Node]:
    """The page's nodes, parents before children, in page order; node 0 is the root.

    Unclosed and misnested tags are closed as browsers do; text of elements that show none is left out.  ``block`` counts
    the block boundaries before a piece of text.
    """
    nodes = [Node("#root", -1)]
    open_: list[int] = [0]
    unseen = block = links = 0
    at, end = 0, len(page)

    def close(to: int) -> None:
        nonlocal unseen, block, links
        while len(open_) > to:
            tag = nodes[open_.pop()].tag
            unseen -= tag in UNSEEN
            links -= tag == "a"
            block += tag in BLOCK

    def end_head() -> None:
        while nodes[open_[-1]].tag == "head":
            close(len(open_) - 1)

    def text(raw: str) -> None:
        if unseen and html.unescape(raw).strip(" \t\n\r\f"):
            end_head()
        if raw and not unseen:
            nodes.append(Node("#text", open_[-1], text=html.unescape(raw), linked=links > 0, block=block))

    def find(tags: set | frozenset, barriers: set | frozenset) -> int:
        for k in range(len(open_) - 1, 0, -1):
            tag = nodes[open_[k]].tag
            if tag in tags:
                return k
            if tag in barriers:
                return 0
        return 0

    while at < end:
        m = _piece.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        ending, starting = m.group(1), m.group(2)
        if ending:
            tag = ending.lower()
            if tag in ("br", "p") and (tag == "br" or not find({"p"}, BARRIERS)):
                block += 1
            elif k := find({tag}, frozenset() if tag in BARRIERS or tag in ("table", "form", "div", "section", "article") else BARRIERS):
                close(k)
        elif starting:
            tag = starting.lower()
            if tag not in IN_HEAD:
                end_head()
            if tag in ENDS_P and (k := find({"p"}, BARRIERS)):
                close(k)
            if tag in IMPLIED:
                while k := find(*IMPLIED[tag]):
                    close(k)
            if tag in ("h1", "h2", "h3", "h4", "h5", "h6") and nodes[open_[-1]].tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
                close(len(open_) - 1)
            block += tag in BLOCK
            if tag in VOID:
                continue
            names: tuple[str, ...] = ()
            if m.group(3):
                for a in _attribute.finditer(m.group(3)):
                    if a.group(1).lower() in ("class", "id", "role"):
                        names += tuple(x.lower() for x in _named.findall(html.unescape(a.group(2) or a.group(3) or a.group(4) or "")))
            nodes.append(Node(tag, open_[-1], names))
            if _self_closed(m.group(3) or "") and (tag in FOREIGN or nodes[open_[find(FOREIGN | {"foreignobject"}, frozenset())]].tag in FOREIGN):
                continue
            open_.append(len(nodes) - 1)
            unseen += tag in UNSEEN
            links += tag == "a"
            if tag in RAW:
                stop = re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE).search(page, at)
                at = stop.start() if stop else end
    return nodes


# ---- model ---------------------------------------------------------------------------------------------------------


CONTAINERS = frozenset("article aside body div footer form header html main nav section td".split())


def _features(nodes: list[Node]) -> list[list[tuple[str, str]]]:
    """Features of each node as (family, value): of a text whether it is a link, by the parent's tag; of an element each of its names, and of containers how much text that is no link they hold."""
    out: list[list[tuple[str, str]]] = [[] for _ in nodes]
    chars = [0] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        node = nodes[i]
        if node.tag == "#text":
            n = len(node.text.strip())
            chars[i] = 0 if node.linked else n
            if n:
                out[i].append((f"text in {nodes[node.parent].tag}", "linked" if node.linked else "plain"))
        else:
            out[i] += [("name", x) for x in set(node.names)]
            if node.tag in CONTAINERS:
                out[i].append(("amount", str(min(6, chars[i].bit_length() // 2))))
        if i:
            chars[node.parent] += chars[i]
    return out


@dataclass
class PageModel:
    """Weights of the features, and for each kind of child (see ``Node.kind``) the probability of content given a parent that is boilerplate or content."""

    weights: dict[tuple[str, str], float] = field(default_factory=dict)
    edges: dict[str, tuple[float, float]] = field(default_factory=dict)

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Log odds of content of every node, by messages up and down the tree."""
        weights, exp, log = self.weights, math.exp, math.log
        other = self.edges[""]
        up = [sum(weights.get(f, 0.0) for f in fs) for fs in _features(nodes)]
        odds = [self.edges.get(x.kind) or self.edges.get(x.tag, other) for x in nodes]
        message = [0.0] * len(nodes)
        for i in range(len(nodes) - 1, 0, -1):
            a, b = odds[i]
            e = exp(max(-60.0, min(60.0, up[i])))
            message[i] = log((1 - b + b * e) / (1 - a + a * e))
            up[nodes[i].parent] += message[i]
        full = up[:]
        for i in range(1, len(nodes)):
            a, b = odds[i]
            e = exp(max(-60.0, min(60.0, full[nodes[i].parent] - message[i])))
            full[i] = up[i] + log((a + b * e) / (1 - a + (1 - b) * e))
        return full

    def main_text(self, page: str) -> str:
        """The content's text: character references decoded, white space of a block as one space, blocks joined by one space."""
        nodes = parse(page)
        blocks: list[list[str]] = []
        last = None
        for node, odds in zip(nodes, self.marginals(nodes), strict=True):
            if node.tag == "#text" and odds >= 0:
                if node.block != last:
                    blocks.append([])
                    last = node.block
                blocks[-1].append(node.text)
        return " ".join(x for x in (" ".join("".join(b).split()) for b in blocks) if x)


def train(pages: list[str]) -> PageModel:
    """Fit node and edge potentials to pages whose content begins with ``MARK`` in each piece of text, by counting.

    An element's label is that of most of its text; elements without text are not counted.  An edge's potential is the
    share of content among children of that tag by the parent's label, a feature's is its likelihood ratio between labels.
    Text and its amount count for at most ``MOST_OF_TEXT`` each, so that where it stands decides unless several agree.
    """
    edges: dict[tuple[str, int], list[float]] = defaultdict(lambda: [0.0, 0.0])
    seen: dict[tuple[str, str], list[float]] = defaultdict(lambda: [0.2, 0.2])
    total: dict[str, list[float]] = defaultdict(lambda: [1.0, 1.0])
    for page in pages:
        nodes = parse(page)
        good, all_ = [0] * len(nodes), [0] * len(nodes)
        for i in range(len(nodes) - 1, -1, -1):
            node = nodes[i]
            if node.tag == "#text":
                all_[i] = len(node.text.strip())
                good[i] = all_[i] if MARK in node.text else 0
                node.text = node.text.replace(MARK, "")
            if i:
                good[node.parent] += good[i]
                all_[node.parent] += all_[i]
        label = [int(2 * g > n) for g, n in zip(good, all_, strict=True)]
        for i, features in enumerate(_features(nodes)):
            if not all_[i]:
                continue
            for f in features:
                seen[f][label[i]] += 1
                total[f[0]][label[i]] += 1
            if i:
                edges[nodes[i].kind, label[nodes[i].parent]][label[i]] += 1
                edges["", label[nodes[i].parent]][label[i]] += 0.1
    ratio = {f: math.log(n[1] / total[f[0]][1]) - math.log(n[0] / total[f[0]][0]) for f, n in seen.items()}
    weights = {f: max(-MOST_OF_TEXT, min(MOST_OF_TEXT, w)) if f[0] == "amount" or f[0].startswith("text") else w for f, w in ratio.items()}
    tags = {t for t, _ in edges}
    rest = [(edges["", p][1] + 1) / (sum(edges["", p]) + 2) for p in (0, 1)]
    share = lambda t, p: (edges[t, p][1] + rest[p]) / (sum(edges[t, p]) + 1)
    return PageModel(weights, {t: (share(t, 0), share(t, 1)) if t else (rest[0], rest[1]) for t in tags})


# ---- labelled pages ------------------------------------------------------------------------------------------------

# Names that page templates use for their parts.
CONTENT = ["article", "main", "content", "post", "entry", "story", "body", "text", "page", "article-body", "post-content", "entry-content", "main-content", "story-text"]
BOXES = {
    "nav": ["nav", "navbar", "menu", "main-menu", "breadcrumb", "breadcrumbs", "topnav", "navigation", "toc", "pagination", "pager"],
    "header": ["header", "masthead", "banner", "site-header", "top", "branding", "logo", "toolbar"],
    "footer": ["footer", "site-footer", "copyright", "bottom", "colophon", "legal", "credits"],
    "aside": ["sidebar", "side", "widget", "related", "recommended", "aside", "promo", "trending", "popular", "rail"],
    "notice": ["cookie", "notice", "consent", "alert", "gdpr", "popup", "modal", "disclaimer", "subscribe", "newsletter", "paywall"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsored", "sponsor", "ad-slot", "banner-ad"],
    "form": ["search", "login", "signup", "form", "contact-form", "search-box"],
    "comments": ["comments", "comment", "comment-list", "replies", "responses", "disqus", "discussion", "comment-body"],
    "share": ["share", "social", "tags", "meta", "byline", "tools", "share-buttons"],
}
_SYLLABLES = "ba co di fu ga he in jo ka lu mo ne or pa qui re sa to un ve".split()


def labelled_pages(n: int = 800, seed: int = 11) -> list[str]:
    """Pages of random words in varied templates, with ``MARK`` before each piece of content text."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice(_SYLLABLES) for _ in range(r.randint(1, 4)))
    words = lambda a, b: " ".join(word() for _ in range(r.randint(a, b)))

    def sentences(a: int, b: int) -> str:
        return " ".join(words(1, 18).capitalize() + r.choice(["."] * 5 + ["?", "!", ":"]) for _ in range(r.randint(a, b)))

    def prose(m: str) -> str:
        x = r.random()
        out = m + (sentences(1, 6) if x < 0.7 else words(1, 4) + r.choice([".", ""]) if x < 0.85 else r.choice([" ", " | ", " ## "]).join(words(1, 2) for _ in range(r.randint(2, 30))))
        if r.random() < 0.25:
            tag = r.choice(["b", "i", "em", "strong", "a href='/x'", "span", "code", "u", "sup"])
            out += f" <{tag}>{m}{words(1, 4)}</{tag.split()[0]}>{m} {words(0, 8)}."
        return out

    def paragraphs(m: str, a: int, b: int, tag: str = "p") -> str:
        out = ""
        for _ in range(r.randint(a, b)):
            x = r.random()
            if x < 0.08:
                out += f"<h{r.randint(2, 4)}>{m}{words(1, 6)}</h2>".replace("</h2>", f"</h{out.count('zz') + 2}>")
            elif x < 0.14:
                out += "<ul>" + "".join(f"<li>{m}{words(1, 12)}</li>" for _ in range(r.randint(2, 5))) + "</ul>"
            elif x < 0.18:
                out += f"<blockquote>{'<p>' if r.random() < 0.5 else ''}{prose(m)}</blockquote>"
            elif x < 0.22:
                out += "<table>" + "".join(f"<tr><td>{m}{words(1, 3)}</td><td>{m}{words(1, 3)}</td></tr>" for _ in range(3)) + "</table>"
            elif x < 0.25:
                out += f"<figure><img src=x.png><figcaption>{m}{words(2, 9)}</figcaption></figure>"
            elif x < 0.28:
                out += f"<pre>{m}{words(4, 20)}</pre>"
            else:
                out += f"<{tag}>{'<b>' if r.random() < 0.1 else ''}{prose(m)}" + (f"</{tag}>" if r.random() < 0.85 or tag != "p" else "")
        return out

    def links(k: int) -> str:
        style = r.random()
        items = [f'<a href="/{word()}">{words(1, 4)}</a>' for _ in range(k)]
        if style < 0.6:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return (" | " if style < 0.8 else " ").join(items)

    def box(kind: str) -> str:
        names = r.sample(BOXES[kind], 1 + (r.random() < 0.3))
        attribute = f' {r.choice(["class", "id", "class"])}="{" ".join(names)}"' if r.random() < 0.9 or kind in ("ad", "notice", "share") else ""
        tag = {"nav": ["nav", "nav", "div", "ul"], "header": ["header", "header", "div"], "footer": ["footer", "footer", "div"], "aside": ["aside", "aside", "div", "section"], "notice": ["div", "section", "div", "dialog"], "ad": ["div", "aside", "div", "section"], "form": ["form"], "comments": ["section", "div", "div"], "share": ["div", "p", "ul"]}[kind]
        tag = r.choice(tag)
        if tag not in ("nav", "header", "footer", "aside", "form") and not attribute:
            attribute = f' class="{names[0]}"'
        if kind == "nav":
            inner = links(r.randint(2, 9))
        elif kind == "header":
            inner = f"<a href=/>{words(1, 3)}</a>" + (f"<p>{words(2, 6)}</p>" if r.random() < 0.5 else "") + (f"<nav>{links(4)}</nav>" if r.random() < 0.4 else "")
        elif kind == "footer":
            inner = r.choice([f"&copy; {words(1, 3)} &middot; {sentences(1, 3)}", f"<p>&copy; {words(1, 5)}</p>{links(4)}", f"<p>{sentences(1, 4)}</p>", sentences(1, 2)])
        elif kind == "aside":
            inner = f"<h3>{words(1, 3)}</h3>" + r.choice([links(5), f"<p>{sentences(1, 4)}</p>", links(3) + f"<p>{sentences(1, 2)}</p>"])
        elif kind == "notice":
            inner = r.choice([f"<p>{sentences(1, 3)}</p><button>{words(1, 2)}</button>", sentences(1, 3), f"<p>{sentences(1, 3)} <a href=/p>{words(1, 2)}</a></p>"])
        elif kind == "ad":
            inner = r.choice([sentences(1, 3), f"<p>{sentences(1, 3)}</p>", f"<a href=/ad>{words(2, 8)}</a>", words(2, 8)])
        elif kind == "form":
            inner = f"<label>{words(1, 3)}</label><input name=q><button>{words(1, 2)}</button>" + (f"<p>{sentences(1, 2)}</p>" if r.random() < 0.4 else "")
        elif kind == "comments":
            one = lambda: f'<{(t := r.choice(["div", "li", "article"]))} class="{r.choice(["comment", "reply", "comment-item"])}"><b>{word()}</b><p>{sentences(1, 4)}</p></{t}>'
            inner = f"<h3>{words(1, 2)}</h3>" + "".join(one() for _ in range(r.randint(1, 5))) + (box("form") if r.random() < 0.4 else "")
        else:
            inner = links(3) if r.random() < 0.6 else words(1, 5)
        return f"<{tag}{attribute}>{inner}</{tag}>"

    pages = []
    for _ in range(n):
        before = "".join(box(k) for k in ("notice", "header", "nav", "ad", "form") if r.random() < 0.55)
        after = "".join(box(k) for k in ("share", "comments", "aside", "ad", "nav", "footer") if r.random() < 0.55)
        inside_before = "".join(box(k) for k in ("share", "nav") if r.random() < 0.15)
        inside_after = "".join(box(k) for k in ("share", "aside", "ad", "comments", "form", "footer") if r.random() < 0.12)
        title = f"<h1>{MARK}{words(2, 9)}</h1>" if r.random() < 0.8 else ""
        style = r.random()
        tag = r.choice(["p"] * 6 + ["div"])
        core = paragraphs(MARK, 1, r.choice([1, 2, 4, 9, 20]), tag)
        if r.random() < 0.2:
            core = core[: len(core) // 2 + 0] + core[len(core) // 2 :]
        if r.random() < 0.15:
            at = core.find("</p>")
            core = core[: at + 4] + box(r.choice(["ad", "aside", "notice"])) + core[at + 4 :] if at > 0 else core
        body = inside_before + title + core + inside_after
        if style < 0.45:
            body = f"<article>{body}</article>"
        elif style < 0.6:
            body = f"<main>{body}</main>"
        elif style < 0.9:
            body = f'<{(t := r.choice(["div", "section"]))} {r.choice(["class", "id"])}="{r.choice(CONTENT)}">{body}</{t}>'
        if r.random() < 0.3:
            body = f'<main>{body}</main>' if r.random() < 0.5 else f'<div class="{r.choice(["wrapper", "container", "row", "site", "layout", "col"])}">{body}{after}</div>'
            after = after if "</div>" not in body[-6:] else ""
        pages.append(f"<!DOCTYPE html><html><head><title>{words(1, 4)}</title></head><body>{before}{body}{after}</body></html>")
    pages += [f"<p>{MARK}{sentences(1, 3)}" for _ in range(max(1, n // 40))] + [f"{MARK}{sentences(1, 3)}" for _ in range(max(1, n // 40))]
    return pages


_trained: list[PageModel] = []


def default_model() -> PageModel:
    """The model of the made pages, trained once in a process."""
    if not _trained:
        _trained.append(train(labelled_pages()))
    return _trained[0]


def extract_main_text(pages: DataFrame, html_col: str = "html", model: PageModel | None = None) -> DataFrame:
    """The columns of ``pages`` with ``text``, the main text of the whole html, and ``n_chars``, its code points; they replace columns of these names.

    Null and empty pages, and pages without content, have the empty text.  Rows are independent: repeated rows have equal
    results, an empty table gives an empty table.
    """
    inner, (page,) = positional(pages, html_col)
    model = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [model.main_text(x) if x else "" for x in batch.column(page).to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*batch.schema.names, "text", "n_chars"])

    done = inner.mapInArrow(run, StructType([*inner.schema.fields, StructField("text", StringType()), StructField("n_chars", LongType())]))
    new = ("text", "n_chars")
    return done.select(*(F.col(c).alias(name) for c, name in zip(inner.columns, pages.columns, strict=True) if name not in new), *new)
