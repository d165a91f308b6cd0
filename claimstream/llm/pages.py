"""Main text of web pages by gradient-boosted trees over the nodes of the page.

Every block element with text is a node with features of its subtree (size, density of text,
links and marks), its place (depth, position, brothers and sisters) and the tokens of its
tag, class, id and role and of those of its ancestors.  Boosted trees give each node the
odds of being main text.  The page is then decoded as a whole, bottom-up: a node may only be
kept below kept nodes, and the choice with the highest total over the page is taken, so
an ancestor and its descendants cannot contradict each other.

No page says which text is the main one.  The trees learn from at most ``TRAIN_PAGES`` pages
that mark their article with a tag; where these are fewer, also from pages that mark their main
part, and then from the node that holds most of a page's running text.  They learn from the original form
and from forms in which the tag is exchanged for a neutral one and furniture that the
contract names (menus, notices, comments and the like) is put around and into the article
with sentences of the page itself.  There the right answer is known because of where a node
came from.

Defined results: null and empty html give an empty text; markup that is not closed ends with
what encloses it; a head also ends where something starts that may not stand in it, and
a self-closed svg is empty; white space is blank, tab, line feed, vertical tab, form feed and carriage return;
a page without any kept node gives an empty text.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import escape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimstream.llm import boosting

# The bound on what the driver learns from.
TRAIN_PAGES = 200
VOCABULARY = 120

# Elements of HTML by how they take part in the text.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
NO_TEXT = set(
    "head script style template noscript form select textarea button svg iframe object canvas audio video".split()
)
BLOCK = set(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre"
    " table thead tbody tfoot tr td th figure figcaption aside nav header footer address details"
    " summary hr form fieldset center caption".split()
)
IN_HEAD = set("html head base basefont bgsound link meta title style script noscript noframes template".split())
CLOSED_BY = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
}
SCOPE = {"ul", "ol", "dl", "table", "body", "html", "article", "div", "section", "main", "td", "th"}
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_TOKEN = re.compile(r"[a-z]+")


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    tokens: set[str]
    given: str | None
    order: int
    links: int = 0
    children: list[int] = field(default_factory=list)


class Page(HTMLParser):
    """Block elements of a page and the pieces of text in them, in page order."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("page", -1, 0, set(), None, 0)]
        self.pieces: list[tuple[int, list[str]]] = []
        self.open: list[tuple[str, int]] = [("page", 0)]
        self.silent = self.linked = 0
        self.feed(html)
        self.close()

    def _pop_to(self, at: int) -> None:
        for tag, _ in self.open[at:]:
            self.silent -= tag in NO_TEXT
            self.linked -= tag == "a"
        del self.open[at:]
        self._new_piece()

    def _new_piece(self) -> None:
        self.pieces.append((self.open[-1][1], []))

    def _close_head(self, tag: str) -> None:
        """The end tag of a head may be left out: what may not stand in it ends it."""
        if tag == "body":
            at = next((i for i, (name, _) in enumerate(self.open) if name in ("head", "template")), 0)
        else:
            at = 0 if tag in IN_HEAD else len(self.open) - 1
        if self.open[at][0] == "head":
            self._pop_to(at)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._close_head(tag)
        if tag in VOID:
            if tag == "br":
                self.handle_data(" ")
            elif tag == "hr":
                self._new_piece()
            return
        if tag in BLOCK:
            self._close_implied(tag)
        node = self.open[-1][1]
        if tag in BLOCK:
            known = dict(attrs)
            words = " ".join(known.get(a) or "" for a in ("class", "id", "role"))
            tokens = {tag, *("." + t for t in _TOKEN.findall(words.lower()))}
            above = self.nodes[node]
            self.nodes.append(
                Node(tag, node, above.depth + 1, tokens, known.get("data-origin"), len(above.children))
            )
            node = len(self.nodes) - 1
            above.children.append(node)
        self.open.append((tag, node))
        self.silent += tag in NO_TEXT
        self.linked += tag == "a"
        if tag in BLOCK:
            self._new_piece()

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag == "svg":  # the one element without text that may close itself
            self._close_head(tag)
        else:
            self.handle_starttag(tag, attrs)

    def _close_implied(self, tag: str) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            name = self.open[at][0]
            if name == "p" or name in CLOSED_BY.get(tag, ()):
                self._pop_to(at)
                if name == "p" and tag in CLOSED_BY:
                    self._close_implied(tag)
                return
            if name in SCOPE:
                return

    def handle_endtag(self, tag: str) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][0] == tag:
                if tag in BLOCK or tag in NO_TEXT:
                    self._pop_to(at)
                else:
                    self.linked -= tag == "a"
                    del self.open[at]
                return
            if self.open[at][0] in BLOCK and tag not in BLOCK:
                return

    def handle_data(self, data: str) -> None:
        if self.open[-1][0] == "head" and _SPACE.sub("", data):
            self._close_head("")
        if not self.silent:
            if not self.pieces:
                self._new_piece()
            self.pieces[-1][1].append(data)
            if self.linked:
                self.nodes[self.open[-1][1]].links += len(data)

    def blocks(self) -> list[tuple[int, str]]:
        """(node, text) of the pieces that have text, white space folded."""
        folded = ((n, _SPACE.sub(" ", "".join(parts)).strip(" ")) for n, parts in self.pieces)
        return [(n, t) for n, t in folded if t]


NUMBERS = 14


class Vocabulary:
    """Numbers of the known tokens; a longer token has those of the known ones it contains."""

    def __init__(self, tokens: list[str]):
        self.known = {t: i for i, t in enumerate(tokens)}
        self.roots = [(t[1:], i) for t, i in self.known.items() if t[0] == "." and len(t) > 4]
        self.seen: dict[str, tuple[int, ...]] = {}

    def __len__(self) -> int:
        return len(self.known)

    def numbers(self, token: str) -> tuple[int, ...]:
        found = self.seen.get(token)
        if found is None:
            found = (self.known[token],) if token in self.known else ()
            if token[0] == ".":
                found = tuple({*found, *(i for root, i in self.roots if root in token)})
            if len(self.seen) < 100_000:
                self.seen[token] = found
        return found


def node_features(page: Page, blocks: list[tuple[int, str]], vocabulary: Vocabulary) -> tuple[list[int], np.ndarray]:
    """The nodes with text of their own and a row of features for each.

    After the numbers come the tokens of the node itself, then those of its ancestors.
    """
    nodes, n = page.nodes, len(page.nodes)
    own = [[0.0, 0.0, 0.0, 0.0] for _ in nodes]  # characters, words, sentence marks, pieces
    for at, text in blocks:
        mine = own[at]
        mine[0] += len(text)
        mine[1] += text.count(" ") + 1
        mine[2] += text.count(".") + text.count("!") + text.count("?")
        mine[3] += 1
    subtree = [x.copy() for x in own]
    linked, count = [float(x.links) for x in nodes], [1] * n
    for i in range(n - 1, 0, -1):
        up = nodes[i].parent
        for k in range(4):
            subtree[up][k] += subtree[i][k]
        linked[up] += linked[i]
        count[up] += count[i]
    whole, before = max(1.0, subtree[0][0]), 0.0
    alike: list[Counter] = [Counter() for _ in nodes]
    for node in nodes[1:]:
        alike[node.parent][node.tag] += 1
    own_tokens: list[set[int]] = []
    above_tokens: list[set[int]] = []
    chosen, rows, flags = [], [], []
    size = len(vocabulary)
    for i, node in enumerate(nodes):
        up = node.parent
        own_tokens.append({k for t in node.tokens for k in vocabulary.numbers(t)})
        above_tokens.append(above_tokens[up] | own_tokens[up] if up >= 0 else set())
        if own[i][3]:
            chars, words, marks, pieces = subtree[i]
            up = max(up, 0)
            brothers = max(1, len(nodes[up].children))
            rows.append(
                (
                    chars,
                    own[i][0],
                    linked[i] / max(1.0, chars),
                    chars / count[i],
                    marks / max(1.0, words),
                    words / max(1.0, pieces),
                    node.depth,
                    node.order,
                    brothers,
                    alike[up][node.tag] / brothers,
                    subtree[up][0] / brothers,
                    chars / whole,
                    before / whole,
                    len(node.children),
                )
            )
            flags += [len(chosen) * 2 * size + k for k in own_tokens[i]]
            flags += [(len(chosen) * 2 + 1) * size + k for k in above_tokens[i]]
            chosen.append(i)
        before += own[i][0]
    tokens = np.zeros(len(chosen) * 2 * size)
    tokens[flags] = 1
    return chosen, np.hstack([np.array(rows).reshape(-1, NUMBERS), tokens.reshape(len(chosen), 2 * size)])


def decode(page: Page, logits: dict[int, float]) -> list[bool]:
    """Which nodes are kept: the best total of log-odds with no kept node below a dropped one."""
    n = len(page.nodes)
    best = [logits.get(i, 0.0) for i in range(n)]
    for i in range(n - 1, 0, -1):
        if best[i] > 0:
            best[page.nodes[i].parent] += best[i]
    kept = [True] * n
    for i in range(1, n):
        kept[i] = kept[page.nodes[i].parent] and best[i] > 0
    return kept


@dataclass
class Extractor:
    vocabulary: Vocabulary
    trees: boosting.Trees

    def texts(self, htmls: list[str | None]) -> list[str]:
        pages = [Page(h or "") for h in htmls]
        blocks = [p.blocks() for p in pages]
        found = [node_features(p, b, self.vocabulary) for p, b in zip(pages, blocks)]
        logits = self.trees.logits(np.concatenate([x for _, x in found])).tolist() if found else []
        out, at = [], 0
        for page, block, (chosen, _) in zip(pages, blocks, found):
            kept = decode(page, dict(zip(chosen, logits[at : at + len(chosen)])))
            at += len(chosen)
            out.append("\n".join(t for n, t in block if kept[n]))
        return out


# Furniture put into the training pages; {s} is a sentence of the page, {w} a word.
FURNITURE = """
<aside class="sidebar"><h3>{w}</h3><p>{s}</p><p>{s}</p></aside>
<div class="sidebar widget"><h4>{w}</h4><ul><li><a href="#">{w}</a></li><li><a href="#">{w}</a></li></ul></div>
<div id="comments" class="comments"><h2>{w}</h2><div class="comment"><p>{s}</p></div><div class="comment"><p>{s}</p></div></div>
<section class="reader-comments"><ol><li class="comment"><b>{w}</b><p>{s} {s}</p></li></ol></section>
<div class="cookie-notice" role="alert"><p>{s}</p></div>
<div class="notice banner" id="notice">{s}</div>
<div class="newsletter subscribe"><h4>{w}</h4><p>{s}</p></div>
<header class="site-header"><h2>{w}</h2><p>{s}</p></header>
<header><h1>{w} {w}</h1><p>{s}</p></header>
<header><div class="logo">{w}</div><div class="tagline">{s}</div></header>
<div class="menu"><ul><li><a href="#">{w}</a></li><li><a href="#">{w}</a></li><li><a href="#">{w}</a></li></ul></div>
<nav class="breadcrumbs"><a href="#">{w}</a> / <a href="#">{w}</a></nav>
<div class="related"><h3>{w}</h3><ul><li><a href="#">{s}</a></li><li><a href="#">{s}</a></li></ul></div>
<div class="share social"><a href="#">{w}</a> <a href="#">{w}</a></div>
<div class="ad advert">{s}</div>
<div class="ads sponsored promo"><p>{s}</p></div>
<aside class="aside-box"><p>{s}</p></aside>
<footer class="site-footer"><p>{s}</p><ul><li><a href="#">{w}</a></li></ul></footer>
<div class="footer copyright">{s}</div>
<div class="popup modal overlay"><p>{s}</p></div>
""".strip().splitlines()
BODIES = (
    '<article class="post">', "<main>", '<div class="content">', '<div class="entry article-body">',
    '<section class="story text">', "<div>", '<div id="main">', '<div class="post-content">',
)
# Other forms a paragraph of an article may take.
OTHER = (
    "<ul><li>{0}</li><li>{0}</li></ul>", "<ol><li>{0}</li></ol>", "<blockquote>{0}</blockquote>", "<h2>{0}</h2>",
    "<h3>{0}</h3>", "<table><tr><td>{0}</td></tr></table>", "<pre>{0}</pre>", "<div>{0}</div>",
)
# How tags begin that say by themselves that they hold furniture.
SEMANTIC = ("asi", "hea", "foo", "nav")
_NAMES = re.compile(r' (?:class|id|role)="[^"]*"')
# What marks an article, the surest first.
_MARKS = tuple(
    re.compile(pattern, re.S | re.I)
    for pattern in (
        r"<(article)\b[^>]*>(.*)</article\s*>",
        r"<(main)\b[^>]*>(.*)</main\s*>",
        r"<(\w+)\b[^>]*\brole\s*=\s*[\"']?main\b[^>]*>(.*)</\1\s*>",
    )
)
# Where no mark is: a subtree holds the article with this share of the page's running text.
DENSE = 0.6


def marked_article(html: str) -> tuple[int, str, str, int] | None:
    """Start, tag, inner html and end of the part of a page that is marked as its article."""
    for mark in _MARKS:
        found = mark.search(html)
        if found:
            return found.start(), found[1].lower(), found[2], found.end()
    return None


def dense_article(html: str) -> tuple[str, str] | None:
    """(article, rest) of a page without a mark, as paragraphs and as furniture.

    The article is the deepest node with most of the running text: blocks that hold a sentence
    mark and are no links.  It is written anew as paragraphs, since it may have no tag of its own.
    """
    page = Page(html)
    blocks = page.blocks()
    weight = [0] * len(page.nodes)
    for at, text in blocks:
        node = page.nodes[at]
        if re.search(r"[.!?](\s|$)", text) and not node.links * 2 > len(text):
            weight[at] += len(text)
    for i in range(len(weight) - 1, 0, -1):
        weight[page.nodes[i].parent] += weight[i]
    if not weight or not weight[0]:
        return None
    top = max(i for i, w in enumerate(weight) if w >= DENSE * weight[0])
    inside = [False] * len(weight)
    for i, node in enumerate(page.nodes):
        inside[i] = i == top or (node.parent >= 0 and inside[node.parent])
    article = "".join(f"<p>{escape(t)}</p>" for n, t in blocks if inside[n])
    return article, "".join(f"<div>{escape(t)}</div>" for n, t in blocks if not inside[n])


def training_pages(html: str, seed: int) -> Iterator[str]:
    """The page with its article marked by origin, and three forms with other furniture.

    A page without a mark counts with its densest part as its article; a page without
    running text teaches nothing.
    """
    draw, found = np.random.default_rng(seed), marked_article(html)
    if found:
        start, name, inner, end = found
        before, after = html[:start], html[end:]
        yield f'{before}<{name} data-origin="main">{inner}</{name}>{after}'
    else:
        dense = dense_article(html)
        if dense is None:
            return
        inner, rest = dense
        before, after = "<body>", rest + "</body>"
        yield f'{before}<div data-origin="main">{inner}</div>{after}'
    forms = inner.split("<p>")
    plain = [t for _, t in Page(inner).blocks()]
    sentences = [s.strip() for t in plain for s in re.split(r"(?<=[.!?])\s", t) if s.strip()] or ["x"]
    words = " ".join(plain).split() or ["x"]

    def furniture(k: int) -> str:
        out = []
        for _ in range(k):
            form = FURNITURE[draw.integers(len(FURNITURE))]
            if form[1:4] in SEMANTIC and draw.random() < 0.6:
                form = _NAMES.sub("", form)
            for mark, pool in (("{s}", sentences), ("{w}", words)):
                while mark in form:
                    form = form.replace(mark, pool[draw.integers(len(pool))].replace("<", "").replace("{", ""), 1)
            out.append(form.replace(">", ' data-origin="rest">', 1))
        return "".join(out)

    for _ in range(3):
        body = BODIES[draw.integers(len(BODIES))]
        tag = re.match(r"<(\w+)", body)[1]
        marked = body.replace(">", ' data-origin="main">')
        inside = furniture(int(draw.integers(0, 2)))
        varied = "".join(
            part if not i or draw.random() < 0.5 else OTHER[draw.integers(len(OTHER))].format(part)
            for i, part in enumerate([forms[0], *("<p>" + f for f in forms[1:])])
        )
        yield f"{before}{furniture(2)}{marked}{varied}{inside}</{tag}>{furniture(2)}{after}"


def fit(htmls: list[str]) -> Extractor | None:
    """Trees from pages that mark their article or have running text; none of them, no extractor."""
    pages = []
    for html in htmls:
        pages += [Page(h) for h in training_pages(html, zlib.crc32(html.encode()))]
    counts = Counter(t for p in pages for t in {t for n in p.nodes for t in n.tokens})
    vocabulary = Vocabulary(sorted(counts, key=lambda t: (-counts[t], t))[:VOCABULARY])
    xs, ys = [], []
    for page in pages:
        chosen, x = node_features(page, page.blocks(), vocabulary)
        origin: list[bool] = []
        for node in page.nodes:
            above = origin[node.parent] if node.parent >= 0 else False
            origin.append(above if node.given is None else node.given == "main")
        xs.append(x)
        ys.append([origin[i] for i in chosen])
    if not any(map(any, ys)):
        return None
    y = np.concatenate(ys).astype(float)
    return Extractor(vocabulary, boosting.fit(np.concatenate(xs), y, NUMBERS))


def train(pages: DataFrame, id: str, html: str) -> Extractor | None:
    """An extractor from a bounded number of pages, drawn by a hash.

    Pages that mark an article, as ``<article>`` in any case, come first, then those that mark
    their main part, then the others.  The draw is made on the hashes alone; only the drawn pages
    travel to the driver.
    """
    text = F.col(html)
    article = F.regexp_like(text, F.lit("(?i)<article[^a-z0-9-]"))
    main = F.regexp_like(text, F.lit("(?i)<main[^a-z0-9-]|<[^>]*role *= *[\"']?main"))
    keyed = pages.where(text.isNotNull()).select(
        F.when(article, 0).when(main, 1).otherwise(2).alias("_level"),
        F.xxhash64(id, html).alias("_key"),
        text.alias("html"),
    )
    drawn = keyed.select("_level", "_key").orderBy("_level", "_key").limit(TRAIN_PAGES).select("_key").distinct()
    rows = keyed.join(F.broadcast(drawn), "_key").dropDuplicates(["_key"]).select("_key", "html").collect()
    return fit([r["html"] for r in sorted(rows)])


def extracted(pages: DataFrame, html: str, extractor: Extractor | None) -> DataFrame:
    """``pages`` with the main text; ``text`` replaces a column of that name."""
    sent = pages.sparkSession.sparkContext.broadcast(extractor)
    kept = [c for c in pages.columns if c != "text"]
    schema = pages.select(*kept).withColumn("text", F.lit("")).schema

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(html))
            texts = []
            for at in range(0, len(column), 64):
                some = column[at : at + 64].to_pylist()
                texts += sent.value.texts(some) if sent.value else [""] * len(some)
            own = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*own, pa.array(texts, pa.string())], names=[*kept, "text"])

    return pages.mapInArrow(add, schema)
