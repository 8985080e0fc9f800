"""Operator 6: main text by union-free regular-expression inference.

A page is a stream of tokens: containers that open and close, leaf blocks such
as paragraphs, and text slots. Streams of one host are aligned, one after the
other. A repeated stretch becomes a group ``(...)+``, a token that some pages
lack becomes optional ``(...)?``, and a text that differs becomes a slot. What
remains is the host's wrapper, an expression without alternatives. Its slots
carry how many pages fill them, with how much text, how much of it in links,
and whether the text is always the same; from that, and from the containers
around it, a slot is main text or not. Each page is then read by its wrapper,
and main text is chosen among the slots that the page fills.
Whether the article decides is up to each page: one with text in an article
gives that text, and its figures stay out of the choice for the others.

A host may hold a third of all pages, so no host is gathered in one task.
Every task folds its own pages into one wrapper per host; wrappers are merged
by the same alignment, first in ``PARTS`` parts of a host, then these. Every
page takes part. A wrapper is bounded: beyond ``NODES`` tokens, optional
tokens of the same kind become one, and optional tags and groups leave the
expression. The figures of such a group stay: each place of text keeps one slot
with the sums of all that left, so no text is without a slot.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinistar.llm.common import staged, table

PARTS = 64
NODES = 600
#: Tokens of the longest repeated stretch.
LONGEST_GROUP = 12
#: Distinct pages (copies count once) on which a text outside the article is the same, to be part of the template.
TEMPLATE_PAGES = 5

#: What tags mean here (fixed values).
CONTAINERS = frozenset(
    "html head body div section article main nav header footer aside form ul ol dl table thead tbody tfoot figure "
    "blockquote details dialog menu fieldset template noscript iframe object svg button select".split()
)
LEAVES = frozenset("p li h1 h2 h3 h4 h5 h6 pre td th tr dt dd figcaption caption address hr summary legend label option".split())
RAW = frozenset("script style textarea title".split())
CONTENT = frozenset("article main".split())
NEVER = frozenset("head nav footer aside form menu dialog template noscript iframe object svg button select fieldset".split())
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar widget footer comment comments reply replies discussion disqus "
    "share sharing social related recommended newsletter subscribe subscription signup login search popup modal pagination pager "
    "complementary contentinfo alert".split()
)
PAGE_HEADER = frozenset("header masthead topbar".split())

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<![^>]*>?|<\?[^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<(?=/?[a-zA-Z])[^>]*\Z|[^<]+|<",
    re.S,
)
ATTRIBUTE = re.compile(r"(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?(?=[\s/]|\Z)", re.I)


@dataclass
class Node:
    """A token of an expression. ``key`` decides what aligns; ``blocks`` are a
    page's texts in it, by number."""

    key: str
    path: str | None = None
    body: list[Node] | None = None
    optional: bool = False
    pages: int = 1
    chars: int = 0
    linked: int = 0
    same: str | None = None
    #: Of a text that is always the same: distinct pages with it, ``TEMPLATE_PAGES`` at most.
    on: list[str] = field(default_factory=list)
    blocks: list[int] = field(default_factory=list)

    def plain(self) -> list:
        return [self.key, self.path, self.body and [n.plain() for n in self.body], self.optional, self.pages, self.chars, self.linked, self.same, self.on]

    @staticmethod
    def of(x: list) -> Node:
        return Node(x[0], x[1], x[2] and [Node.of(y) for y in x[2]], *x[3:])


def name_of(tag: str, attributes: str) -> str:
    """A tag with what its attributes say: the words of class, id and role, without numbers."""
    if not attributes.strip():
        return tag
    words = set()
    for k, v in ATTRIBUTE.findall(attributes):
        k, v = k.lower(), v.strip("\"'").lower()
        if k in ("class", "id", "role"):
            words |= {w for w in re.split(r"[^a-z]+", v) if w}
        elif k == "hidden" or (k == "aria-hidden" and v == "true") or (k == "style" and re.search(r"display\s*:\s*none", v)):
            words.add("!hidden")
    return ".".join([tag, *sorted(words)])


def tokens(page: str) -> tuple[list[Node], list[str]]:
    """The token stream of a page, and its blocks of text."""
    stream: list[Node] = []
    blocks: list[str] = []
    stack: list[str] = []
    leaf, links, until = "", 0, None
    words: list[str] = []
    linked = 0

    def end_block() -> None:
        nonlocal words, linked
        text = " ".join("".join(words).split()) if words else ""
        if text:
            path = "/".join([*stack, leaf] if leaf else stack)
            # Until another page differs, the slot is a text that is always the same.
            stream.append(Node("#" + path, path, None, False, 1, len(text), linked, xxhash.xxh64_hexdigest(text), [], [len(blocks)]))
            blocks.append(text)
        words, linked = [], 0

    at, n = 0, len(page)
    while at < n:
        if until is not None:  # inside script, style and the like
            end = re.compile(rf"</{until}(?=[\s/>])", re.I).search(page, at)
            at, until = (end.start() if end else n), None
            if at >= n:
                break
        m = TOKEN.match(page, at)
        at = m.end()
        tag = m.group(2) or m.group(5)
        if tag is None:
            text = m.group()
            if not text.startswith("<") or text == "<":
                if "&" in text:
                    text = html.unescape(text)
                words.append(text)
                linked += len(text.strip()) if links else 0
            continue
        closes, tag, attributes = bool(m.group(1) or m.group(4)), tag.lower(), m.group(3) or m.group(6) or ""
        if tag in CONTAINERS:
            end_block()
            leaf = ""
            if not closes and not attributes.endswith("/"):
                name = name_of(tag, attributes)
                stack.append(name)
                stream.append(Node("<" + name))
            elif closes and any(s.split(".")[0] == tag for s in stack):
                while stack.pop().split(".")[0] != tag:
                    pass
                stream.append(Node("</" + tag))
        elif tag in LEAVES:
            end_block()
            leaf = "" if closes else name_of(tag, attributes)
            if leaf:
                stream.append(Node("<" + leaf))
        elif tag in RAW and not closes:
            until = tag
        elif tag == "br":
            words.append(" ")
        elif tag == "a":
            links = max(0, links + (-1 if closes else 1))
    end_block()
    return stream, blocks


def absorb(into: Node, other: Node) -> None:
    """``other`` is another occurrence of ``into``."""
    into.chars += other.chars
    into.linked += other.linked
    into.blocks += other.blocks
    if into.same != other.same:
        into.same, into.on = None, []
    elif into.same and len(into.on) < TEMPLATE_PAGES:
        into.on = [*dict.fromkeys(into.on + other.on)][:TEMPLATE_PAGES]
    for a, b in zip(into.body or (), other.body or ()):
        absorb(a, b)


def repeats(keys: list[str], size: int) -> bool:
    """Whether a stretch of this size is followed by itself."""
    run = 0
    for x, y in zip(keys, keys[size:]):
        run = run + 1 if x == y else 0
        if run == size:
            return True
    return False


def grouped(stream: list[Node], keys: list[str], size: int) -> list[Node]:
    """Repeated stretches of this size as groups."""
    out, i = [], 0
    while i < len(stream):
        j = i + size
        if keys[i:j] != keys[j : j + size]:
            out.append(stream[i])
            i += 1
            continue
        group, body = stream[i:j], keys[i:j]
        while keys[j : j + size] == body:
            for x, y in zip(group, stream[j : j + size]):
                absorb(x, y)
            j += size
        if size == 1 and group[0].body:  # two equal groups side by side are one
            out.append(group[0])
        else:
            out.append(Node("(" + " ".join(body) + ")+", body=group))
        i = j
    return out


def with_neighbours(stream: list[Node]) -> list[Node]:
    """A stretch beside its own group, before or after it, joins the group."""
    out: list[Node] = []
    i = 0
    while i < len(stream):
        group = out[-1].body if out else None
        if group and [x.key for x in group] == [x.key for x in stream[i : i + len(group)]]:
            for x, y in zip(group, stream[i : i + len(group)]):
                absorb(x, y)
            i += len(group)
            continue
        ahead = stream[i].body
        if ahead and len(out) >= len(ahead) and [x.key for x in ahead] == [x.key for x in out[-len(ahead) :]]:
            for x, y in zip(ahead, out[-len(ahead) :]):
                absorb(x, y)
            del out[-len(ahead) :]
        out.append(stream[i])
        i += 1
    return out


def fold(stream: list[Node]) -> list[Node]:
    """Repeated neighbouring stretches as groups, innermost first."""
    while True:
        before = len(stream)
        keys = [n.key for n in stream]
        for size in range(1, LONGEST_GROUP + 1):
            if repeats(keys, size):
                stream = grouped(stream, keys, size)
                keys = [n.key for n in stream]
        if any(n.body for n in stream):
            stream = with_neighbours(stream)
        if len(stream) == before:
            return stream


def single_groups(stream: list[Node], other: list[Node]) -> list[Node]:
    """A stretch that is a group in ``other`` is a group here too, seen once."""
    for g in other:
        if not g.body:
            continue
        body, out, i = [x.key for x in g.body], [], 0
        if any(n.key == g.key for n in stream):
            continue
        while i < len(stream):
            part = stream[i : i + len(body)]
            if [x.key for x in part] == body:
                out.append(Node(g.key, body=part, optional=any(x.optional for x in part), pages=max(x.pages for x in part)))
                i += len(body)
            else:
                out.append(stream[i])
                i += 1
        stream = out
    return stream


def align(a: list[Node], b: list[Node]) -> Iterator[tuple[Node | None, Node | None]]:
    """The tokens of two expressions in a common order, equal ones together."""
    matcher = SequenceMatcher(None, [n.key for n in a], [n.key for n in b], autojunk=False)
    for _, i0, i1, j0, j1 in matcher.get_opcodes():
        if _ == "equal":
            yield from zip(a[i0:i1], b[j0:j1])
        else:
            yield from ((n, None) for n in a[i0:i1])
            yield from ((None, n) for n in b[j0:j1])


def merged(a: list[Node], b: list[Node]) -> list[Node]:
    """The expression that both ``a`` and ``b`` fit."""
    left = [n for n in a + b if is_left(n)]
    a, b = ([n for n in x if not is_left(n)] for x in (a, b))
    a, b = single_groups(a, b), single_groups(b, a)
    out = []
    for x, y in align(a, b):
        if x is None or y is None:
            node = x or y
            node.optional = True
        else:
            node = x
            node.optional |= y.optional
            node.pages += y.pages
            absorb(x, y)
        node.blocks = []
        out.append(node)
    return bounded(out, left)


def is_left(n: Node) -> bool:
    """Whether this is the slot of what left the expression at a place."""
    return n.key.startswith("*")


def add_figures(into: Node, other: Node) -> None:
    into.pages += other.pages
    absorb(into, other)


def bounded(nodes: list[Node], left: Iterable[Node] = ()) -> list[Node]:
    """The expression within its bound, then a slot for each place of ``left``
    and of the groups that leave it now."""
    kept: dict[str, Node] = {}

    def leave(slot: Node) -> None:
        new = Node("*" + slot.path, slot.path, None, True, slot.pages, slot.chars, slot.linked, slot.same, slot.on)
        if (old := kept.setdefault(slot.path, new)) is not new:
            add_figures(old, new)

    for n in left:
        leave(n)
    if len(nodes) <= NODES:
        return [*nodes, *kept.values()]
    out: list[Node] = []
    for n in nodes:  # a slot keeps in sum what the slots of the same place had
        if n.optional and not n.key.startswith("<") and not n.key.startswith("</") and any(n.key == o.key for o in out[-NODES // 2 :]):
            add_figures(next(o for o in reversed(out) if o.key == n.key), n)
        elif n.optional and len(out) >= NODES and not n.path:
            for slot in slots(n.body or []):
                slot.pages = max(slot.pages, n.pages)
                leave(slot)
        else:
            out.append(n)
    return [*out, *kept.values()]


def slots(nodes: list[Node]) -> Iterator[Node]:
    for n in nodes:
        if n.body:
            for x in slots(n.body):
                x.pages = max(x.pages, n.pages)
                yield x
        elif n.path is not None:
            yield n


def places(path: str) -> list[tuple[str, frozenset[str]]]:
    return [(p[0], frozenset(p[1:])) for p in (x.split(".") for x in path.split("/") if x)]


def in_content(path: str) -> bool:
    return any(tag in CONTENT or words & {"article", "main"} and tag in ("div", "section") for tag, words in places(path))


def is_boilerplate(path: str) -> bool:
    """Whether the containers around a slot say that it isn't main text."""
    inside = False
    for tag, words in places(path):
        if "!hidden" in words or tag in NEVER:
            return True
        if tag in ("html", "body", *CONTENT):
            inside |= tag in CONTENT
            continue
        if words & BOILERPLATE or (not inside and (tag == "header" or words & PAGE_HEADER)):
            return True
    return False


@lru_cache(4096)
def is_article(path: str) -> bool:
    """Whether a slot is the main text of its page, whatever else the page holds."""
    return in_content(path) and not is_boilerplate(path)


def uncounted(nodes: list[Node]) -> None:
    """Tokens of a page with an article: they align like others, but have no figures."""
    for n in nodes:
        n.pages = n.chars = n.linked = 0
        uncounted(n.body or [])


def varied_paths(every: list[Node]) -> list[set[str]]:
    """The places of a host's slots that may be main text on a page without an
    article: those of varied texts; for pages without, link lists as well; on
    a host without varied texts, all."""
    every = [s for s in every if s.pages and not is_boilerplate(s.path)]
    own = [s for s in every if not (s.same and len(s.on) >= TEMPLATE_PAGES)]
    varied = [s for s in own if 2 * s.linked <= s.chars]
    return [{s.path for s in x} for x in ([varied, own] if varied else [every])]


def main_paths(weights: dict[str, float]) -> set[str]:
    """The places of main text among those that a page without an article
    fills: go down while one container holds most of the text."""
    prefix = ""
    while True:
        inside = {p: w for p, w in weights.items() if p == prefix or p.startswith(prefix + "/") or not prefix}
        sums: dict[str, float] = {}
        for path, weight in inside.items():
            rest = path[len(prefix) :].lstrip("/").split("/")
            if len(rest) > 1 or (rest[0] and rest[0].split(".")[0] in CONTAINERS):
                child = f"{prefix}/{rest[0]}".lstrip("/")
                sums[child] = sums.get(child, 0) + weight
        best = max(sums, key=sums.get, default=None)
        if best is None or sums[best] * 10 < 7 * sum(inside.values()):
            return set(inside)
        prefix = best


class Wrappers:
    """The wrappers of hosts, as pages come in."""

    def __init__(self):
        self.of: dict[str, list[Node]] = {}
        self.seen: dict[tuple, list[Node]] = {}
        #: What the wrappers hold now: figures given to a token that has left would be lost.
        self.live: dict[str, set[int]] = {}

    def add(self, host: str, page: str) -> None:
        stream, blocks = tokens(page)
        on = xxhash.xxh64_hexdigest("\n".join(blocks))
        for n in stream:
            if n.path is not None:
                n.on = [on]
        article = any(n.path is not None and is_article(n.path) for n in stream)
        expression = fold(stream)
        if article:
            uncounted(expression)
        keys = (host, *(n.key for n in expression))
        known = self.seen.get(keys)
        if known is not None and all(id(n) in self.live[host] for n in known):  # a page of a kind met before: only its figures are new
            for a, b in zip(known, expression):
                add_figures(a, b)
                a.blocks = []
            return
        if host not in self.of:
            self.of[host] = bounded(expression)
        else:
            self.of[host] = merged(self.of[host], expression)
        self.live[host] = {id(n) for n in self.of[host]}
        by_key: dict[str, list[Node]] = {}
        for n in self.of[host]:
            by_key.setdefault(n.key, []).append(n)
        if len(self.seen) > 50_000:
            self.seen.clear()
        if all(len(by_key.get(k, ())) == 1 for k in keys[1:]):
            self.seen[keys] = [by_key[k][0] for k in keys[1:]]


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def infer(pages: DataFrame) -> DataFrame:
    """``host, wrapper`` (JSON), from all pages (``url, html``)."""

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = Wrappers()
        part = 0
        for b in batches:
            for host, page, part in zip(b["host"], b["html"], b["part"]):
                w.add(host, page)
        yield pd.DataFrame([(h, part, json.dumps([n.plain() for n in x])) for h, x in w.of.items()], columns=["host", "part", "wrapper"])

    def join(g: pd.DataFrame) -> pd.DataFrame:
        whole = None
        for x in sorted(g["wrapper"]):
            nodes = [Node.of(y) for y in json.loads(x)]
            whole = nodes if whole is None else merged(whole, nodes)
        return pd.DataFrame({"host": g["host"].iloc[:1], "part": g["part"].iloc[:1], "wrapper": [json.dumps([n.plain() for n in whole])]})

    kind = "host string, part int, wrapper string"
    rows = pages.select(host_of(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html"), (F.spark_partition_id() % PARTS).alias("part"))
    learnt = rows.mapInPandas(learn, kind)
    parts = learnt.groupBy("host", "part").applyInPandas(join, kind)
    return staged(parts.groupBy("host").applyInPandas(join, kind).select("host", "wrapper"), "html-wrappers")


class Reader:
    """Reads pages by their host's wrapper."""

    def __init__(self, wrapper: str):
        nodes = [Node.of(x) for x in json.loads(wrapper)]
        self.wrapper = [n for n in nodes if not is_left(n)]
        every = [*slots(nodes)]
        self.varied = varied_paths(every)
        self.figures: dict[str, list[int]] = {}
        for s in every:
            chars, pages = self.figures.get(s.path, (0, 0))
            self.figures[s.path] = [chars + s.chars, pages + s.pages]
        self.known: dict[tuple, list[bool]] = {}

    def wanted(self, found: list[tuple[Node | None, Node]]) -> list[bool]:
        """Which of a page's slots, each with the wrapper's, are main text:
        those of its article if it has one. Else its slots stand for as much
        text as the host's pages have in them, on average."""
        article = [is_article(s.path) for _, s in found]
        if any(article):
            return article
        weights: dict[str, float] = {}
        varied = next((x for x in self.varied if any(s.path in x for _, s in found)), ())
        for w, s in found:
            if s.path in varied:
                chars, pages = (w.chars, w.pages) if w and w.pages else self.figures[s.path]
                weights[s.path] = weights.get(s.path, 0) + chars / max(1, pages)
        main = main_paths(weights)
        return [s.path in main for _, s in found]

    def text(self, page: str) -> str:
        stream, blocks = tokens(page)
        expression = single_groups(fold(stream), self.wrapper)
        keys = tuple(n.key for n in expression)
        flags = self.known.get(keys)
        if flags is None:
            pairs = [(w, p) for w, p in align(self.wrapper, expression) if p is not None]
            flags = self.wanted([x for w, p in pairs for x in (zip(slots([w]), slots([p])) if w else ((None, s) for s in slots([p])))])
            if len(self.known) >= 1000:
                self.known.clear()
            self.known[keys] = flags
        kept = sorted(i for s, wanted in zip(slots(expression), flags) if wanted for i in s.blocks)
        return "\n".join(blocks[i] for i in kept)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``.

    ``pages`` needs ``page_id, url, html``; other columns are ignored. A null
    or empty html gives an empty text; a null url, or one without a host,
    belongs to the host without a name; a null id stays null; repeated rows
    are read each. A host with one page is read by that page's own stream. No
    rows give no rows. The wrappers go to the pages as Spark sees fit by their
    size: sent to all tasks if small, else by a join on the host, whose large
    hosts Spark splits.
    """
    wrappers = infer(pages).withColumnRenamed("host", "of")
    kind = pages.schema["page_id"].dataType.simpleString()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parsed: dict[str, Reader] = {}
        for b in batches:
            out = []
            for page, wrapper in zip(b["html"], b["wrapper"]):
                if wrapper not in parsed:
                    if len(parsed) >= 256:
                        parsed.clear()
                    parsed[wrapper] = Reader(wrapper)
                out.append(parsed[wrapper].text(page))
            yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "text": pd.Series(out, index=b.index, dtype=object), "n_chars": pd.Series([len(t) for t in out], index=b.index, dtype="int64")})

    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of(F.col("url")).alias("host"))
    rows = rows.join(wrappers, F.col("host") == F.col("of")).select("page_id", "url", "html", "wrapper")
    return rows.mapInPandas(read, f"page_id {kind}, url string, text string, n_chars long")


def op6_html_text(spark, sf_dir) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
