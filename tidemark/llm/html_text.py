"""Operator 1: main text of web pages by consensus host paths.

Each page is cut into tags and text (no document tree is kept, only a node's parent and its own part of the generalised
path: the tag with its first class, digits as #). Containers are scored by the text of the blocks in them that isn't
link text, halved for each container between. Pages vote for their best containers' paths; votes are summed per host in
Spark (partial sums first, so a host with a third of all pages is no burden). Then every page is read again and the
nodes on the best voted path that it has are its main text; a page that has none of its host's paths keeps its own best
container.

Inside the main text these go: menus (nav, menu), headers and footers, sidebars (aside), forms and their controls,
scripts, styles, templates, frames, and what a whole class, id or role calls a menu, sidebar, notice, advert, sharing
bar, form or reader comments. A class only counts if all its words say so ("cookie-notice", "comment-list"): one that
merely holds such a word ("reader-text") drops nothing. Inside an article a header's h1 stays. Nothing else is dropped.

A null html is an empty page with an empty text; a null url has an empty host; repeated rows give repeated results, an
empty table an empty one. Pages are read whole, however long and deep: memory and time grow with the page, not with its
depth. Paths with as many votes as each other go in order of their names, containers of one score by their place. Other
columns are not looked at, whatever their names.
"""

from __future__ import annotations

import re
from collections import defaultdict
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged

TAG = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)", re.S)
ATTR = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: Elements of HTML by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
DROPPED = frozenset("nav header footer aside form script style template button select textarea input iframe head menu title".split())
RAW = frozenset("script style textarea title iframe".split())
CONTAINERS = frozenset("article main section div body td center blockquote".split())
#: Words of a class, id or role that mark what isn't the article, and words that may stand beside them.
NOT_MAIN = frozenset(
    "ad ads adv advert adverts advertisement advertising banner banners sponsor sponsored promo promotion sidebar menu nav navbar navigation breadcrumb breadcrumbs header masthead"
    " footer cookie cookies consent notice notices gdpr popup modal newsletter subscribe subscription signup login comment comments commentlist disqus reply replies respond"
    " social share sharing related recommended recommendations widget widgets form search searchbox pagination pager toolbar complementary contentinfo".split()
)
BESIDE = frozenset("box block wrapper wrap container list item items section area bar slot unit post posts article articles page site main top bottom left right inner outer primary secondary side reader readers user users button buttons link links icons policy text message overlay thread count holder row col column panel group global".split())
ENTITY = re.compile(r"&#(?:[xX]([0-9a-fA-F]+)|([0-9]+));?")
ENDS_SAME = {"li": ("li", "ul", "ol"), "dt": ("dd", "dl", ""), "dd": ("dd", "dl", ""), "tr": ("tr", "table", ""), "td": ("td", "tr", ""), "th": ("td", "tr", ""), "option": ("option", "select", "")}


def not_main(names: list[str]) -> bool:
    """Whether one of the names (classes, id, role) says, with all its words, that this isn't main text."""
    for name in names:
        words = [w for w in re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()) if w]
        if words and (words[-1] in NOT_MAIN or words[0] in NOT_MAIN) and all(w in NOT_MAIN or w in BESIDE or len(w) == 1 for w in words):
            # "article-header" and "main-form" speak of the article itself.
            if words[0] not in ("article", "main", "text") or words[0] in NOT_MAIN:
                return True
    return False


def decoded(text: str) -> str:
    """Character references as characters; numeric ones to controls and noncharacters too, which `unescape` would delete."""

    def numeric(m: re.Match) -> str:
        n = int(m[1], 16) if m[1] else int(m[2])
        kept = n in (0x0B, 0x7F) or 1 <= n <= 8 or 0x0E <= n <= 0x1F or 0xFDD0 <= n <= 0xFDEF or (n & 0xFFFE == 0xFFFE and n <= 0x10FFFF)
        return chr(n) if kept else m[0]

    return unescape(ENTITY.sub(numeric, text)) if "&" in text else text


class Page:
    """A page's nodes and text events, in page order."""

    def __init__(self, html: str) -> None:
        self.tag, self.part, self.parent, self.first, self.last = ["html"], [""], [-1], [0], [0]
        self.bad = [False]
        self.box = [-1]  # the nearest container, the node itself counted
        self.open: dict[str, int] = defaultdict(int)  # tags on the stack
        self.events: list[tuple[int, str, bool, bool]] = []  # node, text ("" ends a block), in a link, dropped
        stack, at, n = [0], 0, len(html)
        links = 0
        while at < n:
            m = TAG.search(html, at)
            if not m:
                self._text(stack[-1], html[at:], links)
                break
            if m.start() > at:
                self._text(stack[-1], html[at : m.start()], links)
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                k = next((k for k in range(len(stack) - 1, 0, -1) if self.tag[stack[k]] == tag), 0) if self.open[tag] else 0
                if k and not (tag not in BLOCK and any(self.tag[s] in CONTAINERS for s in stack[k + 1 :])):
                    links -= sum(self.tag[s] == "a" for s in stack[k:])
                    self._close(stack, k)
                if tag in BLOCK:
                    self._break(stack[-1])
                continue
            if tag == "br" or tag == "wbr":
                if tag == "br":
                    self._text(stack[-1], " ", links)
                continue
            if tag in BLOCK:
                k = next((k for k in range(len(stack) - 1, 0, -1) if self.tag[stack[k]] in ("p", "table", "td", "div", "article", "section", "li")), 0)
                if k and self.tag[stack[k]] == "p":
                    links -= sum(self.tag[s] == "a" for s in stack[k:])
                    self._close(stack, k)
                self._break(stack[-1])
            if tag in ENDS_SAME:
                own, outer, other = ENDS_SAME[tag]
                k = next((k for k in range(len(stack) - 1, 0, -1) if self.tag[stack[k]] in (own, tag, outer, other)), 0)
                if k and self.tag[stack[k]] not in (outer, other):
                    links -= sum(self.tag[s] == "a" for s in stack[k:])
                    self._close(stack, k)
            if tag in VOID:
                continue
            if tag in ("html", "body") and tag in self.tag[1:]:
                continue
            top = stack[-1]
            attrs = {a.lower(): (b or c or d) for a, b, c, d in ATTR.findall(m[3] or "")}
            cls = attrs.get("class", "").split()
            self.tag.append(tag)
            self.parent.append(top)
            self.part.append(tag + ("." + re.sub(r"\d+", "#", cls[0].lower()) if cls else ""))
            named = bool(attrs) and not_main([*cls, *attrs.get("id", "").split(), *attrs.get("role", "").split()])
            bad = self.bad[top] or tag in DROPPED or (named and tag not in ("html", "body", "article", "main", "h1"))
            if tag == "h1" and bad and not named and self.tag[top] == "header" and not self.bad[self.parent[top]] and self.open["article"]:
                bad = False
            self.bad.append(bad)
            self.box.append(len(self.tag) - 1 if tag in CONTAINERS and not bad else self.box[top])
            self.first.append(len(self.events))
            self.last.append(-1)
            if tag in RAW:
                end = re.compile(f"</{tag}", re.I).search(html, at)
                at = end.start() if end else n
            links += tag == "a"
            if not m[3].endswith("/") or tag not in ("svg", "path"):
                stack.append(len(self.tag) - 1)
                self.open[tag] += 1
        self._close(stack, 0)
        for i, x in enumerate(self.last):
            if x < 0:
                self.last[i] = len(self.events)

    def _text(self, node: int, text: str, links: int) -> None:
        if text:
            self.events.append((node, text, links > 0, self.bad[node]))

    def _break(self, node: int) -> None:
        self.events.append((node, "", False, False))

    def _close(self, stack: list[int], k: int) -> None:
        for s in stack[k:]:
            self.last[s] = len(self.events)
            self.open[self.tag[s]] -= 1
        del stack[k:]
        if not stack:
            stack.append(0)

    def blocks(self, a: int, b: int):
        """(node, text, share of it in links) of the blocks between two events."""
        parts: list[str] = []
        linked, total, node = 0, 0, 0
        for x, text, link, bad in self.events[a:b]:
            if not text:
                if parts:
                    if t := " ".join(decoded("".join(parts)).split()):
                        yield node, t, linked / max(1, total)
                    parts, linked, total = [], 0, 0
            elif not bad:
                if not parts:
                    node = x
                parts.append(text)
                total += len(text)
                linked += len(text) * link
        if parts and (t := " ".join(decoded("".join(parts)).split())):
            yield node, t, linked / max(1, total)

    def scores(self) -> dict[int, float]:
        """Containers that hold text, best first."""
        out: dict[int, float] = defaultdict(float)
        for node, t, linked in self.blocks(0, len(self.events)):
            share, x = 1.0, self.box[node]
            while x > 0 and share > 1e-9:  # what lies deeper adds nothing that could decide
                out[x] += share * len(t) * (1 - linked)
                share /= 2
                x = self.box[self.parent[x]]
        return dict(sorted(out.items(), key=lambda kv: (-kv[1], kv[0])))

    def best(self) -> int:
        """The best container, or the article or main element around it; 0: the page."""
        x = top = next(iter(self.scores()), 0)
        while x > 0:
            if self.tag[x] in ("article", "main"):
                top = x
            x = self.parent[x]
        return top

    def path(self, x: int) -> str:
        parts = []
        while x > 0:
            parts.append(self.part[x])
            x = self.parent[x]
        return "".join(">" + p for p in reversed(parts))

    def on(self, path: str) -> list[int]:
        """The nodes on a path, by how much of it each node's ancestors match."""
        parts, met = path.split(">")[1:], [0]
        out = []
        for i in range(1, len(self.part)):
            before = met[self.parent[i]]
            met.append(before + 1 if 0 <= before < len(parts) and self.part[i] == parts[before] else -1)
            if met[i] == len(parts):
                out.append(i)
        return out

    def text(self, paths: list[str]) -> str:
        """The main text by the first of the paths that has any here, or else by the page's own best container."""
        for p in paths:
            nodes, end = [], 0
            for i in self.on(p):
                if not self.bad[i] and self.first[i] >= end:
                    nodes.append(i)
                    end = self.last[i]
            if got := [t for i in nodes for _, t, _ in self.blocks(self.first[i], self.last[i])]:
                return "\n".join(got)
        i = self.best()
        return "\n".join(t for _, t, _ in self.blocks(self.first[i] if i else 0, self.last[i] if i else len(self.events)))


def _host(url: str):
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def host_paths(pages: DataFrame, *, least: float = 0.1) -> DataFrame:
    """host, paths: its winning paths by votes, best first; at most 1 / least of them."""

    def vote(batches):
        for whole, at in ((b, at) for b in batches for at in range(0, b.num_rows, 512)):
            batch = whole.slice(at, 512)
            rows: dict[tuple[str, str], float] = defaultdict(float)
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                page = Page(html or "")
                if x := page.best():
                    rows[host, page.path(x)] += 1.0
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in rows]), pa.array([k[1] for k in rows]), pa.array(list(rows.values()), pa.float64())], schema=pa.schema([("host", pa.string()), ("path", pa.string()), ("votes", pa.float64())]))

    votes = pages.select(_host("url").alias("host"), "html").mapInArrow(vote, "host string, path string, votes double").groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    whole = votes.groupBy("host").agg(F.sum("votes").alias("whole"))
    won = votes.join(whole, "host").where(F.col("votes") >= least * F.col("whole"))
    return won.groupBy("host").agg(F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("v"), "path"))).alias("won")).select("host", F.col("won.path").alias("paths"))


def extract(pages: DataFrame, *, broadcast_bytes: int = 16 << 20) -> DataFrame:
    """page_id, url, text, n_chars. Winning paths are broadcast up to that many bytes (counted), joined by shuffle beyond."""
    paths = staged(host_paths(pages), "host-paths")
    size = paths.agg(F.sum(F.expr("octet_length(host) + aggregate(paths, 64, (n, p) -> n + octet_length(p) + 16)"))).first()[0] or 0
    side = F.broadcast(paths) if size <= broadcast_bytes else paths
    rows = pages.select("page_id", "url", "html", _host("url").alias("host")).join(side, "host", "left").select("page_id", "url", "html", "paths")

    def run(batches):
        for whole, at in ((b, at) for b in batches for at in range(0, b.num_rows, 512)):
            batch = whole.slice(at, 512)
            texts = [Page(h or "").text(p or []) for h, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kinds = dict(pages.dtypes)
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
