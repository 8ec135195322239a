"""Main text of web pages by consensus of each host's pages.

1. Every page scores its containers: visible text outside links, passed up the tree with a discount; menus, headers,
   footers, sidebars, notices, adverts, forms, scripts and reader comments score nothing.
2. Paths of tags and classes, digits removed, are voted on per host. Votes are sums, so a host of any size is combined
   before the shuffle. Every path with a vote counts, however many a host has.
3. Each page's own paths meet the votes of its host; pages are told apart by a digest, and the best-voted path that holds
   text on the page wins. Every page is read again with it. A page without a host uses its own best container.

White space inside a block becomes one space, blocks are joined by a line break in page order, character references are
decoded. A null or empty page, and one without visible text, gives the empty text. ``<br>`` is white space inside a block.
Repeated rows are read each; further columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import map_rows, stored
from ledgerlake.llm.url_filter import host_and_path

DISCOUNT = 0.9

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*+(?:=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++))?")
_WORD = re.compile(r"[a-z]+")
RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "math", "object", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "li", "main", "nav", "ol", "p",
    "pre", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul",
}
CONTAINERS = {"html", "body", "article", "main", "section", "div", "td", "center", "blockquote", "table"}
DROPPED = {"head", "nav", "footer", "aside", "form", "button", "select", "menu", "dialog", "option", "label", "input"}
DROPPED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "alert", "menu"}
# Words of a class or id that mark a part as no article text.
DROPPED_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
    "consent", "cookie", "cookies", "copyright", "disqus", "footer", "gdpr", "header", "hidden", "login", "masthead", "menu", "menus",
    "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pager", "pagination", "popup", "promo", "promoted",
    "promotion", "related", "respond", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored",
    "subscribe", "toolbar", "topbar", "widget",
}
# Words that make a header the head of an article, not of the page.
ARTICLE_WORDS = {"article", "entry", "post", "story"}
GOOD_WORDS = {"article", "content", "entry", "main", "post", "story", "text", "body"}
# Start tags that end an open element of these names.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}}


class Page:
    """``blocks``: (text, characters inside links, container) in page order, dropped parts left out; ``containers``:
    (path, parent, weight), parents first."""

    def __init__(self, html: str | None):
        self.blocks: list[tuple[str, int, int]] = []
        self.containers: list[tuple[str, int, float]] = [("", -1, 0.5)]
        self._parts: list[str] = []
        self._linked = 0
        #: Open elements: name, container, dropped, inside a link, inside an article.
        self._open: list[tuple[str, int, bool, bool, bool]] = [("", 0, False, False, False)]
        if html:
            self._read(html)

    def _text(self, raw: str) -> None:
        top = self._open[-1]
        if not top[2]:
            text = unescape(raw) if "&" in raw else raw
            self._parts.append(text)
            if top[3]:
                self._linked += len(text.strip())

    def _end_block(self) -> None:
        if self._parts:
            text = " ".join("".join(self._parts).split())
            if text:
                self.blocks.append((text, self._linked, self._open[-1][1]))
            self._parts, self._linked = [], 0

    def _close(self, depth: int) -> None:
        """Close open elements down to a depth; text belongs to the block that ends first."""
        while len(self._open) > depth:
            if self._open[-1][0] in BLOCKS:
                self._end_block()
            self._open.pop()

    def _start(self, name: str, attributes: str) -> None:
        if name in BLOCKS:
            for depth in range(len(self._open) - 1, 0, -1):  # a block ends an open paragraph
                if self._open[depth][0] == "p":
                    self._close(depth)
                    break
                if self._open[depth][0] in BLOCKS or self._open[depth][0] in ("td", "th"):
                    break
            self._end_block()
        if name in CLOSES:
            for depth in range(len(self._open) - 1, 0, -1):
                if self._open[depth][0] in CLOSES[name]:
                    self._close(depth)
                    break
                if self._open[depth][0] in ("ul", "ol", "dl", "table", "select"):
                    break
        if name in ("br", "td", "th") and not self._open[-1][2]:
            self._parts.append(" ")
        if name in VOID:
            return
        _, container, dropped, linked, article = self._open[-1]
        wanted = {}
        if attributes and not dropped:
            for key, value in _ATTR.findall(attributes):
                wanted.setdefault(key.lower(), value.strip("\"'"))
        classes = unescape(wanted.get("class", "")).lower().split()
        words = {w for c in (*classes, wanted.get("id", "").lower()) for w in _WORD.findall(c)}
        if name not in ("html", "body", "article", "main") and not re.fullmatch("h[1-6]", name):
            titled = article or bool(words & ARTICLE_WORDS)  # an article's own header holds its title
            dropped = (dropped or name in DROPPED or name == "header" and not titled
                       or bool(words & DROPPED_WORDS - {"header"} if titled else words & DROPPED_WORDS) or wanted.get("role", "").lower() in DROPPED_ROLES)
        elif name == "article":
            dropped = dropped or bool(words & {"comment", "comments", "related", "sponsored", "ad", "promo"})
        dropped = dropped or "hidden" in wanted or wanted.get("aria-hidden", "").lower() == "true" or bool(
            re.search(r"display\s*:\s*none", wanted.get("style", "")))
        if name in CONTAINERS and not dropped:
            step = ".".join([name, *sorted({c for c in (re.sub(r"\d+", "", c) for c in classes) if c})])
            weight = 1.5 if name in ("article", "main") or wanted.get("role") == "main" else 0.5 if name in ("html", "body") else (
                1.2 if words & GOOD_WORDS else 1.0)
            self.containers.append((f"{self.containers[container][0]}/{step}", container, weight))
            container = len(self.containers) - 1
        self._open.append((name, container, dropped, linked or name == "a", article or name in ("article", "main")))

    def _end(self, name: str) -> None:
        for depth in range(len(self._open) - 1, 0, -1):
            if self._open[depth][0] == name:
                self._close(depth)
                return
            if name not in BLOCKS and self._open[depth][0] in BLOCKS:
                return  # an inline end tag does not close a block

    def _read(self, html: str) -> None:
        at = 0
        while (m := _TOKEN.search(html, at)) is not None:
            if m.start() > at:
                self._text(html[at:m.start()])
            at, name = m.end(), m[2]
            if not name:
                continue
            name = name.lower()
            if m[1]:
                self._end(name)
            elif name in RAW and not m[3].endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(html, at)
                at = end.end() if end else len(html)
            else:
                self._start(name, m[3])
        self._text(html[at:])
        self._close(1)
        self._end_block()

    def scores(self) -> dict[str, float]:
        """Path of each container with its best score."""
        found = [0.0] * len(self.containers)
        for text, linked, container in self.blocks:
            score = max(0.0, len(text) - 2.0 * linked)
            while container >= 0 and score:
                found[container] += score
                container, score = self.containers[container][1], score * DISCOUNT
        out: dict[str, float] = {}
        for (path, _, weight), score in zip(self.containers, found):
            out[path] = max(out.get(path, 0.0), score * weight)
        return out

    def text(self, path: str | None) -> str:
        """Blocks inside the containers of the path, without one of the best own path."""
        if not self.blocks:
            return ""
        if path is None:
            scores = self.scores()
            path = max(sorted(scores), key=scores.__getitem__)
        inside = []
        for own, parent, _ in self.containers:
            inside.append(own == path or parent >= 0 and inside[parent])
        return "\n".join(text for text, _, container in self.blocks if inside[container])


def candidates(pages: DataFrame) -> DataFrame:
    """(host, page, path, vote) of every container with a score, from (host, page, html). Pages vote for every container that
    scores at least half of their best one, in proportion to its score; the others have a vote of 0."""
    def votes(rows: Iterator[dict]) -> Iterator[tuple]:
        for r in rows:
            scores = Page(r["html"]).scores()
            best = max(scores.values())
            for path, score in scores.items():
                if score > 0:
                    yield r["host"], r["page"], path, round(1000 * score / best) if score >= 0.5 * best else 0

    return map_rows(pages.where("host <> ''").select("host", "page", "html"), votes, "host string, page string, path string, vote long")


def choose(found: DataFrame) -> DataFrame:
    """(host, page, path): of each page's candidates the one with most votes on its host, then the first in order."""
    tally = found.where("vote > 0").groupBy("host", "path").agg(F.sum("vote").alias("votes"))
    ranked = found.select("host", "page", "path").join(tally, ["host", "path"])
    best = ranked.groupBy("host", "page").agg(F.min(F.struct(-F.col("votes"), "path")).alias("b"))
    return best.select("host", "page", F.col("b.path").alias("path"))


def extract(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    rows = rows.withColumns({"host": host_and_path(F.col("url"))[0], "page": F.md5("html")})
    winners = stored(pages.sparkSession, choose(stored(pages.sparkSession, candidates(rows), "page-paths")), "host-paths")

    def read(found: Iterator[dict]) -> Iterator[tuple]:
        for r in found:
            text = Page(r["html"]).text(r["path"])
            yield r["page_id"], r["url"], text, len(text)

    return map_rows(rows.join(winners, ["host", "page"], "left"), read, "page_id long, url string, text string, n_chars long", flush=256)
