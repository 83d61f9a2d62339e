"""Main text of web pages by consensus of each host.

Every page's containers are scored by the text they hold, and the page votes for the generalised tag-class path of its best
one. Votes are counted per host in Spark; each page is then extracted again from the containers on its host's winning path, or
from its own best one where it has no text there or shows by an article or main element that its text is elsewhere. Pages
without a host have no winning path.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, written

#: Paths of a host besides the first that win too: by the share of its pages that vote for them (so there are a few), and their number.
LEAST_SHARE, LEAST_PAGES = 0.2, 3

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")

#: Elements whose content is no text of the page.
_OPAQUE = {"script", "style", "noscript", "template", "iframe", "svg", "object", "textarea", "title", "head", "canvas", "math", "audio", "video"}
_CONTAINERS = {"html", "body", "div", "section", "article", "main", "table", "tbody", "tr", "td", "center", "blockquote", "ul", "ol", "dl",
               "nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset", "figure", "details", "button", "select", "label"}
_BLOCKS = _CONTAINERS | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "br", "hr", "pre", "dt", "dd", "th", "caption", "figcaption",
                         "address", "thead", "tfoot", "option", "summary", "legend", "hgroup"}
_VOID = {"br", "hr", "img", "input", "meta", "link", "source", "wbr", "area", "base", "col", "embed", "param", "track"}
_BOILERPLATE = {"nav", "footer", "aside", "form", "menu", "dialog", "fieldset", "button", "select", "label"}
_MAIN = {"article", "main"}
_HINTS = set(
    "ad ads advert advertisement adverts advertising sponsor sponsored promo promotion banner nav navbar navigation menu footer sidebar side "
    "aside masthead topbar header breadcrumb breadcrumbs pagination pager cookie cookies consent notice alert popup modal overlay share sharing "
    "social related recommended recommendations comment comments reply replies respond disqus talkback feedback discussion discussions newsletter subscribe subscription signup login "
    "search widget toolbar copyright disclaimer skip hidden tags byline".split()
)
#: Beginnings and ends of words that are run together, such as commentlist, adsbygoogle, siteheader; and words that only look like one.
_STEMS = ("comment", "advert", "adsby", "adsense", "adslot", "adunit", "adbox", "adbanner", "adcontainer", "sponsor", "breadcrumb", "newsletter", "cookie", "navbar", "navmenu", "topnav")
_TAILS = ("header", "footer", "sidebar", "navbar", "menu", "comments", "commentlist", "breadcrumbs", "banner")
_NO_PART = {"commentary", "commentaries", "subheader"}
#: Words before header or footer, and header itself, that make it a part of the article.
_ARTICLE = {"article", "entry", "post", "story", "content", "section", "chapter", "figure"}
#: Names that are a part beside the article, but a section of many articles too.
_SECTIONS = {"discussion", "feedback"}
#: First words of class names that tell about the page or its subject, and last words that tell a state: neither names a part.
_ABOUT = {"has", "with", "without", "no", "not", "is", "category", "cat", "tag", "topic", "term", "type", "format", "status", "author", "layout", "template"}
_STATES = {"open", "closed", "enabled", "disabled", "on", "off", "active", "visible", "layout", "template"}
#: Besides containers, elements whose own marks count; their end tags may be missing.
_MARKED_BLOCKS = _BLOCKS - _CONTAINERS - _VOID | {"span"}
_ENDED_BY_NEXT = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "th": {"table", "tr"}, "option": {"select"}}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}


def _hints(word: str) -> bool:
    """Whether a word names a part beside the article, by itself or run together with others."""
    if word in _HINTS or word in _NO_PART:
        return word in _HINTS
    return word.startswith(_STEMS) or (word.endswith(_TAILS) and not word.startswith(tuple(_ARTICLE)))


def _names_other_part(name: str, tag: str) -> bool:
    """Whether a class name or id as a whole names a part beside the article: its first or last word does."""
    words = [w for w in re.split(r"[^a-z]+", name) if w]
    if not words or len(words) > 1 and (words[0] in _ABOUT or words[-1] in _STATES):
        return False
    if (words[-1] in ("header", "footer") and _ARTICLE.intersection(words)) or (tag == "section" and words[-1] in _SECTIONS):
        return False
    return _hints(words[0]) or _hints(words[-1])


def _marks(attributes: str, tag: str) -> tuple[str, bool, bool]:
    """The generalised class of an element, whether its names hint at no part of the article, and whether it surely is none."""
    name, hinted, out = "", False, False
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key in ("class", "id"):
            hinted = hinted or any(_names_other_part(x, tag) for x in value.split())
            if key == "class" and value.split():
                name = "." + re.sub(r"\d+", "N", ".".join(sorted(value.split())))
        elif key == "role":
            out = out or value in _ROLES
        elif key == "style":
            out = out or "display:none" in value.replace(" ", "")
        elif key in ("hidden", "aria-hidden") and value != "false":
            out = True
    return name, hinted, out


class Page:
    """Containers of one page in order, each with its path, parent, and the blocks of text that stand in it."""

    def __init__(self, source: str | None):
        self.paths: list[str] = [""]
        self.parents: list[int] = [-1]
        self.main: list[bool] = [False]
        self.tags: list[str] = [""]
        self.hinted: list[bool] = [False]
        self.blocks: list[tuple[int, str, int]] = []  # container, text, characters inside links
        self._read(source or "")
        self._drop_hinted()

    def _read(self, source: str) -> None:
        open_: list[tuple[str, int, bool]] = [("", 0, False)]  # tag, container, whether outside the article
        text: list[str] = []
        spans: list[bool] = []
        link, linked, at = 0, 0, 0

        def flush() -> None:
            nonlocal linked
            joined = " ".join(entities.unescape("".join(text)).split())
            if joined and not open_[-1][2]:
                self.blocks.append((open_[-1][1], joined, linked))
            text.clear()
            linked = 0

        def enter(tag: str, name: str, hinted: bool, outside: bool) -> None:
            _, parent, without = open_[-1]
            self.paths.append(f"{self.paths[parent]}/{tag}{name}")
            self.parents.append(parent)
            self.main.append(self.main[parent] or tag in _MAIN)
            self.tags.append(tag)
            self.hinted.append(hinted)
            open_.append((tag, len(self.paths) - 1, outside or without))

        def leave(tag: str, up_to: set[str]) -> None:
            """Closes the marked element ``tag`` if it is open inside the innermost of ``up_to``."""
            for k in range(len(open_) - 1, 0, -1):
                if open_[k][0] == tag:
                    del open_[k:]
                if k >= len(open_) or open_[k][0] in up_to:
                    break

        while True:
            token = _TOKEN.search(source, at)
            piece = source[at : token.start()] if token else source[at:]
            if piece:
                text.append(piece)
                linked += len(piece) * (link > 0)
            if not token:
                break
            at = token.end()
            tag = (token[2] or token[5] or "").lower()
            closing, attributes = token[1] or token[4], token[3] or token[6] or ""
            if not tag:
                continue
            if tag in _OPAQUE and not closing:
                # The head has other elements inside, so it ends where the body starts at the latest.
                end = re.compile(r"</head\b|<body\b" if tag == "head" else rf"</{re.escape(tag)}\b", re.I).search(source, at)
                if not attributes.endswith("/"):
                    at = end.start() if end else len(source)
                continue
            if tag == "a":
                link = max(0, link - 1) if closing else link + 1
            if tag == "span":
                marks = ("", False, False) if closing else _marks(attributes, tag)
                if closing and spans and spans.pop():
                    flush()
                    leave(tag, _CONTAINERS)
                elif not closing and not attributes.endswith("/"):
                    spans.append(marks[1] or marks[2])
                    if spans[-1]:
                        flush()
                        enter(tag, *marks)
                continue
            if tag not in _BLOCKS:
                continue
            flush()
            if not closing and tag != "br":
                # A new block ends an open paragraph.
                leave("p", _CONTAINERS)
            if tag in _MARKED_BLOCKS:
                if closing:
                    leave(tag, _CONTAINERS)
                    continue
                for other in ("dt", "dd") if tag in ("dt", "dd") else (tag,):
                    leave(other, _ENDED_BY_NEXT.get(tag, _CONTAINERS))
                marks = _marks(attributes, tag)
                if (marks[1] or marks[2]) and not attributes.endswith("/"):
                    enter(tag, *marks)
                continue
            if tag not in _CONTAINERS:
                continue
            if closing:
                for k in range(len(open_) - 1, 0, -1):
                    if open_[k][0] == tag:
                        del open_[k:]
                        link = 0
                        break
                continue
            if tag in _VOID or attributes.endswith("/"):
                continue
            name, hinted, out = _marks(attributes, tag)
            whole = tag in ("html", "body")
            outside = (out and not whole) or tag in _BOILERPLATE or (tag == "header" and not self.main[open_[-1][1]])
            enter(tag, name, hinted and not whole, outside)
        flush()

    def _sizes(self) -> list[int]:
        """Characters outside links in each container."""
        size = [0] * len(self.paths)
        for container, text, linked in self.blocks:
            size[container] += len(text) - min(len(text), 2 * linked)
        for k in range(len(size) - 1, 0, -1):
            size[self.parents[k]] += size[k]
        return size

    def _drop_hinted(self) -> None:
        """Leaves out what is inside hinted elements. An element that is or holds the main element, an article with a fifth of
        the page's text, or most of that text stays, whatever its names hint at; elements inside it are judged by themselves."""
        if not any(self.hinted):
            return
        size = self._sizes()
        stays = [tag == "main" or (tag == "article" and n >= 0.2 * size[0] > 0) or 2 * n > size[0] for tag, n in zip(self.tags, size, strict=True)]
        for k in range(len(stays) - 1, 0, -1):
            stays[self.parents[k]] |= stays[k]
        dropped = [False] * len(stays)
        for k in range(1, len(stays)):
            dropped[k] = dropped[self.parents[k]] or (self.hinted[k] and not stays[k])
        self.blocks = [b for b in self.blocks if not dropped[b[0]]]

    def best(self) -> int | None:
        """The container for this page's text: an article or main element with most text, else the innermost container that
        holds most of the text outside links."""
        size = self._sizes()
        if not size[0]:
            return None
        main = [k for k in range(len(size)) if self.tags[k] in _MAIN and size[k] >= 0.2 * size[0]]
        if main:
            return max(main, key=lambda k: (size[k], -k))
        return max(k for k in range(len(size)) if size[k] >= 0.6 * size[0] and self.tags[k] not in _MARKED_BLOCKS)

    def _inside(self, wanted: set[int]) -> list[bool]:
        """For each container whether it is one of ``wanted`` or inside one."""
        inside = [False] * len(self.paths)
        for k in range(len(self.paths)):
            inside[k] = k in wanted or (self.parents[k] >= 0 and inside[self.parents[k]])
        return inside

    def _on(self, paths: list[str]) -> list[bool]:
        """For each container whether it is on, or inside one on, the winning path that this page follows.

        That is the path with most votes among those with text here, or another that lies apart from it and holds more: a host of
        several templates has several, and a teaser on one of them is not the article.
        """
        size, chosen, held = self._sizes(), [False] * len(self.paths), -1
        for path in paths:
            inside = self._inside({k for k, p in enumerate(self.paths) if p == path})
            here = sum(size[k] for k in range(1, len(size)) if inside[k] and not inside[self.parents[k]])
            apart = not any(a and b for a, b in zip(inside, chosen, strict=True))
            if any(inside[c] for c, _, _ in self.blocks) and apart and here > held:
                chosen, held = inside, here
        return chosen

    def text(self, paths: list[str] | str | None) -> str:
        """All blocks inside the containers on the winning path. Without text there, or if the page's own best container is an
        article or main element apart from them and holds more text, the blocks of that best container."""
        own = self.best()
        inside = self._on([paths] if isinstance(paths, str) else paths or [])
        if own is not None and not inside[own]:
            size = self._sizes()
            voted = sum(size[k] for k in range(1, len(size)) if inside[k] and not inside[self.parents[k]])
            within = self._inside({own})
            apart = not any(i and w for i, w in zip(inside, within, strict=True))
            if not any(inside[c] for c, _, _ in self.blocks) or (self.tags[own] in _MAIN and apart and size[own] > voted):
                inside = within
        return " ".join(text for container, text, _ in self.blocks if inside[container])


def host_of(url: Column) -> Column:
    """Host of an address in lower case; empty for null and for other text."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^@/?#]*@)?([^/:?#]*)", 1), F.lit(""))


def votes(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """host, path and the number of pages of the host whose best container is on that path; pages without a host don't vote."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                paths = []
                for text in part.column(1).to_pylist():
                    page = Page(text)
                    best = page.best()
                    paths.append(None if best is None else page.paths[best])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(paths, pa.string())], names=["host", "path"])

    rows = map_arrow(pages.select(host_of(F.col(url)).alias("host"), source).filter("host <> ''"), run, "host string, path string")
    return rows.filter("path IS NOT NULL").groupBy("host", "path").count()


def extract(pages: DataFrame, keys: list[str], url: str = "url", source: str = "html") -> DataFrame:
    """``keys`` and text: the main text of each page, empty where there is none.

    Null or empty pages have empty text; pages without a host are read by themselves; pages of one host that are equal come
    back as often as given; of paths with equal votes the first in alphabetical order wins; other columns are not read. The
    winners are written first, so Spark knows their size and picks the join by it; the pages move only if hosts are many.
    """
    ranked = written(votes(pages, url, source), "host-votes")
    place = F.struct((-F.col("count")).alias("n"), F.col("path").alias("p"))
    hosts = ranked.groupBy("host").agg(F.sum("count").alias("pages"), F.min(place).alias("top"))
    several = (F.col("count") >= LEAST_PAGES) & (F.col("count") >= F.col("pages") * LEAST_SHARE)
    winning = ranked.join(hosts, "host").filter(several | (F.col("path") == F.col("top.p")))
    winners = winning.groupBy("host").agg(F.sort_array(F.collect_list(place))["p"].alias("path"))
    given = pages.select(*[F.col(k).alias(f"k{n}") for n, k in enumerate(keys)], host_of(F.col(url)).alias("host"), F.col(source).alias("html"))
    rows = given.join(written(winners, "host-paths"), "host", "left").drop("host")
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                texts = [Page(h).text(p) for h, p in zip(part.column(n).to_pylist(), part.column(n + 1).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:n], pa.array(texts, pa.string())], names=[*keys, "text"])

    schema = T.StructType([*(T.StructField(k, pages.schema[k].dataType) for k in keys), T.StructField("text", T.StringType())])
    return map_arrow(rows.select(*[f"k{m}" for m in range(n)], "html", "path"), run, schema)
