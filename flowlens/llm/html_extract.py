"""HTML main-text extraction by host consensus paths (operator 2).

Pass 1 scores the containers of every page and lets the page vote for the
generalised tag-class path of its best one; votes are added up per host in
Spark (partial aggregation, so a hot host is spread).  Pass 2 re-extracts each
page with the winning path of its host: the best-scored element on that path,
or the page's own best container where the path does not occur.

Inside the container, menus, headers, footers, sidebars, notices, adverts,
forms, comments, scripts and styles are left out.  Blocks have white space
runs turned into one space and are joined by a blank line.

Defined cases: null or empty html gives an empty text; a null url votes only
for itself; unclosed tags and cut-off pages are read as far as they go; equal
votes go to the higher score, then the first path; repeated rows are returned
once each; an empty table gives no rows; other columns, also those named like
results, are ignored; very long, deeply nested and broken pages take time in
proportion to their length.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import batch, prepare, written

#: Hosts whose winning paths may be broadcast; more are joined by a shuffle.
BROADCAST_HOSTS = 20_000

_OPEN = re.compile(r"<([a-zA-Z][^\s/>]*)|</([a-zA-Z][^\s>]*)|<!--|<[!?]")
_STOP = re.compile(r"[>\"']")
_ATTR = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: Elements whose content is not text, or not of the article.
_RAW = {"script", "style", "noscript", "template", "textarea", "svg", "iframe", "object",
        "canvas", "title", "xmp", "annotation", "annotation-xml"}
_JUNK_TAGS = {"nav", "aside", "footer", "form", "button", "select", "dialog", "menu", "head",
              "input", "fieldset", "option"}
_JUNK_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog",
               "alert", "alertdialog", "menu", "menubar", "form"}
_JUNK_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor",
    "sponsored", "promo", "promotion", "banner", "cookie", "cookies", "consent", "gdpr",
    "notice", "notices", "notification", "alert", "popup", "modal", "overlay", "newsletter",
    "subscribe", "subscription", "signup", "login", "sidebar", "sidebars", "widget", "related",
    "recommended", "recommendations", "share", "sharing", "social", "comment", "comments",
    "commentlist", "respond", "disqus", "discussion", "replies", "reply", "breadcrumb",
    "breadcrumbs", "menu", "nav", "navbar", "navigation", "footer", "masthead", "toolbar",
    "pagination", "pager", "skip"}
_HEAD_WORDS = {"header", "topbar"}
#: Inside an article a name is junk only if all its parts are such words or these.
_PLAIN_PARTS = {"", "area", "bar", "block", "body", "bottom", "box", "button", "buttons", "card", "cards",
                "container", "content", "form", "group", "icons", "inner", "item", "items", "label",
                "left", "link", "links", "list", "main", "media", "module", "outer", "page", "panel",
                "post", "posts", "articles", "stories", "right", "row", "section", "site", "slot",
                "small", "text", "thread", "title", "top", "unit", "user", "wrap", "wrapper"}
#: A section of an article is junk only by these words.
_SECTION_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsored",
                  "comment", "comments", "commentlist", "respond", "disqus", "replies"}
#: Inside an article no name makes these junk: headings, paragraphs, marked-up words.
_TEXT_TAGS = {"h1", "h2", "h3", "h4", "h5", "h6", "p", "code", "kbd", "samp", "var", "em", "strong",
              "b", "i", "u", "a", "sup", "sub", "abbr", "cite", "q", "mark", "time", "dfn", "pre",
              "blockquote", "td", "th", "tr", "table", "tbody", "thead", "dt", "dd", "dl"}
_CONTAINERS = {"article", "main", "section", "div", "td", "body", "center", "blockquote"}
_BLOCKS = _CONTAINERS | {
    "html", "header", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd",
    "table", "thead", "tbody", "tfoot", "tr", "th", "caption", "pre", "figure", "figcaption",
    "details", "summary", "address", "hr"} | _JUNK_TAGS
_VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "area", "base", "col", "embed",
         "source", "track", "param"}
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
           "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_CUT_OFF = re.compile(r"</?[a-zA-Z!][^<>]*$")
_DIGITS = re.compile(r"\d+")
_PARTS = re.compile(r"[^a-z0-9]+")
#: Parts of names that tell of a layout or of something missing.
_LAYOUT_WORDS = {"no", "not", "non", "without", "with", "has", "free", "open", "opened", "closed",
                 "active", "enabled", "disabled", "layout"}
_COMMENT_WORDS = {"comment", "comments", "commentlist", "respond", "disqus", "discussion",
                  "replies", "reply"}
#: Raw elements that may be left unclosed without swallowing the page.
_NESTED_RAW = {"svg", "object", "canvas"}
_FOREIGN = {"svg"}
_BREAK_OUT = re.compile(r"<foreignobject|<(article|main|section|blockquote|body|center|dd|div|dl|dt"
                        r"|h[1-6]|hr|li|ol|p|pre|table|ul)(?=[\s/>])", re.I)
#: An element with a junk name and no article is kept if it holds this many
#: times the text outside such elements.
_MOST = 3
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_GOOD = {"article": 1.3, "main": 1.2}
_DECAY = 0.7


class Element:
    """``hard``: left out for sure, like everything below it; ``soft``: left
    out by its name, unless it turns out to hold the page's text.  ``order``
    numbers elements as they open, ``last`` is the largest number below."""

    __slots__ = ("tag", "path", "up", "hard", "soft", "inside", "score", "order", "last", "comments",
                 "junk", "outer", "main", "article", "size", "filled", "below", "blocks")

    def __init__(self, tag, path, up, hard, soft, inside, order, comments=False):
        self.tag, self.path, self.up, self.hard, self.soft = tag, path, up, hard, soft
        self.inside, self.score, self.order, self.comments = inside, 0.0, order, comments
        self.last, self.below, self.blocks = order, [], []

    def holds(self, e: "Element") -> bool:
        return self.order <= e.order <= self.last


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(text)}


def _is_hard(tag: str, attrs: dict[str, str], inside: bool) -> bool:
    if tag in _JUNK_TAGS or (tag == "header" and not inside):
        return True
    if attrs.get("role", "").lower() in _JUNK_ROLES or "hidden" in attrs:
        return True
    return attrs.get("aria-hidden") == "true" or "display:none" in attrs.get(
        "style", "").replace(" ", "").lower()


def _names(tag: str, attrs: dict[str, str], inside: bool) -> set[str]:
    """Words of class and id that make an element junk.  A name that only says
    how a page is laid out (no-sidebar, nav-open) says nothing of its content.
    Inside an article a name counts whole: related-posts is junk, related-work
    is not; sections are judged by few words, headings and text by none."""
    if tag in ("article", "main", "body", "html") or inside and tag in _TEXT_TAGS:
        return set()
    known = _JUNK_WORDS if inside else _JUNK_WORDS | _HEAD_WORDS
    if inside and tag == "section":
        known = _SECTION_WORDS
    found = set()
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split():
        parts = set(_PARTS.split(_DIGITS.sub("", name)))
        if not parts & _LAYOUT_WORDS and (not inside or parts <= known | _JUNK_WORDS | _PLAIN_PARTS):
            found |= parts & known
    return found


def _raw_end(page: str, tag: str, pos: int, closed: bool, unclosed: set[str]) -> int:
    """Where the content of a raw element ends that starts at ``pos``; tags
    found without an end are noted in ``unclosed`` and not looked for again."""
    if tag in unclosed:
        return pos
    if tag not in _NESTED_RAW:
        close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, pos)
        return close.end() if close else len(page)
    if closed and tag in _FOREIGN:
        return pos
    depth, end = 1, None
    for m in re.compile(rf"<(/?){tag}(?=[\s/>])[^>]*>", re.I).finditer(page, pos):
        if m[1]:
            depth -= 1
        elif not (tag in _FOREIGN and m[0].endswith("/>")):
            depth += 1
        if not depth:
            end = m.end()
            break
    if end is None:
        unclosed.add(tag)
    if tag in _FOREIGN:  # a block of the page ends a drawing that was not closed
        out = _BREAK_OUT.search(page, pos, len(page) if end is None else end)
        if out and out[1]:
            return out.start()
    return pos if end is None else end


def tags(page: str):
    """(start, stop, opening tag, its attributes, closing tag) of the markup in
    one pass.  A quote that is never closed is a character like any other; once
    a tag has no end outside quotes, quotes no longer count."""
    pos, quoted, missing = 0, True, set()
    while m := _OPEN.search(page, pos):
        start, pos = m.start(), m.end()
        if m[0] == "<!--":
            end = page.find("-->", pos)
            pos = len(page) if end < 0 else end + 3
            yield start, pos, "", "", ""
            continue
        end, at = -1, pos
        while m[1] and quoted:
            stop = _STOP.search(page, at)
            if not stop or stop[0] == ">":
                end = stop.start() if stop else -1
                quoted = stop is not None
                break
            at = stop.end()
            if stop[0] not in missing:
                close = page.find(stop[0], at)
                if close < 0:
                    missing.add(stop[0])
                else:
                    at = close + 1
        if end < 0:
            end = page.find(">", pos)
        if end < 0:  # no tag ends any more
            return
        jump = yield start, end + 1, (m[1] or "").lower(), page[pos:end] if m[1] else "", \
            (m[2] or "").lower()
        pos = jump or end + 1


def parse(page: str) -> tuple[list[Element], list[tuple[Element, str, int]]]:
    """All elements that are blocks or left out, in the order they open, and
    the text blocks in page order as (innermost element, raw text, characters
    in links)."""
    root = Element("", "", None, False, False, False, 0)
    found, blocks, stack = [root], [], [root]
    depth: Counter = Counter()  # open elements by tag
    unclosed: set[str] = set()
    buffer: list[str] = []
    linked, in_link = 0, 0

    def flush():
        nonlocal linked
        if buffer:
            raw = "".join(buffer)
            if raw.strip():
                blocks.append((stack[-1], raw, linked))
            buffer.clear()
        linked = 0

    def pop():
        e = stack.pop()
        depth[e.tag] -= 1
        e.last = len(found) - 1

    def add(piece):
        nonlocal linked
        if piece:
            buffer.append(piece)
            if in_link:
                linked += len(piece)

    source, jump, pos = tags(page), None, 0
    while True:
        try:
            start, stop, tag, inner, end = source.send(jump)
        except StopIteration:
            add(_CUT_OFF.sub("", page[pos:]))
            break
        jump = None
        add(page[pos:start])
        pos = stop
        if tag in _RAW:
            jump = pos = _raw_end(page, tag, pos, inner.endswith("/"), unclosed)
        elif tag == "a":
            in_link = 1
        elif end == "a":
            in_link = 0
        elif tag == "br":
            buffer.append(" ")
        elif tag and (tag in _BLOCKS or " class" in inner or " id" in inner or " role" in inner):
            attrs = _attributes(inner) if inner else {}
            up = stack[-1]
            if tag not in _BLOCKS and not _names(tag, attrs, up.inside) and (
                    up.hard or not _is_hard(tag, attrs, up.inside)):
                continue
            flush()
            if tag in _BLOCKS:
                closes = _CLOSES.get(tag, ()) if tag in _CLOSES else (
                    {"p"} if stack[-1].tag == "p" else ())
                while stack[-1].tag in closes:
                    pop()
                up = stack[-1]
            names = _names(tag, attrs, up.inside)
            if tag in _VOID:
                continue
            name = ".".join([tag, *sorted(set(_DIGITS.sub("#", attrs.get("class", "")
                                                          .lower()).split()))])
            # the path as a chained hash: its length does not grow with the depth
            e = Element(tag, xxhash.xxh64_hexdigest(f"{up.path}/{name}"), up,
                        up.hard or _is_hard(tag, attrs, up.inside), bool(names),
                        up.inside or tag in ("article", "main"), len(found),
                        bool(names & _COMMENT_WORDS))
            found.append(e)
            up.below.append(e)
            stack.append(e)
            depth[tag] += 1
        elif end and depth[end] > 0:
            flush()
            while stack[-1].tag != end:
                pop()
            pop()
    flush()
    while stack:
        pop()
    return found, blocks


def clean(raw: str) -> str:
    return " ".join(entities.unescape(raw).split())


def _keep_wrappers(found: list[Element], blocks: list[tuple[Element, str, float]]) -> None:
    """Take back ``soft`` of elements that hold the page's text: a main; an
    article and more text than is left without; or most of the text.  Comments
    only if they hold a main, or an article and nothing is left without.

    From the outermost inwards; the text left without only grows, so an element
    that stays soft is not looked at again."""
    for e in found:
        e.size, e.filled, e.main, e.article = 0.0, False, False, False
    for e, _, weight in blocks:
        e.size, e.filled = e.size + max(weight, 0), True
    for e in reversed(found):
        e.main |= e.filled and e.tag == "main"
        e.article |= e.filled and e.tag == "article"
        if (up := e.up) is not None:
            up.size, up.filled = up.size + e.size, up.filled or e.filled
            up.main, up.article = up.main or e.main, up.article or e.article
    nested = defaultdict(list)  # soft elements by the nearest soft element around them
    for e in found:
        e.outer = e.up.outer if e.up is not None else None
        if e.soft:
            nested[e.outer].append(e)
            e.outer = e
    new = nested[None]
    outside = found[0].size - sum(e.size for e in new)
    while new:
        kept = [e for e in new if e.main or (
            e.article and not outside and e.size > 0 if e.comments else
            e.size > outside * (1 if e.article else _MOST))]
        for e in kept:
            e.soft = False
            outside += e.size - sum(x.size for x in nested[e])
        new = [x for e in kept for x in nested[e]]


def scored(page: str):
    """Containers with scores, and the kept blocks (element, text, weight)."""
    found, blocks = parse(page)
    texts = [(e, clean(raw), linked) for e, raw, linked in blocks if not e.hard]
    texts = [(e, text, len(text) - 1.5 * min(linked, len(text))) for e, text, linked in texts
             if text]
    if any(e.soft for e in found):
        _keep_wrappers(found, texts)
    for e in found:
        e.junk = e.hard or e.soft or (e.up is not None and e.up.junk)
    kept = []
    for e, text, weight in texts:
        if not e.junk:
            kept.append((e, text, weight))
            e.score += weight
            e.blocks.append((e, text, weight))
    for e in reversed(found):  # from below: a container passes on a part of its score
        if e.up is not None:
            e.up.score += e.score * (_DECAY if e.tag in _CONTAINERS else 1.0)
    containers = [e for e in found if e.tag in _CONTAINERS and not e.junk]
    for e in containers:
        e.score *= _GOOD.get(e.tag, 1.0)
    return containers, kept


def best_container(found: list[Element], path: str | None = None) -> Element | None:
    own = [e for e in found if path is None or e.path == path]
    return max(own, key=lambda e: (e.score, -e.order), default=None)


def _blocks_below(e: Element, but: Element | None):
    """Kept blocks in ``e`` that are not in ``but``, each visited once."""
    todo = [e]
    while todo:
        x = todo.pop()
        if x is not but:
            yield from x.blocks
            todo += x.below


def _several_articles(e: Element) -> bool:
    """Whether the main around article ``e`` holds other articles beside it,
    each more text than links."""
    if e.up is None or e.up.tag != "main":
        return False
    others = [x for x in e.up.below if x.tag == "article" and x is not e and not x.junk]
    sums = [(sum(w for _, _, w in _blocks_below(x, None)), sum(len(t) for _, t, _ in _blocks_below(x, None)))
            for x in others]
    return any(size for _, size in sums) and all(w >= size / 2 for w, size in sums)


def whole(e: Element | None, kept: list[tuple[Element, str, float]]) -> Element | None:
    """The element that holds the whole article of which ``e`` is a part: the
    nearest article (or the main, if that holds several) or main, else the
    highest container all of whose text beside ``e`` is that of headings,
    paragraphs, sections or the like, with few links; of the body only what
    stands directly in it counts."""
    if e is None:
        return None
    up = e
    while up is not None:
        if up.tag == "article" and _several_articles(up):
            return up.up
        if up.tag in ("article", "main"):
            return up
        up = up.up
    top, seen, up = e, e, e.up
    pending = []  # blocks beside the article so far
    while up is not None and up.tag not in ("", "html"):
        new = list(_blocks_below(up, seen))
        pending += new
        if any(w < len(t) / 2 or b.tag in ("div", "body", "center", "header", "") for b, t, w in new):
            break
        if up.tag == "body" and any(b.up is not up or b.tag not in _HEADINGS | {"p"}
                                    for b, _, _ in pending):
            break
        if pending and up.tag in _CONTAINERS:
            top, pending = up, []
        seen, up = up, up.up
    return top


def main_text(page: str | None, path: str | None) -> str:
    """Text of the element on ``path``, or of the page's best container, with
    the rest of its article."""
    if not page:
        return ""
    found, kept = scored(page)
    chosen = (best_container(found, path) if path else None) or best_container(found)
    chosen = whole(chosen, kept)
    if chosen is None:
        return "\n\n".join(t for _, t, _ in kept)
    return "\n\n".join(t for e, t, _ in kept if chosen.holds(e))


def host_of(url: str | None) -> str | None:
    try:
        return (urlsplit(url).hostname or None) if url else None
    except ValueError:
        return None


_VOTE = pa.schema([("host", pa.string()), ("path", pa.string()), ("score", pa.float64())])
_OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()),
                  ("n_chars", pa.int64())])


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the consensus path of every host."""
    def vote(batches):
        for b in batches:
            rows = []
            for url, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                host = host_of(url)
                found, kept = scored(page) if host and page else ([], [])
                top = best_container(found)
                if top is not None and top.score > 0:
                    top = whole(top, kept)
                    rows.append((host, top.path, top.score))
            yield batch(_VOTE, *(zip(*rows, strict=True) if rows else ([], [], [])))

    votes = pages.select("url", "html").mapInArrow(vote, "host string, path string, score double")
    return (votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"),
                                              F.sum("score").alias("score"))
            .groupBy("host").agg(F.max_by("path", F.struct(
                "votes", F.round("score", 3), F.hash("path"))).alias("path")))


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    spark = pages.sparkSession
    prepare(spark)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    paths = written(host_paths(pages), "host-paths")
    if paths.count() <= BROADCAST_HOSTS:
        winners = {r[0]: r[1] for r in paths.collect()}
        joined = pages.select("page_id", "url", "html", F.lit(None).cast("string").alias("path"))
    else:
        winners = None
        joined = pages.withColumn("host", F.udf(host_of, "string")("url")).join(paths, "host", "left").select(
            "page_id", "url", "html", "path")

    def run(batches):
        for b in batches:
            urls, htmls, given = (b.column(i).to_pylist() for i in (1, 2, 3))
            if winners is not None:
                given = [winners.get(host_of(u)) for u in urls]
            texts = [main_text(h, p) for h, p in zip(htmls, given, strict=True)]
            yield batch(_OUT, b.column(0), b.column(1), texts, [len(t) for t in texts])

    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
