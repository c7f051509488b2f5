"""Main text of web pages: markup, then differencing with the page of the nearest URL."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlato.llm.common import in_ranges, table

RANGE_ROWS = 512

# Element names and words of class and id names, by what they mean for a page.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "template", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
SKIPPED = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "head", "fieldset"}
# inside a line: what is not shown as text there, with what it holds
INLINE_SKIPPED = {
    "annotation", "annotation-xml", "audio", "button", "canvas", "datalist", "defs", "metadata", "object", "select", "video",
}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
    "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary",
    "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
CHROME_WORDS = {
    "ad", "ads", "advert", "advertisement", "advertising", "adverts", "alert", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "login", "masthead", "menu", "modal",
    "nav", "navbar", "navigation", "newsletter", "notice", "notification", "overlay", "pager", "pagination", "popup",
    "promo", "promotion", "promoted", "recommended", "related", "replies", "search", "share", "sharing", "sidebar",
    "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "teaser", "toolbar", "widget",
}
# words of names that tell the kind of a box, or whose it is, and not what is in it
NEUTRAL_WORDS = {
    "a", "area", "article", "background", "bar", "block", "body", "bottom", "box", "btn", "button", "buttons", "card", "cards",
    "center", "col", "column", "container", "content", "entry", "float", "footer", "form", "global", "group", "header",
    "heading", "icon", "icons", "inline", "inner", "item", "items", "label", "layout", "left", "link", "links", "list", "main",
    "outer", "page", "panel", "part", "post", "posts", "primary", "reader", "right", "row", "secondary", "section", "site",
    "slot", "small", "text", "the", "thread", "title", "to", "top", "unit", "user", "wide", "wrap", "wrapper",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CHROME_ROLES = {
    "alert", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar", "navigation", "search",
}

# All of these run in linear time: nothing that was read is tried again in another way. A quoted value
# without an end is closed by the next ">".
TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|["'][^>]*+|[^\s>"'][^\s>]*+)?+)*+)(?:>|\Z)"""
    r"""|<[!?/][^>]*+(?:>|\Z)""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s>/=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|["']?+([^\s>"'][^\s>]*+)?+))?+""")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")

# What a line is part of: an article, an article inside the main element, that element outside of articles, a part
# of any of these whose name says that it may not belong there, none of all, or what surrounds articles.
ARTICLE, INNER, MAIN, DOUBTFUL, OPEN, CHROME = "article", "inner", "main", "doubtful", "open", "chrome"
TEXT = (ARTICLE, INNER, MAIN)


def _named_chrome(name: str) -> str | None:
    """What a class or id says: ``CHROME`` if all its words mean what surrounds articles, ``DOUBTFUL`` if only the
    one that the others qualify does (``price-alert``; not ``share-price`` or ``related-work``)."""
    found = [w for w in re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()) if w]
    known = [w for w in found if w not in NEUTRAL_WORDS]
    if not known:
        # a name like "site-header" has no word of its own
        return None
    while found[-1] in NEUTRAL_WORDS:
        found.pop()
    if found[-1] not in CHROME_WORDS:
        return None
    return CHROME if all(w in CHROME_WORDS for w in known) else DOUBTFUL


def _judged(name: str, attributes: str, inside: bool) -> str | None:
    """``CHROME`` for an element that surrounds articles, ``DOUBTFUL`` for one inside an article that may; a header or
    footer inside an article is part of it unless named otherwise. Ids of headings are made of their words and tell nothing."""
    if name in SKIPPED and not (inside and name == "header") or name in INLINE_SKIPPED:
        return CHROME
    doubt = None
    for key, *values in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), next((v for v in values if v), "")
        if key in ("class", "id") and name not in ("body", "html", "article", "main"):
            if key == "id" and name in HEADINGS:
                continue
            for part in value.split():
                kind = _named_chrome(part)
                if not inside and (kind or part.lower() == "header" or re.search(r"(^|[-_])header$", part.lower())):
                    return CHROME
                if kind == CHROME:
                    return CHROME
                doubt = doubt or kind
        elif key == "role" and value.lower() in CHROME_ROLES or key == "aria-hidden" and value.lower() == "true":
            return CHROME
        elif key == "hidden" or key == "style" and HIDDEN.search(value.lower()):
            return CHROME
    return doubt


def lines(html: str | None) -> list[tuple[str, str]]:
    """The page's blocks of text in order, each with what it is part of.

    Scripts, styles and markup are gone, character references decoded, white
    space within a block is one space. Tags need not match: an end tag closes
    what is open inside its element, and one without a beginning is ignored.
    """
    found: list[tuple[str, str]] = []
    block: list[str] = []
    # open elements: name, place before it, and the line that an element inside it interrupts, if it does
    stack: list[tuple[str, str, list[str] | None]] = []
    opened: Counter[str] = Counter()
    place = OPEN

    def close() -> None:
        text = " ".join("".join(block).split())
        if text:
            found.append((place, text))
        block.clear()

    def leave() -> str:
        nonlocal place, block
        name, before, line = stack.pop()
        opened[name] -= 1
        if line is not None:
            close()
            place, block = before, line
        elif before != place:
            close()
            place = before
        return name

    at, html = 0, html or ""
    while True:
        tag = TAG.search(html, at)
        if tag is None:
            block.append(unescape(html[at:]))
            break
        if tag.start() > at:
            text = html[at : tag.start()]
            block.append(unescape(text) if "&" in text else text)
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        if tag[1]:
            if name in BLOCKS or name in SKIPPED:
                close()
            if opened[name]:
                while leave() != name:
                    pass
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}[\s/>]|</{re.escape(name)}\Z", re.IGNORECASE).search(html, at)
            at = html.find(">", end.start()) + 1 if end else len(html)
            at = at or len(html)
            continue
        if name == "br":
            block.append(" ")
        if name in BLOCKS or name in SKIPPED:
            close()
            # a paragraph or list item ends where the next begins
            if stack and stack[-1][0] in ("p", "li") and (stack[-1][0] == "p" or name == "li"):
                leave()
        if name in VOID or tag[3].endswith("/") and (name in SKIPPED or name in INLINE_SKIPPED):
            continue
        now = place
        if place != CHROME:
            kind = _judged(name, tag[3], place in TEXT)
            if kind:
                now = kind
            elif place != DOUBTFUL and (name == "article" or "articlebody" in tag[3].lower()):
                now = INNER if place in (INNER, MAIN) else ARTICLE
            elif place == OPEN and (name == "main" or re.search(r"""role\s*=\s*["']?main\b""", tag[3], re.IGNORECASE)):
                now = MAIN
        line = None
        if now != place:
            if name in BLOCKS or name in SKIPPED:
                close()
            else:
                # the line goes on after an element inside it
                line, block = block, []
        stack.append((name, place, line))
        opened[name] += 1
        place = now
    while stack:
        leave()
    close()
    return found


def common_lines(a: list[str], b: list[str]) -> set[int]:
    """Positions in ``a`` of the lines of a longest common subsequence of ``a`` and ``b``, with one bit per line of ``b``."""
    masks: dict[str, int] = {}
    for j, line in enumerate(b):
        masks[line] = masks.get(line, 0) | 1 << j
    full = (1 << len(b)) - 1
    state, rows = full, []
    for line in a:
        hit = state & masks.get(line, 0)
        state = ((state + hit) | (state - hit)) & full
        rows.append(state)
    matched, i, j = set(), len(a), len(b)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if i and not rows[i - 1] >> (j - 1) & 1:
                continue
            matched.add(i)
            j -= 1
    return matched


def _parts(own: list[tuple[str, str]]) -> tuple[str, ...]:
    """What a page's text is made of: the main element with its articles, or these alone if they hold half of its
    characters at least; without one, the articles; else all that surrounds nothing."""
    held = Counter()
    for part, text in own:
        held[part] += len(text)
    if held[MAIN] > held[INNER]:
        return (MAIN, INNER)
    if held[INNER]:
        return (INNER,)
    return (ARTICLE,) if held[ARTICLE] else (OPEN,)


def main_text(own: list[tuple[str, str]], near: list[tuple[str, str]] | None) -> str:
    """A page's lines without what surrounds the article, and without the lines it shares with the near page.

    Lines inside an article element are its text, whatever other pages say: pages
    quote each other and repeat licences. What the alignment decides is all that markup leaves open: lines of the
    main element outside of articles, lines of pages that have neither, and lines of doubtful name anywhere in the
    text. Shared ones go; but where two main elements share half of their characters or more, the pages
    are versions of one another, and only lines of doubtful name go. Without a near page, those go too.
    """
    wanted = _parts(own)
    gone = {k for k, (part, _) in enumerate(own) if part not in wanted and part != DOUBTFUL}
    doubtful = {k for k, (part, _) in enumerate(own) if part == DOUBTFUL}
    if near is None:
        gone |= doubtful
    else:
        theirs = (*_parts(near), DOUBTFUL)
        mine = [k for k, (part, _) in enumerate(own) if part in wanted or part == DOUBTFUL]
        other = [text for part, text in near if part in theirs]
        met = {mine[k] for k in common_lines([own[k][1] for k in mine], other)}
        shared = sum(len(own[k][1]) for k in met)
        versions = 2 * shared >= min(sum(len(own[k][1]) for k in mine), sum(map(len, other)))
        open_to = doubtful if versions and wanted != (OPEN,) else {k for k in mine if own[k][0] not in (ARTICLE, INNER)}
        gone |= met & open_to
    return "\n".join(text for k, (_, text) in enumerate(own) if k not in gone)


def _nearness(a: str, b: str) -> int:
    """Equal leading characters of two paths; -1 for different hosts."""
    (host, path), (other, near) = a.split("\0")[:2], b.split("\0")[:2]
    if host != other:
        return -1
    return next((k for k, (x, y) in enumerate(zip(path, near)) if x != y), min(len(path), len(near)))


def _differenced(rows: pd.DataFrame) -> pd.DataFrame:
    """One range of pages in the order of host and path, with a guest from either side."""
    rows = rows.sort_values(["order", "guest"], kind="stable", ignore_index=True)
    keys = rows["order"].tolist()
    parsed = [lines(html) for html in rows["html"]]
    texts = []
    for k in range(len(rows)):
        sides = [i for i in (k - 1, k + 1) if 0 <= i < len(rows) and _nearness(keys[k], keys[i]) >= 0]
        # copies tell nothing about what surrounds an article
        sides = [i for i in sides if parsed[i] != parsed[k]] or sides
        near = max(sides, key=lambda i: _nearness(keys[k], keys[i]), default=None)
        same = near is None or parsed[near] == parsed[k]
        texts.append(main_text(parsed[k], None if same else parsed[near]))
    return rows[["page_id", "url"]].assign(text=texts)[~rows["guest"]]


def extract(pages: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``page_id, url, text``: the main text of pages ``page_id, url, html``.

    Pages are sorted by host and path, in ranges of their own so that a host
    with many pages is spread. Each page is paired with the one before or after
    it on its host, whichever path has more leading characters in common, and lines
    are aligned by longest common subsequence; see :func:`main_text`. A pair of
    equal pages, or a page alone on its host, shares nothing.

    A null html is empty and gives an empty text, a null url is a host of its
    own, null ids stay null. Pages that repeat come out each. Other columns are
    ignored; no rows give none.
    """
    url = F.coalesce("url", F.lit(""))
    pattern = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)([^?#]*)"
    host, path = F.lower(F.regexp_extract(url, pattern, 1)), F.regexp_extract(url, pattern, 2)
    page_id = F.col("page_id").cast("string")
    order = F.concat_ws("\0", F.translate(host, "\0", ""), F.translate(path, "\0", ""), F.lpad(page_id, 20, "0"), F.sha1(F.coalesce("html", F.lit(""))))

    def guests(ends: list[tuple[int, str, str]]) -> dict[str, list[int]]:
        places: dict[str, list[int]] = {}
        for (low, _, last), (high, first, _) in zip(ends, ends[1:]):
            places.setdefault(last, []).append(high)
            places.setdefault(first, []).append(low)
        return places

    rows = in_ranges(pages.select(page_id.alias("page_id"), "url", "html", order.alias("order")), range_rows, guests)
    made = rows.groupBy("range").applyInPandas(_differenced, "page_id string, url string, text string")
    return made.select(F.col("page_id").cast("long").alias("page_id"), "url", "text")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
