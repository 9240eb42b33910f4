"""Cut HTML into element paths and text nodes, leniently and in one pass."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|"
    r"<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>",
    re.S,
)
_MARKS = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[a-z0-9]+")

#: Content up to the end tag is text without markup.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "template"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
    "mark", "q", "ruby", "rt", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
}
#: An opening tag ends an open element of these kinds.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
#: Elements that hold running text, as opposed to containers.
TEXT = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "td", "th", "tr", "blockquote", "pre", "figcaption", "caption", "ul", "ol", "dl", "table", "tbody", "thead"}
ASIDE_TAGS = {
    "nav", "header", "footer", "aside", "form", "script", "style", "noscript", "button", "select", "textarea", "iframe",
    "menu", "dialog", "template", "head", "title", "svg", "object", "xmp", "noembed", "noframes",
}
ASIDE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
    "consent", "contentinfo", "cookie", "cookies", "disclaimer", "footer", "gdpr", "header", "masthead", "menu", "modal", "nav",
    "navbar", "navigation", "newsletter", "notice", "popup", "promo", "promoted", "related", "replies", "respond", "search",
    "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "subscription", "toolbar", "widget", "reader",
}
#: Words that an aside's name may have besides; any other makes it another name (``no-sidebar``, ``header-image``).
ASIDE_BESIDES = {"site", "list", "area", "box", "section", "block", "links", "buttons", "posts"}
NO_ASIDES = {"html", "body", "main", "article"}
DEPTH = 60


def component(tag: str, attributes: str) -> str:
    """Name of an element in a path: its tag and the values of its class, id and role without numbers, sorted."""
    marks = set()
    if attributes:
        for _, a, b, c in _MARKS.findall(attributes):
            for value in (a or b or c).lower().split():
                marks.add("-".join(w for w in _WORDS.findall(value) if not w.isdigit()))
    return ".".join([tag, *sorted(marks - {""})])


@lru_cache(1 << 16)
def is_aside(name: str) -> bool:
    """Whether a path component is by its name no part of an article."""
    tag, *values = name.split(".")
    if tag in NO_ASIDES:
        return False
    return tag in ASIDE_TAGS or any(
        (words := set(v.split("-")) - ASIDE_BESIDES) and words <= ASIDE_WORDS for v in values
    )


def parts(page: str) -> Iterator[tuple[str, tuple[str, ...], str, bool]]:
    """``(kind, path, text, in link)``: kind ``open`` for an element, ``text`` for a text node, ``break`` between blocks.

    A path names the open block elements from the root, ``DEPTH`` at most, and the outermost aside below those. End tags close what they match and
    are ignored otherwise. Text is given with character references decoded; void elements but ``hr`` and inline
    elements break no block; ``br`` is white space.
    """
    path: list[str] = []
    deep: list[int] = []  # places of open asides below DEPTH
    links, at, here = 0, 0, ()

    def named() -> tuple[str, ...]:
        while deep and deep[-1] >= len(path):
            deep.pop()
        return (*path[:DEPTH], path[deep[0]]) if deep else tuple(path[:DEPTH])

    while at < len(page):
        found = _TAG.search(page, at)
        text = page[at : found.start()] if found else page[at:]
        if text:
            yield "text", here, html.unescape(text) if "&" in text else text, links > 0
        if not found:
            return
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        closing, attributes = found[1] or found[4], found[3] or found[6] or ""
        if tag in INLINE:
            if tag == "a":
                links = max(0, links + (-1 if closing else 1))
            continue
        if tag in VOID:
            if tag == "br":
                yield "text", here, " ", links > 0
            elif tag == "hr":
                yield "break", here, "", False
            continue
        if closing:
            for i in range(len(path) - 1, -1, -1):
                if path[i].split(".", 1)[0] == tag:
                    del path[i:]
                    break
        else:
            if path:
                top = path[-1].split(".", 1)[0]
                if top in ENDS.get(tag, ()) or top == "p" or (tag == "tr" and top in ENDS["tr"]):
                    path.pop()
                    named()
            path.append(component(tag, attributes))
            if len(path) > DEPTH and is_aside(path[-1]):
                deep.append(len(path) - 1)
        here = named()
        links = 0 if not closing else links
        yield "break", here, "", False
        if not closing:
            yield "open", here, "", False
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
                path.pop()
                here = named()
                yield "break", here, "", False
