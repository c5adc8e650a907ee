"""HTML as a stream of block items: opened block elements and the text runs between block borders."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)"
    r"(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(?P<void>/?)>|<(?P<close2>/?)(?P<name2>[A-Za-z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)",
    re.S)
ATTR = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([^\s=/\"'>]+)", re.S)

# Element names of the HTML standard, by role.
RAW = {"script", "style", "noscript", "template", "iframe", "title", "textarea", "xmp", "noembed", "noframes"}
HEAD = {"meta", "link", "base", "title", "style", "script", "noscript", "template"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u",
          "var", "wbr", "img", "nobr", "ruby", "rt", "rp"}
SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
                "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"ul", "ol", "dl", "table", "tbody", "thead", "article", "main", "section", "div", "body"}
CONTENT = {"article", "main"}
CHROME = {"nav", "footer", "aside", "form", "button", "select", "option", "dialog", "menu", "object", "svg", "canvas",
          "head", "input", "label", "fieldset", "audio", "video", "map"} | RAW
CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert",
                "alertdialog", "menu", "menubar", "toolbar"}
# Elements whose class can mark them as page furniture.
CONTAINERS = {"div", "section", "ul", "ol", "dl", "table", "header"}
# Whole class names that mark page furniture.
CHROME_WORDS = {"ad", "ads", "adbox", "adslot", "advert", "adverts", "advertisement", "advertising", "adsense",
                "sponsor", "sponsored", "promo", "promotion", "cookie", "cookies", "consent", "gdpr", "notice",
                "notices", "notification", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription",
                "signup", "login", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination",
                "pager", "sidebar", "aside", "widget", "footer", "masthead", "topbar", "toolbar", "comment",
                "comments", "disqus", "replies", "reply", "share", "sharing", "social", "related", "recommended",
                "recommendations", "trending", "search", "skip", "banner", "disclaimer"}
OWN_WORDS = {"ad", "ads", "advert", "advertisement", "sponsored", "promo", "comment", "comments", "reply", "replies",
             "related", "teaser"}


@dataclass
class Item:
    """``key`` describes the item without its words; a text run also has its words."""

    key: str
    text: str | None = None


def attributes(raw: str) -> dict[str, str]:
    return {(m[1] or m[5]).lower(): unescape(m[2] or m[3] or m[4] or "") for m in ATTR.finditer(raw)}


def region(name: str, attrs: dict[str, str], inside: str) -> str:
    """A: main content, M: an article with the class of a comment or teaser, B: other body text, X: page
    furniture, S and C: furniture by the class of a container, C also for the articles in it."""
    words = set(attrs.get("class", "").lower().split())
    if inside == "X" or name in CHROME or "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return "X"
    if attrs.get("role", "").lower() in CHROME_ROLES or re.search(r"display\s*:\s*none", attrs.get("style", "")):
        return "X"
    if name in CONTENT or attrs.get("role") in CONTENT or attrs.get("itemprop") == "articleBody":
        return inside if inside in ("C", "M") else "M" if words & OWN_WORDS else "A"
    if name in ("html", "body"):
        return "B"
    if name in CONTAINERS and words & CHROME_WORDS:
        return "C" if inside in ("A", "M", "C") or words & OWN_WORDS else "S"
    if name in CONTAINERS and inside not in ("A", "M", "C") and (name == "header" or "header" in words):
        return "S"
    return inside


SEEN: dict = {}


def remembered(key: tuple, make):
    """``make()`` once per key; pages of a host repeat the same few tags."""
    if key not in SEEN:
        if len(SEEN) > 10_000:
            SEEN.clear()
        SEEN[key] = make()
    return SEEN[key]


def raw_end(name: str) -> re.Pattern:
    return remembered((name,), lambda: re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I))


def opened(name: str, raw: str, inside: str) -> tuple[str, str]:
    """Region and key of an opened element."""

    def look():
        attrs = attributes(raw)
        where = region(name, attrs, inside)
        return where, f"{where}|{name}|{'.'.join(sorted(attrs.get('class', '').split()))}"

    return remembered((name, raw, inside), look)


def block_items(page: str) -> list[Item]:
    """Items of a page in order. Text runs are decoded, with white space collapsed and trimmed.

    Comments, declarations and the content of scripts, styles and the like are dropped; inline elements
    do not end a run; missing end tags and stray ones are tolerated as browsers do.
    """
    items: list[Item] = []
    stack: list[tuple[str, str]] = []  # element name, region
    run: list[str] = []
    linked, free, in_link = 0, 0, 0

    def flush() -> None:
        nonlocal linked, free
        words = " ".join(unescape("".join(run)).split())
        if words:
            where = stack[-1][1] if stack else "B"
            block = next((n for n, _ in reversed(stack) if n not in INLINE), "")
            items.append(Item(f"#{where}|{block}|{'l' if linked > free else ''}", words))
        run.clear()
        linked = free = 0

    def pop(at: int) -> None:
        nonlocal in_link
        for name, _ in stack[at:]:
            in_link -= name == "a"
        del stack[at:]

    def text(part: str) -> None:
        nonlocal linked, free
        if part:
            run.append(part)
            if in_link:
                linked += len(part)
            elif not part.isspace():
                free += len(part)

    at, size = 0, len(page)
    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            text(page[at:])
            break
        m = TOKEN.match(page, lt)
        if not m:
            text(page[at:lt + 1])
            at = lt + 1
            continue
        text(page[at:lt])
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        closing = m["close"] or m["close2"]
        if closing:
            if name in ("br", "p") and not any(n == name for n, _ in stack):
                flush()
                continue
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    if name not in INLINE:
                        flush()
                    pop(k)
                    break
                if name in INLINE and stack[k][0] not in INLINE:
                    break  # a stray inline end tag does not close blocks
            continue
        if name == "br":
            text(" ")
            continue
        if name not in INLINE:
            flush()
            while stack and stack[-1][0] in INLINE:
                pop(len(stack) - 1)
            if stack and any(n == "head" for n, _ in stack) and name not in HEAD:  # a missing </head>
                pop(next(k for k, (n, _) in enumerate(stack) if n == "head"))
            shut = SELF_CLOSING.get(name, set()) | {"p"}
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in shut:
                    pop(k)
                elif stack[k][0] in SCOPES:
                    break
        where, key = opened(name, m["attrs"] or m["attrs2"] or "", stack[-1][1] if stack else "B")
        if name in RAW:
            end = raw_end(name).search(page, at)
            at = end.end() if end else size
            continue
        if name not in INLINE:
            items.append(Item(key))
        if name not in VOID and not (m["void"] and name in ("svg", "path")):
            stack.append((name, where))
            in_link += name == "a"
    flush()
    return items
