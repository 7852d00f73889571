"""Leaf blocks of a page: runs of text between the borders of block elements, with what their ancestors say.

One pass over the page, linear in its length: an element takes over its parent's hints when it
is opened, so no block walks up its ancestors, and an end tag that nothing opened is told by a
count. End tags that may be left out are implied; an unknown or inline element ends nothing.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from typing import NamedTuple

#: Fixed values, of HTML: elements without content, with content that isn't text of the page, that end a run of text, and those whose start ends an open one of the second set.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = frozenset("script style noscript template textarea iframe svg math object canvas audio video title noframes xmp".split())
BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split())
ENDS_P = BLOCK - {"button", "label", "option", "optgroup", "select", "legend", "caption", "tr", "td", "th", "tbody", "thead", "tfoot"}
IMPLIED = {"li": ("li", {"ul", "ol", "menu", "dir"}), "dt": ("dd dt", {"dl"}), "dd": ("dd dt", {"dl"}), "option": ("option", {"select"}), "tr": ("tr", {"table"}), "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"}), "tbody": ("tbody thead tfoot", {"table"}), "tfoot": ("tbody thead tfoot", {"table"})}
SCOPE = frozenset("table td th caption button object html".split())

#: Words of class, id and role that tell what an element is for.
HINTS = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs crumbs toc tabs tablist pager pagination dropdown skip skiplink sitemap",
    "head": "header masthead topbar logo branding banner hero",
    "foot": "footer foot copyright colophon legal imprint contentinfo",
    "side": "sidebar aside rail widget widgets related recommended recommendations trending popular teaser teasers more complementary latest",
    "ad": "ad ads advert advertisement advertising adsense adslot sponsor sponsored promo promotion promoted outbrain taboola dfp commercial",
    "note": "cookie cookies consent gdpr notice notification alert alertdialog dialog modal popup overlay paywall newsletter subscribe subscription signup toast disclaimer",
    "talk": "comment comments commentlist reply replies respond discussion discussions disqus thread reactions feedback reviews review guestbook",
    "share": "share sharing social sharebar follow like likes tweet addtoany",
    "form": "form login search searchbox contact register poll survey",
    "body": "article post entry content story body text main blog news prose copy maincontent",
    "meta": "meta byline author date timestamp published tags tag category categories credits",
    "hide": "hidden hide invisible visuallyhidden screenreader sr",
}
_TAG_HINTS = {"nav": "menu", "menu": "menu", "header": "head", "footer": "foot", "aside": "side", "form": "form", "fieldset": "form", "select": "form", "option": "form", "button": "form", "label": "form", "legend": "form", "dialog": "note", "article": "body", "main": "body", "address": "meta", "time": "meta"}
_TAGS = ["article", "main", "nav", "header", "footer", "aside", "form", "section", "ul", "ol", "table", "figure", "blockquote", "details", "a"]
NAMES = [*HINTS, *[f"<{t}>" for t in _TAGS]]
_BIT = {n: 1 << i for i, n in enumerate(NAMES)}
_HINT_BITS = (1 << len(HINTS)) - 1
_WORD = {w: _BIT[h] for h, words in HINTS.items() for w in words.split()}
_LINK = _BIT["<a>"]
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTR = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_QUOTE = re.compile(r"=\s*([\"'])")
_CLOSERS = {t: re.compile(f"</{t}", re.I) for t in UNREAD}
#: Elements within so many others take their place in the outermost of those, as in browsers.
DEPTH = 512
_PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Block(NamedTuple):
    """text; tag of the block element and of its parent; hints of all ancestors, and of the innermost that has any; characters within links."""

    text: str
    tag: str
    parent: str
    any: int
    near: int
    linked: int


def _tag_end(page: str, at: int, gone: set[str]) -> int:
    """The place of the > that ends the tag at that place, quoted values passed over; -1 if it isn't ended. gone: quotes that the rest of the page lacks."""
    while True:
        end = page.find(">", at)
        if end < 0:
            return -1
        opens = _QUOTE.search(page, at, end)
        if not opens or opens[1] in gone:
            return end
        close = page.find(opens[1], opens.end())
        if close < 0:
            gone.add(opens[1])
            return end
        at = close + 1


def _hints(tag: str, attrs: str) -> int:
    bits = _BIT.get(f"<{tag}>", 0)
    if tag in _TAG_HINTS:
        bits |= _BIT[_TAG_HINTS[tag]]
    if attrs:
        for m in _ATTR.finditer(attrs):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
                bits |= _BIT["hide"]
            elif name in ("class", "id", "role"):
                for w in _PIECE.findall(value):
                    bits |= _WORD.get(w.lower(), 0)
    return bits


def leaf_blocks(page: str) -> tuple[list[Block], Counter]:
    """The blocks of a page that have text, in order, and how often each element was opened."""
    out: list[Block] = []
    stack: list[tuple[str, int, int]] = [("", 0, 0)]  # element, hints of it and its ancestors, innermost hints
    opened: Counter = Counter()
    seen: Counter = Counter()
    blocks: list[int] = [0]  # places of block elements in the stack
    scopes: list[tuple[str, int]] = []  # open p, and elements that hide them
    texts: list[str] = []
    linked, at, n, gone = 0, 0, len(page), set()

    def flush():
        nonlocal linked
        text = " ".join("".join(texts).split())
        texts.clear()
        if text:
            _, every, near = stack[-1]
            parent = stack[blocks[-2]][0] if len(blocks) > 1 else ""
            out.append(Block(text, stack[blocks[-1]][0], parent, every & ~_LINK, near, min(linked, len(text))))
        linked = 0

    def cut_to(depth: int):
        while len(stack) > depth:
            tag = stack.pop()[0]
            opened[tag] -= 1
            if blocks[-1] == len(stack):
                blocks.pop()
            if scopes and scopes[-1][1] == len(stack):
                scopes.pop()

    def close(names: str, bound) -> None:
        """Closes the innermost of the named elements unless an element of bound is further in."""
        if any(opened[t] > 0 for t in names.split()):
            for i in range(len(blocks) - 1, 0, -1):
                tag = stack[blocks[i]][0]
                if tag in bound:
                    return
                if tag in names.split():
                    cut_to(blocks[i])
                    return

    while at < n:
        lt = page.find("<", at)
        lt = n if lt < 0 else lt
        if lt > at:
            text = page[at:lt]
            text = html.unescape(text) if "&" in text else text
            texts.append(text)
            if stack[-1][1] & _LINK:
                linked += len(text.strip())
        if lt == n:
            break
        nxt = page[lt + 1 : lt + 2]
        if nxt in ("!", "?"):
            if page.startswith("<!--", lt):
                end = lt + 3 if page.startswith("<!-->", lt) else page.find("-->", lt + 4)
                at = n if end < 0 else page.find(">", end) + 1
            else:
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
            continue
        closing = nxt == "/"
        name = _NAME.match(page, lt + 1 + closing)
        if not name:
            if closing:  # a comment, as browsers read it
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                texts.append("<")
                at = lt + 1
            continue
        tag = name[0].lower()
        end = _tag_end(page, name.end(), gone)
        if end < 0:
            break  # the page ends within a tag
        at = end + 1
        if closing:
            if tag == "br":
                texts.append(" ")
            elif tag in BLOCK:
                flush()
            if opened[tag] > 0:
                while stack[-1][0] != tag:
                    cut_to(len(stack) - 1)
                cut_to(len(stack) - 1)
            continue
        seen[tag] += 1
        if tag == "br":
            texts.append(" ")
            continue
        if tag in UNREAD:
            if page[end - 1] == "/" and tag in ("svg", "math"):
                continue
            stop = _CLOSERS[tag].search(page, at)
            if not stop:
                break
            stop = page.find(">", stop.end())
            at = n if stop < 0 else stop + 1
            continue
        if tag in BLOCK:
            flush()
            if tag in ENDS_P and scopes and scopes[-1][0] == "p":
                cut_to(scopes[-1][1])
            if tag in IMPLIED:
                close(*IMPLIED[tag])
        if tag in VOID:
            continue
        if tag == "a" and opened["a"] > 0 and stack[-1][0] == "a":
            cut_to(len(stack) - 1)
        if len(stack) > DEPTH:
            continue
        bits = _hints(tag, page[name.end() : end])
        _, every, near = stack[-1]
        stack.append((tag, every | bits, bits & _HINT_BITS or near))
        opened[tag] += 1
        if tag in BLOCK:
            blocks.append(len(stack) - 1)
        if tag == "p" or tag in SCOPE:
            scopes.append((tag, len(stack) - 1))
    flush()
    return out, seen
