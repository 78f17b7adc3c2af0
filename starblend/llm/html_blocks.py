"""HTML as a list of text blocks, each with where it stands."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

# Element and attribute names of HTML.
INLINE = frozenset(
    """a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr output q rp rt ruby s samp
    small span strike strong sub sup time tt u var wbr img""".split()
)
DROPPED = frozenset(
    """script style noscript template iframe object embed svg math canvas head title select textarea button datalist
    audio video map""".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CHROME = frozenset("nav header footer aside form menu dialog fieldset".split())
MAIN = frozenset("article main".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split())
MAIN_ROLES = frozenset("main article".split())
#: Words of class and id names that mark something else than the main text.
CHROME_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising advertorial banner breadcrumb breadcrumbs byline comment
    comments commentlist commenting consent cookie cookies copyright disclaimer disqus dropdown footer footnav gdpr
    header login masthead menu modal nav navbar navigation newsletter notice notices overlay pager paging pagination
    popup privacy promo promos promotion recommended related replies reply respond search share sharing sidebar signup
    skip social sponsor sponsored sponsors subscribe subscription tags toc toolbar topbar widget widgets""".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSED_BY = {
    "p": frozenset(
        """address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1
        h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul""".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option", "optgroup"]),
}
FENCES = frozenset("table ul ol dl article section aside nav main header footer form body html div blockquote".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",  # with a quote that is never closed
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'=<>`]+))?""")
_RAW = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.IGNORECASE) for name in ("script", "style", "textarea", "title", "iframe", "noscript", "noembed", "xmp")}
HEAD = frozenset("base link meta noscript script style template title".split())
ITEM_WORDS = frozenset("ad advert advertisement comment comments promo related reply sponsored".split())
NEGATED = frozenset("has hide is no not with without".split())
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


#: Words that join a layout's parts in one class name, as in ``content-with-sidebar``: such a name marks no part.
JOINING = frozenset("with and of on in at for to left right".split())


class Block(NamedTuple):
    text: str
    path: str  # the open elements
    chrome: bool  # inside a menu, header, footer, sidebar, notice, advert, form or comments
    main: bool  # inside the article
    wrapped: bool = False  # its article lies inside something that a class or id marks as one of these


class _Open(NamedTuple):
    name: str
    chrome: bool
    main: bool
    dropped: bool
    soft: bool = False  # chrome by class or id only, and of a kind that may be the layout around the article
    wrapped: bool = False


def _kind(name: str, attributes: str, within: _Open) -> _Open:
    main, chrome, marked, item = name in MAIN, name in CHROME, False, False
    hidden = False
    if attributes and not attributes.isspace():
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), html.unescape(value.strip("\"'")) if value else ""
            if key == "role":
                main, chrome = main or value.lower() in MAIN_ROLES, chrome or value.lower() in CHROME_ROLES
            elif key in ("class", "id") and name not in ("html", "body"):
                if key == "id" and (within.main or within.soft) and (name in HEADINGS or name == "p"):
                    continue  # the anchor of a heading or paragraph
                marks = ITEM_WORDS if name in MAIN else CHROME_WORDS
                for token in value.split():
                    words = [w.lower() for w in _NAME_WORD.findall(token)]
                    if words and words[0] not in NEGATED and JOINING.isdisjoint(words[1:-1]):
                        found = marks.intersection(words[:1] if name in MAIN else words)
                        marked, item = marked or bool(found), item or not ITEM_WORDS.isdisjoint(found)
            elif key == "itemprop" and value.lower() == "articlebody":
                main = True
            elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
                hidden = True
            elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
                hidden = True
    # a header or form inside the article belongs to it; an article inside comments does not count as one
    if name == "header" and within.main and not within.chrome:
        chrome = False
    dropped = within.dropped or hidden or name in DROPPED
    if within.soft and main and not marked:  # what the class names is the layout around this article
        return _Open(name, False, True, dropped, False, True)
    soft = marked and not (chrome or item or within.main or main) and (within.soft or not within.chrome)
    soft = soft or (within.soft and not (chrome or item))
    return _Open(name, within.chrome or chrome or marked, (within.main or main) and not within.chrome, dropped, soft, within.wrapped)


def blocks(page: str | None) -> list[Block]:
    """The text blocks of a page in order: character references decoded, white space as one space, trimmed."""
    out: list[Block] = []
    if not page:
        return out
    stack = [_Open("", False, False, False)]
    parts: list[str] = []
    at = 0

    def flush() -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            top = stack[-1]
            path = "/".join(e.name for e in stack[1:] if e.name not in INLINE)
            out.append(Block(text, path, top.chrome, top.main, top.wrapped))

    def text(raw: str) -> None:
        top = stack[-1]
        if raw and not top.dropped and not (top.chrome and not stack[_block_depth(stack)].chrome):
            parts.append(html.unescape(raw) if "&" in raw else raw)

    def close(depth: int) -> None:
        if any(e.name not in INLINE for e in stack[depth:]):
            flush()
        del stack[depth:]

    while (tag := _TAG.search(page, at)) is not None:
        text(page[at : tag.start()])
        at = tag.end()
        ends, name, attributes = (tag[1], tag[2], tag[3]) if tag[2] else (tag[4], tag[5], tag[6])
        if name is None:
            if tag[0].startswith("<![CDATA["):
                text(html.escape(tag[0][9:].removesuffix("]]>")))
            continue
        name = name.lower()
        if ends:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    close(depth)
                    break
                if stack[depth].name in FENCES and name in INLINE | {"p", "li"}:
                    break
            else:
                if name not in INLINE:
                    flush()
            continue
        if name not in INLINE:
            flush()
        if name not in HEAD and name != "html":
            for depth, element in enumerate(stack):
                if element.name == "head":
                    del stack[depth:]
                    break
        while len(stack) > 1 and name in CLOSED_BY.get(_block_name(stack), ()):
            close(_block_depth(stack))
        if name in VOID:
            if name in ("br", "hr"):
                flush()
            continue
        kind = _kind(name, attributes, stack[-1])
        if attributes.rstrip().endswith("/") and name in DROPPED:
            continue
        if name in _RAW:
            end = _RAW[name].search(page, at)
            at = end.start() if end else len(page)
            if kind.dropped:
                closing = _TAG.match(page, at)
                at = closing.end() if closing else at
                continue
        stack.append(kind)
    text(page[at:])
    flush()
    return out


def _block_depth(stack: list[_Open]) -> int:
    depth = len(stack) - 1
    while depth > 0 and stack[depth].name in INLINE:
        depth -= 1
    return depth


def _block_name(stack: list[_Open]) -> str:
    return stack[_block_depth(stack)].name
