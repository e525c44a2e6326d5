"""Blocks of text in raw pages, and what each page's own markup says about them.

One pass of a pattern over a page finds its tags; a stack of the open elements that matter
tells the place of each piece of text.  A block is what stands between the borders of
block-level elements; its character references are decoded, its white space (line breaks of
<br> too) becomes single spaces, and empty blocks aren't blocks.

A block is
- ARTICLE inside the page's main text: its <article> elements; where there are none, <main> or
  an element with that role or name; an article or main element isn't judged by the class of a
  container around it, unless that is one of reader comments or adverts (an element that is only
  named like content is);
- FURNITURE where markup names it a menu, header, footer, sidebar, notice, advert, form or
  reader comment, by element, role or class and id words (inside the main text, too, but for
  headers, which there hold the headline);
- OPEN otherwise: markup leaves it open.
Text of scripts, styles and other elements that aren't read as text is no block at all.
"""

from __future__ import annotations

import html
import re
from collections import Counter

ARTICLE, OPEN, FURNITURE = 0, 1, 2

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>|</[^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

# Elements by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in "script style noscript template textarea title iframe noembed noframes xmp".split()}
UNREAD = frozenset("head svg object applet canvas audio video select datalist button".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES = {  # an opening tag ends these open elements, up to the elements that hold them
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("table", "tr")), "th": (("td", "th"), ("table", "tr")), "option": (("option",), ("select",)),
}
STRONG_TAGS, WEAK_TAGS = frozenset("nav footer aside menu dialog".split()), frozenset("form search".split())
STRONG_ROLES, WEAK_ROLES = frozenset("navigation contentinfo complementary dialog alertdialog alert menu menubar toolbar".split()), frozenset("banner search form".split())
# Words of class and id names.
STRONG_WORDS = frozenset("comment comments commentlist disqus ad ads adbox adslot adunit adsbygoogle adsense advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr".split())
WEAK_WORDS = frozenset(
    "alert nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar footer masthead topbar banner promo notice popup modal overlay newsletter subscribe signup share sharing social related recommended "
    "recommendations trending widget widgets toolbar pagination pager skip skiplink login search replies respond tags".split()
)
MAIN_NAMES = frozenset({"article-body", "articlebody", "article-content", "post-body", "post-content", "entry-content", "main-content", "story-body"})
CONTENT_NAMES = frozenset({"content", "main", "article", "post", "story", "entry", "maincontent", "page-content", "article-text", "main-text"})

_NONE, _WEAK, _STRONG = 0, 1, 2


def _judge(name: str, attributes: str, inside: bool) -> tuple[int, int]:
    """(how strongly the tag says furniture, how strongly it says main text)."""
    mark = _STRONG if name in STRONG_TAGS else _WEAK if name in WEAK_TAGS or (name == "header" and not inside) else _NONE
    main = _STRONG if name == "main" else _NONE
    if not attributes or attributes.isspace():
        return mark, main
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "role":
            role = value.strip().lower()
            mark = max(mark, _STRONG if role in STRONG_ROLES else _WEAK if role in WEAK_ROLES and not inside else _NONE)
            main = _STRONG if role == "main" else main
        elif key == "itemprop":
            main = _STRONG if value == "articleBody" else main
            mark = _STRONG if value == "comment" else mark
        elif key in ("class", "id"):
            names = value.lower().replace("_", "-").split()
            main = _STRONG if any(v in MAIN_NAMES for v in names) else max(main, _WEAK) if any(v in CONTENT_NAMES for v in names) else main
            if name == "article":  # blogs put all they know of an article into its class
                mark = _STRONG if any(v in STRONG_WORDS for v in names) else mark
                continue
            words = {w.lower() for w in _WORD.findall(value)}
            if words & STRONG_WORDS:
                mark = _STRONG
            elif words & WEAK_WORDS or (not inside and "header" in words):
                mark = max(mark, _WEAK)
    return mark, main if mark == _NONE else _NONE


def blocks_of(page: str | None) -> list[tuple[str, int]]:
    """(text, ARTICLE, OPEN or FURNITURE) of each block of a page, in order."""
    if not page:
        return []
    found: list[tuple[str, bool, bool, int]] = []  # text, in an article, in main, mark
    pieces: list[str] = []
    stack: list[tuple[str, int, int, int, int]] = []  # open elements that matter, with articles, mains, mark and unread around them
    held: Counter[str] = Counter()
    articles = mains = mark = unread = 0

    def flush() -> None:
        if pieces:
            text = "".join(pieces)
            pieces.clear()
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                found.append((text, articles > 0, mains > 0, mark))

    def close(name: str) -> None:
        nonlocal articles, mains, mark, unread
        while stack:
            own, articles, mains, mark, unread = stack.pop()
            held[own] -= 1
            if own == name:
                return

    at, end = 0, page.rfind(">") + 1  # behind the last > there are no whole tags
    while at < end:
        m = _TAG.search(page, at, end)
        if m is None:
            break
        if not unread and m.start() > at:
            pieces.append(page[at : m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            if at == end and m[0].startswith("<!--") and not m[0].endswith("-->"):
                at = len(page)
            continue
        if name in BLOCK:
            flush()
        if m[1] or m[4]:
            if held[name]:
                close(name)
            continue
        if name == "br":
            pieces.append(" ")
            continue
        if name in BLOCK:
            if held["p"]:
                k = len(stack) - 1
                while stack[k][0] not in BLOCK:
                    k -= 1
                if stack[k][0] == "p":
                    close("p")
            ends, holders = CLOSES.get(name, ((), ()))
            for k in range(len(stack) - 1, max(-1, len(stack) - 9), -1) if ends else ():  # an unclosed element stands close above
                if stack[k][0] in holders:
                    break
                if stack[k][0] in ends:
                    close(stack[k][0])
                    break
        if name in VOID:
            continue
        if name in RAW:
            closing = RAW[name].search(page, at)
            at = closing.start() if closing else len(page)
            continue
        said, main = _judge(name, m[3] or m[6] or "", articles > 0 or mains > 0) if name not in ("html", "body") else (_NONE, _NONE)
        if said or main or name in BLOCK or name in UNREAD:
            stack.append((name, articles, mains, mark, unread))
            held[name] += 1
            if name == "article" and mark != _STRONG and said != _STRONG:
                articles, mark = articles + 1, mark if articles else _NONE
            elif main and mark < main and not articles:
                mains, mark = mains + 1, _NONE
            else:
                mark = max(mark, said)
            unread += name in UNREAD
    if not unread and at < len(page):
        torn = re.compile(r"<[A-Za-z/!?]").search(page, max(at, end))
        pieces.append(page[at : torn.start() if torn else len(page)])
    flush()
    has_article = any(a for _, a, _, w in found if not w)
    has_main = any(b for _, _, b, w in found if not w)
    return [(text, FURNITURE if w else ARTICLE if (a if has_article else b and has_main) else OPEN) for text, a, b, w in found]
