"""Text blocks of an HTML page, each with the kind of place it stands in.

A scanner for real pages: unclosed and misnested tags, truncated ends, comments,
raw-text elements and character references without a semicolon are all fine. It takes
linear time and never fails.

Elements and roles of boilerplate (navigation, footers, asides, dialogs) are strong: what they
hold is out. Class words and forms are weak: they never apply to ``html``, ``body``, ``main`` or
``article``, only whole tokens of few words count inside main text, and a main or article element
inside a weak one is main text if the page has no other.
"""

from __future__ import annotations

import html
import re

#: Places, worst first: boilerplate; boilerplate by a class word or form; no sign either way; a first-level
#: heading without a sign; a main or content element; an article.
OUT, WEAK, LOOSE, TITLE, MAIN, ARTICLE = range(6)
#: A main or article element inside a weak place, until the page's end tells which it is.
_HELD = 6

# Element names and class words of common page templates.
_DROPPED = frozenset("script style noscript template title head iframe svg math canvas object audio video textarea select button datalist map".split())
_OUT_TAGS = frozenset("nav footer aside dialog menu fieldset".split())
_BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSED_BY_BLOCK = frozenset("p dt dd li td th tr option".split())
_WHOLE_PAGE = frozenset("html body".split())
_TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th caption figcaption a b i em strong".split())
_OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
_OUT_WORDS = frozenset("ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion promotions banner cookie cookies consent gdpr notice notices notification alert newsletter subscribe subscription signup popup modal overlay lightbox sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer foot masthead topbar toolbar comment comments commentlist disqus reply replies respond share sharing social related recommended recommendations widget widgets login search pagination pager copyright legal".split())
_OUT_IN_MAIN = frozenset("ad ads advert adverts advertisement advertising adsense sponsored promo newsletter subscribe share sharing share-buttons social social-share comment comments comment-list comments-area commentlist disqus disqus_thread respond related-posts related-articles".split())
_COMMENT_WORDS = frozenset("comment comments comment-body reply".split())
_OUT_UNLESS_INSIDE = frozenset({"header"})
#: First or last parts of tokens that speak of the page's layout, not of the element.
_LAYOUT_FIRST = frozenset("no has with without hide show single".split())
_LAYOUT_LAST = frozenset("open closed layout enabled disabled".split())
_MAIN_WORDS = frozenset("content main article article-body article-content articlebody post-content post-body entry-content main-content story-body page-content story".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[a-zA-Z/!?][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_NONE_SHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORDS = re.compile(r"[^\s]+")
_PARTS = re.compile(r"[-_:]+|(?<=[a-z])(?=[A-Z])")


def _boilerplate(tag: str, name: str, token: str, now: int) -> bool:
    """Whether a class or id token says that its element is boilerplate."""
    low = token.lower()
    if now >= MAIN:
        return tag not in _TEXT_TAGS and low in _OUT_IN_MAIN
    if tag in _TEXT_TAGS:
        return name == "class" and low in _OUT_WORDS
    parts = [x.lower() for x in _PARTS.split(token) if x]
    if len(parts) > 1 and (parts[0] in _LAYOUT_FIRST or parts[-1] in _LAYOUT_LAST):
        return False
    return low in _OUT_WORDS or not _OUT_WORDS.isdisjoint(parts) or (low not in _MAIN_WORDS and not _OUT_UNLESS_INSIDE.isdisjoint(parts))


def _place(tag: str, attributes: str, now: int) -> int | None:
    """The place that an element opens; None if it changes nothing."""
    if tag in _OUT_TAGS or (tag == "header" and now < MAIN) or (tag == "form" and now >= MAIN):
        return OUT
    if tag in _WHOLE_PAGE:
        return None
    main = tag in ("article", "main")
    found = ARTICLE if tag == "article" else MAIN if tag == "main" else LOOSE
    weak = tag == "form"
    if attributes and not attributes.isspace():
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _NONE_SHOWN.search(value)):
                return OUT
            if name == "role":
                if value.lower() in _OUT_ROLES and not main:
                    return OUT
                found = max(found, {"main": MAIN, "article": ARTICLE}.get(value.lower(), LOOSE))
            elif name in ("class", "id"):
                for token in _WORDS.findall(value):
                    if main:
                        weak |= tag == "article" and token.lower() in _COMMENT_WORDS
                    elif _boilerplate(tag, name, token, now):
                        weak = True
                    elif token.lower() in _MAIN_WORDS:
                        found = max(found, MAIN)
    if weak:
        return WEAK if now != WEAK else None
    if found < MAIN:
        return None
    if now in (WEAK, _HELD):
        return _HELD if now == WEAK else None
    return found if found > now else None


def blocks(page: str) -> tuple[bool, list[tuple[int, str]]]:
    """(whether the page marks its main text, (place, text) of every block with text).

    Blocks are in page order; references are decoded, white space made single spaces.
    """
    out: list[tuple[int, str]] = []
    held: list[str] = []
    held_at = LOOSE
    #: open elements that matter: (tag, place inside); depth of like-named ones inside them is counted
    stack: list[list] = []
    now = LOOSE
    heading = marked = held_main = False
    at, end = 0, len(page)

    def flush() -> None:
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if text:
                out.append((held_at, text))

    while at < end:
        m = _TAG.search(page, at)
        stop = m.start() if m else end
        if stop > at:
            here = TITLE if heading and now == LOOSE else now
            if held and held_at != here:
                flush()
            held_at = here
            held.append(page[at:stop])
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag in _BLOCKS:
            flush()
            heading = tag == "h1" and not m[1]
        if m[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    if stack[i][2]:
                        stack[i][2] -= 1
                    else:
                        flush()
                        del stack[i:]
                        now = stack[-1][1] if stack else LOOSE
                    break
            continue
        if tag in _DROPPED:
            if tag == "head" or m[3].endswith("/"):
                continue
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if tag in _VOID or m[3].endswith("/"):
            continue
        if tag in _BLOCKS and stack and stack[-1][0] in _CLOSED_BY_BLOCK and (tag == stack[-1][0] or stack[-1][0] == "p"):
            stack.pop()
            now = stack[-1][1] if stack else LOOSE
        place = _place(tag, m[3], now) if now != OUT else None
        if place is not None:
            flush()
            stack.append([tag, place, 0])
            now = place
            marked |= MAIN <= place < _HELD
            held_main |= place == _HELD
        elif stack and stack[-1][0] == tag:
            stack[-1][2] += 1
    flush()
    if held_main:
        told = ARTICLE if not any(MAIN <= p < _HELD for p, _ in out) else WEAK
        out = [(told if p == _HELD else p, t) for p, t in out]
    return marked or held_main, out
