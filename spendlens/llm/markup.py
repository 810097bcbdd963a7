"""Reads a page of HTML, however broken, into blocks of text with their place in the page."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
# an opening tag ends an open element of these names
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDERS = frozenset("ul ol menu dl table tbody thead tfoot select".split())

# elements and names that never hold the article
ASIDE_TAGS = frozenset("nav footer aside form noscript button select dialog template svg head menu".split())
# whole names of classes and ids
ASIDE_NAMES = frozenset(
    "nav navbar navigation menu footer sidebar ad ads advert adverts advertisement banner sponsor sponsored promo cookie cookies "
    "consent notice notices alert popup modal newsletter subscribe social share sharing related recommended comment comments "
    "respond replies breadcrumb breadcrumbs pagination pager widget skip login search "
    "site-nav main-nav top-nav page-nav primary-nav site-navigation main-navigation primary-navigation post-navigation nav-bar "
    "nav-menu nav-links main-menu top-menu site-menu primary-menu menu-bar site-footer page-footer main-footer footer-links "
    "footer-widgets site-sidebar main-sidebar page-sidebar primary-sidebar sidebar-widget widget-area ad-banner ad-slot ad-box "
    "ad-unit ad-container ad-wrapper banner-ad google-ad cookie-notice cookie-banner cookie-bar cookie-consent cookies-notice "
    "consent-banner newsletter-signup newsletter-form related-posts related-articles related-links recommended-posts share-bar "
    "share-links share-buttons sharing-buttons social-links social-share social-icons comment-list comment-body comment-form "
    "comment-respond comments-area comments-list comments-section disqus-thread skip-link login-form search-form search-box search-bar".split()
)
# of these, what readers and advertisers add within an article; other ids there are anchors of its sections
READER_NAMES = frozenset(
    "comment comments respond replies comment-list comment-body comment-form comment-respond comments-area comments-list "
    "comments-section disqus-thread".split()
)
WITHIN_IDS = READER_NAMES | frozenset("ad ads advert adverts advertisement ad-banner ad-slot ad-box ad-unit ad-container banner-ad".split())
ANCHORS = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd td th tr a span caption figure blockquote pre".split())  # their ids name a topic
OUTSIDE_NAMES = frozenset("header masthead topbar toolbar site-header page-header main-header".split())  # unless within the article
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())


@dataclass
class Block:
    """Text of one block: its place, whether it is within an article or beside it, and how much of it is links."""

    path: str
    text: str
    main: bool
    aside: bool
    linked: int


def _names(value: str) -> set[str]:
    """Whole names in lower case, words joined by hyphens, without a number at the end."""
    return {re.sub(r"-?\d+$", "", _HUMP.sub("-", n).replace("_", "-").lower()) for n in value.split()}


@lru_cache(maxsize=10_000)
def _kind(tag: str, attributes: str, within: bool) -> tuple[str, bool, bool, bool, bool]:
    """Name for paths; whether the element is an article, stands beside it by its tag or role, does so by its names,
    or only outside of an article. Names of the page and of an article itself say nothing, but for a reader's comment
    within an article."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    marks = " ".join(found.get(k, "") for k in ("class", "id"))
    classes, ids = _names(found.get("class", "")), _names(found.get("id", ""))
    role = found.get("role", "").lower()
    main = tag in ("article", "main") or role in ("main", "article")
    if tag in ("html", "body") or main:
        classes, ids = (classes & READER_NAMES, set()) if within and tag != "main" else (set(), set())
    elif tag in ANCHORS:
        ids = set()
    elif within or tag == "section" or "section" in classes:
        ids = ids & WITHIN_IDS
    aside = (tag in ASIDE_TAGS and tag != "form") or role in ASIDE_ROLES
    named = tag == "form" or bool((classes | ids) & ASIDE_NAMES)
    outside = tag == "header" or bool((classes | ids) & OUTSIDE_NAMES)
    label = re.sub(r"\d+", "0", "".join(f".{n}" for n in sorted(marks.split())))
    return tag + label, main and not aside and not named, aside, named, outside


def blocks(html: str) -> tuple[list[Block], list[str]]:
    """The blocks of a page in order, and the path of every element.

    Names that would set an element aside do not count where it holds ``main``, or where no article stands outside of
    such elements and it holds one.
    """
    stack: list[tuple[str, str, bool, int]] = []  # tag, path, main, number of the element
    out: list[Block] = []
    owner: list[int] = []  # of each block
    paths: list[str] = []
    above_of, aside_of, named_of = [-1], [False], [False]  # of each element; 0 is the page
    mains: list[int] = []
    articles: list[int] = []
    held: list[str] = []
    linked, links, at, end = 0, 0, 0, len(html)

    def flush() -> None:
        nonlocal held, linked
        if held:
            text = " ".join("".join(held).split())
            if text:
                _, path, main, element = stack[-1] if stack else ("", "", False, 0)
                out.append(Block(path, text, main, False, linked))
                owner.append(element)
            held, linked = [], 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            text = unescape(text)
            held.append(text)
            if links:
                linked += len(text)

    def pop(to: int) -> None:
        nonlocal links
        flush()
        links -= sum(1 for e in stack[to:] if e[0] == "a")
        del stack[to:]

    while at < end:
        token = _TOKEN.search(html, at)
        if token is None:
            add(html[at:])
            break
        add(html[at : token.start()])
        at = token.end()
        closing, tag, attributes = (token[1], token[2], token[3]) if token[2] else (token[4], token[5], token[6])
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            place = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if place is not None:
                if tag in BLOCK or any(e[0] in BLOCK for e in stack[place:]):
                    pop(place)
                else:
                    links -= tag == "a"
                    del stack[place]
            continue
        if tag in RAW:
            close = re.compile(f"</{tag}[^>]*>", re.I).search(html, at)
            at = close.end() if close else end
            continue
        if tag == "br":
            held.append(" ")
        if tag in BLOCK:
            flush()
            if tag in ENDS:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in HOLDERS and not (tag == "tr" and stack[i][0] in ("td", "th")):
                        break
                    if stack[i][0] in ENDS[tag]:
                        pop(i)
                        break
            else:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == "p":
                        pop(i)
                        break
                    if stack[i][0] in BLOCK:
                        break
        if tag in VOID:
            continue
        above = stack[-1] if stack else ("", "", False, 0)
        label, article, aside, named, outside = _kind(tag, attributes, above[2])
        main = article or above[2]
        element = len(above_of)
        above_of.append(above[3])
        aside_of.append(aside)
        named_of.append(named or (outside and not main))
        if article and not above[2]:
            (articles if tag == "article" else mains).append(element)
        path = f"{above[1]}/{label}" if tag in BLOCK else above[1]
        if tag in BLOCK:
            paths.append(path)
        stack.append((tag, path, main, element))
        links += tag == "a"
    flush()
    _spare(above_of, aside_of, named_of, mains, articles)
    for element in range(1, len(above_of)):
        aside_of[element] = aside_of[element] or named_of[element] or aside_of[above_of[element]]
    for block, element in zip(out, owner):
        block.aside = aside_of[element]
    return out, paths


def _spare(above_of: list[int], aside_of: list[bool], named_of: list[bool], mains: list[int], articles: list[int]) -> None:
    """Takes back names of elements that hold the page's article."""

    def over(element: int) -> list[int]:
        out = []
        while (element := above_of[element]) > 0:
            out.append(element)
        return out

    for element in mains:
        for e in over(element):
            named_of[e] = False
    if not any(named_of):
        return
    free = [e for e in mains + articles if not any(aside_of[a] or named_of[a] for a in over(e))]
    for element in [] if free else articles:
        if not any(aside_of[a] for a in over(element)):
            for e in over(element):
                named_of[e] = False
            break
