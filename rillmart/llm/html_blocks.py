"""HTML text blocks in page order, each with what its markup says about it."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

# Names of HTML elements by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|textarea|title"
#: Elements whose content is no text of the page, as far as they are closed.
OPAQUE = frozenset("noscript template iframe svg object canvas audio video select".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table "
    "tbody td tfoot th thead tr ul".split())
CHROME = frozenset("nav footer aside form dialog menu search head button".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Words in a class or an id that mark page furniture.
CHROME_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense banner sponsor sponsored promo promotion promoted nav navbar "
    "navigation menu submenu breadcrumb breadcrumbs masthead footer sidebar aside widget related recommended recommendations share sharing "
    "social newsletter subscribe subscription signup login cookie cookies consent gdpr notice notices alert popup modal overlay comment "
    "comments commentlist disqus reply replies respond pagination pager toolbar copyright disclaimer teaser outbrain taboola feedback".split())
#: Words that only say what shape a thing has: what stands before them says what it is.
SHAPE_WORDS = frozenset(
    "area bar block body bottom box button buttons card cards center col column container content count counter cta form grid group header heading "
    "icon icons image img inline inner item items label large left link links list main mobile module outer panel post posts primary right row "
    "secondary section slot small stories story strip tab tabs text thread title top unit widget wrap wrapper zone".split())
#: Elements that a new element of the same kind closes.
CLOSED_BY_OWN = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
SAME_KIND = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>", re.S | re.I)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|([^\s=\"'/>]+)", re.S)
#: Names that tell of a page's layout or of a post's topics, not of what an element is.
_ABOUT = re.compile(r"(?<!\S)(?:has|no|with|without|category|tag)(?:[-_]|(?=[A-Z]))\S*")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


class Block(NamedTuple):
    text: str
    chrome: bool  # the markup calls it page furniture
    level: int  # 2 inside an article, 1 inside a main part, 0 elsewhere


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c, bare in _ATTRIBUTE.findall(raw):
        out.setdefault((name or bare).lower(), a or b or c)
    return out


def _names_furniture(names: str) -> bool:
    """Whether a class or id is a word of furniture itself, and not only made of one: share-links is, share-prices is not."""
    for name in names.split():
        words = [w.lower() for w in _WORDS.findall(name)]
        while len(words) > 1 and words[-1] in SHAPE_WORDS and words[-1] not in CHROME_WORDS:
            words.pop()
        if words and words[-1] in CHROME_WORDS:
            return True
    return False


def _state(tag: str, raw: str, chrome: bool, level: int) -> tuple[bool, int]:
    """Whether an element is furniture, and its level, from its own markup and its parent's."""
    at = _attributes(raw) if "=" in raw or "hidden" in raw else {}
    names = _ABOUT.sub("", f"{at.get('class', '')} {at.get('id', '')}") if at else ""
    words = {w.lower() for w in _WORDS.findall(names)}
    role = at.get("role", "").lower() if at else ""
    # Inside the main part names are also about the matter of the text, so there the word has to be what is named.
    marked = bool(words & CHROME_WORDS) and tag not in ("html", "body") and (not level or _names_furniture(names))
    own = 2 if tag == "article" or role == "article" or at.get("itemprop") == "articleBody" else 1 if tag == "main" or role == "main" else 0
    if own and not (marked and (chrome or level == 2)):
        # Words mark an article only within another one or within furniture, as with the comments of readers.
        # An article within furniture, such as a wrapper named after its sidebar, is no furniture itself.
        return (chrome and level > 0), max(level, own)
    hidden = "hidden" in at or at.get("aria-hidden") == "true" or "display:none" in at.get("style", "").replace(" ", "").lower()
    page_header = (tag == "header" or "header" in words) and not level and tag not in ("html", "body")
    return chrome or marked or hidden or page_header or tag in CHROME or role in CHROME_ROLES, level


def _opaque_ends(tokens: list[re.Match[str]]) -> dict[int, int]:
    """Start tags of opaque elements and their end tags, by place; one that is empty or never closed is not among them."""
    opened: dict[str, list[int]] = {}
    ends: dict[int, int] = {}
    for i, m in enumerate(tokens):
        tag = (m[3] or m[6] or "").lower()
        if tag not in OPAQUE:
            continue
        if m[2] or m[5]:
            if opened.get(tag):
                ends[opened[tag].pop()] = i
        elif not (m[4] or m[7] or "").rstrip().endswith("/"):
            opened.setdefault(tag, []).append(i)
    return ends


def blocks(page: str) -> list[Block]:
    """All non-empty blocks: character references decoded, white space made one space, trimmed."""
    out: list[Block] = []
    stack: list[tuple[str, bool, int]] = []
    chrome, level = False, 0
    parts: list[tuple[str, bool]] = []

    def end() -> None:
        """Close the block: its text, and apart from it what inline furniture it holds."""
        if parts:
            for furniture in (False, True):
                text = " ".join(html.unescape("".join([t for t, c in parts if c == furniture])).split())
                if text:
                    out.append(Block(text, furniture, level))
            parts.clear()

    def enter(inner: tuple[bool, int]) -> None:
        nonlocal chrome, level
        if inner[1] != level:
            end()
        chrome, level = inner

    def close(kinds: tuple[str, ...], within: tuple[str, ...]) -> None:
        """Close the nearest open element of these kinds, not looking beyond ``within``."""
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in kinds:
                del stack[i:]
                enter((stack[-1][1], stack[-1][2]) if stack else (False, 0))
                return
            if stack[i][0] in within:
                return

    at, hidden_to = 0, -1
    tokens = list(_TOKEN.finditer(page))
    ends = _opaque_ends(tokens)
    for n, m in enumerate(tokens):
        if n <= hidden_to:
            at = m.end()
            continue
        if m.start() > at:
            parts.append((page[at:m.start()], chrome))
        at = m.end()
        tag = (m[3] or m[6] or "").lower()
        if not tag:
            continue
        if tag in OPAQUE:
            hidden_to = ends.get(n, -1)
            continue
        raw, block = m[4] or m[7] or "", tag in BLOCKS
        if block:
            end()
        if m[2] or m[5]:
            if tag not in VOID:
                close((tag,), () if block else ("article", "main", "body"))
        elif tag in VOID:
            if tag == "br":
                parts.append((" ", chrome))
        else:
            if block and tag not in ("html", "head", "body"):
                close(("p",), ("article", "main", "section", "div", "li", "td", "th", "blockquote", "body", "table"))
            if tag in CLOSED_BY_OWN:
                close(SAME_KIND.get(tag, (tag,)), CLOSED_BY_OWN[tag])
            inner = _state(tag, raw, chrome, level)
            if not raw.rstrip().endswith("/") or block:
                stack.append((tag, *inner))
                enter(inner)
    if at < len(page):
        parts.append((page[at:], chrome))
    end()
    return out
