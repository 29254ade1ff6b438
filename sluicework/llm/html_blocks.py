"""A page as elements and blocks of text, read from HTML of any quality."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import xxhash

# Names of HTML elements by what they do to text.
_RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HEAD = frozenset("base link meta noscript script style template title".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_BLOCKS = _HEADINGS | frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " head header hgroup html li main menu nav noscript object ol optgroup option p pre search section select summary svg table tbody td"
    " template tfoot th thead tr ul video audio canvas".split()
)
_BOILERPLATE = frozenset(
    "aside audio button canvas dialog footer head header menu nav noscript object search select svg template video".split()
)
#: An end tag may be left out: what an element ends when it starts, and what holds it back.
_ENDS = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir".split())),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"])),
    "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "tr": (frozenset("tr td th caption".split()), frozenset(["table"])),
    "td": (frozenset("td th".split()), frozenset("table tr".split())),
    "th": (frozenset("td th".split()), frozenset("table tr".split())),
    "tbody": (frozenset("thead tbody tr td th caption".split()), frozenset(["table"])),
    "thead": (frozenset("tr td th caption".split()), frozenset(["table"])),
    "tfoot": (frozenset("thead tbody tr td th".split()), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
#: Words in a class, id or role by which authors name what is not the article.
_NAMES = re.compile(
    r"(?:ad|ads|adbox|adsense|advert\w*|alert|banner|breadcrumbs?|comment\w*|consent|contentinfo|cookies?|cookiebar|disqus|footer|gdpr"
    r"|login|menu\w*|modal|nav|navbar|navigation|newsletter|notices?|overlay|pager|pagination|popup|promo\w*|recommend\w*"
    r"|related|replies|respond|search|share|sharing|sidebar\w*|signup|social|sponsor\w*|subscribe|subscription|toolbar|topbar|widgets?)"
)
#: Inside an article a header is its own.
_HEADER_NAMES = frozenset("header masthead".split())

ARTICLE, MAIN = 2, 1

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)"
    # Attributes with balanced quotes, of bounded number and length; else up to the next bracket.
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>\"']*+(?:(?:\"[^\"]{0,20000}+\"|'[^']{0,20000}+')[^>\"']*+){0,200}+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
_NAMED = re.compile(r"""(?:^|\s)(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_KNOWN_PATHS = 100_000

_paths: dict[tuple[int, str], int] = {}


def _path(parent: int, name: str) -> int:
    """A signed 64-bit number of the names from the root down."""
    known = _paths.get((parent, name))
    if known is None:
        if len(_paths) >= _KNOWN_PATHS:
            _paths.clear()
        known = xxhash.xxh3_64_intdigest(f"{parent}>{name}".encode("utf-8", "replace")) - (1 << 63)
        _paths[parent, name] = known
    return known


def text_token(path: int, text: str) -> int:
    """A number of a block's text in its place."""
    return xxhash.xxh3_64_intdigest(f"{path}:{text}".encode("utf-8", "replace")) - (1 << 63)


@dataclass
class Page:
    """Elements in page order, with the number of their parent, and blocks of text."""

    tags: list[str] = field(default_factory=list)
    paths: list[int] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    #: 0, or that the element is no part of the article: 1 by its tag, 2 by its name.
    kinds: list[int] = field(default_factory=list)
    ranks: list[int] = field(default_factory=list)
    #: Element, text and characters in links.
    blocks: list[tuple[int, str, int]] = field(default_factory=list)
    #: Of each block the number of elements that start before it.
    starts: list[int] = field(default_factory=list)

    def excluded(self) -> list[bool]:
        """Of each element whether it or one around it is no part of the article.

        An element that is so by its name alone stays if the article is in it: the longest
        element marked as one, if all are in such elements, or the heading if no text is left.
        """
        found = self._excluded(frozenset())
        if any(rank and not gone for rank, gone in zip(self.ranks, found, strict=True)):
            return found
        marked = [i for i, rank in enumerate(self.ranks) if rank and not self.kinds[i]]
        if marked:
            chars = [0] * len(self.tags)
            for element, text, _ in self.blocks:
                if element >= 0:
                    chars[element] += len(text)
            for i in range(len(self.tags) - 1, 0, -1):
                chars[self.parents[i]] += chars[i] if self.parents[i] >= 0 else 0
            inner = max(marked, key=lambda i: chars[i])
        elif any(element < 0 or not found[element] for element, _, _ in self.blocks) or "h1" not in self.tags:
            return found
        else:
            inner = self.tags.index("h1")
        around = set()
        while inner >= 0:
            around.add(inner)
            inner = self.parents[inner]
        return self._excluded(around)

    def _excluded(self, kept: frozenset[int] | set[int]) -> list[bool]:
        found: list[bool] = []
        for i, kind in enumerate(self.kinds):
            own = kind == 1 or kind == 2 and i not in kept
            found.append(own or self.parents[i] >= 0 and found[self.parents[i]])
        return found


def _described(tag: str, attributes: str) -> tuple[str, str, int]:
    """A name for the path, what the author's names tell of (``other`` than the article, its ``header`` or
    nothing), and the rank as an article."""
    rank = ARTICLE if tag == "article" else MAIN if tag == "main" else 0
    if "=" not in attributes:
        return tag, "", rank
    parts, words = [tag], []
    for key, *values in _NAMED.findall(attributes):
        value = html.unescape("".join(values))
        key = key.lower()
        if key == "itemprop":
            rank = max(rank, MAIN if value == "articleBody" else 0)
            continue
        if key == "role" and value.lower() in ("main", "article"):
            rank = max(rank, MAIN)
        # Names with digits in them are of one page.
        parts += sorted(f"{key}={w}" for w in value.split() if not any(c.isdigit() for c in w))
        words += [w.lower() for w in _WORD.findall(value)]
    if tag in ("html", "body", "main"):
        named = ""
    else:
        named = "other" if any(map(_NAMES.fullmatch, words)) else "header" if _HEADER_NAMES.intersection(words) else ""
    return " ".join(parts), named, rank


class _Reader:
    def __init__(self) -> None:
        self.page = Page()
        self.open: list[int] = []
        self.parts: list[str] = []
        self.in_link = 0
        self.link_chars = 0

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.page.blocks.append((self.open[-1] if self.open else -1, text, min(self.link_chars, len(text))))
                self.page.starts.append(len(self.page.tags))
            self.parts.clear()
        self.link_chars = 0

    def text(self, raw: str) -> None:
        raw = html.unescape(raw) if "&" in raw else raw
        self.parts.append(raw)
        if self.in_link:
            self.link_chars += len(raw)

    def start(self, tag: str, attributes: str) -> None:
        page, tags = self.page, self.page.tags
        if tag in ("html", "body") and any(tags[i] == tag for i in self.open):
            return
        self.flush()
        if self.open and tags[self.open[-1]] == "head" and tag not in _HEAD:
            self.open.pop()
        if self.open and tags[self.open[-1]] == "p":
            self.open.pop()
        if tag in _HEADINGS and self.open and tags[self.open[-1]] in _HEADINGS:
            self.open.pop()
        if tag in _ENDS:
            ended, fence = _ENDS[tag]
            for at in range(len(self.open) - 1, -1, -1):
                name = tags[self.open[at]]
                if name in fence:
                    break
                if name in ended:
                    del self.open[at:]
                    break
        name, named, rank = _described(tag, attributes)
        parent = self.open[-1] if self.open else -1
        if tag in _BOILERPLATE:
            kind = 1
        else:
            kind = 2 if named or tag == "form" else 0
        if (tag == "header" or named == "header") and any(page.ranks[i] for i in self.open):
            kind = 0
        if tag == "h1":  # a form around the heading is one around the page
            for i in self.open:
                page.kinds[i] *= tags[i] != "form"
        self.open.append(len(tags))
        tags.append(tag)
        page.paths.append(_path(page.paths[parent] if parent >= 0 else 0, name))
        page.parents.append(parent)
        page.kinds.append(kind)
        page.ranks.append(rank)

    def end(self, tag: str) -> None:
        self.flush()
        for at in range(len(self.open) - 1, -1, -1):
            if self.page.tags[self.open[at]] == tag:
                del self.open[at:]
                return


def read_page(source: str) -> Page:
    """Elements and blocks. Text in a block has one space for white space; a line break
    is white space; comments, scripts and styles are skipped; end tags may be missing."""
    reader, at, size = _Reader(), 0, len(source)
    lowered = None
    while at < size:
        found = _TAG.search(source, at)
        if not found:
            reader.text(source[at:])
            break
        if found.start() > at:
            reader.text(source[at : found.start()])
        at = found.end()
        closes, tag, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if closes:
            if tag == "a":
                reader.in_link = 0
            elif tag in _BLOCKS:
                reader.end(tag)
            elif tag == "br":
                reader.parts.append(" ")
        elif tag in _RAW:
            lowered = lowered or source.lower()
            end = lowered.find(f"</{tag}", at) if len(lowered) == size else source.find(f"</{tag}", at)
            at = size if end < 0 else end
        elif tag == "hr":
            reader.flush()
        elif tag == "br":
            reader.parts.append(" ")
        elif tag in _BLOCKS:
            reader.start(tag, attributes)
        elif tag == "a":
            reader.in_link = 1
    reader.flush()
    return reader.page
