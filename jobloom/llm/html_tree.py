"""A small reader of HTML: elements with their parents, and the text of the page between breaks, in linear time."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg textarea select title object canvas noframes xmp".split())
#: Of these, what runs to the end of the page where it is never closed; of the others only the tag goes.
TO_THE_END = frozenset("script style xmp iframe noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
#: What a start tag closes, up to the nearest element of the second set.
CLOSES = {
    "li": (frozenset(["li"]), frozenset("ul ol menu".split())),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])), "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])), "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])), "option": (frozenset(["option"]), frozenset(["select"])),
}
#: A paragraph is closed by a block that begins inside it, unless one of these lies between.
SCOPE = frozenset("table td th caption button object ul ol dl".split())
_name = re.compile(r"[a-zA-Z][^\s/>]*")
_attribute = re.compile(r"""\b(class|id|role|data-y)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)


@dataclass
class Page:
    """Elements in page order; element 0 is the page itself. Pieces are (element, text) or breaks (-1, "")."""

    tags: list[str] = field(default_factory=lambda: ["#page"])
    parents: list[int] = field(default_factory=lambda: [-1])
    attributes: list[str] = field(default_factory=lambda: [""])  # class, id and role
    answers: list[str] = field(default_factory=lambda: [""])  # data-y of labelled pages
    pieces: list[tuple[int, str]] = field(default_factory=list)


def read(source: str) -> Page:
    """The tree of a page. Raw-text elements (scripts, styles, fields) keep no text; comments and declarations vanish."""
    page = Page()
    open_ = [0]
    count: dict[str, int] = {}
    paragraphs = [0]  # open ones in each scope
    absent = {'"': len(source) + 1, "'": len(source) + 1}  # from where on a quote is known not to follow
    unclosed: set[str] = set()  # raw-text elements known to have no end any more
    at, size = 0, len(source)
    pieces, tags = page.pieces, page.tags

    def pop() -> str:
        tag = tags[open_.pop()]
        count[tag] -= 1
        if tag in SCOPE:
            paragraphs.pop()
        elif tag == "p":
            paragraphs[-1] -= 1
        if tag in BLOCK:
            pieces.append((-1, ""))
        return tag

    while at < size:
        start = source.find("<", at)
        if start < 0:
            start = size
        if start > at:
            pieces.append((open_[-1], html.unescape(source[at:start])))
        if start == size:
            break
        if source.startswith("<!--", start):
            end = source.find("-->", start + 4)
            at = size if end < 0 else end + 3
            continue
        if source.startswith(("<!", "<?"), start):
            end = source.find(">", start)
            at = size if end < 0 else end + 1
            continue
        closing = source.startswith("</", start)
        match = _name.match(source, start + 1 + closing)
        if not match:
            if closing:  # a bogus comment
                end = source.find(">", start)
                at = size if end < 0 else end + 1
            else:
                pieces.append((open_[-1], "<"))
                at = start + 1
            continue
        end = source.find(">", match.end())
        if end < 0:
            break  # an unfinished tag ends the page
        for quote in ('"', "'"):  # a bracket inside a quoted value does not end the tag
            while source.count(quote, match.end(), end) % 2 and f"={quote}" in source[match.end() : end] and end < absent[quote]:
                close = source.find(quote, end)
                after = source.find(">", close) if close >= 0 else -1
                if after < 0:
                    absent[quote] = end
                    break
                end = after
        tag = match.group().lower()
        at = end + 1
        if closing:
            if count.get(tag):
                while pop() != tag:
                    pass
            elif tag == "p" or tag in BLOCK:
                pieces.append((-1, ""))
            continue
        if tag == "br":
            pieces.append((open_[-1], " "))
            continue
        if tag in BLOCK:
            if paragraphs[-1]:
                while pop() != "p":
                    pass
            pieces.append((-1, ""))
        if tag in CLOSES:
            closed, bounds = CLOSES[tag]
            if any(count.get(c) for c in closed):
                for k in range(len(open_) - 1, 0, -1):
                    if tags[open_[k]] in closed:
                        while len(open_) > k:
                            pop()
                        break
                    if tags[open_[k]] in bounds:
                        break
        text = source[match.end() : end]
        found = _attribute.findall(text) if "=" in text else []
        page.answers.append(next((a + b + c for name, a, b, c in found if name.lower() == "data-y"), ""))
        tags.append(tag)
        page.parents.append(open_[-1])
        page.attributes.append(" ".join(a + b + c for name, a, b, c in found if name.lower() != "data-y"))
        if tag in VOID or text.endswith("/") and (tag == "svg" or tag not in BLOCK and tag not in RAW):
            continue
        if tag in RAW:
            close = None if tag in unclosed else re.compile(rf"</{re.escape(tag)}\b", re.IGNORECASE).search(source, at)
            if close is None:
                unclosed.add(tag)
                if tag in TO_THE_END:
                    break
                continue
            end = source.find(">", close.end())
            at = size if end < 0 else end + 1
            continue
        open_.append(len(tags) - 1)
        count[tag] = count.get(tag, 0) + 1
        if tag in SCOPE:
            paragraphs.append(0)
        elif tag == "p":
            paragraphs[-1] += 1
    return page
