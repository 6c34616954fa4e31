"""A small HTML reader: element tree in document order, and its text runs.

Comments, scripts and styles never give text; void elements have no content;
a new paragraph, list item or table part ends an open one; end tags without a
match are ignored and elements left open end with their parent.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

_TAG = re.compile(
    r"<(?:!--(?:.*?--!?>|.*\Z)|(/?)([a-zA-Z][^\s/>]*)((?:(?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+>)|[^>]*+(?:>|\Z))|[!?][^>]*+(?:>|\Z))",
    re.S,
)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role|data-y)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

# Element names by what HTML says of them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noscript template xmp".split())
SILENT = frozenset("script style textarea title iframe noscript template xmp head svg math canvas object audio video select button".split())
BLOCK = frozenset(
    "html body article main section nav header footer aside div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "form fieldset legend blockquote pre figure figcaption address details summary dialog hr center menu hgroup search".split()
)
_ENDS_P = BLOCK - frozenset("html body td th tr thead tbody tfoot caption li dt dd legend summary figcaption".split())
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_FENCE = frozenset("ul ol dl table html body div article section".split())
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


@dataclass
class Page:
    """Elements in document order: parallel lists. ``end`` is one past an
    element's last descendant. Text runs are ``(element, text, block)``: runs
    of one block number stand in one block."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    end: list[int] = field(default_factory=list)
    names: list[list[str]] = field(default_factory=list)
    label: list[str | None] = field(default_factory=list)
    runs: list[tuple[int, str, int]] = field(default_factory=list)


def parse(html: str, labelled: bool = True) -> Page:
    """``labelled``: ``data-y`` is a label, as in layouts made for learning;
    otherwise an attribute like any other."""
    page, block, silent = Page(), 0, 0
    stack: list[int] = []
    tags, ends = page.tag, page.end

    def open_(name: str, attributes: str) -> None:
        names, label = [], None
        if "=" in attributes:
            for m in _NAMES.finditer(attributes):
                value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4]
                if m[1].lower() == "data-y":
                    label = value if labelled else None
                else:
                    names += [t.lower() for t in _TOKEN.findall(value)]
        tags.append(name)
        page.parent.append(stack[-1] if stack else -1)
        ends.append(len(tags))
        page.names.append(names)
        page.label.append(label)

    def close_to(depth: int) -> None:
        nonlocal silent
        for i in stack[depth:]:
            ends[i] = len(tags)
            silent -= tags[i] in SILENT
        del stack[depth:]

    open_("#page", "")
    stack.append(0)
    at, size = 0, len(html)
    while at < size:
        m = _TAG.search(html, at)
        text = html[at : m.start()] if m else html[at:]
        if text and not silent:
            page.runs.append((stack[-1], unescape(text) if "&" in text else text, block))
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if name in BLOCK:
            block += 1
        if m[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if tags[stack[depth]] == name:
                    close_to(depth)
                    break
            continue
        if name == "br" and not silent:
            page.runs.append((stack[-1], " ", block))
        if name in _ENDS_P or name in _ENDS:
            ended = _ENDS.get(name, ("p",))
            for depth in range(len(stack) - 1, 0, -1):
                inside = tags[stack[depth]]
                if inside in ended or inside == "p":
                    close_to(depth)
                    break
                if inside in _FENCE:
                    break
        open_(name, m[3])
        if name in VOID:
            continue
        stack.append(len(tags) - 1)
        silent += name in SILENT
        if name in RAW:
            stop = _RAW_END[name].search(html, at)
            at = stop.start() if stop else size
    close_to(0)
    return page


def blocks_of(page: Page, keep: list[bool]) -> str:
    """The kept elements' own text: white space inside a block becomes one
    space, blocks are trimmed and joined by newlines, empty ones left out."""
    lines, held, block = [], [], -1
    for owner, text, b in page.runs:
        if b != block:
            lines.append(" ".join("".join(held).split()))
            held, block = [], b
        if keep[owner]:
            held.append(text)
    lines.append(" ".join("".join(held).split()))
    return "\n".join(x for x in lines if x)
