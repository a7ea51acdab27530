"""Leaf blocks of an HTML page: text, ancestors and link share.

A block is a run of text between block-level boundaries.  The reader is forgiving: unclosed and
stray tags, unquoted attributes and unfinished comments or scripts are taken as they come.
"""

import html
import re
from dataclasses import dataclass

# Fixed values of HTML: elements by how they break text.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section select summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# An opening tag ends these open elements (up to the element that holds them).
ENDS = {
    "li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr", ("table",)),
    "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",)),
}

_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)
      | <(?:svg|object|iframe)\b(?:"[^"]*"|'[^']*'|[^>"'])*/>
      | <(script|style|noscript|template|textarea|iframe|svg|object)\b(?:"[^"]*"|'[^']*'|[^>"'])*>.*?(?:</\1\s*>|\Z)
      | <[!?][^>]*(?:>|\Z)
      | <(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*)>""",
    re.VERBOSE | re.DOTALL | re.IGNORECASE,
)
_NAMES = re.compile(r"""\b(class|id|role|aria-label|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:[\s=]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE)
_PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


@dataclass
class Block:
    """Text with single spaces; the path of (tag, name pieces) above it; its share of linked characters."""

    text: str
    path: tuple
    linked: float


def _names(attributes: str) -> tuple:
    if not attributes or attributes.isspace():
        return ()
    found = [p.lower() for m in _NAMES.finditer(attributes) for p in _PIECES.findall(m[2] or m[3] or m[4] or "")]
    if _HIDDEN.search(attributes):
        found.append("hidden")
    return tuple(found)


def blocks(page: str | None) -> list[Block]:
    """The blocks of a page in order; none for null, empty or text-free pages."""
    page = page or ""
    found: list[Block] = []
    stack: list[tuple] = []
    pieces: list[str] = []
    plain = linked = links = 0

    def end_block():
        nonlocal plain, linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                found.append(Block(text, tuple(stack), linked / max(1, plain)))
            pieces.clear()
        plain = linked = 0

    def close(at):
        nonlocal links
        links -= sum(tag == "a" for tag, _ in stack[at:])
        del stack[at:]

    def add(raw):
        nonlocal plain, linked
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            size = len(text) - text.count(" ")
            plain += size
            linked += size if links else 0

    last = 0
    for match in _MARKUP.finditer(page):
        add(page[last : match.start()])
        last = match.end()
        if not match[3]:
            continue
        tag = match[3].lower()
        breaks = tag in BLOCK
        if breaks:
            end_block()
        elif tag == "br":
            pieces.append(" ")
        if match[2]:
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] == tag:
                    close(at)
                    break
            continue
        if breaks:
            ended, within = ENDS.get(tag, ("", ()))
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] in within:
                    break
                if stack[at][0] == "p" or stack[at][0] in ended.split():
                    close(at)
                    break
        if tag not in VOID and not match[4].endswith("/"):
            stack.append((tag, _names(match[4])))
            links += tag == "a"
    add(page[last:])
    end_block()
    return found
