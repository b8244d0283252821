"""Page markup as a small tree of block elements with the text runs between them."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

# Quotes count after an equals sign only, as in browsers; one that never closes is a character like any other.
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+)>")
_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)")
_ZEROS = re.compile(r"&#([xX]?)0+(?=[0-9a-fA-F])")
_TOO_LARGE = re.compile(r"&#(?:[xX][0-9a-fA-F]{7,}+|[0-9]{8,}+);?")
_ATTRIBUTE = re.compile(r"(class|id|role|style|hidden|aria-hidden|data-part)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Raw text up to the end tag, or to the end of the page where there is none.
RAW = frozenset("script style textarea title iframe".split())
#: Never text of a page: code, styles, embedded documents and the head's title. Those that are not raw and never
#: closed are as if they had no content.
SILENT = RAW | frozenset("noscript template object svg math canvas audio video select".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var button".split()
)
CONTROLS = frozenset("input select textarea button option".split())
_CLOSED_BY = {
    "p": frozenset(
        "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
        "hr li main menu nav ol p pre section table ul dd dt td th tr".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
}


@dataclass
class Block:
    """A block element, or a run of text beside block elements (tag ``#text``)."""

    tag: str
    parent: int
    depth: int
    attributes: str = ""
    children: list[int] = field(default_factory=list)
    runs: list[int] = field(default_factory=list)
    chars: int = 0
    links: int = 0
    tags: int = 0
    controls: int = 0
    marks: int = 0
    run_count: int = 0


@dataclass
class Page:
    """Blocks in page order, the root first; ``texts`` are the decoded runs, each owned by one block."""

    blocks: list[Block]
    texts: list[str]


def attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw)}


_TEXT, _OPEN, _CLOSE = 0, 1, 2


def _decoded(text: str) -> str:
    """Character references as characters; numbers beyond Unicode become the replacement character."""
    if "&" not in text:
        return text
    if "&#" in text:
        text = _TOO_LARGE.sub("\ufffd", _ZEROS.sub(r"&#\1", text))
    return unescape(text)


def _tokens(body: str) -> list[tuple[int, str, str]]:
    """Texts, start tags and end tags in order, without comments and raw text, in time linear in the page."""
    out: list[tuple[int, str, str]] = []
    at, end, last, quoted = 0, len(body), body.rfind(">"), True
    raw_end = {}
    while at < end:
        mark = body.find("<", at)
        if mark < 0:
            mark = end
        if mark > at:
            out.append((_TEXT, "", body[at:mark]))
        if mark == end:
            break
        at = mark
        ahead = body[at + 1 : at + 2]
        if ahead in ("!", "?"):
            if body.startswith("<!--", at) or body.startswith("<![CDATA[", at):
                close = "-->" if body[at + 2] == "-" else "]]>"
                stop = body.find(close, at + 4)
                at = end if stop < 0 else stop + 3
            elif at < last:
                at = body.index(">", at) + 1
            else:
                out.append((_TEXT, "", "<"))
                at += 1
            continue
        name = _NAME.match(body, at)
        if name is None:
            out.append((_TEXT, "", "<"))
            at += 1
            continue
        if at > last:  # a tag that never ends
            break
        tag = _TAG.match(body, at) if quoted else None
        if tag is None:
            # its quotes reach the end of the page: from here on a tag ends with the next bracket
            quoted = False
            stop = body.index(">", at)
            slash, word, rest = name[1], name[2], body[name.end() : stop]
        else:
            stop = tag.end() - 1
            slash, word, rest = tag[1], tag[2], tag[3]
        at, word = stop + 1, word.lower()
        out.append((_CLOSE if slash else _OPEN, word, rest))
        if word in RAW and not slash and not rest.endswith("/"):
            if word not in raw_end:
                raw_end[word] = re.compile(rf"</{word}\s*+>", re.I)
            gone = raw_end[word].search(body, at)
            at = gone.end() if gone else end
    return out


def _silent_ends(tokens: list[tuple[int, str, str]]) -> dict[int, int]:
    """For each closed silent element the place of its start tag and that of its end tag; nested ones close inside out."""
    ends: dict[int, int] = {}
    opened: list[tuple[str, int]] = []
    counts: dict[str, int] = {}
    for i, (kind, name, rest) in enumerate(tokens):
        if kind == _TEXT or name not in SILENT or name in RAW:
            continue
        if kind == _OPEN:
            if not rest.endswith("/"):
                opened.append((name, i))
                counts[name] = counts.get(name, 0) + 1
        elif counts.get(name):
            while True:
                held, at = opened.pop()
                counts[held] -= 1
                if held == name:
                    ends[at] = i
                    break
    return ends


def parse(html: str | None) -> Page:
    """Lenient reading of a page: unclosed and stray tags, comments and broken markup never fail.

    The time is linear in the page, whatever it holds. A tag that never ends, a comment and raw text without an end
    run to the end of the page.
    """
    blocks = [Block("#root", -1, 0)]
    texts: list[str] = []
    open_blocks, open_links, pieces, link_chars = [0], 0, [], 0
    open_names: dict[str, int] = {}

    def close_run() -> None:
        nonlocal pieces, link_chars
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                owner = blocks[open_blocks[-1]]
                owner.runs.append(len(texts))
                # the place among the children tells later where the run stands
                owner.children.append(-len(texts) - 1)
                owner.chars += len(text)
                owner.links += min(link_chars, len(text))
                owner.marks += text.count(".") + text.count(",") + text.count("?") + text.count("!")
                owner.run_count += 1
                texts.append(text)
            pieces, link_chars = [], 0

    def close_block() -> str:
        name = blocks[open_blocks.pop()].tag
        open_names[name] -= 1
        return name

    tokens = _tokens(html or "")
    ends = _silent_ends(tokens)
    place = -1
    while place + 1 < len(tokens):
        place += 1
        kind, name, rest = tokens[place]
        if kind == _TEXT:
            held = _decoded(rest)
            pieces.append(held)
            if open_links:
                link_chars += len(held.strip())
            continue
        blocks[open_blocks[-1]].tags += 1
        if kind == _CLOSE:
            if name == "a":
                open_links = max(0, open_links - 1)
            elif name not in INLINE and name not in VOID and open_names.get(name):
                close_run()
                while close_block() != name:
                    pass
                open_links = 0
            continue
        if name in CONTROLS:
            blocks[open_blocks[-1]].controls += 1
        if name in SILENT:
            place = ends.get(place, place)
            continue
        if name == "br":
            pieces.append("\n")
        elif name == "a":
            open_links = 1
        elif name not in INLINE:
            close_run()
            open_links = 0
            while len(open_blocks) > 1 and name in _CLOSED_BY.get(blocks[open_blocks[-1]].tag, ()):
                close_block()
            if name in VOID:
                continue
            parent = open_blocks[-1]
            blocks.append(Block(name, parent, len(open_blocks), rest))
            blocks[parent].children.append(len(blocks) - 1)
            if not rest.endswith("/"):
                open_blocks.append(len(blocks) - 1)
                open_names[name] = open_names.get(name, 0) + 1
    close_run()
    return _with_text_blocks(Page(blocks, texts))


def _with_text_blocks(page: Page) -> Page:
    """Runs beside block elements become blocks of their own, so that each can be judged apart."""
    blocks = page.blocks
    for i in range(len(blocks)):
        block = blocks[i]
        if not any(c >= 0 for c in block.children):
            block.children = []
            continue
        held = []
        for c in block.children:
            if c < 0:
                text = page.texts[-c - 1]
                marks = text.count(".") + text.count(",") + text.count("?") + text.count("!")
                share = round(block.links * len(text) / block.chars) if block.chars else 0
                made = Block("#text", i, block.depth + 1, "", [], [-c - 1], len(text), share, 0, 0, marks, 1)
                blocks.append(made)
                c = len(blocks) - 1
            held.append(c)
        block.children = held
        if block.runs:
            block.runs, block.chars, block.links, block.marks, block.run_count = [], 0, 0, 0, 0
    return page
