"""One page as elements and pieces of text: the part of extraction that needs Python. What is read off them are columns
(``elements.py``)."""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: An element: its place in the page, its parent's and that of the last element within it, its number among its parent's
#: children of its tag and the place of the one before (else null), tag, marks (``.class``, ``#id``, ``name``,
#: ``name=value``), and its pieces of text, from and up to.
ELEMENT = "pos int, parent int, end int, nth int, before int, tag string, marks array<string>, class string, id string, href string, first int, last int"


_TAGS = re.compile(r"(<[^<>]*>)")
#: Tags that the parser reads alike wherever they stand. Of others (comments, doctypes, odd quotes, and tags whose content
#: is no markup) the parser reads the whole page.
_PLAIN = re.compile(r"""<(?:/[a-z][a-z0-9]*|[a-z][a-z0-9]*(?:[ \t\n]+[a-z][a-z0-9:._-]*(?:="[^"<>]*"|='[^'<>]*')?)*[ \t\n]*/?)>""", re.ASCII | re.IGNORECASE)
_NAME, _ATTRIBUTE = re.compile("[a-zA-Z][a-zA-Z0-9]*"), re.compile(r"""[ \t\n]([a-zA-Z][a-zA-Z0-9:._-]*)(?:=("[^"]*"|'[^']*'))?(?=[ \t\n/>])""")
_RAW = frozenset("script style textarea title iframe noembed noframes noscript xmp plaintext".split())
#: Tags, as pages write them, that a worker remembers, and elements of structures.
REMEMBERED = 50_000
_structures: dict[tuple, list[tuple]] = {}
_ROOT = "", ["#"], "", "", None
_known: dict[frozenset[str], dict[str, tuple | None]] = {}


class _Reader(HTMLParser):
    def __init__(self, names: frozenset[str]):
        super().__init__(convert_charrefs=True)
        self.names, self.elements, self.pieces, self.open, self.siblings = names, [], [], [], {}
        self.handle_starttag("", ())

    def handle_starttag(self, tag, attrs):
        pos, parent = len(self.elements), self.open[-1] if self.open else 0
        before, nth = self.siblings.get((parent, tag), (None, 0))
        self.siblings[parent, tag] = pos, nth + 1
        at = len(self.pieces)
        self.elements.append([pos, parent, pos, nth + 1, before, *_told(tag, attrs, self.names), at, at])
        if tag not in VOID:
            self.open.append(pos)

    def handle_endtag(self, tag):
        depth = next((k for k in range(len(self.open) - 1, 0, -1) if self.elements[self.open[k]][5] == tag), None)
        if depth is not None:
            self.leave(depth)

    def handle_data(self, data):
        if self.elements[self.open[-1]][5] not in ("script", "style") and (piece := data.strip()):
            self.pieces.append(piece)

    def leave(self, depth):
        for pos in self.open[depth:]:
            self.elements[pos][2], self.elements[pos][11] = len(self.elements) - 1, len(self.pieces)
        del self.open[depth:]


def _told(tag: str, attrs, names: frozenset[str]) -> tuple[str, list[str], str, str, str | None]:
    """What a start tag says of its element: tag, marks, class, id, href."""
    attrs = dict(attrs)
    classes, own_id = attrs.get("class") or "", attrs.get("id") or ""
    marks = [f".{c}" for c in classes.split()] + [f"#{own_id}"]
    for name in names & attrs.keys():
        marks += [name] if attrs[name] is None else [name, f"{name}={attrs[name]}"]
    return tag, marks, classes, own_id, attrs.get("href")


class _OneTag(HTMLParser):
    found = None

    def handle_starttag(self, tag, attrs):
        self.found = attrs


def _tag(text: str, names: frozenset[str]) -> tuple | None:
    """(what it says, or null for an end tag; the tags that it opens and closes, or null) of a plain tag; null for others."""
    if not _PLAIN.fullmatch(text):
        return None
    name, attrs = _NAME.search(text)[0].lower(), _ATTRIBUTE.findall(text)
    if name in _RAW:
        return None
    if text[1] == "/":
        return None, (None, name)
    attrs = [(n.lower(), value[1:-1] if value else None) for n, value in attrs]
    if "&" in text:
        one = _OneTag()
        one.feed(text)
        attrs = one.found
    return _told(name, attrs, names), (name, name if text[-2] == "/" else None)


def _structure(kinds: tuple, filled: tuple) -> list[tuple]:
    """(place, parent, end, number, before, first piece, last piece) of each element, from each tag's (opens, closes) and
    which of the texts around the tags are not empty."""
    rows, pieces, open_, siblings = [[0, 0, 0, 1, None, 0, 0]], int(filled[0]), [0], {}
    names = [""]

    def leave(depth):
        for pos in open_[depth:]:
            rows[pos][2], rows[pos][6] = len(rows) - 1, pieces
        del open_[depth:]

    for (opens, closes), text in zip(kinds, filled[1:], strict=True):
        if opens:
            pos, parent = len(rows), open_[-1]
            before, nth = siblings.get((parent, opens), (None, 0))
            siblings[parent, opens] = pos, nth + 1
            rows.append([pos, parent, pos, nth + 1, before, pieces, pieces])
            names.append(opens)
            if opens not in VOID:
                open_.append(pos)
        if closes and (depth := next((k for k in range(len(open_) - 1, 0, -1) if names[open_[k]] == closes), None)):
            leave(depth)
        pieces += text
    leave(0)
    return list(map(tuple, rows))


def _read_plain(html: str, names: frozenset[str]) -> tuple[list[list], list[str]] | None:
    """The same as the reader gives for a page of plain tags and text; null for other pages. Pages of one layout share
    their structure, which is remembered."""
    parts, known, tags = _TAGS.split(html), _known.setdefault(names, {}), []
    if len(known) > REMEMBERED:
        known.clear()
    for part in parts[1::2]:
        if part not in known:
            known[part] = _tag(part, names)
        tags.append(known[part])
    if None in tags or html.count("<") != len(tags):
        return None
    texts = [(unescape(x) if "&" in x else x).strip() for x in parts[::2]]
    key = tuple([t[1] for t in tags]), tuple(map(bool, texts))
    if (rows := _structures.get(key)) is None:
        rows = _structure(*key)
        if sum(map(len, _structures.values())) + len(rows) > REMEMBERED:
            _structures.clear()
        if len(rows) <= REMEMBERED:
            _structures[key] = rows
    told = [_ROOT, *[t[0] for t in tags if t[0]]]
    return [[*row[:5], *own, *row[5:]] for row, own in zip(rows, told, strict=True)], list(filter(None, texts))


def read_page(html: str | None, names: frozenset[str]) -> tuple[list[list], list[str]]:
    """(elements in document order, the page itself first; pieces of text). Of the attributes, class, id, href and ``names`` are kept."""
    if isinstance(html, str) and (plain := _read_plain(html, names)):
        return plain
    reader = _Reader(names)
    reader.feed(html or "")
    reader.close()
    reader.leave(0)
    return reader.elements, reader.pieces
