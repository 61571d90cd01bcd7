"""Small HTML reader for the page extraction tasks: one pass, no recursion.

It keeps what the extraction rules look at: elements in document order with their classes, parents
and text positions.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from html import unescape

# Fixed element groups of HTML.
VOID = frozenset(
    "area base br col embed hr img input link meta source track wbr".split()
)
BLOCK = frozenset(
    "address article aside blockquote br dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr li main nav ol p pre section table td th tr ul".split()
)
HIDDEN = frozenset("script style noscript template title".split())
# An opening tag closes an open element of the same kind, unless one of these lies between them.
CLOSED_BY_SIBLING = {"li": ("ul", "ol"), "p": ("div", "section", "article", "li", "td"), "option": ("select",)}


class Element:
    """Tag, attributes, and the ranges of descendants and text pieces; ``first`` is its first own text piece, if any."""

    __slots__ = ("tag", "attrs", "classes", "parent", "start", "end", "text_start", "text_end", "first")

    def __init__(self, tag, attrs, classes, parent, start, text_start):
        self.tag, self.attrs, self.classes, self.parent = tag, attrs, classes, parent
        self.start, self.end = start, None
        self.text_start, self.text_end = text_start, None
        self.first = None


# A comment, a tag with its attribute text (an opening one together with its text and the closing one, if nothing
# else is between them), a declaration, or a run of text. The possessive quantifiers keep broken quotes from being
# tried again and again.
TOKEN = re.compile(
    r"""<!--(?:.*?-->|.*)|(<(/)?([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>)(?(2)|(?:([^<]++)</\3>)?)|<[!?/][^>]*>|[^<]+|<""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
# Elements whose content holds no tags.
RAW_END = {name: re.compile(rf"</{name}\b", re.IGNORECASE) for name in ("script", "style", "title", "textarea")}


SPACES = re.compile(r"[ \t\r\n\f]+")
#: Tags of a page repeat; those met lately are taken apart once. Longer ones, and more than these, are not kept.
KNOWN_TAGS, KNOWN_CHARS = 4096, 256


def _attributes(text: str) -> dict:
    found = {}
    for name, double, single, bare in ATTRIBUTE.findall(text):
        value = double or single or bare
        found.setdefault(name.lower(), unescape(value) if "&" in value else value)
    return found


def _opened(tag: str, attributes: str) -> tuple:
    """What an opening tag says: tag, attributes, classes, names to find it by, and whether it is a block or has rules of its own."""
    attrs = _attributes(attributes) if attributes else {}
    classes = tuple(attrs["class"].split()) if "class" in attrs else ()
    names = (tag, *("." + name for name in dict.fromkeys(classes)))
    return tag, attrs, classes, names, tag in BLOCK, tag in VOID or tag in HIDDEN or tag in RAW_END or tag in CLOSED_BY_SIBLING


_known: dict[str, tuple] = {}


def _tag(text: str, closing: str | None, name: str, attributes: str) -> tuple:
    """``_opened`` of an opening tag; (tag, None) of a closing one."""
    tag = name.lower()
    said = (tag, None) if closing else _opened(tag, attributes)
    if len(text) <= KNOWN_CHARS:
        if len(_known) >= KNOWN_TAGS:
            _known.clear()
        _known[text] = said
    return said


class Page:
    """Elements and text pieces of a page in document order."""

    def __init__(self, html: str):
        self.elements, self.pieces, self.open = [], [], []
        self.hidden = []  # pieces that are no visible text
        self.by_name = defaultdict(list)
        self.root = self._push("", {}, (), ("",))
        self._read(html)
        self._pop_to(0)

    def _read(self, html):
        # Attributes of the page as locals: this loop runs once for every tag and text.
        elements, pieces, opened, hidden, by_name = self.elements, self.pieces, self.open, self.hidden, self.by_name
        known, add_piece, add_element = _known.get, self.pieces.append, self.elements.append
        position, size = 0, len(html)
        joinable = False  # whether the next text continues the last piece
        while position < size:
            for token in TOKEN.finditer(html, position):
                text, closing, name, attributes, inner = token.groups()
                if text is None:
                    text = token.group()
                    if text[0] == "<" and text != "<":
                        joinable = False
                        continue
                    if "&" in text:
                        text = unescape(text)
                    if joinable:
                        pieces[-1] += text
                    else:
                        self._add_text(opened[-1], text)
                        joinable = True
                    continue
                said = known(text) or _tag(text, closing, name, attributes)
                if closing:
                    last = opened[-1]
                    if last.tag == said[0]:
                        opened.pop()
                        last.end, last.text_end = len(elements), len(pieces)
                        if said[0] in BLOCK:
                            add_piece("\n")
                        joinable = False
                    elif self._end(said[0]):
                        joinable = False
                    continue
                joinable = False
                tag, attrs, classes, names, block, special = said
                if special and tag in CLOSED_BY_SIBLING:
                    self._close_sibling(tag)
                if block:
                    add_piece("\n")
                start = len(elements)
                element = Element(tag, attrs, classes, opened[-1], start, len(pieces))
                add_element(element)
                for name in names:
                    by_name[name].append(start)
                if inner is not None and not special:
                    # An element of one text, begun and ended at once.
                    element.first = len(pieces)
                    add_piece(unescape(inner) if "&" in inner else inner)
                    element.end, element.text_end = start + 1, len(pieces)
                    if block:
                        add_piece("\n")
                    continue
                opened.append(element)
                if special:
                    if tag in VOID:
                        self._pop_to(len(opened) - 1)
                    if tag in RAW_END or inner is not None:
                        position = token.end(1)
                        break
            else:
                return
            if tag in RAW_END:
                # The content of the element that has just been opened holds no tags.
                end = RAW_END[tag].search(html, position)
                stop = end.start() if end else size
                if stop > position:
                    text = html[position:stop]
                    self._add_text(element, unescape(text) if "&" in text and tag not in ("script", "style") else text)
                    joinable = True
                position = stop

    def _add_text(self, owner, text):
        """A piece of text in an open element."""
        at = len(self.pieces)
        if owner.first is None:
            owner.first = at
        if owner.tag in HIDDEN:
            self.hidden.append(at)
        self.pieces.append(text)

    def _push(self, tag, attrs, classes, names):
        element = Element(tag, attrs, classes, None, len(self.elements), len(self.pieces))
        self.elements.append(element)
        for name in names:
            self.by_name[name].append(element.start)
        self.open.append(element)
        return element

    def _pop_to(self, depth):
        while len(self.open) > depth:
            element = self.open.pop()
            element.end, element.text_end = len(self.elements), len(self.pieces)

    def _close_sibling(self, tag):
        barriers = CLOSED_BY_SIBLING[tag]
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == tag:
                self._pop_to(depth)
                break
            if self.open[depth].tag in barriers:
                break

    def _end(self, tag):
        """Close the innermost element of the tag with all in it; whether there is one."""
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == tag:
                self._pop_to(depth)
                if tag in BLOCK:
                    self.pieces.append("\n")
                return True
        return False

    def find(self, element, selector, include_self=False):
        """Descendants that match, in document order."""
        low, high, elements = element.start + (0 if include_self else 1), element.end, self.elements
        steps = selector.steps
        if len(steps) == 1:
            return [elements[at] for at in self._matching(low, high, *steps[0])]
        return [elements[at] for at in sorted({at for step in steps for at in self._matching(low, high, *step)})]

    def _matching(self, low, high, name, test):
        starts = self.by_name.get(name, ())
        found = starts[bisect_left(starts, low):bisect_left(starts, high)]
        return found if test is None else [at for at in found if test(self.elements[at])]

    def first(self, element, selector):
        """The first descendant that matches, or None; for a selector that is one tag or class."""
        (name, test), = selector.steps
        if test is None:
            starts = self.by_name.get(name, ())
            at = bisect_left(starts, element.start + 1)
            return self.elements[starts[at]] if at < len(starts) and starts[at] < element.end else None
        found = self._matching(element.start + 1, element.end, name, test)
        return self.elements[found[0]] if found else None

    def everywhere(self, selector):
        return self.find(self.root, selector)

    def inside(self, element):
        """The element and its descendants."""
        return self.elements[element.start:element.end]

    def text(self, element) -> str:
        """Visible text with white space runs collapsed."""
        low, high, hidden = element.text_start, element.text_end, self.hidden
        parts = self.pieces[low:high]
        if not hidden or hidden[-1] < low:
            return SPACES.sub(" ", parts[0] if len(parts) == 1 else "".join(parts)).strip()
        for at in hidden[bisect_left(hidden, low):bisect_left(hidden, high)]:
            parts[at - low] = ""
        return SPACES.sub(" ", "".join(parts)).strip()

    def first_text(self, elements):
        """First own text piece of the given elements, in document order; None without any."""
        positions = [e.first for e in elements if e.first is not None]
        return self.pieces[min(positions)] if positions else None


def _simple(selector: str):
    tag, classes, name, value = re.fullmatch(
        r"([\w-]*)((?:\.[\w-]+)*)(?:\[([\w-]+)=\"([^\"]*)\"\])?", selector
    ).groups()
    wanted = [c for c in classes.split(".") if c]

    def test(e):
        return (
            (not tag or e.tag == tag)
            and all(c in e.classes for c in wanted)
            and (name is None or e.attrs.get(name) == value)
        )

    return ("." + wanted[0] if wanted else tag), test, name is None and len(wanted) + bool(tag) == 1


class Selector:
    """A list of ``tag.class[attr="value"]`` selectors, each with optional ancestors.

    ``steps`` pairs the class or tag to look up with the rest of the test, None where there is none; ``tests`` are whole.
    """

    def __init__(self, selectors: str):
        steps = [self._step(one.split()) for one in selectors.split(",")]
        self.steps = [(name, None if alone else test) for name, test, alone in steps]
        self.tests = [test for _, test, _ in steps]

    @staticmethod
    def _step(parts):
        name, own, alone = _simple(parts[-1])
        above = [_simple(part)[1] for part in parts[:-1]]

        def has_ancestor(element, test):
            element = element.parent
            while element is not None and not test(element):
                element = element.parent
            return element is not None

        if not above:
            return name, own, alone
        return name, lambda e: own(e) and all(has_ancestor(e, test) for test in above), False

    def matches(self, element) -> bool:
        return any(test(element) for test in self.tests)
