"""A tolerant HTML tree on the standard library's tokenizer, selectors, and the text of elements."""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache
from html.entities import html5
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style"))
BLOCKS = frozenset("address article aside blockquote dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tbody td tfoot th thead tr ul".split())
#: What an opening tag closes, up to the elements in the second set.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
# Elements that begin with a mark in the visitor's text, and those that end with a line end.
VISITOR_OPEN = {"li": "\n* ", "dd": "\t"}
VISITOR_CLOSE = frozenset(("br", "p", "h1", "h2", "h3", "h4", "h5", "ul", "ol", "dd", "dl", "dt", "pre"))


class Element:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self):
        """The elements below, in order."""
        todo = [x for x in reversed(self.children) if isinstance(x, Element)]
        while todo:
            one = todo.pop()
            yield one
            todo += [x for x in reversed(one.children) if isinstance(x, Element)]

    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("#root", {}, None)
        # How many elements of a tag are open: what isn't open is not looked for, however deep the page.
        self.open: Counter[str] = Counter()

    def _close(self, tags: set[str], until: set[str]) -> None:
        one = self.at if any(self.open[t] for t in tags) else self.root
        while one.parent is not None and one.tag not in until:
            if one.tag in tags:
                self._leave(one)
                return
            one = one.parent

    def _leave(self, one: Element) -> None:
        while self.at is not one.parent:
            self.open[self.at.tag] -= 1
            self.at = self.at.parent

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self._close({"p"}, {"td", "th", "table", "button", "li", "div", "article", "section"})
        if tag in _CLOSES:
            self._close(*_CLOSES[tag])
        one = Element(tag, {}, self.at)
        for name, value in attrs:
            one.attrs.setdefault(name, value or "")
        self.at.children.append(one)
        if tag not in VOID:
            self.at = one
            self.open[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        one = self.at if self.open[tag] else self.root
        while one.parent is not None:
            if one.tag == tag:
                self._leave(one)
                return
            one = one.parent

    def handle_data(self, data):
        if self.at.tag not in RAW:
            self.at.children.append(data)


_REFERENCE = re.compile(r"&(#[0-9]+;|#[xX][0-9A-Fa-f]+;|[A-Za-z][A-Za-z0-9]*;)?")


def _escaped(found: re.Match) -> str:
    name = found[1] or ""
    return found[0] if name[:1] == "#" or name in html5 else "&amp;" + name


def parse(html: str | None, closed: bool = False) -> Element:
    """The tree of a page.  HTML reads some references also without their semicolon; ``closed``: only those that have it."""
    builder = _Builder()
    builder.feed(_REFERENCE.sub(_escaped, html or "") if closed else html or "")
    builder.close()
    return builder.root


_SIMPLE = re.compile(r"(?P<tag>\*|[A-Za-z][\w-]*)?(?P<rest>(?:[.#][\w-]+|\[[\w-]+(?:=(?:\"[^\"]*\"|'[^']*'|[^\]]*))?\])*)$")
_PART = re.compile(r"([.#])([\w-]+)|\[([\w-]+)(?:=(?:\"([^\"]*)\"|'([^']*)'|([^\]]*)))?\]")


@lru_cache(maxsize=256)
def selector(text: str) -> tuple:
    """A compiled selector: alternatives, each a tuple of (combinator, tag, conditions).  Raises on syntax it doesn't know."""
    out = []
    for alternative in text.split(","):
        steps, direct = [], False
        for token in re.sub(r"\s*>\s*", " > ", alternative).split():
            if token == ">" and steps and not direct:
                direct = True
                continue
            found = _SIMPLE.match(token)
            if not found or not token:
                raise ValueError(f"unknown selector: {text}")
            conditions = []
            for kind, name, attr, a, b, c in _PART.findall(found["rest"]):
                conditions.append((kind or "[", name or attr.lower(), (a or b or c) if not kind and "=" in found["rest"] else None))
            steps.append((">" if direct else " ", (found["tag"] or "*").lower(), tuple(conditions)))
            direct = False
        if not steps or direct:
            raise ValueError(f"unknown selector: {text}")
        out.append(tuple(steps))
    return tuple(out)


def _fits(one: Element, tag: str, conditions: tuple) -> bool:
    if tag not in ("*", one.tag):
        return False
    for kind, name, value in conditions:
        if kind == "." and name not in one.classes() or kind == "#" and one.attrs.get("id") != name:
            return False
        if kind == "[" and (name not in one.attrs or value and one.attrs[name] != value):
            return False
    return True


def _matches(one: Element, steps: tuple) -> bool:
    combinator, tag, conditions = steps[-1]
    if not _fits(one, tag, conditions):
        return False
    if len(steps) == 1:
        return combinator == " " or one.parent is not None and one.parent.tag == "#root"
    above = one.parent
    while above is not None and above.tag != "#root":
        if _matches(above, steps[:-1]):
            return True
        if combinator == ">":
            return False
        above = above.parent
    return False


def select(root: Element, text: str) -> list[Element]:
    """The elements below that a selector matches, in order, each once."""
    alternatives = selector(text)
    return [x for x in root.walk() if any(_matches(x, steps) for steps in alternatives)]


def remove(root: Element, selectors: list[str]) -> None:
    for text in selectors:
        for one in select(root, text):
            if one in one.parent.children:
                one.parent.children.remove(one)


def _collapsed(text: str) -> str:
    return re.sub(r"[ \t\n\r\f]+", " ", text)


def visitor_text(root: Element) -> str:
    """Text nodes with marks at list items and definitions and line ends after the block elements of a fixed list."""
    out: list[str] = []

    def append(text: str) -> None:
        if text == " " and (not out or out[-1][-1:] in (" ", "\n")):
            return
        if text:
            out.append(text)

    todo: list[tuple[Element | str, bool]] = [(root, False)]
    while todo:
        node, done = todo.pop()
        if isinstance(node, str):
            append(_collapsed(node))
        elif done:
            if node.tag in VISITOR_CLOSE:
                append("\n")
        else:
            if node.tag in VISITOR_OPEN:
                append(VISITOR_OPEN[node.tag])
            todo.append((node, True))
            todo += [(x, False) for x in reversed(node.children)]
    return "".join(out)


def plain_text(root: Element, broken: bool = False) -> str:
    """Text with white space collapsed and blocks parted by a blank; ``broken``: with a line end for every ``br`` and after every ``p``."""
    out: list[str] = []
    todo: list[tuple[Element | str, bool]] = [(root, False)]
    while todo:
        node, done = todo.pop()
        if isinstance(node, str):
            out.append(node.replace("\0", ""))
        elif done:
            if broken and node.tag in ("br", "p"):
                out.append("\0")
            if node.tag in BLOCKS:
                out.append(" ")
        else:
            if node.tag in BLOCKS or node.tag == "br":
                out.append(" ")
            todo.append((node, True))
            todo += [(x, False) for x in reversed(node.children)]
    return _collapsed("".join(out)).strip().replace("\0", "\n").strip()


def selected_text(root: Element, accept: list[str], reject: list[str], mode: str = "visitor") -> str | None:
    """The text of all accepted elements, one after another; None if no selector matches anything."""
    if mode not in ("visitor", "br2n"):
        raise ValueError(f"unknown text mode: {mode}")
    remove(root, reject)
    found, out = False, []
    for text in accept:
        for one in select(root, text):
            found = True
            plain = (visitor_text(one) if mode == "visitor" else plain_text(one, broken=True)).strip("".join(map(chr, range(33))))
            if plain:
                out.append(plain + "\n")
    return "".join(out) if found else None


def categories(root: Element, where: str = "div#catlinks li") -> list[str]:
    return [x for x in (plain_text(one) for one in select(root, where)) if x]


def blocks(root: Element) -> list[tuple[str, int, int]]:
    """(text, words, words in links) of every run of text between block elements."""
    out: list[tuple[str, int, int]] = []
    parts: list[str] = []
    linked: list[str] = []

    def flush() -> None:
        text = _collapsed("".join(parts)).strip()
        if text:
            out.append((text, len(text.split()), len("".join(linked).split())))
        parts.clear(), linked.clear()

    todo: list[tuple[Element | str, bool, bool]] = [(root, False, False)]
    while todo:
        node, done, link = todo.pop()
        if isinstance(node, str):
            parts.append(node)
            if link:
                linked.append(node + " ")
        elif done:
            if node.tag in BLOCKS:
                flush()
        elif node.tag not in ("head", "title", *RAW):
            if node.tag in BLOCKS:
                flush()
            todo.append((node, True, link))
            todo += [(x, False, link or node.tag == "a") for x in reversed(node.children)]
    flush()
    return out
