"""HTML as a small tree, and the column functions that read sections and links from it."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is no text of the page.
HIDDEN = frozenset(("script", "style", "template"))


class Node:
    __slots__ = ("attrs", "children", "name", "parent")

    def __init__(self, name: str, attrs: dict[str, str], parent: Node | None):
        self.name, self.attrs, self.parent, self.children = name, attrs, parent, []

    def walk(self) -> Iterator[Node]:
        """All elements below, in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def fragments(self) -> Iterator[str]:
        """The non-empty stripped text fragments below, in document order."""
        stack: list[Node | str] = list(reversed(self.children))
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                if text := node.strip():
                    yield text
            elif node.name not in HIDDEN:
                stack.extend(reversed(node.children))

    def links(self) -> Iterator[Node]:
        return (n for n in self.walk() if n.name == "a" and "href" in n.attrs)


class _Builder(HTMLParser):
    """Elements nest as they come: an end tag closes up to the nearest open element of its name, or does nothing."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)
        self.open: dict[str, int] = {}
        self.run: list[str] = []

    def flush(self) -> None:
        if self.run:
            self.at.children.append("".join(self.run))
            self.run = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.flush()
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node
            self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.flush()
        if not self.open.get(tag):
            return
        while True:
            name, self.at = self.at.name, self.at.parent
            self.open[name] -= 1
            if name == tag:
                return

    def handle_data(self, data: str) -> None:
        self.run.append(data)

    def handle_comment(self, data: str) -> None:
        self.flush()

    handle_decl = handle_pi = unknown_decl = handle_comment


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    builder.flush()
    return builder.root


def only_entities(html: str | None, names: tuple[str, ...]) -> str | None:
    """The page in which of all character references only ``&name;`` of these names is one; any other ``&`` is itself."""
    return html and re.sub(f"&(?!(?:{'|'.join(map(re.escape, names))});)", "&amp;", html)


def sections(html: str | None, header: str = "h3", entities: tuple[str, ...] | None = None) -> list[dict]:
    """The sections of a page: under each header element its siblings up to the next header among them.

    A header inside a sibling ends nothing: links below it belong to the outer section and to its own.
    ``entities``: names of the character references that are read, each ending in ``;``; by default all are read as HTML
    has it, old ones without ``;`` as well.
    """
    out, places = [], {}
    if entities is not None:
        html = only_entities(html, entities)
    for h in parse(html).walk():
        if h.name != header:
            continue
        siblings = h.parent.children
        if id(siblings) not in places:  # looked up once a parent, however many headers it has
            places[id(siblings)] = {id(c): i for i, c in enumerate(siblings)}
        texts, links = [], []
        for s in islice(siblings, places[id(siblings)][id(h)] + 1, None):
            if isinstance(s, str) or s.name in ("script", "style"):
                continue
            if s.name == header:
                break
            if text := "\n".join(s.fragments()):
                texts.append(text)
            links += [{"url": a.attrs["href"], "title": "".join(a.fragments())} for a in s.links()]
        out.append({"section_title": "".join(h.fragments()), "section_text": "\n".join(texts).strip(), "links": links})
    return out


def anchors(html: str | None, within: str | None = None) -> list[dict] | None:
    """All links of a page in order, or those below its first ``within`` element; None if there is no such element."""
    root = parse(html)
    if within is not None:
        root = next((n for n in root.walk() if n.name == within), None)
        if root is None:
            return None
    return [{"url": a.attrs["href"], "title": "".join(a.fragments())} for a in root.links()]


_LINK = pa.struct([("url", pa.string()), ("title", pa.string())])
_SECTION = pa.struct([("section_title", pa.string()), ("section_text", pa.string()), ("links", pa.list_(_LINK))])
_LINK_SQL = "array<struct<url:string,title:string>>"


def sections_of(html: Column, header: str = "h3", entities: tuple[str, ...] | None = None) -> Column:
    """``array<struct(section_title, section_text, links array<struct(url, title)>)>``, in document order."""

    @F.arrow_udf(f"array<struct<section_title:string,section_text:string,links:{_LINK_SQL}>>")
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([sections(p.as_py(), header, entities) for p in pages], pa.list_(_SECTION))

    return run(html)


def anchors_of(html: Column, within: str | None = None, once: bool = False) -> Column:
    """``array<struct(url, title)>`` in document order; null where there is no ``within`` element.

    ``once``: the optimizer never makes a second copy of the call.
    """

    @F.arrow_udf(_LINK_SQL)
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([anchors(p.as_py(), within) for p in pages], pa.list_(_LINK))

    return (run.asNondeterministic() if once else run)(html)


def starts_with_any(url: Column, prefixes: tuple[str, ...]) -> Column:
    """Whether the url starts with one of the prefixes, by case."""
    hit = F.lit(False)
    for p in prefixes:
        hit = hit | F.startswith(url, F.lit(p))
    return hit


def clean_link_title(title: Column, folder: Column) -> Column:
    """The title without ``(<resource type>)``, the type being the folder's name up to the first underscore."""
    from lectern.functions.paths import strip

    return strip(F.replace(title, F.concat(F.lit("("), F.split_part(folder, F.lit("_"), F.lit(1)), F.lit(")")), F.lit("")))
