"""Rows out of landed HTML pages, chosen by tag and class.

A page is parsed in the task that holds it and gives one array of field values per matching
element; everything after that (filters, numbering, cleaning) is ordinary columns. Pages with
unclosed tags, and scripts that hold markup in strings, are read like a browser would.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Elements without content, and elements that end an open paragraph.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_ENDS_P = frozenset("article div footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p section table ul".split())
# Markup that reads one way only: text, plain tags, scripts without tags that end, short comments. Other pages go to ``HTMLParser``.
_ATTRIBUTES = r"""(?: +[a-z][a-z0-9-]*=(?:'[^'<>&]*'|"[^"<>&]*"))*"""
_PLAIN = re.compile(
    rf"""(?P<text>[^<]+)|<(?!(?:script|style)[ />])([a-z][a-z0-9]*)(?P<attributes>{_ATTRIBUTES}) */?>|</(?P<closed>[a-z][a-z0-9]*)>"""
    rf"""|<(script|style)(?P<raw_attributes>{_ATTRIBUTES})>[^<]*(?:<(?![/!])[^<]*)*</\5>|<!--[^<>-]+-->|<!(?:DOCTYPE|doctype) [a-z]+>""")
_ATTRIBUTE = re.compile(r"""([a-z][a-z0-9-]*)=(?:'([^']*)'|"([^"]*)")""")
_RAW_TEXT = frozenset("title textarea xmp iframe noembed noframes plaintext noscript".split())
_OUT_CHARS = 1 << 20  # characters of values in an output batch


@lru_cache(4096)
def _attributes(source: str) -> dict[str, str]:
    return {name: one or two for name, one, two in _ATTRIBUTE.findall(source)}


@dataclass(frozen=True)
class Step:
    """An element by tag and class; ``index`` picks the n-th match.

    ``cls`` matches one class or the whole attribute; with ``contains`` a part of the attribute.
    """

    tag: str
    cls: str | None = None
    index: int = 0
    contains: bool = False


@dataclass(frozen=True)
class Field:
    """A value of a row: follow the steps, then take the text, the number of matches of the last
    step, or an attribute of the next element of a given tag in the page."""

    name: str
    path: tuple[Step, ...]
    take: str = "text"
    next_tag: str = ""
    attribute: str = ""


class _Element:
    __slots__ = ("tag", "attrs", "children", "place", "last")

    def __init__(self, tag: str, attrs: dict, place: int):
        self.tag, self.attrs, self.place = tag, attrs, place
        self.children: list = []
        self.last = place  # place of the last element inside

    def text(self) -> str:
        if len(self.children) == 1 and type(self.children[0]) is str and self.tag not in ("script", "style"):
            return self.children[0]
        parts, todo = [], [self]
        while todo:
            node = todo.pop()
            if isinstance(node, str):
                parts.append(node)
            elif node.tag not in ("script", "style"):
                todo.extend(reversed(node.children))
        return "".join(parts)


class _Page(HTMLParser):
    """All elements of a page in document order, and by tag."""

    def __init__(self, page: str):
        super().__init__(convert_charrefs=True)
        self._start()
        if not self._read_plain(page):
            self._start()
            self.feed(page)
            self.close()
        while self._open:
            self._pop()
        self._tags: dict[str, list[_Element]] = defaultdict(list)
        for e in self.elements[1:]:
            self._tags[e.tag].append(e)
        self._found: dict[tuple, tuple[list[int], list[_Element]]] = {}

    def _start(self) -> None:
        self.elements: list[_Element] = [_Element("", {}, 0)]
        self._open = [self.elements[0]]
        self._open_tags: dict[str, int] = defaultdict(int)

    def _read_plain(self, page: str) -> bool:
        """Read a page of plain markup; False as soon as there is anything else."""
        end, start, close, data = 0, self.handle_starttag, self.handle_endtag, self.handle_data
        for m in _PLAIN.finditer(page):
            if m.start() != end:
                return False
            end, kind = m.end(), m.lastgroup
            if kind == "text":
                text = m[1]
                data(unescape(text) if "&" in text else text)
            elif kind == "attributes":
                if m[2] in _RAW_TEXT:
                    return False
                start(m[2], _attributes(m[3]) if len(m[3]) < 256 else _attributes.__wrapped__(m[3]))
            elif kind == "closed":
                close(m[4])
            elif kind == "raw_attributes":  # what is inside is never part of a text
                start(m[5], _attributes.__wrapped__(m[6]))
                close(m[5])
        return end == len(page)

    def _pop(self) -> None:
        element = self._open.pop()
        element.last = len(self.elements) - 1
        self._open_tags[element.tag] -= 1

    def handle_starttag(self, tag: str, attrs: list | dict) -> None:
        if tag in _ENDS_P and self._open[-1].tag == "p":
            self._pop()
        element = _Element(tag, attrs if type(attrs) is dict else dict(attrs), len(self.elements))
        self.elements.append(element)
        self._open[-1].children.append(element)
        if tag not in _VOID:
            self._open.append(element)
            self._open_tags[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list | dict) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if self._open_tags[tag] > 0:
            while self._open[-1].tag != tag:
                self._pop()
            self._pop()

    def handle_data(self, data: str) -> None:
        self._open[-1].children.append(data)

    def find_all(self, step: Step) -> tuple[list[int], list[_Element]]:
        """Places and elements of the whole page that fit a step; looked up once a page."""
        key = (step.tag, step.cls, step.contains)
        if key not in self._found:
            found = self._tags.get(step.tag, [])
            if step.cls is not None:
                found = [e for e in found if self._fits(e.attrs.get("class") or "", step)]
            self._found[key] = [e.place for e in found], found
        return self._found[key]

    @staticmethod
    def _fits(cls: str, step: Step) -> bool:
        return step.cls in cls if step.contains else cls == step.cls or step.cls in cls.split()

    def _nth(self, step: Step, root: _Element) -> _Element | None:
        places, found = self.find_all(step)
        i = bisect_right(places, root.place) + step.index
        return found[i] if i < len(places) and places[i] <= root.last else None

    def value(self, field: Field, root: _Element) -> str | None:
        for step in field.path[:-1]:
            root = self._nth(step, root)
            if root is None:
                return None
        step = field.path[-1]
        if field.take == "count":
            places, _ = self.find_all(step)
            return str(bisect_right(places, root.last) - bisect_right(places, root.place))
        element = self._nth(step, root)
        if element is None:
            return None
        if field.take == "text":
            return element.text()
        places, found = self.find_all(Step(field.next_tag))
        later = bisect_right(places, element.place)
        return found[later].attrs.get(field.attribute) if later < len(places) else None


def reader(row: Step, fields: Sequence[Field], keep: Sequence[str], html: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Arrow batches of pages to batches of the kept columns and ``rows``.

    Pages are read one at a time and their rows handed on whenever about a million characters have come together, so a task
    holds one page and one small batch besides the Arrow batch it was given.
    """
    names = [f.name for f in fields]

    def read(page: str | None, columns: list[list]) -> tuple[int, int]:
        """Append the values of a page's rows; returns (rows, characters)."""
        if page is None:
            return 0, 0
        parsed, chars = _Page(page), 0
        found = parsed.find_all(row)[1]
        for element in found:
            for f, column in zip(fields, columns, strict=True):
                value = parsed.value(f, element)
                column.append(value)
                chars += 8 + len(value or "")
        return len(found), chars

    def packed(batch: pa.RecordBatch, ends: list[int], columns: list[list]) -> pa.RecordBatch:
        structs = pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in columns], names)
        rows = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs)
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), rows], [*keep, "rows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, ends, columns, size = 0, [0], [[] for _ in names], 0
            for i, page in enumerate(batch.column(html)):
                n, chars = read(page.as_py(), columns)
                ends.append(ends[-1] + n)
                size += chars
                if size >= _OUT_CHARS or i + 1 == batch.num_rows:
                    yield packed(batch.slice(first, i + 1 - first), ends, columns)
                    first, ends, columns, size = i + 1, [0], [[] for _ in names], 0

    return run


def extract(
    pages: DataFrame, row: Step, fields: Sequence[Field], keep: Sequence[str] = ("page_id",), html: str = "html"
) -> DataFrame:
    """Per page the kept columns and ``rows``: an array with one struct of strings per row element.

    A field that is not there is NULL, so the caller decides which rows are rejects.
    """
    item = T.StructType([T.StructField(f.name, T.StringType()) for f in fields])
    schema = T.StructType([pages.schema[c] for c in keep] + [T.StructField("rows", T.ArrayType(item))])
    return pages.select(*keep, html).mapInArrow(reader(row, fields, keep, html), schema)
