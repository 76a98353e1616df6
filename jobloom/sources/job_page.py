"""Fields of a board B job page. They depend on how elements are nested, so each page is parsed as a tree of tags."""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

FIELDS = ("posted", "Experience", "location", "jobType", "Education", "description", "name", "title")
#: Pages that are Python objects at a time.
SLICE = 64

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# Tags that end an open paragraph, and tags that end an open one of their kind up to the element around it.
_BLOCK = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre "
    "section table ul".split()
)
_SIBLINGS = {
    "li": ("li", ("ul", "ol", "menu")), "option": ("option", ("select",)), "tr": ("tr", ("table",)),
    "td": ("td", ("tr", "table")), "th": ("td", ("tr", "table")),
}
_BOUNDS = {"p": ("td", "th", "table", "button", "li")}


class _Element:
    """A tag with its class; its text is a stretch of the page's text, its descendants are those up to ``last``."""

    __slots__ = ("tag", "css", "order", "last", "start", "stop")

    def __init__(self, tag: str, css: str, order: int, start: int):
        self.tag, self.css, self.order, self.start = tag, css, order, start
        self.last: int | None = None
        self.stop: int | None = None


class _Page(HTMLParser):
    """Elements of a page in document order; each piece of text is kept once, whatever is open around it."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.elements: list[_Element] = []
        self.open: list[_Element] = []
        self.count: Counter = Counter()
        self.parts: list[str] = []
        self.size = 0
        self.feed(html)
        self.close()
        self._leave(0)
        self.whole = "".join(self.parts)

    def _leave(self, depth: int) -> None:
        for element in self.open[depth:]:
            element.stop, element.last = self.size, len(self.elements) - 1
            self.count[element.tag] -= 1
        del self.open[depth:]

    def _end_open(self, tags: tuple[str, ...], bounds: tuple[str, ...]) -> None:
        if any(self.count[t] > 0 for t in tags):
            for depth in range(len(self.open) - 1, -1, -1):
                if self.open[depth].tag in tags:
                    return self._leave(depth)
                if self.open[depth].tag in bounds:
                    return None
        return None

    def handle_starttag(self, tag, attrs):
        if tag in _BLOCK:
            self._end_open(("p",), _BOUNDS["p"])
        if tag in _SIBLINGS:
            kind, bounds = _SIBLINGS[tag]
            self._end_open(("td", "th") if kind == "td" else (kind,), bounds)
        css = next((v or "" for k, v in attrs if k == "class"), "")
        element = _Element(tag, css, len(self.elements), self.size)
        self.elements.append(element)
        if tag in _VOID:
            element.stop, element.last = self.size, element.order
        else:
            self.open.append(element)
            self.count[tag] += 1

    def handle_endtag(self, tag):
        if self.count[tag] > 0:
            depth = len(self.open) - 1
            while self.open[depth].tag != tag:
                depth -= 1
            self._leave(depth)

    def handle_data(self, data):
        if not (self.open and self.open[-1].tag in ("script", "style")):
            self.parts.append(data)
            self.size += len(data)

    def text(self, element: _Element) -> str:
        return self.whole[element.start : element.stop]

    def all(self, tag: str, css: str | None = None, within: _Element | None = None) -> list[_Element]:
        """Elements with the tag whose class attribute is ``css`` or holds it as one of its words."""
        held = self.elements if within is None else self.elements[within.order + 1 : within.last + 1]
        return [e for e in held if e.tag == tag and (css is None or e.css == css or css in e.css.split())]

    def first(self, tag: str, css: str | None = None, within: _Element | None = None) -> _Element | None:
        return next(iter(self.all(tag, css, within)), None)

    def stripped(self, element: _Element | None) -> str | None:
        return None if element is None else self.text(element).strip()


def _board_b_record(html: str | None) -> dict[str, str | None]:
    """The eight fields a board B job page shows; a field whose element is missing is null."""
    page = _Page(html or "")
    profile = page.first("div", "candidate-profile")
    values = page.all("p", "value", profile) if profile else []
    body = page.first("div", "job-description")
    headings = page.all("p", "heading", body) if body else []
    heading = next((e for e in headings if page.text(e) == "Employment Type"), None)
    job_type = next((e for e in page.all("ul") if heading and e.order > heading.order), None)
    company = page.first("div", "jd-company-desc ng-box")
    return {
        "posted": page.stripped(page.first("p", "jd-timeVal")),
        "Experience": page.stripped(values[0]) if values else None,
        "location": page.stripped(page.first("a", None, profile)) if profile else None,
        "jobType": page.stripped(job_type),
        "Education": page.text(values[2]) if len(values) > 2 else None,
        "description": page.stripped(page.first("article", "job-description")),
        "name": page.stripped(page.first("p", "heading", company)) if company else None,
        "title": page.stripped(page.first("h1", "info-position")),
    }


def _fields_of_batches(batches: Iterable[pa.RecordBatch], page: str) -> Iterator[pa.RecordBatch]:
    """The rows with the fields in place of the column ``page``. Only SLICE pages at a time become Python objects."""
    for batch in batches:
        kept = [name for name in batch.schema.names if name != page]
        for start in range(0, batch.num_rows, SLICE):
            part = batch.slice(start, SLICE)
            found = [_board_b_record(html) for html in part.column(page).to_pylist()]
            fields = [pa.array([r[f] for r in found], pa.string()) for f in FIELDS]
            yield pa.RecordBatch.from_arrays([*map(part.column, kept), *fields], [*kept, *FIELDS])
    pa.default_memory_pool().release_unused()  # a worker keeps what it holds until its next task


def with_job_page_fields(pages: DataFrame, page: str) -> DataFrame:
    """``pages`` with the fields in place of the column ``page``; the function carries this module to the executors.

    No other column may have the name of a field.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    kept = [f for f in pages.schema.fields if f.name != page]
    schema = T.StructType([*kept, *[T.StructField(f, T.StringType()) for f in FIELDS]])
    return pages.mapInArrow(lambda batches: _fields_of_batches(batches, page), schema)
