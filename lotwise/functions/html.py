"""HTML text to its strings, landmarks and links.

Only what needs a parser happens here; all field rules are Spark expressions on the result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as t

from lotwise.functions.documents import slices
from lotwise.vocab import DESCRIPTION_HEADING, EQUIPMENT_HEADING

PAGE = t.StructType(
    [
        t.StructField("strings", t.ArrayType(t.StringType())),
        t.StructField("page_text", t.StringType()),
        t.StructField("og_title", t.StringType()),
        t.StructField("listing_title", t.StringType()),
        t.StructField("ad_title", t.StringType()),
        t.StructField("h1", t.StringType()),
        t.StructField("head_title", t.StringType()),
        t.StructField("prime_price", t.StringType()),
        t.StructField("equipment_at", t.IntegerType()),
        t.StructField("description_at", t.IntegerType()),
        t.StructField("links", t.ArrayType(t.StringType())),
        t.StructField("failed", t.BooleanType()),
    ]
)
_VOID = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr".split()
)
_HIDDEN = frozenset(("script", "style", "template"))
_HEADINGS = {EQUIPMENT_HEADING: "equipment_at", DESCRIPTION_HEADING: "description_at"}
_HEADING_TAGS = frozenset(("h2", "h3", "div"))
_LONGEST_HEADING = max(map(len, _HEADINGS))


class _Page(HTMLParser):
    """Collects strings in document order; an element is a range of them."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.strings: list[str] = []
        self.shown: list[bool] = []
        self.pending: list[str] = []
        self.open: list[tuple[str, int, str | None]] = []  # tag, first string, role
        self.found: dict[str, object] = {"links": []}
        self.starts: dict[str, int] = {}
        self.visible: list[int] = []  # strings that show more than white space
        self.depth: Counter[str] = Counter()  # open elements by tag
        self.hidden = 0  # open elements that hide what they hold

    def _flush(self, shown: bool = True) -> None:
        if self.pending:
            self.strings.append("".join(self.pending))
            self.shown.append(shown and not self.hidden)
            if self.shown[-1] and self.strings[-1].strip():
                self.visible.append(len(self.strings) - 1)
            self.pending = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._flush()
        values = dict(reversed(attrs))
        if tag == "meta" and values.get("property") == "og:title":
            self.found.setdefault("og_title", values.get("content"))
        if tag == "a" and values.get("href"):
            self.found["links"].append(values["href"])
        if tag not in _VOID:
            self.open.append((tag, len(self.strings), self._role(tag, values)))
            self.depth[tag] += 1
            self.hidden += tag in _HIDDEN

    def _role(self, tag: str, values: dict) -> str | None:
        test_id = values.get("data-testid")
        if test_id == "listing-title":
            role = "listing_title"
        elif test_id == "prime-price":
            role = "prime_price"
        elif values.get("id") == "ad-title":
            role = "ad_title"
        else:
            role = {"h1": "h1", "title": "head_title"}.get(tag)
        if role in self.starts:
            return None
        if role:
            self.starts[role] = len(self.strings)
        return role

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self._flush()
        if self.depth[tag]:
            while self._close() != tag:
                pass

    def _close(self) -> str:
        tag, first, role = self.open.pop()
        self.depth[tag] -= 1
        self.hidden -= tag in _HIDDEN
        if role or tag in _HEADING_TAGS:
            shown = [s for s, ok in zip(self.strings[first:], self.shown[first:]) if ok] if role else None
            if role == "prime_price":
                self.found[role] = "".join(s.strip() for s in shown)
            elif role == "head_title":
                self.found[role] = "".join(shown)
            elif role:
                self.found[role] = " ".join(s for s in map(str.strip, shown) if s)
        if tag in _HEADING_TAGS:
            self._note_heading(first)
        return tag

    def _note_heading(self, first: int) -> None:
        # every string has a character at least, so a heading spans few of them
        start = bisect_left(self.visible, first)
        if start == len(self.visible) or len(self.visible) - start > _LONGEST_HEADING:
            return
        begin, end = self.visible[start], self.visible[-1] + 1
        if end - begin > 2 * _LONGEST_HEADING:
            return
        text = "".join(s for s, ok in zip(self.strings[begin:end], self.shown[begin:end]) if ok)
        name = _HEADINGS.get(text.strip())
        if name:
            # an outer element closes later but starts earlier: document order means the smaller start
            self.found[name] = min(first, self.found.get(name, first))

    def handle_data(self, data: str) -> None:
        self.pending.append(data)

    def handle_comment(self, data: str) -> None:
        self._flush()
        self.pending = [data]
        self._flush(shown=False)

    def result(self) -> dict:
        self.close()
        self._flush()
        while self.open:
            self._close()
        shown = (s.strip() for s, ok in zip(self.strings, self.shown) if ok)
        return {
            **dict.fromkeys(PAGE.names),
            **self.found,
            "strings": self.strings,
            "page_text": " ".join(s for s in shown if s),
        }


def read_page(html: str | None) -> dict | None:
    """The parts of one page, None when there is no page."""
    if html is None:
        return None
    page = _Page()
    page.feed(html)
    return page.result()


def tolerant_page(html: str | None) -> dict:
    """The parts of one page; a page that cannot be read has none and is marked, the others go on."""
    try:
        return {**(read_page(html) or dict.fromkeys(PAGE.names)), "failed": False}
    except Exception:  # whatever a broken page makes the parser stumble over
        return {**dict.fromkeys(PAGE.names), "failed": True}


@F.pandas_udf(PAGE)
def page_parts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for pages in slices(batches):
        yield pd.DataFrame([tolerant_page(html) for html in pages], columns=PAGE.names)


# or Spark repeats it in the filters that it makes for an explode or pushes down
page_parts = page_parts.asNondeterministic()
