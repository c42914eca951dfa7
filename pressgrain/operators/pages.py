"""Article fields from fetched web pages.

The page is parsed by the standard library's HTML parser in Arrow batches; the
publisher and the row filters are column expressions.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from pressgrain.functions.text import publisher_from_url
from pressgrain.schemas import PAGE_FIELDS

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements without content, and elements whose text is not prose.
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input "
    "isindex keygen link menuitem meta nextid param source spacer track wbr".split()
)
NOT_PROSE = frozenset(["script", "style", "template"])


class _Page(HTMLParser):
    """Collects title, meta tags, paragraphs and by-line candidates in one pass.

    Open elements form a stack.  A paragraph's text is the run of text pieces
    between its start and end, so each piece is stored once even where
    paragraphs nest.
    """

    def __init__(self, repeat: bool):
        super().__init__(convert_charrefs=True)
        self.repeat = repeat
        self.pieces: list[str] = []
        self.run: list[str] = []
        self.stack: list[dict] = []
        self.title: dict | None = None
        self.metas: dict[str, str] = {}
        self.blocks: list[dict] = []

    def handle_starttag(self, tag, attrs):
        self._end_of_run()
        if tag == "meta":
            found = dict(attrs)
            name = found.get("name")
            if name in ("author", "publish-date") and name not in self.metas:
                self.metas[name] = found["content"] or ""  # only the first tag of a name counts
        if tag == "p" and not self.repeat:
            self._close_to("p")
        node = {"tag": tag, "children": 0, "only": None, "start": len(self.pieces), "end": None}
        self._add_child(node)
        if tag in VOID:
            return
        self.stack.append(node)
        if tag == "title" and self.title is None:
            self.title = node
        if tag in ("p", "div"):
            self.blocks.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._end_of_run()
        self._close_to(tag)

    def handle_comment(self, data):
        self._end_of_run()
        self._add_child("")

    def handle_data(self, data):
        self.run.append(data)

    def finish(self):
        self.close()
        self._end_of_run()
        while self.stack:
            self.stack.pop()["end"] = len(self.pieces)

    def _add_child(self, child):
        if self.stack:
            self.stack[-1]["children"] += 1
            self.stack[-1]["only"] = child

    def _end_of_run(self):
        """Adjacent text becomes one string; blank text one newline or space."""
        if not self.run:
            return
        text = "".join(self.run)
        self.run = []
        if not text.strip(" \n\t\f\r") and not any(n["tag"] in ("pre", "textarea") for n in self.stack):
            text = "\n" if "\n" in text else " "
        self._add_child(text)
        if not self.stack or self.stack[-1]["tag"] not in NOT_PROSE:
            self.pieces.append(text)

    def _close_to(self, tag):
        if any(node["tag"] == tag for node in self.stack):
            while True:
                node = self.stack.pop()
                node["end"] = len(self.pieces)
                if node["tag"] == tag:
                    return

    def text_of(self, node) -> str:
        return "".join(self.pieces[node["start"] : node["end"]])

    def by_line(self) -> str | None:
        for node in self.blocks:
            if not _holds_one_string(node):
                continue
            text = self.text_of(node).strip()
            if text.lower().startswith("by "):
                names = text[3:].split()
                if len(names) <= 3:
                    return " ".join(names)
        return None


def _holds_one_string(node) -> bool:
    """One string inside, directly or through a chain of only children."""
    while isinstance(node, dict):
        if node["children"] != 1:
            return False
        node = node["only"]
    return True


def parse_page(html: str, nested: str = "once") -> tuple | None:
    """(title, author, publish_date, content), or None for a page without title."""
    page = _Page(repeat=nested == "repeat")
    page.feed(html)
    page.finish()
    if page.title is None:
        return None
    author = page.metas["author"] if "author" in page.metas else page.by_line()
    paragraphs = [page.text_of(n) for n in page.blocks if n["tag"] == "p"]
    return page.text_of(page.title), author, page.metas.get("publish-date"), " ".join(paragraphs)


def _parsed(batches: Iterator[pd.Series], nested: str) -> Iterator[pd.DataFrame]:
    for pages in batches:
        rows = []
        for html in pages:
            try:
                rows.append(parse_page(html, nested) if html is not None else None)
            except Exception:  # whatever is wrong with a page, it alone gives no row
                rows.append(None)
        none = (None,) * 4
        yield pd.DataFrame([r or none for r in rows], columns=PAGE_FIELDS.names, dtype=object)


def page_fields(html: str, nested: str) -> Column:
    """struct<title, author, publish_date, content>; a failed page has no title."""
    if nested not in ("once", "repeat"):
        raise ValueError(f"unknown nesting mode {nested!r}")

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        return _parsed(batches, nested)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    # marked nondeterministic so that filters on its output do not run it twice
    return F.pandas_udf(run, PAGE_FIELDS).asNondeterministic()(F.col(html))


def extract_articles(
    pages: DataFrame,
    *,
    url: str = "url",
    html: str = "html",
    status: str | None = None,
    theme: str | None = None,
    nested: str = "once",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One article per page; failed pages and pages without a title give no row.

    ``nested='once'`` ends an open paragraph where the next one starts, so each
    text counts once.  ``nested='repeat'`` lets paragraphs nest: inner text
    counts in the outer paragraph too, as a parser without implied ends sees it.
    ``theme`` names a column to carry as the theme, ``keep`` further ones.
    """
    if status is not None:
        pages = pages.where(F.col(status) == 200)
    tag = F.col(theme) if theme else F.lit(None).cast("string")
    fields = page_fields(html, nested).alias("a")
    return (
        pages.select(*keep, F.col(url).alias("url"), tag.alias("theme"), fields)
        .where(F.col("a.title").isNotNull())
        .select(
            *keep,
            "a.title",
            "a.author",
            "a.publish_date",
            "a.content",
            "theme",
            "url",
            publisher_from_url(F.col("url")).alias("publisher"),
        )
    )


def extract_report(pages: DataFrame, *, html: str = "html", status: str | None = None) -> DataFrame:
    """One row: pages read, dropped for their status, dropped by the parser, kept."""
    ok = F.coalesce(F.col(status) == 200, F.lit(False)) if status else F.lit(True)
    parsed = pages.select(ok.alias("ok"), page_fields(html, "once").alias("a"))
    titled = F.col("a.title").isNotNull()
    return parsed.agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(~F.col("ok")).alias("bad_status"),
        F.count_if(F.col("ok") & ~titled).alias("not_parsed"),
        F.count_if(F.col("ok") & titled).alias("kept"),
    )


def page_title(html: Column) -> Column:
    """Title by pattern alone: the JVM-side form when only the title is needed."""
    raw = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
    return F.when(html.rlike(r"(?is)<title[\s>]"), raw)
