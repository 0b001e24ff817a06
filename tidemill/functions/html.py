"""HTML to blocks and Markdown.

One Arrow UDF turns a page into an array of ``(tag, text)`` in document
order; everything after it is native, and no shuffle is needed because a
page's blocks stay in its row.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed
from .batches import text_slices

BLOCK_ARRAY = pa.list_(pa.struct([("tag", pa.string()), ("text", pa.string())]))

_FURNITURE = frozenset(fixed.FURNITURE_TAGS)
_BLOCKS = frozenset(fixed.BLOCK_TAGS)
_VOID = frozenset(fixed.VOID_TAGS)
_OWN_TEXT = frozenset(fixed.OWN_TEXT_TAGS)


class _Blocks(HTMLParser):
    """Collects the text of block elements while following open elements.

    An end tag closes the nearest open element of its name and everything
    inside it; an end tag without a partner is ignored; what is never closed
    ends with its parent.  A block inside a block is emitted by itself and its
    text also belongs to the outer one.  ``close_open_p`` ends an open
    paragraph when the next block starts, as browsers do.
    """

    def __init__(self, close_open_p: bool):
        super().__init__(convert_charrefs=True)
        self.close_open_p = close_open_p
        self.open: list[tuple[str, list[str] | None]] = []
        self.open_count: dict[str, int] = {}
        self.hidden = 0  # open furniture elements
        self.own_text = 0  # open elements that keep their text to themselves
        self.blocks: list[tuple[str, list[str]]] = []
        self.texts: list[str] = []  # stripped text nodes seen so far
        self.node: list[str] = []  # pieces of the current text node

    def end_node(self) -> None:
        if self.node:
            text = "".join(self.node).strip()
            self.node = []
            if text and not self.hidden and not self.own_text:
                for _, collected in self.open:
                    if collected is not None:
                        collected.append(text)

    def handle_starttag(self, tag, attrs):
        self.end_node()
        if tag in _VOID:
            return
        if self.close_open_p and tag in _BLOCKS and self.open_count.get("p"):
            self.end_element("p")
        collected = None
        if tag in _FURNITURE:
            self.hidden += 1
        elif tag in _BLOCKS and not self.hidden:
            collected = []
            self.blocks.append((tag, collected))
        if tag in _OWN_TEXT:
            self.own_text += 1
        self.open.append((tag, collected))
        self.open_count[tag] = self.open_count.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.end_node()
        if self.open_count.get(tag):
            self.end_element(tag)

    def end_element(self, tag):
        name = None
        while name != tag:
            name, _ = self.open.pop()
            self.open_count[name] -= 1
            self.hidden -= name in _FURNITURE
            self.own_text -= name in _OWN_TEXT

    def handle_data(self, data):
        self.node.append(data)

    def handle_comment(self, data):
        self.end_node()

    def handle_decl(self, decl):
        self.end_node()

    def handle_pi(self, data):
        self.end_node()

    def unknown_decl(self, data):
        self.end_node()
        if data.upper().startswith("CDATA["):
            self.node.append(data[len("CDATA[") :])
            self.end_node()


def blocks_of(html: str, close_open_p: bool = False) -> list[dict]:
    parser = _Blocks(close_open_p)
    parser.feed(html)
    parser.close()
    parser.end_node()
    found = ((tag, "".join(texts)) for tag, texts in parser.blocks)
    return [{"tag": tag, "text": text} for tag, text in found if text]


def html_blocks(c: Column, close_open_p: bool = False) -> Column:
    """Non-empty blocks of a page as ``ARRAY<STRUCT<tag, text>>``, in document order."""

    @F.arrow_udf("array<struct<tag:string,text:string>>")
    def parse(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for pages in text_slices(batch):
                yield pa.array([None if p is None else blocks_of(p, close_open_p) for p in pages.to_pylist()], BLOCK_ARRAY)

    # Nondeterministic in name: a filter on the result must not be pushed below
    # it, which would parse every page twice.
    return parse.asNondeterministic()(c)


def render_markdown(blocks: Column) -> Column:
    """Blocks as Markdown lines joined by newlines."""

    def line(b: Column) -> Column:
        tag, text = b["tag"], b["text"]
        return (
            F.when(tag == "h1", F.concat(F.lit("\n# "), text, F.lit("\n")))
            .when(tag == "h2", F.concat(F.lit("\n## "), text, F.lit("\n")))
            .when(tag == "h3", F.concat(F.lit("\n### "), text, F.lit("\n")))
            .when(tag == "h4", F.concat(F.lit("\n#### "), text, F.lit("\n")))
            .when(tag == "li", F.concat(F.lit("- "), text))
            .when(tag.isin("pre", "code"), F.concat(F.lit("\n```\n"), text, F.lit("\n```\n")))
            .otherwise(text)
        )

    return F.array_join(F.transform(blocks, line), "\n")


def html_to_markdown(c: Column, close_open_p: bool = False) -> Column:
    return render_markdown(html_blocks(c, close_open_p))
