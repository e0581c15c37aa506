"""HTML that needs a parser: full text and an allow-list sanitiser, by Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html import escape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from postings.functions.html import ALLOWED

#: Tags whose content goes with them, and tags without an end.
DROPPED = ("script", "style", "noscript", "template", "iframe", "svg")
VOID = ("br",)


class _Reader(HTMLParser):
    """Collects text or allowed tags; ``depth`` counts open dropped tags."""

    def __init__(self, tags: bool):
        super().__init__(convert_charrefs=True)
        self.tags, self.out, self.open, self.depth = tags, [], [], 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in DROPPED:
            self.depth += 1
        elif self.tags and not self.depth and tag in ALLOWED:
            self.out.append(f"<{tag}>")
            if tag not in VOID:
                self.open.append(tag)
        elif not self.tags:
            self.out.append(" ")

    def handle_endtag(self, tag: str) -> None:
        if tag in DROPPED:
            self.depth = max(0, self.depth - 1)
        elif self.tags and not self.depth and tag in self.open:
            while self.open:  # what is open inside ends with it
                last = self.open.pop()
                self.out.append(f"</{last}>")
                if last == tag:
                    break
        elif not self.tags:
            self.out.append(" ")

    def handle_data(self, data: str) -> None:
        if not self.depth:
            self.out.append(escape(data, quote=False) if self.tags else data)


def _text(html: str) -> str:
    reader = _Reader(False)
    reader.feed(html)
    reader.close()
    return " ".join("".join(reader.out).split())


def _safe(html: str) -> str:
    reader = _Reader(True)
    reader.feed(html)
    reader.close()
    return "".join(reader.out) + "".join(f"</{t}>" for t in reversed(reader.open))


#: Pages that are turned into Python texts at a time.
SLICE = 100


def _slices(batches: Iterator[pa.Array], work: Callable[[str], str]) -> Iterator[pa.Array]:
    """``work`` of each text; of a batch only SLICE texts at a time are Python objects."""
    for batch in batches:
        for at in range(0, len(batch), SLICE):
            yield pa.array([None if t is None else work(t) for t in batch.slice(at, SLICE).to_pylist()], pa.string())


def _each(c: Column, work: Callable[[str], str]) -> Column:
    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _slices(batches, work)

    return run(c)


def full_text(html: Column) -> Column:
    """Text of any HTML, entities resolved, dangerous content dropped."""
    return _each(html, _text)


def sanitise(html: Column) -> Column:
    """Only allowed tags without attributes, balanced; all other text escaped."""
    return _each(html, _safe)
