"""Text of selected elements in stored HTML pages."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilth.schema import strip
from tilth.sources.collect import stamp

# Elements that never have content.
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
    "source", "track", "wbr",
}
# Start tags that end an open paragraph.
CLOSES_P = {
    "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer",
    "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav",
    "ol", "p", "pre", "section", "table", "ul",
}
HIDDEN = {"script", "style"}


PART = re.compile(
    r"""(?P<tag>\*|[a-zA-Z][\w-]*)|\.(?P<class>[\w-]+)|\#(?P<id>[\w-]+)"""
    r"""|\[\s*(?P<attr>[\w-]+)\s*(?:(?P<how>[~^$*|]?=)\s*(?P<value>"[^"]*"|'[^']*'|[\w-]+)\s*)?\]"""
)


@dataclass(frozen=True)
class Simple:
    """What one element has to be: tag name, id, classes, attributes with comparison and value."""

    tag: str | None
    wanted: tuple[tuple[str, str, str], ...]

    def fits(self, tag: str, attrs: dict[str, str | None]) -> bool:
        if self.tag not in (None, "*", tag):
            return False
        return all(name in attrs and compare(how, attrs[name] or "", value) for name, how, value in self.wanted)


def compare(how: str, found: str, value: str) -> bool:
    """Attribute comparisons of CSS; an empty comparison asks for the attribute alone."""
    match how:
        case "":
            return True
        case "=":
            return found == value
        case "~=":
            return value in found.split()
        case "^=":
            return bool(value) and found.startswith(value)
        case "$=":
            return bool(value) and found.endswith(value)
        case "*=":
            return bool(value) and value in found
    return found == value or found.startswith(value + "-")


def read_selector(selector: str) -> list[list[tuple[str, Simple]]]:
    """Alternatives between commas; each is a chain of (combinator, element), outermost first.

    Combinators are descendant (space) and child (``>``); elements are told by tag, class,
    id and attributes.  Anything else, such as siblings or pseudo classes, raises.
    """
    out: list[list[tuple[str, Simple]]] = []
    chain: list[tuple[str, Simple]] = []
    at, text, link = 0, selector.strip(), " "
    while at < len(text):
        tag, wanted, start = None, [], at
        while found := PART.match(text, at):
            if found["tag"] and at > start:
                break
            if found["tag"]:
                tag = found["tag"].lower()
            elif found["class"]:
                wanted.append(("class", "~=", found["class"]))
            elif found["id"]:
                wanted.append(("id", "=", found["id"]))
            else:
                wanted.append((found["attr"].lower(), found["how"] or "", (found["value"] or "").strip("\"'")))
            at = found.end()
        if at == start:
            raise ValueError(f"unsupported selector: {selector!r}")
        chain.append((link, Simple(tag, tuple(wanted))))
        gap = re.compile(r"\s*([,>])\s*|\s+").match(text, at)
        if gap is None and at < len(text):
            raise ValueError(f"unsupported selector: {selector!r}")
        if gap is None or gap[1] == ",":
            out.append(chain)
            chain, link = [], " "
        else:
            link = gap[1] or " "
        at = gap.end() if gap else at
        if gap and at == len(text):
            raise ValueError(f"unfinished selector: {selector!r}")
    if not out:
        raise ValueError("empty selector")
    return out


class _Selected(HTMLParser):
    """Collects the inner text of elements that one of the selector's chains ends in."""

    def __init__(self, selector: str):
        super().__init__(convert_charrefs=True)
        self.chains = read_selector(selector)
        self.open: list[tuple[str, int | None]] = []
        self.attrs: list[dict[str, str | None]] = []
        self.texts: list[list[str]] = []

    def _above(self, chain: list[tuple[str, Simple]], k: int, level: int) -> bool:
        """Whether the open elements below ``level`` hold the chain's elements before ``k``."""
        if k == 0:
            return True
        link, (_, simple) = chain[k][0], chain[k - 1]
        levels = [level - 1] if link == ">" else range(level - 1, -1, -1)
        return any(i >= 0 and simple.fits(self.open[i][0], self.attrs[i]) and self._above(chain, k - 1, i) for i in levels)

    def _matches(self, tag: str, attrs: dict[str, str | None]) -> bool:
        return any(c[-1][1].fits(tag, attrs) and self._above(c, len(c) - 1, len(self.open)) for c in self.chains)

    def _close(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:], self.attrs[i:]
                return

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P and any(t == "p" for t, _ in self.open):
            self._close("p")
        slot, named = None, dict(attrs)
        if self._matches(tag, named):
            slot = len(self.texts)
            self.texts.append([])
        if tag not in VOID:
            self.open.append((tag, slot))
            self.attrs.append(named)

    def handle_endtag(self, tag):
        self._close(tag)

    def handle_data(self, data):
        if any(t in HIDDEN for t, _ in self.open):
            return
        for _, slot in self.open:
            if slot is not None:
                self.texts[slot].append(data)


def select_text(html: str | None, selector: str) -> list[str]:
    parser = _Selected(selector)
    parser.feed(html or "")
    parser.close()
    return ["".join(t) for t in parser.texts]


def extract_html(
    pages: DataFrame,
    selector: str = "p",
    *,
    html_col: str = "html",
    url_col: str = "url",
    collected_at: datetime | Column | None = None,
) -> DataFrame:
    """One row per non-empty element matching ``selector``, in document order.

    Selectors that :func:`read_selector` does not know raise on the driver.
    """
    read_selector(selector)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame(
                {"url": b[url_col], "texts": [select_text(h, selector) for h in b[html_col]]}
            )

    found = pages.select(url_col, html_col).mapInPandas(parse, "url string, texts array<string>")
    return (
        found.select("url", F.posexplode("texts").alias("position", "text"))
        .withColumn("text", strip("text"))
        .filter(F.col("text") != "")
        .select(
            "text",
            F.concat(F.lit("scrape:"), "url").alias("source"),
            stamp(collected_at).alias("collected_at"),
            "position",
        )
    )
