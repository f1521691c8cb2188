"""Main text of pages by template deduction over the pages of a host.

A page is a sequence of tokens: tags and texts, each with the path of elements that it
stands in.  Tokens of one host with the same vector of occurrences over its pages form an
equivalence class.  A class is valid if it is on enough pages and holds a tag; the valid
classes of all layouts of a host form its template.  (Neither the order of tokens inside a
class nor the nesting of classes is computed; tokens only carry their path of elements.)
Texts of the template are the site's own; what remains are the slots, of which those in the article's part of the
page are its text.

A vector is represented by an exclusive-or of hashes of (page, count), so classes of a
host with any number of pages come from counts that combine before they are exchanged.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.functions.store import cut
from tilth.llm.text import slices
from tilth.llm.urls import host_of

#: A class is on so many pages of its host at least, however many others the host has.
SUPPORT = 5
TOKENS = re.compile(r"""<!--.*?(?:-->|$)|<!\[CDATA\[.*?\]\]>|<(script|style|noscript|template|textarea|select|svg)\b[^>]*>.*?(?:</\1\s*>|$)|<[/!?]?[a-zA-Z](?:"[^"<]*"|'[^'<]*'|[^'">])*(?:>|$)|<[/!?]?[a-zA-Z][^>]*(?:>|$)|<!?[^>]{0,1}>?|[^<]+""", re.S | re.I)
NAME = re.compile(r"<(/?)([a-zA-Z][\w:-]*)")
#: Attributes in order, so that neither data-class nor the text of another value counts as a class.
NAMED = re.compile(r"""([^\s"'<>/=]+)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Start tags that end an open element of the second set.
ENDS = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}}
#: These keep their content from such ends.
KEEPS = frozenset("table ul ol dl div article section".split())
STOPS = KEEPS.union(*ENDS.values())
OUTSIDE = frozenset("head title nav footer aside form menu dialog button iframe object script style noscript template textarea select svg label".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
#: Parts of class names and ids of what is not the article.
SIGNS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo related replies reply responses search share sharing sidebar signup social sponsor sponsored subscribe tags toolbar widget widgets".split()
)
#: These only outside an article, where they head the page.
HEADERS = frozenset(["header", "topbar", "top"])
#: Names with these words say what a page has, or how it is set, and not what the element is.
BEFORE, AFTER = frozenset("has no is with without not".split()), frozenset("open closed enabled disabled layout".split())
#: These are the page or the article, whatever their names say.
FRAMES = frozenset(["html", "body", "main"])
#: Why a text is outside the article: a form around it, a name, an element or role.
FORM, NAME_SIGN, FIRM = 1, 2, 4


def _hash(*parts: str) -> int:
    return xxhash.xxh64_intdigest("\x00".join(parts)) - (1 << 63)


def _words(names: str) -> set[str]:
    """The words of class names and ids, without names such as has-sidebar or comments-open."""
    parts = [re.findall(r"[a-z]+", x) for x in names.split()]
    return {w for x in parts if x and not BEFORE & set(x[:-1]) and x[-1] not in AFTER for w in x}


class Piece:
    """A run of text in one block: path of elements, text, whether it is inside or outside the article.

    ``lifted``: in an article below which no sign stands, though signs may stand above it.
    """

    __slots__ = ("path", "text", "inside", "outside", "lifted", "linked")

    def __init__(self, path: int, inside: bool, outside: int, lifted: bool) -> None:
        self.path, self.inside, self.outside, self.lifted, self.text, self.linked = path, inside, outside, lifted, [], 0


class Open:
    """An open element: what its children take from it, and its place under others.

    ``path`` and ``blocks`` number the labels of all elements down to it, and of all block
    elements; ``stop`` is the next one at or below it that an implied end can stop at.
    """

    __slots__ = ("name", "path", "blocks", "stop", "inside", "outside", "lifted", "below")

    def __init__(self, name: str, path: int, blocks: int, stop: int, inside: bool, outside: int, lifted: bool, below: bool) -> None:
        self.name, self.path, self.blocks, self.stop = name, path, blocks, stop
        self.inside, self.outside, self.lifted, self.below = inside, outside, lifted, below


def read_page(source: str | None) -> tuple[list[Piece], list[int]]:
    """The text blocks of a page in order, and the paths of its tags in order.

    Each token costs the same however deep it stands: elements know their path as a number,
    and counts of open elements tell what there is to close.
    """
    stack = [Open("", 0, 0, 0, False, 0, False, False)]
    opened: Counter[str] = Counter()
    pieces: list[Piece] = []
    tags: list[int] = []
    piece: Piece | None = None

    def close(until: int) -> None:
        while len(stack) > until:
            opened[stack.pop().name] -= 1

    def last(name: str) -> int:
        at = len(stack) - 1
        while stack[at].name != name:
            at -= 1
        return at

    for found in TOKENS.finditer(source or ""):
        token = found.group()
        if token[0] != "<" or not (head := NAME.match(token)):
            if token[0] == "<" and len(token) > 1 and token[1] in "!?/":
                continue
            if piece is None:
                top = stack[-1]
                piece = Piece(top.blocks, top.inside, top.outside, top.lifted)
                pieces.append(piece)
            piece.text.append(token)
            if opened["a"]:
                piece.linked += len(token)
            continue
        name = head.group(2).lower()
        if found.group(1):  # an element whose content is no text
            if piece is not None:
                piece.text.append(" ")
            continue
        if name in BLOCKS:
            piece = None
        elif name == "br" and piece is not None:
            piece.text.append(" ")
        if head.group(1):
            if opened[name]:
                close(last(name))
            continue
        if name in ENDS:
            at = stack[-1].stop
            while at and stack[at].name not in ENDS[name] and stack[at].name not in KEEPS:
                at = stack[at - 1].stop
            if at and stack[at].name in ENDS[name]:
                close(at)
        elif name in BLOCKS and opened["p"]:
            close(last("p"))  # a block ends an open paragraph
        marks = {k.lower(): v.strip("\"'").lower() for k, v in NAMED.findall(token, head.end()) if k.lower() in ("class", "id", "role")}
        words = set() if name in FRAMES else _words(marks.get("class", "") + " " + marks.get("id", ""))
        top = stack[-1]
        inside, outside, lifted, below = top.inside, top.outside, top.lifted, top.below
        why = FIRM if (name in OUTSIDE and name != "form") or marks.get("role") in ROLES or (not inside and name == "header") else 0
        why |= NAME_SIGN if words & SIGNS or (not inside and words & HEADERS) else 0
        why |= FORM if name == "form" else 0
        if name == "article" and why == NAME_SIGN and not words & SIGNS:
            why = 0
        article = name == "article" or name == "main" or marks.get("role") == "main"
        if article:  # a form around an article is the page's
            outside &= ~FORM
        if article and not below and not (outside | why) & FIRM:
            lifted = True
        elif why:
            lifted = False
        below = below or name == "article"
        label = name + "." + marks.get("class", "") + "#" + re.sub(r"\d+", "", marks.get("id", ""))
        inside = inside or (article and not why)
        path = _hash(str(top.path), label)
        tags.append(path)
        if name not in VOID:
            blocks = _hash(str(top.blocks), label) if name in BLOCKS else top.blocks
            stop = len(stack) if name in STOPS else top.stop
            stack.append(Open(name, path, blocks, stop, inside, outside | why, lifted, below))
            opened[name] += 1
    return pieces, tags


def block_text(parts: list[str]) -> str:
    """Character references decoded, white space to single spaces."""
    return " ".join(html.unescape("".join(parts)).split())


def page_tokens(source: str | None) -> dict[int, tuple[int, bool]]:
    """Token hash -> how often, whether a tag."""
    pieces, tags = read_page(source)
    counts = Counter(_hash("tag", str(t)) for t in tags)
    texts = Counter(_hash("text", str(p.path), block_text(p.text)) for p in pieces)
    return {k: (n, False) for k, n in texts.items()} | {k: (n, True) for k, n in counts.items()}


def templates(pages: DataFrame, html_column: str = "html", host: str = "host") -> DataFrame:
    """``host`` and the hashes of the texts of its template.

    All pages of a class hold all of its tokens, so a class has at most the texts of one
    page, and a host at most as many classes as it has distinct paths of tags.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            rows = []
            for site, page, source in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                rows += [(site, page, key, n, tag) for key, (n, tag) in page_tokens(source).items()]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["host", "page", "token", "n", "tag"])

    # Equal pages are one witness: they say nothing about what varies.
    distinct = pages.select(F.col(host).alias("host"), F.xxhash64(F.coalesce(F.col(html_column), F.lit(""))).alias("page"), F.col(html_column).alias("html"))
    tokens = distinct.mapInArrow(run, "host string, page long, token long, n long, tag boolean").dropDuplicates(["host", "page", "token"])
    vectors = tokens.groupBy("host", "token").agg(
        F.expr("bit_xor(xxhash64(page, n))").alias("vector"), F.count("*").alias("on"), F.max("tag").alias("tag")
    )
    # What is on few pages is most of all tokens and no template's; the rest is small.
    often = vectors.filter(F.col("on") >= SUPPORT)
    classes = often.groupBy("host", "vector", "on").agg(F.max("tag").alias("tagged"), F.collect_list(F.when(~F.col("tag"), F.col("token"))).alias("texts"))
    return classes.filter("tagged and size(texts) > 0").groupBy("host").agg(F.flatten(F.collect_list("texts")).alias("texts"))


def extract(source: str | None, template: set[int]) -> str:
    """The article's blocks, without the template's texts, in page order."""
    pieces, _ = read_page(source)
    found = [(p, block_text(p.text)) for p in pieces]
    found = [(p, t) for p, t in found if t]
    clean = [(p, t) for p, t in found if not p.outside]
    if any(p.inside for p, _ in clean):
        found = [(p, t) for p, t in clean if p.inside]
    else:
        # No element marks the article: leave out what is links only.  Where an article stands
        # below signs, or all stands in a form, and is longer than the rest, it is the page's text.
        clean = [(p, t) for p, t in clean if 2 * p.linked < len(t)]
        below = [(p, t) for p, t in found if p.lifted]
        formed = [(p, t) for p, t in found if p.outside in (0, FORM) and 2 * p.linked < len(t)]
        size = sum(len(t) for _, t in clean)
        if sum(len(t) for _, t in below) > size:
            found = below
        else:
            found = formed if sum(len(t) for _, t in formed) > 2 * size else clean
    slots = [t for p, t in found if _hash("text", str(p.path), t) not in template]
    return "\n\n".join(slots)


def main_text(pages: DataFrame, html_column: str = "html", url: str = "url", out: str = "text") -> DataFrame:
    """``pages`` with the main text of each page in place of its html.

    A null or empty page has an empty text; pages without a host form a host of their
    own; a host with fewer than ``SUPPORT`` different pages has no template, and all its
    slots stay.  Repeated pages count once for the template and are rows of the result.
    """
    sited = pages.drop(out, "__host", "__texts").withColumn("__host", host_of(url))
    # Written, so that its size is known: small ones are broadcast and others joined by host.
    known = cut(templates(sited, html_column, "__host")).select(F.col("host").alias("__site"), F.col("texts").alias("__texts"))
    joined = sited.join(known, F.col("__host") == F.col("__site"), "left").drop("__site", "__host")
    fields = [f for f in joined.schema.fields if f.name not in (html_column, "__texts")]
    schema = T.StructType([*fields, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, set[int]] = {}
        for batch in slices(batches, html_column):
            texts = []
            for source, template in zip(batch.column(html_column).to_pylist(), batch.column("__texts").to_pylist(), strict=True):
                key = tuple(template or ())
                if key not in held:
                    held.clear() if len(held) > 500 else None
                    held[key] = set(key)
                texts.append(extract(source, held[key]))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in fields), pa.array(texts, pa.string())], names=schema.names)

    return joined.mapInArrow(run, schema)


def texts(pages: DataFrame) -> DataFrame:
    return main_text(pages.select("page_id", "url", "html")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
