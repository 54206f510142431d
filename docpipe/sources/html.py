"""Pages to a struct of what extraction needs: one Arrow-batched pass of the standard library's HTML parser."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docpipe.session import spread_out

MIN_PAGE = 1000
MIN_CONTENT = 100

# Fixed values of HTML: elements without an end, elements whose text is not page text, elements that end an open <p>.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT = frozenset("script style template".split())
ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())

PAGE = T.StructType(
    [
        T.StructField("meta", T.MapType(T.StringType(), T.StringType())),
        *(T.StructField(n, T.StringType()) for n in ("title", "h1", "datos", "summary_text", "norm_start", "content", "paragraph_text", "raw_title")),
    ]
)


class Node:
    __slots__ = ("tag", "attrs", "kids", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.kids, self.parent = tag, attrs, [], parent

    def walk(self) -> Iterator[Node]:
        """Elements below in document order, without recursion: pages may nest deeply."""
        stack = [k for k in reversed(self.kids) if isinstance(k, Node)]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(k for k in reversed(n.kids) if isinstance(k, Node))

    def strings(self, notes: bool = False) -> Iterator[str]:
        """Text nodes in order; with notes, a <span class="n"> gives one text in square brackets."""
        stack = list(reversed(self.kids))
        while stack:
            k = stack.pop()
            if isinstance(k, str):
                yield k
            elif k.tag in SILENT:
                continue
            elif notes and k.tag == "span" and "n" in k.classes() and (t := " ".join(" ".join(s.strip() for s in k.strings() if s.strip()).split())):
                yield f" [{t}] "
            else:
                stack.extend(reversed(k.kids))

    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def start(self, n: int) -> str:
        """The first n characters of the text as it stands."""
        got, size = [], 0
        for s in self.strings():
            got.append(s)
            size += len(s)
            if size >= n:
                break
        return "".join(got)[:n]

    def text(self, joiner: str = "", stripped: bool = True, notes: bool = False) -> str:
        if not stripped:
            return "".join(self.strings(notes))
        return joiner.join(t for s in self.strings(notes) if (t := s.strip()))


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ENDS_P:
            self._close("p", stop=ENDS_P - {"p"})
        first: dict[str, str] = {}
        for k, v in attrs:
            first.setdefault(k, v or "")
        node = Node(tag, first, self.at)
        self.at.kids.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.at = self.at.parent

    def handle_endtag(self, tag: str) -> None:
        self._close(tag)

    def _close(self, tag: str, stop: frozenset = frozenset()) -> None:
        n = self.at
        while n.parent is not None:
            if n.tag == tag:
                self.at = n.parent
                return
            if n.tag in stop:
                return
            n = n.parent

    def handle_data(self, data: str) -> None:
        self.at.kids.append(data)


# What classes of containers and summaries are called, and what a page title has around it.
_ENTITY = re.compile("&[a-z]+;", re.I | re.A)
_OTHER = re.compile("contenido-norma|content|texto|articulo", re.I)
_SUMMARY = re.compile("resumen|abstract|summary", re.I)


_SITE, _LIBRARY = re.compile(r"^Ley Chile\s*-\s*", re.I), re.compile(r"\s*-\s*Biblioteca del Congreso Nacional$")


def _clean_title(t: str) -> str:
    return _LIBRARY.sub("", _SITE.sub("", t.strip())).strip()


def _any_class(node: Node, pattern: re.Pattern) -> bool:
    return any(pattern.search(c) for c in (*node.classes(), node.attrs.get("class", "")))


def parse_page(html: str) -> dict:
    """The fields of PAGE; null where the page has no such part. paragraph_text is there only where no container will do."""
    b = _Builder()
    b.feed(html)
    b.close()
    out: dict = dict.fromkeys(f.name for f in PAGE.fields)
    out["meta"] = {}
    # the first of each sort of container; whose text is taken only if none before it will do, since they often nest
    first: dict[str, Node] = {}
    paragraphs: list[Node] = []
    for n in b.root.walk():
        cls = n.classes()
        if n.tag == "meta":
            if "name" in n.attrs:
                out["meta"].setdefault(n.attrs["name"], n.attrs.get("content", ""))
        elif n.tag == "title" and out["title"] is None:
            out["title"] = n.text()
        elif n.tag == "h1" and out["h1"] is None:
            out["h1"] = n.text()
        elif n.tag == "p":
            paragraphs.append(n)
        if cls:
            if out["datos"] is None and "datos" in cls:
                out["datos"] = n.text(stripped=False)
            if "norm" not in first and "texto_norma" in cls:
                first["norm"] = n
                out["norm_start"] = n.start(1000)
            if "body" not in first and "cuerpo-norma" in cls:
                first["body"] = n
            if "other" not in first and _any_class(n, _OTHER):
                first["other"] = n
            if out["summary_text"] is None and _any_class(n, _SUMMARY):
                out["summary_text"] = n.text()
    chosen = next((t for k in ("norm", "body", "other") if k in first and len(t := first[k].text("\n\n", notes=True)) >= MIN_CONTENT), None)
    if chosen is None:
        joined = out["paragraph_text"] = "\n\n".join(t for n in paragraphs if (t := n.text())) or None
        chosen = joined if joined and len(joined) >= MIN_CONTENT else None
    if chosen is not None:
        # cleaned here, once: as an expression the optimiser would repeat it in every rule that reads the content
        out["content"] = _ENTITY.sub("", " ".join(chosen.split())).strip()
    # the page's own title: og:title by name, else <title> if longer than 10, else <h1>; here, once, as many rules read it
    title = _clean_title(out["title"] or "")
    out["raw_title"] = _clean_title(out["meta"].get("og:title", "")) or (title if len(title) > 10 else "") or out["h1"] or None
    return out


def with_page(df: DataFrame, html: str, out: str = "page") -> DataFrame:
    """df without its html column and with the struct PAGE of it; a null page gives a null struct.

    A map over batches and not a column function: the optimiser would copy that into every expression that reads a field.
    """
    kept = [c for c in df.columns if c != html]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(out, PAGE)])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = pa.struct([("meta", pa.map_(pa.string(), pa.string())), *((f.name, pa.string()) for f in PAGE.fields[1:])])
        for b in batches:
            for s in range(0, b.num_rows, 256):
                part = b.slice(s, 256)
                pages = [None if h is None else parse_page(h) for h in part.column(len(kept)).to_pylist()]
                rows = [None if p is None else {**p, "meta": list(p["meta"].items())} for p in pages]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(kept))), pa.array(rows, types)], names=[*kept, out])

    return spread_out(df.select(*kept, html)).mapInArrow(parse, schema)


def fetched(df: DataFrame, html: str, status: str | None = None, least: int = MIN_PAGE) -> DataFrame:
    """Pages worth parsing: of status 200, where a status is known, and of a least length. Filters in front of the parser."""
    kept = df.where(F.length(html) >= least)
    return kept if status is None else kept.where(F.col(status) == 200)


def meta(name: str, page: str = "page") -> Column:
    return F.try_element_at(F.col(f"{page}.meta"), F.lit(name))
