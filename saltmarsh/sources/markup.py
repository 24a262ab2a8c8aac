"""Text of HTML, JATS and other XML, and PDF files.

Documents come as rows (path, content): `spark.read.format("binaryFile")`, or a table. The format
follows the extension, else the first bytes. HTML is read by the standard library's tolerant parser and XML by its
event parser, what is read before an error being kept; PDF needs an installed reader and is else left out.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame

from ..functions.values import ABSTRACT_PATTERN

DROPPED = {"script", "style", "nav", "footer", "header", "noscript"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_ABSTRACT = re.compile(ABSTRACT_PATTERN)


def clean(text: str | None) -> str:
    """Line ends, blank lines and blanks put right."""
    text = (text or "").replace("\r", "\n").replace("\xa0", " ")
    return re.sub(r"[ \t]{2,}", " ", re.sub(r"\n{3,}", "\n\n", text)).strip()


def abstract_in(text: str) -> str:
    m = _ABSTRACT.search(text)
    return clean(m[1]) if m else ""


class Node:
    """An element: tag, attributes, children (nodes and strings)."""

    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []

    def walk(self) -> Iterator["Node"]:
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            stack += [c for c in reversed(n.children) if isinstance(c, Node)]

    def strings(self) -> Iterator[str]:
        stack: list = [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                yield n
            else:
                stack += reversed(n.children)

    def text(self, by: str) -> str:
        return by.join(t for s in self.strings() if (t := s.strip()))

    def find(self, tag: str, test: Callable[["Node"], bool] = lambda n: True) -> "Node | None":
        return next((n for n in self.walk() if n.tag == tag and test(n)), None)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]
        self.skip = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.skip or tag in DROPPED:
            self.skip += tag in DROPPED
            return
        n = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(n)
        if tag not in VOID:
            self.open.append(n)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if not self.skip and tag not in DROPPED:
            self.open[-1].children.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag: str) -> None:
        if self.skip:
            self.skip -= tag in DROPPED
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                break

    def handle_data(self, data: str) -> None:
        if not self.skip:
            self.open[-1].children.append(data)


def html(data: bytes) -> dict | None:
    """Title, abstract and text of a page; None for too little text."""
    b = _Builder()
    b.feed(data.decode("utf-8", "replace"))
    b.close()
    root = b.root

    def meta(key: str, value: str) -> str:
        n = root.find("meta", lambda n: n.attrs.get(key) == value)
        return n.attrs.get("content", "") if n else ""

    def said(tag: str) -> str:
        n = root.find(tag)
        return n.text(" ") if n else ""

    title = meta("name", "citation_title") or meta("property", "og:title") or said("title") or said("h1")
    body = root.find("article") or root.find("main") or root.find("div", lambda n: re.search("article|content|body", n.attrs.get("class", ""), re.I)) or root.find("body") or root
    text = clean(body.text("\n"))
    abstract = meta("name", "description") or meta("name", "citation_abstract") or abstract_in(text[:8000])
    return _enough("html", title, abstract, text)


def _enough(kind: str, title: str, abstract: str, text: str, sections: list | None = None, least: int = 200) -> dict | None:
    if len(text) < least and len(abstract) < 120:
        return None
    return {"format": kind, "title": title, "abstract": abstract, "full_text": text, "sections": sections or []}


def _tree(data: bytes) -> ElementTree.Element | None:
    """The root; of broken XML what was read before the error."""
    p = ElementTree.XMLPullParser(("start",))
    root = None
    try:
        p.feed(data)
        p.close()
    except ElementTree.ParseError:
        pass
    for _, e in p.read_events():
        root = e if root is None else root
    return root


def _local(e: ElementTree.Element) -> str:
    return e.tag.rpartition("}")[2] if isinstance(e.tag, str) else ""


def _said(e: ElementTree.Element | None) -> str:
    return clean("".join(e.itertext())) if e is not None else ""


def _all(e: ElementTree.Element, name: str) -> list[ElementTree.Element]:
    return [x for x in e.iter() if _local(x) == name]


def _children(e: ElementTree.Element, name: str) -> list[ElementTree.Element]:
    return [x for x in e if _local(x) == name]


def jats(data: bytes, generic_title: bool = False, headings_alone: bool = False) -> dict | None:
    """Title, abstract and sections of an article (S24); with a generic title, and sections kept for their heading alone, as chunking wants it."""
    root = _tree(data)
    if root is None:
        return None
    first = lambda n: _said(next(iter(_all(root, n)), None))
    title, abstract = first("article-title") or (first("title") if generic_title else ""), first("abstract")
    body, sections = next(iter(_all(root, "body")), None), []
    if body is not None:
        for s in _all(body, "sec"):
            heading = _said(next(iter(_children(s, "title")), None))
            text = "\n".join(t for p in _children(s, "p") if (t := _said(p)))
            if text or (headings_alone and heading):
                sections.append({"heading": heading, "text": text})
        if not sections and (text := "\n".join(t for p in _all(body, "p") if (t := _said(p)))):
            sections.append({"heading": "", "text": text})
    text = "\n\n".join(f"## {s['heading']}\n{s['text']}".strip() if s["heading"] else s["text"] for s in sections)
    return _enough("xml", title, abstract, text or _said(root), sections)


def other_xml(data: bytes) -> dict | None:
    """Any XML: a title, something like an abstract, all text."""
    root = _tree(data)
    if root is None:
        return None
    text = _said(root)
    title = _said(next(iter(_all(root, "title")), None))
    abstract = _said(next((e for e in root.iter() if "abstract" in _local(e)), None)) or abstract_in(text[:6000])
    return _enough("xml", title, abstract, text)


def pdf(data: bytes, least: int = 200) -> dict | None:
    """Text of a PDF's pages (S22, S23); None without a reader or with too little text."""
    try:
        import fitz
    except ImportError:
        return None
    with fitz.open(stream=data, filetype="pdf") as doc:
        pages = [t.strip() for p in doc if (t := p.get_text("text")) and t.strip()]
    text = clean("\n\n".join(pages))
    if not text or len(text) < least:
        return None
    lines = [x.strip() for x in text.splitlines() if x.strip()]
    return {"format": "pdf", "title": lines[0][:300] if lines else "", "abstract": abstract_in("\n".join(lines[:200])), "full_text": text, "sections": [], "pages": len(pages)}


def by_format(path: str, data: bytes) -> dict | None:
    """By extension, else by the first 300 bytes."""
    name, head = path.lower(), data[:300]
    if name.endswith(".xml") or (not name.endswith((".pdf", ".html", ".htm")) and not head.startswith(b"%PDF") and (b"<?xml" in head or b"<article" in head)):
        return jats(data) or other_xml(data)
    if name.endswith(".pdf") or head.startswith(b"%PDF"):
        return pdf(data)
    if name.endswith((".html", ".htm")) or b"<html" in head.lower():
        return html(data)
    return None


def strict_format(path: str, data: bytes) -> dict | None:
    """XML and PDF only; ValueError for others."""
    if path.lower().endswith(".xml"):
        return jats(data, True, True) or other_xml(data)
    if path.lower().endswith(".pdf"):
        return pdf(data, 0)
    raise ValueError(f"unsupported file type: {path}")


def extracted(files: DataFrame, key: str = "path", strict: bool = False) -> DataFrame:
    """key, format, title, abstract, full_text, sections, pages, error of rows (path, content); failed ones have an error and no text."""
    take = strict_format if strict else by_format
    kind = files.schema[key].dataType.simpleString()
    names = ["format", "title", "abstract", "full_text", "sections", "pages", "error"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, path, data in zip(batch[key], batch["path"], batch["content"], strict=True):
                try:
                    got, error = take(path, data or b""), None
                    error = None if got else "no text"
                except Exception as e:  # one bad file must not end the job
                    got, error = None, f"{type(e).__name__}: {e}"
                got = got or {}
                out.append([k, *[got.get(n) for n in names[:-1]], error])
            yield pd.DataFrame(out, columns=["_key", *names])

    rows = files.selectExpr(f"`{key}` AS `{key}`", *([] if key == "path" else ["path"]), "content")
    return rows.mapInPandas(run, f"_key {kind}, format string, title string, abstract string, full_text string, sections array<struct<heading:string,text:string>>, pages int, error string").withColumnRenamed("_key", key)
