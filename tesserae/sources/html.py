"""HTML to rows on the standard parser: a small tree, text with links, tables with spans, infoboxes, markdown, main text."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.session import spread

VOID = {"br", "img", "hr", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
CLOSES = {"tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "li": {"li"}, "p": {"p"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "thead": {"tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
BARRIERS = {"table", "ul", "ol", "body", "html", "div"}
HIDDEN = {"script", "style", "noscript", "template"}
NOTE = re.compile(r"\[[\d ]+\]")
BRACKETS = re.compile(r"\s*\[[^\]]*\]")


class Node:
    __slots__ = ("attrs", "kids", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, parent: Node | None = None) -> None:
        self.tag, self.attrs, self.parent = tag, attrs or {}, parent
        self.kids: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(k for k in reversed(n.kids) if isinstance(k, Node))

    def all(self, *tags: str) -> list[Node]:
        return [n for n in self.walk() if n.tag in tags and n is not self]

    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()


class TreeBuilder(HTMLParser):
    """A forgiving tree: void tags have no content, and open cells, rows, items and paragraphs end where the next begins."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root")

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        ends = CLOSES.get(tag)
        n: Node | None = self.at
        last = None
        while ends and n is not None and n.tag not in BARRIERS:
            if n.tag in ends:
                last = n
            n = n.parent
        if last is not None:
            self.at = last.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.kids.append(node)
        if tag not in VOID:
            self.at = node

    def handle_endtag(self, tag: str) -> None:
        n: Node | None = self.at
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.at = n.parent

    def handle_data(self, data: str) -> None:
        self.at.kids.append(data)


def parse(html: str) -> Node:
    b = TreeBuilder()
    b.feed(html)
    b.close()
    return b.root


def text_and_links(node: Node) -> tuple[str, list[str]]:
    """The text of an element and the targets of its links: line breaks kept, note marks and edit links dropped unless
    nothing else is left, runs of blanks made one."""
    parts: list[str] = []
    urls: list[str] = []

    def visit(n: Node) -> None:
        for k in n.kids:
            if isinstance(k, str):
                parts.append(k)
            elif k.tag == "br":
                parts.append("\n")
            elif k.tag not in HIDDEN:
                if k.tag == "a" and k.attrs.get("href"):
                    urls.append(k.attrs["href"])
                visit(k)

    visit(node)
    text = " ".join(p.strip(" ") if p != "\n" else p for p in parts if p.strip(" "))
    bare = NOTE.sub("", text)
    text = (bare if bare.strip() else text).replace("[ edit ]", "")
    return re.sub(r" +", " ", re.sub(r" *\n *", "\n", text)).strip(), urls


def grid_of(table: Node) -> tuple[list[list[tuple[str, str | None]]], int]:
    """(rows of (text, href), number of header rows) with row and column spans filled in; nested tables aren't entered."""
    rows: list[list[tuple[str, str | None]]] = []
    heads: list[bool] = []
    carry: dict[int, tuple[int, tuple[str, str | None]]] = {}

    def trs(n: Node) -> Iterator[Node]:
        for k in n.kids:
            if isinstance(k, Node):
                if k.tag == "tr":
                    yield k
                elif k.tag != "table":
                    yield from trs(k)

    for tr in trs(table):
        cells = [k for k in tr.kids if isinstance(k, Node) and k.tag in ("td", "th")]
        row: list[tuple[str, str | None]] = []
        nxt: dict[int, tuple[int, tuple[str, str | None]]] = {}
        j = 0

        def carried(j: int, row: list, nxt: dict) -> int:
            while j in carry:
                left, cell = carry[j]
                row.append(cell)
                if left > 1:
                    nxt[j] = (left - 1, cell)
                j += 1
            return j

        j = carried(j, row, nxt)
        for cell in cells:
            text, urls = text_and_links(cell)
            value = (text, urls[0] if urls else None)
            span = lambda a, cell=cell: max(1, int(m.group())) if (m := re.match(r"\d+", cell.attrs.get(a, ""))) else 1
            for _ in range(min(span("colspan"), 1000)):  # the HTML standard clamps it to 1,000
                row.append(value)
                if span("rowspan") > 1:
                    nxt[j] = (span("rowspan") - 1, value)
                j = carried(j + 1, row, nxt)
        carry = nxt
        if row:
            rows.append(row)
            heads.append(bool(cells) and all(x.tag == "th" for x in cells))
    n_head = 0
    while n_head < len(heads) and heads[n_head]:
        n_head += 1
    if n_head == len(rows):
        n_head = min(1, n_head)
    return rows, n_head


def unnamed(name: str) -> bool:
    return not name or bool(re.match(r"Unnamed: \d+", name))


def shaped(rows: list[list[tuple[str, str | None]]], n_head: int) -> tuple[list[str], list[str], list[list[tuple[str | None, str | None]]]]:
    """(header levels, column names, body): upper header rows of at most one name become levels, the others are joined
    to the names with ' -- '; names and cells lose their bracket notes unless nothing else is left."""
    width = max((len(r) for r in rows), default=0)
    pad = lambda r: r + [("", None)] * (width - len(r))
    head = [[c[0] for c in pad(r)] for r in rows[:n_head]]
    levels: list[str] = []
    while len(head) > 1:
        named = list(dict.fromkeys(x for x in head[0] if not unnamed(x)))
        if len(named) > 1:
            break
        levels += named
        head.pop(0)
    names = []
    for j in range(width):
        if not head:
            names.append(str(j))
            continue
        upper = [h[j] for h in head[:-1] if not unnamed(h[j])]
        names.append(BRACKETS.sub("", " -- ".join([*upper, head[-1][j]])).strip())

    def clean(x: str) -> str | None:
        t = x.replace("\n", "; ").strip()
        return (BRACKETS.sub("", t).strip() or t) or None

    return levels, names, [[(clean(t), h) for t, h in pad(r)] for r in rows[n_head:]]


CELLS = "row_idx int, col_idx int, col_name string, text string, href string"


def cells(df: DataFrame, key: str, html: str) -> DataFrame:
    """(key, row_idx, col_idx, col_name, text, href) of the first table of every row's HTML; null or table-less gives none."""
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for k, h in zip(b[key].tolist(), b[html].tolist(), strict=True):
                tables = parse(h).all("table")
                if tables:
                    _, names, body = shaped(*grid_of(tables[0]))
                    out += [(k, i, j, names[j], t, u) for i, r in enumerate(body) for j, (t, u) in enumerate(r)]
            yield pd.DataFrame(out, columns=[key, "row_idx", "col_idx", "col_name", "text", "href"])

    return spread(df.where(F.col(html).isNotNull()).select(key, html)).mapInPandas(run, f"{key} {kind}, {CELLS}")


def heading_path(node: Node) -> str | None:
    """The section an element stands in: the nearest heading before it and the higher ones above, joined by ' / '."""
    level = lambda n: int(n.tag[1]) if re.fullmatch(r"h[1-6]", n.tag) else next((int(c[-1]) for c in n.classes() if re.fullmatch(r"mw-heading[1-6]", c)), 0)
    names: list[str] = []
    bound = 7
    at: Node | None = node
    while at is not None and at.parent is not None:
        before = at.parent.kids[: at.parent.kids.index(at)]
        for k in reversed(before):
            if isinstance(k, Node) and 0 < (v := level(k)) < bound:
                names.insert(0, text_and_links(k)[0])
                bound = v
        at = at.parent
    return " / ".join(names) or None


def hatnote(node: Node) -> tuple[str, list[str]] | None:
    """The nearest hatnote before an element on its own level or its parent's; null without one."""
    at: Node | None = node
    for _ in range(2):
        if at is None or at.parent is None:
            return None
        for k in reversed(at.parent.kids[: at.parent.kids.index(at)]):
            if isinstance(k, Node) and "hatnote" in k.classes():
                return text_and_links(k)
        at = at.parent
    return None


def route(node: Node) -> str:
    """What becomes of a table by its classes: infobox, skip (navigation or empty) or table."""
    names = " ".join(node.classes())
    if "infobox" in names:
        return "infobox"
    if "navbox" in names or "sidebar" in names or not text_and_links(node)[0]:
        return "skip"
    return "table"


PAGE_TABLES = "page_id bigint, ordinal int, route string, section string, caption string, caption_urls array<string>, headers array<struct<text: string, urls: array<string>>>, hatnote string, hatnote_urls array<string>, levels array<string>, cells array<struct<row_idx: int, col_idx: int, col_name: string, text: string, href: string>>"


def page_tables(pages: DataFrame) -> DataFrame:
    """Every table of (page_id, html) with its context; ordinal counts all table tags from 1, nested and skipped ones too."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for pid, h in zip(b["page_id"].tolist(), b["html"].tolist(), strict=True):
                for i, t in enumerate(parse(h).all("table"), 1):
                    r = route(t)
                    cap = next((text_and_links(k) for k in t.kids if isinstance(k, Node) and k.tag == "caption"), (None, None))
                    heads = [dict(zip(("text", "urls"), text_and_links(x), strict=True)) for x in t.all("th")]
                    note = hatnote(t)
                    levels, got = [], []
                    if r == "table":
                        levels, names, body = shaped(*grid_of(t))
                        got = [{"row_idx": a, "col_idx": j, "col_name": names[j], "text": x, "href": u} for a, row in enumerate(body) for j, (x, u) in enumerate(row)]
                    out.append((pid, i, r, heading_path(t), *cap, heads, note[0] if note else None, note[1] if note else None, levels, got))
            yield pd.DataFrame(out, columns=["page_id", "ordinal", "route", "section", "caption", "caption_urls", "headers", "hatnote", "hatnote_urls", "levels", "cells"])

    return pages.where(F.col("html").isNotNull()).select("page_id", "html").mapInPandas(run, PAGE_TABLES)


def nested_rows(table: Node) -> list:
    """A table inside a cell: one entry a row, of one cell its text, of two a pair, else the list of its texts."""
    out: list = []
    for tr in (k for k in _direct_rows(table)):
        texts = [text_and_links(x)[0] for x in tr.kids if isinstance(x, Node) and x.tag in ("th", "td")]
        if texts:
            out.append(texts[0] if len(texts) == 1 else {texts[0]: texts[1]} if len(texts) == 2 else texts)
    return out


def _direct_rows(table: Node) -> Iterator[Node]:
    for k in table.kids:
        if isinstance(k, Node) and k.tag == "tr":
            yield k
        elif isinstance(k, Node) and k.tag in ("tbody", "thead", "tfoot"):
            yield from (x for x in k.kids if isinstance(x, Node) and x.tag == "tr")


def cell_value(td: Node) -> str:
    """A cell's text, or the rows of the table in it as JSON."""
    inner = td.all("table")
    return json.dumps(nested_rows(inner[0]), ensure_ascii=False) if inner else text_and_links(td)[0]


def footnotes(table: Node) -> list[str]:
    """The texts of a box's reference marks, in order."""
    return [text_and_links(x)[0] for x in table.all("sup") if "reference" in " ".join(x.classes())]


def infobox_rows(table: Node, lose_last: bool = True) -> list[tuple[str, int, str | None, str | None]]:
    """(section, position, label, value): rows between header rows form sections, General before the first and for a
    blank header; sections of one name go on; the last row only ends the box unless lose_last is off. Of a label that a
    section has twice the last value holds. A label alone in a data row has an empty value, a value alone no label, and a
    table in a cell is given as JSON."""
    rows = [r for r in table.all("tr") if not any(p.tag == "td" for p in _ancestors(r, table))]
    section = "General"
    sections: dict[str, dict[str, tuple[str | None, str | None]]] = {}
    for tr in rows[:-1] if lose_last else rows:
        th = [k for k in tr.kids if isinstance(k, Node) and k.tag == "th"]
        td = [k for k in tr.kids if isinstance(k, Node) and k.tag == "td"]
        if th and not td and "infobox-label" not in " ".join(th[0].classes()):
            section = text_and_links(th[0])[0] or "General"
            sections.setdefault(section, {})
            continue
        label = text_and_links(th[0])[0] if th else None
        value = "; ".join(filter(None, map(cell_value, td)))
        if label or value:
            at = sections.setdefault(section, {})
            at[label if label else f"#{len(at)}"] = (label, value)
    return [(s, i, a, v) for s, got in sections.items() for i, (a, v) in enumerate(got.values())]


def _ancestors(n: Node, stop: Node) -> Iterator[Node]:
    while n.parent is not None and n.parent is not stop:
        n = n.parent
        yield n


def infoboxes(df: DataFrame, key: str, html: str, lose_last: bool = True) -> DataFrame:
    """(key, section, item_idx, label, value) of the first infobox table of every row's HTML."""
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for k, h in zip(b[key].tolist(), b[html].tolist(), strict=True):
                box = next((t for t in parse(h).all("table") if "infobox" in " ".join(t.classes())), None)
                if box is not None:
                    out += [(k, *x) for x in infobox_rows(box, lose_last)]
            yield pd.DataFrame(out, columns=[key, "section", "item_idx", "label", "value"])

    return spread(df.where(F.col(html).isNotNull()).select(key, html)).mapInPandas(run, f"{key} {kind}, section string, item_idx int, label string, value string")


BLOCKS = {"p", "div", "section", "article", "ul", "ol", "table", "tr", "blockquote", "pre", "main", "figure"}
FURNITURE = {"nav", "footer", "aside", "form", "header", "button", "svg", "iframe"}


def to_markdown(node: Node, main_only: bool = False) -> str:
    """ATX headings, list items, table rows as pipes, images as ![alt](image), links as their text; scripts and styles go.
    With main_only navigation, footers, forms and comments go as well."""
    out: list[str] = []

    def visit(n: Node, depth: int) -> None:
        for k in n.kids:
            if isinstance(k, str):
                out.append(re.sub(r"\s+", " ", k))
                continue
            if k.tag in HIDDEN or (main_only and (k.tag in FURNITURE or re.search(r"\b(?:nav|menu|footer|cookie|sidebar|comments?|share)\b", " ".join(k.classes())))):
                continue
            if re.fullmatch(r"h[1-6]", k.tag):
                out.append("\n\n" + "#" * int(k.tag[1]) + " " + text_and_links(k)[0] + "\n\n")
            elif k.tag == "br":
                out.append("\n")
            elif k.tag == "img":
                out.append(f"![{k.attrs.get('alt', '')}](image)")
            elif k.tag == "li":
                out.append("\n" + "  " * depth + "- ")
                visit(k, depth + 1)
            elif k.tag == "tr":
                row = [text_and_links(x)[0].replace("\n", " ") for x in k.kids if isinstance(x, Node) and x.tag in ("td", "th")]
                out.append("\n| " + " | ".join(row) + " |")
            else:
                if k.tag in BLOCKS:
                    out.append("\n\n" if k.tag != "div" else "\n")
                visit(k, depth)
                if k.tag in BLOCKS:
                    out.append("\n\n" if k.tag != "div" else "\n")

    visit(node, 0)
    text = re.sub(r"[ \t]*\n[ \t]*", "\n", "".join(out))
    return re.sub(r"\n{3,}", "\n\n", text).strip()


def markdown_of(html: str, main_only: bool = False):  # noqa: ANN201
    """The column of a page's markdown."""

    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda h: None if h is None else to_markdown(parse(h), main_only))

    return F.pandas_udf(run, "string")(html)


def texts_and_links(html: str):  # noqa: ANN201
    """The column of an element's text and link targets."""

    def run(s: pd.Series) -> pd.DataFrame:
        got = [("", []) if h is None else text_and_links(parse(h)) for h in s.tolist()]
        return pd.DataFrame(got, columns=["text", "urls"])

    return F.pandas_udf(run, "text string, urls array<string>")(html)
