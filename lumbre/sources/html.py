"""Rows, forms and totals of listing pages, with the standard library's parser."""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PER_PAGE = 10
LABELS = {"precalificadas": ("Viviendas Precalificadas", 0), "calificadas": ("Viviendas Calificadas", 1)}
TOTAL = r"Se\s+ha\s*\(?n\)?\s+encontrado\s+([\d.]+)\s+Vivienda"
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class Node:
    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def find(self, tag: str) -> list[Node]:
        """Descendants of a tag, in document order; without recursion, pages may be nested deeply."""
        out, stack = [], list(reversed(self.children))
        while stack:
            x = stack.pop()
            if isinstance(x, Node):
                if x.tag == tag:
                    out.append(x)
                stack += reversed(x.children)
        return out

    def text(self) -> str:
        parts, stack = [], list(reversed(self.children))
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                parts.append(x.strip())
            elif x.tag not in ("script", "style"):
                stack += reversed(x.children)
        return " ".join(p for p in parts if p)


class Tree(HTMLParser):
    def __init__(self, html: str):
        super().__init__()
        self.root = self.at = Node("", {}, None)
        self.feed(html)
        self.close()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def visible(cell: Node) -> bool:
    kinds = cell.attrs.get("class", "").lower().split()
    return not ({"hidde", "hidden"} & set(kinds)) and "display:none" not in cell.attrs.get("style", "").lower().replace(" ", "")


def listing(html: str, table_id: str | None = None, wanted: tuple[str, ...] = ("informe",)) -> list[tuple]:
    """(ident, kind, commune, project, [(name, title)]) of the table's rows with five visible cells or more; pagers and headings are passed over."""
    root = Tree(html or "").root
    tables = [t for t in root.find("table") if table_id is None or t.attrs.get("id") == table_id]
    out = []
    for row in [r for t in tables for r in t.find("tr")]:
        cells = [c for c in row.children if isinstance(c, Node) and c.tag == "td" and visible(c)]
        texts = [c.text() for c in cells]
        simple = " ".join(texts).replace(".", "").strip()
        if len(cells) < 5 or simple and re.fullmatch(r"[\d\s]+", simple) or not texts[0] or "Identificación Vivienda" in texts[0]:
            continue
        actions = [(i.attrs["name"], i.attrs.get("title") or i.attrs.get("alt") or "accion") for i in cells[-1].find("input") if i.attrs.get("type", "").lower() == "image" and i.attrs.get("name") and any(w in (i.attrs.get("title") or i.attrs.get("alt") or "").lower() for w in wanted)]
        out.append((*texts[:4], actions))
    return out


def form_payload(html: str) -> dict[str, str] | None:
    """What the page's first form would send; null without a form."""
    forms = Tree(html or "").root.find("form")
    if not forms:
        return None
    out = {}
    for i in forms[0].find("input"):
        kind, name = i.attrs.get("type", "").lower(), i.attrs.get("name")
        if not name or kind in ("submit", "button", "image", "file", "reset"):
            continue
        if kind not in ("checkbox", "radio"):
            out[name] = i.attrs.get("value", "")
        elif "checked" in i.attrs:
            out[name] = i.attrs.get("value", "on")
    for s in forms[0].find("select"):
        if s.attrs.get("name"):
            options = s.find("option")
            chosen = [o for o in options if "selected" in o.attrs] or options[:1]
            out[s.attrs["name"]] = chosen[0].attrs.get("value", "") if chosen else ""
    for t in forms[0].find("textarea"):
        if t.attrs.get("name"):
            out[t.attrs["name"]] = "".join(c for c in t.children if isinstance(c, str))
    return out


def page_total(html: str, section: str) -> int:
    label, place = LABELS[section]
    words = Tree(html or "").root.text()
    if m := re.search(rf"{label}.*?{TOTAL}", words, re.IGNORECASE):
        return int(m[1].replace(".", "") or 0)
    found = re.findall(TOTAL, words, re.IGNORECASE)
    return int(found[place].replace(".", "") or 0) if len(found) > place else 0


def html_rows(pages: DataFrame, key: str, html: str = "html", table_id: str | None = None) -> DataFrame:
    """A row for every listed dwelling, with its actions."""
    kind = "array<struct<ident:string,kind:string,commune:string,project:string,actions:array<struct<name:string,title:string>>>>"

    @F.pandas_udf(kind)
    def parse(s: pd.Series) -> pd.Series:
        return s.map(lambda h: [dict(zip(("ident", "kind", "commune", "project", "actions"), (*r[:4], [{"name": a, "title": b} for a, b in r[4]]), strict=True)) for r in listing(h, table_id)])

    return pages.select(key, F.inline(parse(F.col(html))))


def html_form(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    @F.pandas_udf("map<string,string>")
    def parse(s: pd.Series) -> pd.Series:
        return s.map(form_payload)

    return pages.select(key, parse(F.col(html)).alias("payload"))


def html_totals(pages: DataFrame, key: str, section: str, html: str = "html") -> DataFrame:
    @F.pandas_udf("long")
    def parse(s: pd.Series) -> pd.Series:
        return s.map(lambda h: page_total(h, section))

    total = parse(F.col(html))
    return pages.select(key, total.alias("total")).withColumn("pages", F.ceil(F.col("total") / PER_PAGE))


def totals_builtin(words: Column, place: int) -> Column:
    """The total from a page's plain text, by place, without Python."""
    found = F.regexp_extract_all(words, F.lit("(?i)" + TOTAL), F.lit(1))
    return F.coalesce(F.try_element_at(F.transform(found, lambda x: F.replace(x, F.lit("."), F.lit("")).try_cast("long")), F.lit(place + 1)), F.lit(0))


def form_action(html: str, url: str) -> str:
    forms = Tree(html or "").root.find("form")
    return urljoin(url, (forms[0].attrs.get("action") if forms else None) or url)


def page_count(total: int) -> int:
    return math.ceil(max(0, total) / PER_PAGE)
