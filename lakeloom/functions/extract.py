"""Pages to rows: links, titles, article text, tables and JSON, with built-in functions where they suffice.

What needs an HTML parser (bodies picked by selector, entities beyond the common ones, unknown encodings) runs as
Arrow-batched functions on the standard library.
"""

from __future__ import annotations

import html as html_
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dom import Node, parse
from .sites import hkex_code
from .text import one_line, strip

LINK = r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>"""
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
ROW = r"(?is)<tr\b[^>]*>(.*?)</tr>"
CELL = r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"
BLOCKS = {"br", "p", "div", "li", "tr"}
NOISE = {"script", "style", "noscript", "iframe", "nav", "footer", "aside", "header", "form", "button"}


def text_of(fragment: Column) -> Column:
    return one_line(F.regexp_replace(fragment, r"<[^>]*>", " "))


def title(html: Column) -> Column:
    return F.nullif(text_of(F.regexp_extract(html, TITLE, 1)), F.lit(""))


def links(pages: DataFrame, key: str, html: str = "html", least_title: int = 0) -> DataFrame:
    """(key, pos, href, title) of each link; of equal addresses the first stays."""
    found = F.arrays_zip(F.regexp_extract_all(html, F.lit(LINK), 1).alias("h"), F.regexp_extract_all(html, F.lit(LINK), 2).alias("t"))
    rows = pages.select(key, F.posexplode(found).alias("pos", "x")).select(key, "pos", F.col("x.h").alias("href"), text_of(F.col("x.t")).alias("title"))
    rows = rows.where(F.length("title") >= least_title)
    return rows.groupBy(key, "href").agg(F.min("pos").alias("pos"), F.min_by("title", "pos").alias("title"))


def table_rows(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, pos, cells) of each table row that has cells."""
    rows = pages.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(ROW), 1)).alias("pos", "tr"))
    cells = F.transform(F.regexp_extract_all("tr", F.lit(CELL), 1), text_of)
    return rows.select(key, "pos", cells.alias("cells")).where(F.size("cells") > 0)


def field_value(html: Column, label: str) -> Column:
    """The cell or definition that follows a label."""
    pattern = rf"(?is)<(?:th|td|dt)\b[^>]*>\s*\Q{label}\E\s*:?\s*</(?:th|td|dt)>\s*<(?:td|dd)\b[^>]*>(.*?)</(?:td|dd)>"
    return F.nullif(text_of(F.regexp_extract(html, pattern, 1)), F.lit(""))


def board_rows(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, nid, title, pos) of the posts on a board page, each nid once."""
    found = links(pages, key, html)
    nid = F.regexp_extract("href", r"[?&]nid=(\d+)", 1)
    named = found.withColumn("nid", nid).where((F.col("nid") != "") & (F.col("title") != ""))
    return named.groupBy(key, "nid").agg(F.min("pos").alias("pos"), F.min_by("title", "pos").alias("title"))


DETAIL = "struct<isSuccess:boolean,result:struct<id:string,title:string,contents:string,writer:struct<id:string,nickname:string>,createdAt:string,viewCount:bigint,goodCount:bigint,badCount:bigint,commentCount:bigint>>"


def discussion(json: Column) -> Column:
    """A post's fields from its JSON; null unless it says that it succeeded."""
    d = F.from_json(json, DETAIL)
    r = d["result"]
    return F.when(d["isSuccess"], F.struct(r["id"].alias("nid"), strip(r["title"]).alias("title"), r["contents"].alias("contents"), r["writer"]["id"].alias("author_id"), r["writer"]["nickname"].alias("author_name"), r["createdAt"].alias("created_at"), r["viewCount"].alias("views")))


def exact_stock(matches: Column, code: str) -> Column:
    """Of an array of structs with `code`, the first whose code is this one when both have five digits."""
    return F.try_element_at(F.filter(matches, lambda m: hkex_code(m["code"]) == code.zfill(5)), F.lit(1))


def has_locked_rows(html: Column) -> Column:
    """Whether a list shows rows that only members can open."""
    return html.rlike(r"""(?is)<tr\b[^>]*>(?:(?!</tr>).)*(?:class=["'][^"']*(?:lock|premium|kagi)[^"']*["'])(?:(?!</tr>).)*</tr>""")


def structured(json: Column, *names: str) -> Column:
    """The first of several paths that a JSON text has a value at."""
    return F.coalesce(*[F.nullif(F.get_json_object(json, n), F.lit("")) for n in names])


def article_text(html: str | None, selectors: tuple[str, ...], least: int, strict: bool = False) -> str | None:
    """The text of the first selector (tag, .class or #id) whose first element has at least `least` characters, without
    noise; a line for each block. The page is parsed once for all selectors. strict: see parse()."""
    page = parse(html, strict)

    def pieces(node: Node) -> Iterator[str]:
        for c in node.children:
            if isinstance(c, str):
                yield c
            elif c.tag not in NOISE:
                if c.tag in BLOCKS:
                    yield "\n"
                yield from pieces(c)

    for s in selectors:
        if (node := page.first(s)) is not None:
            lines = (" ".join(line.replace("\xa0", " ").split()) for line in "".join(pieces(node)).split("\n"))
            text = "\n".join(line for line in lines if line)
            if len(text) >= least:
                return text
    return None


def article(html: Column, selectors: tuple[str, ...] = ("article", "main", "#content", "body"), least: int = 100, strict: bool = False) -> Column:
    return F.pandas_udf(lambda rows: pd.Series([article_text(h, selectors, least, strict) for h in rows], dtype=object), "string")(html)


def unescape(text: Column) -> Column:
    """All of HTML's entities."""
    return F.pandas_udf(lambda rows: pd.Series([None if t is None else html_.unescape(t) for t in rows], dtype=object), "string")(text)


DECLARED = re.compile(rb"""<meta[^>]*?charset\s*=\s*["']?\s*([\w-]+)""", re.IGNORECASE)


def decoded(data: bytes | None, charset: str | None) -> str | None:
    """By the response's charset, the one that the page declares or its bytes show, Korean encodings and UTF-8: the
    first that decodes and looks like HTML; else UTF-8 with replacements."""
    if data is None:
        return None
    found = DECLARED.search(data[:4096])
    try:
        detected = "utf-8" if data.decode("utf-8") else None
    except UnicodeDecodeError:
        detected = None
    for name in filter(None, (charset, found and found[1].decode("ascii"), detected, "euc-kr", "cp949", "utf-8")):
        try:
            text = data.decode(name)
        except (LookupError, UnicodeDecodeError):
            continue
        if "<" in text:
            return text
    return data.decode("utf-8", "replace")


def decode(data: Column, charset: Column) -> Column:
    return F.pandas_udf(lambda d, c: pd.Series([decoded(a, b) for a, b in zip(d, c, strict=True)], dtype=object), "string")(data, charset)
