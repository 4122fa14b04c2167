"""What the sites' pages hold, as Arrow-batched functions: each parses a page once and gives all its rows.

A page that isn't of the expected kind (null, empty, another layout) gives no rows, or a struct of nulls.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from datetime import date, datetime
from urllib.parse import parse_qs, urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import sites
from .dom import Node, parse

KABUTAN, HKEX, TOSS_BLANKS = "https://kabutan.jp", "https://www1.hkexnews.hk", "​"
NEWS_ID = re.compile(r"n\d{12}")
# The ways in which reports write year, month and day; labels and key names of the sites' pages.
REPORT_DATES = [re.compile(p) for p in (r"(\d{4})[.\-/]\s*(\d{1,2})[.\-/]\s*(\d{1,2})", r"(\d{4})\s*년\s*(\d{1,2})\s*월\s*(\d{1,2})\s*일", r"(?<!\d)(\d{2})[.](\d{1,2})[.](\d{1,2})(?!\d)")]
VIEWS = re.compile(r"(?:조회(?:수)?|views?)\s*[:：]?\s*([\d,]+)", re.IGNORECASE)
OPINION, TARGET = ("투자의견", "투자 의견"), ("목표가", "목표주가")
TITLE_KEYS = ("title", "headline", "newsTitle", "articleTitle", "contentTitle", "subject")
PUBLISHER_KEYS = ("publisher", "press", "pressName", "media", "mediaName", "provider", "providerName", "sourceName", "officeName")
DATE_KEYS = ("publishedAt", "published_at", "publishDate", "publishedDate", "datePublished", "createdAt", "created_at", "articleDate")
AUTHOR_KEYS = ("author", "authorName", "reporter", "reporterName", "writer", "writerName", "journalist")
ID_KEYS, BODY_KEYS, NAME_KEYS = ("id", "newsId", "news_id", "articleId", "article_id", "contentId"), ("content", "body", "article", "description", "summary"), ("name", "title", "label")


def line(text: str | None) -> str:
    return " ".join((text or "").split())


def integer(text: str | None) -> int | None:
    found = re.search(r"-?\d+", (text or "").replace(",", ""))
    return int(found[0]) if found else None


def report_day(text: str | None) -> str | None:
    for pattern in REPORT_DATES:
        if found := pattern.search(line(text)):
            y, m, d = map(int, found.groups())
            try:
                return date(y + 2000 if y < 100 else y, m, d).isoformat()
            except ValueError:
                continue
    return None


def prose(node: Node, noise: Callable[[Node], bool], breaks: frozenset[str]) -> str:
    """Text with its paragraphs: blanks collapsed, margins of lines gone, at most one empty line in a row."""
    text = "".join(node.strings(noise, breaks)).replace("\xa0", " ")
    lines = [" ".join(x.split()) for x in text.split("\n")]
    return re.sub("\n{3,}", "\n\n", "\n".join(lines)).strip()


def query(href: str, name: str) -> str:
    return parse_qs(urlsplit(href).query).get(name, [""])[0].strip()


def once(rows: Iterator[tuple[str, dict]]) -> list[dict]:
    """The rows with a key, each key once, at its first place."""
    out: dict[str, dict] = {}
    for key, row in rows:
        if key:
            out.setdefault(key, row)
    return list(out.values())


def board_posts(html: str | None, code: str) -> list[dict]:
    """Posts of a board page: rows with a link to a post; cells are told by their class."""

    def rows() -> Iterator[tuple[str, dict]]:
        for tr in parse(html).all("tr"):
            link = next((a for a in tr.all("a") if "board_read.naver" in a.attrs.get("href", "").lower()), None)
            if link is None:
                continue
            cell = lambda *names, tr=tr: next((line("".join(td.strings())) for td in tr.all("td") if any(n in " ".join([*td.attrs, *td.attrs.values()]).lower() for n in names)), None)
            href = link.attrs["href"]
            yield query(href, "nid"), {"nid": query(href, "nid"), "code": code, "title": line("".join(link.strings())) or None, "nickname": cell("author", "writer"), "written_at": cell("date"), "view_count": integer(cell("hit", "view")), "recommend": integer(cell("recom", "recommend")), "detail_url": urljoin(sites.NAVER, href)}

    return once(rows())


def news_links(html: str | None, code: str) -> list[dict]:
    """Articles of a stock's news list, by office and article; titles under five letters are no articles."""

    def rows() -> Iterator[tuple[str, dict]]:
        for a in parse(html).all("a"):
            href, title = a.attrs.get("href", ""), a.text()
            office, article = query(href, "office_id"), query(href, "article_id")
            if "news_read.naver" not in href or len(title) < 5 or not office or not article:
                continue
            tr = a.up("tr")
            near = lambda name, tr=tr: (node.text() or None) if tr is not None and (node := tr.first(f".{name}")) else None
            yield f"{office}:{article}", {"code": code, "office_id": office, "article_id": article, "title": title, "url": urljoin(sites.NAVER, href), "canonical_url": f"https://n.news.naver.com/mnews/article/{office}/{article}", "provider": near("info"), "listed_at": near("date")}

    return once(rows())


def research_list(html: str | None, category: str, list_url: str) -> list[dict]:
    """Reports of a research list. Industry and company lists have a column more, before the title."""
    extra = int(category in ("industry", "company"))
    reads = lambda a: "_read.naver" in a.attrs.get("href", "") and "nid=" in a.attrs.get("href", "")
    table = next((t for t in parse(html).all("table.type_1") if any(reads(a) for a in t.all("a"))), None)

    def rows() -> Iterator[tuple[str, dict]]:
        for tr in table.all("tr") if table else ():
            cells = tr.own("td")
            link = next((a for a in cells[extra].all("a") if "href" in a.attrs), None) if len(cells) > extra + 4 else None
            if link is None or not reads(link) or not (title := link.text()):
                continue
            url, file = urljoin(list_url, link.attrs["href"]), cells[extra + 2]
            pdf = any(re.search(r"\.pdf|stock-research", a.attrs.get("href", ""), re.IGNORECASE) for a in file.all("a")) or any("pdf" in i.attrs.get("alt", "").lower() for i in file.all("img"))
            stock = next((a for a in cells[0].all("a") if "href" in a.attrs), None) if category == "company" else None
            codes = [c for n in ("code", "itemcode", "stock_code") if stock and re.fullmatch(r"\d{6}", c := query(stock.attrs["href"], n))]
            yield query(url, "nid"), {
                "report_id": query(url, "nid"), "title": title, "institution": cells[extra + 1].text(), "published_at": report_day(cells[extra + 3].text()), "views": integer(cells[extra + 4].text()), "detail_url": url,
                "stock_code": codes[0] if codes else None, "stock_name": (cells[0].text() or None) if category == "company" else None, "classification": (cells[0].text() or None) if category == "industry" else None, "pdf_hint": pdf,
            }

    return once(rows())


def field(page: Node, labels: tuple[str, ...]) -> str | None:
    """The cell after one that begins with a label, or the definition after a term that is one."""
    for node in page.all("th", "td"):
        if node.text().startswith(labels) and (beside := node.after()):
            if value := next((n for n in beside if n.tag == "td"), beside[0]).text():
                return value
    for node in page.all("dt"):
        if node.text() in labels and (value := next((n.text() for n in node.after() if n.tag == "dd"), "")):
            return value
    return None


def research_detail(html: str | None, category: str) -> dict:
    """A report's page; price and opinion of companies only."""
    page = parse(html)
    source = page.first("p.source", ".source")
    said = source.text() if source else ""
    parts = [p for p in map(line, re.split(r"[|｜]", said)) if p and not report_day(p) and not re.search(r"조회|views?", p, re.IGNORECASE)]
    views = VIEWS.search(said)
    noise = lambda n: n.tag in ("script", "style", "noscript", "iframe", "form", "button") or n.tag == "th" and "view_report" in n.classes
    body, marks = page.first("td.view_cnt", "div.view_cnt"), lambda n: n.tag == "p" and "source" in n.classes or bool({"source", "view_report"} & set(n.classes))
    heads = (n for s in ("th.view_sbj", "h3.sub_tlt", "h3") for n in page.all(s))
    titles = (line(" ".join(n.strings(marks))) for n in heads)
    links = [a.attrs["href"] for n in page.all("th.view_report") for a in n.all("a") if a.attrs.get("href")] + [a.attrs["href"] for a in page.all("a") if a.attrs.get("href")]
    pdf = next((u for u in (urljoin(sites.NAVER, h) for h in links) if ".pdf" in u.lower() or "stock-research" in u.lower()), None)
    price = field(page, TARGET) if category == "company" else None
    return {
        "title": next(filter(None, titles), None), "institution": parts[0] if parts else None, "published_at": report_day(said), "views": integer(views[1]) if views else None,
        "content": prose(body, noise, frozenset(("br", "p", "div", "li", "tr"))) if body else "", "pdf_url": pdf, "investment_opinion": field(page, OPINION) if category == "company" else None, "target_price": integer(price), "target_price_text": price,
    }


def kabutan_list(html: str | None) -> list[dict]:
    """Articles of a news list; of one that comes twice the last row counts, at the first one's place."""
    out: dict[str, dict] = {}
    for table in parse(html).all("table.s_news_list"):
        for tr in table.all("tr"):
            cells = tr.own("td")
            link = next((a for a in tr.all("a") if NEWS_ID.search(a.attrs.get("href", ""))), None) if cells else None
            if link is None or not (title := link.text()):
                continue
            time_, kind = tr.first("td.news_time"), cells[1].text() if len(cells) > 1 else ""
            news_id = NEWS_ID.search(link.attrs["href"])[0]
            out[news_id] = {"news_id": news_id, "title": title, "category": kind if len(kind) <= 10 and kind != title else "", "list_time": time_.text() if time_ else "", "url": urljoin(KABUTAN, link.attrs["href"])}
    return list(out.values())


def kabutan_locked(html: str | None) -> bool:
    """Whether a list shows articles without links, which only members can open."""
    rows = (tr for t in parse(html).all("table.s_news_list") for tr in t.all("tr") if tr.first("td.news_time"))
    return any(tr.text() and not any(NEWS_ID.search(a.attrs.get("href", "")) for a in tr.all("a")) for tr in rows)


def kabutan_article(html: str | None, title: str | None = None, category: str | None = None) -> dict:
    """An article; title and category of the list where the page has none."""
    article = parse(html).first("article")
    out = {"article_found": article is not None, "body_found": False, "title": line(title), "category": line(category), "published_at": None, "content": ""}
    if article is None:
        return out
    head, when, body = article.first("h1"), article.first("time.s_news_date"), article.first("div.body", "div.mono")
    out["title"] = (head.text() if head else "") or out["title"]
    when = when or next((t for t in article.all("time") if "datetime" in t.attrs), None)
    if when is not None:
        try:
            datetime.fromisoformat(line(when.attrs.get("datetime")))
            out["published_at"] = line(when.attrs["datetime"])
        except ValueError:
            pass
    out["category"] = out["category"] or next((x for s in (".news_category", ".category", ".s_news_category") if (n := article.first(s)) and (x := n.text())), "")
    if body is not None:
        noise = lambda n: n.tag in ("script", "style", "iframe") or bool({"ads_box", "ad", "sns", "related"} & set(n.classes))
        pieces = (" ".join(s.split()) for s in body.strings(noise))
        out |= {"body_found": True, "content": "\n".join(p for p in pieces if p)}
    return out


def without_label(text: str, label: str) -> str:
    return re.sub(rf"(?i)^{label}\s*:\s*", "", line(text))


def hkex_pdf(href: str) -> str | None:
    """The whole address of a report's PDF; None if it isn't one."""
    url = urlsplit(urljoin(HKEX, line(href)))
    host = (url.hostname or "").lower()
    if url.scheme not in ("http", "https") or not url.path.lower().endswith(".pdf") or host not in sites.REPORT_HOSTS:
        return None
    return f"{url.scheme}://{host}{f':{url.port}' if url.port else ''}{url.path}{f'?{url.query}' if url.query else ''}"


def hkex_results(html: str | None) -> list[dict]:
    """Reports of a search's results: rows of four cells and more with a PDF."""

    def rows() -> Iterator[tuple[str, dict]]:
        for a in parse(html).all("a"):
            tr = a.up("tr")
            cells = list(tr.all("td")) if tr is not None and ".pdf" in a.attrs.get("href", "").lower() else []
            url = hkex_pdf(a.attrs["href"]) if len(cells) >= 4 else None
            title = url and (without_label(cells[-1].text(), "Document") or a.text())
            if not title:
                continue
            raw = without_label(cells[1].text(), "Stock Code")
            code = re.sub(r"\.0$", "", raw)
            yield url, {"release_time": without_label(cells[0].text(), "Release Time"), "stock_code": code.zfill(5) if re.fullmatch(r"\d{1,5}", code) else raw, "stock_name": without_label(cells[2].text(), "Stock Short Name"), "title": title, "pdf_url": url}

    return once(rows())


def market_sum(html: str | None, market: str) -> list[dict]:
    """Listed stocks of a market-capitalisation page."""

    def rows() -> Iterator[tuple[str, dict]]:
        for a in parse(html).all("a.tltle"):
            if found := re.search(r"code=(\d{6})", a.attrs.get("href", "")):
                yield found[1], {"code": found[1], "name": a.text(), "market": market, "main_url": urljoin(sites.NAVER, a.attrs["href"]), "instrument_id": f"XKRX:{found[1]}"}

    return once(rows())


def news_metadata(text: str | None, news_id: str) -> dict:
    """Title, publisher, time and author of an article, from a page's JSON: objects that have its id or the shape of
    an article are asked in their order, for each field until one has it."""
    out = {"title": "", "publisher": "", "published_at": "", "author": "", "title_source": ""}
    clean = lambda v: line(str(v).replace(TOSS_BLANKS, "")) if isinstance(v, (str, int)) else ""

    def value(node: dict, keys: tuple[str, ...]) -> str:
        for v in (node.get(k) for k in keys):
            if isinstance(v, str) and clean(v):
                return clean(v)
            if isinstance(v, dict) and (inner := next((clean(v[k]) for k in NAME_KEYS if isinstance(v.get(k), str) and clean(v[k])), "")):
                return inner
        return ""

    try:
        todo = [json.loads(text or "null")]
    except ValueError:
        return out
    while todo:
        node = todo.pop()
        if isinstance(node, dict):
            exact = news_id in [clean(node[k]) for k in ID_KEYS if k in node]
            if exact or any(k in node for k in TITLE_KEYS) and any(k in node for k in BODY_KEYS):
                if not out["title"]:
                    out |= {"title": value(node, TITLE_KEYS), "title_source": "page_json_exact" if exact else "page_json_article"}
                for name, keys in (("publisher", PUBLISHER_KEYS), ("published_at", DATE_KEYS), ("author", AUTHOR_KEYS)):
                    out[name] = out[name] or value(node, keys)
            node = list(node.values())
        if isinstance(node, list):
            todo += reversed([v for v in node if isinstance(v, (dict, list))])
    return out


def comment_cards(html: str | None) -> list[dict]:
    """Visible comments of a saved community page: elements with a post's id, its author, time, text and likes."""

    def rows() -> Iterator[tuple[str, dict]]:
        for card in parse(html).walk():
            if key := card.attrs.get("data-post-id", card.attrs.get("data-comment-id", "")):
                part = lambda name, card=card: node.text() if (node := next((n for n in card.walk() if n.attrs.get("data-part") == name or name in n.classes), None)) else None
                yield key, {"post_id": key, "author_name": part("author"), "created_at_text": part("time"), "content": part("content"), "likes": integer(part("likes"))}

    return once(rows())


#: Extractor -> the type of what it gives.
TYPES: dict[Callable, str] = {
    board_posts: "array<struct<nid:string,code:string,title:string,nickname:string,written_at:string,view_count:bigint,recommend:bigint,detail_url:string>>",
    news_links: "array<struct<code:string,office_id:string,article_id:string,title:string,url:string,canonical_url:string,provider:string,listed_at:string>>",
    research_list: "array<struct<report_id:string,title:string,institution:string,published_at:string,views:bigint,detail_url:string,stock_code:string,stock_name:string,classification:string,pdf_hint:boolean>>",
    research_detail: "struct<title:string,institution:string,published_at:string,views:bigint,content:string,pdf_url:string,investment_opinion:string,target_price:bigint,target_price_text:string>",
    kabutan_list: "array<struct<news_id:string,title:string,category:string,list_time:string,url:string>>",
    kabutan_locked: "boolean",
    kabutan_article: "struct<article_found:boolean,body_found:boolean,title:string,category:string,published_at:string,content:string>",
    hkex_results: "array<struct<release_time:string,stock_code:string,stock_name:string,title:string,pdf_url:string>>",
    market_sum: "array<struct<code:string,name:string,market:string,main_url:string,instrument_id:string>>",
    news_metadata: "struct<title:string,publisher:string,published_at:string,author:string,title_source:string>",
    comment_cards: "array<struct<post_id:string,author_name:string,created_at_text:string,content:string,likes:bigint>>",
}


def extracted(extractor: Callable, *args: Column | str) -> Column:
    """The extractor as a Column; explode it where it gives an array."""
    kind = TYPES[extractor]

    def batch(*columns: pd.Series):
        rows = [extractor(*row) for row in zip(*columns, strict=True)]
        return pd.DataFrame(rows, columns=[f.split(":")[0] for f in kind[7:-1].split(",")]).astype(object).where(lambda d: d.notna(), None) if kind.startswith("struct") else pd.Series(rows, dtype=object if kind.startswith("array") else None)

    # The number of arguments has to show in the signature.
    one = {1: lambda a: batch(a), 2: lambda a, b: batch(a, b), 3: lambda a, b, c: batch(a, b, c)}[len(args)]
    return F.pandas_udf(one, kind)(*[a if isinstance(a, Column) else F.lit(a) for a in args])
