"""Identifiers and addresses of the sites that records come from, as Columns."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import one_line, strip, without_zero_width

CANONICAL = r"^[A-Z0-9]+:[A-Z0-9._-]+$"

# Report types, hosts, publishers and section markers of the sites.
REPORT_TYPES = {"annual": "40100", "interim": "40200", "quarterly": "40300"}
REPORT_HOSTS = ["hkexnews.hk", "www.hkexnews.hk", "www1.hkexnews.hk"]
PUBLISHERS = {
    "seokyung_": "서울경제", "sedaily_": "서울경제", "edaily_": "이데일리", "hankyung_": "한국경제", "moneytoday_": "머니투데이",
    "maekyung_": "매일경제", "ajukyung_": "아주경제", "financial_": "파이낸셜뉴스", "news1_": "뉴스1", "etoday_": "이투데이",
    "electronicnews_": "전자신문", "asiae_": "아시아경제", "chosunbiz_": "조선비즈", "yna_": "연합뉴스", "yonhap_": "연합뉴스",
    "newspim_": "뉴스핌",
}
GENERIC_TITLES = ["tossinvest", "toss invest", "토스증권", "토스증권 - 주식 투자를 더 쉽게"]
GENERIC_PARTS = ["뉴스 · 공시", "뉴스·공시", "주요 뉴스", "관련 주식", "관련 종목"]
SECTIONS = ["\n관련 주식\n", "\n관련주식\n", "\n관련 종목\n", "\n관련종목\n", "\n주요 뉴스\n"]


def is_canonical(instrument: Column) -> Column:
    return instrument.rlike(CANONICAL)


def query_value(url: Column, name: str) -> Column:
    return F.try_parse_url(url, F.lit("QUERY"), F.lit(name))


def naver_code(c: Column) -> Column:
    return F.regexp_replace(strip(c), r"(?i)^XKRX:", "")


def naver_instrument(c: Column) -> Column:
    """XKRX: and six digits; null otherwise."""
    code = naver_code(c)
    return F.when(code.rlike(r"^\d{6}$"), F.concat(F.lit("XKRX:"), code))


def naver_news_url(office: Column, article: Column) -> Column:
    return F.format_string("https://n.news.naver.com/mnews/article/%s/%s", office, article)


def report_id(url: Column) -> Column:
    return query_value(url, "nid")


def stock_code(url: Column) -> Column:
    """The first of code, itemcode and stock_code that has six digits."""
    values = [query_value(url, n) for n in ("code", "itemcode", "stock_code")]
    return F.coalesce(*[F.when(v.rlike(r"^\d{6}$"), v) for v in values])


def kabutan_news_id(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"(n\d{12})", 1), F.lit(""))


def hkex_code(c: Column) -> Column:
    """Five digits; null if there are more or other characters."""
    text = F.regexp_replace(strip(c), r"\.0$", "")
    return F.when(text.rlike(r"^\d{1,5}$"), F.lpad(text, 5, "0"))


def hkex_instrument(c: Column) -> Column:
    return F.concat(F.lit("XHKG:"), hkex_code(c))


def hkex_codes(c: Column) -> Column:
    """All numbers of one to five digits, each once, in order."""
    found = F.regexp_extract_all(c, F.lit(r"(?<!\d)(\d{1,5})(?!\d)"), 1)
    return F.array_distinct(F.transform(found, lambda t: F.lpad(t, 5, "0")))


def hkex_report_type(c: Column) -> Column:
    """struct(name, code) of either of the two."""
    text = F.lower(strip(c))
    out = F.lit(None).cast("struct<name:string,code:string>")
    for name, code in REPORT_TYPES.items():
        out = F.when(text.isin(name, code), F.struct(F.lit(name).alias("name"), F.lit(code).alias("code"))).otherwise(out)
    return out


def hkex_pdf_url(c: Column, base: str = "https://www1.hkexnews.hk") -> Column:
    """The absolute address with scheme and host in lower case and without fragment; null if it isn't one of a report."""
    url = absolute(one_line(c), base)
    part = lambda i: F.regexp_extract(url, r"(?i)^(https?)://([^/?#:]*)(:\d+)?([^?#]*)(\?[^#]*)?", i)
    ok = F.lower(part(4)).endswith(".pdf") & F.lower(part(2)).isin(REPORT_HOSTS)
    return F.when(ok, F.concat(F.lower(part(1)), F.lit("://"), F.lower(part(2)), part(3), part(4), part(5)))


def absolute(href: Column, base: str) -> Column:
    """An address on a page of `base` (a host's root) as a whole one; `.` and `..` parts are resolved."""
    whole = F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href).when(href.startswith("//"), F.concat(F.lit(f"{base.split('//')[0]}"), href)).when(href.startswith("/"), F.concat(F.lit(base), href)).otherwise(F.concat(F.lit(f"{base}/"), href))
    for _ in range(4):
        whole = F.regexp_replace(F.regexp_replace(whole, r"(?<=[^:/])/\.(?=/)", ""), r"(?<=[^:/])/(?!\.\./)[^/?#]+/\.\.(?=/)", "")
    return F.regexp_replace(whole, r"^(https?://[^/]+)(?:/\.\.)+(?=/)", "$1")


def hkex_source_id(url: Column) -> Column:
    return F.sha2(hkex_pdf_url(url), 256)


def jsonp_body(c: Column) -> Column:
    """The JSON between a callback's brackets."""
    return F.nullif(F.regexp_extract(strip(c), r"(?s)^[\w.$]+\s*\((.*)\)\s*;?$", 1), F.lit(""))


def toss_symbol(c: Column) -> Column:
    """Six digits of A000000, XKRX:000000 or 000000; null otherwise."""
    return F.nullif(F.regexp_extract(without_zero_width(c), r"^(?:XKRX:|A)?(\d{6})$", 1), F.lit(""))


def toss_instrument(c: Column) -> Column:
    return F.concat(F.lit("XKRX:"), toss_symbol(c))


def toss_stock(key: Column, name: Column, href: Column, base: str = "https://www.tossinvest.com") -> Column:
    """struct(stock_key, stock_code, stock_name, stock_url) of a key like A000000; null otherwise."""
    k, path = without_zero_width(key), without_zero_width(href)
    url = F.when(path.startswith("/"), F.concat(F.lit(base), path)).when(path != "", path).otherwise(F.concat(F.lit(f"{base}/stocks/"), k, F.lit("/order")))
    return F.when(k.rlike(r"^A\d{6}$"), F.struct(k.alias("stock_key"), F.substring(k, 2, 6).alias("stock_code"), without_zero_width(name).alias("stock_name"), url.alias("stock_url")))


def toss_news_id(url: Column) -> Column:
    """The id in the query's JSON, else the SHA-256 of the address."""
    own = F.get_json_object(F.try_url_decode(query_value(url, "contentParams")), "$.id")
    return F.coalesce(F.nullif(own, F.lit("")), F.sha2(url, 256))


def toss_news_date(news_id: Column) -> Column:
    parts = [F.regexp_extract(news_id, r"(20\d{2})[.\-_]?(\d{2})[.\-_]?(\d{2})", i) for i in (1, 2, 3)]
    return F.when(parts[0] == "", F.lit("")).otherwise(F.concat_ws("-", *parts))


def toss_publisher(news_id: Column) -> Column:
    out = F.lit("")
    for prefix, name in reversed(PUBLISHERS.items()):
        out = F.when(F.lower(news_id).startswith(prefix), F.lit(name)).otherwise(out)
    return out


def is_human_check(status: Column, html: Column) -> Column:
    """Whether a page is a firewall's question for humans instead of content: by the status, the phrase and a marker."""
    marker = html.contains("awsWafCookieDomainList") | html.contains("gokuProps")
    return F.coalesce((status == 405) & html.contains("Human Verification") & marker, F.lit(False))


# Research categories and the list pages of each.
RESEARCH_LISTS = {
    "market": "/research/market_info_list.naver", "invest": "/research/invest_list.naver", "company": "/research/company_list.naver",
    "industry": "/research/industry_list.naver", "economy": "/research/economy_list.naver", "debenture": "/research/debenture_list.naver",
}
NAVER = "https://finance.naver.com"


def research_category(name: str) -> str:
    if (out := str(name).strip().lower()) not in RESEARCH_LISTS:
        raise ValueError(f"unknown research category: {name}")
    return out


def research_categories(names: str | Iterable[str] | None) -> tuple[str, ...]:
    """Each once, in order; nothing or `all` stands for all of them."""
    given = ["all"] if names is None else [names] if isinstance(names, str) else list(names)
    each = (c for n in given for c in (RESEARCH_LISTS if str(n).strip().lower() == "all" else [research_category(n)]))
    return tuple(dict.fromkeys(each))


def research_list_url(category: Column, page: Column) -> Column:
    paths = F.create_map(*[F.lit(x) for kv in RESEARCH_LISTS.items() for x in kv])
    return F.when(page >= 1, F.concat(F.lit(NAVER), F.try_element_at(paths, F.lower(F.trim(category))), F.lit("?page="), page.cast("int")))


def news_list_url(code: Column, page: Column) -> Column:
    return F.concat(F.lit(f"{NAVER}/item/news_news.naver?code="), naver_code(code), F.lit("&page="), page.cast("int"))


def is_generic_title(title: Column, stock: Column) -> Column:
    """Whether a title names the site or a section instead of an article."""
    text = without_zero_width(title)
    out = (text == "") | F.lower(text).isin(GENERIC_TITLES) | reduce(Column.__or__, [text.contains(w) for w in GENERIC_PARTS])
    return out | ((F.coalesce(stock, F.lit("")) != "") & text.isin(F.concat(stock, F.lit(" 뉴스")), F.concat(stock, F.lit(" News"))))
