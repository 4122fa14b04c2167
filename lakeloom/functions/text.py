"""Text cleaning and number parsing as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Named entities that are decoded without Python; the rest of HTML's names is left to extract.unescape.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&amp;": "&"}


#: All white space, Unicode's and the separators 1C to 1F.
BLANKS = "".join(chr(c) for c in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])


def strip(c: Column) -> Column:
    """Strips all Unicode white space; null becomes ''. Without a regular expression, as every field goes through it."""
    return F.btrim(F.coalesce(c.cast("string"), F.lit("")), F.lit(BLANKS))


def optional(c: Column) -> Column:
    """strip(), with '' as null."""
    return F.nullif(strip(c), F.lit(""))


def unescaped(c: Column) -> Column:
    for name, char in ENTITIES.items():
        c = F.replace(c, F.lit(name), F.lit(char))
    return c


def strip_html(c: Column) -> Column:
    """<br> breaks the line, other tags vanish, entities are decoded, blank lines and the lines' margins go; '' is null."""
    text = F.regexp_replace(c, r"(?i)<br\s*/?>", "\n")
    text = F.replace(unescaped(F.regexp_replace(text, r"<[^>]+>", "")), F.lit(" "), F.lit(" "))
    lines = F.transform(F.split(text, r"\r\n|[\n\r]"), strip)
    return F.nullif(F.array_join(F.filter(lines, lambda line: line != ""), "\n"), F.lit(""))


def one_line(c: Column) -> Column:
    """Entities decoded, every run of white space one blank."""
    return strip(F.regexp_replace(unescaped(F.coalesce(c, F.lit(""))), r"(?U)\s+", " "))


def paragraphs(c: Column) -> Column:
    """Entities decoded, blanks collapsed, three and more line breaks made two."""
    text = F.replace(unescaped(F.coalesce(c, F.lit(""))), F.lit(" "), F.lit(" "))
    text = F.regexp_replace(F.regexp_replace(text, "[ \t\r\f\u000b]+", " "), "\n[ \t]+", "\n")
    return strip(F.regexp_replace(text, "\n{3,}", "\n\n"))


def clean_lines(c: Column) -> Column:
    """Non-breaking and ideographic blanks are blanks; lines are collapsed and empty ones dropped."""
    text = F.translate(F.coalesce(c, F.lit("")), " 　", "  ")
    lines = F.transform(F.split(text, r"\r\n|[\n\r]"), lambda line: strip(F.regexp_replace(line, "[ \t]+", " ")))
    return F.array_join(F.filter(lines, lambda line: line != ""), "\n")


def without_zero_width(c: Column) -> Column:
    """Zero-width spaces go, blanks other than line breaks are collapsed."""
    return strip(F.regexp_replace(F.replace(F.coalesce(c, F.lit("")), F.lit("​"), F.lit("")), "[ \t\r\f\u000b]+", " "))


def first_integer(c: Column, signed: bool = True) -> Column:
    """The first run of digits once commas are dropped; null if none."""
    digits = F.regexp_extract(F.replace(c, F.lit(","), F.lit("")), r"-?\d+" if signed else r"\d+", 0)
    return F.nullif(digits, F.lit("")).try_cast("bigint")


def count_or_zero(c: Column) -> Column:
    return F.coalesce(first_integer(c, signed=False), F.lit(0).cast("bigint"))


def before_marker(c: Column, markers: list[str]) -> Column:
    """The text before the first marker that it has, each in turn."""
    for m in markers:
        c = F.substring_index(c, m, 1)
    return strip(c)


def labelled(c: Column, label: str) -> Column:
    """Drops a leading 'label:' in any case."""
    return strip(F.regexp_replace(one_line(c), rf"(?i)^\Q{label}\E\s*:\s*", ""))


def first_plain_part(c: Column) -> Column:
    """Of parts between bars, the first that is neither empty, a date nor a view count."""
    parts = F.transform(F.split(c, r"\|"), strip)
    ok = F.filter(parts, lambda p: (p != "") & ~p.rlike(r"^\d{2,4}[./-]\d{1,2}[./-]\d{1,2}") & ~p.rlike(r"(?i)^(조회|views?)"))
    return F.try_element_at(ok, F.lit(1))


def compact_json(c: Column) -> Column:
    """JSON without blanks between its parts; the order of its keys stays. Text that isn't JSON is null."""
    return F.to_json(F.try_parse_json(c))


def sort_text(c: Column) -> Column:
    """A value as text that sorts, '' for null."""
    return F.coalesce(c.cast("string"), F.lit(""))
