"""Licence scan by conditional compression and exact wording.

A block of text is a candidate if it has a word that licence notices use. It is compressed alone and with each
template as a raw zstandard dictionary; the best relative size reduction is its score. Wordings are confirmed apart
from the score: the template's words must follow each other with few differences, of which none may be a missing
number. They are looked for in the whole text, across lines, blank lines and blocks. Only texts and stretches with too
few of a template's words are passed over, which can't have its wording.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .license_templates import TEMPLATES

#: Words of notices; a block without one is no candidate.
TRIGGER = r"(?i)licen[sc]|copyright|spdx|creative commons|public domain|\bcc0?[ -]|hereby granted|redistribut|free software|all copies"
#: Characters of a block at most (longer lines are cut at blanks), and of overlap between its pieces.
BLOCK, OVERLAP = 1200, 400
#: The share of a template's words that may differ.
MOST_MISSING = 0.1
RESULT = "n_blocks int, licenses array<string>, reduction double, n_differences int, differences array<string>, spans array<struct<license:string,start:int,end:int>>"


def blocks(text: str) -> Iterator[tuple[int, str]]:
    """(start, block): runs of candidate lines, and overlapping pieces of long ones."""
    trigger, at, open_ = re.compile(TRIGGER), 0, None
    for line in [*text.split("\n"), ""]:
        if trigger.search(line) or open_ is not None and line.strip() and at - open_ < BLOCK and not at == 0:
            open_ = at if open_ is None else open_
        elif open_ is not None:
            yield from pieces(text, open_, at - 1)
            open_ = None
        at += len(line) + 1
    if open_ is not None:
        yield from pieces(text, open_, len(text))


def pieces(text: str, start: int, end: int) -> Iterator[tuple[int, str]]:
    """Pieces of at most BLOCK characters; those without a trigger are left out."""
    while end - start > BLOCK:
        cut = max(text.rfind(" ", start + OVERLAP, start + BLOCK), start + BLOCK // 2)
        if re.search(TRIGGER, text[start:cut]):
            yield start, text[start:cut]
        start = max(cut - OVERLAP, start + 1)
    if re.search(TRIGGER, text[start:end]):
        yield start, text[start:end]


@dataclass
class Template:
    license: str
    words: list[str]
    compressor: zstandard.ZstdCompressor

    def __post_init__(self) -> None:
        self.most, self.counts = int(MOST_MISSING * len(self.words)), Counter(self.words)
        self.fixed = [bool(re.search(r"\d", w)) for w in self.words]


def placed_words(text: str) -> list[tuple[str, int, int]]:
    """(word, start, end) of each word."""
    return [(m.group().lower().rstrip("."), m.start(), m.end()) for m in re.finditer(r"[\w.-]+", text) if m.group().strip(".-")]


def word_list(text: str) -> list[str]:
    return [w for w, _, _ in placed_words(text)]


def stretches(words: list[str], t: Template) -> Iterator[tuple[int, int]]:
    """Where a wording may lie: runs of windows of its greatest length that have enough of the template's words."""
    width, sums = len(t.words) + t.most, [0]
    for w in words:
        sums.append(sums[-1] + (w in t.counts))
    open_ = None
    for i in range(max(1, len(words) - width + 1)):
        end = min(len(words), i + width)
        if sums[end] - sums[i] >= len(t.words) - t.most:
            if open_ and i > open_[1]:
                yield open_
                open_ = None
            open_ = (open_[0] if open_ else i, end)
    if open_:
        yield open_


def wordings(words: list[str], t: Template) -> Iterator[tuple[int, int, list[str]]]:
    """(first word, end, differences) of each wording of the template, none overlapping another."""
    for at, stop in stretches(words, t):
        while at < stop:
            best, until = None, stop
            # By template words used: (differences, -first word, the differing words), None beyond the most allowed.
            row = start_row(t, at)
            for j in range(at, stop):
                new = start_row(t, j + 1)
                for i, word in enumerate(t.words):
                    ways = [new[i + 1]] if new[i + 1] else []
                    if word == words[j] and row[i]:
                        ways.append(row[i])
                    if (c := row[i + 1]) and c[0] < t.most:
                        ways.append((c[0] + 1, c[1], (*c[2], f"+{words[j]}")))
                    if (c := new[i]) and c[0] < t.most and not t.fixed[i]:
                        ways.append((c[0] + 1, c[1], (*c[2], f"-{word}")))
                    new[i + 1] = min(ways, default=None)
                row = new
                if row[-1] and (best is None or row[-1][0] < best[0][0]):
                    # A better end of the same wording has the words that this one lacks, and no more others than allowed.
                    best, until = (row[-1], j + 1), until if best else j + 1 + 2 * t.most
                if best and j + 1 >= until:
                    break
            if best is None:
                break
            (_, first, differences), at = best
            yield -first, at, sorted(differences, key=lambda d: d[0] == "+")


def start_row(t: Template, at: int) -> list[tuple | None]:
    """The alignment before the word `at`: nothing used, or the first words missing."""
    row: list[tuple | None] = [(0, -at, ())]
    for i, word in enumerate(t.words):
        c = row[i]
        row.append((c[0] + 1, -at, (*c[2], f"-{word}")) if c and c[0] < t.most and not t.fixed[i] else None)
    return row


class Scanner:
    def __init__(self, templates: dict[str, list[str]]):
        self.plain = zstandard.ZstdCompressor(level=9)
        raw = lambda t: zstandard.ZstdCompressionDict(t.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.templates = [Template(k, word_list(t), zstandard.ZstdCompressor(level=9, dict_data=raw(t))) for k, all_ in templates.items() for t in all_]

    def reduction(self, block: str) -> float:
        """The best relative reduction of the block's compressed size by a template."""
        data = " ".join(block.lower().split()).encode("utf-8", "surrogatepass")
        alone = len(self.plain.compress(data))
        return max(1 - len(t.compressor.compress(data)) / alone for t in self.templates)

    def confirmed(self, text: str) -> Iterator[tuple[tuple[str, int, int], list[str]]]:
        """((licence, start, end), differing words) of the wordings of all templates."""
        found = placed_words(text)
        words = [w for w, _, _ in found]
        counts = Counter(words)
        for t in self.templates:
            if sum(min(n, counts[w]) for w, n in t.counts.items()) >= len(t.words) - t.most:
                for first, end, differences in wordings(words, t):
                    yield (t.license, found[first][1], found[end - 1][2]), differences

    def scan(self, text: str | None) -> tuple:
        n, best = 0, 0.0
        for _, block in blocks(text or ""):
            n += 1
            best = max(best, self.reduction(block))
        hits = dict(self.confirmed(text or ""))
        spans, last = [], {}
        for k, a, b in sorted(hits, key=lambda s: (s[1], -s[2], s[0])):
            # A wording inside another one of its licence is no further one.
            if b > last.get(k, -1):
                spans.append((k, a, b))
                last[k] = b
        spans.sort(key=lambda s: (s[1], s[0]))
        differences = [d for s in spans for d in hits[s]]
        return n, sorted({s[0] for s in spans}), best, len(differences), differences, [dict(zip(("license", "start", "end"), s, strict=True)) for s in spans]


def needed(templates: dict[str, list[str]]) -> str:
    """A pattern that fits every text with a wording: of each template, one word more than may be missing, the longest ones."""
    out = set()
    for words in (word_list(t) for all_ in templates.values() for t in all_):
        out |= set(sorted(set(words), key=lambda w: (-len(w), w))[: int(MOST_MISSING * len(words)) + 1])
    # A word within a longer one fits wherever that does.
    return "(?iu)" + "|".join(re.escape(w) for w in sorted(out) if not any(x != w and x in w for x in out))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """One row per document: `id_col`, n_blocks, licenses (sorted), reduction, n_differences, differences, spans.

    reduction is the best relative size reduction of a candidate block; spans are code points of confirmed wordings,
    which may lie across blocks or outside of them. Texts of any length are read whole. Of equal reductions none is
    preferred, as only the figure is returned, and wordings don't depend on it; of wordings of one licence that begin at
    one place the longest counts. A null or empty text has no blocks. Repeated rows give repeated results; an empty
    table gives an empty result. Other columns are not read, so their names can't clash.
    """

    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(templates)
        for texts in batches:
            yield pd.DataFrame([scanner.scan(t) for t in texts], columns=[c.split(" ")[0] for c in ("n_blocks", "licenses", "reduction", "n_differences", "differences", "spans")])

    # Texts without a trigger or a word that each wording has don't leave the JVM.
    text = F.when(F.col(text_col).rlike(TRIGGER) | F.col(text_col).rlike(needed(templates)), F.col(text_col))
    return docs.select(F.col(id_col), F.pandas_udf(scanned, RESULT)(text).alias("_r")).select(F.col(id_col), "_r.*")
