"""URL filter: rules first, then host words by unigram Viterbi and multinomial naive Bayes.

The lexicon has every word of the pages with its count over all of them. A host's labels are cut into words by the
Viterbi path of the unigram model, in which an unknown word costs more the longer it is. Naive Bayes counts host words
and path words over all pages that a rule judges, and judges the others by their log-odds.

Both tables are DataFrames of any size. Their most frequent entries go to the workers, at most LEXICON and TOKENS;
hosts and urls that may need others get them by a join, so the result is that of the whole tables. Each host is cut
once: what it may look up leaves the workers in batches of LOOKED_UP strings, and what the join finds comes back
sorted by host, so a worker holds the words of one host whatever their number and length.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, stored

#: (verdict, host, path); a rule's name is its host and path.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
#: Words of the lexicon and tokens of the classifier that workers hold, the most frequent first; others are joined.
LEXICON, TOKENS = 50_000, 50_000
#: Strings that a worker gives at once, about.
LOOKED_UP = 20_000
#: Characters of a label of the domain name system at most, so no longer word can be in one.
LONGEST = 63
RUN = re.compile(r"[^\W\d_]+")


def parts(url: Column) -> tuple[Column, Column]:
    """Host, lower-cased, and path of a url; both empty without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    return lower_ascii(F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit(""))), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def first_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits; null if none does."""
    out = F.lit(None).cast("struct<rule string, verdict string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def word_counts(texts: DataFrame, col: str) -> DataFrame:
    """(w, n): every lower-cased word of letters with its count over all texts, markup left out."""
    words = texts.select(F.explode(F.split(F.lower(F.regexp_replace(F.coalesce(F.col(col), F.lit("")), "<[^>]*+>", " ")), r"[^\p{L}]+")).alias("w"))
    return words.where(F.length("w").between(2, LONGEST)).groupBy("w").agg(F.count(F.lit(1)).alias("n"))


class Segmenter:
    """`counts` has words of the lexicon, `total` the sum of all its counts; more words may come with each run."""

    def __init__(self, counts: dict[str, int], total: int | None = None):
        self.total = total or sum(counts.values()) or 1
        self.cost = {w: math.log(self.total / n) for w, n in counts.items()}
        self.unknown = math.log(10 * self.total)

    def words(self, run: str, more: dict[str, int] | None = None) -> list[str]:
        """The cheapest cut of a run of letters; of equal ones that with the longest last words."""
        known, rare = self.cost.get, {w: math.log(self.total / n) for w, n in more.items()} if more else {}
        best, back = [0.0], [0]
        for i in range(1, len(run) + 1):
            least = (math.inf, 0)
            for j in range(max(0, i - LONGEST), i):
                w = run[j:i]
                cost = known(w)
                if cost is None:
                    cost = rare.get(w, self.unknown + 2.3 * len(w))
                least = min(least, (best[j] + cost, j))
            best.append(least[0])
            back.append(least[1])
        out, i = [], len(run)
        while i:
            out.append(run[back[i] : i])
            i = back[i]
        return out[::-1]

    def host_words(self, host: str, more: dict[str, int] | None = None) -> list[str]:
        """Words of all labels but the last one."""
        return [w for run in runs(host) for w in self.words(run, more)]


def runs(host: str) -> list[str]:
    """The runs of letters, lower-cased, in all labels of a host but the last one."""
    labels = host.lower().split(".")
    return [run for label in labels[: max(1, len(labels) - 1)] for run in RUN.findall(label)]


def path_words(path: str) -> list[str]:
    """Letters of the path's parts; every number is one token."""
    return ["#" if w[0].isdigit() else w for w in re.findall(r"[^\W\d_]+|[0-9]+", path.lower())]


def tokens(words: pd.Series, paths: pd.Series) -> pd.Series:
    """Tokens of the classifier: words of the host and of the path."""
    return pd.Series([[f"h:{w}" for w in own] + [f"p:{w}" for w in path_words(path)] for own, path in zip(words, paths, strict=True)], dtype=object)


def candidates(longest: int) -> Callable[[Iterable[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """(_k, w): the strings of a host, of at most `longest` letters, that Viterbi may look up; some come again."""

    def of(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys: list[str] = []
        words: list[str] = []
        for frame in frames:
            for key, host in zip(frame["_k"], frame["host"], strict=True):
                own: set[str] = set()
                for run in runs(host):
                    for i in range(2, len(run) + 1):
                        own.update([run[j:i] for j in range(max(0, i - longest), i - 1)])
                        if len(own) >= LOOKED_UP:
                            yield pd.DataFrame({"_k": key, "w": list(own)})
                            own.clear()
                keys += [key] * len(own)
                words += own
                if len(words) >= LOOKED_UP:
                    yield pd.DataFrame({"_k": keys, "w": words})
                    keys, words = [], []
        yield pd.DataFrame({"_k": keys, "w": words}, dtype=object)

    return of


def cut(segmenter: Segmenter) -> Callable[[Iterable[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """(host, _w): each host's words. Rows come sorted by `_k`: one with the host, and one for each word looked up."""

    def of(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, host, more = None, "", {}
        hosts: list[str] = []
        words: list[list[str]] = []
        size = 0
        for frame in frames:
            for k, h, w, n in zip(frame["_k"], frame["host"], frame["w"], frame["n"].tolist(), strict=True):
                if k != key:
                    if key is not None:
                        hosts.append(host)
                        words.append(segmenter.host_words(host, more))
                        size += 1 + len(words[-1])
                    if size >= LOOKED_UP:
                        yield pd.DataFrame({"host": hosts, "_w": words})
                        hosts, words, size = [], [], 0
                    key, host, more = k, "", {}
                host = h or host
                if w:
                    more[w] = n
        if key is not None:
            hosts.append(host)
            words.append(segmenter.host_words(host, more))
        yield pd.DataFrame({"host": hosts, "_w": words}, dtype=object)

    return of


def judge(log_odds: dict[str, float], prior: float) -> Callable[[pd.Series], pd.DataFrame]:
    """The score by the tokens known here, and the others."""

    def of(rows: pd.Series) -> pd.DataFrame:
        scores = [prior + sum(log_odds.get(t, 0.0) for t in row) for row in rows]
        return pd.DataFrame({"score": pd.Series(scores, dtype=float), "rest": [[t for t in row if t not in log_odds] for row in rows]})

    return of


def most_frequent(table: DataFrame, col: str, n: Column, most: int) -> tuple[list, DataFrame | None]:
    """The `most` most frequent rows, and the others as a DataFrame (None if there are none)."""
    top = table.orderBy(F.desc(n), col).limit(most).collect()
    if len(top) < most or table.count() == most:
        return top, None
    last = top[-1]
    return top, table.where((n < last["_f"]) | ((n == last["_f"]) & (F.col(col) > last[col])))


def words_of_hosts(hosts: DataFrame, segmenter: Segmenter, rare: DataFrame | None, longest: int) -> DataFrame:
    """(host, _w): the words of each of `hosts`, which are distinct; `rare` has those that the segmenter doesn't hold."""
    # A host of 64 characters or more goes by its SHA-256, which has 64: else each of its strings would carry all of it.
    hosts = hosts.select(F.when(F.length("host") < 64, F.col("host")).otherwise(F.sha2("host", 256)).alias("_k"), "host")
    rows = hosts.select("_k", "host", F.lit("").alias("w"), F.lit(0).cast("long").alias("n"))
    if rare is not None:
        # Few bytes of hosts have many strings: as many tasks as a shuffle has, which Spark doesn't put together.
        spread = hosts.repartition(int(hosts.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_k")
        looked_up = spread.mapInPandas(candidates(longest), "_k string, w string")
        rows = rows.union(looked_up.join(rare, "w").select("_k", F.lit("").alias("host"), "w", "n"))
    return rows.repartition("_k").sortWithinPartitions("_k").mapInPandas(cut(segmenter), "host string, _w array<string>")


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """One row per page: `id_col`, host, path, rule, verdict, host_words, score.

    score is the log-odds of allow against block by naive Bayes; the verdict is that of the longest rule that fits
    (of equally long ones the last by name), else allow if score is at least 0, ties included. A url that is null,
    empty or has no `://` has an empty host and path; null or empty html adds no words, and long ones are read whole.
    Without pages that rules judge, the score is 0. Repeated rows give repeated results, and count as often as they
    come. An empty table gives an empty result. Other columns are not read, so their names can't clash.
    """
    host, path = parts(F.col(url_col))
    split = pages.select(F.col(id_col).alias("_id"), host.alias("host"), path.alias("path"))
    lexicon = stored(word_counts(pages, html_col).withColumn("_f", F.col("n")), "lexicon")
    top, rare = most_frequent(lexicon, "w", F.col("_f"), LEXICON)
    total, longest = lexicon.agg(F.sum("n"), F.coalesce(F.max(F.length("w")), F.lit(0))).first()
    segmenter = Segmenter({r["w"]: r["n"] for r in top}, total)
    # Stored, so both sides of the join are plain exchanges and the rows of a frequent host can be split.
    split = split.join(stored(words_of_hosts(split.select("host").distinct(), segmenter, rare, longest), "host-words"), "host")
    ruled = split.withColumn("_r", first_rule(F.col("host"), F.col("path"), rules))
    tokenised = ruled.withColumn("_t", F.pandas_udf(tokens, "array<string>")("_w", "path"))

    labelled = tokenised.where(F.col("_r").isNotNull()).select((F.col("_r.verdict") == "allow").cast("int").alias("y"), "_t")
    met = labelled.select("y", F.explode(F.concat(F.array(F.lit("")), "_t")).alias("t"))  # '' counts the pages
    counts = stored(met.groupBy("t").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b")).withColumn("_f", F.col("a") + F.col("b")), "tokens")
    pages_of = next(iter(counts.where("t = ''").collect()), None)
    prior = math.log((pages_of["a"] + 1) / (pages_of["b"] + 1)) if pages_of else 0.0
    counts = counts.where("t != ''")
    sums = counts.agg(F.coalesce(F.sum("a"), F.lit(0)), F.coalesce(F.sum("b"), F.lit(0)), F.count(F.lit(1))).first()
    n_a, n_b = sums[0] + sums[2] + 1, sums[1] + sums[2] + 1
    frequent, others = most_frequent(counts, "t", F.col("_f"), TOKENS)
    log_odds = {r["t"]: math.log((r["a"] + 1) / n_a) - math.log((r["b"] + 1) / n_b) for r in frequent}

    scored = tokenised.withColumn("_s", F.pandas_udf(judge(log_odds, prior), "score double, rest array<string>")("_t")).select("_id", "host", "path", "_r", "_w", "_s.*")
    if others is None:
        scored = scored.withColumn("_add", F.lit(0.0))
    else:
        odds = others.select("t", (F.log((F.col("a") + 1) / n_a) - F.log((F.col("b") + 1) / n_b)).alias("_o"))
        asked = scored.where(F.size("rest") > 0).select("host", "path", "rest").distinct().select("host", "path", F.explode("rest").alias("t"))
        add = stored(asked.join(odds, "t").groupBy("host", "path").agg(F.sum("_o").alias("_add")), "rare-tokens")
        scored = scored.join(add, ["host", "path"], "left").withColumn("_add", F.coalesce("_add", F.lit(0.0)))
    scored = scored.withColumn("score", F.col("score") + F.col("_add"))
    own = F.when(F.col("score") >= 0, "allow").otherwise("block")
    return scored.select(F.col("_id").alias(id_col), "host", "path", F.col("_r.rule").alias("rule"), F.coalesce("_r.verdict", own).alias("verdict"), F.array_join("_w", " ").alias("host_words"), "score")
