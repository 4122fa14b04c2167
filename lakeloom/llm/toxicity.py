"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

P(grade <= k) = sigmoid(theta_k - w.x): one weight vector shared by the ordered thresholds theta_1 < theta_2. A text's
features are the prefixes of 4 to 7 letters of its words (so inflected and compounded forms count), each with the
logarithm of its count and that of its rate; only prefixes that are clearly more frequent in toxic sample texts enter.
Two more features are the count and the rate of all words with such a prefix. Counts catch a few words in a long text
that no clean text has; rates keep chance hits of commoner prefixes from adding up over a long text.

The labels say toxic or not. A toxic sample text gets grade 2 if the share of its words with a toxic prefix is at
least the median among toxic sample texts, else grade 1; all others get grade 0. The expected severity is the sum of
P(grade >= k), from 0 to 2.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, stored

#: Labelled rows that the fit reads at most, by the order of a hash of the id.
SAMPLE = 8000
#: The least log-likelihood ratio and number of toxic texts of a feature; all that reach them enter.
LEAST_G, LEAST_DF = 12.0, 4
#: Feature numbers: four times a hash, plus the prefix's length less four.
SPACE = 1 << 18
#: A rate counts hits among so many words.
PER = 100.0
WORD = re.compile(r"[^\W\d_]+")
RESULT = "severity double, grade int, p_toxic double, rejected boolean"


def prefixes(word: str) -> tuple[int, ...]:
    return tuple(zlib.crc32(word[:n].encode("utf-8", "surrogatepass")) % (SPACE // 4) * 4 + n - 4 for n in range(4, min(7, len(word)) + 1))


class Prefixes(dict):
    """word -> its features, those of `chosen` only if given; forgets all when full."""

    def __init__(self, chosen: dict[int, int] | None = None, most: int = 200_000):
        super().__init__()
        self.chosen, self.most = chosen, most

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= self.most:
            self.clear()
        found = prefixes(word)
        if self.chosen is not None:
            found = tuple(f for f in found if f in self.chosen)
        self[word] = found
        return found


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


@dataclass
class ToxicityModel:
    columns: dict[int, int]  # feature -> its place among the weights
    weights: np.ndarray  # of the chosen features' counts and of their rates, then of the count and the rate of hits
    thresholds: np.ndarray  # theta_1 < theta_2

    def vector(self, features: list[int], counts: list[int], n: int) -> tuple[np.ndarray, np.ndarray, float]:
        """Places and values of what isn't 0, and the number of hit words."""
        c, k = np.array(counts, float), len(self.columns)
        at = np.array([self.columns[f] for f in features], np.int64)
        # A word has at most one prefix of each length.
        hits = np.bincount(np.array(features, np.int64) % 4, c, 4).max()
        rate = np.log1p(PER * np.append(c, hits) / max(n, 1))
        return np.concatenate([at, at + k, [2 * k, 2 * k + 1]]), np.concatenate([np.log1p(c), rate[:-1], [np.log1p(hits), rate[-1]]]), hits

    def score(self, texts: pd.Series) -> pd.DataFrame:
        """severity, grade, p_toxic, rejected for each text."""
        found, out = Prefixes(self.columns), np.zeros((len(texts), 2))
        for i, text in enumerate(texts):
            own = words(text)
            if counts := Counter(f for w in own for f in found[w]):
                at, value, _ = self.vector(list(counts), list(counts.values()), len(own))
                out[i] = 1 / (1 + np.exp(np.clip(self.thresholds - self.weights[at] @ value, -50, 50)))
        grade = (out >= 0.5).sum(axis=1)
        return pd.DataFrame({"severity": out.sum(axis=1), "grade": grade.astype(np.int32), "p_toxic": out[:, 0], "rejected": grade > 0})


def counted(text: str, found: Prefixes) -> tuple[Counter, int]:
    """Features of a text with their counts, and the number of words."""
    own = words(text)
    return Counter(x for w in own for x in found[w]), len(own)


def texts_with(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(f, y, n): in how many texts of a label each feature is; at most 2 * SPACE rows whatever the input."""
    found, seen = Prefixes(), np.zeros((2, SPACE), np.int64)
    for frame in frames:
        for y, text in zip(frame["y"], frame["t"], strict=True):
            seen[int(y), list(counted(text, found)[0])] += 1
    y, f = np.nonzero(seen)
    yield pd.DataFrame({"f": f.astype(np.int32), "y": y.astype(bool), "n": seen[y, f]})


def chosen_only(features: list[int]):
    """(id, y, f, c, n): the features that were chosen, with their counts, as bytes, and the number of words."""

    def of(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = Prefixes(dict.fromkeys(features, 0))
        for frame in frames:
            rows = []
            for h, y, text in zip(frame["h"], frame["y"], frame["t"], strict=True):
                c, n = counted(text, found)
                rows.append((h, y, np.fromiter(c, np.int32, len(c)).tobytes(), np.fromiter(c.values(), np.int32, len(c)).tobytes(), n))
            yield pd.DataFrame(rows, columns=["h", "y", "f", "c", "n"])

    return of


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic", sample: int = SAMPLE) -> ToxicityModel:
    """Learns from at most `sample` labelled documents, chosen by the order of a hash of their ids.

    Rows with a null id, label or text are not used; of an id with several labels the largest counts, and of an id
    with several texts the one with the least hash. Features are counted on the executors; the driver gets one number
    a feature and label, then the chosen features of each sample text. Without toxic or without clean documents, or
    without any, the model finds everything clean.
    """
    chosen = labels.where(F.col(toxic_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(toxic_col).alias("_y"))
    chosen = chosen.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).alias("t"))
    # At most `sample` labels are broadcast.
    met = texts.join(F.broadcast(chosen), "_id").groupBy("_id").agg(F.min(F.struct(F.xxhash64("t").alias("h"), "t")).alias("_t"), F.first("_y").alias("_y"))
    met = stored(met.select(F.xxhash64("_id").alias("h"), (F.col("_y") > 0).alias("y"), F.col("_t.t").alias("t")), "sample")
    sizes = {r["y"]: r["n"] for r in met.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = sizes.get(False, 0), sizes.get(True, 0)
    if not n0 or not n1:
        return never_toxic()
    seen = met.select("y", "t").mapInPandas(texts_with, "f int, y boolean, n long").groupBy("f").agg(F.sum(F.when(F.col("y"), F.col("n"))).alias("n1"), F.sum("n").alias("n"))
    table = seen.where(F.col("n1") >= LEAST_DF).toArrow()
    f, with1, with_ = (table.column(i).to_numpy() for i in range(3))
    features = significant(f, with_ - with1, with1, n0, n1)
    got = met.mapInPandas(chosen_only(features), "h long, y boolean, f binary, c binary, n int").collect()
    got.sort(key=lambda r: (r["h"], r["n"]))
    return fitted(features, [(np.frombuffer(r["f"], np.int32), np.frombuffer(r["c"], np.int32), r["n"]) for r in got], np.array([r["y"] for r in got], bool))


def never_toxic() -> ToxicityModel:
    return ToxicityModel({}, np.zeros(2), np.array([50.0, 50.0]))


def significant(f: np.ndarray, with0: np.ndarray, with1: np.ndarray, n0: int, n1: int) -> list[int]:
    """The features that are clearly more frequent in toxic texts, by twice the log-likelihood ratio of their presence."""
    df, n = np.array([with0, with1], float).reshape(2, -1), np.array([[n0], [n1]], float)
    seen = df.sum(axis=0)
    part = lambda o, e: np.where(o > 0, o * np.log(np.maximum(o, 1e-9) / np.maximum(e, 1e-9)), 0)
    g = 2 * (part(df, n * seen / n.sum()) + part(n - df, n * (1 - seen / n.sum()))).sum(axis=0)
    best = (g >= LEAST_G) & (df[1] >= LEAST_DF) & (df[1] * n0 > df[0] * n1)
    order = np.lexsort((f[best], -g[best]))
    return f[best][order].tolist()


def fitted(features: list[int], rows: list[tuple[np.ndarray, np.ndarray, int]], toxic: np.ndarray, steps: int = 800, ridge: float = 1e-4) -> ToxicityModel:
    """The model by the chosen features, their counts and the number of words of each text."""
    if not features:
        return never_toxic()
    k = len(features)
    model = ToxicityModel({f: i for i, f in enumerate(features)}, np.zeros(2 * k + 2), np.array([2.0, 4.0]))
    x, share = np.zeros((len(rows), 2 * k + 2), np.float32), np.zeros(len(rows))
    for i, (f, c, n_words) in enumerate(rows):
        if len(f):
            at, value, hits = model.vector(f.tolist(), c.tolist(), n_words)
            x[i, at] = value
            share[i] = hits / max(n_words, 1)
    grade = np.where(toxic, 1 + (share >= np.median(share[toxic])), 0)
    return ascend(model, x, grade, steps, ridge)


def ascend(model: ToxicityModel, x: np.ndarray, grade: np.ndarray, steps: int, ridge: float) -> ToxicityModel:
    """Maximises the likelihood with Adam; theta_2 = theta_1 + exp(gap) keeps the thresholds ordered."""
    k = x.shape[1]
    p = np.concatenate([np.zeros(k), [2.0, 0.0]])
    m, v = np.zeros_like(p), np.zeros_like(p)
    sigmoid = lambda s: 1 / (1 + np.exp(-np.clip(s, -50, 50)))
    for step in range(1, steps + 1):
        score, gap = x @ p[:k].astype(np.float32), np.exp(p[k + 1])
        c1, c2 = sigmoid(p[k] - score), sigmoid(p[k] + gap - score)
        d1, d2 = c1 * (1 - c1), c2 * (1 - c2)
        mid = np.maximum(c2 - c1, 1e-12)
        g1 = np.where(grade == 0, 1 - c1, np.where(grade == 1, -d1 / mid, 0))  # by theta_1
        g2 = np.where(grade == 1, d2 / mid, np.where(grade == 2, -c2, 0))  # by theta_2
        g = np.concatenate([-(x.T @ (g1 + g2).astype(np.float32)) / len(x) - ridge * p[:k], [(g1 + g2).mean(), (g2 * gap).mean()]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p += 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    model.weights, model.thresholds = p[:k], np.array([p[k], p[k] + np.exp(p[k + 1])])
    return model


def toxicity(text: Column, model: ToxicityModel) -> Column:
    """struct(severity, grade, p_toxic, rejected) of a text; null, empty and wordless texts are clean."""
    return F.pandas_udf(lambda texts: model.score(texts), RESULT)(text)


def grade_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """One row per document: `id_col`, severity, grade (0 to 2), p_toxic, rejected (grade over 0).

    Null and empty texts are clean, and texts of any length are read whole; a probability of exactly one half counts
    for the higher grade. Repeated rows give repeated results; an empty table gives an empty result. Other columns are
    not read, so their names can't clash.
    """
    model = fit_toxicity(docs, labels, id_col, text_col, sample=sample)
    return docs.select(F.col(id_col), toxicity(F.col(text_col), model).alias("_r")).select(F.col(id_col), "_r.*")


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """The rows of docs that aren't rejected, repeated ones included, with all columns of docs, whatever their names.
    Null and empty texts stay; an empty table stays empty."""
    model = fit_toxicity(docs, labels, id_col, text_col, sample=sample)
    graded = packed(docs, toxicity(F.col(text_col), model)["rejected"].alias("_rejected"))
    return graded.where(~F.col("_rejected")).select("_row.*")
