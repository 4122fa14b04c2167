"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from a seed and its code point. An n-gram of letters is bound by
multiplying its letters' vectors, each rotated by its place in the n-gram. A text is the bundle (sum) of its n-grams,
a language the bundle of its training texts, each scaled to unit length. A text gets the language whose prototype has
the largest cosine with it.

A bundle is the sum over distinct n-grams of count times vector, so n-grams are counted first, and a worker keeps the
vectors of frequent n-grams. Texts are read in pieces, so memory doesn't grow with their length; the last letters of a
piece are carried over, so a text has the same n-grams wherever it is cut.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Dimensions, letters of an n-gram, and the seed of all letters.
DIMENSIONS, N, SEED = 1024, 3, 7
#: Training texts at most, by the order of a hash of the id.
SAMPLE = 6000
#: n-gram vectors that a worker keeps (each of DIMENSIONS bytes), and code points of a piece of text.
KEPT, PIECE = 40_000, 1 << 18
SPACE = 32


class Vectors:
    """n-gram codes -> rows of +1 and -1."""

    def __init__(self) -> None:
        self.letters: dict[int, np.ndarray] = {}
        self.at: dict[int, int] = {}
        self.rows = np.empty((KEPT, DIMENSIONS), np.int8)

    def letter(self, point: int) -> np.ndarray:
        if point not in self.letters:
            if len(self.letters) >= 20_000:
                self.letters.clear()
            self.letters[point] = np.random.default_rng([SEED, point]).integers(0, 2, DIMENSIONS, dtype=np.int8) * np.int8(2) - np.int8(1)
        return self.letters[point]

    def gram(self, code: int) -> np.ndarray:
        out = np.ones(DIMENSIONS, np.int8)
        for place in range(N):
            out *= np.roll(self.letter(code & 0x1FFFFF), place)
            code >>= 21
        return out

    def of(self, codes: np.ndarray) -> np.ndarray:
        """The rows of at most KEPT distinct codes."""
        new = [c for c in codes.tolist() if c not in self.at]
        if len(self.at) + len(new) > KEPT:
            self.at.clear()
            new = codes.tolist()
        for c in new:
            self.rows[len(self.at)] = self.gram(c)
            self.at[c] = len(self.at)
        return self.rows[np.fromiter(map(self.at.__getitem__, codes.tolist()), np.int64, len(codes))]


LETTERS = np.zeros(0x110000, bool)


def letter_table() -> np.ndarray:
    if not LETTERS[97]:
        LETTERS[:] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return LETTERS


def letters(text: str) -> np.ndarray:
    """Code points of lower-cased letters, anything else as a blank. Lower-casing looks at single letters only (a final
    sigma is one like any), so it doesn't depend on what stands beside a piece."""
    points = np.frombuffer(text.lower().replace("\u03c2", "\u03c3").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return np.where(letter_table()[points], points, SPACE)


def grams(text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct n-gram codes of each piece of a text and their counts; a blank stands before, after and between words."""
    carried = np.array([SPACE], np.int64)
    for lo in range(0, len(text) + 1, PIECE):
        piece = letters(text[lo : lo + PIECE])
        # Python has code points of a text as its items, so a cut never splits one; the end closes the last word.
        points = np.concatenate([carried, piece, [SPACE] if lo + PIECE > len(text) else []]).astype(np.int64)
        points = points[np.append(True, (points[1:] != SPACE) | (points[:-1] != SPACE))]
        if len(points) >= N:
            yield np.unique(sum(points[i : len(points) - N + 1 + i] << np.int64(21 * i) for i in range(N)), return_counts=True)
        carried = points[-(N - 1) :]


def bundle(text: str | None, vectors: Vectors) -> np.ndarray | None:
    """The bundle of a text's n-grams; None if it has no letter."""
    out, any_letter = np.zeros(DIMENSIONS, np.float32), False
    for codes, counts in grams(text or ""):
        any_letter |= bool(len(codes))
        for at in range(0, len(codes), 4096):
            out += counts[at : at + 4096].astype(np.float32) @ vectors.of(codes[at : at + 4096]).astype(np.float32)
    return out if any_letter else None


@dataclass
class LanguageModel:
    names: list[str]
    prototypes: np.ndarray  # unit rows

    def predict(self, frames: Iterable[pd.Series]) -> Iterator[pd.DataFrame]:
        vectors = Vectors()
        for texts in frames:
            out = []
            for text in texts:
                v = bundle(text, vectors) if self.names else None
                if v is None:
                    out.append(("und", 0.0))
                    continue
                cosine = self.prototypes @ v / max(float(np.linalg.norm(v)), 1e-9)
                best = int(cosine.argmax())
                out.append((self.names[best], float(min(1.0, max(0.0, cosine[best])))))
            yield pd.DataFrame(out, columns=["lang_pred", "score"])


def held_out(id_: Column) -> Column:
    """Whether a row is kept out of training."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> LanguageModel:
    """Prototypes from at most `sample` training rows: those with text and language that aren't held out, by the
    order of a hash of their ids. Sums are taken on the executors; the driver gets one vector a language and part.
    """
    usable = docs.where(~held_out(F.col(id_col)) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    chosen = usable.select(F.col(id_col).alias("_id")).orderBy(F.xxhash64("_id"), "_id").limit(sample).distinct()
    rows = usable.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    # At most `sample` ids are broadcast.
    rows = rows.join(F.broadcast(chosen), "_id").select("lang", "text")

    def sums(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vectors, total = Vectors(), {}
        for frame in frames:
            for lang, text in zip(frame["lang"], frame["text"], strict=True):
                v = bundle(text, vectors)
                if v is not None:
                    total[lang] = total.get(lang, 0) + v / max(float(np.linalg.norm(v)), 1e-9)
        for lang, v in total.items():
            yield pd.DataFrame({"lang": lang, "d": np.arange(DIMENSIONS), "v": v.astype(float)})

    got = rows.mapInPandas(sums, "lang string, d int, v double").groupBy("lang", "d").agg(F.sum("v").alias("v")).collect()
    names = sorted({r["lang"] for r in got})
    prototypes = np.zeros((len(names), DIMENSIONS), np.float32)
    for r in got:
        prototypes[names.index(r["lang"]), r["d"]] = r["v"]
    return LanguageModel(names, prototypes / np.maximum(np.linalg.norm(prototypes, axis=1, keepdims=True), 1e-9))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """One row per document: `id_col`, held_out, lang_pred, score (the cosine, from 0 to 1).

    A null or empty text or one without letters gets `und` and 0, as does every text if there is nothing to learn from
    (an empty table gives an empty result). Texts of any length are read whole. Of equal cosines the first language by
    name wins. A null id is not held out. Repeated rows give repeated results; other columns are not read, so their
    names can't clash.
    """
    model = fit_languages(docs, id_col, text_col, lang_col, sample)
    predict = iterated(model)
    return docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), predict(F.col(text_col)).alias("_r")).select(F.col(id_col), "held_out", "_r.*")


def iterated(model: LanguageModel):
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from model.predict(texts)

    return F.pandas_udf(predict, "lang_pred string, score double")
