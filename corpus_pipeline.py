"""From raw documents to a mixed training corpus, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written and read again as the docs of
the next one. All but the last return the columns of documents; the last adds mix_phase, mix_slot, mix_order and
mix_lane, and mix_order sorts the corpus.

What all stages have in common: an empty table stays empty; texts are read whole, however long; rows keep all their
columns, whatever the names; a row that comes twice in everything counts as one text, of which exact_dedup keeps one row.
Null texts are clean, equal to empty ones, near nothing, without benchmark passages and mixed like any.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm.common import WRITTEN, release, stored, table
from lakeloom.llm.decontaminate import drop_contaminated
from lakeloom.llm.exact_dedup import drop_exact_copies
from lakeloom.llm.mixing import mix
from lakeloom.llm.near_dedup import drop_near_copies
from lakeloom.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the ordinal model grades over 0. A probability of one half counts as toxic; null and empty
    texts, and all texts where no labels are of any use, stay; repeated rows share their fate."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the largest doc_id of texts that are equal but for A-Z; null and empty texts are equal, null ids smallest, and
    of rows that tie by repeating id and text one stays."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group linked at a similarity of 0.8 on shingles of five words. Texts without words
    are linked with nothing; of rows that tie by repeating id and text one stays."""
    return drop_near_copies(docs, width=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a window of a benchmark item occurs. Null and empty texts have none; without items all
    documents stay; repeated rows share their fate."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Interleaves the sources by the square roots of their sizes; drops nothing. A null source is one of its own, ties go
    by a hash of the row, and an input column with the name of one that is added becomes `<name>_in`."""
    return mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix_sources),
]

#: Toxicity is a trained model, which SQL can't express; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies STAGES to documents; each result but the last is stored in the shared folder and read again, and what the
    stages before it had stored is deleted then."""
    docs, since = table(spark, sf_dir, "documents"), len(WRITTEN)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, name)
            release(spark, since, keep=docs)
    return docs
