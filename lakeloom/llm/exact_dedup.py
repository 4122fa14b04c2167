"""Exact deduplication by a tree-merge of sorted digest runs (DataFrame operations only).

Every row becomes a digest record, which is stored once and dealt to one of `runs` runs by chance, so that even a text
which a third of all rows share is spread over all runs. A run is sorted by digest. In each round `fan_in`
neighbouring runs are merged into one: the pieces of their sorted records that have the same digests meet, and a
streaming aggregation over the merged order lets one record per digest survive, with the identifier to keep and the
number of rows. It holds one record at a time, and no hash table. After log(runs) rounds one record per distinct text
is left; it is handed down to the leaf runs, whose rows pick it up.

A merge is verified at every level: the key is the SHA-256 of the normalised text together with its length in
bytes and an independent 64-bit hash, and records meet only if all three agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lower_ascii, only, packed, same, stored, without

#: What makes two texts equal.
KEY = ["_digest", "_bytes", "_check"]


def digest_columns(text: Column) -> list[Column]:
    norm = lower_ascii(F.coalesce(text, F.lit("")))
    return [F.unhex(F.sha2(norm, 256)).alias("_digest"), F.octet_length(norm).alias("_bytes"), F.xxhash64(norm).alias("_check")]


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: int = 256, fan_in: int = 4) -> DataFrame:
    """One row per input row: `id_col`, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; a null text is an empty one, and texts of any length are
    read whole. The row with the largest id stays; null ids count as smallest. Of rows that tie, repeating id and
    text, exactly one is kept. An empty table gives an empty result. Columns other than the two named are not read, so
    their names can't clash.
    """
    rows = docs.select(F.col(id_col).alias("_id"), *digest_columns(F.col(text_col)), F.monotonically_increasing_id().alias("_tag"))
    leaf = stored(rows, "digests").withColumn("_run", F.pmod(F.xxhash64("_tag"), F.lit(runs)).cast("int"))
    leaf = leaf.repartition("_run", *KEY).sortWithinPartitions("_run", *KEY)
    first = merged(leaf.select("_run", *KEY, F.struct("_id", "_tag").alias("_best"), F.lit(1).cast("long").alias("_n")), ["_run", *KEY])
    level, left = first, runs
    while left > fan_in:
        left = -(-left // fan_in)
        level = level.withColumn("_run", F.floor(F.col("_run") / fan_in).cast("int"))
        level = merged(level.repartition("_run", *KEY).sortWithinPartitions("_run", *KEY), ["_run", *KEY])
    whole = merged(level.repartition(*KEY).sortWithinPartitions(*KEY), KEY).where(F.col("_n") > 1).withColumnsRenamed({"_best": "_keep", "_n": "_size"})
    # By the records of the leaf runs, of which a digest has one a run at most; rows get theirs within their run.
    down = first.select("_run", *KEY).join(whole, KEY)
    out = leaf.join(down, ["_run", *KEY], "left")
    alone = F.col("_size").isNull()
    return out.select(
        F.col("_id").alias(id_col),
        F.when(alone, F.col("_id")).otherwise(F.col("_keep._id")).alias("keep_id"),
        F.coalesce("_size", F.lit(1).cast("long")).alias("group_size"),
        F.when(alone, F.lit(True)).otherwise(F.col("_tag") == F.col("_keep._tag")).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
    )


def merged(runs: DataFrame, key: list[str]) -> DataFrame:
    """Merges sorted runs: of each key the largest (id, tag), nulls first, and the sum of the counts. The maximum of a
    struct is kept by Spark's sort-based aggregation, which streams over the order that the runs already have."""
    return runs.groupBy(*key).agg(F.max("_best").alias("_best"), F.sum("_n").alias("_n"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs whose text no row with a larger id repeats, with all columns of docs, whatever their names.

    Null and empty texts are equal; of rows that repeat id and text one stays; an empty table stays empty.
    """
    told = exact_dedup(docs, id_col, text_col).groupBy(F.col(id_col).alias("_gone_id"), F.unhex("text_sha256").alias("_gone_digest"))
    told = told.agg(F.bool_or("kept").alias("_kept"), F.count(F.lit(1)).alias("_c"))
    told = stored(told.where(~F.col("_kept") | (F.col("_c") > 1)), "told")
    marked = packed(docs, F.col(id_col).alias("_id"), digest_columns(F.col(text_col))[0])
    on = same(F.col("_id"), F.col("_gone_id")) & (F.col("_digest") == F.col("_gone_digest"))
    left = without(marked, told, on).select("_row.*")
    repeated = told.where("_kept")
    if repeated.isEmpty():
        return left
    place = F.row_number().over(Window.partitionBy("_id", "_digest").orderBy("_digest"))
    return left.unionByName(only(marked, repeated, on).withColumn("_place", place).where(F.col("_place") == 1).select("_row.*"))
