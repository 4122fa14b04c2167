"""Benchmark decontamination by a prefix-filtered set join (DataFrame operations only).

An item is cut into windows of `width` consecutive words. A document contains a window only if it contains every
token of it, so one token is a sufficient prefix for exact containment: the rarest one, by its count over all
documents. The join meets documents only at the places of these prefix tokens; length and position bounds discard
places where the window would stick out of the document, and what is left is compared word by word.

The documents are cut into words twice: to count the tokens of windows, and to look for windows. The second pass also
gives each document's number of words; it is stored, and all that follows works on it.

The windows are broadcast in blocks of at most `block` windows; a benchmark of more windows takes more passes over
the documents, so that the broadcast stays bounded however many items there are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lower_ascii, packed, same, stored, without

BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Identifies a row of documents, also where an id repeats or is null.
ROW = ["_id", "_hash", "_len"]


def words_of(text: Column) -> Column:
    """The words of a text as they are written."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN_WORDS), "")


def item_windows(items: DataFrame, item_col: str, text_col: str, width: int) -> DataFrame:
    """(_window, _k, _item): the words of each window joined by blanks, how many they are, and an item that has it."""
    cut = items.select(F.col(item_col).cast("string").alias("_item"), words_of(lower_ascii(F.col(text_col))).alias("_w")).where(F.size("_w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("_w") - (width - 1), F.lit(1)))
    cut = cut.select("_item", "_w", F.explode(starts).alias("_s"))
    return cut.select("_item", F.array_join(F.slice("_w", F.col("_s"), width), " ").alias("_window"), F.least(F.size("_w"), F.lit(width)).alias("_k")).distinct()


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = 10, block: int = 100_000) -> DataFrame:
    """One row per document: `id_col`, n_words, n_hit, n_items, items_sha256, contaminated.

    A word is hit if it lies in an occurrence of a window. A null or empty text has no words, and long ones are read
    whole; an item without words has no window, and one of fewer than `width` words is one window. Of equally rare
    tokens of a window the first by name is its prefix, which changes no result. Repeated rows give repeated results.
    Items that share an id count once. Without items nothing is hit; an empty table gives an empty result. Other
    columns of either table are not read, so their names can't clash.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_hash"), F.length(text_col).alias("_len"), words_of(F.col(text_col)).alias("_words"))
    # Benchmarks are small beside documents; their windows are stored once, as every pass reads them.
    windows = stored(item_windows(items, item_col, item_text_col, width), "windows")
    blocks = max(1, -(-windows.count() // block))
    windows = windows.withColumn("_block", F.pmod(F.xxhash64("_window"), F.lit(blocks)))
    counts = stored(token_counts(rows, windows, blocks), "counts")
    found = stored(reduce(DataFrame.union, [occurrences(rows, windows, counts, i) for i in range(blocks)]), "hits")
    base = found.where(F.col("_window").isNull()).select(*ROW, F.col("_size").cast("long").alias("n_words"))
    hits = found.where(F.col("_window").isNotNull()).repartition(*ROW)

    spans = hits.groupBy(*ROW, "_start").agg(F.max(F.col("_start") + F.col("_k")).alias("_end"))
    before = Window.partitionBy(*ROW).orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.col("_end") - F.greatest(F.col("_start"), F.coalesce(F.max("_end").over(before), F.lit(0))), F.lit(0))
    covered = spans.select(*ROW, fresh.alias("_new")).groupBy(*ROW).agg(F.sum("_new").cast("long").alias("n_hit"))

    owned = hits.select(*ROW, "_window").distinct().join(windows.select("_window", "_item"), "_window")
    named = owned.select(*ROW, "_item").distinct().groupBy(*ROW).agg(F.sort_array(F.collect_list("_item")).alias("_items"))

    named = named.withColumnsRenamed({c: f"{c}3" for c in ROW})
    both = covered.join(named, same_row(covered, named, "3")).withColumnsRenamed({c: f"{c}2" for c in ROW})
    out = base.join(both, same_row(base, both, "2"), "left")
    items_of = F.coalesce("_items", F.array().cast("array<string>"))
    return out.select(
        F.col("_id").alias(id_col),
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.size(items_of).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def same_row(a: DataFrame, b: DataFrame, mark: str) -> Column:
    return reduce(Column.__and__, [same(a[c], b[c + mark]) for c in ROW])


def token_counts(rows: DataFrame, windows: DataFrame, blocks: int) -> DataFrame:
    """(_token, _count): how often each token of a window occurs in all documents."""
    tokens = windows.select("_block", F.explode(F.split("_window", " ")).alias("_token")).distinct()
    parts = []
    for i in range(blocks):
        of_block = tokens.where(F.col("_block") == i).select("_token")
        met = rows.select(F.explode("_words").alias("_word")).select(lower_ascii(F.col("_word")).alias("_token")).join(F.broadcast(of_block), "_token")
        parts.append(met.groupBy("_token").agg(F.count(F.lit(1)).alias("_count")))
    return reduce(DataFrame.union, parts).distinct()


def occurrences(rows: DataFrame, windows: DataFrame, counts: DataFrame, block: int) -> DataFrame:
    """Each place of a document where a window of the block occurs: ROW, _size (words of the document), _window, _k,
    _start (from 0). The first block also has each document once with a null window."""
    own = windows.where(F.col("_block") == block).select("_window", "_k").distinct()
    spread = own.select("_window", "_k", F.posexplode(F.split("_window", " ")).alias("_at", "_token"))
    known = spread.join(counts, "_token", "left").withColumn("_count", F.coalesce("_count", F.lit(0)))
    ranked = known.groupBy("_window", "_k").agg(F.min(F.struct("_count", "_token", "_at")).alias("_rare"))
    prefix = ranked.select(F.col("_rare._token").alias("_token"), F.col("_rare._at").alias("_at"), "_window", "_k")
    if not block:
        # No word is empty: this token stands before the first word of every document and for the document itself.
        whole = rows.sparkSession.range(1).select(F.lit("").alias("_token"), F.lit(0).alias("_at"), F.lit(None).cast("string").alias("_window"), F.lit(0).alias("_k"))
        prefix = prefix.union(whole)
    places = rows.select(*ROW, "_words", F.posexplode(F.concat(F.array(F.lit("")), "_words")).alias("_pos", "_word"))
    places = places.withColumn("_token", lower_ascii(F.col("_word")))
    start = F.col("_pos") - 1 - F.col("_at")
    held = lower_ascii(F.array_join(F.slice("_words", start + 1, F.col("_k")), " "))
    inside = (start >= 0) & (start + F.col("_k") <= F.size("_words"))
    fits = F.when(F.col("_window").isNull(), True).when(inside, held == F.col("_window")).otherwise(False)
    return places.join(F.broadcast(prefix), "_token").where(fits).select(*ROW, F.size("_words").alias("_size"), "_window", "_k", start.alias("_start"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of docs in which no window of an item occurs, repeated ones included, with all columns of docs,
    whatever their names. Null and empty texts stay; an empty table stays empty."""
    key = F.struct(F.col(id_col).alias("i"), F.xxhash64(text_col).alias("h"))
    found = decontaminate(docs.select(key.alias("_key"), F.col(text_col).alias("_text")), items, id_col="_key", text_col="_text", **how)
    bad = found.where("contaminated").select(F.col("_key.i").alias("_bad_id"), F.col("_key.h").alias("_bad_hash")).distinct()
    own = packed(docs, F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_hash"))
    return without(own, bad, same(F.col("_id"), F.col("_bad_id")) & (F.col("_hash") == F.col("_bad_hash"))).select("_row.*")
