"""Near-duplicate detection with HyperMinHash.

1. Every document becomes its set of word shingles, a digest of the set, and a HyperMinHash signature: per register
   the leading-zero count and the mantissa bits of its least hash value. Documents with equal sets are one class, so
   copies are neither compared nor expanded into pairs.
2. The compressed registers are banded. A pair at similarity s misses all 32 bands of four registers with
   probability (1 - s**4)**32: 6e-11 at 0.85 and 5e-8 at 0.8.
3. In every bucket each class is paired with the smallest one. Pairs whose collision-corrected estimate is within
   reach of the threshold are confirmed on the full sets, and linked classes get a first component.
4. Classes joined by buckets that still hold several components form a cluster. It is cut into blocks of bounded
   size. Registers meet first: a task has those of two wide blocks and looks for members of different components
   whose sizes and corrected estimate are within reach of the threshold. Texts go only to the blocks in which they
   have such a partner, so texts that merely share boilerplate move a signature and nothing else. There the full sets
   are compared, and only as many links returned as join the components: none between them is lost, and no pair
   becomes a row.
5. A component takes the smallest id of its documents.

Texts travel once to the hubs they are compared with; hubs of many pairs are dealt out over several tasks, which
stream through the pairs and hold one set at a time. Full sets are sets of 64-bit shingle hashes, not of the words
themselves; in a pair of 10,000 shingles each, two that differ have equal hashes with a probability of 5e-12.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import only, packed, same, stored, without
from .components import connected
from .shingles import BANDS, REGISTERS, WordHashes, band_keys, corrected, digest, shingle_set, signature

#: An estimate of less than the threshold by this is four standard deviations off at 128 registers, or more.
SLACK = 0.15
#: Pairs of one hub in a task, members of one of the two blocks whose texts a task compares, and such blocks in a wide one.
HUB_PAIRS, BLOCK, WIDE = 2048, 512, 4


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, percent: int = 85) -> DataFrame:
    """One row per document: `id_col`, n_shingles, component_id, kept, _hash (xxhash64 of the
    text) and _root (names the component, also where ids repeat; null without words).

    Documents are linked when 100 * intersection >= percent * union of their shingle sets. A document without words
    (or null text) is linked with nothing and is its own component. Rows that repeat an id are told apart by text;
    kept tells the rows whose id is their component's, so of rows that tie, repeating id and text, all are kept. A null
    id never names a component that has other ids. Texts of any length are read whole. Other columns are not read, so
    their names can't clash. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_hash"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType
    feature_type = T.StructType([T.StructField("_id", kind), T.StructField("_hash", T.LongType()), T.StructField("_n", T.LongType()), T.StructField("_node", T.BinaryType()), T.StructField("_sig", T.BinaryType())])
    features = stored(rows.mapInArrow(lambda batches: featured(batches, width), feature_type), "features")
    full = features.where(F.col("_n") > 0)
    classes = full.groupBy("_node").agg(F.min("_id").alias("_least"), F.min(F.struct("_id", "_hash")).alias("_rep"), F.first("_n").alias("_n"), F.first("_sig").alias("_sig"))
    classes = stored(classes, "classes")

    bands = classes.select("_node", "_sig").mapInArrow(banded, "_key long, _node binary")
    crowds = bands.groupBy("_key").agg(F.min("_node").alias("_hub"), F.count(F.lit(1)).alias("_c")).where(F.col("_c") > 1)
    shared = stored(bands.join(crowds, "_key"), "buckets")
    reps = shared.select("_node").distinct().join(classes.select("_node", "_rep._id", F.col("_rep._hash").alias("_h")), "_node")
    met = rows.join(reps.withColumnRenamed("_id", "_rid"), same(F.col("_id"), F.col("_rid")) & (F.col("_hash") == F.col("_h")))
    texts = stored(met.select("_node", "_text"), "texts")

    signed = classes.select("_node", "_n", "_sig")
    first = shared.where(F.col("_node") != F.col("_hub")).select("_hub", "_node").distinct()
    first = first.join(signed, "_node").join(signed.select(F.col("_node").alias("_hub"), F.col("_n").alias("_hn"), F.col("_sig").alias("_hsig")), "_hub")
    floor = percent / 100 - SLACK
    first = first.where(F.pandas_udf(estimated, "double")("_sig", "_hsig", "_n", "_hn") >= floor).select("_hub", "_node")
    links = confirmed(stored(first, "pairs"), texts, width, percent)
    roots = connected(links, "_hub", "_node")

    placed = shared.join(roots.withColumnsRenamed({"node": "_node", "root": "_root"}), "_node", "left").withColumn("_root", F.coalesce("_root", "_node"))
    placed = stored(placed.select("_key", "_hub", "_node", "_root"), "placed")
    open_ = placed.groupBy("_key").agg(F.min("_root").alias("_lo"), F.max("_root").alias("_hi")).where(F.col("_lo") != F.col("_hi")).select("_key")
    near = placed.join(open_, "_key").select("_hub", "_node").distinct()
    # Classes that buckets join are one cluster, whatever their components; each goes to its cluster once.
    clusters = connected(near, "_hub", "_node")
    clusters = clusters.union(clusters.select("root", "root").distinct()).toDF("_node", "_cluster")
    parts = clusters.groupBy("_cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("_parts"))
    members = clusters.join(parts, "_cluster").join(placed.select("_node", "_root").distinct(), "_node").join(signed, "_node")
    own = F.pmod(F.hash("_node"), F.col("_parts"))
    wide, wides = F.floor(F.col("_own") / WIDE).cast("int"), F.ceil(F.col("_parts") / WIDE).cast("int")
    pairs_of = F.explode(F.transform(F.sequence(F.lit(0), wides - 1), lambda j: F.struct(F.least(wide, j).alias("i"), F.greatest(wide, j).alias("j"))))
    met = members.withColumn("_own", own).withColumn("_b", pairs_of).select("_cluster", F.col("_b.i").alias("_i"), F.col("_b.j").alias("_j"), "_own", "_node", "_root", "_n", "_sig")
    met = met.repartition("_cluster", "_i", "_j").sortWithinPartitions("_cluster", "_i", "_j")
    within = "_cluster binary, _i int, _j int, _own int, _node binary, _root binary"
    within = stored(met.mapInArrow(lambda batches: in_reach(batches, percent), within), "within")
    blocks = within.join(texts, "_node").select("_cluster", "_i", "_j", "_own", "_node", "_root", "_text")
    blocks = blocks.repartition("_cluster", "_i", "_j").sortWithinPartitions("_cluster", "_i", "_j")
    more = stored(blocks.mapInArrow(lambda batches: crossing(batches, width, percent), "_hub binary, _node binary"), "links")
    ends = connected(roots.select(F.col("root").alias("_hub"), F.col("node").alias("_node")).union(more), "_hub", "_node")

    named = classes.select("_node", "_least").join(ends.withColumnRenamed("node", "_node"), "_node", "left").withColumn("root", F.coalesce("root", "_node"))
    least = named.groupBy("root").agg(F.min("_least").alias("_component"))
    of_node = named.select("_node", "root").join(least, "root").select("_node", "_component", F.col("root").alias("_root"))
    out = features.join(of_node, "_node", "left")
    component = F.when(F.col("_n") > 0, F.col("_component")).otherwise(F.col("_id"))
    return out.select(F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"), component.alias("component_id"), same(F.col("_id"), component).alias("kept"), "_hash", "_root")


def featured(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        for lo in range(0, batch.num_rows, 1024):
            part = batch.slice(lo, 1024)
            n, node, sig = [], [], []
            for text in part.column(2).to_pylist():
                s = shingle_set(text, width, hashes)
                n.append(len(s))
                node.append(digest(s))
                sig.append(signature(s).tobytes() if len(s) else b"")
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(node, pa.binary()), pa.array(sig, pa.binary())], ["_id", "_hash", "_n", "_node", "_sig"])


def registers(sigs: Iterable[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(sigs), np.uint16).reshape(-1, REGISTERS)


def banded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = band_keys(registers(batch.column(1).to_pylist()))
            which = pa.array(np.repeat(np.arange(batch.num_rows), BANDS))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), batch.column(0).take(which)], ["_key", "_node"])


def estimated(a: pd.Series, b: pd.Series, n_a: pd.Series, n_b: pd.Series) -> pd.Series:
    agreeing = (registers(a) == registers(b)).sum(axis=1)
    return pd.Series(corrected(agreeing, n_a.to_numpy(float), n_b.to_numpy(float)))


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (_hub, _node) whose full sets reach the threshold."""
    degree = pairs.groupBy("_hub").agg(F.ceil(F.count(F.lit(1)) / HUB_PAIRS).cast("int").alias("_salts"))
    member = pairs.join(degree, "_hub").select("_hub", F.pmod(F.hash("_node"), F.col("_salts")).alias("_salt"), F.lit(1).alias("_m"), "_node").join(texts, "_node")
    hub = degree.select("_hub", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt"), F.lit(0).alias("_m"), F.col("_hub").alias("_node")).join(texts, "_node")
    cols = ["_hub", "_salt", "_m", "_node", "_text"]
    met = member.select(*cols).union(hub.select(*cols)).repartition("_hub", "_salt").sortWithinPartitions("_hub", "_salt", "_m")
    return stored(met.mapInArrow(lambda batches: compared(batches, width, percent), "_hub binary, _node binary").distinct(), "links")


def compared(batches: Iterable[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows come as a hub, its members, the next hub...; one set of a hub is held at a time."""
    hashes, at, held = WordHashes(), None, np.empty(0, np.uint64)
    for batch in batches:
        out: list[tuple[bytes, bytes]] = []
        for hub, salt, m, node, text in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            own = shingle_set(text, width, hashes)
            if not m:
                at, held = (hub, salt), own
                continue
            if at != (hub, salt):
                raise ValueError("a pair came before its hub")
            both = len(np.intersect1d(held, own, assume_unique=True))
            if 100 * both >= percent * (len(held) + len(own) - both):
                out.append((hub, node))
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.binary()) for i in (0, 1)], ["_hub", "_node"])


def crossing(batches: Iterable[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows come by cluster and block; links between its components, as many as it takes to join them."""
    hashes = WordHashes()
    held: list[tuple] = []
    for batch in batches:
        out: list[tuple[bytes, bytes]] = []
        for *at, own, node, root, text in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
            if held and held[0][0] != at:
                out += links_within(held, percent)
                held = []
            held.append((at, own, node, root, shingle_set(text, width, hashes)))
        yield as_pairs(out)
    if held:
        yield as_pairs(links_within(held, percent))


def in_reach(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows come by cluster and two wide blocks; (cluster, two blocks, member) for the members that have a partner."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(8)), strict=True):
            if held and held[0][:3] != row[:3]:
                yield partners(held, percent)
                held = []
            held.append(row)
    if held:
        yield partners(held, percent)


def partners(rows: list[tuple], percent: int) -> pa.RecordBatch:
    rows = sorted(rows, key=lambda r: r[6])
    (cluster, i, j), n = rows[0][:3], len(rows)
    own, size, sig = np.array([r[3] for r in rows]), np.array([r[6] for r in rows], float), registers(r[7] for r in rows)
    _, group = np.unique(np.array([r[5] for r in rows], object), return_inverse=True)
    wide, by_register = own // WIDE, np.ascontiguousarray(sig.T)
    least = percent / 100 - SLACK
    found, blocks = [np.empty(0, np.int64)], int(own.max()) + 1
    for lo in range(0, n, 128):
        hi = min(n, lo + 128)
        # Members come by size; a set can't have a partner of more than 100 / percent times its own size.
        end = int(np.searchsorted(size, size[hi - 1] * 100 / percent + 1e-6, "right"))
        agreeing = np.zeros((hi - lo, end - lo), np.uint8)
        for register in by_register:
            agreeing += register[lo:hi, None] == register[None, lo:end]
        fits = (agreeing >= int(least * REGISTERS)) & (group[lo:hi, None] != group[None, lo:end])
        if i != j:
            fits &= wide[lo:hi, None] != wide[None, lo:end]
        x, y = np.nonzero(fits)
        near = corrected(agreeing[x, y], size[x + lo], size[y + lo]) >= least
        x, y = x[near] + lo, y[near] + lo
        both = np.minimum(own[x], own[y]) * blocks + np.maximum(own[x], own[y])
        found.append(np.unique(np.concatenate([both * n + x, both * n + y])))
    code = np.unique(np.concatenate(found))
    at, both = (code % n).tolist(), code // n
    columns = [[cluster] * len(code), both // blocks, both % blocks, own[at] if at else [], [rows[k][4] for k in at], [rows[k][5] for k in at]]
    kinds = [pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["_cluster", "_i", "_j", "_own", "_node", "_root"])


def as_pairs(out: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.binary()) for i in (0, 1)], ["_hub", "_node"])


def links_within(block: list[tuple], percent: int) -> list[tuple[bytes, bytes]]:
    (_, i, j), n = block[0][0], len(block)
    own, sizes = np.array([b[1] for b in block]), np.array([len(b[4]) for b in block])
    _, group = np.unique(np.array([b[3] for b in block], object), return_inverse=True)
    _, column, times = np.unique(np.concatenate([b[4] for b in block]), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), sizes)
    # Only shingles of two members or more count for an intersection.
    place = np.cumsum(times > 1) - 1
    row, column = row[times[column] > 1], place[column[times[column] > 1]]
    both = np.zeros((n, n), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, [lo, lo + 4096])
        has = np.zeros((n, 4096), np.float32)
        has[row[a:b], column[a:b] - lo] = 1
        both += has @ has.T
    linked = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
    linked &= group[:, None] != group[None, :]
    if i != j:
        linked &= own[:, None] != own[None, :]
    parent = list(range(int(group.max()) + 1))
    out: list[tuple[bytes, bytes]] = []

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in np.argwhere(np.triu(linked)).tolist():
        a, b = top(group[x]), top(group[y])
        if a != b:
            parent[a] = b
            out.append((block[x][2], block[y][2]))
    return out


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row of docs of each component, that of the smallest id, with all columns of docs, whatever their names.

    Texts without words (or null) are near nothing; of rows that repeat an id and text one stays, with words or
    without; an empty table stays empty.
    """
    found = stored(near_duplicates(docs, id_col, text_col, width, percent), "found")
    # One row stands for a component also where an id or a whole row repeats.
    one = found.where("kept").groupBy(F.col(id_col).alias("_i"), "_root", F.when(F.col("n_shingles") == 0, F.col("_hash")).alias("_bare")).agg(F.min("_hash").alias("_h")).select("_i", "_h")
    times = found.groupBy(F.col(id_col).alias("_ti"), F.col("_hash").alias("_th")).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > 1)
    own = packed(docs, F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_hash"))
    met = only(own, one, same(F.col("_id"), F.col("_i")) & (F.col("_hash") == F.col("_h")))
    if times.isEmpty():
        return met.select("_row.*")
    on = same(F.col("_id"), F.col("_ti")) & (F.col("_hash") == F.col("_th"))
    first = F.row_number().over(Window.partitionBy("_id", "_hash").orderBy("_hash"))
    return without(met, times, on).select("_row.*").unionByName(only(met, times, on).withColumn("_first", first).where(F.col("_first") == 1).select("_row.*"))
