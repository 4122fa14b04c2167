"""Mixing sources to target weights by Pfair scheduling (DataFrame operations only).

A source is a queue of blocks of `block_docs` documents. With weight q of a total Q, block j of a source is released
at slot floor(j*Q/q) and due by slot ceil((j+1)*Q/q); in each slot the released block with the earliest deadline is
played. That keeps every source within less than one block of its share at any time. Weights are fractions as exact as
they are given, so nothing drifts however long the input is. The slots are worked out on the driver from the weights
and the numbers of blocks, a few numbers a block, and go to the executors as a table; documents find their block from
their rank in their source.

When a source runs out, a new phase begins with the next slot: the others share the slots in proportion to their
weights. No row is dropped or repeated, and no slot stays empty.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator, Mapping
from fractions import Fraction
from itertools import islice
from math import lcm

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from .common import packed, same, stored

#: Sources with queues of their own; smaller ones beyond share a queue by their weights, so the tables that are broadcast stay bounded.
MAX_LANES = 4096
#: Slots that go to Spark at once.
BATCH = 1_000_000
#: Parts of a source that are ranked on their own; a source with a third of all rows is spread over all of them.
CHUNKS = 4096
REST = "*"
ADDED = ["mix_phase", "mix_slot", "mix_order", "mix_lane"]


def whole_weights(share: Mapping[str, float], period: int) -> dict[str, int]:
    """Whole weights that add up to about `period`, one at least each, by largest remainder."""
    total = sum(share.values())
    exact = {k: period * v / total for k, v in share.items()}
    out = {k: max(1, int(v)) for k, v in exact.items()}
    for k in sorted(exact, key=lambda k: (int(exact[k]) - exact[k], k))[: max(0, period - sum(out.values()))]:
        out[k] += 1
    return out


def exact_weights(share: Mapping[str, float]) -> dict[str, int]:
    """Whole weights in the exact proportions of the shares as they are written."""
    exact = {k: Fraction(str(v)) for k, v in share.items()}
    unit = lcm(*[v.denominator for v in exact.values()])
    return {k: int(v * unit) for k, v in exact.items()}


def earliest_deadlines(weights: Mapping[str, int]) -> Iterator[str]:
    """The source of each slot without end, by earliest deadline first among released blocks."""
    total = sum(weights.values())
    waiting = [(0, k, 0) for k in weights]  # release, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []  # deadline, source, block
    slot = 0
    while True:
        while waiting and waiting[0][0] <= slot:
            _, k, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * total // weights[k]), k, j))
        _, k, j = heapq.heappop(ready)
        yield k
        heapq.heappush(waiting, ((j + 1) * total // weights[k], k, j + 1))
        slot += 1


def one_period(weights: Mapping[str, int]) -> dict[str, list[int]]:
    """The slots of each source until the schedule repeats."""
    out: dict[str, list[int]] = {k: [] for k in weights}
    for slot, k in enumerate(islice(earliest_deadlines(weights), sum(weights.values()))):
        out[k].append(slot)
    return out


def phases(blocks: Mapping[str, int], weights: Mapping[str, int]) -> Iterator[tuple[str, int, int, int]]:
    """(source, phase, block, slot) of all blocks in the order of slots."""
    left, done, slot, n = dict(blocks), dict.fromkeys(blocks, 0), 0, 0
    while left:
        for k in earliest_deadlines({k: weights[k] for k in left}):
            yield k, n, done[k], slot
            done[k] += 1
            left[k] -= 1
            slot += 1
            # The phase ends with the first last block.
            if not left[k]:
                del left[k]
                break
        n += 1


def small_table(spark: SparkSession, columns: Mapping[str, list], kind: pa.DataType, **more: pa.Array) -> DataFrame:
    return spark.createDataFrame(pa.table({k: pa.array(v, kind) for k, v in columns.items()} | more))


def slot_table(spark: SparkSession, slots: Iterable[tuple[str, int, int, int]]) -> DataFrame:
    """The slots as a table; beyond one batch it is stored, so the driver never holds more than a batch."""
    kinds, it, out = pa.schema([("_pl", pa.string()), ("_phase", pa.int64()), ("_pb", pa.int64()), ("_slot", pa.int64())]), iter(slots), None
    while (batch := list(islice(it, BATCH))) or out is None:
        columns = zip(*batch, strict=True) if batch else [()] * 4
        df = spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds))
        if out is not None or len(batch) == BATCH:
            df = stored(df, "slots")
        out = df if out is None else out.unionByName(df)
    return out


def identity(docs: DataFrame) -> Column:
    """A 64-bit hash of a whole row; maps, which can't be hashed, count by their entries."""
    maps = {f.name for f in docs.schema if isinstance(f.dataType, MapType)}
    quoted = lambda n: F.col(f"`{n}`")
    return F.xxhash64(*[F.map_entries(quoted(n)) if n in maps else quoted(n) for n in docs.columns])


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, id_col: str = "doc_id", source_col: str = "source", block_docs: int = 16, temperature: float = 0.5, queues: int | None = None) -> DataFrame:
    """All rows and columns of docs, with mix_phase, mix_slot, mix_order (long) and mix_lane (string) added.

    Rows in the order of mix_order interleave the sources; mix_order is unique and has gaps where a block isn't
    full. `weights` gives the share of each source; sources that it doesn't name get the least share named. Without
    it, shares are the row counts to the power of `temperature`. A null source is a source of its own. Within a
    source the order is that of a hash of the id, then the id, then a hash of the row, so rows that share an id (or
    have none) are told apart by what they hold, and rows alike in everything take places next to each other. Sources
    beyond the `queues` largest make up lane `*`, whose weight is the sum of theirs; within it each keeps its own, row
    r of a source of weight w standing at (r + u) / w, u in [0, 1) by its name. Weights have to be over 0. Texts are
    moved as they are, null, empty or long. An input column with the name of one that is added becomes `<name>_in`.
    `queues` is MAX_LANES unless given. An empty table stays empty.
    """
    if weights and min(weights.values()) <= 0:
        raise ValueError("weights have to be over 0")
    spark, queues = docs.sparkSession, queues or MAX_LANES
    for name in [c for c in docs.columns if c.lower() in ADDED]:
        free = f"{name}_in"
        while free.lower() in map(str.lower, docs.columns):
            free += "_in"
        docs = docs.withColumnRenamed(name, free)
    # Ranks are worked out on narrow rows; whole rows are only hashed here and joined with their places at the end.
    narrow = docs.select(F.col(source_col).cast("string").alias("_source"), F.col(id_col).alias("_oid"), identity(docs).alias("_s"))
    narrow = stored(narrow.groupBy("_source", "_oid", "_s").agg(F.count(F.lit(1)).alias("_c")), "narrow")
    by_source = narrow.groupBy(F.col("_source").alias("_s")).agg(F.sum("_c").alias("_n"))
    sized = by_source.orderBy(F.desc("_n"), F.asc_nulls_first("_s")).limit(queues).collect()
    named = {r["_s"]: r["_n"] for r in sized}
    lane_of = {s: f"={s}" if s is not None else "null" for s in named}
    counts = {lane_of[s]: n for s, n in named.items()}
    least = min(weights.values()) if weights else None
    share = {lane_of[s]: weights.get(s, least) if weights else n**temperature for s, n in named.items()}
    lanes = small_table(spark, {"_ls": list(lane_of), "_lane": list(lane_of.values())}, pa.string())
    keyed = narrow.join(F.broadcast(lanes), F.col("_source").eqNullSafe(F.col("_ls")), "left").drop("_ls")
    keyed = keyed.withColumn("_lane", F.coalesce("_lane", F.lit(REST))).withColumn("_h", F.xxhash64("_oid"))
    keyed = keyed.withColumn("_chunk", F.pmod("_h", F.lit(CHUNKS))).withColumn("_at", F.lit(0.0))
    if len(named) == queues:
        members = by_source.join(F.broadcast(lanes), F.col("_s").eqNullSafe(F.col("_ls")), "left_anti")
        if weights:
            given = small_table(spark, {"_gs": list(weights)}, pa.string(), _gw=pa.array(map(float, weights.values()), pa.float64()))
            members = members.join(given, F.col("_s").eqNullSafe(F.col("_gs")), "left").withColumn("_w", F.coalesce("_gw", F.lit(float(least))))
        else:
            members = members.withColumn("_w", F.pow("_n", F.lit(float(temperature))))
        members = members.select(F.col("_s").alias("_ms"), F.col("_n").alias("_mn"), "_w", (F.col("_n") / F.col("_w")).alias("_last"))
        rest = members.agg(F.sum("_mn").alias("n"), F.sum("_w").alias("w"), F.max("_last").alias("last")).first()
        if rest["n"]:
            counts[REST], share[REST] = rest["n"], rest["w"]
            # No member has more rows than the least of so many other sources.
            in_source = Window.partitionBy("_source").orderBy("_h", "_oid", "_s").rowsBetween(Window.unboundedPreceding, -1)
            start = F.pmod(F.xxhash64("_source"), F.lit(1 << 20)) / F.lit(1 << 20)
            small = keyed.where(F.col("_lane") == REST).withColumn("_r", F.coalesce(F.sum("_c").over(in_source), F.lit(0)))
            small = small.join(members, F.col("_source").eqNullSafe(F.col("_ms"))).withColumn("_at", (F.col("_r") + start) / F.col("_w"))
            small = small.withColumn("_chunk", F.least(F.floor(F.col("_at") / rest["last"] * CHUNKS), F.lit(CHUNKS - 1)))
            keyed = keyed.where(F.col("_lane") != REST).unionByName(small.select(*keyed.columns))
    slots = slot_table(spark, phases({k: -(-n // block_docs) for k, n in counts.items()}, exact_weights(share)))

    sizes = keyed.groupBy("_lane", "_chunk").agg(F.sum("_c").alias("_cc"))
    before = Window.partitionBy("_lane").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("_lane").alias("_ol"), F.col("_chunk").alias("_oc"), F.coalesce(F.sum("_cc").over(before), F.lit(0)).alias("_before"), "_cc")
    first = F.floor(F.col("_before") / block_docs)
    # Blocks of each chunk with their slots, so that rows need no further join.
    each = offsets.select("_ol", "_oc", "_before", F.explode(F.sequence(first, F.floor((F.col("_before") + F.col("_cc") - 1) / block_docs))).alias("_ob"))
    met = each.join(slots, (F.col("_ol") == F.col("_pl")) & (F.col("_ob") == F.col("_pb")))
    played = met.groupBy("_ol", "_oc").agg(F.first("_before").alias("_before"), F.array_sort(F.collect_list(F.struct("_ob", "_phase", "_slot"))).alias("_played"))
    place = Window.partitionBy("_lane", "_chunk").orderBy("_at", "_h", "_oid", "_s").rowsBetween(Window.unboundedPreceding, -1)
    # The rows are dealt by lane and chunk already, so this join moves only the offsets.
    ranked = keyed.withColumn("_in", F.coalesce(F.sum("_c").over(place), F.lit(0))).join(played, (F.col("_lane") == F.col("_ol")) & (F.col("_chunk") == F.col("_oc")))
    # Rows alike in everything have one narrow row; each of them gets a place of its own.
    ranked = ranked.withColumn("_twin", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_c") - 1)))
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_in") + F.col("_twin"))
    timed = ranked.withColumn("_b", F.col("_played")[(F.floor(F.col("_rank") / block_docs) - first).cast("int")])
    slot = F.col("_b._slot")
    places = timed.select(
        F.col("_oid").alias("_i2"), F.col("_s").alias("_s2"), F.col("_twin").alias("_t2"),
        F.col("_b._phase").alias("mix_phase"), slot.alias("mix_slot"), (slot * block_docs + F.col("_rank") % block_docs).alias("mix_order"), F.col("_lane").alias("mix_lane"),
    )

    own = packed(docs, F.col(id_col).alias("_oid"), identity(docs).alias("_s"))
    alike = narrow.where(F.col("_c") > 1).select(F.col("_oid").alias("_i1"), F.col("_s").alias("_s1"))
    if alike.isEmpty():
        own = own.withColumn("_twin", F.lit(0).cast("long"))
    else:
        marked = own.join(alike, same(F.col("_oid"), F.col("_i1")) & (F.col("_s") == F.col("_s1")), "left").drop("_i1")
        one = marked.where(F.col("_s1").isNull()).withColumn("_twin", F.lit(0).cast("long"))
        twin = (F.row_number().over(Window.partitionBy("_oid", "_s").orderBy("_s")) - 1).cast("long")
        own = one.unionByName(marked.where(F.col("_s1").isNotNull()).withColumn("_twin", twin)).drop("_s1")
    # Whole rows are dealt out once and stream past a hash table of places: no text is sorted or held in a window.
    on = same(F.col("_oid"), F.col("_i2")) & (F.col("_s") == F.col("_s2")) & (F.col("_twin") == F.col("_t2"))
    return own.join(places.hint("shuffle_hash"), on).select("_row.*", *ADDED)
