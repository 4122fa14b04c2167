"""Removal of repeated substrings by sorting suffixes (deep-shallow sorting).

A string of `length` bytes that occurs twice has the same anchor in both places (suffix_sort.anchors), so only the
suffixes at anchors need sorting, together with the bytes before them.

1. Anchors are found in every text and counted by the hash of their first KEY bytes; those whose key occurs once can't
   lie in a repeated string.
2. The others are grouped by document and meet their text once. Each gives its context: the bytes within reach of a
   string of `length` bytes around it. Equal contexts are one entry with a count.
3. The contexts of a key meet in one task, in which the suffixes from the anchor and the reversed bytes before it are
   sorted. Adjacent common prefixes tell which contexts agree on both sides, and so which strings occur elsewhere.
   A key with more than HOT different contexts is split by more context: all strings that start a to b bytes before
   the anchor share the bytes from there on, so contexts meet only with those that agree in them, for these distances.
   Where even that leaves more than HOT, distances are taken one by one: then the whole string is shared and nothing
   is left to sort, so strings are counted by a 128-bit hash in an aggregation.
4. Repeated strings go back to the documents, where they are cut out.

Stretches of one short period (blanks, rules) are covered as they are, see suffix_sort.long_runs: they would give as
many contexts as bytes. Contexts leave a worker in batches of BATCH bytes and count equal ones of a batch once, so a
worker's memory is that of a text and a batch, however long or monotonous texts are.

Rows are named by a 64-bit hash of id and text; wherever a name meets a text, the anchor's key is checked again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .suffix_sort import KEY, agreement, anchors, common_prefixes, deep_shallow, keys_of, long_runs_of

#: Different contexts of a key that are sorted in one task.
HOT = 65_536
#: Contexts that are compared pair by pair after sorting.
PAIRS = 160
#: Texts of an Arrow batch that are worked on at once, and bytes of what leaves a worker at once.
TEXTS, BATCH = 256, 1 << 24
#: Ranges of distances into which a key with more than HOT contexts is split.
RANGES = 8


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200) -> DataFrame:
    """One row per document: `id_col`, n_bytes, n_removed, n_spans, kept_sha256.

    Every byte of the text's UTF-8 that is covered by a string of `length` bytes which also starts at another place,
    in this or another document, is removed; strings are judged on the input and may overlap. A null text is empty.
    Rows that repeat id and text are documents of their own, so their strings repeat; no copy is spared, so there are
    no ties. Texts of any length are read whole. Other columns are not read, so their names can't clash; an empty
    table gives an empty result.
    """
    if length < KEY + 16:
        raise ValueError(f"length must be {KEY + 16} or more")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), F.xxhash64(F.col(id_col), text, F.length(text)).alias("_ref"))
    long_ = rows.where(F.octet_length("_text") >= length)

    found = long_.select("_ref", "_text").mapInArrow(lambda b: anchored(b, length), "_ref long, _key long, _pos int")
    twice = stored(found.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("_key"), "keys")
    shared = stored(found.join(twice, "_key").select("_ref", "_key", "_pos"), "anchors")
    of_ref = shared.distinct().groupBy("_ref").agg(F.collect_list(F.struct("_pos", "_key")).alias("_at"))
    of_ref = of_ref.select("_ref", F.transform("_at", lambda x: x["_pos"]).alias("_at"), F.transform("_at", lambda x: x["_key"]).alias("_keys"))
    texts = stored(long_.select("_ref", "_text").join(of_ref, "_ref"), "texts")

    contexts = texts.mapInArrow(lambda b: in_context(b, length), "_key long, _whole long, _left int, _bytes binary, _n long")
    entries = contexts.groupBy("_key", "_whole").agg(F.sum("_n").alias("_n"), F.first("_left").alias("_left"), F.first("_bytes").alias("_bytes"))
    entries = stored(entries, "contexts")
    crowded = lambda e, *by: stored(e.groupBy(*by).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > HOT).select(*by), "hot")
    hot = crowded(entries, "_key")
    groups = entries.select("_key", F.lit(0).cast("long").alias("_part"), "_whole", "_n", "_left", "_bytes", F.lit(0).alias("_a"), F.lit(length - KEY).alias("_b"))
    if hot.isEmpty():
        runs = sorted_runs(groups, length)
    else:
        split = entries.join(hot, "_key", "left_semi").select("_key", "_whole", "_n", "_left", "_bytes")
        split = stored(split.mapInArrow(lambda b: in_ranges(b, length), "_key long, _part long, _whole long, _n long, _left int, _bytes binary, _a int, _b int"), "split")
        still = crowded(split, "_key", "_part")
        runs = sorted_runs(groups.join(hot, "_key", "left_anti").unionByName(split.join(still, ["_key", "_part"], "left_anti").select(*groups.columns)), length)
        runs = runs.union(counted_runs(split.join(still, ["_key", "_part"], "left_semi"), length))
    runs = stored(runs, "runs")

    places = texts.mapInArrow(lambda b: places_of(b, length), "_ref long, _pos int, _key long, _whole long")
    spans = places.join(runs, ["_key", "_whole"]).select("_ref", (F.col("_pos") + F.col("_lo")).alias("lo"), (F.col("_pos") + F.col("_hi")).alias("hi"))
    per_ref = spans.distinct().groupBy("_ref").agg(F.collect_list(F.struct("lo", "hi")).alias("_spans"))
    cut = texts.select("_ref", "_text").join(per_ref, "_ref").mapInArrow(lambda b: cut_out(b, length), "_ref long, _size long, _removed long, _n_spans long, _sha string").distinct()

    base = rows.select("_id", "_ref", F.octet_length("_text").cast("long").alias("_bytes"), F.sha2("_text", 256).alias("_whole_sha"))
    out = base.join(cut, (base["_ref"] == cut["_ref"]) & (base["_bytes"] == cut["_size"]), "left")
    zero = F.lit(0).cast("long")
    return out.select(F.col("_id").alias(id_col), F.col("_bytes").alias("n_bytes"), F.coalesce("_removed", zero).alias("n_removed"), F.coalesce("_n_spans", zero).alias("n_spans"), F.coalesce("_sha", "_whole_sha").alias("kept_sha256"))


def parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, TEXTS):
            yield batch.slice(lo, TEXTS)


def table(names: str, *columns: tuple[Iterable, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names.split())


def sorted_runs(groups: DataFrame, length: int) -> DataFrame:
    met = groups.repartition("_key", "_part").sortWithinPartitions("_key", "_part")
    return met.mapInArrow(lambda b: repeated(b, length), "_key long, _whole long, _lo int, _hi int")


def joined(column: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The UTF-8 of a column's texts as it lies there, one after the other, and where each text ends."""
    own = column.cast(pa.large_string()).cast(pa.large_binary())
    bounds = np.frombuffer(own.buffers()[1], np.int64)[own.offset : own.offset + len(own) + 1]
    return memoryview(own.buffers()[2] or b"")[bounds[0] : bounds[-1]], bounds[1:] - bounds[0]


def starts_of(ends: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], ends[:-1]]).astype(np.int64)


def anchored(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in parts(batches):
        data, ends = joined(batch.column(1))
        at = anchors(data, length, ends)
        text = np.searchsorted(ends, at, side="right")
        refs, places = batch.column(0).to_numpy()[text], (at - starts_of(ends)[text]).astype(np.int32)
        for lo in range(0, len(at), BATCH // 20 + 1):
            now = slice(lo, lo + BATCH // 20 + 1)
            yield table("_ref _key _pos", (refs[now], pa.int64()), (keys_of(data, at[now], ends[text[now]]), pa.int64()), (places[now], pa.int32()))


def valid(batch: pa.RecordBatch, length: int, size: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Of anchors, without positions of another text of the same name: (ref, position, key, hash of the context, bytes
    of it before the anchor, its bytes). A context is the reach of strings that have this anchor. So many at a time that
    those of `size` bytes each are BATCH bytes."""
    column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
    data, ends = joined(column["_text"])
    starts, refs = starts_of(ends), column["_ref"].to_numpy()
    text = np.repeat(np.arange(len(ends)), column["_at"].value_lengths().to_numpy(zero_copy_only=False))
    places, keys = (column[c].flatten().to_numpy(zero_copy_only=False) for c in ("_at", "_keys"))
    each = BATCH // size + 1
    for lo in range(0, len(text), each):
        of, pos, key = text[lo : lo + each], places[lo : lo + each].astype(np.int64), keys[lo : lo + each]
        fit = (pos >= 0) & (keys_of(data, starts[of] + pos, ends[of]) == key)
        of, pos, key = of[fit], pos[fit], key[fit]
        left = np.minimum(pos, length - KEY)
        first, end = starts[of] + pos - left, np.minimum(starts[of] + pos + length, ends[of])
        own = [data[a:b] for a, b in zip(first.tolist(), end.tolist(), strict=True)]
        whole = np.array([xxhash.xxh3_64_intdigest(x, n) for x, n in zip(own, left.tolist(), strict=True)], np.uint64).view(np.int64)
        yield refs[of], pos, key, whole, left, own


def in_context(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in parts(batches):
        for _, _, key, whole, left, own in valid(batch, length, 2 * length - KEY + 28):
            if not len(key):
                continue
            # Equal contexts are one row with a count.
            order = np.lexsort((whole, key))
            new = np.flatnonzero(np.concatenate([[True], (np.diff(key[order]) != 0) | (np.diff(whole[order]) != 0)]))
            n, one = np.diff(np.append(new, len(order))), order[new]
            kinds = ((key[one], pa.int64()), (whole[one], pa.int64()), (left[one], pa.int32()), ([bytes(own[i]) for i in one.tolist()], pa.binary()), (n, pa.int64()))
            yield table("_key _whole _left _bytes _n", *kinds)


def places_of(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in parts(batches):
        for ref, pos, key, whole, _, _ in valid(batch, length, 24):
            yield table("_ref _pos _key _whole", (ref, pa.int64()), (pos, pa.int32()), (key, pa.int64()), (whole, pa.int64()))


def in_ranges(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Each context once for each range of distances, with a hash of the bytes that all strings of the range share."""
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32())
    bounds = np.linspace(0, length - KEY + 1, RANGES + 1).astype(int).tolist()
    for batch in parts(batches):
        out = []
        for key, whole, n, left, data in zip(*(batch.column(c).to_pylist() for c in ("_key", "_whole", "_n", "_left", "_bytes")), strict=True):
            for a, b in zip(bounds[:-1], [x - 1 for x in bounds[1:]], strict=True):
                if left >= a and len(data) - left >= length - b:
                    out.append((key, xxhash.xxh3_64_intdigest(data[left - a : left + length - b], seed=a) - (1 << 63), whole, n, left, data, a, b))
        if out:
            yield table("_key _part _whole _n _left _bytes _a _b", *zip(zip(*out, strict=True), kinds, strict=True))


def repeated(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows come by key and part; of each context, the maximal runs of bytes covered by repeated strings, relative to its anchor."""
    held: list[tuple] = []
    at: tuple | None = None
    for batch in batches:
        out: list[tuple[int, int, int, int]] = []
        key, part, a, b, whole, n, left, data = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).tolist() for c in ("_key", "_part", "_a", "_b", "_whole", "_n", "_left", "_bytes"))
        for i, k in enumerate(key):
            if at is None or at[0] != k or at[1] != part[i]:
                if at is not None:
                    out += runs_of(held, length, *at[2:])
                held, at = [], (k, part[i], a[i], b[i])
            held.append((k, whole[i], n[i], left[i], data[i]))
        yield as_runs(out)
    if at is not None:
        yield as_runs(list(runs_of(held, length, *at[2:])))


def as_runs(out: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    return table("_key _whole _lo _hi", *(([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32()))))


def runs_of(group: list[tuple], length: int, a: int, b: int) -> Iterator[tuple[int, int, int, int]]:
    """A string that starts o bytes before the anchor is repeated if another context agrees o bytes to the left and
    length-o to the right; o is from a to b."""
    if len(group) == 1:
        key, whole, n, left, data = group[0]
        if n > 1 and len(data) >= length:
            yield key, whole, -left, len(data) - left
        return
    if len(group) == 2 and group[0][2] == group[1][2] == 1 and b - a == length - KEY:
        yield from runs_of_two(group, length)
        return
    reach = length - KEY
    lefts = np.array([g[3] for g in group])
    rights = np.array([len(g[4]) - g[3] for g in group])
    after, before = in_rows([g[4][g[3] :] for g in group], length), in_rows([g[4][: g[3]][::-1] for g in group], reach)
    order_a, order_b = deep_shallow(after, rights), deep_shallow(before, lefts)
    lcp_a, lcp_b = common_prefixes(after, rights, order_a), common_prefixes(before, lefts, order_b)
    many = np.array([g[2] > 1 for g in group])
    # The longest agreement with any other context is that with a neighbour; without `length` in sum there is no partner.
    most = neighbours(order_a, lcp_a) + neighbours(order_b, lcp_b)
    for i in np.flatnonzero(many & (lefts + rights >= length)).tolist():
        yield group[i][0], group[i][1], -int(lefts[i]), int(rights[i])
    alive = most >= length
    if not (alive & ~many).any():
        return
    order_a, lcp_a = among(order_a, lcp_a, alive)
    order_b, lcp_b = among(order_b, lcp_b, alive)
    which = np.flatnonzero(alive)
    lefts, rights, many = lefts[which], rights[which], many[which]
    dup = np.zeros((len(which), reach + 1), bool)
    if len(which) <= PAIRS:
        r, le = pairwise(order_a, lcp_a), pairwise(order_b, lcp_b)
        first, second = np.nonzero(r + le >= length)
        # Of each pair, distances from length-r to l: one more begins, one fewer after the last.
        wide, size = reach + 2, len(which) * (reach + 2)
        begun = np.bincount(first * wide + length - r[first, second], minlength=size)
        over = np.bincount(first * wide + le[first, second] + 1, minlength=size)
        dup = np.cumsum((begun - over).reshape(-1, wide), axis=1)[:, :-1] > 0
        dup[:, :a] = dup[:, b + 1 :] = False
    else:
        class_a, class_b = np.zeros(len(which), np.int64), np.zeros(len(which), np.int64)
        for o in range(max(a, length - int(lcp_a.max())), min(b, int(lcp_b.max())) + 1):
            class_a[order_a[1:]] = np.cumsum(lcp_a < length - o)
            class_b[order_b[1:]] = np.cumsum(lcp_b < o)
            class_a[order_a[0]] = class_b[order_b[0]] = 0
            fits = np.flatnonzero((lefts >= o) & (rights >= length - o))
            _, back, count = np.unique((class_a * len(which) + class_b)[fits], return_inverse=True, return_counts=True)
            dup[fits, o] = count[back] > 1
    dup[many] = False
    padded = np.zeros((len(which), reach + 3), np.int8)
    padded[:, 1:-1] = dup
    row, edge = np.nonzero(np.diff(padded, axis=1))
    for i, first, end in zip(which[row[::2]].tolist(), edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        # Starts from end-1 to first bytes before the anchor.
        yield group[i][0], group[i][1], -(end - 1), length - first


def in_rows(texts: list[bytes], width: int) -> np.ndarray:
    """Each text as a row, zero beyond its length."""
    return np.frombuffer(b"".join([t.ljust(width, b"\0") for t in texts]), np.uint8).reshape(len(texts), width)


def neighbours(order: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """The longest agreement of each row with any other."""
    out = np.zeros(len(order), np.int64)
    out[order[1:]] = lcp
    out[order[:-1]] = np.maximum(out[order[:-1]], lcp)
    return out


def among(order: np.ndarray, lcp: np.ndarray, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the rows that are alive, renumbered, and their common prefixes: the least over those between."""
    at = np.flatnonzero(alive[order])
    number = np.cumsum(alive) - 1
    return number[order[at]], np.minimum.reduceat(lcp[: at[-1]], at[:-1])


def pairwise(order: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """The common prefix of every two of few rows: the least over those between them in order."""
    n = len(order)
    out = np.zeros((n, n), np.int64)
    for i in range(n - 1):
        reach = np.minimum.accumulate(lcp[i:])
        out[order[i], order[i + 1 :]] = reach
        out[order[i + 1 :], order[i]] = reach
    return out


def runs_of_two(group: list[tuple], length: int) -> Iterator[tuple[int, int, int, int]]:
    (_, _, _, l1, d1), (_, _, _, l2, d2) = group
    r = agreement(d1[l1:], d2[l2:])
    left = agreement(d1[:l1][::-1], d2[:l2][::-1])
    if left + r >= length:
        for g in group:
            yield g[0], g[1], -left, r


def counted_runs(split: DataFrame, length: int) -> DataFrame:
    """The runs of parts of keys that still have too many contexts for one task: their strings are counted by hash."""

    def windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        for batch in parts(batches):
            out = []
            for key, whole, n, left, data, a, b in zip(*(batch.column(c).to_pylist() for c in ("_key", "_whole", "_n", "_left", "_bytes", "_a", "_b")), strict=True):
                out += [(key, whole, n, o, xxhash.xxh3_128_digest(data[left - o : left - o + length])) for o in range(max(a, length - len(data) + left), min(b, left) + 1)]
            if out:
                yield table("_key _whole _n _o _w", *zip(zip(*out, strict=True), kinds, strict=True))

    each = split.mapInArrow(windows, "_key long, _whole long, _n long, _o int, _w binary")
    # A string may be within reach of several anchors, so it is counted for each key and distance by itself.
    same_place = ["_key", "_o", "_w"]
    twice = each.groupBy(*same_place).agg(F.sum("_n").alias("_s")).where(F.col("_s") > 1).select(*same_place)
    return each.join(twice, same_place).select("_key", "_whole", (-F.col("_o")).alias("_lo"), (F.lit(length) - F.col("_o")).alias("_hi"))


def cut_out(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in parts(batches):
        column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        data, ends = joined(column["_text"])
        starts = starts_of(ends)
        runs = [(i, *run[:2]) for i, of in long_runs_of(data, ends, length).items() for run in of]
        spans = column["_spans"].flatten()
        text = np.repeat(np.arange(len(ends)), column["_spans"].value_lengths().to_numpy(zero_copy_only=False))
        more, los, his = (np.array([run[i] for run in runs], np.int64) for i in range(3))
        text = np.concatenate([text, more])
        lo, hi = (np.concatenate([spans.field(c).to_numpy(zero_copy_only=False), x]) for c, x in (("lo", los), ("hi", his)))
        lo, hi = np.minimum((lo, hi), (ends - starts)[text])
        # In one line, with a gap after each text, spans that overlap or touch become one.
        shift = starts[text] + text
        order = np.argsort(lo + shift, kind="stable")
        text, lo, hi = text[order], (lo + shift)[order], np.maximum.accumulate((hi + shift)[order])
        first = np.flatnonzero(np.concatenate([np.ones(min(1, len(lo)), bool), lo[1:] > hi[:-1]]))
        last = np.append(first[1:], len(lo)) - 1
        text, lo, hi = text[first], lo[first] - text[first], hi[last[: len(first)]] - text[first]
        n = np.bincount(text, minlength=len(ends))
        removed = np.bincount(text, hi - lo, minlength=len(ends)).astype(np.int64)
        at, shas = 0, []
        los, his = lo.tolist(), hi.tolist()
        for here, end, k in zip(starts.tolist(), ends.tolist(), n.tolist(), strict=True):
            kept = hashlib.sha256()
            for i in range(at, at + k):
                kept.update(data[here : los[i]])
                here = his[i]
            kept.update(data[here:end])
            shas.append(kept.hexdigest())
            at += k
        columns = ((column["_ref"], pa.int64()), (ends - starts, pa.int64()), (removed, pa.int64()), (n, pa.int64()), (shas, pa.string()))
        yield table("_ref _size _removed _n_spans _sha", *columns)
