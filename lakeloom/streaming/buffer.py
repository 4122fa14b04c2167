"""Partition buffers: records wait in their partition until there are enough of them, or they waited long enough.

flushes() says for records at rest to which flush each belongs; buffered() does it on a stream, with the waiting rows
in Spark's state. Both flush a partition at `most` rows, or at `least` rows once they have `size` bytes.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


@dataclass(frozen=True)
class Limits:
    most: int = 50_000
    least: int = 1_000
    size: int = 64 << 20
    seconds: int = 30

    def reached(self, rows: int, size: int) -> bool:
        return rows >= self.most or rows >= self.least and size >= self.size


def flushes(records: DataFrame, key: Sequence[str], order: str, size: str, limits: Limits) -> DataFrame:
    """records with `flush` (from 0 in each key) and `flushed`: whether the flush was reached; the rest is still waiting.
    Rows stream through their partition in order; nothing but two numbers is held for a key."""
    cols = [*key, order, size]
    rows = records.repartition(*key).sortWithinPartitions(*key, order)
    schema = T.StructType([*records.schema.fields, T.StructField("flush", T.LongType()), T.StructField("reached", T.BooleanType())])

    def numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, n, rows_, bytes_ = None, 0, 0, 0
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in cols]
            flush, reached = [], []
            for *own, _, b in zip(*columns, strict=True):
                if own != at:
                    at, n, rows_, bytes_ = own, 0, 0, 0
                rows_, bytes_ = rows_ + 1, bytes_ + (b or 0)
                flush.append(n)
                reached.append(limits.reached(rows_, bytes_))
                if reached[-1]:
                    n, rows_, bytes_ = n + 1, 0, 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(flush, pa.int64()), pa.array(reached, pa.bool_())], schema.fieldNames())

    told = rows.mapInArrow(numbered, schema)
    last = told.groupBy(*key).agg(F.max(F.when(F.col("reached"), F.col("flush"))).alias("_last"))
    return told.join(last, list(key)).withColumn("flushed", F.coalesce(F.col("flush") <= F.col("_last"), F.lit(False))).select(*records.columns, "flush", "flushed")


def waiting(told: DataFrame, key: Sequence[str], size: str, at: str, scope: str) -> DataFrame:
    """The buffers that are left: key, n_rows, n_bytes, created (the first row's time), scopes."""
    left = told.where(~F.col("flushed"))
    return left.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(size).alias("n_bytes"), F.min(at).alias("created"), F.sort_array(F.collect_set(scope)).alias("scopes"))


def expired(buffers: DataFrame, now: Column, limits: Limits) -> DataFrame:
    """Buffers whose first row waited long enough, however few rows they have."""
    return buffers.where(F.unix_micros(now) - F.unix_micros("created") >= limits.seconds * 1_000_000)


def holding(buffers: DataFrame, scope: str) -> DataFrame:
    """Whole buffers with a row of the scope, rows of other scopes included."""
    return buffers.where(F.array_contains("scopes", scope))


def scope_done(crawled: Column, pending_batches: Column, buffered_rows: Column) -> Column:
    """Whether a scope's checkpoint may be saved: its crawl ended and nothing of it is on its way."""
    return F.coalesce(crawled & (pending_batches == 0) & (buffered_rows == 0), F.lit(False))


def buffered(stream: DataFrame, key: Sequence[str], size: str, limits: Limits, final: bool = False) -> DataFrame:
    """The rows of a stream as they are flushed, with `flush` and `reason` (size, age or end). final: what is left of a
    micro-batch is flushed at its end, as at a shutdown."""
    out = T.StructType([*stream.schema.fields, T.StructField("flush", T.LongType()), T.StructField("reason", T.StringType())])
    cut = out.fieldNames()

    def step(_key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, n, created = (pickle.loads(state.get[0]), *state.get[1:]) if state.exists else ([], 0, 0)
        if not final and state.hasTimedOut:
            yield pd.DataFrame([(*r, n, "age") for r in held], columns=cut)
            state.update((pickle.dumps([]), n + 1, 0))
            return
        now, size_ = 0 if final else state.getCurrentProcessingTimeMs(), sum(r[at] or 0 for r in held)
        for frame in frames:
            done = []
            for row in frame.itertuples(index=False, name=None):
                created = created if held else now
                held.append(row)
                size_ += row[at] or 0
                if limits.reached(len(held), size_):
                    done += [(*r, n, "size") for r in held]
                    held, size_, n = [], 0, n + 1
            if done:
                yield pd.DataFrame(done, columns=cut)
        if final and held:
            yield pd.DataFrame([(*r, n, "end") for r in held], columns=cut)
            held, n = [], n + 1
        state.update((pickle.dumps(held), n, created))
        if held and not final:
            # The age counts from the first row, not from the last.
            state.setTimeoutDuration(max(1, created + limits.seconds * 1000 - now))

    # With timeouts Spark goes on making batches, so a stream that is to end has none.
    timeout = GroupStateTimeout.NoTimeout if final else GroupStateTimeout.ProcessingTimeTimeout
    at = stream.columns.index(size)
    return stream.groupBy(*key).applyInPandasWithState(step, out, "held binary, n long, created long", "append", timeout)
