"""Deduplication that forgets: first arrivals with the number of their repeats.

The first event of a key opens a window of fixed length.  Events of the key inside
it are repeats; they are counted, not kept.  When the watermark passes the window's
end, a timer releases the key's state and the first event comes out with its count.
State therefore holds one row per key with an open window, however long the stream.

An event that comes late, after a later one of its key, counts in the window that is
open then; one that is older than the watermark is dropped.  Events without a key are
nobody's repeat: each comes out at once, and none of them meet in one task.  Events with
a key but no time are left out.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

from lakemart.streaming.committed import APPEND, CommittedParts

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class ExpiringDedup:
    """Key, event time and the length of a window."""

    key: str
    time: str
    seconds: int
    delay: str = "0 seconds"  # how much later than a younger one an event may come

    def schema(self, events: DataFrame) -> StructType:
        return StructType([events.schema[self.key], StructField("first_at", TimestampType()), StructField("repeats", LongType())])

    def rows(self, events: DataFrame) -> DataFrame:
        """(key, first_at, repeats) of every window that has ended."""
        schema = self.schema(events)
        timed = events.select(self.key, F.col(self.time).alias("first_at")).withWatermark("first_at", self.delay)
        keyed = timed.where(F.col(self.key).isNotNull() & F.col("first_at").isNotNull()).withColumn("at", F.unix_micros("first_at")).groupBy(self.key)
        counted = keyed.applyInPandasWithState(
            _windows(self.key, self.seconds), _ended(schema, self.key), "first long, repeats long", "append", GroupStateTimeout.EventTimeTimeout
        )
        counted = counted.select(self.key, F.timestamp_micros("first").alias("first_at"), "repeats")
        loose = timed.where(F.col(self.key).isNull()).withColumn("repeats", F.lit(0).cast("long"))
        return counted.unionByName(loose)

    def run(self, events: DataFrame, table: CommittedParts, checkpoint: str) -> list[int]:
        """Take everything available, then stop; the keys in state after each micro-batch."""
        schema = self.schema(events)

        def write(batch: DataFrame, number: int) -> None:
            spark = batch.sparkSession
            if not table.committed(spark, number):
                table.write(batch, "rows", number)
                table.commit(spark, number, {"rows": (APPEND, range(table.parts), schema)})

        query = self.rows(events).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
        query.awaitTermination()
        return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]

    def read(self, spark: SparkSession, table: CommittedParts) -> DataFrame:
        return table.read(spark, "rows")


def _ended(schema: StructType, key: str) -> StructType:
    """What a task gives back: whole microseconds, which no time zone changes."""
    return StructType([schema[key], StructField("first", LongType()), StructField("repeats", LongType())])


def _windows(key: str, seconds: int) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """One open window per key: first event, repeats.

    The state comes and goes with the rows of many keys in one Arrow batch; a
    processor that asks for it pays a round trip for each question.
    """
    length = seconds * 1_000_000

    def take(of: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first, repeats = state.get if state.exists else (None, 0)
        ended = []
        if state.hasTimedOut:
            ended.append((first, repeats))
            state.remove()
        else:
            times = np.sort(np.concatenate([part["at"].to_numpy(np.int64) for part in rows]))
            at = 0
            while at < len(times):
                if first is None or times[at] >= first + length:
                    if first is not None:
                        ended.append((first, repeats))
                    first, repeats = int(times[at]), 0
                    at += 1
                inside = int(np.searchsorted(times, first + length, side="left"))
                repeats, at = repeats + max(0, inside - at), max(at, inside)
            state.update((first, repeats))
            state.setTimeoutTimestamp(-(-(first + length) // 1000))
        if ended:
            starts, counts = zip(*ended)
            yield pd.DataFrame({key: [of[0]] * len(ended), "first": starts, "repeats": counts})

    return take
