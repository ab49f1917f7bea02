"""Streaming forms of the append-only logs: accumulated queue patches and latest states."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATE = "last_at timestamp, status string"


def queue_counts(patches: DataFrame, key: str, at: str, late: str = "1 hour") -> DataFrame:
    """key, day, mentions: patches counted by key and day; later than `late`, they are dropped and the state
    of a finished day is released. Works on a stream and on a table alike."""
    stamped = patches.withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", late)
    counted = stamped.groupBy(key, F.window("_at", "1 day").alias("_w")).agg(F.count(F.lit(1)).alias("mentions"))
    return counted.select(key, F.col("_w.start").alias("day"), "mentions")


def latest_states(events: DataFrame, key: str, at: str, status: str) -> DataFrame:
    """key, last_at, status after every batch of events, out-of-order events ignored.

    A key's state is two values, however many events it has.
    """

    def fold(k: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last, value = state.get if state.exists else (pd.Timestamp.min, "")
        for b in batches:
            newest = b.sort_values([at, status]).iloc[-1]
            if newest[at] >= last:
                last, value = newest[at].to_pydatetime(), newest[status]
        state.update((last, value))
        yield pd.DataFrame({key: [k[0]], "last_at": [last], "status": [value]})

    kind = events.schema[key].dataType.simpleString()
    return events.groupBy(key).applyInPandasWithState(fold, f"{key} {kind}, {STATE}", STATE, "update", "NoTimeout")
