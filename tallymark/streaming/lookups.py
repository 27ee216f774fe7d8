"""Lookups that expire: a stream of questions and answers gives the requests that are due."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

REQUESTS = T.StructType([T.StructField("key", T.StringType()), T.StructField("due_ms", T.LongType())])
_STATE = T.StructType([T.StructField("answered_ms", T.LongType())])


def due_requests(events: DataFrame, ttl_ms: int, late: str = "0 seconds") -> DataFrame:
    """``key`` and ``due_ms`` of every lookup that has to be made again, as the stream goes on.

    ``events`` has ``key``, ``at`` (timestamp) and ``answered`` (boolean; false for a
    question). A key with an answer is at rest for ``ttl_ms`` from the newest one. Then a
    timer makes it a request and the key is forgotten, so the state holds valid answers
    only. A question about a key without a valid answer is a request at once. Time is the
    events' own; ``late`` is how long older events are waited for.
    """

    def handle(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            (answered,) = state.get
            state.remove()
            yield pd.DataFrame({"key": [key[0]], "due_ms": [answered + ttl_ms]})
            return
        answered, asked = (state.get[0] if state.exists else None), None
        for frame in frames:
            for time, kind in zip(frame["at_ms"].tolist(), frame["answered"].tolist(), strict=True):
                if kind:
                    answered = time if answered is None else max(answered, time)
                else:
                    asked = time if asked is None else max(asked, time)
        if answered is None:
            if asked is not None:
                yield pd.DataFrame({"key": [key[0]], "due_ms": [asked]})
        elif answered + ttl_ms <= state.getCurrentWatermarkMs():
            if state.exists:
                state.remove()
            yield pd.DataFrame({"key": [key[0]], "due_ms": [answered + ttl_ms]})
        else:
            state.update((answered,))
            state.setTimeoutTimestamp(answered + ttl_ms)

    rows = events.select(F.col("key").cast("string").alias("key"), "at", F.coalesce("answered", F.lit(False)).alias("answered"))
    rows = rows.withWatermark("at", late).withColumn("at_ms", F.unix_millis("at"))
    return rows.groupBy("key").applyInPandasWithState(handle, REQUESTS, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def run_lookups(events: DataFrame, ttl_ms: int, target: str, checkpoint: str, late: str = "0 seconds") -> None:
    """Process everything that has arrived and stop; the requests are added to ``target``."""
    (
        due_requests(events, ttl_ms, late)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
