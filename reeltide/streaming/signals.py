"""Signals as a stream: counts in event-time windows, and silences paired as their marks arrive."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def read_events(spark: SparkSession, folder: str, files_per_trigger: int = 1) -> DataFrame:
    """Events as files land in a folder."""
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_trigger).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def window_counts(events: DataFrame, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events by type and window; windows close when the watermark passes them."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


#: How long a start waits for its end, in milliseconds of event time.
WAITS_MS = 24 * 3600 * 1000


def _pair(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """An end closes the latest start since the end before it. Marks wait in the state until the watermark passes them, and so are taken in order across micro-batches."""
    open_, times, starts = state.get if state.exists else (None, [], [])
    waiting = list(zip(times, starts, strict=True)) + [(int(t), bool(s)) for b in batches for t, s in zip(b["us"], b["is_start"], strict=True)]
    passed = state.getCurrentWatermarkMs()
    out = []
    for t, is_start in sorted(m for m in waiting if m[0] < passed * 1000):
        if is_start:
            open_ = t
        elif open_ is not None:
            out.append((key[0], open_, t))
            open_ = None
    waiting = sorted(m for m in waiting if m[0] >= passed * 1000)
    if open_ is not None and open_ < (passed - WAITS_MS) * 1000:
        open_ = None
    if waiting or open_ is not None:
        state.update((open_, [t for t, _ in waiting], [s for _, s in waiting]))
        state.setTimeoutTimestamp(max(passed + 1, waiting[0][0] // 1000 + 1 if waiting else open_ // 1000 + WAITS_MS + 1))
    elif state.exists:
        state.remove()
    yield pd.DataFrame(out, columns=["user_id", "start_us", "end_us"])


def paired_silences(events: DataFrame, late: str = "10 minutes") -> DataFrame:
    """(user_id, start_us, end_us) from clicks (starts) and purchases (ends), in order of event time; marks later than the watermark are dropped, and a start waits a day for its end."""
    marks = events.withWatermark("ts", late).where("event_type in ('click', 'purchase')").select("user_id", "ts", F.unix_micros("ts").alias("us"), (F.col("event_type") == "click").alias("is_start"))
    return marks.groupBy("user_id").applyInPandasWithState(_pair, "user_id long, start_us long, end_us long", "open_us long, times array<long>, starts array<boolean>", "append", GroupStateTimeout.EventTimeTimeout)
