"""Streaming twins of batch steps (an extension)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quizloom.sources.files import append_new
from quizloom.sources.ledger import Ledger


def daily_counts(events: DataFrame, late: str = "1 day") -> DataFrame:
    """day, event_type, n, value; works on a stream, with a watermark, as on a table."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if events.isStreaming:
        e = e.withWatermark("ts", late)
    out = e.groupBy(F.window("ts", "1 day"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("value"))
    return out.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n", "value")


def append_stream(spark: SparkSession, folder: str, schema: T.StructType, out: str, checkpoint: str) -> StreamingQuery:
    """New record files of a folder, appended without overwriting ids that are there."""
    stream = spark.readStream.schema(schema).json(folder)
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, _: append_new(df, out, ["id"], schema) and None).trigger(availableNow=True).start()


def append_ledger_stream(spark: SparkSession, folder: str, schema: T.StructType, store: Ledger, checkpoint: str, order: list[str], ident: str = "id", files: int = 1000) -> StreamingQuery:
    """New record files of a folder added to a ledger, each batch under the stream's number for it: a batch that runs again after a loss is not added twice."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).json(folder)
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, n: store.append(df, ident, order, f"stream-{n:09d}") and None).trigger(availableNow=True).start()


def first_wins_stream(stream: DataFrame, by: str, order: list[str], time: str, late: str = "1 hour", keep_ms: int = 86_400_000) -> DataFrame:
    """The first row of each key as a stream: of the batch in which a key is first seen, the least row in the order given.

    The state is one flag a key, and no output is read again. A key is forgotten keep_ms after its latest time
    (column `time`, a timestamp) is passed by the watermark, so state is bounded by the keys of that span; a key that comes back
    later is first again. Rows with a null key or time, and rows later than the watermark, go. Of rows of one key
    a batch holds one at a time in memory; equal rows are one.
    """
    schema = stream.schema

    def one(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        best, latest = None, state.get[0] if state.exists else 0
        for f in frames:
            latest = max(latest, int(f[time].max().timestamp() * 1000))
            if not state.exists:
                f = f if best is None else pd.concat([best, f])
                best = f.sort_values(order, na_position="first", kind="stable").head(1)
        state.update((latest,))
        state.setTimeoutTimestamp(max(latest + keep_ms, state.getCurrentWatermarkMs() + 1))
        if best is not None:
            yield best

    rows = stream.where(F.col(by).isNotNull() & F.col(time).isNotNull()).withWatermark(time, late)
    return rows.groupBy(by).applyInPandasWithState(one, schema, "latest long", "append", GroupStateTimeout.EventTimeTimeout)
