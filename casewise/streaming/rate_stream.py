"""Positive rate of ``pred = value >= 50`` per hour over ``events``, as a stream with event-time state.

``withWatermark`` and a window aggregation keep running totals in the state store; a window leaves
the state once the watermark (the newest event less ten minutes) has passed its end, so the state
holds the open windows only.  Every trigger writes the windows that changed, with their totals so
far, to a folder of its epoch (overwritten on a retry); the last epoch of a window holds.

Rows older than the watermark cannot reach the state.  The query's progress tells that there were
some; then, and only then, a batch job takes the totals from the landing folder, and ``late_events``
is what it found beyond the stream's own totals.  So no event is lost however late it comes.

``batch_positive_rate`` is the batch twin with the same numbers.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

THRESHOLD = 50.0
WINDOW = "1 hour"
WATERMARK = "10 minutes"
TOTALS_SCHEMA = "start timestamp, end timestamp, events long, positives long, epoch long"


def _rate(df: DataFrame, *more) -> DataFrame:
    pred = (F.col("value") >= F.lit(THRESHOLD)).cast("int")
    return df.groupBy(F.window("ts", WINDOW).alias("w")).agg(
        F.count(F.lit(1)).alias("events"), F.sum(pred).alias("positives"), *more)


def batch_positive_rate(events: DataFrame) -> DataFrame:
    out = _rate(events)
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "events", "positives", (F.col("positives") / F.col("events")).alias("positive_rate"))


class LateRows(StreamingQueryListener):
    """Adds up what the watermark kept out of the state, trigger by trigger, of one query."""

    def __init__(self, name: str):
        self.name, self.dropped = name, 0
        self.ended = threading.Event()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        if event.progress.name == self.name:
            self.dropped += sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended.set()


def run_rate_stream(spark: SparkSession, source_dir: str, schema, out_dir: str, checkpoint: str,
                    files_per_trigger: int | None = None) -> DataFrame:
    """Drain ``source_dir`` and return (window_start, window_end, events, positives, late_events, positive_rate)."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # The tables hold wall-clock TIMESTAMP_NTZ: shift so that the instant equals the
    # wall clock read as UTC (hour windows then align with wall-clock hours in any
    # session zone) and shift back on output.
    tz = spark.conf.get("spark.sql.session.timeZone")

    def instants(df: DataFrame) -> DataFrame:
        return df.withColumn("ts", F.from_utc_timestamp(F.col("ts").cast("timestamp"), tz))
    totals = _rate(instants(reader.parquet(source_dir)).withWatermark("ts", WATERMARK))
    totals = totals.select("w.start", "w.end", "events", "positives")
    # the folder exists before the first epoch, so that reading it needs no special case
    spark.createDataFrame([], TOTALS_SCHEMA).write.mode("append").partitionBy("epoch").parquet(out_dir)

    def sink(batch_df, epoch_id):
        batch_df.write.mode("overwrite").parquet(f"{out_dir}/epoch={epoch_id}")  # idempotent on retry

    name = f"rate-{uuid.uuid4().hex}"
    late = LateRows(name)
    spark.streams.addListener(late)
    try:
        q = totals.writeStream.queryName(name).outputMode("update").foreachBatch(sink) \
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()  # an availableNow query ends when its input is drained, and raises if it failed
        late.ended.wait(30)  # listeners are told a little later
        # told by the last triggers too, should the listener have missed them
        told = sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"])
    finally:
        spark.streams.removeListener(late)
    written = spark.read.schema(TOTALS_SCHEMA).option("basePath", out_dir).parquet(out_dir)
    last = written.groupBy("start", "end").agg(F.max_by(F.struct("events", "positives"), "epoch").alias("t"))
    out = last.select("start", "end", "t.events", "t.positives", F.lit(0).cast("long").alias("late_events"))
    if late.dropped or told:
        whole = _rate(instants(spark.read.schema(schema).parquet(source_dir))).select("w.start", "w.end", "events", "positives")
        seen = last.select(F.col("start"), F.col("t.events").alias("seen"))
        out = whole.join(seen, "start", "left").select("start", "end", "events", "positives",
                                                       (F.col("events") - F.coalesce("seen", F.lit(0))).alias("late_events"))
    return out.select(F.to_utc_timestamp("start", tz).cast("timestamp_ntz").alias("window_start"),
                      F.to_utc_timestamp("end", tz).cast("timestamp_ntz").alias("window_end"),
                      "events", "positives", "late_events",
                      (F.col("positives") / F.col("events")).alias("positive_rate"))
