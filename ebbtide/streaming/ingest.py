"""Streaming ingest, deduplication, upsert and health."""

from __future__ import annotations

import datetime as dt
import threading
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..constants import LOOKBACK_HOURS
from ..operators.ingest import DROPPED, FAILED, OK, accepted, rejected, route_events
from ..sinks.tables import VersionedTable
from ..sinks.writers import write_quarantine, write_raw
from ..sources.paths import exists

TRIGGER = "5 minutes"


def _triggered(writer, available_now: bool):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=TRIGGER)


def observed(routed: DataFrame, name: str = "outcomes") -> DataFrame:
    """Attach the counts of taken, dropped and failed records to each batch."""
    of = F.col("result")
    return routed.observe(
        name, F.count_if(of == OK).alias("ok"), F.count_if(of == DROPPED).alias("dropped"), F.count_if(of == FAILED).alias("failed")
    )


class OutcomeListener(StreamingQueryListener):
    """Sums the observed counts of one query's finished batches, however many there are."""

    def __init__(self, name: str = "outcomes"):
        self.name, self.totals, self.query, self.ended = name, Counter(), None, threading.Event()

    def watch(self, query: StreamingQuery) -> None:
        self.query = str(query.id)

    def wait(self, seconds: float = 60) -> dict[str, int]:
        """The totals once the query has ended; its events arrive in order, the end last."""
        if not self.ended.wait(seconds):
            raise TimeoutError("the end of the query was not reported")
        return dict(self.totals)

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        row = (event.progress.observedMetrics or {}).get(self.name)
        if row is not None and self.query in (None, str(event.progress.id)):
            self.totals.update({name: count or 0 for name, count in row.asDict().items()})

    def onQueryTerminated(self, event):
        if self.query in (None, str(event.id)):
            self.ended.set()


def batch_moment(spark: SparkSession, folder: str, batch_id: int, clock: Callable[[], dt.datetime]) -> dt.datetime:
    """The moment of a batch, fixed by its first attempt: a repeated batch finds it again and writes the same rows."""
    path = f"{folder}/batch={batch_id}"
    if not exists(spark, f"{path}/_SUCCESS"):
        spark.createDataFrame([(clock(),)], "moment timestamp").coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.schema("moment timestamp").parquet(path).first()["moment"]


def now_utc() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def write_batch(lines: DataFrame, batch_id: int, raw_path: str, quarantine_path: str, now: Column) -> None:
    """Route a batch of text lines, once for both sinks, into partitions named after it; a repeated attempt replaces them."""
    routed = route_events(lines).persist()
    try:
        write_raw(accepted(routed, now), raw_path, f"b{batch_id}")
        write_quarantine(rejected(routed, now), quarantine_path, f"b{batch_id}")
    finally:
        routed.unpersist()


def start_ingest(
    lines: DataFrame, raw_path: str, quarantine_path: str, checkpoint: str, available_now: bool = False,
    clock: Callable[[], dt.datetime] = now_utc,
) -> StreamingQuery:
    """Route a stream of text lines into the raw table and the quarantine.

    Both sinks get a partition named after the batch, which a repeated attempt of the batch
    replaces, and the moment of a batch is kept beside the checkpoint: a batch is written once
    whatever fails in between, over midnight too.
    """
    spark = lines.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        now = F.lit(batch_moment(spark, f"{checkpoint}-moments", batch_id, clock)).cast("timestamp")
        write_batch(batch, batch_id, raw_path, quarantine_path, now)

    writer = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, available_now).start()


def deduplicated_stream(events: DataFrame, time: str = "event_timestamp", hours: int = LOOKBACK_HOURS) -> DataFrame:
    """First delivery of each event id; ids are forgotten once the watermark has passed them."""
    return events.withWatermark(time, f"{hours} hours").dropDuplicatesWithinWatermark(["event_id"])


def with_lateness(events: DataFrame, newest: Column, time: str = "event_timestamp", hours: int = LOOKBACK_HOURS) -> DataFrame:
    """Mark rows older than the overlap; they are left to the batch merge instead of the stream state."""
    return events.withColumn("late", F.col(time) < newest - F.make_dt_interval(hours=F.lit(hours)))


def start_upsert(
    events: DataFrame, table: VersionedTable, name: str, checkpoint: str, at: dt.datetime | None = None, available_now: bool = False
) -> StreamingQuery:
    """Merge each batch of curated events into the table; a batch that was committed before is skipped.

    An event keeps its time, so only the days of the batch are read and rewritten; an event that
    does move is put right by the batch merge, which searches the whole table.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch, "event_id", "_etl_timestamp", at or now_utc(), f"{name}-{batch_id}", keys_may_move=False)

    writer = events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return _triggered(writer, available_now).start()


def arrival_counts(events: DataFrame, time: str = "event_timestamp", minutes: int = 15, hours: int = LOOKBACK_HOURS) -> DataFrame:
    """Records per tumbling window; a window is final when the watermark has passed it."""
    return events.withWatermark(time, f"{hours} hours").groupBy(F.window(time, f"{minutes} minutes").alias("w")).agg(
        F.count(F.lit(1)).alias("records")
    ).select(F.col("w.start").alias("window_start"), "records")


def sliding_counts(log: DataFrame, time: str = "ts", window: str = "5 minutes", step: str = "30 seconds", delay: str = "10 minutes") -> DataFrame:
    """Requests and errors per environment in sliding windows."""
    return log.withWatermark(time, delay).groupBy("env", F.window(time, window, step).alias("w")).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(F.col("status_code") >= 500).alias("errors")
    ).select("env", F.col("w.end").alias("ts"), "requests", "errors")


def start_append(df: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append a stream to Parquet files, each batch exactly once."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return _triggered(writer, available_now).start()
