"""Streams whose operators keep state and timers of their own: silence of any source, late rows aside, alerts.

State per key is small and bounded in time; it lives in the RocksDB store, so that it need not fit into memory. Inside the
operators a moment is a number of microseconds, which no time zone touches.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..constants import LOOKBACK_HOURS

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_state_store(spark: SparkSession) -> None:
    """Operators with timers need a store that keeps several states per key."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


def _ms(micros: int) -> int:
    return micros // 1000


class _Silence(StatefulProcessor):
    """Per source the last event time, with a timer that every arrival puts off."""

    def __init__(self, wait_ms: int):
        self.wait_ms = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "seen long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        newest = max((r["_at"] for r in rows if r["_at"] is not None), default=None)
        held = self.last.get()[0] if self.last.exists() else None
        known = [m for m in (newest, held) if m is not None]
        self.last.update((max(known) if known else None,))
        for expiry in list(self.handle.listTimers()):
            self.handle.deleteTimer(expiry)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait_ms)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # Nothing is kept of a source that fell silent: its next event starts anew.
        seen = self.last.get()[0] if self.last.exists() else None
        self.last.clear()
        yield Row(source=key[0], last_seen=seen, noticed=expiredTimerInfo.getExpiryTimeInMs() * 1000)

    def close(self) -> None:
        pass


def silent_by_timer(events: DataFrame, source: str, time: str = "event_timestamp", seconds: float = 900) -> DataFrame:
    """One row per source and silence: source, its last event time, and the moment at which it had been quiet for `seconds`.

    The clock is that of the stream, not that of the events, so that a silence is noticed when nothing arrives at all. A
    source that comes back is watched again. The state is one moment per source that is not silent.
    """
    with_state_store(events.sparkSession)
    rows = events.select(F.col(source).cast("string").alias("source"), F.unix_micros(time).alias("_at"))
    found = rows.groupBy("source").transformWithState(
        statefulProcessor=_Silence(int(seconds * 1000)), outputStructType="source string, last_seen long, noticed long", outputMode="Append", timeMode="ProcessingTime",
    )
    return found.select("source", F.timestamp_micros("last_seen").alias("last_seen"), F.timestamp_micros("noticed").alias("noticed"))


FIRST, REPEATED, LATE = "first", "repeated", "late"


# Fixed value: groups of ids. The ids of a group are one state, so that a batch costs a few calls to the store per group and not
# per id. It may not change under a checkpoint.
BUCKETS = 4096


class _Fates(StatefulProcessor):
    """Whether a delivery is the first of its id, a repetition, or behind the watermark; for the ids of one bucket."""

    def __init__(self, columns: list[str], key: str, kind: T.DataType, keep_ms: int):
        self.columns, self.key, self.kind, self.keep_ms = columns, columns.index(key), kind, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # The ids that were seen, and until when each is remembered.
        fields = [T.StructField("ids", T.ArrayType(self.kind)), T.StructField("until", T.ArrayType(T.LongType()))]
        self.held = handle.getValueState("held", T.StructType(fields))

    def _seen(self) -> dict:
        return dict(zip(*self.held.get())) if self.held.exists() else {}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        watermark, seen, row = timerValues.getCurrentWatermarkInMs(), self._seen(), Row(*self.columns, "fate")
        known, earliest, at_index = len(seen), min(seen.values(), default=None), self.columns.index("_at")
        for r in rows:
            at, name = r[at_index], r[self.key]
            if at is None or _ms(at) < watermark:
                fate = LATE
            elif name in seen:
                fate = REPEATED
            else:
                fate = FIRST
                seen[name] = _ms(at) + self.keep_ms
            yield row(*r[: len(self.columns)], fate)
        if len(seen) > known:
            self.held.update((list(seen), list(seen.values())))
            if earliest is None or min(seen.values()) < earliest:
                self.handle.registerTimer(min(seen.values()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)
        seen = {name: until for name, until in self._seen().items() if until > passed}
        if seen:
            self.held.update((list(seen), list(seen.values())))
            self.handle.registerTimer(min(seen.values()))
        else:
            self.held.clear()
        return iter([])

    def close(self) -> None:
        pass


def with_fate(events: DataFrame, key: str = "event_id", time: str = "event_timestamp", hours: float = LOOKBACK_HOURS) -> DataFrame:
    """Every row of the stream with `fate`: first, repeated, or late.

    Rows behind the watermark, which trails the newest event by `hours`, are not dropped but marked late, as are rows without
    a time; an id is forgotten once the watermark has passed its first delivery by as much again. No row is lost: the three
    fates together are the input. Ids are remembered in BUCKETS groups; a task holds the ids of one group at a time.
    """
    with_state_store(events.sparkSession)
    span = f"{int(hours * 3600)} seconds"
    marked = events.withWatermark(time, span)
    # The time as a number carries no watermark, so that late rows reach the operator.
    copied = marked.select(*[c for c in events.columns if c != time], F.unix_micros(time).alias("_at"))
    schema = T.StructType([*copied.schema.fields, T.StructField("fate", T.StringType())])
    found = copied.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(BUCKETS))).groupBy("_bucket").transformWithState(
        statefulProcessor=_Fates(copied.columns, key, copied.schema[key].dataType, int(hours * 3600_000)), outputStructType=schema,
        outputMode="Append", timeMode="EventTime",
    )
    return found.select(*[F.timestamp_micros("_at").alias(c) if c == time else F.col(c) for c in events.columns], "fate")


def start_with_late_table(events: DataFrame, path: str, late_path: str, checkpoint: str, available_now: bool = False, **options):
    """First deliveries to one table, late rows to another; both by batch, which a repeated attempt replaces."""
    from .ingest import _triggered

    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            for fate, target in ((FIRST, path), (LATE, late_path)):
                rows = held.where(F.col("fate") == fate).drop("fate").withColumn("batch", F.lit(batch_id))
                rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(target)
        finally:
            held.unpersist()

    writer = with_fate(events, **options).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, available_now).start()


INACTIVE, PENDING, FIRING, RESOLVED = "inactive", "pending", "firing", "resolved"


class _Alert(StatefulProcessor):
    """One rule on one series: samples wait until the watermark has passed them, then move the state in order of time."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        sample = "ts long, value double, met boolean, wait_s int, step_s int, severity string"
        self.waiting = handle.getListState("waiting", sample)
        # Since when the condition holds, the last sample, and whether the alert fires.
        self.state = handle.getValueState("state", "since long, last long, firing boolean, step_s int, severity string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = self.state.get()[1] if self.state.exists() else None
        # What is behind the last sample that counted comes too late to count.
        fresh = [(r["ts"], r["value"], bool(r["met"]), r["for_s"], r["step_s"], r["severity"]) for r in rows if r["ts"] is not None and (last is None or r["ts"] > last)]
        if fresh:
            self.waiting.appendList(fresh)
            self.handle.registerTimer(_ms(min(s[0] for s in fresh)))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        upto = timerValues.getCurrentWatermarkInMs()
        since, last, firing, step, severity = self.state.get() if self.state.exists() else (None, None, False, 0, None)
        held = sorted(self.waiting.get(), key=lambda s: s[0]) if self.waiting.exists() else []
        due, later = [s for s in held if _ms(s[0]) <= upto], [tuple(s) for s in held if _ms(s[0]) > upto]
        out = []

        def row(ts, value, met, fires, state):
            out.append(Row(alert=key[0], series=key[1], severity=severity, ts=ts, value=value, met=met, firing=fires, state=state))

        for ts, value, met, wait, step, severity in due:
            if last is not None and ts - last > step * 1_000_000:
                if firing:
                    row(last + step * 1_000_000, None, None, False, RESOLVED)
                since, firing = None, False
            since = None if not met else ts if since is None else since
            fires = met and ts - since >= wait * 1_000_000
            row(ts, value, met, fires, FIRING if fires else PENDING if met else RESOLVED if firing else INACTIVE)
            last, firing = ts, fires
        if firing and upto * 1000 - last > step * 1_000_000:
            # No sample for longer than a step: what fired is over.
            row(last + step * 1_000_000, None, None, False, RESOLVED)
            since, firing = None, False
        if due:
            if later:
                self.waiting.put(later)
            else:
                self.waiting.clear()
        if later:
            self.handle.registerTimer(_ms(later[0][0]))
        if firing:
            self.handle.registerTimer(_ms(last) + step * 1000 + 1)
        self.state.update((since, last, firing, step, severity))
        return iter(out)

    def close(self) -> None:
        pass


def alert_states(metrics: DataFrame, rules: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """A stream of samples (metric, series, ts, value) against rules: a row per rule and sample that the watermark has passed.

    `state` goes from inactive over pending to firing and, when the condition or the samples end, to resolved; met and firing
    are those of `operators.alerts.evaluate_alerts` over the same samples. Samples wait for `delay`; one that comes later
    than that, or again, changes nothing. A silence longer than a step resolves an alert that fires, in a row without
    value and met.
    """
    from ..operators.alerts import rule_met

    with_state_store(metrics.sparkSession)
    judged = metrics.withWatermark("ts", delay).join(F.broadcast(rules), "metric").withColumn("met", F.coalesce(rule_met(), F.lit(False)))
    rows = judged.select("alert", "series", F.unix_micros("ts").alias("ts"), "value", "met", "for_s", "step_s", "severity")
    found = rows.groupBy("alert", "series").transformWithState(
        statefulProcessor=_Alert(),
        outputStructType="alert string, series string, severity string, ts long, value double, met boolean, firing boolean, state string",
        outputMode="Append", timeMode="EventTime",
    )
    return found.withColumn("ts", F.timestamp_micros("ts"))
