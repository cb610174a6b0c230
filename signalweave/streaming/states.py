"""Streaming forms: keyed state with baseline, visible-window differences, novelty by key, windowed counts with late data."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from ..operators.series import compare_state

EVENT_OUT = "key string, first_seen timestamp, last_seen timestamp, n long, status string"
WINDOW_OUT = "source string, status string, n_new long"
_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _stateful(stream: DataFrame) -> None:
    """Timers and several states of a key need the RocksDB store; a session that has chosen it, or another one that can, keeps its choice."""
    conf = stream.sparkSession.conf
    if "RocksDB" not in (conf.get("spark.sql.streaming.stateStore.providerClass", "") or ""):
        conf.set("spark.sql.streaming.stateStore.providerClass", _PROVIDER)


def _millis(at: pd.Timestamp) -> int:
    return int(pd.Timestamp(at).tz_localize("UTC").timestamp() * 1000) if pd.Timestamp(at).tzinfo is None else int(pd.Timestamp(at).timestamp() * 1000)


class KeyedEvents(StatefulProcessor):
    """One small value of state for each key, and a timer that ends it."""

    def __init__(self, ttl_days: int):
        self.ttl_days = ttl_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "first_seen timestamp, last_seen timestamp, n long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        known = self.seen.exists()
        first, last, n = self.seen.get() if known else (None, None, 0)
        for f in rows:
            at = f["at"].dropna()
            n += len(f)
            if len(at):
                lo, hi = at.min().to_pydatetime(), at.max().to_pydatetime()
                first = lo if first is None else min(first, lo)
                last = hi if last is None else max(last, hi)
        self.seen.update((first, last, n))
        if self.ttl_days and last is not None:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer(_millis(last) + self.ttl_days * 86_400_000)
        yield pd.DataFrame({"key": [key[0]], "first_seen": [first], "last_seen": [last], "n": [n], "status": ["SEEN" if known else "NEW"]})

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.seen.exists():
            first, last, n = self.seen.get()
            self.seen.clear()
            yield pd.DataFrame({"key": [key[0]], "first_seen": [first], "last_seen": [last], "n": [n], "status": ["EXPIRED"]})

    def close(self) -> None:
        pass


def keyed_events(stream: DataFrame, key: str, at: str, ttl_days: int = 0) -> DataFrame:
    """Per key and micro-batch the state and whether the key is NEW or SEEN. After ``ttl_days`` of event time without the key its state
    ends, with a row EXPIRED, and the key is NEW again (by a watermark of a day on ``at``; 0 keeps it for good). Null keys are one key; a null time
    counts as a row and moves nothing. A query that is started again from its checkpoint goes on with state and timers."""
    _stateful(stream)
    rows = stream.select(F.col(key).cast("string").alias("key"), F.col(at).cast("timestamp").alias("at"))
    if ttl_days:
        rows = rows.withWatermark("at", "1 day")
    return rows.groupBy("key").transformWithStateInPandas(KeyedEvents(ttl_days), EVENT_OUT, "append", "eventTime" if ttl_days else "none")


class WindowChanges(StatefulProcessor):
    """The newest keys of a source as a list, and whether it had a window before."""

    def __init__(self, keep: int):
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.keys = handle.getListState("keys", "k string")
        self.begun = handle.getValueState("begun", "yes boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        now = list(dict.fromkeys(k for f in rows for k in f["k"]))
        old = [r[0] for r in self.keys.get()] if self.begun.exists() else None
        here, before = set(now), set(old or ())
        if old is None:
            status, n = "BASELINE", None
        elif not here & before:
            status, n = "POSSIBLE_GAP", None
        else:
            status, n = ("NEW" if here - before else "NO_NEW"), len(here - before)
        self.keys.put([(k,) for k in [*now, *[k for k in old or [] if k not in here]][: max(self.keep, len(now))]])
        self.begun.update((True,))
        yield pd.DataFrame({"source": [key[0]], "status": [status], "n_new": pd.array([n], dtype="Int64")})

    def close(self) -> None:
        pass


def window_changes(stream: DataFrame, source: str, key: str, keep: int = 200) -> DataFrame:
    """Per source and micro-batch: BASELINE for its first window, POSSIBLE_GAP if no key is known, NEW with the count of unseen keys, NO_NEW else.

    The newest ``keep`` keys of a source are its state, as the batch form keeps them: those of this window first, in the order of
    its rows, then those of windows before it. A window of more than ``keep`` keys is kept whole. Keys may hold any character.
    """
    _stateful(stream)
    rows = stream.select(F.col(source).cast("string").alias("source"), F.col(key).cast("string").alias("k"))
    return rows.groupBy("source").transformWithStateInPandas(WindowChanges(keep), WINDOW_OUT, "append", "none")


def windowed_counts(stream: DataFrame, at: str, group: str, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts per window; rows later than the watermark are left out, as a late snapshot is in the batch form."""
    return stream.withColumn("at", F.col(at).cast("timestamp")).withWatermark("at", late).groupBy(F.window("at", size).alias("w"), group).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), group, "n")


def first_occurrences(stream: DataFrame, key: str, at: str, within: str = "7 days") -> DataFrame:
    """The first row of each key inside the watermark."""
    return stream.withColumn("at", F.col(at).cast("timestamp")).withWatermark("at", within).dropDuplicatesWithinWatermark([key])


def merge_into(path: str, key: list[str], now: str):
    """A ``foreachBatch`` function that keeps the state table of ``compare_state`` under ``path``, one version per batch."""

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        observed = batch.select(*key).distinct()
        try:
            prior = spark.read.parquet(f"{path}/v={number - 1}")
            baseline = False
        except Exception as e:  # noqa: BLE001  no version before this one
            if "PATH_NOT_FOUND" not in str(e):
                raise
            prior = observed.limit(0).withColumns({"first_seen": F.lit(None).cast("date"), "last_seen": F.lit(None).cast("date")})
            baseline = True
        compare_state(prior.select(*key, "first_seen", "last_seen"), observed, key, now, baseline).write.mode("overwrite").parquet(f"{path}/v={number}")

    return run
