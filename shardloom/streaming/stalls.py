"""Best value so far and stalls per run, in event time: a run that is silent for longer than the limit is reported once.

Points are drawn together before they reach the state: what a run brought without a long silence in between is one
segment, whatever the number of its points, so that a run with most of the points sends few rows. A timer stands at the
end of the last segment; it is moved on when the run goes on, fires when the watermark passes it, and takes the state
of the run with it after another, longer silence.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SEGMENTS = "run_id string, first_ts timestamp, last_ts timestamp, best double, best_step long, n_seen long"
STALLS = "run_id string, last_ts timestamp, silent_from timestamp, best double, best_step long, n_seen long"
STATE = "last_us long, best double, best_step long, n_seen long, told boolean"
PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _us(ts) -> int:
    return int(pd.Timestamp(ts).value // 1000)


def _ts(us: int) -> datetime:
    return datetime(1970, 1, 1) + timedelta(microseconds=us)


def segments(limit_us: int):
    """A ``mapInPandas`` function from ``(run_id, step, value, ts)`` to segments without a silence of the limit."""
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            pdf = pdf.sort_values(["run_id", "ts", "step"])
            us = pdf["ts"].astype("int64") if pdf["ts"].dtype.kind == "i" else pdf["ts"].map(_us)
            new = (pdf["run_id"] != pdf["run_id"].shift()) | (us.diff() >= limit_us)
            by = pdf.assign(segment=new.cumsum()).groupby("segment", sort=True)
            low = pdf.assign(segment=new.cumsum()).sort_values(["segment", "value", "step"]).groupby("segment", sort=True).first()
            yield pd.DataFrame({"run_id": by["run_id"].first(), "first_ts": by["ts"].min(), "last_ts": by["ts"].max(), "best": low["value"],
                                "best_step": low["step"].astype("int64"), "n_seen": by.size().astype("int64")})

    return work


class StallWatch(StatefulProcessor):
    """State per run: its last point, best value and number of points, and whether its silence was told."""

    def __init__(self, limit_us: int, forget_us: int) -> None:
        self.limit, self.forget = limit_us, forget_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", STATE)

    def _row(self, key, last: int, best: float, step: int, n: int) -> tuple:
        return key[0], _ts(last), _ts(last + self.limit), best, step, n

    def _at(self, us: int) -> int:
        """A timer in milliseconds, at which the watermark has passed the time."""
        return -(-us // 1000)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = sorted((_us(r.first_ts), _us(r.last_ts), float(r.best), int(r.best_step), int(r.n_seen)) for pdf in rows for r in pdf.itertuples())
        last, best, step, n, told = self.run.get() if self.run.exists() else (None, float("inf"), -1, 0, False)
        out = []
        for first_us, last_us, low, low_step, size in found:
            if last is not None and first_us - last >= self.limit and not told:
                out.append(self._row(key, last, best, step, n))
            if (low, low_step) < (best, step) and low < best:
                best, step = low, low_step
            last, n, told = max(last or last_us, last_us), n + size, False
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.run.update((last, best, step, n, told))
        self.handle.registerTimer(self._at(last + self.limit))
        if out:
            yield pd.DataFrame(out, columns=[f.split()[0] for f in STALLS.split(", ")])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, best, step, n, told = self.run.get()
        if told:
            self.run.clear()
            return
        self.run.update((last, best, step, n, True))
        self.handle.registerTimer(self._at(last + self.limit + self.forget))
        yield pd.DataFrame([self._row(key, last, best, step, n)], columns=[f.split()[0] for f in STALLS.split(", ")])

    def close(self) -> None:
        pass


def stalls(points: DataFrame, limit_seconds: int, delay_seconds: int = 0, forget_seconds: int = 30 * 86_400) -> DataFrame:
    """A stream of ``(run_id, step, value, ts)`` as one row per silence of at least the limit.

    ``last_ts`` is the last point before it and ``silent_from`` the time at which it was a stall; best value, its step
    and the number of points are those until then. A silence at the end counts once the watermark, the latest point of
    all runs less the delay, has passed it. Points later than the delay are dropped. Runs silent for ``forget_seconds``
    more are forgotten: one that comes back starts anew.
    """
    micro = 1_000_000
    rows = points.select(F.col("run_id").cast("string").alias("run_id"), F.col("step").cast("long").alias("step"), F.col("value").cast("double").alias("value"), "ts")
    joined = rows.mapInPandas(segments(limit_seconds * micro), SEGMENTS).withWatermark("last_ts", f"{delay_seconds} seconds")
    return joined.groupBy("run_id").transformWithStateInPandas(
        statefulProcessor=StallWatch(limit_seconds * micro, forget_seconds * micro), outputStructType=STALLS, outputMode="Append", timeMode="EventTime")


def run_stalls(found: DataFrame, out: str, checkpoint: str) -> None:
    """Process everything available and append it to a parquet table; the state is kept by RocksDB, as timers need it."""
    spark = found.sparkSession
    before = spark.conf.get(PROVIDER_KEY)
    spark.conf.set(PROVIDER_KEY, PROVIDER)
    try:
        query = found.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(
            availableNow=True).start()
    finally:
        spark.conf.set(PROVIDER_KEY, before)
    query.awaitTermination()
