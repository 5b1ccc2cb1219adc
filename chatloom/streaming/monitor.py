"""Monitoring operators on streams: counters, windowed growth, held thresholds, logs.

Late rows behind the watermark are dropped by Structured Streaming.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from chatloom.operators.monitor import parse_logs, select_logs


def counters(stream: DataFrame, *labels: str) -> DataFrame:
    """Running counter per label set; use output mode ``update`` or ``complete``."""
    return stream.groupBy(*labels).agg(F.count("*").alias("total"))


def latest_gauge(stream: DataFrame, series: list[str]) -> DataFrame:
    """Latest value per series; sum by label downstream."""
    return stream.groupBy(*series).agg(F.max_by("value", "ts").alias("value"))


#: State keys over which the series are dealt; a running stream keeps the number it began with.
BUCKETS = 1024


def _packed(rows: pd.DataFrame) -> tuple[bytes]:
    """Rows as one value of state."""
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return (sink.getvalue().to_pybytes(),)


def _unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_pandas()


def _later_ms(us: int) -> int:
    """Milliseconds since 1970, rounded up."""
    return -(-int(us) // 1000)


def _in_order(carried: pd.DataFrame, rows: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    """Both by series, what was carried first and then by time and tie; where a series begins and ends."""
    both = pd.concat([part for part in (carried, rows) if len(part)], ignore_index=True)
    fresh = np.arange(len(both)) >= len(carried)
    series = pd.factorize(both["series"], use_na_sentinel=False)[0]
    order = np.lexsort((both["tie"], both["us"], fresh, series))
    series = series[order]
    change = series[1:] != series[:-1]
    return both.iloc[order], np.append(True, change), np.append(change, True)


class InOrder(StatefulProcessor):
    """Per bucket of series: holds rows until the watermark has passed them, then hands them on by time.

    Rows of one series may come in any order within the watermark's delay. What a batch brings
    waits as one value of a list state; a timer at the earliest row lets go what the watermark
    covers, as nothing older can follow. ``released`` sees every row once. A call to the state
    costs far more than a row, so that series share keys: calls follow the buckets, not the series.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._waiting = handle.getListState("waiting", "rows binary")
        self._carried = handle.getValueState("carried", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        batch = batch.loc[batch["us"].notna(), ["series", "us", "tie", "value"]].astype({"us": "int64", "value": float})
        if len(batch):
            self._waiting.appendValue(_packed(batch))
            self._handle.registerTimer(_later_ms(batch["us"].min()))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        parts = [_unpacked(part[0]) for part in self._waiting.get()]
        waiting = pd.concat(parts, ignore_index=True) if parts else _NO_ROWS
        due = waiting["us"] <= passed * 1000
        if due.any():
            left = waiting[~due]
            self._waiting.clear()
            if len(left):
                self._waiting.put([_packed(left)])
                self._handle.registerTimer(_later_ms(left["us"].min()))
        carried = self._carried.get()
        carried = _unpacked(carried[0]) if carried is not None else _NO_ROWS
        if due.any() or len(carried):
            out, carried = self.released(carried, waiting[due], passed)
            if len(carried):
                self._carried.update(_packed(carried))
            else:
                self._carried.clear()
            if len(out):
                yield out

    def released(
        self, carried: pd.DataFrame, rows: pd.DataFrame, passed_ms: int
    ) -> tuple[pd.DataFrame, pd.DataFrame]:
        """What the rows give, and what to carry: a row per series at most, both with the same columns."""
        raise NotImplementedError

    def close(self) -> None:
        pass


_NO_ROWS = pd.DataFrame({"series": [], "us": [], "tie": [], "value": []}).astype(
    {"series": object, "us": "int64", "tie": "int64", "value": float}
)


class CounterSteps(InOrder):
    """Growth since the sample before; a reset counts in full."""

    def released(
        self, carried: pd.DataFrame, rows: pd.DataFrame, passed_ms: int
    ) -> tuple[pd.DataFrame, pd.DataFrame]:
        if not len(rows):
            return rows, carried
        both, first, last = _in_order(carried, rows)
        value, before = both["value"], both["value"].shift()
        step = np.where(value >= before, value - before, value)
        return both[["series", "us"]].assign(step=step)[~first], both[last]


def _per_series(stream: DataFrame, delay: str, value: Column, tie: str | None, processor: InOrder, out: str, buckets: int) -> DataFrame:
    """Feed (series, us, tie, value) to the processor; rows with equal times go by ``tie``."""
    fields = stream.select(
        F.pmod(F.xxhash64("series"), F.lit(buckets)).cast("int").alias("bucket"),
        F.col("series").cast("string").alias("series"),
        "ts",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("us"),
        (F.col(tie) if tie else F.lit(0)).cast("bigint").alias("tie"),
        value.alias("value"),
    )
    return (
        fields.withWatermark("ts", delay)
        .groupBy("bucket")
        .transformWithStateInPandas(
            statefulProcessor=processor, outputStructType=out, outputMode="Append", timeMode="EventTime"
        )
    )


def counter_steps(
    stream: DataFrame, delay: str = "10 minutes", tie: str | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """(series, ts, step) of a (series, ts, value) counter stream, in event time.

    Same rows as the batch form over the samples the watermark has passed, in whatever
    order they came; samples behind the watermark are dropped. The state of one of the
    ``buckets`` is held in memory at a time, so their number should follow the samples.
    """
    value = F.col("value").cast("double")
    steps = _per_series(stream, delay, value, tie, CounterSteps(), "series string, us long, step double", buckets)
    return steps.select("series", F.timestamp_micros("us").alias("ts"), "step")


def windowed_increase(steps: DataFrame, by: list[str], range_: str, slide: str, delay: str = "10 minutes") -> DataFrame:
    """Growth per sliding window of a (ts, step) stream."""
    return (
        steps.withWatermark("ts", delay)
        .groupBy(F.window("ts", range_, slide), *by)
        .agg(F.sum("step").alias("increase"))
    )


class HeldThreshold(InOrder):
    """Since when the condition holds; fires once when no sample has ended it in time.

    Carries, as ``us``, since when it holds for a series, and as ``value`` whether it has fired (2) or not (1).
    """

    def __init__(self, hold: timedelta):
        self._hold = hold // timedelta(microseconds=1)

    def released(
        self, carried: pd.DataFrame, rows: pd.DataFrame, passed_ms: int
    ) -> tuple[pd.DataFrame, pd.DataFrame]:
        both, first, last = _in_order(carried, rows)
        us, value = both["us"].to_numpy(), both["value"].to_numpy()
        ok = value > 0
        begins = np.flatnonzero(ok & (first | ~np.append(False, ok[:-1])))
        ends = np.flatnonzero(ok & (last | ~np.append(ok[1:], False)))
        is_open, since, fired = last[ends], us[begins], value[begins] == _FIRED
        # What follows a stretch in its series has ended it.
        ended = us[np.minimum(ends + 1, len(us) - 1)]
        deadline = -(-(since + self._hold) // 1000)
        fires = ~fired & np.where(is_open, deadline <= passed_ms, since + self._hold < ended)
        stretches = both.iloc[begins]
        left = is_open & ~fired & ~fires
        if left.any():
            # Fires by itself, without a further sample.
            self._handle.registerTimer(int(deadline[left].min()))
        alerts = pd.DataFrame(
            {"series": stretches["series"], "since": since, "fires_at": since + self._hold}
        )[fires]
        return alerts, stretches.assign(value=np.where(fired | fires, _FIRED, 1.0))[is_open]


_FIRED = 2.0


def held_threshold(
    stream: DataFrame, hold_seconds: float, delay: str = "10 minutes", tie: str | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """(series, since, fires_at) for a (series, ts, ok) stream, one row per stretch held long enough.

    A stretch lasts until a sample ends it: the batch form is ``monitor.held``. The alert comes
    when the watermark passes ``fires_at``. ``buckets`` as in ``counter_steps``.
    """
    ok = F.when(F.col("ok"), 1.0).otherwise(0.0)
    processor = HeldThreshold(timedelta(seconds=hold_seconds))
    alerts = _per_series(stream, delay, ok, tie, processor, "series string, since long, fires_at long", buckets)
    return alerts.select(
        "series", F.timestamp_micros("since").alias("since"), F.timestamp_micros("fires_at").alias("fires_at")
    )


def logs(stream: DataFrame, **labels: str) -> DataFrame:
    """Parsed and selected log rows."""
    return select_logs(parse_logs(stream), **labels)
