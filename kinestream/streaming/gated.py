"""A stateful filter with a gated innovation, a slow bias and timers: forecasts come out of gaps by themselves."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from kinestream.streaming.asof import PARTS, frame_of, named, part_of, rows_of, streams_of

OUTPUT = "stream long, t long, estimate double, variance double, bias double, accepted boolean, forecast boolean"
_COLUMNS = {"stream": "Int64", "t": "int64", "estimate": "Float64", "variance": "Float64", "bias": "float64", "accepted": "bool", "forecast": "bool"}
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@dataclass(frozen=True)
class Tuning:
    """noise: of a value; drift: of the state in a second's root; gate: accepted innovations in standard deviations; rate and bound: of the bias, a second and in all;
    gap: microseconds without a row after which a forecast comes, once."""

    noise: float
    drift: float
    gate: float
    rate: float
    bound: float
    gap: int


class GatedFilter(StatefulProcessor):
    """State of a stream: the fast one (estimate, variance, time of the last row), the slow one (bias), and whether its gap has been told. The streams of a part keep theirs together.

    A row's time lets the variance grow. A value less the bias updates the estimate if its innovation is within the gate, else it's refused and changes nothing. A row that has an
    anchor, too, moves the bias towards value - anchor; without an anchor the slow state holds. The first value starts the estimate.

    A stream is due ``gap`` after its last row; a part's one timer waits for the first that is. Where it expires the forecast of each due stream is the estimate, with the variance of that time. Where the
    next row is in the same or a later batch before the timer's turn, the row itself tells the gap first. So rows are the same however batches are cut, if these are in order of time.
    """

    def __init__(self, tuning: Tuning):
        self.tuning = tuning

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("streams", "stream array<long>, x array<double>, p array<double>, t array<long>, bias array<double>, told array<boolean>")

    def _known(self) -> dict:
        """(x, p, t, bias, told) by stream."""
        return {s: tuple(rest) for s, *rest in zip(*self.state.get(), strict=True)} if self.state.exists() else {}

    def _due(self, t: int) -> int:
        """When the timer of a last row at ``t`` expires, in milliseconds."""
        return (t + self.tuning.gap) // 1000 + 1

    def _keep(self, known: dict) -> None:
        self.state.update(([*known], *([v[k] for v in known.values()] for k in range(5))))
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        first = min((self._due(t) for x, _, t, _, told in known.values() if x is not None and not told), default=None)
        if first is not None:
            self.handle.registerTimer(first)

    def _forecast(self, stream: int | None, x: float, p: float, t: int, bias: float) -> tuple:
        k = self.tuning
        return stream, t + k.gap, x, p + k.drift**2 * k.gap / 1e6, bias, False, True

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        k, known, out = self.tuning, self._known(), []
        fresh, grows = k.noise**2, k.drift**2
        ordered = rows_of(rows, ["t"])
        for stream, t, value, anchor in zip(streams_of(ordered), *(ordered[c].tolist() for c in ("t", "value", "anchor")), strict=True):
            x, p, last, bias, told = known.get(stream, (None, None, None, 0.0, False))
            seconds = 0.0
            if last is not None:
                if t - last > k.gap and not told and x is not None:
                    out.append(self._forecast(stream, x, p, last, bias))
                seconds = (t - last) / 1e6
                if x is not None:
                    p += grows * seconds
            accepted = False
            if value == value:
                z = value - bias
                if x is None:
                    x, p, accepted = z, fresh, True
                elif abs(z - x) <= k.gate * math.sqrt(p + fresh):
                    gain = p / (p + fresh)
                    x, p, accepted = x + gain * (z - x), (1 - gain) ** 2 * p + gain**2 * fresh, True
                if anchor == anchor:
                    bias += min(1.0, k.rate * seconds) * (value - anchor - bias)
                    bias = max(-k.bound, min(k.bound, bias))
            known[stream] = (x, p, t, bias, False)
            out.append((stream, t, x, p, bias, accepted, False))
        self._keep(known)
        if out:
            yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known, out = self._known(), []
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        for stream, (x, p, t, bias, told) in known.items():
            if x is not None and not told and self._due(t) <= now:
                known[stream] = (x, p, t, bias, True)
                out.append(self._forecast(stream, x, p, t, bias))
        self._keep(known)
        if out:
            yield self._frame(out)

    @staticmethod
    def _frame(rows: list[tuple]) -> pd.DataFrame:
        return frame_of(rows, _COLUMNS)

    def close(self) -> None:
        pass


def gated_filter(rows: DataFrame, tuning: Tuning, late: str = "0 seconds", parts: int = PARTS) -> DataFrame:
    """The filter over a stream of rows (stream, t in microseconds, value and anchor, either of them null at times): a row for each, and one for each gap.

    A forecast at the end of a stream comes when the watermark, ``late`` behind the latest row of any stream, has passed it. Rows later than that are dropped.
    """
    timed = rows.withColumn("_event", F.timestamp_micros("t")).withWatermark("_event", late)
    numbers = [F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(c) for c in ("value", "anchor")]
    dealt = timed.select(part_of("stream", parts).alias("part"), *named(), "t", *numbers, "_event")
    return dealt.groupBy("part").transformWithStateInPandas(GatedFilter(tuning), OUTPUT, "Append", "EventTime")


@contextmanager
def timers(spark: SparkSession) -> Iterator[None]:
    """Timers and several state variables need the store that is kept in RocksDB; the session's setting is put back afterwards."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)
