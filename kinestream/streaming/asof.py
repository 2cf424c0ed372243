"""The causal as-of join as a stateful stream operator, and session splits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Streams fall in so many parts by their hash. A checkpoint holds for one number only.
PARTS = 256
STATE = "stream array<long>, acq array<long>, packet_id array<long>, value array<double>, held array<long>"
OUTPUT = "stream long, query_id long, t long, packet_id long, value double, age long, fresh boolean"


def part_of(stream: str = "stream", parts: int = PARTS) -> Column:
    """The part of a stream. The operators are called once for each part of a micro-batch and keep the state of all its streams together: a call
    costs milliseconds, far more than the few rows that most streams have in a micro-batch. Null is a stream like others."""
    return F.pmod(F.xxhash64(stream), F.lit(parts)).cast("int")


def rows_of(frames: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    """The rows of a part in order, ``stream`` without nulls and ``none`` where it was null."""
    rows = pd.concat([*frames])
    if rows["t"].isna().any():
        raise ValueError("a row without a time has no place in a stream")
    return rows.iloc[np.lexsort([rows[c].to_numpy() for c in reversed(order)])]


def streams_of(rows: pd.DataFrame) -> list:
    """The stream of each row, None for null."""
    found = rows["stream"].tolist()
    return [None if n else s for s, n in zip(found, rows["none"], strict=True)] if rows["none"].any() else found


def named(stream: str = "stream") -> list[Column]:
    """``stream`` and ``none``: whole numbers stay whole, as pandas has nulls only among floats."""
    return [F.coalesce(F.col(stream), F.lit(0)).alias("stream"), F.col(stream).isNull().alias("none")]


def frame_of(rows: list[tuple], columns: dict[str, str]) -> pd.DataFrame:
    """Rows as a frame of typed columns, each of which may hold None."""
    return pd.DataFrame({name: pd.array(list(values), dtype=kind) for (name, kind), values in zip(columns.items(), zip(*rows, strict=True), strict=True)})


def asof_stream(events: DataFrame, max_age: int, parts: int = PARTS) -> DataFrame:
    """For a stream of packets and queries in order of arrival, the packet of each query.

    events: stream, kind (0: packet, 1: query), t (arrival or query time), acq, packet_id, value, query_id. State per stream is one
    packet (the greatest acquisition so far) and the id that the last query with a packet was given. Within a micro-batch rows
    are taken by t, packets first; a packet that comes in a later batch than a query is not seen by it: no look-ahead and
    no revision. So results equal those of ``temporal.asof_causal`` however batches are cut, if batches are in order of t.
    A part's rows of a micro-batch are one frame in memory (``part_of``), so bound micro-batches (``maxFilesPerTrigger``, or slices of time).
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        known = {s: (a, p, v, h) for s, a, p, v, h in zip(*state.get, strict=True)} if state.exists else {}
        rows = rows_of(frames, ["t", "kind", "id"])
        out = []
        for stream, kind, t, acq, id_, value in zip(streams_of(rows), *(rows[c].tolist() for c in ("kind", "t", "acq", "id", "value")), strict=True):
            best = known.get(stream)
            if kind == 0:
                if best is None or (acq, id_) > best[:2]:
                    known[stream] = (acq, id_, value, best and best[3])
            elif best is not None and 0 <= t - best[0] <= max_age:
                out.append((stream, id_, t, best[1], best[2], t - best[0], best[1] != best[3]))
                if best[1] != best[3]:
                    known[stream] = (*best[:3], best[1])
            else:
                out.append((stream, id_, t, None, None, 0, False))
        state.update(([*known], *([v[k] for v in known.values()] for k in range(4))))
        if out:
            yield frame_of(out, {"stream": "Int64", "query_id": "int64", "t": "int64", "packet_id": "Int64", "value": "Float64", "age": "int64", "fresh": "bool"})

    ids = F.when(F.col("kind") == 0, F.col("packet_id")).otherwise(F.col("query_id"))
    rows = events.select(part_of("stream", parts).alias("part"), *named(), "kind", "t", F.when(F.col("kind") == 0, F.col("acq")).otherwise(0).alias("acq"), ids.alias("id"), "value")
    return rows.groupBy("part").applyInPandasWithState(step, OUTPUT, STATE, "append", "NoTimeout")


def session_splits(events: DataFrame, time: str, stream: str, gap: str = "1 second", late: str = "10 minutes") -> DataFrame:
    """Rows and bounds of each run without a gap, as session windows with a watermark; late rows are dropped."""
    seen = events.withWatermark(time, late).groupBy(stream, F.session_window(time, gap).alias("s")).agg(F.count("*").alias("rows"), F.min(time).alias("first"), F.max(time).alias("last"))
    return seen.select(stream, "rows", "first", "last")


def diagonal_filter(events: DataFrame, noise: float, drift: float, parts: int = PARTS) -> DataFrame:
    """A scalar random-walk filter per stream: stream, t, value in; estimate and variance out. A missing value holds the state and lets the
    variance grow; the gain is variance / (variance + noise ** 2), the update in Joseph's form."""
    fresh, grows = noise**2, drift**2

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        known = {s: (x, p, t) for s, x, p, t in zip(*state.get, strict=True)} if state.exists else {}
        rows = rows_of(frames, ["t"])
        out = []
        for stream, t, value in zip(streams_of(rows), rows["t"].tolist(), rows["value"].tolist(), strict=True):
            x, p, last = known.get(stream, (None, None, None))
            if x is not None:
                p += grows * (t - last) / 1e6
            if value == value:
                if x is None:
                    x, p = value, fresh
                else:
                    gain = p / (p + fresh)
                    x, p = x + gain * (value - x), (1 - gain) ** 2 * p + gain**2 * fresh
            if x is not None:
                known[stream] = (x, p, t)
            out.append((stream, t, x, p))
        state.update(([*known], *([v[k] for v in known.values()] for k in range(3))))
        yield frame_of(out, {"stream": "Int64", "t": "int64", "estimate": "Float64", "variance": "Float64"})

    rows = events.select(part_of("stream", parts).alias("part"), *named(), "t", F.coalesce(F.col("value").cast("double"), F.lit(float("nan"))).alias("value"))
    state = "stream array<long>, x array<double>, p array<double>, last array<long>"
    return rows.groupBy("part").applyInPandasWithState(step, "stream long, t long, estimate double, variance double", state, "append", "NoTimeout")


def free_run(state: DataFrame, horizons: list[int], drift: float) -> DataFrame:
    """``diagonal_filter``'s last state (stream, t, estimate, variance) without input: for each horizon in microseconds the same estimate at t + ahead with
    the variance that has grown until then."""
    each = state.select("*", F.explode(F.array(*[F.lit(h).cast("long") for h in horizons])).alias("ahead"))
    return each.select("stream", (F.col("t") + F.col("ahead")).alias("t"), "ahead", "estimate", (F.col("variance") + drift**2 * F.col("ahead") / 1e6).alias("variance"))
