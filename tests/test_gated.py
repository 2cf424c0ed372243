"""The gated filter with timers: plain Python, and the same rows however batches are cut."""

import math
import random

import pytest

from kinestream.plans.timelines import streamed
from kinestream.streaming import gated

TUNING = gated.Tuning(noise=2.0, drift=0.5, gate=3.0, rate=0.05, bound=1.5, gap=20_000_000)
SCHEMA = "stream long, t long, value double, anchor double"


def plain(rows, k):
    out, latest = [], max(r[1] for r in rows)
    for stream in sorted({r[0] for r in rows}):
        x = p = last = None
        bias = 0.0
        own = sorted(r for r in rows if r[0] == stream)
        for (_, t, value, anchor), following in zip(own, [*own[1:], None], strict=True):
            seconds = 0.0 if last is None else (t - last) / 1e6
            if x is not None:
                p += k.drift**2 * seconds
            took = False
            if value is not None:
                z = value - bias
                if x is None:
                    x, p, took = z, k.noise**2, True
                elif abs(z - x) <= k.gate * math.sqrt(p + k.noise**2):
                    g = p / (p + k.noise**2)
                    x, p, took = x + g * (z - x), (1 - g) * p, True
                if anchor is not None:
                    bias = max(-k.bound, min(k.bound, bias + min(1.0, k.rate * seconds) * (value - anchor - bias)))
            last = t
            out.append((stream, t, x, p, bias, took, False))
            if x is not None and (following[1] if following else latest) - t > k.gap:
                out.append((stream, t + k.gap, x, p + k.drift**2 * k.gap / 1e6, bias, False, True))
    return out


def rows_of(seed):
    rng = random.Random(seed)
    rows = []
    for stream in range(5):
        t = rng.randrange(10_000_000)
        for i in range(40):
            t += rng.choice([1_000_003, 5_000_017, 9_000_011, 45_000_019])
            value = None if rng.random() < 0.2 else 10 + rng.gauss(0, 2) + (100 if rng.random() < 0.1 else 0)
            rows.append((stream, t, value, None if value is None or rng.random() < 0.6 else value - 1))
    return rows


@pytest.mark.parametrize("slices", [1, 3, 8])
def test_rows_are_the_same_however_batches_are_cut(spark, slices):
    rows = rows_of(7)
    with gated.timers(spark):
        got = streamed(spark.createDataFrame(rows, SCHEMA), "t", lambda r: gated.gated_filter(r, TUNING), "gated", slices).collect()
    key = lambda r: (r[0], r[1], r[6])
    want = sorted(plain(rows, TUNING), key=key)
    got = sorted(map(tuple, got), key=key)
    assert [key(r) + (r[5],) for r in got] == [key(r) + (r[5],) for r in want]
    for g, w in zip(got, want, strict=True):
        assert g[2:5] == (pytest.approx(w[2]) if w[2] is not None else None, pytest.approx(w[3]) if w[3] is not None else None, pytest.approx(w[4]))
    assert any(r[6] for r in got) and any(not r[5] and not r[6] for r in got) and max(abs(r[4]) for r in got) <= TUNING.bound


def test_the_setting_is_put_back(spark):
    before = spark.conf.get(gated._PROVIDER)
    with gated.timers(spark):
        assert "RocksDB" in spark.conf.get(gated._PROVIDER)
    assert spark.conf.get(gated._PROVIDER) == before


def test_slices_grow_with_rows(spark, monkeypatch):
    """As many slices as the rows ask for, each a micro-batch of its own; rows without a time are in the first."""
    from kinestream.plans import timelines

    monkeypatch.setattr(timelines, "SLICE_ROWS", 10)
    df = spark.createDataFrame([(i, i) for i in range(60)] + [(None, 99)], "t long, v long")
    from pyspark.sql import functions as F

    seen = []
    streamed(df, "t", lambda r: (seen.append(1), r.withColumn("x", F.lit(1)))[1], "slices")
    assert len(seen) == 7
    assert streamed(df, "t", lambda r: r, "slices").count() == 61


def test_streams_of_one_part_have_one_state_and_one_timer(spark, tmp_path):
    """Gaps of all streams of a part are told, by rows and by the timer, however batches are cut; the state has a few rows for each part, not for each stream."""
    rows = rows_of(3) + [(s, 1_000_000 * s, 5.0, None) for s in range(100, 160)]
    key = lambda r: (r[0], r[1], r[6])
    want = sorted(plain(rows, TUNING), key=key)
    with gated.timers(spark):
        got = streamed(spark.createDataFrame(rows, SCHEMA), "t", lambda r: gated.gated_filter(r, TUNING, parts=2), "gated", 4).collect()
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/in")
        stream = gated.gated_filter(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in"), TUNING, parts=2)
        run = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
        run.awaitTermination()
        kept = max(p.stateOperators[0].numRowsTotal for p in run.recentProgress)
    once = spark.read.schema(stream.schema).parquet(f"{tmp_path}/out").collect()
    for found in (got, once):
        found = sorted(map(tuple, found), key=key)
        assert [key(r) + (r[5],) for r in found] == [key(r) + (r[5],) for r in want]
        assert [r[2:5] for r in found] == [tuple(None if v is None else pytest.approx(v) for v in r[2:5]) for r in want]
    assert sum(r[6] for r in got if r[0] >= 100) == 60 and kept <= 20
