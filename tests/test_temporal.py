"""Joins on time: stated tables, and brute force over random streams and buckets."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from kinestream.operators import temporal


def packets(spark, acq, arrival):
    return spark.createDataFrame([(1, a, b, i, float(i)) for i, (a, b) in enumerate(zip(acq, arrival, strict=True))], "stream long, acq long, arrival long, packet_id long, value double")


def times(spark, ts, name="query_id"):
    return spark.createDataFrame([(1, t, i) for i, t in enumerate(ts)], f"stream long, t long, {name} long")


def source(spark, ts):
    return spark.createDataFrame([(1, t, i, t / 1000) for i, t in enumerate(ts)], "stream long, t long, sample_id long, value double")


def by_id(df):
    return sorted(df.collect(), key=lambda r: r.query_id)


def test_causal_asof(spark):
    r = by_id(temporal.asof_causal(packets(spark, [0, 10, 20], [50, 15, 25]), times(spark, [0, 15, 25, 40, 50]), 100, bucket=16))
    assert [x.packet_id for x in r] == [None, 1, 2, 2, 2]
    assert [x.fresh for x in r] == [False, True, True, False, False]
    assert all(x.age >= 0 for x in r)


def test_stale_packets_are_not_used(spark):
    r = by_id(temporal.asof_causal(packets(spark, [0], [100]), times(spark, [100, 200]), 50))
    assert [x.packet_id for x in r] == [None, None] and not any(x.fresh for x in r)


def test_gap_gate(spark):
    r = by_id(temporal.interpolated(temporal.bracket(source(spark, [0, 10, 100, 110]), times(spark, [5, 50, 105]), bucket=30), 25))
    assert [x.valid for x in r] == [True, False, True] and r[1].value is None


def test_exact_hits_pass_the_gate(spark):
    r = by_id(temporal.interpolated(temporal.bracket(source(spark, [0, 1000, 10000]), times(spark, [0, 500, 1000, 5000, 10000]), bucket=700), 250))
    assert [x.valid for x in r] == [True, False, True, False, True]
    assert [x.value for x in r if x.valid] == [0.0, 1.0, 10.0]


def test_bracket_audit(spark):
    r = by_id(temporal.interpolated(temporal.bracket(source(spark, [10, 20, 40]), times(spark, [10, 40])), 5))
    assert [(x.low_id, x.high_id, x.alpha, x.span, x.nearest_delta) for x in r] == [(0, 0, 0.0, 0, 0), (2, 2, 0.0, 0, 0)]


def test_nearest_takes_the_earlier_of_equals(spark):
    r = by_id(temporal.nearest(temporal.bracket(source(spark, [0, 10, 30]), times(spark, [5, 20, 21, 31]))))
    assert [x.sample_id for x in r] == [0, 1, 2, None]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 20)), min_size=0, max_size=25), st.lists(st.integers(0, 90), min_size=1, max_size=20, unique=True), st.integers(0, 25), st.sampled_from([7, 30, 1000]))
def test_asof_is_brute_force(spark, raw, ts, age, bucket):
    acq = [a for a, _ in raw]
    arrival = [a + d for a, d in raw]
    ts = sorted(ts)
    got = by_id(temporal.asof_causal(packets(spark, acq, arrival), times(spark, ts), age, bucket=bucket))
    held = None
    for q, r in zip(ts, got, strict=True):
        seen = [(a, i) for i, (a, b) in enumerate(zip(acq, arrival, strict=True)) if b <= q]
        best = max(seen)[1] if seen and 0 <= q - max(seen)[0] <= age else None
        assert r.packet_id == best and r.fresh == (best is not None and best != held)
        held = best if best is not None else held


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 100), min_size=0, max_size=20, unique=True), st.lists(st.integers(-5, 105), min_size=1, max_size=20, unique=True), st.integers(1, 40), st.sampled_from([9, 1000]))
def test_bracket_is_brute_force(spark, src, ts, gap, bucket):
    src = sorted(src)
    got = by_id(temporal.interpolated(temporal.bracket(source(spark, src), times(spark, ts), bucket=bucket), gap))
    for q, r in zip(ts, got, strict=True):
        low, high = max((s for s in src if s <= q), default=None), min((s for s in src if s >= q), default=None)
        valid = low == q or (low is not None and high is not None and high - low <= gap)
        assert r.valid == valid
        assert (r.low_id, r.high_id) == tuple(src.index(x) if x is not None else None for x in (low, high))


def test_gap_fill_leaves_edges_and_long_runs(spark):
    v = [None, 1.0, None, None, 4.0, None, None, None, 8.0, None]
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate(v)], "stream long, i long, value double")
    r = sorted(temporal.gap_filled(df, 2, bucket=3).collect(), key=lambda x: x.i)
    assert [x.filled for x in r] == [None, 1.0, 2.0, 3.0, 4.0, None, None, None, 8.0, None]


def test_rows_without_stream_or_time_stay(spark):
    p = spark.createDataFrame([(1, 0, 5, 0, 1.0), (None, 0, 5, 1, 2.0), (1, 3, None, 2, 3.0)], "stream long, acq long, arrival long, packet_id long, value double")
    q = spark.createDataFrame([(1, 9, 0), (1, None, 1), (None, 9, 2)], "stream long, t long, query_id long")
    got = {r.query_id: (r.packet_id, r.age, r.fresh) for r in temporal.asof_causal(p, q, 100, bucket=4).collect()}
    assert got == {0: (0, 9, True), 1: (None, 0, False), 2: (1, 9, True)}
    s = spark.createDataFrame([(1, 0, 0, 1.0), (1, 10, 1, 2.0), (None, 8, 2, 3.0), (None, 12, 3, 5.0), (1, None, 4, 7.0)], "stream long, t long, sample_id long, value double")
    rows = {r.query_id: (r.valid, r.value) for r in temporal.interpolated(temporal.bracket(s, q, bucket=4), 25).collect()}
    assert rows == {0: (True, 1.9), 1: (False, None), 2: (True, 3.5)}
    near = {r.query_id: r.sample_id for r in temporal.nearest(temporal.bracket(s, q, bucket=4)).collect()}
    assert near == {0: 1, 1: None, 2: 2}
    total = temporal.numbered(q, ["stream"], [F.col("t")], "t").collect()
    assert {r.query_id: r.i for r in total} == {0: 0, 1: None, 2: 0}


def test_later_rows_change_nothing_before(spark):
    """Of a prefix in time the as-of join gives what it gives for the whole: nothing looks ahead."""
    rng = random.Random(9)
    p = [(rng.randrange(3), a, a + rng.randrange(30), i, float(i)) for i, a in enumerate(sorted(rng.randrange(200) for _ in range(60)))]
    q = [(rng.randrange(3), rng.randrange(200), i) for i in range(40)]
    run = lambda a, b: {r.query_id: r for r in temporal.asof_causal(spark.createDataFrame(a, "stream long, acq long, arrival long, packet_id long, value double"), spark.createDataFrame(b, "stream long, t long, query_id long"), 50, bucket=32).collect()}
    whole = run(p, q)
    for cut in (60, 120):
        part = run([x for x in p if x[2] <= cut], [x for x in q if x[1] <= cut])
        assert part and all(whole[i] == r for i, r in part.items())


@pytest.mark.parametrize("slices", [1, 3, 7])
def test_streams_go_on_after_a_restart(spark, slices):
    from kinestream.plans.timelines import streamed
    from kinestream.streaming import asof

    rng = random.Random(3)
    p = [(rng.randrange(2), a, a + rng.randrange(30), i, float(i)) for i, a in enumerate(sorted(rng.randrange(200) for _ in range(40)))]
    q = [(rng.randrange(2), t, i) for i, t in enumerate(rng.sample(range(230), 30))]
    rows = [(s, 0, b, a, i, v, None) for s, a, b, i, v in p] + [(s, 1, t, None, None, None, i) for s, t, i in q]
    made = streamed(spark.createDataFrame(rows, "stream long, kind int, t long, acq long, packet_id long, value double, query_id long"), "t", lambda r: asof.asof_stream(r, 60), "test", slices)
    want = temporal.asof_causal(spark.createDataFrame(p, "stream long, acq long, arrival long, packet_id long, value double"), spark.createDataFrame(q, "stream long, t long, query_id long"), 60)
    names = ["stream", "query_id", "t", "packet_id", "value", "age", "fresh"]
    assert sorted(map(tuple, made.select(names).collect())) == sorted(map(tuple, want.select(names).collect()))


def test_session_stream_is_the_table(spark):
    from kinestream.operators import frames
    from kinestream.plans.timelines import streamed
    from kinestream.streaming import asof

    rng = random.Random(1)
    rows = [(rng.randrange(3), rng.randrange(400) * 1_000_000) for _ in range(80)]
    # Far later rows let the watermark pass all others.
    df = spark.createDataFrame(rows + [(9, 100_000 * 1_000_000), (9, 200_000 * 1_000_000)], "stream long, t long")
    made = streamed(df, "t", lambda r: asof.session_splits(r.withColumn("at", F.timestamp_micros("t")), "at", "stream", "5 seconds"), "sessions", 3)
    got = {(r.stream, r.first.timestamp(), r["rows"]) for r in made.collect() if r.stream < 9}
    want = {(r.stream, r["first"] / 1e6, r.n) for r in frames.sessions(df, 5_000_000).collect() if r.stream < 9}
    assert got == want


def test_rows_without_a_time_are_many_tasks(spark):
    """They stay, get nothing and give nothing, and no window holds all of them; columns named like ours are kept."""
    from kinestream.operators import temporal

    rows = [("s", None, k, k) for k in range(500)] + [("s", 10 * k, k, k) for k in range(20)] + [(None, None, 7, 7), (None, 3, 7, 7)]
    df = spark.createDataFrame(rows, "stream string, t long, _value long, _key long")
    got = temporal.running_extreme(df, ["stream"], [F.col("t")], "t", F.col("_value"), "best", bucket=50).collect()
    assert len(got) == len(rows) and all(r.best == (None if r.t is None else r._value) for r in got)
    keys = df.select(temporal._bucket_key(df, ["stream"], "t", 50).alias("k")).groupBy("k").count().orderBy(F.desc("count")).first()
    assert keys["count"] < 25
    total = temporal.running_total(df, ["stream"], [F.col("t")], "t", F.lit(1).cast("long"), "n", bucket=50).collect()
    assert sorted(r.n for r in total if r.n is not None and r.stream) == list(range(1, 21)) and sum(r.n is None for r in total) == 501


def test_holdouts_pass_over_any_number_of_excluded_frames(spark):
    """Against a walk over all frames: long runs of excluded ones, quantiles that meet, streams without excluded ones or with nothing else."""
    import random

    from kinestream.operators import frames

    rng, rows, sizes = random.Random(3), [], {}
    for s in range(12):
        n = sizes[s] = rng.choice([1, 2, 7, 40, 300])
        rows += [(s, f) for f in range(n) if s == 3 or (s and rng.random() < 0.2 + 0.7 * (f // 50 % 2))]
    rows += rows[:5] + [(1, -4), (5, 10**6)]
    quantiles = [0.0, 0.5, 0.5, 0.52, 1.0]
    want = []
    out = set(rows)
    for s, n in sizes.items():
        chosen = []
        for q in quantiles:
            at = round((n - 1) * q)
            while (s, at) in out or at in chosen:
                at += 1
            chosen.append(at)
        want += [(s, k, f if f < n else None) for k, f in enumerate(chosen)]
    got = frames.quantile_holdout(spark.createDataFrame([*sizes.items()], "stream int, n long"), spark.createDataFrame(rows, "stream int, frame long"), quantiles).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_several_sources_take_as_many_sorts_as_one(spark):
    from kinestream.operators import temporal

    p = spark.createDataFrame([("s", 1, 2, 3, 0.5)], "stream string, acq long, arrival long, packet_id long, value double")
    q = spark.createDataFrame([("s", 5, 1)], "stream string, t long, query_id long")
    sorts = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Window [")
    assert sorts(temporal.asof_each({n: p for n in "abc"}, q, 10)) <= sorts(temporal.asof_causal(p, q, 10)) * 1 + 4
    r = temporal.asof_each({n: p for n in "abc"}, q, 10).first()
    assert tuple(r.a) == tuple(r.b) == (3, 0.5, 4, True)


def run_once(spark, tmp_path, rows, schema, made):
    """The rows of one micro-batch of a stream, and how many keys its state has."""
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/in")
    stream = made(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"))
    run = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    kept = [p.stateOperators[0].numRowsTotal for p in run.recentProgress if p.numInputRows]
    return spark.read.schema(stream.schema).parquet(f"{tmp_path}/out").collect(), kept[0]


def test_a_filter_is_called_for_parts_and_not_for_streams(spark, tmp_path):
    """Far more streams than calls and states, one of them null, names and times beyond what a float holds; each as if it were alone."""
    from kinestream.streaming import asof

    rng, big = random.Random(5), 2**60
    rows = [(None if s == 7 else big + s, big + s + 1_000_000 * k, rng.choice([None, rng.gauss(0, 9)])) for s in range(900) for k in range(3)]
    got, kept = run_once(spark, tmp_path, rows, "stream long, t long, value double", lambda r: asof.diagonal_filter(r, 2.0, 0.5))
    want = []
    for s, own in {s: [r for r in rows if r[0] == s] for s in {r[0] for r in rows}}.items():
        x = p = last = None
        for _, t, v in sorted(own, key=lambda r: r[1]):
            if x is not None:
                p += 0.25 * (t - last) / 1e6
            if v is not None:
                g = 1.0 if x is None else p / (p + 4.0)
                x, p = (v, 4.0) if x is None else (x + g * (v - x), (1 - g) ** 2 * p + g**2 * 4.0)
            last = t
            want.append((s, t, x, p))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert kept <= asof.PARTS < 900


def test_slices_are_as_long_as_the_rows_of_a_part_allow(spark, monkeypatch):
    """Rows of many parts come in few slices; of one part, and where a part has all of its rows at one end, in slices that bound these."""
    from kinestream.plans import timelines

    monkeypatch.setattr(timelines, "SLICE_ROWS", 40)
    even = spark.createDataFrame([(i, i % 20) for i in range(1600)], "t long, part int")
    late = spark.createDataFrame([(i, i % 20 if i < 1200 else 3) for i in range(1600)], "t long, part int")

    def fullest(df, part):
        cuts = timelines._cuts(df, "t", None, part)
        return len(cuts) + 1, df.groupBy(timelines._slice_of("t", cuts), part).count().agg(F.max("count")).first()[0]

    slices, most = fullest(even, F.col("part"))
    assert 4 <= slices <= 6 and most <= 40
    slices, most = fullest(even, F.expr("t * 0"))
    assert slices >= 40 and most <= 40
    slices, most = fullest(late, F.col("part"))
    assert 13 <= slices <= 20 and most <= 40


def test_forecasts_take_no_more_runs_for_more_rows(spark, monkeypatch):
    """Ten times the rows that one slice may hold, spread over many streams, are still some four runs, and each stream has its three horizons."""
    from kinestream.plans import timelines

    sf, runs, keep = "/root/testdata/sf0.001", [], timelines.asof.diagonal_filter
    streams = timelines.stream_events(spark, sf).select("stream").distinct().count()
    rows = timelines.stream_events(spark, sf).count()
    monkeypatch.setattr(timelines, "SLICE_ROWS", rows // 10)
    monkeypatch.setattr(timelines.asof, "diagonal_filter", lambda *a: (runs.append(1), keep(*a))[1])
    got = timelines.forecast(spark, sf).collect()
    assert 4 <= len(runs) <= 7
    assert len({(r.stream, r.hours) for r in got}) == len(got) == 3 * streams


def test_an_asof_stream_is_called_for_parts_and_not_for_streams(spark, tmp_path):
    """Far more streams than calls and states, one of them null, ids and times beyond what a float holds: the rows of ``asof_causal``."""
    from kinestream.streaming import asof

    rng, big = random.Random(8), 2**60
    name = lambda s: None if s == 7 else big + s
    p = [(name(s), big + a, big + a + rng.randrange(30), big + 10 * s + k, rng.choice([None, float(k)])) for s in range(700) for k, a in enumerate(rng.sample(range(100), 3))]
    q = [(name(s), big + t, big + 10 * s + k) for s in range(700) for k, t in enumerate(rng.sample(range(120), 3))]
    rows = [(s, 0, b, a, i, v, None) for s, a, b, i, v in p] + [(s, 1, t, None, None, None, i) for s, t, i in q]
    got, kept = run_once(spark, tmp_path, rows, "stream long, kind int, t long, acq long, packet_id long, value double, query_id long", lambda r: asof.asof_stream(r, 60))
    want = temporal.asof_causal(spark.createDataFrame(p, "stream long, acq long, arrival long, packet_id long, value double"), spark.createDataFrame(q, "stream long, t long, query_id long"), 60)
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want.select("stream", "query_id", "t", "packet_id", "value", "age", "fresh").collect()), key=repr)
    assert kept <= asof.PARTS < 700
