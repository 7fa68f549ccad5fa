import random

import pytest
from model import anomalies, energy, is_first_max, peaks
from pyspark.sql import functions as F
from util import T0, random_signals, samples

from beatline.functions import arrays
from beatline.operators.windows import count_window_arrays
from beatline.plans import detection as d


def beats(df):
    return sorted((r.signame, r.k, r.seg, r.start, r.len, r.ecg) for r in df.collect())


def expected(signals, **kw):
    return sorted(
        (name, k, seg, start, n, [float(x) for x in part])
        for name, xs in signals.items()
        for k, seg, start, n, _, part in anomalies([float(x) for x in xs], **kw)
    )


@pytest.mark.parametrize("task_rows", [10**6, 100])
def test_chain_against_model(spark, task_rows):
    signals = random_signals(30, 200, seed=3)
    kw = dict(size=32, slide=16, width=4)
    df = d.detect_anomalies(samples(spark, signals), rr_floor=8 / 360, task_rows=task_rows, **kw)
    want = expected(signals, rr=8 / 360, **kw)
    assert len(want) > 50
    assert beats(df) == want


def test_default_settings(spark):
    rng = random.Random(4)
    xs = [rng.random() + (1.5 if i % 130 == 7 else 0) for i in range(2000)]
    df = d.detect_anomalies(samples(spark, {"a": xs}))
    want = expected({"a": xs}, size=576, slide=288, width=50)
    assert want and beats(df) == want


def test_stamps(spark):
    xs = [0, 2, 0, 0, 2, 0, 0, 2, 0, 0]
    kw = dict(size=10, slide=10, width=1, te_floor=1e9)
    rows = d.detect_anomalies(samples(spark, {"a": xs}), **kw).orderBy("seg").collect()
    assert [(r.time - T0).microseconds // 1000 for r in rows] == [0, 1]
    rows = d.detect_anomalies(samples(spark, {"a": xs}), time_mode="peak", **kw).orderBy("seg").collect()
    assert [(r.time - T0).microseconds // 1000 for r in rows] == [1, 4]
    with pytest.raises(ValueError):
        d.detect_anomalies(samples(spark, {"a": xs}), time_mode="other", **kw)


def test_interval_is_strict(spark):
    def flat_peaks(a, b):
        xs = [0.0] * 576
        xs[a] = xs[b] = 50.0
        return xs

    # The flat slices have no energy, so only the interval may decide here.
    both = samples(spark, {"at": flat_peaks(10, 153), "under": flat_peaks(10, 152)})
    df = d.detect_anomalies(both, slide=576, te_floor=-1.0)
    assert [(r.signame, r.len) for r in df.collect()] == [("under", 143)]


def test_one_peak_gives_nothing(spark):
    firing = count_window_arrays(samples(spark, {"a": [0, 0, 2, 0]}), 4, 4)
    assert d.min_peaks_gate(firing, width=1).count() == 0
    assert d.beat_segments(firing, 4, 4, width=1).count() == 0
    assert [r.pos for r in d.r_peaks(firing, width=1).collect()] == [2]


def test_repeats_are_dropped_once(spark):
    signals = {"a": [0, 2, 0, 0, 2, 0, 0, 2, 0, 0, 2, 0]}
    kw = dict(size=8, slide=4, width=1, te_floor=1e9)
    every = d.detect_anomalies(samples(spark, signals), **kw).collect()
    once = d.detect_anomalies(samples(spark, signals), dedup=True, **kw).collect()
    spans = [(r.abs_start, r.abs_end) for r in every]
    assert len(spans) > len(set(spans))
    assert sorted((r.abs_start, r.abs_end) for r in once) == sorted(set(spans))
    for r in once:
        assert r.k == min(e.k for e in every if (e.abs_start, e.abs_end) == (r.abs_start, r.abs_end))


def test_anomaly_rows_columns(spark):
    df = d.anomaly_rows(d.detect_anomalies(samples(spark, {"a": [0, 2, 0, 2]}), 4, 4, width=1))
    assert df.columns == ["signame", "time", "ecg", "abnormal"]
    assert [(r.ecg, r.abnormal) for r in df.collect()] == [([2, 0, 2], "TRUE")]


def test_array_peaks(spark):
    cases = [([0, 1, 0, 2, 2, 0], 1, [1, 3]), ([0.75, 0], 1, []), ([5], 2, [0]), ([1, 1, 1], 0, [0, 1, 2])]
    for xs, width, want in cases:
        assert peaks(xs, width, 0.75) == want
        df = spark.createDataFrame([([float(x) for x in xs],)], "a array<double>")
        assert df.select(arrays.peak_positions(F.col("a"), width, 0.75)).first()[0] == want
    empty = spark.createDataFrame([([],)], "a array<double>")
    assert empty.select(arrays.peak_positions(F.col("a"), 3, 0.75)).first()[0] == []


@pytest.mark.parametrize("width", [0, 1, 2, 5, 50])
def test_array_peaks_against_model(spark, width):
    signals = random_signals(150, 60, seed=width, levels=(0.0, 0.7, 0.8, 0.9, 1.0))
    df = spark.createDataFrame([(n, [float(x) for x in xs]) for n, xs in signals.items()], "g string, a array<double>")
    found = {r.g: r.p for r in df.select("g", arrays.peak_positions(F.col("a"), width, 0.75).alias("p")).collect()}
    assert found == {n: [m for m in range(len(xs)) if xs[m] > 0.75 and is_first_max(xs, m, width)] for n, xs in signals.items()}


def test_teager(spark):
    for xs in ([1, 2, 3, 4], [3.0], [1, 2], [2, 0, 5]):
        xs = [float(x) for x in xs]
        df = spark.createDataFrame([(xs,)], "a array<double>")
        row = df.select(arrays.teager(F.col("a")), arrays.teager_sum(F.col("a"))).first()
        assert row[0] == energy(xs) and row[1] == sum(energy(xs))
    seg = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0], 4)], "ecg array<double>, len bigint")
    assert d.avg_teager(seg).first().avg_te == 0.5


def test_detection_adds_no_shuffle(spark):
    firing = spark.createDataFrame([], "signame string, k bigint, times array<timestamp_ntz>, ecg array<double>")
    plan = d.detect_in_windows(firing)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_beats_are_scored_once(spark):
    df = d.detect_anomalies(samples(spark, {"a": [0.0] * 10}))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 1
