import math

import model
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from util import by_group, pos_rows, random_signals

from beatline.functions import arrays
from beatline.operators import peaks, shape

G = ["g"]


def positions(df):
    return {g: [p for (p,) in v] for g, v in by_group(df, "pos").items()}


def drop_empty(d):
    return {g: v for g, v in d.items() if v}


@pytest.mark.parametrize("width", [0, 1, 2, 5, 9, 50])
@pytest.mark.parametrize("chunk", [7, 64, 65_536])
def test_find_peaks(spark, width, chunk):
    signals = random_signals(40, 150, seed=width + chunk)
    df = peaks.find_peaks(pos_rows(spark, signals), width, 0.75, G, chunk=chunk)
    assert positions(df) == drop_empty({g: model.peaks(xs, width, 0.75) for g, xs in signals.items()})


@pytest.mark.parametrize("width,chunk", [(0, 50), (1, 10), (3, 8), (4, 65_536)])
def test_relative_threshold(spark, width, chunk):
    signals = random_signals(40, 90, seed=7)
    df = peaks.find_peaks(pos_rows(spark, signals), width, 0.1001, G, relative=True, chunk=chunk)
    want = {g: model.peaks(xs, width, 0.1001, relative=True) for g, xs in signals.items()}
    assert positions(df) == drop_empty(want)
    kept = peaks.over_threshold(pos_rows(spark, signals), width, 0.1001, G, relative=True, chunk=chunk)
    want = {g: [m for m in range(len(xs)) if model.passes(xs, m, width, 0.1001, True)] for g, xs in signals.items()}
    assert positions(kept) == drop_empty(want)


@pytest.mark.parametrize("fold", [2, 3, 10, 256])
@pytest.mark.parametrize("decay", [0.0, 0.3, 0.95, 1.0])
def test_decay_hold(spark, fold, decay):
    signals = random_signals(20, 70, seed=11)
    df = peaks.exp_decay_hold(pos_rows(spark, signals), decay, G, fold=fold)
    assert df.columns == ["g", "pos", "value", "av"]
    for g, rows in by_group(df, "pos", "value", "av").items():
        assert [v for _, v, _ in rows] == signals[g]
        assert [a for _, _, a in rows] == pytest.approx(model.hold(signals[g], decay), abs=1e-12)


def test_decay_does_not_depend_on_other_groups(spark):
    signals = {"a": [((i * 7919) % 997) / 313 for i in range(3000)]}
    more = signals | {"b": [float(i % 13) for i in range(20_000)]}
    alone, beside = (
        {r.pos: r.av for r in peaks.exp_decay_hold(pos_rows(spark, x), 0.95, G).where("g = 'a'").collect()}
        for x in (signals, more)
    )
    assert alone == beside


def test_decay_hand_case(spark):
    df = peaks.exp_decay_hold(pos_rows(spark, {"a": [4, 0, 2]}), 0.5, G)
    assert [a for _, a in by_group(df, "pos", "av")["a"]] == [4, 2, 2]
    with pytest.raises(ValueError):
        peaks.exp_decay_hold(df, 1.5, G)


def test_decay_with_negative_levels(spark):
    signals = {"a": [-5.0, -9.0, -8.0, -1.0, -7.0, -6.5, -3.0, -2.0, -8.0]}
    df = peaks.exp_decay_hold(pos_rows(spark, signals), 0.9, G, fold=2)
    assert [a for _, a in by_group(df, "pos", "av")["a"]] == pytest.approx(model.hold(signals["a"], 0.9), abs=1e-12)


def test_decay_keeps_its_bits_beside_long_groups(spark):
    """More levels of chunks for one group change nothing for the others; no array grows."""
    signals = {"short": [0.1 * (i % 7) - 0.3 for i in range(9)], "mid": [0.1 * (i % 5) for i in range(40)]}
    long = {"long": [0.3 * (i % 11) for i in range(700)]}

    def levels(given):
        rows = peaks.exp_decay_hold(pos_rows(spark, given), 0.95, G, fold=8).where("g != 'long'").collect()
        return {(r.g, r.pos): r.av for r in rows}

    assert levels(signals) == levels(signals | long)
    plan = peaks.exp_decay_hold(pos_rows(spark, signals), 0.95, G)._jdf.queryExecution().executedPlan().toString()
    assert "aggregate(" not in plan and "concat(" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_decayed_peaks(spark):
    signals = random_signals(60, 60, seed=12)
    df = peaks.find_peaks(pos_rows(spark, signals), 2, 0.2, G, decay=0.95)
    assert positions(df) == drop_empty({g: model.peaks(xs, 2, 0.2, 0.95) for g, xs in signals.items()})
    assert df.columns == ["g", "pos", "value"]


@pytest.mark.parametrize("n,width,chunk", [(2, 1, 65_536), (3, 2, 9), (50, 1, 20)])
def test_top_n(spark, n, width, chunk):
    signals = random_signals(40, 80, seed=n)
    df = peaks.top_n_peaks(pos_rows(spark, signals), n, width, G, chunk=chunk)
    found = {g: [p for _, p in v] for g, v in by_group(df, "rank", "pos").items()}
    assert found == {g: model.top_peaks(xs, n, width) for g, xs in signals.items()}


def test_top_n_hand_case(spark):
    df = peaks.top_n_peaks(pos_rows(spark, {"a": [0, 3, 0, 5, 0, 3, 0]}), 2, 1, G)
    assert by_group(df, "rank", "pos")["a"] == [(1, 3), (2, 1)]


@pytest.mark.parametrize("chunk", [5, 65_536])
def test_normalise(spark, chunk):
    signals = random_signals(20, 40, seed=21) | {"flat": [2, 2, 2], "two": [1, 3]}
    df = shape.normalise(pos_rows(spark, signals), G, chunk=chunk)
    found = {g: [v for _, v in rows] for g, rows in by_group(df, "pos", "value").items()}
    for g, xs in signals.items():
        assert found[g] == pytest.approx(model.z_scores(xs), abs=1e-9)
    assert found["flat"] == [0, 0, 0] and found["two"] == [-1, 1]


@pytest.mark.parametrize("n,chunk", [(2, 65_536), (3, 6), (4, 10), (7, 9), (12, 65_536)])
def test_slope(spark, n, chunk):
    signals = random_signals(30, 50, seed=n)
    df = shape.rolling_slope(pos_rows(spark, signals), n, G, hop=0.5, chunk=chunk)
    for g, rows in by_group(df.withColumn("slope", F.coalesce("slope", F.lit(math.inf))), "pos", "slope").items():
        want = [math.inf if s is None else s for s in model.slope(signals[g], 0.5, n)]
        assert [s for _, s in rows] == pytest.approx(want, abs=1e-9)


def test_slope_hand_case(spark):
    df = shape.rolling_slope(pos_rows(spark, {"a": [0, 1, 3, 6]}), 3, G)
    assert [s for _, s in by_group(df, "pos", "slope")["a"]] == pytest.approx([1.5, 1.5, 2.5, 2.5])
    one = shape.rolling_slope(pos_rows(spark, {"a": [1, 2]}), 1, G)
    assert all(math.isnan(r.slope) for r in one.collect())


def test_extremes(spark):
    signals = random_signals(30, 30, seed=31) | {"h": [1, 3, 3, 1]}
    rows = {r.g: r for r in shape.extremes(pos_rows(spark, signals), G).collect()}
    table = spark.createDataFrame([(g, [float(x) for x in xs]) for g, xs in signals.items()], "g string, a array<double>")
    a = F.col("a")
    flat = {r[0]: r for r in table.select("g", arrays.arr_min(a), arrays.arg_min(a), arrays.arr_max(a), arrays.arg_max(a)).collect()}
    for g, xs in signals.items():
        want = (min(xs), xs.index(min(xs)), max(xs), xs.index(max(xs)))
        assert tuple(rows[g])[1:] == want and tuple(flat[g])[1:] == want


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    arrays_=st.lists(st.lists(st.sampled_from([-1.0, 0.0, 0.5, 1.0, 2.0]), min_size=1, max_size=25), min_size=1, max_size=25),
    width=st.integers(1, 6),
)
def test_peaks_property(spark, arrays_, width):
    signals = {f"s{i}": xs for i, xs in enumerate(arrays_)}
    df = peaks.find_peaks(pos_rows(spark, signals), width, -0.5, G, chunk=8)
    assert positions(df) == drop_empty({g: model.peaks(xs, width, -0.5) for g, xs in signals.items()})
