import pytest
from model import firings
from pyspark.sql import functions as F
from util import random_signals, samples

from beatline.operators.indexing import dense_index
from beatline.operators.windows import (
    count_window,
    count_window_arrays,
    key_by,
    rebalance,
    watermark,
    window_collect,
    window_rows,
)
from beatline.runtime import group_load, partitions_for


def got(df):
    return {(r.signame, r.k): r.ecg for r in df.collect()}


def expected(signals, size, slide):
    return {
        (name, k): [float(xs[i]) for i in idx]
        for name, xs in signals.items()
        for k, idx in firings(len(xs), size, slide).items()
    }


def test_hand_cases(spark):
    ten = samples(spark, {"a": range(10)})
    assert got(count_window_arrays(ten, 8, 4)) == {("a", 1): [0, 1, 2, 3], ("a", 2): list(range(8))}
    six = samples(spark, {"a": range(6)})
    assert got(count_window_arrays(six, 1, 3)) == {("a", 1): [2], ("a", 2): [5]}


@pytest.mark.parametrize("size,slide", [(1, 1), (5, 1), (4, 4), (7, 3), (3, 7), (8, 4), (9, 2)])
@pytest.mark.parametrize("task_rows", [10**6, 20])
def test_against_model(spark, size, slide, task_rows):
    signals = random_signals(20, 120, seed=size * 31 + slide)
    signals["long"] = [float(i % 17) for i in range(900)]  # most of all rows
    df = count_window_arrays(samples(spark, signals), size, slide, task_rows=task_rows)
    assert got(df) == expected(signals, size, slide)


def test_given_index(spark):
    signals = random_signals(10, 60, seed=5)
    indexed = dense_index(samples(spark, signals), ["signame"], ["ts", "tie"], "i")
    assert got(count_window_arrays(indexed, 6, 4, idx="i")) == expected(signals, 6, 4)


def test_times_run_parallel(spark):
    row = count_window_arrays(samples(spark, {"a": range(6)}), 4, 2).where("k = 3").first()
    assert row.ecg == [2, 3, 4, 5]
    assert [t.microsecond // 1000 for t in row.times] == [2, 3, 4, 5]


def test_rows_and_collect_are_inverse(spark):
    df = count_window_arrays(samples(spark, random_signals(5, 50, seed=2)), 6, 3)
    back = window_collect(window_rows(df))
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    rows = count_window(samples(spark, {"a": range(4)}), 4, 4).collect()
    assert sorted((r.k, r.pos, r.value) for r in rows) == [(1, i, float(i)) for i in range(4)]


@pytest.mark.parametrize("task_rows", [10**6, 50])
def test_dense_index(spark, task_rows):
    signals = random_signals(15, 40, seed=9)
    signals["hot"] = range(700)
    df = dense_index(samples(spark, signals), ["signame"], ["ts", "tie"], "i", task_rows)
    assert df.where("i != tie").count() == 0
    assert df.count() == sum(map(len, signals.values()))
    whole = dense_index(samples(spark, signals), [], ["signame", "tie"], "i", task_rows).collect()
    assert [r.i for r in sorted(whole, key=lambda r: (r.signame, r.tie))] == list(range(len(whole)))


def test_range_path_survives_null_keys_and_equal_times(spark):
    rows = spark.range(300).select(
        F.when(F.col("id") % 3 > 0, "k").alias("signame"), F.lit(1).alias("ts"), F.col("id").alias("tie")
    )
    df = dense_index(rows, ["signame"], ["ts", "tie"], "i", task_rows=10)
    counts = {r.signame: (r["n"], r.lo, r.hi) for r in df.groupBy("signame").agg(
        F.count_distinct("i").alias("n"), F.min("i").alias("lo"), F.max("i").alias("hi")).collect()}
    assert counts == {"k": (200, 0, 199), None: (100, 0, 99)}


def test_group_load(spark):
    load = group_load(samples(spark, {"a": range(90), "b": range(10)}), ["signame"])
    assert (load.rows, load.groups, load.largest) == (100, 2, 90)
    assert not load.balanced(8)


def test_small_tasks_ask_for_bounded_partitions(spark):
    assert partitions_for(spark, 100_000, 500) == 200
    assert partitions_for(spark, 6_000_000, 500) == partitions_for(spark, 36_000_000, 500) == 2_048
    assert partitions_for(spark, 100_000_000, 500) == 5_000
    assert partitions_for(spark, 10_000_000_000) == 5_000
    assert partitions_for(spark, 10**12) == 32_768


def test_identities(spark):
    df = samples(spark, {"a": range(50), "b": range(20)})
    for same in (rebalance(df, 5), key_by(df), watermark(df)):
        assert sorted(map(repr, same.collect())) == sorted(map(repr, df.collect()))
    assert rebalance(df, 5).rdd.getNumPartitions() == 5


def test_bad_arguments(spark):
    with pytest.raises(ValueError):
        count_window_arrays(samples(spark, {"a": [1]}), 0, 1)


def test_samples_cross_one_shuffle(spark):
    """With a given index nothing but the lane shuffle moves samples."""
    indexed = samples(spark, {"a": range(40)}).withColumn("i", F.col("tie"))
    plan = count_window_arrays(indexed, 8, 4, idx="i")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
