import datetime as dt
import random

from beatline.schemas import SAMPLES

T0 = dt.datetime(2024, 1, 1)


def sample_rows(signals):
    """{name: values} to SAMPLES rows, one sample per millisecond, shuffled."""
    rows = [
        (name, T0 + dt.timedelta(milliseconds=i), i, float(x))
        for name, xs in signals.items()
        for i, x in enumerate(xs)
    ]
    random.Random(0).shuffle(rows)
    return rows


def samples(spark, signals):
    return spark.createDataFrame(sample_rows(signals), SAMPLES)


def pos_rows(spark, signals):
    rows = [(name, i, float(x)) for name, xs in signals.items() for i, x in enumerate(xs)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "g string, pos bigint, value double")


def random_signals(count, longest, seed, levels=(0.0, 0.25, 0.5, 0.75, 1.0, 1.5)):
    """Arrays with many ties, of lengths 1 … longest."""
    rng = random.Random(seed)
    return {f"s{i}": [rng.choice(levels) for _ in range(rng.randint(1, longest))] for i in range(count)}


def by_group(df, *cols):
    """{group: [tuple of cols]} in pos order of the first column."""
    out = {}
    for row in df.select("g", *cols).collect():
        out.setdefault(row[0], []).append(tuple(row[1:]))
    return {g: sorted(v) for g, v in out.items()}
