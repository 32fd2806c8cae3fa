"""Exact quantiles: ranked groups, narrowed groups, odd values."""

import math
import random

import pytest
from pyspark.sql import functions as F

from graphweft.functions import aggregates as A

WANTED = {"d9": ("disc", 0.9), "m": ("cont", 0.5), "lo": ("step", 0.25), "top": ("disc", 1.0), "first": ("disc", 0.0), "c3": ("cont", 0.3)}


def plain(values, kind, q):
    v, n = sorted(values, key=lambda x: (math.isnan(x), x)), len(values)
    if kind == "disc":
        return v[max(math.ceil(n * q), 1) - 1]
    if kind == "cont":
        spot = (n - 1) * q
        a, b = v[math.floor(spot)], v[math.ceil(spot)]
        return a + (b - a) * (spot - math.floor(spot))
    return (v[max(math.ceil(n * q), 1) - 1] + v[min(math.floor(n * q) + 1, n) - 1]) / 2


@pytest.mark.parametrize("chunk", [None, 1, 7, 60])
def test_against_sorted_lists(spark, chunk):
    rng = random.Random(5)
    shapes = {
        "even": [rng.uniform(-5, 5) for _ in range(150)], "steep": [10.0 ** rng.uniform(-300, 300) for _ in range(90)],
        "same": [4.5] * 70, "few": [rng.choice([1.0, 2.0, 2.0, 8.0]) for _ in range(120)], None: [rng.gauss(0, 1) for _ in range(80)], "one": [3.0],
        "huge": [rng.choice([-1, 1]) * rng.uniform(1e307, 1.7e308) for _ in range(40)],
    }
    data = [(g, x) for g, values in shapes.items() for x in values] + [("void", None)]
    rng.shuffle(data)
    got = {r.g: r for r in A.quantiles(spark.createDataFrame(data, "g string, x double"), ["g"], "x", chunk, **WANTED).collect()}
    assert got.keys() == shapes.keys()
    for g, values in shapes.items():
        for name, (kind, q) in WANTED.items():
            if g != "huge" or kind == "disc":  # sums of huge values are not finite
                assert got[g][name] == pytest.approx(plain(values, kind, q), rel=1e-12), (g, name)


def test_infinite_and_missing_numbers(spark):
    values = [math.inf, -math.inf, math.nan, *map(float, range(50)), math.inf]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    row = A.quantiles(df, [], "x", 5, **{f"q{i}": ("disc", i / 10) for i in range(11)}).first()
    for i in range(11):
        want = plain(values, "disc", i / 10)
        assert row[f"q{i}"] == want or math.isnan(want) and math.isnan(row[f"q{i}"])


def test_other_types_and_nothing(spark):
    df = spark.createDataFrame([(i % 2, i) for i in range(100)], "g int, x int")
    whole = df.select("g", F.col("x").cast("decimal(20,2)").alias("d"), "x", F.lpad(F.col("x").cast("string"), 3, "0").alias("s"))
    for chunk in (None, 8):
        assert sorted(tuple(r) for r in A.quantiles(whole, ["g"], "x", chunk, q=("disc", 0.5)).collect()) == [(0, 48), (1, 49)]
        assert sorted((r.g, float(r.q)) for r in A.quantiles(whole, ["g"], "d", chunk, q=("disc", 0.5)).collect()) == [(0, 48.0), (1, 49.0)]
        assert sorted(tuple(r) for r in A.quantiles(whole, ["g"], "s", chunk, q=("disc", 0.5)).collect()) == [(0, "048"), (1, "049")]
        assert A.quantiles(whole.where("x < 0"), ["g"], "x", chunk, q=("cont", 0.5)).count() == 0
        assert A.quantiles(whole.where("x < 0"), [], "x", chunk, q=("cont", 0.5)).first()[0] is None
    with pytest.raises(ValueError):
        A.quantiles(df, ["g"], "x", q=("other", 0.5))


def test_rows_of_large_groups_are_not_moved(spark):
    df = spark.range(20_000).select((F.col("id") % 2).alias("g"), (F.col("id") * 7919 % 20_011).alias("x"))
    plan = A.quantiles(df, ["g"], "x", 100, q=("disc", 0.5))._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "BroadcastHashJoin" in plan
