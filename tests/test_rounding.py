"""The rounding recipe gives bit-identical results in Spark and in the SQL
oracle, including decimal ties where the engines' own ROUND functions differ."""

from __future__ import annotations

import duckdb
import pytest
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from cardlens.functions import rounding as R
from cardlens.plans import oracle as O

TIES = [1.005, 2.675, 0.125, -0.125, 0.5, -0.5, 1.115, -2.345, 1e-9, -1e-9, 0.0, 123456.785, -0.003]


def _values(n=3000, seed=7):
    rng = np.random.default_rng(seed)
    v = np.concatenate([rng.normal(0, 1000, n), np.round(rng.normal(0, 100, n), 3), TIES])
    return [float(x) for x in v]


def test_half_away_matches_sql(spark):
    vals = _values()
    sdf = spark.createDataFrame([(i, x) for i, x in enumerate(vals)], "i INT, x DOUBLE")
    got = {r["i"]: (r["r2"], r["r0"]) for r in
           sdf.select("i", R.half_away("x", 2).alias("r2"), R.half_away("x", 0).alias("r0")).collect()}
    pdf = pd.DataFrame({"i": range(len(vals)), "x": vals})
    con = duckdb.connect()
    con.register("t", pdf)
    want = {i: (a, b) for i, a, b in con.execute(
        f"SELECT i, {O.half_away('x', 2)}, {O.half_away('x', 0)} FROM t").fetchall()}
    assert got == want
    assert got[vals.index(1.005)][0] == 1.0       # rounds the binary value, like the reference engine
    assert got[vals.index(-0.003)][0] == 0.0 and np.copysign(1, got[vals.index(-0.003)][0]) == 1


def test_ratio_and_money_match_sql(spark):
    rng = np.random.default_rng(11)
    rows = [(int(g), float(np.round(a, 3)), int(y)) for g, a, y in
            zip(rng.integers(0, 50, 4000), rng.uniform(-50, 500, 4000), rng.integers(0, 2, 4000))]
    sdf = spark.createDataFrame(rows, "g INT, a DOUBLE, y INT")
    got = {r["g"]: tuple(r)[1:] for r in sdf.groupBy("g").agg(
        R.money_avg("a").alias("avg"), R.money_sum("a").alias("sum"),
        R.ratio(F.sum("y"), F.count("y")).alias("pct")).collect()}
    con = duckdb.connect()
    con.register("t", pd.DataFrame(rows, columns=["g", "a", "y"]))
    want = {g: (a, s, p) for g, a, s, p in con.execute(
        f"SELECT g, {O.money_avg('a')}, {O.money_sum('a')}, {O.ratio('SUM(y)', 'COUNT(y)')} "
        "FROM t GROUP BY g").fetchall()}
    assert got == want


def test_money_is_rounded_once(spark):
    """The fraction of a cent of each row counts; NaN and huge amounts pass."""
    df = spark.createDataFrame([(0.004,)] * 1000 + [(31.937,)] * 1000, "a DOUBLE")
    r = df.agg(R.money_sum("a").alias("s"), R.money_avg("a").alias("m")).first()
    assert (r["s"], r["m"]) == (31941.0, 15.97)
    nan = spark.createDataFrame([(1.0,), (float("nan"),)], "a DOUBLE").agg(
        R.money_sum("a").alias("s"), R.money_avg("a").alias("m")).first()
    assert np.isnan(nan["s"]) and np.isnan(nan["m"])
    big = spark.createDataFrame([(1e30,), (1e30,)], "a DOUBLE").agg(R.money_sum("a").alias("s")).first()
    assert big["s"] == 2e30
    none = spark.createDataFrame([(None,)], "a DOUBLE").agg(R.money_sum("a").alias("s"), R.money_avg("a").alias("m")).first()
    assert none["s"] is None and none["m"] is None


def test_half_away_passes_nan_and_large_values(spark):
    vals = [float("nan"), 1e18, -1e18, float("inf"), None, -2.5]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in vals], "x DOUBLE").select(R.half_away("x", 0)).collect()]
    assert np.isnan(got[0]) and got[1:] == [1e18, -1e18, float("inf"), None, -3.0]


@pytest.mark.parametrize("amounts", [
    [0.0, 0.01], [1.0, 1.01, 1.02, 1.005] * 5, [999.999999, 1000.0] * 40, [1e9 + 0.005 * k for k in range(50)],
    [-3.25, 7.75, 1.125], [1e10, -1e10, 0.000001], [5.0], [2.5, 2.5, 2.5]])
def test_std_does_not_depend_on_the_partitions(spark, amounts):
    from fractions import Fraction
    from math import floor, isqrt

    from cardlens.functions.rounding import money_std
    micros = [round(Fraction(a).limit_denominator(10**6) * 10**6) for a in amounts]
    n, spread = len(micros), len(micros) * sum(m * m for m in micros) - sum(micros) ** 2
    want = None
    if n > 1:  # half away from zero at the second decimal, in whole numbers
        want = (isqrt(spread * 4 // (n * (n - 1)) // 10**8) + 1) // 2 / 100.0
    got = set()
    for parts in (1, 7, 64):
        df = spark.createDataFrame([(a,) for a in amounts], "a DOUBLE").repartition(parts)
        got.add(df.agg(money_std("a").alias("s")).first().s)
    assert got == {want}


def test_std_of_unusual_amounts(spark):
    from cardlens.functions.rounding import money_std
    rows = [("nan", 1.0), ("nan", float("nan")), ("big", 1e30), ("big", 3e30), ("null", None), ("null", 4.0),
            ("nulls", None), ("pair", 1.0), ("pair", None), ("pair", 2.0)]
    got = {r.g: r.s for r in spark.createDataFrame(rows, "g STRING, a DOUBLE").groupBy("g").agg(money_std("a").alias("s")).collect()}
    assert got["nan"] != got["nan"] and got["big"] == pytest.approx(2**0.5 * 1e30)
    assert got["null"] is None and got["nulls"] is None and got["pair"] == 0.71
