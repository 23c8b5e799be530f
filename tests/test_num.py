import math

from pyspark.sql import functions as F

from valuora.functions.num import (clean_inf, false_if_null, ieee_div, nan_to_null,
                                   null_first_min, null_if_zero, positive_or_null, round2)


def test_ieee_division(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 0.0), (1.0, None),
                                (6.0, 3.0)], "n double, d double")
    out = [r[0] for r in df.select(ieee_div(F.col("n"), F.col("d"))).collect()]
    assert out[0] == math.inf and out[1] == -math.inf
    assert out[2] is None and out[3] is None and out[4] is None
    assert out[5] == 2.0


def test_round2_is_half_even_like_numpy(spark):
    vals = [2.675, 0.125, 0.285, 1.005, -0.125]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(round2(F.col("x"))).collect()]
    assert got == [2.68, 0.12, 0.28, 1.0, -0.12]


def test_python_min_asymmetry(spark):
    df = spark.createDataFrame([(None, 5.0), (5.0, None), (3.0, 4.0)], "a double, b double")
    got = [r[0] for r in df.select(null_first_min(F.col("a"), F.col("b"))).collect()]
    assert got == [None, 5.0, 3.0]


def test_inf_nan_cleaning(spark):
    df = spark.createDataFrame([(math.inf,), (-math.inf,), (float("nan"),), (1.5,), (None,)],
                               "x double")
    got = [r[0] for r in df.select(clean_inf(F.col("x"))).collect()]
    assert got == [None, None, None, 1.5, None]
    got = [r[0] for r in df.select(nan_to_null(F.col("x"))).collect()]
    assert got[2] is None and got[0] == math.inf


def test_zero_null_positive_and_flags(spark):
    df = spark.createDataFrame([(0.0,), (-2.0,), (3.0,), (None,)], "x double")
    assert [r[0] for r in df.select(null_if_zero(F.col("x"))).collect()] == [None, -2.0, 3.0, None]
    assert [r[0] for r in df.select(positive_or_null(F.col("x"))).collect()] == [None, None, 3.0, None]
    got = [r[0] for r in df.select(false_if_null(F.col("x") >= 0)).collect()]
    assert got == [True, False, True, False]
