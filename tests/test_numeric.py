import math

from pyspark.sql import functions as F

from millstat.functions.keys import surrogate_key
from millstat.functions.numeric import exact_avg, exact_sum, half_up, least_strict, round_to_int


def test_half_up_rounds_away_from_zero(spark):
    df = spark.createDataFrame([(0.125,), (-0.125,), (2.5,), (-2.5,), (1.234,), (None,)], "x double")
    got = [r[0] for r in df.select(half_up("x", 2)).collect()]
    assert got[:2] == [0.13, -0.13]
    assert got[4] == 1.23 and got[5] is None
    ints = [r[0] for r in df.select(half_up("x", 0)).collect()]
    assert ints[2:4] == [3.0, -3.0]


def test_half_up_has_no_negative_zero(spark):
    v = spark.createDataFrame([(-0.001,)], "x double").select(half_up("x", 2)).first()[0]
    assert v == 0.0 and math.copysign(1.0, v) == 1.0


def test_exact_sum_and_avg_are_order_free(spark):
    vals = [(0.1,), (0.2,), (0.3,), (None,)] * 50
    df = spark.createDataFrame(vals, "x double").repartition(7)
    s, a = df.agg(exact_sum("x", 2), exact_avg("x", 2)).first()
    assert s == 30.0
    assert a == 0.2


def test_least_strict_is_null_on_any_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0)], "a double, b double")
    got = [r[0] for r in df.select(least_strict("a", "b")).collect()]
    assert got == [1.0, None]


def test_round_to_int_half_away(spark):
    df = spark.createDataFrame([(2.4,), (2.5,), (-2.5,)], "x double")
    assert [r[0] for r in df.select(round_to_int("x")).collect()] == [2, 3, -3]


def test_surrogate_key_distinguishes_null_from_empty(spark):
    df = spark.createDataFrame([(None, "a"), ("", "a")], "k string, v string")
    keys = [r[0] for r in df.select(surrogate_key(df, "k", "v")).collect()]
    assert keys[0] != keys[1]
    assert all(len(k) == 32 for k in keys)


def test_surrogate_key_timestamp_text(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-02 03:04:05' AS t, 'Motor_001' AS e")
    key = df.select(surrogate_key(df, "t", "e")).first()[0]
    expected = df.select(F.md5(F.lit("2024-01-02 03:04:05.000-Motor_001"))).first()[0]
    assert key == expected
