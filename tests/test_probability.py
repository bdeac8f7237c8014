import math

import pytest
from pyspark.sql import functions as F

from trialspark.functions import probability as P


def test_normal_cdf_matches_erfc(spark):
    zs = [-38.0, -7.5, -5.0, -1.5, -0.3, 0.0, 0.2, 1.0, 3.3, 6.0, 9.0]
    rows = spark.createDataFrame([(z,) for z in zs], "z double").select("z", P.normal_cdf(F.col("z")).alias("p")).collect()
    for r in rows:
        assert r.p == pytest.approx(0.5 * math.erfc(-r.z / math.sqrt(2)), rel=1e-7, abs=1e-15)


def test_null_and_nan_give_null(spark):
    rows = spark.createDataFrame([(None,), (float("nan"),)], "z double").select(P.normal_cdf(F.col("z")).alias("p")).collect()
    assert [r.p for r in rows] == [None, None]


@pytest.mark.parametrize(
    "f, m, n, want",
    [(1.0, 5.0, 10.0, 0.465119426537), (2.5, 3.0, 7.0, 0.143509456279), (4.0, 1.0, 1.0, 0.295167235301), (0.0, 3.0, 3.0, 1.0)],
)
def test_f_tail(spark, f, m, n, want):
    df = spark.createDataFrame([(f, m, n)], "f double, m double, n double")
    got = df.select(P.f_sf(F.col("f"), F.col("m"), F.col("n")).alias("p")).first().p
    assert got == pytest.approx(want, abs=1e-10)


def test_f_tail_of_impossible_degrees_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0, 3.0), (None, 2.0, 3.0)], "f double, m double, n double")
    values = [r.p for r in df.select(P.f_sf(F.col("f"), F.col("m"), F.col("n")).alias("p")).collect()]
    assert all(v is None or math.isnan(v) for v in values)


@pytest.mark.parametrize("df, want", [(1, 12.706204736), (2, 4.302652730), (5, 2.570581836), (30, 2.042272456), (10000, 1.960201240)])
def test_t_quantile(spark, df, want):
    got = spark.createDataFrame([(float(df),)], "n double").select(P.t_quantile(0.975, F.col("n")).alias("t")).first().t
    assert got == pytest.approx(want, abs=1e-8)


@pytest.mark.parametrize("x, n, want", [(3.0, 5, 0.699985835879), (7.5, 3, 0.057558451973), (12.0, 1, 0.000532005505), (40.0, 60, None), (90.0, 60, None)])
def test_chi_square_tail(spark, x, n, want):
    if want is None:  # an even number of degrees has a finite Poisson sum
        want = math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(n // 2))
    got = spark.createDataFrame([(x, float(n))], "x double, n double").select(P.chi2_sf(F.col("x"), F.col("n")).alias("p")).first().p
    assert got == pytest.approx(want, abs=1e-6)
