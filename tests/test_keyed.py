import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from trialspark.operators import keyed as K


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(1)
    key = np.where(rng.random(3000) < 0.6, "hot", rng.integers(0, 30, 3000).astype(str))
    pdf = pd.DataFrame({"k": key, "x": rng.integers(0, 400, 3000).astype(float), "w": rng.random(3000)})
    return spark.createDataFrame(pdf).cache(), pdf


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_match_a_sort(skewed, descending):
    df, pdf = skewed
    got = K.running_totals(df, ["k"], "x", {"n": F.lit(1), "w": F.col("w")}, descending).toPandas()
    cells = pdf.groupby(["k", "x"]).agg(n=("w", "size"), w=("w", "sum")).reset_index().sort_values(["k", "x"], ascending=[True, not descending])
    cells["cum_n"], cells["cum_w"] = cells.groupby("k")["n"].cumsum(), cells.groupby("k")["w"].cumsum()
    both = got.merge(cells, on=["k", "x"], suffixes=("", "_want"))
    assert len(both) == len(got) == len(cells)
    assert (both["cum_n"] == both["cum_n_want"]).all()
    assert np.allclose(both["cum_w"], both["cum_w_want"])


def test_group_ranks_are_mid_ranks(skewed):
    df, pdf = skewed
    got = K.group_ranks(df, ["k"], "x").toPandas()
    pdf = pdf.assign(want=pdf.groupby("k")["x"].rank(method="average"))
    both = pdf.merge(got, on=["k", "x"])
    assert np.allclose(both["rank_avg"], both["want"])


def test_salted_join_equals_join(skewed, spark):
    df, _ = skewed
    small = spark.createDataFrame([("hot", 1), ("3", 2), ("none", 3)], "k string, v int")
    assert K.salted_join(df, small, ["k"], ["x"]).count() == df.join(small, "k").count()
    assert K.salted_join(df, small, ["k"], ["x"], key_rows=3).count() == df.join(small, "k").count()


def test_joins_with_many_pairs_are_dealt_out_by_pairs(spark):
    big = spark.createDataFrame([(k, x) for k in (1, 2, None) for x in range(300 if k == 1 else 3)], "k int, x int")
    small = spark.createDataFrame([(k, y) for k in (1, 3, None) for y in range(50)], "k int, y int")
    for how in ("inner", "left"):
        out = K.paired_join(big, small, ["k"], ["x"], how, pairs_at_once=1000)
        assert sorted(out.collect(), key=str) == sorted(big.join(small, "k", how).collect(), key=str)
        sizes = sorted(out.rdd.glom().map(len).collect())
        assert len(sizes) == 16 and sizes[-1] <= 6000 and out.count() >= 15_000
    assert K.paired_join(big.filter("k = 5"), small, ["k"], ["x"]).count() == 0


def test_top_per_key_limits_before_the_shuffle(skewed):
    df, _ = skewed
    out = K.top_per_key(df, ["k"], ["-x", "w"], 2, rank_col="r")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert out.groupBy("k").count().agg(F.max("count")).first()[0] <= 2


@pytest.fixture
def ranges(spark):
    """Sets the number of ranges that rows are dealt out to, small as they are."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {n: spark.conf.get(n) for n in names}
    yield lambda n: (spark.conf.set(names[0], n), spark.conf.set(names[1], False))
    for n, v in before.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize("blocks", [2, 8])
def test_fill_in_order_matches_pandas(spark, blocks, ranges):
    ranges(blocks)
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"k": np.where(rng.random(500) < 0.5, "a", "b"), "o": rng.permutation(500), "v": np.where(rng.random(500) < 0.8, np.nan, rng.random(500))})
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    got = K.fill_in_order(df, ["k"], ["o"], ["v"]).toPandas().sort_values("o")
    want = pdf.sort_values("o")
    want = want.assign(v=want.groupby("k")["v"].transform(lambda s: s.ffill().bfill()))
    assert np.allclose(got["v"].to_numpy(dtype=float), want["v"].to_numpy(dtype=float))


def test_fill_by_date_and_text(spark, ranges):
    ranges(4)
    day = datetime.date(2020, 1, 1)
    rows = [("a", day + datetime.timedelta(i), f"t{i:02d}", None if i % 3 else i) for i in range(20)]
    df = spark.createDataFrame(rows, "k string, d date, t string, v int")
    for order in ("d", "t"):
        got = [r.v for r in K.fill_in_order(df, ["k"], [order], ["v"]).orderBy("t").collect()]
        assert got == [i - i % 3 for i in range(20)]


def test_numbered_counts_in_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("x"))
    rows = K.numbered(df, ["x"], "n").orderBy("x").collect()
    assert [r.n for r in rows] == list(range(1, 1001))


def test_null_keys_meet(spark):
    df = spark.createDataFrame([(None, 1.0), ("a", 2.0), (None, 3.0)], "k string, v double")
    out = K.with_group_values(df, ["k"], total=F.sum("v")).orderBy("v").collect()
    assert [r.total for r in out] == [4.0, 2.0, 4.0]
