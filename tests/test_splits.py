"""Running sums and minima do not depend on the number of splits."""

import math
import random

import pytest
from pyspark.sql import functions as F

from panelforge.operators import ranking as rk
from panelforge.operators.common import attach_row


def rows():
    rng = random.Random(4)
    out = [(g, math.exp(rng.gauss(0, 4)), rng.randrange(9)) for g in ("a", "b", None) for _ in range(300)]
    return out + [(g, v, 2) for g in ("a", None) for v in (None, math.nan, math.inf, -math.inf, 0.0)] + [("c", 1.0, 1), ("d", None, 5)]


def key(r):
    return str(r[0]), r[1] is not None, math.nan if r[1] is None else r[1]


def text(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("buckets", [2, 7, 40])
def test_prefix_sums_and_minima(spark, buckets):
    df = spark.createDataFrame(rows(), "g string, v double, n int").groupBy("g", "v").agg(F.sum("n").alias("n")).persist()
    one = rk.prefix_sums(df, ["g"], "v", ["n"], 1)
    assert text(rk.prefix_sums(df, ["g"], "v", ["n"], buckets).select(one.columns)) == text(one)
    assert one.count() == df.count()
    for exclusive in (False, True):
        m = rk.prefix_min(df, ["g"], "v", "n", "m", 1, exclusive)
        assert text(rk.prefix_min(df, ["g"], "v", "n", "m", buckets, exclusive).select(m.columns)) == text(m)
    flat = df.where("g = 'a'").select("v", "n")
    assert text(rk.prefix_min(flat, [], "v", "n", "m", buckets)) == text(rk.prefix_min(flat, [], "v", "n", "m", 1))


def test_splits_are_even_on_a_lognormal_column(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([("g", math.exp(rng.gauss(0, 4))) for _ in range(20000)], "g string, v double")
    sizes = [r["count"] for r in rk._split(df, ["g"], "v", 64).groupBy("__b").count().collect()]
    assert len(sizes) == 64 and max(sizes) < 2 * 20000 / 64


def test_a_table_of_two_rows_is_no_row(spark):
    with pytest.raises(Exception):
        attach_row(spark.range(2), spark.range(2).toDF("x")).collect()
