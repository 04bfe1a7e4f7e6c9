"""Plan helpers: one-row attach, bounded broadcast, materialisation."""

from pyspark.sql import functions as F

from panelforge.operators.common import attach_row, materialize, maybe_broadcast
from panelforge.session import shared_root


def test_attach_row_is_a_scalar_subquery_and_nulls_when_empty(spark):
    df = spark.range(5)
    one = spark.range(10).agg(F.max("id").alias("mx"))
    out = attach_row(df, one)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Subquery" in plan
    assert [r.mx for r in out.collect()] == [9] * 5
    empty = spark.range(10).filter("id < 0").select(F.col("id").alias("v"))
    assert [r.v for r in attach_row(df, empty).collect()] == [None] * 5


def test_materialize_writes_below_shared_folder(spark):
    m = materialize(spark.range(3))
    files = m.inputFiles()
    root = shared_root(spark).replace("file:", "")
    assert files and all(root in f for f in files) and m.count() == 3


def test_maybe_broadcast_respects_bound(spark):
    small = maybe_broadcast(spark.range(3), 10)
    big = maybe_broadcast(spark.range(30), 10)
    j_small = spark.range(100).join(small, "id")._jdf.queryExecution().logical().toString()
    j_big = spark.range(100).join(big, "id")._jdf.queryExecution().logical().toString()
    assert "broadcast" in j_small.lower() and "broadcast" not in j_big.lower()
