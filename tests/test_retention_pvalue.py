"""Applied retention, skipped refresh, exact two-sample p-values."""

from itertools import combinations

import pytest
from pyspark.sql import functions as F

from panelforge.operators import drift as dr
from panelforge.sources import snapshot as sn


def snapshots(spark, root, days):
    for d in days:
        sn.write_snapshot(spark.createDataFrame([(d, 1)], "gameweek_id int, player_id int"), root, created_at=f"2024-03-{d:02d}T00:00:00Z", source="t", query_text="q", run_id="r")
    stamp = F.regexp_replace("created_at_utc", "[-:Z]", "")
    return sn.read_manifests(spark, root).select(F.concat(F.lit("v="), stamp).alias("version"), "created_at_utc")


def test_versions_on_disk_equal_the_plan(spark, tmp_path):
    root = str(tmp_path / "snap")
    plan = sn.retention_plan(snapshots(spark, root, range(1, 6)), keep=2, preserve="v=20240302T000000").persist()
    keep = sorted(r.version for r in plan.collect() if r.keep)
    (tmp_path / "snap" / "notes").mkdir()
    assert len(sn.apply_retention(spark, root, plan, dry_run=True)) == 2 and len(sn.versions_on_disk(spark, root)) == 6
    # a run that stopped in the middle is repeated
    spark._jvm.org.apache.hadoop.fs.FileSystem.getLocal(spark._jsc.hadoopConfiguration()).delete(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/v=20240301T000000"), True)
    assert sn.apply_retention(spark, root, plan, preserve="v=20240302T000000") == ["v=20240301T000000", "v=20240303T000000"]
    assert sorted(sn.versions_on_disk(spark, root)) == sorted([*keep, "notes"]) and sorted(sn.versions_on_disk(spark, f"{root}/_manifests")) == keep
    assert sn.apply_retention(spark, root, plan) == []
    foreign = spark.createDataFrame([("../../x", False), ("", False), (keep[0], True), (keep[1], False)], "version string, keep boolean")
    assert sn.apply_retention(spark, root, foreign, preserve=keep[1]) == [] and len(sn.versions_on_disk(spark, root)) == 4
    with pytest.raises(ValueError):
        sn.apply_retention(spark, root, foreign.filter("not keep"))


def test_fresh_snapshots_are_not_refreshed(spark, tmp_path):
    root, calls = str(tmp_path / "snap"), []
    assert sn.refresh_snapshot(spark, root, "2024-03-01 00:00:00", lambda: calls.append(0))
    snapshots(spark, root, [1])
    assert not sn.refresh_snapshot(spark, root, "2024-03-02 00:00:00", lambda: calls.append(1))
    assert sn.refresh_snapshot(spark, root, "2025-03-02 00:00:00", lambda: calls.append(2)) and calls == [0, 2]


def test_exact_p_value_counts_every_arrangement(spark):
    for n, m in ((1, 1), (3, 4), (5, 5), (6, 2)):
        found = []
        for left in combinations(range(n + m), n):
            a, top = 0, 0.0
            for k in range(n + m):
                a += k in left
                top = max(top, abs(a / n - (k + 1 - a) / m))
            found.append(top)
        levels = sorted(set(found))
        df = spark.createDataFrame([(d, n, m) for d in levels], "d double, n long, m long")
        got = {r.d: r.p for r in df.select("d", dr.ks_p_value(F.col("d"), F.col("n"), F.col("m")).alias("p")).collect()}
        for d in levels:
            assert abs(got[d] - sum(f >= d - 1e-12 for f in found) / len(found)) < 1e-12
    big = spark.createDataFrame([(0.1, 5000, 70), (0.25, 100, 100)], "d double, n long, m long")
    rows = big.select(dr.ks_method(F.col("n"), F.col("m")).alias("how"), dr.ks_p_value(F.col("d"), F.col("n"), F.col("m")).alias("p")).collect()
    assert [r.how for r in rows] == ["asymptotic", "exact"] and abs(rows[1].p - 0.0036) < 4e-4
