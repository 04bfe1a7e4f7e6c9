"""Period policy and splits (golden case of the reference's policy test)."""

import pytest
from pyspark.sql import functions as F

from panelforge.operators import split as sp

POLICY = sp.PeriodPolicy.from_dict(
    {
        "policy_version": "t",
        "excluded_gameweeks": [2],
        "backfilled_but_untrusted_gameweeks": [5],
        "trusted_backfilled_gameweeks": [],
        "eligible_training_gameweeks": [1, 3, 4],
        "eligible_holdout_backtest_gameweeks": [3, 4, 5, 6],
    }
)


def _frame(spark):
    rows = [(p, g - 1, g, float(p + g)) for p in (1, 2, 3) for g in range(1, 7)]
    return spark.createDataFrame(rows, "player_id int, gameweek_id int, target_gameweek_id int, target_next_gw_points double")


def test_policy_split_hand_derived(spark):
    out = sp.policy_split(_frame(spark), POLICY, holdout=2)
    roles = {r.role: sorted(set(x.target_gameweek_id for x in out.filter(F.col("role") == r.role).collect()))
             for r in out.select("role").distinct().collect()}
    assert roles == {"holdout": [4, 6], "train": [1, 3]}
    # rows conserved: every kept row has exactly one role
    assert out.count() == 3 * 4


def test_effective_exclusions_and_classify(spark):
    assert POLICY.effective_excluded() == [2, 5]
    ex = sorted(r.week for r in sp.effective_exclusions_frame(spark, POLICY).collect())
    assert ex == [2, 5]
    df = spark.createDataFrame([(2,), (5,), (6,)], "gameweek_id int")
    st = [r.status for r in sp.classify_periods(df, POLICY).orderBy("gameweek_id").collect()]
    assert st == ["excluded", "backfilled_untrusted", "trusted"]


def test_policy_lists_validated():
    with pytest.raises(ValueError):
        sp.PeriodPolicy.from_dict({"excluded_gameweeks": [0]})
    p = sp.PeriodPolicy.from_dict({"excluded_gameweeks": [3, 1, 3]})
    assert p.excluded_gameweeks == (1, 3)


def test_temporal_split_needs_more_periods(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], "player_id int, target_gameweek_id int")
    with pytest.raises(Exception):
        sp.temporal_split(df, holdout=2).collect()
    ok = sp.temporal_split(df, holdout=1).orderBy("target_gameweek_id").collect()
    assert [r.role for r in ok] == ["train", "holdout"]


def test_recent_periods_no_error(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], "player_id int, target_gameweek_id int")
    assert sp.recent_periods(df, 5).count() == 2


def test_expanding_folds_shape(spark):
    df = spark.createDataFrame([(w,) for w in range(1, 13)], "target_gameweek_id int")
    f = sp.expanding_folds(df, n_splits=5).collect()
    tests = {r.fold: sorted(x.week for x in f if x.fold == r.fold and x.role == "test") for r in f}
    assert tests[0] == [3, 4] and tests[4] == [11, 12]
    assert max(x.week for x in f if x.fold == 0 and x.role == "train") == 2


def test_strict_temporal_drops_train_after_holdout(spark):
    pol = sp.PeriodPolicy.from_dict({"eligible_holdout_backtest_gameweeks": [3, 4]})
    out = sp.policy_split(_frame(spark), pol, holdout=1, strict_temporal=True)
    train = sorted(set(r.target_gameweek_id for r in out.filter(F.col("role") == "train").collect()))
    hold = sorted(set(r.target_gameweek_id for r in out.filter(F.col("role") == "holdout").collect()))
    assert hold == [4] and train == [1, 2, 3]
    loose = sp.policy_split(_frame(spark), pol, holdout=1)
    assert 6 in set(r.target_gameweek_id for r in loose.filter(F.col("role") == "train").collect())


def test_a_split_with_an_empty_side_is_an_error(spark):
    import pytest

    from panelforge.operators import split as sp

    both = spark.createDataFrame([(1, "train"), (2, "holdout")], "w int, role string")
    assert sp.require_both_sides(both) is both
    for part, text in (("w = 1", "holdout"), ("w = 2", "train"), ("w = 3", "after exclusion")):
        with pytest.raises(ValueError, match=text):
            sp.require_both_sides(both.where(part))
