"""Squad operators: feasibility on the driver data, exact best XI vs brute force."""

import itertools
import random

from pyspark.sql import functions as F

from panelforge.operators import squad as sq
from conftest import SF01


def test_best_xi_matches_enumeration(spark):
    rnd = random.Random(1)
    rows, quotas = [], dict(sq.SquadRules().quotas)
    pid = 0
    for pos, n in quotas.items():
        for _ in range(n):
            rows.append((1, pid, pos, pid % 10, 5.0, float(rnd.randrange(0, 100)) / 7.0))
            pid += 1
    df = spark.createDataFrame(rows, "g int, player_id int, position_id int, team_id int, now_cost double, score double")
    xi = sq.best_xi(df, ["g"], "score").collect()
    got = sum(r.score for r in xi if r.is_starter)
    mins = dict(sq.SquadRules().xi_min)
    best = 0.0
    for combo in itertools.combinations(rows, 11):
        cnt = {p: sum(1 for r in combo if r[2] == p) for p in quotas}
        if all(cnt[p] >= mins[p] for p in mins):
            best = max(best, sum(r[5] for r in combo))
    assert abs(got - best) < 1e-9
    caps = [r for r in xi if r.is_captain]
    assert len(caps) == 1 and caps[0].score == max(r.score for r in xi if r.is_starter)


def test_budgeted_squads_are_feasible(spark):
    import __spark_entry__ as E

    checks = E.queries()["squad_feasibility"](spark, SF01)
    assert checks.count() > 0
    assert checks.filter(~F.col("feasible")).count() == 0


def test_transfer_cost(spark):
    new = spark.createDataFrame([(1, i) for i in range(15)], "g int, player_id int")
    old = spark.createDataFrame([(1, i) for i in range(3, 18)], "g int, player_id int")
    r = sq.transfer_cost(new, old, ["g"]).collect()[0]
    assert r.transfers == 3.0 and r.transfer_penalty == 12.0 and r.within_limit


def test_formations_include_two_keepers():
    f = sq.formations()
    assert (2, 3, 5, 1) in f and all(sum(x) == 11 for x in f) and (1, 4, 4, 2) in f


def _legal(rows, rules=sq.SquadRules()):
    by_seg = {p: sum(r.position_id == p for r in rows) for p, _ in rules.quotas}
    teams = [r.team_id for r in rows]
    assert by_seg == dict(rules.quotas) and max(teams.count(t) for t in teams) <= rules.max_per_team
    assert sum(r.now_cost for r in rows) <= rules.budget + 1e-9


def test_a_feasible_group_always_has_a_squad(spark):
    shape = "g int, player_id int, position_id int, team_id int, now_cost double, score double"
    dear = [(1, i, i % 4 + 1, i % 10, 20.0 if i < 40 else 4.0, 1000.0 + i if i < 40 else 1.0) for i in range(60, 0, -1)]
    # the best three of every team are all of one segment
    lopsided = [(2, i, 4 if i % 8 < 3 else i % 3 + 1, i // 8, 5.0, 90.0 if i % 8 < 3 else 10.0 + i % 5) for i in range(64)]
    poor = [(3, i, i % 4 + 1, i, 9.0, 1.0) for i in range(60)]
    short = [(4, i, i % 3 + 1, i, 4.0, 1.0) for i in range(30)]
    df = spark.createDataFrame(dear + lopsided + poor + short, shape)
    squads = sq.budgeted_squad(df, ["g"], "score").persist()
    by = {g: [r for r in squads.collect() if r.g == g] for g in (1, 2, 3, 4)}
    for g in (1, 2):
        assert len(by[g]) == 15
        _legal(by[g])
    assert sum(r.score for r in by[1]) >= 2 * 1000  # two dear ones fit beside thirteen cheap ones
    assert not by[3] and not by[4]
    assert {r.g: r.status for r in sq.squad_status(df, squads, ["g"]).collect()} == {
        1: "ok", 2: "ok", 3: "no legal squad within the budget", 4: "too few candidates"}


def test_cheapest_flow_equals_brute_force():
    rules = sq.SquadRules(budget=100, squad_size=3, quotas=((1, 1), (2, 2)), max_per_team=1)
    rnd = random.Random(0)
    for _ in range(60):
        n = rnd.randrange(4, 9)
        rows = [(rnd.choice((1, 2)), rnd.randrange(4), rnd.uniform(-5, 5)) for _ in range(n)]
        best = None
        for c in itertools.combinations(range(n), 3):
            if sorted(rows[i][0] for i in c) == [1, 2, 2] and len({rows[i][1] for i in c}) == 3:
                w = sum(rows[i][2] for i in c)
                best = w if best is None else min(best, w)
        got = sq._cheapest_flow([r[2] for r in rows], [r[0] for r in rows], [r[1] for r in rows], rules)
        assert (not got) if best is None else abs(sum(rows[i][2] for i in got) - best) < 1e-9


def test_penalties_pick_the_same_rows_without_dominated_ones(spark):
    rnd = random.Random(4)
    inf, nan = float("inf"), float("nan")
    odd = [None, nan, inf, -inf]
    rows = [(g, p, p % 4 + 1, rnd.randrange(3), rnd.choice([4.0, 4.5, 5.0, rnd.random() * 9]), rnd.choice([1.0, 2.0, rnd.random() * 8])) for g in range(2) for p in range(400)]
    rows += [(2, p, p % 4 + 1, 0, *(rnd.choice([5.0, *odd]) for _ in range(2))) for p in range(60)]
    rows += rows[:20]  # repeated rows
    df = spark.createDataFrame(rows, "g int, player_id int, position_id int, team_id int, now_cost double, score double").repartition(4)
    near = sq.undominated(df, ["g"], "score", "now_cost", 3, max(sq.LAMBDA_GRID), salts=4)
    assert near.columns == df.columns and near.count() < len(rows) / 4

    def picked(d):
        d = d.withColumn("lam", F.explode(F.array(*map(F.lit, sq.LAMBDA_GRID)))).withColumn("adj", F.col("score") - F.col("lam") * F.col("now_cost"))
        return sorted(map(str, sq.quota_topk(d, ["g", "lam"], "adj").collect()))

    assert picked(near) == picked(df)
