"""The joint squad against enumeration."""

import math
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from panelforge.operators.joint_squad import joint_squad
from panelforge.operators.squad import SquadRules

RULES = SquadRules(budget=30.0, squad_size=5, quotas=((1, 1), (2, 2), (3, 2)), max_per_team=2, xi_size=3, xi_min=((1, 1), (2, 1), (3, 0)))
SCHEMA = "g int, player_id long, position_id int, team_id int, now_cost double, score double, mine boolean"


def enumerate_best(rows, rules, present=None):
    """Highest objective over all legal squads and elevens, or None."""
    rows = [r for r in rows if r[4] is not None and r[5] is not None and r[3] is not None and r[2] in dict(rules.quotas)]
    best = None
    for squad in combinations(rows, rules.squad_size):
        if len({r[1] for r in squad}) < len(squad) or sum(round(r[4] * 10) for r in squad) > round(rules.budget * 10):
            continue
        if any(sum(r[2] == s for r in squad) != n for s, n in rules.quotas) or any(sum(q[3] == r[3] for q in squad) > rules.max_per_team for r in squad):
            continue
        for xi in combinations(squad, rules.xi_size):
            if any(sum(r[2] == s for r in xi) < n for s, n in rules.xi_min):
                continue
            value = sum(r[5] for r in xi) + max(r[5] for r in xi)
            if present is not None:
                value -= rules.transfer_penalty * (rules.squad_size + len(present) - 2 * len(present & {r[1] for r in squad})) / 2
            best = value if best is None else max(best, value)
    return best


def legal(rows, by_id, rules):
    squad = [by_id[r.player_id] for r in rows]
    xi = [by_id[r.player_id] for r in rows if r.is_starter]
    assert len({r[1] for r in squad}) == rules.squad_size and len(xi) == rules.xi_size and sum(r[4] for r in squad) <= rules.budget + 1e-9
    assert all(sum(r[2] == s for r in squad) == n for s, n in rules.quotas) and all(sum(r[2] == s for r in xi) >= n for s, n in rules.xi_min)
    assert all(sum(q[3] == r[3] for q in squad) <= rules.max_per_team for r in squad)
    captain = [r for r in rows if r.is_captain]
    assert len(captain) == 1 and captain[0].is_starter and sum(r.is_vice_captain for r in rows) == 1
    return sum(r[5] for r in xi) + max(r[5] for r in xi)


@pytest.mark.parametrize("transfers", [False, True])
def test_equals_enumeration(spark, transfers):
    rng, table = random.Random(5), []
    for g in range(14):
        for p in range(14):
            table.append((g if g else None, p, rng.choice([1, 2, 2, 3, 3]), rng.randrange(5), rng.randrange(30, 90) / 10, rng.choice([rng.uniform(-2, 9), float(rng.randrange(6))]), rng.random() < 0.3))
    table += [(1, 99, 9, 1, 4.0, 50.0, False), (1, 98, 2, None, 4.0, 50.0, False), (1, 97, 2, 1, None, 50.0, True), (1, 96, 2, 1, 4.0, None, False), (2, 0, 1, 0, 4.0, -50.0, False), (20, 1, 1, 1, 4.0, 1.0, True)]
    df = spark.createDataFrame(table, SCHEMA)
    rows = joint_squad(df, ["g"], "score", rules=RULES, current=F.col("mine") if transfers else None).collect()
    found = {}
    for r in rows:
        found.setdefault(r.g, []).append(r)
    for g in {r[0] for r in table}:
        own = [r for r in table if r[0] == g]
        present = {r[1] for r in own if r[6]} if transfers else None
        best = enumerate_best(own, RULES, present)
        assert (best is None) == (g not in found), g
        if best is not None:
            by_id = {r[1]: r for r in sorted(own, key=lambda r: (r[5] is not None, r[5] or 0)) if r[5] is not None}
            points = legal(found[g], by_id, RULES)
            assert all(math.isclose(r.objective, best, abs_tol=1e-6) and r.gap == 0 for r in found[g]), (g, best, found[g][0].objective)
            if not transfers:
                assert math.isclose(points, best, abs_tol=1e-6)


def test_empty_table(spark):
    assert joint_squad(spark.createDataFrame([], SCHEMA), ["g"], "score", rules=RULES).collect() == []
