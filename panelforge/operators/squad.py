"""Constrained top-k squad selection at scale.

The reference solves one small integer program per run on one machine.  Here
the same decision is made for every group (period, scenario ...) at once
with set operations:

* ``quota_topk`` (O2): at most ``max_per_team`` per (group, team), then the
  per-segment quota, both as ``row_number() <= k`` windows directly under a
  filter, so Spark applies a partial (map-side) group limit before the
  shuffle and a huge group never ships all of its rows to one task;
* ``budgeted_squad`` (O3): a grid of cost penalties lambda (score - lambda *
  cost) is exploded per row that some penalty can pick (``undominated``; no join), O2 runs per (group, lambda), and the
  feasible lambda (full quotas, cost <= budget) with the best total score wins -
  a Lagrangian heuristic, exact when lambda = 0 is feasible; groups for which
  the grid finds nothing are solved by cheapest flows with a bisected penalty;
* ``best_xi`` (O4): exact for a given squad: all legal formations are scored
  from per-segment cumulative sums in one aggregate per group;
* captain / vice (O5), bench order (O6), transfers (O7), checks (O1) and
  regret vs the oracle squad (O8) are joins and aggregates on <= 15 rows
  per group.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.operators.common import materialize
from panelforge.operators.ranking import topk


@dataclass(frozen=True)
class SquadRules:
    # Fixed values of the reference's optimisation config.
    budget: float = 100.0
    squad_size: int = 15
    quotas: tuple[tuple[int, int], ...] = ((1, 2), (2, 5), (3, 5), (4, 3))
    max_per_team: int = 3
    xi_size: int = 11
    xi_min: tuple[tuple[int, int], ...] = ((1, 1), (2, 3), (3, 2), (4, 1))
    transfer_penalty: float = 4.0
    max_transfers: int = 15


#: Shares of a group's entities that are looked through by themselves before the group is.
SALTS = 16
# Cost penalty grid for the budget search (points per unit of cost).
LAMBDA_GRID = tuple(round(0.05 * i, 2) for i in range(0, 41))


def formations(rules: SquadRules = SquadRules()) -> list[tuple[int, int, int, int]]:
    """Legal XI shapes: each segment between its minimum and its squad quota
    (so GK may be 1 or 2: the reference only sets minimums), summing to 11."""
    q = dict(rules.quotas)
    m = dict(rules.xi_min)
    out = []
    for g in range(m[1], q[1] + 1):
        for d in range(m[2], q[2] + 1):
            for mi in range(m[3], q[3] + 1):
                f = rules.xi_size - g - d - mi
                if m[4] <= f <= q[4]:
                    out.append((g, d, mi, f))
    return out


def _quota_col(segment: str, rules: SquadRules) -> Column:
    expr = None
    for s, n in rules.quotas:
        expr = F.when(F.col(segment) == s, F.lit(n)) if expr is None else expr.when(F.col(segment) == s, F.lit(n))
    return expr.otherwise(F.lit(0))


def quota_topk(df: DataFrame, group: Sequence[str], score: str, rules: SquadRules = SquadRules(),
               entity: str = "player_id", team: str = "team_id", segment: str = "position_id") -> DataFrame:
    """O2: best ``max_per_team`` per (group, team), then best quota per
    (group, segment) among those.  Ties: score desc, entity asc."""
    group = list(group)
    order = [F.col(score).desc(), F.col(entity).asc()]
    capped = topk(df, [*group, team], order, rules.max_per_team, "__rt").drop("__rt")
    max_q = max(n for _, n in rules.quotas)
    ranked = topk(capped, [*group, segment], order, max_q, "__rs")
    return ranked.filter(F.col("__rs") <= _quota_col(segment, rules)).drop("__rs")


def budgeted_squad(df: DataFrame, group: Sequence[str], score: str, cost: str = "now_cost",
                   rules: SquadRules = SquadRules(), grid: Sequence[float] = LAMBDA_GRID,
                   entity: str = "player_id", team: str = "team_id", segment: str = "position_id") -> DataFrame:
    """O3: squad per group under the budget.  Returns the chosen squad rows
    with ``lam`` (the penalty used).

    A group for which no penalty of the grid gives a legal squad is solved by
    itself (``_legal_squads``), so a group is missing only if it has no legal
    squad within the budget; ``squad_status`` names those.
    """
    group = list(group)
    cols = df.columns
    near = undominated(df, group, score, cost, rules.max_per_team, max(grid), entity, team) if min(grid) >= 0 else df
    lam = near.withColumn("lam", F.explode(F.array(*[F.lit(float(x)) for x in grid])))
    lam = lam.withColumn("__adj", F.col(score) - F.col("lam") * F.col(cost))
    sq = quota_topk(lam, [*group, "lam"], "__adj", rules, entity, team, segment)
    per = sq.groupBy(*group, "lam").agg(
        F.count(F.lit(1)).alias("__n"), F.sum(cost).alias("__cost"), F.sum(score).alias("__total"),
        F.collect_list(F.struct(*cols)).alias("__rows"),  # at most squad_size rows
    )
    legal = (F.col("__n") == rules.squad_size) & (F.col("__cost") <= rules.budget + 1e-9)
    # totals compared at 1e-9: several penalties often give the same squad
    best = materialize(per.groupBy(*group).agg(
        F.max_by(F.struct("__rows", "lam"), F.when(legal, F.struct(F.round("__total", 9), -F.col("lam")))).alias("__best")))
    found = best.where("__best IS NOT NULL").select(F.explode("__best.__rows").alias("__r"), F.col("__best.lam").alias("lam")).select("__r.*", "lam")
    missing = best.where("__best IS NULL").select(*group)
    if missing.isEmpty():
        return found
    return found.unionByName(_legal_squads(df.join(missing, group, "left_semi"), group, score, cost, rules, entity, team, segment))


def undominated(df: DataFrame, group: Sequence[str], score: str, cost: str, k: int, most: float, entity: str = "player_id", team: str = "team_id",
                salts: int = SALTS) -> DataFrame:
    """``df`` without rows that are not among the best ``k`` of their (group, team) by score - lam * cost (ties:
    entity asc) for any lam from 0 to ``most``: ``k`` others score more and cost no more, or have the same score and
    cost and come before.  Scores that differ by rounding only are kept.  First within shares of the entities, so no
    task gets a whole group, then among what is left."""
    s, c = F.col(score).cast("double"), F.col(cost).cast("double")
    endless = F.lit(float("inf"))
    # 0: numbers; a null or NaN makes the same of every penalty; infinite ones are only compared with their likes
    kind = F.when(s.isNull() | c.isNull(), 1).when(F.isnan(s) | F.isnan(c), 2).when((F.abs(s) == endless) | (F.abs(c) == endless), 3).otherwise(0)
    rows = df.withColumns({"__kind": kind, "__salt": F.pmod(F.xxhash64(entity), F.lit(salts))})
    rows = rows.withColumns({"__s": F.when(F.col("__kind").isin(0, 3), s), "__c": F.when(F.col("__kind").isin(0, 3), c)})
    for parts in ([*group, team, "__kind", "__salt"], [*group, team, "__kind"]):
        rows = topk(rows, [*parts, "__c", "__s"], [F.col(entity).asc()], k, "__same").drop("__same")
        cheaper = Window.partitionBy(*parts).orderBy(F.col("__c").asc(), F.col("__s").desc(), F.col(entity).asc()).rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("__left", F.col("__s"))
        for _ in range(k - 1):
            # those above all cheaper ones make a layer; the best of the k-th layer has k - 1 others above it
            rows = rows.withColumn("__top", F.max("__left").over(cheaper)).withColumn("__left", F.when(F.col("__left") <= F.col("__top"), F.col("__left")))
        rows = rows.withColumn("__top", F.max("__left").over(cheaper))
        slack = 1e-12 * (1.0 + F.abs("__s") + most * F.abs("__c"))
        rows = rows.where((F.col("__kind") != 0) | F.col("__top").isNull() | (F.col("__s") + slack > F.col("__top")))
    return rows.select(*df.columns)


def _legal_squads(df: DataFrame, group: list[str], score: str, cost: str, rules: SquadRules, entity: str, team: str, segment: str) -> DataFrame:
    """Squads of groups that the grid leaves empty: legal squads are flows from
    segments to teams, so for any penalty the best one is a cheapest flow; the
    penalty is bisected between none and "cheapest squad" until the budget
    holds.  Only candidates that can be among a team's best three of a segment
    (by score, cost or a mix of them) reach the group's task."""
    orders = [F.col(score).desc(), F.col(cost).asc()] + [(F.col(score) - k * F.col(cost)).desc() for k in (0.25, 1.0, 4.0)]
    w = Window.partitionBy(*group, team, segment)
    near = None
    for order in orders:
        rows = df.withColumn("__k", F.row_number().over(w.orderBy(order, F.col(entity).asc()))).where(F.col("__k") <= rules.max_per_team).drop("__k")
        near = rows if near is None else near.unionByName(rows)
    near = near.where(F.col(score).isNotNull() & F.col(cost).isNotNull()).dropDuplicates([*group, entity])

    def solve(pdf):
        pdf = pdf.sort_values(entity, ignore_index=True)
        picked, lam = _bisected(pdf[score].tolist(), pdf[cost].tolist(), pdf[segment].tolist(), pdf[team].tolist(), rules)
        return pdf.iloc[picked].assign(lam=lam)

    return near.groupBy(*group).applyInPandas(solve, near.withColumn("lam", F.lit(0.0)).schema)


def _bisected(score: list[float], cost: list[float], segment: list, team: list, rules: SquadRules) -> tuple[list[int], float]:
    def at(lam: float | None):
        weight = cost if lam is None else [lam * c - s for s, c in zip(score, cost)]
        squad = _cheapest_flow(weight, segment, team, rules)
        return squad, sum(cost[i] for i in squad) <= rules.budget + 1e-9

    squad, fits = at(0.0)
    if not squad or fits:
        return squad, 0.0
    squad, fits = at(None)
    if not fits:
        return [], 0.0
    best, low, high = (squad, float("inf")), 0.0, 1.0
    while not at(high)[1] and high < 1e9:
        high *= 4
    for _ in range(30):
        mid = (low + high) / 2
        squad, fits = at(mid)
        if fits:
            high = mid
            if best[1] == float("inf") or sum(score[i] for i in squad) >= sum(score[i] for i in best[0]):
                best = (squad, mid)
        else:
            low = mid
    return _swapped(best[0], score, cost, segment, team, rules), best[1] if best[1] < float("inf") else high


def _swapped(squad: list[int], score: list[float], cost: list[float], segment: list, team: list, rules: SquadRules) -> list[int]:
    """The squad after the best single swaps within a segment, as long as one gains points and fits."""
    squad = list(squad)
    while True:
        spent, load = sum(cost[i] for i in squad), {}
        for i in squad:
            load[team[i]] = load.get(team[i], 0) + 1
        gains = [(score[j] - score[i], -j, i) for i in squad for j in range(len(score))
                 if j not in squad and segment[j] == segment[i] and score[j] > score[i] and spent - cost[i] + cost[j] <= rules.budget + 1e-9
                 and (team[j] == team[i] or load.get(team[j], 0) < rules.max_per_team)]
        if not gains:
            return sorted(squad)
        _, j, i = max(gains)
        squad[squad.index(i)] = -j


def _cheapest_flow(weight: list[float], segment: list, team: list, rules: SquadRules) -> list[int]:
    """Rows of the lightest legal squad (quota per segment, cap per team), or
    none; one unit after the other along the lightest augmenting path."""
    quotas = dict(rules.quotas)
    rows = [i for i in range(len(weight)) if segment[i] in quotas]
    used, left, load = set(), dict(quotas), {}
    while any(left.values()):
        # distance of a team over paths segment -> team -> (taken row back) segment -> ...
        dist = {("s", s): 0.0 for s in left if left[s]}
        via: dict = {}
        for _ in range(2 * (len(quotas) + len(set(team))) + 2):
            changed = False
            for i in rows:
                a, b, w = ("s", segment[i]), ("t", team[i]), weight[i]
                if i in used:
                    a, b, w = b, a, -w
                if a in dist and dist[a] + w < dist.get(b, float("inf")) - 1e-12:
                    dist[b], via[b], changed = dist[a] + w, (a, i), True
            if not changed:
                break
        ends = [(d, str(n), n) for n, d in dist.items() if n[0] == "t" and load.get(n[1], 0) < rules.max_per_team]
        if not ends:
            return []
        node = min(ends)[2]
        load[node[1]] = load.get(node[1], 0) + 1
        while node in via:
            node, i = via[node]
            used ^= {i}
        left[node[1]] -= 1
    return sorted(used)


def squad_status(df: DataFrame, squad: DataFrame, group: Sequence[str], rules: SquadRules = SquadRules(),
                 segment: str = "position_id", entity: str = "player_id") -> DataFrame:
    """One row per group of candidates: ``status`` is 'ok' or why it has no squad."""
    group = list(group)
    short = [F.count_distinct(F.when(F.col(segment) == s, F.col(entity))) < n for s, n in rules.quotas]
    few = short[0]
    for s in short[1:]:
        few = few | s
    have = squad.select(*group).distinct().withColumn("__ok", F.lit(True))
    return df.groupBy(*group).agg(few.alias("__few")).join(have, group, "left").select(
        *group, F.when(F.col("__ok"), "ok").when(F.col("__few"), "too few candidates").otherwise("no legal squad within the budget").alias("status"))


def best_xi(squad: DataFrame, group: Sequence[str], score: str, rules: SquadRules = SquadRules(),
            entity: str = "player_id", segment: str = "position_id") -> DataFrame:
    """Starters of each group's squad under the best formation, plus
    captain (best starter) and vice (second best) (O5).  Adds is_starter,
    is_captain, is_vice_captain, formation."""
    group = list(group)
    w = Window.partitionBy(*group, segment).orderBy(F.col(score).desc(), F.col(entity).asc())
    r = squad.withColumn("__k", F.row_number().over(w))  # <= 5 rows per (group, segment)
    max_q = max(n for _, n in rules.quotas)
    cs = r.groupBy(*group).agg(
        *[F.sum(F.when((F.col(segment) == s) & (F.col("__k") <= k), F.col(score)).otherwise(0.0)).alias(f"__c{s}_{k}")
          for s, _ in rules.quotas for k in range(1, max_q + 1)]
    )
    forms = F.array(*[F.struct(*[F.lit(n).alias(f"n{s}") for s, n in zip((1, 2, 3, 4), f)]) for f in formations(rules)])
    ex = cs.select(*group, *[c for c in cs.columns if c.startswith("__c")], F.explode(forms).alias("f"))

    def pick(s):
        e = F.lit(0.0)
        for k in range(1, max_q + 1):
            e = F.when(F.col(f"f.n{s}") == k, F.col(f"__c{s}_{k}")).otherwise(e)
        return e

    total = pick(1) + pick(2) + pick(3) + pick(4)
    # Ties between formations: fewer goalkeepers, then more forwards etc. by a fixed order.
    chosen = ex.withColumn("__t", total).groupBy(*group).agg(
        F.max_by(F.col("f"), F.struct(F.col("__t"), -F.col("f.n1"), F.col("f.n4"), F.col("f.n3"))).alias("f")
    )
    j = r.join(chosen, group)
    need = F.when(F.col(segment) == 1, F.col("f.n1")).when(F.col(segment) == 2, F.col("f.n2")).when(
        F.col(segment) == 3, F.col("f.n3")).otherwise(F.col("f.n4"))
    st = j.withColumn("is_starter", F.col("__k") <= need).withColumn(
        "formation", F.concat_ws("-", F.col("f.n2").cast("string"), F.col("f.n3").cast("string"), F.col("f.n4").cast("string"))
    )
    wc = Window.partitionBy(*group).orderBy(F.col("is_starter").desc(), F.col(score).desc(), F.col(entity).asc())
    st = st.withColumn("__c", F.row_number().over(wc))
    return st.withColumns(
        {"is_captain": F.col("is_starter") & (F.col("__c") == 1), "is_vice_captain": F.col("is_starter") & (F.col("__c") == 2)}
    ).drop("__k", "f", "__c")


def bench_order(picked: DataFrame, group: Sequence[str], score: str, entity: str = "player_id") -> DataFrame:
    """Squad minus starters (anti join), ordered by score."""
    group = list(group)
    starters = picked.filter("is_starter").select(*group, entity)
    bench = picked.join(starters, [*group, entity], "left_anti")
    w = Window.partitionBy(*group).orderBy(F.col(score).desc(), F.col(entity).asc())
    return bench.withColumn("bench_order", F.row_number().over(w).cast("int"))


def squad_checks(picked: DataFrame, group: Sequence[str], cost: str = "now_cost", rules: SquadRules = SquadRules(),
                 team: str = "team_id", segment: str = "position_id") -> DataFrame:
    """O1: one row per group with every rule as a boolean plus ``feasible``."""
    group = list(group)
    per_team = picked.groupBy(*group, team).agg(F.count(F.lit(1)).alias("__nt")).groupBy(*group).agg(
        F.max("__nt").alias("max_per_team")
    )
    seg_counts = {s: F.count_if(F.col(segment) == s) for s, _ in rules.quotas}
    xi_counts = {s: F.count_if((F.col(segment) == s) & F.col("is_starter")) for s, _ in rules.xi_min}
    agg = picked.groupBy(*group).agg(
        F.count(F.lit(1)).alias("squad_size"),
        F.sum(cost).alias("squad_cost"),
        F.count_if("is_starter").alias("xi_size"),
        F.count_if("is_captain").alias("n_captain"),
        F.count_if("is_vice_captain").alias("n_vice"),
        F.count_if(F.col("is_captain") & F.col("is_vice_captain")).alias("__both"),
        F.count_if((F.col("is_captain") | F.col("is_vice_captain")) & ~F.col("is_starter")).alias("__bench_cap"),
        *[c.alias(f"__q{s}") for s, c in seg_counts.items()],
        *[c.alias(f"__x{s}") for s, c in xi_counts.items()],
    ).join(per_team, group)
    q, m = dict(rules.quotas), dict(rules.xi_min)
    checks = {
        "size_ok": F.col("squad_size") == rules.squad_size,
        "quota_ok": F.lit(True),
        "team_cap_ok": F.col("max_per_team") <= rules.max_per_team,
        "budget_ok": F.col("squad_cost") <= rules.budget + 1e-9,
        "xi_size_ok": F.col("xi_size") == rules.xi_size,
        "formation_ok": F.lit(True),
        "captain_ok": (F.col("n_captain") == 1) & (F.col("n_vice") == 1) & (F.col("__both") == 0) & (F.col("__bench_cap") == 0),
    }
    for s in q:
        checks["quota_ok"] = checks["quota_ok"] & (F.col(f"__q{s}") == q[s])
    for s in m:
        checks["formation_ok"] = checks["formation_ok"] & (F.col(f"__x{s}") >= m[s])
    out = agg.withColumns(checks)
    feasible = None
    for k in checks:
        feasible = F.col(k) if feasible is None else feasible & F.col(k)
    return out.withColumn("feasible", feasible).drop(*[c for c in out.columns if c.startswith("__")])


def transfer_cost(new: DataFrame, old: DataFrame, group: Sequence[str], rules: SquadRules = SquadRules(),
                  entity: str = "player_id") -> DataFrame:
    """transfers = sum |new - old| / 2 over the union of both squads
    (full outer join on entity), penalty = 4 per transfer, limit 15."""
    group = list(group)
    n = new.select(*group, entity, F.lit(1).alias("__new"))
    o = old.select(*group, entity, F.lit(1).alias("__old"))
    j = n.join(o, [*group, entity], "full_outer")
    diff = F.abs(F.coalesce("__new", F.lit(0)) - F.coalesce("__old", F.lit(0)))
    agg = j.groupBy(*group).agg((F.sum(diff) / 2.0).alias("transfers"))
    return agg.withColumns(
        {"transfer_penalty": F.col("transfers") * rules.transfer_penalty, "within_limit": F.col("transfers") <= rules.max_transfers}
    )


def squad_summary(picked: DataFrame, group: Sequence[str], name: str = "web_name", cost: str = "now_cost",
                  segment: str = "position_id") -> DataFrame:
    """Per (group, segment) the sorted 'name (£x.xm)' list and cost."""
    group = list(group)
    label = F.format_string("%s (£%.1fm)", F.col(name), F.col(cost))
    return picked.groupBy(*group, segment).agg(
        F.array_join(F.sort_array(F.collect_list(label)), ", ").alias("players"),
        F.count(F.lit(1)).alias("n_players"),
        F.sum(cost).alias("segment_cost"),
    )


def recommendation_rows(picked: DataFrame, recommended_at: Column, period: str, score: str,
                        details: Column | None = None) -> DataFrame:
    """recommendation_key = '<player>_<ISO time>', 5-period projection,
    trust fields; details truncated to 500 characters."""
    d = details if details is not None else F.lit(None).cast("string")
    return picked.select(
        F.concat_ws("_", F.col("player_id").cast("string"), recommended_at).alias("recommendation_key"),
        F.to_timestamp(recommended_at).cast("timestamp_ntz").alias("recommended_at"),
        F.col("player_id").cast("int").alias("player_id"),
        F.col(period).cast("int").alias("gameweek_id"),
        F.col(score).alias("expected_points_next_gw"),
        (F.col(score) * 5.0).alias("expected_points_5_gw"),
        F.lit(True).alias("is_in_squad"),
        "is_starter", "is_captain", "is_vice_captain",
        F.substring(d, 1, 500).alias("backfill_validation_details"),
    )
