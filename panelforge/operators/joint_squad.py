"""The whole squad decision as one exact problem, for every group at once.

Maximise the points of the eleven that start, the captain's twice, minus the
transfer penalty, over squads that keep the quotas per segment, the cap per
team, the budget and the least numbers of starters.  A cheap bench is
therefore right: only starters count.

The table of partial squads has the key (group, squad members and starters by
segment, captain chosen, money spent) and the best value with its members.  It
grows team by team: joined with the team's options (none up to three of its
players, each on the bench, starting or captain), then a grouped maximum, then
rows that cost more for the same counts without gaining are dropped.

Rows are cut by an upper bound.  With a price on every shared constraint
(budget, quotas, eleven starters, least starters, one captain) the teams fall apart, so
the best priced option of every team makes a bound of the whole problem, and an option
that is worse than its team's best lowers the bound of every squad with it by the
difference, its ``slack``.  Any prices give a valid bound; good ones leave less
to follow.  They are looked for by a short subgradient search over the options of a
group (``prices``).  A growth follows all rows whose slacks add up to less than a width;
a group is solved if its best squad is worth at least its bound less the width, since
everything else is worth less.  Groups that aren't solved grow again, eight times as wide.
The ``gap`` column is the certificate: the bound of all that was not followed
minus the value, 0 if nothing better can exist.

A candidate is left out before that if three others of its team and segment are
no dearer and at least as good both as starter and on the bench.  Prices are
whole multiples of ``unit``.  Defined cases: null score, cost, team or segment and
segments without quota: no candidate; repeated rows of an entity in a group: the first by
score, then cost; equal values: any one of the best squads; groups without
a legal squad have no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.operators.common import materialize, maybe_broadcast
from panelforge.operators.ranking import topk
from panelforge.operators.squad import SquadRules

STEPS = 3000
#: First width as a share of the bound, teams that grow in one job, and option rows that are broadcast at most.
WIDTH, TOGETHER, BROADCAST_ROWS = 0.004, 7, 200_000
_EPS = 1e-7
BENCH, START, CAPTAIN = 0, 1, 2


class _Shape:
    """Names of the count columns for the rules' segments."""

    def __init__(self, rules: SquadRules):
        self.segments = [s for s, _ in rules.quotas]
        self.quota = [n for _, n in rules.quotas]
        least = dict(rules.xi_min)
        self.least = [least.get(s, 0) for s in self.segments]
        self.c = [f"c{k}" for k in range(len(self.segments))]
        self.s = [f"s{k}" for k in range(len(self.segments))]
        self.counts = [*self.c, *self.s, "cap"]
        self.prices = ["p_cost", *[f"p_{c}" for c in self.c], "p_xi", *[f"p_{s}" for s in self.s], "p_cap"]


def _pareto(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows for which no row of the same keys spends no more for at least the value
    (of equal rows the grouped maximum before has left one)."""
    before = Window.partitionBy(*keys).orderBy("spent").rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("__top", F.max("value").over(before))
    return rows.filter(F.col("__top").isNull() | (F.col("value") > F.col("__top") + _EPS)).drop("__top")


def _candidates(df: DataFrame, group: list[str], score: str, cost: str, rules: SquadRules, entity: str, team: str, segment: str, current: Column, unit: float) -> DataFrame:
    bonus = F.when(F.coalesce(current, F.lit(False)), F.lit(float(rules.transfer_penalty))).otherwise(F.lit(0.0))
    ok = F.col(segment).isin([s for s, _ in rules.quotas])
    for c in (score, cost, team, segment, entity):
        ok = ok & F.col(c).isNotNull()
    rows = df.filter(ok).select(*group, F.col(entity).alias("e"), F.col(team).alias("t"), F.col(segment).alias("seg"), F.col(score).cast("double").alias("v"),
                                F.round(F.col(cost) / unit).cast("long").alias("spent"), bonus.alias("bonus"))
    rows = topk(rows, [*group, "e"], [F.col("v").desc(), F.col("spent").asc(), F.col("t").asc()], 1).drop("rn")
    # a candidate with as many better ones of its team and segment as a team may have is never needed
    keys, n = [*group, "t", "seg"], rules.max_per_team
    w = Window.partitionBy(*keys).orderBy("spent", F.col("v").desc(), F.col("bonus").desc(), "e").rowsBetween(Window.unboundedPreceding, -1)
    better = F.size(F.filter(F.collect_list(F.struct("v", "bonus")).over(w), lambda o: (o["v"] >= F.col("v")) & (o["bonus"] >= F.col("bonus"))))
    kept = topk(rows, [*keys, "bonus", "spent"], [F.col("v").desc(), F.col("e")], n).drop("rn")  # so the lists above are bounded by the number of prices
    return kept.withColumn("__n", better).filter(F.col("__n") < n).drop("__n")


def _options(cand: DataFrame, group: list[str], rules: SquadRules, shape: _Shape) -> DataFrame:
    """Selections of at most ``max_per_team`` players of a team with their roles: counts, spent, value, members."""
    step = Window.partitionBy(*group).orderBy("t")
    teams = cand.select(*group, "t").distinct().withColumn("step", F.row_number().over(step))  # teams of a group
    teams = teams.select(*[F.col(g).alias(f"__{g}") for g in group], F.col("t").alias("__t"), "step")
    cand = cand.join(teams, _same(group, "", "__") & (F.col("t") == F.col("__t")))
    roles = F.array(*[F.struct(F.lit(r).alias("role"), v.alias("gain")) for r, v in ((BENCH, F.col("bonus")), (START, F.col("v") + F.col("bonus")), (CAPTAIN, 2 * F.col("v") + F.col("bonus")))])
    one = cand.select(*group, "step", "e", "seg", "spent", F.explode(roles).alias("r")).select(*group, "step", "e", "seg", "spent", "r.role", F.col("r.gain").alias("value"))
    one = one.select(*group, "step", F.col("e").alias("last"), "spent", "value", F.array(F.struct("e", "role")).alias("members"),
                     *[F.when(F.col("seg") == s, 1).otherwise(0).alias(c) for s, c in zip(shape.segments, shape.c)],
                     *[F.when((F.col("seg") == s) & (F.col("role") > BENCH), 1).otherwise(0).alias(c) for s, c in zip(shape.segments, shape.s)],
                     F.when(F.col("role") == CAPTAIN, 1).otherwise(0).alias("cap"))
    sizes, grown = [one], one
    adds = ["spent", "value", *shape.counts]
    for _ in range(rules.max_per_team - 1):
        more = one.select(*[F.col(g).alias(f"__{g}") for g in group], F.col("step").alias("__step"), F.col("last").alias("__last"), F.col("members").alias("__members"),
                          *[F.col(c).alias(f"__{c}") for c in adds])
        on = (F.col("step") == F.col("__step")) & (F.col("last") < F.col("__last")) & (F.col("cap") + F.col("__cap") <= 1)
        for g in group:
            on = on & F.col(g).eqNullSafe(F.col(f"__{g}"))
        grown = grown.join(more, on).select(*group, "step", F.col("__last").alias("last"), F.concat("members", "__members").alias("members"),
                                            *[(F.col(c) + F.col(f"__{c}")).alias(c) for c in adds])
        sizes.append(grown)
    every = sizes[0]
    for s in sizes[1:]:
        every = every.unionByName(s)
    every = _best(every.drop("last"), [*group, "step", *shape.counts, "spent"])
    return _pareto(every, [*group, "step", *shape.counts])


def _best(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The grouped maximum: the best value of each key, with its members."""
    return df.groupBy(*keys).agg(F.max_by(F.struct("value", "members"), F.struct("value", "members")).alias("__b")).select(*keys, "__b.value", "__b.members")


def prices(options: DataFrame, group: list[str], rules: SquadRules, shape: _Shape, budget: int, steps: int = STEPS) -> DataFrame:
    """Prices of the shared constraints of every group, and per team the best priced option
    (``tops``, by step).  Any prices make the bound valid."""
    width = len(shape.segments)

    def search(table: pa.Table) -> pa.Table:
        col = lambda c: table[c].to_numpy().astype(float)
        team = table["step"].to_numpy()
        n = int(team.max())
        use = np.stack([col("spent"), *[col(c) for c in shape.c], sum(col(s) for s in shape.s), *[-col(s) for s in shape.s], col("cap")], 1)
        have = np.array([budget, *shape.quota, rules.xi_size, *[-m for m in shape.least], 1], float)
        free = np.array([False, *[True] * width, True, *[False] * width, True])  # equalities may have prices of either sign
        value, scale = col("value"), np.maximum(np.abs(have), 1.0)
        order = np.argsort(team, kind="stable")
        first = np.searchsorted(team[order], np.arange(1, n + 1))
        u, v = use[order] / scale, value[order]
        y, best = np.zeros(len(have)), (np.inf, None)
        reach = max(float(np.abs(v).max(initial=1.0)), 1.0)
        for k in range(steps):
            reduced = v - u @ y
            tops = np.maximum(np.maximum.reduceat(reduced, first), 0.0)
            bound = y @ (have / scale) + tops.sum()
            if bound < best[0]:
                best = (bound, y.copy())
            pick = np.flatnonzero(reduced == np.repeat(np.maximum.reduceat(reduced, first), np.diff(np.append(first, len(v)))))
            pick = pick[np.append(True, np.diff(np.searchsorted(first, pick, side="right")) > 0)] if len(pick) else pick
            slope = have / scale - u[pick[reduced[pick] > 0]].sum(0)
            norm = float(slope @ slope)
            if norm < 1e-12:
                break
            y = y - reach * (1.5 / (1 + k / 12)) * slope / np.sqrt(norm)
            y = np.where(free, y, np.maximum(y, 0.0))
        y = best[1]
        tops = np.maximum(np.maximum.reduceat(v - u @ y, first), 0.0)
        real = y / scale
        return pa.table({**{g: table[g].slice(0, 1) for g in group}, "bound": [float(best[0])], **{p: [x] for p, x in zip(shape.prices, real.tolist())},
                         "tops": pa.array([tops.tolist()], pa.list_(pa.float64()))})

    fields = {f.name: f.dataType.simpleString() for f in options.schema.fields}
    schema = ", ".join([f"{g} {fields[g]}" for g in group] + ["bound double"] + [f"{p} double" for p in shape.prices] + ["tops array<double>"])
    return options.select(*group, "step", "spent", "value", *shape.counts).groupBy(*group).applyInArrow(search, schema)


def _slack(options: DataFrame, duals: DataFrame, group: list[str], shape: _Shape, teams: int) -> DataFrame:
    """Options, and taking none of a team, with what they take off the bound."""
    priced = duals.select(*[F.col(g).alias(f"__{g}") for g in group], "tops", *shape.prices)
    gain = F.col("value") - F.col("p_cost") * F.col("spent") - F.col("p_cap") * F.col("cap")
    for c, s in zip(shape.c, shape.s):
        gain = gain - F.col(f"p_{c}") * F.col(c) - F.col("p_xi") * F.col(s) + F.col(f"p_{s}") * F.col(s)
    rows = options.join(priced, _same(group, "", "__")).withColumn("slack", F.greatest(F.lit(0.0), F.get("tops", F.col("step") - 1) - gain))
    steps = duals.select(*group, "tops", F.explode(F.sequence(F.lit(1), F.lit(teams))).alias("step"))  # groups of fewer teams pass the others' steps
    none = steps.withColumn("slack", F.coalesce(F.get("tops", F.col("step") - 1), F.lit(0.0))).select(
        *group, "step", *[F.lit(0).alias(c) for c in shape.counts], F.lit(0).cast("long").alias("spent"), F.lit(0.0).alias("value"),
        F.array().cast(options.schema["members"].dataType).alias("members"), "slack")
    return rows.select(none.columns).unionByName(none)


def _grown(options: DataFrame, start: DataFrame, group: list[str], rules: SquadRules, shape: _Shape, budget: int, teams: int) -> DataFrame:
    """The best full squad of each group of ``start`` (with its width) that the growth reaches: value, members, spent."""
    nothing = F.array().cast(options.schema["members"].dataType)
    state = start.select(*group, "width", *[F.lit(0).alias(c) for c in shape.counts], F.lit(0).cast("long").alias("spent"), F.lit(0.0).alias("value"), F.lit(0.0).alias("slack"),
                         nothing.alias("members"))
    options = maybe_broadcast(materialize(options), BROADCAST_ROWS)
    keys, adds = [*group, "width", *shape.counts], ["spent", "value", "slack", *shape.counts]
    spare = sum(shape.quota) - rules.xi_size
    for k in range(1, teams + 1):
        mine = options.filter(F.col("step") == k).select(*[F.col(g).alias(f"__{g}") for g in group], F.col("members").alias("__members"), *[F.col(c).alias(f"__{c}") for c in adds])
        grown = state.join(mine, _same(group, "", "__")).select(
            *group, "width", F.concat("members", "__members").alias("members"), *[(F.col(c) + F.col(f"__{c}")).alias(c) for c in adds])
        ok = (F.col("spent") <= budget) & (F.col("cap") <= 1) & (F.col("slack") < F.col("width") + _EPS)
        bench = F.lit(0)
        for c, s, q, m in zip(shape.c, shape.s, shape.quota, shape.least):
            ok = ok & (F.col(c) <= q) & (F.col(c) - F.col(s) <= q - m)
            bench = bench + F.col(c) - F.col(s)
        ok = ok & (bench <= spare) & (sum((F.col(s) for s in shape.s[1:]), F.col(shape.s[0])) <= rules.xi_size)
        # one exchange a team: rows of one key meet, whatever they spend
        best = F.max_by(F.struct("value", "members", "slack"), F.struct("value", "members")).alias("__b")
        grown = grown.filter(ok).repartition(*keys).groupBy(*keys, "spent").agg(best).select(*keys, "spent", "__b.*")
        grown = _pareto(grown, keys)
        state = materialize(grown) if k % TOGETHER == 0 or k == teams else grown
    full = F.col("cap") == 1
    xi = sum((F.col(s) for s in shape.s[1:]), F.col(shape.s[0]))
    for c, s, q, m in zip(shape.c, shape.s, shape.quota, shape.least):
        full = full & (F.col(c) == q) & (F.col(s) >= m)
    return state.filter(full & (xi == rules.xi_size)).groupBy(*group).agg(
        F.max_by(F.struct("value", "members", "spent"), F.struct("value", -F.col("spent"), "members")).alias("b")).select(*group, "b.*")


def _possible(cand: DataFrame, start: DataFrame, group: list[str], rules: SquadRules, shape: _Shape, budget: int) -> DataFrame:
    """Groups of ``start`` that have a legal squad: the cheapest one by the same growth without money and roles."""
    seg = [F.when(F.col("seg") == s, 1).otherwise(0).alias(c) for s, c in zip(shape.segments, shape.c)]
    w = Window.partitionBy(*group, "t", "seg").orderBy("spent", "e")
    near = cand.withColumn("__k", F.row_number().over(w)).filter(F.col("__k") <= rules.max_per_team)
    one = near.groupBy(*group, "t").agg(F.sort_array(F.collect_list(F.struct(F.col("spent").alias("cost"), F.array(*seg).alias("n")))).alias("all"))  # a team's cheapest few
    # sets of a team's candidates, cheapest for each count
    sets = F.aggregate("all", F.array(F.struct(F.lit(0).cast("long").alias("cost"), F.array(*[F.lit(0)] * len(shape.c)).alias("n"))),
                       lambda acc, o: F.concat(acc, F.transform(acc, lambda a: F.struct((a["cost"] + o["cost"]).alias("cost"), F.zip_with(a["n"], o["n"], lambda x, y: x + y).alias("n")))))
    total = lambda n: F.aggregate(n, F.lit(0), lambda x, y: x + y)
    sets = one.select(*group, "t", F.explode(F.filter(sets, lambda o: total(o["n"]) <= rules.max_per_team)).alias("o"))
    sets = sets.groupBy(*group, "t", F.col("o.n").alias("n")).agg(F.min("o.cost").alias("cost"))
    step = Window.partitionBy(*group).orderBy("t")
    teams = sets.select(*group, "t").distinct().withColumn("step", F.row_number().over(step))
    sets = materialize(sets.join(teams.select(*[F.col(g).alias(f"__{g}") for g in group], F.col("t").alias("__t"), "step"), _same(group, "", "__") & (F.col("t") == F.col("__t")))
                       .select(*[F.col(g).alias(f"__{g}") for g in group], "step", F.col("n").alias("__n"), F.col("cost").alias("__cost")))
    state = start.select(*group, F.array(*[F.lit(0)] * len(shape.c)).alias("n"), F.lit(0).cast("long").alias("cost"))
    quota = F.array(*map(F.lit, shape.quota))
    for k in range(1, (sets.agg(F.max("step")).first()[0] or 0) + 1):  # one row
        joined = state.join(sets.filter(F.col("step") == k), _same(group, "", "__"), "left")
        added = joined.withColumn("n", F.when(F.col("__n").isNull(), F.col("n")).otherwise(F.zip_with("n", "__n", lambda x, y: x + y))).withColumn(
            "cost", F.col("cost") + F.coalesce(F.col("__cost"), F.lit(0)))
        fits = F.forall(F.zip_with("n", quota, lambda x, q: x <= q), lambda x: x)
        state = added.filter(fits).groupBy(*group, "n").agg(F.min("cost").alias("cost"))
        state = materialize(state) if k % TOGETHER == 0 else state
    whole = state.filter((F.col("n") == quota) & (F.col("cost") <= budget)).select(*[F.col(g).alias(f"__{g}") for g in group]).distinct()
    return start.join(whole, _same(group, "", "__"), "left_semi")


def _same(group: Sequence[str], a: str, b: str) -> Column:
    on = F.lit(True)
    for g in group:
        on = on & F.col(a + g).eqNullSafe(F.col(b + g))
    return on


def joint_squad(df: DataFrame, group: Sequence[str], score: str, cost: str = "now_cost", rules: SquadRules = SquadRules(), entity: str = "player_id",
                team: str = "team_id", segment: str = "position_id", current: Column | None = None, unit: float = 0.1) -> DataFrame:
    """The best squad of each group, a row a member: the group, the entity, is_starter,
    is_captain, is_vice_captain (the second best starter), ``objective`` (points of the eleven,
    captain twice, minus penalties) and ``gap``.  ``current`` marks members of the present squad:
    every other member costs a transfer."""
    group, shape = list(group), _Shape(rules)
    budget = int(round(rules.budget / unit))
    marked = current if current is not None else F.lit(True)
    cand = materialize(_candidates(df, group, score, cost, rules, entity, team, segment, marked, unit))
    options = materialize(_options(cand, group, rules, shape))
    teams = options.agg(F.max("step")).first()[0] or 0  # one row
    duals = materialize(prices(options, group, rules, shape, budget))
    teams = max(1, teams)
    options = materialize(_slack(options, duals, group, shape, teams))
    todo = materialize(duals.select(*group, "bound", (WIDTH * F.greatest(F.abs("bound"), F.lit(1.0))).alias("width")))
    solved, tries = None, 0
    while not todo.isEmpty():
        near = options.join(todo.select(*[F.col(g).alias(f"__{g}") for g in group], "width"), _same(group, "", "__")).filter(F.col("slack") < F.col("width") + _EPS)
        found = _grown(near.drop("width", *[f"__{g}" for g in group]), todo, group, rules, shape, budget, teams)
        limit = todo.select(*[F.col(g).alias(f"__{g}") for g in group], (F.col("bound") - F.col("width")).alias("unseen"))
        found = found.join(limit, _same(group, "", "__")).drop(*[f"__{g}" for g in group])
        found = materialize(found.filter(F.col("value") >= F.col("unseen") - _EPS))
        solved = found if solved is None else solved.unionByName(found)
        done = found.select(*[F.col(g).alias(f"__{g}") for g in group])
        todo = todo.join(done, _same(group, "", "__"), "left_anti").withColumn("width", F.col("width") * 8)
        tries += 1
        todo = materialize(_possible(cand, materialize(todo), group, rules, shape, budget) if tries == 1 else todo)
    if solved is None:
        solved = df.sparkSession.createDataFrame([], ", ".join([f"{g} {df.schema[g].dataType.simpleString()}" for g in group] + ["value double", f"members {options.schema['members'].dataType.simpleString()}", "unseen double"]))
    # what was not followed is worth at most ``unseen``
    members = solved.select(*group, "value", F.greatest(F.lit(0.0), F.col("unseen") - F.col("value") - _EPS).alias("gap"), F.explode("members").alias("m"))
    members = members.select(*group, "value", "gap", F.col("m.e").alias(entity), F.col("m.role").alias("role"))
    # transfers are half of both squads' sizes less the members they share; each of these has the bonus.
    # Without a present squad every member has it, so it cancels out.
    rows, half = members, rules.transfer_penalty / 2.0
    if current is None:
        fixed = F.lit(2 * half * rules.squad_size)
    else:
        now = df.filter(F.coalesce(marked, F.lit(False))).groupBy(*group).agg(F.count_distinct(F.col(entity)).alias("__now"))
        now = now.select(*[F.col(g).alias(f"__{g}") for g in group], "__now")
        rows = members.join(now, _same(group, "", "__"), "left").drop(*[f"__{g}" for g in group])
        fixed = half * (rules.squad_size + F.coalesce(F.col("__now"), F.lit(0)))
    rows = rows.withColumn("objective", F.col("value") - fixed).drop("__now", "value")
    points = cand.select(*[F.col(g).alias(f"__{g}") for g in group], F.col("e").alias("__e"), F.col("v").alias("__v"))
    rows = rows.join(points, _same(group, "", "__") & (F.col(entity) == F.col("__e"))).drop("__e", *[f"__{g}" for g in group])
    second = F.row_number().over(Window.partitionBy(*group).orderBy(F.when(F.col("role") == CAPTAIN, 2).when(F.col("role") == START, 1).otherwise(0).desc(), F.col("__v").desc(), F.col(entity)))
    return rows.withColumn("__k", second).select(*group, entity, (F.col("role") > BENCH).alias("is_starter"), (F.col("role") == CAPTAIN).alias("is_captain"),
                                                 ((F.col("role") == START) & (F.col("__k") == 2)).alias("is_vice_captain"), F.col("__v").alias(score), "objective", "gap")
