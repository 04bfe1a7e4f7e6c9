"""Connected components of a table of links, by contraction.

Each round hooks every node on its smallest neighbour, follows that pointer
once more and replaces both ends of every link by the result; links inside
one node vanish.  All but local minima disappear per round, so the rounds
are logarithmic; each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.operators.common import materialize


def _links(a, b) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b): the smallest id that
    links reach.  Loops, repeats and nulls are allowed; ids without links are absent."""
    edges = materialize(links.where("a <> b").select(*_links(F.col("a"), F.col("b"))).distinct())
    label = None
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select("b", "a")).toDF("id", "other")
        parent = materialize(both.groupBy("id").agg(F.min("other").alias("p")).select("id", F.least("id", "p").alias("p")))
        step = materialize(parent.join(parent.select(F.col("id").alias("p"), F.col("p").alias("pp")), "p").select("id", F.col("pp").alias("p")))
        if label is None:
            label = step.toDF("id", "component")
        else:
            nxt = step.toDF("component", "p")
            label = label.join(nxt, "component", "left").select("id", F.coalesce("p", "component").alias("component"))
        label = materialize(label)
        a = edges.join(step.toDF("a", "pa"), "a")
        ab = a.join(step.toDF("b", "pb"), "b").where("pa <> pb")
        edges = materialize(ab.select(*_links(F.col("pa"), F.col("pb"))).distinct())
    return label if label is not None else edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
