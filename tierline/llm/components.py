"""Connected components of a link table, by contraction on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import join_spread, written


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; component is its smallest node.

    Each round points every node at the neighbour (or itself) that comes first in an order of that
    round, renames the links by it and drops those that became loops. The first order is that of the
    nodes, which ends groups linked to their smallest member at once; later orders are seeded and
    random, so every component loses a constant share of its nodes a round in expectation, whatever
    its shape, and the rounds grow with the logarithm of the longest chain. A round's table holds only the
    nodes that still had links; the tables are composed at the end, last round first. A hub with very
    many links is one key of an aggregate that combines before the shuffle, and its links are renamed by
    a broadcast of hubs alone. Loops, repeated links and nulls (dropped) are allowed; no links give an
    empty table.
    """
    links = written(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                    .distinct(), "links")
    total, rounds = links.count(), []
    while total:
        turn = len(rounds)
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))

        def order(c: str):
            seeded = F.xxhash64(c, F.lit(turn)) if turn else F.lit(0).cast("long")
            return F.struct(seeded.alias("r"), F.col(c).alias("v"))

        step = written(both.groupBy(F.col("a").alias("at"))
                       .agg(F.min(order("b")).alias("m"), F.count(F.lit(1)).alias("n"))
                       .select("at", F.least("m", order("at"))["v"].alias("to"), "n"), "contract")
        sums, nodes = step.agg(F.sum("n"), F.count(F.lit(1))).first()
        rounds.append((step.select("at", "to"), nodes))
        end = step.select(F.col("at").alias("a"), F.col("to").alias("ta"), "n")
        other = step.select(F.col("at").alias("b"), F.col("to").alias("tb"), "n")
        moved = join_spread(join_spread(links, end, ["a"], "n", sums), other, ["b"], "n", sums)
        links = written(moved.filter("ta <> tb").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b"))
                        .distinct(), "links")
        total = links.count()
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    label, size = rounds.pop()
    while rounds:
        step, size = rounds.pop()
        members = step.groupBy("to").agg(F.count(F.lit(1)).alias("n"))
        later = label.select(F.col("at").alias("to"), F.col("to").alias("end")).join(members, "to")
        label = written(join_spread(step, later, ["to"], "n", size, "left").select("at", F.coalesce("end", "to").alias("to")),
                        "labels")
    smallest = label.groupBy("to").agg(F.min("at").alias("component"), F.count(F.lit(1)).alias("n"))
    return join_spread(label, smallest, ["to"], "n", size).select(F.col("at").alias("node"), "component")
