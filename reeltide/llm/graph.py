"""Connected components by repeated contraction, wholly in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reeltide.llm.scratch import Scratch, lookup, salted_lookup


def forest_roots(up: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, up)``, each node once and without cycles -> ``(node, root)``, by jumps of doubled length: a written table each."""
    up = scratch.table(up.select("node", "up"), "up")
    while True:
        parents = up.groupBy("up").agg(F.count("*").alias("n"))
        jumps = scratch.table(up.select(F.col("node").alias("up"), F.col("up").alias("next")).join(parents, "up"), "jumps")
        if jumps.isEmpty():
            scratch.release(jumps)
            return up.select("node", F.col("up").alias("root"))
        last, up = up, scratch.table(lookup(up, jumps, "up", ["node"]).select("node", F.coalesce("next", "up").alias("up")), "up")
        scratch.release(jumps, last)


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(u, v)`` of any orderable type -> ``(node, component)``, component the smallest node reachable.

    Only nodes with an edge to another node appear. Each round hooks every node to its neighbour of
    lowest hashed priority and contracts the graph, so that an expected constant share of the nodes goes
    in each round and long chains take logarithmically many; each round is a written table. Hubs are
    handled by partial aggregation and by lookups that deal hot nodes to several tasks.
    """
    e = edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u <> v").distinct()
    e = scratch.table(e, "edges")
    rounds: list[DataFrame] = []
    while not e.isEmpty():
        ends = F.explode(F.array(F.struct(F.col("u").alias("at"), F.col("v").alias("to"), F.lit(1).alias("out")), F.struct(F.col("v").alias("at"), F.col("u").alias("to"), F.lit(0).alias("out"))))
        rank = lambda c, r=len(rounds): F.struct(F.xxhash64(c, F.lit(r)).alias("h"), c.alias("id"))
        best = e.select(ends.alias("x")).groupBy(F.col("x.at").alias("u")).agg(F.min(rank(F.col("x.to"))).alias("best"), F.sum("x.out").alias("outs"), F.sum(1 - F.col("x.out")).alias("ins"))
        hooked = scratch.table(best.select("u", F.when(F.col("best") < rank(F.col("u")), F.col("best.id")).otherwise(F.col("u")).alias("p"), "outs", "ins"), "hook")
        rounds.append(hooked)
        last, total = e, e.count()
        e = lookup(e, hooked.drop("ins"), "u", ["v"], "inner", "outs", total).select(F.col("p").alias("a"), F.col("v").alias("u"))
        e = lookup(e, hooked.drop("outs"), "u", ["a"], "inner", "ins", total).select(F.least("a", "p").alias("u"), F.greatest("a", "p").alias("v")).where("u <> v").distinct()
        e = scratch.table(e, "edges")
        scratch.release(last)
    if not rounds:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).limit(0)
    label = rounds[0].select(F.col("u").alias("node"), F.col("p").alias("u"))
    for hooked in rounds[1:]:
        label = salted_lookup(label, hooked.select("u", "p"), "u", ["node"]).select("node", F.coalesce("p", "u").alias("u"))
    label = scratch.table(label, "label")
    scratch.release(e, *rounds)
    least = scratch.table(label.groupBy("u").agg(F.min("node").alias("component"), F.count("*").alias("n")), "least")
    return lookup(label, least, "u", ["node"], "inner").select("node", "component")
