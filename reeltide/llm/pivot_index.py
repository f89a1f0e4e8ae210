"""Embedding near-duplicates through a pivot-permutation index.

A vector is described by its nearest reference points (pivots) in order of nearness. It is listed under each of
them; vectors of one label that share enough pivots of their descriptions are candidates and are verified by
cosine in double precision.

Equal vectors of a label are one class from the start and count by their number. Each pivot's list is dealt to
pairs of bounded blocks. There the other pivots' lists, cut down to the blocks, are walked to count what pairs share; a pair
belongs to the list of the first pivot that it shares, and only pairs that share enough are compared by cosine. So
links are counted once and leave a task as sums per vector and a spanning forest, never as pairs.

A label has twice the square root of its number of vectors as pivots (PIVOTS says at least and at most), so that lists grow more slowly than the
table and the share of all pairs that they hold falls. Pivots are chosen from a bounded sample of the label (SAMPLED
vectors of smallest hash for each pivot), apart from each other; every vector is indexed. Measured recall against brute force is in
the README and in the tests.

Defined cases: vectors that are null, zero, or hold null or non-finite components, and vectors without a
label, link with nothing; vectors of different width never compare; rows that repeat an id are separate
vectors of one node.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reeltide.llm.graph import connected_components
from reeltide.llm.scratch import Scratch, salted_lookup

#: Pivots of a label at least and at most, pivots that describe a vector, and how many of them candidates share.
PIVOTS, NEAREST, SHARED = (64, 16_384), 8, 2
#: Vectors for each pivot that a label's pivots are chosen from, and the cosine that pivots have to each other at most.
SAMPLED, APART = 8, 0.7
#: Vectors of one block of a list, and of one that is described by one task; cosines to pivots, and of candidates, that are held at once.
BLOCK, DESCRIBED, HELD = 2048, 16_384, 1 << 22


def _describe(vectors, pivots):
    """Adds to a block of vectors the numbers of their NEAREST pivots, nearest first (ties: the smaller number)."""
    n = len(vectors)
    p = np.frombuffer(pivots.column("pivots")[0].as_py(), float)
    v = np.concatenate([np.zeros(0), *(c.flatten().to_numpy() for c in vectors.column("v").chunks)]).reshape(n, -1)
    p = p.reshape(-1, v.shape[1])
    v = v / np.linalg.norm(v, axis=1, keepdims=True)
    near = np.empty((n, min(NEAREST, len(p))), np.int32)
    step = max(1, HELD // len(p))
    for a in range(0, n, step):
        far = -(v[a : a + step] @ p.T)
        some = np.sort(np.argpartition(far, near.shape[1] - 1, axis=1)[:, : near.shape[1]], axis=1)
        order = np.argsort(np.take_along_axis(far, some, 1), axis=1, kind="stable")
        near[a : a + step] = np.take_along_axis(some, order, 1)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * near.shape[1], pa.int32()), pa.array(near.ravel()))
    return pa.Table.from_arrays([*(vectors.column(c) for c in ("part", "node", "n", "v")), lists], names=["part", "node", "n", "v", "near"])


def _posts(near: np.ndarray) -> dict[int, np.ndarray]:
    """The rows that each pivot describes."""
    row = np.repeat(np.arange(len(near)), near.shape[1])
    order = np.argsort(near.ravel(), kind="stable")
    held, begin = np.unique(near.ravel()[order], return_index=True)
    return dict(zip(held.tolist(), np.split(row[order], begin[1:]), strict=True))


def candidates(pivot: int, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of two blocks of the list of ``pivot`` that share SHARED pivots and none of a smaller number (``x``, ``y``: their pivots)."""
    shared = np.ones((len(x), len(y)), np.uint8)
    a, b = _posts(x), _posts(y)
    both = sorted(set(a) & set(b), reverse=True)  # those before the list's own come last
    for p in both:
        if p > pivot:
            shared[np.ix_(a[p], b[p])] += 1
        elif p < pivot:
            shared[np.ix_(a[p], b[p])] = 0
    return np.nonzero(shared >= min(SHARED, x.shape[1]))


def _verify(least: float):
    def run(table):
        table = table.combine_chunks()
        pivot = table.column("pivot")[0].as_py()
        same = table.column("i")[0].as_py() == table.column("j")[0].as_py()
        side = table.column("side").to_numpy()
        x, y = (np.flatnonzero(side == k) for k in (0, 0 if same else 1))
        v, near = (table.column(c).combine_chunks().flatten().to_numpy().reshape(len(table), -1) for c in ("v", "near"))
        v = v / np.linalg.norm(v, axis=1, keepdims=True)
        node, n = table.column("node").to_numpy(), table.column("n").to_numpy()
        a, b = candidates(pivot, near[x], near[y])
        if same:
            once = node[x[a]] < node[y[b]]
            a, b = a[once], b[once]
        linked = np.zeros((len(x), len(y)), bool)
        step = max(1, HELD // v.shape[1])
        for k in range(0, len(a), step):
            i, j = a[k : k + step], b[k : k + step]
            linked[i, j] = np.einsum("ij,ij->i", v[x[i]], v[y[j]]) >= least
        degree: dict[int, int] = {}
        for at, other, axis in ((x, y, 1), (y, x, 0)):
            total = (linked * (n[other][None, :] if axis else n[other][:, None])).sum(axis)
            for i in np.flatnonzero(total):
                degree[int(node[at[i]])] = degree.get(int(node[at[i]]), 0) + int(total[i])
        # a forest: breadth first over the linked blocks
        forest, seen = [], set()
        of_x = {int(a): k for k, a in enumerate(node[x])}
        of_y = {int(b): k for k, b in enumerate(node[y])}
        for start in degree:
            if start in seen:
                continue
            seen.add(start)
            todo = [start]
            while todo:
                a = todo.pop()
                ends = [node[y[np.flatnonzero(linked[of_x[a]])]]] if a in of_x else []
                ends += [node[x[np.flatnonzero(linked[:, of_y[a]])]]] if a in of_y else []
                for b in np.concatenate(ends).tolist():
                    if b not in seen:
                        seen.add(b)
                        todo.append(b)
                        forest.append((a, b))
        kinds = [(k, None, c) for k, c in degree.items()] + [(a, b, 0) for a, b in forest]
        return pa.table({"u": pa.array([k[0] for k in kinds], pa.int64()), "v": pa.array([k[1] for k in kinds], pa.int64()), "links": pa.array([k[2] for k in kinds], pa.int64())})

    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = 0.93) -> DataFrame:
    """One row per row of ``vectors``: the id, n_links, component_id, kept."""
    scratch = Scratch(vectors.sparkSession, "pivot-index")
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), v.alias("v"))
    sound = F.col("v").isNotNull() & F.col("label").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = scratch.table(rows.withColumn("sound", F.coalesce(sound, F.lit(False))), "rows")
    # equal vectors of a label: one class, known by a hash of both
    classed = rows.where("sound").select("id", F.xxhash64("label", "v").alias("node"), F.struct("label", F.size("v").alias("width")).alias("part"), "v")
    classes = scratch.table(classed.groupBy("node").agg(F.count("*").alias("n"), F.first("part").alias("part"), F.first("v").alias("v")), "classes")
    return _linked(rows, classed, classes, least, scratch, id_col)


def _pivots(classes: DataFrame, counts: DataFrame) -> DataFrame:
    """(part, pivots): the unit vectors of a sample of each part's classes that lie apart, packed as doubles. ``counts``: (part, pivots), how many."""
    # the few smallest hashes of each part: first within 32 slices, twice what each should give, then of those
    slices = Window.partitionBy("part", "slice").orderBy("h", "node")
    some = salted_lookup(classes.select("part", "node", "v"), counts, "part", ["node"], "inner").withColumn("h", F.xxhash64("node", F.lit(7))).withColumn("slice", F.pmod("h", F.lit(32)))
    some = some.withColumn("r", F.row_number().over(slices)).where(F.col("r") <= SAMPLED * F.col("pivots") / 16)
    some = some.withColumn("r", F.row_number().over(Window.partitionBy("part").orderBy("h", "node"))).where(F.col("r") <= SAMPLED * F.col("pivots"))

    def gather(table):
        table = table.sort_by("r")
        most = table.column("pivots")[0].as_py()
        p = np.array([np.asarray(x.as_py(), float) for x in table.column("v")])
        p /= np.linalg.norm(p, axis=1, keepdims=True)
        chosen = np.empty((most, p.shape[1]))  # apart from each other, so that a large group of near copies isn't described by its own members
        n = 0
        for x in p:
            if n < most and not (chosen[:n] @ x > APART).any():
                chosen[n] = x
                n += 1
        return pa.Table.from_arrays([table.column("part")[:1], pa.array([chosen[:n].tobytes()], pa.binary())], names=["part", "pivots"])

    return some.select("part", "r", "v", "pivots").groupBy("part").applyInArrow(gather, f"part {classes.schema['part'].dataType.simpleString()}, pivots binary")


def _linked(rows: DataFrame, classed: DataFrame, classes: DataFrame, least: float, scratch: Scratch, id_col: str) -> DataFrame:
    kind = classes.schema["part"].dataType.simpleString()
    wanted = F.least(F.greatest(F.ceil(2 * F.sqrt(F.count("*"))), F.lit(PIVOTS[0])), F.lit(PIVOTS[1])).cast("int")
    blocks = scratch.table(classes.groupBy("part").agg(F.ceil(F.count("*") / DESCRIBED).cast("int").alias("blocks"), wanted.alias("pivots")), "blocks")
    dealt = salted_lookup(classes, blocks.drop("pivots"), "part", ["node"], "inner").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    pivots = _pivots(classes, blocks.drop("blocks")).join(blocks.drop("pivots"), "part").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    described = dealt.select("part", "block", "node", "n", "v").groupBy("part", "block").cogroup(pivots.select("part", "block", "pivots").groupBy("part", "block"))
    described = scratch.table(described.applyInArrow(_describe, f"part {kind}, node long, n long, v array<double>, near array<int>"), "described")
    posts = described.withColumn("pivot", F.explode("near"))
    plan = posts.groupBy("part", "pivot").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).select(F.struct("part", "pivot").alias("k"), "blocks")
    posts = salted_lookup(posts.withColumn("k", F.struct("part", "pivot")), plan, "k", ["node"], "inner")
    posts = posts.withColumn("b", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).cast("int"))
    meet = F.expr("concat(transform(sequence(b, blocks - 1), x -> struct(b as i, x as j, 0 as side)), if(b > 0, transform(sequence(0, b - 1), x -> struct(x as i, b as j, 1 as side)), array()))")  # a block meets itself once
    sent = posts.withColumn("m", F.explode(meet)).select("part", "pivot", "m.i", "m.j", "m.side", "node", "n", "v", "near")
    found = scratch.table(sent.groupBy("part", "pivot", "i", "j").applyInArrow(_verify(least), "u long, v long, links long"), "found")
    degrees = found.where("v is null").groupBy("u").agg(F.sum("links").alias("links"))
    part = connected_components(found.where("v is not null").select("u", "v"), scratch)
    named = scratch.table(classed.select("id", "node").join(classes.select("node", "n"), "node"), "named")
    named = salted_lookup(named, degrees.withColumnRenamed("u", "node"), "node", ["id"])
    named = salted_lookup(named, part, "node", ["id"]).select("id", "node", F.coalesce("component", "node").alias("component"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    named = scratch.table(named, "linked")
    scratch.keep_only(named, rows)
    least_id = named.groupBy("component").agg(F.min("id").alias("component_id"))
    named = salted_lookup(named, least_id, "component", ["id", "node"], "inner").select("id", "n_links", "component_id")
    alone = rows.where("not sound").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = named.unionByName(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
