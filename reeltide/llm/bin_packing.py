"""Sharding by vector bin packing.

Documents go to a fixed number of shards so that bytes, tokens and rows are balanced jointly; the law that holds is
``bytes`` (sizes near equal). Equal texts are one group and go to one shard; only a group of more than 16 rows and
1/512 of all bytes, tokens or rows that no shard can take and still be levelled is split, by a hash of the rows' numbers, into fragments
of about 1/512.

Groups are aggregated and fall into classes by the power of two of their largest share of all bytes, tokens or rows.
Those that hold more than 1/64 of a pack's part of the whole, or 1/512 of all, are placed first in one step: largest
groups first, each goes where the dot product of its (bytes, tokens, rows) with the shard's residual capacity is highest,
bytes weighing more. The capacity they leave is dealt to packs of about 20,000 of the other groups, and each pack is
placed alike; it begins at its own fraction of a group, so that what packs miss doesn't add up in one shard. Should
more than 20,000 groups be that large, they are dealt to fewer packs in the same way, and so on.

Defined cases: null text has size 1 (no bytes, plus 1), like empty text, but is a group of its own; ids may be null
or repeated, each row counts for itself; with fewer documents than shards some shards stay empty.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reeltide.llm.mixing import WORD
from reeltide.llm.scratch import Scratch, salted_lookup

#: Groups of one pack; rows whose slots are numbered in one task.
PACK_GROUPS, SLOT_ROWS = 20_000, 50_000
#: Share of all bytes, tokens or rows of a fragment, which a group needs to be split at all, and rows that no group is split below.
SPLIT_SHARE, SPLIT_ROWS = 1 / 512, 16
#: Of a pack's part of all bytes, tokens or rows, what a group in it has at most.
PACK_SHARE = 1 / 64
#: Of a shard's share, what the capacities that a whole group leaves of bytes, tokens and rows may differ by: no other groups would level them.
UNEVEN = 1 / 8
#: What bytes, which are the law, weigh in the dot product against tokens and rows.
BYTES_WEIGHT = 8
_SIZES = ("bytes", "tokens", "rows")


def _best(room: list[list[float]], share: list[float], among) -> int:
    b, t, r = share
    return max(among, key=lambda s: BYTES_WEIGHT * room[s][0] * b + room[s][1] * t + room[s][2] * r)


def _fill(room: list[list[float]], s: int, share: list[float]) -> None:
    for d in range(3):
        room[s][d] -= share[d]


def _place(room: list[list[float]], share: np.ndarray, names: np.ndarray) -> np.ndarray:
    """The shard of each row of ``share``, the largest first; ``room`` is what is left of each shard and is filled.

    Capacities count as parts of what each shard has at first, so that shards of unequal room get the same mix.
    """
    out = np.zeros(len(share), np.int32)
    if not len(share):
        return out
    whole = np.maximum(np.asarray(room), np.maximum(share.mean(0), 1e-12))
    part = (np.asarray(room) / whole).tolist()
    scale = (1 / whole).tolist()
    order = np.lexsort((names, -share.max(1)))
    for i, x in zip(order.tolist(), share[order].tolist(), strict=True):
        out[i] = s = _best(part, x, range(len(part)))
        _fill(part, s, [a * b for a, b in zip(x, scale[s], strict=True)])
    room[:] = (np.asarray(part) * whole).tolist()
    return out


def _place_whole(room: list[list[float]], share: np.ndarray, names: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shard of each large group that some shard has room for, or -1; and which groups are to be split."""
    out, split = np.full(len(share), -1, np.int32), np.zeros(len(share), bool)
    large = np.flatnonzero(share.max(1) > SPLIT_SHARE)
    for i in large[np.lexsort((names[large], -share[large].max(1)))].tolist():
        x = share[i].tolist()
        fit = []
        for s in range(len(room)):
            free = [room[s][d] - x[d] for d in range(3)]
            if min(free) >= 0 and max(free) - min(free) <= UNEVEN / len(room):
                fit.append(s)
        if fit or rows[i] <= SPLIT_ROWS:
            out[i] = s = _best(room, x, fit or range(len(room)))
            _fill(room, s, x)
        else:
            split[i] = True
    return out, split


def _place_pack(left: list[list[float]]):
    """Places a pack in shards that hold the shares ``left`` of it."""

    def run(key, table):
        sizes = np.column_stack([table.column(c).to_numpy() for c in _SIZES]).astype(float)
        share = sizes / np.maximum(sizes.sum(0), 1)
        start = np.random.default_rng([key[0].as_py(), key[1].as_py()]).random(len(left))
        room = (np.asarray(left) + np.outer(start - start.mean(), share.mean(0))).tolist()
        group = table.column("group").to_numpy()
        return pa.Table.from_arrays([table.column("group"), pa.array(_place(room, share, group))], names=["group", "shard"])

    return run


def _place_top(rows: DataFrame, groups: DataFrame, total: np.ndarray, shards: int) -> tuple[DataFrame, np.ndarray]:
    """(group, shards of its fragments) of the given groups, a bounded number, and the capacities they leave."""
    room = [[1 / shards] * 3 for _ in range(shards)]
    found = np.array(groups.select("group", *_SIZES).collect(), np.int64).reshape(-1, 4)
    names, share = found[:, 0], found[:, 1:] / total
    out, split = _place_whole(room, share, names, found[:, 3])
    pieces = {int(names[i]): int(min(found[i, 3], math.ceil(share[i].max() / SPLIT_SHARE))) for i in np.flatnonzero(split)}
    rest = np.flatnonzero((out < 0) & ~split)
    at = {int(names[i]): int(i) for i in np.flatnonzero(split)}
    fragments = []
    if pieces:
        cut = rows.join(F.broadcast(rows.sparkSession.createDataFrame(list(pieces.items()), "group long, pieces int")), "group")
        counted = cut.groupBy("group", F.pmod(F.xxhash64("row"), F.col("pieces")).cast("int").alias("frag")).agg(F.count("*").alias("n"))
        fragments = sorted((r.group, r.frag, r.n) for r in counted.collect())
    parts = np.array([share[at[g]] * n / found[at[g], 3] for g, _, n in fragments]).reshape(-1, 3)
    where = _place(room, np.concatenate([share[rest], parts]), np.concatenate([names[rest], np.array([g for g, _, _ in fragments], np.int64)]))
    out[rest] = where[: len(rest)]
    homes = {int(g): [int(s)] for g, s in zip(names, out, strict=True)} | {g: [0] * n for g, n in pieces.items()}
    for (g, f, _), s in zip(fragments, where[len(rest) :].tolist(), strict=True):
        homes[g][f] = s
    return rows.sparkSession.createDataFrame(list(homes.items()), "group long, shards array<int>"), np.array(room)


def shard(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, size, text_crc32, tokens, law, shard, slot (gapless in its shard), grown_shard (null)."""
    scratch = Scratch(docs.sparkSession, "bin-packing")
    text = F.col(text_col).cast("string")
    data = F.coalesce(text, F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("tokens"),
        F.xxhash64(text, F.octet_length(text)).alias("group"),
    )
    rows = scratch.table(rows.withColumn("row", F.monotonically_increasing_id()), "sizes")
    groups = scratch.table(rows.groupBy("group").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")), "groups")
    total = np.maximum(np.array(groups.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in _SIZES)).first(), float), 1)
    largest = F.greatest(*(F.col(c) / float(n) for c, n in zip(_SIZES, total, strict=True)))
    classed = groups.withColumn("class", F.floor(F.log2(largest)).cast("int"))
    counts = sorted(((r["class"], r.n) for r in classed.groupBy("class").agg(F.count("*").alias("n")).collect()), reverse=True)  # one row a power of two
    levels, above = {}, counts
    while (n := sum(n for _, n in above)) > PACK_GROUPS:
        most = min(SPLIT_SHARE, PACK_SHARE * PACK_GROUPS / n)
        small = [x for x in above if 2.0 ** (x[0] + 1) <= most]
        if not small:
            break
        levels |= dict.fromkeys((c for c, _ in small), (len(levels), -(-sum(n for _, n in small) // PACK_GROUPS)))
        above = above[: -len(small)]
    least = above[-1][0] if above else 1
    top, room = _place_top(rows, classed.where(F.col("class") >= least), total, shards)
    rows = rows.join(F.broadcast(top), "group", "left")
    known = rows.where("shards is not null").withColumn("shard", F.get("shards", F.pmod(F.xxhash64("row"), F.size("shards")).cast("int"))).drop("shards")
    if levels:
        rest = np.maximum(room, 0)
        left = np.where(rest.sum(0) > 0, rest / np.maximum(rest.sum(0), 1e-300), 1 / shards).tolist()
        level = F.element_at(F.create_map(*(y for c, (k, n) in levels.items() for y in (F.lit(c), F.struct(F.lit(k).alias("level"), F.lit(n).alias("packs"))))), F.col("class"))
        packed = classed.where(F.col("class") < least).withColumn("of", level).select("group", *_SIZES, "of.level", F.pmod(F.xxhash64("group"), F.col("of.packs")).cast("int").alias("pack"))
        placed = scratch.table(packed.groupBy("level", "pack").applyInArrow(_place_pack(left), "group long, shard int"), "placed")
        known = known.unionByName(rows.where("shards is null").drop("shards").join(placed, "group"))
    bucket = F.pmod(F.xxhash64("row"), F.lit(max(1, -(-int(total[2]) // SLOT_ROWS)))).cast("int")
    rows = scratch.table(known.withColumn("bucket", bucket), "sharded")
    scratch.keep_only(rows)
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n")).select(F.struct("shard", "bucket").alias("k"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "bucket").orderBy("id", "group", "row")
    rows = rows.withColumn("r", F.row_number().over(within) - 1).withColumn("k", F.struct("shard", "bucket"))
    out = salted_lookup(rows, offsets, "k", ["row"], "inner", 1)
    return out.select(F.col("id").alias(id_col), "size", "text_crc32", "tokens", F.lit("bytes").alias("law"), "shard", (F.col("offset") + F.col("r")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
