"""Frames of a timeline: when they are taken, near-duplicate removal, kinds, and which are captioned."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reeltide.operators.segment import stretch, stretches
from reeltide.sources.sinks import Kept

#: Seconds within which stamps are one, in both timelines, and within which a frame belongs to a scene change.
SAME_STAMP, SAME_STAMP_ALT, SCENE_NEAR = 0.25, 0.1, 0.25
#: Fixed value: seconds before the end from which no frame is taken.
TAIL = 0.5


def distinct_times(sorted_times: Column, least: float) -> Column:
    """Drops times that are closer than ``least`` to the last one kept."""
    keep = lambda acc, t: F.when((F.size(acc) > 0) & (F.abs(t - F.try_element_at(acc, F.lit(-1))) < least), acc).otherwise(F.concat(acc, F.array(t)))
    return F.aggregate(sorted_times, F.array().cast("array<double>"), keep)


def _scene_lists(scenes: DataFrame) -> DataFrame:
    return scenes.groupBy("video_id").agg(F.collect_list("at_sec").alias("scenes"))


def frame_timestamps(media: DataFrame, scenes: DataFrame, interval: float = 5.0, most: int = 8) -> DataFrame:
    """(video_id, frame_idx, at_sec): start, middle, every interval and each scene change, thinned evenly to ``most``."""
    m = media.where("duration_sec > 0").join(_scene_lists(scenes), "video_id", "left")
    dur = F.col("duration_sec")
    safe = F.when(dur > TAIL, dur - TAIL).otherwise(dur)
    none = F.array().cast("array<double>")
    steps = F.ceil(safe / interval).cast("int") - 1 if interval > 0 else F.lit(0)
    periodic = F.when(steps >= 1, F.transform(F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), lambda i: i * F.lit(interval))).otherwise(none)
    changes = F.filter(F.coalesce("scenes", none), lambda t: (t > 0) & (t < safe))
    stamps = F.array_sort(F.concat(F.array(F.lit(0.0), F.least(dur / 2, safe)), periodic, changes))
    m = m.select("video_id", distinct_times(stamps, SAME_STAMP).alias("s"))
    last = F.size("s") - 1
    thinned = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: F.get("s", F.round(i * last / F.lit(float(max(most - 1, 1)))).cast("int")))
    m = m.select("video_id", F.when(F.size("s") > most, distinct_times(F.array_sort(thinned), SAME_STAMP)).otherwise(F.col("s")).alias("s"))
    return m.select("video_id", F.posexplode("s").alias("frame_idx", "at_sec"))


def alternative_timestamps(media: DataFrame, scenes: DataFrame, interval: float = 5.0) -> DataFrame:
    """(video_id, frame_idx, at_sec): every interval from 0 before the end and all scene changes."""
    m = media.where("duration_sec > 0").join(_scene_lists(scenes), "video_id", "left")
    periodic = F.transform(F.sequence(F.lit(0), F.ceil(F.col("duration_sec") / interval).cast("int") - 1), lambda i: i * F.lit(interval))
    stamps = F.array_sort(F.concat(periodic, F.coalesce("scenes", F.array().cast("array<double>"))))
    return m.select("video_id", F.posexplode(distinct_times(stamps, SAME_STAMP_ALT)).alias("frame_idx", "at_sec"))


def frame_kinds(frames: DataFrame, scenes: DataFrame) -> DataFrame:
    """``frames`` with kind: scene_change within a quarter second of a scene change, else periodic."""
    second = lambda at: F.floor(at).cast("bigint")
    f = frames.select("video_id", "frame_idx", "at_sec").withColumn("second", F.explode(F.sequence(second(F.col("at_sec") - SCENE_NEAR), second(F.col("at_sec") + SCENE_NEAR))))
    near = f.join(scenes.select("video_id", F.col("at_sec").alias("scene_sec"), second(F.col("at_sec")).alias("second")), ["video_id", "second"]).where(F.abs(F.col("scene_sec") - F.col("at_sec")) < SCENE_NEAR)
    near = near.select("video_id", "frame_idx").distinct().withColumn("is_scene", F.lit(True))
    return frames.join(near, ["video_id", "frame_idx"], "left").withColumn("kind", F.when(F.col("is_scene"), "scene_change").otherwise("periodic")).drop("is_scene")


#: Different hashes of a group that is decided in one task, rows of a bucket that meet in one task, and how many buckets may be larger.
FOLD_HASHES, BUCKET_ROWS, LARGE_BUCKETS = 20_000, 8_192, 100_000


def _first_of_alike(threshold: int):
    """Of one group's hashes in order, the places of those that no kept one is near to."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("o", "ascending"), ("h", "ascending")])
        hashes = table.column("h").to_numpy().view(np.uint64)
        kept, at = np.empty(len(hashes), np.uint64), []
        for i, h in enumerate(hashes):
            if not len(at) or np.bitwise_count(kept[: len(at)] ^ h).min() > threshold:
                kept[len(at)] = h
                at.append(i)
        return table.take(pa.array(at, pa.int64()))

    return run


def _first_near(hashes: np.ndarray, among: np.ndarray, wanted: np.ndarray, threshold: int) -> np.ndarray:
    """For each place in ``wanted`` the first place in ``among`` before it whose hash is near, or -1; both ascend.

    Earlier places are gone through in blocks, and who has found one is left out of the next, so that many that are alike take few steps.
    """
    found = np.full(len(hashes), -1)
    for k in range(0, len(among), 1024):
        block = among[k : k + 1024]
        wanted = wanted[wanted > block[0]]
        for j in range(0, len(wanted), 1024):
            w = wanted[j : j + 1024]
            near = (np.bitwise_count(hashes[w][:, None] ^ hashes[block][None, :]) <= threshold) & (block[None, :] < w[:, None])
            has = near.any(1)
            found[w[has]] = block[near[has].argmax(1)]
        wanted = wanted[found[wanted] < 0]
    return found


def _meet(threshold: int):
    """Of the undecided rows of a bucket: whether one kept before is near, else the first undecided one before that is."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("o", "ascending"), ("h", "ascending")])
        hashes, kept = table.column("h").to_numpy().view(np.uint64), table.column("kept").to_numpy()
        places = np.arange(len(hashes))
        dropped = _first_near(hashes, places[kept], places[~kept], threshold) >= 0
        left = places[~kept & ~dropped]
        first = _first_near(hashes, left, left, threshold)
        of = np.flatnonzero(dropped | (first >= 0))
        before = pa.array(np.maximum(first[of], 0), mask=first[of] < 0)
        columns = {c: table.column(c).take(of) for c in ("g", "o", "h")}
        return pa.table(columns | {"dropped": pa.array(dropped[of]), "fo": table.column("o").take(before), "fh": table.column("h").take(before)})

    return run


def _bands(h: Column, threshold: int) -> list[Column]:
    """The bits of a hash in one more band than bits may differ: near hashes agree in one of them."""
    cuts = [64 * k // (threshold + 1) for k in range(threshold + 2)]
    return [F.shiftrightunsigned(F.shiftleft(h, 64 - b), 64 - (b - a)) for a, b in zip(cuts, cuts[1:], strict=False)]


def _decide(rows: DataFrame, threshold: int, kinds: str, tables: Kept) -> DataFrame:
    """The kept ones of different hashes (g, o, h), as the fold over each group's order would keep them.

    Hashes meet in buckets of (group, band, value). In each round an undecided hash that no kept one before it is near to learns the first
    undecided one before it that is: without any it is kept, and if that one is kept it goes. So rounds follow chains of near hashes,
    not the size of a group. Buckets larger than BUCKET_ROWS (or more, so that LARGE_BUCKETS are larger at most) are dealt to
    pairs of blocks.
    """
    state = tables.table(rows.select("*", F.lit(False).alias("kept")), "undecided")
    done: list[DataFrame] = []
    same = lambda a, b: F.col(f"{a}g").eqNullSafe(F.col(f"{b}g")) & (F.col(f"{a}h") == F.col(f"{b}h"))
    while not state.where("not kept").isEmpty():
        posts = state.select("*", F.posexplode(F.array(*_bands(F.col("h"), threshold))).alias("band", "value"))
        least = max(BUCKET_ROWS, state.count() * (threshold + 1) // LARGE_BUCKETS)
        large = posts.groupBy("g", "band", "value").agg(F.count("*").alias("n")).where(F.col("n") > least)
        large = large.select(F.col("g").alias("lg"), F.col("band").alias("lb"), F.col("value").alias("lv"), F.ceil(F.col("n") / (least // 2)).cast("int").alias("blocks"))
        dealt = posts.join(F.broadcast(large), F.col("g").eqNullSafe(F.col("lg")) & (F.col("band") == F.col("lb")) & (F.col("value") == F.col("lv")), "left")
        own = F.pmod(F.xxhash64("h"), F.col("blocks")).cast("int")
        pair = lambda i: F.least(i, own) * F.col("blocks") + F.greatest(i, own)
        tiles = F.when(F.col("blocks").isNull(), F.array(F.lit(-1))).otherwise(F.transform(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: i != own), pair))
        met = dealt.select("g", "o", "h", "kept", "band", "value", F.explode(tiles).alias("tile")).groupBy("g", "band", "value", "tile").applyInArrow(_meet(threshold), f"{kinds}, dropped boolean, fo {kinds.split(', ')[1].split(' ', 1)[1]}, fh bigint")
        known = met.groupBy("g", "h").agg(F.max("dropped").alias("dropped"), F.min(F.when(F.col("fh").isNotNull(), F.struct("fo", "fh"))).alias("first")).select(F.col("g").alias("kg"), F.col("h").alias("kh"), "dropped", "first.fh")
        open_ = tables.table(state.where("not kept").join(known, same("", "k"), "left").where("not coalesce(dropped, false)").select("g", "o", "h", "fh"), "open")
        new = tables.table(open_.where("fh is null").select("g", "o", "h"), "kept")
        done.append(new)
        by = new.select(F.col("g").alias("ng"), F.col("h").alias("nh"))
        rest = open_.where("fh is not null").join(by, F.col("g").eqNullSafe(F.col("ng")) & (F.col("fh") == F.col("nh")), "left_anti").select("g", "o", "h", F.lit(False).alias("kept"))
        state = tables.table(rest.unionByName(new.select("*", F.lit(True).alias("kept"))), "undecided")
    return reduce(DataFrame.unionByName, done, rows.limit(0))


def dedupe_frames(frames: DataFrame, key: str, order: str, hash_col: str, threshold: int = 10, fold_hashes: int = FOLD_HASHES) -> DataFrame:
    """(key, order): in order, frames whose hash isn't within ``threshold`` bits of a kept one; frames without a hash stay.

    Of equal hashes of a group only the first can stay; frames of one order are taken by their hash. Groups of up to ``fold_hashes``
    different hashes are decided in one task each, larger ones by buckets of bands of their hashes.
    """
    kinds = f"g {frames.schema[key].dataType.simpleString()}, o {frames.schema[order].dataType.simpleString()}, h bigint"
    rows = frames.select(F.col(key).alias("g"), F.col(order).alias("o"), F.col(hash_col).alias("h"))
    without = rows.where("h is null").select("g", "o")
    different = rows.where("h is not null").groupBy("g", "h").agg(F.min("o").alias("o")).select("g", "o", "h")
    tables = Kept(frames.sparkSession)
    different = tables.table(different, "hashes")
    large = different.groupBy("g").agg(F.count("*").alias("n")).where(F.col("n") > fold_hashes).select(F.col("g").alias("lg"))
    of_large = F.col("g").eqNullSafe(F.col("lg"))
    folded = different.join(large, of_large, "left_anti").groupBy("g").applyInArrow(_first_of_alike(threshold), kinds)
    kept = folded
    if not large.isEmpty():
        kept = folded.unionByName(_decide(different.join(large, of_large, "left_semi"), threshold, kinds, tables))
    return kept.select("g", "o").union(without).toDF(key, order)


def frames_in_chunks(frames: DataFrame, chunks: DataFrame, half_open: bool = False) -> DataFrame:
    """Frames joined to the chunks whose time they lie in; both ends belong to a chunk unless ``half_open``."""
    c = chunks.select("video_id", "idx", F.col("start_sec").alias("c0"), F.col("end_sec").alias("c1")).withColumn("_stretch", stretches(F.col("c0"), F.col("c1")))
    inside = (F.col("at_sec") >= F.col("c0")) & ((F.col("at_sec") < F.col("c1")) if half_open else (F.col("at_sec") <= F.col("c1")))
    return frames.withColumn("_stretch", stretch(F.col("at_sec"))).join(c, ["video_id", "_stretch"]).where(inside).drop("_stretch", "c0", "c1")


def caption_frames(frames: DataFrame, chunks: DataFrame, most: int = 3) -> DataFrame:
    """(video_id, frame_idx) of each chunk's first frames, scene changes before others."""
    w = Window.partitionBy("video_id", "idx").orderBy(F.when(F.col("kind") == "scene_change", 0).otherwise(1), "at_sec", "frame_idx")
    ranked = frames_in_chunks(frames, chunks).withColumn("r", F.row_number().over(w))
    return ranked.where(F.col("r") <= most).select("video_id", "frame_idx").distinct()


def caption_evenly(frames: DataFrame, chunks: DataFrame, most: int = 3) -> DataFrame:
    """(video_id, frame_idx) of frames spread evenly over each chunk; a frame at a chunk's end belongs to the next."""
    return evenly_spaced(frames_in_chunks(frames, chunks, half_open=True), ["video_id", "idx"], most).select("video_id", "frame_idx").distinct()


def evenly_spaced(frames: DataFrame, keys: list[str], most: int = 3) -> DataFrame:
    """All frames of groups of up to ``most``; of larger ones those at ``floor(i * (n / most))``."""
    w = Window.partitionBy(*keys)
    ranked = frames.withColumn("n", F.count("*").over(w)).withColumn("r", F.row_number().over(w.orderBy("frame_idx")) - 1)
    at = F.transform(F.sequence(F.lit(0), F.lit(max(most - 1, 0))), lambda i: F.floor(i * (F.col("n") / float(most))).cast("int"))
    return ranked.where((F.col("n") <= most) | F.array_contains(at, F.col("r"))).drop("n", "r")
