"""Segmentation of timelines: coarse segments, semantic chunks, merging, splitting, ids and checks.

Everything is keyed by video and needs one shuffle by it; order-dependent steps are folds over a video's own rows. Texts
meet spans by video and stretch of time, so that a long medium is joined in many small groups.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from reeltide.functions.text import trim_ws

#: The hard limits of chunk length and the length that long chunks are split to, in seconds.
LEAST, MOST, SPLIT = 15.0, 120.0, 60.0
# Rationales of results.
WITH_TEXT, WITHOUT_TEXT = "time-based split within coarse segment", "time-based split without transcript"


#: Seconds of the stretches of time by which spans and what lies in them meet.
STRETCH = 300.0


def stretch(at: Column) -> Column:
    return F.floor(at / STRETCH).cast("bigint")


def stretches(start: Column, end: Column) -> Column:
    """All stretches that a span touches."""
    return F.explode(F.sequence(stretch(start), F.greatest(stretch(end), stretch(start))))


def segment_ends(duration: float, candidates: list[float], most: float, snap: float, symmetric: bool) -> list[float]:
    """The ends of one medium's segments; ``candidates`` in order."""
    ends, start = [], 0.0
    while start < duration:
        target = min(start + most, duration)
        low = max(start, target - snap) if symmetric else start
        high = min(start + most + snap, duration)
        at = bisect_right(candidates, target)
        near = [candidates[k] for k in (at - 1, at) if 0 <= k < len(candidates) and low <= candidates[k] <= high]
        end = min(near, key=lambda c: (abs(c - target), -c)) if near else target
        start = min(start + 1.0, duration) if end <= start else end
        ends.append(start)
    return ends


def coarse_segments(media: DataFrame, candidates: DataFrame, most: float = 300.0, snap: float = 30.0, symmetric: bool = False) -> DataFrame:
    """(video_id, duration_sec), (video_id, at_sec) -> (video_id, seg_index, start_sec, end_sec).

    A segment ends at the candidate nearest to ``start + most`` among those from its start (or, if ``symmetric``,
    from ``snap`` before the target) to ``snap`` past the target, the later of two; where that isn't past its start, a second
    later. Media without positive duration have no segments.
    """
    grouped = candidates.groupBy("video_id").agg(F.array_sort(F.collect_set("at_sec")).alias("cands"))
    m = media.where("duration_sec > 0").select("video_id", F.col("duration_sec").cast("double").alias("duration_sec")).join(grouped, "video_id", "left")

    def run(batches):
        for batch in batches:
            found = [segment_ends(d, c or [], most, snap, symmetric) for d, c in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.float64()))], ["video_id", "ends"])

    rows = m.mapInArrow(run, f"video_id {media.schema['video_id'].dataType.simpleString()}, ends array<double>")
    rows = rows.select("video_id", "ends", F.posexplode("ends").alias("i", "end_sec"))
    return rows.select("video_id", F.col("i").cast("bigint").alias("seg_index"), F.when(F.col("i") == 0, 0.0).otherwise(F.get("ends", F.col("i") - 1)).alias("start_sec"), "end_sec")


def overlap_text(spans: DataFrame, transcript: DataFrame, keys: list[str], trimmed: bool = True) -> DataFrame:
    """``spans`` with transcript_text: the texts of overlapping segments in order; blank ones are skipped if ``trimmed``."""
    text = trim_ws(F.col("text")) if trimmed else F.col("text")
    t = transcript.select("video_id", "seg_idx", F.col("start_sec").alias("t0"), F.col("end_sec").alias("t1"), text.alias("tx"))
    t = t.where("tx <> ''") if trimmed else t
    t = t.withColumn("stretch", stretches(F.col("t0"), F.col("t1")))
    s = spans.select(*keys, F.col("start_sec").alias("s0"), F.col("end_sec").alias("s1")).withColumn("stretch", stretches(F.col("s0"), F.col("s1")))
    # of the stretches that both touch, they meet in the first
    met = s.join(t, ["video_id", "stretch"]).where((F.col("t0") < F.col("s1")) & (F.col("t1") > F.col("s0")) & (F.col("stretch") == F.greatest(stretch(F.col("t0")), stretch(F.col("s0")))))
    hits = met.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("seg_idx", "tx"))).alias("l"))
    hits = hits.select(*keys, F.array_join(F.transform("l", lambda x: x["tx"]), " ").alias("transcript_text"))
    return spans.join(hits, keys, "left").withColumn("transcript_text", F.coalesce("transcript_text", F.lit("")))


def _pieces(start: Column, end: Column, count: Column) -> Column:
    """Equal pieces of [start, end] as structs (j, a, b); the last ends exactly at the end."""
    width = (end - start) / count
    return F.transform(F.sequence(F.lit(0).cast("bigint"), count.cast("bigint") - 1), lambda j: F.struct(j.alias("j"), (start + width * j).alias("a"), F.when(j + 1 == count, end).otherwise(start + width * (j + 1)).alias("b")))


def _count(target_min: float, target_max: float) -> Column:
    target = max((target_min + target_max) / 2, 1.0)
    return F.greatest(F.ceil((F.col("end_sec") - F.col("start_sec")) / target), F.lit(1))


def semantic_chunks(coarse: DataFrame, transcript: DataFrame, target_min: float = 30.0, target_max: float = 90.0) -> DataFrame:
    """Equal pieces of each coarse segment with their own text: (video_id, ord, start_sec, end_sec, transcript_text, rationale)."""
    rows = coarse.where("end_sec > start_sec").withColumn("p", F.explode(_pieces(F.col("start_sec"), F.col("end_sec"), _count(target_min, target_max))))
    rows = rows.select("video_id", (F.col("seg_index") * 1000000 + F.col("p.j")).alias("ord"), F.col("p.a").alias("start_sec"), F.col("p.b").alias("end_sec"))
    spoken = transcript.select("video_id").distinct().withColumn("spoken", F.lit(True))
    rows = overlap_text(rows, transcript, ["video_id", "ord", "start_sec", "end_sec"]).join(spoken, "video_id", "left")
    return rows.withColumn("rationale", F.when(F.col("spoken"), WITH_TEXT).otherwise(WITHOUT_TEXT)).drop("spoken")


def equal_division(coarse_text: DataFrame, target_min: float = 30.0, target_max: float = 90.0) -> DataFrame:
    """Equal pieces of each coarse segment, each with the segment's whole text."""
    rows = coarse_text.where("end_sec > start_sec").withColumn("p", F.explode(_pieces(F.col("start_sec"), F.col("end_sec"), _count(target_min, target_max))))
    return rows.select("video_id", "seg_index", F.col("p.j").alias("part"), F.col("p.a").alias("start_sec"), F.col("p.b").alias("end_sec"), "transcript_text")


def merge_short(chunks: DataFrame, hard_min: float = 15.0) -> DataFrame:
    """Chunks shorter than the limit take in those that follow; a short rest at the end joins the chunk before it."""
    least = min(hard_min, LEAST)
    item = "struct<start_sec:double,end_sec:double,transcript_text:string,rationale:string>"
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("ord", "start_sec", "end_sec", "transcript_text", "rationale"))), lambda x: F.struct(x["start_sec"], x["end_sec"], x["transcript_text"], x["rationale"]).cast(item))
    rows = chunks.groupBy("video_id").agg(ordered.alias("all"))

    def glue(a: Column, b: Column, text: Column) -> Column:
        return F.struct(a["start_sec"].alias("start_sec"), b["end_sec"].alias("end_sec"), text.alias("transcript_text"), F.concat(a["rationale"], F.lit(" + "), b["rationale"]).alias("rationale")).cast(item)

    short = lambda x: x["end_sec"] - x["start_sec"] < least
    both = lambda a, b: F.concat(a["transcript_text"], F.lit(" "), b["transcript_text"])

    def step(acc: Column, x: Column) -> Column:
        now = F.when(acc["open"].isNull(), x).otherwise(glue(acc["open"], x, both(acc["open"], x)))
        closed = F.struct(F.concat(acc["done"], F.array(now)).alias("done"), F.lit(None).cast(item).alias("open"))
        return F.when(short(now), F.struct(acc["done"].alias("done"), now.alias("open"))).otherwise(closed)

    def finish(acc: Column) -> Column:
        done, rest = acc["done"], acc["open"]
        last = F.try_element_at(done, F.lit(-1))
        joined = F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(glue(last, rest, trim_ws(both(last, rest)))))
        return F.when(rest.isNull(), done).when(F.size(done) == 0, F.array(rest)).otherwise(joined)

    begin = F.struct(F.array().cast(f"array<{item}>").alias("done"), F.lit(None).cast(item).alias("open"))
    merged = rows.select("video_id", F.posexplode(F.aggregate("all", begin, step, finish)).alias("ord", "c"))
    return merged.select("video_id", F.col("ord").cast("bigint").alias("ord"), "c.*")


def split_long(chunks: DataFrame, hard_max: float = 120.0) -> DataFrame:
    """Chunks beyond the limit become equal parts of about a minute, each with the whole text."""
    most = max(hard_max, MOST)
    long = (F.col("end_sec") - F.col("start_sec")) > most
    count = F.when(long, F.ceil((F.col("end_sec") - F.col("start_sec")) / min(SPLIT, most / 2))).otherwise(1)
    rows = chunks.withColumn("p", F.explode(_pieces(F.col("start_sec"), F.col("end_sec"), count))).withColumn("long", long)
    rationale = F.when(F.col("long"), F.concat("rationale", F.lit(" (part "), (F.col("p.j") + 1).cast("string"), F.lit(")"))).otherwise(F.col("rationale"))
    return rows.select("video_id", "ord", F.col("p.j").alias("part"), F.when(F.col("long"), F.col("p.a")).otherwise(F.col("start_sec")).alias("start_sec"), F.when(F.col("long"), F.col("p.b")).otherwise(F.col("end_sec")).alias("end_sec"), "transcript_text", rationale.alias("rationale"))


def assign_ids(chunks: DataFrame) -> DataFrame:
    """Numbers the chunks of each video from 0 in order: (video_id, idx, chunk_id, parent_segment_id, …)."""
    from pyspark.sql import Window

    idx = F.row_number().over(Window.partitionBy("video_id").orderBy("ord", "part")) - 1
    rows = chunks.withColumn("idx", idx.cast("bigint"))
    return rows.select("video_id", "idx", F.concat(F.col("video_id").cast("string"), F.lit("_chunk_"), F.format_string("%04d", "idx")).alias("chunk_id"), F.lit("").alias("parent_segment_id"), "start_sec", "end_sec", "transcript_text")


def normalize(chunks: DataFrame, hard_min: float = 15.0, hard_max: float = 120.0, merge: Callable[[DataFrame, float], DataFrame] = merge_short) -> DataFrame:
    return assign_ids(split_long(merge(chunks, hard_min), hard_max))


def watched(segments: DataFrame, media: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
    """``segments`` and what to call once they are written: raises where they don't lead from 0 to each medium's duration without gap or overlap.

    Each end but the last is the next begin, so that hashes of ends and begins, summed while the rows pass by, differ by those of
    0 and the durations; no other pass over the rows is needed.
    """
    seen = Observation()
    key = lambda at: F.xxhash64(F.col("video_id").cast("string"), at.cast("double")).cast("decimal(38,0)")
    zero = F.lit(0).cast("decimal(38,0)")
    rows = segments.observe(seen, (F.coalesce(F.sum(key(F.col("end_sec"))), zero) - F.coalesce(F.sum(key(F.col("start_sec"))), zero)).alias("sum"), F.count_if(F.col("end_sec") <= F.col("start_sec")).alias("empty"))

    def check() -> None:
        want = media.where("duration_sec > 0").agg(F.coalesce(F.sum(key(F.col("duration_sec"))), zero) - F.coalesce(F.sum(key(F.lit(0.0))), zero)).first()[0]
        if seen.get["empty"] or seen.get["sum"] != want:
            raise ValueError(f"segments leave gaps or overlap, or don't reach from 0 to the duration ({seen.get['empty']} are empty)")

    return rows, check


def check_segments(segments: DataFrame, media: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Whether each video's segments start at 0, end at its duration, follow each other and have length."""
    from pyspark.sql import Window

    w = Window.partitionBy("video_id").orderBy("seg_index")
    s = segments.withColumn("next", F.lead("start_sec").over(w))
    s = s.groupBy("video_id").agg(F.count("*").alias("segments"), F.min_by("start_sec", "seg_index").alias("first"), F.max_by("end_sec", "seg_index").alias("last"), F.bool_and(F.coalesce(F.abs(F.col("next") - F.col("end_sec")) <= tolerance, F.lit(True))).alias("continuous"), F.bool_and(F.col("end_sec") > F.col("start_sec")).alias("positive"))
    s = s.join(media.select("video_id", "duration_sec"), "video_id")
    return s.select("video_id", "segments", (F.abs("first") <= tolerance).alias("starts_at_zero"), (F.abs(F.col("last") - F.col("duration_sec")) <= tolerance).alias("ends_at_duration"), "continuous", "positive")


def check_reply(chunks: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """(key, ord, start_sec, end_sec, segment_end) -> (key, valid): a reply's chunks start at 0, end with the segment, don't overlap and leave no gap."""
    from pyspark.sql import Window

    w = Window.partitionBy("key").orderBy("ord")
    c = chunks.withColumn("next", F.lead("start_sec").over(w)).withColumn("r", F.row_number().over(w))
    fits = F.coalesce((F.col("end_sec") <= F.col("next")) & (F.col("next") - F.col("end_sec") <= tolerance), F.abs(F.col("end_sec") - F.col("segment_end")) <= tolerance)
    first = (F.col("r") > 1) | (F.abs("start_sec") <= tolerance)
    return c.groupBy("key").agg(F.bool_and(fits & first & (F.col("end_sec") > F.col("start_sec"))).alias("valid"))
