"""Segmentation of timelines of any length: no row and no task holds a whole medium.

Where a segment ends depends on where it begins, so that each place it may begin at has one successor. Successors are found for all
places at once, by as-of joins over stretches of time with what lies before and after a stretch carried in; the places that a timeline
really goes through are those reached from its begin, by jumps of doubled length. The results are those of the folds in
``segment``, which hold a medium's own rows in one task and are faster for media of usual length.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reeltide.functions.text import trim_ws
from reeltide.operators.segment import LEAST, stretch
from reeltide.sources.sinks import Kept

#: Seconds by which a length that just suffices is looked for early, as sums and differences are rounded differently.
ROUNDING = 1e-6


def nearest(points: DataFrame, marks: DataFrame) -> DataFrame:
    """``points`` (video_id, at, …) with before and after: the last of ``marks`` (video_id, at) up to it, and the first past it.

    Rows are sorted within stretches of time; one row per stretch carries the marks over its ends.
    """
    rest = [c for c in points.columns if c not in ("video_id", "at")]
    given = points.select("video_id", "at", F.lit(1).alias("kind"), F.struct(F.lit(0).alias("_"), *rest).alias("row"))
    marks = marks.select("video_id", "at").distinct()
    both = given.unionByName(marks.select("video_id", "at", F.lit(0).alias("kind"), F.lit(None).cast(given.schema["row"].dataType).alias("row"))).withColumn("stretch", stretch(F.col("at")))
    inside, mark = Window.partitionBy("video_id", "stretch"), F.when(F.col("kind") == 0, F.col("at"))
    past = lambda w: w.rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumns({"b": F.last(mark, True).over(past(inside.orderBy("at", "kind"))), "a": F.last(mark, True).over(past(inside.orderBy(F.col("at").desc(), F.col("kind").desc())))}).where("kind = 1")
    ends = both.groupBy("video_id", "stretch").agg(F.min(mark).alias("low"), F.max(mark).alias("high"))
    over, outside = Window.partitionBy("video_id"), lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("video_id", "stretch", F.last("high", True).over(outside(over.orderBy("stretch"))).alias("cb"), F.last("low", True).over(outside(over.orderBy(F.col("stretch").desc()))).alias("ca"))
    out = found.join(carried, ["video_id", "stretch"])
    return out.select("video_id", "at", *[F.col(f"row.{c}").alias(c) for c in rest], F.coalesce("b", "cb").alias("before"), F.coalesce("a", "ca").alias("after"))


def ranked(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` (video_id, at, …) numbered from 0 in the order of their times, by counts of stretches and places within."""
    rows = rows.withColumn("stretch", stretch(F.col("at")))
    before = Window.partitionBy("video_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("video_id", "stretch").agg(F.count("*").alias("n")).select("video_id", "stretch", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("video_id", "stretch").orderBy("at")) - 1
    return rows.withColumn("place", place).join(counts, ["video_id", "stretch"]).withColumn(name, (F.col("offset") + F.col("place")).cast("bigint")).drop("stretch", "place", "offset")


def reached(edges: DataFrame, roots: DataFrame, kept: Kept) -> DataFrame:
    """(video_id, at) that are reached from ``roots`` along ``edges`` (video_id, at, next), each place having one; rounds are written tables."""
    jumps = kept.table(edges.where("next is not null").select("video_id", "at", "next"), "jumps")
    known = kept.table(roots.select("video_id", "at"), "reached")
    n = known.count()
    while True:
        known = kept.table(known.unionByName(known.join(jumps, ["video_id", "at"]).select("video_id", F.col("next").alias("at"))).distinct(), "reached")
        last, n = n, known.count()
        if n == last:
            return known
        on = jumps.select("video_id", F.col("at").alias("next"), F.col("next").alias("further"))
        jumps = kept.table(jumps.join(on, ["video_id", "next"]).select("video_id", "at", F.col("further").alias("next")), "jumps")


def _gap(most: float, snap: float):
    """The ends of segments that begin at ``at`` in a gap, up to one that may end at the candidate past it or at the medium's end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = []
            for at, after, duration in zip(*(batch.column(c).to_pylist() for c in ("end", "after", "duration")), strict=True):
                one = [at]
                while at < duration and (after is None or after > min(at + most + snap, duration)):
                    at = min(at + most, duration)
                    one.append(at)
                ends.append(one)
            yield pa.RecordBatch.from_arrays([batch.column("video_id"), batch.column("begin"), batch.column("duration"), pa.array(ends, pa.list_(pa.float64()))], ["video_id", "begin", "duration", "ends"])

    return run


def coarse_segments(media: DataFrame, candidates: DataFrame, most: float = 300.0, snap: float = 30.0) -> DataFrame:
    """As ``segment.coarse_segments`` (not symmetric), by successors."""
    kept = Kept(media.sparkSession)
    kind = media.schema["video_id"].dataType.simpleString()
    m = media.where("duration_sec > 0").select("video_id", F.col("duration_sec").cast("double").alias("duration"))
    marks = kept.table(candidates.select("video_id", F.col("at_sec").cast("double").alias("at")).join(m, "video_id").where("at >= 0 and at <= duration").distinct(), "candidates")
    begins = marks.where("at < duration").unionByName(m.select("video_id", F.lit(0.0).alias("at"), "duration")).distinct()
    begin, duration = F.col("begin"), F.col("duration")

    def aimed(rows: DataFrame) -> DataFrame:
        """Where segments that begin at ``begin`` end by a candidate (snapped), with the candidates around their target (at)."""
        rows = nearest(rows.withColumn("at", F.least(begin + most, duration)), marks)
        low, high = F.when(F.col("before") >= begin, F.col("before")), F.when(F.col("after") <= F.least(begin + most + snap, duration), F.col("after"))
        nearer = F.when(low.isNotNull() & (high.isNull() | (F.col("at") - low < high - F.col("at"))), low).otherwise(high)
        return rows.withColumn("end", F.coalesce(nearer, F.col("at"))).withColumn("snapped", nearer.isNotNull() & (F.col("end") > begin)).withColumn("end", F.when(F.col("end") <= begin, F.least(begin + 1.0, duration)).otherwise(F.col("end")))

    tried = kept.table(aimed(begins.withColumnRenamed("at", "begin")), "aimed")
    over = F.col("snapped") | (F.col("end") >= duration)
    direct = tried.where(over).select("video_id", "begin", "duration", F.array("end").alias("ends"))
    gaps = tried.where(~over).select("video_id", "begin", "end", "after", "duration").mapInArrow(_gap(most, snap), f"video_id {kind}, begin double, duration double, ends array<double>")
    gaps = kept.table(gaps, "gaps")
    last = F.element_at("ends", -1)
    ended = gaps.where(last >= duration)
    beyond = aimed(gaps.where(last < duration).select("video_id", last.alias("begin"), F.col("begin").alias("origin"), "duration", "ends"))
    beyond = beyond.select("video_id", F.col("origin").alias("begin"), "duration", F.concat("ends", F.array("end")).alias("ends"))
    edges = kept.table(direct.unionByName(ended).unionByName(beyond).select("video_id", F.col("begin").alias("at"), "ends", F.when(last < duration, last).alias("next")), "edges")
    known = reached(edges, m.select("video_id", F.lit(0.0).alias("at")), kept)
    each = edges.join(known, ["video_id", "at"]).select("video_id", "at", "ends", F.posexplode("ends").alias("i", "end_sec"))
    each = each.select("video_id", F.when(F.col("i") == 0, F.col("at")).otherwise(F.get("ends", F.col("i") - 1)).alias("at"), "end_sec")
    return ranked(each, "seg_index").select("video_id", "seg_index", F.col("at").alias("start_sec"), "end_sec")


def merge_short(chunks: DataFrame, hard_min: float = 15.0) -> DataFrame:
    """As ``segment.merge_short``, by successors; a medium's chunks begin and end one after the other."""
    least = min(hard_min, LEAST)
    kept = Kept(chunks.sparkSession)
    c = kept.table(chunks.select("video_id", "ord", F.col("start_sec").alias("at"), "end_sec", "transcript_text", "rationale"), "chunks")
    ends = c.select("video_id", F.col("end_sec").alias("at"))
    first = nearest(c.select("video_id", (F.col("at") + least - ROUNDING).alias("at"), F.col("at").alias("begin")), ends).select("video_id", "begin", F.col("after").alias("at"))
    second = nearest(first.where("at is not null"), ends).select("video_id", "begin", F.when(F.col("at") - F.col("begin") >= least, F.col("at")).otherwise(F.col("after")).alias("end_sec"))
    follows = nearest(c.select("video_id", "at", "end_sec"), c).select("video_id", "end_sec", F.col("after").alias("next"))
    closed = second.where("end_sec is not null").join(follows, ["video_id", "end_sec"]).select("video_id", F.col("begin").alias("at"), "next", F.lit(True).alias("closed"))
    edges = kept.table(closed, "edges")
    known = reached(edges, c.groupBy("video_id").agg(F.min("at").alias("at")), kept)
    rows = nearest(c.withColumnRenamed("end_sec", "end"), known)
    item = F.array_sort(F.collect_list(F.struct("ord", "at", "end", "transcript_text", "rationale")))
    text: Column = F.array_join(F.transform("l", lambda x: x["transcript_text"]), " ")
    whole = rows.groupBy("video_id", F.col("before").alias("head")).agg(item.alias("l"))
    whole = whole.select("video_id", F.col("head").alias("at"), F.element_at("l", -1)["end"].alias("end_sec"), text.alias("transcript_text"), F.array_join(F.transform("l", lambda x: x["rationale"]), " + ").alias("rationale"))
    whole = kept.table(whole.join(edges, ["video_id", "at"], "left"), "merged")
    # what is left at the end of a medium joins the chunk before it, if there is one
    open_ = whole.where("closed is null").select("video_id", F.col("at").alias("next"), F.col("end_sec").alias("e2"), F.col("transcript_text").alias("t2"), F.col("rationale").alias("r2"))
    alone = open_.join(whole.where("closed").select("video_id", "next"), ["video_id", "next"], "left_anti").select("video_id", F.col("next").alias("at"), F.col("e2").alias("end_sec"), F.col("t2").alias("transcript_text"), F.col("r2").alias("rationale"))
    joined = whole.where("closed").join(open_, ["video_id", "next"], "left")
    has = F.col("e2").isNotNull()
    joined = joined.select("video_id", "at", F.coalesce("e2", "end_sec").alias("end_sec"), F.when(has, trim_ws(F.concat("transcript_text", F.lit(" "), "t2"))).otherwise(F.col("transcript_text")).alias("transcript_text"), F.when(has, F.concat("rationale", F.lit(" + "), "r2")).otherwise(F.col("rationale")).alias("rationale"))
    return ranked(joined.unionByName(alone), "ord").select("video_id", "ord", F.col("at").alias("start_sec"), "end_sec", "transcript_text", "rationale")
