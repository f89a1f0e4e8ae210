"""Timeline relations derived from the given tables: the media are conversations, the signals their events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("video_id"), F.col("turn").alias("seg_idx"), "text", F.col("role").alias("speaker"))
    return turns.withColumn("ms", F.greatest(F.lit(500), 120 * F.length("text")).cast("bigint"))


def transcript(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, seg_idx, start_sec, end_sec, text, speaker): turns laid end to end, 120 ms a character, 500 ms at least."""
    turns = _turns(spark, sf_dir)
    end = F.sum("ms").over(Window.partitionBy("video_id").orderBy("seg_idx"))
    return turns.withColumn("end_ms", end).select("video_id", "seg_idx", ((F.col("end_ms") - F.col("ms")) / 1000.0).alias("start_sec"), (F.col("end_ms") / 1000.0).alias("end_sec"), "text", "speaker", "end_ms")


def media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, dur_ms, duration_sec)"""
    return _turns(spark, sf_dir).groupBy("video_id").agg(F.sum("ms").alias("dur_ms")).withColumn("duration_sec", F.col("dur_ms") / 1000.0)


def signals(spark: SparkSession, sf_dir: str, of: DataFrame | None = None) -> DataFrame:
    """(video_id, event_id, event_type, at_sec): each event falls somewhere in its user's media (``of``, where they are made already)."""
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("video_id"), "event_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    joined = events.join(media(spark, sf_dir) if of is None else of, "video_id")
    return joined.select("video_id", "event_id", "event_type", (F.expr("us div 1000 % dur_ms") / 1000.0).alias("at_sec"))


def silence_marks(signals: DataFrame) -> DataFrame:
    """(video_id, ord, is_start, at_sec): starts and ends of silence in log order."""
    marks = signals.where("event_type in ('click', 'purchase')")
    return marks.select("video_id", F.struct("at_sec", "event_id").alias("ord"), (F.col("event_type") == "click").alias("is_start"), "at_sec")


def scenes(signals: DataFrame) -> DataFrame:
    """(video_id, at_sec)"""
    return signals.where("event_type = 'view'").select("video_id", "at_sec")


def frame_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(grp, seq, hash): one perceptual hash for each embedding, in groups by label."""
    from reeltide.functions.text import difference_hash

    return table(spark, sf_dir, "embeddings").select(F.col("label").alias("grp"), F.col("vec_id").alias("seq"), difference_hash(F.col("embedding")).alias("hash"))
