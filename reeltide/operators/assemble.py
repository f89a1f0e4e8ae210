"""Annotation and assembly of chunks, and the rows of the output documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reeltide.functions import text as X
from reeltide.operators.frames import frames_in_chunks

#: Fixed value: the text of chunks without any.
NO_TEXT = "No transcript available. Chunk generated from timing and visual boundaries."
#: The columns of a finished chunk that are the same for all.
SCHEMA_VERSION, SOURCE_TYPE, CONTENT_TYPE, RATIONALE = "1.0", "local_mp4", "screen_recording", "coarse+time-based semantic segmentation"


def annotate(chunks: DataFrame) -> DataFrame:
    """Adds title, summary and keywords, all from the transcript (or, without one, from the chunk's time)."""
    blank = F.concat(F.lit("Segment "), F.col("chunk_id"), F.lit(" ("), X.time_range(F.col("start_sec"), F.col("end_sec")), F.lit(")"))
    title = lambda t: F.when(t == "", blank).otherwise(X.title(t))
    summary = lambda t: F.when(t == "", F.lit(NO_TEXT)).otherwise(X.summarize(t))
    made = X.once(X.trim_ws(F.col("transcript_text")), lambda t: X.once(title(t), lambda n: F.struct(n.alias("title"), summary(t).alias("summary"), X.keywords(n, t).alias("keywords"))))
    return chunks.select("*", F.inline(F.array(made)))


def _ordered_texts(column: str, by: str) -> Column:
    """The distinct texts of a group's frames in their order, joined; null where there are none."""
    text = X.trim_ws(F.col(column))
    rows = F.array_sort(F.collect_list(F.when(text != "", F.struct("frame_idx", text.alias("t")))))
    return F.nullif(F.array_join(F.array_distinct(F.transform(rows, lambda x: x["t"])), by), F.lit("")).alias(column)


def _refs() -> Column:
    rows = F.array_sort(F.collect_list(F.struct("frame_idx", F.struct("path", "at_sec", "kind", F.lit(True).alias("analyzed")).alias("ref"))))
    return F.transform(rows, lambda x: x["ref"]).alias("image_refs")


def visual_text(frames: DataFrame, chunks: DataFrame) -> DataFrame:
    """(video_id, idx, ocr_text, visual_caption): each chunk's distinct texts in order of their frames."""
    return frames_in_chunks(frames, chunks).groupBy("video_id", "idx").agg(_ordered_texts("ocr_text", "\n"), _ordered_texts("visual_caption", " "))


def image_refs(frames: DataFrame, chunks: DataFrame) -> DataFrame:
    """(video_id, idx, image_refs): each chunk's frames in order."""
    return frames_in_chunks(frames, chunks).groupBy("video_id", "idx").agg(_refs())


def evidence(frames: DataFrame, chunks: DataFrame) -> DataFrame:
    """What ``visual_text`` and ``image_refs`` give, by one join and one aggregation."""
    return frames_in_chunks(frames, chunks).groupBy("video_id", "idx").agg(_ordered_texts("ocr_text", "\n"), _ordered_texts("visual_caption", " "), _refs())


def build_chunks(annotated: DataFrame, frames: DataFrame, sources: DataFrame, asr: str = "whisper_cpp", vlm: str = "stub", generated_at: Column | None = None) -> DataFrame:
    """The finished chunks. ``sources``: (video_id, source_path, source_hash, has_audio)."""
    refs = "array<struct<path:string,at_sec:double,kind:string,analyzed:boolean>>"
    rows = annotated.join(evidence(frames, annotated.select("video_id", "idx", "start_sec", "end_sec")), ["video_id", "idx"], "left").join(sources, "video_id")
    rows = rows.withColumn("image_refs", F.coalesce("image_refs", F.array().cast(refs)))
    spoken = F.col("has_audio") & (X.trim_ws(F.col("transcript_text")) != "")
    return rows.select(
        F.lit(SCHEMA_VERSION).alias("schema_version"), F.col("video_id").cast("string").alias("video_id"), "idx", F.lit(SOURCE_TYPE).alias("source_type"), "source_path", "source_hash", "chunk_id", "parent_segment_id", "start_sec", "end_sec",
        X.timecode(F.col("start_sec")).alias("start_tc"), X.timecode(F.col("end_sec")).alias("end_tc"), F.greatest(F.col("end_sec") - F.col("start_sec"), F.lit(0.0)).alias("duration_sec"), F.lit(CONTENT_TYPE).alias("content_type"), F.array().cast("array<string>").alias("speaker_info"),
        "title", "summary", F.col("transcript_text").alias("transcript"), "ocr_text", "visual_caption", "keywords", X.embedding_text(F.col("title"), F.col("summary"), F.col("transcript_text"), F.col("ocr_text"), F.col("visual_caption")).alias("embedding_text"), "image_refs",
        F.struct(F.lit("local").alias("type"), F.col("start_sec")).alias("source_jump_ref"), F.struct(spoken.alias("has_speech"), F.col("ocr_text").isNotNull().alias("has_ocr"), (F.size("image_refs") > 0).alias("has_visual")).alias("modality_flags"),
        F.struct(F.lit(RATIONALE).alias("segmentation_rationale"), F.lit(asr).alias("asr_adapter"), F.lit(vlm).alias("vlm_adapter"), (F.current_timestamp() if generated_at is None else generated_at).alias("generated_at")).alias("processing_meta"),
    )


def json_line(df: DataFrame) -> Column:
    """Each row as one compact JSON object, nulls included."""
    return F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})


def output_index(chunks: DataFrame, media: DataFrame) -> DataFrame:
    """(video_id, total_chunks, total_duration_sec, chunks_file, markdown_file)"""
    counts = chunks.groupBy("video_id").agg(F.count("*").alias("total_chunks"))
    return media.join(counts, "video_id", "left").select("video_id", F.coalesce("total_chunks", F.lit(0)).cast("bigint").alias("total_chunks"), F.col("duration_sec").alias("total_duration_sec"), F.lit("chunks.jsonl").alias("chunks_file"), F.lit("chunks.md").alias("markdown_file"))


def markdown(annotated: DataFrame) -> DataFrame:
    """(video_id, document): heading, numbered contents and a section for each chunk."""
    n, start, end = (F.col("idx") + 1).cast("string"), X.clock(F.col("start_sec")), X.clock(F.col("end_sec"))
    entry = F.concat(n, F.lit(". ["), F.col("title"), F.lit("](#"), F.col("idx").cast("string"), F.lit(") - "), start, F.lit("\n"))
    said = F.when(F.col("transcript_text") != "", F.concat(F.lit("**Transcript:**\n```\n"), F.col("transcript_text"), F.lit("\n```\n\n"))).otherwise("")
    section = F.concat(F.lit("## "), n, F.lit(" - "), F.col("title"), F.lit(" ("), start, F.lit("–"), end, F.lit(")\n\n**Summary:** "), F.col("summary"), F.lit("\n\n**Keywords:** "), F.array_join("keywords", ", "), F.lit("\n\n"), said, F.lit("\n---\n\n"))
    parts = F.array_sort(F.collect_list(F.struct("idx", entry.alias("e"), section.alias("s"))))
    joined = lambda f: F.array_join(F.transform("p", lambda x: x[f]), "")
    rows = annotated.groupBy("video_id").agg(parts.alias("p"))
    return rows.select("video_id", F.concat(F.lit("# Video Analysis: "), F.col("video_id").cast("string"), F.lit("\n\n## Contents\n\n"), joined("e"), F.lit("\n---\n\n"), joined("s")).alias("document"))
