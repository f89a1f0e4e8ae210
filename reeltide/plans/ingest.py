"""From media files to the tables that the pipeline starts from, by external tools in Spark's tasks.

Files of a folder that all executors see are probed; sound is extracted and recognised and its silences found where there is
sound, scene changes where there are pictures. What fails is null with its reason in ``errors``, and such media go on with
what is left.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reeltide.functions.text import trim_ws
from reeltide.plans.facts import FactStore
from reeltide.sources import adapters, parsers, tools


@dataclass
class Facts:
    """What is known of some media: media (video_id, path, bytes, source_hash, duration_sec, …, has_video, has_audio), transcript, silences, scenes, errors (video_id, step, error)."""

    media: DataFrame
    transcript: DataFrame
    silences: DataFrame
    scenes: DataFrame
    errors: DataFrame


def facts(spark: SparkSession, folder: str, work: str, speech: adapters.SpeechAdapter | None = None, commands: tools.Tools | None = None, pattern: str = "*.mp4") -> Facts:
    """The facts of all files of ``folder``; ``work`` takes what the tools write, and what they said of each content.

    Tools run only for contents that ``work`` doesn't know yet from the same command (see FactStore).
    """
    commands = commands or tools.Tools()
    store = FactStore(spark, f"{work}/facts")
    errors: list[DataFrame] = []

    def said(rows: DataFrame, step: str, command: object, run: Callable[[DataFrame], DataFrame]) -> DataFrame:
        found = store.of(rows, step, command, run)
        errors.append(found.where("error is not null").select("video_id", F.lit(step).alias("step"), "error"))
        return found.drop("error")

    def tool(command: tuple[str, ...], **how) -> Callable[[DataFrame], DataFrame]:
        return lambda rows: tools.run_tool(rows, command, "output", **how)

    files = store.hashed(tools.media_files(spark, folder, pattern), tools.with_source_hash)
    errors.append(files.where("source_hash_error is not null").select("video_id", F.lit("hash").alias("step"), F.col("source_hash_error").alias("error")))
    probed = said(files.drop("source_hash_error", "modified"), "probe", commands.probe, tool(commands.probe))
    media = parsers.probe(probed, "output").drop("output")
    spoken, shown = media.where("has_audio").select("video_id", "path", "source_hash"), media.where("has_video").select("video_id", "path", "source_hash")
    wav_path = F.concat(F.lit(f"{work}/audio/"), F.regexp_replace("source_hash", "^.*:", ""), F.lit(".wav"))
    wav = said(spoken.withColumn("wav_path", wav_path), "audio", commands.audio, tool(commands.audio, out_col="wav_path")).where("output is not null").select("video_id", "source_hash", "wav_path")
    if speech:
        heard = said(wav, "asr", speech, lambda rows: adapters.transcribe(rows, speech).withColumnsRenamed({"asr_json": "output", "asr_json_error": "output_error"}))
    else:
        heard = wav.withColumn("output", F.lit(None).cast("string"))
    transcript = parsers.speech_segments(heard.select("video_id", "output"), "output").withColumnRenamed("pos", "seg_idx")
    quiet = said(spoken, "silence", commands.silence, tool(commands.silence, from_log=True))
    lines = quiet.select("video_id", F.posexplode(F.split("output", "\n")).alias("ord", "line"))
    start, end = parsers.silence_line(F.col("line"))
    marks = lines.select("video_id", "ord", start.alias("a"), end.alias("b")).where("a is not null or b is not null")
    silences = parsers.pair_silences(marks.select("video_id", "ord", F.col("a").isNotNull().alias("is_start"), F.coalesce("a", "b").alias("at_sec")))
    cuts = said(shown, "scene", commands.scenes, tool(commands.scenes, from_log=True))
    scenes = cuts.select("video_id", F.explode(parsers.scene_times(F.col("output"))).alias("at_sec"))
    return Facts(media, transcript, silences, scenes, reduce(DataFrame.unionByName, errors))


def take_frames(frames: DataFrame, media: DataFrame, work: str, commands: tools.Tools | None = None, quality: int = 85) -> DataFrame:
    """``frames`` (video_id, frame_idx, at_sec) with path, the picture taken at that time, and frame_error where none was."""
    commands = commands or tools.Tools()
    out = tools.frame_path(F.concat(F.lit(f"{work}/images/"), "video_id"), F.col("frame_idx"))
    rows = frames.join(media.select("video_id", F.col("path").alias("source")), "video_id").withColumns({"path": out, "quality": tools.jpeg_quality(F.lit(quality))})
    rows = tools.run_tool(rows, commands.frame, "frame", path_col="source", values=("at_sec", "quality"), out_col="path")
    return rows.drop("frame", "source", "quality")


def read_pictures(frames: DataFrame, ocr: adapters.OcrAdapter | None, captions: adapters.CaptionAdapter | None, chosen: DataFrame | None = None, languages: tuple[str, ...] = ("jpn", "eng")) -> DataFrame:
    """``frames`` with ocr_text and, for the ``chosen`` (video_id, frame_idx) ones, visual_caption."""
    none = F.lit(None).cast("string")
    frames = adapters.read_frames(frames, ocr, languages).withColumn("ocr_text", F.nullif(trim_ws(F.col("ocr_text")), F.lit(""))) if ocr else frames.withColumns({"ocr_text": none, "ocr_text_error": none})
    if captions is None:
        return frames.withColumns({"visual_caption": none, "visual_caption_error": none})
    keys = ["video_id", "frame_idx"]
    wanted = adapters.caption_frames(frames.select(*keys, "path").join(chosen, keys, "left_semi") if chosen is not None else frames.select(*keys, "path"), captions)
    return frames.join(wanted.drop("path"), keys, "left")
