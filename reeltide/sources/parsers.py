"""Parsers of what external tools print: probe JSON, silence and scene logs, speech-recognition JSON, JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reeltide.functions.text import parse_fraction, parse_timecode, trim_ws

PROBE = "format struct<duration:string>, streams array<struct<codec_type:string, width:int, height:int, r_frame_rate:string>>"
SPEECH = "result array<struct<start:double, end:double, text:string>>, transcription array<struct<offsets:struct<from:bigint, to:bigint>, text:string>>"


def probe(df: DataFrame, json_col: str) -> DataFrame:
    """Adds duration_sec, fps, width, height, has_video, has_audio; later video streams override what they state."""
    p = F.from_json(json_col, PROBE)
    streams = F.coalesce(p["streams"], F.array().cast("array<struct<codec_type:string,width:int,height:int,r_frame_rate:string>>"))
    video = F.filter(streams, lambda s: s["codec_type"] == "video")
    last = lambda field, parse=lambda x: x: F.try_element_at(F.filter(F.transform(video, lambda s: parse(s[field])), lambda x: x.isNotNull()), F.lit(-1))
    return df.withColumns(
        {
            "duration_sec": F.coalesce(p["format"]["duration"].try_cast("double"), F.lit(0.0)),
            "fps": F.coalesce(last("r_frame_rate", parse_fraction), F.lit(0.0)),
            "width": F.coalesce(last("width"), F.lit(0)),
            "height": F.coalesce(last("height"), F.lit(0)),
            "has_video": F.size(video) > 0,
            "has_audio": F.exists(streams, lambda s: s["codec_type"] == "audio"),
        }
    )


# How the tools write times in their logs.
SILENCE_START, SILENCE_END = r"silence_start:\s+([\d.]+)", r"silence_end:\s+([\d.]+)"
SCENE_TIMECODE, SCENE_SECONDS = r"time=([\d:.]+)", r"pts_time:([\d.]+)"


def silence_line(line: Column) -> tuple[Column, Column]:
    """(start, end) of a log line; each null where the line states none. Negative times don't match."""
    return tuple(F.regexp_extract(line, p, 1).try_cast("double") for p in (SILENCE_START, SILENCE_END))


def pair_silences(marks: DataFrame, key: str = "video_id") -> DataFrame:
    """(key, ord, is_start, at_sec) -> (key, start_sec, end_sec): an end closes the latest start since the end before it."""
    w = Window.partitionBy(key).orderBy("ord")
    run = marks.withColumn("run", F.coalesce(F.sum(F.when(F.col("is_start"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    start = F.last(F.when(F.col("is_start"), F.col("at_sec")), True).over(Window.partitionBy(key, "run").orderBy("ord"))
    return run.withColumn("start_sec", start).where("not is_start and start_sec is not null").select(key, "start_sec", F.col("at_sec").alias("end_sec"))


def scene_times(log: Column) -> Column:
    """Times of the lines of a log: ``time=`` (a timecode or seconds) before ``pts_time:``; lines without either are dropped."""
    lines = F.split(log, "\n")

    def at(line: Column) -> Column:
        code, seconds = F.regexp_extract(line, SCENE_TIMECODE, 1), F.regexp_extract(line, SCENE_SECONDS, 1)
        return F.when(code != "", parse_timecode(code)).when(seconds != "", seconds.try_cast("double"))

    return F.filter(F.transform(lines, at), lambda t: t.isNotNull())


def speech_segments(df: DataFrame, json_col: str) -> DataFrame:
    """Explodes recognised speech to (…, pos, start_sec, end_sec, text): ``result`` in seconds, else ``transcription`` in milliseconds; blank texts go."""
    p = F.from_json(json_col, SPEECH)
    seconds = F.transform(p["result"], lambda r: F.struct(F.coalesce(r["start"], F.lit(0.0)).alias("start_sec"), F.coalesce(r["end"], F.lit(0.0)).alias("end_sec"), trim_ws(r["text"]).alias("text")))
    ms = lambda x: F.when(x >= 0, x / 1000.0).otherwise(0.0)
    millis = F.transform(p["transcription"], lambda r: F.struct(ms(r["offsets"]["from"]).alias("start_sec"), ms(r["offsets"]["to"]).alias("end_sec"), trim_ws(r["text"]).alias("text")))
    rows = df.select(*[c for c in df.columns if c != json_col], F.posexplode(F.coalesce(seconds, millis)).alias("pos", "s"))
    return rows.select("*", "s.*").drop("s").where("text <> ''")


def valid_json(line: Column) -> Column:
    return F.call_function("try_parse_json", line).isNotNull()
