"""External tools over many files: each row's file is worked on by one command in a Spark task, and what it prints comes back as a column."""

from __future__ import annotations

import hashlib
import os
import re
import subprocess
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reeltide.sources.adapters import TOOL_TIMEOUT, map_text

# The commands; {path} is the row's file, {out} the file to be written.
PROBE = ("ffprobe", "-v", "error", "-print_format", "json", "-show_format", "-show_streams", "{path}")
SILENCE = ("ffmpeg", "-i", "{path}", "-af", "silencedetect=noise=%gdB:d=%g", "-f", "null", "-")
SCENES = ("ffmpeg", "-i", "{path}", "-vf", "select='gt(scene,%g)',showinfo", "-f", "null", "-")
AUDIO = ("ffmpeg", "-y", "-i", "{path}", "-vn", "-ac", "1", "-ar", "16000", "{out}")
FRAME = ("ffmpeg", "-y", "-ss", "{at_sec}", "-i", "{path}", "-frames:v", "1", "-q:v", "{quality}", "{out}")


@dataclass(frozen=True)
class Tools:
    """The commands that media files are worked on with."""

    probe: tuple[str, ...] = PROBE
    silence: tuple[str, ...] = tuple(p % (-35.0, 0.5) if "%g" in p else p for p in SILENCE)
    scenes: tuple[str, ...] = tuple(p % 0.4 if "%g" in p else p for p in SCENES)
    audio: tuple[str, ...] = AUDIO
    frame: tuple[str, ...] = FRAME

    @classmethod
    def of(cls, scene_threshold: float, noise_db: float, least_silence: float) -> Tools:
        """The usual commands with these settings."""
        return cls(silence=tuple(p % (noise_db, least_silence) if "%g" in p else p for p in SILENCE), scenes=tuple(p % scene_threshold if "%g" in p else p for p in SCENES))


def media_files(spark: SparkSession, folder: str, pattern: str = "*.mp4") -> DataFrame:
    """(video_id, path, bytes, modified) of the files of a folder; their contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    path = F.url_decode(F.regexp_replace(F.regexp_replace("path", "^file:/*", "/"), r"\+", "%2B"))
    return with_media_ids(files.select(path.alias("path"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")), folder)


def with_media_ids(files: DataFrame, folder: str) -> DataFrame:
    """Adds video_id: a file's stem where no other file has it, else the stem and a digest of the path below ``folder``."""
    below = F.regexp_replace("path", "^" + re.escape(re.sub("^file:/*", "/", folder).rstrip("/")) + "/+", "")
    named = files.withColumn("video_id", video_id(F.col("path")))
    clashes = named.groupBy("video_id").agg(F.count("*").alias("_n")).where("_n > 1").select("video_id", F.lit(True).alias("_clash"))
    own = F.concat("video_id", F.lit("~"), F.substring(F.sha2(below.cast("binary"), 256), 1, 12))
    return named.join(clashes, "video_id", "left").select(F.when(F.col("_clash"), own).otherwise(F.col("video_id")).alias("video_id"), *files.columns)


def with_source_hash(files: DataFrame) -> DataFrame:
    """Adds source_hash, a digest of each file's contents, read piece by piece."""

    return map_text(files, ["path"], "source_hash", file_hash)


def file_hash(path: str) -> str:
    with open(path, "rb") as f:
        return "sha256:" + hashlib.file_digest(f, "sha256").hexdigest()


def said(command: tuple[str, ...], given: dict[str, object], from_log: bool, must_succeed: bool = True, timeout: float = TOOL_TIMEOUT) -> str:
    """What a command prints (or logs), whose braces stand for what is given."""
    done = subprocess.run([part.format(**given) for part in command], capture_output=True, text=True, timeout=timeout)
    if must_succeed and done.returncode:
        raise OSError(done.stderr[-200:])
    return done.stderr if from_log else done.stdout


def run_tool(files: DataFrame, command: tuple[str, ...], output: str, path_col: str = "path", from_log: bool = False, must_succeed: bool = True, values: tuple[str, ...] = (), out_col: str | None = None, timeout: float = TOOL_TIMEOUT) -> DataFrame:
    """Adds what the tool prints (or logs) for each file; where it fails null, and why in ``<output>_error``.

    ``values``: columns that the command names in braces; ``out_col``: the column of {out}, whose folder is made.
    """
    columns = [path_col, *values, *([out_col] if out_col else [])]

    def call(path: str, *more: object) -> str:
        given = dict(zip(columns[1:], more, strict=True))
        out = given[out_col] if out_col else f"{path}.wav"
        if out_col:
            os.makedirs(os.path.dirname(out), exist_ok=True)
        return said(command, given | {"path": path, "out": out}, from_log, must_succeed, timeout)

    return map_text(files, columns, output, call)


def video_id(path: Column) -> Column:
    """A file's name without folders and its last extension; ``video`` where nothing is left."""
    name = F.element_at(F.split(path, "/"), -1)
    stem = F.regexp_extract(name, r"^(.+?)(\.[^.]*)?$", 1)
    return F.when(stem == "", "video").otherwise(stem)


def frame_path(folder: Column, idx: Column) -> Column:
    return F.concat(folder, F.lit("/"), F.format_string("frame_%03d.jpg", idx))


def jpeg_quality(q: Column) -> Column:
    """Quality 1 to 100 as the encoder's scale, 31 (worst) to 1."""
    return F.least(F.greatest(32 - F.floor(q / 4).cast("int"), F.lit(1)), F.lit(31))
