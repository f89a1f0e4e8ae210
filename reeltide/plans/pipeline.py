"""From facts about media to finished chunks: one lazy plan, with stages that can be kept and taken up again."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reeltide.operators import assemble, chains, frames, segment
from reeltide.plans import contracts
from reeltide.plans.config import Config
from reeltide.plans.manifest import Manifest, finished, input_hash
from reeltide.sources.sinks import Kept


class Ended(Exception):
    """The last stage that was asked for is done."""


class Stages:
    """Runs stages by name. With a folder each is written, and its records kept in the folder's manifest.

    With ``resume`` a media's rows of a stage are read where its newest record is done with the same input hash (source and
    settings) and made anew otherwise; a run that broke off leaves records that aren't done. Stages before ``first`` must be
    there; the one after ``last`` raises Ended.
    """

    def __init__(self, media: DataFrame, config: Config, folder: str | None = None, resume: bool = False, first: str | None = None, last: str | None = None, keys: DataFrame | None = None, typed: bool = False):
        for stage in (first, last):
            if stage is not None and stage not in contracts.STAGES:
                raise ValueError(f"no such stage: {stage}; there are {', '.join(contracts.ordered())}")
        self.spark, self.folder, self.resume, self.first, self.last = media.sparkSession, folder, resume, first, last
        source = F.col("source_hash") if "source_hash" in media.columns else F.lit("").cast("string")
        self.media = media.select(F.col("video_id").cast("string").alias("video_id"), input_hash(source, config.hash()).alias("input_hash"))
        self.keys, self.typed = keys, typed  # keys of each stage, where what it reads is known; else all depend on source and settings alike
        self.begun, self.over = first is None, False
        self.manifest = Manifest(self.spark, folder) if folder else None

    def run(self, name: str, make: Callable[[], DataFrame], watch: Callable[[DataFrame, DataFrame], tuple[DataFrame, Callable[[], None]]] | None = None) -> DataFrame:
        """The stage's rows, all of them keyed by video_id. ``watch`` gets them and the ids (_id) of their media, and gives what checks them once they are written."""
        checked = lambda rows: contracts.check(name, rows, contracts.STAGES[name].gives) if self.typed else rows
        if not self.manifest:
            return checked(make())
        if self.over:
            raise Ended(name)
        self.begun, self.over = self.begun or name == self.first, name == self.last
        wanted = (self.media if self.keys is None else self.keys.select("video_id", F.col(name).alias("input_hash"))).withColumn("stage", F.lit(name))
        done = finished(wanted, self.manifest.records()).select("video_id", "output_path") if self.resume or not self.begun else None
        # one path for each run that wrote this stage
        paths = sorted(r.output_path for r in done.select("output_path").distinct().collect()) if done is not None else []
        todo = wanted.join(done, "video_id", "left_anti") if paths else wanted
        of = lambda rows, ids: rows.join(ids.select(F.col("video_id").alias("_id")), F.col("video_id").cast("string") == F.col("_id"), "left_semi")
        parts = [of(self.spark.read.parquet(p), done.where(F.col("output_path") == p)) for p in paths]
        if self.begun and (not paths or not todo.isEmpty()):
            path = f"{self.folder}/stages/{name}/{uuid.uuid4().hex}"
            self.manifest.add(todo, "running")
            try:
                made = checked(make())
                made = of(made, todo) if paths else made
                made, check = watch(made, todo.select(F.col("video_id").alias("_id"))) if watch else (made, None)
                made.write.parquet(path)
                if check:
                    check()
            except Exception:
                self.manifest.add(todo, "failed")
                raise
            self.manifest.add(todo, "done", path)
            parts.append(self.spark.read.parquet(path))
        if not parts:
            raise FileNotFoundError(f"stage {name} isn't there and lies before {self.first}")
        return reduce(DataFrame.unionByName, parts)


def build(
    media: DataFrame, transcript: DataFrame, silences: DataFrame, scenes: DataFrame, hashes: DataFrame | None = None, config: Config | None = None, folder: str | None = None, resume: bool = False, enrich: Callable[[DataFrame, DataFrame], DataFrame] | None = None, annotate: Callable[[DataFrame], DataFrame] | None = None, split: Callable[[DataFrame], DataFrame] | None = None, first: str | None = None, last: str | None = None, models: str = "",
) -> tuple[DataFrame, DataFrame]:
    """(annotated chunks, frames with kind and texts).

    media: (video_id, duration_sec and, if known, source_hash); transcript: (video_id, seg_idx, start_sec, end_sec, text); silences:
    (video_id, start_sec, end_sec); scenes: (video_id, at_sec); hashes: (video_id, frame_idx, hash); enrich: adds ocr_text and
    visual_caption to frames; models: what names those that split and annotate use; annotate: adds title, summary and keywords to chunks, as a model would, instead of what the
    chunks' own words give; split: makes semantic chunks of coarse segments with their text, instead of equal pieces.
    """
    config = config or Config()
    given = {"media": media, "transcript": transcript, "silences": silences, "scenes": scenes} | ({"hashes": hashes} if hashes is not None else {})
    for name, rows in given.items():
        contracts.check(name, rows, contracts.GIVEN[name])
    known = Kept(media.sparkSession).table(contracts.stage_keys(given, config, more=models), "keys") if folder else None
    stages = Stages(media, config, folder, resume, first, last, known, typed=True)
    c, s, f = config.coarse, config.semantic, config.frames
    starts, ends = silences.select("video_id", F.col("start_sec").alias("at_sec")), silences.select("video_id", F.col("end_sec").alias("at_sec"))
    candidates = starts.unionByName(ends).unionByName(scenes.select("video_id", "at_sec"))

    def shots() -> DataFrame:
        taken = frames.frame_kinds(frames.frame_timestamps(media, scenes, f.periodic_interval_sec, max(f.max_analyzed, 8)), scenes)
        taken = taken.withColumn("path", F.concat(F.lit("images/"), F.col("video_id").cast("string"), F.lit("/frame_"), F.format_string("%03d", "frame_idx"), F.lit(".jpg")))
        if hashes is None:
            return taken
        hashed = taken.join(hashes, ["video_id", "frame_idx"], "left")
        return taken.join(frames.dedupe_frames(hashed, "video_id", "frame_idx", "hash", f.dhash_distance_threshold), ["video_id", "frame_idx"])

    def semantic() -> DataFrame:
        if split is None:
            return segment.semantic_chunks(coarse, transcript, s.target_min_sec, s.target_max_sec)
        return split(segment.overlap_text(coarse, transcript, ["video_id", "seg_index"], trimmed=False))

    def watch(rows: DataFrame, ids: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
        return segment.watched(rows, media.join(ids, F.col("video_id").cast("string") == F.col("_id"), "left_semi"))

    if c.by_successors and c.symmetric_snap:
        raise ValueError("segments by successors aren't symmetric")
    exact = watch if split is None else None  # a model's chunks may leave small gaps
    seen = stages.run("frames", shots)
    coarse = stages.run("coarse", lambda: chains.coarse_segments(media, candidates, c.max_duration_sec, c.snap_window_sec) if c.by_successors else segment.coarse_segments(media, candidates, c.max_duration_sec, c.snap_window_sec, c.symmetric_snap), watch)
    chunks = stages.run("semantic", semantic, exact)
    normal = stages.run("normalize", lambda: segment.normalize(chunks, s.hard_min_sec, s.hard_max_sec, chains.merge_short if c.by_successors else segment.merge_short), exact)
    annotated = stages.run("annotate", lambda: (annotate or assemble.annotate)(normal))
    none = F.lit(None).cast("string")
    return annotated, enrich(seen, normal) if enrich else seen.withColumns({"ocr_text": none, "visual_caption": none})
