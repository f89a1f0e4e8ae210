"""Command line: process media or tables to chunks, validate JSON lines, inspect stage records, estimate."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reeltide.functions.text import estimate, trim_ws
from reeltide.plans.config import Config
from reeltide.plans.facts import command_hash
from reeltide.plans.manifest import Manifest, latest
from reeltide.sources import adapters, sinks, tools
from reeltide.sources.parsers import valid_json


def validate(spark: SparkSession, path: str) -> tuple[int, int]:
    """(valid, invalid) lines of a JSON lines file; blank ones don't count."""
    ok = valid_json(F.col("value"))
    row = spark.read.text(path).where(trim_ws(F.col("value")) != "").agg(F.count_if(ok), F.count_if(~ok)).first()
    return row[0], row[1]


def process(spark: SparkSession, source: str, out: str, config: Config, resume: bool = False, first: str | None = None, last: str | None = None, commands: tools.Tools | None = None, speech: adapters.SpeechAdapter | None = None, ocr: adapters.OcrAdapter | None = None, captions: adapters.CaptionAdapter | None = None, model: adapters.LanguageModel | None = None, pattern: str = "*.mp4") -> None:
    """All media of a folder (or, if it holds them, of its tables) to chunks, Markdown and index below ``out``."""
    from reeltide.operators import assemble, frames, images
    from reeltide.plans import catalogue, ingest, pipeline

    annotate = (lambda chunks: adapters.annotate_with(chunks, model)) if model else None
    models = command_hash(model) if model else ""
    split = (lambda coarse: adapters.semantic_with(coarse, model)) if model and config.semantic.by_model else None
    commands = commands or tools.Tools.of(config.frames.scene_change_threshold, config.silence.noise_db, config.silence.min_duration_sec)
    if sinks.exists(spark, f"{source}/conversations.parquet"):
        given = catalogue.Facts(spark, source)
        media = given.media
        annotated, seen = pipeline.build(media, given.transcript, given.silences, given.scenes, config=config, folder=out, resume=resume, annotate=annotate, split=split, first=first, last=last, models=models)
        sources = media.select("video_id", F.concat(F.lit("media/"), F.col("video_id").cast("string")).alias("source_path"), F.lit(None).cast("string").alias("source_hash"), F.lit(True).alias("has_audio"))
    else:
        facts = ingest.facts(spark, source, out, speech, commands, pattern)
        media = facts.media

        def enrich(shots: DataFrame, chunks: DataFrame) -> DataFrame:
            """Pictures of media that have any, near-duplicates dropped, with their texts."""
            kept = sinks.Kept(spark, f"{out}/pictures")
            taken = kept.table(ingest.take_frames(shots.drop("path"), media.where("has_video"), out, commands), "frames").where("frame_error is null").drop("frame_error")
            taken = taken.join(images.file_hashes(spark, f"{out}/images"), "path", "left")
            unique = frames.dedupe_frames(taken, "video_id", "frame_idx", "hash", config.frames.dhash_distance_threshold)
            taken = kept.table(taken.join(unique, ["video_id", "frame_idx"]).drop("hash"), "unique")
            choose = frames.caption_evenly if config.vision.caption_choice == "even" else frames.caption_frames
            chosen = choose(taken, chunks, config.vision.captions_per_chunk) if captions else None
            return kept.table(ingest.read_pictures(taken, ocr, captions, chosen, config.vision.languages), "read")

        annotated, seen = pipeline.build(media, facts.transcript, facts.silences, facts.scenes, config=config, folder=out, resume=resume, enrich=enrich, annotate=annotate, split=split, first=first, last=last, models=models)
        sources = media.select("video_id", F.col("path").alias("source_path"), "source_hash", "has_audio")
        facts.errors.write.mode("overwrite").json(f"{out}/errors.jsonl")
    sinks.write_chunks(assemble.build_chunks(annotated, seen, sources, config.speech.adapter, config.vision.caption_adapter), out)
    sinks.write_annotated(annotated.drop("annotation_error"), out)
    sinks.write_markdown(assemble.markdown(annotated), out)
    sinks.write_index(assemble.output_index(annotated, media), out)


def inspect(spark: SparkSession, out: str) -> DataFrame:
    """The newest record of each media's stage, in order."""
    return latest(Manifest(spark, out).records()).orderBy("video_id", "stage")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser("reeltide")
    commands = parser.add_subparsers(dest="command", required=True)
    p = commands.add_parser("process")
    p.add_argument("source", help="a folder of media files, or of tables")
    p.add_argument("out")
    p.add_argument("--config")
    p.add_argument("--pattern", default="*.mp4")
    p.add_argument("--resume", action="store_true", help="take stages that are done with the same source and settings")
    p.add_argument("--force", action="store_true", help="make every stage anew, whatever is there")
    p.add_argument("--from", dest="first")
    p.add_argument("--to", dest="last")
    commands.add_parser("validate").add_argument("jsonl")
    commands.add_parser("inspect").add_argument("out")
    commands.add_parser("estimate").add_argument("path")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("reeltide").getOrCreate()
    if args.command == "process":
        from reeltide.plans.pipeline import Ended

        config = Config.load(args.config)
        speech = adapters.speech_of(config.speech.command, config.speech.model, config.speech.language)
        ocr, captions = adapters.ocr_of(config.vision.ocr_adapter), adapters.captions_of(config.vision.caption_adapter)
        try:
            process(spark, args.source, args.out, config, args.resume and not args.force, args.first, args.last, speech=speech, ocr=ocr, captions=captions, model=adapters.model_from_environment(), pattern=args.pattern)
        except Ended as e:
            print(f"ended before stage {e}")
    elif args.command == "validate":
        valid, invalid = validate(spark, args.jsonl)
        print(f"valid: {valid}, invalid: {invalid}")
        return int(invalid > 0)
    elif args.command == "inspect":
        inspect(spark, args.out).show(1000, False)
    else:
        files = spark.read.format("binaryFile").load(args.path).select("path", "length")
        files.select("path", *[c.alias(k) for k, c in estimate(F.col("length")).items()]).show(1000, False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
