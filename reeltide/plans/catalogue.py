"""The registered queries of the media timeline engine; their SQL twins are in ``oracles``."""

from __future__ import annotations

import json
import re
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reeltide.functions import text as X
from reeltide.operators import assemble, chains, frames, segment
from reeltide.plans.facts import FactStore
from reeltide.plans.manifest import STAGES, cache_key, pending
from reeltide.plans.oracles import ORACLE_SQL  # noqa: F401
from reeltide.sources import adapters, parsers, sinks, timeline, tools
from reeltide.sources.adapters import STUB_CAPTION
from reeltide.sources.timeline import table


class Facts:
    """The timeline of one folder of tables. What many of a query's branches read is written once; the rest is plans.

    ``once``: the query reads media and signals in one or two branches, whose exchanges Spark shares, so that they aren't written.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, once: bool = False):
        self.spark, self.sf_dir, self.kept, self.once = spark, sf_dir, sinks.Kept(spark), once

    def _shared(self, rows: DataFrame, name: str) -> DataFrame:
        return rows if self.once else self.kept.table(rows, name)

    @cached_property
    def media(self) -> DataFrame:
        return self._shared(timeline.media(self.spark, self.sf_dir), "media")

    @cached_property
    def signals(self) -> DataFrame:
        return self._shared(timeline.signals(self.spark, self.sf_dir, self.media), "signals")

    @cached_property
    def transcript(self) -> DataFrame:
        return timeline.transcript(self.spark, self.sf_dir)

    @property
    def scenes(self) -> DataFrame:
        return timeline.scenes(self.signals)

    @property
    def silences(self) -> DataFrame:
        return parsers.pair_silences(timeline.silence_marks(self.signals))

    @property
    def coarse(self) -> DataFrame:
        s = self.silences.select("video_id", F.explode(F.array("start_sec", "end_sec")).alias("at_sec"))
        return segment.coarse_segments(self.media, s.union(self.scenes))

    @property
    def semantic(self) -> DataFrame:
        return segment.semantic_chunks(self.kept.table(self.coarse, "coarse"), self.transcript)

    @property
    def normalized(self) -> DataFrame:
        return segment.normalize(self.semantic)

    @cached_property
    def chunks(self) -> DataFrame:
        """The normalised chunks, for queries that read them several times."""
        return self.kept.table(self.normalized, "normalized")

    @property
    def stamps(self) -> DataFrame:
        return frames.frame_timestamps(self.media, self.scenes)

    @cached_property
    def frames(self) -> DataFrame:
        """Frames with kind, path and hash (an embedding's), near-duplicates dropped."""
        kinds = frames.frame_kinds(self.kept.table(self.stamps, "stamps"), self.scenes)
        ids = F.pmod(F.col("video_id") * 8 + F.col("frame_idx"), table(self.spark, self.sf_dir, "embeddings").agg(F.count("*")).scalar())
        f = kinds.withColumn("path", F.concat(F.lit("images/"), F.col("video_id").cast("string"), F.lit("/frame_"), F.format_string("%03d", "frame_idx"), F.lit(".jpg"))).withColumn("seq", ids.cast("bigint"))
        f = self.kept.table(f.join(timeline.frame_hashes(self.spark, self.sf_dir).select("seq", "hash"), "seq", "left"), "frames")
        return f.join(frames.dedupe_frames(f, "video_id", "frame_idx", "hash"), ["video_id", "frame_idx"]).select("video_id", "frame_idx", "at_sec", "kind", "path")

    @property
    def enriched(self) -> DataFrame:
        """Frames with recognised text (a document's) and, for chosen ones, the stub's caption."""
        docs = table(self.spark, self.sf_dir, "documents")
        f = self.kept.table(self.frames, "unique").withColumn("doc_id", F.pmod(F.col("video_id") * 8 + F.col("frame_idx"), docs.agg(F.count("*")).scalar()).cast("bigint"))
        f = f.join(docs.select("doc_id", F.col("text").alias("ocr_text")), "doc_id", "left")
        chosen = frames.caption_frames(f, self.chunks).withColumn("chosen", F.lit(True))
        caption = F.when(F.col("chosen"), F.concat(F.lit(STUB_CAPTION), F.element_at(F.split("path", "/"), -1)))
        return f.join(chosen, ["video_id", "frame_idx"], "left").select("video_id", "frame_idx", "at_sec", "kind", "path", "ocr_text", caption.alias("visual_caption"))


def fx_transcript(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.transcript(spark, sf_dir).drop("end_ms")


def fx_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.signals(spark, sf_dir)


def silence_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsers.pair_silences(timeline.silence_marks(timeline.signals(spark, sf_dir)))


def silence_log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines made from the signals, parsed line by line and paired."""
    s = timeline.signals(spark, sf_dir)
    ms = F.round(F.col("at_sec") * 1000).cast("bigint")
    seconds = F.concat(F.floor(ms / 1000).cast("string"), F.lit("."), F.format_string("%03d", ms % 1000))
    line = F.when(F.col("event_type") == "click", F.concat(F.lit("[silencedetect @ 0x1] silence_start: "), seconds)).when(F.col("event_type") == "purchase", F.concat(F.lit("[silencedetect @ 0x1] silence_end: "), seconds, F.lit(" | silence_duration: 1"))).otherwise(F.concat(F.lit("size=N/A silence_start: -"), seconds))
    start, end = parsers.silence_line(F.col("line"))
    marks = s.select("video_id", F.struct("at_sec", "event_id").alias("ord"), line.alias("line")).select("video_id", "ord", start.alias("a"), end.alias("b")).where("a is not null or b is not null")
    return parsers.pair_silences(marks.select("video_id", "ord", F.col("a").isNotNull().alias("is_start"), F.coalesce("a", "b").alias("at_sec")))


def scene_log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log per video with both ways to write times; errors have a bad timecode, which drops the line."""
    s = timeline.signals(spark, sf_dir).where("event_type in ('view', 'signup', 'error')")
    ms = F.round(F.col("at_sec") * 1000).cast("bigint")
    pts = F.concat(F.lit("pts_time:"), F.floor(ms / 1000).cast("string"), F.lit("."), F.format_string("%03d", ms % 1000))
    line = F.when(F.col("event_type") == "view", F.concat(F.lit("n: 1 "), pts)).when(F.col("event_type") == "signup", F.concat(pts, F.lit(" time="), X.timecode(F.col("at_sec")))).otherwise(F.concat(pts, F.lit(" time=12:34")))
    logs = s.groupBy("video_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at_sec", "event_id", line.alias("line")))), lambda x: x["line"]), "\n").alias("log"))
    return logs.select("video_id", F.posexplode(parsers.scene_times(F.col("log"))).alias("pos", "at_sec"))


def timecode_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = timeline.signals(spark, sf_dir).select("event_id", X.timecode(F.col("at_sec")).alias("tc"))
    return s.select("event_id", "tc", X.parse_timecode(F.col("tc")).alias("seconds"))


def probe_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probe output made from orders: two streams of video, the second without a height for some, and audio for some."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    k = F.col("o_orderkey").cast("string")
    odd = F.col("o_orderkey") % 2 == 1
    text = F.concat(
        F.lit('{"format":'), F.when(F.col("o_orderkey") % 5 == 0, "{}").otherwise(F.concat(F.lit('{"duration":"'), k, F.lit('.5"}'))),
        F.lit(',"streams":[{"codec_type":"video","width":640,"height":480,"r_frame_rate":"30000/1001"}'), F.when(odd, F.concat(F.lit(',{"codec_type":"video","width":'), k, F.lit(',"r_frame_rate":"'), k, F.lit('/2"}'))).otherwise(""),
        F.when(F.col("o_orderkey") % 3 == 0, '],"x":1}').otherwise(',{"codec_type":"audio"}]}'),
    )
    return parsers.probe(o.withColumn("json", text), "json").drop("json")


def fraction_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 11 == 0, "bad").when(F.col("event_id") % 13 == 0, "1/2/3").otherwise(F.concat((F.col("event_id") * 1000).cast("string"), F.lit("/"), (F.col("event_id") % 97 + 1).cast("string"))).alias("fraction"))
    return e.select("event_id", X.parse_fraction(F.col("fraction")).alias("value"))


def asr_json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recognised speech as JSON, in seconds for even media and in milliseconds for odd ones, parsed again."""
    t = timeline.transcript(spark, sf_dir)
    ms0, ms1 = F.round(F.col("start_sec") * 1000).cast("bigint"), F.col("end_ms")
    rows = t.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("seg_idx", "start_sec", "end_sec", ms0.alias("m0"), ms1.alias("m1"), "text"))).alias("s"))
    seconds = F.to_json(F.struct(F.transform("s", lambda x: F.struct(x["start_sec"].alias("start"), x["end_sec"].alias("end"), x["text"].alias("text"))).alias("result")))
    millis = F.to_json(F.struct(F.transform("s", lambda x: F.struct(F.struct(x["m0"].alias("from"), x["m1"].alias("to")).alias("offsets"), x["text"].alias("text"))).alias("transcription")))
    return parsers.speech_segments(rows.select("video_id", F.when(F.col("video_id") % 2 == 0, seconds).otherwise(millis).alias("json")), "json")


def jsonl_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid and invalid lines among the events' properties, every seventh cut short."""
    e = table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 7 == 0, F.expr("left(props, length(props) - 1)")).otherwise(F.col("props")).alias("line"))
    ok = parsers.valid_json(F.col("line"))
    return e.where(X.trim_ws(F.col("line")) != "").agg(F.count_if(ok).alias("valid"), F.count_if(~ok).alias("invalid"))


def coarse_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Facts(spark, sf_dir, once=True).coarse


def coarse_segments_chained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same segments by successors, for media of any length."""
    facts = Facts(spark, sf_dir)
    s = facts.silences.select("video_id", F.explode(F.array("start_sec", "end_sec")).alias("at_sec"))
    return chains.coarse_segments(facts.media, s.union(facts.scenes))


def _coarse_text(facts: Facts) -> DataFrame:
    return segment.overlap_text(facts.kept.table(facts.coarse, "coarse"), facts.transcript, ["video_id", "seg_index"], trimmed=False)


def coarse_transcript(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coarse_text(Facts(spark, sf_dir, once=True))


def segment_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = Facts(spark, sf_dir, once=True)
    return segment.check_segments(facts.coarse, facts.media)


def semantic_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Facts(spark, sf_dir, once=True).semantic


def equal_division(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.equal_division(coarse_transcript(spark, sf_dir))


class HalvesModel:
    """A model for tests of the path to it: two halves of what the prompt says, for every third length only at the second time of asking, for every other third never."""

    def __init__(self):
        self.asked: dict[str, int] = {}

    def complete_json(self, prompt: str) -> str:
        seconds = float(re.search(r"of ([\d.]+) seconds", prompt)[1])
        kind = round(seconds * 1000) % 3
        times = self.asked[prompt] = self.asked.get(prompt, 0) + 1
        if kind == 2 or kind == 1 and times % 2:
            return json.dumps({"chunks": [{"start_sec": 1.0, "end_sec": seconds, "rationale": "late"}]})
        return json.dumps({"chunks": [{"start_sec": 0.0, "end_sec": seconds / 2, "rationale": "first"}, {"start_sec": seconds / 2, "end_sec": seconds, "rationale": "second"}]})


def model_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coarse segments as a model cuts them: some at once, some when asked again, the others into equal pieces."""
    return adapters.semantic_with(_coarse_text(Facts(spark, sf_dir, once=True)), HalvesModel(), at_once=8)


def merged_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.merge_short(semantic_chunks(spark, sf_dir))


def merged_chunks_chained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merged chunks by successors, for media of any length."""
    return chains.merge_short(semantic_chunks(spark, sf_dir))


def split_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splitting is applied to coarse segments, as merged chunks are never long enough here."""
    rows = coarse_transcript(spark, sf_dir).select("video_id", F.col("seg_index").alias("ord"), "start_sec", "end_sec", "transcript_text", F.lit("coarse").alias("rationale"))
    return segment.split_long(rows)


def normalized_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Facts(spark, sf_dir, once=True).normalized


def frame_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Facts(spark, sf_dir, once=True).stamps


def frame_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = Facts(spark, sf_dir)
    return frames.frame_kinds(facts.stamps, facts.scenes)


def dhash_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.frame_hashes(spark, sf_dir)


def dhash_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance of each hash to the one before it in its group."""
    before = F.lag("hash").over(Window.partitionBy("grp").orderBy("seq"))
    return timeline.frame_hashes(spark, sf_dir).withColumn("before", before).where("before is not null").select("grp", "seq", X.hamming(F.col("hash"), F.col("before")).alias("distance"))


def frame_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.dedupe_frames(timeline.frame_hashes(spark, sf_dir), "grp", "seq", "hash", threshold=24)


def alt_frame_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = Facts(spark, sf_dir, once=True)
    return frames.alternative_timestamps(facts.media, facts.scenes)


def caption_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = Facts(spark, sf_dir)
    return frames.caption_frames(facts.frames, facts.normalized, 2)


def even_k_of_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = Facts(spark, sf_dir)
    inside = frames.frames_in_chunks(frames.alternative_timestamps(facts.media, facts.scenes), facts.normalized, half_open=True)
    return frames.evenly_spaced(inside, ["video_id", "idx"]).select("video_id", "idx", "frame_idx", "at_sec")


def chunk_visual(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = Facts(spark, sf_dir)
    return assemble.visual_text(facts.enriched, facts.chunks)


def chunk_image_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = Facts(spark, sf_dir)
    refs = assemble.image_refs(facts.frames, facts.normalized)
    return refs.select("video_id", "idx", F.posexplode("image_refs").alias("pos", "r")).select("video_id", "idx", "pos", "r.path", "r.at_sec", "r.kind", "r.analyzed")


def summarize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", X.summarize(F.col("text")).alias("summary"))


def keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.array_join(X.keywords(X.title(X.trim_ws(F.col("text"))), F.col("text")), ",").alias("keywords"))


def fallback_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", X.title(F.col("text")).alias("title"), X.short_title(F.col("text"), F.col("doc_id").cast("string")).alias("short_title"))


def embedding_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", X.source_hash(X.embedding_text(X.title(F.col("text")), X.summarize(F.col("text")), F.col("text"), F.nullif(F.col("lang"), F.lit("fr")), F.col("source")).cast("binary")).alias("text_hash"))


def timecodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = timeline.signals(spark, sf_dir)
    return s.select("event_id", X.timecode(F.col("at_sec")).alias("tc"), X.time_range(F.col("at_sec"), F.col("at_sec") + 61.5).alias("span"), X.clock(F.col("at_sec") * 9).alias("clock"))


def source_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", X.source_hash(F.col("html").cast("binary")).alias("source_hash"))


def llm_reply_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each coarse segment's own chunks as a reply; a later segment doesn't start at 0 and so is rejected."""
    facts = Facts(spark, sf_dir)
    coarse = facts.kept.table(facts.coarse, "coarse")
    c = segment.semantic_chunks(coarse, facts.transcript).withColumn("seg_index", F.expr("ord div 1000000"))
    s = coarse.select("video_id", "seg_index", F.col("end_sec").alias("segment_end"))
    rows = c.join(s, ["video_id", "seg_index"]).select((F.col("video_id") * 1000 + F.col("seg_index")).alias("key"), "ord", "start_sec", "end_sec", "segment_end")
    return segment.check_reply(rows)


def annotated_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.annotate(normalized_chunks(spark, sf_dir)).withColumn("keywords", F.array_join("keywords", ","))


def markdown_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.markdown(assemble.annotate(normalized_chunks(spark, sf_dir)))


def chunk_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks written as JSON lines, read back by path."""
    a = assemble.annotate(normalized_chunks(spark, sf_dir))
    line = assemble.json_line(a.drop("start_sec", "end_sec"))
    get = lambda path: F.get_json_object("line", f"$.{path}")
    return a.select(line.alias("line")).select(get("chunk_id").alias("chunk_id"), get("title").alias("title"), get("summary").alias("summary"), get("keywords[0]").alias("first_keyword"), get("transcript_text").alias("transcript_text"), get("parent_segment_id").alias("parent_segment_id"))


def output_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = Facts(spark, sf_dir)
    return assemble.output_index(facts.normalized, facts.media)


def manifest_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages of media that have no finished record with the same input."""
    facts = Facts(spark, sf_dir)
    wanted = facts.media.select("video_id", F.explode(F.array(*[F.lit(s) for s in STAGES])).alias("stage"), F.concat(F.lit("h"), F.col("dur_ms").cast("string")).alias("input_hash"))
    n = F.abs(F.col("event_id"))
    records = facts.signals.join(facts.media, "video_id").select("video_id", F.element_at(F.array(*[F.lit(s) for s in STAGES]), (n % len(STAGES) + 1).cast("int")).alias("stage"), F.concat(F.lit("h"), (F.col("dur_ms") + F.when(n % 3 == 0, 1).otherwise(0)).cast("string")).alias("input_hash"), F.when(n % 2 == 0, "done").otherwise("failed").alias("status"))
    return pending(wanted, records)


def stage_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each media's key of the stage that cuts it, made of what that stage reads, and whether it changes with the duration alone."""
    facts = Facts(spark, sf_dir)
    key = lambda dur: cache_key(F.col("video_id"), dur.alias("dur_ms"), F.lit(STAGES[6]).alias("stage"), F.lit(None).cast("string").alias("note"))
    return facts.media.select("video_id", key(F.col("dur_ms")).alias("cache_key"), (key(F.col("dur_ms")) != key(F.col("dur_ms") + 1)).alias("changes"))


def stored_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over a store of outputs: of two thirds of the pages, some of which fail, then of all pages, some of which changed.

    The output, its length, comes from the run that first made it without failing.
    """
    store = FactStore(spark, f"{sinks.shared_folder(spark)}/outputs-{uuid.uuid4().hex}")
    p = table(spark, sf_dir, "pages").select("page_id", F.coalesce("html", F.lit("")).alias("html"))
    hashed = lambda html: p.select("page_id", html.alias("html"), X.source_hash(html.cast("binary")).alias("source_hash"))
    fails = F.col("source_hash").endswith("0")
    size = lambda rows, broken: rows.withColumns({"output": F.when(~broken, F.char_length("html").cast("string")), "output_error": F.when(broken, "broken")})
    store.of(hashed(F.col("html")).where("page_id % 3 <> 0"), "size", ("count",), lambda rows: size(rows, fails))
    now = hashed(F.when(F.col("page_id") % 5 == 0, F.concat("html", F.lit("x"))).otherwise(F.col("html")))
    found = store.of(now, "size", ("count",), lambda rows: size(rows, F.lit(False)))
    runs = store.said("size", ("count",)).select("source_hash", F.col("version").alias("run"))
    return found.join(runs, "source_hash").select("page_id", "source_hash", "output", "error", "run")


def estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") * 100000).alias("bytes"))
    return d.select("doc_id", *[c.alias(k) for k, c in X.estimate(F.col("bytes")).items()])


def media_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and frame paths from pages' addresses, and the encoder's scale for qualities of 0 to 100."""
    p = table(spark, sf_dir, "pages").withColumn("name", F.concat(F.regexp_replace("url", r"\?.*$", ""), F.when(F.col("page_id") % 3 == 0, ".tar.gz").when(F.col("page_id") % 3 == 1, "/").otherwise("")))
    v = tools.video_id(F.col("name"))
    return p.select("page_id", v.alias("video_id"), tools.frame_path(v, F.col("page_id")).alias("frame_path"), tools.jpeg_quality((F.col("page_id") % 101).cast("int")).alias("quality"))


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pipeline; nested fields flattened, and without the time of the run."""
    facts = Facts(spark, sf_dir)
    annotated = assemble.annotate(facts.chunks)
    path = F.concat(F.lit("media/"), F.col("video_id").cast("string"), F.lit(".mp4"))
    sources = facts.media.select("video_id", path.alias("source_path"), X.source_hash(F.col("dur_ms").cast("string").cast("binary")).alias("source_hash"), F.lit(True).alias("has_audio"))
    c = assemble.build_chunks(annotated, facts.enriched, sources)
    flags = [F.col(f"modality_flags.{f}").alias(f) for f in ("has_speech", "has_ocr", "has_visual")]
    flat = ["schema_version", "video_id", "source_type", "source_path", "source_hash", "chunk_id", "parent_segment_id", "start_sec", "end_sec", "start_tc", "end_tc", "duration_sec", "content_type", "title", "summary", "transcript", "ocr_text", "visual_caption"]
    return c.select(*flat, F.array_join("keywords", ",").alias("keywords"), F.sha2(F.col("embedding_text").cast("binary"), 256).alias("embedding_hash"), F.size("image_refs").alias("n_images"), F.col("source_jump_ref.type").alias("jump_type"), *flags, F.col("processing_meta.segmentation_rationale").alias("segmentation_rationale"))


QUERIES = {
    f.__name__: f
    for f in (
        fx_transcript, fx_signals, silence_intervals, silence_log_parse, scene_log_parse, timecode_parse, probe_parse, fraction_parse, asr_json_parse, jsonl_validate, coarse_segments, coarse_segments_chained, coarse_transcript, segment_invariants, semantic_chunks, equal_division, model_chunks,
        merged_chunks, merged_chunks_chained, split_chunks, normalized_chunks, frame_timestamps, frame_kinds, dhash_pack, dhash_hamming, frame_dedupe, alt_frame_timeline, caption_topk, even_k_of_n, chunk_visual, chunk_image_refs, summarize, keywords, fallback_titles, embedding_text,
        timecodes, source_hashes, llm_reply_validate, annotated_chunks, markdown_doc, chunk_jsonl, output_index, manifest_pending, stage_cache, stored_outputs, estimate, media_names, chunks,
    )
}
