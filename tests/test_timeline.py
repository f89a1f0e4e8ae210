import random
import urllib.error

import pytest
from pyspark.sql import functions as F

from reeltide.operators import assemble, chains, frames, segment
from reeltide.plans import manifest
from reeltide.plans.config import Config
from reeltide.sources import adapters, parsers


def media(spark, *durations):
    return spark.createDataFrame([(i, float(d)) for i, d in enumerate(durations)], "video_id long, duration_sec double")


def times(spark, *rows):
    return spark.createDataFrame([(v, float(t)) for v, t in rows], "video_id long, at_sec double")


def test_coarse_takes_the_later_of_two_and_a_second_after(spark):
    got = segment.coarse_segments(media(spark, 100), times(spark, (0, 45), (0, 55)), 50, 10).orderBy("seg_index").collect()
    assert [(r.start_sec, r.end_sec) for r in got] == [(0, 55), (55, 56), (56, 100)]


def test_coarse_without_signals_and_without_duration(spark):
    got = segment.coarse_segments(media(spark, 100, 0, -1), times(spark), 50, 10).orderBy("seg_index").collect()
    assert [(r.video_id, r.start_sec, r.end_sec) for r in got] == [(0, 0, 50), (0, 50, 100)]


def test_coarse_covers_long_media(spark):
    got = segment.coarse_segments(media(spark, 40000), times(spark, *[(0, 7 * i) for i in range(200)]))
    check = segment.check_segments(got, media(spark, 40000)).first()
    assert check.starts_at_zero and check.ends_at_duration and check.continuous and check.positive


def chunks(spark, *spans, text=None):
    return spark.createDataFrame([(0, i, float(a), float(b), text or f"t{i}", "r") for i, (a, b) in enumerate(spans)], "video_id long, ord long, start_sec double, end_sec double, transcript_text string, rationale string")


def spans(df):
    return [(r.start_sec, r.end_sec, r.transcript_text) for r in df.orderBy("ord").collect()]


def test_merge_head_tail_and_lone(spark):
    assert spans(segment.merge_short(chunks(spark, (0, 10), (10, 60)))) == [(0, 60, "t0 t1")]
    assert spans(segment.merge_short(chunks(spark, (0, 50), (50, 55)))) == [(0, 55, "t0 t1")]
    assert spans(segment.merge_short(chunks(spark, (0, 5)))) == [(0, 5, "t0")]
    got = segment.merge_short(chunks(spark, (0, 50), (50, 55), (55, 58))).first()
    assert got.rationale == "r + r + r"


def test_split(spark):
    got = segment.split_long(chunks(spark, (0, 200))).orderBy("part").collect()
    assert [(r.start_sec, r.end_sec) for r in got] == [(0, 50), (50, 100), (100, 150), (150, 200)]
    assert got[3].rationale == "r (part 4)"
    assert segment.split_long(chunks(spark, (0, 120))).count() == 1


def test_ids_widen_beyond_four_digits(spark):
    many = spark.range(10001).select(F.lit(7).alias("video_id"), F.col("id").alias("ord"), F.lit(0).alias("part"), F.col("id").cast("double").alias("start_sec"), (F.col("id") + 1).cast("double").alias("end_sec"), F.lit("").alias("transcript_text"))
    ids = {r.idx: r.chunk_id for r in segment.assign_ids(many).collect()}
    assert ids[0] == "7_chunk_0000" and ids[10000] == "7_chunk_10000"


def test_reply_check(spark):
    rows = [("ok", 0, 0.0, 50.0), ("ok", 1, 50.0, 100.0), ("gap", 0, 0.0, 40.0), ("gap", 1, 50.0, 100.0), ("late", 0, 5.0, 100.0), ("over", 0, 0.0, 60.0), ("over", 1, 50.0, 100.0)]
    df = spark.createDataFrame(rows, "key string, ord int, start_sec double, end_sec double").withColumn("segment_end", F.lit(100.0))
    assert {r.key: r.valid for r in segment.check_reply(df).collect()} == {"ok": True, "gap": False, "late": False, "over": False}


def test_stamps_fold_against_the_last_kept(spark):
    row = spark.range(1).select(frames.distinct_times(F.array(*[F.lit(x) for x in (0.0, 0.2, 0.4)]), 0.25).alias("s")).first()
    assert row.s == [0.0, 0.4]


def test_stamps_are_bounded(spark):
    got = frames.frame_timestamps(media(spark, 60, 0.4, 0), times(spark, (0, 10), (0, 50), (0, 59.9)), 20, 5).collect()
    assert len([r for r in got if r.video_id == 0]) <= 5 and all(0 <= r.at_sec <= 59.5 for r in got)
    assert [r.at_sec for r in got if r.video_id == 1] == [0.0] and not [r for r in got if r.video_id == 2]


def test_dedupe_keeps_frames_without_hash(spark):
    df = spark.createDataFrame([(0, 0, 0), (0, 1, 1), (0, 2, None), (0, 3, -1), (0, 4, None)], "g long, seq long, h long")
    assert sorted(r.seq for r in frames.dedupe_frames(df, "g", "seq", "h", 10).collect()) == [0, 2, 3, 4]


def test_captions_take_scene_changes_first(spark):
    f = spark.createDataFrame([(0, 0, 1.0, "periodic"), (0, 1, 2.0, "scene_change"), (0, 2, 3.0, "periodic"), (0, 3, 10.0, "periodic")], "video_id long, frame_idx int, at_sec double, kind string")
    c = spark.createDataFrame([(0, 0, 0.0, 10.0), (0, 1, 10.0, 20.0)], "video_id long, idx long, start_sec double, end_sec double")
    assert sorted(r.frame_idx for r in frames.caption_frames(f, c, 2).collect()) == [0, 1, 3]


def test_evenly_spaced(spark):
    f = spark.createDataFrame([(0, i) for i in range(10)], "g int, frame_idx int")
    assert sorted(r.frame_idx for r in frames.evenly_spaced(f, ["g"], 3).collect()) == [0, 3, 6]
    assert frames.evenly_spaced(f.where("frame_idx < 3"), ["g"], 3).count() == 3


def test_silences(spark):
    rows = [(0, 1, True, 0.5), (0, 2, True, 0.7), (0, 3, False, 2.5), (0, 4, False, 3.0), (0, 5, True, 5.0)]
    df = spark.createDataFrame(rows, "video_id long, ord long, is_start boolean, at_sec double")
    assert [(r.start_sec, r.end_sec) for r in parsers.pair_silences(df).collect()] == [(0.7, 2.5)]


def test_probe_and_scene_log(spark):
    full = '{"format":{"duration":"75.25"},"streams":[{"codec_type":"video","width":704,"height":396,"r_frame_rate":"24000/1001"},{"codec_type":"audio"}]}'
    df = spark.createDataFrame([(full,), ('{"format":{},"streams":[]}',), ("no json",)], "j string")
    a, b, c = parsers.probe(df, "j").collect()
    assert (a.duration_sec, a.width, a.height, a.has_video, a.has_audio) == (75.25, 704, 396, True, True) and abs(a.fps - 23.976) < 0.01
    assert (b.duration_sec, b.fps, b.has_video, b.has_audio) == (0.0, 0.0, False, False) and c.duration_sec == 0.0
    log = "x pts_time:3.071\npts_time:8 time=00:00:09.250\ntime=bad pts_time:4\ntime=7 pts_time:11\nnone\ntime=00:01:02.75"
    row = spark.createDataFrame([(log,)], "l string").select(parsers.scene_times(F.col("l")).alias("t")).first()
    assert row.t == [3.071, 9.25, 4.0, 62.75]


def test_speech_layouts(spark):
    a = '{"result":[{"start":0.5,"end":1.0,"text":" hi "},{"start":1,"end":2,"text":"  "}]}'
    b = '{"transcription":[{"offsets":{"from":0,"to":1735},"text":"川辺"},{"offsets":{"from":-5,"to":3210},"text":"x"}]}'
    df = spark.createDataFrame([(0, a), (1, b), (2, "{}"), (3, "bad")], "id int, j string")
    got = [(r.id, r.start_sec, r.end_sec, r.text) for r in parsers.speech_segments(df, "j").orderBy("id", "pos").collect()]
    assert got == [(0, 0.5, 1.0, "hi"), (1, 0.0, 1.735, "川辺"), (1, 0.0, 3.21, "x")]


def test_annotation_of_blank_chunks(spark):
    df = spark.createDataFrame([("v_chunk_0000", 0.0, 1.5, "  ")], "chunk_id string, start_sec double, end_sec double, transcript_text string")
    r = assemble.annotate(df).first()
    assert r.title == "Segment v_chunk_0000 (00:00:00.000-00:00:01.500)" and r.summary.startswith("No transcript") and "v_chunk_0000" in r.keywords


def test_manifest(spark):
    records = spark.createDataFrame([], manifest.RECORD)
    one = spark.createDataFrame([("1", "probe", "h")], "video_id string, stage string, input_hash string")
    records = manifest.mark(manifest.mark(records, one, "running"), one, "done", "p")
    last = manifest.latest(records).first()
    assert (last.status, last.output_path, last.version) == ("done", "p", 1)
    assert manifest.pending(one, records).count() == 0
    assert manifest.pending(one.withColumn("input_hash", F.lit("other")), records).count() == 1


def test_config(tmp_path):
    c = Config.parse('[coarse]\nmax_duration_sec = 100\n[frames]\nmax_analyzed = "many"\n')
    assert c.coarse.max_duration_sec == 100.0 and c.coarse.snap_window_sec == 30.0 and c.frames == Config().frames
    assert c.hash() != Config().hash() and Config().hash() == Config().hash()


def test_adapters_fail_softly(spark):
    class Half:
        def caption(self, path):
            if path == "b":
                raise OSError
            return f"see {path}"

    df = spark.createDataFrame([("a",), ("b",)], "path string")
    assert {r.path: (r.visual_caption, r.visual_caption_error) for r in adapters.caption_frames(df, Half()).collect()} == {"a": ("see a", None), "b": (None, "OSError: ")}
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return "{}"

    assert adapters.with_retries(flaky, sleep=lambda s: None) == "{}" and len(calls) == 3
    chunk = spark.createDataFrame([("c", 0.0, 1.0, "some words")], "chunk_id string, start_sec double, end_sec double, transcript_text string")
    assert adapters.annotate_with(chunk, adapters.FixedModel('{"title":"T","summary":"S","keywords":["k"]}')).first().title == "T"
    r = adapters.annotate_with(chunk, adapters.FixedModel('{"title":"T"}')).first()
    assert (r.title, r.keywords) == ("some words", ["content"])


def test_image_hashes(spark):
    import numpy as np

    from reeltide.operators.images import hash_of, image_hash

    ramp = np.tile(np.linspace(255, 0, 90).astype(np.uint8), (80, 1))
    assert hash_of(ramp) == -1 and hash_of(ramp[:, ::-1]) == 0
    hash_of(np.zeros((1000, 1), np.uint8))  # a tall image is no problem
    rows = [(b"P5\n90 80\n255\n" + ramp.tobytes(),), (b"P6 broken",), (None,), (b"P5 9 9 255 short",)]
    got = [r.h for r in spark.createDataFrame(rows, "content binary").select(image_hash(F.col("content")).alias("h")).collect()]
    assert got == [-1, None, None, None]


def test_names(spark):
    from reeltide.sources import tools

    rows = [("/a/b/clip.one.mp4", 1), (".mp4", 100), ("noext", 0), ("a/", 4)]
    got = spark.createDataFrame(rows, "p string, q int").select(tools.video_id(F.col("p")).alias("v"), tools.jpeg_quality(F.col("q")).alias("j")).collect()
    assert [r.v for r in got] == ["clip.one", ".mp4", "noext", "video"] and [r.j for r in got] == [31, 7, 31, 31]
    ran = tools.run_tool(spark.createDataFrame([("x",)], "path string"), ("echo", "{path}"), "out").first()
    gone = tools.run_tool(spark.createDataFrame([("x",)], "path string"), ("no-such-tool-here", "{path}"), "out").first()
    assert ran.out == "x\n" and ran.out_error is None and gone.out is None and "no-such-tool-here" in gone.out_error


def test_dedupe_over_several_ranges(spark, monkeypatch):
    """The same frames are kept however the order is dealt out."""
    import numpy as np

    rng = np.random.default_rng(5)
    hashes = rng.integers(0, 1 << 20, 400) * (1 << 40)
    df = spark.createDataFrame([(int(i % 7 > 1), i, int(h)) for i, h in enumerate(hashes)], "g long, seq long, h long")
    whole = sorted((r.g, r.seq) for r in frames.dedupe_frames(df, "g", "seq", "h", 5).collect())
    assert sorted((r.g, r.seq) for r in frames.dedupe_frames(df, "g", "seq", "h", 5, fold_hashes=0).collect()) == whole and 10 < len(whole) < 300


def test_dedupe_by_bands_is_the_fold(spark, monkeypatch):
    """Chains, clusters, repeats, null groups and hashes, and buckets of several blocks."""
    monkeypatch.setattr(frames, "BUCKET_ROWS", 16)
    rng = random.Random(3)
    flip = lambda h, n: h ^ sum(1 << b for b in rng.sample(range(64), n))
    rows, h = [], rng.getrandbits(64)
    for i in range(60):  # each near the one before it, seldom near the one before that
        rows.append(("chain", i, h))
        h = flip(h, 3)
    centre = rng.getrandbits(64)
    rows += [("cluster", i, flip(centre, rng.randint(0, 4))) for i in range(150)]
    rows += [(None, i, flip(centre, rng.randint(0, 6))) for i in range(80)] + [(None, 80, None), ("chain", 60, None)]
    rows += [("cluster", 150 + i, rows[60 + i][2]) for i in range(10)]
    rng.shuffle(rows)
    signed = [(g, o, None if x is None else x - (1 << 64) if x >> 63 else x) for g, o, x in rows]
    kept, want = {}, []
    for g, o, x in sorted(rows, key=lambda r: r[1]):
        if x is None or all((x ^ y).bit_count() > 4 for y in kept.get(g, [])):
            want.append((g, o))
            if x is not None:
                kept.setdefault(g, []).append(x)
    df = spark.createDataFrame(signed, "g string, o int, h bigint")
    key = lambda r: (r[0] or "", r[1])
    for most in (0, 100, 1000):
        assert sorted(map(tuple, frames.dedupe_frames(df, "g", "o", "h", 4, fold_hashes=most).collect()), key=key) == sorted(want, key=key), most
    assert frames.dedupe_frames(df.limit(0), "g", "o", "h", fold_hashes=0).isEmpty()
    far = spark.createDataFrame([("a", 0, 5), ("a", 1, 4)], "g string, o int, h bigint")
    assert [r.o for r in frames.dedupe_frames(far, "g", "o", "h", 0, fold_hashes=0).orderBy("o").collect()] == [0, 1]


def test_texts_meet_over_stretches_of_time(spark):
    turns = [(0, i, 70.0 * i, 70.0 * i + 90.0, f"t{i}") for i in range(30)] + [(0, 99, 10.0, 1900.0, "all")]
    t = spark.createDataFrame(turns, "video_id long, seg_idx long, start_sec double, end_sec double, text string")
    spans = [(0, k, a, b) for k, (a, b) in enumerate([(0.0, 60.0), (299.0, 301.0), (300.0, 600.0), (100.0, 1500.0), (5000.0, 5100.0)])]
    s = spark.createDataFrame(spans, "video_id long, idx long, start_sec double, end_sec double")
    got = {r.idx: r.transcript_text for r in segment.overlap_text(s, t, ["video_id", "idx"]).collect()}
    assert got == {k: " ".join(x for _, _, c, d, x in turns if c < b and d > a) for _, k, a, b in spans}


def test_chunks_by_a_model(spark):
    class Says:
        """A model that gives its answers in turn, the last one for ever."""

        def __init__(self, *answers):
            self.answers = list(answers)

        def complete_json(self, prompt):
            answer = self.answers.pop(0) if len(self.answers) > 1 else self.answers[0]
            if answer is None:
                raise OSError("unreachable")
            return answer

    df = spark.createDataFrame([(1, 0, 0.0, 100.0, "said")], "video_id long, seg_index long, start_sec double, end_sec double, transcript_text string")
    good = '{"chunks":[{"start_sec":0,"end_sec":40.25,"rationale":"a"},{"start_sec":40.255,"end_sec":100,"rationale":"b"}]}'
    late, gap, back = ('{"chunks":[{"start_sec":%s,"end_sec":50,"rationale":"a"},{"start_sec":%s,"end_sec":%s,"rationale":"b"}]}' % x for x in ((1, 50, 100), (0, 51, 100), (0, 50, 50)))
    cut = [(0, 0.0, 40.25, "Segment from 0.0s to 40.2s", "a"), (1, 40.255, 100.0, "Segment from 40.3s to 100.0s", "b")]
    divided = [(0, 0.0, 50.0, "said", "Fallback equal division"), (1, 50.0, 100.0, "said", "Fallback equal division")]
    for answers, want in (((good,), cut), ((late, good), cut), ((gap, back), divided), (("{}", "[]"), divided), ((None,), divided)):
        got = adapters.semantic_with(df, Says(*answers), at_once=1).orderBy("ord").collect()
        assert [(r.ord, r.start_sec, r.end_sec, r.transcript_text, r.rationale) for r in got] == want, answers


def test_placeholder_rounds_binary_values(spark):
    values = [0.25, 0.35, 0.45, 0.05, 2.5, 1e6 + 0.75, 0.0, 12.999, 7.949999]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select(adapters.placeholder(F.col("x"), F.col("x")).alias("t")).collect()
    assert [r.t for r in rows] == [f"Segment from {v:.1f}s to {v:.1f}s" for v in values]


def test_model_from_environment():
    assert adapters.model_from_environment({}) is None
    model = adapters.model_from_environment({"REELTIDE_MODEL_URL": "http://localhost:1/x", "REELTIDE_MODEL_KEY": "secret"})
    assert model.timeout == adapters.MODEL_TIMEOUT and "secret" not in repr(model)


def test_speech_and_text_commands(spark, tmp_path):
    tool = tmp_path / "tool"
    tool.write_text('#!/bin/sh\ncase $1 in */bad) exit 3;; esac\necho " {$1} "\n')
    tool.chmod(0o755)
    df = spark.createDataFrame([("/x/good",), ("/x/bad",)], "wav_path string")
    got = {r.wav_path: r for r in adapters.transcribe(df, adapters.CommandSpeech(str(tool))).collect()}
    assert got["/x/good"].asr_json == " {/x/good} \n" and got["/x/bad"].asr_json is None and "exit status 3" in got["/x/bad"].asr_json_error
    read = adapters.read_frames(df.withColumnRenamed("wav_path", "path"), adapters.TesseractOcr(str(tool)))
    assert {r.path: r.ocr_text for r in read.collect()} == {"/x/good": "{/x/good}", "/x/bad": None}


def test_image_files(spark, tmp_path):
    import numpy as np

    from reeltide.operators.images import file_hashes, hash_of

    ramp = np.tile(np.linspace(250, 5, 90).astype(np.uint8), (80, 1))
    jvm = spark._jvm
    for name, kind, grey in (("a.png", "png", True), ("b.jpg", "jpg", True), ("c.png", "png", False)):
        image = jvm.java.awt.image.BufferedImage(90, 80, 10 if grey else 1)
        for x in range(90):
            v = int(ramp[0, x])
            for y in range(80):
                image.setRGB(x, y, (v << 16 | v << 8 | v) if grey else (v << 8))
        jvm.javax.imageio.ImageIO.write(image, kind, jvm.java.io.File(str(tmp_path / name)))
    (tmp_path / "broken.jpg").write_bytes(b"no image")
    got = {r.path.rsplit("/", 1)[-1]: r.hash for r in file_hashes(spark, str(tmp_path)).collect()}
    assert got["a.png"] == hash_of(ramp) == -1 and got["c.png"] == -1 and bin(got["b.jpg"] & (1 << 64) - 1).count("1") > 55 and got.get("broken.jpg") is None


def test_segments_by_successors_are_the_fold(spark):
    """Long gaps, dense signals, signals at the begin, at the end and beyond, media without any, and times that are rounded."""
    rng = random.Random(9)
    durations = [5000.3, 1234.567, 900.0, 299.9, 330.0, 0.0, 86_400.1, 3000.0]
    marks = [(0, rng.uniform(0, 5000)) for _ in range(200)] + [(1, t) for t in (0.0, 1.0, 310.1, 330.0, 1234.567, 2000.0, -3.0)] + [(2, 300.0), (2, 600.0), (4, 330.0)]
    marks += [(6, rng.uniform(0, 4000)) for _ in range(40)] + [(6, 80_000 + i * 0.1) for i in range(30)] + [(7, 100.0 + k) for k in (0, 199.5, 200.5)]
    m, c = media(spark, *durations), times(spark, *marks, *marks[:20])
    for most, snap in ((300.0, 30.0), (7.1, 0.7)):
        want = sorted(map(tuple, segment.coarse_segments(m, c, most, snap).collect()))
        assert sorted(map(tuple, chains.coarse_segments(m, c, most, snap).collect())) == want and len(want) > 300, most
    assert chains.coarse_segments(m, c.limit(0)).where("video_id = 6").count() == 289 and chains.coarse_segments(m.limit(0), c).isEmpty()


def test_merging_by_successors_is_the_fold(spark):
    rng = random.Random(4)
    rows = []
    for v in range(12):
        at = 0.0
        for k in range(rng.choice((1, 2, 40))):
            to = at + rng.choice((0.3, 4.0, 7.5, 15.0, 15.1, 80.0))
            rows.append((v, k, at, to, rng.choice(("a b", " c", "")), f"r{k}"))
            at = to
    rows += [(20, 0, 0.0, 5.0, "only", "r"), (21, 0, 0.0, 15.0, "x ", "r"), (21, 1, 15.0, 20.0, "", "s")]
    df = spark.createDataFrame(rows, "video_id long, ord long, start_sec double, end_sec double, transcript_text string, rationale string")
    want = sorted(map(tuple, segment.merge_short(df).collect()))
    assert sorted(map(tuple, chains.merge_short(df).collect())) == want and len(want) > 20
    assert chains.merge_short(df.limit(0)).isEmpty()


def test_watched_segments_fail_on_gaps(spark, tmp_path):
    m = media(spark, 100.0, 50.0)
    names = "video_id long, start_sec double, end_sec double"

    def run(name, *rows):
        out, check = segment.watched(spark.createDataFrame(rows, names), m)
        out.write.parquet(str(tmp_path / name))
        check()

    run("fits", (0, 0.0, 60.0), (0, 60.0, 100.0), (1, 0.0, 50.0))
    for k, rows in enumerate((((0, 0.0, 60.0), (0, 61.0, 100.0), (1, 0.0, 50.0)), ((0, 0.0, 60.0), (0, 59.0, 100.0), (1, 0.0, 50.0)), ((0, 0.0, 100.0),), ((0, 0.0, 99.0), (1, 0.0, 50.0)), ((0, 0.0, 0.0), (0, 0.0, 100.0), (1, 0.0, 50.0)))):
        with pytest.raises(ValueError):
            run(f"bad{k}", *rows)


def test_calls_are_admitted_for_the_whole_job(spark, tmp_path):
    """However many partitions ask, no more than two calls overlap, and each says when it began."""
    log = str(tmp_path)

    def call(x):
        import time
        import uuid

        began = time.time()
        time.sleep(0.15)
        with open(f"{log}/{uuid.uuid4().hex}", "w") as f:
            f.write(f"{began} {time.time()}")
        return "{}"

    df = spark.range(12).selectExpr("cast(id as string) as x").repartition(4)
    assert adapters.admitted(df, ["x"], "y", call, at_once=2).where("y = '{}'").count() == 12
    spans = sorted(tuple(map(float, p.read_text().split())) for p in tmp_path.iterdir())
    assert max(sum(a <= at < b for a, b in spans) for at, _ in spans) <= 2
    import time

    began = time.monotonic()
    adapters.admitted(df, ["x"], "y", lambda x: "{}", at_once=1, per_sec=10.0).collect()
    assert time.monotonic() - began >= 1.1


def test_servers_that_ask_to_wait_or_refuse():
    waits, calls = [], []

    def fails(status, **headers):
        def call():
            calls.append(status)
            raise urllib.error.HTTPError("http://x", status, "no", headers, None)

        return call

    for status, headers, tries, wait in ((429, {"Retry-After": "7"}, 3, [7.0, 7.0]), (429, {"Retry-After": "9999"}, 3, [60.0, 60.0]), (503, {}, 3, [0.1, 0.2]), (401, {}, 1, []), (400, {"Retry-After": "7"}, 1, [])):
        waits.clear(), calls.clear()
        with pytest.raises(urllib.error.HTTPError):
            adapters.with_retries(fails(status, **headers), sleep=waits.append)
        assert len(calls) == tries and waits == wait, status
