import dataclasses
import hashlib
import json
from graphlib import CycleError

import pytest
from pyspark.sql import functions as F

from reeltide import cli
from reeltide.plans import contracts, ingest
from reeltide.plans.commits import Batches, put_if_absent
from reeltide.plans.config import Config
from reeltide.plans.manifest import Manifest, latest, rows_hash
from reeltide.plans.pipeline import Ended, Stages, build
from reeltide.sources import adapters, mediasource, parsers, tools
from reeltide.streaming import signals


def test_process_validate(spark, small, tmp_path):
    cli.process(spark, small, str(tmp_path / "out"), Config())
    assert cli.validate(spark, str(tmp_path / "out/chunks.jsonl"))[1] == 0
    line = json.loads(spark.read.text(str(tmp_path / "out/chunks.jsonl")).first().value)
    assert "ocr_text" in line and line["schema_version"] == "1.0" and line["source_jump_ref"]["type"] == "local"
    runs = lambda: len(list((tmp_path / "out/stages/normalize").iterdir()))
    cli.process(spark, small, str(tmp_path / "out"), Config(), resume=True)
    assert runs() == 1 and {r.status for r in cli.inspect(spark, str(tmp_path / "out")).collect()} == {"done"}
    cli.process(spark, small, str(tmp_path / "out"), Config.parse("[coarse]\nmax_duration_sec = 200\n"), resume=True)
    assert runs() == 2


def test_rows_hash_follows_rows_not_their_order(spark):
    names = "video_id long, text string"
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, None), (2, "z")], names)
    of = lambda *t: {r.video_id: r.source_hash for r in rows_hash(*t).collect()}
    first = of(a, a.limit(0))
    assert of(spark.createDataFrame([(2, "z"), (1, "y"), (2, None), (1, "x")], names), a.limit(0)) == first
    changed = of(spark.createDataFrame([(1, "x"), (1, "y"), (2, ""), (2, "z")], names), a.limit(0))
    assert changed["1"] == first["1"] and changed["2"] != first["2"]
    twice = of(spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (2, None), (2, "z")], names), a.limit(0))
    assert twice["1"] != first["1"] and of(a.limit(0), a)["1"] != first["1"]


def test_changed_rows_are_made_anew(spark, tmp_path):
    media = spark.createDataFrame([(1, 100.0), (2, 100.0)], "video_id long, duration_sec double")
    none = spark.createDataFrame([], "video_id long, start_sec double, end_sec double")
    scenes = spark.createDataFrame([], "video_id long, at_sec double")
    said = lambda second: spark.createDataFrame([(1, 0, 0.0, 50.0, "first words"), (2, 0, 0.0, 50.0, second)], "video_id long, seg_idx int, start_sec double, end_sec double, text string")
    run = lambda second: {r.video_id: r.transcript_text for r in build(media, said(second), none, scenes, folder=str(tmp_path), resume=True)[0].where("start_sec = 0").collect()}
    assert run("same") == {1: "first words", 2: "same"}
    assert run("other") == {1: "first words", 2: "other"}
    made = lambda: {s: len(list((tmp_path / f"stages/{s}").iterdir())) for s in contracts.STAGES}
    assert made() == {"frames": 1, "coarse": 1, "semantic": 2, "normalize": 2, "annotate": 2}  # what doesn't read the transcript stays
    changed = Config.parse("[frames]\nmax_analyzed = 9\n")
    build(media, said("other"), none, scenes, config=changed, folder=str(tmp_path), resume=True)
    assert made() == {"frames": 2, "coarse": 1, "semantic": 2, "normalize": 2, "annotate": 2}


def test_contracts_give_order_and_fail_before_jobs(spark, tmp_path):
    assert contracts.ordered()[-1] == "annotate" and contracts.ordered().index("coarse") < contracts.ordered().index("semantic")
    with pytest.raises(contracts.ContractError, match="nothing gives"):
        contracts.ordered({"a": contracts.Contract(("b",), (), "x int")})
    with pytest.raises(CycleError):
        contracts.ordered({"a": contracts.Contract(("b",), (), "x int"), "b": contracts.Contract(("a",), (), "x int")})
    media = spark.createDataFrame([(1, 100.0)], "video_id long, duration_sec double")
    none = spark.createDataFrame([], "video_id long, start_sec double, end_sec double")
    scenes = spark.createDataFrame([], "video_id long, at_sec double")
    words = spark.createDataFrame([], "video_id long, seg_idx int, start_sec double, end_sec double, text string")
    with pytest.raises(contracts.ContractError, match="transcript lacks text string"):
        build(media, words.drop("text"), none, scenes)
    with pytest.raises(contracts.ContractError, match="scenes lacks at_sec double"):
        build(media, words, none, scenes.withColumn("at_sec", F.col("at_sec").cast("string")))
    with pytest.raises(contracts.ContractError, match="annotate lacks"):
        build(media, words, none, scenes, annotate=lambda chunks: chunks)
    with pytest.raises(ValueError, match="no such stage"):
        build(media, words, none, scenes, folder=str(tmp_path), last="cuts")
    assert build(media, words, none, scenes)[0].count() > 0


def test_commits_of_several_writers(spark, tmp_path):
    """Of writers that begin at the same version each gets its own, and what isn't committed isn't read."""
    path = f"file://{tmp_path}/commits/1.json"
    assert put_if_absent(spark, path, "one") and not put_if_absent(spark, path, "two")
    assert (tmp_path / "commits/1.json").read_text() == "one" and [x.name for x in (tmp_path / "commits").iterdir() if x.suffix == ".draft"] == []
    writers = [Batches(spark, str(tmp_path / "t"), "v int") for _ in range(3)]
    rows = spark.range(1).select(F.lit(7).alias("v"))
    for w in writers:
        w._newest = lambda: 0  # as if all had looked before any committed
    assert [w.append(rows) for w in writers] == [1, 2, 3]
    rows.write.parquet(str(tmp_path / "t/rows/batch=bbroken"))
    assert sorted(r.version for r in Batches(spark, str(tmp_path / "t"), "v int").read().collect()) == [1, 2, 3]
    assert Batches(spark, str(tmp_path / "none"), "v int").read().isEmpty()


class Counted:
    """Stages over a tiny table, with a record of which were made."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.made = spark, str(folder), []

    def run(self, hashes, config=None, stage="coarse", fail=False, **how):
        media = self.spark.createDataFrame([(i, h) for i, h in enumerate(hashes)], "video_id long, source_hash string")

        def make():
            self.made.append(stage)
            if fail:
                raise ValueError("broken")
            return media.withColumn("v", F.concat(F.lit(f"{len(self.made)}-"), "source_hash"))

        rows = Stages(media, config or Config(), self.folder, **how).run(stage, make)
        return {r.video_id: r.v for r in rows.collect()}


def test_resume_takes_what_is_done_with_the_same_input(spark, tmp_path):
    s = Counted(spark, tmp_path)
    assert s.run("ab", resume=True) == {0: "1-a", 1: "1-b"}
    assert s.run("ab", resume=True) == {0: "1-a", 1: "1-b"} and len(s.made) == 1  # hit
    assert s.run("xb", resume=True) == {0: "2-x", 1: "1-b"}  # one source changed: only that medium is made anew
    assert s.run("xb", Config.parse("[coarse]\nmax_duration_sec = 9\n"), resume=True) == {0: "3-x", 1: "3-b"}  # other settings
    assert s.run("xb", resume=False) == {0: "4-x", 1: "4-b"}


def test_resume_makes_anew_what_is_not_done(spark, tmp_path):
    s = Counted(spark, tmp_path)
    with pytest.raises(ValueError):
        s.run("ab", resume=True, fail=True)
    assert {r.status for r in latest(Manifest(spark, str(tmp_path)).records()).collect()} == {"failed"}
    assert s.run("ab", resume=True) == {0: "2-a", 1: "2-b"}
    media = spark.createDataFrame([("0", "coarse", "h")], "video_id string, stage string, input_hash string")
    Manifest(spark, str(tmp_path)).add(media, "running")  # a later run began and broke off
    assert s.run("ab", resume=True) == {0: "3-a", 1: "2-b"}


def test_stage_ranges(spark, tmp_path):
    s = Counted(spark, tmp_path)
    with pytest.raises(FileNotFoundError):
        s.run("a", first="semantic")
    s.run("a", stage="coarse", last="coarse")
    assert s.run("a", first="semantic") == {0: "1-a"} and len(s.made) == 1
    stages = Stages(spark.createDataFrame([(0, "a")], "video_id long, source_hash string"), Config(), str(tmp_path / "b"), last="coarse")
    stages.run("coarse", lambda: spark.range(1).withColumnRenamed("id", "video_id"))
    with pytest.raises(Ended):
        stages.run("semantic", lambda: None)


def test_process_media_files(spark, tmp_path):
    """Files stand for media: each tool prints what lies beside the file under another name."""
    media = tmp_path / "media"
    media.mkdir()
    streams = {"one": '{"codec_type":"video","width":64,"height":48,"r_frame_rate":"25/1"},{"codec_type":"audio"}', "mute": '{"codec_type":"video","width":64,"height":48,"r_frame_rate":"25/1"}'}
    for name, x in streams.items():
        (media / f"{name}.mp4").write_bytes(name.encode())
        (media / f"{name}.mp4.probe").write_text('{"format":{"duration":"100.0"},"streams":[%s]}' % x)
        (media / f"{name}.mp4.silence").write_text("x silence_start: 44.25\nx silence_end: 52.75 | silence_duration: 8.5\n")
        (media / f"{name}.mp4.scenes").write_text("n:0 pts_time:31.75\n")
    (media / "broken.mp4").write_bytes(b"?")
    show = lambda kind: ("sh", "-c", "cat '{path}." + kind + "' >&2")
    commands = tools.Tools(probe=("cat", "{path}.probe"), silence=show("silence"), scenes=show("scenes"), audio=("cp", "{path}", "{out}"), frame=("sh", "-c", "printf 'P5 1 1 255 x' > '{out}'"))

    class Speech:
        def transcribe(self, path):
            return '{"result":[{"start":1.0,"end":30.0,"text":"of %s"}]}' % open(path).read()

    out = str(tmp_path / "out")
    cli.process(spark, str(media), out, Config(), commands=commands, speech=Speech())
    lines = [json.loads(r.value) for r in spark.read.text(f"{out}/chunks.jsonl").collect()]
    assert {x["video_id"] for x in lines} == {"one", "mute"}
    first = {x["video_id"]: x for x in lines if x["start_sec"] == 0}
    assert first["one"]["transcript"] == "of one" and first["one"]["modality_flags"]["has_speech"] and first["one"]["source_hash"].startswith("sha256:")
    assert first["mute"]["transcript"] == "" and not first["mute"]["modality_flags"]["has_speech"] and first["mute"]["image_refs"]
    errors = spark.read.json(f"{out}/errors.jsonl").collect()
    assert [(r.video_id, r.step) for r in errors] == [("broken", "probe")]
    annotated = spark.read.json(f"{out}/annotated.jsonl")
    assert annotated.count() == len(lines) and "title" in annotated.columns


class Calls:
    """A folder of files that stand for media, and tools that note each call in a log."""

    def __init__(self, folder):
        self.media, self.log = folder / "media", folder / "log"
        noted = lambda step, then: ("sh", "-c", f"echo {step} $(cat '{{path}}') >> {self.log}; {then}")
        streams = '{"format":{"duration":"100.0"},"streams":[{"codec_type":"video"},{"codec_type":"audio"}]}'
        self.commands = tools.Tools(probe=noted("probe", f"echo '{streams}'".replace("{", "{{").replace("}", "}}")), silence=noted("silence", "echo silence_start: 44.25 >&2; echo silence_end: 52.75 >&2"), scenes=noted("scene", "echo pts_time:31.75 >&2"), audio=noted("audio", "cp '{path}' '{out}'"), frame=("true",))

    def put(self, name, text):
        path = self.media / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)

    def made(self):
        lines = sorted(self.log.read_text().split("\n")[:-1]) if self.log.exists() else []
        self.log.unlink(missing_ok=True)
        return lines

    def speech(self):
        log = str(self.log)

        class Speech:  # of a function, so that workers needn't import this module
            def transcribe(self, path):
                text = open(path).read()
                with open(log, "a") as f:
                    f.write(f"asr {text}\n")
                return '{"result":[{"start":1.0,"end":30.0,"text":"of %s"}]}' % text

        return Speech()

    def facts(self, spark, commands=None):
        found = ingest.facts(spark, str(self.media), str(self.media.parent / "out"), self.speech(), commands or self.commands)
        return {r.video_id: r.text for r in found.transcript.collect()}, found


def test_facts_are_kept_by_contents(spark, tmp_path):
    calls = Calls(tmp_path)
    calls.put("a/one.mp4", "first")
    calls.put("b/two.mp4", "second")
    steps = ("asr", "audio", "probe", "scene", "silence")
    of = lambda *texts: sorted(f"{s} {t}" for s in steps for t in texts)
    assert calls.facts(spark)[0] == {"one": "of first", "two": "of second"} and calls.made() == of("first", "second")
    assert calls.facts(spark)[0] == {"one": "of first", "two": "of second"} and calls.made() == []  # nothing changed
    calls.put("b/two.mp4", "third!")
    assert calls.facts(spark)[0] == {"one": "of first", "two": "of third!"} and calls.made() == of("third!")  # only its own calls
    (calls.media / "a/one.mp4").rename(calls.media / "a/moved.mp4")
    calls.put("c/copy.mp4", "third!")
    assert calls.facts(spark)[0] == {"moved": "of first", "two": "of third!", "copy": "of third!"} and calls.made() == []  # known contents elsewhere
    other = dataclasses.replace(calls.commands, scenes=(*calls.commands.scenes, "again"))
    found = calls.facts(spark, other)[1]
    assert calls.made() == ["scene first", "scene third!"] and {r.at_sec for r in found.scenes.collect()} == {31.75}  # only the changed step
    calls.put("d/bad.mp4", "bad")
    broken = dataclasses.replace(calls.commands, silence=("sh", "-c", "grep -qv bad '{path}' && echo silence_start: 1 >&2"))
    calls.facts(spark, broken)
    calls.made()
    errors = calls.facts(spark, broken)[1].errors.collect()
    assert [(r.video_id, r.step) for r in errors] == [("bad", "silence")] and calls.made() == []  # what failed is tried again, without a note in the log
    assert {r.video_id for r in calls.facts(spark)[1].silences.collect()} == {"moved", "two", "copy", "bad"} and calls.made() == ["silence bad"]


def test_equal_names_are_different_media(spark, tmp_path):
    calls = Calls(tmp_path)
    for name, text in {"a/one.mp4": "first", "b/one.mp4": "second", "two.mp4": "third", "c/one.mp4": "first"}.items():
        calls.put(name, text)
    out = str(tmp_path / "out")
    commands = dataclasses.replace(calls.commands, frame=("sh", "-c", "printf 'P5 1 1 255 x' > '{out}'"))
    cli.process(spark, str(calls.media), out, Config(), commands=commands, speech=calls.speech())
    lines = [json.loads(r.value) for r in spark.read.text(f"{out}/chunks.jsonl").collect()]
    assert len({x["chunk_id"] for x in lines}) == len(lines)
    said = {x["source_path"].rsplit("/media/")[1]: (x["video_id"], x["transcript"]) for x in lines if x["start_sec"] == 0}
    assert {k: t for k, (_, t) in said.items()} == {"a/one.mp4": "of first", "b/one.mp4": "of second", "c/one.mp4": "of first", "two.mp4": "of third"}
    assert said["two.mp4"][0] == "two" and len({i for i, _ in said.values()}) == 4 and all(i.startswith("one~") for i, _ in said.values() if i != "two")
    assert all(x["visual_caption"] in (None, "") for x in lines)  # no captions without what makes them
    assert tools.with_media_ids(spark.createDataFrame([("/m/a/one.mp4",)], "path string"), "file:/m").first().video_id == "one"


def test_settings_choose_tools_and_adapters():
    t = tools.Tools.of(0.3, -40, 1)
    assert "select='gt(scene,0.3)',showinfo" in t.scenes and "silencedetect=noise=-40dB:d=1" in t.silence
    assert tools.Tools() == tools.Tools.of(0.4, -35.0, 0.5) and "silencedetect=noise=-35dB:d=0.5" in tools.Tools().silence
    assert adapters.captions_of("none", {}) is None and adapters.captions_of("http", {}) is None and isinstance(adapters.captions_of("stub", {}), adapters.StubCaption)
    assert adapters.captions_of("http", {"REELTIDE_CAPTION_URL": "http://x"}).url == "http://x"
    assert adapters.speech_of((), "m", "ja") is None and adapters.speech_of(("r", "-m", "{model}", "-l{language}"), "m", "ja").command == ["r", "-m", "m", "-lja"]
    assert adapters.ocr_of("none") is None


def test_media_as_a_data_source(spark, tmp_path):
    """Tools run for the columns asked for and the files that filters leave; a stream reads what arrives."""
    calls = Calls(tmp_path)
    calls.put("a/one.mp4", "first")
    calls.put("b/two.mp4", "second one")
    calls.put("b/bad.mp4", "bad")
    calls.put("b/notes.txt", "no medium")
    mediasource.register(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    scenes = ("sh", "-c", f"grep -qv bad '{{path}}' && echo scene $(cat '{{path}}') >> {calls.log} && echo pts_time:31.75 >&2")
    commands = {"probe": json.dumps(calls.commands.probe), "scenes": json.dumps(scenes), "silence": json.dumps(calls.commands.silence)}
    read = lambda schema: spark.read.format("media").options(**commands).schema(schema).load(str(calls.media))
    files = read("path string, bytes bigint").collect()
    assert sorted((r.path.rsplit("/", 1)[1], r.bytes) for r in files) == [("bad.mp4", 3), ("one.mp4", 5), ("two.mp4", 10)] and calls.made() == []
    rows = {r.path.rsplit("/", 1)[1]: r for r in read("path string, scene_log string, error string").collect()}
    assert rows["one.mp4"].scene_log == "pts_time:31.75\n" and rows["one.mp4"].error is None
    assert rows["bad.mp4"].scene_log is None and rows["bad.mp4"].error.startswith("scene_log: OSError") and calls.made() == ["scene first", "scene second one"]
    large = read("path string, bytes bigint, source_hash string, probe_json string").where("bytes > 5").collect()
    assert [r.source_hash for r in large] == ["sha256:" + hashlib.sha256(b"second one").hexdigest()] and calls.made() == ["probe second one"]
    assert set(spark.read.format("media").options(**commands).load(str(calls.media)).columns) == {"path", "bytes", "modified", "source_hash", "probe_json", "silence_log", "scene_log", "error"}
    assert spark.read.format("media").load(str(tmp_path / "none")).isEmpty()

    def arrived():
        q = spark.readStream.format("media").options(**commands).schema("path string, probe_json string").load(str(calls.media))
        q = q.writeStream.format("parquet").option("path", str(tmp_path / "seen")).option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return sorted(r.path.rsplit("/", 1)[1] for r in spark.read.parquet(str(tmp_path / "seen")).collect())

    calls.made()
    assert arrived() == ["bad.mp4", "one.mp4", "two.mp4"] and calls.made() == ["probe bad", "probe first", "probe second one"]
    calls.put("c/late.mp4", "late")
    assert arrived() == ["bad.mp4", "late.mp4", "one.mp4", "two.mp4"] and calls.made() == ["probe late"]


def test_streams_agree_with_batch(spark, small, tmp_path):
    events = spark.read.parquet(f"{small}/events.parquet")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    cuts = [r.ts for r in events.selectExpr("percentile_approx(cast(ts as timestamp), array(0.33, 0.66)) as q").selectExpr("explode(q) as ts").collect()]
    t = F.col("ts").cast("timestamp")
    for part in (t <= cuts[0], (t > cuts[0]) & (t <= cuts[1]), t > cuts[1]):
        events.where(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run(df, name, mode="append"):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(240)
        return spark.table(name)

    counted = run(signals.window_counts(signals.read_events(spark, str(tmp_path / "in"))), "counted")
    whole = events.groupBy(F.window(t, "1 hour").alias("w"), "event_type").count()
    late = {(r.w.start, r.event_type): r["count"] for r in whole.collect()}
    got = {(r.window_start, r.event_type): r.n for r in counted.collect()}
    assert got and all(late[k] == n for k, n in got.items())
    paired = run(signals.paired_silences(signals.read_events(spark, str(tmp_path / "in"))), "paired")
    marks = events.where("event_type in ('click', 'purchase')").select(F.col("user_id").alias("video_id"), F.unix_micros(t).alias("us"), (F.col("event_type") == "click").alias("is_start"))
    batch = parsers.pair_silences(marks.select("video_id", F.struct("us", "is_start").alias("ord"), "is_start", F.col("us").alias("at_sec")))
    over = events.agg(F.unix_micros(F.max(t))).first()[0] - 600_000_000
    every = {(r.video_id, r.start_sec, r.end_sec) for r in batch.collect()}
    want = {p for p in every if p[2] < over and p[2] - p[1] < 1000 * signals.WAITS_MS}
    got = {(r.user_id, r.start_us, r.end_us) for r in paired.collect()}
    assert want and want <= got <= every and len(got) == paired.count()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
