"""What runs outside Spark stands behind small protocols; each is applied to batches of rows in Spark's tasks.

A call that fails gives null and its reason in a second column, ``<output>_error``, so that one bad file doesn't end a job and
a missing tool doesn't pass for media without content.
"""

from __future__ import annotations

import base64
import json
import os
import shutil
import subprocess
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Statuses of a server that is busy or was slow. Seconds that it may ask to wait at most.
WAIT_STATUS, MOST_ASKED_WAIT = (408, 425, 429), 60.0
#: Seconds that an external tool and a model's answer may take.
TOOL_TIMEOUT, MODEL_TIMEOUT = 3600.0, 30.0


class SpeechAdapter(Protocol):
    def transcribe(self, path: str) -> str:
        """The tool's JSON for one audio file."""


class OcrAdapter(Protocol):
    def extract_text(self, path: str, languages: tuple[str, ...]) -> str: ...


class CaptionAdapter(Protocol):
    def caption(self, path: str) -> str: ...


class LanguageModel(Protocol):
    def complete_json(self, prompt: str) -> str: ...


def tool_available(name: str) -> bool:
    return shutil.which(os.path.expanduser(name)) is not None


class CommandSpeech:
    """Runs a recogniser that prints JSON. ``~`` in its path or its model's stands for the home folder."""

    def __init__(self, *command: str, timeout: float = TOOL_TIMEOUT):
        self.command, self.timeout = [os.path.expanduser(c) for c in command], timeout

    def transcribe(self, path: str) -> str:
        return subprocess.run([*self.command, path], capture_output=True, check=True, text=True, timeout=self.timeout).stdout


class TesseractOcr:
    def __init__(self, binary: str = "tesseract", timeout: float = TOOL_TIMEOUT):
        self.binary, self.timeout = os.path.expanduser(binary), timeout

    def extract_text(self, path: str, languages: tuple[str, ...]) -> str:
        return subprocess.run([self.binary, path, "stdout", "-l", "+".join(languages)], capture_output=True, check=True, text=True, timeout=self.timeout).stdout.strip()


class StubCaption:
    """Names the file, as long as no model is connected."""

    def caption(self, path: str) -> str:
        return STUB_CAPTION + path.rsplit("/", 1)[-1]


@dataclass(frozen=True)
class HttpCaption:
    """A model behind an HTTP endpoint that takes {model, image} (base64) as JSON and answers {text}."""

    url: str
    model: str
    key: str = field(default="", repr=False)
    timeout: float = MODEL_TIMEOUT

    def caption(self, path: str) -> str:
        with open(path, "rb") as f:
            return _post(self.url, {"model": self.model, "image": base64.b64encode(f.read()).decode()}, self.key, self.timeout)


class FixedModel:
    """Answers every prompt with the same JSON."""

    def __init__(self, reply: str):
        self.reply = reply

    def complete_json(self, prompt: str) -> str:
        return self.reply


@dataclass(frozen=True)
class HttpModel:
    """A model behind an HTTP endpoint that takes {model, prompt} as JSON and answers {text}, the model's JSON."""

    url: str
    model: str
    key: str = field(default="", repr=False)
    timeout: float = MODEL_TIMEOUT

    def complete_json(self, prompt: str) -> str:
        return _post(self.url, {"model": self.model, "prompt": prompt}, self.key, self.timeout)


def _post(url: str, body: dict[str, str], key: str, timeout: float) -> str:
    request = urllib.request.Request(url, json.dumps(body).encode(), {"content-type": "application/json", **({"authorization": f"Bearer {key}"} if key else {})})
    with urllib.request.urlopen(request, timeout=timeout) as answer:
        return json.load(answer)["text"]


def model_from_environment(environment: dict[str, str] | None = None) -> LanguageModel | None:
    """The model that REELTIDE_MODEL_URL, REELTIDE_MODEL and REELTIDE_MODEL_KEY name; None without an address."""
    env = os.environ if environment is None else environment
    url = env.get("REELTIDE_MODEL_URL")
    return HttpModel(url, env.get("REELTIDE_MODEL", "default"), env.get("REELTIDE_MODEL_KEY", "")) if url else None


def captions_of(kind: str, environment: dict[str, str] | None = None) -> CaptionAdapter | None:
    """What makes captions: nothing, the stub, or the model that REELTIDE_CAPTION_URL names (nothing without an address)."""
    env = os.environ if environment is None else environment
    if kind == "stub":
        return StubCaption()
    url = env.get("REELTIDE_CAPTION_URL") if kind == "http" else None
    return HttpCaption(url, env.get("REELTIDE_CAPTION_MODEL", "default"), env.get("REELTIDE_MODEL_KEY", "")) if url else None


def speech_of(command: tuple[str, ...], model: str, language: str) -> SpeechAdapter | None:
    """The recogniser with that command line, whose {model} and {language} are filled in; None without one."""
    return CommandSpeech(*[c.replace("{model}", model).replace("{language}", language) for c in command]) if command else None


def ocr_of(kind: str) -> OcrAdapter | None:
    """The named reader of pictures, where it is installed."""
    return TesseractOcr(kind) if kind == "tesseract" and tool_available(kind) else None


def with_retries(call: Callable[[], str], attempts: int = 3, first_wait: float = 0.1, most_wait: float = 10.0, sleep: Callable[[float], None] = time.sleep) -> str:
    """Calls until one attempt succeeds and its answer is JSON; waits double in between, or are as long as a busy server asks for.

    What a server refuses for good (a status of 400 to 499, but for those that say wait) isn't asked again.
    """
    for i in range(attempts):
        try:
            answer = call()
            json.loads(answer)
            return answer
        except Exception as e:
            status = e.code if isinstance(e, urllib.error.HTTPError) else 0
            if i + 1 == attempts or 400 <= status < 500 and status not in WAIT_STATUS:
                raise
            asked = e.headers.get("Retry-After", "") if status else ""
            sleep(min(float(asked), MOST_ASKED_WAIT) if asked.isdigit() else min(first_wait * 2**i, most_wait))
    raise ValueError("no attempts")


def map_text(df: DataFrame, inputs: list[str], output: str, call: Callable[..., str | None]) -> DataFrame:
    """Adds a string column made by ``call`` of the inputs and, where it fails, null and the reason in ``<output>_error``."""

    def safe(args: tuple) -> tuple[str | None, str | None]:
        try:
            return call(*args), None
        except Exception as e:
            return None, f"{type(e).__name__}: {e}"[:500]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [safe(row) for row in batch[inputs].itertuples(index=False, name=None)]
            batch[output] = pd.Series([d[0] for d in done], batch.index, object)
            batch[f"{output}_error"] = pd.Series([d[1] for d in done], batch.index, object)
            yield batch

    return df.mapInPandas(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), f"`{output}` string", f"`{output}_error` string"]))


def admitted(df: DataFrame, inputs: list[str], output: str, call: Callable[..., str | None], at_once: int, per_sec: float | None = None) -> DataFrame:
    """``map_text`` for calls that others answer: at most ``at_once`` of the whole job wait at a time, ``per_sec`` begin in a second.

    Rows are dealt by their inputs to as many partitions as calls are admitted, whose calls follow each other; each has its share
    of the rate. However many tasks a cluster could run, the job asks no more.
    """
    apart = at_once / per_sec if per_sec else 0.0

    def paced(*args: object) -> str | None:
        began = time.monotonic()
        try:
            return call(*args)
        finally:
            time.sleep(max(0.0, apart - (time.monotonic() - began)))

    return map_text(df.repartition(at_once, *inputs), inputs, output, paced)


def transcribe(audio: DataFrame, adapter: SpeechAdapter, path_col: str = "wav_path") -> DataFrame:
    """Adds asr_json; files that can't be recognised have none, and so an empty transcript, with the reason in asr_json_error."""
    return map_text(audio, [path_col], "asr_json", adapter.transcribe)


def read_frames(frames: DataFrame, ocr: OcrAdapter, languages: tuple[str, ...] = ("jpn", "eng"), path_col: str = "path") -> DataFrame:
    return map_text(frames, [path_col], "ocr_text", lambda path: ocr.extract_text(path, languages))


def caption_frames(frames: DataFrame, captions: CaptionAdapter, path_col: str = "path") -> DataFrame:
    return map_text(frames, [path_col], "visual_caption", captions.caption)


#: What a model is asked about a chunk, and the reply that is expected.
ANNOTATION_PROMPT = "Give a title of at most 50 characters, a summary and three keywords as JSON (title, summary, keywords) for this transcript from %s to %s:\n%s"
ANNOTATION = "title string, summary string, keywords array<string>"
#: What a model is asked about a coarse segment, and the reply that is expected.
CHUNKS_PROMPT = "Split this transcript of %s seconds into parts of %s to %s seconds that follow each other from 0 to the end, as JSON with chunks of start_sec, end_sec and rationale:\n%s"
CHUNKS = "chunks array<struct<start_sec:double,end_sec:double,rationale:string>>"
# Texts of results.
NO_SUMMARY, DIVIDED, STUB_CAPTION, NO_REPLY_KEYWORD = "Failed to generate summary from LLM", "Fallback equal division", "Visual caption for ", "content"


def annotation_prompt(start: Column, end: Column, text: Column) -> Column:
    return F.format_string(ANNOTATION_PROMPT, start, end, text)


def chunks_prompt(duration: Column, least: float, most: float, text: Column) -> Column:
    return F.format_string(CHUNKS_PROMPT, duration.cast("string"), F.lit(str(least)), F.lit(str(most)), text)


def _asked(df: DataFrame, model: LanguageModel, prompt: str, reply: str, at_once: int, per_sec: float | None) -> DataFrame:
    return admitted(df, [prompt], reply, lambda p: with_retries(lambda: model.complete_json(p)), at_once, per_sec)


def annotate_with(chunks: DataFrame, model: LanguageModel, at_once: int = 4, per_sec: float | None = None) -> DataFrame:
    """Adds title, summary and keywords from a model's replies; where one lacks a field, those a chunk can give itself, with the reason in annotation_error."""
    from reeltide.functions.text import short_title
    from reeltide.functions.text import timecode as tc

    asked = chunks.withColumn("prompt", annotation_prompt(tc(F.col("start_sec")), tc(F.col("end_sec")), F.col("transcript_text")))
    asked = _asked(asked, model, "prompt", "reply", at_once, per_sec)
    r = F.from_json("reply", ANNOTATION)
    whole = r["title"].isNotNull() & r["summary"].isNotNull() & r["keywords"].isNotNull()
    return asked.withColumns(
        {
            "title": F.when(whole, r["title"]).otherwise(short_title(F.col("transcript_text"), F.col("chunk_id"))),
            "summary": F.when(whole, r["summary"]).otherwise(NO_SUMMARY),
            "keywords": F.when(whole, r["keywords"]).otherwise(F.array(F.lit(NO_REPLY_KEYWORD))),
            "annotation_error": F.when(~F.coalesce(whole, F.lit(False)), F.coalesce("reply_error", F.lit("the reply lacks a field"))),
        }
    ).drop("prompt", "reply", "reply_error")


def reply_is_valid(chunks: Column, end: Column, tolerance: float = 0.01) -> Column:
    """Whether a reply's chunks start at 0, end at ``end``, have length, and follow each other without overlap or gap."""
    n = F.size(chunks)
    near = lambda a, b: F.abs(a - b) <= tolerance
    follows = F.forall(F.sequence(F.lit(0), n - 2), lambda i: (F.get(chunks, i)["end_sec"] <= F.get(chunks, i + 1)["start_sec"]) & near(F.get(chunks, i)["end_sec"], F.get(chunks, i + 1)["start_sec"]))
    sound = F.forall(chunks, lambda c: c["start_sec"].isNotNull() & c["end_sec"].isNotNull() & c["rationale"].isNotNull() & (c["end_sec"] > c["start_sec"]))
    ok = near(F.get(chunks, F.lit(0))["start_sec"], F.lit(0.0)) & near(F.get(chunks, n - 1)["end_sec"], end) & sound & F.when(n < 2, True).otherwise(follows)
    return F.coalesce(F.when(n > 0, ok), F.lit(False))


def placeholder(start: Column, end: Column) -> Column:
    """The text of a chunk that a model cut: its times to a tenth of a second, rounded from their exact binary values, ties to even."""

    def tenth(x: Column) -> Column:
        whole = F.floor(F.abs(x)).cast("bigint")
        bits = ((F.abs(x) - whole) * float(1 << 59)).cast("bigint") * 10  # of the fraction, exact
        digit = F.shiftright(bits, 59)
        rest = bits - F.shiftleft(digit, 59)
        up = (rest > 1 << 58) | ((rest == 1 << 58) & (digit % 2 == 1))
        n = whole * 10 + digit + up.cast("bigint")
        return F.concat(F.when(x < 0, "-").otherwise(""), F.floor(n / 10).cast("string"), F.lit("."), (n % 10).cast("string"))

    return F.concat(F.lit("Segment from "), tenth(start), F.lit("s to "), tenth(end), F.lit("s"))


def semantic_with(coarse_text: DataFrame, model: LanguageModel, target_min: float = 30.0, target_max: float = 90.0, at_once: int = 4, per_sec: float | None = None) -> DataFrame:
    """Chunks of coarse segments (video_id, seg_index, start_sec, end_sec, transcript_text) as a model cuts them.

    A reply that isn't valid is asked for once more; where that isn't valid either, or the model can't be reached, the
    segment is cut into equal pieces. Returns (video_id, ord, start_sec, end_sec, transcript_text, rationale).
    """
    from reeltide.operators.segment import equal_division
    from reeltide.sources.sinks import keep

    end = F.col("end_sec")
    asked = coarse_text.withColumn("prompt", chunks_prompt(end, target_min, target_max, F.col("transcript_text")))

    def ask(prompt: str, end_sec: float) -> str:
        answer = with_retries(lambda: model.complete_json(prompt))
        return answer if _fits(answer, end_sec) else with_retries(lambda: model.complete_json(prompt))

    asked = keep(admitted(asked, ["prompt", "end_sec"], "reply", ask, at_once, per_sec), "replies")  # both branches below read them
    asked = asked.withColumn("chunks", F.from_json("reply", CHUNKS)["chunks"]).withColumn("cut", reply_is_valid(F.col("chunks"), end))
    ord_ = F.col("seg_index") * 1000000
    cut = asked.where("cut").select("video_id", "seg_index", F.posexplode("chunks").alias("part", "c"))
    cut = cut.select("video_id", (ord_ + F.col("part")).alias("ord"), "c.start_sec", "c.end_sec", placeholder(F.col("c.start_sec"), F.col("c.end_sec")).alias("transcript_text"), "c.rationale")
    divided = equal_division(asked.where("not cut").select(coarse_text.columns), target_min, target_max)
    divided = divided.select("video_id", (ord_ + F.col("part")).alias("ord"), "start_sec", "end_sec", "transcript_text", F.lit(DIVIDED).alias("rationale"))
    return cut.unionByName(divided)


def _fits(answer: str, end: float, tolerance: float = 0.01) -> bool:
    """``reply_is_valid`` for one answer, to know whether to ask again."""
    try:
        spans = [(float(c["start_sec"]), float(c["end_sec"])) for c in json.loads(answer)["chunks"] if c["rationale"] is not None]
    except (KeyError, TypeError, ValueError):
        return False
    inner = all(a[1] <= b[0] and b[0] - a[1] <= tolerance for a, b in zip(spans, spans[1:]))
    return bool(spans) and inner and all(a < b for a, b in spans) and abs(spans[0][0]) <= tolerance and abs(spans[-1][1] - end) <= tolerance
