"""Settings by section, from defaults overlaid with a TOML file."""

from __future__ import annotations

import dataclasses
import hashlib
import json
import os
import tomllib
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Coarse:
    max_duration_sec: float = 300.0
    snap_window_sec: float = 30.0
    symmetric_snap: bool = False
    #: Whether segments and merged chunks are found by successors, for media whose signals or texts don't fit one task.
    by_successors: bool = False


@dataclass(frozen=True)
class Semantic:
    target_min_sec: float = 30.0
    target_max_sec: float = 90.0
    hard_min_sec: float = 15.0
    hard_max_sec: float = 120.0
    #: Whether a language model, where there is one, cuts coarse segments.
    by_model: bool = False


@dataclass(frozen=True)
class Frames:
    periodic_interval_sec: float = 5.0
    scene_change_threshold: float = 0.4
    max_analyzed: int = 8
    dhash_distance_threshold: int = 10


@dataclass(frozen=True)
class Silence:
    noise_db: float = -35.0
    min_duration_sec: float = 0.5


@dataclass(frozen=True)
class Vision:
    ocr_adapter: str = "tesseract"
    languages: tuple[str, ...] = ("jpn", "eng")
    #: ``none``, ``stub`` (names the file) or ``http`` (a model behind REELTIDE_CAPTION_URL).
    caption_adapter: str = "none"
    captions_per_chunk: int = 3
    #: Which frames of a chunk get captions: ``priority`` (scene changes first) or ``even``.
    caption_choice: str = "priority"


@dataclass(frozen=True)
class Speech:
    adapter: str = "whisper_cpp"
    model: str = "large-v3"
    language: str = "auto"
    #: The recogniser's command line, in which {model} and {language} stand for those settings and to which a file's path is added; it prints JSON.
    command: tuple[str, ...] = ()


@dataclass(frozen=True)
class Config:
    coarse: Coarse = field(default_factory=Coarse)
    semantic: Semantic = field(default_factory=Semantic)
    frames: Frames = field(default_factory=Frames)
    silence: Silence = field(default_factory=Silence)
    vision: Vision = field(default_factory=Vision)
    speech: Speech = field(default_factory=Speech)

    @classmethod
    def parse(cls, text: str) -> Config:
        """Defaults overlaid with a TOML text. Bad TOML raises; a section of the wrong kind is left at its defaults."""
        given = tomllib.loads(text)
        sections = {}
        for f in dataclasses.fields(cls):
            kind = type(getattr(cls(), f.name))
            part = given.get(f.name)
            known = {x.name: x for x in dataclasses.fields(kind)}
            try:
                values = {k: _as(getattr(kind(), k), v) for k, v in (part or {}).items() if k in known}
                sections[f.name] = kind(**values)
            except (TypeError, ValueError, AttributeError):
                sections[f.name] = kind()
        return cls(**sections)

    @classmethod
    def load(cls, path: str | None = None) -> Config:
        """The given file, else ``./reeltide.toml``, else the one in the user's configuration folder, else defaults."""
        for p in [path] if path else ["reeltide.toml", os.path.expanduser("~/.config/reeltide/config.toml")]:
            if path or os.path.exists(p):
                with open(p, encoding="utf-8") as f:
                    return cls.parse(f.read())
        return cls()

    def hash(self) -> str:
        """A digest of all settings; there are no secrets among them."""
        return "sha256:" + hashlib.sha256(json.dumps(dataclasses.asdict(self), sort_keys=True).encode()).hexdigest()


def _as(default, value):
    if isinstance(default, tuple):
        return tuple(str(v) for v in value)
    if isinstance(default, bool) != isinstance(value, bool) or isinstance(value, str) != isinstance(default, str):
        raise TypeError(value)
    return type(default)(value)
