"""Media files as a data source: ``spark.read.format("media").load(folder)``, and the same as a stream of files that arrive.

Each column but the file's own is what one tool says, and a tool runs only where its column is asked for: give the wanted columns as
``.schema(...)``. Filters on a file's path or size choose files before any tool runs (with
``spark.sql.python.filterPushdown.enabled``). A tool that fails gives null, with its reason in ``error``. Folders are seen by all executors.

Options: ``path``; ``pattern`` of file names (``*.mp4``); ``probe``, ``silence`` and ``scenes``, commands as JSON lists instead of the usual ones; ``files``
of one task (1).
"""

from __future__ import annotations

import datetime
import fnmatch
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from reeltide.sources import tools

SCHEMA = "path string, bytes bigint, modified timestamp, source_hash string, probe_json string, silence_log string, scene_log string, error string"
_COMPARED = {EqualTo: lambda a, b: a == b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b, In: lambda a, b: a in b}


@dataclass(frozen=True)
class File:
    path: str
    bytes: int
    modified_ns: int

    def value(self, column: str) -> object:
        return datetime.datetime.fromtimestamp(self.modified_ns / 1e9, datetime.UTC) if column == "modified" else getattr(self, column)


class Files(InputPartition):
    def __init__(self, files: list[File]):
        super().__init__(files)


class _Media:
    """What reads files, whether once or as they arrive."""

    def __init__(self, options: dict[str, str], schema: StructType):
        usual = tools.Tools()
        self.folder, self.pattern, self.at_once = options["path"].removeprefix("file://"), options.get("pattern", "*.mp4"), max(1, int(options.get("files", "1")))
        self.columns = schema.fieldNames()
        self.commands = {column: tuple(json.loads(options[option])) if option in options else command for column, option, command in (("probe_json", "probe", usual.probe), ("silence_log", "silence", usual.silence), ("scene_log", "scenes", usual.scenes))}
        self.filters: list[tuple[type[Filter], str, object]] = []

    def listed(self) -> list[File]:
        found = []
        for folder, _, names in os.walk(self.folder):
            for name in fnmatch.filter(names, self.pattern):
                path = os.path.join(folder, name)
                about = os.stat(path)
                found.append(File(path, about.st_size, about.st_mtime_ns))
        return sorted((f for f in found if all(_COMPARED[kind](f.value(c), v) for kind, c, v in self.filters)), key=lambda f: f.path)

    def dealt(self, files: list[File]) -> list[Files]:
        return [Files(files[k : k + self.at_once]) for k in range(0, len(files), self.at_once)]

    def read(self, partition: Files) -> Iterator[tuple]:
        for f in partition.value:
            row: dict[str, object] = {c: f.value(c) for c in ("path", "bytes", "modified") if c in self.columns}
            errors = []
            for column in self.columns:
                try:
                    if column == "source_hash":
                        row[column] = tools.file_hash(f.path)
                    elif column in self.commands:
                        row[column] = tools.said(self.commands[column], {"path": f.path}, column != "probe_json")
                except Exception as e:
                    errors.append(f"{column}: {type(e).__name__}: {e}"[:500])
            row["error"] = "; ".join(errors) or None
            yield tuple(row.get(c) for c in self.columns)


class MediaReader(_Media, DataSourceReader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes those on a file's own columns, and gives the others back."""
        for f in filters:
            if type(f) in _COMPARED and f.attribute in (("path",), ("bytes",)):
                self.filters.append((type(f), f.attribute[0], f.value))
            else:
                yield f

    def partitions(self) -> list[Files]:
        return self.dealt(self.listed()) or [Files([])]


class MediaStreamReader(_Media, DataSourceStreamReader):
    """Files in the order of their times of change; one that arrives with an older time than a batch has seen is missed."""

    def initialOffset(self) -> dict:
        return {"until": 0}

    def latestOffset(self) -> dict:
        return {"until": max((f.modified_ns for f in self.listed()), default=0)}

    def partitions(self, start: dict, end: dict) -> list[Files]:
        return self.dealt([f for f in self.listed() if start["until"] < f.modified_ns <= end["until"]])


class MediaSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "media"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> MediaReader:
        return MediaReader(self.options, schema)

    def streamReader(self, schema: StructType) -> MediaStreamReader:
        return MediaStreamReader(self.options, schema)


def register(spark: SparkSession) -> None:
    """Make ``media`` known to the session."""
    spark.dataSource.register(MediaSource)
