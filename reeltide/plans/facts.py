"""What tools said of media, kept by contents: a file that is known isn't worked on again, wherever it lies.

An output belongs to a source hash, a step and the command that made it. Files that have the same path, size and time of change as before keep
their hash unread; outputs are looked up by hash, so that moved, renamed or repeated files cost nothing, a changed file costs its own
calls and a changed command its own step. Outputs that failed are tried again. Everything is appended in committed batches.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import is_dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reeltide.plans.commits import Batches

OUTPUT = "source_hash string, step string, command_hash string, output string, error string"
FILE = "path string, bytes bigint, modified timestamp, source_hash string, source_hash_error string"


def command_hash(command: object) -> str:
    """A digest of a command line, or of an adapter's kind and settings."""
    if isinstance(command, tuple | list):
        said = list(command)
    elif is_dataclass(command):  # whose secrets aren't shown
        said = [repr(command)]
    else:
        said = [type(command).__qualname__, {k: repr(v) for k, v in sorted(getattr(command, "__dict__", {}).items())}]
    return hashlib.sha256(json.dumps(said).encode()).hexdigest()[:32]


class FactStore:
    """The outputs of tools, and the hashes of files, below one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.outputs, self.files = Batches(spark, f"{folder}/outputs", OUTPUT), Batches(spark, f"{folder}/files", FILE)

    def hashed(self, files: DataFrame, digest: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``files`` (path, bytes, modified, …) with source_hash; ``digest`` adds it (and source_hash_error) to those not known as they are.

        A file whose hash can't be made has none, and is tried again.
        """
        keys = ["path", "bytes", "modified"]
        new = files.select(*keys).join(self.files.read().where("source_hash is not null"), keys, "left_anti")
        if not new.isEmpty():
            self.files.append(digest(new).select(*keys, "source_hash", "source_hash_error"))
        newest = F.max_by(F.struct("source_hash", "source_hash_error"), F.struct(F.col("source_hash").isNotNull(), "version"))
        return files.join(self.files.read().groupBy(*keys).agg(newest.alias("r")).select(*keys, "r.*"), keys, "left")

    def said(self, step: str, command: object) -> DataFrame:
        """(source_hash, output, error, version) of a step: the newest success, else the newest failure."""
        rows = self.outputs.read().where((F.col("step") == step) & (F.col("command_hash") == command_hash(command)))
        newest = F.max_by(F.struct("output", "error", "version"), F.struct(F.col("error").isNull(), "version"))
        return rows.groupBy("source_hash").agg(newest.alias("r")).select("source_hash", "r.*")

    def of(self, wanted: DataFrame, step: str, command: object, run: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``wanted`` (source_hash, …) with the step's output and error.

        ``run`` gets one row of each source without a successful output and adds output and output_error.
        """
        todo = wanted.where("source_hash is not null").join(self.said(step, command).where("error is null"), "source_hash", "left_anti").dropDuplicates(["source_hash"])
        if not todo.isEmpty():
            self.outputs.append(run(todo).select("source_hash", F.lit(step).alias("step"), F.lit(command_hash(command)).alias("command_hash"), "output", F.col("output_error").alias("error")))
        return wanted.join(self.said(step, command).drop("version"), "source_hash", "left")
