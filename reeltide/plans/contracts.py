"""What each stage reads and gives, declared once: order, checks of schemas and cache keys follow from it.

A stage's key for a medium digests the keys of what it reads and the settings it uses, so that a change remakes what depends on it and nothing else.
Schemas are checked before a job runs: a missing column or a wrong type fails at once, not in a later stage.
"""

from __future__ import annotations

import dataclasses
import hashlib
import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, StructType

from reeltide.plans.config import Config
from reeltide.plans.manifest import rows_hash

#: Relations that the pipeline is given; each also has a video_id.
GIVEN = {
    "media": "duration_sec double",
    "transcript": "seg_idx bigint, start_sec double, end_sec double, text string",
    "silences": "start_sec double, end_sec double",
    "scenes": "at_sec double",
    "hashes": "frame_idx int, hash bigint",
}


class ContractError(ValueError):
    """A relation lacks what its contract says."""


@dataclass(frozen=True)
class Contract:
    """The relations and stages that a stage reads, the sections of settings it uses, and the columns it gives besides video_id."""

    reads: tuple[str, ...]
    settings: tuple[str, ...]
    gives: str


STAGES: Mapping[str, Contract] = {
    "frames": Contract(("media", "scenes", "hashes"), ("frames",), "frame_idx int, at_sec double, kind string, path string"),
    "coarse": Contract(("media", "silences", "scenes"), ("coarse",), "seg_index bigint, start_sec double, end_sec double"),
    "semantic": Contract(("coarse", "transcript"), ("semantic",), "ord bigint, start_sec double, end_sec double, transcript_text string, rationale string"),
    "normalize": Contract(("semantic",), ("semantic", "coarse"), "idx bigint, chunk_id string, start_sec double, end_sec double, transcript_text string"),
    "annotate": Contract(("normalize",), (), "idx bigint, chunk_id string, start_sec double, end_sec double, transcript_text string, title string, summary string, keywords array<string>"),
}


def ordered(stages: Mapping[str, Contract] = STAGES, given: Iterable[str] = tuple(GIVEN)) -> list[str]:
    """The stages, each after those it reads; a stage or relation that nothing gives, or a circle, is an error."""
    known = {*stages, *given}
    for name, contract in stages.items():
        if missing := [r for r in contract.reads if r not in known]:
            raise ContractError(f"stage {name} reads {missing}, which nothing gives")
    return list(TopologicalSorter({n: [r for r in c.reads if r in stages] for n, c in stages.items()}).static_order())


def _alike(has: DataType, wants: DataType) -> bool:
    whole = isinstance(has, IntegralType) and isinstance(wants, IntegralType)
    return whole or has.simpleString() == wants.simpleString()


def check(name: str, rows: DataFrame, columns: str) -> DataFrame:
    """``rows``, if it has the columns of a contract; whole numbers may be of any width."""
    wanted = StructType.fromDDL(columns)
    types = {f.name: f.dataType for f in rows.schema.fields}
    wrong = [f"{f.name} {f.dataType.simpleString()}" for f in wanted if f.name not in types or not _alike(types[f.name], f.dataType)]
    if "video_id" not in types or wrong:
        raise ContractError(f"{name} lacks {', '.join(wrong) or 'video_id'}; it has {rows.schema.simpleString()}")
    return rows


def settings_hash(config: Config, sections: tuple[str, ...]) -> str:
    return hashlib.sha256(json.dumps([dataclasses.asdict(getattr(config, s)) for s in sections], sort_keys=True).encode()).hexdigest()


def stage_keys(given: Mapping[str, DataFrame], config: Config, stages: Mapping[str, Contract] = STAGES, more: str = "") -> DataFrame:
    """(video_id, and each stage's key as a column of its name) of all media.

    A given relation's key is the digest of the medium's rows in it, of the columns that its contract names (see rows_hash). ``more``: what else results depend on, such as which model is used.
    """
    keys = given["media"].select(F.col("video_id").cast("string").alias("video_id")).distinct()
    for name, rows in given.items():
        keys = keys.join(rows_hash(rows.select("video_id", *StructType.fromDDL(GIVEN[name]).names)).withColumnRenamed("source_hash", name), "video_id", "left")
    for name in ordered(stages, GIVEN):
        parts = [F.coalesce(F.col(r), F.lit("-")) if r in keys.columns else F.lit("-") for r in stages[name].reads]
        keys = keys.withColumn(name, F.concat(F.lit("sha256:"), F.sha2(F.concat_ws("|", F.lit(name), F.lit(settings_hash(config, stages[name].settings)), F.lit(more), *parts), 256)))
    return keys.select("video_id", *stages)
