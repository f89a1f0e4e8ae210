"""Stage bookkeeping as a table: records of runs, their transitions, and what is still to be done.

Records are only ever added, so that runs of different media can write side by side; the newest record of a media's stage
says where it stands.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reeltide.plans.commits import Batches

#: The stages of the pipeline in order, and the states of a record.
STAGES = ("probe", "audio", "asr", "silence", "scene", "frames", "coarse", "semantic", "normalize", "annotate")
STATES = ("pending", "running", "done", "failed")
RECORD = "video_id string, stage string, input_hash string, status string, output_path string, completed_at timestamp, version bigint"


def input_hash(source_hash: Column, config_hash: str) -> Column:
    """What all stages of a media depend on: its source and the settings."""
    return F.concat(F.coalesce(source_hash, F.lit("")), F.lit(":"), F.lit(config_hash))


def cache_key(*inputs: Column | str) -> Column:
    """A digest of a stage's input columns as JSON, nulls included."""
    return F.concat(F.lit("sha256:"), F.sha2(F.to_json(F.struct(*inputs), {"ignoreNullFields": "false"}), 256))


def latest(records: DataFrame) -> DataFrame:
    """The newest record of each media's stage."""
    rest = [c for c in records.columns if c not in ("video_id", "stage")]
    return records.groupBy("video_id", "stage").agg(F.max_by(F.struct(*rest), "version").alias("r")).select("video_id", "stage", "r.*")


def _next(stages: DataFrame, status: str, output_path: str | None, *more: Column) -> DataFrame:
    if status not in STATES:
        raise ValueError(f"no such state: {status}")
    done = status == "done"
    at = F.current_timestamp() if done else F.lit(None).cast("timestamp")
    return stages.select("video_id", "stage", "input_hash", F.lit(status).alias("status"), F.lit(output_path if done else None).cast("string").alias("output_path"), at.alias("completed_at"), *more)


def rows_hash(*tables: DataFrame) -> DataFrame:
    """(video_id, source_hash): a digest of the rows that each medium has in the tables, whatever their order.

    Each table gives its number of rows, and the sum and the exclusive or of two hashes of them, so that a medium's rows are never gathered.
    """
    parts = []
    for k, t in enumerate(tables):
        columns = sorted(t.columns)
        row = lambda seed, c=columns: F.xxhash64(F.lit(seed), *[F.struct(F.col(x).isNull(), F.col(x)) for x in c])
        parts.append(t.groupBy(F.col("video_id").cast("string").alias("video_id")).agg(F.count("*").alias("n"), F.sum(row(1).cast("decimal(38,0)")).alias("s"), F.bit_xor(row(2)).alias("x")).withColumn("k", F.lit(k)))
    whole = reduce(DataFrame.unionByName, parts).groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("k", "n", "s", "x"))).alias("l"))
    return whole.select("video_id", cache_key("l").alias("source_hash"))


def transition(records: DataFrame, stages: DataFrame, status: str, output_path: str | None = None) -> DataFrame:
    """The next record, in ``status``, of each of ``stages`` (video_id, stage, input_hash); a run in progress has no output yet."""
    before = records.groupBy("video_id", "stage").agg(F.max("version").alias("v"))
    return _next(stages.join(before, ["video_id", "stage"], "left"), status, output_path, (F.coalesce("v", F.lit(-1)) + 1).alias("version"))


def mark(records: DataFrame, stages: DataFrame, status: str, output_path: str | None = None) -> DataFrame:
    """``records`` and their next ones."""
    return records.unionByName(transition(records, stages, status, output_path))


def finished(wanted: DataFrame, records: DataFrame) -> DataFrame:
    """The wanted (video_id, stage, input_hash) whose newest record is done with the same input, with its output_path."""
    done = latest(records).where("status = 'done'").select("video_id", "stage", "input_hash", "output_path")
    return wanted.join(done, ["video_id", "stage", "input_hash"])


def pending(wanted: DataFrame, records: DataFrame) -> DataFrame:
    """The wanted (video_id, stage, input_hash) without a finished record of the same input."""
    done = records.where("status = 'done'").select("video_id", "stage", "input_hash").distinct()
    return wanted.join(done, ["video_id", "stage", "input_hash"], "left_anti")


class Manifest:
    """The records of one output folder, below ``folder/manifest``: each batch of them is committed under a version of its own."""

    def __init__(self, spark: SparkSession, folder: str):
        self.table = Batches(spark, f"{folder}/manifest", RECORD.removesuffix(", version bigint"))

    def records(self) -> DataFrame:
        return self.table.read()

    def add(self, stages: DataFrame, status: str, output_path: str | None = None) -> None:
        self.table.append(_next(stages, status, output_path))
