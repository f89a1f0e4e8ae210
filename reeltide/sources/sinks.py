"""Where results go: JSON lines, Markdown documents and an index, partitioned by video."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_chunks(chunks: DataFrame, folder: str) -> None:
    """One compact JSON object per chunk, nulls written out."""
    chunks.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{folder}/chunks.jsonl")


def write_markdown(documents: DataFrame, folder: str) -> None:
    """(video_id, document) -> one text row per video, in folders by video."""
    documents.select("video_id", F.col("document").alias("value")).write.mode("overwrite").partitionBy("video_id").option("lineSep", "\n").text(f"{folder}/markdown")


def write_index(index: DataFrame, folder: str) -> None:
    index.write.mode("overwrite").json(f"{folder}/index")


def write_annotated(annotated: DataFrame, folder: str) -> None:
    """Annotated chunks, without evidence from frames, as one compact JSON object each."""
    annotated.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{folder}/annotated.jsonl")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share (``spark.checkpoint.dir``). Only a session of one machine may go without: it gets a folder of its own."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"file://{tempfile.gettempdir()}/checkpoints"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


class Kept:
    """Tables of rows that several branches of a plan read, written once below a shared folder."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or f"{shared_folder(spark)}/kept-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Delete all of them, once nothing reads them any more."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)


def keep(df: DataFrame, name: str) -> DataFrame:
    """One such table, for as long as the shared folder lasts."""
    return Kept(df.sparkSession).table(df, name)
