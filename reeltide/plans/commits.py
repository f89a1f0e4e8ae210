"""Append-only tables whose batches count once they are committed, in the order of their commits.

A commit is one small file, named by its version, that is put where none may be yet: of several writers that try the same
version one succeeds, and the others take the next. What a broken run left without a commit is never read.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from reeltide.sources.sinks import exists

COMMIT = "version bigint, batch string"


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a whole file, or nothing where one is already: by a link on local disks, else by a rename that doesn't overwrite."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    draft = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.draft")
    system = target.getFileSystem(conf)
    system.mkdirs(target.getParent())
    stream = system.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if system.getScheme() == "file":
            os.link(draft.toUri().getPath(), target.toUri().getPath())
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), conf)
            context.rename(draft, target, spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        return True
    except Exception:
        if not system.exists(target):
            raise
        return False
    finally:
        if system.exists(draft):
            system.delete(draft, False)


class Batches:
    """One such table: rows below ``folder/rows``, commits below ``folder/commits``."""

    def __init__(self, spark: SparkSession, folder: str, schema: str):
        self.spark, self.folder, self.schema = spark, folder, schema
        self._batches: dict[int, str] = {}

    def _newest(self) -> int:
        """The newest version; commits that weren't known yet are looked up, one row each."""
        folder = f"{self.folder}/commits"
        if not exists(self.spark, folder):
            return 0
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        names = [f.getPath().getName() for f in path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path)]
        new = [f"{folder}/{n}" for n in names if n.endswith(".json") and int(n.removesuffix(".json")) not in self._batches]
        if new:
            self._batches |= {r.version: r.batch for r in self.spark.read.schema(COMMIT).json(new).collect()}
        return max(self._batches, default=0)

    def append(self, rows: DataFrame) -> int:
        """Write ``rows`` as one batch and commit it; the version it got, from 1."""
        batch = f"b{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.folder}/rows/batch={batch}")
        version = self._newest() + 1
        while not put_if_absent(self.spark, f"{self.folder}/commits/{version:020d}.json", json.dumps({"version": version, "batch": batch})):
            version += 1
        return version

    def read(self) -> DataFrame:
        """All rows committed by now, with the version of their batch.

        The batches are named one by one: two reads of one folder would count as the same scan, whatever was added in between.
        """
        if not self._newest():
            return self.spark.createDataFrame([], f"{self.schema}, version bigint")
        versions = self.spark.createDataFrame([(b, v) for v, b in self._batches.items()], "batch string, version bigint")
        folder = f"{self.folder}/rows"
        rows = self.spark.read.schema(f"{self.schema}, batch string").option("basePath", folder).parquet(*[f"{folder}/batch={b}" for b in self._batches.values()])
        return rows.join(versions, "batch").drop("batch")
