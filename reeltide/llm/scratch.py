"""Intermediate tables in the folder that all executors share.

Long jobs cut their lineage by writing a table there and reading it back, so that a lost
executor costs a re-read and not a recomputation from the start.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reeltide.sources.sinks import shared_folder

#: Rows of one Arrow batch at most: documents come to Python tasks in batches of a few MB.
BATCH_ROWS = 1000


class Scratch:
    """A fresh folder below the shared one, for the tables of one operator call."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
        if not 0 < int(spark.conf.get(setting)) <= BATCH_ROWS:
            spark.conf.set(setting, BATCH_ROWS)
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self._n = 0
        self._tables: dict[str, DataFrame] = {}

    def folder(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def table(self, df: DataFrame, name: str = "t") -> DataFrame:
        """Write ``df`` and return it as read back, with its lineage cut."""
        path = self.folder(name)
        df.write.option("compression", "zstd").parquet(path)
        self._tables[path] = self.spark.read.schema(df.schema).parquet(path)
        return self._tables[path]

    def tables(self, name: str) -> list[DataFrame]:
        """Those that were written under a name."""
        return [t for p, t in self._tables.items() if p.endswith(f"-{name}")]

    def release(self, *tables: DataFrame) -> None:
        """Delete tables that nothing reads any more."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for path in [p for p, t in self._tables.items() if any(t is x for x in tables)]:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)
            del self._tables[path]

    def keep_only(self, *tables: DataFrame) -> None:
        """Delete all tables but those that the result still reads."""
        self.release(*[t for t in self._tables.values() if not any(t is x for x in tables)])


def free_name(name: str, taken: list[str]) -> str:
    """``name``, or with as many underscores before it as keep it apart from the columns ``taken``."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


#: Tasks that share a hot key in a lookup, rows from which a key may be hot, and how many keys may be hot at most.
SALTS, HOT_ROWS, HOT_KEYS = 16, 10_000, 10_000


def lookup(left: DataFrame, right: DataFrame, key: str, spread: list[Column | str], how: str = "left", n: str = "n", total: int | None = None) -> DataFrame:
    """Join ``left`` to ``right`` (a written table, unique in ``key``), with hot keys dealt to SALTS tasks each.

    ``n``: the column of ``right`` that says how many rows of ``left`` have the key (it goes); ``total``: how many there are.
    Keys of HOT_ROWS rows or more, and a ten-thousandth of all, are hot: HOT_KEYS at most, so that they can be broadcast whatever
    the size of the tables. ``spread``: columns of ``left`` whose hash tells rows of the same key apart.
    """
    least = max(HOT_ROWS, -(-(left.count() if total is None else total) // HOT_KEYS))
    hot = right.where(F.col(n) >= least).select(key).withColumn("_hot", F.lit(True))
    a = left.join(F.broadcast(hot), key, "left").withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(*spread), F.lit(SALTS))).otherwise(0).cast("int")).drop("_hot")
    b = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.when(F.col(n) >= least, SALTS - 1).otherwise(0)))).drop(n)
    return a.join(b, [key, "_salt"], how).drop("_salt")


def salted_lookup(left: DataFrame, right: DataFrame, key: str, spread: list[Column | str], how: str = "left", salts: int = 8) -> DataFrame:
    """Join ``left`` to a small ``right`` (unique in ``key``), every key dealt to ``salts`` tasks, where its rows aren't counted."""
    a = left.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    b = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return a.join(b, [key, "_salt"], how).drop("_salt")
