"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a target number of words. Whole epochs of the source come first; the rest of its target is
filled by documents in the order of exponential keys, ``-ln(u) / quality``, which makes the chance to come early
proportional to quality. ``u`` hashes the document's id, so that reruns agree. The document at the end of the
budget is taken up to it (its first words), so a source's words are its target, rounded.

Sizes, keys and sources are one narrow table; its order is dealt to range partitions of (source, key), and
prefix sums are offsets of partitions plus sums within, so that a source of any size is spread evenly.

Defined cases: null text has size 0; a null source is a source of its own, ordered last; a source without words
has target 0; null, non-positive or NaN quality counts as the least weight; rows that repeat an id are ordered by
size and then by their place in the table, each taken by itself; a document without words isn't taken. Targets are found over one
row per source, in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reeltide.llm.scratch import Scratch, free_name

WORD = r"[^\x20\x09-\x0D]+"
_LEAST_QUALITY = 1e-3
#: Rows of one range partition.
_RANGE_ROWS = 50_000


def cleanness(text: Column) -> Column:
    """A plain quality weight in (0, 1]: the share of characters that aren't markup-like symbols."""
    n = F.length(text)
    return F.when(n > 0, F.length(F.translate(text, "#$%&*|<>{}[]=_~^\\", "")) / n)


def plan_mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, quality: Column | None = None, seed: int = 0, row_col: str | None = None
) -> DataFrame:
    """One row per document: row, id, source, size, source_size, target (its source's), epochs, extra, taken.

    ``weights`` repeat over the sources in code point order; together they get ``share`` of all words, each at most
    ``most`` times its own, with any excess dealt again by weight. ``taken = epochs * size + extra``. ``row_col``: a column of
    written numbers that tell rows apart, where the caller has one.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    text = F.col(text_col).cast("string")
    q = cleanness(text) if quality is None else quality
    q = F.when(q > _LEAST_QUALITY, q).otherwise(_LEAST_QUALITY)
    digest = F.md5(F.concat_ws("-", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(str(seed))).cast("binary"))
    u = (F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") + 0.5) / float(1 << 48)
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"), (-F.log(u) / q).alias("key"), (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"))
    rows = scratch.table(rows, "sizes")  # rows that are alike are told apart by their number

    targets = scratch.table(_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows")), weights, share, most), "targets")
    parts = max(1, -(-(targets.agg(F.sum("rows")).first()[0] or 0) // _RANGE_ROWS))
    order = [F.col("source").asc_nulls_last(), "key", "id", "size", "row"]
    ranged = scratch.table(rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "ranged")
    scratch.keep_only(targets, ranged)
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("source", "part").agg(F.sum("size").alias("s")).select("source", "part", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("part", "source").orderBy("key", "id", "size", "row").rowsBetween(Window.unboundedPreceding, -1)
    ranged = ranged.withColumn("prior", F.coalesce(F.sum("size").over(within), F.lit(0)))
    # one row per source and partition: small against the rows, and joined by both
    small = offsets.join(targets.withColumnRenamed("source", "s2"), F.col("source").eqNullSafe(F.col("s2"))).select(F.col("source").alias("s1"), F.col("part").alias("p1"), "offset", "source_size", "target", "epochs", "rest")
    out = ranged.join(small, (F.col("part") == F.col("p1")) & F.col("source").eqNullSafe(F.col("s1")))
    extra = F.least(F.greatest(F.col("rest") - F.col("offset") - F.col("prior"), F.lit(0)), F.col("size"))
    return out.select("row", "id", "source", "size", "source_size", "target", "epochs", extra.alias("extra"), (F.col("epochs") * F.col("size") + extra).alias("taken"))


def _targets(sources: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Adds target, epochs and rest (words beyond whole epochs) to one row per source.

    The targets are ``min(most * source_size, level * weight)`` at the one level that spends the budget: dealing the
    excess again and again ends there. Sorted by the level at which each source is full, the level is found by prefix sums.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sources.withColumn("w", w).withColumn("full", F.lit(most) * F.col("source_size")).withColumn("full_at", F.col("full") / F.col("w"))
    by_level = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    s = s.withColumn("spent", F.coalesce(F.sum("full").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    s = s.withColumn("left_w", F.sum("w").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("budget", F.lit(share) * F.sum("source_size").over(Window.partitionBy()))
    s = s.withColumn("level", (F.col("budget") - F.col("spent")) / F.col("left_w"))
    s = s.withColumn("level", F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(Window.partitionBy()))
    s = s.withColumn("target", F.coalesce(F.least("full", F.col("level") * F.col("w")), F.col("full")))
    s = s.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    rest = F.greatest(F.round(F.col("target") - F.col("epochs") * F.col("source_size")), F.lit(0.0)).cast("long")
    return s.select("source", "rows", "source_size", "target", "epochs", rest.alias("rest"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` as the mix has them: a row for each time a document is taken; one that is taken in part ends after its last word that is.

    Rows are numbered as they are written once, and meet the plan by that number.
    """
    scratch = Scratch(docs.sparkSession, "mixed")
    number, key, mix, part = (free_name(n, docs.columns) for n in ("mix_number", "mix_row", "mix", "mix_part"))
    numbered = scratch.table(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    plan = plan_mix(numbered, id_col, text_col, row_col=number, **how).where("taken > 0").select(F.col("row").alias(key), F.struct("epochs", "extra", "size").alias(mix))
    joined = numbered.join(plan, F.col(number) == F.col(key))
    x = F.col(mix)
    whole = F.array_repeat(F.lit(-1).cast("long"), x["epochs"].cast("int"))
    rest = F.when(x["extra"] > 0, F.array(F.when(x["extra"] == x["size"], F.lit(-1)).otherwise(x["extra"]).cast("long"))).otherwise(F.array().cast("array<long>"))
    taken = joined.withColumn(part, F.explode(F.concat(whole, rest)))
    words = F.slice(F.regexp_extract_all(F.col(text_col), F.lit(rf"([\x20\x09-\x0D]*{WORD})"), F.lit(1)), 1, F.col(part).cast("int"))
    return taken.withColumn(text_col, F.when(F.col(part) < 0, F.col(text_col)).otherwise(F.array_join(words, ""))).select(docs.columns)
