"""Substring deduplication over sliding runs of sentences.

Spans are all runs of ``sentences`` consecutive sentences with ``least_words`` words or more. Of equal spans that with the
smallest (id, hash of its text, position) is the first, and every sentence that the others cover is removed. As the ends of a
passage needn't fall on sentences, stretches of ``many_words`` words are spans too, wherever they hold two sentences that repeat.

Every pair of consecutive sentences with enough words for a span to hold one is hashed first, and pairs meet globally by hash. A
pair that only exact copies of one text share says no more than that the text repeats; around the occurrences of any other
repeated pair the spans are hashed and meet globally in turn. No span that repeats is without such a pair. Of
exact copies all but that with the smallest id lose what their spans cover, without meeting anyone.

A sentence ends after a word that ends in ``.``, ``!`` or ``?``, and at a line's end. One of more than LONG words, as in
text without punctuation, ends also after each word whose hash is the least among its NEAR neighbours on either side,
so that all copies are cut alike, and at the latest after MOST words. Words compare with A-Z folded; white space between them
doesn't matter.

Defined cases: null text stays null and empty text empty; documents shorter than a span are left alone; rows
that share id and text are one document and are treated alike; rows that share only the id, be it null, are
documents of their own; a null id orders before all others; a document that only repeats others keeps its row, with what
is left of its text. Other columns pass through, whatever they are called.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reeltide.llm import wordhash as W
from reeltide.llm.scratch import Scratch, free_name, lookup

#: Words of a sentence that ends only where it says so, reach of the comparison that ends a longer one, and words of any.
LONG, NEAR, MOST = 16, 3, 20

#: Sentences of the runs that lead to spans.
PAIR = 2

_STOPS = np.zeros(256, bool)
_STOPS[[0x21, 0x2E, 0x3F]] = True


class Words:
    """The words of some texts: where they lie, their row, their hashes, and the first word of each sentence."""

    def __init__(self, text: pa.Array):
        self.data, self.rows = W.text_bytes(text)
        folded = W._FOLD[self.data]
        self.start, self.end, self.row = W.word_spans(folded, self.rows)
        self.hash = W.span_hashes(folded, self.start, self.end)
        #: Number of the first word of each row, and of all words at the end.
        self.begin = np.searchsorted(self.row, np.arange(len(self.rows)))
        self.first = self._sentences()

    def _sentences(self) -> np.ndarray:
        n = len(self.start)
        if not n:
            return np.zeros(0, np.int64)
        lines = np.cumsum(self.data == 0x0A)
        stop = _STOPS[self.data[self.end - 1]]
        stop[:-1] |= (lines[self.start[1:]] > lines[self.end[:-1] - 1]) | (self.row[1:] != self.row[:-1])
        first = np.flatnonzero(np.concatenate([[True], stop[:-1]]))
        size = np.diff(np.append(first, n))
        ends = np.repeat(size > LONG, size)
        within = np.repeat(np.arange(len(first)), size)
        rank = W.mix(self.hash)
        for k in range(1, NEAR + 1):
            apart = within[k:] != within[:-k]
            ends[k:] &= (rank[k:] < rank[:-k]) | apart
            ends[:-k] &= (rank[:-k] < rank[k:]) | apart
        cuts = np.flatnonzero(ends) + 1
        first = np.union1d(first, cuts[cuts < n])
        size = np.diff(np.append(first, n))
        more = -(-size // MOST) - 1
        steps = np.arange(int(more.sum())) - np.repeat(np.cumsum(more) - more, more) + 1
        return np.union1d(first, np.repeat(first, more) + steps * MOST)

    def runs(self, sentences: int, least_words: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and end of every run of that many sentences of one row with that many words."""
        bounds = np.append(self.first, len(self.start))
        a, b = bounds[: max(0, len(bounds) - sentences)], bounds[sentences:]
        fit = b - a >= least_words
        fit[fit] = self.row[a[fit]] == self.row[b[fit] - 1]
        return a[fit], b[fit]

    def runs_around(self, a: np.ndarray, sentences: int, least_words: int) -> tuple[np.ndarray, np.ndarray]:
        """Of those runs, the ones that hold one of the pairs of sentences that begin at the words ``a``."""
        some, ends = self.runs(sentences, least_words)
        pairs = np.zeros(len(self.first) + 1, np.int64)
        pairs[np.searchsorted(self.first, a) + 1] = 1
        pairs = np.cumsum(pairs)
        at = np.searchsorted(self.first, some)
        held = pairs[at + sentences - PAIR + 1] > pairs[at]
        return some[held], ends[held]

    def stretches(self, a: np.ndarray, b: np.ndarray, words: int) -> np.ndarray:
        """First words of all stretches of that many words of one row that hold one of the ranges a to b."""
        row = self.row[a]
        low = np.maximum(self.begin[row], b - words)
        high = np.minimum(a, self.begin[row + 1] - words)
        some = low <= high
        marks = np.zeros(len(self.start) + 1, np.int64)
        np.add.at(marks, low[some], 1)
        np.add.at(marks, high[some] + 1, -1)
        return np.flatnonzero(np.cumsum(marks)[:-1] > 0)


def _hash_pairs(least_words: int):
    def run(batches):
        for batch in batches:
            text = W.as_strings(batch.column(1))
            for x, y in W.chunks(text):
                words = Words(text[x:y])
                a, b = words.runs(PAIR, least_words)
                h, row, own = W.sequence_hashes(words.hash, a, b), words.row[a], words.begin[words.row[a]]
                order = np.lexsort((row, h))
                again = np.zeros(len(h), bool)
                same = (h[order][1:] == h[order][:-1]) & (row[order][1:] == row[order][:-1])
                again[order[1:]] |= same
                again[order[:-1]] |= same
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), *(batch.column(i)[x:y].take(pa.array(row)) for i in (0, 2)), pa.array((a - own).astype(np.int32)), pa.array((b - own).astype(np.int32)), pa.array(again)],
                    ["hash", "id", "of", "a", "b", "again"],
                )

    return run


def _ranges(words: Words, lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The (a, b) of each row's list, counted over all rows."""
    flat = lists.flatten()
    own = words.begin[np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())]
    return flat.field("a").to_numpy() + own, flat.field("b").to_numpy() + own


def _spans(words: Words, a: np.ndarray, b: np.ndarray, sentences: int, least_words: int, many_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First words and ends of all spans that hold one of the pairs of sentences a to b, each once."""
    at = words.stretches(a, b, many_words)
    runs, ends = words.runs_around(a, sentences, least_words)
    new = ends - runs != many_words  # a run of that many words is one of the stretches
    return np.concatenate([at, runs[new]]), np.concatenate([at + many_words, ends[new]])


def _hash_spans(*kinds: int):
    def run(batches):
        for batch in batches:
            text = W.as_strings(batch.column(1))
            for x, y in W.chunks(text):
                words = Words(text[x:y])
                a, b = _spans(words, *_ranges(words, batch.column(3)[x:y]), *kinds)
                row = words.row[a]
                own = words.begin[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(W.sequence_hashes(words.hash, a, b).view(np.int64)), *(batch.column(i)[x:y].take(pa.array(row)) for i in (0, 2)), pa.array((a - own).astype(np.int32)), pa.array((b - own).astype(np.int32))],
                    ["hash", "id", "of", "a", "b"],
                )

    return run


def _cut(text_at: int, columns: int, pair_words: int, *kinds: int):
    """Drop the sentences that the listed spans cover, in copies all spans; adds how many sentences and words went."""

    def run(batches):
        for batch in batches:
            held, (copy, spans) = list(batch.columns[:columns]), batch.columns[columns:]
            old = held[text_at]
            sentences_gone, words_gone = np.zeros(len(old), np.int64), np.zeros(len(old), np.int64)
            touched = pc.or_(pc.fill_null(copy, False), pc.is_valid(spans))
            rows = np.flatnonzero(touched.to_numpy(zero_copy_only=False))
            new: list[str] = []
            text = W.as_strings(old.take(pa.array(rows)))
            for x, y in W.chunks(text):
                some = rows[x:y]
                words = Words(text[x:y])
                is_copy = pc.fill_null(copy.take(pa.array(some)), False).to_numpy(zero_copy_only=False)
                a, b = words.runs(PAIR, pair_words)
                mine = is_copy[words.row[a]]
                listed = zip(_spans(words, a[mine], b[mine], *kinds), _ranges(words, spans.take(pa.array(some))), strict=True)
                a, b = (np.concatenate(x) for x in listed)
                marks = np.zeros(len(words.start) + 1, np.int64)
                np.add.at(marks, a, 1)
                np.add.at(marks, b, -1)
                covered = np.concatenate([[0], np.cumsum(np.cumsum(marks)[:-1] > 0)])
                bounds = np.append(words.first, len(words.start))
                gone = covered[bounds[1:]] - covered[bounds[:-1]] == np.diff(bounds)
                where = words.row[words.first]
                sentences_gone[some] = np.bincount(where[gone], minlength=len(some))
                words_gone[some] = np.bincount(where[gone], np.diff(bounds)[gone], len(some))
                # a sentence reaches from its first word to the next one's; a row's first also holds what stands before it
                edges = np.append(words.start[words.first], len(words.data))
                lead = np.searchsorted(where, np.arange(len(some)))
                for r in range(len(some)):
                    i, j = int(lead[r]), int(np.searchsorted(where, r, "right"))
                    cuts = np.append(edges[i:j], words.rows[r + 1])
                    cuts[0] = words.rows[r]
                    new.append(b"".join(words.data[cuts[k] : cuts[k + 1]].tobytes() for k in np.flatnonzero(~gone[i:j])).decode() if j > i else words.data[words.rows[r] : words.rows[r + 1]].tobytes().decode())
            if len(rows):
                held[text_at] = pc.replace_with_mask(old, touched, pa.array(new, old.type))
            yield pa.RecordBatch.from_arrays([*held, pa.array(sentences_gone), pa.array(words_gone)], [f"c{i}" for i in range(columns + 2)])

    return run


def remove_repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sentences: int = 3, least_words: int = 20, many_words: int = 50) -> DataFrame:
    """``docs`` with the text cut, and ``sentences_removed`` and ``words_removed`` added."""
    if sentences < PAIR or least_words > many_words:
        raise ValueError("spans are runs of two sentences at least, and no longer at least than a stretch")
    scratch = Scratch(docs.sparkSession, "span-dedup")
    kinds = (sentences, least_words, many_words)
    pair_words = least_words // ((sentences + 1) // PAIR)  # pairs side by side make the span, so that one of them has so many words
    id_, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    of = F.xxhash64(text)
    source = docs.select(id_.alias("id"), text.alias("text"), of.alias("of"))  # a document is an id and a text
    pairs = scratch.table(source.mapInArrow(_hash_pairs(pair_words), "hash long, id long, of long, a int, b int, again boolean"), "pairs")
    shared = pairs.groupBy("hash").agg(F.min("of").alias("lo"), F.max("of").alias("hi"), F.max("again").alias("again"), F.count("*").alias("n")).where("lo <> hi or again").select("hash", "n")
    hits = lookup(pairs, scratch.table(shared, "shared"), "hash", ["id", "of", "a"], "left_semi")
    marks = scratch.table(hits.groupBy("id", "of").agg(F.collect_set(F.struct("a", "b")).alias("pairs")), "marks")

    # of equal texts the one with the smallest id stands for all
    texts = docs.select(id_.alias("id"), of.alias("of"))
    least = texts.groupBy("of").agg(F.min(F.struct("id")).alias("least"), F.max(F.struct("id")).alias("most"), F.count("*").alias("n")).where("least <> most").select("of", "least", "n")
    copies = lookup(texts, scratch.table(least, "least"), "of", ["id"], "inner").where(F.struct("id") != F.col("least")).select("id", "of").distinct()
    copies = scratch.table(copies.withColumn("copy", F.lit(True)), "copies")
    scratch.release(pairs)

    def same_text(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
        b = b.withColumnsRenamed({"id": "_id", "of": "_of"})
        return a.join(b, F.col("id").eqNullSafe(F.col("_id")) & (F.col("of") == F.col("_of")), how).drop("_id", "_of")

    asked = same_text(source, same_text(marks, copies.drop("copy"), "left_anti"), "inner").select("id", "text", "of", "pairs")
    spans = scratch.table(asked.mapInArrow(_hash_spans(*kinds), "hash long, id long, of long, a int, b int"), "spans")
    firsts = spans.groupBy("hash").agg(F.count("*").alias("n"), F.min(F.struct("id", "of", "a")).alias("first")).where("n > 1").select("hash", "first", "n")
    later = lookup(spans, scratch.table(firsts, "firsts"), "hash", ["id", "of", "a"], "inner").where(~F.struct("id", "of", "a").eqNullSafe(F.col("first")))
    cuts = later.groupBy("id", "of").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    verdicts = scratch.table(copies.withColumn("spans", F.lit(None).cast(cuts.schema["spans"].dataType)).unionByName(cuts.withColumn("copy", F.lit(False))), "verdicts")
    scratch.keep_only(verdicts)

    names = [free_name(n, docs.columns) for n in ("span_id", "span_of", "span_copy", "span_lists")]
    verdicts = verdicts.select(*(F.col(c).alias(n) for c, n in zip(("id", "of", "copy", "spans"), names, strict=True)))
    joined = docs.join(verdicts, id_.eqNullSafe(F.col(names[0])) & (of == F.col(names[1])), "left").select(*(docs[c] for c in docs.columns), *names[2:])
    fields = [*docs.schema.fields, T.StructField("sentences_removed", T.LongType()), T.StructField("words_removed", T.LongType())]
    at = [c.lower() for c in docs.columns].index(text_col.lower())
    numbered = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(fields)])
    return joined.mapInArrow(_cut(at, len(docs.columns), pair_words, *kinds), numbered).toDF(*(f.name for f in fields))
