"""Grouping of spelling variants by neighbourhoods over a reduced alphabet.

Each letter is hashed to one of a few symbols, so that a word becomes a reduced word; words that differ by one edit have
reduced words that differ by one edit at most. The full one-edit neighbourhood of each distinct reduced word (itself,
deletions, replacements; insertions are the other side's deletions) is generated as hashes and joined with the reduced
vocabulary, and the words behind the pairs that meet are verified on their own letters. Hashes can only add pairs to
verify. The alphabet grows with the ninth root of the vocabulary, so that the pairs to verify grow like the vocabulary.

Words are counted within each task before they meet; what follows works on distinct words. A word's form is the near word
that is much more frequent; counts rise along forms, so that they are a forest, whose roots are found by jumps of doubled
length. A word's near words are limited by its letters, not by the table.

Defined cases: null text has no words; a null id counts as the text ``null``; rows that repeat an id (also with equal
text) count each by themselves, with the same deletions; an empty table, and one without repeated long words, give no rows.
Columns other than id and text aren't read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reeltide.llm.graph import forest_roots
from reeltide.llm.scratch import Scratch
from reeltide.llm.wordhash import mix

#: The letters of words, the least length and count of a word, and one of how many runs loses a letter.
LETTERS = "A-Za-zÀ-ÿ"
LEAST_LETTERS, LEAST_COUNT, DELETES = 7, 2, 31
#: How many times as frequent as a word its form is.
MUCH_MORE = 10
#: Distinct words that a task counts before it hands them on; letters whose neighbourhoods are made at once.
COUNTER_WORDS, CHUNK_LETTERS = 200_000, 1 << 16
#: Characters of a text that are searched at once.
PIECE = 1 << 20
_LOWER = {c: c + 32 for c in range(65, 91)}
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
_LETTER = re.compile(f"[{LETTERS}]")


def _pieces(text: str) -> Iterator[str]:
    """A text in pieces of about PIECE characters that don't cut runs of letters."""
    at = 0
    while len(text) - at > PIECE:
        to = at + PIECE
        while to < len(text) and _LETTER.match(text, to):
            to += 1
        yield text[at:to]
        at = to
    yield text[at:]


def _word(run: str, begun: int) -> str:
    """What is left of a lower-cased run; ``begun`` is the checksum of the id and colon before it."""
    h = crc32(run.encode(), begun)
    if h % DELETES:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1 :]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs_of = re.compile(f"[{LETTERS}]{{{LEAST_LETTERS},}}").findall
    total: Counter[str] = Counter()

    def counted() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])
        total.clear()
        return out

    for batch in batches:
        for i, text in zip(batch.column(0), batch.column(1), strict=True):
            begun = crc32(f"{i.as_py()}:".encode())
            for piece in _pieces(text.as_py() or ""):
                folded: Counter[str] = Counter()
                for run, n in Counter(runs_of(piece)).items():
                    folded[run if run.islower() else run.translate(_LOWER)] += n
                for run, n in folded.items():
                    word = _word(run, begun)
                    if len(word) >= LEAST_LETTERS:
                        total[word] += n
            if len(total) > COUNTER_WORDS:
                yield counted()
    if total:
        yield counted()


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the words of all texts with at least LEAST_COUNT occurrences."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("i"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def alphabet(words: int) -> int:
    """Symbols for a vocabulary of that size."""
    return min(26, max(4, int(np.ceil((16 * max(words, 1)) ** (1 / 9)))))


def _symbol(letter: int, symbols: int) -> int:
    return (letter * 2654435761 % (1 << 32) >> 16) % symbols


def _matrices(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, symbols from 1 as a matrix) of reduced words of one length each, about CHUNK_LETTERS at once."""
    texts = words.to_pylist()
    lengths = np.array([len(x) for x in texts])
    for n in np.unique(lengths).tolist():
        places = np.flatnonzero(lengths == n)
        step = max(1, CHUNK_LETTERS // max(n, 1))
        for k in range(0, len(places), step):
            at = places[k : k + step]
            flat = np.frombuffer("".join(texts[i] for i in at.tolist()).encode(), np.uint8).reshape(len(at), n)
            yield at, flat.astype(np.uint64) - np.uint64(96)


def _sums(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base, and the weighted sums before each place of each row and of the whole."""
    powers = np.ones(s.shape[1], np.uint64)
    powers[1:] = _BASE
    np.cumprod(powers, out=powers)
    sums = np.zeros((len(s), s.shape[1] + 1), np.uint64)
    np.cumsum(s * powers, axis=1, out=sums[:, 1:])
    return powers, sums


def _finish(h: np.ndarray, length: int) -> np.ndarray:
    return mix(h + np.uint64(length)).view(np.int64)


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each reduced word itself."""
    for batch in batches:
        own = np.zeros(len(batch), np.int64)
        for at, s in _matrices(batch.column(1)):
            own[at] = _finish(_sums(s)[1][:, -1], s.shape[1])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own)], names=["other", "key"])


def _neighbours(symbols: int):
    """The hashes of each reduced word and of all words one deletion, or one replacement by a later symbol, away."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at, s in _matrices(batch.column(1)):
                n = s.shape[1]
                powers, sums = _sums(s)
                whole = sums[:, -1:]
                rows = np.repeat(ids[at], n).reshape(s.shape)
                first = np.ones(s.shape, bool)  # of a run of one symbol only the first is deleted: the others give the same word
                first[:, 1:] = s[:, 1:] != s[:, :-1]
                shorter = sums[:, :-1] + (whole - sums[:, 1:]) * _BASE_INVERSE
                keys, who = [_finish(whole[:, 0], n), _finish(shorter[first], n - 1)], [ids[at], rows[first]]
                for d in range(1, symbols):
                    fits = s + np.uint64(d) <= np.uint64(symbols)
                    keys.append(_finish((whole + np.uint64(d) * powers)[fits], n))
                    who.append(rows[fits])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(who)), pa.array(np.concatenate(keys))], names=["one", "key"])

    return run


def near_words(words: DataFrame, scratch: Scratch, symbols: int) -> DataFrame:
    """``(word, n)``, a written table -> (word, n, near, near_n) for every two words one edit apart, both ways round."""
    letters = [c for c in range(256) if _LETTER.match(chr(c)) and c not in _LOWER]
    reduced = F.translate("word", "".join(map(chr, letters)), "".join(chr(97 + _symbol(c, symbols)) for c in letters))
    classes = scratch.table(words.select("word", "n", reduced.alias("reduced")).withColumn("rid", F.xxhash64("reduced")), "classes")
    vocabulary = classes.select("rid", "reduced").distinct()
    posts = vocabulary.mapInArrow(_neighbours(symbols), "one long, key long")
    targets = vocabulary.mapInArrow(_own, "other long, key long")
    pairs = scratch.table(posts.join(targets.hint("shuffle_hash"), "key").select("one", "other"), "pairs")
    a = classes.select(F.col("rid").alias("one"), F.col("word").alias("a"), F.col("n").alias("an"))
    b = classes.select(F.col("rid").alias("other"), F.col("word").alias("b"), F.col("n").alias("bn"))
    met = pairs.join(a, "one").join(b, "other").where((F.col("one") != F.col("other")) | (F.col("a") < F.col("b")))
    near = met.where(F.levenshtein("a", "b", 1) == 1).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(F.col("a") < F.col("b"), F.col("an")).otherwise(F.col("bn")).alias("an"), F.when(F.col("a") < F.col("b"), F.col("bn")).otherwise(F.col("an")).alias("bn")).distinct()
    ways = F.array(F.struct(F.col("a").alias("word"), F.col("an").alias("n"), F.col("b").alias("near"), F.col("bn").alias("near_n")), F.struct(F.col("b").alias("word"), F.col("bn").alias("n"), F.col("a").alias("near"), F.col("an").alias("near_n")))
    return near.select(F.inline(ways))


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", symbols: int | None = None) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root."""
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.table(count_words(docs, id_col, text_col), "words")
    near = near_words(words, scratch, symbols or alphabet(words.count()))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("word")))
    known = near.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"), F.first("n").alias("n"))
    chosen = -F.col("best.less") >= MUCH_MORE * F.col("n")
    known = scratch.table(known.select("word", "n_near", F.when(chosen, F.col("best.word")).alias("form"), F.when(chosen, -F.col("best.less")).alias("form_n")), "known")
    roots = forest_roots(known.where("form is not null").select(F.col("word").alias("node"), F.col("form").alias("up")), scratch)
    out = words.join(known, "word", "left").join(roots.withColumnRenamed("node", "word"), "word", "left")
    out = scratch.table(out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root")), "variants")
    scratch.keep_only(out)
    return out
