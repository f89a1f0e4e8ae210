"""Phrase collocation mining by HAT-trie counting.

Each task counts phrases in a shallow trie of word ids: a first word leads to a hash container of what follows it, and a
container that grows too large bursts into one per second word. When a trie is full its largest subtrees are spilled as
sorted runs, spelled in words as ids are a task's own, one run per prefix partition; runs of a partition are merged, whose
counts are then whole.

Words and pairs are counted first. A longer phrase occurs often only if all its pairs do, so that the second pass counts, of
the windows of four words that begin at each word, what lies before the first rare pair; counts of three words are sums over
windows. Frequent pairs are known to tasks by a bitmap of fixed size (FILTER_BITS), which may take a rare pair for a frequent one
but not the reverse: it saves work and decides nothing. Once it is full, the second pass counts more and the result is the same.

A window's partition is that of its first three words, a pair's that of both, so that a frequent word or pair is spread over all. There are as many
partitions as the bytes of all texts ask for, and a run holds each phrase once however often it occurs, so that a partition's size is
bounded. What is left after that are phrases that occur often enough, which the rest of the work (cuts, containment, ranks)
joins and groups as plain rows.

Defined cases: null and empty texts have no words; a null lang is ``und``, together with rows that say so; rows that
repeat an id or text count each; long texts are cut at white space and keep their phrases; an empty table gives no rows.
Columns other than text and lang aren't read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reeltide.llm.scratch import Scratch, lookup
from reeltide.llm.wordhash import mix

#: Words of the longest phrase.
LONGEST = 4
#: Entries of a trie at most and what a spill leaves of them, entries of a container that bursts, words that a task numbers.
TRIE_ENTRIES, LEFT_ENTRIES, BURST_ENTRIES, TRIE_WORDS = 800_000, 100_000, 2_048, 600_000
#: Bytes of text per prefix partition; characters of a piece that are split, and words that are counted, at once.
PART_BYTES, BLOCK, BLOCK_WORDS = 6 << 20, 1 << 20, 1 << 16
#: Bits of the bitmap of frequent pairs.
FILTER_BITS = 1 << 25
#: Tasks that choose a language's best rows before they meet.
RANK_TASKS = 32
#: Bytes of a text as they are split: A-Z folded, all ends of pieces as line feeds, tabs as spaces.
_BYTES = bytes(range(256)).translate(bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\x0b\x0c\r\t", bytes(range(97, 123)) + b"\n" * 9 + b" "))
_ID = (1 << 32) - 1


class _Ids(dict):
    """Words and their numbers from 1; ``new`` are those that weren't hashed yet."""

    def __init__(self) -> None:
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        self[word] = n = len(self) + 1
        return n


class _Burst(dict):
    """A node whose container burst: second words and the containers of what follows them."""


class Trie:
    """Phrases of one language: first words, and containers (or nodes of them) of what follows."""

    def __init__(self) -> None:
        self.root: dict[int, dict] = {}
        self.entries = 0
        self.waiting: tuple[list[int], list[int]] = [], []

    def add_pairs(self, words: list[int], n: int) -> None:
        """The first ``n`` of ``words``, each with the word after it; zeros lie between pieces."""
        first, second = self.waiting
        first += words[:n]
        second += words[1 : n + 1]
        if len(first) > BLOCK_WORDS:
            self.settle()

    def settle(self) -> None:
        """Count the pairs that wait, those of one first word together."""
        first, second = np.array(self.waiting, np.int64)
        self.waiting = [], []
        first, second = first[first > 0], second[first > 0]
        if not len(first):
            return
        order = np.argsort(first, kind="stable")
        first, second = first[order], second[order].tolist()
        cuts = np.flatnonzero(np.diff(first, prepend=-1))
        root, new = self.root, 0
        for a, at, to in zip(first[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(second)], strict=True):
            node = root.get(a)
            if node is None:
                node = root[a] = {}
            had = len(node)
            for b in second[at:to]:
                node[b] = node.get(b, 0) + 1
            new += len(node) - had
        self.entries += new

    def add_windows(self, windows: list[tuple[int, int, int, int]]) -> None:
        """Windows of three or four words; the last is zero where there are three."""
        root, new = self.root, 0
        for a, b, c, d in windows:
            node = root.get(a)
            if node is None:
                node = root[a] = {}
            if node.__class__ is _Burst:
                below = node.get(b)
                if below is None:
                    below = node[b] = {}
                node, key = below, c << 32 | d
            else:
                key = b << 64 | c << 32 | d
            had = node.get(key)
            if had is None:
                node[key] = 1
                new += 1
                if len(node) > BURST_ENTRIES and root[a] is node:
                    root[a] = self._burst(node)
            else:
                node[key] = had + 1
        self.entries += new

    @staticmethod
    def _burst(container: dict) -> _Burst:
        node = _Burst()
        for key, n in container.items():
            b = key >> 64
            if b not in node:
                node[b] = {}
            node[b][key & (_ID << 32 | _ID)] = n
        return node

    @staticmethod
    def _size(node: dict) -> int:
        return sum(map(len, node.values())) if node.__class__ is _Burst else len(node)

    def spill(self, most_left: int, spelled: list[bytes], codes: list[int], parts: int, pairs: bool) -> Iterator[tuple[int, bytes]]:
        """(partition, sorted run) of the largest subtrees, until ``most_left`` entries are left.

        A line of a run is a phrase, each word ended by a line feed, then a tab and its count. ``codes``: hashes of the words.
        """
        if self.waiting[0]:
            self.settle()
        nodes: list[tuple[int, dict]] = []
        for size, a in sorted(((self._size(x), a) for a, x in self.root.items()), reverse=True):
            if self.entries <= most_left:
                break
            self.entries -= size
            nodes.append((a, self.root.pop(a)))
        codes_of, phrases = np.array(codes, np.int64), self._pairs(nodes) if pairs else self._windows(nodes)
        *ids, counts = phrases
        if not len(counts):
            return
        part = np.zeros(len(counts), np.int64)
        for words in ids[:3]:
            part = (part * 31 + codes_of[words]) % parts
        order = np.argsort(part, kind="stable")
        columns = [x[order].tolist() for x in (*ids, counts)]
        once = b"\t1"
        if pairs:
            lines = [spelled[a] + spelled[b] + (once if n == 1 else b"\t%d" % n) for a, b, n in zip(*columns, strict=True)]
        else:
            lines = [b"%b%b%b%b\t%d" % (spelled[a], spelled[b], spelled[c], spelled[d], n) for a, b, c, d, n in zip(*columns, strict=True)]
        pack = zstandard.ZstdCompressor(level=3).compress
        part = part[order]
        cuts = np.flatnonzero(np.diff(part, prepend=-1))
        for p, at, to in zip(part[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(lines)], strict=True):
            yield p, pack(b"\r".join(sorted(lines[at:to])))

    @staticmethod
    def _pairs(nodes: list[tuple[int, dict]]) -> tuple[np.ndarray, ...]:
        """(first words, second words, counts) of spilled containers; a word by itself has no second."""
        second: list[int] = []
        counts: list[int] = []
        for _, node in nodes:
            whole = sum(node.values())
            node.pop(0, None)  # at the end of a piece
            second.append(0)
            second += node
            counts.append(whole)
            counts += node.values()
        return np.repeat(np.array([a for a, _ in nodes], np.int64), [len(x) + 1 for _, x in nodes]), np.array(second, np.int64), np.array(counts, np.int64)

    @staticmethod
    def _windows(nodes: list[tuple[int, dict]]) -> tuple[np.ndarray, ...]:
        """(the four words, counts) of spilled containers and nodes."""
        flat = [(a, key >> 64, key >> 32 & _ID, key & _ID, n) for a, node in nodes for key, n in (((b << 64 | k, n) for b, x in node.items() for k, n in x.items()) if node.__class__ is _Burst else node.items())]
        return tuple(np.array(flat, np.int64).reshape(-1, 5).T)


def _blocks(piece: bytes) -> Iterator[bytes]:
    """A piece in blocks of about BLOCK bytes that end at a space."""
    at = 0
    while len(piece) - at > BLOCK:
        to = piece.find(b" ", at + BLOCK)
        if to < 0:
            break
        yield piece[at:to]
        at = to
    yield piece[at:]


def _words(ids: _Ids, text: bytes) -> Iterator[tuple[list[int], int]]:
    """The words of a text as numbers, zeros after each piece, with how many of them begin a phrase; three more follow those."""
    buffer: list[int] = []
    for piece in text.translate(_BYTES).split(b"\n"):
        if piece:
            for block in _blocks(piece):
                buffer += [ids[w] for w in block.split(b" ") if w]
                if len(buffer) > BLOCK_WORDS:
                    yield buffer, len(buffer) - 3
                    buffer = buffer[-3:]
            buffer.append(0)
    yield [*buffer, 0, 0, 0], len(buffer)


_hash = xxhash.xxh3_64_intdigest


def _bits(lang: int, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each pair of words, by the hashes of the language and of both."""
    h = mix(mix(first + np.uint64(lang)) + second)
    return (h & np.uint64(FILTER_BITS - 1)).astype(np.int64), (h >> np.uint64(32) & np.uint64(FILTER_BITS - 1)).astype(np.int64)


class _Filter:
    """Frequent pairs among a task's numbered words."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.hashes, self.known = np.zeros(1 << 12, np.uint64), 1

    def windows(self, ids: _Ids, lang: int, words: list[int], n: int) -> list[tuple[int, int, int, int]]:
        """The windows that begin at the first ``n`` words, up to their first rare pair, where they have three words."""
        if ids.new:
            to = self.known + len(ids.new)
            if to > len(self.hashes):
                self.hashes = np.concatenate([self.hashes, np.zeros(to, np.uint64)])
            self.hashes[self.known : to] = [_hash(x) for x in ids.new]
            self.known = to
            ids.new.clear()
        w = np.array(words, np.int64)
        one, two = _bits(lang, self.hashes[w[:-1]], self.hashes[w[1:]])
        frequent = (self.bits[one >> 3] >> (one & 7).astype(np.uint8) & self.bits[two >> 3] >> (two & 7).astype(np.uint8) & 1).astype(bool) & (w[:-1] > 0) & (w[1:] > 0)
        at = np.flatnonzero(frequent[:n] & frequent[1 : n + 1])
        return list(zip(w[at].tolist(), w[at + 1].tolist(), w[at + 2].tolist(), np.where(frequent[at + 2], w[at + 3], 0).tolist(), strict=True)) if len(at) else []


def _count(parts: int, bits: bytes | None = None):
    """Counts words and pairs or, with the bitmap of frequent pairs, longer phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, tries = _Ids(), defaultdict(Trie)
        known = None if bits is None else _Filter(np.frombuffer(bits, np.uint8))

        def spilled(left: int) -> Iterator[pa.RecordBatch]:
            spelled, codes = [b"", *(w + b"\n" for w in ids)], [0, *map(crc32, ids)]
            for lang, trie in tries.items():
                found = list(trie.spill(left // len(tries), spelled, codes, parts, known is None))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array([p for p, _ in found], pa.int32()), pa.array([r for _, r in found], pa.binary())], names=["lang", "part", "run"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                trie = tries[lang]
                for words, n in _words(ids, text.as_py() or b""):
                    if known is None:
                        trie.add_pairs(words, n)
                    else:
                        trie.add_windows(known.windows(ids, _hash(lang.encode()), words, n))
                    if trie.entries > 2 * TRIE_ENTRIES:
                        yield from spilled(LEFT_ENTRIES)
                if len(ids) > TRIE_WORDS:
                    yield from spilled(0)
                    ids.clear()
                    ids.new.clear()
                    tries.clear()
                    known = known and _Filter(known.bits)
                elif sum(t.entries for t in tries.values()) > TRIE_ENTRIES:
                    yield from spilled(LEFT_ENTRIES)
        yield from spilled(0)

    return run


def _set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bits of pairs, as 64 bits with their place."""
    for batch in batches:
        pairs = [(lang, *phrase.split(" ")) for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
        langs, first, second = (np.array([_hash(p[k].encode()) for p in pairs], np.uint64) for k in range(3))
        one, two = _bits(0, first + langs, second)
        at = np.concatenate([one, two])
        yield pa.RecordBatch.from_arrays([pa.array((at >> 6).astype(np.int32)), pa.array((np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64))], names=["place", "bits"])


def _merge(least: int):
    """The whole counts of a partition's phrases out of its runs, and (with no phrase) the sum of its single words."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor().decompress
        lines: list[bytes] = []
        for r in table.column("run"):
            lines += unpack(r.as_py()).split(b"\r")
        lines.sort()  # merges the sorted runs it finds
        found: list[tuple[str | None, int, int]] = []
        singles, three, sum_three = 0, b"", 0

        def keep(phrase: bytes, n: int) -> None:
            if n >= least:
                words = phrase[:-1].decode().split("\n")
                found.append((" ".join(words), len(words), n))

        def close(phrase: bytes, n: int) -> None:
            nonlocal singles, three, sum_three
            k = phrase.count(b"\n")
            if k < 3:
                singles += n if k == 1 else 0
                keep(phrase, n)
                return
            prefix = phrase if k == 3 else phrase[: phrase.rindex(b"\n", 0, -1) + 1]
            if prefix != three:
                if three:
                    keep(three, sum_three)
                three, sum_three = prefix, 0
            sum_three += n
            if k == LONGEST and n >= least:
                keep(phrase, n)

        phrase, total = b"", 0
        for line in lines:
            now, _, n = line.rpartition(b"\t")
            if now != phrase:
                if phrase:
                    close(phrase, total)
                phrase, total = now, 0
            total += int(n)
        if phrase:
            close(phrase, total)
        if three:
            keep(three, sum_three)
        found.append((None, 0, singles))
        columns = list(zip(*found, strict=True))
        lang = pa.array([key[0].as_py()] * len(found), pa.string())
        return pa.Table.from_arrays([lang, pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64())], names=["lang", "phrase", "words", "f"])

    return run


def count_phrases(docs: DataFrame, scratch: Scratch, least: int, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, phrase, words, f) of phrases of one to four words with f >= ``least``; rows without a phrase have parts of the sum of all words."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text.alias("text"))
    parts = max(1, -(-(rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0) // PART_BYTES))
    counted = lambda how: scratch.table(rows.mapInArrow(how, "lang string, part int, run binary"), "runs")
    merged = lambda runs: scratch.table(runs.groupBy("lang", "part").applyInArrow(_merge(least), "lang string, phrase string, words int, f long"), "grams")
    runs = counted(_count(parts))
    short = merged(runs)
    scratch.release(runs)
    bitmap = np.zeros(FILTER_BITS // 64, np.int64)
    for r in short.where("words = 2").select("lang", "phrase").mapInArrow(_set_bits, "place int, bits long").groupBy("place").agg(F.bit_or("bits").alias("bits")).toLocalIterator():  # FILTER_BITS / 64 rows at most
        bitmap[r.place] = r.bits
    runs = counted(_count(parts, bitmap.tobytes()))
    long = merged(runs)
    scratch.release(runs)
    return short.unionByName(long)


def _wide(c: str) -> Column:
    """A count whose products don't pass what it can hold."""
    return F.col(c).cast("decimal(20,0)")


def collocations(docs: DataFrame, least: int = 30, most: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase of two to four words that occurs ``least`` times scores as its worst cut in two does. It is left out where 80 % of its
    occurrences lie in one longer such phrase.
    """
    scratch = Scratch(docs.sparkSession, "collocations")
    grams = count_phrases(docs, scratch, least, text_col, lang_col)
    known = grams.where("phrase is not null")
    w = F.split("phrase", " ")
    candidates = known.where("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"), w.alias("w"))
    joined = lambda at, n: F.array_join(F.slice("w", at, n), " ")
    name = lambda phrase: F.concat("lang", F.lit("\n"), phrase)  # noqa: E731  a phrase has no line feed

    sides = F.flatten(F.transform(F.sequence(F.lit(1), F.col("words") - 1), lambda k: F.array(F.struct(k.alias("cut"), F.lit("l").alias("side"), joined(1, k).alias("part")), F.struct(k.alias("cut"), F.lit("r").alias("side"), joined(k + 1, F.col("words") - k).alias("part")))))
    cuts = candidates.select("lang", "phrase", "a", F.explode(sides).alias("x")).select("lang", "phrase", "a", "x.cut", "x.side", name(F.col("x.part")).alias("part"))
    cuts = scratch.table(cuts, "cuts")
    asked = cuts.groupBy("part").agg(F.count("*").alias("n"))
    counts = scratch.table(known.select(name(F.col("phrase")).alias("part"), "f").join(asked, "part"), "counts")
    found = lookup(cuts, counts, "part", ["phrase", "cut", "side"], "inner")
    side = lambda k, s: F.max(F.when((F.col("cut") == k) & (F.col("side") == s), F.col("f"))).alias(f"{s}{k}")
    cut = found.groupBy("lang", "phrase", "a").agg(*[side(k, s) for k in range(1, LONGEST) for s in "lr"])
    score = lambda k: F.call_function("div", F.lit(2_000_000).cast("decimal(10,0)") * _wide("a"), _wide(f"l{k}") + _wide(f"r{k}"))
    worst = F.array_min(F.filter(F.array(*[F.when(F.col(f"l{k}").isNotNull(), F.struct(score(k).alias("score"), F.lit(k).alias("cut"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k in range(1, LONGEST)]), lambda x: x.isNotNull()))
    scored = cut.select("lang", "phrase", "a", worst.alias("x")).select("lang", "phrase", "a", "x.l", "x.r", "x.score")

    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("words") - n + 1), lambda at: joined(at, n))))
    within = candidates.where("words >= 3").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(within, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (_wide("longer") * 100 < _wide("a") * 80)).drop("longer")

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    task = F.pmod(F.xxhash64("phrase"), F.lit(RANK_TASKS))
    best = kept.withColumn("task", task).withColumn("r1", F.row_number().over(Window.partitionBy("lang", "task").orderBy(*order))).where(F.col("r1") <= most)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= most)
    words = grams.where("phrase is null").groupBy("lang").agg(F.sum("f").alias("n"))
    out = scratch.table(best.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"), "ranked")
    scratch.keep_only(out)
    return out
