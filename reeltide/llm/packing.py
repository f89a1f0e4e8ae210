"""Sequence packing along a space-filling curve.

Each document's tokens are hashed to a vector of fixed width, projected to few dimensions and placed on a
Hilbert curve. Documents are range-partitioned by their place on the curve and laid end to end in that order,
so that a sequence holds neighbouring documents; sequences are cut from the whole line every ``length`` tokens,
and what is left at its end is cut to powers of two. Nothing is padded.

Tokens are made once and kept packed in a written table; ranges and their token totals come from its narrow
columns. Equal documents share a place and are told apart by a hash of their id, so that no range grows with a
group of copies.

Defined cases: null text is empty and has the end token only; every row is packed, also repeated ones; other
columns are ignored.
"""

from __future__ import annotations

import gc
import json
import re
import unicodedata
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reeltide.llm import wordhash as W
from reeltide.llm.scratch import Scratch

#: Tokens of one range of the curve.
RANGE_TOKENS = 4_000_000
#: Width of the hashed document vectors, dimensions of the curve, and bits of each.
WIDTH, DIMENSIONS, BITS = 256, 4, 15

#: For texts of these characters, composing changes nothing, folding goes letter by letter and white space is ASCII's.
_PLAIN = re.compile("[\t\n\r\x20-\x7e¡-įı-ɏ]*")
# The word pattern of word-level tokenizer files, and what else such a file says of texts and words. Texts are cut into pieces in bulk for these only.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMAL = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = {"type": "Split", "pattern": {"Regex": _PATTERN}, "behavior": "Removed", "invert": True}
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
#: Pieces that a worker remembers and bytes of them, and bytes of text tokenised at once.
_REMEMBERED, _REMEMBERED_BYTES, _CHUNK_BYTES = 1_000_000, 64 << 20, 3 << 20


def _byte_letters() -> str:
    """The letter that byte-level files write for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return "".join(chr(b if b in shown else next(others)) for b in range(256))


_LETTERS = _byte_letters()
#: What a character of up to two bytes is: white space, a letter, a number (a piece by itself), or anything else.
_BLANK, _LETTER, _NUMBER, _OTHER = range(4)
_KINDS = np.array([_BLANK if chr(c).isspace() else {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x800)], np.uint8)
_OF_BYTE = np.concatenate([_KINDS[:0x80], np.full(0x80, _LETTER, np.uint8)])  # lower case of three bytes is letters only


def piece_starts(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of ``_PATTERN`` begin in lower-cased plain texts, and which bytes are no white space."""
    kind = _OF_BYTE[data]
    two = np.flatnonzero((data >= 0xC0) & (data < 0xE0))
    kind[two] = kind[two + 1] = _KINDS[(data[two] & 0x1F).astype(np.int64) << 6 | data[two + 1] & 0x3F]
    opens = np.zeros(len(data) + 1, bool)
    opens[rows] = True
    first = opens[:-1].copy()
    first[1:] |= kind[1:] != kind[:-1]
    first |= (kind == _NUMBER) & ((data & 0xC0) != 0x80)
    ink = kind != _BLANK
    first &= ink
    # 's and the like begin with an apostrophe by itself that a letter follows
    mark = np.flatnonzero((data[:-1] == 0x27) & first[:-1] & (kind[1:] == _LETTER) & ~opens[1:-1])
    if len(mark):
        a = data[mark + 1]
        within = (mark + 2 < len(data)) & ~opens[mark + 2]
        b = np.where(within, data[np.minimum(mark + 2, len(data) - 1)], 0)
        n = np.where(np.isin(a, list(b"stmd")), 1, np.where(((a == 0x72) | (a == 0x76)) & (b == 0x65) | (a == 0x6C) & (b == 0x6C), 2, 0))
        mark, n = mark[n > 0], n[n > 0]
        first[mark + 1] = False
        after = mark + 1 + n
        after = after[after < len(data)]
        first[after] = ink[after]
    return np.flatnonzero(first), ink


#: What is remembered of a piece: where its bytes and its ids begin, how many these are, and the chunk of texts that had it last.
_PIECE = np.dtype([("text", "i8"), ("length", "i4"), ("ids", "i8"), ("size", "i4"), ("used", "i4")])


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places in ranges of ``n`` from ``start`` on, range after range."""
    end = np.cumsum(n)
    return np.repeat(start - (end - n), n) + np.arange(end[-1] if len(end) else 0)


class WordTokenizer:
    """The ids of a tokenizer file.

    In a word-level BPE file of known settings no token spans two pieces of a text, so plain texts are cut into pieces in bulk, and each
    piece goes through the file's model once and is remembered. Of any other file every text is encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            text = f.read()
        self.whole = Tokenizer.from_str(text)
        self.model = self.whole.model
        said = json.loads(text)
        self.by_words = said["normalizer"] == _NORMAL and said["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": [_SPLIT, _BYTES]} and said["model"]["type"] == "BPE" and not said["model"].get("dropout") and not said["truncation"] and all(not a["normalized"] and "<|" in a["content"] for a in said["added_tokens"])
        self.kind = np.dtype("<u2") if self.whole.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        # pieces by ascending hash, their bytes, and their ids
        self.keys, self.pieces = np.zeros(0, np.uint64), np.zeros(0, _PIECE)
        self.text, self.ids, self.chunk = np.zeros(0, np.uint8), np.zeros(0, self.kind), 0

    def _forget(self, keep: np.ndarray) -> None:
        """Of the remembered pieces only these stay."""
        self.keys, p = self.keys[keep], self.pieces[keep]
        self.text, self.ids = self.text[_ranges(p["text"], p["length"])], self.ids[_ranges(p["ids"], p["size"])]
        p["text"], p["ids"] = np.cumsum(p["length"]) - p["length"], np.cumsum(p["size"]) - p["size"]
        self.pieces = p

    def _learn(self, texts: list[bytes]) -> np.ndarray:
        """Keep the bytes and ids of pieces, and say where they are."""
        model = self.model.tokenize
        coded = [[t.id for t in model(x.decode() if x.isascii() else x.decode("latin-1").translate(_LETTERS))] for x in texts]
        p = np.zeros(len(texts), _PIECE)
        p["length"], p["size"] = list(map(len, texts)), list(map(len, coded))
        p["text"], p["ids"] = len(self.text) + np.cumsum(p["length"]) - p["length"], len(self.ids) + np.cumsum(p["size"]) - p["size"]
        self.text = np.concatenate([self.text, np.frombuffer(b"".join(texts), np.uint8)])
        self.ids = np.concatenate([self.ids, np.array(list(chain.from_iterable(coded)), self.kind)])
        return p

    def _places(self, raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where the different pieces of ``raw`` are remembered; those that weren't are learnt. A hash finds a piece, and its bytes decide."""
        if len(self.keys) > _REMEMBERED or len(self.text) > _REMEMBERED_BYTES:  # at most half stay, those used last
            self._forget(self.pieces["used"] > np.median(self.pieces["used"]))
        length = np.diff(ends)
        h = W.span_hashes(raw, ends[:-1], ends[1:])
        order = np.argsort(h)
        place = np.empty_like(order)
        place[order] = np.searchsorted(self.keys, h[order])
        found = np.zeros(len(h), bool)
        seen = np.flatnonzero(place < len(self.keys))
        seen = seen[(self.keys[place[seen]] == h[seen]) & (self.pieces["length"][place[seen]] == length[seen])]
        if len(seen):
            n = length[seen]
            same = self.text[_ranges(self.pieces["text"][place[seen]], n)] == raw[_ranges(ends[seen], n)]
            found[seen] = np.logical_and.reduceat(same, np.cumsum(n) - n)
        new = order[~found[order]]
        at = place
        if len(new):
            before, data = place[new], raw.tobytes()
            learnt = self._learn([data[a:b] for a, b in zip(ends[new].tolist(), ends[new + 1].tolist(), strict=True)])
            self.keys, self.pieces = np.insert(self.keys, before, h[new]), np.insert(self.pieces, before, learnt)
            at = place + np.searchsorted(before, place, "right")
            at[new] = before + np.arange(len(new))
        self.chunk += 1
        self.pieces["used"][at] = self.chunk
        return at

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        plain = [self.by_words and _PLAIN.fullmatch(t) is not None and "<|" not in t for t in texts]
        data, rows = W.text_bytes(pa.array([t.lower() if p else "" for t, p in zip(texts, plain, strict=True)], pa.string()))
        start, ink = piece_starts(data, rows)
        flat, cuts = np.zeros(0, self.kind), np.zeros(len(texts) + 1, np.int64)
        if len(start):
            before = np.zeros(len(data) + 1, np.int32)  # bytes before each place, without white space
            np.cumsum(ink, out=before[1:])
            pieces = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(np.append(before[start], before[-1])), pa.py_buffer(data[ink])]).dictionary_encode()
            _, ends, raw = pieces.dictionary.buffers()
            ends = np.frombuffer(ends, np.int32)[: len(pieces.dictionary) + 1].astype(np.int64)
            at = self._places(np.frombuffer(raw, np.uint8)[: ends[-1]], ends)
            known = self.pieces[at]
            which = pieces.indices.to_numpy()
            n = known["size"][which]
            end = np.cumsum(n)
            flat = self.ids[_ranges(known["ids"][which], n)]
            cuts = np.concatenate([[0], end])[np.searchsorted(start, rows)]
        return [flat[a:b] if p else np.array(self.whole.encode(t, add_special_tokens=False).ids, self.kind) for t, p, a, b in zip(texts, plain, cuts.tolist(), cuts[1:].tolist())]


@lru_cache(1)
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


@lru_cache(1)
def _projection(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((WIDTH, DIMENSIONS)).astype(np.float32)


def hilbert_keys(x: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with integer coordinates of ``bits`` bits, one row each."""
    x = x.astype(np.int64).T.copy()
    dims = len(x)
    for q in (1 << b for b in range(bits - 1, 0, -1)):  # undo the rotations and reflections of each level
        low = q - 1
        for i in range(dims):
            set_ = (x[i] & q) > 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(set_, low, swap)
            x[i] ^= swap
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        flip ^= np.where((x[-1] & q) > 0, q - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


@lru_cache(1)
def _features(seed: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and sign of every id in the hashed vector."""
    h = W.mix(np.arange(size, dtype=np.uint64) + np.uint64(seed + 1))
    return (h % np.uint64(WIDTH)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0)


def curve_places(ids: np.ndarray, row: np.ndarray, rows: int, seed: int) -> np.ndarray:
    """Hilbert keys of the hashed, normalised and projected token counts of each row."""
    place, sign = _features(seed, 1 << 16) if not len(ids) or ids.max() < 1 << 16 else _features(seed, 1 << int(ids.max()).bit_length())
    v = np.bincount(row * WIDTH + place[ids], sign[ids], rows * WIDTH).reshape(rows, WIDTH)
    v = (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)).astype(np.float32)
    at = np.clip((v @ _projection(seed) / 6 + 0.5) * (1 << BITS), 0, (1 << BITS) - 1)
    return hilbert_keys(at, BITS)


def _tokenise(path: str, end: int, seed: int):
    def run(batches):
        tokens = _tokenizer(path)
        packer = zstandard.ZstdCompressor(level=1)
        last = np.array([end], tokens.kind)
        for batch in batches:
            text = W.as_strings(batch.column(1))
            for a, b in W.chunks(text, _CHUNK_BYTES):
                texts = text[a:b].to_pylist()
                gc.disable()  # many lists and no cycles
                try:
                    coded = [np.append(c, last) for c in tokens.encode(texts)]
                finally:
                    gc.enable()
                n = np.array([len(c) for c in coded])
                flat = np.concatenate(coded)
                key = curve_places(flat, np.repeat(np.arange(len(n)), n), len(n), seed)
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array(n), pa.array(key), pa.array([packer.compress(c.tobytes()) for c in coded], pa.binary())], ["id", "n", "key", "packed"])

    return run


def tail_cuts(rest: int) -> list[int]:
    """Where the last ``rest`` tokens are cut: lengths that are powers of two, longest first."""
    ends, at = [], 0
    for b in range(rest.bit_length() - 1, -1, -1):
        if rest >> b & 1:
            at += 1 << b
            ends.append(at)
    return ends


def _lay(offsets: np.ndarray, total: int, length: int, itemsize: int):
    """The pieces of documents that come range by range, each in curve order; what is held is one batch, whatever a range has."""
    full = total // length
    tail = full * length + np.array([0, *tail_cuts(total - full * length)])

    def run(batches):
        unpacker = zstandard.ZstdDecompressor()
        part, at = -1, 0  # the range being laid, and the place in the line that its next document takes
        for batch in batches:
            doc, start, size, sequence, offset, ids = [], [], [], [], [], []
            n = batch.column("n").to_numpy()
            packed = batch.column("packed")
            for i, (p, m) in enumerate(zip(batch.column("part").to_pylist(), n.tolist(), strict=True)):
                if p != part:
                    part, at = p, int(offsets[p])
                tokens = np.frombuffer(unpacker.decompress(packed[i].as_py()), f"<u{itemsize}").astype("<u4")
                s, end = at, at + m
                while at < end:
                    if at < tail[0]:
                        k, first, stop = at // length, at - at % length, at - at % length + length
                    else:
                        j = int(np.searchsorted(tail, at, "right"))
                        k, first, stop = full + j - 1, int(tail[j - 1]), int(tail[j])
                    to = min(stop, end)
                    doc.append(i)
                    start.append(at - s)
                    size.append(to - at)
                    sequence.append(k)
                    offset.append(at - first)
                    ids.append(tokens[at - s : to - s].tobytes())
                    at = to
            long = lambda x: pa.array(x, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id").take(long(doc)), long(start), long(size), pa.array(ids, pa.binary()), long(n[doc] if doc else []), long(sequence), long(offset)], ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", length: int = 4096, end_id: int = 2, seed: int = 0) -> DataFrame:
    """The pieces of all sequences: the id, start (in its document), length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset."""
    scratch = Scratch(docs.sparkSession, "packing")
    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    coded = scratch.table(source.mapInArrow(_tokenise(tokenizer, end_id, seed), f"id {kind}, n long, key long, packed binary").withColumn("tie", F.xxhash64(F.monotonically_increasing_id())), "tokens")  # rows that are alike have places of their own
    total = coded.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = max(1, -(-total // RANGE_TOKENS))
    # one row per range of RANGE_TOKENS: its least place, as any range partitioner keeps, and its tokens
    ranges = coded.select("key", "tie", "n").repartitionByRange(parts, "key", "tie").groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("key", "tie")).alias("lo"), F.sum("n").alias("n")).orderBy("lo").select("lo.key", "lo.tie", "n").collect()
    offsets = np.cumsum([0, *(r.n for r in ranges)])[:-1]
    keys, ties = np.array([r.key for r in ranges], np.int64), np.array([r.tie for r in ranges], np.int64)

    def deal(batches):
        for batch in batches:
            k, t = batch.column("key").to_numpy(), batch.column("tie").to_numpy()
            lo, hi = np.searchsorted(keys, k, "left"), np.searchsorted(keys, k, "right")
            part = hi - 1
            for i in np.flatnonzero(hi > lo):  # ranges that begin at this very place
                part[i] = lo[i] + np.searchsorted(ties[lo[i] : hi[i]], t[i], "right") - 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part.astype(np.int64))], [*batch.schema.names, "part"])

    dealt = coded.mapInArrow(deal, f"id {kind}, n long, key long, packed binary, tie long, part long")
    itemsize = 2 if _vocabulary(tokenizer) <= 1 << 16 else 4
    # a range has as many documents as others, not as many tokens: Spark sorts it, spilling, and it is laid batch by batch
    lines = dealt.repartition("part").sortWithinPartitions("part", "key", "tie", F.asc_nulls_last("id"), "n")
    out = lines.mapInArrow(_lay(offsets, total, length, itemsize), f"id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)


def _vocabulary(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size()
