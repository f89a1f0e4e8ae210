"""N-gram Jaccard join with token-combination prefixes.

Every document is the set of its distinct k-word shingles ("tokens"). Tokens are put in one global
order, rare before frequent. A document's *prefix* is its first tokens in that order, extended until a
pigeonhole argument holds: two sets that are similar enough share, within the shorter prefix, either one
rare token or two frequent tokens of the same subclass. So rare tokens are indexed alone and frequent
ones only as pairs within a subclass, candidates are the sets that share an index entry, and each
candidate is verified exactly.

How it runs:

1. one scan gives each document's set size and set signature, and a fixed-size counter sketch, from which
   the *hot* tokens (of 1/64 of all documents or more) are known by a bit map of fixed size;
2. a second scan sends every other token, packed in blocks, to the bucket that counts its document
   frequency; tokens of one document only go no further, as they can't be shared;
3. the tokens that return meet by block of documents, where prefixes and index entries are made. Equal
   sets have the same signature and so are one node from here on;
4. in each entry's posting list the members have a hub, the one with the most frequent tokens; every node is compared
   with the hub that it shares most entries with. As hubs rank above those that follow them, these links are a forest, and its trees
   are parts of components;
5. in lists whose members still lie in different parts, the members of different parts and like sizes are candidates. They meet
   by list and block of bounded size with a parity bitmap of their tokens each, whose difference bounds what a pair can share
   from above; pairs that the bound leaves are verified token by token. No link between different sets that connects anything is lost, while no group
   ever becomes rows for all its pairs.

A token is 40 bits and a bucket number wide (44 bits or more, and more with every doubling of the corpus).

Defined cases: null or wordless text is an empty set, linked with nothing and its own component; a text of
fewer words than the shingle has one token; rows that share an id are one node; ids may not be null (such
rows are returned with a null component). Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reeltide.llm import wordhash as W
from reeltide.llm.graph import connected_components, forest_roots
from reeltide.llm.scratch import Scratch, lookup, salted_lookup

#: Counters of the sketch that finds hot tokens, and the share of all documents from which a token is hot.
SLOTS, HOT_SHARE, HOT_LEAST = 1 << 18, 1 / 64, 16
_SLOT_ROWS = 64
#: Document frequency up to which a token is rare, and so indexed alone.
RARE = 32
#: Tokens that one bucket counts at once.
BUCKET_TOKENS = 1_000_000
#: Rows of one block at most: their numbers fit 16 bits.
_BLOCK_ROWS = 60_000
#: Bits of a parity bitmap; members of a list that meet as one block; rows of lists that one task compares, and pairs that it looks at together.
BITMAP_BITS, LIST_BLOCK, LIST_ROWS, _PAIRS = 1024, 1024, 5_000, 1 << 20
#: Sketches that are summed in one task.
_SKETCHES = 1000
_HOT_LEVEL = 255

_I64 = np.int64


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, pa.Array, pa.Array]]:
    for batch in batches:
        text = W.as_strings(batch.column(1))
        for a, b in W.chunks(text):
            for c in range(a, b, _BLOCK_ROWS):
                part = slice(c, min(b, c + _BLOCK_ROWS))
                yield batch.column(0)[part], text[part]


def _signatures(h: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and 64-bit signature of each row's set."""
    n = np.bincount(row, minlength=rows)
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h, out=total[1:])
    ends = np.cumsum(n)
    return n, W.mix((total[ends] - total[ends - n]) ^ (n.astype(np.uint64) << np.uint64(40))).view(_I64)


def _profile(k: int):
    def run(batches):
        slots = np.zeros(SLOTS, np.int64)
        for ids, text in _blocks(batches):
            h, row = W.shingle_sets(text, k)
            n, node = _signatures(h, row, len(text))
            slots += np.bincount((h & np.uint64(SLOTS - 1)).astype(_I64), minlength=SLOTS)
            none = pa.nulls(len(text))
            yield pa.RecordBatch.from_arrays([ids, pa.array(n), pa.array(node), none.cast(pa.int32()), none.cast(pa.binary())], ["doc_id", "n", "node", "slots", "counts"])
        parts = [x.astype(np.int32).tobytes() for x in slots.reshape(_SLOT_ROWS, -1)]
        none = pa.nulls(_SLOT_ROWS).cast(pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, pa.array(range(_SLOT_ROWS), pa.int32()), pa.array(parts, pa.binary())], ["doc_id", "n", "node", "slots", "counts"])

    return run


def _sum_counts(table: pa.Table) -> pa.Table:
    total = np.zeros(SLOTS // _SLOT_ROWS, _I64)
    for x in table.column("counts"):
        counts = x.as_py()  # of 4 bytes from a task, of 8 where they are sums
        total += np.frombuffer(counts, np.int32 if len(counts) == 4 * len(total) else _I64)
    return pa.table({"slots": table.column("slots")[:1], "counts": pa.array([total.tobytes()], pa.binary())})


def _token_parts(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A token is known by its bucket, the 32 bits that it is counted by, and 8 further bits."""
    return ((h & np.uint64(0xFFFFFF)) % np.uint64(buckets)).astype(np.int32), (h >> np.uint64(32)).astype(np.uint32), (h >> np.uint64(24)).astype(np.uint8)


def _ask(k: int, buckets: int, hot: bytes):
    """Blocks of (row in block, token bits) by bucket; bucket -1 holds a block's own rows and hot tokens."""

    def run(batches):
        is_hot = np.unpackbits(np.frombuffer(hot, np.uint8)).astype(bool)
        task, seq = TaskContext.get().partitionId(), 0
        for _, text in _blocks(batches):
            block = (task << 32) + seq
            seq += 1
            h, row = W.shingle_sets(text, k)
            n, node = _signatures(h, row, len(text))
            warm = is_hot[(h & np.uint64(SLOTS - 1)).astype(_I64)]
            bucket, bits, more = _token_parts(h, buckets)
            bucket[warm] = -1
            row = row.astype(np.uint16)
            order = np.argsort(bucket, kind="stable")
            bucket, bits, more, row = bucket[order], bits[order], more[order], row[order]
            own = _token_parts(h[order[: int(warm.sum())]], buckets)[0].astype(np.int32)
            at = np.flatnonzero(np.diff(bucket, prepend=-2)) if len(bucket) else np.zeros(0, _I64)
            to = np.append(at[1:], len(bucket))
            out = [(int(bucket[a]), row[a:b].tobytes(), bits[a:b].tobytes(), more[a:b].tobytes()) for a, b in zip(at, to, strict=True) if bucket[a] >= 0]
            m = int(warm.sum())
            out.append((-1, row[:m].tobytes(), bits[:m].tobytes(), more[:m].tobytes()))
            none = [None] * (len(out) - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * len(out), pa.int64()), pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary()), pa.array([x[2] for x in out], pa.binary()), pa.array([x[3] for x in out], pa.binary()), pa.array([*none, own.tobytes()], pa.binary()), pa.array([*none, n.astype(np.int32).tobytes() + node.tobytes()], pa.binary())],
                ["block", "bucket", "at", "bits", "more", "extra", "docs"],
            )

    return run


_ASKED = "block long, bucket int, at binary, bits binary, more binary, extra binary, docs binary"


def _frequency_level(df: np.ndarray) -> np.ndarray:
    """Document frequency as a byte that keeps its order: exact to 200, then in steps of a sixteenth octave or more."""
    return np.where(df <= 200, df, np.minimum(254, 200 + np.log2(np.maximum(df, 200) / 200) * 2)).astype(np.uint8)


def _count(table: pa.Table) -> pa.Table:
    """For one bucket: what each block asked about tokens of two documents or more, with their level."""
    bits = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in table.column("bits")])
    lengths = np.array([len(x.as_py()) // 4 for x in table.column("bits")])
    order = np.argsort(bits, kind="stable")
    ranked = bits[order]
    new = np.flatnonzero(np.diff(ranked, prepend=~ranked[:1]))
    df = np.diff(np.append(new, len(ranked)))
    level = np.empty(len(bits), np.uint8)
    level[order] = np.repeat(_frequency_level(df), df)
    rows = []
    end = 0
    for i, size in enumerate(lengths):
        own = slice(end, end + size)
        end += size
        keep = level[own] >= 2
        if keep.any():
            at = np.frombuffer(table.column("at")[i].as_py(), np.uint16)
            more = np.frombuffer(table.column("more")[i].as_py(), np.uint8)
            rows.append((table.column("block")[i].as_py(), table.column("bucket")[i].as_py(), at[keep].tobytes(), bits[own][keep].tobytes(), more[keep].tobytes(), level[own][keep].tobytes(), None))
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 5]
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["block", "bucket", "at", "bits", "more", "extra", "docs"])


def _index(num: int, den: int):
    """For one block: index entries (sig, node, n, central) of its sets, and the shared tokens of the sets that have any, each set once.

    ``central``: how frequent the tokens of a set are, all in all; equal sets have it in common.
    """

    def scheme_of(n: int) -> int:
        return int(np.floor(np.log(n) / np.log(den / num) + 1e-9))

    def run(table: pa.Table) -> pa.Table:
        rows, token, level, n, node = [], [], [], np.zeros(0, np.int32), np.zeros(0, _I64)
        for r in table.to_pylist():
            at, bits = np.frombuffer(r["at"], np.uint16), (np.frombuffer(r["bits"], np.uint32).astype(np.uint64) << np.uint64(8)) | np.frombuffer(r["more"], np.uint8)
            if r["docs"] is not None:
                m = len(r["docs"]) // 12
                n, node = np.frombuffer(r["docs"], np.int32, m), np.frombuffer(r["docs"], _I64, m, 4 * m) if m % 2 == 0 else np.frombuffer(r["docs"][4 * m :], _I64)
                bucket, lev = np.frombuffer(r["extra"], np.int32).astype(np.uint64), np.full(len(at), _HOT_LEVEL, np.uint8)
            else:
                bucket, lev = np.uint64(r["bucket"]), np.frombuffer(r["extra"], np.uint8)
            rows.append(at)
            token.append((bucket << np.uint64(40)) | bits)
            level.append(lev)
        row, token, level = np.concatenate(rows).astype(_I64), np.concatenate(token), np.concatenate(level)
        order = np.lexsort((W.mix(token), level, row))
        row, token, level = row[order], token[order], level[order]
        shared = np.bincount(row, minlength=len(n))
        begin = np.cumsum(shared) - shared
        alone = n - shared
        need = n - -(-(n.astype(_I64) * num) // den) + 1  # tokens of which one is shared, at least
        rare = np.bincount(row[level <= RARE], minlength=len(n))
        place = np.arange(len(row)) - begin[row] + alone[row]
        single = (level <= RARE) & (place < need[row])
        sigs, owners = [W.mix(token[single])], [row[single]]
        for d in np.flatnonzero((alone + rare < need) & (n > 0)):
            a, b = begin[d] + rare[d], begin[d] + shared[d]
            often = token[a:b]
            if not len(often):
                continue
            own = scheme_of(int(n[d]))
            for scheme in {own, own - 1} - {-1}:
                classes = int(0.15 * (den / num) ** scheme)
                if not classes:  # so few tokens: each alone
                    take = often[: need[d] - alone[d] - rare[d]]
                    sigs.append(W.mix(take ^ np.uint64(0x5BD1E995)))
                    owners.append(np.full(len(take), d))
                    continue
                sub = (W.mix(often) % np.uint64(classes)).astype(_I64)
                first = np.zeros(len(sub), bool)
                first[np.unique(sub, return_index=True)[1]] = True
                gained = np.cumsum(~first)  # tokens so far, less one for each subclass
                p = int(np.searchsorted(gained, need[d] - alone[d] - rare[d])) + 1
                by = np.argsort(sub[:p], kind="stable")
                often_p, sub_p = often[:p][by], sub[:p][by]
                pairs = []
                for gap in range(1, p):
                    same = np.flatnonzero(sub_p[gap:] == sub_p[:-gap])
                    if not len(same):
                        break
                    x, y = often_p[same], often_p[same + gap]
                    pairs.append(W.mix(np.minimum(x, y) * np.uint64(0x9E3779B97F4A7C15) + np.maximum(x, y) + np.uint64(2 * scheme + 1)))
                if pairs:
                    sigs.append(np.concatenate(pairs))
                    owners.append(np.full(len(sigs[-1]), d))
        sig, owner = np.concatenate(sigs).view(_I64), np.concatenate(owners).astype(_I64)
        once = np.zeros(len(n), bool)
        once[np.unique(node, return_index=True)[1]] = True
        sig, owner = sig[once[owner]], owner[once[owner]]
        central = np.bincount(row, level, len(n)).astype(_I64)
        used = np.unique(owner)
        lists = [token[begin[d] : begin[d] + shared[d]].view(_I64) for d in used]
        ends = np.cumsum([0, *map(len, lists)])
        none = pa.ListArray.from_arrays(pa.array([0, *[0] * len(sig)], pa.int32()), pa.array([], pa.int64())) if len(sig) else pa.array([], pa.list_(pa.int64()))
        tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*lists, np.zeros(0, _I64)])))
        both = np.concatenate([owner, used])
        block = pa.array(np.full(len(both), table.column("block")[0].as_py(), _I64))
        return pa.Table.from_arrays(
            [block, pa.concat_arrays([pa.array(sig), pa.nulls(len(used), pa.int64())]), pa.array(node[both]), pa.array(n[both].astype(_I64)), pa.array(central[both]), pa.concat_arrays([none, tokens])],
            ["block", "sig", "node", "n", "central", "tokens"],
        )

    return run


def _parity(batches):
    """(node, n, tokens) -> (node, n, shared, bits): the number of tokens and the parity bitmap of each set."""
    for batch in batches:
        lists = batch.column(2)
        size = np.diff(lists.offsets.to_numpy())
        row = np.repeat(np.arange(len(size)), size)
        place = (W.mix(lists.flatten().to_numpy().view(np.uint64)) % np.uint64(BITMAP_BITS)).astype(_I64)
        for a in range(0, len(size), 256):  # so many rows' bits are counted together
            b = min(a + 256, len(size))
            use = slice(*np.searchsorted(row, [a, b]))
            odd = (np.bincount((row[use] - a) * BITMAP_BITS + place[use], minlength=(b - a) * BITMAP_BITS) & 1).astype(np.uint8)
            bits = np.packbits(odd.reshape(b - a, -1), axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], batch.column(1)[a:b], pa.array(size[a:b].astype(_I64)), pa.array([x.tobytes() for x in bits], pa.binary())], ["node", "n", "shared", "bits"])


def _near_pairs(num: int, den: int):
    """Of the rows (block, side, node, n, shared, bits, part) of some lists' blocks, the pairs of nodes of different parts that may be similar."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("sig", "ascending"), ("i", "ascending"), ("j", "ascending"), ("side", "ascending")]).combine_chunks()
        key = np.stack([table.column(c).to_numpy() for c in ("sig", "i", "j")])
        side, node, n, shared, part = (table.column(c).to_numpy() for c in ("side", "node", "n", "shared", "part"))
        bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(len(node), -1)
        at = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(0)]))
        to = np.append(at[1:], len(node))
        same = key[1][at] == key[2][at]
        # each row meets those after it in its block, or all rows of the other block
        group = np.repeat(np.arange(len(at)), to - at)
        turn = np.array([a + int(np.searchsorted(side[a:b], 1)) for a, b in zip(at, to, strict=True)], _I64)
        first = np.where(same[group], np.arange(len(node)) + 1, turn[group])
        many = np.where(same[group] | (side == 0), to[group] - first, 0)
        found = []
        ends = np.cumsum(many)
        a = 0
        while a < len(node):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + _PAIRS, "right")))
            x = np.repeat(np.arange(a, b), many[a:b])
            y = np.arange(len(x)) - np.repeat(np.cumsum(many[a:b]) - many[a:b], many[a:b]) + first[x]
            ok = (part[x] != part[y]) & (den * np.minimum(n[x], n[y]) >= num * np.maximum(n[x], n[y]))
            x, y = x[ok], y[ok]
            apart = np.zeros(len(x), _I64)
            for k in range(bits.shape[1]):
                apart += np.bitwise_count(bits[x, k] ^ bits[y, k])
            most = (shared[x] + shared[y] - apart) // 2
            ok = den * most >= num * (n[x] + n[y] - most)
            x, y = x[ok], y[ok]
            swap = node[x] > node[y]
            x, y = np.where(swap, y, x), np.where(swap, x, y)
            found.append(np.stack([node[x], node[y], n[x], n[y]]))
            a = b
        pairs = np.unique(np.concatenate(found, axis=1), axis=1)
        return pa.table({c: pa.array(pairs[i], pa.int64()) for i, c in enumerate(("a", "b", "na", "nb"))})

    return run


def similar_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 80, den: int = 100) -> tuple[DataFrame, DataFrame]:
    """``(members, links)`` of the join of ``docs`` with itself at Jaccard similarity ``num / den`` or more.

    ``members``: doc_id, n (set size), node (equal sets share it). ``links``: verified pairs (u, v) of nodes, which
    connect exactly the nodes that all similar pairs connect (pairs that others already connect may be left out).
    """
    members, roots, links = _similar(docs, id_col, text_col, words, num, den, Scratch(docs.sparkSession, "ngram-join"))
    return members, roots.select(F.col("up").alias("u"), F.col("node").alias("v")).unionByName(links)


def _similar(docs: DataFrame, id_col: str, text_col: str, words: int, num: int, den: int, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """members as above; trees of verified links (node, up, root), the roots left out; further links (u, v, a, b) of nodes and their roots."""
    if not 0 < 2 * num < 2 * den <= 4 * num:
        raise ValueError("the threshold must lie from 1/2 up to, but without, 1")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    seen = scratch.table(source.mapInArrow(_profile(words), "doc_id long, n long, node long, slots int, counts binary"), "profile")
    members = seen.where("slots is null").select("doc_id", "n", "node")
    size = seen.agg(F.count_if(F.col("slots").isNull()), F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("slots") == 0)).first()
    buckets = min(max(16, -(-size[1] // BUCKET_TOKENS)), 1 << 23)
    sketches = seen.where("slots is not null").select("slots", "counts")
    if size[2] > _SKETCHES:  # one for each task: first sums of some, then of all
        some = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(-(-size[2] // _SKETCHES)))
        sketches = sketches.withColumn("some", some).groupBy("slots", "some").applyInArrow(_sum_counts, "slots int, counts binary")
    counts = sketches.groupBy("slots").applyInArrow(_sum_counts, "slots int, counts binary").collect()  # 64 rows of 32 KB
    slots = np.concatenate([np.frombuffer(r.counts, _I64) for r in sorted(counts)]) if counts else np.zeros(SLOTS, _I64)
    hot = np.packbits(slots >= max(HOT_LEAST, HOT_SHARE * size[0])).tobytes()

    asked = scratch.table(source.mapInArrow(_ask(words, buckets, hot), _ASKED), "asked")
    told = asked.where("bucket >= 0").groupBy("bucket").applyInArrow(_count, _ASKED)
    indexed = scratch.table(asked.where("bucket < 0").unionByName(told).groupBy("block").applyInArrow(_index(num, den), "block long, sig long, node long, n long, central long, tokens array<long>"), "index")
    scratch.release(asked)
    posts = scratch.table(indexed.where("sig is not null").groupBy("sig", "node").agg(F.first("n").alias("n"), F.first("central").alias("central")), "posts")
    hubs = scratch.table(posts.groupBy("sig").agg(F.count("*").alias("c"), F.max(F.struct("central", "node", "n")).alias("rep")).where("c > 1"), "hubs")
    lists = scratch.table(lookup(posts, hubs, "sig", ["node"], "inner", "c").select("sig", "node", "n", "rep"), "lists")
    scratch.release(posts)
    # each set's tokens once, from the first block that has it
    sets = indexed.where("sig is null").select("node", "block", "n", "tokens")
    owners = sets.groupBy("node").agg(F.min("block").alias("block")).join(lists.select("node").distinct(), "node", "left_semi")
    own = scratch.table(sets.join(owners.hint("merge"), ["node", "block"], "left_semi").select("node", "n", "tokens"), "sets")
    scratch.release(indexed)

    def verified(pairs: DataFrame) -> DataFrame:
        """(a, b) of those pairs (a, na, b, nb), a table, that reach the threshold; a is the side that may be a hub."""
        often = pairs.groupBy("a").agg(F.count("*").alias("c"))
        hub = scratch.table(own.select(F.col("node").alias("a"), F.col("tokens").alias("ta")).join(often, "a"), "hub-tokens")
        both = pairs.join(own.select(F.col("node").alias("b"), F.col("tokens").alias("tb")), "b")
        both = lookup(both, hub, "a", ["b"], "inner", "c", pairs.count()).withColumn("both", F.size(F.array_intersect("ta", "tb")))
        return both.where(f"{den} * both >= {num} * (na + nb - both)").select("a", "b")

    star = lists.where("node <> rep.node").where(f"{den} * least(n, rep.n) >= {num} * greatest(n, rep.n)").groupBy("node", "n", "rep").agg(F.count("*").alias("c"))
    best = star.groupBy("node", "n").agg(F.max(F.struct("c", "rep")).alias("best"))
    first = scratch.table(best.select(F.col("best.rep.node").alias("a"), F.col("best.rep.n").alias("na"), F.col("node").alias("b"), F.col("n").alias("nb")), "first")
    up = scratch.table(verified(first).select(F.col("b").alias("node"), F.col("a").alias("up")), "links")
    roots = scratch.table(up.join(forest_roots(up, scratch), "node"), "roots")

    part = scratch.table(lists.select("sig", "node").join(roots.select("node", "root"), "node", "left").select("sig", "node", F.coalesce("root", "node").alias("part")), "part")
    open_lists = part.groupBy("sig").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.count("*").alias("c")).where("lo < hi").select("sig", "c", F.ceil(F.col("c") / LIST_BLOCK).cast("int").alias("blocks"))
    rows = scratch.table(lookup(part, scratch.table(open_lists, "open-lists"), "sig", ["node"], "inner", "c"), "open")
    scratch.release(lists, part, first)
    meet = F.expr("concat(transform(sequence(k, blocks - 1), x -> struct(k as i, x as j, 0 as side)), transform(filter(sequence(0, k), x -> x < k), x -> struct(x as i, k as j, 1 as side)))")
    sent = rows.withColumn("k", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).select("sig", "node", "part", F.explode(meet).alias("m")).select("sig", "node", "part", "m.*")
    bitmaps = own.select("node", "n", "tokens").join(rows.select("node").distinct(), "node", "left_semi").mapInArrow(_parity, "node long, n long, shared long, bits binary")
    tasks = max(1, -(-rows.count() // LIST_ROWS))
    sent = sent.join(bitmaps, "node").withColumn("task", F.pmod(F.xxhash64("sig", "i", "j"), F.lit(tasks)).cast("int"))
    near = sent.groupBy("task").applyInArrow(_near_pairs(num, den), "a long, b long, na long, nb long").distinct()
    more = scratch.table(verified(scratch.table(near, "near")), "more")
    to_root = lambda rows, c, r: rows.join(roots.select(F.col("node").alias(c), F.col("root").alias("_root")), c, "left").withColumn(r, F.coalesce("_root", c)).drop("_root")
    links = scratch.table(to_root(to_root(more.select(F.col("a").alias("u"), F.col("b").alias("v")), "u", "a"), "v", "b"), "further")
    scratch.keep_only(seen, roots, links)
    return members, roots, links


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the smallest id reachable over similar pairs)."""
    scratch = Scratch(docs.sparkSession, "ngram-groups")
    members, roots, links = _similar(docs, id_col, text_col, words, num, den, scratch)
    alike = members.where("n > 0 and doc_id is not null")
    nodes = scratch.table(alike.groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("c")).join(roots.select("node", "root"), "node", "left").select("node", "least", "c", F.coalesce("root", "node").alias("part")), "nodes")
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    # ids with several rows connect their nodes
    twice = scratch.table(alike.groupBy("doc_id").agg(F.min("node").alias("u"), F.max("node").alias("v"), F.count("*").alias("c")).where("u < v").select("doc_id", "u", "c"), "twice")
    if not twice.isEmpty():
        tied = lookup(alike, twice, "doc_id", ["node"], "inner", "c").where("node <> u").select("u", "node").distinct()
        tied = tied.join(nodes.select(F.col("node").alias("u"), F.col("part").alias("a")), "u").join(nodes.select("node", F.col("part").alias("b")), "node")
        edges = edges.unionByName(tied.select(F.col("a").alias("u"), F.col("b").alias("v")))
    joined = salted_lookup(nodes, connected_components(edges, scratch).withColumnRenamed("node", "part"), "part", ["node"]).select("node", "least", "c", F.coalesce("component", "part").alias("part"))
    joined = scratch.table(joined, "joined")
    least = scratch.table(joined.groupBy("part").agg(F.min("least").alias("component_id"), F.count("*").alias("m")), "least")
    by_node = scratch.table(lookup(joined, least, "part", ["node"], "inner", "m").select("node", "component_id", "c"), "by-node")
    seen = [t for t in scratch.tables("profile")]
    scratch.keep_only(by_node, *seen)
    out = lookup(members, by_node, "node", ["doc_id"], "left", "c")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce(F.when(F.col("n") > 0, F.col("component_id")), F.col("doc_id")).alias("component_id"))
