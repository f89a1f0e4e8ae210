"""Exact top-k search by a bit-sliced index.

Vectors are quantised to integers. A block of rows is kept as bit slices: for each dimension one bitmap over the
rows per binary digit, counted up from the dimension's least value and, for negative query components, down from
its greatest. A query's scores are added up as bitmaps: slices of equal weight are reduced three to two by
bitwise full adders until one slice per weight is left. The k best rows are then selected from the most
significant slice downward; rows that tie at the boundary are resolved by id, and the scores that are reported
are computed from the integers themselves.

Rows are dealt to blocks, whose slices are made once and written as packed bitmaps, and queries to chunks; each block meets each
chunk in a task of bounded size, and only k rows for each query and block leave it.

Defined cases: vectors that are null, empty, or hold null or non-finite components take no part, nor does a null id;
queries compare with vectors of their own width only; rows that repeat an id are rows of their own: each asks for itself where
``queries`` holds, and is a candidate of the others; quantised components stay within the range of a long, and scores whose
bound doesn't fit 62 bits are computed with Python's integers and reported within that range.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reeltide.llm.scratch import Scratch

#: Rows of one block of the index, and queries that meet it in one task.
BLOCK_ROWS, CHUNK_QUERIES = 8192, 1024
_MAX_TASKS = 20_000


def _slices(y: np.ndarray) -> list[np.ndarray]:
    """Bitmaps over the rows of each binary digit of non-negative numbers (rows, dimensions): a (dimensions, words) array per digit."""
    pad = -len(y) % 64
    y = np.pad(y, ((0, pad), (0, 0))) if pad else y
    digits = int(y.max(initial=0)).bit_length()
    return [np.packbits(np.ascontiguousarray(((y >> s) & 1).T).astype(bool), axis=1, bitorder="little").view(np.uint64) for s in range(digits)]


def add_slices(terms: dict[int, list[np.ndarray]], words: int) -> list[np.ndarray]:
    """The sum of weighted bitmaps as one bitmap per binary digit. terms: by the weight's exponent, (n, words) arrays."""
    out = []
    w = 0
    while any(k >= w for k in terms):
        held = terms.get(w)
        x = np.concatenate(held) if held else np.zeros((0, words), np.uint64)
        while len(x) > 1:
            n = len(x) // 3
            if n:
                a, b, c = x[:n], x[n : 2 * n], x[2 * n : 3 * n]
                ab = a ^ b
                carry = (a & b) | (c & ab)
                x = np.concatenate([ab ^ c, x[3 * n :]])
            else:  # two are left: a half adder
                carry = x[:1] & x[1:]
                x = x[:1] ^ x[1:]
            terms.setdefault(w + 1, []).append(carry)
        out.append(x[0] if len(x) else np.zeros(words, np.uint64))
        w += 1
    return out


def select_top(digits: list[np.ndarray], among: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the k rows in bitmap ``among`` with the greatest sums; ties at the boundary go to smaller numbers."""
    sure, open_ = np.zeros_like(among), among.copy()
    for digit in reversed(digits):
        ones = open_ & digit
        n = int(np.bitwise_count(sure).sum() + np.bitwise_count(ones).sum())
        if n > k:
            open_ = ones
        else:
            sure |= ones
            open_ &= ~digit
            if n == k:
                open_[:] = 0
                break
    numbers = lambda m: np.flatnonzero(np.unpackbits(m.view(np.uint8), bitorder="little"))
    first = numbers(sure)
    return np.concatenate([first, numbers(open_)[: max(0, k - len(first))]])


def _matrix(table: pa.Table) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy() for c in table.column("x").chunks]).reshape(len(table), -1)


_INDEX = "width int, block long, ids binary, rows binary, x binary, up binary, down binary, digits array<int>"


def _build(table: pa.Table) -> pa.Table:
    """One block's row of the index: ids, numbers of its rows, and components, in order of id, and the slices upward and downward."""
    table = table.sort_by([("id", "ascending"), ("row", "ascending")])
    x = _matrix(table)
    span = float(np.abs(x.astype(float)).max()) >= 2.0**61  # differences wouldn't fit
    up, down = ([], []) if span else (_slices(x - x.min(0)), _slices(x.max(0) - x))
    packed = [table.column("id").to_numpy(), table.column("row").to_numpy(), x, np.array(up, np.uint64), np.array(down, np.uint64)]
    return pa.Table.from_arrays([*(table.column(c)[:1] for c in ("width", "block")), *(pa.array([p.tobytes()], pa.binary()) for p in packed), pa.array([[len(up), len(down)]], pa.list_(pa.int32()))], names=["width", "block", "ids", "rows", "x", "up", "down", "digits"])


def _search(k: int):
    def run(index, queries):
        names = ["query_row", "query_id", "vec_id", "score"]
        if not len(index) or not len(queries):
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        held = {c: index.column(c)[0].as_py() for c in ("ids", "rows", "x", "up", "down", "digits")}
        ids, rows = np.frombuffer(held["ids"], np.int64), np.frombuffer(held["rows"], np.int64)
        x = np.frombuffer(held["x"], np.int64).reshape(len(ids), -1)
        words = -(-len(x) // 64)
        up, down = (list(np.frombuffer(held[c], np.uint64).reshape(n, x.shape[1], words)) if n else [] for c, n in zip(("up", "down"), held["digits"], strict=True))
        q = _matrix(queries)
        wide = float(np.abs(x.astype(float)).max()) * float(np.abs(q.astype(float)).sum(1).max()) >= 2.0**62
        everyone = np.packbits(np.arange(words * 64) < len(x), bitorder="little").view(np.uint64)
        out = []
        for number, query, v in zip(queries.column("row").to_numpy(), queries.column("id").to_numpy(), q, strict=True):
            own = [i for i in range(np.searchsorted(ids, query, "left"), np.searchsorted(ids, query, "right")) if rows[i] == number]
            if wide:
                score = x.astype(object) @ v.astype(object)
                best = sorted((i for i in range(len(ids)) if i not in own), key=lambda i: (-score[i], i))[:k]
                out += [(number, query, ids[i], max(min(score[i], 2**63 - 1), -(2**63))) for i in best]
                continue
            terms: dict[int, list[np.ndarray]] = {}
            for digits, factor in ((up, np.maximum(v, 0)), (down, np.maximum(-v, 0))):
                for t in range(int(factor.max()).bit_length()):
                    has = (factor >> t & 1).astype(bool)
                    if has.any():
                        for s, digit in enumerate(digits):
                            terms.setdefault(s + t, []).append(digit[has])
            among = everyone.copy()
            for i in own:
                among[i // 64] &= ~np.uint64(1 << (i % 64))
            best = select_top(add_slices(terms, words), among, k)
            out += zip([number] * len(best), [query] * len(best), ids[best], x[best] @ v, strict=True)
        return pa.table({n: pa.array([int(r[i]) for r in out], pa.int64()) for i, n in enumerate(names)})

    return run


def top_k(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score, query_row): for each row where ``queries`` holds, the k other rows of the greatest integer inner product. ``query_row`` tells rows of one id apart."""
    scratch = Scratch(vectors.sparkSession, "bit-sliced")
    v = F.col(vector_col)
    sound = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.col(id_col).isNotNull()
    x = F.transform(v, lambda c: F.floor(c.cast("double") * float(scale)).cast("long"))
    rows = vectors.where(sound).select(F.col(id_col).cast("long").alias("id"), x.alias("x"), F.coalesce(queries, F.lit(False)).alias("q"))
    rows = scratch.table(rows.withColumns({"width": F.size("x"), "row": F.monotonically_increasing_id()}), "rows")
    n, m = rows.agg(F.count("*"), F.count_if("q")).first()
    blocks, chunks = max(1, -(-n // BLOCK_ROWS)), max(1, -(-m // CHUNK_QUERIES))
    block = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks))
    chunk = F.pmod(F.xxhash64("row", F.lit(2)), F.lit(chunks))
    tasks = min(blocks * chunks, _MAX_TASKS)
    keys = ["width", "block", "chunk"]
    numbers = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
    index = scratch.table(rows.select("width", "row", "id", "x", block.alias("block")).groupBy("width", "block").applyInArrow(_build, _INDEX), "index")
    index = index.withColumn("chunk", numbers(chunks))
    asked = rows.where("q").select("width", "row", "id", "x", numbers(blocks).alias("block"), chunk.alias("chunk"))
    found = index.repartition(tasks, *keys).groupBy(*keys).cogroup(asked.repartition(tasks, *keys).groupBy(*keys)).applyInArrow(_search(k), "query_row long, query_id long, vec_id long, score long")
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "query_row")
