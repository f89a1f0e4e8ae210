"""Toxicity by class-conditional Kneser-Ney models of byte n-grams.

Two models of a word's bytes, one for toxic and one for ordinary documents, are compared by the
log-likelihood each gives an expression, normalised by its length. Both interpolate their own discounted
6-gram counts with one *shared* Kneser-Ney distribution of the lower orders, made from continuation counts
of both classes. An n-gram that neither class knows after a context gets the same backed-off probability
from both, so a rare expression is only as suspicious as the parts of it that were seen; inflected forms of
a toxic stem are caught by the stem.

Counts are taken over all labelled training rows: a document counts a word once. A logistic regression turns a
document's highest expression scores and its mean into a probability. It is fitted on CALIBRATION_ROWS labelled rows of
one fold at most, scored by a second model whose counts leave out just these rows; both models are made in the same passes.

A model of up to BROADCAST_ENTRIES entries is sent to all tasks; with a larger one each distinct word of the corpus is scored once, by
joins, and joined back to the documents that have it. Scores are the same either way.

Defined cases: null and wordless texts score as documents without any evidence; a null or missing label
trains nothing; if a document has several labels, it is toxic if one says so; without both classes among the
training rows every score is the share of toxic rows (0 without any labelled row). Each row is scored by its own text:
rows may share an id, and ids may be null; a label counts for all rows of its id, of which one calibrates.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reeltide.llm import wordhash as W
from reeltide.llm.scratch import Scratch, lookup

ORDER = 6
#: Model entries up to which executors get the model as a broadcast (12 bytes each); a larger one is joined.
BROADCAST_ENTRIES = 6_000_000
#: Labelled rows that calibrate the score.
CALIBRATION_ROWS = 20_000
#: Distinct n-grams that a task holds before it passes its counts on.
_HELD = 300_000
_MASK = (1 << 8 * ORDER) - 1
#: Added to a context's key, to keep it apart from n-grams.
_CONTEXT = 1 << 60
#: Number of highest-scoring distinct expressions that are features, and the powers of their length that normalise their scores.
TOP, POWERS = 5, (1.0, 0.5)


def _grams(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams that predict each byte and the end of each word, and their word's number."""
    length = end - start
    room = length + ORDER
    at = np.cumsum(room) - room
    flat = np.full(int(room.sum()) + ORDER, 0x20, np.uint8)
    which = np.repeat(np.arange(len(start)), length)
    inside = np.arange(len(which)) - np.repeat(np.cumsum(length) - length, length)
    flat[at[which] + ORDER - 1 + inside] = data[start[which] + inside]
    packed = np.zeros(len(flat) - ORDER, np.int64)
    for k in range(ORDER):
        packed = (packed << 8) | flat[k : k + len(packed)]
    which = np.repeat(np.arange(len(start)), length + 1)
    inside = np.arange(len(which)) - np.repeat(np.cumsum(length + 1) - length - 1, length + 1)
    return packed[at[which] + inside], which


def _distinct_words(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, start, end and row of each row's distinct words, and their hashes."""
    data, rows = W.text_bytes(text)
    data = W._FOLD[data]
    start, end, row = W.word_spans(data, rows)
    h = W.span_hashes(data, start, end)
    order = np.lexsort((h, row))
    new = np.ones(len(order), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (row[order][1:] != row[order][:-1])
    keep = order[new]
    return data, start[keep], end[keep], row[keep], h[keep]


def _merge(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    gram = np.concatenate([p[0] for p in parts])
    key, back = np.unique(gram, return_inverse=True)
    return key, *(np.bincount(back, np.concatenate([p[i] for p in parts]), len(key)).astype(np.int64) for i in range(1, 5))


def _count(batches):
    """(text, toxic, apart) -> (gram, t0, o0, t1, o1): in how many toxic and ordinary documents' words each n-gram occurs, and without those apart."""
    held = [(np.zeros(0, np.int64),) * 5]
    names = ["gram", "t0", "o0", "t1", "o1"]
    for batch in batches:
        text = W.as_strings(batch.column(0))
        toxic, apart = (batch.column(i).to_numpy(zero_copy_only=False).astype(bool) for i in (1, 2))
        for a, b in W.chunks(text):
            data, start, end, row, h = _distinct_words(text[a:b])
            if not len(h):
                continue
            _, first, back = np.unique(h, return_index=True, return_inverse=True)
            bad, kept = toxic[a:b][row], ~apart[a:b][row]
            often = [np.bincount(back, which, len(first)) for which in (bad, ~bad, bad & kept, ~bad & kept)]
            gram, word = _grams(data, start[first], end[first])
            held.append(_merge([(gram, *(x[word] for x in often))]))
        if sum(len(x[0]) for x in held) > _HELD:
            held = [_merge(held)]
            if len(held[0][0]) > _HELD:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in held.pop()], names)
                held = [(np.zeros(0, np.int64),) * 5]
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in _merge(held)], names)


#: The two models: of all counts, and of those without the rows apart.
_MODELS = (0, 1)


def _shared_backoff(grams: DataFrame, scratch: Scratch) -> DataFrame:
    """(gram of ORDER - 1 bytes, p0, p1): interpolated Kneser-Ney over the continuation counts of both classes, for each model."""
    levels = []
    seen = lambda c: (c > 0).cast("int")
    counts = grams.select("gram", *(seen(F.col(f"t{m}") + F.col(f"o{m}")).alias(f"k{m}") for m in _MODELS))
    for k in range(ORDER - 1, 0, -1):
        longer = counts.groupBy(F.col("gram").bitwiseAND((1 << 8 * k) - 1).alias("gram"))
        counts = scratch.table(longer.agg(*(F.sum(f"k{m}").alias(f"c{m}") for m in _MODELS)), f"continuations{k}")
        levels.append(counts)
        counts = counts.select("gram", *(seen(F.col(f"c{m}")).alias(f"k{m}") for m in _MODELS))
    lower: DataFrame | None = None
    for k, counts in zip(range(1, ORDER), reversed(levels), strict=True):
        d = _discounts(counts, "c")
        context = F.shiftright("gram", 8)
        around = counts.groupBy(context.alias("context")).agg(*[f for m in _MODELS for f in (F.sum(f"c{m}").alias(f"s{m}"), F.count_if(F.col(f"c{m}") > 0).alias(f"n{m}"))])
        both = counts.withColumn("context", context).join(around, "context")
        if lower is None:
            both = both.select("*", *(F.lit(1 / 256).alias(f"low{m}") for m in _MODELS))
        else:
            both = both.withColumn("low", F.col("gram").bitwiseAND((1 << 8 * (k - 1)) - 1)).join(lower.select(F.col("gram").alias("low"), *(F.col(f"p{m}").alias(f"low{m}") for m in _MODELS)), "low")

        def p(m: int, d: float) -> Column:  # null where the model doesn't know the context
            return F.when(F.col(f"s{m}") > 0, (F.greatest(F.col(f"c{m}") - d, F.lit(0.0)) + d * F.col(f"n{m}") * F.col(f"low{m}")) / F.col(f"s{m}"))

        lower = scratch.table(both.select("gram", *(p(m, d[m]).alias(f"p{m}") for m in _MODELS)), f"shared{k}")
    return lower


def _discounts(counts: DataFrame, c: str) -> list[float]:
    """The usual estimate from how many counts are one and two, for each model."""
    found = counts.agg(*[F.count_if(F.col(f"{c}{m}") == k) for m in _MODELS for k in (1, 2)]).first()
    return [min(0.95, max(0.1, found[2 * m] / (found[2 * m] + 2 * found[2 * m + 1]))) if found[2 * m] else 0.5 for m in _MODELS]


def fit(train: DataFrame, text: str, toxic: str, scratch: Scratch, apart: str | None = None) -> DataFrame:
    """(key, llr, llr_apart): the log-likelihood ratio of every known n-gram, and of an unknown one after every known context.

    ``apart``: a column that marks the rows that the second ratio is without; it is null where the n-gram or context isn't known without them.
    """
    kept = F.coalesce(F.col(apart).cast("boolean"), F.lit(False)) if apart else F.lit(False)
    parts = train.select(F.col(text), F.col(toxic).cast("boolean"), kept.alias("apart")).mapInArrow(_count, "gram long, t0 long, o0 long, t1 long, o1 long")
    grams = scratch.table(parts.groupBy("gram").agg(*(F.sum(x).alias(x) for x in ("t0", "o0", "t1", "o1"))), "grams")
    d = {x: _discounts(grams, x) for x in "to"}
    sums = [f for x in ("t0", "o0", "t1", "o1") for f in (F.sum(x).alias(f"s{x}"), F.count_if(F.col(x) > 0).alias(f"n{x}"))]
    around = scratch.table(grams.groupBy(F.shiftright("gram", 8).alias("context")).agg(*sums), "contexts")

    def rest(x: str, m: int) -> Column:  # what a context leaves to the shared distribution
        return F.when(F.col(f"s{x}{m}") > 0, d[x][m] * F.col(f"n{x}{m}") / F.col(f"s{x}{m}")).otherwise(1.0)

    def p(x: str, m: int) -> Column:
        own = F.when(F.col(f"s{x}{m}") > 0, F.greatest(F.col(f"{x}{m}") - d[x][m], F.lit(0.0)) / F.col(f"s{x}{m}")).otherwise(0.0)
        return own + rest(x, m) * F.col(f"p{m}")

    def ratio(of, t: str, o: str, m: int) -> Column:
        known = F.col(f"{t}{m}") + F.col(f"{o}{m}") > 0
        return F.when(known, F.log(of("t", m) / of("o", m))).cast("float").alias("llr_apart" if m else "llr")

    low = F.col("gram").bitwiseAND((1 << 8 * (ORDER - 1)) - 1)
    known = grams.withColumn("low", low).withColumn("context", F.shiftright("gram", 8)).join(_shared_backoff(grams, scratch).withColumnRenamed("gram", "low"), "low").join(around, "context")
    known = known.select(F.col("gram").alias("key"), *(ratio(p, "t", "o", m) for m in _MODELS))
    unknown = around.select((F.col("context") + F.lit(_CONTEXT)).alias("key"), *(ratio(rest, "st", "so", m) for m in _MODELS))
    return scratch.table(known.unionByName(unknown), "model")


def _lookup(keys: np.ndarray, values: np.ndarray, gram: np.ndarray) -> np.ndarray:
    def find(k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
        return keys[at] == k, values[at]

    known, out = find(gram)
    other = np.flatnonzero(~known)
    has, value = find((gram[other] >> 8) + _CONTEXT)
    out = out.copy()
    out[other] = np.where(has, value, 0)
    return out


def _summaries(score: np.ndarray, size: np.ndarray, row: np.ndarray, rows: int) -> list[pa.Array]:
    """Per row: its TOP highest expression scores by each normalisation, the mean over all its bytes, and the logarithm of its number of words."""
    n = np.bincount(row, minlength=rows)
    begin = np.cumsum(n) - n
    out = []
    for power in POWERS:
        normal = score / size**power
        ranked = normal[np.lexsort((-normal, row))]
        for k in range(TOP):
            best = np.zeros(rows)
            best[n > k] = ranked[begin[n > k] + k]
            out.append(pa.array(best))
    return [*out, pa.array(np.bincount(row, score, rows) / np.maximum(np.bincount(row, size, rows), 1)), pa.array(np.log1p(n))]


FEATURES = [*(f"top{p}_{k}" for p in range(len(POWERS)) for k in range(TOP)), "mean", "words"]


def _features(shared):
    def run(batches):
        keys, values = shared.value
        for batch in batches:
            text = W.as_strings(batch.column(2))
            for a, b in W.chunks(text):
                data, start, end, row, h = _distinct_words(text[a:b])
                _, first, back = np.unique(h, return_index=True, return_inverse=True)
                gram, word = _grams(data, start[first], end[first])
                kinds, again = np.unique(gram, return_inverse=True)
                each = np.bincount(word, _lookup(keys, values, kinds)[again], len(first)) if len(keys) else np.zeros(len(first))
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], batch.column(1)[a:b], *_summaries(each[back], (end - start + 1).astype(float), row, b - a)], ["id", "of", *FEATURES])

    return run


def _row_words(batches):
    """(row, word) of the distinct words of each row."""
    for batch in batches:
        text = W.as_strings(batch.column(1))
        for a, b in W.chunks(text):
            _, _, _, row, h = _distinct_words(text[a:b])
            yield pa.RecordBatch.from_arrays([batch.column(0)[a:b].take(pa.array(row)), pa.array(h.view(np.int64))], ["row", "word"])


def _word_bytes(batches):
    """(word, bytes) of the distinct words of each batch of texts."""
    for batch in batches:
        text = W.as_strings(batch.column(0))
        for a, b in W.chunks(text):
            data, start, end, _, h = _distinct_words(text[a:b])
            h, first = np.unique(h, return_index=True)
            raw = data.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array([raw[x:y] for x, y in zip(start[first].tolist(), end[first].tolist(), strict=True)], pa.binary())], ["word", "bytes"])


def _word_grams(batches):
    for batch in batches:
        data, rows = W.text_bytes(batch.column(1))
        if len(data):
            gram, word = _grams(data, rows[:-1], rows[1:])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(word)), pa.array(gram)], ["word", "gram"])


def _word_scores(source: DataFrame, model: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, score, size, n): each distinct word's log-likelihood ratio and number of n-grams, and how many rows have it, at least."""
    words = source.select("text").mapInArrow(_word_bytes, "word long, bytes binary").groupBy("word").agg(F.first("bytes").alias("bytes"))
    grams = scratch.table(scratch.table(words, "words").mapInArrow(_word_grams, "word long, gram long"), "word-grams").withColumn("context", F.shiftright("gram", 8))
    # the first n-gram of a word says no more than its first byte: a few n-grams and contexts come with a large share of all words
    total = grams.count()

    def often(of: str, key: Column, llr: str) -> DataFrame:
        found = model.select(key.alias(of), F.col("llr").alias(llr))
        return scratch.table(found.join(grams.groupBy(of).agg(F.count("*").alias("n")), of), f"found-{of}")

    known = lookup(grams, often("gram", F.col("key"), "llr"), "gram", ["word"], total=total)
    known = lookup(known, often("context", F.col("key") - F.lit(_CONTEXT), "other"), "context", ["word", "gram"], total=total)
    return known.groupBy("word").agg(F.sum(F.coalesce("llr", "other", F.lit(0.0)).cast("double")).alias("score"), F.count("*").alias("size"))


def features(docs: DataFrame, id_col: str, text_col: str, model: DataFrame, entries: int, scratch: Scratch) -> DataFrame:
    """(id, of, *FEATURES) of every row; ``of`` is a hash of its text."""
    text = F.col(text_col).cast("string")
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("of"), text.alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    if entries <= BROADCAST_ENTRIES:
        rows = model.toArrow().sort_by("key")
        shared = docs.sparkSession.sparkContext.broadcast((rows.column("key").to_numpy(), rows.column("llr").to_numpy()))
        return source.mapInArrow(_features(shared), ", ".join([f"id {kind}, of long", *(f"{f} double" for f in FEATURES)]))
    scores = _word_scores(source, model, scratch)
    # equal texts have equal features: rows of one text are one until the end
    words = scratch.table(source.select("of", "text").mapInArrow(_row_words, "row long, word long"), "row-words")
    scores = scratch.table(scores.join(words.groupBy("word").agg(F.count("*").alias("n")), "word"), "scores")
    scored = lookup(words, scores, "word", ["row"], "inner")
    best = scored.groupBy("row").agg(F.collect_set(F.struct("word", "score", "size")).alias("w"))
    w = F.col("w")

    def normalised(power: float) -> Column:
        return F.sort_array(F.transform(w, lambda x: x["score"] / F.pow(x["size"], F.lit(power))), False)

    ranked = [normalised(p).alias(f"x{i}") for i, p in enumerate(POWERS)]
    total = lambda c: F.aggregate(w, F.lit(0.0), lambda acc, x: acc + x[c])
    best = best.select("row", *ranked, (total("score") / total("size")).alias("mean"), F.log1p(F.size(w).cast("double")).alias("words"))
    tops = [F.coalesce(F.get(f"x{i}", k), F.lit(0.0)).alias(f"top{i}_{k}") for i in range(len(POWERS)) for k in range(TOP)]
    best = best.select(F.col("row").alias("of"), *tops, "mean", "words")
    ids = source.select("id", "of")
    best = scratch.table(best.join(ids.groupBy("of").agg(F.count("*").alias("n")), "of"), "best")
    return lookup(ids, best, "of", ["id"]).select("id", "of", *FEATURES).na.fill(0.0, FEATURES)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights and intercept of a logistic regression, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        penalty = np.full(len(w), ridge)
        penalty[-1] = 1e-6
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 5, held_out: int = 0, calibration: int = 1) -> DataFrame:
    """One row per row of ``docs``: the id, held_out, score, predicted, of (the xxhash64 of its text), and the features.

    Rows fall into ``folds`` by crc32 of the id as text. Labels of fold ``held_out`` are never used; of those of fold
    ``calibration`` CALIBRATION_ROWS at most (those of smallest hashed id) calibrate as well as count.
    """
    scratch = Scratch(docs.sparkSession, "toxicity")
    fold = F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(folds))
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).where("id is not null and y is not null").groupBy("id").agg(F.max(F.col("y").cast("int")).alias("y"))
    marked = marked.withColumn("fold", fold).where(F.col("fold") != held_out)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sample = F.xxhash64("id")
    picked = scratch.table(marked.where(F.col("fold") == calibration).orderBy(sample, "id").limit(CALIBRATION_ROWS).select("id", F.lit(True).alias("apart")), "picked")
    # texts of the training folds only meet their labels, by a shuffle at every size
    trained = rows.where(fold != held_out).join(marked.join(picked, "id", "left").hint("merge"), "id")
    model = fit(trained, "text", "y", scratch, "apart")
    docs = docs.select(id_col, text_col)
    held = docs.join(picked.select(F.col("id").alias(id_col)), id_col, "left_semi")
    without = model.where("llr_apart is not null").select("key", F.col("llr_apart").alias("llr"))
    tried = scratch.table(features(held, id_col, text_col, without, without.count(), scratch), "tried")
    known = scratch.table(features(docs, id_col, text_col, model.select("key", "llr"), model.count(), scratch), "features")
    scratch.keep_only(known, tried)
    one = tried.groupBy("id").agg(F.min(F.struct("of", *FEATURES)).alias("f")).select("id", "f.*")
    fitted = one.join(marked.select("id", "y"), "id").orderBy("id").select(*FEATURES, "y").toPandas()
    y = fitted["y"].to_numpy(float)
    if len(y) and 0 < y.sum() < len(y):
        *w, bias = (float(v) for v in _logistic(fitted[FEATURES].to_numpy(float), y))
    else:
        w, bias = [0.0] * len(FEATURES), float(np.log((y.sum() + 1e-9) / (len(y) - y.sum() + 1e-9))) if len(y) else -30.0
    logit = sum((F.col(f) * v for f, v in zip(FEATURES, w, strict=True)), F.lit(bias))
    scored = known.withColumn("score", 1 / (1 + F.exp(-F.least(F.greatest(logit, F.lit(-30.0)), F.lit(30.0)))))
    out = scored.select("id", F.coalesce(fold == held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "of", *FEATURES)
    return out.withColumnRenamed("id", id_col)
