"""One registered query per operator, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reeltide.llm import bin_packing, bit_sliced, collocations, kneser_ney, mixing, ngram_join, packing, pii, pivot_index, span_dedup, spelling, tag_paths, warc

TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(_table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_bit_sliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_sliced.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0).drop("query_row")


def op4_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = bin_packing.shard(_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op5_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_index.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op3_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = span_dedup.remove_repeated_spans(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "text", "sentences_removed", "words_removed")


def op7_tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_paths.extract(_table(spark, sf_dir, "pages"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_mix(_table(spark, sf_dir, "documents"))
    return plan.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op9_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = kneser_ney.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(_table(spark, sf_dir, "documents"), words=4, num=85)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.personal_data(_table(spark, sf_dir, "documents")))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_warc, op2_bit_sliced_topk, op3_curve_packing, op4_bin_packing, op5_pivot_index, op6_span_dedup, op7_tag_paths, op8_source_mixing, op9_kneser_ney, op10_ngram_join, op11_collocations, op12_pii, op13_spelling_variants)}
# Where SQL can express an operator; the others are tested against plain versions.
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

_LINKED = """
reach AS (SELECT id AS a, id AS b FROM nodes UNION SELECT r.a, l.v FROM reach r JOIN links l ON l.u = r.b),
parts AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a)
"""

#: The letters beyond ASCII, and a byte for each, as edit distances are counted in bytes here.
_WIDE = "".join(map(chr, range(0xC0, 0x100)))
_BYTES = "".join(c for c in map(chr, range(33, 127)) if not c.islower() and c != "'")[: len(_WIDE)]

ORACLE_SQL: dict[str, str] = {
    "op1_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS digest FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS last, list_transform(range(1, 41), lambda i: strpos('0123456789abcdef', substring(digest, CAST(i AS INT), 1)) - 1) AS h FROM d)
SELECT page_id, payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda k: substring('{_BASE32}', CAST(1 + list_sum(list_transform(range(0, 5), lambda j: (h[CAST((5 * k + j) // 4 + 1 AS INT)] // CAST(power(2, 3 - (5 * k + j) % 4) AS BIGINT) % 2) * CAST(power(2, 4 - j) AS BIGINT))) AS INT), 1)), '') AS payload_digest,
    CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id < last THEN last END AS refers_to FROM g""",
    "op2_bit_sliced_topk": """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS query_row, a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""",
    "op5_pivot_index": """
WITH RECURSIVE nodes AS (SELECT vec_id AS id FROM embeddings),
v AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
w AS (SELECT id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v),
links AS (SELECT a.id AS u, b.id AS v FROM w a JOIN w b ON a.label = b.label AND a.id <> b.id AND len(a.e) = len(b.e) WHERE a.norm > 0 AND b.norm > 0 AND list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2])) / (a.norm * b.norm) >= 0.93),
"""
    + _LINKED
    + """
SELECT p.id AS vec_id, (SELECT count(*) FROM links l WHERE l.u = p.id) AS n_links, p.component_id, p.id = p.component_id AS kept FROM parts p""",
    "op8_source_mixing": r"""
WITH d AS (SELECT doc_id, text, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, (CAST('0x' || substring(md5(CAST(doc_id AS VARCHAR) || '-0'), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u,
    CASE WHEN length(text) > 0 THEN CAST(length(translate(text, '#$%&*|<>{}[]=_~^\', '')) AS DOUBLE) / length(text) END AS clean FROM documents),
k AS (SELECT doc_id, source, size, -ln(u) / CASE WHEN clean > 0.001 THEN clean ELSE 0.001::DOUBLE END AS key FROM d),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, ([3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM k GROUP BY source),
s1 AS (SELECT *, 2.0::DOUBLE * source_size AS full_, 2.0::DOUBLE * source_size / w AS full_at FROM s0),
s2 AS (SELECT *, 1.5::DOUBLE * (SELECT sum(source_size) FROM s0) AS budget, coalesce(sum(full_) OVER (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent, sum(w) OVER (ORDER BY full_at, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_w FROM s1),
s3 AS (SELECT *, max(CASE WHEN (budget - spent) / left_w <= full_at THEN (budget - spent) / left_w END) OVER () AS level FROM s2),
s4 AS (SELECT source, source_size, coalesce(least(full_, level * w), full_) AS target FROM s3),
s5 AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM s4),
r AS (SELECT k.doc_id, k.size, s.source_size, s.target, s.epochs, CAST(greatest(round(s.target - s.epochs * s.source_size), 0) AS BIGINT) AS rest, coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior
    FROM k JOIN s5 s ON s.source IS NOT DISTINCT FROM k.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(epochs * size + least(greatest(rest - prior, 0), size) AS BIGINT) AS taken FROM r""",
    "op10_ngram_join": r"""
WITH RECURSIVE nodes AS (SELECT doc_id AS id FROM documents),
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0) q),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT u, v FROM both_ JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * c >= 85 * (a.n + b.n - c)),
"""
    + _LINKED
    + """
SELECT p.id AS doc_id, coalesce(n.n, 0) AS n_shingles, p.component_id FROM parts p LEFT JOIN n ON n.doc_id = p.id""",
    "op11_collocations": r"""
WITH t AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(regexp_extract_all(text, '[^.,;:!?\x0A-\x0D]+')), '[^\x20\x09]+') AS w FROM t),
g AS (SELECT lang, array_to_string(w[i : i + k - 1], ' ') AS phrase, k FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (SELECT unnest([1, 2, 3, 4]) AS k) q) q),
f AS MATERIALIZED (SELECT lang, phrase, k, count(*) AS f FROM g GROUP BY lang, phrase, k HAVING k = 1 OR count(*) >= 30),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, phrase, string_split(phrase, ' ') AS w, k, f FROM f WHERE k > 1),
x AS MATERIALIZED (SELECT lang, phrase, f AS a, cut, array_to_string(w[1 : cut], ' ') AS first_, array_to_string(w[cut + 1 : k], ' ') AS rest FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) q),
s AS (SELECT x.*, l.f AS l, r.f AS r, (2000000 * CAST(x.a AS HUGEINT)) // (CAST(l.f AS HUGEINT) + r.f) AS score FROM x JOIN f l ON l.lang = x.lang AND l.phrase = x.first_ JOIN f r ON r.lang = x.lang AND r.phrase = x.rest),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS q FROM s),
inner_ AS (SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, f FROM (SELECT lang, w, k, f, m, unnest(range(1, k - m + 2)) AS i FROM c, (SELECT unnest([2, 3]) AS m) q WHERE m < k) q),
longer AS (SELECT lang, phrase, max(f) AS f FROM inner_ GROUP BY lang, phrase),
kept AS (SELECT b.* FROM b LEFT JOIN longer x ON x.lang = b.lang AND x.phrase = b.phrase WHERE b.q = 1 AND (x.f IS NULL OR 100 * CAST(x.f AS HUGEINT) < 80 * CAST(b.a AS HUGEINT))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, n.n, CAST(r.score AS BIGINT) AS score FROM ranked r JOIN n ON n.lang = r.lang WHERE r.rank <= 2000""",
    "op13_spelling_variants": rf"""
WITH RECURSIVE crcs AS (SELECT list_transform(range(0, 256), lambda i: list_reduce(list_prepend(CAST(i AS BIGINT), range(0, 8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]{{7,}}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r FROM documents),
d AS (SELECT r, hex(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || r) AS b, count(*) AS n FROM runs GROUP BY ALL),
h AS (SELECT r, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, 1 + length(b) // 2), lambda i: CAST(CAST('0x' || substring(b, CAST(2 * i - 1 AS INT), 2) AS INT) AS BIGINT))), lambda c, x: xor(c >> 8, t[CAST(xor(c & 255, x) + 1 AS INT)])), 4294967295) AS h FROM d, crcs),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT n, CASE WHEN h % 31 = 0 THEN substring(r, 1, h % length(r)) || substring(r, h % length(r) + 2) ELSE r END AS word FROM h) q WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
v AS (SELECT word, n, word AS v FROM w UNION SELECT word, n, substring(word, 1, i - 1) || substring(word, i + 1) FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w) q),
near AS (SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n FROM v a JOIN v b ON a.v = b.v AND a.word <> b.word WHERE levenshtein(translate(a.word, '{_WIDE}', '{_BYTES}'), translate(b.word, '{_WIDE}', '{_BYTES}')) = 1),
best AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS r, count(*) OVER (PARTITION BY word) AS n_near FROM near),
f AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 10 * w.n THEN b.near END AS form, CASE WHEN b.near_n >= 10 * w.n THEN b.near_n END AS form_n FROM w LEFT JOIN best b ON b.word = w.word AND b.r = 1),
up AS (SELECT word, word AS at FROM f UNION ALL SELECT up.word, f.form FROM up JOIN f ON f.word = up.at WHERE f.form IS NOT NULL)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, up.at AS root FROM f JOIN up ON up.word = f.word JOIN f AS last ON last.word = up.at WHERE last.form IS NULL""",
}
