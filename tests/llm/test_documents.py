"""The operators over documents against plain versions and in edge cases."""

import random
import zlib
from collections import defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from tests.llm.brute import WORD, Union, repeated_words, shingles, similar_groups, without_repeats
from tokenizers import Tokenizer

from reeltide.llm import bin_packing, graph, kneser_ney, mixing, ngram_join, packing, span_dedup
from reeltide.llm import wordhash as W
from reeltide.llm.scratch import Scratch

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("k,num", [(4, 85), (5, 80), (2, 60)])
def test_ngram_groups(documents, corpus, k, num):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(documents, words=k, num=num).collect()}
    groups = similar_groups(corpus, k, num)
    assert got == {i: (len(shingles(t, k)), groups[i]) for i, t in corpus}


def test_ngram_groups_by_combinations(documents, corpus, monkeypatch):
    """With hardly any rare tokens and small blocks, everything goes by pairs of frequent tokens and by pairs of blocks."""
    for name, value in (("RARE", 1), ("LIST_BLOCK", 7), ("LIST_ROWS", 300), ("_PAIRS", 50), ("BUCKET_TOKENS", 500), ("_SKETCHES", 1)):
        monkeypatch.setattr(ngram_join, name, value)
    got = {r.doc_id: r.component_id for r in ngram_join.ngram_components(documents, words=4, num=85).collect()}
    assert got == similar_groups(corpus, 4, 85)


def test_ngram_groups_of_chains_and_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(100))
    chain = [(i, " ".join(f"w{j}" for j in range(i, i + 100))) for i in range(0, 60, 3)]
    rows = [(1000, text), (1000, "x y z a b"), (5000, "x y z a b"), (None, text), (7, None), (7, None)] + chain
    got = sorted((r.doc_id, r.component_id) for r in ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id long, text string"), words=4, num=85).where("doc_id is not null").collect())
    union = Union()
    for i, _ in chain:
        union.join(0, i)
    union.join(1000, 0)
    union.join(5000, 1000)
    assert got == sorted((i, union.find(i)) for i, _ in rows if i is not None)


def test_components_of_a_long_path(spark):
    edges = spark.range(300).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v")).union(spark.createDataFrame([(900, 901), (901, 900), (77, 77)], "u long, v long"))
    got = {r.node: r.component for r in graph.connected_components(edges, Scratch(spark, "test")).collect()}
    assert got == {**{i: 0 for i in range(301)}, 900: 900, 901: 900}


@cache
def _rank(word):
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(W.mix(W.span_hashes(raw, np.array([0]), np.array([len(raw)])))[0])


def test_spans(documents, corpus):
    got = {r.doc_id: (r.text, r.sentences_removed) for r in span_dedup.remove_repeated_spans(documents).collect()}
    want = without_repeats(corpus, _rank)
    assert got.pop(310) == (None, 0)
    want.pop(310)
    assert got == want
    assert sum(n > 0 for _, n in want.values()) > 20


def test_spans_against_all_repeated_words(spark):
    """Passages that begin and end within sentences, some without punctuation, among clean texts: all found, and nothing else touched."""
    rng = np.random.default_rng(3)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 3000, n)]

    def prose(n, stops):
        w = word(n)
        for k in np.cumsum(rng.integers(5, 25, n)):
            if stops and k < n:
                w[k] += "."
        return w

    rows = []
    for k in range(12):
        stops = k % 3 > 0
        passage = prose(int(rng.integers(60, 90)), stops)
        for j in range(3):
            rows.append((100 * k + j, " ".join(prose(int(rng.integers(3, 120)), stops) + passage + prose(int(rng.integers(3, 120)), stops))))
    rows += [(5000 + k, " ".join(prose(300, k % 2 == 0))) for k in range(30)]
    out = {r.doc_id: r for r in span_dedup.remove_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    covered = repeated_words(rows)
    assert {i for i, r in out.items() if r.sentences_removed} == set(covered)
    assert all(r.words_removed <= len(covered[i]) for i, r in out.items() if i in covered)


def test_spans_of_few_sentences(spark):
    """Runs of three sentences go wherever they aren't first, however short the passage; two sentences and few words stay."""
    tell = lambda tag, n, k: " ".join(" ".join(f"{tag}{j}x{i}" for i in range(k)) + "." for j in range(n))
    uneven = " ".join(tell(f"uneven{k}", 1, k) for k in (2, 16, 3))
    rows = [(i, f"{tell(f'a{i}', 2, 9)} {tell('five', 5, 9)} {tell(f'b{i}', 2, 9)}") for i in range(20)]
    rows += [(100 + i, f"{tell('two', 2, 12)} {tell(f'c{i}', 3, 9)}") for i in range(5)]
    rows += [(200 + i, f"{tell('few', 3, 6)} {tell(f'd{i}', 3, 9)}") for i in range(5)]
    rows += [(300, f"{tell('own', 3, 7)} {tell('e', 2, 9)} {tell('own', 3, 7)}"), (301, uneven), (302, f"Other words here. {uneven}")]
    got = {r.doc_id: (r.text, r.sentences_removed) for r in span_dedup.remove_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i][1] for i in range(20)] == [0] + [5] * 19 and all("five" not in got[i][0] and f"b{i}1x8" in got[i][0] for i in range(1, 20))
    assert all(got[i][1] == 0 for i in got if 100 <= i < 300)
    assert got[300][1] == 3 and got[301][1] == 0 and got[302] == ("Other words here. ", 3)
    with pytest.raises(ValueError, match="stretch"):
        span_dedup.remove_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string"), least_words=60)


def test_spans_of_one_word(spark):
    rows = [(1, "and " * 400), (2, "and " * 300), (3, "x")]
    got = {r.doc_id: r.words_removed for r in span_dedup.remove_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[2] == 300 and got[3] == 0


def test_spans_keep_other_columns_and_clean_documents(spark, documents):
    out = span_dedup.remove_repeated_spans(documents)
    assert out.columns == [*documents.columns, "sentences_removed", "words_removed"]
    assert out.where("sentences_removed = 0").select(documents.columns).exceptAll(documents).isEmpty()


def test_spans_of_null_and_repeated_ids(spark):
    passage = " ".join(f"shared{i} of every one of them is here." for i in range(8))
    own = [" ".join(f"own{k} sentence{j} differs from all the others in here." for j in range(1 + k % 3)) for k in range(9)]
    ids = [None, None, None, None, 5, 5, 5, 5, 9]
    rows = [(i, f"{o}\n{passage}" if k % 4 else o) for k, (i, o) in enumerate(zip(ids, own, strict=True))]
    rows += [(7, f"{passage}\nleft{k} alone."[: None if k else len(passage)]) for k in range(3)]  # the same run at the same place
    got = [(r.doc_id, r.text) for r in span_dedup.remove_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert len(got) == len(rows)
    assert [i for i, t in got if passage in t] == [None] and sum("shared" in t for _, t in got) == 1
    bare = lambda t: t.replace(passage, "").strip()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((i, bare(t)) for i, t in got), key=key) == sorted(((i, bare(t)) for i, t in rows), key=key)


def test_mixing(documents, corpus):
    plan = mixing.plan_mix(documents).collect()
    size = {i: len(WORD.findall(t or "")) for i, t in corpus}
    assert {r.id: r["size"] for r in plan} == size
    by = defaultdict(list)
    for r in plan:
        by[r.source].append(r)
    total = sum(size.values())
    sources = sorted(by, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sources)}
    own = {s: sum(r["size"] for r in by[s]) for s in sources}
    target, open_ = {}, set(sources)
    while open_:  # deal by weight; what is over a source's double is dealt again
        level = (1.5 * total - sum(target.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * own[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 2.0 * own[s] for s in full}
        open_ -= full
    for s, rows in by.items():
        assert all(abs(r.target - target[s]) < 1e-6 and r.source_size == own[s] for r in rows)
        assert abs(sum(r.taken for r in rows) - target[s]) <= 1
        epochs = int(target[s] // own[s])
        assert all(epochs * r["size"] <= r.taken <= min(epochs + 1, 2) * r["size"] for r in rows)
        assert sum(0 < r.taken - epochs * r["size"] < r["size"] for r in rows) <= 1
    again = mixing.plan_mix(documents.repartition(7)).collect()
    assert sorted((r.id, r.taken) for r in again) == sorted((r.id, r.taken) for r in plan)


def test_mixed_documents_hold_the_planned_words(documents):
    plan = {r.id: r.taken for r in mixing.plan_mix(documents).collect()}
    mixed = mixing.mixed_documents(documents)
    assert mixed.columns == documents.columns
    words = defaultdict(int)
    for r in mixed.collect():
        words[r.doc_id] += len(WORD.findall(r.text or ""))
    assert {i: n for i, n in plan.items() if n} == {i: n for i, n in words.items() if n}


def test_quality_decides_who_comes_early(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"), (F.col("id") % 2).alias("good"))
    taken = mixing.plan_mix(df, share=0.5, quality=F.col("good") * 9 + 1).join(df.select(F.col("doc_id").alias("id"), "good"), "id").groupBy("good").agg(F.sum("taken").alias("n")).collect()
    n = {r.good: r.n for r in taken}
    assert n[0] + n[1] == 6000 and n[1] > 3 * n[0]


def test_packing_round_trip(documents, corpus):
    pieces = packing.pack(documents, PATH, length=256).collect()
    whole = Tokenizer.from_file(PATH)
    want = {i: whole.encode(t or "", add_special_tokens=False).ids + [2] for i, t in corpus}
    got, lines = defaultdict(list), defaultdict(list)
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert p.start == len(got[p.doc_id]) and p.length == len(ids) and p.doc_tokens == len(want[p.doc_id])
        got[p.doc_id] += ids
        lines[p.sequence_id].append((p.offset, p.length))
    assert got == want
    lengths = []
    for k in sorted(lines):
        at = 0
        for offset, n in sorted(lines[k]):
            assert offset == at
            at += n
        lengths.append(at)
    assert sorted(lines) == list(range(len(lines)))
    assert all(n <= 256 and n & (n - 1) == 0 for n in lengths)


def test_packing_of_odd_texts(spark):
    texts = ["İstanbul ΑΣ Σ ς", "a<|endoftext|>b", "don't 'tis ''s !'s", "x²³ ½ ¼½", "日本語 テキスト", "á é", "\x0b\x0c\x1c\x85\xa0", "ªº ǅ ß STRASSE", "", None, "tabs\tand\r\nlines", "1234567 12ab34", "…—“quoted”", "naïve café's"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = Tokenizer.from_file(PATH)
    got = defaultdict(list)
    for p in sorted(packing.pack(df, PATH).collect(), key=lambda p: (p.doc_id, p.start)):
        got[p.doc_id] += np.frombuffer(p.ids, "<u4").tolist()
    assert got == {i: whole.encode(t or "", add_special_tokens=False).ids + [2] for i, t in enumerate(texts)}


def test_hilbert_neighbours():
    x = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    key = packing.hilbert_keys(x, 3)
    assert sorted(key.tolist()) == list(range(512)) and np.abs(np.diff(x[np.argsort(key)], axis=0)).sum(1).max() == 1


def test_sharding(spark, documents, corpus):
    rows = bin_packing.shard(documents).collect()
    text = dict(corpus)
    assert all(r["size"] == len((text[r.doc_id] or "").encode()) + 1 and r.text_crc32 == zlib.crc32((text[r.doc_id] or "").encode()) for r in rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(8))
    assert len({r.shard for r in rows if 300 <= r.doc_id < 305}) == 1
    many = spark.range(30000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same text").otherwise(F.concat(F.lit("t "), F.repeat(F.lit("xy "), (F.col("id") % 50).cast("int")), F.col("id").cast("string"))).alias("text"))
    size = bin_packing.shard(many).groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    b = [r.b for r in size]
    assert len(b) == 8 and (max(b) - min(b)) / (sum(b) / 8) < 0.005


def test_sharding_in_hundreds_of_packs(spark, monkeypatch):
    monkeypatch.setattr(bin_packing, "PACK_GROUPS", 100)
    k = F.pmod(F.xxhash64("id"), F.lit(50)).cast("int")
    many = spark.range(30000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.repeat(F.lit("the same text "), 6)).otherwise(F.concat(F.lit("t "), F.repeat(F.lit("xy "), k), F.col("id").cast("string"))).alias("text"))
    size = bin_packing.shard(many).groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    for x in ([r.b for r in size], [r.n for r in size]):
        assert len(x) == 8 and (max(x) - min(x)) / (sum(x) / 8) < 0.02


def test_sharding_keeps_groups_that_fit_whole(spark):
    text = F.when(F.col("id") < 1000, F.concat(F.lit("copied "), (F.col("id") % 50).cast("string"))).when(F.col("id") < 1800, F.lit("tenth of all rows")).otherwise(F.concat(F.lit("a text alone "), F.col("id").cast("string")))
    rows = bin_packing.shard(spark.range(8000).select(F.col("id").alias("doc_id"), text.alias("text"))).collect()
    homes, size = defaultdict(set), defaultdict(int)
    for r in rows:
        size[r.shard] += r["size"]
        if r.doc_id < 1800:
            homes[r.text_crc32].add(r.shard)
    assert len(homes) == 51 and all(len(s) == 1 for s in homes.values())
    assert len(size) == 8 and max(size.values()) - min(size.values()) < 0.01 * sum(size.values()) / 8


def test_sharding_is_greedy_by_the_dot_product(spark):
    """Few large groups go, largest first, where their size and the room left agree most, so that no shard ends far above the others."""
    rows = [(i, f"t{i} " + "word " * (40 + 7 * i)) for i in range(64)]
    placed = bin_packing.shard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    size = {r.doc_id: r.size for r in placed}
    used = [0] * 8
    for r in placed:
        used[r.shard] += r.size
    assert all(size[i] == len(t.encode()) + 1 for i, t in rows) and max(used) - min(used) <= max(size.values())
    alike = spark.createDataFrame(rows + [(1000 + i, rows[i % 4][1]) for i in range(40)], "doc_id long, text string")
    shards = defaultdict(set)
    text = dict(rows + [(1000 + i, rows[i % 4][1]) for i in range(40)])
    for r in bin_packing.shard(alike).collect():
        shards[text[r.doc_id]].add(r.shard)
    assert sum(len(s) > 1 for s in shards.values()) <= 4


def test_toxicity_held_out(spark, tmp_path, monkeypatch):
    import random

    rng = random.Random(3)
    plain = [f"{a}{b}{c}" for a in "ba ce di fo".split() for b in "ta ve xi po".split() for c in "n s r l".split()]
    stems = ["grotz", "vilmuk"]
    rows, labels = [], []
    for i in range(1200):
        bad = i % 6 == 0
        words = [rng.choice(plain) for _ in range(rng.randint(5, 80))]
        if bad:
            words[rng.randrange(len(words))] = rng.choice(stems) + rng.choice(plain)[:3]
        rows.append((i, " ".join(words)))
        if i % 10 != 9:
            labels.append((i, int(bad)))
    rows += [(5000, None), (5001, ""), (5002, "grotzing " * 3), (5003, "bataN")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels + [(3, None), (None, 1)], "doc_id long, toxic int")
    scored = {r.doc_id: r for r in kneser_ney.toxicity(docs, marks).collect()}
    assert len(scored) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in scored.items())
    held = [(scored[i].predicted, int(i % 6 == 0)) for i in range(1200) if scored[i].held_out]
    assert sum(p == y for p, y in held) / len(held) > 0.97
    assert scored[5002].predicted == 1 and scored[5000].score == scored[5001].score < 0.5
    monkeypatch.setattr(kneser_ney, "BROADCAST_ENTRIES", 0)  # the joined way gives the same
    joined = {r.doc_id: r.score for r in kneser_ney.toxicity(docs, marks).collect()}
    assert all(abs(joined[i] - r.score) < 1e-6 for i, r in scored.items())


def test_toxicity_of_repeated_and_null_ids(spark, monkeypatch):
    """Each row is scored by its own text, whichever way the model goes to the documents."""
    rows = [(i, f"mild words number{i % 7} here" + (" grotzen" if i % 4 == 0 else "")) for i in range(400)]
    odd = [(5000, "grotzen grotzen"), (5000, "mild words"), (5000, "mild words"), (None, "grotzen now"), (None, "mild here"), (5000, None), (None, None)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")

    def run():
        return sorted(((r.doc_id or -1, r.of or 0, r.predicted), round(r.score, 6)) for r in kneser_ney.toxicity(docs, marks).collect() if r.doc_id is None or r.doc_id == 5000)

    sent = run()
    assert len(sent) == len(odd) and sum(p for (_, _, p), _ in sent) == 2
    monkeypatch.setattr(kneser_ney, "BROADCAST_ENTRIES", 0)
    assert run() == sent


def test_model_against_plain_kneser_ney(spark):
    """Ratios of a few n-grams by the definition, over sets of words of documents."""
    from collections import Counter

    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcd"), 5)) for _ in range(30)]
    rows = [(i, " ".join(rng.choice(words, 6)), int(i % 3 == 0)) for i in range(60)]
    n = kneser_ney.ORDER
    counts = [Counter(), Counter()]
    for _, text, toxic in rows:
        for w in set(text.split()):
            padded = " " * (n - 1) + w + " "
            counts[toxic].update(padded[k : k + n] for k in range(len(w) + 1))
    discount = lambda c: min(0.95, max(0.1, (o := sum(x == 1 for x in c.values())) / (o + 2 * sum(x == 2 for x in c.values())))) if any(x == 1 for x in c.values()) else 0.5
    grams = set(counts[0]) | set(counts[1])
    levels = {}
    above = grams
    for k in range(n - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in above)
        above = set(levels[k])

    def low(g):
        if not g:
            return 1 / 256
        c, d = levels[len(g)], discount(levels[len(g)])
        around = [x for h, x in c.items() if h[:-1] == g[:-1]]
        return (max(c[g] - d, 0) + d * len(around) * low(g[1:])) / sum(around)

    def p(g, c):
        d, around = discount(c), [x for h, x in c.items() if h[:-1] == g[:-1]]
        s = sum(around)
        return (max(c[g] - d, 0) / s if s else 0) + (d * len(around) / s if s else 1) * low(g[1:])

    scratch = Scratch(spark, "test")
    model = {r.key: r.llr for r in kneser_ney.fit(spark.createDataFrame(rows, "id long, text string, y int"), "text", "y", scratch).collect()}
    for g in sorted(grams):
        key = int.from_bytes(g.encode(), "big")
        assert abs(model[key] - np.log(p(g, counts[1]) / p(g, counts[0]))) < 1e-4, g


def test_mixed_documents_keep_their_white_space(spark):
    rows = [(i, f"a{i}  b\n\nc\td e f g h", "s", i, f"m{i}", 0) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_part int, mix string, mix_id int")
    out = mixing.mixed_documents(df, share=0.5).collect()
    assert sum(len(r.text.split()) for r in out) == 20 and all(rows[r.doc_id][1].startswith(r.text) and r.mix == f"m{r.doc_id}" for r in out)
    again = spark.createDataFrame([(1, "x y z", "s")] * 40, "doc_id long, text string, source string")
    assert mixing.plan_mix(again).agg(F.sum("taken")).first()[0] == 180


def test_two_models_in_one_pass(spark):
    """The second ratio is that of a model which never saw the rows apart."""
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcdef"), 4)) for _ in range(60)]
    rows = [(" ".join(rng.choice(words, 5)), int(i % 3 == 0), i % 4 == 1) for i in range(80)]
    scratch = Scratch(spark, "test")
    whole = kneser_ney.fit(spark.createDataFrame(rows, "text string, y int, apart boolean"), "text", "y", scratch, "apart").collect()
    for mark, column in ((True, "llr"), (False, "llr_apart")):
        alone = kneser_ney.fit(spark.createDataFrame([r[:2] for r in rows if mark or not r[2]], "text string, y int"), "text", "y", scratch)
        want = {r.key: r.llr for r in alone.collect()}
        got = {r.key: r[column] for r in whole if r[column] is not None}
        assert got.keys() == want.keys() and all(abs(got[k] - x) < 1e-5 for k, x in want.items())
    assert any(r.llr_apart is None for r in whole)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    r = kneser_ney.toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int")).first()
    assert r.predicted == 0 and r.score < 0.01


def test_tokenizers_of_other_settings(tmp_path):
    """A file that says otherwise of its texts is taken at its word."""
    import json

    said = json.loads(open(PATH, encoding="utf-8").read())
    assert packing.WordTokenizer(PATH).by_words
    said["normalizer"]["normalizers"].pop()  # no lower case
    other = tmp_path / "other.json"
    other.write_text(json.dumps(said), encoding="utf-8")
    texts = ["Some Words, and MORE", "", "it's  9"]
    tokens = packing.WordTokenizer(str(other))
    assert not tokens.by_words and [c.tolist() for c in tokens.encode(texts)] == [Tokenizer.from_file(str(other)).encode(x, add_special_tokens=False).ids for x in texts]


def test_order_along_the_curve():
    """Each step of the curve goes to a neighbouring cell, in any number of dimensions, and every cell is met once."""
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij")).reshape(dims, -1).T
        keys = packing.hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def test_packing_lays_documents_in_order(documents):
    """Sequences hold the documents along the curve, as a plain sort by place lays them."""
    pieces = packing.pack(documents, PATH).collect()
    whole = {r.doc_id: b"".join(x.ids for x in sorted((x for x in pieces if x.doc_id == r.doc_id), key=lambda x: x.start)) for r in pieces}
    places = {}
    for i, ids in whole.items():
        flat = np.frombuffer(ids, "<u4").astype(np.int64)
        places[i] = int(packing.curve_places(flat, np.zeros(len(flat), np.int64), 1, 0)[0])
    order = [r.doc_id for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset))]
    order = list(dict.fromkeys(order))
    assert [places[i] for i in order] == sorted(places.values())


def test_empty_tables(spark, documents):
    none = documents.limit(0)
    assert ngram_join.ngram_components(none).isEmpty()
    assert span_dedup.remove_repeated_spans(none).isEmpty()
    assert mixing.plan_mix(none).isEmpty() and mixing.mixed_documents(none).isEmpty()
    assert packing.pack(none, PATH).isEmpty()
    assert bin_packing.shard(none).isEmpty()
    assert kneser_ney.toxicity(none, spark.createDataFrame([], "doc_id long, toxic int")).isEmpty()


def test_scratch_keeps_what_is_read(spark):
    from py4j.protocol import Py4JJavaError
    from pyspark.errors import PySparkException

    scratch = Scratch(spark, "test")
    a = scratch.table(spark.range(5).toDF("x"))
    b = scratch.table(a.selectExpr("x + 1 as x"))
    scratch.keep_only(b)
    assert b.count() == 5
    with pytest.raises((PySparkException, Py4JJavaError)):
        a.count()


def test_ranges_are_laid_batch_by_batch(spark, documents, monkeypatch):
    """A range of any size: pieces leave with the batch that they came in, and ranges that share a task follow one another."""
    packer, read = zstandard.ZstdCompressor(level=1), []
    parts = [5] * 30 + [2] * 10  # batches of two ranges, as they come to one task

    def batches():
        for k, part in enumerate(parts):
            read.append(k)
            tokens = [np.full(700, k, "<u2"), np.full(300, k, "<u2")]
            yield pa.RecordBatch.from_arrays([pa.array([2 * k, 2 * k + 1]), pa.array([700, 300]), pa.array([packer.compress(t.tobytes()) for t in tokens]), pa.array([part, part])], ["id", "n", "packed", "part"])

    out, line = packing._lay(np.array([0, 0, 30_000, 0, 0, 0]), 40_000, 256, 2)(batches()), []
    for k, batch in enumerate(out):
        assert len(read) == k + 1 and set(batch.column("id").to_pylist()) == {2 * k, 2 * k + 1}
        line += [(r["sequence_id"], r["offset"], r["length"], np.frombuffer(r["ids"], "<u4").tolist() == [k] * r["length"]) for r in batch.to_pylist()]
    assert len(read) == 40 and sum(r[2] for r in line) == 40_000 and all(r[3] for r in line)
    for a, b in zip(line, line[1:], strict=False):
        assert b[:2] == (a[0], a[1] + a[2]) or (b[:2] == (a[0] + 1, 0) and a[1] + a[2] in (256, 64))
    whole = sorted(packing.pack(documents, PATH).collect(), key=str)
    monkeypatch.setattr(packing, "RANGE_TOKENS", 3000)
    assert sorted(packing.pack(documents, PATH).collect(), key=str) == whole


def _plain_texts(rng, n):
    """Texts of letters, numbers and signs of one and two bytes, many apostrophes among them."""
    signs = "abcstredvmlSTREVLDM'''' \t\n\r.,!?-0129²½ªµº×÷éÉßÿĀŉžƁǅȺɎ¡¿­<|~"
    return ["".join(rng.choice(signs) for _ in range(rng.randint(0, 25))) for _ in range(n)]


@pytest.mark.parametrize("case", ["all kept", "few kept", "few bytes kept", "hashes collide"])
def test_pieces_cut_in_bulk_are_the_tokenizers(monkeypatch, case):
    if case == "few kept":
        monkeypatch.setattr(packing, "_REMEMBERED", 300)
    elif case == "few bytes kept":
        monkeypatch.setattr(packing, "_REMEMBERED_BYTES", 2000)
    elif case == "hashes collide":
        hashes = W.span_hashes
        monkeypatch.setattr(W, "span_hashes", lambda *a: hashes(*a) % np.uint64(50))
    rng, whole, tokens = random.Random(5), Tokenizer.from_file(PATH), packing.WordTokenizer(PATH)
    signs = [chr(c) for c in range(0x250) if packing._PLAIN.fullmatch(chr(c))]
    odd = ["", " \t\n", "'", "'s", "'r", "'re", "'rex 'v've'll'l l'", "it's O'Dea's we'Re I'M '9 'st", "'ll'd't", "x' s", "r'e", "''s !'s 'É's"]
    odd += [t for c in signs for t in (c, f"a{c}b", f"1{c}2", f".{c}.", f"'{c}", f"s'{c}x", f"{c}'s", c * 3)]
    assert tokens.encode([]) == []
    for texts in (odd, ["'", "s"], ["don'", "t"], ["'l", "l"], ["", "x", ""], *(_plain_texts(rng, 200) for _ in range(20))):
        assert [c.tolist() for c in tokens.encode(texts)] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_no_piece_is_tokenised_twice_while_memory_holds_them(monkeypatch):
    """What is remembered is pieces, not the many words that they make up."""
    monkeypatch.setattr(packing, "_REMEMBERED", 3100)
    stems = [f"{a}{b}{c}" for a in ("ba", "ce", "di", "fo", "gu", "la") for b in "abcdefghijklmnopqrst" for c in "abcdefghijklmnopqrstuvwxy"]
    chunks = [[" ".join(f"{s}{e}" for s in stems[i : i + 500]) for e in (",", ".", "!", "'s", "; ", "#", "") * 2] for i in range(0, 3000, 500)]
    whole, tokens = Tokenizer.from_file(PATH), packing.WordTokenizer(PATH)
    want = [[whole.encode(t, add_special_tokens=False).ids for t in c] for c in chunks]
    assert [[x.tolist() for x in tokens.encode(c)] for c in chunks] == want
    tokens.whole = tokens.model = None
    assert [[x.tolist() for x in tokens.encode(c)] for c in chunks] == want
