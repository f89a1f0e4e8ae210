"""Spelling variants, collocations and personal data against plain versions."""

import random
import re
import time
from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from reeltide.llm import bin_packing, collocations, mixing, pii, spelling
from reeltide.llm.scratch import Scratch

FOLD = {x: x + 32 for x in range(65, 91)}


# spelling variants


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = crc32(f"{'null' if i is None else i}:{run}".encode())
            word = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run
            if len(word) >= 7:
                n[word] += 1
    n = {w: k for w, k in n.items() if k >= 2}
    out, form = {}, {}
    for w in n:
        found = sorted((-n[v], v) for v in n if near(w, v))
        form[w] = found[0][1] if found and -found[0][0] >= 10 * n[w] else None
        out[w] = (n[w], len(found), form[w], n[form[w]] if form[w] else None)

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (*x, root(w)) for w, x in out.items()}


def test_spelling_variants(spark):
    rng = random.Random(5)
    letters = "abcdeéèxyzÀß÷"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(7, 12))) for _ in range(25)]

    def spelt(w):
        k = rng.randrange(len(w))
        return rng.choice((w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1 :]))

    rows = []
    for i in range(300):
        words = [rng.choice(stems[:3]) if rng.random() < 0.5 else rng.choice(stems) for _ in range(12)]
        words = [spelt(spelt(w)) if rng.random() < 0.04 else spelt(w) if rng.random() < 0.15 else w for w in words]
        words = [w.upper() if rng.random() < 0.1 else w for w in words]
        rows.append((i % 290 if i % 50 else None, rng.choice(" ,\n1").join(words)))
    rows += [(900, None), (901, ""), (902, "short words only"), (903, "aaaaaaaa aaaaaaaa aaaaaaaaa aaaaaaaaa"), (903, "aaaaaaaa"), (904, "abcdefg abcdefg bcdefgh bcdefgh"), *((905 + k, "qqqqqqqqq " * 400 + "qqqqqqqqr " * 30 + "qqqqqqqrr " * 2) for k in range(3))]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int")
    want = plain_variants(rows)
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.spelling_variants(df).collect()}
    assert got == want and any(x[2] for x in want.values()) and len(want) > 100
    assert max(x[1] for x in want.values()) > 3 and any(x[2] and x[4] != x[2] for x in want.values())  # hubs, and forms of forms
    for symbols in (1, 20):
        assert {r.word: r.n_near for r in spelling.spelling_variants(df, symbols=symbols).collect()} == {w: x[1] for w, x in want.items()}
    assert spelling.spelling_variants(df.limit(0)).isEmpty() and spelling.spelling_variants(df.where("doc_id >= 900 and doc_id < 903")).isEmpty()


def test_long_texts_are_searched_in_pieces(monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 10)
    text = "some words ÀÉlongerthantenletters, and " * 5 + "x" * 40
    assert "".join(spelling._pieces(text)) == text and len(list(spelling._pieces(text))) > 10
    assert [r for p in spelling._pieces(text) for r in re.findall("[A-Za-zÀ-ÿ]{7,}", p)] == re.findall("[A-Za-zÀ-ÿ]{7,}", text)
    assert list(spelling._pieces("")) == [""]


def test_the_alphabet_grows_with_the_vocabulary():
    assert spelling.alphabet(0) == 4 and spelling.alphabet(400_000) == 6 and spelling.alphabet(10**9) > 10 and spelling.alphabet(10**15) == 26


# collocations


def plain_collocations(rows, least, most):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(FOLD)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3, 4):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        c = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        ranked = []
        for p, a in c.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in c.items()):
                continue
            score, k = min((2000000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(ranked)[:most])]
    return sorted(out)


def phrases(seed):
    rng = random.Random(seed)
    words = ["a", "b", "cé", "d\x01", "E", "f\x0e", "it's", " ", "#"]
    fixed = ["new york city", "as a matter of fact", "a a a a a"]
    rows = []
    for i in range(150):
        parts = [rng.choice(fixed) if rng.random() < 0.2 else rng.choice(words) for _ in range(rng.randint(1, 30))]
        text = "".join(p + rng.choice((" ", "  ", "\t", ". ", ",", "\n", " ", " ", " ")) for p in parts)
        rows.append((rng.choice(("en", "en", "de", None, "und")), text))
    return [*rows, ("en", None), ("fr", ""), ("fr", ".,;  \t"), (None, "a"), ("en", "a b " * 3000)]


def test_collocations(spark):
    rows = phrases(3)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, n int, phrase string")
    for least, most in ((3, 40), (12, 2000)):
        want = plain_collocations(rows, least, most)
        got = sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in collocations.collocations(df, least, most).collect())
        assert got == want and len(want) > 20
    assert collocations.collocations(df.limit(0)).isEmpty() and collocations.collocations(df.where("lang = 'fr'")).isEmpty()


def test_tries_that_burst_and_spill(monkeypatch):
    """Small limits, several tasks: merged runs hold the whole counts."""
    monkeypatch.setattr(collocations, "TRIE_ENTRIES", 40)
    monkeypatch.setattr(collocations, "LEFT_ENTRIES", 10)
    monkeypatch.setattr(collocations, "BURST_ENTRIES", 4)
    monkeypatch.setattr(collocations, "TRIE_WORDS", 12)
    monkeypatch.setattr(collocations, "BLOCK", 16)
    monkeypatch.setattr(collocations, "BLOCK_WORDS", 8)
    rows = [("en", t) for _, t in phrases(8)]
    rows[-1] = ("en", "a b c d " * 40)
    want = Counter()
    for _, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(FOLD)):
            w = re.findall("[^ \t]+", piece)
            for k in (1, 2, 3, 4):
                want.update(" ".join(w[i : i + k]) for i in range(len(w) - k + 1))
    got, every = {}, b"\xff" * (collocations.FILTER_BITS // 8)
    for bits in (None, every):
        runs = defaultdict(list)
        for task in (rows[:60], rows[60:]):
            batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in task]), pa.array([r[1] for r in task], pa.string())], names=["lang", "text"])]
            for out in collocations._count(3, bits)(iter(batches)):
                for part, run in zip(out.column("part").to_pylist(), out.column("run").to_pylist(), strict=True):
                    runs[part].append(run)
        assert sum(map(len, runs.values())) > 20
        for part, blobs in runs.items():
            merged = collocations._merge(2)((pa.scalar("en"), pa.scalar(part)), pa.table({"run": pa.array(blobs, pa.binary())}))
            for r in merged.to_pylist():
                if r["phrase"] is None:
                    got[None] = got.get(None, 0) + r["f"]
                else:
                    assert r["phrase"] not in got
                    got[r["phrase"]] = r["f"]
    assert got.pop(None) == sum(n for p, n in want.items() if " " not in p)
    assert got == {p: n for p, n in want.items() if n >= 2}


def test_scores_past_64_bits(spark, monkeypatch):
    big = 9 * 10**15
    known = [("x", "p", 1, big), ("x", "q", 1, big + 1), ("x", "p q", 2, big - 1), ("x", "q p", 2, 9 * 10**17), ("x", "q q", 2, big), ("x", "q q q", 3, big * 8 // 10), (None, None, 0, 1)]
    grams = spark.createDataFrame([("x" if r[0] is None else r[0], *r[1:]) for r in known], "lang string, phrase string, words int, f long")
    monkeypatch.setattr(collocations, "count_phrases", lambda *a: grams)
    got = {r.phrase: (r.score, r["rank"]) for r in collocations.collocations(spark.range(1)).collect()}
    score = {"p q": 2000000 * (big - 1) // (2 * big + 1), "q p": 2000000 * 9 * 10**17 // (2 * big + 1), "q q q": 2000000 * (big * 8 // 10) // (2 * big + 1)}
    assert {p: s for p, (s, _) in got.items()} == score  # "q q" lies in "q q q" four times of five


# personal data

FORMATS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def fixed_spans(text):
    def fits(kind, m):
        d = re.sub("[^0-9]", "", m)
        return {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m.split(".")), "card": lambda: 14 <= len(d) <= 19 and luhn(d), "phone": lambda: 10 <= len(d) <= 15}[kind]()

    return sorted((m.start(), k, m.end()) for k, kind in enumerate(FORMATS) for m in re.finditer(FORMATS[kind], text or "") if fits(kind, m.group()))


def card(rng, n=16):
    body = "".join(rng.choice("0123456789") for _ in range(n - 1))
    return next(body + c for c in "0123456789" if luhn(body + c))


def test_fixed_spans(spark):
    rng = random.Random(11)
    parts = ["a", "b.c", "@", ".", "@x.y", "x@y.z", "1", "22", "255", "256", ".", "1.2.3.4", "0001.02.3.255", " ", "-", "--", "+", "+1 (017) 555-7713", "(", ")", "é", "😀", "\x01", "\x02", "$1", "\\", "\n", "%", "_", card(rng), card(rng, 19)]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))) for i in range(500)]
    rows += [(600 + i, rng.choice(("", "x ")) + re.sub("(....)", rng.choice(("\\1 ", "\\1-")), card(rng)) + rng.choice(("", "7", " 7", " é"))) for i in range(60)]
    rows += [(700, None), (701, ""), (None, "a@b.c"), (None, "+49 30 1234567"), (702, "a@b.c_x@d.e.f@g.h"), (702, "x@y@z.w"), (703, "1.2.3.4.5.6.7.8"), (704, "9" * 5000 + " " + "8 " * 5000), (705, "a" * 200_000 + "@" + "b." * 20_000 + "c"), (706, "+1" + "(" * 50_000 + "5" + ")" * 50_000)]
    df = spark.createDataFrame([(*r, 1, "x", None) for r in rows], "doc_id long, text string, start int, row string, spans string")
    began = time.monotonic()
    found = pii.personal_data(df).collect()
    assert time.monotonic() - began < 120
    got = Counter((r.doc_id, tuple((s.start, s.kind, s.end) for s in r.spans if s.fixed)) for r in found)
    assert got == Counter((i, tuple(fixed_spans(t))) for i, t in rows)
    out = {r.doc_id: r for r in pii.digest(spark.createDataFrame([(1, [(0, 0, 5, True, 1.0), (9, 3, 12, False, 0.9)]), (2, [])], "doc_id long, spans array<struct<start:long,kind:int,end:long,fixed:boolean,score:double>>")).collect()}
    assert out[1].spans == "email:0:5,phone:9:12" and out[1].base_sha256 == sha256(b"email:0:5").hexdigest() and (out[1].n_email, out[1].n_phone) == (1, 0)
    assert out[2].spans == "" and out[2].base_sha256 == sha256(b"").hexdigest()
    assert pii.personal_data(df.limit(0)).isEmpty()
    clean = pii.personal_data(spark.createDataFrame([(1, "nothing here, but 12 words"), (2, "at home. Then 1.2.3")], "doc_id long, text string"))
    assert all(r.spans == [] for r in clean.collect())


def test_trees_add_disguised_spans_and_leave_clean_texts(spark):
    rng = random.Random(2)
    words = "the of and house river stone at over under seven with from light paper".split()
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    user = lambda: rng.choice(("ann", "bob.k", "c_d")) + str(rng.randint(1, 99))
    host = lambda: rng.choice(("mail", "post", "web")) + str(rng.randint(1, 9)) + ".example." + rng.choice(("com", "org"))
    ip = lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4))
    phone = lambda: f"+{rng.randint(1, 9)} ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}"
    plain = [(i, f"{prose(8)} {rng.choice((lambda: user() + '@' + host(), ip, lambda: card(rng), phone))()} {prose(6)}") for i in range(800)]
    hidden = [(1000 + i, f"{prose(5)} {user()} [at] {host().replace('.', ' [dot] ')} {prose(5)}") for i in range(30)]
    hidden += [(1100 + i, f"{prose(5)} {re.sub('(....)(?=.)', '\\1.', card(rng))} {prose(5)}") for i in range(30)]
    spoilt = lambda: (lambda c: c[:-1] + str((int(c[-1]) + 1) % 10))(card(rng))
    clean = [(2000 + i, f"{prose(6)} {rng.choice((spoilt, lambda: 'at home. Then', lambda: '300.400.500.600', lambda: '12, 13, 14, 15', lambda: str(rng.randint(10**8, 10**9 - 1)), lambda: '3.14.159'))()} {prose(6)}") for i in range(200)]
    df = spark.createDataFrame(plain + hidden + clean, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.personal_data(df).collect()}
    assert all([(s.start, s.kind, s.end) for s in found[i] if s.fixed] == fixed_spans(t) for i, t in plain + hidden + clean)
    assert sum(any(not s.fixed and s.kind == 0 for s in found[i]) for i, _ in hidden if i < 1100) >= 27
    assert sum(any(not s.fixed and s.kind == 2 for s in found[i]) for i, _ in hidden if i >= 1100) >= 27
    assert sum(bool(found[i]) for i, _ in clean) <= 6  # prose around "at" before numbers with dots is taken for an address now and then
    for spans in found.values():
        added = [s for s in spans if not s.fixed]
        assert not any(a.start < b.end and b.start < a.end for a in added for b in spans if a is not b)


def test_every_match_of_every_pattern_is_proposed(spark):
    """Loose addresses too where a text has no digit, no at sign and no dot as a word; hosts of many labels as a whole."""
    rng = random.Random(5)
    parts = ["ann", "bob.k", " ", " ", ".", ".", "x", "org", " at ", " AT ", "[at]", " (at) ", "{ At }", " [dot] ", " DOT ", "<dot>", "@", "4111", "1", "-", "+", "é", "😀", "\n", "_" * 70]
    rows = [(i, "".join(rng.choice(parts[: rng.choice((13, 20, len(parts)))]) for _ in range(rng.randint(1, 30)))) for i in range(400)]
    rows += [(500, "write to ann [at] example.org"), (501, "ann(at)example.org"), (502, "bob at example.org"), (503, "ann [at] " + ".".join("abcdefghijk")), (504, "AT home. Then"), (505, None), (506, "")]
    scratch = Scratch(spark, "proposed")
    ids, matches = pii.proposed(spark.createDataFrame(rows, "doc_id long, text string"), scratch, "doc_id", "text")
    got = Counter((r.id, r.gen, r.start, r.end, r.m) for r in matches.join(ids, "row").collect())
    patterns = [regex.compile(p) for p in pii._FIXED + pii._LOOSE]
    assert got == Counter((i, g, m.start(), m.end(), m.group()) for i, t in rows for g, p in enumerate(patterns) for m in p.finditer(t or ""))
    assert {(500, 4, 9, 29, "ann [at] example.org"), (501, 4, 0, 18, "ann(at)example.org"), (503, 4, 0, 30, "ann [at] a.b.c.d.e.f.g.h.i.j.k")} <= set(got)


def test_trees_add_disguised_spans_of_texts_without_digits(spark):
    rng = random.Random(3)
    words = "the of and house river stone over under seven with from light paper".split()
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    user = lambda: rng.choice(("ann", "bob.k", "c_d")) + rng.choice("abc")
    host = lambda: rng.choice(("mail", "post", "web")) + rng.choice("uvw") + ".example." + rng.choice(("com", "org"))
    plain = [(i, f"{prose(8)} {user()}@{host()} {prose(6)}") for i in range(400)]
    hidden = [(1000 + i, f"{prose(5)} {user()}{rng.choice(('[at]', ' [at] ', '(at)'))}{host()} {prose(5)}") for i in range(30)]
    clean = [(2000 + i, f"{prose(5)} at {prose(1)}. The {prose(5)}") for i in range(100)]
    found = {r.doc_id: r.spans for r in pii.personal_data(spark.createDataFrame(plain + hidden + clean, "doc_id long, text string")).collect()}
    assert sum(any(not s.fixed and s.kind == 0 for s in found[i]) for i, _ in hidden) >= 27
    assert not any(found[i] for i, _ in clean)


def test_kinds_that_the_trees_tell_apart_have_a_threshold(spark):
    """One held example of low score among hundreds must not take its kind's additions away."""
    rng = random.Random(4)
    octets = lambda least: "[.]".join(str(rng.randint(least, least + 200)) for _ in range(4))
    rows = [(1, octets(0), "to ", " and", 1, i % 2 == 0) for i in range(400)] + [(1, octets(300), "to ", " and", 0, i < 1) for i in range(200)]
    model, thresholds = pii.fit(spark.createDataFrame(rows, "kind int, m string, before string, after string, label int, held boolean"))
    assert set(thresholds) == {1} and thresholds[1] >= 0.5
    scored = pii._scored(model, spark.createDataFrame([(1, "9[.]9[.]9[.]9", "to ", " and"), (1, "999[.]9[.]9[.]9", "to ", " and")], "kind int, m string, before string, after string")).collect()
    assert [r.score >= thresholds[1] for r in scored] == [True, False]


# rows without an id, or with one of many


def test_rows_of_one_id_are_taken_each_by_itself(spark):
    """A third of all rows have no id, many rows are alike: the mix keeps to its targets, and shards stay level."""
    rows = [(None, "one text of several words for all of these rows", "a", k) for k in range(40)] + [(1, "x y", "a", 1)] * 20 + [(10 + i, "word " * (i % 30), "b" if i % 2 else None, i) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, mix int")
    total = lambda text: len((text or "").split())
    plan = mixing.plan_mix(df).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    mixed = Counter()
    for r in mixing.mixed_documents(df).collect():
        assert total(r.text)
        mixed[r.source] += total(r.text)
    assert {r.source: r.taken for r in plan} == dict(mixed) and all(abs(r.taken - r.target) <= 1 for r in plan)
    many = spark.range(16000).select(F.when(F.col("id") >= 8000, F.col("id")).alias("doc_id"), F.when(F.col("id") < 8000, F.lit("the same text")).otherwise(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"))
    placed = bin_packing.shard(many).groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n"), F.count_distinct("slot").alias("slots"), F.max("slot").alias("last")).collect()
    b = [r.b for r in placed]
    assert len(b) == 8 and max(b) - min(b) < 0.01 * sum(b) / 8 and all(r.n == r.slots == r["last"] + 1 for r in placed)


@pytest.mark.parametrize("shards", [3, 8])
def test_each_large_group_goes_where_the_dot_product_is_highest(spark, shards):
    """Placement by placement, by a plain version of the rule."""
    rng = random.Random(shards)
    rows = [(k, t) for k, t in enumerate(x for i in range(16) for x in [f"g{i} " + "word " * rng.randint(5, 60)] * (i + 1))]  # no two groups are as large
    sizes = defaultdict(lambda: [0, 0, 0])
    for _, t in rows:
        for d, x in enumerate((len(t) + 1, len(t.split()), 1)):
            sizes[t][d] += x
    whole = [sum(s[d] for s in sizes.values()) for d in range(3)]
    share = {t: [s[d] / whole[d] for d in range(3)] for t, s in sizes.items()}
    room = [[1 / shards] * 3 for _ in range(shards)]
    home = {}
    for t in sorted(share, key=lambda t: -max(share[t])):
        x = share[t]
        free = [[room[s][d] - x[d] for d in range(3)] for s in range(shards)]
        fit = [s for s in range(shards) if min(free[s]) >= 0 and max(free[s]) - min(free[s]) <= 1 / 8 / shards]
        home[t] = max(fit or range(shards), key=lambda s: 8 * room[s][0] * x[0] + room[s][1] * x[1] + room[s][2] * x[2])
        room[home[t]] = free[home[t]]
    got = {}
    for r in bin_packing.shard(spark.createDataFrame(rows, "doc_id long, text string"), shards).collect():
        got.setdefault(dict(rows)[r.doc_id], set()).add(r.shard)
    assert got == {t: {s} for t, s in home.items()}
