"""The operators over embeddings and pages against plain versions and in edge cases."""

import base64
import hashlib
import math
import re
import time
from collections import defaultdict
from html import unescape

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.llm.brute import Union

from reeltide.llm import bit_sliced, pivot_index, tag_paths, warc
from reeltide.llm.scratch import Scratch

VECTORS = "vec_id long, embedding array<float>, label int, id string, x int"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(16).astype(np.float32).tolist(), int(i % 3)) for i in range(300)]
    hub = rng.standard_normal(16)
    rows += [(400 + i, (hub + 0.08 * rng.standard_normal(16)).astype(np.float32).tolist(), 1) for i in range(80)]
    rows += [(600 + i, rows[7][1], 1) for i in range(6)] + [(700, rows[7][1], 2)]
    rows += [(800, None, 1), (801, [0.0] * 16, 1), (802, [float("nan")] * 16, 1), (803, [1.0, None] * 8, 1), (804, rows[7][1], None), (805, [float("inf")] * 16, 1), (806, [], 1), (850, [1.0, 2.0], 1), (900, [-0.5] * 16, 0)]
    return spark.createDataFrame([(*r, "e", 1) for r in rows], VECTORS), rows


def sound(v):
    return v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v)


@pytest.mark.parametrize("blocks", [(8192, 256), (50, 3)])
def test_top_k_is_exact(vectors, blocks, monkeypatch):
    df, rows = vectors
    monkeypatch.setattr(bit_sliced, "BLOCK_ROWS", blocks[0])
    monkeypatch.setattr(bit_sliced, "CHUNK_QUERIES", blocks[1])
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in bit_sliced.top_k(df, F.col("vec_id") % 50 == 0).collect())
    q = {i: [math.floor(256 * float(c)) for c in v] for i, v, _ in rows if sound(v)}
    want = []
    for i in q:
        if i % 50 == 0:
            score = sorted((-sum(a * b for a, b in zip(q[i], q[j], strict=True)), j) for j in q if j != i and len(q[j]) == len(q[i]))
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(score[:5])]
    assert got == sorted(want)


def test_top_k_of_repeated_ids(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [0.0, 1.0]), (8, [0.75, 0.25]), (7, [0.5, 0.5]), (6, [0.25, 0.5]), (5, [0.25, 0.25]), (4, [0.0, 0.0])]
    got = bit_sliced.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0).collect()
    lists = sorted([(r.rank, r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.query_row == q] for q in {r.query_row for r in got})
    east, north = [(0, 1, 65536), (8, 1, 49152), (7, 1, 32768), (5, 1, 16384), (6, 1, 16384)], [(6, 1, 32768), (7, 1, 32768), (5, 1, 16384), (8, 1, 16384), (0, 1, 0)]
    assert [[(v, 1, s) for _, v, s in x] for x in lists] == sorted([east, east, north], key=lambda x: x[0])


def test_top_k_of_wide_numbers_and_few_rows(spark):
    rows = [(0, [1e12, -3.0]), (1, [1e12, 2.0]), (2, [-1e12, 5.0]), (50, [1.0, 1.0])]
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in bit_sliced.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0).collect()}
    assert got[(0, 1)] == (1, 2**63 - 1) and got[(0, 3)] == (2, -(2**63)) and (0, 4) not in got and len(got) == 6
    assert bit_sliced.top_k(spark.createDataFrame([], "vec_id long, embedding array<double>"), F.lit(True)).isEmpty()


def test_slices_add_and_select():
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2, (37, 128)).astype(bool)
    weight = rng.integers(0, 5, 37)
    terms = defaultdict(list)
    for b, w in zip(bits, weight, strict=True):
        terms[int(w)].append(np.packbits(b, bitorder="little").view(np.uint64)[None])
    digits = bit_sliced.add_slices(dict(terms), 2)
    total = sum(np.unpackbits(d.view(np.uint8), bitorder="little").astype(int) << k for k, d in enumerate(digits))
    assert (total == (bits.astype(int) << weight[:, None]).sum(0)).all()
    everyone = np.full(2, ~np.uint64(0))
    assert sorted(bit_sliced.select_top(digits, everyone, 9)) == sorted(np.lexsort((np.arange(128), -total))[:9])


def test_near_duplicates(vectors):
    df, rows = vectors
    unit = {i: (lab, np.asarray(v, float) / np.linalg.norm(np.asarray(v, float))) for i, v, lab in rows if lab is not None and sound(v) and any(v)}
    got = {r.vec_id: r for r in pivot_index.near_duplicates(df).collect()}
    assert len(got) == len(rows)
    union, links = Union(), defaultdict(int)
    for i, (lab, v) in unit.items():
        for j, (other, w) in unit.items():
            if i != j and lab == other and len(v) == len(w) and v @ w >= 0.93:
                links[i] += 1
                union.join(i, j)
    assert all(got[i].n_links <= links[i] for i in unit)  # nothing below the threshold
    assert sum(got[i].n_links for i in unit) >= 0.97 * sum(links.values())
    assert sum(got[i].component_id == union.find(i) for i in unit) >= 0.97 * len(unit)
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i, _, _ in rows if i not in unit)
    assert got[607 - 2].component_id == 7 and got[700].n_links == 0 and not got[601].kept


def test_near_duplicates_in_blocks(vectors, monkeypatch):
    df, rows = vectors
    whole = {r.vec_id: (r.n_links, r.component_id) for r in pivot_index.near_duplicates(df).collect()}
    monkeypatch.setattr(pivot_index, "BLOCK", 9)
    monkeypatch.setattr(pivot_index, "DESCRIBED", 40)
    assert {r.vec_id: (r.n_links, r.component_id) for r in pivot_index.near_duplicates(df).collect()} == whole
    assert pivot_index.near_duplicates(df.limit(0)).isEmpty()


def test_candidates_by_posts():
    """Counts by the pivots' lists equal those by sets."""
    rng = np.random.default_rng(5)
    x, y = (np.array([[7, *rng.choice([k for k in range(20) if k != 7], 4, replace=False)] for _ in range(n)], np.int32) for n in (40, 31))
    got = set(zip(*(k.tolist() for k in pivot_index.candidates(7, x, y)), strict=True))
    assert got == {(i, j) for i, a in enumerate(x.tolist()) for j, b in enumerate(y.tolist()) if len({*a} & {*b}) >= 2 and min({*a} & {*b}) == 7}


def test_few_cosines_for_one_large_label(spark, monkeypatch):
    """20,000 vectors of one label: all planted links found, and no more than a twentieth of all pairs may be compared."""
    rng = np.random.default_rng(9)
    v = rng.normal(size=(20_000, 64))
    twin = rng.permutation(20_000)
    v[twin[:2000]] = v[twin[2000:4000]] + 0.02 * rng.normal(size=(2000, 64))
    frame = pa.table({"vec_id": pa.array(np.arange(20_000)), "embedding": pa.FixedSizeListArray.from_arrays(pa.array(v.ravel()), 64).cast(pa.list_(pa.float64())), "label": pa.array(["one"] * 20_000)})
    compared = spark.sparkContext.accumulator(0)
    found, count = pivot_index.candidates, lambda a: compared.add(len(a))

    def counted(*given):
        a, b = found(*given)
        count(a)
        return a, b

    monkeypatch.setattr(pivot_index, "candidates", counted)
    links = pivot_index.near_duplicates(spark.createDataFrame(frame)).where("n_links = 1").count()
    assert links == 4000
    assert compared.value <= 0.05 * 20_000**2 / 2 * 2  # a block that meets itself holds each pair twice


def test_warc_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    pages = [(i, f"http://x.example/{i}", f"<p>Page {i % 40} é {'word ' * (i % 40)}</p>") for i in range(200)]
    pages += [(300, None, None), (301, "http://a b\r\nX: y/", ""), (302, "", "<p>alone</p>\r\n\r\nWARC/1.1\r\n"), (None, "u", "<p>no id</p>"), (None, "u", "<p>no id</p>"), (303, "big", "z" * 100_000)]
    df = spark.createDataFrame([(*p, "r", 1) for p in pages], "page_id long, url string, html string, digest string, last int")
    scratch = Scratch(spark, "test-warc")
    index = warc.write_archives(df, scratch.folder("a"), scratch)
    assert index.count() == len(pages) and index.select("archive").distinct().count() > 3
    got = warc.round_trip(df).collect()
    groups = defaultdict(list)
    for i, _, h in pages:
        groups[(h or "").encode()].append(i)
    want = []
    for body, ids in groups.items():
        last = max((i for i in ids if i is not None), default=None)
        for i in ids:
            again = i is not None and i != last
            want.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response", last if again else None))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=key) == sorted(want, key=key)
    assert warc.round_trip(df.limit(0)).isEmpty()


def test_warc_records_are_alone_readable(spark):
    import zstandard

    df = spark.createDataFrame([(i, "u", f"<p>{i} {'some words here ' * 9}</p>") for i in range(300)], "page_id long, url string, html string")
    scratch = Scratch(spark, "test-warc")
    folder = scratch.folder("a")
    row = warc.write_archives(df, folder, scratch).where("page_id = 123").first()
    data = memoryview(bytes(spark.read.format("binaryFile").load(f"{folder}/{row.archive}").first().content))
    words, _ = warc.dictionary_of(data)
    record = warc.parse_record(zstandard.ZstdDecompressor(dict_data=words).decompress(data[row.offset : row.offset + row.length]))
    assert record["page_id"] == 123 and record["payload"].decode() == f"<p>123 {'some words here ' * 9}</p>"
    plain = zstandard.ZstdDecompressor()
    with pytest.raises(zstandard.ZstdError):
        plain.decompress(data[row.offset : row.offset + row.length])


def test_small_payloads_are_all_responses(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    assert {r.page_id: r.record_type for r in warc.round_trip(df, least_payload=3).collect()} == {1: "response", 2: "response", 3: "revisit", 4: "response"}


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href="/a">A menu</a></li></ul></nav><div class="cookie-notice">We use cookies.</div>
<div class="layout"><article><h1>A   title &amp; more</h1><p>First paragraph, with <b>bold</b> and <a href="x">a link</a> inside.<p>Second one;\n with white&nbsp;space.
<ul><li>One item.<li>Another item.</ul><form><label>Name</label><input></form><aside>See also.</aside><!-- hidden --><p>Last: 1 &lt; 2.</p></article>
<div id="comments"><p>A reader says something long, and then even more of it.</p></div><div class="sidebar"><p>Popular now.</p></div></div><footer>&copy; Site</footer></body></html>"""


def test_main_text():
    assert tag_paths.main_text(PAGE) == "A title & more\nFirst paragraph, with bold and a link inside.\nSecond one; with white space.\nOne item.\nAnother item.\nLast: 1 < 2."


def test_main_text_without_marks():
    body = "<div class='top'><a href=1>Home</a> <a href=2>News</a></div><div class='story'>" + "".join(f"<p>Sentence {i} has some words, a comma, and an end.</p>" for i in range(5)) + "</div><div class='links'><a href=1>Next</a></div>"
    assert tag_paths.main_text(body).split("\n") == [f"Sentence {i} has some words, a comma, and an end." for i in range(5)]
    assert [tag_paths.main_text(x) for x in (None, "", "just  text", "<p>a<p>b", "<nav>x</nav>", "<script>x", "a < b", "<p>" * 500 + "deep")] == ["", "", "just text", "a\nb", "", "", "a < b", "deep"]


LONG = [f"Paragraph {i} tells a part of the story, with commas, and it ends. " * 5 for i in range(3)]
BODY = "".join(f"<p>{x}</p>" for x in LONG)
TOLD = "\n".join(x.strip() for x in LONG)


@pytest.mark.parametrize("page", [f"<div class='content has-sidebar'>{BODY}</div>", f"<div class='page sidebar-left'><article>{BODY}</article></div>", f"<article class='post category-social'>{BODY}</article>", f"<article class='widget'>{BODY}</article>", f"<main><div id='related'><article>{BODY}</article></div></main>", f"<article><div class='social'>{BODY}</div></article>"])
def test_a_class_word_does_not_drop_the_main_text(page):
    around = f"<body><div class='sidebar'><p>Popular now, and more of it.</p></div>{page}<div class='related'><p>Read this, too.</p></div></body>"
    assert tag_paths.main_text(around) == TOLD


def test_an_advert_longer_than_a_short_article_goes():
    assert tag_paths.main_text("<div class='ad'>Buy it now, while it is cheap, and tell all your friends of it, too.</div><article><h1>The title</h1><p>A short one.</article>") == "The title\nA short one."


def test_headings_and_links_of_an_article_stay():
    assert tag_paths.main_text(f"<article><div class='entry-header'><h1><a href='/x'>The title</a></h1></div>{BODY}</article>") == f"The title\n{TOLD}"
    marks = ["href='/wiki/hidden-valley'", "href=/wiki/hidden", "href='/p?id=search'", "title='the hidden coast' href='/x'", "data-hidden='false' href='/x'", "data-style='display:none' href='/x'", "data-class='ad' href='/x'", "aria-hidden='false' href='/x'"]
    for mark in marks:
        assert tag_paths.main_text(f"<article>{BODY}<p>Words, and <a {mark}>a link</a>, more words.</p></article>") == f"{TOLD}\nWords, and a link, more words."
    for mark in ("hidden", "HIDDEN=''", "aria-hidden=true", "style='color:red; display: none'"):
        assert tag_paths.main_text(f"<article>{BODY}<p {mark}>Not to be seen, ever.</p></article>") == TOLD


@pytest.mark.parametrize(
    "extra",
    [
        "<ul class='more-stories'>" + "".join(f"<li><a href='/{i}'>Another story of the day</a></li>" for i in range(10)) + "</ul>",
        "<div class='mpu'><a href='/buy'>Buy it now, while it is cheap!</a></div>",
        "<div class='ad-slot'><p>Buy it now, while it is cheap!</p></div>",
        "<div class='comments'>" + "".join(f"<p>Reader {i} says something long, and then even more of it, to the end.</p>" for i in range(9)) + "</div>",
    ],
    ids=["links", "linked advert", "advert", "comments"],
)
def test_what_is_not_main_text_within_an_article(extra):
    assert tag_paths.main_text(f"<body><article>{BODY}{extra}</article></body>") == TOLD
    items = "<ul><li>Short one</li><li>Short two</li><li>Short three</li><li>Short four</li></ul>"
    assert tag_paths.main_text(f"<article>{BODY}{items}{extra}</article>") == f"{TOLD}\nShort one\nShort two\nShort three\nShort four"


def _bare(html):
    return re.sub(r"<(/?)article>", r"<\1div>", html)


def test_ratios_decide(spark, small, monkeypatch):
    """Without a threshold most pages keep adverts; without words of noise and marked articles, ratios alone find the article nearly always."""
    pages = [r.html for r in spark.read.parquet(f"{small.replace('0.001', '0.01')}/pages.parquet").select("html").collect()]
    want = [tag_paths.main_text(h) for h in pages]
    assert sum(tag_paths.main_text(h, -1, -1) != w for h, w in zip(pages, want, strict=True)) > 0.5 * len(pages)
    monkeypatch.setattr(tag_paths, "NOISE", frozenset())
    assert sum(tag_paths.main_text(_bare(h)) == w for h, w in zip(pages, want, strict=True)) >= 0.95 * len(pages)


def test_ratios_against_a_plain_version(spark, small):
    """The chosen paths of simple pages by the formulas, over nodes that another parser finds."""
    from html.parser import HTMLParser

    class Nodes(HTMLParser):
        def __init__(self):
            super().__init__()
            self.stack, self.out = [], []

        def handle_starttag(self, tag, attrs):
            if tag not in tag_paths.VOID:
                self.stack.append((tag, dict(attrs).get("class")))

        def handle_endtag(self, tag):
            while self.stack and self.stack.pop()[0] != tag:
                pass

        def handle_data(self, data):
            if not data.isspace():
                self.out.append((tuple(t if c is None else f"{t}.{c}" for t, c in self.stack if t not in tag_paths.INLINE), data, any(t == "a" for t, _ in self.stack)))

    html = "<body><div class='wrap'><div class='top'>Welcome, all.</div><div class='story'><h2>A heading</h2>" + "".join(f"<p>Text number {i} goes on, and on, for <b>some time</b>; then it ends.</p>" for i in range(6)) + "<div class='box'><span>Go</span> <a href='/x'>here</a></div></div><div class='low'><p>Rights, all of them.</p></div></div></body>"
    parser = Nodes()
    parser.feed(html)
    paths = {}
    for path, text, link in parser.out:
        p = paths.setdefault(path, [0, 0, 0, 0])
        for i, x in enumerate((1, len(text), len(re.findall("[.,;:!?]", text)), len(text) * link)):
            p[i] += x
    ratio = {k: n / c * np.log2(2 + q / c) * (1 - a / n) ** 2 for k, (c, n, q, a) in paths.items()}
    order = [p for p, _, _ in parser.out]
    value = [ratio[next((p for p in order[j:] if p[-1] != "h2"), order[j])] for j in range(len(order))]
    smooth = {}
    for j, p in enumerate(order):
        w = {k: np.exp(-2.0 * k * k) for k in range(-2, 3) if 0 <= j + k < len(order)}
        smooth.setdefault(p, []).append(sum(w[k] * value[j + k] for k in w) / sum(w.values()))
    fused = {k: np.mean(v) for k, v in smooth.items()}
    total = sum(p[1] for p in paths.values())
    mean = sum(fused[k] * p[1] for k, p in paths.items()) / total
    story = ("body", "div.wrap", "div.story")
    want = {k for k in paths if k[:3] == story and fused[k] >= tag_paths.BELOW * mean}
    around = lambda k: sum(p[1] - p[3] for j, p in paths.items() if j[:-1] == k[:-1]) / (total - sum(p[3] for p in paths.values()))
    want |= {k for k in paths if fused[k] * around(k) ** 0.5 >= tag_paths.ELSEWHERE * mean}
    page = tag_paths.Page(html)
    names = {v: k for k, v in page._known.items()}

    def full(k):
        return (*full(names[k][0]), names[k][1]) if k else ()

    assert {full(k) for k in tag_paths.chosen_paths(page)} == want and (*story, "h2") in want and ("body", "div.wrap", "div.top") not in want


@pytest.mark.parametrize("html", ['<a "' * 250_000, "<a \">\" " * 100_000 + '"', "<div>" * 50_000 + "x" + "</div>" * 50_000, "<div class=ad>" * 50_000 + "x", "<b>" * 50_000 + "<hr>" * 50_000, "<p>" + "x <b>" * 50_000 + "</i>" * 50_000, "<!--" * 250_000, "<x" * 300_000 + ">", "<p>Word, and word. " * 60_000], ids=range(9))
def test_long_bad_pages_take_seconds(html):
    began = time.perf_counter()
    tag_paths.main_text(html)
    assert time.perf_counter() - began < 20


def test_extraction_of_the_given_pages(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    got = {r.page_id: r for r in tag_paths.extract(pages.withColumn("text", F.lit("x"))).collect()}
    for r in pages.collect():
        article = r.html[r.html.index("<article>") + 9 : r.html.index("</article>")]
        blocks = (re.sub(r"\s+", " ", unescape(re.sub(r"<[^>]+>", " ", b))).strip() for b in re.split(r"</?(?:p|h1)>", article))
        assert got[r.page_id].text == "\n".join(b for b in blocks if b) and got[r.page_id].n_chars == len(got[r.page_id].text)
    assert tag_paths.extract(pages.limit(0)).isEmpty()
