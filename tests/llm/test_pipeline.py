"""The stages of the corpus pipeline, each against what it decides."""

import corpus_pipeline
from pyspark.sql import functions as F
from tests.llm.brute import WORD, similar_groups, without_repeats
from tests.llm.test_documents import _rank

from reeltide.llm import kneser_ney, queries


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").persist()
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "n-gram Jaccard join", "substring dedup", "mixing sources to target weights", "packing"]

    kept = stages["toxicity"](spark, docs, small).persist()
    scored = kneser_ney.toxicity(docs, spark.read.parquet(f"{small}/labels.parquet"))
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in scored.where("predicted = 0").collect()} and kept.columns == columns

    unique = stages["n-gram Jaccard join"](spark, kept, small).persist()
    groups = similar_groups([(r.doc_id, r.text) for r in kept.collect()], 5, 80)
    assert {r.doc_id for r in unique.collect()} == set(groups.values()) and unique.columns == columns

    cut = stages["substring dedup"](spark, unique, small).persist()
    assert {r.doc_id: r.text for r in cut.collect()} == {i: t for i, (t, _) in without_repeats([(r.doc_id, r.text) for r in unique.collect()], _rank).items()}
    assert cut.columns == columns and cut.where(F.length("text") != F.col("n_chars")).isEmpty()

    mixed = stages["mixing sources to target weights"](spark, cut, small).persist()
    total = lambda df: sum(len(WORD.findall(r.text)) for r in df.collect())
    assert mixed.columns == columns and abs(total(mixed) - 1.5 * total(cut)) <= 30

    packed = stages["packing"](spark, mixed, small).collect()
    lengths = {}
    for r in packed:
        lengths[r.sequence_id] = lengths.get(r.sequence_id, 0) + r.length
    assert all(n <= 4096 and n & (n - 1) == 0 for n in lengths.values()) and {r.doc_id for r in packed} == {r.doc_id for r in mixed.collect()}


def test_stages_on_odd_rows(spark, small):
    """Empty tables, nulls, repeated ids and clashing names pass through all stages; what each keeps is defined."""
    own = [" ".join(f"own{k} sentence{j} differs from all the others in here." for j in range(3)) for k in range(4)]
    rows = [(1, own[0], "en", "a"), (1, own[1], "en", "a"), (1, own[0], "en", "a"), (None, own[2], None, None), (None, own[2], None, None), (2, None, None, None), (3, "", "en", "a"), (4, own[3], "de", None), (5, own[3], "de", "b")]
    names = "doc_id long, text string, lang string, source string, n_chars long, rejected_id int, rejected_of int, surplus int, span_copy int, mix int, id int, of int"
    docs = spark.createDataFrame([(*r, len(r[1] or ""), 1, 2, 3, 4, 5, 6, 7) for r in rows], names)
    stages = dict(corpus_pipeline.STAGES)
    for name in list(stages)[:4]:
        assert stages[name](spark, docs.limit(0), small).isEmpty(), name
    assert stages["packing"](spark, docs.limit(0), small).isEmpty()
    key = lambda df: sorted(((r.doc_id or -1), r.text or "-") for r in df.collect())
    kept = stages["toxicity"](spark, docs, small)
    assert kept.columns == docs.columns and key(kept) == key(docs)
    unique = stages["n-gram Jaccard join"](spark, kept, small)
    assert unique.columns == docs.columns and [i for i, _ in key(unique)] == [-1, -1, 1, 2, 3, 4]
    cut = stages["substring dedup"](spark, unique, small)
    assert cut.columns == docs.columns and key(cut) == key(unique)
    mixed = stages["mixing sources to target weights"](spark, cut, small)
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} <= {None, 1, 4}
    assert {r.doc_id for r in stages["packing"](spark, mixed, small).collect()} == {r.doc_id for r in mixed.collect()}


def test_run_and_queries(spark, small):
    assert corpus_pipeline.run(spark, small).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    for name in ("op1_warc", "op2_bit_sliced_topk", "op4_bin_packing", "op5_pivot_index", "op7_tag_paths"):
        assert not queries.QUERIES[name](spark, small).isEmpty()
