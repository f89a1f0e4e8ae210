from pyspark.sql import functions as F

from reeltide.functions import text as X


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first().y


def test_trim_and_words_know_unicode_spaces(spark):
    assert one(spark, "　 a\tb \n", X.trim_ws) == "a\tb"
    assert one(spark, "　a  b c\n", X.words) == ["a", "b", "c"]


def test_summary_counts_characters(spark):
    assert one(spark, "é" * 180, X.summarize) == "é" * 180
    assert one(spark, "é" * 181, X.summarize) == "é" * 177 + "..."
    assert one(spark, " a \n b ", X.summarize) == "a b"


def test_byte_prefix_keeps_whole_characters(spark):
    assert one(spark, "é" * 31, lambda c: X.byte_prefix(c, 60)) == "é" * 30
    assert one(spark, "日" * 21, lambda c: X.byte_prefix(c, 61)) == "日" * 20
    assert one(spark, "abc", lambda c: X.byte_prefix(c, 60)) == "abc"


def test_titles(spark):
    assert one(spark, "one two three four five six seven eight nine", X.title) == "one two three four five six seven eight"
    assert one(spark, "", lambda c: X.short_title(c, F.lit("v_1"))) == "Segment v_1"
    long = one(spark, "abcdefghij " * 10, lambda c: X.short_title(c, F.lit("v")))
    assert len(long) == 50 and long.endswith("...")


def test_keywords(spark):
    assert one(spark, "This that Zebra apple apple a_b_c été abc", lambda c: X.keywords(F.lit("Mango"), c)) == ["a_b_c", "apple", "mango", "zebra", "été"]
    assert one(spark, "a b c", lambda c: X.keywords(F.lit(""), c)) == ["video"]


def test_times(spark):
    number = lambda v, f: one(spark, str(v), lambda c: f(c.cast("double")))
    assert number(3661.0015, X.timecode) == "01:01:01.002"
    assert number(-1, X.timecode) == "00:00:00.000"
    assert number(360000, X.timecode) == "100:00:00.000"
    assert number(59.9, X.clock) == "0:59" and number(3661, X.clock) == "1:01:01" and number(-5, X.clock) == "0:00"
    assert one(spark, "01:02:03.5", X.parse_timecode) == 3723.5
    assert one(spark, "02:03", X.parse_timecode) is None and one(spark, "a:b:c", X.parse_timecode) is None


def test_fractions(spark):
    assert abs(one(spark, "30000/1001", X.parse_fraction) - 29.97) < 0.01
    assert one(spark, "1/0", X.parse_fraction) == float("inf")
    assert one(spark, "1/2/3", X.parse_fraction) is None and one(spark, "x/2", X.parse_fraction) is None


def test_hash_and_bits(spark):
    assert one(spark, "abc", lambda c: X.source_hash(c.cast("binary"))) == "sha256:ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
    row = spark.range(1).select(X.hamming(F.lit(0), F.lit(-1).cast("bigint")).alias("all"), X.hamming(F.lit(0xFF).cast("bigint"), F.lit(0).cast("bigint")).alias("eight"), X.difference_hash(F.array(*[F.lit(float(-i)) for i in range(65)]), 64).alias("h")).first()
    assert (row["all"], row.eight, row.h) == (64, 8, -1)


def test_embedding_text(spark):
    row = spark.range(1).select(X.embedding_text(F.lit(" a "), F.lit(""), F.lit(None).cast("string"), F.lit("b")).alias("y")).first()
    assert row.y == "a\n\nb"
