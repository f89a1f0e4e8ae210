"""Column functions over text, times and hashes. All stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that are never keywords, and how many bytes a keyword has at least.
STOP_WORDS = ("this", "that", "with", "from", "chunk", "segment")
KEYWORD_BYTES, KEYWORDS = 4, 8


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def trim_ws(text: Column) -> Column:
    """Without Unicode white space at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def words(text: Column) -> Column:
    """The runs of other than Unicode white space."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def compact(text: Column) -> Column:
    return F.array_join(words(text), " ")


def summarize(text: Column, limit: int = 180) -> Column:
    """White space collapsed; beyond ``limit`` characters cut, with dots."""
    return once(compact(text), lambda c: F.when(F.length(c) <= limit, c).otherwise(F.concat(F.substring(c, 1, max(limit - 3, 0)), F.lit("..."))))


def byte_prefix(text: Column, limit: int) -> Column:
    """The longest prefix of whole characters of at most ``limit`` bytes."""

    def cut(t: Column) -> Column:
        ends = F.filter(F.sequence(F.lit(0), F.least(F.length(t), F.lit(limit))), lambda i: F.octet_length(F.substring(t, F.lit(1), i)) <= limit)
        return F.when(F.octet_length(t) <= limit, t).otherwise(F.substring(t, F.lit(1), F.array_max(ends)))

    return once(text, cut)


def title(text: Column, count: int = 8, limit: int = 60) -> Column:
    """The first words, cut to ``limit`` bytes."""
    return byte_prefix(F.array_join(F.slice(words(text), 1, count), " "), limit)


def short_title(text: Column, chunk_id: Column) -> Column:
    """The first ten words or the chunk's name; over 50 bytes, the first 47 and dots."""
    first = F.array_join(F.slice(words(text), 1, 10), " ")
    full = once(first, lambda f: F.when(f == "", F.concat(F.lit("Segment "), chunk_id)).otherwise(f))
    return once(full, lambda f: F.when(F.octet_length(f) > 50, F.concat(byte_prefix(f, 47), F.lit("..."))).otherwise(f))


def tokens(text: Column) -> Column:
    """Runs of letters, numbers and underscores, lower-cased."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"([\p{IsAlphabetic}\p{N}_]+)"), F.lit(1)), lambda t: F.lower(t))


#: Fixed value: the keyword of what has none.
NO_KEYWORD = "video"


def keywords(title_text: Column, text: Column) -> Column:
    """The alphabetically first distinct tokens of title and text that may be keywords; ``video`` where there are none."""
    kept = F.filter(F.concat(tokens(title_text), tokens(text)), lambda t: (F.octet_length(t) >= KEYWORD_BYTES) & ~t.isin(*STOP_WORDS))
    best = F.slice(F.array_sort(F.array_distinct(kept)), 1, KEYWORDS)
    return once(best, lambda b: F.when(F.size(b) > 0, b).otherwise(F.array(F.lit(NO_KEYWORD))))


def timecode(seconds: Column) -> Column:
    """HH:MM:SS.mmm, rounded to milliseconds; negative times are zero."""
    ms = F.round(F.greatest(seconds, F.lit(0.0)) * 1000).cast("bigint")
    part = lambda div, mod: F.floor(ms / div).cast("bigint") % mod
    return F.format_string("%02d:%02d:%02d.%03d", F.floor(ms / 3600000).cast("bigint"), part(60000, 60), part(1000, 60), ms % 1000)


def time_range(start: Column, end: Column) -> Column:
    return F.concat(timecode(start), F.lit("-"), timecode(end))


def clock(seconds: Column) -> Column:
    """M:SS or H:MM:SS, truncated."""
    s = F.greatest(seconds, F.lit(0.0)).cast("bigint")
    h, m, r = F.floor(s / 3600).cast("bigint"), F.floor(s / 60).cast("bigint") % 60, s % 60
    return F.when(h > 0, F.format_string("%d:%02d:%02d", h, m, r)).otherwise(F.format_string("%d:%02d", m, r))


def source_hash(data: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(data, 256))


def parse_timecode(text: Column) -> Column:
    """Seconds of H:M:S; null unless there are three numbers."""
    p = F.split(text, ":")
    part = lambda i: F.get(p, F.lit(i)).try_cast("double")
    return F.when(F.size(p) == 3, part(0) * 3600 + part(1) * 60 + part(2))


def parse_fraction(text: Column) -> Column:
    """The value of n/d; null unless both are numbers; by zero, infinite or NaN."""
    p = F.split(text, "/")
    n, d = F.get(p, F.lit(0)).try_cast("double"), F.get(p, F.lit(1)).try_cast("double")
    by_zero = F.when(n > 0, F.lit(float("inf"))).when(n < 0, F.lit(float("-inf"))).otherwise(F.lit(float("nan")))
    return F.when((F.size(p) == 2) & n.isNotNull() & d.isNotNull(), F.when(d == 0, by_zero).otherwise(F.try_divide(n, d)))


def embedding_text(*parts: Column) -> Column:
    """The parts that aren't blank, trimmed, a blank line between them."""
    return F.array_join(F.filter(F.array(*[F.coalesce(trim_ws(p), F.lit("")) for p in parts]), lambda p: p != ""), "\n\n")


def difference_hash(values: Column, bits: int = 63) -> Column:
    """Bit i is set where value i is greater than the next one."""
    return F.aggregate(F.sequence(F.lit(0), F.lit(bits - 1)), F.lit(0).cast("bigint"), lambda h, i: h.bitwiseOR(F.when(F.get(values, i) > F.get(values, i + 1), F.call_function("shiftleft", F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint"))))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def estimate(size_bytes: Column) -> dict[str, Column]:
    """Rules of thumb by file size: chunks, output MB and minutes."""
    mb = size_bytes / float(1 << 20)
    return {"chunks": F.greatest(mb / 10, F.lit(5.0)).cast("bigint"), "output_mb": F.ceil(mb * 0.5).cast("bigint"), "minutes": F.ceil(mb / 50).cast("bigint")}
