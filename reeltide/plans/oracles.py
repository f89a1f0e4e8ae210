"""The registered queries as SQL over the given tables, for comparison by another engine."""

from __future__ import annotations

# Relations are common table expressions, each text continuing the ones before it.
_FX = r"""
WITH RECURSIVE tr0 AS (SELECT conv_id AS video_id, turn AS seg_idx, text, role AS speaker, CAST(greatest(500, 120 * length(text)) AS BIGINT) AS ms FROM conversations),
tr1 AS (SELECT *, CAST(sum(ms) OVER (PARTITION BY video_id ORDER BY seg_idx) AS BIGINT) AS end_ms FROM tr0),
transcript AS (SELECT video_id, seg_idx, CAST(end_ms - ms AS DOUBLE) / 1000 AS start_sec, CAST(end_ms AS DOUBLE) / 1000 AS end_sec, text, speaker, end_ms FROM tr1),
media AS (SELECT video_id, max(end_ms) AS dur_ms, CAST(max(end_ms) AS DOUBLE) / 1000 AS duration_sec FROM transcript GROUP BY video_id),
signals AS (SELECT e.user_id AS video_id, e.event_id, e.event_type, CAST((epoch_us(e.ts) // 1000) % m.dur_ms AS DOUBLE) / 1000 AS at_sec FROM events e JOIN media m ON m.video_id = e.user_id),
scenes AS (SELECT video_id, at_sec FROM signals WHERE event_type = 'view')
"""

_SILENCE = (
    _FX
    + r""",
marks AS (SELECT video_id, at_sec, event_id, event_type = 'click' AS is_start,
    coalesce(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY video_id ORDER BY at_sec, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run
    FROM signals WHERE event_type IN ('click', 'purchase')),
silences AS (SELECT video_id, start_sec, at_sec AS end_sec FROM (
    SELECT *, max(CASE WHEN is_start THEN at_sec END) OVER (PARTITION BY video_id, run) AS start_sec FROM marks) q
    WHERE NOT is_start AND start_sec IS NOT NULL)
"""
)

_COARSE = (
    _SILENCE
    + r""",
cand AS (SELECT video_id, list(DISTINCT at_sec) AS c FROM (
    SELECT video_id, start_sec AS at_sec FROM silences UNION ALL SELECT video_id, end_sec FROM silences UNION ALL SELECT video_id, at_sec FROM scenes) q GROUP BY video_id),
base AS (SELECT m.video_id, m.duration_sec AS dur, coalesce(k.c, CAST([] AS DOUBLE[])) AS c FROM media m LEFT JOIN cand k ON k.video_id = m.video_id WHERE m.duration_sec > 0),
walk AS (
    SELECT video_id, dur, c, CAST(-1 AS BIGINT) AS seg_index, CAST(0 AS DOUBLE) AS start_sec, CAST(0 AS DOUBLE) AS end_sec FROM base
    UNION ALL
    SELECT video_id, dur, c, seg_index + 1, end_sec, CASE WHEN pick <= end_sec THEN least(end_sec + 1, dur) ELSE pick END FROM (
        SELECT *, coalesce(-(list_sort(list_transform(list_filter(c, lambda x: x >= end_sec AND x <= least(end_sec + 330, dur)), lambda x: {'d': abs(x - least(end_sec + 300, dur)), 'n': -x}))[1]).n, least(end_sec + 300, dur)) AS pick
        FROM walk WHERE end_sec < dur) q),
coarse AS (SELECT video_id, seg_index, start_sec, end_sec FROM walk WHERE seg_index >= 0)
"""
)

_WS = r"[\s\p{Z}\x{85}]"


def _trim(x: str) -> str:
    return rf"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _words(x: str) -> str:
    return rf"list_filter(regexp_split_to_array({x}, '{_WS}+'), lambda w: w <> '')"


def _first_words(x: str, n: int) -> str:
    return f"array_to_string({_words(x)}[1:{n}], ' ')"


def _prefix(x: str, limit: int) -> str:
    return f"CASE WHEN strlen({x}) <= {limit} THEN {x} ELSE substring({x}, 1, list_max(list_filter(range(0, {limit + 1}), lambda i: strlen(substring({x}, 1, CAST(i AS INT))) <= {limit}))) END"


def _title(x: str) -> str:
    return _prefix(_first_words(x, 8), 60)


def _summary(x: str) -> str:
    c = f"array_to_string({_words(x)}, ' ')"
    return f"CASE WHEN length({c}) <= 180 THEN {c} ELSE substring({c}, 1, 177) || '...' END"


def _keywords(title: str, text: str) -> str:
    tokens = lambda x: rf"list_transform(regexp_extract_all({x}, '[\p{{L}}\p{{Nl}}\p{{N}}_]+'), lambda t: lower(t))"
    kept = f"list_sort(list_distinct(list_filter(list_concat({tokens(title)}, {tokens(text)}), lambda t: strlen(t) >= 4 AND t NOT IN ('this', 'that', 'with', 'from', 'chunk', 'segment'))))[1:8]"
    return f"CASE WHEN len({kept}) > 0 THEN array_to_string({kept}, ',') ELSE 'video' END"


def _tc(x: str) -> str:
    ms = f"CAST(round(greatest({x}, 0) * 1000) AS BIGINT)"
    return f"printf('%02d:%02d:%02d.%03d', {ms} // 3600000, {ms} // 60000 % 60, {ms} // 1000 % 60, {ms} % 1000)"


def _clock(x: str) -> str:
    s = f"CAST(floor(greatest({x}, 0)) AS BIGINT)"
    return f"CASE WHEN {s} >= 3600 THEN printf('%d:%02d:%02d', {s} // 3600, {s} // 60 % 60, {s} % 60) ELSE printf('%d:%02d', {s} // 60 % 60, {s} % 60) END"


_SEMANTIC = (
    _COARSE
    + rf""",
cut AS (SELECT *, CAST(greatest(ceil((end_sec - start_sec) / 60), 1) AS BIGINT) AS n FROM coarse WHERE end_sec > start_sec),
piece AS (SELECT video_id, seg_index, j, seg_index * 1000000 + j AS ord, start_sec + ((end_sec - start_sec) / n) * j AS start_sec, CASE WHEN j + 1 = n THEN end_sec ELSE start_sec + ((end_sec - start_sec) / n) * (j + 1) END AS end_sec
    FROM (SELECT *, unnest(range(0, n)) AS j FROM cut) q),
spoken AS (SELECT video_id, seg_idx, start_sec AS t0, end_sec AS t1, {_trim("text")} AS tx FROM transcript),
semantic AS (SELECT p.video_id, p.ord, p.start_sec, p.end_sec, coalesce(string_agg(s.tx, ' ' ORDER BY s.seg_idx), '') AS transcript_text, 'time-based split within coarse segment' AS rationale
    FROM piece p LEFT JOIN spoken s ON s.video_id = p.video_id AND s.t0 < p.end_sec AND s.t1 > p.start_sec AND s.tx <> '' GROUP BY p.video_id, p.ord, p.start_sec, p.end_sec),
coarse_text AS (SELECT p.video_id, p.seg_index, p.start_sec, p.end_sec, coalesce(string_agg(s.text, ' ' ORDER BY s.seg_idx), '') AS transcript_text
    FROM coarse p LEFT JOIN transcript s ON s.video_id = p.video_id AND s.start_sec < p.end_sec AND s.end_sec > p.start_sec GROUP BY p.video_id, p.seg_index, p.start_sec, p.end_sec)
"""
)

_MERGED = (
    _SEMANTIC
    + rf""",
line AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY ord) AS r FROM semantic),
fold AS (
    SELECT video_id, r, start_sec AS g_start, end_sec AS g_end, CAST(0 AS BIGINT) AS g, end_sec - start_sec < 15 AS open FROM line WHERE r = 1
    UNION ALL
    SELECT l.video_id, l.r, CASE WHEN f.open THEN f.g_start ELSE l.start_sec END, l.end_sec, CASE WHEN f.open THEN f.g ELSE f.g + 1 END, l.end_sec - (CASE WHEN f.open THEN f.g_start ELSE l.start_sec END) < 15
    FROM fold f JOIN line l ON l.video_id = f.video_id AND l.r = f.r + 1),
grouped AS (SELECT f.video_id, f.g, min(l.start_sec) AS start_sec, max(l.end_sec) AS end_sec, string_agg(l.transcript_text, ' ' ORDER BY l.r) AS transcript_text, string_agg(l.rationale, ' + ' ORDER BY l.r) AS rationale, arg_max(f.open, f.r) AS short
    FROM fold f JOIN line l ON l.video_id = f.video_id AND l.r = f.r GROUP BY f.video_id, f.g),
paired AS (SELECT *, lead(short) OVER w AS next_short, lead(end_sec) OVER w AS next_end, lead(transcript_text) OVER w AS next_text, lead(rationale) OVER w AS next_why FROM grouped WINDOW w AS (PARTITION BY video_id ORDER BY g)),
merged AS (SELECT video_id, g AS ord, start_sec, CASE WHEN next_short THEN next_end ELSE end_sec END AS end_sec,
    CASE WHEN next_short THEN {_trim("(transcript_text || ' ' || next_text)")} ELSE transcript_text END AS transcript_text, CASE WHEN next_short THEN rationale || ' + ' || next_why ELSE rationale END AS rationale
    FROM paired WHERE NOT (short AND g > 0))
"""
)


def _split(source: str) -> str:
    return f"""SELECT video_id, ord, j AS part, CASE WHEN n > 1 THEN start_sec + ((end_sec - start_sec) / n) * j ELSE start_sec END AS start_sec,
    CASE WHEN j + 1 = n THEN end_sec ELSE start_sec + ((end_sec - start_sec) / n) * (j + 1) END AS end_sec, transcript_text, CASE WHEN n > 1 THEN rationale || ' (part ' || CAST(j + 1 AS VARCHAR) || ')' ELSE rationale END AS rationale
    FROM (SELECT *, unnest(range(0, n)) AS j FROM (SELECT *, CASE WHEN end_sec - start_sec > 120 THEN CAST(ceil((end_sec - start_sec) / 60) AS BIGINT) ELSE 1 END AS n FROM ({source}) a) b) c"""


_NORMAL = (
    _MERGED
    + f""",
parts AS ({_split("SELECT * FROM merged")}),
normal AS (SELECT video_id, idx, CAST(video_id AS VARCHAR) || '_chunk_' || printf('%04d', idx) AS chunk_id, '' AS parent_segment_id, start_sec, end_sec, transcript_text
    FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY ord, part) - 1 AS idx FROM parts) q)
"""
)

_T = _trim("transcript_text")
_ANNOTATED = (
    _NORMAL
    + f""",
titled AS (SELECT *, {_T} AS t, CASE WHEN {_T} = '' THEN 'Segment ' || chunk_id || ' (' || {_tc("start_sec")} || '-' || {_tc("end_sec")} || ')' ELSE {_title(_T)} END AS title FROM normal),
annotated AS (SELECT video_id, idx, chunk_id, parent_segment_id, start_sec, end_sec, transcript_text, title, CASE WHEN t = '' THEN 'No transcript available. Chunk generated from timing and visual boundaries.' ELSE {_summary("t")} END AS summary,
    {_keywords("title", "t")} AS keywords FROM titled)
"""
)


def _stamp_fold(name: str, source: str, least: float) -> str:
    """A relation of times with those dropped that are nearer than ``least`` to the last one kept."""
    return f"""
{name}_s AS (SELECT video_id, at_sec, row_number() OVER (PARTITION BY video_id ORDER BY at_sec) AS r FROM ({source}) q),
{name}_f AS (
    SELECT video_id, r, at_sec, at_sec AS kept, true AS keep FROM {name}_s WHERE r = 1
    UNION ALL
    SELECT s.video_id, s.r, s.at_sec, CASE WHEN abs(s.at_sec - f.kept) < {least} THEN f.kept ELSE s.at_sec END, abs(s.at_sec - f.kept) >= {least} FROM {name}_f f JOIN {name}_s s ON s.video_id = f.video_id AND s.r = f.r + 1),
{name} AS (SELECT video_id, at_sec, row_number() OVER (PARTITION BY video_id ORDER BY r) - 1 AS frame_idx FROM {name}_f WHERE keep)"""


_STAMPS = (
    r"""
safe AS (SELECT video_id, duration_sec AS dur, CASE WHEN duration_sec > 0.5 THEN duration_sec - 0.5 ELSE duration_sec END AS lim FROM media WHERE duration_sec > 0),
stamp AS (SELECT video_id, CAST(0 AS DOUBLE) AS at_sec FROM safe UNION ALL SELECT video_id, least(dur / 2, lim) FROM safe
    UNION ALL SELECT video_id, at_sec FROM (SELECT video_id, lim, CAST(unnest(range(1, CAST(ceil(lim / 5) AS BIGINT))) * 5 AS DOUBLE) AS at_sec FROM safe) q WHERE at_sec < lim
    UNION ALL SELECT s.video_id, s.at_sec FROM scenes s JOIN safe f ON f.video_id = s.video_id WHERE s.at_sec > 0 AND s.at_sec < f.lim),"""
    + _stamp_fold("every", "SELECT * FROM stamp", 0.25)
    + r""",
counted AS (SELECT *, count(*) OVER (PARTITION BY video_id) AS n FROM every),
thin AS (SELECT c.video_id, c.at_sec FROM counted c JOIN range(0, 8) i(i) ON c.frame_idx = CAST(round(i.i * (c.n - 1) / 7.0) AS BIGINT) WHERE c.n > 8),"""
    + _stamp_fold("thinned", "SELECT * FROM thin", 0.25)
    + r""",
stamps AS (SELECT video_id, frame_idx, at_sec FROM counted WHERE n <= 8 UNION ALL SELECT video_id, frame_idx, at_sec FROM thinned),
kinds AS (SELECT f.video_id, f.frame_idx, f.at_sec, CASE WHEN EXISTS (SELECT 1 FROM scenes s WHERE s.video_id = f.video_id AND abs(s.at_sec - f.at_sec) < 0.25) THEN 'scene_change' ELSE 'periodic' END AS kind FROM stamps f)
"""
)

_HASHES = r"hashes AS (SELECT label AS grp, vec_id AS seq, CAST(list_sum(list_transform(range(1, 64), lambda i: CASE WHEN embedding[i] > embedding[i + 1] THEN CAST(1 AS HUGEINT) << CAST(i - 1 AS INT) ELSE CAST(0 AS HUGEINT) END)) AS BIGINT) AS hash FROM embeddings)"


def _hash_fold(name: str, source: str, threshold: int) -> str:
    """(grp, seq) of the rows of (grp, seq, hash) that aren't near to one kept before."""
    near = f"len(list_filter(f.kept, lambda h: bit_count(xor(h, s.hash)) <= {threshold})) > 0"
    return f"""
{name}_s AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY seq) AS r FROM ({source}) q),
{name}_f AS (
    SELECT grp, seq, r, CASE WHEN hash IS NULL THEN CAST([] AS BIGINT[]) ELSE [hash] END AS kept, true AS keep FROM {name}_s WHERE r = 1
    UNION ALL
    SELECT s.grp, s.seq, s.r, CASE WHEN s.hash IS NULL OR {near} THEN f.kept ELSE list_append(f.kept, s.hash) END, s.hash IS NULL OR NOT ({near}) FROM {name}_f f JOIN {name}_s s ON s.grp = f.grp AND s.r = f.r + 1),
{name} AS (SELECT grp, seq FROM {name}_f WHERE keep)"""


_FRAMES = (
    _STAMPS
    + ", "
    + _HASHES
    + r""",
hashed AS (SELECT k.*, h.hash, 'images/' || CAST(k.video_id AS VARCHAR) || '/frame_' || printf('%03d', k.frame_idx) || '.jpg' AS path FROM kinds k LEFT JOIN hashes h ON h.seq = (k.video_id * 8 + k.frame_idx) % (SELECT count(*) FROM embeddings)),"""
    + _hash_fold("unlike", "SELECT video_id AS grp, frame_idx AS seq, hash FROM hashed", 10)
    + r""",
frames AS (SELECT h.video_id, h.frame_idx, h.at_sec, h.kind, h.path FROM hashed h JOIN unlike u ON u.grp = h.video_id AND u.seq = h.frame_idx)
"""
)

_INSIDE = "inside AS (SELECT f.*, c.idx FROM frames f JOIN normal c ON c.video_id = f.video_id AND f.at_sec >= c.start_sec AND f.at_sec <= c.end_sec)"


def _captioned(k: int) -> str:
    return f"captioned AS (SELECT DISTINCT video_id, frame_idx FROM (SELECT *, row_number() OVER (PARTITION BY video_id, idx ORDER BY CASE WHEN kind = 'scene_change' THEN 0 ELSE 1 END, at_sec, frame_idx) AS r FROM inside) q WHERE r <= {k})"


_VISUAL = (
    _FRAMES
    + ", "
    + _INSIDE
    + ", "
    + _captioned(3)
    + rf""",
seen AS (SELECT i.video_id, i.idx, i.frame_idx, {_trim("d.text")} AS ocr, CASE WHEN c.frame_idx IS NOT NULL THEN 'Visual caption for frame_' || printf('%03d', i.frame_idx) || '.jpg' END AS caption
    FROM inside i LEFT JOIN documents d ON d.doc_id = (i.video_id * 8 + i.frame_idx) % (SELECT count(*) FROM documents) LEFT JOIN captioned c ON c.video_id = i.video_id AND c.frame_idx = i.frame_idx),
ocr_first AS (SELECT video_id, idx, ocr, min(frame_idx) AS seen_at FROM seen WHERE ocr <> '' GROUP BY video_id, idx, ocr),
cap_first AS (SELECT video_id, idx, caption, min(frame_idx) AS seen_at FROM seen WHERE caption IS NOT NULL GROUP BY video_id, idx, caption),
visual AS (SELECT k.video_id, k.idx, o.ocr_text, c.visual_caption FROM (SELECT DISTINCT video_id, idx FROM inside) k
    LEFT JOIN (SELECT video_id, idx, string_agg(ocr, chr(10) ORDER BY seen_at) AS ocr_text FROM ocr_first GROUP BY video_id, idx) o ON o.video_id = k.video_id AND o.idx = k.idx
    LEFT JOIN (SELECT video_id, idx, string_agg(caption, ' ' ORDER BY seen_at) AS visual_caption FROM cap_first GROUP BY video_id, idx) c ON c.video_id = k.video_id AND c.idx = k.idx)
"""
)

_ALT = _stamp_fold("alt", "SELECT video_id, CAST(unnest(range(0, CAST(ceil(duration_sec / 5) AS BIGINT))) * 5 AS DOUBLE) AS at_sec FROM media WHERE duration_sec > 0 UNION ALL SELECT s.video_id, s.at_sec FROM scenes s", 0.1)


def _embedding(parts: list[str]) -> str:
    listed = ", ".join(f"coalesce({_trim(p)}, '')" for p in parts)
    return f"array_to_string(list_filter([{listed}], lambda p: p <> ''), chr(10) || chr(10))"


_STAGES = "['probe', 'audio', 'asr', 'silence', 'scene', 'frames', 'coarse', 'semantic', 'normalize', 'annotate']"
_MS = "CAST(round(at_sec * 1000) AS BIGINT)"

ORACLE_SQL: dict[str, str] = {
    "fx_transcript": _FX + "SELECT video_id, seg_idx, start_sec, end_sec, text, speaker FROM transcript",
    "fx_signals": _FX + "SELECT * FROM signals",
    "silence_intervals": _SILENCE + "SELECT * FROM silences",
    "silence_log_parse": _SILENCE + "SELECT * FROM silences",
    "scene_log_parse": _FX + "SELECT video_id, CAST(row_number() OVER (PARTITION BY video_id ORDER BY at_sec, event_id) - 1 AS INTEGER) AS pos, at_sec FROM signals WHERE event_type IN ('view', 'signup')",
    "timecode_parse": _FX + f"SELECT event_id, {_tc('at_sec')} AS tc, CAST({_MS} // 3600000 AS DOUBLE) * 3600 + CAST({_MS} // 60000 % 60 AS DOUBLE) * 60 + CAST({_MS} % 60000 AS DOUBLE) / 1000 AS seconds FROM signals",
    "probe_parse": """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 0.0::DOUBLE ELSE o_orderkey + 0.5::DOUBLE END AS duration_sec, CASE WHEN o_orderkey % 2 = 1 THEN o_orderkey / 2.0::DOUBLE ELSE 30000.0::DOUBLE / 1001 END AS fps,
        CAST(CASE WHEN o_orderkey % 2 = 1 THEN o_orderkey ELSE 640 END AS INTEGER) AS width, 480 AS height, true AS has_video, o_orderkey % 3 <> 0 AS has_audio FROM orders""",
    "fraction_parse": "SELECT event_id, CASE WHEN event_id % 11 = 0 OR event_id % 13 = 0 THEN NULL ELSE CAST(event_id * 1000 AS DOUBLE) / (event_id % 97 + 1) END AS value FROM events",
    "asr_json_parse": _FX + f"SELECT video_id, CAST(row_number() OVER (PARTITION BY video_id ORDER BY seg_idx) - 1 AS INTEGER) AS pos, start_sec, end_sec, {_trim('text')} AS text FROM transcript WHERE {_trim('text')} <> ''",
    "jsonl_validate": f"SELECT count(*) FILTER (WHERE json_valid(line)) AS valid, count(*) FILTER (WHERE NOT json_valid(line)) AS invalid FROM (SELECT CASE WHEN event_id % 7 = 0 THEN left(props, length(props) - 1) ELSE props END AS line FROM events) q WHERE {_trim('line')} <> ''",
    "coarse_segments": _COARSE + "SELECT * FROM coarse",
    "coarse_transcript": _SEMANTIC + "SELECT * FROM coarse_text",
    "segment_invariants": _COARSE
    + """SELECT s.video_id, count(*) AS segments, abs(arg_min(s.start_sec, s.seg_index)) <= 0.01 AS starts_at_zero, abs(arg_max(s.end_sec, s.seg_index) - m.duration_sec) <= 0.01 AS ends_at_duration, bool_and(coalesce(abs(s.nxt - s.end_sec) <= 0.01, true)) AS continuous, bool_and(s.end_sec > s.start_sec) AS positive
        FROM (SELECT *, lead(start_sec) OVER (PARTITION BY video_id ORDER BY seg_index) AS nxt FROM coarse) s JOIN media m ON m.video_id = s.video_id GROUP BY s.video_id, m.duration_sec""",
    "semantic_chunks": _SEMANTIC + "SELECT * FROM semantic",
    "equal_division": _SEMANTIC + "SELECT p.video_id, p.seg_index, p.j AS part, p.start_sec, p.end_sec, c.transcript_text FROM piece p JOIN coarse_text c ON c.video_id = p.video_id AND c.seg_index = p.seg_index",
    "model_chunks": _SEMANTIC + """, halves AS (SELECT *, CASE j WHEN 0 THEN 0.0::DOUBLE ELSE end_sec / 2 END AS a, CASE j WHEN 0 THEN end_sec / 2 ELSE end_sec END AS b FROM (SELECT *, unnest([0, 1]) AS j FROM coarse_text) q WHERE round(end_sec * 1000) % 3 <> 2)
SELECT video_id, seg_index * 1000000 + j AS ord, a AS start_sec, b AS end_sec, 'Segment from ' || printf('%.1f', a) || 's to ' || printf('%.1f', b) || 's' AS transcript_text, CASE j WHEN 0 THEN 'first' ELSE 'second' END AS rationale FROM halves
UNION ALL SELECT p.video_id, p.seg_index * 1000000 + p.j, p.start_sec, p.end_sec, c.transcript_text, 'Fallback equal division' FROM piece p JOIN coarse_text c ON c.video_id = p.video_id AND c.seg_index = p.seg_index WHERE round(c.end_sec * 1000) % 3 = 2""",
    "merged_chunks": _MERGED + "SELECT * FROM merged",
    "split_chunks": _SEMANTIC + _split("SELECT video_id, seg_index AS ord, start_sec, end_sec, transcript_text, 'coarse' AS rationale FROM coarse_text"),
    "normalized_chunks": _NORMAL + "SELECT * FROM normal",
    "frame_timestamps": _FX + "," + _STAMPS + "SELECT video_id, CAST(frame_idx AS INTEGER) AS frame_idx, at_sec FROM stamps",
    "frame_kinds": _FX + "," + _STAMPS + "SELECT video_id, CAST(frame_idx AS INTEGER) AS frame_idx, at_sec, kind FROM kinds",
    "dhash_pack": "WITH " + _HASHES + "SELECT * FROM hashes",
    "dhash_hamming": "WITH " + _HASHES + "SELECT grp, seq, CAST(bit_count(xor(hash, before)) AS INTEGER) AS distance FROM (SELECT *, lag(hash) OVER (PARTITION BY grp ORDER BY seq) AS before FROM hashes) q WHERE before IS NOT NULL",
    "frame_dedupe": "WITH RECURSIVE " + _HASHES + "," + _hash_fold("unlike", "SELECT * FROM hashes", 24) + " SELECT * FROM unlike",
    "alt_frame_timeline": _FX + "," + _ALT + " SELECT video_id, CAST(frame_idx AS INTEGER) AS frame_idx, at_sec FROM alt",
    "caption_topk": _NORMAL + "," + _FRAMES + "," + _INSIDE + "," + _captioned(2) + " SELECT video_id, CAST(frame_idx AS INTEGER) AS frame_idx FROM captioned",
    "even_k_of_n": _NORMAL + "," + _ALT + """, half AS (SELECT a.*, c.idx FROM alt a JOIN normal c ON c.video_id = a.video_id AND a.at_sec >= c.start_sec AND a.at_sec < c.end_sec),
        ranked AS (SELECT *, count(*) OVER (PARTITION BY video_id, idx) AS n, row_number() OVER (PARTITION BY video_id, idx ORDER BY frame_idx) - 1 AS r FROM half)
        SELECT video_id, idx, CAST(frame_idx AS INTEGER) AS frame_idx, at_sec FROM ranked WHERE n <= 3 OR r IN (0, CAST(floor(n / 3.0::DOUBLE) AS BIGINT), CAST(floor(2 * (n / 3.0::DOUBLE)) AS BIGINT))""",
    "chunk_visual": _NORMAL + "," + _VISUAL + "SELECT * FROM visual",
    "chunk_image_refs": _NORMAL + "," + _FRAMES + "," + _INSIDE + " SELECT video_id, idx, CAST(row_number() OVER (PARTITION BY video_id, idx ORDER BY frame_idx) - 1 AS INTEGER) AS pos, path, at_sec, kind, true AS analyzed FROM inside",
    "summarize": f"SELECT doc_id, {_summary('text')} AS summary FROM documents",
    "keywords": f"SELECT doc_id, {_keywords(_title(_trim('text')), 'text')} AS keywords FROM documents",
    "fallback_titles": f"SELECT doc_id, {_title('text')} AS title, CASE WHEN strlen(f) > 50 THEN {_prefix('f', 47)} || '...' ELSE f END AS short_title FROM (SELECT doc_id, text, CASE WHEN {_first_words('text', 10)} = '' THEN 'Segment ' || CAST(doc_id AS VARCHAR) ELSE {_first_words('text', 10)} END AS f FROM documents) q",
    "embedding_text": f"SELECT doc_id, 'sha256:' || sha256({_embedding([_title('text'), _summary('text'), 'text', chr(39).join(['nullif(lang, ', 'fr', ')']), 'source'])}) AS text_hash FROM documents",
    "timecodes": _FX + f"SELECT event_id, {_tc('at_sec')} AS tc, {_tc('at_sec')} || '-' || {_tc('(at_sec + 61.5::DOUBLE)')} AS span, {_clock('at_sec * 9')} AS clock FROM signals",
    "source_hashes": "SELECT page_id, 'sha256:' || sha256(html) AS source_hash FROM pages",
    "llm_reply_validate": _SEMANTIC
    + """SELECT video_id * 1000 + seg_index AS key, bool_and(coalesce(end_sec <= nxt AND nxt - end_sec <= 0.01, abs(end_sec - segment_end) <= 0.01) AND (r > 1 OR abs(start_sec) <= 0.01) AND end_sec > start_sec) AS valid
        FROM (SELECT p.*, c.end_sec AS segment_end, lead(p.start_sec) OVER w AS nxt, row_number() OVER w AS r FROM piece p JOIN coarse c ON c.video_id = p.video_id AND c.seg_index = p.seg_index WINDOW w AS (PARTITION BY p.video_id, p.seg_index ORDER BY p.j)) q GROUP BY video_id, seg_index""",
    "annotated_chunks": _ANNOTATED + "SELECT * FROM annotated",
    "markdown_doc": _ANNOTATED
    + f"""SELECT video_id, '# Video Analysis: ' || CAST(video_id AS VARCHAR) || chr(10) || chr(10) || '## Contents' || chr(10) || chr(10)
        || string_agg(CAST(idx + 1 AS VARCHAR) || '. [' || title || '](#' || CAST(idx AS VARCHAR) || ') - ' || {_clock("start_sec")} || chr(10), '' ORDER BY idx) || chr(10) || '---' || chr(10) || chr(10)
        || string_agg('## ' || CAST(idx + 1 AS VARCHAR) || ' - ' || title || ' (' || {_clock("start_sec")} || '–' || {_clock("end_sec")} || ')' || chr(10) || chr(10) || '**Summary:** ' || summary || chr(10) || chr(10)
            || '**Keywords:** ' || replace(keywords, ',', ', ') || chr(10) || chr(10) || CASE WHEN transcript_text <> '' THEN '**Transcript:**' || chr(10) || '```' || chr(10) || transcript_text || chr(10) || '```' || chr(10) || chr(10) ELSE '' END
            || chr(10) || '---' || chr(10) || chr(10), '' ORDER BY idx) AS document FROM annotated GROUP BY video_id""",
    "chunk_jsonl": _ANNOTATED + "SELECT chunk_id, title, summary, string_split(keywords, ',')[1] AS first_keyword, transcript_text, parent_segment_id FROM annotated",
    "output_index": _NORMAL + "SELECT m.video_id, count(n.idx) AS total_chunks, m.duration_sec AS total_duration_sec, 'chunks.jsonl' AS chunks_file, 'chunks.md' AS markdown_file FROM media m LEFT JOIN normal n ON n.video_id = m.video_id GROUP BY m.video_id, m.duration_sec",
    "manifest_pending": _FX
    + f"""SELECT w.video_id, w.stage, w.input_hash FROM (SELECT video_id, unnest({_STAGES}) AS stage, 'h' || CAST(dur_ms AS VARCHAR) AS input_hash FROM media) w
        WHERE NOT EXISTS (SELECT 1 FROM signals s JOIN media m ON m.video_id = s.video_id WHERE s.video_id = w.video_id AND {_STAGES}[abs(s.event_id) % 10 + 1] = w.stage AND abs(s.event_id) % 3 <> 0 AND abs(s.event_id) % 2 = 0)""",
    "stage_cache": "SELECT conv_id AS video_id, 'sha256:' || sha256('{\"video_id\":' || conv_id || ',\"dur_ms\":' || CAST(sum(greatest(500, 120 * length(text))) AS BIGINT) || ',\"stage\":\"coarse\",\"note\":null}') AS cache_key, true AS changes FROM conversations GROUP BY conv_id",
    "estimate": "SELECT doc_id, CAST(trunc(greatest(n_chars * 100000 / 1048576.0::DOUBLE / 10, 5)) AS BIGINT) AS chunks, CAST(ceil(n_chars * 100000 / 1048576.0::DOUBLE * 0.5::DOUBLE) AS BIGINT) AS output_mb, CAST(ceil(n_chars * 100000 / 1048576.0::DOUBLE / 50) AS BIGINT) AS minutes FROM documents",
    "media_names": r"""
WITH p AS (SELECT page_id, list_last(string_split(regexp_replace(url, '\?.*$', '') || CASE page_id % 3 WHEN 0 THEN '.tar.gz' WHEN 1 THEN '/' ELSE '' END, '/')) AS name FROM pages),
q AS (SELECT page_id, CASE WHEN regexp_extract(name, '^(.+?)(\.[^.]*)?$', 1) = '' THEN 'video' ELSE regexp_extract(name, '^(.+?)(\.[^.]*)?$', 1) END AS video_id FROM p)
SELECT page_id, video_id, video_id || '/' || printf('frame_%03d.jpg', page_id) AS frame_path, CAST(least(greatest(32 - (page_id % 101) // 4, 1), 31) AS INTEGER) AS quality FROM q""",
    "chunks": _ANNOTATED
    + ","
    + _VISUAL
    + f""", images AS (SELECT video_id, idx, count(*) AS n FROM inside GROUP BY video_id, idx)
        SELECT '1.0' AS schema_version, CAST(a.video_id AS VARCHAR) AS video_id, 'local_mp4' AS source_type, 'media/' || CAST(a.video_id AS VARCHAR) || '.mp4' AS source_path, 'sha256:' || sha256(CAST(m.dur_ms AS VARCHAR)) AS source_hash, a.chunk_id, a.parent_segment_id, a.start_sec, a.end_sec,
        {_tc("a.start_sec")} AS start_tc, {_tc("a.end_sec")} AS end_tc, greatest(a.end_sec - a.start_sec, 0) AS duration_sec, 'screen_recording' AS content_type, a.title, a.summary, a.transcript_text AS transcript, v.ocr_text, v.visual_caption, a.keywords,
        sha256({_embedding(["a.title", "a.summary", "a.transcript_text", "v.ocr_text", "v.visual_caption"])}) AS embedding_hash, CAST(coalesce(i.n, 0) AS INTEGER) AS n_images, 'local' AS jump_type, {_trim("a.transcript_text")} <> '' AS has_speech, v.ocr_text IS NOT NULL AS has_ocr, coalesce(i.n, 0) > 0 AS has_visual,
        'coarse+time-based semantic segmentation' AS segmentation_rationale FROM annotated a JOIN media m ON m.video_id = a.video_id LEFT JOIN visual v ON v.video_id = a.video_id AND v.idx = a.idx LEFT JOIN images i ON i.video_id = a.video_id AND i.idx = a.idx""",
}
ORACLE_SQL["coarse_segments_chained"], ORACLE_SQL["merged_chunks_chained"] = ORACLE_SQL["coarse_segments"], ORACLE_SQL["merged_chunks"]
ORACLE_SQL["stored_outputs"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
one AS (SELECT DISTINCT sha256(html) AS h FROM p WHERE page_id % 3 <> 0 AND sha256(html) NOT LIKE '%0'),
two AS (SELECT page_id, CASE WHEN page_id % 5 = 0 THEN html || 'x' ELSE html END AS html FROM p)
SELECT page_id, 'sha256:' || sha256(html) AS source_hash, CAST(length(html) AS VARCHAR) AS output, CAST(NULL AS VARCHAR) AS error, CASE WHEN h IS NULL THEN CAST(2 AS BIGINT) ELSE 1 END AS run FROM two LEFT JOIN one ON h = sha256(html)"""
