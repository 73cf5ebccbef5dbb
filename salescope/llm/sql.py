"""DuckDB SQL for the queries whose results SQL can state."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP2 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, WORDS_LOWER AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS k FROM w, unnest(range(1, greatest(len(ws) - 1, least(len(ws) + 1, 2)))) t(i)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
ends AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, ends.b FROM reach JOIN ends ON reach.b = ends.a)
SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(b) AS component_id, min(b) = doc_id AS kept
FROM reach JOIN documents d ON d.doc_id = reach.a LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""

OP3 = r"""
WITH w AS (SELECT doc_id, WORDS AS ws FROM documents),
windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS k FROM w, unnest(range(1, len(ws) - 18)) t(i)),
later AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM later, range(20) t(j)),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS whole
  FROM (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w) ANTI JOIN gone USING (doc_id, i) GROUP BY 1
)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(whole, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)
"""


def _percentiles(by: str, depth: int) -> str:
    keys = f"{by}, " if by else ""
    return f"""q{depth} AS (
  SELECT {keys}rate, any_value(size) AS size, min(bucket) FILTER (upto * 100 >= size * 25) AS p25, min(bucket) FILTER (upto * 100 >= size * 50) AS p50,
    min(bucket) FILTER (upto * 100 >= size * 75) AS p75, min(bucket) FILTER (upto * 100 >= size * 90) AS p90, min(bucket) FILTER (upto * 100 >= size * 99) AS p99
  FROM (SELECT {keys}rate, bucket, sum(n) OVER (PARTITION BY {keys}rate ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {keys}rate) AS size
    FROM (SELECT {keys}rate, bucket, count(*) AS n FROM rates GROUP BY ALL)) GROUP BY {keys}rate)"""


OP4 = rf"""
WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, {WORDS} AS ws FROM documents),
triples AS (SELECT doc_id, i, array_to_string(ws[i:i + 2], ' ') AS k FROM w, unnest(range(1, len(ws) - 1)) t(i)),
twice AS (SELECT doc_id, i FROM triples QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
repeats AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, range(3) t(j) GROUP BY 1),
lines AS (SELECT doc_id, count(*) AS n, count(DISTINCT line) AS different FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '[^ 	-
]') GROUP BY 1),
m AS (
  SELECT doc_id, lang, source, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(lines.n - different, 0) AS n_dup_lines,
    coalesce(repeats.n, 0) AS n_repeat_words, lines.n AS n_lines
  FROM w LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)
), r AS (SELECT *, word_chars * 1000 // n_words AS word_length, n_symbols * 10000 // n_words AS symbols, n_dup_lines * 10000 // n_lines AS dup_lines,
    n_repeat_words * 10000 // n_words AS repeats FROM m),
rates AS (
  SELECT lang, source, rate, (v >> greatest(length(bin(v)) - 7, 0)) << greatest(length(bin(v)) - 7, 0) AS bucket
  FROM (UNPIVOT r ON word_length, symbols, dup_lines, repeats INTO NAME rate VALUE v) WHERE n_words > 0
), {_percentiles("lang, source", 0)}, {_percentiles("lang", 1)}, {_percentiles("", 2)},
q AS (
  SELECT q0.lang, q0.source, q0.rate, CASE WHEN q0.size >= 200 THEN q0 WHEN q1.size >= 200 THEN {{'size': q1.size, 'p25': q1.p25, 'p50': q1.p50, 'p75': q1.p75, 'p90': q1.p90, 'p99': q1.p99}}
    ELSE {{'size': q2.size, 'p25': q2.p25, 'p50': q2.p50, 'p75': q2.p75, 'p90': q2.p90, 'p99': q2.p99}} END AS q
  FROM (SELECT lang, source, rate, {{'size': size, 'p25': p25, 'p50': p50, 'p75': p75, 'p90': p90, 'p99': p99}} AS q0, size FROM q0) q0
  LEFT JOIN q1 ON q1.rate = q0.rate AND q1.lang IS NOT DISTINCT FROM q0.lang LEFT JOIN q2 ON q2.rate = q0.rate
), ends AS (
  SELECT *, q.p50 - 8 * (q.p50 - q.p25 + (q.p25 >> 6)) AS low, q.p50 + factor * (tail - q.p50 + (tail >> 6)) AS high
  FROM (SELECT *, CASE rate WHEN 'word_length' THEN 8 ELSE 2 END AS factor, CASE rate WHEN 'word_length' THEN q.p75 WHEN 'symbols' THEN q.p90 ELSE q.p99 END AS tail FROM q)
), bounds AS (
  SELECT lang, source, max(low) FILTER (rate = 'word_length') AS low_word_length, max(high) FILTER (rate = 'word_length') AS high_word_length,
    max(high) FILTER (rate = 'symbols') AS high_symbols, max(high) FILTER (rate = 'dup_lines') AS high_dup_lines, max(high) FILTER (rate = 'repeats') AS high_repeats
  FROM ends GROUP BY ALL
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(word_length >= low_word_length AND word_length <= high_word_length AND symbols <= high_symbols
    AND dup_lines <= high_dup_lines AND repeats <= high_repeats, false) AS kept,
  lang, source, COLUMNS('(low|high)_.*')
FROM (SELECT r.*, b.* EXCLUDE (lang, source), n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM r LEFT JOIN bounds b ON b.lang IS NOT DISTINCT FROM r.lang AND b.source IS NOT DISTINCT FROM r.source)
"""

OP7 = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0
    AND len(embedding) = (SELECT len(embedding) FROM embeddings WHERE embedding IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
), d AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM d
WINDOW w AS (PARTITION BY query_id ORDER BY score, vec_id)
QUALIFY row_number() OVER w <= 10
"""

OP9 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p, count(*) OVER (PARTITION BY conv_id) AS n,
    length('<|turn|><|text|><|end|>') + length(replace(replace(role || text, '\', '\\'), '|', '\p')) AS size
  FROM t
), s AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY p) AS upto FROM o)
SELECT conv_id, max(n) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY p)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY p) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (role = 'assistant' OR p = n) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id
"""

_NUMBERS = "embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0"


def _round(k: int) -> str:
    """Nearest entries of the books of round ``k``, and the books after it."""
    return f"""d{k} AS (
  SELECT vec_id, p, e, CAST(list_sum([(v[i] - c[i]) * (v[i] - c[i]) FOR i IN range(1, len(v) + 1)]) AS BIGINT) AS far FROM parts JOIN book{k} USING (p)
), near{k} AS (SELECT vec_id, p, e, far FROM d{k} QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY far, e) = 1),
sums{k} AS (
  SELECT p, e, i, sum(v[i]) AS s, count(*) AS n FROM near{k} JOIN parts USING (vec_id, p), unnest(range(1, len(v) + 1)) t(i) GROUP BY ALL
), means{k} AS (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM sums{k} GROUP BY ALL),
book{k + 1} AS (SELECT p, e, coalesce(means{k}.c, book{k}.c) AS c FROM book{k} LEFT JOIN means{k} USING (p, e))"""


OP11 = f"""
WITH k AS (SELECT vec_id, label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings WHERE {_NUMBERS}),
parts AS (SELECT vec_id, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS v FROM k, range(16) t(p)),
firsts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k ORDER BY vec_id LIMIT 64),
book0 AS (SELECT p, e, v AS c FROM parts JOIN firsts USING (vec_id)),
{_round(0)}, {_round(1)}, {_round(2)},
coded AS (SELECT vec_id, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(far) AS BIGINT) AS error FROM near2 GROUP BY 1)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256
FROM coded JOIN k USING (vec_id)
"""

OP12 = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE {_NUMBERS} AND label IS NOT NULL AND len([x FOR x IN embedding IF x <> 0]) > 0
), ends AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.93),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, ends.b FROM reach JOIN ends ON reach.b = ends.a),
n AS (SELECT a, count(*) AS n FROM ends GROUP BY 1)
SELECT reach.a AS vec_id, coalesce(any_value(n.n), 0) AS n_links, min(b) AS component_id, min(b) = reach.a AS kept FROM reach LEFT JOIN n USING (a) GROUP BY reach.a
"""

OP13 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
f AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS p, count(*) AS f FROM w, range(1, 5) t(k), unnest(range(1, len(ws) - k + 2)) u(i) GROUP BY ALL
), c AS (SELECT lang, k, p, f AS a, string_split(p, ' ') AS ws FROM f WHERE k > 1 AND f >= 30),
cuts AS (
  SELECT c.*, x.f AS l, y.f AS r, j, (2000000 * CAST(a AS HUGEINT)) // (x.f + y.f) AS score
  FROM (SELECT c.*, unnest(range(1, k)) AS j FROM c) c
  JOIN f x ON x.lang = c.lang AND x.p = array_to_string(ws[1:j], ' ') JOIN f y ON y.lang = c.lang AND y.p = array_to_string(ws[j + 1:], ' ')
), low AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, j) = 1),
inside AS (
  SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS p, max(a) AS longer FROM c, unnest(range(2, k)) t(m), unnest(range(1, k - m + 2)) u(i) GROUP BY ALL
), n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY 1)
SELECT lang, row_number() OVER best AS rank, p AS phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM low JOIN n USING (lang) LEFT JOIN inside USING (lang, p) WHERE longer IS NULL OR 100 * longer < 80 * a
WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, encode(p)) QUALIFY row_number() OVER best <= 2000
"""

SQL: dict[str, str] = {
    "op2_near_duplicates": OP2.replace("WORDS_LOWER", "[translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FOR x IN " + WORDS + "]"),
    "op3_repeated_passages": OP3.replace("WORDS", WORDS),
    "op4_quality_rules": OP4,
    "op7_nearest_neighbours": OP7,
    "op9_chat_examples": OP9,
    "op11_vector_codes": OP11,
    "op12_near_vectors": OP12,
    "op13_collocations": OP13,
}
