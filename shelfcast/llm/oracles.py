"""SQL counterparts of the registered queries, for DuckDB."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op4_url_filters"] = r"""
WITH rules(rule_host, rule_path, verdict) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
           ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
rest AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r
    FROM pages),
split AS (
    SELECT page_id,
           translate(regexp_extract(r, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rest),
best AS (
    SELECT s.page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
           arg_max(verdict, length(rule_host || rule_path)) AS verdict
    FROM split s JOIN rules ON (s.host = rule_host OR ends_with(s.host, '.' || rule_host))
                           AND starts_with(s.path, rule_path)
    GROUP BY s.page_id)
SELECT s.page_id, s.host, s.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM split s LEFT JOIN best b ON b.page_id = s.page_id
"""


ORACLES["op1_line_dedup"] = r"""
WITH raw AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
    FROM documents WHERE text IS NOT NULL),
lines AS (
    SELECT doc_id, line_no,
           list_filter(string_split_regex(lower(line),
                                          '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM raw),
placed AS (
    SELECT doc_id, line_no, len(words) AS n, words, md5(array_to_string(words, ' ')) AS key,
           {'id': doc_id, 'no': line_no} AS place
    FROM lines WHERE len(words) > 0),
uniq AS (SELECT key, any_value(words) AS words, any_value(n) AS n, min(place) AS place FROM placed GROUP BY key),
cuts AS (
    SELECT key, place, i, md5(array_to_string(words[:i - 1] || words[i + 1:], ' ')) AS rest
    FROM (SELECT *, unnest(generate_series(1, n)) AS i FROM uniq WHERE n >= 8)),
near AS (
    SELECT a.key, b.place FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i
    UNION ALL SELECT a.key, b.place FROM cuts a JOIN uniq b ON a.rest = b.key AND b.n >= 8
    UNION ALL SELECT b.key, a.place FROM cuts a JOIN uniq b ON a.rest = b.key AND b.n >= 8
    UNION ALL SELECT key, place FROM uniq),
best AS (SELECT key, min(place) AS place FROM near GROUP BY key)
SELECT p.doc_id, p.line_no, p.n AS n_words, p.place = b.place AS kept,
       b.place.id AS first_doc_id, b.place.no AS first_line_no
FROM placed p JOIN best b USING (key)
"""


ORACLES["op8_quality_rules"] = r"""
WITH split AS (
    SELECT doc_id, lang, source, coalesce(text, '') AS text,
           list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM documents),
spots AS (
    SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS five
    FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 4)) AS i FROM split WHERE len(words) >= 5)),
twice AS (SELECT doc_id, i FROM spots QUALIFY count(*) OVER (PARTITION BY doc_id, five) > 1),
covered AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 4)) AS at_word FROM twice),
repeats AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id),
counts AS (
    SELECT s.doc_id, s.lang, s.source, len(words) AS n_words,
           coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
           len(lines) AS n_lines,
           len(list_filter(words, lambda w: regexp_matches(w, '[A-Z]') AND NOT regexp_matches(w, '[a-z]'))) AS n_upper_words,
           len(list_filter(words, lambda w, i: i > 1 AND w = words[i - 1])) AS n_echo_words
    FROM split s LEFT JOIN repeats r USING (doc_id)),
based AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts),
metrics AS (
    SELECT doc_id, lang, source, base_failed, unnest([
        {'m': 'word_length', 'v': 100 * word_chars // greatest(n_words, 1), 'slack': 450, 'low': true},
        {'m': 'symbols', 'v': 1000 * n_symbols // greatest(word_chars, 1), 'slack': 15, 'low': false},
        {'m': 'dup_lines', 'v': 1000 * n_dup_lines // greatest(n_lines, 1), 'slack': 250, 'low': false},
        {'m': 'repeats', 'v': 1000 * n_repeat_words // greatest(n_words, 1), 'slack': 150, 'low': false},
        {'m': 'echoes', 'v': 1000 * n_echo_words // greatest(n_words, 1), 'slack': 100, 'low': false},
        {'m': 'upper', 'v': 1000 * n_upper_words // greatest(n_words, 1), 'slack': 150, 'low': false}], recursive := true)
    FROM based),
binned AS (
    SELECT *, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS b FROM metrics WHERE NOT base_failed),
levels AS (
    SELECT 2 AS level, lang, source, m, slack, low, b FROM binned
    UNION ALL SELECT 1, lang, NULL, m, slack, low, b FROM binned
    UNION ALL SELECT 0, NULL, NULL, m, slack, low, b FROM binned),
ranked AS (
    SELECT *, count(*) OVER g AS n, count(*) OVER (PARTITION BY level, lang, source, m ORDER BY b) AS upto
    FROM levels WINDOW g AS (PARTITION BY level, lang, source, m)),
quartiles AS (
    SELECT level, lang, source, m, slack, low, min(b) FILTER (4 * upto >= n) AS q1, min(b) FILTER (4 * upto >= 3 * n) AS q3
    FROM ranked WHERE n >= 40 GROUP BY ALL),
cut AS (
    SELECT level, lang, source, m, q3 + 3 * (q3 - q1) + slack AS high,
           CASE WHEN low THEN q1 - 3 * (q3 - q1) - slack END AS low FROM quartiles),
judged AS (
    SELECT d.doc_id, bool_and(coalesce(v <= coalesce(a.high, b.high, c.high), true)
                              AND coalesce(v >= coalesce(a.low, b.low, c.low), true)) AS fits
    FROM metrics d
    LEFT JOIN cut a ON a.level = 2 AND a.lang IS NOT DISTINCT FROM d.lang AND a.source IS NOT DISTINCT FROM d.source AND a.m = d.m
    LEFT JOIN cut b ON b.level = 1 AND b.lang IS NOT DISTINCT FROM d.lang AND b.m = d.m
    LEFT JOIN cut c ON c.level = 0 AND c.m = d.m
    GROUP BY d.doc_id)
SELECT b.* EXCLUDE (lang, source), NOT base_failed AND fits AS kept FROM based b JOIN judged USING (doc_id)
"""

# Base kinds, then the added ones; matches and the gaps between them give the offsets.
ORACLES["op9_secret_scans"] = r"""
WITH rules(rank, kind, pattern, keep) AS (VALUES
    (0, 'assign', '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+',
        '^(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]{6,}$'),
    (1, 'access', 'AKIA[A-Z0-9]+', '^.{20,}$'),
    (2, 'hex', '[0-9a-f]+', '^.{24,}$'),
    (3, 'pem', '-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----', ''),
    (4, 'github', 'gh[pousr]_[A-Za-z0-9]{36,}', ''),
    (5, 'slack', 'xox[abprs]-[A-Za-z0-9-]{10,}', ''),
    (6, 'jwt', 'eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}', '')),
hits AS (
    SELECT doc_id, 0 AS rank, regexp_extract_all(coalesce(text, ''), (SELECT pattern FROM rules WHERE rank = 0)) AS ms,
           string_split_regex(coalesce(text, ''), (SELECT pattern FROM rules WHERE rank = 0)) AS gaps FROM documents
    {more}),
placed AS (
    SELECT doc_id, rank, unnest(ms) AS m, unnest(gaps[1:len(ms)]) AS gap, generate_subscripts(ms, 1) AS i
    FROM hits WHERE len(ms) > 0),
ends AS (
    SELECT doc_id, rank, m, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, rank ORDER BY i)::BIGINT AS e FROM placed),
spans AS (
    SELECT doc_id, r.rank, kind, e - length(m) AS s, e, kind || ':' || (e - length(m))::VARCHAR || ':' || e::VARCHAR AS span
    FROM ends JOIN rules r USING (rank) WHERE keep = '' OR regexp_matches(m, keep)),
digest AS (
    SELECT doc_id, count(*) FILTER (rank = 0) AS a, count(*) FILTER (rank = 1) AS k, count(*) FILTER (rank = 2) AS h,
           string_agg(span, ',' ORDER BY s, rank) FILTER (rank < 3) AS base, string_agg(span, ',' ORDER BY s, rank) AS every
    FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM documents LEFT JOIN digest USING (doc_id)
""".replace(
    "{more}",
    "".join(
        f"""UNION ALL SELECT doc_id, {rank}, regexp_extract_all(coalesce(text, ''), (SELECT pattern FROM rules WHERE rank = {rank})),
           string_split_regex(coalesce(text, ''), (SELECT pattern FROM rules WHERE rank = {rank})) FROM documents
    """
        for rank in range(1, 7)
    ),
)

ORACLES["op11_top_k_search"] = r"""
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
    FROM vectors q JOIN vectors c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM pairs QUALIFY rank <= 5
"""

ORACLES["op12_lexical_search"] = r"""
WITH said AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
total AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM said),
postings AS (
    SELECT doc_id, term, count(*) AS tf, any_value(n) AS n
    FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM said)
    WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term),
weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM postings, total GROUP BY term),
parts AS (
    SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))) AS part
    FROM postings JOIN weights USING (term), total),
scores AS (SELECT item_id, doc_id, sum(part)::BIGINT AS score FROM asked JOIN parts USING (term) GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
