"""DuckDB SQL for the queries that SQL can express; the others are tested against brute force."""

from __future__ import annotations

from waterline.llm.licenses import PER_CENT, TEMPLATES, bigrams
from waterline.llm.sharding import SLACK

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def license_sql() -> str:
    listed = [(name, bigrams(t)) for name, texts in TEMPLATES.items() for t in texts]
    rows = ", ".join(f"({name!r}, [{', '.join(map(repr, grams))}])" for name, grams in listed)
    return rf"""
WITH templates AS (SELECT * FROM (VALUES {rows}) AS t(license, tg)),
lines AS (
  SELECT doc_id, 'line' AS kind, unnest(string_split(text, chr(10))) AS unit,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS place
  FROM documents WHERE text IS NOT NULL),
paragraphs AS (
  SELECT doc_id, 'paragraph' AS kind, unnest(string_split_regex(text, '\n[ \t\r]*\n')) AS unit,
         generate_subscripts(string_split_regex(text, '\n[ \t\r]*\n'), 1) - 1 AS place
  FROM documents WHERE text IS NOT NULL),
units AS (SELECT * FROM lines UNION ALL SELECT * FROM paragraphs WHERE contains(unit, chr(10))),
worded AS (SELECT doc_id, kind, place, regexp_extract_all(lower(unit), '[a-z0-9]+') AS w FROM units),
paired AS (
  SELECT doc_id, kind, place, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g
  FROM worded WHERE len(w) > 1),
compared AS (
  SELECT doc_id, kind, place, license, len(list_intersect(g, tg)) AS common, len(g) + len(tg) AS sizes FROM paired, templates),
hits AS (
  SELECT doc_id, license, kind, place, max(common * 2.0::DOUBLE / sizes) AS dice
  FROM compared WHERE common * 200 >= {PER_CENT} * sizes GROUP BY ALL)
SELECT doc_id, license, max(dice) AS dice, coalesce(min(place) FILTER (kind = 'line'), -1)::INT AS line,
       coalesce(min(place) FILTER (kind = 'paragraph'), -1)::INT AS paragraph, count(*) AS n_units
FROM hits GROUP BY doc_id, license"""


def near_duplicate_sql() -> str:
    return r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM worded),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k
  FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared WHERE 100 * k >= 75 * (na + nb - k)
  UNION ALL SELECT b, a FROM shared WHERE 100 * k >= 75 * (na + nb - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
groups AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN groups USING (doc_id)"""


#: Of the adaptive rules: count, of which count, upper per cent, reach, and least distance. Spelt out, so that they are checked.
_RULES = {
    "marks": ("_marks", "word_chars", 90, 5, 20),
    "word_length": ("word_chars", "n_words", 90, 5, 500),
    "dup_lines": ("n_dup_lines", "_lines", 99, 3, 300),
    "repeats": ("n_repeat_words", "n_words", 99, 3, 100),
}


def quality_rules_sql() -> str:
    rates = ", ".join(f"{{'rate': '{n}', 'v': {a} * 1000 // greatest({b}, 1)}}" for n, (a, b, *_) in _RULES.items())
    high = " ".join(
        f"WHEN '{n}' THEN q50 + greatest({reach} * (q{q} - q50), {least})" for n, (_, _, q, reach, least) in _RULES.items()
    )
    columns = ", ".join(f"max(low) FILTER (rate = '{n}') AS {n}_low, max(high) FILTER (rate = '{n}') AS {n}_high" for n in _RULES)
    within = " AND ".join(f"({a} * 1000 // greatest({b}, 1)) BETWEEN {n}_low AND {n}_high" for n, (a, b, *_) in _RULES.items())
    return rf"""
WITH worded AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS body, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM worded)),
repeated AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, x) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, range(5) AS r(k) GROUP BY 1),
counted AS (
  SELECT d.doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(array_to_string(w, ''), '[\p{{L}}\p{{N}}\p{{M}}]+', '', 'g')) AS _marks,
         len(regexp_extract_all(body, '[#*$%&|<>]')) AS n_symbols, len(l) AS _lines,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM worded d LEFT JOIN covered c USING (doc_id)),
based AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted),
measured AS (SELECT lang, source, unnest([{rates}], recursive := true) FROM based WHERE NOT base_failed),
bucketed AS (
  SELECT lang, source, rate, v - v % (1::BIGINT << greatest(0, length(bin(v)) - 9)) AS bucket, count(*) AS n FROM measured GROUP BY ALL),
levels AS (
  SELECT level, CASE WHEN level < 2 THEN lang END AS lang, CASE WHEN level < 1 THEN source END AS source, rate, bucket, sum(n) AS n
  FROM bucketed, range(3) AS r(level) GROUP BY ALL),
running AS (
  SELECT *, sum(n) OVER (PARTITION BY level, lang, source, rate ORDER BY bucket) AS upto,
         sum(n) OVER (PARTITION BY level, lang, source, rate) AS total FROM levels),
quantiles AS (
  SELECT level, lang, source, rate, min(bucket) FILTER (upto * 100 >= total * 10) AS q10, min(bucket) FILTER (upto * 100 >= total * 50) AS q50,
         min(bucket) FILTER (upto * 100 >= total * 90) AS q90, min(bucket) FILTER (upto * 100 >= total * 99) AS q99, max(total) AS total
  FROM running GROUP BY ALL),
sides AS (
  SELECT *, CASE WHEN rate <> 'word_length' THEN -1 ELSE q50 - greatest(5 * (q50 - q10), 500) END AS low, CASE rate {high} END AS high
  FROM quantiles),
limits AS (SELECT level, lang, source, {columns}, max(total) AS total FROM sides GROUP BY level, lang, source),
judged AS (
  SELECT b.*, NOT base_failed AND coalesce({within}, true) AS kept
  FROM based b LEFT JOIN limits l ON (l.total >= 50 OR l.level = 2)
       AND (l.level = 2 OR l.lang IS NOT DISTINCT FROM b.lang) AND (l.level > 0 OR l.source IS NOT DISTINCT FROM b.source)
  QUALIFY row_number() OVER (PARTITION BY b.doc_id ORDER BY l.level) = 1)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed, kept FROM judged"""


def chat_sql() -> str:
    escaped = r"length(replace(replace({}, '\', '\\'), '<|', '<\|'))"
    return rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
ordered AS (
  SELECT *, row_number() OVER w AS n, count(*) OVER (PARTITION BY conv_id) AS total,
         sum(24 + {escaped.format('role')} + {escaped.format('text')}) OVER (w ROWS UNBOUNDED PRECEDING) AS upto
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (sum(upto) FILTER (role = 'assistant' OR n = total))::BIGINT AS formatted_chars
FROM ordered GROUP BY conv_id"""


def shard_sql(shards: int = 8) -> str:
    return rf"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
hashed AS (
  SELECT doc_id, md5(coalesce(text, '')) AS h, octet_length(encode(coalesce(text, ''))) + 1 AS size,
         xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
             lambda x: ('0x' || x)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM documents, crc_table),
laid AS (
  SELECT *, sum(size) OVER w - size AS start, sum(size) OVER () AS total, sum(size) OVER (PARTITION BY h) AS group_bytes
  FROM hashed WINDOW w AS (ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING)),
grouped AS (SELECT *, min(start) OVER (PARTITION BY h) AS group_start FROM laid),
targets AS (SELECT k, (k * total + {shards} - 1) // {shards} AS target FROM range(1, {shards}) AS r(k), (SELECT any_value(total) AS total FROM laid)),
cuts AS (
  SELECT k, CASE WHEN group_bytes <= {SLACK}::DOUBLE * total / {shards} AND group_start + group_bytes > start + size
                 THEN group_start ELSE start + size END AS cut
  FROM grouped, targets WHERE start < target AND start + size >= target),
placed AS (SELECT g.*, (SELECT count(*) FROM cuts WHERE cut <= g.start) AS shard FROM grouped g)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard::INT AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY start) - 1 AS slot, NULL::INT AS grown_shard FROM placed"""


def filter_audit_sql() -> str:
    return r"""
WITH flagged AS (
  SELECT d.doc_id, coalesce(lang, '') AS part, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, coalesce(text, '') AS body,
         coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic
  FROM documents d LEFT JOIN labels l USING (doc_id)),
failing AS (
  SELECT part, good, toxic, (CASE WHEN len(w) < 100 THEN 'A' ELSE '' END)
         || (CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END)
         || (CASE WHEN 100 * len(regexp_extract_all(body, '[A-Z]')) > 10 * length(body) THEN 'C' ELSE '' END)
         || (CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 'D' ELSE '' END)
         || (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY body) THEN 'E' ELSE '' END) AS fails
  FROM flagged),
counts AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS t FROM failing GROUP BY 1, 2),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT filter_order, step, filter_order[step] AS own, left(filter_order, step - 1) AS before FROM orders, range(1, 6) AS r(step)),
met AS (
  SELECT *, contains(fails, own) AS fails_own,
         len(list_intersect(string_split(fails, ''), string_split(before, ''))) > 0 AND fails <> '' AND before <> '' AS gone
  FROM counts, steps),
audited AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (NOT fails_own AND NOT gone), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (fails_own AND NOT gone), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (fails_own AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (fails = own), 0)::BIGINT AS unique_fails,
         coalesce(sum(g) FILTER (fails_own AND NOT gone), 0)::BIGINT AS good_lost, coalesce(sum(t) FILTER (fails_own AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM met GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM audited"""


def collocation_sql() -> str:
    return r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
occurring AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM placed, range(1, 6) AS r(m) WHERE i + m - 1 <= len(w)),
frequent AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS f FROM occurring GROUP BY ALL HAVING f >= 100),
totals AS (SELECT lang, sum(len(w)) AS n FROM worded GROUP BY 1),
candidates AS MATERIALIZED (SELECT lang, m, phrase, f AS a FROM frequent WHERE m > 1),
cut AS (
  SELECT lang, m, phrase, a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS p, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS q
  FROM candidates, range(1, 5) AS r(k) WHERE k < m),
scored AS (
  SELECT cut.lang, cut.phrase, cut.a, k, l.f AS l, r.f AS r, t.n, (1000::HUGEINT * a * t.n) // (l.f::HUGEINT * r.f) AS score
  FROM cut JOIN frequent l ON l.lang = cut.lang AND l.phrase = p JOIN frequent r ON r.lang = cut.lang AND r.phrase = q JOIN totals t ON t.lang = cut.lang),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
alone AS (
  SELECT * FROM lowest x WHERE NOT EXISTS (
    SELECT 1 FROM candidates c WHERE c.lang = x.lang AND 100 * c.a >= 100 * x.a AND length(c.phrase) > length(x.phrase)
       AND contains(' ' || c.phrase || ' ', ' ' || x.phrase || ' '))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM alone)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000"""


ORACLE: dict[str, str] = {
    "op3_license_dice_scan": license_sql(),
    "op4_minhash_near_duplicates": near_duplicate_sql(),
    "op5_adaptive_quality_rules": quality_rules_sql(),
    "op6_prefix_target_chat": chat_sql(),
    "op10_byte_shards": shard_sql(),
    "op11_filter_interaction_audit": filter_audit_sql(),
    "op13_phrase_collocations": collocation_sql(),
}
