"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

LINE_DEDUP = f"""
WITH doc AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS all_lines FROM documents),
line AS (
  SELECT doc_id, unnest(all_lines) AS line, unnest(range(len(all_lines))) AS pos FROM doc
),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^{SPACE}+|{SPACE}+$', '', 'g'), '{UPPER}', '{UPPER.lower()}') AS key FROM line
),
shared AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
),
judged AS (
  SELECT doc_id, pos, line, s.key IS NOT NULL AND doc_id <> s.last AS dropped
  FROM keyed LEFT JOIN shared s USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

NEAR_DEDUP = rf"""
WITH RECURSIVE doc AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{WORD}') AS w FROM documents
),
shingle AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + least(5, len(w)) - 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS p FROM doc WHERE len(w) > 0)
),
sized AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
edge AS MATERIALIZED (
  SELECT a, b FROM common c JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)
),
reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM doc UNION SELECT edge.b, reach.root FROM reach JOIN edge ON edge.a = reach.doc_id
)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(root) AS component_id, doc_id = min(root) AS kept
FROM reach LEFT JOIN sized USING (doc_id) GROUP BY doc_id
"""

SUFFIX_DEDUP = """
WITH doc AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
-- Cut in two steps, as finding a place in a long string takes as long as the place is far.
part AS (
  SELECT doc_id, c, substr(h, (2 * c + 1)::BIGINT, 1098) AS h
  FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2, 500)) AS c FROM doc)
),
win AS (
  SELECT doc_id, c + p AS p, substr(h, (2 * p + 1)::BIGINT, 100) AS s
  FROM (SELECT doc_id, c, h, unnest(range(0, least(500, len(h) // 2 - 49))) AS p FROM part WHERE len(h) >= 100)
),
judged AS (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY s) < doc_id AS again FROM win),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS k FROM judged WHERE again),
span AS (
  SELECT doc_id, count(*) AS n_removed, count(*) FILTER (before IS NULL OR before < k - 1) AS n_spans
  FROM (SELECT doc_id, k, lag(k) OVER (PARTITION BY doc_id ORDER BY k) AS before FROM gone) GROUP BY doc_id
),
byte AS (SELECT doc_id, c + k AS k, substr(h, (2 * k + 1)::BIGINT, 2) AS x FROM (SELECT doc_id, c, h, unnest(range(0, least(500, len(h) // 2))) AS k FROM part)),
kept AS (
  SELECT b.doc_id, string_agg(b.x, '' ORDER BY b.k) AS h
  FROM byte b ANTI JOIN gone g ON b.doc_id = g.doc_id AND b.k = g.k GROUP BY b.doc_id
)
SELECT d.doc_id, (len(d.h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept.h, ''))) AS kept_sha256
FROM doc d LEFT JOIN span USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

SUBSTRING_DEDUP = rf"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
win AS (
  SELECT doc_id, p, array_to_string(w[p:p + 19], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM doc WHERE len(w) >= 20)
),
judged AS (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) > 1 AS again FROM win),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS k FROM judged WHERE again),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM doc),
kept AS (
  SELECT v.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY v.k) AS text
  FROM word v ANTI JOIN gone g ON v.doc_id = g.doc_id AND v.k = g.k GROUP BY v.doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM doc d LEFT JOIN kept USING (doc_id)
"""

QUALITY_RULES = rf"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '{SPACE}+'), lambda w: w <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
),
word AS (SELECT doc_id, words, unnest(range(len(words) - 2)) AS i FROM doc WHERE len(words) >= 3),
win AS (SELECT doc_id, i, [words[i + 1], words[i + 2], words[i + 3]] AS w FROM word),
again AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM win),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again WHERE n >= 2) GROUP BY doc_id
),
base AS (
  SELECT d.doc_id, text, words, lines,
    len(words)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM doc d LEFT JOIN hit h ON d.doc_id IS NOT DISTINCT FROM h.doc_id
),
failed AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed
    OR 100 * n_symbols > 30 * n_words
    OR 100 * n_dup_lines > 60 * len(lines)
    OR word_chars NOT BETWEEN 2 * n_words AND 20 * n_words
    OR 2 * length(regexp_replace(text, '[^\p{{Lu}}]', '', 'g')) > word_chars
    OR 100 * len(list_filter(words, lambda w: NOT regexp_matches(w, '\p{{L}}'))) > 20 * n_words) AS kept
FROM failed
"""

CONTROL = r"\[INST\]|\[/INST\]|<s>|</s>|<<SYS>>|<</ROLE>>|<</SYS>>"

CHAT_FORMATTING = rf"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
sized AS (
  SELECT *,
    length(text) + len(regexp_extract_all(text, '\\|{CONTROL}')) AS spelled,
    length(role) + len(regexp_extract_all(role, '\\|{CONTROL}')) AS named
  FROM given
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(CASE role WHEN 'user' THEN 15 + spelled WHEN 'assistant' THEN 6 + spelled ELSE 28 + named + spelled END))::BIGINT
    AS formatted_chars
FROM sized GROUP BY conv_id
"""

DECONTAMINATION = rf"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
),
item_window AS (
  SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item_id, size, array_to_string(w[p:p + size - 1], ' ') AS win
  FROM (SELECT item_id, w, least(13, len(w)) AS size, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p FROM item WHERE len(w) > 0)
),
doc_window AS (
  SELECT doc_id, size, p, array_to_string(w[p:p + size - 1], ' ') AS win
  FROM (
    SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p
    FROM doc, (SELECT DISTINCT size FROM item_window) WHERE len(w) >= size
  )
),
hit AS (SELECT DISTINCT doc_id, d.size, p, item_id FROM doc_window d JOIN item_window i ON d.size = i.size AND d.win = i.win),
word AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(p, p + size)) AS place FROM hit) GROUP BY doc_id
),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc d LEFT JOIN word USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

RANKED_SEARCH = rf"""
WITH doc_term AS (
  SELECT doc_id, term, count(*) AS tf
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{TERM}')) AS term FROM documents)
  GROUP BY doc_id, term
),
sized AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM doc_term GROUP BY doc_id),
corpus AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM sized),
weighed AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM doc_term GROUP BY term), corpus
),
normed AS (SELECT doc_id, 50 + (50 * n * docs) // terms AS m FROM sized, corpus),
asked AS (
  SELECT DISTINCT item_id, term
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{TERM}')) AS term FROM benchmark)
),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM asked JOIN weighed USING (term) JOIN doc_term USING (term) JOIN normed USING (doc_id) GROUP BY item_id, doc_id
)
SELECT item_id, rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scored WHERE score > 0)
WHERE rank <= 50
"""

FILTER_AUDIT = rf"""
WITH split AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '{SPACE}+'), lambda w: w <> '') AS words
  FROM documents
),
tested AS (
  SELECT doc_id, part,
    (len(words) < 100)::INTEGER
    + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INTEGER
    + 4 * (100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text))::INTEGER
    + 8 * regexp_matches(text, '[#$%&*|]')::INTEGER
    + 16 * (doc_id > min(doc_id) OVER (PARTITION BY text))::INTEGER AS pattern
  FROM split
),
counted AS (
  SELECT part, pattern, count(*) AS n, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS toxic
  FROM tested LEFT JOIN labels USING (doc_id) GROUP BY part, pattern
),
bit AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS t(name, b)),
orders AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM bit a, bit b, bit c, bit d, bit e WHERE (a.b | b.b | c.b | d.b | e.b) = 31
),
stepped AS (
  SELECT filter_order, i AS step, bits[i] AS own, list_sum(bits[1:i - 1])::INTEGER AS earlier
  FROM orders, range(1, 6) AS r(i)
),
told AS (
  SELECT part, filter_order, step, own,
    sum(n) FILTER ((pattern & (coalesce(earlier, 0) | own)) = 0) AS kept,
    sum(n) FILTER ((pattern & coalesce(earlier, 0)) = 0 AND (pattern & own) > 0) AS removed,
    sum(n) FILTER ((pattern & coalesce(earlier, 0)) > 0 AND (pattern & own) > 0) AS redundant,
    sum(n) FILTER (pattern = own) AS unique_fails,
    sum(good) FILTER ((pattern & coalesce(earlier, 0)) = 0 AND (pattern & own) > 0) AS good_lost,
    sum(toxic) FILTER ((pattern & coalesce(earlier, 0)) = 0 AND (pattern & own) > 0) AS toxic_lost
  FROM counted, stepped GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  sum(coalesce(removed, 0)) OVER (PARTITION BY part, own)::BIGINT AS shapley
FROM told
"""

ORACLES: dict[str, str] = {
    "op1_line_dedup": LINE_DEDUP,
    "op2_minhash_near_dedup": NEAR_DEDUP,
    "op3_chat_formatting": CHAT_FORMATTING,
    "op5_quality_rules": QUALITY_RULES,
    "op6_decontamination": DECONTAMINATION,
    "op9_suffix_dedup": SUFFIX_DEDUP,
    "op10_substring_dedup": SUBSTRING_DEDUP,
    "op12_ranked_search": RANKED_SEARCH,
    "op13_filter_audit": FILTER_AUDIT,
}
