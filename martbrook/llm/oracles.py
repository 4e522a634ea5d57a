"""SQL for the registered queries of the training-data operators, where SQL can express them."""

ORACLES: dict[str, str] = {}

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op1_exact_dedup"] = f"""
WITH folded AS (SELECT doc_id, {_FOLDED} AS folded FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(folded) AS text_sha256
FROM folded WINDOW same AS (PARTITION BY folded)
"""

_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_CUT = "regexp_extract_all({}, " + _WORDS + ")"

ORACLES["op2_benchmark_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_CUT.format(_FOLDED)} AS w FROM documents),
b AS (SELECT item_id, {_CUT.format(_FOLDED)} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, list_slice(w, pos, pos + least(len(w), 10) - 1) AS key
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS pos FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(key) AS n FROM windows),
parts AS (
  SELECT doc_id, pos, n, list_slice(w, pos, pos + n - 1) AS key
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS pos FROM d, sizes WHERE len(w) >= n)),
found AS (SELECT doc_id, pos, n, item_id FROM parts JOIN windows USING (key)),
hits AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS word FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLES["op3_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS size FROM pages),
named AS (SELECT *, CASE WHEN size >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS first FROM p)
SELECT page_id, size AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM named
"""

ORACLES["op10_ngram_jaccard"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array({_FOLDED}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, pos, pos + 3), ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS pos FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
    GROUP BY ALL) JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * n_both >= 85 * (na.n + nb.n - n_both)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT a AS doc_id, coalesce(any_value(n), 0) AS n_shingles, min(b) AS component_id
FROM reach LEFT JOIN n ON n.doc_id = reach.a GROUP BY a
"""

_TERMS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

ORACLES["op11_lexical_search"] = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS k, {_TERMS.format(_FOLDED)} AS terms FROM documents),
sizes AS (SELECT doc_id, k, CAST(len(terms) AS BIGINT) AS n FROM d WHERE len(terms) > 0),
whole AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM sizes),
m AS (SELECT doc_id, k, 100 - 25 + ((25 * n * n_docs) // all_terms) AS m FROM sizes, whole),
tfs AS (SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(terms) AS term FROM d) GROUP BY k, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), whole),
asked AS (SELECT item_id, unnest({_TERMS.format(_FOLDED)}) AS term FROM benchmark),
q AS (SELECT item_id, term, count(*) AS times FROM asked GROUP BY ALL),
scores AS (
  SELECT item_id, m.doc_id, m.k, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM q JOIN weights USING (term) JOIN tfs USING (term) JOIN m USING (k) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, k) AS rank FROM scores WHERE score > 0)
WHERE rank <= 20
"""

_PLAIN = "trim(regexp_replace(regexp_replace(lower(line), '[0-9]+', '0', 'g'), '[\\x20\\x09-\\x0D]+', ' ', 'g'))"

ORACLES["op12_quality_rules"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(source, '-') AS host, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (
  SELECT k, pos, list_slice(w, pos, pos + 2) AS key
  FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS pos FROM d WHERE len(w) > 2)),
again AS (SELECT k, unnest(list(pos)) AS pos FROM windows GROUP BY k, key HAVING count(*) > 1),
covered AS (SELECT k, count(DISTINCT word) AS n FROM (SELECT k, unnest(range(pos, pos + 3)) AS word FROM again) GROUP BY k),
lines AS (
  SELECT k, host, text, line FROM (SELECT k, host, text, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
dup AS (SELECT k, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY k),
plain AS (SELECT k, host, text, {_PLAIN} AS line FROM lines),
hosts AS (SELECT host, count(DISTINCT text) AS n FROM d GROUP BY host),
common AS (
  SELECT host, line FROM (SELECT host, line, count(DISTINCT text) AS n FROM plain GROUP BY host, line) often
  JOIN hosts USING (host) WHERE often.n > 20 AND often.n > hosts.n * 0.002),
lost AS (SELECT k, CAST(sum(len(string_split(line, ' '))) AS BIGINT) AS n FROM plain JOIN common USING (host, line) GROUP BY k),
counts AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(dup.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, coalesce(lost.n, 0) AS lost
  FROM d LEFT JOIN covered USING (k) LEFT JOIN dup USING (k) LEFT JOIN lost USING (k)),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_words - lost AS n_left_words,
       NOT base_failed AND n_words - lost >= 0.5 * n_words AS kept
FROM failed
"""

_CRC_BIT = "list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)"
_CRC = ("xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({0}, ''), lambda x: CAST(ascii(x) AS BIGINT))), "
        "lambda c, x: " + _CRC_BIT + "), 4294967295)")
_FIELD = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"


def _leaf(*values: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(v) for v in values) + ")"


ORACLES["op13_merkle_manifest"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, {_leaf('doc_id', 'source', 'lang', 'n_chars', 'text')} AS leaf,
         CASE WHEN {_CRC.format('CAST(doc_id AS VARCHAR)')} % 7 = 0
              THEN {_leaf('doc_id', 'source', 'lang', '(n_chars + 1)', 'text')} END AS tampered FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n, coalesce('=' || lang, '') AS grp FROM d),
up AS (
  SELECT grp, 0 AS level, pos, n, leaf AS h FROM leaves
  UNION ALL
  SELECT grp, level + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM up WHERE n > 1 GROUP BY grp, level, pos // 2),
subroots AS (SELECT grp, h AS subroot, row_number() OVER (ORDER BY encode(grp)) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (
  SELECT 0 AS level, pos, n, subroot AS h FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM top WHERE n > 1 GROUP BY level, pos // 2),
walk AS (
  SELECT l.doc_id, l.grp, l.leaf, 0 AS level, l.pos, l.n, coalesce(l.tampered, l.leaf) AS folded, '' AS said FROM leaves l
  UNION ALL
  SELECT w.doc_id, w.grp, w.leaf, w.level + 1, w.pos // 2, (w.n + 1) // 2,
         CASE WHEN s.h IS NULL THEN sha256(w.folded) WHEN s.pos < w.pos THEN sha256(s.h || w.folded) ELSE sha256(w.folded || s.h) END,
         w.said || coalesce(s.h, '')
  FROM walk w LEFT JOIN up s ON s.grp = w.grp AND s.level = w.level AND s.pos = xor(w.pos, 1) WHERE w.n > 1),
walk_top AS (
  SELECT w.doc_id, w.leaf, r.subroot, 0 AS level, r.pos, r.n, w.folded, w.said FROM walk w JOIN subroots r USING (grp) WHERE w.n = 1
  UNION ALL
  SELECT w.doc_id, w.leaf, w.subroot, w.level + 1, w.pos // 2, (w.n + 1) // 2,
         CASE WHEN s.h IS NULL THEN sha256(w.folded) WHEN s.pos < w.pos THEN sha256(s.h || w.folded) ELSE sha256(w.folded || s.h) END,
         w.said || coalesce(s.h, '')
  FROM walk_top w LEFT JOIN top s ON s.level = w.level AND s.pos = xor(w.pos, 1) WHERE w.n > 1),
root AS (SELECT h AS root FROM top WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(said) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM walk_top, root WHERE n = 1
"""
