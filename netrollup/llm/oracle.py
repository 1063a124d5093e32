"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_COMPONENTS = """
reach(v, r) AS (
  SELECT id, id FROM nodes
  UNION
  SELECT reach.v, pairs.b FROM reach JOIN pairs ON reach.r = pairs.a
),
named AS (SELECT v, min(r) AS component_id FROM reach GROUP BY v)
"""

OP1 = r"""
WITH kinds(kind, pattern, nth) AS (VALUES
  ('email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+', 1),
  ('ip', '[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)', 2),
  ('card', '[0-9](?:[\x20-]?[0-9])+', 3),
  ('phone', '\+[0-9][\x20().0-9-]+[0-9]', 4)),
docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS (
  SELECT doc_id, text, kind, nth, regexp_extract_all(text, pattern) AS f,
         list_transform(string_split_regex(text, pattern), lambda x: length(x)) AS gaps
  FROM docs, kinds),
placed AS (
  SELECT doc_id, text, kind, nth, unnest(f) AS v, generate_subscripts(f, 1) AS i, f, gaps
  FROM found),
matched AS (
  SELECT doc_id, text, kind, nth, v,
         (list_sum(gaps[1:i]) + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: length(x))), 0))
           ::INTEGER AS s
  FROM placed),
digits AS (SELECT *, s + length(v) AS e, regexp_replace(v, '[^0-9]', '', 'g') AS d FROM matched),
spans AS (
  SELECT doc_id, text, kind, nth, v, s, e FROM digits WHERE CASE kind
    WHEN 'ip' THEN list_bool_and(list_transform(string_split(v, '.'),
                                 lambda x: length(ltrim(x, '0')) <= 3
                                           AND coalesce(try_cast(right(x, 3) AS INTEGER), 0) <= 255))
    WHEN 'card' THEN length(d) BETWEEN 13 AND 19 AND list_sum(list_transform(
        range(0, length(d)), lambda k: CASE
          WHEN k % 2 = 0 THEN d[length(d) - k]::INTEGER
          WHEN d[length(d) - k]::INTEGER > 4 THEN 2 * d[length(d) - k]::INTEGER - 9
          ELSE 2 * d[length(d) - k]::INTEGER END)) % 10 = 0
    WHEN 'phone' THEN length(d) BETWEEN 9 AND 15
    ELSE true END),
parts AS (
  SELECT *, list_transform(string_split(v, '.'), lambda x: regexp_replace(x, '^0+(.)', '\1')) AS octets
  FROM (SELECT doc_id, text, kind, v, regexp_replace(v, '[^0-9]', '', 'g') AS d FROM spans)),
entities AS (
  SELECT DISTINCT text, unnest(CASE kind
    WHEN 'email' THEN ['email:' || v, 'email-domain:' || lower(string_split(v, '@')[-1])]
    WHEN 'ip' THEN ['ip:' || v, 'ip-number:' || array_to_string(octets, '.'),
                    'ip-network:' || array_to_string(octets[1:3], '.')]
    WHEN 'card' THEN ['card:' || v, 'card-digits:' || d, 'card-prefix:' || d[1:6]]
    ELSE ['phone:' || v, 'phone-digits:' || d, 'phone-prefix:' || d[1:length(d) - 4]] END) AS value
  FROM parts),
words AS (
  SELECT DISTINCT text, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM docs),
texts AS (SELECT count(DISTINCT text) AS total FROM docs),
df_value AS (SELECT value, count(*) AS df FROM entities GROUP BY value HAVING count(*) >= 3),
df_term AS (SELECT term, count(*) AS df FROM words WHERE length(term) >= 3 GROUP BY term),
together AS (
  SELECT value, term, count(*) AS n FROM entities JOIN words USING (text)
  WHERE length(term) >= 3 GROUP BY value, term HAVING count(*) >= 3),
shares AS (
  SELECT value, term, CASE WHEN n = df_term.df THEN 1.0 WHEN total > df_value.df THEN
      log2(n * total::DOUBLE / (df_value.df * df_term.df)) / log2(total::DOUBLE / df_value.df)
    END AS share
  FROM together JOIN df_value USING (value) JOIN df_term USING (term), texts),
told AS (
  SELECT doc_id, term, max(share) AS share
  FROM docs JOIN entities USING (text) JOIN words USING (text) JOIN shares USING (value, term)
  WHERE share >= 0.9 GROUP BY doc_id, term),
tokens AS (
  SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}]+') AS f,
         list_transform(string_split_regex(text, '[\p{L}\p{N}]+'), lambda x: length(x)) AS gaps
  FROM docs WHERE doc_id IN (SELECT doc_id FROM told)),
token AS (SELECT doc_id, unnest(f) AS v, generate_subscripts(f, 1) AS i, f, gaps FROM tokens),
terms AS (
  SELECT doc_id, share >= 1.0 AS removed, s, s + length(v) AS e FROM (
    SELECT token.doc_id, v, share, (list_sum(gaps[1:i]) + coalesce(list_sum(
             list_transform(f[1:i - 1], lambda x: length(x))), 0))::INTEGER AS s
    FROM token JOIN told ON told.doc_id = token.doc_id AND told.term = lower(v)) t
  WHERE NOT EXISTS (SELECT 1 FROM spans b WHERE b.doc_id = t.doc_id AND b.s < t.s + length(t.v)
                    AND t.s < b.e)),
every AS (
  SELECT doc_id, nth, kind, s, e FROM spans
  UNION ALL SELECT doc_id, CASE WHEN removed THEN 6 ELSE 5 END,
                   CASE WHEN removed THEN 'removed' ELSE 'generalised' END, s, e FROM terms),
lists AS (
  SELECT doc_id,
    count(*) FILTER (nth = 1) AS n_email, count(*) FILTER (nth = 2) AS n_ip,
    count(*) FILTER (nth = 3) AS n_card, count(*) FILTER (nth = 4) AS n_phone,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY nth, s) FILTER (nth <= 4) AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY nth, s) AS spans
  FROM every GROUP BY doc_id)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip,
       coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(lists.spans, '') AS spans
FROM docs LEFT JOIN lists USING (doc_id)
"""

OP4 = f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
nodes AS (SELECT vec_id AS id FROM embeddings),
pairs(a, b) AS (
  SELECT x.id, y.id FROM vectors x JOIN vectors y ON x.id <> y.id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.9),
{_COMPONENTS},
links AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT v AS vec_id, coalesce(n, 0) AS n_links, component_id, v = component_id AS kept
FROM named LEFT JOIN links ON a = v
"""

OP5 = rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
worded AS (
  SELECT doc_id, text, {_WORDS} AS words,
         list_filter(string_split(text, chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM texts),
windows AS (
  SELECT doc_id, unnest(range(1, len(words) - 3)) AS i, unnest(list_transform(
           range(1, len(words) - 3), lambda k: array_to_string(words[k:k + 4], ' '))) AS w
  FROM worded WHERE len(words) >= 5),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n
            FROM twice, (SELECT unnest(range(0, 5)) AS k) GROUP BY doc_id),
measured AS (
  SELECT worded.doc_id, len(words) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words, len(lines) AS n_lines,
         length(regexp_replace(text, '[^!]', '', 'g')) AS n_exclamations
  FROM worded LEFT JOIN covered USING (doc_id)),
failed AS (
  SELECT *,
    CASE WHEN n_words < 10 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_symbols > 15 * word_chars THEN 4 ELSE 0 END
    + CASE WHEN n_lines > 4 AND 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars > 40 * n_words THEN 16 ELSE 0 END
    + CASE WHEN n_words >= 10 AND n_exclamations > n_words THEN 32 ELSE 0 END AS failed
  FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed::BIGINT AS failed
FROM failed
"""

OP5_POLICIES = f"""
SELECT doc_id, failed, failed & 3 = 0 AS kept_base, failed & 15 = 0 AS kept_v1,
       failed = 0 AS kept_v2
FROM ({OP5})
"""

OP5_ABLATIONS = f"""
WITH ledger AS MATERIALIZED ({OP5}),
rules(rule, bit) AS (VALUES ('few_words', 1), ('repeated_windows', 2), ('symbols', 4),
                            ('duplicate_lines', 8), ('word_length', 16), ('exclamations', 32)),
policies(policy, mask) AS (VALUES ('base', 3), ('v1', 15), ('v2', 63)),
asked AS (SELECT * FROM policies, rules WHERE mask & bit <> 0)
SELECT policy, rule, count(*) FILTER (failed & bit <> 0) AS failing,
       count(*) FILTER (failed & mask = bit) AS failing_this_alone
FROM ledger, asked GROUP BY policy, rule
"""

OP6 = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(words) - 2, 2)),
           lambda k: array_to_string(words[k:k + 3], ' '))) AS s
  FROM worded WHERE len(words) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
           FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
nodes AS (SELECT doc_id AS id FROM documents),
pairs AS (SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
         WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)),
""" + _COMPONENTS + """
SELECT v AS doc_id, coalesce(n, 0) AS n_shingles, component_id, v = component_id AS kept
FROM named LEFT JOIN sizes ON doc_id = v
"""

OP10 = rf"""
WITH docs AS (
  SELECT doc_id, source, len({_WORDS}) AS size,
         md5(concat_ws('|', 'mix', CAST(doc_id AS VARCHAR), coalesce(text, ''))) AS key
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth
  FROM docs GROUP BY source),
weighed AS (SELECT *, (nth % 3 + 1)::DOUBLE AS weight, 3 * source_size AS lim FROM sources),
ranked AS (SELECT *, row_number() OVER (ORDER BY lim / weight, nth) AS rank FROM weighed),
levels AS (
  SELECT *, ((sum(source_size) OVER ())::BIGINT - coalesce(sum(lim) OVER (
             ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)::DOUBLE
         / sum(weight) OVER (ORDER BY rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked),
first AS (SELECT min(rank) AS f, min_by(level, rank) AS final FROM levels WHERE level * weight <= lim),
budget AS (
  SELECT source, source_size, CASE WHEN rank >= f THEN final * weight ELSE lim::DOUBLE END AS target
  FROM levels, first),
epochs AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 WHEN target >= source_size * 3 THEN 3
                 ELSE floor(target / source_size)::BIGINT END AS epochs FROM budget),
placed AS (
  SELECT doc_id, size, source_size, target, epochs,
         floor(target - epochs * source_size)::BIGINT AS rest,
         coalesce(sum(size) OVER (PARTITION BY docs.source ORDER BY key
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM docs JOIN epochs ON docs.source IS NOT DISTINCT FROM epochs.source)
SELECT doc_id, size, source_size, target, epochs * size + CASE WHEN epochs < 3 THEN
         greatest(0, least(size, rest - before)) ELSE 0 END AS taken
FROM placed
"""

OP12 = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
often AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (doc_id <> last) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (last IS NULL OR doc_id = last),
                       '')) AS kept_sha256
FROM keyed LEFT JOIN often USING (key) GROUP BY doc_id
"""

OP13 = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
sizes AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms
          FROM docs),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
occurs AS (
  SELECT doc_id, n, term, count(*) AS tf
  FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM items) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM occurs, sizes GROUP BY term, n_docs),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf)
           // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // n_terms)))))::BIGINT AS score
  FROM occurs JOIN weights USING (term) JOIN items USING (term), sizes
  GROUP BY item_id, doc_id),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER
           AS rank, doc_id, score
  FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50
"""

ORACLE = {
    "op1_pii": OP1,
    "op4_embedding_dedup": OP4,
    "op5_quality_rules": OP5,
    "op5_policies": OP5_POLICIES,
    "op5_ablations": OP5_ABLATIONS,
    "op6_minhash_dedup": OP6,
    "op10_mixing": OP10,
    "op12_line_dedup": OP12,
    "op13_lexical_search": OP13,
}
