"""SQL for the queries of the text operators that DuckDB can express.

The other text queries learn a model, tokenize or lex; tests hold them against brute force.
"""

from __future__ import annotations

LLM_ORACLES: dict[str, str] = {}

LLM_ORACLES["op3_host_reputation"] = r"""
WITH parsed AS (
  SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
judged AS (
  SELECT page_id, html,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<[^>]*>|&[a-z]+;|\s+', '', 'g') AS visible
  FROM parsed),
outcomes AS (
  SELECT host, CASE WHEN html IS NULL THEN NULL WHEN visible = '' THEN 0
    WHEN (length(visible) - length(translate(visible, '%$#&*!|~^=', ''))) / length(visible) >= 0.05 THEN 1 ELSE 0
    END AS bad FROM judged),
levels AS (
  SELECT *, regexp_matches(host, '^[0-9.]+(:\d+)?$|^\[') AS address,
    string_split(regexp_replace(host, '^.*@|:\d*$', '', 'g'), '.') AS labels FROM outcomes),
named AS (
  SELECT host, CASE WHEN address THEN host ELSE array_to_string(labels[-2:], '.') END AS domain,
    CASE WHEN address THEN '' ELSE labels[-1] END AS suffix, bad FROM levels),
suffix_counts AS (
  SELECT suffix, count(bad) AS n, coalesce(sum(bad), 0) AS k,
    (SELECT (coalesce(sum(bad), 0) + 1) / (count(bad) + 2) FROM named) AS mu FROM named GROUP BY ALL),
suffix_weight AS (
  SELECT coalesce(1 / least(greatest((sum(n * pow(k / n - mu, 2)) - sum(greatest(mu * (1 - mu), 1e-9)))
    / nullif(sum((n - 1) * greatest(mu * (1 - mu), 1e-9)), 0), 1e-4), 0.99) - 1, 10.0) AS w
  FROM suffix_counts WHERE n > 0),
domain_counts AS (
  SELECT c.*, (s.k + w * s.mu) / (s.n + w) AS mu
  FROM (SELECT suffix, domain, count(bad) AS n, coalesce(sum(bad), 0) AS k FROM named GROUP BY ALL) c
  JOIN suffix_counts s USING (suffix), suffix_weight),
domain_weight AS (
  SELECT coalesce(1 / least(greatest((sum(n * pow(k / n - mu, 2)) - sum(greatest(mu * (1 - mu), 1e-9)))
    / nullif(sum((n - 1) * greatest(mu * (1 - mu), 1e-9)), 0), 1e-4), 0.99) - 1, 10.0) AS w
  FROM domain_counts WHERE n > 0),
host_counts AS (
  SELECT c.*, (d.k + w * d.mu) / (d.n + w) AS mu
  FROM (SELECT suffix, domain, host, count(bad) AS n, coalesce(sum(bad), 0) AS k FROM named GROUP BY ALL) c
  JOIN domain_counts d USING (suffix, domain), domain_weight),
host_weight AS (
  SELECT coalesce(1 / least(greatest((sum(n * pow(k / n - mu, 2)) - sum(greatest(mu * (1 - mu), 1e-9)))
    / nullif(sum((n - 1) * greatest(mu * (1 - mu), 1e-9)), 0), 1e-4), 0.99) - 1, 10.0) AS w
  FROM host_counts WHERE n > 0),
posterior AS (
  SELECT host, k + w * mu AS a, n - k + w * (1 - mu) AS b FROM host_counts, host_weight),
reputation AS (
  SELECT host, a / (a + b) AS mean,
    greatest(a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))), 0.0) AS low FROM posterior),
ruled AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule FROM judged)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN low > 0.5 THEN 'block' ELSE 'allow' END AS verdict,
  round(mean, 6) AS bad_share, round(low, 6) AS bad_low
FROM ruled LEFT JOIN reputation USING (host)
"""

LLM_ORACLES["op5_minhash_containment"] = r"""
WITH item_words AS (
  SELECT row_number() OVER () AS item, item_id,
    list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS words
  FROM benchmark),
items AS (
  SELECT item, item_id, least(len(words), 5) AS width, words FROM item_words WHERE len(words) > 0),
item_shingles AS (
  SELECT DISTINCT item, width, unnest(list_transform(range(1, len(words) - width + 2),
    lambda i: array_to_string(words[i:i + width - 1], ' '))) AS shingle FROM items),
doc_words AS (
  SELECT row_number() OVER () AS doc, doc_id,
    list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS words
  FROM documents),
doc_shingles AS (
  SELECT DISTINCT doc, doc_id, width, unnest(list_transform(range(1, len(words) - width + 2),
    lambda i: array_to_string(words[i:i + width - 1], ' '))) AS shingle
  FROM doc_words, (SELECT DISTINCT width FROM items)),
sizes AS (SELECT item, count(*) AS item_shingles FROM item_shingles GROUP BY item),
shared AS (
  SELECT doc, doc_id, item, count(*) AS shared
  FROM doc_shingles JOIN item_shingles USING (width, shingle) GROUP BY ALL),
contained AS (
  SELECT doc_id, item_id, shared, item_shingles, shared / item_shingles AS containment
  FROM shared JOIN sizes USING (item) JOIN items USING (item) WHERE 5 * shared >= 4 * item_shingles)
SELECT doc_id, item_id, shared, item_shingles, containment FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY containment DESC, shared DESC) AS place
  FROM contained)
WHERE place = 1
"""

LLM_ORACLES["op8_prefix_tree"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
escaped AS (
  SELECT *, '\\|\[INST\]|\[/INST\]|</?s>|<</?(ROLE|SYS)>>' AS control FROM turns),
sized AS (
  SELECT *, length(text) + len(regexp_extract_all(text, control)) + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 9
    ELSE 25 + length(role) + len(regexp_extract_all(role, control)) END AS chars FROM escaped),
whole AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum(chars)::BIGINT AS formatted_chars
  FROM sized GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  formatted_chars FROM whole
"""

LLM_ORACLES["op10_lsh_forest"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(words) < 2 THEN words ELSE list_distinct(list_transform(range(1, len(words)),
    lambda i: words[i] || ' ' || words[i + 1])) END AS shingles FROM words),
keyed AS (SELECT doc_id, len(shingles) AS n, md5(array_to_string(list_sort(shingles), chr(10))) AS key, shingles FROM sets),
nodes AS (
  SELECT key, min(doc_id) AS node, any_value(n) AS n, any_value(shingles) AS shingles
  FROM keyed WHERE n > 0 GROUP BY key),
ranked AS (
  SELECT node, n, shingle, row_number() OVER (PARTITION BY node ORDER BY df, shingle) AS place
  FROM (SELECT node, n, shingle, count(*) OVER (PARTITION BY shingle) AS df
        FROM (SELECT node, n, unnest(shingles) AS shingle FROM nodes))),
rare AS (SELECT * FROM ranked WHERE 5 * place <= n + 5),
candidates AS (
  SELECT DISTINCT x.node AS a, y.node AS b, x.n AS n_a, y.n AS n_b FROM rare x JOIN rare y USING (shingle)
  WHERE x.node < y.node AND 5 * least(x.n, y.n) >= 4 * greatest(x.n, y.n)),
links AS (
  SELECT a, b FROM (
    SELECT a, b, n_a, n_b, len(list_intersect(x.shingles, y.shingles)) AS common
    FROM candidates JOIN nodes x ON x.node = a JOIN nodes y ON y.node = b)
  WHERE 100 * common >= 80 * (n_a + n_b - common)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT a AS node, a AS root FROM both_ways
  UNION
  SELECT b, root FROM reach JOIN both_ways ON a = node),
roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node)
SELECT doc_id, k.n AS n_shingles, coalesce(root, node, doc_id) AS component_id,
  doc_id = coalesce(root, node, doc_id) AS kept
FROM keyed k LEFT JOIN nodes USING (key) LEFT JOIN roots USING (node)
"""

LLM_ORACLES["op13_bloom_search"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS place, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents WHERE text IS NOT NULL),
sized AS (SELECT place, doc_id, len(words)::BIGINT AS n FROM docs WHERE len(words) > 0),
totals AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS terms FROM sized),
counts AS (SELECT place, term, count(*) AS tf FROM (SELECT place, unnest(words) AS term FROM docs) GROUP BY ALL),
items AS (
  SELECT row_number() OVER () AS item, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM benchmark WHERE text IS NOT NULL),
item_terms AS (SELECT DISTINCT item, item_id, unnest(words) AS term FROM items),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM counts, totals WHERE term IN (SELECT term FROM item_terms) GROUP BY term),
scored AS (
  SELECT item, item_id, doc_id, place,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // totals.terms))))::BIGINT AS score
  FROM item_terms JOIN weights USING (term) JOIN counts USING (term) JOIN sized USING (place), totals GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scored WHERE score > 0)
WHERE rank <= 10
"""

LLM_ORACLES["op11_structure_repair"] = r"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
kinds AS (
  SELECT row_number() OVER () AS place, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_concat([4294967295], list_transform(string_split(
      coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)),
      lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) % 20 AS kind
  FROM conversations, crc_table),
damaged AS (
  SELECT conv_id, turn, 2 * place + copy AS place, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, (VALUES (0), (1)) AS c(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, place) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, place) AS seen,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid, substr(role, 1, 1) AS initial
  FROM damaged),
faults AS (
  SELECT *, CASE WHEN solid = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
      WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'sound' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
  FROM ordered),
inserts(origin, mid, letters, cost) AS (VALUES
  (0, 0, '', 0), (1, 1, '', 0), (2, 2, '', 0), (3, 3, '', 0), (0, 2, 'I', 5), (1, 2, 'I', 5), (2, 3, 'I', 5),
  (3, 2, 'I', 5), (0, 3, 'II', 10), (1, 3, 'II', 10), (2, 2, 'II', 10), (3, 3, 'II', 10)),
acts(mid, target, letter, cost, needs) AS (VALUES
  (0, 0, 'D', 2, NULL), (1, 1, 'D', 2, NULL), (2, 2, 'D', 2, NULL), (3, 3, 'D', 2, NULL),
  (0, 1, 'K', 0, 's'), (0, 2, 'K', 0, 'u'), (1, 2, 'K', 0, 'u'), (2, 3, 'K', 0, 'a'), (3, 2, 'K', 0, 'u'),
  (0, 2, 'R', 1, NULL), (1, 2, 'R', 1, NULL), (2, 3, 'R', 1, NULL), (3, 2, 'R', 1, NULL)),
edges AS (
  SELECT origin, target, letters || letter AS letters, inserts.cost + acts.cost AS cost, letter, needs
  FROM inserts JOIN acts USING (mid)),
walk AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS state, '000000000' AS path FROM conversations GROUP BY conv_id
  UNION ALL
  SELECT walk.conv_id, f.i, target, min(printf('%09d', substr(path, 1, 9)::INTEGER + cost
      + CASE WHEN fault = 'truncated' AND letter <> 'D' THEN 5 ELSE 0 END) || substr(path, 10) || letters)
  FROM walk JOIN faults f ON f.conv_id IS NOT DISTINCT FROM walk.conv_id AND f.i = walk.i + 1
  JOIN edges ON origin = state AND (letter = 'D' OR (fault NOT IN ('blank', 'duplicate')
    AND (needs IS NULL OR needs = initial)))
  GROUP BY walk.conv_id, f.i, target),
sizes AS (SELECT conv_id, max(i) AS n FROM walk GROUP BY conv_id),
best AS (
  SELECT walk.conv_id, min(printf('%09d', substr(path, 1, 9)::INTEGER + cost) || substr(path, 10) || letters) AS path
  FROM walk JOIN sizes ON sizes.conv_id IS NOT DISTINCT FROM walk.conv_id AND i = n
  JOIN (VALUES (0, '', 0), (3, '', 0), (2, 'I', 5), (1, 'II', 10)) AS e(state, letters, cost) USING (state)
  GROUP BY walk.conv_id),
audits AS (SELECT conv_id, substr(path, 1, 9)::BIGINT AS cost, substr(path, 10) AS audit FROM best),
letters AS (
  SELECT conv_id, k, substr(audit, k, 1) AS letter FROM (
    SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS k FROM audits)),
numbered AS (
  SELECT *, count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv_id ORDER BY k) AS i,
    count(*) FILTER (letter <> 'D') OVER (PARTITION BY conv_id ORDER BY k) AS place
  FROM letters),
placed AS (
  SELECT n.conv_id, n.k, n.letter, n.place, f.role, f.text, f.initial,
    max((n.place = 1 AND n.letter = 'K' AND f.initial = 's')::INTEGER) OVER (PARTITION BY n.conv_id) AS led
  FROM numbered n LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM n.conv_id AND f.i = n.i AND n.letter <> 'I'),
repaired AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - led) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS whole
  FROM placed WHERE letter <> 'D' GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit,
  sha256(coalesce(whole, '')) AS repaired_sha256
FROM audits a LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM a.conv_id
"""
