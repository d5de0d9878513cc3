"""DuckDB SQL for the operators that SQL can express."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

URL_FILTER = f"""
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1) AS query
  FROM rest
), params AS (
  SELECT *, list_filter(string_split(query, '&'), lambda p: p <> '' AND NOT starts_with(p, 'utm_')) AS kept FROM parts
), canon AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^www\\.', '') || regexp_replace(path, '/+$', '')
                 || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS canonical
  FROM params
), listed AS (
  SELECT DISTINCT canonical FROM canon WHERE regexp_matches(query, '(^|&)utm_source=') AND canonical IS NOT NULL
), rules(rule_host, rule_path, says) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), fits AS (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(says, length(rule_host || rule_path)) AS says
  FROM canon JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id
)
SELECT c.page_id, c.host, c.path, f.rule,
       coalesce(f.says, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM canon c LEFT JOIN fits f USING (page_id) LEFT JOIN listed l ON c.canonical = l.canonical
"""

#: Word sequences are compared as text, with the words joined by single spaces.
LINE_DEDUP = r"""
WITH docs AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
), occ AS (
  SELECT doc_id, i AS line, lines[i] AS t, array_to_string(list_filter(
           regexp_split_to_array(lower(lines[i]), '[\x20\x09-\x0D]+'), lambda w: w <> ''), ' ') AS norm
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM docs)
), firsts AS (
  SELECT norm, min((doc_id, line)) AS first, string_split(norm, ' ') AS w FROM occ WHERE norm <> '' GROUP BY norm
), variants AS (
  SELECT norm, first, -1 AS k, norm AS v FROM firsts WHERE len(w) >= 8
  UNION ALL
  SELECT norm, first, k, array_to_string(list_concat(w[1:k - 1], w[k + 1:]), ' ')
  FROM (SELECT *, unnest(range(1, len(w) + 1)) AS k FROM firsts WHERE len(w) >= 8)
), near AS (
  SELECT DISTINCT x.norm FROM variants x JOIN variants y ON x.v = y.v AND y.first < x.first AND (x.k = y.k OR least(x.k, y.k) = -1)
), judged AS (
  SELECT o.*, o.norm <> '' AND f.first <> (o.doc_id, o.line) AS exact, n.norm IS NOT NULL AS near
  FROM occ o LEFT JOIN firsts f ON o.norm = f.norm LEFT JOIN near n ON o.norm = n.norm
)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_exact, 0)::BIGINT AS n_exact, coalesce(n_near, 0)::BIGINT AS n_near,
       CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(kept, '')) END AS text_sha256
FROM docs d LEFT JOIN (
  SELECT doc_id, count_if(norm <> '') AS n_lines, count_if(coalesce(exact, false)) AS n_exact, count_if(near AND NOT exact) AS n_near,
         string_agg(t, chr(10) ORDER BY line) FILTER (WHERE NOT coalesce(exact, false) AND NOT near) AS kept
  FROM judged GROUP BY doc_id
) USING (doc_id)
"""

_TERMS = f"regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

RANKED_SEARCH = f"""
WITH occ AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents
), lengths AS (SELECT doc_id, count(*) AS n FROM occ GROUP BY doc_id
), total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths
), tfs AS (SELECT doc_id, term, count(*) AS tf FROM occ GROUP BY doc_id, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tfs, total GROUP BY term
), wanted AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)
), scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms))))::BIGINT AS score
  FROM wanted JOIN weights USING (term) JOIN tfs USING (term) JOIN lengths USING (doc_id), total
  GROUP BY item_id, doc_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""
