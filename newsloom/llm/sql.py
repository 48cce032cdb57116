"""DuckDB statements of the results that SQL can express."""

ORACLES: dict[str, str] = {}

ORACLES["op10_url_filters"] = r"""
WITH RECURSIVE p AS (
  SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), q AS (
  SELECT page_id, html, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS tail FROM p
), r(what, rule, rhost, rpath) AS (
  VALUES ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'), ('block', 'example.org/en/1', 'example.org', '/en/1'),
         ('allow', 'com/fr/', 'com', '/fr/'), ('block', 'com/de/', 'com', '/de/')
), named AS (
  SELECT host || tail AS key, q.host, q.path FROM q WHERE host <> ''
), tags AS (
  SELECT host || tail AS key, host,
         regexp_extract(regexp_extract(html, '(?is)(<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>)', 1), '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) AS c,
         regexp_extract(regexp_extract(html, '(?is)(<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>)', 1), '(?is)\burl\s*=\s*[''"]?([^"''\s>;]+)', 1) AS m
  FROM q WHERE host <> ''
), aims AS (
  SELECT key, host, unnest([c, m]) AS t FROM tags
), full_aims AS (
  SELECT key, CASE WHEN t LIKE '%://%' THEN t WHEN t LIKE '//%' THEN 'http:' || t WHEN t LIKE '/%' THEN 'http://' || host || t END AS t
  FROM aims WHERE t <> ''
), edges AS (
  SELECT key AS a, translate(regexp_extract(substr(t, strpos(t, '://') + 3), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                || regexp_extract(substr(t, strpos(t, '://') + 3), '^[^/?#]*([^#]*)', 1) AS b
  FROM full_aims WHERE t IS NOT NULL
), both_ways AS (
  SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b
), reach(node, other) AS (
  SELECT a, a FROM both_ways UNION SELECT reach.node, both_ways.b FROM reach JOIN both_ways ON reach.other = both_ways.a
), ruled AS (
  SELECT other, arg_max(what, length(rule)) AS what
  FROM (SELECT DISTINCT other, regexp_extract(other, '^([^/?#]*)', 1) AS h, regexp_extract(other, '^[^/?#]*([^?]*)', 1) AS pt FROM reach) o
  JOIN r ON (h = rhost OR h LIKE '%.' || rhost) AND starts_with(pt, rpath) GROUP BY other
), inherits AS (
  SELECT node, min(reach.other) AS component, bool_or(what = 'block') AND NOT coalesce(bool_or(what = 'allow'), false) AS blocked
  FROM reach LEFT JOIN ruled ON reach.other = ruled.other GROUP BY node
), own AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(what, length(rule)) AS what
  FROM q JOIN r ON (host = rhost OR host LIKE '%.' || rhost) AND starts_with(path, rpath) GROUP BY page_id
)
SELECT q.page_id, q.host, q.path, own.rule, coalesce(own.what, CASE WHEN i.blocked THEN 'block' ELSE 'allow' END) AS verdict, i.component
FROM q LEFT JOIN own USING (page_id) LEFT JOIN inherits i ON q.host <> '' AND i.node = q.host || q.tail
"""

ORACLES["op1_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [list_aggregate(w, 'string_agg', ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' ')) END) AS g FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), both_have AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM both_have JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 75 * (na.n + nb.n - k)
), ways AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reach(a, b) AS (
  SELECT a, b FROM ways UNION SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a
), groups AS (
  SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(g.low, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN groups g USING (doc_id)
"""

_ROUND = r"""
near{i} AS MATERIALIZED (
  SELECT rid, b.part, min({{'d': list_sum(list_transform(list_zip(x, y), lambda t: (t[1] - t[2]) * (t[1] - t[2])))::BIGINT, 'e': e}}) AS best
  FROM cut JOIN book{i} b ON cut.part = b.part GROUP BY rid, b.part
)"""

_MEANS = r"""
sums{i} AS (
  SELECT part, e, place, sum(z)::BIGINT AS s, count(*)::BIGINT AS n
  FROM (SELECT cut.part, near{i}.best.e AS e, unnest(x) AS z, unnest(range(len(x))) AS place FROM cut JOIN near{i} ON cut.rid = near{i}.rid AND cut.part = near{i}.part)
  GROUP BY part, e, place
), means{i} AS (
  SELECT part, e, list((s - ((s % n) + n) % n) // n ORDER BY place) AS y FROM sums{i} GROUP BY part, e
), book{j} AS MATERIALIZED (
  SELECT b.part, b.e, coalesce(m.y, b.y) AS y FROM book{i} b LEFT JOIN means{i} m ON b.part = m.part AND b.e = m.e
)"""

ORACLES["op11_vector_codes"] = (
    r"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), cut AS MATERIALIZED (
  SELECT rid, part, v[part * (len(v) // 16) + 1:(part + 1) * (len(v) // 16)] AS x FROM kept, range(16) r(part)
), book0 AS MATERIALIZED (
  SELECT part, e, x AS y FROM cut JOIN (SELECT rid, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS e FROM kept) USING (rid) WHERE e < 64
),"""
    + ",".join((_ROUND + "," + _MEANS).format(i=i, j=i + 1) for i in range(2))
    + ","
    + _ROUND.format(i=2)
    + r""", coded AS (
  SELECT rid, string_agg(lpad(lower(to_hex(best.e)), 2, '0'), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM near2 GROUP BY rid
), whole AS (
  SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY part, e)) AS codebooks_sha256 FROM book2
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM kept JOIN coded USING (rid), whole
"""
)

ORACLES["op13_prefix_trie"] = r"""
WITH own AS MATERIALIZED (
  SELECT conv_id AS conv, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place,
         md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS mark, length(coalesce(text, '')) AS tokens
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv, conv - conv % 100 AS base,
         xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv::VARCHAR, ''), lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
             lambda acc, s: CASE WHEN s >= 0 THEN xor(acc, s) WHEN acc % 2 = 1 THEN xor(acc >> 1, 3988292384) ELSE acc >> 1 END), 4294967295::BIGINT) % 6 AS h
  FROM (SELECT DISTINCT conv FROM own)
), rebuilt AS (
  SELECT c.conv, 0 AS own_turn, o.place, o.mark, o.tokens FROM convs c JOIN own o ON o.conv = c.base AND o.place < c.h
  UNION ALL SELECT c.conv, 1, o.place, o.mark, o.tokens FROM convs c JOIN own o ON o.conv = c.conv AND o.place >= c.h
), path AS MATERIALIZED (
  SELECT conv, row_number() OVER w AS depth, string_agg(mark, '') OVER w AS k, tokens FROM rebuilt WINDOW w AS (PARTITION BY conv ORDER BY own_turn, place)
  UNION ALL SELECT conv, 0, '', 0 FROM convs
), nodes AS MATERIALIZED (
  SELECT depth, k, min(conv) AS conv_id, count(*) AS n_convs, max(tokens) AS tokens FROM path GROUP BY depth, k
), kids AS MATERIALIZED (
  SELECT n.depth, n.k, n.conv_id, n.n_convs, (n.n_convs - 1) * n.tokens AS saved, count(m.k) AS n_children
  FROM nodes n LEFT JOIN nodes m ON m.depth = n.depth + 1 AND m.k[1:32 * n.depth] = n.k GROUP BY ALL
), below AS (
  SELECT up.depth, up.k, sum(n.saved) AS saved_tokens, sum((n.n_children = 0)::INT) AS n_leaves
  FROM kids n JOIN path own ON own.conv = n.conv_id AND own.depth <= n.depth JOIN nodes up ON up.depth = own.depth AND up.k = own.k GROUP BY ALL
), ends AS (
  SELECT p.depth, p.k, sha256(string_agg(p.conv::VARCHAR, ',' ORDER BY p.conv)) AS ends_sha256
  FROM path p JOIN (SELECT conv, max(depth) AS depth FROM path GROUP BY conv) l USING (conv, depth) GROUP BY p.depth, p.k
)
SELECT n.conv_id, n.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, n.n_children::BIGINT AS n_children,
       below.n_leaves::BIGINT AS n_leaves, below.saved_tokens::BIGINT AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM kids n JOIN below USING (depth, k) LEFT JOIN ends USING (depth, k) LEFT JOIN nodes up ON up.depth = n.depth - 1 AND up.k = n.k[1:32 * (n.depth - 1)]
"""
