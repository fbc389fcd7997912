"""DuckDB SQL of the operators that SQL can express, over the whole tables."""

from __future__ import annotations

from strata.llm import quality_rules

_SPACES = r"[\x20\x09-\x0D]+"


def op4(width: int = 20) -> str:
    return rf"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '{_SPACES}'), lambda x: x <> '') AS ws
  FROM documents
), win AS (
  SELECT doc_id, i, list_aggregate(ws[i:i + {width - 1}], 'string_agg', ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {width - 2})) AS i FROM w)
), later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS n FROM win) WHERE n > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + {width})) AS p FROM later
), kept AS (
  SELECT a.doc_id, string_agg(a.word, ' ' ORDER BY a.p) AS body, count(*) AS n
  FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w) a
  ANTI JOIN gone b ON a.doc_id = b.doc_id AND a.p = b.p
  GROUP BY a.doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.body, '')) AS kept_sha256
FROM w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""


def op7() -> str:
    rules = {r.measure: r for r in quality_rules.RULES}
    stops = ", ".join(f"'{w}'" for w in dict.fromkeys(quality_rules.STOP_WORDS))
    value = {
        "mean_word_length": "CASE WHEN n_words > 0 THEN word_chars / n_words END",
        "symbols_per_word": "CASE WHEN n_words > 0 THEN n_symbols / n_words END",
        "stop_words": "CASE WHEN n_words > 0 THEN n_stop_words END",
        "duplicate_line_ratio": "CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines END",
        "bullet_line_ratio": "CASE WHEN n_lines > 0 THEN n_bullet_lines / n_lines END",
        "ellipsis_line_ratio": "CASE WHEN n_lines > 0 THEN n_ellipsis_lines / n_lines END",
    }
    passes = []
    for name, rule in rules.items():
        if rule.least is not None:
            passes.append(f"coalesce({value[name]} >= {rule.least}, true)")
        if rule.most is not None:
            passes.append(f"coalesce({value[name]} <= {rule.most}, true)")
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, t, list_filter(string_split_regex(t, '{_SPACES}'), lambda x: x <> '') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), g AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS n
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)
), r AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM g WHERE n > 1) GROUP BY doc_id
), c AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) AS BIGINT) AS n_lines,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         len(list_intersect(ws, [{stops}])) AS n_stop_words,
         len(list_filter(ls, lambda x: regexp_matches(x, '^[\x20\x09]*[-*•‣·]'))) AS n_bullet_lines,
         len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis_lines
  FROM w LEFT JOIN r ON w.doc_id = r.doc_id
), b AS (
  SELECT *, n_words < {quality_rules.MIN_WORDS}
            OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM c
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(passes)} AS kept
FROM b
"""


def op6(width: int = 10) -> str:
    terms = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', " \
            r"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    return rf"""
WITH i AS (SELECT item_id, {terms} AS ws FROM benchmark),
d AS (SELECT doc_id, {terms} AS ws FROM documents),
w AS (
  SELECT DISTINCT item_id, least(len(ws), {width}) AS size,
         array_to_string(ws[k:k + least(len(ws), {width}) - 1], ' ') AS g
  FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(len(ws), {width}) + 2)) AS k FROM i WHERE len(ws) > 0)
), p AS (
  SELECT doc_id, k, size, array_to_string(ws[k:k + size - 1], ' ') AS g
  FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS k
        FROM d, (SELECT DISTINCT size FROM w) WHERE len(ws) >= size)
), h AS (
  SELECT p.doc_id, p.k, p.size, w.item_id FROM p JOIN w ON p.size = w.size AND p.g = w.g
), hit AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + size)) AS word FROM h) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN named ON d.doc_id = named.doc_id
"""


def op8(min_bytes: int = 1000) -> str:
    return f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS holder
  FROM pages
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n < {min_bytes} OR page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN n < {min_bytes} OR page_id = holder THEN NULL ELSE holder END AS refers_to
FROM p
"""


def op9(shingle: int = 4, percent: int = 80) -> str:
    words = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', " \
            rf"'abcdefghijklmnopqrstuvwxyz'), '{_SPACES}'), lambda x: x <> '')"
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, {words} AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[k:k + least(len(ws), {shingle}) - 1], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - least(len(ws), {shingle}) + 2)) AS k FROM w WHERE len(ws) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * common >= {percent} * (p.n + q.n - common)
), reach AS (
  SELECT doc_id AS node, doc_id AS via FROM w
  UNION
  SELECT reach.node, links.y FROM reach JOIN links ON links.x = reach.via
), least_id AS (SELECT node, min(via) AS component_id FROM reach GROUP BY node)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w LEFT JOIN n ON w.doc_id = n.doc_id JOIN least_id ON least_id.node = w.doc_id
"""


_USABLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def op11() -> str:
    """All scores of the anchors, the best positives by window functions, then the window of each."""
    return f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE label IS NOT NULL AND {_USABLE}),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id AS other, b.label AS label,
         CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, own, other AS positive_id, score AS positive_score FROM scored WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE label <> positives.own AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) <= 10"""


def op12() -> str:
    """All cosines; the least vec_id reachable by a recursive walk over the links."""
    return f"""
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings WHERE {_USABLE}),
n AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS size FROM v WHERE list_dot_product(e, e) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.95),
reached AS (SELECT vec_id, vec_id AS place FROM embeddings UNION SELECT reached.vec_id, links.b FROM reached JOIN links ON place = links.a)
SELECT e.vec_id, coalesce(l.n, 0) AS n_links, r.least AS component_id, e.vec_id = r.least AS kept
FROM embeddings e JOIN (SELECT vec_id, min(place) AS least FROM reached GROUP BY vec_id) r USING (vec_id)
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) l ON l.a = e.vec_id"""
