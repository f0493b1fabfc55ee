"""DuckDB SQL for the queries whose whole result SQL can state."""

from __future__ import annotations

import string

from .quality_divergence import (COMMON_SHARE, GUARD_CHARACTERS, GUARD_WORDS, LEAST_WORDS, MOST_REPEATED, NEAR_CLASSES,
                                 NEAR_WORDS, WINDOW)


def _lower(column: str) -> str:
    """A-Z lower-cased, null as empty."""
    return f"translate(coalesce({column}, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


WINNOWING = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_lower('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({_lower('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bn AS (SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0
), bi AS (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM bn
), bw AS (SELECT DISTINCT item_id, n, list_slice(w, i, i + n - 1) AS g FROM bi
), sizes AS (SELECT DISTINCT n FROM bw
), di AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes
), hit AS (
  SELECT DISTINCT doc_id, i, n, item_id
  FROM (SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS g FROM di) JOIN bw USING (n, g)
), pos AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# A pattern for each character class, in order.
_CLASSES = [r"[a-z]", r"[A-Z]", r"[0-9]", r"\x20", r"[\n\r]", r"[\t\x0B\x0C]", r"""[.,;:!?\x27"()-]""", r"[#*$%&|<>]",
            r"[/@\[\]\\^_`{}~+=]", r"[\x00-\x08\x0E-\x1F\x7F]", r"[\x{C0}-\x{FF}]", r"[^\x00-\x7F\x{C0}-\x{FF}]"]


def _kept(pattern: str) -> str:
    return f"length(t) - length(regexp_replace(t, '{pattern}', '', 'g'))"


def _part(p: str = "p", q: str = "q") -> str:
    """Twice one value's share of the Jensen-Shannon divergence in bits."""
    return (f"CASE WHEN {p} > 0 THEN {p} * log2({p} / (({p} + {q}) / 2)) ELSE 0 END"
            f" + CASE WHEN {q} > 0 THEN {q} * log2({q} / (({p} + {q}) / 2)) ELSE 0 END")


DIVERGENCE = rf"""
WITH d AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), base AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         {_kept('[#*$%&|<>]')} AS n_symbols, length(t) AS n_characters FROM d
), lines AS (
  SELECT doc_id, CAST(sum(n - 1) AS BIGINT) AS n_dup_lines FROM (
    SELECT doc_id, line, count(*) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL) GROUP BY doc_id
), win AS (
  SELECT doc_id, i, list_slice(w, i, i + {WINDOW - 1}) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d)
), twice AS (SELECT doc_id, g FROM win GROUP BY ALL HAVING count(*) > 1
), repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM win JOIN twice USING (doc_id, g)) GROUP BY doc_id
), classes AS (
  SELECT doc_id, lang, unnest(range(0, 12)) AS cls, unnest([{", ".join(_kept(c) for c in _CLASSES)}]) AS n FROM d
), of_lang AS (
  SELECT lang, cls, sum(n) / sum(sum(n)) OVER (PARTITION BY lang) AS q FROM classes WHERE lang IS NOT NULL GROUP BY lang, cls
), of_doc AS (
  SELECT doc_id, cls, n / greatest(1, sum(n) OVER (PARTITION BY doc_id)) AS p FROM classes
), class_distance AS (
  SELECT doc_id, lang AS reference, sqrt(greatest(0, least(1, sum({_part()}) / 2))) AS cd
  FROM of_doc JOIN of_lang USING (cls) GROUP BY ALL
), words AS (
  SELECT doc_id, lang, unnest(regexp_extract_all({_lower('t')}, '[^\x20\x09-\x0D]+')) AS word FROM d
), common AS (
  SELECT lang, word, n / total AS q FROM (
    SELECT lang, word, count(*) AS n, sum(count(*)) OVER (PARTITION BY lang) AS total FROM words WHERE lang IS NOT NULL GROUP BY lang, word)
  WHERE n >= {COMMON_SHARE} * total
), counts AS (SELECT doc_id, word, count(*) AS n FROM words GROUP BY ALL
), seen AS (
  SELECT c.doc_id, m.lang, n / n_words AS p, q FROM counts c JOIN common m USING (word) JOIN base USING (doc_id)
), sums AS (
  SELECT b.doc_id, m.lang, any_value(m.q_all) AS q_all, coalesce(sum(s.p), 0) AS p_seen, coalesce(sum(s.q), 0) AS q_seen,
         coalesce(sum(CASE WHEN s.p IS NULL THEN 0 ELSE {_part("s.p", "s.q")} END), 0) AS parts
  FROM base b CROSS JOIN (SELECT lang, sum(q) AS q_all FROM common GROUP BY lang) m
  LEFT JOIN seen s ON s.doc_id = b.doc_id AND s.lang = m.lang GROUP BY b.doc_id, m.lang
), rest AS (
  SELECT doc_id, lang, parts, 1 - p_seen AS p, 1 - q_all AS q, greatest(0, q_all - q_seen) AS unseen FROM sums
), word_distance AS (
  SELECT doc_id, lang AS reference, sqrt(greatest(0, least(1, (parts + {_part()} + unseen) / 2))) AS wd FROM rest
), verdicts AS (
  SELECT *, (cd <= {NEAR_CLASSES} OR n_characters < {GUARD_CHARACTERS}) AND (wd <= {NEAR_WORDS} OR n_words < {GUARD_WORDS}) AS fine
  FROM class_distance JOIN word_distance USING (doc_id, reference) JOIN base USING (doc_id)
), best AS (
  SELECT doc_id, bool_or(fine) AS near, arg_min(struct_pack(reference, cd, wd), CASE WHEN fine THEN cd + wd ELSE 9 + cd + wd END) AS b
  FROM verdicts GROUP BY doc_id
), counted AS (
  SELECT *, coalesce(n_repeat_words, 0) AS n_repeat,
         n_words < {LEAST_WORDS} OR 100 * coalesce(n_repeat_words, 0) > {MOST_REPEATED} * n_words AS base_failed
  FROM base LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id) JOIN best USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, CAST(n_repeat AS BIGINT) AS n_repeat_words,
       base_failed, NOT base_failed AND near AS kept, b.reference AS reference, b.cd AS class_distance, b.wd AS word_distance
FROM counted
"""

COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_lower('text')}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang
), grams AS (
  SELECT lang, size, list_slice(w, i, i + size - 1) AS g
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS size))
), f AS (SELECT lang, size, g, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10
), cand AS (SELECT lang, size, g, f AS a FROM f WHERE size > 1
), covered AS (
  SELECT DISTINCT s.lang, s.g FROM (SELECT lang, a, unnest([g[1:2], g[2:3]]) AS g FROM cand WHERE size = 3) t
  JOIN cand s ON s.lang = t.lang AND s.g = t.g WHERE 100 * t.a >= 50 * s.a
), cuts AS (
  SELECT lang, g, a, k, g[1:k] AS gl, g[k + 1:size] AS gr FROM (SELECT *, unnest(range(1, size)) AS k FROM cand)
), scored AS (
  SELECT c.lang, c.g, a, k, x.f AS l, y.f AS r, CAST(1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.g = gl JOIN f y ON y.lang = c.lang AND y.g = gr
), best AS (
  SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS place FROM scored ANTI JOIN covered USING (lang, g)
), ranked AS (
  SELECT *, array_to_string(g, ' ') AS phrase,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank FROM best WHERE place = 1
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

_TERMS = rf"regexp_extract_all({_lower('text')}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SEARCH = f"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS w FROM documents
), sizes AS (SELECT count(*) AS all_docs, CAST(sum(len(w)) AS BIGINT) AS all_terms FROM d WHERE len(w) > 0
), tf AS (
  SELECT row, doc_id, n, term, count(*) AS tf FROM (SELECT row, doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * all_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
  FROM tf, sizes GROUP BY term, all_docs
), items AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark
), scored AS (
  SELECT item_id, row, doc_id,
         CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * all_docs) // all_terms)))) AS BIGINT) AS score
  FROM items JOIN tf USING (term) JOIN weights USING (term), sizes GROUP BY ALL
), ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

# Equal sets are one node; walks over its links end at the smallest doc_id reached.
JACCARD = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({_lower('text')}, '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT row, doc_id, list_sort(list_distinct(list_transform(range(1, greatest(2, len(w) - 2)), lambda i: array_to_string(w[i:i + 3], ' ')))) AS s
  FROM d WHERE len(w) > 0
), nodes AS (SELECT s, min(doc_id) AS doc, row_number() OVER () AS node FROM sets GROUP BY s
), shingles AS (SELECT node, len(s) AS n, unnest(s) AS x FROM nodes
), links AS (
  SELECT a.node AS a, b.node AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.node <> b.node
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), walk(node, reached) AS (
  SELECT node, node FROM nodes UNION SELECT walk.node, b FROM walk JOIN links ON reached = a
), named AS (SELECT w.node, min(n.doc) AS component FROM walk w JOIN nodes n ON n.node = reached GROUP BY w.node
)
SELECT d.doc_id, CAST(coalesce(len(sets.s), 0) AS BIGINT) AS n_shingles, CASE WHEN sets.s IS NULL THEN d.doc_id ELSE component END AS component_id
FROM d LEFT JOIN sets USING (row) LEFT JOIN nodes ON nodes.s = sets.s LEFT JOIN named USING (node)
"""
