"""DuckDB SQL for the registered queries of the operators that SQL can express."""

from __future__ import annotations

_LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"
_MASKS = ((0, 1, 2, 4), (0, 2, 5, 6), (0, 3, 5, 6))

NGRAM_JACCARD = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {_WORDS.format(_LOWERED.format('text'))} AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 4 THEN list_distinct(list_transform(
      range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words
), grams AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b USING (g)
  WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reached AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), least AS (
  SELECT a, min(b) AS b FROM reached GROUP BY a
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles,
  least(doc_id, coalesce(b, doc_id)) AS component_id
FROM sets LEFT JOIN least ON doc_id = a
"""


def _seeds(words: str, ident: str, source: str) -> str:
    parts = [
        f"SELECT {ident}, i - 1 AS p, {m} AS mask, "
        f"[{', '.join(f'{words}[i + {k}]' for k in mask)}] AS seed FROM {source}"
        for m, mask in enumerate(_MASKS)
    ]
    return " UNION ALL ".join(parts)


def _tokens(ident: str, name: str) -> str:
    return (
        f"SELECT {ident}, list_filter(regexp_split_to_array(lower(coalesce(text, '')), "
        rf"'[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w FROM {name}"
    )


DECONTAMINATION = f"""
WITH docs AS ({_tokens('doc_id', 'documents')}), items AS ({_tokens('item_id', 'benchmark')}),
doc_at AS (SELECT doc_id, w, unnest(range(1, len(w) - 5)) AS i FROM docs),
item_at AS (SELECT item_id, w, unnest(range(1, len(w) - 5)) AS i FROM items),
d AS ({_seeds('w', 'doc_id', 'doc_at')}), t AS ({_seeds('w', 'item_id', 'item_at')}),
hits AS (
  SELECT DISTINCT doc_id, item_id, d.p - t.p AS start
  FROM d JOIN t ON d.seed = t.seed AND d.mask = t.mask
), equal AS (
  SELECT doc_id, item_id, start, CAST(len(i.w) AS BIGINT) AS n_tokens,
    list_filter(range(len(i.w)), lambda x: start + x >= 0 AND d.w[start + x + 1] = i.w[x + 1]) AS e
  FROM hits JOIN items i USING (item_id) JOIN docs d USING (doc_id)
), judged AS (
  SELECT *, CAST(len(e) AS BIGINT) AS n_matched, list_max(list_transform(e,
    lambda f: len(list_filter(e, lambda x: x >= f AND x < f + 13)))) AS near FROM equal
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id
    ORDER BY n_matched DESC, start) AS r FROM judged
  WHERE n_matched >= 0.6 * n_tokens OR near >= 11
)
SELECT doc_id, item_id, CAST(start AS BIGINT) AS start, n_tokens, n_matched,
  CAST(n_matched AS DOUBLE) / n_tokens AS overlap
FROM ranked WHERE r = 1
"""

_HOST = r"""coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')"""
_PATH = r"coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '')"

URL_FILTER = rf"""
WITH parts AS (
  SELECT page_id, url, {_HOST} AS host, {_PATH} AS path FROM pages
), keyed AS (
  SELECT *, regexp_replace(host, '^www\.', '') || regexp_replace(path, '/$', '') AS key
  FROM parts
), listed AS (
  SELECT DISTINCT key FROM keyed WHERE regexp_matches(url, '(?s)\?[^#]*utm_') AND key <> ''
), rules(verdict, host, path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
    ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fitting AS (
  SELECT k.page_id, k.host, k.path, k.key, r.host || r.path AS rule, r.verdict,
    row_number() OVER (PARTITION BY k.page_id ORDER BY length(r.host || r.path) DESC NULLS LAST)
      AS n
  FROM keyed k LEFT JOIN rules r
    ON (k.host = r.host OR suffix(k.host, '.' || r.host)) AND starts_with(k.path, r.path)
)
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN l.key IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM fitting f LEFT JOIN listed l ON f.key = l.key WHERE n = 1
"""

SUBSTRING_DEDUP = f"""
WITH words AS (
  SELECT doc_id, {_WORDS.format('text')} AS w FROM documents
), starts AS (
  SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words)
), first AS (
  SELECT g, min(doc_id) AS low FROM starts GROUP BY g
), repeated AS (
  SELECT doc_id, i FROM starts JOIN first USING (g) WHERE low < doc_id
), places AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words
), judged AS (
  SELECT p.doc_id, p.i, p.word, coalesce(max(r.i) OVER (PARTITION BY p.doc_id ORDER BY p.i)
    >= p.i - 49, false) AS gone
  FROM places p LEFT JOIN repeated r ON p.doc_id = r.doc_id AND p.i = r.i
), kept AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed,
    string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS text
  FROM judged GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""

BIT_SLICED_TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding,
    lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r
  FROM scored
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5
"""

FILL_IN_MIDDLE = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || CAST(doc_id AS VARCHAR)) AS h,
    regexp_extract_all(coalesce(text, ''),
      '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents
), numbers AS (
  SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM drawn
), formed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN h IS NULL OR t = '' OR contains(t, '<P>') OR contains(t, '<S>')
      OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
    WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers
), parts AS (
  SELECT doc_id, n, form, t, array_to_string(u[1:a], '') AS p,
    array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s
  FROM formed
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""

ORACLE: dict[str, str] = {
    "op1_ngram_jaccard": NGRAM_JACCARD,
    "op5_decontamination": DECONTAMINATION,
    "op6_url_filter": URL_FILTER,
    "op7_substring_dedup": SUBSTRING_DEDUP,
    "op10_bit_sliced_topk": BIT_SLICED_TOPK,
    "op11_fill_in_middle": FILL_IN_MIDDLE,
}
