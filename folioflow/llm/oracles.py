"""SQL that gives the rows of the queries which SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPLIT = "list_filter(regexp_split_to_array({}, '{}'), lambda x: x <> '')"
_WHITE, _BETWEEN = "[\\x20\\x09-\\x0D]+", "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SPLIT.format(_LOWER, _WHITE)} AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END)) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, m.component_id = d.doc_id AS kept FROM d LEFT JOIN n USING (doc_id) JOIN m USING (doc_id)
"""

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_SPLIT.format(_LOWER, _BETWEEN)} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_SPLIT.format(_LOWER, _BETWEEN)} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS g FROM (SELECT item, w, least(10, len(w)) AS size, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS g FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
h AS (SELECT doc_id, i, dw.size AS size, item FROM dw JOIN bw USING (size, g)),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT doc_id, i, size FROM h)) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""

SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, {_SPLIT.format("coalesce(text, '')", _WHITE)} AS w FROM documents),
x AS (SELECT doc_id, i, hash(g) AS h, g FROM (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20))),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS n FROM x),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM r WHERE n > 1),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
k AS (SELECT word.doc_id, count(gone.p) AS n_removed, string_agg(word, ' ' ORDER BY word.p) FILTER (gone.p IS NULL) AS kept FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.p = word.p GROUP BY word.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""

_H = "CAST('0x' || substr(h, {}, 8) AS BIGINT)"

FILL_IN_MIDDLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
c AS (SELECT doc_id, t, u, len(u) AS n, least({_H.format(1)} % (len(u) + 1), {_H.format(9)} % (len(u) + 1)) AS a, greatest({_H.format(1)} % (len(u) + 1), {_H.format(9)} % (len(u) + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain' WHEN {_H.format(25)} % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT doc_id, t, n, form, array_to_string(list_slice(u, 1, a), '') AS pre, array_to_string(list_slice(u, a + 1, b), '') AS mid, array_to_string(list_slice(u, b + 1, n), '') AS suf FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE t END) AS output_sha256, sha256(t) AS restored_sha256 FROM p
"""


def _rounds(n: int) -> str:
    """b{n} holds the codebooks after n rounds, a{n} the nearest entries by them."""
    steps = []
    for i in range(n + 1):
        steps.append(f"a{i} AS MATERIALIZED (SELECT vec_id, part, min_by(e, dist * 1000 + e) AS e, min(dist) AS dist FROM (SELECT v.vec_id, v.part, b.e, CAST(sum((v.x - b.x) * (v.x - b.x)) AS BIGINT) AS dist FROM v JOIN b{i} b USING (part, pos) GROUP BY ALL) GROUP BY ALL)")
        if i < n:
            steps.append(f"s{i} AS (SELECT part, e, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS c FROM v JOIN a{i} USING (vec_id, part) GROUP BY ALL)")
            steps.append(f"b{i + 1} AS MATERIALIZED (SELECT part, e, pos, CASE WHEN c IS NULL THEN x ELSE (s - ((s % c) + c) % c) // c END AS x FROM b{i} LEFT JOIN s{i} USING (part, e, pos))")
    return ",\n".join(steps)


VECTOR_CODES = f"""
WITH k AS (SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id) - 1 AS n FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (SELECT vec_id, n, (p - 1) // (len(embedding) // 8) AS part, (p - 1) % (len(embedding) // 8) AS pos, CAST(floor(4096 * CAST(embedding[p] AS DOUBLE)) AS BIGINT) AS x FROM (SELECT vec_id, n, embedding, unnest(range(1, len(embedding) + 1)) AS p FROM k)),
b0 AS MATERIALIZED (SELECT part, n AS e, pos, x FROM v WHERE n < 16),
{_rounds(6)},
c AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY part) AS code, CAST(sum(dist) AS BIGINT) AS error FROM a6 GROUP BY vec_id),
l AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM c JOIN k USING (vec_id) GROUP BY label)
SELECT c.vec_id, code, error, label_error, (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, e, pos)) FROM b6) AS codebooks_sha256
FROM c JOIN k USING (vec_id) JOIN l ON l.label IS NOT DISTINCT FROM k.label
"""

ORACLES = {"op1_near_duplicates": NEAR_DUPLICATES, "op3_decontamination": DECONTAMINATION, "op8_substring_dedup": SUBSTRING_DEDUP, "op11_fill_in_middle": FILL_IN_MIDDLE, "op12_vector_codes": VECTOR_CODES}
