"""The training data queries as SQL, where SQL can express them."""

from stowline.llm.secrets import BASE_KINDS, RULES

_TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DIVERGENCE = f"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
  FROM documents
), words AS (
  SELECT d, lang, source, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_TERM}')) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*)::HUGEINT AS n FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= 30
), held AS (
  SELECT lang, source, term, count(*)::HUGEINT AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), sizes AS (
  SELECT lang, source, sum(coalesce(h.n, 0))::HUGEINT AS whole FROM groups LEFT JOIN held AS h USING (lang, source) GROUP BY lang, source
), langs AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS whole FROM kept GROUP BY lang
), parts AS (
  SELECT s.lang, s.source, k.term, coalesce(h.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(h.n, 0) + 5)) // (s.whole + 5 * l.v) AS p,
    1 + (1000000000::HUGEINT * (k.n + 5)) // (l.whole + 5 * l.v) AS q
  FROM sizes AS s JOIN kept AS k ON s.lang = k.lang JOIN langs AS l ON s.lang = l.lang
    LEFT JOIN held AS h ON h.lang = s.lang AND h.source = s.source AND h.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value
  FROM parts AS a JOIN parts AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), all_pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
  FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs AS p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value FROM all_pairs
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM parts WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value,
  row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank
FROM ranked QUALIFY part = 'pair' OR rank <= 50
"""


def _either_case(pattern):
    """ASCII letters outside of classes and groups' marks in either case, as classes of two."""
    out, inside = [], False
    for c in pattern:
        inside = c == "[" or inside and c != "]"
        out.append(f"[{c.upper()}{c}]" if c in _LOWER and not inside else c)
    return "".join(out).replace(r"\[Xx]20", r"\x20")


def _spans(order, rule):
    """Starts and ends of a rule's matches: pieces between matches and matches take turns."""
    pattern = (_either_case(rule.pattern) if rule.any_case else rule.pattern).replace("'", "''")
    least = f"length(regexp_extract(m[i], '{pattern}', {rule.group})) >= {rule.least}"
    return f"""
  SELECT d, {order} AS ord, '{rule.kind}' AS kind, start, start + size AS stop FROM (
    SELECT d, unnest(list_transform(range(1, len(m) + 1), lambda i: {{
      'start': list_sum(list_transform(between[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0),
      'size': length(m[i]), 'good': {least}}}), recursive := true)
    FROM (SELECT d, regexp_extract_all(text, '{pattern}') AS m, regexp_split_to_array(text, '{pattern}') AS between
      FROM docs WHERE regexp_matches(text, '{pattern}'))
  ) WHERE good"""


SECRETS = f"""
WITH docs AS (
  SELECT row_number() OVER () AS d, doc_id, coalesce(text, '') AS text FROM documents
), spans AS ({" UNION ALL ".join(_spans(order, rule) for order, rule in enumerate(RULES))}
), told AS (
  SELECT d, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE_KINDS)},
    string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, ord) FILTER (ord < {len(BASE_KINDS)}) AS base,
    string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, ord) AS spans
  FROM spans GROUP BY d
)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE_KINDS)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(t.spans, '') AS spans
FROM docs LEFT JOIN told AS t USING (d)
"""


def _vector_codes(parts=4, entries=256, rounds=4):
    assign = """
  SELECT r, part, min(far * 256 + entry) % 256 AS entry, min(far * 256 + entry) // 256 AS far
  FROM (SELECT x.r, x.part, c.entry, sum((x.x - c.x) * (x.x - c.x))::BIGINT AS far
        FROM cells AS x JOIN {book} AS c ON x.part = c.part AND x.place = c.place GROUP BY ALL)
  GROUP BY r, part"""
    steps = []
    for n in range(1, rounds + 1):
        steps.append(f"near{n} AS MATERIALIZED ({assign.format(book=f'book{n - 1}')})")
        steps.append(f"""book{n} AS MATERIALIZED (
  SELECT b.part, b.entry, b.place, coalesce(m.x, b.x) AS x FROM book{n - 1} AS b LEFT JOIN (
    SELECT part, entry, place, ((s - ((s % c) + c) % c) // c)::BIGINT AS x FROM (
      SELECT x.part, a.entry, x.place, sum(x.x)::HUGEINT AS s, count(*)::HUGEINT AS c
      FROM cells AS x JOIN near{n} AS a ON x.r = a.r AND x.part = a.part GROUP BY ALL)
  ) AS m ON b.part = m.part AND b.entry = m.entry AND b.place = m.place)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, embedding, len(embedding) // {parts} AS width
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cells AS MATERIALIZED (
  SELECT r, i // width AS part, i % width AS place, floor(1024 * embedding[i + 1]::DOUBLE)::BIGINT AS x
  FROM (SELECT r, width, embedding, unnest(range(0, len(embedding))) AS i FROM kept)
), book0 AS MATERIALIZED (
  SELECT part, r - 1 AS entry, place, x FROM cells WHERE r <= {entries}
), {", ".join(steps)}, final AS MATERIALIZED ({assign.format(book=f"book{rounds}")}
), coded AS (
  SELECT r, string_agg(printf('%02x', entry::INTEGER), '' ORDER BY part) AS code, sum(far)::BIGINT AS error FROM final GROUP BY r
), told AS (
  SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM book{rounds}
)
SELECT k.vec_id, c.code, c.error, (sum(c.error) OVER (PARTITION BY k.label))::BIGINT AS label_error, t.codebooks_sha256
FROM kept AS k JOIN coded AS c ON k.r = c.r CROSS JOIN told AS t
"""


def _reached(nodes):
    """CTE ``least`` (r, c): each node of ``nodes`` with the smallest that ``links`` (a, b) lead to."""
    return f"""reached(r, c) AS (
  SELECT r, r FROM {nodes} UNION SELECT l.b, reached.c FROM reached JOIN links AS l ON l.a = reached.r WHERE reached.c < l.b
), least AS (
  SELECT r, min(c) AS c FROM reached GROUP BY r
)"""


JACCARD = f"""
WITH RECURSIVE docs AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS MATERIALIZED (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM docs
), tokens AS MATERIALIZED (
  SELECT r, len(s) AS n, unnest(s) AS token FROM sets
), links AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b FROM tokens AS a JOIN tokens AS b ON a.token = b.token AND a.r <> b.r
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), {_reached("sets")}
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, t.doc_id AS component_id
FROM sets AS s JOIN least USING (r) JOIN sets AS t ON t.r = least.c
"""

NEAR_VECTORS = f"""
WITH RECURSIVE vectors AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, embedding::DOUBLE[] AS v,
    embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS good
  FROM embeddings
), links AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b FROM vectors AS a JOIN vectors AS b ON a.good AND b.good AND a.r <> b.r
  WHERE CASE WHEN len(a.v) = len(b.v) THEN list_cosine_similarity(a.v, b.v) >= 0.9 ELSE FALSE END
), {_reached("vectors")}
SELECT v.vec_id, (SELECT count(*) FROM links WHERE a = v.r) AS n_links, t.vec_id AS component_id, v.vec_id = t.vec_id AS kept
FROM vectors AS v JOIN least USING (r) JOIN vectors AS t ON t.r = least.c
"""

TOP_SCORES = """
WITH vectors AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM vectors AS q JOIN vectors AS c ON q.r <> c.r WHERE q.vec_id % 100 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scores QUALIFY rank <= 10
"""


ORACLES = {
    "op4_token_group_jaccard": JACCARD,
    "op9_int8_near_vectors": NEAR_VECTORS,
    "op10_uniform_threshold_top_k": TOP_SCORES,
    "op11_arrow_divergence": DIVERGENCE,
    "op12_blob_ledger_secrets": SECRETS,
    "op13_laesa_vector_codes": _vector_codes(),
}
