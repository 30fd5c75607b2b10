"""SQL counterparts of the queries that SQL can express."""

OP3 = r"""
WITH extra AS (
  SELECT -1::BIGINT AS conv_id, r.turn::BIGINT AS turn, r.role, '<|im_end|><|im_start|>assistant ok' AS text
  FROM (VALUES (0, 'user'), (1, 'assistant')) AS r(turn, role)
), turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM extra
), sized AS (
  SELECT *, length('<|im_start|>') + length(role) + 1 + length('<|im_end|>') + 1
    + length(regexp_replace(text, '<([|\\])', '<x\1', 'g')) + CASE WHEN text LIKE '%<' THEN 1 ELSE 0 END AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

OP8 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM words
), classes AS (
  SELECT list_sort(s) AS s, len(s) AS n, min(doc_id) AS rep FROM sets WHERE len(s) > 0 GROUP BY ALL
), items AS (
  SELECT rep, n, unnest(s) AS item FROM classes
), links AS (
  SELECT a.rep AS x, b.rep AS y FROM items a JOIN items b ON a.item = b.item AND a.rep < b.rep
  WHERE 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), both_ways AS (
  SELECT x, y FROM links UNION SELECT y, x FROM links
), reach AS (
  SELECT rep AS start, rep AS node FROM classes
  UNION SELECT reach.start, both_ways.y FROM reach JOIN both_ways ON reach.node = both_ways.x
), least_of AS (
  SELECT start, min(node) AS component_id FROM reach GROUP BY start
)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(l.component_id, d.doc_id) AS component_id
FROM sets d LEFT JOIN classes c ON list_sort(d.s) = c.s LEFT JOIN least_of l ON l.start = c.rep
"""



def _op12(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Every round is a pair of tables: nearest entries by comparing with all, and the entries' new places."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT rn, p, any_value(v) AS v, min({entries} * list_sum(list_transform(range(1, len(v) + 1),
    lambda i: (v[i] - c[i]) * (v[i] - c[i])))::HUGEINT + e) AS best
  FROM cut JOIN c{r} USING (p) GROUP BY rn, p
)""")
        if r < rounds:
            steps.append(f"""
m{r} AS MATERIALIZED (
  SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM (
    SELECT p, CAST(best % {entries} AS BIGINT) AS e, i, sum(v[i])::HUGEINT AS s, count(*) AS n
    FROM a{r}, (SELECT unnest(range(1, (SELECT any_value(len(v)) FROM cut) + 1)) AS i) GROUP BY ALL
  ) GROUP BY p, e
), c{r + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m.c, o.c) AS c FROM c{r} o LEFT JOIN m{r} m USING (p, e)
)""")
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * x::DOUBLE) AS BIGINT)) AS v,
    row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rn
  FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cut AS MATERIALIZED (
  SELECT rn, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS v
  FROM kept, (SELECT unnest(range(0, {parts})) AS p)
), c0 AS MATERIALIZED (
  SELECT p, rn - 1 AS e, v AS c FROM cut WHERE rn <= {entries}
),{",".join(steps)},
coded AS (
  SELECT rn, string_agg(printf('%02x', CAST(best % {entries} AS BIGINT)), '' ORDER BY p) AS code,
    CAST(sum(best // {entries}) AS BIGINT) AS error
  FROM a{rounds} GROUP BY rn
), books AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (rn), books
"""


ORACLES = {"op3_chat": OP3, "op8_ngram_join": OP8, "op12_codes": _op12()}
