"""SQL of phrase mining and vector codes."""

from __future__ import annotations

PHRASES_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
         string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents
), pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(pieces) AS piece FROM docs)
), words AS (
  SELECT lang, unnest(w) AS word FROM pieces
), counts AS (
  SELECT lang, word, count(*) AS c FROM words GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM counts GROUP BY lang
), grams AS (
  SELECT lang, k, w[i:i + k - 1] AS g
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (VALUES (2), (3), (4), (5)) AS t(k))
), cand AS (
  SELECT lang, k, g, array_to_string(g, ' ') AS phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100
), known AS (
  SELECT lang, phrase, a FROM cand UNION ALL SELECT lang, word, c FROM counts WHERE c >= 100
), held AS (
  SELECT lang, array_to_string(unnest([g[1:k - 1], g[2:k]]), ' ') AS phrase, a FROM cand WHERE k > 2
), longest AS (
  SELECT lang, phrase, max(a) AS longer FROM held GROUP BY ALL
), free AS (
  SELECT c.* FROM cand c LEFT JOIN longest h ON h.lang = c.lang AND h.phrase = c.phrase WHERE h.longer IS NULL OR 100 * h.longer < 100 * c.a
), cuts AS (
  SELECT lang, phrase, a, g, k, unnest(range(1, k)) AS cut FROM free
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, l.a AS l, r.a AS r, t.n,
         CAST((CAST(1000 AS HUGEINT) * c.a * t.n) // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
  FROM cuts c
  JOIN known l ON l.lang = c.lang AND l.phrase = array_to_string(c.g[1:c.cut], ' ')
  JOIN known r ON r.lang = c.lang AND r.phrase = array_to_string(c.g[c.cut + 1:c.k], ' ')
  JOIN totals t ON t.lang = c.lang
), worst AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM worst QUALIFY rank <= 2000
"""


def vector_code_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Vector codes: one row a component; each round joins components with entries' components."""
    floor = lambda s, c: f"({s} - (({s} % {c}) + {c}) % {c}) // {c}"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""dist{r} AS (
  SELECT x.row, x.part, b.entry, CAST(sum((x.v - b.v) * (x.v - b.v)) AS BIGINT) AS d FROM cells x JOIN book{r} b ON b.part = x.part AND b.pos = x.pos GROUP BY ALL
), near{r} AS MATERIALIZED (
  SELECT row, part, min(d) AS d, arg_min(entry, (d, entry)) AS entry FROM dist{r} GROUP BY row, part
)""")
        if r < rounds:
            mean = floor("sum(x.v)", "count(*)")
            steps.append(f"""mean{r} AS (
  SELECT n.part, n.entry, x.pos, CAST({mean} AS BIGINT) AS v FROM near{r} n JOIN cells x ON x.row = n.row AND x.part = n.part GROUP BY ALL
), book{r + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, b.pos, coalesce(m.v, b.v) AS v FROM book{r} b LEFT JOIN mean{r} m ON m.part = b.part AND m.entry = b.entry AND m.pos = b.pos
)""")
    return f"""
WITH kept AS (
  SELECT vec_id, label, embedding AS e, row_number() OVER (ORDER BY vec_id) AS row FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cells AS MATERIALIZED (
  SELECT row, (i - 1) // (len(e) // {parts}) AS part, (i - 1) % (len(e) // {parts}) AS pos, CAST(floor(1024 * CAST(e[i] AS DOUBLE)) AS BIGINT) AS v
  FROM (SELECT row, e, unnest(range(1, len(e) + 1)) AS i FROM kept)
), book0 AS (
  SELECT part, row - 1 AS entry, pos, v FROM cells WHERE row <= {entries}
), {", ".join(steps)}, coded AS (
  SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY row
), labelled AS (
  SELECT k.label, CAST(sum(c.error) AS BIGINT) AS label_error FROM kept k JOIN coded c ON c.row = k.row GROUP BY k.label
)
SELECT k.vec_id, c.code, c.error, l.label_error, (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM book{rounds}) AS codebooks_sha256
FROM kept k JOIN coded c ON c.row = k.row JOIN labelled l ON l.label IS NOT DISTINCT FROM k.label
"""
