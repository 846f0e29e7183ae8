"""DuckDB SQL for the queries whose whole tables are within SQL's reach."""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), lists AS (
  SELECT lang, row_number() OVER () AS id, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), words AS (
  SELECT lang, id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM lists
), following AS (
  SELECT lang, word, lead(word) OVER piece AS second, lead(word, 2) OVER piece AS third FROM words WINDOW piece AS (PARTITION BY id ORDER BY i)
), grams AS (
  SELECT lang, 1 AS k, [word] AS p FROM following
  UNION ALL SELECT lang, 2, [word, second] FROM following WHERE second IS NOT NULL
  UNION ALL SELECT lang, 3, [word, second, third] FROM following WHERE third IS NOT NULL
), counted AS (
  SELECT lang, k, p, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT * FROM counted WHERE k > 1 AND f >= 10
), cuts AS (
  SELECT c.lang, c.k, c.p, c.f AS a, j.cut, x.f AS l, y.f AS r, (1000000::HUGEINT * c.f * c.f) // (x.f::HUGEINT * y.f) AS score
  FROM candidates c JOIN (VALUES (1), (2)) AS j(cut) ON j.cut < c.k
  JOIN counted x ON x.lang = c.lang AND x.p = list_slice(c.p, 1, j.cut)
  JOIN counted y ON y.lang = c.lang AND y.p = list_slice(c.p, j.cut + 1, c.k)
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, list_slice(p, s.cut, s.cut + 1) AS p, max(f) AS around
  FROM candidates CROSS JOIN (VALUES (1), (2)) AS s(cut) WHERE k = 3 GROUP BY ALL
), kept AS (
  SELECT lowest.*, array_to_string(p, ' ') AS phrase FROM lowest LEFT JOIN inside USING (lang, p)
  WHERE around IS NULL OR 100 * around < 50 * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000
"""

HARD_NEGATIVES = r"""
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS friends, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE friends
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id))::INTEGER AS rank,
       s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.friends
WHERE 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""
