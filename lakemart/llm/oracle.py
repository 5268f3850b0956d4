"""The same results as SQL for the second engine, where SQL can express them."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

SOURCE_MIXING = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         length(coalesce(text, '')) AS chars,
         length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#*$%&|<>', '')) AS symbols,
         (('0x' || substr(md5('mix-1' || chr(31) || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT)::DOUBLE
           / 4503599627370496.0 + pow(2.0, -54) AS draw
  FROM documents),
keyed AS (
  SELECT *, -ln(draw) / greatest(1e-6, (1.0::DOUBLE - 0.9::DOUBLE * least(1.0::DOUBLE, 10.0::DOUBLE *
           CASE WHEN chars > 0 THEN symbols::DOUBLE / chars ELSE 0 END)) * CASE WHEN size < 50 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END) AS k
  FROM sized),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r
  FROM keyed GROUP BY source),
weighed AS (
  SELECT *, [5, 2, 1][(r % 3)::INT + 1] AS w, 2.0::DOUBLE * source_size AS cap FROM sources),
levelled AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - (sum(cap) OVER (ORDER BY cap / w, r) - cap))
            / (sum(w) OVER () - (sum(w) OVER (ORDER BY cap / w, r) - w)) AS level FROM weighed),
goals AS (
  SELECT source, source_size, CASE WHEN cap / w < level THEN cap
           ELSE w * (max(CASE WHEN cap / w >= level THEN level END) OVER ()) END AS target FROM levelled),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM goals),
ordered AS (
  SELECT d.doc_id, d.size, b.source_size, b.target, b.epochs, floor(b.target - b.epochs * b.source_size)::BIGINT AS budget,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size AS ahead
  FROM keyed d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, budget - ahead)))::BIGINT AS taken FROM ordered
"""

CHAT_FORMATTING = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (
  SELECT *, replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\t') AS er,
         replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\t') AS et FROM turns)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(4 + length(replace(er, ':', '\c')) + 2 + length(et) + 9)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

SOURCE_DIVERGENCE = rf"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{CAPITALS}', '{CAPITALS.lower()}'), '{TERM}') AS terms
  FROM documents),
kept AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM docs) GROUP BY ALL HAVING count(*) >= 10),
grid AS (SELECT s.lang, s.source, k.term FROM (SELECT DISTINCT lang, source FROM docs) s JOIN kept k ON s.lang = k.lang),
said AS (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(terms) AS term FROM docs) GROUP BY ALL),
counted AS (SELECT g.*, coalesce(s.n, 0)::HUGEINT AS n FROM grid g LEFT JOIN said s USING (lang, source, term)),
of_lang AS (SELECT lang, term, sum(n) AS n FROM counted GROUP BY ALL),
lang_sums AS (SELECT lang, sum(n) AS total, count(*) AS v FROM of_lang GROUP BY lang),
group_sums AS (SELECT lang, source, sum(n) AS total FROM counted GROUP BY ALL),
lang_p AS (
  SELECT o.lang, o.term, (1 + (1000000000::HUGEINT * (o.n + 2)) // (l.total + 2 * l.v))::HUGEINT AS q
  FROM of_lang o JOIN lang_sums l USING (lang)),
group_p AS (
  SELECT c.lang, c.source, c.term, c.n, (1 + (1000000000::HUGEINT * (c.n + 2)) // (g.total + 2 * l.v))::HUGEINT AS p
  FROM counted c JOIN group_sums g USING (lang, source) JOIN lang_sums l USING (lang)),
sources AS (SELECT DISTINCT lang, source FROM docs),
pair_values AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM group_p a JOIN group_p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(v.value, 0)::BIGINT AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair_values v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source),
terms AS (
  SELECT g.lang, g.source, 'term' AS part, g.term AS item, (((g.p - l.q) * (g.p - l.q)) // (g.p + l.q))::BIGINT AS value
  FROM group_p g JOIN lang_p l USING (lang, term) WHERE g.n > 0 AND g.p > l.q)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= 10
"""

EXACT_DEDUP = r"""
WITH rows AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
FROM rows WINDOW same AS (PARTITION BY norm)
"""


def _clustering(rounds: int = 5, k: int = 40) -> str:
    """Rounds of assignment and means, one after the other."""
    parts = [
        """vectors AS (
  SELECT row_number() OVER () AS row, vec_id, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        "parts AS (SELECT row, unnest(generate_series(1, 64)) AS d, unnest(v) AS x FROM vectors)",
        f"""first AS (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, v) - 1 AS c, v FROM vectors QUALIFY c < {k})""",
        "centroids0 AS (SELECT c, unnest(generate_series(1, 64)) AS d, unnest(v) AS y FROM first)",
    ]
    for i in range(rounds + 1):
        parts.append(f"""nearest{i} AS MATERIALIZED (
  SELECT row, c, distance FROM (
    SELECT row, c, sum((x - y) * (x - y)) AS distance FROM parts JOIN centroids{i} USING (d) GROUP BY row, c)
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, c) = 1)""")
        parts.append(f"""centroids{i + 1} AS MATERIALIZED (
  SELECT c, d, coalesce(mean, y)::BIGINT AS y FROM centroids{i} LEFT JOIN (
    SELECT c, d, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS mean
    FROM nearest{i} JOIN parts USING (row) GROUP BY c, d) USING (c, d))""")
    return (
        "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, c::INT AS cluster, distance::BIGINT AS distance, (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM nearest{rounds} JOIN vectors USING (row)
JOIN (SELECT c, sha256(string_agg(y::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM centroids{rounds} GROUP BY c) USING (c)
"""
    )


def oracle_sql() -> dict[str, str]:
    return {
        "op3_source_mixing": SOURCE_MIXING,
        "op4_chat_formatting": CHAT_FORMATTING,
        "op11_source_divergence": SOURCE_DIVERGENCE,
        "op12_exact_dedup": EXACT_DEDUP,
        "op13_centroid_clustering": _clustering(),
    }
