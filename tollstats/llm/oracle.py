"""The queries that SQL can express, for a second engine."""

from __future__ import annotations

OP2 = r"""
WITH clean AS (
  SELECT conv_id, coalesce(turn, 9223372036854775807) AS turn,
         replace(coalesce(role, 'unknown'), '<|', '< |') AS speaker,
         replace(coalesce(text, ''), '<|', '< |') AS body
  FROM conversations),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM clean WHERE speaker <> 'system'),
rotated AS (
  SELECT c.*, p.perspective, turn // 64 AS part_turn,
         '<|im_start|>' || CASE WHEN speaker = 'system' THEN 'system'
                                WHEN speaker = perspective THEN 'assistant'
                                ELSE 'user name=' || translate(speaker, chr(13) || chr(10), '  ') END || chr(10) AS head,
         body || '<|im_end|>' || chr(10) AS tail
  FROM clean c LEFT JOIN people p ON c.conv_id IS NOT DISTINCT FROM p.conv_id),
placed AS (
  SELECT *, length(head) + coalesce(sum(length(head) + length(tail)) OVER (
              PARTITION BY conv_id, perspective, part_turn ORDER BY turn, speaker, body
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS opens,
         dense_rank() OVER (PARTITION BY conv_id, perspective ORDER BY part_turn) - 1 AS part
  FROM rotated)
SELECT conv_id, perspective, part, count(*) AS n_turns,
       string_agg(head || tail, '' ORDER BY turn, speaker, body) AS text,
       coalesce(string_agg(cast(opens AS bigint) || '-' || cast(opens + length(tail) - 1 AS bigint), ',' ORDER BY opens)
                FILTER (WHERE speaker = perspective), '') AS trained,
       cast(coalesce(sum(length(tail) - 1) FILTER (WHERE speaker = perspective), 0) AS bigint) AS trained_chars
FROM placed GROUP BY conv_id, perspective, part
"""

# Words by the same pattern; the order of draw is 60 bits of the same MD5.
OP9 = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         ('0x' || substr(md5('1234:' || coalesce(cast(doc_id AS varchar), '<null>')), 1, 15))::bigint AS draw
  FROM documents),
sizes AS (
  SELECT source, cast(sum(size) AS bigint) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM sized GROUP BY source),
ranked AS (
  SELECT *, [3.0, 1.0, 2.0][cast((place - 1) % 3 + 1 AS int)]::double AS weight,
         source_size * 2.0::double AS lim
  FROM sizes),
leveled AS (
  SELECT *, ((SELECT sum(source_size) FROM ranked) * 1.5::double
             - coalesce(sum(lim) OVER (ORDER BY lim / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY lim / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
  FROM ranked),
targets AS (
  SELECT source, source_size,
         least(lim, coalesce((SELECT arg_min(lev, (lim / weight, place)) FROM leveled WHERE lev * weight <= lim) * weight, lim)) AS target
  FROM leveled),
planned AS (
  SELECT *, CASE WHEN source_size > 0 THEN cast(floor(target / source_size) AS bigint) ELSE 0 END AS whole FROM targets),
drawn AS (
  SELECT doc_id, size, source_size, target, whole,
         cast(round(target - whole * source_size) AS bigint) AS extra,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY draw, doc_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, cast(size AS bigint) AS size, source_size, target,
       cast(whole * size + least(size, greatest(0, extra - before)) AS bigint) AS taken
FROM drawn
"""

# Components as whole numbers; their products are exact in double precision.
_WHOLE = """
  SELECT vec_id, {label} AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS whole
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

OP12 = f"""
WITH rows AS ({_WHOLE.format(label="label")}),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.whole, b.whole) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5
"""

OP13 = f"""
WITH rows AS ({_WHOLE.format(label="CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")}),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_inner_product(a.whole, b.whole) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0 AND a.label IS NOT NULL AND b.label IS NOT NULL),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
    FROM scored WHERE same) p
  WHERE place <= 5),
negatives AS (
  SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS place
  FROM positives JOIN scored USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE place <= 10
"""

ORACLE: dict[str, str] = {"op2_perspectives": OP2, "op9_mixing": OP9, "op12_topk": OP12, "op13_negatives": OP13}
