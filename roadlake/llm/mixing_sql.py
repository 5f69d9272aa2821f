"""DuckDB SQL for op8: the same apportionment, written independently as set operations."""

OP8 = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS place FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
s1 AS (SELECT *, [1, 2, 3][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight,
              (sum(source_size) OVER ())::BIGINT AS total FROM s0),
s2 AS (SELECT *, (total - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS rest,
              (sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS shares FROM s1),
s3 AS (SELECT *, 3 * source_size * shares < rest * weight AS is_full FROM s2),
s4 AS (SELECT source, source_size, total,
              CASE WHEN is_full THEN (3 * source_size)::DOUBLE
                   ELSE (max(CASE WHEN NOT is_full THEN rest / shares END) OVER ()) * weight END AS target FROM s3),
seats AS (SELECT source, target, unnest(range(1, (floor(2 * target / 128) + 4)::BIGINT)) AS k FROM s4),
picked AS (SELECT source FROM seats WHERE target > 0
           QUALIFY row_number() OVER (ORDER BY target / (2 * k - 1) DESC, source NULLS LAST, k)
                   <= (SELECT floor(max(total) / 128 + 0.5) FROM s4)),
blocks AS (SELECT source, count(*) AS blocks FROM picked GROUP BY source),
placed AS (SELECT sized.*, ('0x' || substr(place, 1, 8))::BIGINT
                           % greatest(ceil(sqrt(source_size::DOUBLE) / 16), 1)::BIGINT AS shard
           FROM sized JOIN s0 ON sized.source IS NOT DISTINCT FROM s0.source),
cells AS (SELECT p.source, shard, sum(size)::BIGINT AS cell, any_value(b.blocks) AS blocks,
                 any_value(s4.source_size) AS source_size, any_value(s4.target) AS target
          FROM placed p JOIN s4 ON p.source IS NOT DISTINCT FROM s4.source
          LEFT JOIN blocks b ON p.source IS NOT DISTINCT FROM b.source GROUP BY p.source, shard),
cell_seats AS (SELECT source, shard, cell, blocks,
                      unnest(range(1, (floor(2 * cell * coalesce(blocks, 0) / greatest(source_size, 1)) + 4)::BIGINT)) AS k
               FROM cells WHERE cell > 0),
cell_picked AS (SELECT source, shard FROM cell_seats
                QUALIFY row_number() OVER (PARTITION BY source ORDER BY cell / (2 * k - 1) DESC, shard, k) <= coalesce(blocks, 0)),
seated AS (SELECT source, shard, count(*) AS n FROM cell_picked GROUP BY source, shard),
whole AS (SELECT c.source, c.shard, c.cell, c.target, coalesce(n, 0) AS n, least(coalesce(n, 0) * 128, 3 * c.cell)::BIGINT AS words
          FROM cells c LEFT JOIN seated q ON c.source IS NOT DISTINCT FROM q.source AND c.shard = q.shard),
-- Words that blocks leave over or take too much, shard by shard in the order of their next quotients.
rest AS (SELECT *, floor(target + 0.5)::BIGINT - sum(words) OVER (PARTITION BY source) AS over_all,
                coalesce(sum(3 * cell - words) OVER nxt, 0) AS room_before, coalesce(sum(words) OVER nxt, 0) AS words_before
         FROM whole WINDOW nxt AS (PARTITION BY source ORDER BY cell / (2 * n + 1) DESC, shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
plan AS (SELECT source, shard, greatest(cell, 1) AS cell, (words + CASE WHEN over_all >= 0
                THEN greatest(0, least(3 * cell - words, over_all - room_before))
                ELSE -greatest(0, least(words, -over_all - words_before)) END)::BIGINT AS quota FROM rest),
run AS (SELECT p.doc_id, p.size, p.source, cell, quota,
               sum(p.size) OVER (PARTITION BY p.source, p.shard ORDER BY p.place, p.doc_id, p.size
                                 ROWS UNBOUNDED PRECEDING) - p.size AS before
        FROM placed p JOIN plan ON p.source IS NOT DISTINCT FROM plan.source AND p.shard = plan.shard)
SELECT r.doc_id, r.size, s4.source_size, s4.target,
       (r.size * (quota // cell) + greatest(0, least(r.size, quota % cell - before)))::BIGINT AS taken
FROM run r JOIN s4 ON r.source IS NOT DISTINCT FROM s4.source
"""
