"""The same results as `queries` in SQL that DuckDB runs, where SQL can express them."""

from __future__ import annotations

from plumbrule.llm.mixing import STEP

WORD = r"[^\x20\x09-\x0D]+"

# The targets as the fixed point of capping and sharing again: sources by growing limit / weight, of which the first k
# are capped for the smallest k that leaves the next one at or below its limit. Taken: the shuffled order read round and round.
MIX = rf"""
WITH sizes AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size FROM documents
), totals AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source
), numbered AS (
    SELECT *, row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1 AS no FROM totals
), weighted AS (
    SELECT *, CASE no % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, (2 * source_size)::DOUBLE AS most FROM numbered
), capped AS (
    SELECT *,
           row_number() OVER by_ratio AS k,
           coalesce(sum(most) OVER (by_ratio ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped_sum,
           sum(weight) OVER (by_ratio ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left,
           sum(source_size) OVER () AS whole
    FROM weighted WINDOW by_ratio AS (ORDER BY most / weight, no)
), levels AS (
    SELECT *, (1.5::DOUBLE * whole - capped_sum) / weight_left AS level FROM capped
), chosen AS (
    SELECT arg_min(level, k) AS level, min(k) AS k FROM levels WHERE weight * level <= most
), targets AS (
    SELECT l.source, l.source_size, CASE WHEN l.k < c.k THEN l.most ELSE l.weight * c.level END AS target
    FROM levels l, chosen c
), placed AS (
    SELECT s.doc_id, s.size, s.source, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS quota,
           sum(s.size) OVER (
               PARTITION BY s.source
               ORDER BY ('0x' || substr(md5(coalesce(s.doc_id::VARCHAR, '') || ':mix'), 1, 15))::BIGINT, s.doc_id, s.size
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size AS start
    FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), needs AS (
    SELECT t.source, n.no, t.source_size, floor(t.target + 0.5)::BIGINT AS quota, ceil(t.source_size / 4096.0)::BIGINT AS blocks,
           CASE WHEN t.source_size > 0 THEN floor(t.target + 0.5)::BIGINT // t.source_size ELSE 0 END AS passes
    FROM targets t JOIN numbered n ON t.source IS NOT DISTINCT FROM n.source
), needed AS (
    SELECT *, (passes * blocks + ceil((quota - passes * source_size) / 4096.0))::BIGINT AS needed FROM needs
), edges AS (
    SELECT *, sum(needed) OVER () AS total,
           (sum(needed) OVER (ORDER BY no) - needed)::HUGEINT * 1099511627776 // greatest(sum(needed) OVER (), 1) AS lo,
           (sum(needed) OVER (ORDER BY no))::HUGEINT * 1099511627776 // greatest(sum(needed) OVER (), 1) AS hi
    FROM needed
), points AS (
    SELECT slot, (slot::HUGEINT * {STEP}) % 1099511627776 AS point FROM range((SELECT 2 * max(total) + 256 FROM edges)::BIGINT) AS r(slot)
), ranked AS (
    SELECT slot, source, source_size, quota, blocks, needed, row_number() OVER (PARTITION BY no ORDER BY slot) - 1 AS rank
    FROM points JOIN edges ON point >= lo AND point < hi
), slots AS (
    SELECT slot, source, rank % blocks AS block,
           least(4096, source_size - rank % blocks * 4096, quota - (rank // blocks * source_size + rank % blocks * 4096)) AS length
    FROM ranked WHERE rank < needed
), reads AS (
    SELECT p.doc_id, p.source, p.start, p.size, min(slot)::BIGINT AS first_slot, max(slot)::BIGINT AS last_slot
    FROM placed p JOIN slots s ON p.source IS NOT DISTINCT FROM s.source AND p.size > 0
         AND least(p.start + p.size, block * 4096 + length) > greatest(p.start, block * 4096)
    GROUP BY ALL
)
SELECT p.doc_id, p.size, source_size, target,
       (greatest(0, least(p.start + p.size, quota) - p.start)
        + greatest(0, least(p.start + p.size, quota - source_size) - p.start))::BIGINT AS taken,
       p.source, first_slot, last_slot
FROM placed p LEFT JOIN reads r
     ON p.doc_id IS NOT DISTINCT FROM r.doc_id AND p.source IS NOT DISTINCT FROM r.source AND p.start = r.start AND p.size = r.size
"""

# crc32 by its table of 256, itself made by the rule; rendezvous draws as in the operator.
SHARD = """
WITH crc_table AS (
    SELECT list(c ORDER BY n) AS t FROM (
        SELECT n, list_reduce([n::UBIGINT] || list_transform(range(8), lambda b: 0::UBIGINT),
                              lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS c
        FROM range(256) AS r(n))
), sized AS (
    SELECT doc_id, coalesce(text, '') AS text, (octet_length(encode(coalesce(text, ''))) + 1)::BIGINT AS size,
           coalesce(doc_id::VARCHAR, 'null') AS key
    FROM documents
), summed AS (
    SELECT doc_id, size, key,
           xor(list_reduce([4294967295::UBIGINT]
                           || list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::UBIGINT),
                           lambda c, b: xor(c >> 8, t[((xor(c, b) & 255) + 1)::BIGINT])), 4294967295::UBIGINT)::BIGINT AS text_crc32
    FROM sized, crc_table
), draws AS (
    SELECT *, list_transform(range(17), lambda s:
           -ln((('0x' || substr(md5(key || ':' || s::VARCHAR), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE)) AS d
    FROM summed
), best AS (
    SELECT *, list_position(d[:16], list_min(d[:16])) - 1 AS shard FROM draws
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INTEGER AS shard,
       (row_number() OVER (PARTITION BY shard
           ORDER BY ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':slot'), 1, 15))::BIGINT, doc_id, size, text_crc32) - 1)::BIGINT AS slot,
       (CASE WHEN d[17] < d[shard + 1] THEN 16 ELSE shard END)::INTEGER AS grown_shard
FROM best
"""

# All pairs, and the smallest id reached over links, round by round.
NEAR_VECTORS = """
WITH RECURSIVE doubles AS (
    SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
), usable AS (
    SELECT vec_id, v FROM doubles
    WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9
), reached AS (
    SELECT vec_id, vec_id AS other FROM embeddings
    UNION
    SELECT r.vec_id, l.b FROM reached r JOIN links l ON r.other = l.a
), least AS (
    SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id
)
SELECT l.vec_id, (SELECT count(*) FROM links k WHERE k.a = l.vec_id)::BIGINT AS n_links, l.component_id, l.vec_id = l.component_id AS kept
FROM least l
"""

# Every anchor's integer products with all rows.
HARD_NEGATIVES = """
WITH doubles AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
), usable AS (
    SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END) AS label, list_transform(v, lambda x: floor(256 * x)) AS x
    FROM doubles WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same, list_dot_product(a.x, r.x)::BIGINT AS score
    FROM usable a JOIN usable r ON r.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id, (row_number() OVER best)::INTEGER AS rank, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
WINDOW best AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id)
QUALIFY rank <= 5
"""

ORACLES: dict[str, str] = {
    "op3_mix_sources": MIX,
    "op10_shard": SHARD,
    "op12_near_vectors": NEAR_VECTORS,
    "op13_hard_negatives": HARD_NEGATIVES,
}
