"""DuckDB SQL for those numbered queries that it can express."""

from __future__ import annotations

from hearthline.llm.sharding import SHARDS, SLOTS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACE = r"[^\x20\x09-\x0D]+"

_NEAR = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_SPACE}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < @ THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + @ - 1], ' ') END AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - @ + 2, 2))) AS i FROM w WHERE len(w) > 0) x),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM met JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
edge AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, edge.b FROM reach JOIN edge ON edge.a = reach.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a),
h AS (SELECT doc_id, list_sort(list(g)) AS gs FROM s GROUP BY doc_id), same AS (SELECT gs, min(doc_id) AS set_id FROM h GROUP BY gs)
SELECT c.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, c.doc_id = component_id AS kept, coalesce(same.set_id, c.doc_id) AS set_id
FROM c LEFT JOIN n ON n.doc_id = c.doc_id LEFT JOIN h ON h.doc_id = c.doc_id LEFT JOIN same ON same.gs = h.gs"""

#: Components of documents whose sets of so many words' shingles have a similarity of 0.85.
NEAR, JOIN = _NEAR.replace("@", "5"), _NEAR.replace("@", "4")

MIX = f"""WITH RECURSIVE d AS (SELECT doc_id, source, text, CAST(coalesce(len(regexp_extract_all(text, '{_SPACE}')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS words, row_number() OVER (ORDER BY source NULLS LAST) AS k FROM d GROUP BY source),
r AS (SELECT source, words, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(k - 1) % 3 + 1] AS w, 2.0::DOUBLE * words AS cap, k FROM s),
o AS (SELECT *, coalesce(sum(cap) OVER b, 0) AS capped, sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS rest, 1.5::DOUBLE * (SELECT sum(words) FROM s) AS total FROM r WINDOW b AS (ORDER BY cap / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lv AS (SELECT first((total - capped) / rest ORDER BY cap / w, k) AS level FROM o WHERE (total - capped) / rest <= cap / w),
t AS (SELECT source, words, coalesce(least(cap, w * level), cap) AS target FROM o, lv),
j AS (SELECT d.doc_id, d.text, d.size, t.words, t.target, d.source, length(bin(d.size)) AS w, CASE WHEN t.words > 0 THEN target / words ELSE 0 END AS e,
 (('0x' || substr(md5(concat('17:', coalesce(CAST(doc_id AS VARCHAR), 'null'), ':', coalesce(text, ''))), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656 AS u FROM d JOIN t ON t.source IS NOT DISTINCT FROM d.source),
x AS (SELECT *, floor(e + 1e-12) AS certain, greatest(0, target - floor(e + 1e-12) * words) AS room FROM j),
cl AS (SELECT source, w, room, sum(size)::BIGINT AS n FROM x GROUP BY source, w, room),
cx AS (SELECT *, coalesce(sum(n) OVER b, 0)::BIGINT AS capped, (sum(n * w) OVER (PARTITION BY source) - coalesce(sum(n * w) OVER b, 0))::BIGINT AS shares FROM cl
 WINDOW b AS (PARTITION BY source ORDER BY w DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
cv AS (SELECT source, first(level ORDER BY w DESC) AS level FROM (SELECT *, CASE WHEN shares > 0 THEN (room - capped) / shares END AS level FROM cx) z WHERE level * w <= 1 GROUP BY source),
q AS (SELECT x.*, CASE WHEN room > 0 THEN least(1, coalesce(level * w, 1)) ELSE 0 END AS p FROM x LEFT JOIN cv ON cv.source IS NOT DISTINCT FROM x.source),
rk AS (SELECT *, CASE WHEN p >= 1 THEN -1 ELSE (u / (1 - u)) / (p / (1 - p)) END AS rank FROM q),
y AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source, p > 0 ORDER BY rank, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM rk),
z AS (SELECT *, CASE WHEN p <= 0 THEN 0 WHEN p >= 1 OR before + size <= room THEN 1 ELSE 0 END AS extra, row_number() OVER () AS n FROM y),
lack AS (SELECT source, max(room) - sum(extra * size) AS lack, max(target) / 100 AS close FROM z WHERE p > 0 GROUP BY source),
fit AS (SELECT z.n, z.source, z.size, row_number() OVER (PARTITION BY z.source ORDER BY z.rank, z.doc_id, z.size) AS k FROM z JOIN lack ON lack.source IS NOT DISTINCT FROM z.source WHERE lack > close AND p > 0 AND p < 1 AND extra = 0 AND size > 0),
go AS (SELECT source, 0::BIGINT AS k, NULL::BIGINT AS n, lack, close FROM lack WHERE lack > close UNION ALL
 SELECT go.source, fit.k, CASE WHEN size <= lack AND lack > close THEN fit.n END, lack - CASE WHEN size <= lack AND lack > close THEN size ELSE 0 END, close FROM go JOIN fit ON fit.source IS NOT DISTINCT FROM go.source AND fit.k = go.k + 1),
still AS (SELECT source, min(lack) AS lack FROM go GROUP BY source HAVING min(lack) > min(close)),
beyond AS (SELECT first(fit.n ORDER BY fit.k) AS n FROM fit JOIN still ON still.source IS NOT DISTINCT FROM fit.source WHERE fit.size < 2 * still.lack AND fit.n NOT IN (SELECT n FROM go WHERE n IS NOT NULL) GROUP BY fit.source),
f AS (SELECT z.*, certain + extra + (z.n IN (SELECT n FROM go WHERE n IS NOT NULL UNION ALL SELECT n FROM beyond))::BIGINT AS c FROM z)
SELECT doc_id, size, words AS source_size, target, CAST(c * size AS BIGINT) AS taken, CAST(c AS BIGINT) AS copies, p AS chance FROM f"""

_NAMES = ", ".join(f"({k}, '{x}')" for k, x in enumerate(sorted(SHARDS)))
_HASH = "('0x' || substr(md5({}), 1, 8))::BIGINT"
SHARDING = f"""WITH RECURSIVE sh AS (SELECT k, x, {_HASH.format("concat('offset:', x)")} % {SLOTS} AS off, {_HASH.format("concat('step:', x)")} % {SLOTS - 1} + 1 AS step FROM (VALUES {_NAMES}) v(k, x)),
fill AS (SELECT 0 AS t, [CAST(NULL AS INT) FOR i IN range({SLOTS})] AS own UNION ALL
 SELECT t + 1, list_transform(range({SLOTS}), lambda i: CASE WHEN i = slot THEN t % {len(SHARDS)} ELSE own[i + 1] END) FROM
  (SELECT t, own, (off + step * list_min(list_filter(range({SLOTS}), lambda j: own[(off + j * step) % {SLOTS} + 1] IS NULL))) % {SLOTS} AS slot FROM fill JOIN sh ON sh.k = t % {len(SHARDS)} WHERE t < {SLOTS}) s),
tab AS (SELECT unnest(range({SLOTS})) AS slot, unnest(own) AS k FROM fill WHERE t = {SLOTS}),
d AS (SELECT doc_id, source, {_HASH.format("coalesce(CAST(doc_id AS VARCHAR), 'null')")} % {SLOTS} AS slot FROM documents)
SELECT d.doc_id, d.source, d.slot, sh.x AS shard FROM d JOIN tab USING (slot) JOIN sh ON sh.k = tab.k"""


NEGATIVES = """WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
 FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5"""


def oracle_sql() -> dict[str, str]:
    return {"op1_bottom_k_near_dedup": NEAR, "op2_pareto_mix": MIX, "op7_permutation_shards": SHARDING, "op12_parity_sketch_join": JOIN, "op13_hilbert_hard_negatives": NEGATIVES}
