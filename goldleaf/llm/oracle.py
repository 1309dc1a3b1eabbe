"""DuckDB SQL of the operators that SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

NEIGHBOURS = """
WITH v AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), d AS (
    SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(range(1, len(q.e) + 1), lambda i: (q.e[i] - c.e[i]) * (q.e[i] - c.e[i])), lambda a, b: a + b)) AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
), r AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score FROM d
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

MIXING = f"""
WITH d AS (SELECT doc_id, source, len({WORDS}) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS weight, row_number() OVER (ORDER BY source IS NULL, source) AS nth FROM s),
o AS (
    SELECT *, source_size * 3 AS cap, source_size * 3 / weight AS level,
           sum(source_size * 3) OVER u::BIGINT AS used, sum(weight) OVER u::BIGINT AS heavy
    FROM w WINDOW u AS (ORDER BY source_size * 3 / weight, nth ROWS UNBOUNDED PRECEDING)
),
b AS (SELECT sum(source_size)::BIGINT AS budget, sum(weight)::BIGINT AS all_weights FROM w),
l AS (
    SELECT max((budget - used + cap) / (all_weights - heavy + weight)) AS top FROM o, b
    WHERE (budget - used + cap) / (all_weights - heavy + weight) <= level
),
t AS (SELECT source, source_size, weight, least(cap::DOUBLE, weight * coalesce(top, 0)) AS target FROM o, l),
e AS (
    SELECT d.*, source_size, weight, epoch, target - epoch * source_size AS lacking, md5(doc_id || ':' || epoch) AS k
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source, range(3) r(epoch) WHERE size > 0
),
q AS (SELECT *, CASE WHEN lacking > 0 AND lacking < source_size AND size * 50 > lacking THEN size ELSE 0 END AS late FROM e),
f AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY epoch, late, k ROWS UNBOUNDED PRECEDING)::BIGINT / weight AS finish FROM q),
p AS (SELECT *, sum(size) OVER (ORDER BY finish, source IS NULL, source, epoch, late, k ROWS UNBOUNDED PRECEDING)::BIGINT AS spent FROM f),
n AS (SELECT doc_id, count(*) AS copies FROM p, b WHERE 2 * spent - size <= 2 * budget GROUP BY doc_id)
SELECT d.doc_id, size::BIGINT AS size, source_size, target, coalesce(copies, 0) * size AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN n USING (doc_id)
"""

SUBSTRINGS = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
i AS (
    SELECT r, doc_id, i, array_to_string(w[i : i + 12], ' ') AS k
    FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE doc_id IS NOT NULL AND len(w) >= 13)
),
f AS (SELECT k, min(doc_id) AS first FROM i GROUP BY k),
g AS (SELECT DISTINCT r, i + j AS p FROM i JOIN f USING (k), range(13) x(j) WHERE first < doc_id),
p AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
k AS (
    SELECT p.r, count(g.p) AS gone, string_agg(word, ' ' ORDER BY p.p) FILTER (g.p IS NULL) AS kept
    FROM p LEFT JOIN g ON p.r = g.r AND p.p = g.p GROUP BY p.r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""

QUALITY = f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t, {WORDS} AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
    FROM documents
),
i AS (
    SELECT r, i, array_to_string(w[i : i + 7], ' ') AS k
    FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)
),
twice AS (SELECT r, k FROM i GROUP BY r, k HAVING count(*) > 1),
c AS (SELECT r, count(DISTINCT i + j) AS n FROM i JOIN twice USING (r, k), range(8) x(j) GROUP BY r),
m AS (
    SELECT doc_id, source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
           len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines) AS n_lines,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
    FROM d LEFT JOIN c USING (r)
),
j AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
           coalesce(greatest(
               100 * n_symbols / nullif(30 * n_words, 0), 50 * n_dup_lines / nullif(50 * (n_lines - n_dup_lines), 0),
               word_chars / nullif(20 * n_words, 0), 2 * n_words / nullif(word_chars, 0)
           ), 0) AS beyond,
           beyond > 1 AS soft
    FROM m
),
h AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed OR soft) AS f FROM j GROUP BY source),
a AS (
    SELECT sum(f) / sum(n) AS mean,
           (sum(f * (f / n)) - sum(n) * (sum(f) / sum(n)) * (sum(f) / sum(n)) - (count(*) - 1) * (sum(f) / sum(n)) * (1 - sum(f) / sum(n)))
           / nullif(sum(n) - sum(n::DOUBLE * n) / sum(n), 0) AS spread
    FROM h
),
s AS (SELECT mean, least(greatest(CASE WHEN spread > 0 THEN mean * (1 - mean) / spread - 1 ELSE 1000 END, 2), 1000) AS strength FROM a),
v AS (SELECT source, (f + mean * strength) / (n + strength) AS rate FROM h, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT (soft AND beyond * rate > 1 - rate) AS kept
FROM j JOIN v ON j.source IS NOT DISTINCT FROM v.source
"""

EXACT = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, row_number() OVER (PARTITION BY t ORDER BY doc_id, r) = 1 AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)
"""


def _rounds(n: int) -> str:
    """Assignments and means, round by round."""
    steps = []
    for i in range(n + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
    SELECT r, vec_id, v, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
        SELECT r, vec_id, v, c, list_sum(list_transform(range(1, 65), lambda i: (v[i] - m[i]) * (v[i] - m[i])))::BIGINT AS d FROM k, c{i}
    ) GROUP BY r, vec_id, v
)""")
        if i < n:
            steps.append(f"""s{i} AS (
    SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(range(1, 65)) AS i, unnest(v) AS x FROM a{i}) GROUP BY c, i
), m{i} AS (SELECT c, list(((s - ((s % n) + n) % n) / n)::BIGINT ORDER BY i) AS m FROM (SELECT c, i, s, n::HUGEINT AS n FROM s{i}) GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT c, coalesce(m{i}.m, c{i}.m) AS m FROM c{i} LEFT JOIN m{i} USING (c))""")
    return ",\n".join(steps)


CENTROIDS = f"""
WITH k AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS m
    FROM (SELECT sha256('3:' || vec_id) AS h, v FROM k WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT 8)
),
{_rounds(10)}
SELECT vec_id, a10.c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a10.c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a10 JOIN c10 USING (c)
"""

DIVERGENCE = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
),
g AS (SELECT DISTINCT lang, source FROM d),
o AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM o SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
t AS (SELECT lang, source, sum(n)::HUGEINT AS n FROM c GROUP BY lang, source),
p AS MATERIALIZED (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           1 + (1000000000 * (coalesce(c.n, 0) + 5) - (1000000000 * (coalesce(c.n, 0) + 5)) % (coalesce(t.n, 0) + 5 * v.v)) / (coalesce(t.n, 0) + 5 * v.v) AS p,
           1 + (1000000000 * (k.n + 5)::HUGEINT - (1000000000 * (k.n + 5)::HUGEINT) % (v.n + 5 * v.v)) / (v.n + 5 * v.v) AS q
    FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term) LEFT JOIN t USING (lang, source)
),
i AS MATERIALIZED (SELECT lang, source, term, n, p::BIGINT AS p, q::BIGINT AS q FROM p),
a AS (
    SELECT x.lang, x.source, 'pair' AS part, y.source AS item, sum(abs(x.p - y.p))::BIGINT AS value
    FROM i x JOIN i y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY x.lang, x.source, y.source
),
b AS (
    SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(value, 0) AS value
    FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN a ON a.lang = x.lang AND a.source = x.source AND a.item = y.source
    UNION ALL SELECT lang, source, 'term', term, p - q FROM i WHERE n > 0 AND p > q
),
f AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM b)
SELECT * FROM f WHERE part = 'pair' OR rank <= 50
"""

ORACLE: dict[str, str] = {
    "op1_neighbours": NEIGHBOURS,
    "op2_substrings": SUBSTRINGS,
    "op5_mixing": MIXING,
    "op9_quality": QUALITY,
    "op11_exactdups": EXACT,
    "op12_centroids": CENTROIDS,
    "op13_divergence": DIVERGENCE,
}
