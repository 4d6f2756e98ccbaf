"""The queries that SQL can express, written for another engine; all constants are repeated on purpose."""

OP7_QUALITY_RULES = r"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), cut AS (
    SELECT rid, doc_id, t,
           regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines,
           regexp_extract_all(lower(translate(t, '.,;:', '')), '[^\x20\x09-\x0D]+') AS plain
    FROM docs
), windows AS (
    SELECT rid, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
    FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM cut WHERE len(words) >= 3)
), twice AS (
    SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, a, b, c) > 1
), covered AS (
    SELECT rid, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS steps(k) GROUP BY rid
), measured AS (
    SELECT cut.rid, doc_id,
           len(words) AS n_words,
           length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
           length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           coalesce(covered.n, 0) AS n_repeat_words,
           length(t) - length(replace(t, '!', '')) AS n_exclaims,
           len(lines) AS n_lines,
           len(list_filter(plain, lambda w: w IN (
               'the', 'of', 'and', 'to', 'in', 'is', 'that', 'for', 'it', 'was', 'on', 'are', 'as', 'with', 'be',
               'der', 'die', 'und', 'den', 'von', 'das', 'mit', 'sich', 'des', 'auf', 'ist', 'im', 'dem', 'nicht', 'ein',
               'de', 'la', 'le', 'et', 'les', 'est', 'un', 'une', 'du', 'dans', 'qui', 'que', 'pour', 'pas',
               'el', 'en', 'y', 'los', 'se', 'del', 'las', 'por', 'con', 'no', 'su', 'para', 'al', 'lo', 'como'
           ))) AS n_stop_words
    FROM cut LEFT JOIN covered USING (rid)
), judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed
       AND word_chars / n_words BETWEEN 2 AND 14
       AND n_symbols / n_words <= 0.3
       AND n_exclaims / n_words <= 0.5
       AND n_stop_words / n_words >= 0.02
       AND n_dup_lines / n_lines <= 0.5 AS kept
FROM judged
"""

OP8_SOURCE_MIXING = r"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id, source,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
           md5(coalesce(doc_id::VARCHAR, '') || ' ' || md5(coalesce(text, ''))) AS shuffled
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source
), placed AS (
    SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS place FROM sources
), weighted AS (
    SELECT *, CASE place % 3 WHEN 1 THEN 5 WHEN 2 THEN 2 ELSE 1 END AS weight, 3 * source_size AS most FROM placed
), levels AS (
    SELECT *, most / weight AS brim,
           ((SELECT sum(source_size) FROM sources)
            - coalesce(sum(most) OVER (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
           / (sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
    FROM weighted
), water AS (
    SELECT level FROM levels WHERE level <= brim ORDER BY brim, place LIMIT 1
), targets AS (
    SELECT source, source_size, place, least(most::DOUBLE, (SELECT level FROM water) * weight) AS target FROM levels
), queued AS (
    SELECT d.*, source_size, place, target,
           sum(size) OVER (PARTITION BY place ORDER BY shuffled, doc_id, size ROWS UNBOUNDED PRECEDING) AS sent
    FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), copies AS (
    SELECT *, (copy * source_size + sent)::DOUBLE / target AS finish
    FROM queued, (VALUES (0), (1), (2)) AS repeats(copy) WHERE size > 0
), sent AS (
    SELECT rid, count(*) AS n FROM (
        SELECT rid, sum(size) OVER (ORDER BY finish, place, copy, shuffled, size ROWS UNBOUNDED PRECEDING) AS upto FROM copies
    ) WHERE upto <= (SELECT sum(source_size) FROM sources) GROUP BY rid
)
SELECT doc_id, size, source_size, target, (size * coalesce(sent.n, 0))::BIGINT AS taken
FROM queued LEFT JOIN sent USING (rid)
"""

OP11_FILTER_AUDIT = r"""
WITH docs AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), good AS (
    SELECT DISTINCT doc_id FROM labels WHERE quality = 1
), bad AS (
    SELECT DISTINCT doc_id FROM labels WHERE toxic = 1
), marked AS (
    SELECT part,
           len(words) < 200 AS a,
           100 * len(list_distinct(words)) < 50 * len(words) AS b,
           100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) AS c,
           regexp_matches(t, '[#$%&*|]') AS d,
           coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e,
           doc_id IN (FROM good) AS is_good,
           doc_id IN (FROM bad) AS is_toxic
    FROM docs
), cells AS (
    SELECT part, [a, b, c, d, e] AS fails, count(*) AS n,
           count(*) FILTER (is_good) AS good, count(*) FILTER (is_toxic) AS toxic
    FROM marked GROUP BY ALL
), filters AS (
    SELECT unnest(range(1, 6)) AS f
), orders AS (
    SELECT [p.f, q.f, r.f, s.f, t.f] AS perm
    FROM filters p, filters q, filters r, filters s, filters t
    WHERE len(list_distinct([p.f, q.f, r.f, s.f, t.f])) = 5
), steps AS (
    SELECT perm, unnest(range(1, 6)) AS step FROM orders
), seen AS (
    SELECT part, perm, step, perm[step] AS own, n, good, toxic, fails[perm[step]] AS fails_own,
           len(list_filter(perm[1 : step - 1], lambda f: fails[f])) > 0 AS gone,
           len(list_filter(fails, lambda x: x)) AS n_fails
    FROM cells, steps
), summed AS (
    SELECT part, perm, step, own,
           coalesce(sum(n) FILTER (NOT gone AND NOT fails_own), 0) AS kept,
           coalesce(sum(n) FILTER (NOT gone AND fails_own), 0) AS removed,
           coalesce(sum(n) FILTER (gone AND fails_own), 0) AS redundant,
           coalesce(sum(n) FILTER (fails_own AND n_fails = 1), 0) AS unique_fails,
           coalesce(sum(good) FILTER (NOT gone AND fails_own), 0) AS good_lost,
           coalesce(sum(toxic) FILTER (NOT gone AND fails_own), 0) AS toxic_lost
    FROM seen GROUP BY ALL
)
SELECT part, array_to_string(list_transform(perm, lambda f: chr(64 + f::INTEGER)), '') AS filter_order, step::INTEGER AS step,
       kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM summed
"""

OP12_DECONTAMINATION = r"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), items AS (
    SELECT coalesce(item_id::VARCHAR, '') AS item,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), windows AS (
    SELECT DISTINCT item, len(w) AS n, array_to_string(w, ' ') AS gram
    FROM (SELECT item, words[i : i + 9] AS w
          FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM items WHERE len(words) > 0))
), sizes AS (
    SELECT DISTINCT n FROM windows
), grams AS (
    SELECT rid, n, i, array_to_string(words[i : i + n - 1], ' ') AS gram
    FROM (SELECT rid, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM docs, sizes)
), found AS (
    SELECT rid, i, n, item FROM grams JOIN windows USING (n, gram)
), hit AS (
    SELECT rid, count(DISTINCT k) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS k FROM found) GROUP BY rid
), held AS (
    SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT rid, item FROM found) GROUP BY rid
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (rid) LEFT JOIN held USING (rid)
"""

OP13_HARD_NEGATIVES = r"""
WITH valid AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, list_inner_product(a.q, b.q)::BIGINT AS score
    FROM valid a JOIN valid b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
    WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), negatives AS (
    SELECT anchor_id, vec_id AS negative_id, score AS negative_score FROM scored WHERE NOT alike
)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id))::INTEGER AS rank,
       negative_id, positive_score, negative_score
FROM positives JOIN negatives USING (anchor_id)
WHERE 50 * positive_score <= 100 * negative_score AND 100 * negative_score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id) <= 3
"""

TWINS = {
    "op7_quality_rules": OP7_QUALITY_RULES,
    "op8_source_mixing": OP8_SOURCE_MIXING,
    "op11_filter_audit": OP11_FILTER_AUDIT,
    "op12_wu_manber_decontamination": OP12_DECONTAMINATION,
    "op13_bond_hard_negatives": OP13_HARD_NEGATIVES,
}
