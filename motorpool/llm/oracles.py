"""DuckDB SQL with the results of the queries that SQL can express."""

_FILTER_AUDIT = r"""
WITH texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
    FROM documents
), firsts AS (
    SELECT t, min(doc_id) AS least FROM texts GROUP BY t
), marks AS (
    SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
    FROM labels GROUP BY doc_id
), told AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
        CASE WHEN len(words) < 100 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
        || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN coalesce(doc_id > least, false) THEN 'E' ELSE '' END AS failed
    FROM texts JOIN firsts USING (t) LEFT JOIN marks USING (doc_id)
), cells AS (
    SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
    FROM told GROUP BY ALL
), letters(l) AS (
    VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), orders AS (
    SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
    FROM letters a
    JOIN letters b ON b.l <> a.l
    JOIN letters c ON c.l NOT IN (a.l, b.l)
    JOIN letters d ON d.l NOT IN (a.l, b.l, c.l)
    JOIN letters e ON e.l NOT IN (a.l, b.l, c.l, d.l)
), steps AS (
    SELECT filter_order, step::INTEGER AS step, filter_order[step] AS letter,
        string_split(filter_order[1:step - 1], '') AS earlier
    FROM orders, range(1, 6) r(step)
), judged AS (
    SELECT part, filter_order, step, letter, n, good, toxic, failed = letter AS alone,
        contains(failed, letter) AS fails, list_has_any(string_split(failed, ''), earlier) AND step > 1 AND failed <> '' AS gone
    FROM cells, steps
), summed AS (
    SELECT part, filter_order, step, letter,
        coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (fails AND NOT gone), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (fails AND gone), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (alone), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (fails AND NOT gone), 0)::BIGINT AS good_lost,
        coalesce(sum(toxic) FILTER (fails AND NOT gone), 0)::BIGINT AS toxic_lost
    FROM judged GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    sum(removed) OVER (PARTITION BY part, letter)::BIGINT AS shapley
FROM summed
"""

_BLOCK_DEDUP = r"""
WITH texts AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
    FROM documents
), windows AS (
    SELECT doc_id, start, array_to_string(words[start:start + 12], ' ') AS passage
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS start FROM texts)
), firsts AS (
    SELECT passage, min(doc_id) AS least FROM windows GROUP BY passage
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(start, start + 13)) AS place
    FROM windows JOIN firsts USING (passage) WHERE doc_id > least
), placed AS (
    SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM texts
), left_over AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept, count(*) AS n
    FROM placed ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
    sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN left_over USING (doc_id)
"""

_DECONTAMINATION = r"""
WITH texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id, size, array_to_string(words[start:start + size - 1], ' ') AS passage
    FROM (SELECT item_id, words, least(len(words), 13) AS size, unnest(range(1, len(words) - least(len(words), 13) + 2)) AS start
          FROM items WHERE len(words) > 0)
), windows AS (
    SELECT doc_id, size, start, array_to_string(words[start:start + size - 1], ' ') AS passage
    FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS start
          FROM texts JOIN (SELECT DISTINCT size FROM item_windows) ON len(words) >= size)
), met AS (
    SELECT doc_id, start, size, item_id FROM windows JOIN item_windows USING (size, passage)
), hits AS (
    SELECT doc_id, count(DISTINCT place) AS n
    FROM (SELECT doc_id, unnest(range(start, start + size)) AS place FROM met) GROUP BY doc_id
), found AS (
    SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM met) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(hits.n, 0)::BIGINT AS n_hit, coalesce(found.n, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AND 20 * coalesce(hits.n, 0) >= len(words) AS contaminated
FROM texts LEFT JOIN hits USING (doc_id) LEFT JOIN found USING (doc_id)
"""

ORACLES = {
    "op5_block_dedup": _BLOCK_DEDUP,
    "op6_decontamination": _DECONTAMINATION,
    "op13_filter_audit": _FILTER_AUDIT,
}
