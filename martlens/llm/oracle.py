"""DuckDB SQL of the queries that SQL can express, by brute force over the whole tables."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# links: a, b with a <> b, both ways; reach: the transitive closure, small because links are
_REACH = """reach(a, b) AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)"""

OP2 = f"""
WITH RECURSIVE valid AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM valid x JOIN valid y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
    WHERE list_inner_product(x.v, y.v)
          >= 0.9 * sqrt(list_inner_product(x.v, x.v)) * sqrt(list_inner_product(y.v, y.v))),
{_REACH},
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
many AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, least(e.vec_id, coalesce(low.b, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(low.b, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN many ON many.a = e.vec_id LEFT JOIN low ON low.a = e.vec_id
"""

OP7 = f"""
WITH RECURSIVE worded AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sets AS (
    SELECT doc_id, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
                                                          lambda i: array_to_string(w[i:i + 4], ' ')))) AS g
    FROM worded WHERE len(w) > 0),
grams AS (SELECT doc_id, len(g) AS n, unnest(g) AS gram FROM sets),
links AS (
    SELECT x.doc_id AS a, y.doc_id AS b FROM grams x JOIN grams y ON x.gram = y.gram AND x.doc_id <> y.doc_id
    GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING count(*) / (x.n + y.n - count(*)) >= 0.8),
{_REACH},
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
many AS (SELECT a, count(*) AS n FROM links GROUP BY a),
same AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY g) AS class_id FROM sets)
SELECT d.doc_id, coalesce(same.class_id, d.doc_id) AS class_id, coalesce(many.n, 0) AS n_links,
       least(d.doc_id, coalesce(low.b, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(low.b, d.doc_id)) AS kept
FROM documents d LEFT JOIN same USING (doc_id) LEFT JOIN many ON many.a = d.doc_id LEFT JOIN low ON low.a = d.doc_id
"""

OP10 = f"""
WITH worded AS (SELECT doc_id, {_WORDS} AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS passage
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM worded)),
firsts AS (SELECT passage, min(doc_id) AS first_doc FROM windows GROUP BY passage),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS place FROM windows JOIN firsts USING (passage) WHERE first_doc < doc_id),
single AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM worded),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
         FROM single ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM worded LEFT JOIN kept USING (doc_id)
"""

_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP11 = f"""
WITH worded AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS w FROM documents),
items AS (SELECT item_id::VARCHAR AS item, w, least(10, len(w)) AS k FROM (SELECT item_id, {_TERMS} AS w FROM benchmark) WHERE len(w) > 0),
leaks AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS passage
          FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM items)),
windows AS (SELECT row, k, i, array_to_string(w[i:i + k - 1], ' ') AS passage
            FROM (SELECT row, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM worded JOIN (SELECT DISTINCT k FROM leaks) ON len(w) >= k)),
hits AS (SELECT row, i, k, item FROM windows JOIN leaks USING (k, passage)),
hit AS (SELECT row, count(DISTINCT place) AS n FROM (SELECT row, unnest(range(i, i + k)) AS place FROM hits) GROUP BY row),
held AS (SELECT row, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY row)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM worded LEFT JOIN hit USING (row) LEFT JOIN held USING (row)
"""

OP12 = f"""
WITH worded AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS w FROM documents),
corpus AS (SELECT count(*) AS docs, sum(len(w))::BIGINT AS terms FROM worded WHERE len(w) > 0),
tfs AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM worded) GROUP BY row, term),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
            FROM tfs, corpus GROUP BY term),
asked AS (SELECT item, item_id, term, count(*) AS times
          FROM (SELECT row_number() OVER () AS item, item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY item, item_id, term),
grown AS (SELECT row, 75 + (25 * len(w) * docs) // terms AS m FROM worded, corpus WHERE len(w) > 0),
scores AS (SELECT item, item_id, row, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
           FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN grown USING (row) GROUP BY item, item_id, row),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank, doc_id, score
           FROM scores JOIN worded USING (row) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""

ORACLE: dict[str, str] = {"op2_embedding_near_dedup": OP2, "op7_ngram_jaccard_join": OP7, "op10_substring_dedup": OP10,
                          "op11_benchmark_decontamination": OP11, "op12_ranked_lexical_search": OP12}
