"""DuckDB counterparts of those queries of this subpackage that SQL can express."""

from __future__ import annotations

from daytally.llm import mixing

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_EXACT_DEDUP = f"""
WITH lowered AS (SELECT doc_id, {_LOWERED} AS t FROM documents),
judged AS (SELECT doc_id, t, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size
    FROM lowered WINDOW same AS (PARTITION BY t))
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256 FROM judged
"""

_WARC = """
WITH payloads AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first
    FROM payloads),
told AS (SELECT *, first IS NOT NULL AND page_id IS DISTINCT FROM first AS revisit FROM firsts)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN revisit THEN first END AS refers_to
FROM told
"""

_DRAWN = (
    f"('0x' || substr(md5('{mixing.SEED}:' || coalesce(cast(doc_id AS VARCHAR), text, '')), 1, 13))::BIGINT::DOUBLE"
    f" / {16**13}::DOUBLE"
)

# With the sources of the k smallest caps per weight held at their caps, the rest share what is left; the first k at which
# none of the rest is above its cap gives the level.
_MIXING = f"""
WITH sized AS (SELECT doc_id, source, {_DRAWN} AS drawn,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
    FROM sized GROUP BY source),
weighed AS (SELECT *, list_value({", ".join(map(str, mixing.WEIGHTS))})[place % {len(mixing.WEIGHTS)} + 1] AS weight,
    {mixing.MOST_REPEATS} * source_size AS cap FROM sums),
steps AS (SELECT cap, weight, row_number() OVER (ORDER BY cap / weight, place) AS k, {mixing.SHARE} * sum(source_size) OVER () AS words,
    coalesce(sum(cap) OVER below, 0) AS held, sum(weight) OVER () - coalesce(sum(weight) OVER below, 0) AS free
    FROM weighed
    WINDOW below AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (SELECT arg_min((words - held) / free, k) AS level FROM steps WHERE cap >= weight * ((words - held) / free)),
targets AS (SELECT source, source_size, least(cap::DOUBLE, weight * coalesce(level, 0)) AS target
    FROM weighed, levels),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targets)
SELECT doc_id, size, r.source_size, target,
    (size * (floor(rate) + (drawn < rate - floor(rate))::INT))::BIGINT AS taken
FROM sized AS s JOIN rates AS r ON s.source IS NOT DISTINCT FROM r.source
"""

_DECONTAMINATE = f"""
WITH docs AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '{{word}}') AS w FROM documents),
items AS (SELECT coalesce(cast(item_id AS VARCHAR), '') AS item, regexp_extract_all({_LOWERED}, '{{word}}') AS w
    FROM benchmark),
windows AS (SELECT DISTINCT item, w[i : i + 9] AS words FROM
    (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(words) AS n FROM windows),
places AS (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes),
found AS (SELECT doc_id, i, n, item FROM (SELECT doc_id, n, i, w[i : i + n - 1] AS words FROM places) AS p
    JOIN windows USING (words)),
hits AS (SELECT doc_id, count(DISTINCT spot) AS n_hit FROM
    (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS spot FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
""".replace("{word}", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# Exact similarities of all pairs that share a shingle, then components by following links.
_NEAR_DEDUP = f"""
WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '{{word}}') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN w ELSE w[i : i + 4] END AS s FROM
    (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
    FROM shingles AS a JOIN shingles AS b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM shared JOIN sizes AS x ON a = x.doc_id JOIN sizes AS y ON b = y.doc_id
    WHERE 100 * k >= 75 * (x.n + y.n - k)),
both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT a AS doc_id, a AS other FROM both_ways
    UNION SELECT r.doc_id, l.b FROM reached AS r JOIN both_ways AS l ON r.other = l.a),
least AS (SELECT doc_id, min(other) AS component FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, doc_id) AS component_id,
    coalesce(component, doc_id) = doc_id AS kept
FROM docs LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
""".replace("{word}", r"[^\x20\x09-\x0D]+")

# Products of doubles are exact here, as all scores are below 2 ** 53.
_VECTOR_SEARCH = """
WITH vectors AS (SELECT vec_id, row_number() OVER () AS place, list_transform(embedding, lambda c: floor(1024 * c::DOUBLE)) AS x
    FROM (SELECT * FROM embeddings WHERE len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)),
scored AS (SELECT q.vec_id AS query_id, q.place, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
    FROM vectors AS q JOIN vectors AS c ON q.place <> c.place WHERE q.vec_id % 100 = 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM numbered WHERE rank <= 10
"""

_LEXICAL_SEARCH = f"""
WITH docs AS (SELECT row_number() OVER () AS place, doc_id, regexp_extract_all({_LOWERED}, '{{term}}') AS w FROM documents),
counted AS (SELECT place, doc_id, w, len(w)::BIGINT AS n FROM docs WHERE len(w) > 0),
whole AS (SELECT count(*)::BIGINT AS all_docs, sum(n)::BIGINT AS all_terms FROM counted),
items AS (SELECT row_number() OVER () AS item, item_id, regexp_extract_all({_LOWERED}, '{{term}}') AS w FROM benchmark),
wanted AS (SELECT DISTINCT item, item_id, term FROM (SELECT item, item_id, unnest(w) AS term FROM items)),
postings AS (SELECT place, doc_id, n, term, count(*)::BIGINT AS tf
    FROM (SELECT place, doc_id, n, unnest(w) AS term FROM counted) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM postings, whole GROUP BY term, all_docs),
scored AS (SELECT item, item_id, place, doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * all_docs) // all_terms))))::BIGINT AS score
    FROM wanted JOIN postings USING (term) JOIN weights USING (term), whole GROUP BY ALL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INT AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM numbered WHERE rank <= 10
""".replace("{term}", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def oracles() -> dict[str, str]:
    return {
        "op1_exact_dedup": _EXACT_DEDUP,
        "op2_warc": _WARC,
        "op7_mixing": _MIXING,
        "op8_decontaminate": _DECONTAMINATE,
        "op9_near_dedup": _NEAR_DEDUP,
        "op11_vector_search": _VECTOR_SEARCH,
        "op12_lexical_search": _LEXICAL_SEARCH,
    }
