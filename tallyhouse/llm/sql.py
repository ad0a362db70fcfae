"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

#: What separates words, as in the operators.
WORD = r"[^\x20\x09-\x0D]+"
WORDS = f"regexp_extract_all(coalesce(text, ''), '{WORD}')"


def classes(nodes: str, links: str) -> str:
    """node, class: the smallest node reachable over links (a, b), by closing the relation."""
    return f"""reach(node, class) AS (SELECT node, node FROM ({nodes}) UNION SELECT r.node, l.b FROM reach r JOIN
        (SELECT a, b FROM {links} UNION SELECT b, a FROM {links}) l ON l.a = r.class),
        component AS (SELECT node, min(class) AS class FROM reach GROUP BY node)"""


QUALITY = f"""
WITH whole AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t, {WORDS} AS ws FROM documents),
counted AS (SELECT *, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, length(regexp_replace(t, '\\P{{Lu}}', '', 'g')) AS n_capitals,
    length(t) - length(replace(t, '!', '')) AS n_marks, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM whole),
grams AS (SELECT rid, unnest(range(1, n_words - 1)) AS i, ws FROM counted WHERE n_words >= 3),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, ws[i], ws[i + 1], ws[i + 2]) AS n FROM grams) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, i + unnest([0, 1, 2]) AS p FROM twice) GROUP BY rid),
features AS (SELECT c.rid, doc_id, lang, n_words, word_chars, n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
    coalesce(v.n, 0)::BIGINT AS n_repeat_words, n_capitals, n_marks FROM counted c LEFT JOIN covered v USING (rid)),
judged AS (SELECT *, CASE WHEN lang IS NULL THEN '-' ELSE '+' || lang END AS stratum, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
    least(20, greatest(100 * n_symbols // greatest(word_chars, 1), 20 * n_dup_lines // greatest(n_lines, 1), 40 * n_repeat_words // greatest(n_words, 1),
        40 * n_capitals // greatest(word_chars, 1), 20 * n_marks // greatest(n_words, 1)))::INT AS severity FROM features),
labelled AS (SELECT stratum, doc_id, max(severity) AS severity, min(quality) AS quality FROM judged JOIN labels USING (doc_id) WHERE NOT base_failed AND quality IN (0, 1) GROUP BY stratum, doc_id),
tests AS (SELECT stratum, c AS cutoff, count(*) FILTER (quality = 1) AS n, count(*) FILTER (quality = 1 AND severity >= c) AS k,
    count(*) FILTER (quality = 0) AS m, count(*) FILTER (quality = 0 AND severity >= c) AS hits FROM labelled, (SELECT unnest(range(1, 21))::INT AS c) GROUP BY ALL),
bounded AS (SELECT *, CASE WHEN k > n * 0.01 THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1),
    lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.01::DOUBLE) + (n - i) * ln(0.99::DOUBLE)))) END AS tail FROM tests),
certified AS (SELECT stratum, cutoff, hits / greatest(m, 1) - 5 * k / greatest(n, 1) AS gain FROM bounded
    WHERE tail * (SELECT count(DISTINCT stratum) FROM labelled) <= 0.05 AND hits > 0),
chosen AS (SELECT stratum, cutoff FROM certified QUALIFY row_number() OVER (PARTITION BY stratum ORDER BY gain DESC, cutoff DESC) = 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    (NOT base_failed AND coalesce(severity < cutoff, true)) AS kept, severity, cutoff FROM judged LEFT JOIN chosen USING (stratum)
"""

NEAR = f"""
WITH RECURSIVE whole AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS ws FROM documents),
listed AS (SELECT rid, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) ELSE [array_to_string(ws, ' ')] END) AS g
    FROM whole WHERE len(ws) > 0 AND doc_id IS NOT NULL),
bags AS MATERIALIZED (SELECT rid, g, count(*) AS n FROM listed GROUP BY ALL),
sizes AS MATERIALIZED (SELECT rid, sum(n) AS total FROM bags GROUP BY rid),
shared AS (SELECT a.rid AS x, b.rid AS y, sum(least(a.n, b.n)) AS n FROM bags a JOIN bags b ON a.g = b.g AND a.rid < b.rid GROUP BY ALL),
links AS MATERIALIZED (SELECT p.doc_id AS a, q.doc_id AS b FROM shared s JOIN sizes t ON t.rid = s.x JOIN sizes u ON u.rid = s.y JOIN whole p ON p.rid = s.x JOIN whole q ON q.rid = s.y
    WHERE 100 * s.n >= 80 * (t.total + u.total - s.n)),
{classes("SELECT DISTINCT doc_id AS node FROM whole WHERE doc_id IS NOT NULL", "links")}
SELECT doc_id, class AS class_id, coalesce(doc_id = class, true) AS kept, CASE WHEN len(ws) >= 5 THEN len(ws) - 4 ELSE least(len(ws), 1) END::BIGINT AS n_shingles
FROM whole LEFT JOIN component ON node = doc_id
"""

VECTORS = f"""
WITH RECURSIVE rows_ AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0 THEN embedding::DOUBLE[] END AS e FROM embeddings),
pairs AS MATERIALIZED (SELECT a.rid AS x, b.rid AS y, a.vec_id AS a, b.vec_id AS b FROM rows_ a JOIN rows_ b ON a.rid < b.rid AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
{classes("SELECT DISTINCT vec_id AS node FROM rows_ WHERE vec_id IS NOT NULL", "pairs")},
degree AS (SELECT rid, count(*) AS n FROM (SELECT x AS rid FROM pairs UNION ALL SELECT y FROM pairs) GROUP BY rid)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, class AS component_id, coalesce(vec_id = class, true) AS kept
FROM rows_ LEFT JOIN degree USING (rid) LEFT JOIN component ON node = vec_id
"""

# The excess is reshared as often as there can be sources that reach their limit: here by the level at which
# the capped sources, those with the least room for their weight, and the rest sum to the total.
MIX = f"""
WITH sized AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce('0' || source, '1') AS key, len({WORDS})::BIGINT AS size,
    coalesce(greatest(0.5::DOUBLE, 1 - 4 * ((length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g'))) / greatest(length(text), 1))), 1.0)::DOUBLE AS weight,
    (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':7'), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS draw FROM documents),
sources AS (SELECT key, sum(size)::BIGINT AS source_size FROM sized GROUP BY key),
shares AS (SELECT *, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY key) - 1) % 3 + 1]::DOUBLE AS share FROM sources),
ranked AS (SELECT *, 2 * source_size / share AS full_at, row_number() OVER (ORDER BY 2 * source_size / share, key) AS nth FROM shares),
levels AS (SELECT nth, full_at, 1.5 * sum(source_size) OVER () AS wanted,
    coalesce(sum(2 * source_size) OVER (ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
    sum(share) OVER (ORDER BY nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free FROM ranked),
level AS (SELECT coalesce(arg_min((wanted - capped) / free, nth) FILTER ((wanted - capped) / free <= full_at), max(full_at)) AS height FROM levels),
aims AS (SELECT key, source_size, round(least(share * height, 2.0 * source_size), 6) AS target FROM ranked, level),
budgets AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size + 1e-9) ELSE 0 END AS epochs FROM aims),
one AS (SELECT s.*, source_size, target, epochs, target - epochs * source_size AS budget,
    sum(size) OVER (PARTITION BY key ORDER BY -ln(draw) / weight, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS upto FROM sized s JOIN budgets USING (key)),
left_ AS (SELECT *, upto <= budget AS first, budget - coalesce(sum(size) FILTER (upto <= budget) OVER (PARTITION BY key), 0) AS rest FROM one),
two AS (SELECT *, CASE WHEN NOT first AND size <= 2 * rest THEN
    sum(size) FILTER (NOT first AND size <= 2 * rest) OVER (PARTITION BY key ORDER BY -ln(draw) / weight, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) - size / 2 <= rest
    ELSE false END AS second FROM left_),
taken AS (SELECT *, CASE WHEN size > 0 THEN epochs::BIGINT + (first OR second)::BIGINT ELSE 0 END AS copies FROM two)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, copies::BIGINT AS copies FROM taken
"""

def floors(scale: int) -> str:
    return f"list_transform(embedding, lambda x: floor(greatest(least({scale}.0::DOUBLE * x::DOUBLE, 134217728.0::DOUBLE), -134217728.0::DOUBLE)))"


FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def rounds(number: int, parts: str, start: str) -> str:
    """Tables near_0 .. near_<number> (rid, part, entry, d) and book_0 .. book_<number> (part, entry, c).

    ``parts`` has rid, part and v, ``start`` part, entry and c, all components as whole doubles: their
    products are exact. The nearest entry is the least of distance and index as one number.
    """
    out = [f"book_0 AS MATERIALIZED ({start})"]
    for k in range(number + 1):
        out.append(f"""best_{k} AS MATERIALIZED (SELECT rid, part, min(1000::HUGEINT * (list_inner_product(v, v) - 2 * list_inner_product(v, c) + list_inner_product(c, c))::BIGINT + entry) AS m
            FROM {parts} JOIN book_{k} USING (part) GROUP BY rid, part),
            near_{k} AS MATERIALIZED (SELECT rid, part, (m % 1000)::INT AS entry, (m // 1000)::BIGINT AS d FROM best_{k})""")
        if k < number:
            out.append(f"""sums_{k} AS (SELECT part, entry, i, sum(x::BIGINT)::BIGINT AS s, count(*) AS n FROM (SELECT part, entry, unnest(v) AS x, unnest(range(len(v))) AS i
                FROM near_{k} JOIN {parts} USING (rid, part)) GROUP BY ALL),
                means_{k} AS (SELECT part, entry, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY i) AS mean FROM sums_{k} GROUP BY ALL),
                book_{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(mean, c) AS c FROM book_{k} LEFT JOIN means_{k} USING (part, entry))""")
    return ",\n".join(out)


CODES = f"""
WITH whole AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, label, {floors(1024)} AS v, len(embedding) // 4 AS w FROM embeddings WHERE {FINITE}),
parts AS MATERIALIZED (SELECT rid, part, list_slice(v, part * w + 1, part * w + w) AS v FROM whole, (SELECT unnest(range(4)) AS part)),
chosen AS (SELECT rid, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS entry FROM whole QUALIFY entry < 256),
{rounds(4, "parts", "SELECT part, entry, v AS c FROM chosen JOIN parts USING (rid)")},
books AS (SELECT sha256(string_agg(array_to_string(c::BIGINT[], ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book_4),
coded AS (SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM near_4 GROUP BY rid)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM whole JOIN coded USING (rid), books
"""

CLUSTERS = f"""
WITH whole AS MATERIALIZED (SELECT row_number() OVER () AS rid, 0 AS part, vec_id, {floors(256)} AS v FROM embeddings WHERE {FINITE} AND len(embedding) = 64),
chosen AS (SELECT rid, row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS entry FROM whole QUALIFY entry < 40),
{rounds(5, "whole", "SELECT part, entry, v AS c FROM chosen JOIN whole USING (rid)")}
SELECT vec_id, entry AS cluster, d AS distance, (sum(d) OVER (PARTITION BY entry))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
    sha256(array_to_string(c::BIGINT[], ',')) AS centroid_sha256 FROM whole JOIN near_5 USING (rid, part) JOIN book_5 USING (part, entry)
"""

def base32(hexadecimal: str) -> str:
    """Base32 of 40 hexadecimal digits: five digits make four characters."""
    return f"""array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((('0x' || substr({hexadecimal}, (k // 4 * 5 + 1)::INT, 5))::INT >> (15 - k % 4 * 5)::INT) & 31) + 1, 1)), '')"""


WARC = f"""
WITH whole AS (SELECT page_id, coalesce(html, '') AS payload, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes, {base32("sha1(payload)")} AS payload_digest,
    CASE WHEN page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to FROM whole
"""

SQL: dict[str, str] = {
    "op1_quality_rules": QUALITY,
    "op5_minhash_near_dedup": NEAR,
    "op7_embedding_near_dedup": VECTORS,
    "op10_mixing": MIX,
    "op11_warc": WARC,
    "op12_vector_codes": CODES,
    "op13_centroid_clusters": CLUSTERS,
}
