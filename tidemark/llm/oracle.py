"""The operators' queries as SQL for DuckDB, where SQL can say them."""

FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

CHUNK_RECIPE_DEDUP = f"""
WITH texts AS (SELECT doc_id, {FOLDED} AS folded FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY folded) AS keep_id,
       count(*) OVER (PARTITION BY folded) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY folded) AS kept,
       sha256(folded) AS text_sha256
FROM texts
"""

# Base32 of a SHA-1: eight times five hexadecimal digits, four letters each.
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE32_SHA1 = f"""array_to_string(list_transform(range(32), lambda i:
    substr('{LETTERS}', 1 + ((('0x' || substr(sha1(payload), 1 + 5 * (i // 4), 5))::BIGINT
                             >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '')"""

DICTIONARY_WARC = f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages)
SELECT page_id,
       strlen(payload) AS payload_bytes,
       {BASE32_SHA1} AS payload_digest,
       CASE WHEN page_id = max(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> max(page_id) OVER same THEN max(page_id) OVER same END AS refers_to
FROM payloads WINDOW same AS (PARTITION BY payload)
"""

FAIR_QUEUE_MIX = r"""
WITH sized AS (
    SELECT doc_id, source, md5('mix' || doc_id) AS place,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
    FROM documents
), totals AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
    SELECT *, 1.0::DOUBLE + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM totals
), levels AS (
    SELECT *, (sum(source_size) OVER ()
               - 3 * coalesce(sum(source_size) OVER before, 0))::DOUBLE
              / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
    FROM weighed
    WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
    SELECT source, source_size, least(max(level) OVER () * weight, (3 * source_size)::DOUBLE) AS target
    FROM levels
), queued AS (
    SELECT doc_id, place, size, source_size, target,
           sum(size) OVER (PARTITION BY s.source ORDER BY place, doc_id, size
                           ROWS UNBOUNDED PRECEDING) AS so_far
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), line AS (
    SELECT *, CASE WHEN target > 0 THEN (turn * source_size + so_far)::DOUBLE / target ELSE 0 END AS finish
    FROM queued, (SELECT unnest([0, 1, 2]) AS turn)
), served AS (
    SELECT *, sum(size) OVER (ORDER BY finish, place, doc_id, size, turn ROWS UNBOUNDED PRECEDING) AS used
    FROM line
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       sum(CASE WHEN used <= (SELECT sum(size) FROM sized) THEN size ELSE 0 END)::BIGINT AS taken
FROM served GROUP BY doc_id, size, source_size, target
"""

HOST_WORDS = "casino|pills|bets|spam|ads|track|porn|xxx|viagra|payday"

URL_RULE_FILTER = rf"""
WITH rests AS (
    SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) AS rest FROM pages
), places AS (
    SELECT page_id,
           translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '(?s)^[^/?#]*(/[^?#]*)', 1) AS path
    FROM rests
), ruled AS (
    SELECT *, CASE
        WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
        WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
        WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
        WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule
    FROM places
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow'
    WHEN regexp_matches(host, '(^|[^a-z0-9])({HOST_WORDS})([^a-z0-9]|$)') THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""

PREFIX_FREE_PARSE = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents),
strings AS (
    SELECT doc_id, p, substr(hx, 2 * p + 1, 100) AS s
    FROM (SELECT doc_id, hx, unnest(range(length(hx) // 2 - 49)) AS p FROM texts WHERE length(hx) >= 100)
), firsts AS (SELECT s, min(doc_id) AS first FROM strings GROUP BY s
), marks AS (
    SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before
    FROM strings JOIN firsts USING (s) WHERE first < doc_id
), runs AS (
    SELECT *, sum((before IS NULL OR p > before + 50)::INT) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marks
), spans AS (SELECT doc_id, min(p) AS b, max(p) + 50 AS e FROM runs GROUP BY doc_id, run
), gaps AS (
    SELECT doc_id, e - b AS size, b, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS start,
           max(e) OVER (PARTITION BY doc_id) AS last FROM spans
), removed AS (
    SELECT t.doc_id, sum(size)::BIGINT AS n_removed, count(*) AS n_spans,
           string_agg(substr(hx, 2 * start + 1, 2 * (b - start)), '' ORDER BY b) || substr(any_value(hx), 2 * any_value(last) + 1) AS kept
    FROM gaps g JOIN texts t ON t.doc_id = g.doc_id GROUP BY t.doc_id
)
SELECT t.doc_id, length(hx) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, hx))) AS kept_sha256
FROM texts t LEFT JOIN removed r ON t.doc_id = r.doc_id
"""

COUNT_AUTOMATA = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), spoken AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), counts AS (
    SELECT lang, m, array_to_string(w[b : b + m - 1], ' ') AS phrase, count(*) AS f
    FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS b
          FROM spoken, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE len(w) >= m)
    GROUP BY ALL
), totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE m = 1 GROUP BY lang
), frequent AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE f >= 100
), inside AS (
    SELECT lang, array_to_string(CASE side WHEN 0 THEN w[1 : m - 1] ELSE w[2 : m] END, ' ') AS phrase, max(f) AS f
    FROM frequent, (SELECT unnest([0, 1]) AS side) WHERE m > 2 GROUP BY 1, 2
), cuts AS (
    SELECT lang, phrase, f AS a, k, array_to_string(w[1 : k], ' ') AS head, array_to_string(w[k + 1 : m], ' ') AS tail
    FROM (SELECT c.*, unnest(range(1, m)) AS k FROM frequent c ANTI JOIN inside i USING (lang, phrase, f) WHERE m > 1)
), scored AS (
    SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, n,
           (1000::HUGEINT * a * n // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM cuts c JOIN frequent x ON x.lang = c.lang AND x.phrase = head
                JOIN frequent y ON y.lang = c.lang AND y.phrase = tail JOIN totals t ON t.lang = c.lang
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER of_lang AS rank, phrase, a, l, r, n, score
FROM lowest WINDOW of_lang AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY rank <= 2000
"""

ORACLE = {
    "op2_chunk_recipe_dedup": CHUNK_RECIPE_DEDUP,
    "op3_dictionary_warc": DICTIONARY_WARC,
    "op8_fair_queue_mix": FAIR_QUEUE_MIX,
    "op9_url_rule_filter": URL_RULE_FILTER,
    "op11_prefix_free_parse": PREFIX_FREE_PARSE,
    "op12_count_automata": COUNT_AUTOMATA,
}
