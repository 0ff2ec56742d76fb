"""SQL with the results of the queries, for those that SQL can express."""

URL_FILTER = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
places AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
rules(rule_host, rule_path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
         ('org', '/fr/', 'allow')),
fits AS (
  SELECT p.host, p.path, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         max_by(verdict, length(rule_host || rule_path)) AS verdict
  FROM (SELECT DISTINCT host, path FROM places) p JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM places LEFT JOIN fits USING (host, path)
"""

QUALITY_RULES = r"""
WITH split AS (
  SELECT row_number() OVER () AS id, doc_id, source, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT id, unnest(range(1, len(w) - 1)) AS pos, w FROM split WHERE len(w) > 2),
repeated AS (
  SELECT id, pos FROM (
    SELECT id, pos, count(*) OVER (PARTITION BY id, w[pos], w[pos + 1], w[pos + 2]) AS n FROM windows)
  WHERE n > 1),
covered AS (
  SELECT id, count(DISTINCT p) AS n FROM (SELECT id, unnest([pos, pos + 1, pos + 2]) AS p FROM repeated)
  GROUP BY id),
measured AS (
  SELECT doc_id, source, len(w) AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM split LEFT JOIN covered USING (id)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured),
hosts AS (
  SELECT source, count(*) AS n, sum(base_failed::INT) AS k FROM judged GROUP BY source),
means AS (
  SELECT sum(k) / sum(n) AS m, avg(1 / n) AS a, avg((k / n - (SELECT sum(k) / sum(n) FROM hosts)) ** 2) AS v
  FROM hosts),
prior AS (
  SELECT m, CASE WHEN m > 0 AND m < 1 AND v / (m * (1 - m)) > a
                 THEN greatest(2, least(1000, (1 - a) / (v / (m * (1 - m)) - a) - 1)) ELSE 1000 END AS s
  FROM means),
bad AS (
  SELECT source FROM (SELECT source, n, m, s, (k + m * s) / (n + s) AS r FROM hosts, prior)
  WHERE r - 2 * sqrt(r * (1 - r) / (n + s + 1)) > greatest(0.5, 2 * m))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT EXISTS (
         SELECT 1 FROM bad WHERE bad.source IS NOT DISTINCT FROM judged.source) AS kept
FROM judged
"""

# The same rules where short texts are a host of their own.
QUALITY_SECTIONS = QUALITY_RULES.replace("doc_id, source, coalesce(text, '') AS t,", """doc_id,
         CASE WHEN length(coalesce(text, '')) < 315 THEN 'short' ELSE source END AS source,
         coalesce(text, '') AS t,""")

NGRAM_JACCARD = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(
           coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
shingled AS (
  SELECT doc_id, list_distinct(CASE
           WHEN len(w) = 0 THEN []
           WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM split),
entries AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM shingled),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM entries a JOIN entries b USING (g) WHERE a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id, doc_id AS other FROM shingled
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT doc_id, len(s) AS n_shingles, component_id FROM shingled
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""

WARC = r"""
WITH payloads AS (
  SELECT page_id, encode(coalesce(html, '')) AS p FROM pages),
digests AS (
  SELECT page_id, octet_length(p) AS payload_bytes, sha1(p) AS hex FROM payloads),
bits AS (  -- five hex digits are four base-32 digits
  SELECT hex, string_agg(d, '' ORDER BY i, k) AS base32 FROM (
    SELECT hex, i, k, substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                             ((('0x' || substr(hex, 5 * i + 1, 5))::BIGINT >> (15 - 5 * k)) & 31)::INT + 1, 1) AS d
    FROM (SELECT DISTINCT hex FROM digests), range(8) r(i), range(4) q(k))
  GROUP BY hex),
ranked AS (
  SELECT *, min(page_id) OVER (PARTITION BY hex, payload_bytes) AS first FROM digests)
SELECT page_id, payload_bytes, base32 AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM ranked JOIN bits USING (hex)
"""

CHAT_FORMAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
escaped AS (
  SELECT *, length(text) + length(role) + 20
    + len(regexp_extract_all(text, '<\\*/?s>|\[\\*/?INST\]'))
    + len(regexp_extract_all(role, '<\\*/?s>|\[\\*/?INST\]')) AS size FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(size)::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""

def centroid_clusters(centroids: int = 40, rounds: int = 5, dims: int = 64) -> str:
    """Every round compares every vector with every centroid."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT id, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d FROM (
    SELECT id, cluster, sum((x - c) * (x - c))::BIGINT AS d FROM parts JOIN c{r} USING (place)
    GROUP BY id, cluster) GROUP BY id)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT o.cluster, o.place, coalesce(m.c, o.c) AS c FROM c{r} o LEFT JOIN (
    SELECT cluster, place, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS c
    FROM parts JOIN a{r} USING (id) GROUP BY cluster, place) m USING (cluster, place))""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id, embedding AS e FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
parts AS MATERIALIZED (
  SELECT id, place, floor(256 * e[place]::DOUBLE)::BIGINT AS x FROM kept, range(1, {dims} + 1) p(place)),
starts AS (
  SELECT id, row_number() OVER (ORDER BY sha256('2:' || vec_id), e) - 1 AS cluster FROM kept
  QUALIFY cluster < {centroids}),
c0 AS MATERIALIZED (SELECT cluster, place, x AS c FROM starts JOIN parts USING (id)),
{", ".join(steps)},
digests AS (
  SELECT cluster, sha256(string_agg(c::VARCHAR, ',' ORDER BY place)) AS centroid_sha256 FROM c{rounds}
  GROUP BY cluster)
SELECT vec_id, cluster::INT AS cluster, d AS distance,
       (sum(d) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
       centroid_sha256
FROM kept JOIN a{rounds} USING (id) JOIN digests USING (cluster)
"""


def ball_codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Every round compares every part with every entry of its codebook."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT id, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
    SELECT id, part, entry, sum((x - c) * (x - c))::BIGINT AS d FROM cut JOIN c{r} USING (part, place)
    GROUP BY id, part, entry) GROUP BY id, part)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT o.part, o.entry, o.place, coalesce(m.c, o.c) AS c FROM c{r} o LEFT JOIN (
    SELECT part, entry, place,
           ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS c
    FROM cut JOIN a{r} USING (id, part) GROUP BY part, entry, place) m USING (part, entry, place))""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id, label, embedding AS e, len(embedding) // {parts} AS width
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
cut AS MATERIALIZED (
  SELECT id, part, place, floor(4096 * e[part * width + place]::DOUBLE)::BIGINT AS x
  FROM kept, range({parts}) q(part), (SELECT unnest(range(1, max(width) + 1)) AS place FROM kept) p),
starts AS (
  SELECT id, row_number() OVER (ORDER BY vec_id, e) - 1 AS entry FROM kept QUALIFY entry < {entries}),
c0 AS MATERIALIZED (SELECT part, entry, place, x AS c FROM starts JOIN cut USING (id)),
{", ".join(steps)},
coded AS (
  SELECT id, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
  FROM a{rounds} GROUP BY id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, place)) FROM c{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (id)
"""


ORACLE = {
    "op1_url_filter": URL_FILTER,
    "op3_quality_rules": QUALITY_RULES,
    "quality_sections": QUALITY_SECTIONS,
    "op5_ngram_jaccard": NGRAM_JACCARD,
    "op8_warc": WARC,
    "warc_salvage": WARC,
    "op9_chat_format": CHAT_FORMAT,
    "op11_centroid_clusters": centroid_clusters(),
    "op13_ball_codes": ball_codes(),
}
