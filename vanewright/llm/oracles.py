"""DuckDB SQL for the queries of this subpackage that SQL can express."""

#: A line's key, and the lines of every document by position.
_LINES = """
    all_lines AS (
        SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS position
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
    ),
    keyed AS (
        SELECT doc_id, line, position,
               translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM all_lines
    ),
    shared AS (
        SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 20
        GROUP BY key HAVING count(DISTINCT doc_id) >= 3
    ),
    judged AS (
        SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.holder AS dropped
        FROM keyed k LEFT JOIN shared s ON k.key = s.key
    )
"""

ORACLES: dict[str, str] = {
    "op1_url_filter": f"""
        WITH parsed AS (
            SELECT page_id,
                translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
            FROM pages
        ),
        ruled AS (
            SELECT *, CASE
                WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/')
                    THEN 'www.example.com/en/'
                WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/')
                    THEN 'example.com/en/'
                WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
                WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
                WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
            END AS rule FROM parsed
        ),
        labelled AS (
            SELECT *, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
                END AS ruling FROM ruled
        ),
        paths AS (
            SELECT host, path, list_filter(string_split(path, '/'), lambda s: s <> '') AS own, count(*) AS urls,
                count(*) FILTER (WHERE ruling = 'block') AS blocked, count(ruling) AS labels
            FROM labelled GROUP BY host, path
        ),
        segments AS (SELECT host, path, urls, unnest(own) AS segment, unnest(range(len(own))) AS level FROM paths),
        counts AS (SELECT host, level, segment, sum(urls) AS n FROM segments GROUP BY ALL),
        named AS (
            SELECT host, level, segment FROM (SELECT *, sum(n) OVER (PARTITION BY host, level) AS total FROM counts)
            WHERE NOT regexp_matches(segment, '[0-9]') AND length(segment) < 24 AND n * 20 >= total
        ),
        templates AS (
            SELECT s.host, s.path, list(CASE WHEN n.host IS NULL THEN '*' ELSE s.segment END ORDER BY s.level) AS template
            FROM segments s LEFT JOIN named n USING (host, level, segment) GROUP BY s.host, s.path
        ),
        tree AS (
            SELECT p.host, p.path, p.blocked, p.labels, coalesce(t.template, []::VARCHAR[]) AS template
            FROM paths p LEFT JOIN templates t USING (host, path)
        ),
        branches AS (
            SELECT *, template[1:depth] AS node FROM (
                SELECT host, template, sum(blocked) AS blocked, sum(labels) AS labels,
                    unnest(range(len(template) + 1)) AS depth FROM tree GROUP BY host, template)
        ),
        nodes AS (SELECT host, node, depth, sum(blocked) AS b, sum(labels) AS n FROM branches GROUP BY ALL),
        differing AS (
            SELECT * FROM (
                SELECT c.host, c.node, p.node AS parent, c.b, c.n, c.b / c.n AS share, p.b / p.n AS before
                FROM nodes c JOIN nodes p ON c.host = p.host AND c.depth = p.depth + 1 AND c.node[1:c.depth - 1] = p.node
                WHERE c.n >= 5)
            WHERE abs(share - before) > 2.0 * sqrt(before * (1 - before) / n)
        ),
        pools AS (
            SELECT host, parent, share > before AS above, sum(b) AS b, sum(n) AS n FROM differing GROUP BY ALL
        ),
        speaking AS (
            SELECT d.host, d.node, p.b, p.n FROM differing d JOIN pools p
            ON d.host = p.host AND d.parent = p.parent AND (d.share > d.before) = p.above
            UNION ALL SELECT host, node, b, n FROM nodes WHERE depth = 0
        ),
        spoken AS (
            SELECT r.host, r.template, arg_max(s.b, r.depth) AS b, arg_max(s.n, r.depth) AS n
            FROM branches r JOIN speaking s ON r.host = s.host AND r.node = s.node GROUP BY r.host, r.template
        ),
        overall AS (SELECT coalesce(avg(CASE ruling WHEN 'block' THEN 1.0 WHEN 'allow' THEN 0.0 END), 0) AS share
            FROM labelled)
        SELECT l.page_id, l.host, l.path, l.rule, coalesce(l.ruling,
            CASE WHEN s.n > 0 AND s.b >= 0.5 * s.n AND (s.b + 4.0 * o.share) / (s.n + 4.0) >= 0.5
                THEN 'block' ELSE 'allow' END) AS verdict
        FROM labelled l JOIN tree t ON l.host = t.host AND l.path = t.path
        JOIN spoken s ON t.host = s.host AND t.template = s.template, overall o
    """,
    "op5_line_dedup": f"""
        WITH {_LINES}
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (WHERE NOT dropped), ''))
                   AS kept_sha256
        FROM judged GROUP BY doc_id
    """,
}
