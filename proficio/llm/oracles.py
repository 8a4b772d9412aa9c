"""DuckDB SQL of the numbered queries that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH cut AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
parts AS (
    SELECT page_id,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut),
rules(r_host, r_path, r_verdict) AS (VALUES
    ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fit AS (
    SELECT page_id, host, path, r_host || r_path AS rule, r_verdict,
        row_number() OVER (PARTITION BY page_id ORDER BY length(r_host || r_path) DESC NULLS LAST) AS place
    FROM parts LEFT JOIN rules
        ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path))
SELECT page_id, host, path, rule, coalesce(r_verdict, 'allow') AS verdict FROM fit WHERE place = 1
"""

OP4 = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
views AS (
    SELECT s.*, p.perspective, s.role = p.perspective AS own,
        cast(coalesce(floor(s.turn / 64.0), -1) AS BIGINT) AS part
    FROM said s JOIN (SELECT DISTINCT conv_id, role AS perspective FROM said WHERE role <> 'system') p
        ON s.conv_id IS NOT DISTINCT FROM p.conv_id),
segments AS (
    SELECT *, '<|im_start|>' || CASE WHEN role = 'system' THEN 'system' WHEN own THEN 'assistant'
            ELSE 'user name=' || replace(role, '<|', '< |') END || chr(10)
        || replace(text, '<|', '< |') || '<|im_end|>' || chr(10) AS segment
    FROM views),
placed AS (
    SELECT *, sum(length(segment)) OVER (PARTITION BY conv_id, perspective, part ORDER BY turn NULLS FIRST, role, text
        ROWS UNBOUNDED PRECEDING) - length(segment) AS begin_at
    FROM segments)
SELECT conv_id, perspective, part, 0::BIGINT AS piece, count(*) AS n_messages,
    string_agg(segment, '' ORDER BY turn NULLS FIRST, role, text) AS rendered,
    coalesce(string_agg((begin_at + 22)::BIGINT || ':' || (length(segment) - 22)::BIGINT, ','
        ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE own), '') AS mask_spans,
    coalesce(sum(length(segment) - 22) FILTER (WHERE own), 0)::BIGINT AS n_masked_chars
FROM placed GROUP BY conv_id, perspective, part
"""

OP5 = """
WITH hashed AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
    doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM hashed WINDOW g AS (PARTITION BY text_sha256)
"""

OP8 = """
WITH lines AS (
    SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) AS place FROM documents),
spread AS (
    SELECT trim(line, ' ') AS line FROM lines WHERE trim(line, ' ') <> ''
    GROUP BY 1 HAVING count(DISTINCT source) >= 10),
marked AS (
    SELECT l.*, s.line IS NOT NULL AS gone FROM lines l LEFT JOIN spread s ON trim(l.line, ' ') = s.line),
cleaned AS (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
        coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '') AS kept
    FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
    sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN cleaned USING (doc_id)
"""

OP9 = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
    SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words)),
least AS (SELECT s, min(doc_id) AS lo FROM windows GROUP BY s),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS place FROM windows JOIN least USING (s) WHERE lo < doc_id),
placed AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM words),
kept AS (
    SELECT doc_id, count(g.place) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY p.place)
        FILTER (WHERE g.place IS NULL), '') AS kept
    FROM placed p LEFT JOIN gone g USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

OP10 = r"""
WITH ordered AS (
    SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id, coalesce(text, '')) AS place
    FROM documents),
paired AS (
    SELECT o.doc_id, o.place, o.text, n.place AS next_place, n.text AS next_text, length(o.text) // 2 AS half
    FROM ordered o JOIN ordered n
        ON n.place = CASE WHEN o.place = (SELECT count(*) FROM ordered) THEN 1 ELSE o.place + 1 END),
texts AS (
    SELECT place, 0 AS kind, text AS body FROM paired
    UNION ALL
    SELECT place, 1, left(text, length(text) - half) || left(next_text, half) FROM paired),
nodes AS (
    SELECT place, kind, list_transform(string_split(body, chr(10)),
        lambda p: list_transform(string_split(p, '. '), lambda s: md5(s))) AS leaves FROM texts),
marked AS (
    SELECT place, kind, leaves, array_to_string(list_transform(leaves, lambda p:
        md5(array_to_string(p, '')) || '/' || array_to_string(list_transform(p, lambda h: left(h, 8)), '')
        || CASE WHEN md5(array_to_string(p, '')) < '2' THEN ';' ELSE ',' END), '') AS flat FROM nodes),
cut AS (
    SELECT place, kind, string_split(left(flat, length(flat) - 1), ';') AS secs,
        list_distinct(list_transform(flatten(leaves), lambda h: left(h, 8))) AS leaves FROM marked),
named AS (
    SELECT place, kind, leaves, secs,
        list_transform(secs, lambda s: md5(regexp_replace(s, '/[0-9a-f]*,?', '', 'g'))) AS tops FROM cut),
printed AS (
    SELECT place, kind, leaves, md5(array_to_string(tops, '')) || ':' || array_to_string(list_transform(secs, lambda s:
        left(md5(regexp_replace(s, '/[0-9a-f]*,?', '', 'g')), 8) || '='
        || regexp_replace(s, '([0-9a-f]{8})[0-9a-f]{24}/', '\1/', 'g')), ';') AS fp FROM named)
SELECT p.doc_id, length(p.text) AS n_chars, sha256(left(p.text, length(p.text) - half) || left(next_text, half)) AS edited_sha256,
    a.fp AS fingerprint, e.fp AS edited_fingerprint,
    CASE WHEN a.fp = e.fp THEN 1.0::DOUBLE ELSE
        2.0::DOUBLE * len(list_intersect(a.leaves, e.leaves)) / (len(a.leaves) + len(e.leaves)) END AS near_edited,
    CASE WHEN a.fp = n.fp THEN 1.0::DOUBLE ELSE
        2.0::DOUBLE * len(list_intersect(a.leaves, n.leaves)) / (len(a.leaves) + len(n.leaves)) END AS near_next
FROM paired p JOIN printed a ON a.place = p.place AND a.kind = 0 JOIN printed e ON e.place = p.place AND e.kind = 1
    JOIN printed n ON n.place = p.next_place AND n.kind = 0
"""


OP11 = r"""
WITH RECURSIVE table_of AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i::BIGINT], range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
    FROM conversations),
harmed AS (
    SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(key, ''), lambda x: unicode(x)::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS harm
    FROM keyed, table_of),
after AS (
    SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
        CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN harm = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM harmed WHERE harm <> 0),
placed AS (
    SELECT conv_id, turn, role, text, left(role, 1) AS x, row_number() OVER c AS i, lag(left(role, 1)) OVER c AS before
    FROM after WINDOW c AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
judged AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
        WHEN right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) NOT IN ('.', '!', '?')
        THEN 'truncated' END AS fault
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM placed) p),
counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
        count(*) FILTER (WHERE fault = 'truncated') AS truncated,
        count(*) FILTER (WHERE before || x NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
    FROM judged GROUP BY conv_id),
walked AS (
    SELECT conv_id, n AS i, {'c': 0, 'a': ''} AS g0, {'c': 10, 'a': 'II'} AS g1, {'c': 5, 'a': 'I'} AS g2, {'c': 0, 'a': ''} AS g3
    FROM counted
    UNION ALL
    SELECT conv_id, i, least(h0, {'c': 5 + f2.c, 'a': 'I' || f2.a}), least(h1, {'c': 5 + f2.c, 'a': 'I' || f2.a}), f2, f3
    FROM (SELECT *, least(h2, {'c': 5 + h3.c, 'a': 'I' || h3.a}) AS f2, least(h3, {'c': 5 + h2.c, 'a': 'I' || h2.a}) AS f3
    FROM (SELECT w.conv_id, w.i - 1 AS i,
            least({'c': 2 + g0.c, 'a': 'D' || g0.a}, {'c': s + 1 + g2.c, 'a': 'R' || g2.a},
                {'c': s + g2.c + CASE x WHEN 'u' THEN 0 ELSE 999999 END, 'a': 'K' || g2.a},
                {'c': s + g1.c + CASE x WHEN 's' THEN 0 ELSE 999999 END, 'a': 'K' || g1.a}) AS h0,
            least({'c': 2 + g1.c, 'a': 'D' || g1.a}, {'c': s + 1 + g2.c, 'a': 'R' || g2.a},
                {'c': s + g2.c + CASE x WHEN 'u' THEN 0 ELSE 999999 END, 'a': 'K' || g2.a}) AS h1,
            least({'c': 2 + g2.c, 'a': 'D' || g2.a}, {'c': s + 1 + g3.c, 'a': 'R' || g3.a},
                {'c': s + g3.c + CASE x WHEN 'a' THEN 0 ELSE 999999 END, 'a': 'K' || g3.a}) AS h2,
            least({'c': 2 + g3.c, 'a': 'D' || g3.a}, {'c': s + 1 + g2.c, 'a': 'R' || g2.a},
                {'c': s + g2.c + CASE x WHEN 'u' THEN 0 ELSE 999999 END, 'a': 'K' || g2.a}) AS h3
        FROM walked w JOIN (SELECT *, CASE fault WHEN 'truncated' THEN 5 WHEN 'blank' THEN 999999 WHEN 'duplicate' THEN 999999
                ELSE 0 END AS s FROM judged) j
            ON w.conv_id IS NOT DISTINCT FROM j.conv_id AND w.i = j.i) q) r),
best AS (SELECT conv_id, g0.c AS cost, g0.a AS audit FROM walked WHERE i = 0),
letters AS (
    SELECT conv_id, unnest(string_split(audit, '')) AS letter, generate_subscripts(string_split(audit, ''), 1) AS spot
    FROM best WHERE audit <> ''),
followed AS (
    SELECT *, count(*) FILTER (WHERE letter <> 'I') OVER w AS i, count(*) FILTER (WHERE letter <> 'D') OVER w AS place
    FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY spot ROWS UNBOUNDED PRECEDING)),
shown AS (
    SELECT f.conv_id, place, letter, CASE WHEN letter = 'I' THEN '' ELSE j.text END AS text, j.role, j.x,
        max(CASE WHEN place = 1 AND letter = 'K' AND j.x = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY f.conv_id) AS n_system
    FROM followed f LEFT JOIN judged j ON f.conv_id IS NOT DISTINCT FROM j.conv_id AND f.i = j.i
    WHERE letter <> 'D'),
texts AS (
    SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - n_system) % 2 = 1 THEN 'user' ELSE 'assistant' END
        || ':' || text, chr(10) ORDER BY place) AS repaired
    FROM shown GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
    coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
    coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON o.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN texts t ON o.conv_id IS NOT DISTINCT FROM t.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filters": OP1, "op4_chat_formatting": OP4, "op5_exact_dedup": OP5,
            "op8_line_dedup": OP8, "op9_substring_dedup": OP9,
            "op10_fingerprints": OP10, "op11_conversation_repair": OP11}
