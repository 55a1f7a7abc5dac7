"""SQL that has to give the rows of a registered query."""

SQL: dict[str, str] = {
    # Five bits of the SHA-1 at a time: five hexadecimal digits are four base-32 characters.
    "op7_warc_archives": """
        WITH hashed AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex
            FROM pages),
        found AS (
            SELECT page_id, payload_bytes, max(page_id) OVER (PARTITION BY hex) AS largest,
                array_to_string(list_transform(range(0, 32), lambda i: substr(
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                    ((CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS INT), 5) AS INT)
                        >> CAST(15 - 5 * (i % 4) AS INT)) & 31) + 1, 1)), '') AS payload_digest
            FROM hashed)
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id < largest THEN largest END AS refers_to
        FROM found""",
    "op8_minhash_containment": r"""
        WITH texts AS (
            SELECT 'd' AS kind, doc_id AS id, text FROM documents
            UNION ALL SELECT 'i', item_id, text FROM benchmark),
        split AS (
            SELECT kind, id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM texts WHERE text IS NOT NULL),
        shingles AS (
            SELECT DISTINCT kind, id, unnest(CASE WHEN len(w) >= 5
                THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
            FROM split),
        sizes AS (SELECT id, count(*) AS n FROM shingles WHERE kind = 'i' GROUP BY id),
        shared AS (
            SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared
            FROM shingles d JOIN shingles i ON d.shingle = i.shingle AND d.kind = 'd' AND i.kind = 'i'
            GROUP BY ALL)
        SELECT doc_id, item_id, n_shared, n AS n_shingles, n_shared / n AS containment
        FROM shared JOIN sizes ON id = item_id WHERE n_shared >= ceil(0.8 * n - 1e-9)""",
    "op9_exact_dedup": r"""
        WITH rows AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents),
        ranked AS (
            SELECT *, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place,
                count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM rows
            WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id))
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked""",
    # Every row is three steps of a fold: read it, then insert a user's turn, then an assistant's, where that
    # is the cheaper way to a state. States: e nothing yet, s system, u user, a assistant; 10^9 is out of reach.
    "op11_glr_repair": r"""
        WITH named AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
            FROM conversations),
        cases AS (
            SELECT *, xor(4294967295, list_reduce(
                list_transform(range(1, length(name) + 1), lambda i: CAST(ord(name[i]) AS BIGINT)),
                lambda c, b: list_reduce(range(0, 8),
                    lambda y, k: xor(y >> 1, CASE WHEN y & 1 = 1 THEN 3988292384 ELSE 0 END), xor(c, b)),
                CAST(4294967295 AS BIGINT))) % 20 AS c
            FROM named),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN c = 4 THEN 'user' ELSE role END AS role,
                CASE c WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM cases JOIN (VALUES (0), (1)) AS copies(copy) ON copy = 0 OR c = 3
            WHERE c <> 0),
        seen AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth,
                regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS final,
                sha256(length(role) || ':' || role || ':' || text) AS digest
            FROM damaged),
        marked AS (
            SELECT *, substr(role, 1, 1) AS initial, CASE WHEN final = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                WHEN final NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
                lead(substr(role, 1, 1)) OVER w AS following, row_number() OVER w AS place
            FROM seen
            WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, digest, nth)),
        grouped AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                count(*) FILTER (fault = 'truncated') AS truncated,
                count(*) FILTER (following IS NOT NULL AND initial || following NOT IN ('su', 'ua', 'au')) AS illegal,
                list({'i': initial, 'role': role, 'text': text, 'must': fault IN ('blank', 'duplicate'),
                    'more': CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END} ORDER BY place) AS rows
            FROM marked GROUP BY conv_id),
        steps AS (
            SELECT * EXCLUDE (rows), flatten(list_transform(rows, lambda r: [
                {'k': 0, 'i': r.i, 'role': r.role, 'text': r.text, 'must': r.must, 'more': r.more},
                {'k': 1, 'i': '', 'role': '', 'text': '', 'must': false, 'more': 0},
                {'k': 2, 'i': '', 'role': '', 'text': '', 'must': false, 'more': 0}])) AS rows
            FROM grouped),
        parsed AS (
            SELECT * EXCLUDE (rows), list_reduce(
                list_concat([{'k': 1, 'i': '', 'role': '', 'text': '', 'must': false, 'more': 0},
                    {'k': 2, 'i': '', 'role': '', 'text': '', 'must': false, 'more': 0}], rows),
                lambda z, r: {
                    'e': CASE WHEN r.k > 0 THEN z.e ELSE {'c': z.e.c + 3, 'a': z.e.a || 'D', 't': z.e.t} END,
                    's': CASE WHEN r.k > 0 THEN z.s ELSE list_sort([
                        {'c': z.s.c + 3, 'a': z.s.a || 'D', 't': z.s.t},
                        {'c': CASE WHEN r.i = 's' AND NOT r.must THEN z.e.c + r.more ELSE 1000000000 END,
                            'a': z.e.a || 'K', 't': z.e.t || chr(10) || r.role || ':' || r.text}])[1] END,
                    'u': CASE r.k WHEN 2 THEN z.u WHEN 1 THEN list_sort([z.u,
                        {'c': z.e.c + 2, 'a': z.e.a || 'I', 't': z.e.t || chr(10) || 'user:'},
                        {'c': z.s.c + 2, 'a': z.s.a || 'I', 't': z.s.t || chr(10) || 'user:'},
                        {'c': z.a.c + 2, 'a': z.a.a || 'I', 't': z.a.t || chr(10) || 'user:'}])[1]
                    ELSE list_sort(list_concat([{'c': z.u.c + 3, 'a': z.u.a || 'D', 't': z.u.t}],
                        list_transform([z.e, z.s, z.a], lambda x: {
                            'c': CASE WHEN r.i = 'u' AND NOT r.must THEN x.c + r.more ELSE 1000000000 END,
                            'a': x.a || 'K', 't': x.t || chr(10) || r.role || ':' || r.text}),
                        list_transform([z.e, z.s, z.a], lambda x: {
                            'c': CASE WHEN NOT r.must THEN x.c + 2 + r.more ELSE 1000000000 END,
                            'a': x.a || 'R', 't': x.t || chr(10) || 'user:' || r.text})))[1] END,
                    'a': CASE r.k WHEN 1 THEN z.a WHEN 2 THEN list_sort([z.a,
                        {'c': z.u.c + 2, 'a': z.u.a || 'I', 't': z.u.t || chr(10) || 'assistant:'}])[1]
                    ELSE list_sort([{'c': z.a.c + 3, 'a': z.a.a || 'D', 't': z.a.t},
                        {'c': CASE WHEN r.i = 'a' AND NOT r.must THEN z.u.c + r.more ELSE 1000000000 END,
                            'a': z.u.a || 'K', 't': z.u.t || chr(10) || r.role || ':' || r.text},
                        {'c': CASE WHEN NOT r.must THEN z.u.c + 2 + r.more ELSE 1000000000 END,
                            'a': z.u.a || 'R', 't': z.u.t || chr(10) || 'assistant:' || r.text}])[1] END},
                {'e': {'c': CAST(0 AS BIGINT), 'a': '', 't': ''}, 's': {'c': CAST(1000000000 AS BIGINT), 'a': '', 't': ''},
                    'u': {'c': CAST(1000000000 AS BIGINT), 'a': '', 't': ''},
                    'a': {'c': CAST(1000000000 AS BIGINT), 'a': '', 't': ''}}) AS z
            FROM steps),
        chosen AS (SELECT * EXCLUDE (z), list_sort([z.e, z.a])[1] AS best FROM parsed)
        SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
            coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
            coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) AS ids
        LEFT JOIN chosen ON ids.conv_id IS NOT DISTINCT FROM chosen.conv_id""",
}
