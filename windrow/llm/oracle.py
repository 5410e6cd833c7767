"""The same results in SQL, for the queries that SQL can express."""

ORACLE: dict[str, str] = {
    "op2_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same
                   AND row_number() OVER (PARTITION BY t, doc_id ORDER BY doc_id) = 1 AS kept,
               sha256(t) AS text_sha256
        FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
              FROM documents)
        WINDOW same AS (PARTITION BY t)
    """,
    "op8_mixing": r"""
        WITH d AS (SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS k, coalesce(text, '') AS t,
                          len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w,
                     3 * sum(size)::BIGINT AS most FROM d GROUP BY source),
        r AS (SELECT *, sum(source_size) OVER ()::BIGINT - coalesce(sum(most) OVER before, 0)::BIGINT AS rest,
                     sum(w) OVER ()::BIGINT - coalesce(sum(w) OVER before, 0)::BIGINT AS rest_w
              FROM s WINDOW before AS (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        l AS (SELECT rest::DOUBLE / rest_w AS level FROM r WHERE rest * w <= most * rest_w ORDER BY most / w, source NULLS LAST LIMIT 1),
        t AS (SELECT source, source_size, CASE WHEN most / w <= level THEN most::DOUBLE ELSE level * w END AS target FROM r, l),
        p AS (SELECT d.*, source_size, target, floor(target)::BIGINT AS budget,
                     coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, d.doc_id, md5(t)
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        q AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS passes FROM p)
        SELECT doc_id, size, source_size, target,
               (passes * size + greatest(0, least(size, budget - passes * source_size - before)))::BIGINT AS taken FROM q
    """,
    "op11_search": r"""
        WITH docs AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
                          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
        held AS (SELECT doc_id, r, len(terms)::BIGINT AS n, unnest(terms) AS term FROM docs),
        tf AS (SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*)::BIGINT AS tf FROM held GROUP BY r, term),
        whole AS (SELECT count(*)::BIGINT AS nn, sum(len(terms))::BIGINT AS ll FROM docs WHERE len(terms) > 0),
        weights AS (SELECT term, floor(1000 * ln((2 * any_value(nn) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
                    FROM tf, whole GROUP BY term),
        asked AS (SELECT item_id, unnest(regexp_extract_all(
                      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)),
        items AS (SELECT item_id, term, count(*)::BIGINT AS times FROM asked GROUP BY item_id, term),
        scored AS (SELECT item_id, r, any_value(doc_id) AS doc_id,
                          sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // ll))))::BIGINT AS score
                   FROM items JOIN tf USING (term) JOIN weights USING (term), whole GROUP BY item_id, r),
        placed AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
                   FROM scored WHERE score > 0)
        SELECT * FROM placed WHERE rank <= 20
    """,
    "op12_trie": r"""
        WITH said AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
        own AS (SELECT c, role, text, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) - 1 AS pos
                FROM said),
        -- the CRC of the decimal id, bit by bit
        convs AS (SELECT c, c - c % 100 AS base, xor(4294967295, list_reduce(
                      list_prepend(4294967295::BIGINT, list_transform(range(1, len(s) + 1), lambda i: ascii(s[i])::BIGINT)),
                      lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                                               lambda x, z: xor(x >> 1, 3988292384 * (x & 1))))) % 6 AS h
                  FROM (SELECT DISTINCT c, c::VARCHAR AS s FROM own)),
        turns AS (SELECT v.c, o.pos AS place, 0 AS part, role, text FROM convs v JOIN own o ON o.c = v.base AND o.pos < v.h
                  UNION ALL SELECT v.c, o.pos, 1, role, text FROM convs v JOIN own o ON o.c = v.c AND o.pos >= v.h),
        steps AS (SELECT c, row_number() OVER along AS d, len(text)::BIGINT AS n,
                         sha256(string_agg(sha256(strlen(role) || ':' || role || text), ',') OVER (along ROWS UNBOUNDED PRECEDING)) AS node
                  FROM turns WINDOW along AS (PARTITION BY c ORDER BY part, place)),
        paths AS (SELECT c, 0 AS d, 0 AS n, '' AS node FROM convs UNION ALL SELECT c, d, n, node FROM steps),
        ended AS (SELECT c, max(d) AS d FROM paths GROUP BY c),
        nodes AS (SELECT node, p.d, min(p.c) AS conv_id, count(*) AS n_convs, any_value(n) AS n,
                         sha256(coalesce(string_agg(p.c::VARCHAR, ',' ORDER BY p.c) FILTER (WHERE p.d = e.d), '')) AS ends
                  FROM paths p JOIN ended e ON p.c = e.c GROUP BY node, p.d),
        over AS (SELECT b.node, a.node AS above, b.d - a.d AS gap FROM nodes b JOIN paths a ON a.c = b.conv_id AND a.d <= b.d),
        kids AS (SELECT above AS node, count(*) AS n_children FROM over WHERE gap = 1 GROUP BY above),
        sums AS (SELECT above AS node, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves, sum((n_convs - 1) * n) AS saved
                 FROM over JOIN nodes USING (node) LEFT JOIN kids USING (node) GROUP BY above)
        SELECT x.conv_id, x.d::BIGINT AS depth, up.conv_id AS parent_conv_id, x.n_convs::BIGINT AS n_convs,
               coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, x.ends AS ends_sha256
        FROM nodes x JOIN sums s ON x.node = s.node LEFT JOIN kids k ON x.node = k.node
        LEFT JOIN over o ON o.node = x.node AND o.gap = 1 LEFT JOIN nodes up ON up.node = o.above
    """,
}
