"""DuckDB SQL for the operators that SQL can express; the others are tested against brute force."""

from pairloom.llm import importance, url_filter

#: CRC-32 in SQL: the table of 256 follows from the polynomial, a list of byte values is folded through it.
CRC_TABLE = """
    crc_table AS MATERIALIZED (
        SELECT list_transform(range(256), lambda n: list_reduce(
            [n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END
        )) AS steps
    )
"""


def crc_sql(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, beside ``crc_table``."""
    digits = f"hex(encode({text}))"
    values = f"list_transform(range(1, length({digits}), 2), lambda i: ('0x' || substr({digits}, i, 2))::BIGINT)"
    folded = f"list_reduce(list_concat([4294967295], {values}), lambda c, b: xor(c // 256, steps[xor(c % 256, b) + 1]))"
    return f"xor({folded}, 4294967295)"


def _url_filter() -> str:
    """The rules, the labelled table, each step of the regression in turn, and the verdicts."""
    m = url_filter
    a, b, c = m.FACTORS

    def buckets(text: str, kind: int) -> str:
        codes = f"list_transform(string_split({text}, ''), lambda x: unicode(x)::BIGINT)"
        return (
            f"list_transform(range(1, greatest(length({text}) - 1, 1)), "
            f"lambda i: ({codes}[i] * {a} + {codes}[i + 1] * {b} + {codes}[i + 2] * {c} + {kind}) % {m.BUCKETS})"
        )

    cases = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN ['{verdict}', '{h}{p}']"
        for verdict, h, p in sorted(m.RULES, key=lambda r: -len(r[1] + r[2]))
    )
    steps = ["w0 AS MATERIALIZED (SELECT unnest(range(%d)) AS bucket, 0::BIGINT AS w, 0::BIGINT AS move)" % (m.BUCKETS + 1)]
    for k in range(m.STEPS):
        steps.append(f"""
            e{k} AS MATERIALIZED (
                SELECT id, n, floor((1 / (1 + exp(-((bias + coalesce(total, 0) / greatest(n, 1)) / {m.UNIT}))) - blocked) * {m.UNIT} + 0.5)::BIGINT AS error
                FROM learn CROSS JOIN (SELECT w AS bias FROM w{k} WHERE bucket = {m.BUCKETS})
                LEFT JOIN (SELECT id, sum(w)::BIGINT AS total FROM long JOIN w{k} USING (bucket) GROUP BY id) USING (id)
            ),
            w{k + 1} AS MATERIALIZED (
                SELECT bucket, w - next AS w, next AS move FROM (
                    SELECT bucket, w, floor({m.MOMENTUM} * move + CASE WHEN bucket = {m.BUCKETS} THEN {m.BIAS_RATE} ELSE {m.RATE} END
                        * coalesce(total, 0) / greatest((SELECT count(*) FROM learn), 1))::BIGINT AS next
                    FROM w{k} LEFT JOIN (
                        SELECT bucket, sum(floor(error / n + 0.5))::BIGINT AS total FROM long JOIN e{k} USING (id) GROUP BY bucket
                        UNION ALL SELECT {m.BUCKETS}, sum(error)::BIGINT FROM e{k}
                    ) USING (bucket)
                )
            )""")
    return f"""
        WITH parts AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), '{m.LOWER.upper()}', '{m.LOWER}') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)
        ),
        ruled AS MATERIALIZED (
            SELECT *, CASE {cases} END AS r,
                   list_concat({buckets("('^' || host || '$')", 0)}, {buckets("(path || '$')", 1)}) AS grams
            FROM parts
        ),
        learn AS MATERIALIZED (
            SELECT row_number() OVER () AS id, grams, len(grams) AS n, blocked FROM (
                SELECT DISTINCT host, path, grams, (r[1] = 'block')::INT AS blocked FROM ruled WHERE r IS NOT NULL
                ORDER BY md5(host || path), host, path LIMIT {m.LABELLED_ROWS}
            )
        ),
        long AS MATERIALIZED (SELECT id, unnest(grams) AS bucket FROM learn),
        {",".join(steps)},
        final AS MATERIALIZED (SELECT list(w ORDER BY bucket) AS w FROM w{m.STEPS})
        SELECT page_id, host, path, r[2] AS rule,
               CASE WHEN r IS NOT NULL THEN r[1]
                    WHEN w[{m.BUCKETS + 1}] + coalesce(list_sum(list_transform(grams, lambda g: w[g + 1])), 0) / greatest(len(grams), 1) > 0 THEN 'block'
                    ELSE 'allow' END AS verdict
        FROM ruled CROSS JOIN final
    """


def _importance() -> str:
    m = importance
    return f"""
        WITH {CRC_TABLE},
        said AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
        lowered AS MATERIALIZED (
            SELECT row, 0 AS target, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM said
            UNION ALL
            SELECT row_number() OVER (), 1, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark
        ),
        words AS MATERIALIZED (
            SELECT row, target, unnest(regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM lowered
        ),
        hashed AS MATERIALIZED (
            SELECT word, {crc_sql("word")} % {m.BUCKETS} AS bucket FROM (SELECT DISTINCT word FROM words) CROSS JOIN crc_table
        ),
        counts AS (
            SELECT bucket, count(*) FILTER (target = 0)::DOUBLE AS s, count(*) FILTER (target = 1)::DOUBLE AS t
            FROM words JOIN hashed USING (word) GROUP BY bucket
        ),
        gain AS MATERIALIZED (
            SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM counts) + {m.BUCKETS}) / ((s + 1) * ((SELECT sum(t) FROM counts) + {m.BUCKETS}))))::BIGINT AS gain
            FROM counts
        ),
        weighed AS (
            SELECT row, count(*) AS n, floor(sum(gain) / count(*))::BIGINT AS weight
            FROM words JOIN hashed USING (word) JOIN gain USING (bucket) WHERE target = 0 GROUP BY row
        ),
        scored AS MATERIALIZED (
            SELECT row, doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{m.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
            FROM said LEFT JOIN weighed USING (row)
        ),
        ranked AS (
            SELECT row, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank, count(*) OVER () AS n
            FROM scored WHERE n_features >= {m.LEAST_WORDS}
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN rank <= n * {m.PERCENT} // 100 THEN rank END AS rank
        FROM scored LEFT JOIN ranked USING (row)
    """


_TRIE = f"""
    WITH {CRC_TABLE},
    turns AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn,
               md5(octet_length(encode(coalesce(role, '')))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS id
        FROM conversations WHERE conv_id IS NOT NULL
    ),
    own AS MATERIALIZED (
        SELECT conv_id, list(id ORDER BY turn NULLS FIRST, id) AS ids,
               list(octet_length(encode(text)) ORDER BY turn NULLS FIRST, id) AS sizes
        FROM turns GROUP BY conv_id
    ),
    headed AS (
        SELECT own.*, ({crc_sql("conv_id::VARCHAR")} % 9)::INT AS h, conv_id - conv_id % 5 AS first FROM own CROSS JOIN crc_table
    ),
    rebuilt AS MATERIALIZED (
        SELECT headed.conv_id, list_concat(coalesce(f.ids, [])[1:h], headed.ids[h + 1:]) AS ids,
               list_concat(coalesce(f.sizes, [])[1:h], headed.sizes[h + 1:]) AS sizes
        FROM headed LEFT JOIN own f ON headed.first = f.conv_id
    ),
    members AS MATERIALIZED (
        SELECT conv_id, d AS depth, list_aggregate(ids[1:d], 'string_agg', '') AS node, list_aggregate(ids[1:d - 1], 'string_agg', '') AS parent,
               d = len(ids) AS ends, coalesce(sizes[d], 0) AS size
        FROM (SELECT *, unnest(range(len(ids) + 1)) AS d FROM rebuilt)
    ),
    nodes AS MATERIALIZED (
        SELECT coalesce(node, '') AS node, depth, any_value(CASE WHEN depth > 0 THEN coalesce(parent, '') END) AS parent, min(conv_id) AS conv_id,
               count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved,
               sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
        FROM members GROUP BY coalesce(node, ''), depth
    ),
    subtrees AS (
        SELECT a.depth, a.node, sum(b.saved)::BIGINT AS saved_tokens,
               count(*) FILTER (b.depth = a.depth + 1) AS n_children,
               count(*) FILTER (NOT EXISTS (SELECT 1 FROM nodes c WHERE c.parent = b.node)) AS n_leaves
        FROM nodes a JOIN nodes b ON b.depth >= a.depth AND substr(b.node, 1, 32 * a.depth) = a.node
        GROUP BY a.depth, a.node
    )
    SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n_children, n_leaves, saved_tokens, n.ends_sha256
    FROM nodes n JOIN subtrees s USING (depth, node) LEFT JOIN nodes p ON n.parent = p.node
"""


ORACLES = {
    "op1_incremental_multi_index": """
        WITH codes AS (
            SELECT DISTINCT vec_id, list_transform(embedding, lambda v: coalesce(v > 0, false)) AS bits
            FROM embeddings WHERE len(embedding) = 64 AND vec_id IS NOT NULL
        ), pairs AS (
            SELECT q.vec_id, r.vec_id AS neighbor_id,
                   list_sum(list_transform(list_zip(q.bits, r.bits), lambda b: (b[1] <> b[2])::INT))::INT AS distance
            FROM codes q JOIN codes r ON q.vec_id % 20 = 0 AND q.vec_id <> r.vec_id
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbor_id)::INT AS rank FROM pairs
        )
        SELECT vec_id, rank, neighbor_id, distance FROM ranked WHERE rank <= 10
    """,
    "op3_zstd_archive": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
                   sha1(coalesce(html, '')) AS payload_digest
            FROM pages
        ), c AS (
            SELECT payload_digest, max(page_id) AS last FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN last IS NOT NULL AND page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to
        FROM p LEFT JOIN c USING (payload_digest)
    """,
    "op11_importance_resampling": _importance(),
    "op12_conversation_trie": _TRIE,
    "op13_url_regression": _url_filter(),
}
