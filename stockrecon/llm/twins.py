"""DuckDB SQL with the same results as the queries that SQL can express."""

from stockrecon.llm.url_filter import PUBLIC_SUFFIXES

_LOWER = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

_ESCAPED = (
    r"replace(replace(replace(replace(body, '\', '\\'), '##', '#\#'), "
    r"'</turn>', '<\/turn>'), '<part/>', '<\part/>')"
)


def _role(role: str) -> str:
    for plain, safe in (("%", "%25"), (":", "%3A"), ("<", "%3C"), ("#", "%23")):
        role = f"replace({role}, '{plain}', '{safe}')"
    return role


_TURNS = r"""
    t AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS body
        FROM conversations
        UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'),
                         (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
"""

_RULED = """
    u AS (
        SELECT page_id,
            coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
            coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
        FROM pages),
    j AS (
        SELECT *, CASE
            WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%'
                THEN 'example.org/es/'
            WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%'
                THEN 'example.org/en/1'
            WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
            WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
            WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule
        FROM u),
    g AS (
        SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 1
                       WHEN rule IS NOT NULL THEN 0 END AS good FROM j),
    h AS (
        SELECT host, count(good) AS n, coalesce(sum(good), 0) AS good,
            CASE WHEN two IN TWO_LABELS
                 THEN array_to_string(list_slice(string_split(name, '.'), -3, -1), '.')
                 ELSE two END AS domain,
            CASE WHEN two IN TWO_LABELS THEN two ELSE string_split(name, '.')[-1] END AS suffix
        FROM (SELECT *, regexp_replace(host, ':[0-9]*$', '') AS name,
                array_to_string(list_slice(string_split(
                    regexp_replace(host, ':[0-9]*$', ''), '.'), -2, -1), '.') AS two
              FROM g) GROUP BY host, name, two),
    d AS (SELECT domain, suffix, sum(n) AS n, sum(good) AS good FROM h GROUP BY ALL),
    s AS (SELECT suffix, sum(n) AS n, sum(good) AS good FROM d GROUP BY ALL),
    w AS (SELECT (coalesce(sum(good), 0) + 1) / (coalesce(sum(n), 0) + 2) AS m,
                 coalesce(sum(n), 0) AS above_n FROM s),
""".replace("TWO_LABELS", str(PUBLIC_SUFFIXES))


def _strength(groups: str) -> str:
    """Pages that a prior is worth: moments of rows n, good, m of one level."""
    return f"""
        (SELECT 1 / least(greatest(coalesce(CASE WHEN free > 0
                    THEN (spread - chance * (groups - 1)) / (chance * free) END, 0.999),
                0.001), 0.999) - 1
         FROM (SELECT sum(n * (good / n - m) * (good / n - m)) AS spread,
                      sum(n * m * (1 - m)) / sum(n) AS chance, count(*) AS groups,
                      sum(n) - sum(CAST(n * n AS DOUBLE)) / sum(n) - (count(*) - 1) AS free
               FROM {groups} WHERE n > 0))
    """


def _level(name: str, groups: str, columns: str) -> str:
    return f"""
    {name} AS (
        SELECT {columns}, n, good, (good + k * m) / (n + k) AS mean, k
        FROM (SELECT *, least({_strength(groups)}, above_n + 2) AS k FROM {groups}))
    """


TWINS = {
    "op1_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256, {_LOWER} AS body FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY body)
    """,
    "op5_chat_format": f"""
        WITH {_TURNS},
        m AS (
            SELECT *, {_ESCAPED} AS safe, lag(role) OVER w AS before, lead(role) OVER w AS after
            FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, body))
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || body || chr(10), '' ORDER BY turn, role, body))
                AS turns_sha256,
            length(coalesce(string_agg(CASE WHEN role = 'assistant' THEN body END, ''
                ORDER BY turn, role, body), '')) AS loss_chars,
            sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN body END, ''
                ORDER BY turn, role, body), '')) AS loss_sha256,
            CAST(sum(length(safe)
                + CASE WHEN before = role THEN 7 ELSE 6 + length({_role('role')}) END
                + CASE WHEN after = role THEN 0 ELSE 8 END) AS BIGINT) AS formatted_chars
        FROM m GROUP BY conv_id
    """,
    "op6_url_filter": f"""
        WITH {_RULED}
        s0 AS (SELECT s.*, w.m, w.above_n FROM s, w),
        {_level("s1", "s0", "suffix")},
        d0 AS (SELECT d.*, s1.mean AS m, s1.n AS above_n FROM d JOIN s1 USING (suffix)),
        {_level("d1", "d0", "domain")},
        h0 AS (SELECT h.*, d1.mean AS m, d1.n AS above_n FROM h JOIN d1 USING (domain)),
        {_level("h1", "h0", "host")},
        b AS (SELECT host, mean + 1.645 * sqrt(mean * (1 - mean) / (n + k + 1)) AS upper FROM h1)
        SELECT page_id, host, path, rule,
            CASE WHEN good = 1 THEN 'allow' WHEN good = 0 OR upper < 0.5 THEN 'block'
                 ELSE 'allow' END AS verdict
        FROM g JOIN b USING (host)
    """,
    "op7_line_dedup": r"""
        WITH r AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text
                   FROM documents),
        l AS (
            SELECT rid, doc_id, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM r),
        k AS (
            SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12)
                || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM l),
        f AS (
            SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20
            GROUP BY key HAVING count(DISTINCT rid) >= 3)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (last <> doc_id) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
                FILTER (last IS NULL OR doc_id IS NULL OR last = doc_id), '')) AS kept_sha256
        FROM k LEFT JOIN f USING (key) GROUP BY rid, doc_id
    """,
    "op10_top_k": """
        WITH v AS (
            SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id
            ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM s QUALIFY rank <= 10
    """,
    "op12_lexical": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
        c AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(len(terms)) AS BIGINT) AS big_l
              FROM d WHERE len(terms) > 0),
        q AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        t AS (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d),
        f AS (SELECT doc_id, n, term, count(*) AS tf FROM t
              WHERE term IN (SELECT term FROM q) GROUP BY ALL),
        w AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
              FROM f, c GROUP BY term, big_n),
        s AS (
            SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf)
                // (1000 * tf + 8 * (10 + (90 * n * big_n) // big_l)))) AS BIGINT) AS score
            FROM q JOIN f USING (term) JOIN w USING (term), c GROUP BY item_id, doc_id)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id
            ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM s WHERE score > 0 QUALIFY rank <= 10
    """,
}
