"""DuckDB SQL for those corpus queries that SQL can express."""

#: The distinct 5-word shingles of the rows of a table, as (id, s).
SHINGLES = """
{name}_words AS (
    SELECT {id} AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
    FROM {table}
),
{name} AS (
    SELECT DISTINCT id, array_to_string(w[i : i + 4], ' ') AS s
    FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM {name}_words WHERE len(w) > 0)
)"""
DOCS = SHINGLES.format(name="doc", table="documents", id="doc_id")

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op3_near_duplicates"] = f"""
WITH RECURSIVE {DOCS},
sizes AS (SELECT id, count(*) AS n FROM doc GROUP BY id),
shared AS (SELECT a.id AS a, b.id AS b, count(*) AS n FROM doc a JOIN doc b ON a.s = b.s AND a.id < b.id GROUP BY a.id, b.id),
links AS (SELECT p.a, p.b FROM shared p JOIN sizes x ON x.id = p.a JOIN sizes y ON y.id = p.b WHERE 100 * p.n >= 75 * (x.n + y.n - p.n)),
sym AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a, b FROM sym UNION SELECT r.a, e.b FROM reach r JOIN sym e ON e.a = r.b)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(least(c.low, d.doc_id), d.doc_id) AS component_id,
    coalesce(least(c.low, d.doc_id), d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes s ON s.id = d.doc_id
LEFT JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) c ON c.a = d.doc_id
"""

ORACLE_SQL["op8_decontamination"] = f"""
WITH {DOCS}, {SHINGLES.format(name="item", table="benchmark", id="item_id")},
sizes AS (SELECT id, count(*) AS n FROM item GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, any_value(z.n) AS n_item, count(*) AS n_shared
FROM doc d JOIN item i ON i.s = d.s JOIN sizes z ON z.id = i.id
GROUP BY d.id, i.id HAVING 100 * count(*) >= 75 * any_value(z.n)
"""

#: Gap and match lengths of the pieces of a text, like the operator cuts it, in SQL.
_ASSIGN = """(?i:password|passwd|secret|token|api_?key)["\'']?\\x20*[:=]\\x20*["\'']?([A-Za-z0-9+/_.=-]+)"""
_KINDS = [(0, "assign", _ASSIGN, 3), (1, "access", "AKIA[A-Z0-9]+", 2), (2, "hex", "[0-9a-f]+", 2), (3, "key", "[A-Za-z0-9+/_=-]+", 2)]
_PIECES = " UNION ALL ".join(
    f"""SELECT doc_id, source, t, {k} AS k, '{name}' AS kind, unnest(range(1, len(g) + 1)) AS i, unnest(g) AS gap, unnest(m) AS m, unnest(v) AS v
    FROM (SELECT doc_id, source, sha256(coalesce(text, '')) AS t, {', '.join(f"regexp_extract_all(coalesce(text, ''), '(?s)(.*?)({pattern})', {n}) AS {c}" for c, n in (("g", 1), ("m", 2), ("v", group)))} FROM documents)"""
    for k, name, pattern, group in _KINDS
)

ORACLE_SQL["op7_secret_scan"] = f"""
WITH pieces AS ({_PIECES}),
placed AS (SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, k ORDER BY i) AS e FROM pieces),
spans AS (
    SELECT doc_id, source, t, k, v, kind || ':' || (e - length(m)) || ':' || e AS said, e - length(m) AS s FROM placed
    WHERE (k = 0 AND length(v) >= 6) OR (k = 1 AND length(m) >= 20) OR (k = 2 AND length(m) >= 24)
        OR (k = 3 AND length(m) >= 32 AND regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]'))
),
texts AS (SELECT v, t, min(source) AS owner, min(doc_id::VARCHAR) AS repository FROM spans GROUP BY v, t),
owners AS (SELECT v, owner, count(*) AS n FROM (SELECT DISTINCT v, owner, repository FROM texts) GROUP BY v, owner),
judged AS (
    SELECT s.*, (c.n >= 3 AND 100 * (c.places - c.main) >= 10 * c.places) OR len(list_distinct(string_split(s.v, ''))) < 5 AS example
    FROM spans s JOIN (SELECT v, count(*) AS n, sum(n) AS places, max(n) AS main FROM owners GROUP BY v) c ON c.v = s.v
),
by_doc AS (
    SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
        count(*) FILTER (NOT example) AS n_live, count(*) FILTER (example) AS n_example,
        string_agg(said, ',' ORDER BY s, k) AS spans, coalesce(string_agg(said, ',' ORDER BY s, k) FILTER (k < 3), '') AS base
    FROM judged WHERE k < 3 OR NOT example GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM documents d LEFT JOIN by_doc b ON b.doc_id = d.doc_id
"""

_LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE_SQL["op5_url_filter"] = f"""
WITH cut AS (SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, html, regexp_extract(rest, '^[^?#]*') AS kept, {_LOWERED.format("regexp_extract(rest, '^[^/?#]*')")} AS host FROM cut),
urls AS (SELECT page_id, host, substr(kept, length(host) + 1) AS path FROM parts),
said AS (
    SELECT host, coalesce(regexp_matches(regexp_replace({_LOWERED.format("html")}, '(?s)<script.*?</script>|<[^>]*>', ' ', 'g'),
        '(^|[^a-z0-9])(ads|track|tracker|tracking|spam|casino|adult|pills|bets|porn|malware|phishing)([^a-z0-9]|$)'), false) AS s
    FROM parts WHERE host <> ''
),
listed AS (SELECT host FROM said GROUP BY host HAVING 2 * count(*) FILTER (s) >= count(*)),
rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
best AS (
    SELECT u.page_id, arg_max(r.h || r.p, length(r.h || r.p)) AS rule, arg_max(r.verdict, length(r.h || r.p)) AS verdict
    FROM urls u JOIN rules r ON (u.host = r.h OR ends_with(u.host, '.' || r.h)) AND starts_with(u.path, r.p) GROUP BY u.page_id
)
SELECT u.page_id, u.host, u.path, b.rule,
    coalesce(b.verdict, CASE WHEN u.host IN (SELECT host FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM urls u LEFT JOIN best b ON b.page_id = u.page_id
"""


def _vector_code_rounds(rounds: int) -> str:
    """CTEs of the codebooks k0 to k{rounds}, and of the assignments to each, a0 to a{rounds}."""
    out = []
    for k in range(rounds + 1):
        if k:
            out.append(f"""
m{k} AS (SELECT a.part, a.entry, x.pos, sum(x.x) AS s, count(*) AS n FROM a{k - 1} a JOIN x USING (vec_id, part) GROUP BY ALL),
k{k} AS (
    SELECT e.part, e.entry, e.pos, CASE WHEN m.n IS NULL THEN e.x ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS x
    FROM k{k - 1} e LEFT JOIN m{k} m USING (part, entry, pos)
)""")
        out.append(f"""
d{k} AS (SELECT x.vec_id, part, e.entry, sum((x.x - e.x) * (x.x - e.x)) AS d FROM x JOIN k{k} e USING (part, pos) GROUP BY ALL),
a{k} AS (SELECT vec_id, part, min(entry) AS entry, any_value(d) AS d FROM d{k} JOIN (SELECT vec_id, part, min(d) AS d FROM d{k} GROUP BY ALL) USING (vec_id, part, d) GROUP BY vec_id, part)""")
    return ",".join(out)


ORACLE_SQL["op11_vector_codes"] = f"""
WITH kept AS (
    SELECT vec_id, label, embedding AS e, len(embedding) // 4 AS w FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
),
x AS (
    SELECT vec_id, (i - 1) // w AS part, (i - 1) % w AS pos, CAST(floor(1024 * CAST(e[i] AS DOUBLE)) AS HUGEINT) AS x
    FROM (SELECT *, unnest(range(1, len(e) + 1)) AS i FROM kept)
),
starts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT 256),
k0 AS (SELECT part, entry, pos, x FROM x JOIN starts USING (vec_id)),{_vector_code_rounds(4)},
codes AS (SELECT vec_id, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, sum(d) AS error FROM a4 GROUP BY vec_id)
SELECT vec_id, code, CAST(error AS BIGINT) AS error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
    (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM k4) AS codebooks_sha256
FROM kept JOIN codes USING (vec_id)
"""

_GRAMS = " UNION ALL ".join(f"SELECT lang, {k} AS k, w[i : i + {k - 1}] AS p FROM (SELECT lang, w, unnest(range(1, len(w) - {k} + 2)) AS i FROM pieces WHERE len(w) >= {k})" for k in range(1, 5))
_LONGER = " UNION ALL ".join(f"SELECT lang, f, w[i : i + {s - 1}] AS p FROM (SELECT lang, f, p AS w, unnest(range(1, k - {s} + 2)) AS i FROM found WHERE k > {s})" for s in (2, 3))

ORACLE_SQL["op12_collocations"] = f"""
WITH pieces AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents
    )
),
totals AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
found AS (SELECT lang, k, p, count(*) AS f FROM ({_GRAMS}) GROUP BY ALL HAVING count(*) >= 30),
cuts AS (SELECT lang, p, f, unnest(range(1, k)) AS c FROM found WHERE k > 1),
scored AS (
    SELECT x.lang, x.p, x.f AS a, x.c, y.f AS l, z.f AS r, (2000000 * x.f::HUGEINT) // (y.f::HUGEINT + z.f) AS score
    FROM cuts x JOIN found y ON y.lang = x.lang AND y.p = x.p[1 : x.c] JOIN found z ON z.lang = x.lang AND z.p = x.p[x.c + 1 : len(x.p)]
),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, c) = 1),
longer AS (SELECT lang, p, max(f) AS f FROM ({_LONGER}) GROUP BY ALL),
left_over AS (SELECT b.* FROM best b LEFT JOIN longer g USING (lang, p) WHERE g.f IS NULL OR 100 * g.f < 80 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank FROM left_over)
SELECT lang, rank, array_to_string(p, ' ') AS phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
