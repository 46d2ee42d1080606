"""DuckDB statements for the corpus queries that SQL can express."""

from __future__ import annotations

import re

from shelfmark.llm.urls import GLOBS, HOST_RULES


def _glob_regex(glob: str) -> str:
    parts = re.split(r"(\*\*|\*|\?)", glob)
    return "".join({"**": ".*", "*": "[^/]*", "?": "[^/]"}.get(p) or re.escape(p) for p in parts if p)


def _urls() -> str:
    rules = sorted(HOST_RULES, key=lambda r: -len(r.text))

    def fits(text: str) -> str:
        host, _, prefix = text.partition("/")
        return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{prefix}'))"

    rule = "CASE " + " ".join(f"WHEN {fits(r.text)} THEN '{r.text}'" for r in rules) + " END"
    verdict = "CASE rule " + " ".join(f"WHEN '{r.text}' THEN '{r.verdict}'" for r in rules)
    glob = "CASE " + " ".join(
        f"WHEN regexp_full_match(host || path, '{_glob_regex(g.pattern)}', 's') THEN '{g.pattern}'" for g in GLOBS) + " END"
    by_glob = "CASE \"glob\" " + " ".join(f"WHEN '{g.pattern}' THEN '{g.verdict}'" for g in GLOBS) + " ELSE 'allow' END"
    return f"""
        WITH a AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
        b AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
        c AS (SELECT *, {rule} AS rule, {glob} AS "glob" FROM b)
        SELECT page_id, host, path, rule, {verdict} ELSE {by_glob} END AS verdict, "glob" FROM c"""


def _revisits() -> str:
    fields = {
        "cache-control": "'max-age=120'", "content-type": "'text/html'", "date": "CAST(v.t AS VARCHAR)",
        "etag": "coalesce(v.etag, r.etag)", "last-modified": "coalesce(v.modified, r.modified)", "server": "'origin'",
    }
    lines = ", ".join(f"'{name}: ' || {value}" for name, value in fields.items())
    tag = "'\"' || substr(digest, 1, 16) || '\"'"
    return f"""
        WITH a AS (SELECT page_id AS p, url, coalesce(html, '') AS html,
            regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '#.*$', '', 's') AS rest FROM pages),
        b AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), '^www\\.', ''), ':(80|443)$', '') AS host,
            regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
            list_sort([x FOR x IN string_split(regexp_extract(rest, '^[^?]*\\?(.*)$', 1, 's'), '&')
                IF x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref)=')]) AS query FROM a),
        c AS (SELECT *, host || path || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END AS canonical_url FROM b),
        ver AS (SELECT c.*, k, sha256(html || CASE WHEN k > 0 THEN '#' || k ELSE '' END) AS digest FROM c, range(3) n(k) WHERE k <= p % 3),
        r AS (SELECT 10 * p + k AS id, canonical_url, 60 * p + CASE k WHEN 0 THEN 0 WHEN 1 THEN 40000 ELSE 130000 END AS t, digest,
            CASE WHEN p % 4 <> 3 THEN {tag} END AS etag, CASE WHEN p % 6 <> 5 THEN 'day-' || (p // 1440 + k) END AS modified FROM ver),
        at_times AS (SELECT p, 5 AS n, 86400 * (p % 3 + 1) AS later, p % 3 AS k FROM c UNION ALL
            SELECT p, 6, 60000, 1 FROM c WHERE p % 3 > 0 UNION ALL SELECT p, 7, -30, 0 FROM c WHERE p % 11 = 0),
        v AS (SELECT 10 * p + n AS id, canonical_url, 60 * p + later AS t,
            CASE WHEN p % 10 = 7 THEN '"stale"' WHEN p % 10 < 7 THEN 'W/' || {tag} END AS etag,
            CASE WHEN p % 7 < 4 THEN 'day-' || (p // 1440 + k) WHEN p % 7 = 4 THEN 'day-x' END AS modified FROM ver JOIN at_times USING (p, k)),
        j AS (SELECT v.id AS record_id, v.canonical_url, v.t AS captured_at, r.id AS response_id, r.t AS response_at, r.digest,
            CASE WHEN r.id IS NULL THEN 'no_response'
                WHEN v.etag IS NOT NULL AND r.etag IS NOT NULL THEN
                    CASE WHEN regexp_replace(v.etag, '^W/', '') = r.etag THEN 'resolved' ELSE 'etag_mismatch' END
                WHEN v.modified IS NOT NULL AND r.modified IS NOT NULL THEN
                    CASE WHEN v.modified = r.modified THEN 'resolved' ELSE 'modified' END
                ELSE 'unverifiable' END AS status,
            concat_ws(chr(10), {lines}) AS lines
            FROM v ASOF LEFT JOIN r ON v.canonical_url = r.canonical_url AND v.t > r.t)
        SELECT record_id, canonical_url, captured_at, response_id, response_at, status,
            CASE WHEN status = 'resolved' THEN digest END AS digest, CASE WHEN status = 'resolved' THEN lines END AS headers FROM j"""


def _divergence() -> str:
    p = "1 + (1000000000::HUGEINT * ({count} + 5)) // ({total} + 5 * {terms})"
    own, lang = p.format(count="c.n", total="g.total", terms="g.terms"), p.format(count="c.lang_n", total="g.lang_total", terms="g.terms")
    a, b = (p.format(count=f"coalesce({x}c.n, 0)", total=f"{x}.total", terms="a.terms") for x in "ab")
    return f"""
        WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
        w AS (SELECT id, lang, source, unnest(terms) AS term FROM d),
        k AS (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
        c AS (SELECT lang, source, term, count(*) AS n, any_value(lang_n) AS lang_n FROM w JOIN k USING (lang, term)
              GROUP BY lang, source, term),
        g AS (SELECT s.lang, s.source, coalesce(t.total, 0) AS total, coalesce(l.total, 0) AS lang_total, coalesce(l.terms, 0) AS terms
              FROM (SELECT DISTINCT lang, source FROM d) s
              LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) t ON s.lang = t.lang AND s.source = t.source
              LEFT JOIN (SELECT lang, sum(lang_n) AS total, count(*) AS terms FROM k GROUP BY lang) l ON s.lang = l.lang),
        pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
                 coalesce(sum(CASE WHEN k.term IS NOT NULL THEN abs(({a}) - ({b})) END), 0) AS value
                 FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN k ON k.lang = a.lang
                 LEFT JOIN c ac ON ac.lang = a.lang AND ac.source = a.source AND ac.term = k.term
                 LEFT JOIN c bc ON bc.lang = a.lang AND bc.source = b.source AND bc.term = k.term GROUP BY ALL),
        term AS (SELECT c.lang, c.source, 'term' AS part, c.term AS item, ({own}) - ({lang}) AS value
                 FROM c JOIN g ON c.lang = g.lang AND c.source = g.source),
        r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
              FROM (SELECT * FROM pair UNION ALL SELECT * FROM term WHERE value > 0))
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 50"""


def _merkle() -> str:
    def part(column: str) -> str:
        return f"coalesce(octet_length(encode(CAST({column} AS VARCHAR))) || ':' || CAST({column} AS VARCHAR), '-')"

    def leaf(n_chars: str) -> str:
        return "sha256(" + " || ".join(part(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"

    # CRC-32 from its definition, digit by digit of the decimal doc_id: each bit shifts, and subtracts the polynomial where a 1 falls out.
    bit = "CASE WHEN {x} % 2 = 1 THEN xor({x} // 2, 3988292384) ELSE {x} // 2 END"
    crc = ("xor(list_reduce(list_prepend(4294967295::BIGINT, flatten([[CAST(ascii(ch) + 1000 AS BIGINT), 0, 0, 0, 0, 0, 0, 0] "
           "FOR ch IN string_split(CAST(doc_id AS VARCHAR), '')])), lambda x, y: CASE WHEN y >= 1000 THEN "
           + bit.format(x="xor(x, y - 1000)") + " ELSE " + bit.format(x="x") + " END), 4294967295)")
    # A tree per lang, then the tree of their roots: levels of both by recursion, a node's sibling being the one of index XOR 1.
    levels = """
        {name} AS (SELECT tree, 0 AS level, idx, digest FROM {start}
            UNION ALL
            SELECT tree, level + 1, idx // 2, sha256(digest || coalesce(next, '')) FROM
                (SELECT *, lead(digest) OVER (PARTITION BY tree ORDER BY idx) AS next, count(*) OVER (PARTITION BY tree) AS n FROM {name})
            WHERE n > 1 AND idx % 2 = 0)"""
    return f"""
        WITH RECURSIVE l AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, {leaf('n_chars')} AS leaf,
            CASE WHEN {crc} % 7 = 0 THEN {leaf('(n_chars + 1)')} ELSE {leaf('n_chars')} END AS used FROM documents),
        leaves AS (SELECT *, leaf AS digest, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM l),
        {levels.format(name='low', start='leaves')},
        ends_of AS (SELECT * FROM low QUALIFY level = max(level) OVER (PARTITION BY tree)),
        subroots AS (SELECT tree AS lang, 0 AS tree, digest, row_number() OVER (ORDER BY encode(tree)) - 1 AS idx, level AS height FROM ends_of),
        {levels.format(name='high', start='subroots')},
        top AS (SELECT digest AS root, level AS high FROM high ORDER BY level DESC LIMIT 1),
        spots AS (SELECT v.doc_id, v.leaf, v.used, v.tree, v.idx, s.idx AS place, s.digest AS subroot, s.height, t.root, t.high
            FROM leaves v JOIN subroots s ON v.tree = s.lang CROSS JOIN top t),
        steps AS (SELECT tree, idx, level, (idx >> level) % 2 = 1 AS is_left, b FROM
                (SELECT a.tree, a.idx, a.level, n.digest AS b FROM (SELECT tree, idx, range AS level FROM spots JOIN range(0, 64) ON range < height) a
                 LEFT JOIN low n ON n.tree = a.tree AND n.level = a.level AND n.idx = xor(a.idx >> a.level, 1))
            UNION ALL
            SELECT a.tree, a.idx, height + a.level, (place >> a.level) % 2 = 1, n.digest
            FROM (SELECT tree, idx, place, height, range AS level FROM spots JOIN range(0, 64) ON range < high) a
            LEFT JOIN high n ON n.level = a.level AND n.idx = xor(a.place >> a.level, 1)),
        whole AS (SELECT tree, idx, string_agg(b, '' ORDER BY level) AS siblings FROM steps GROUP BY tree, idx),
        fold AS (SELECT tree, idx, 0 AS done, used AS digest FROM spots
            UNION ALL
            SELECT f.tree, f.idx, done + 1, CASE WHEN b IS NULL THEN sha256(digest) WHEN is_left THEN sha256(b || digest) ELSE sha256(digest || b) END
            FROM fold f JOIN steps s ON f.tree = s.tree AND f.idx = s.idx AND f.done = s.level),
        ends AS (SELECT tree, idx, digest FROM fold QUALIFY done = max(done) OVER (PARTITION BY tree, idx))
        SELECT doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256, e.digest AS folded_root, e.digest = root AS verified
        FROM spots a JOIN ends e ON a.tree = e.tree AND a.idx = e.idx LEFT JOIN whole w ON a.tree = w.tree AND a.idx = w.idx"""


STATEMENTS = {"op1_revisit_resolution": _revisits(), "op9_shift_and_urls": _urls(), "op12_source_divergence": _divergence(),
              "op13_merkle_manifest": _merkle()}
