"""DuckDB SQL for the queries that SQL can express; the others are tested against brute force, the library, or round trips."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_NOT_BLANK = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

DECONTAMINATION = f"""
WITH dw AS MATERIALIZED (SELECT doc_id, {_ALNUM} AS ws FROM documents),
bw AS (SELECT item_id, ws, least(10, len(ws)) AS n FROM (SELECT item_id, {_ALNUM} AS ws FROM benchmark) WHERE len(ws) > 0),
win AS MATERIALIZED (SELECT DISTINCT item_id, ws[i:i + n - 1] AS w
    FROM (SELECT item_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM bw) WHERE item_id IS NOT NULL),
occ AS MATERIALIZED (SELECT doc_id, i, n, item_id
    FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
          FROM dw, (SELECT DISTINCT len(w) AS n FROM win) WHERE len(ws) >= n) d
    JOIN win ON win.w = d.ws[i:i + n - 1]),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM occ GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
    n_hit IS NOT NULL AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE dw AS MATERIALIZED (SELECT doc_id, {_NOT_BLANK} AS ws FROM documents),
sh AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM dw WHERE len(ws) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
links AS MATERIALIZED (SELECT x, y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS met
        FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL)
    JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * met >= 75 * (p.n + q.n - met)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM dw
    UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON links.x = reach.other)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM dw LEFT JOIN sizes USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)"""

def _leaf(text: str) -> str:
    fields = [*(f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", "n_chars")), text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


def _siblings(nodes: str) -> str:
    """Nodes with what stands left and right of them in their run, below the top of each tree."""
    return f"""SELECT a.tree, a.l, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') || '|'
            || coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS pair
        FROM (SELECT *, max(l) OVER (PARTITION BY tree) AS top FROM {nodes}) a
        JOIN {nodes} b ON a.tree IS NOT DISTINCT FROM b.tree AND a.l = b.l AND a.pos // 3 = b.pos // 3
        WHERE a.l < a.top GROUP BY ALL"""


def _levels(nodes: str, leaves: str) -> str:
    return f"""{nodes}(tree, l, pos, h) AS (SELECT tree, 0, pos, h FROM {leaves} UNION ALL
        SELECT tree, any_value(l) + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos))
        FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS c FROM {nodes}) WHERE c > 1 GROUP BY tree, pos // 3)"""


#: CRC-32 of the decimal id, bit by bit: a character enters, then eight shifts (marked 256).
_CRC = """xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda c: [CAST(ascii(c) AS BIGINT), 256, 256, 256, 256, 256, 256, 256, 256]))),
    lambda c, b: CASE WHEN b < 256 THEN xor(c, b) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"""

MERKLE = f"""
WITH RECURSIVE leafs AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS pos
    FROM (SELECT doc_id, source AS tree, {_leaf("text")} AS h,
        CASE WHEN {_CRC} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} END AS other FROM documents)),
{_levels("low", "leafs")},
subs AS MATERIALIZED (SELECT 0 AS tree, tree AS source, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS pos, h
    FROM (SELECT tree, arg_max(h, l) AS h FROM low GROUP BY tree)),
{_levels("high", "subs")},
lows AS MATERIALIZED ({_siblings("low")}),
highs AS MATERIALIZED ({_siblings("high")}),
upper AS (SELECT s.source, s.h AS subroot, coalesce(list(x.pair ORDER BY x.l) FILTER (x.pair IS NOT NULL), []) AS pairs
    FROM subs s LEFT JOIN highs x ON x.pos = s.pos // CAST(pow(3, x.l) AS BIGINT) GROUP BY ALL),
steps AS (SELECT unnest(range(0, 40)) AS l),
lower AS (SELECT f.tree, f.pos, coalesce(list(x.pair ORDER BY x.l) FILTER (x.pair IS NOT NULL), []) AS pairs
    FROM (SELECT tree, pos, l, pos // CAST(pow(3, l) AS BIGINT) AS at FROM leafs, steps WHERE l < 20) f
    LEFT JOIN lows x ON x.tree IS NOT DISTINCT FROM f.tree AND x.l = f.l AND x.pos = f.at GROUP BY f.tree, f.pos),
proofs AS (SELECT f.doc_id, f.h AS leaf, u.subroot, list_concat(w.pairs, u.pairs) AS pairs, coalesce(f.other, f.h) AS start
    FROM leafs f JOIN lower w ON w.tree IS NOT DISTINCT FROM f.tree AND w.pos = f.pos
    JOIN upper u ON u.source IS NOT DISTINCT FROM f.tree)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM (
    SELECT doc_id, leaf, subroot, (SELECT arg_max(h, l) FROM high) AS root,
        sha256(replace(array_to_string(pairs, ''), '|', '')) AS proof_sha256,
        list_reduce(list_concat([start], pairs),
            lambda a, x: sha256(string_split(x, '|')[1] || a || string_split(x, '|')[2])) AS folded_root FROM proofs)"""

REPEATS = """
WITH d AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS MATERIALIZED (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s
    FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM d)),
m AS (SELECT s, min(doc_id) AS low FROM w GROUP BY s HAVING min(doc_id) <> max(doc_id)),
hit AS (SELECT DISTINCT doc_id, i FROM w JOIN m USING (s) WHERE doc_id > low),
e AS (SELECT *, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50, true) AS fresh FROM hit),
spans AS (SELECT doc_id, min(i) AS b, max(i) + 50 AS e
    FROM (SELECT *, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM e) GROUP BY doc_id, g),
kept AS (SELECT doc_id, sum(e - b) AS gone, count(*) AS n, max(e) AS rest,
        string_agg(substr(h, 2 * after + 1, 2 * (b - after)), '' ORDER BY b) AS k
    FROM (SELECT *, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS after FROM spans) JOIN d USING (doc_id)
    GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(n, 0) AS n_spans,
    sha256(unhex(coalesce(k || substr(h, 2 * rest + 1), h))) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)"""

LLM_ORACLE = {
    "op3_decontamination": DECONTAMINATION,
    "op5_near_duplicates": NEAR_DUPLICATES,
    "op12_merkle": MERKLE,
    "op13_repeats": REPEATS,
}
