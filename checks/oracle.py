"""The same results in DuckDB SQL, written from the definitions and not from the Spark plans."""

from __future__ import annotations

def _significant(p: str, digits: int = 9, least: int = 13) -> str:
    """A number from 0 to 1 to so many significant digits, at most ``digits + least`` decimals."""
    whens = " ".join(f"WHEN {p} >= 1e-{k} THEN 1e{digits + k - 1}" for k in range(1, least + 1))
    scale = f"(CASE {whens} ELSE 1e{digits + least} END)"
    return f"floor({p} * {scale} + 0.5::DOUBLE) / {scale}"


# ---- shared table expressions, in dependency order ----

CTES = {
    "tok": r"""SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}]+'), lambda x: x <> '') AS ws
        FROM documents""",
    "occ": """SELECT doc_id, ws[i] AS w1, ws[i + 1] AS w2, ws[i + 2] AS w3
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM tok)""",
    "tri": "SELECT w1, w2, w3, CAST(count(*) AS BIGINT) AS n FROM occ GROUP BY w1, w2, w3",
    "bi": """SELECT a AS w1, b AS w2, CAST(sum(n) AS BIGINT) AS n
        FROM (SELECT w1 AS a, w2 AS b, n FROM tri UNION ALL SELECT w2, w3, n FROM tri) GROUP BY a, b""",
    "uni": """SELECT word, CAST(sum(n) AS BIGINT) AS n
        FROM (SELECT w1 AS word, n FROM tri UNION ALL SELECT w2, n FROM tri UNION ALL SELECT w3, n FROM tri)
        GROUP BY word""",
    "size0": "SELECT CAST(sum(n) AS BIGINT) AS c0 FROM uni",
    "stats": """SELECT t.w1, t.w2, t.w3, t.n, p.n AS c12, q.n AS c23, u.n AS c2, v.n AS c3
        FROM tri t JOIN bi p ON p.w1 = t.w1 AND p.w2 = t.w2 JOIN bi q ON q.w1 = t.w2 AND q.w2 = t.w3
        JOIN uni u ON u.word = t.w2 JOIN uni v ON v.word = t.w3""",
    "raw": """SELECT w1, w2, w3, k3 * n / c12 + (1 - k3) * k2 * c23 / c2 + (1 - k3) * (1 - k2) * c3 / c0 AS p
        FROM (SELECT *, (ln(n + 1) + 1) / (ln(n + 1) + 2) AS k3, (ln(c23 + 1) + 1) / (ln(c23 + 1) + 2) AS k2
              FROM stats, size0)""",
    "prob": f"SELECT w1, w2, w3, {_significant('p')} AS prob FROM raw",
    "conv": r"""SELECT DISTINCT ws[i] AS w1, ws[i + 1] AS w2, ws[i + 2] AS w3
        FROM (SELECT ws, unnest(range(1, len(ws) - 1)) AS i FROM (
            SELECT list_filter(regexp_split_to_array(lower(text), '[^\p{L}]+'), lambda x: x <> '') AS ws
            FROM conversations))""",
    "yearly": """SELECT w1, w2, w3, CAST(1990 + doc_id % 30 AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS match_count
        FROM occ GROUP BY ALL""",
    "yearly2": """SELECT w1, w2, year, count(*) AS match_count FROM (
            SELECT CAST(1990 + doc_id % 30 AS INTEGER) AS year, ws[i] AS w1, ws[i + 1] AS w2
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws))) AS i FROM tok)) GROUP BY ALL""",
    "feat": """SELECT w2 AS lexeme, w1 || '-left' AS feature, n FROM tri
        UNION ALL SELECT w2, w3 || '-right', n FROM tri""",
    "lex": "SELECT w2 AS lexeme, CAST(sum(n) AS BIGINT) AS count_l FROM tri GROUP BY w2",
    "lf": "SELECT lexeme, feature, CAST(sum(n) AS BIGINT) AS count_lf FROM feat GROUP BY lexeme, feature",
    "ft": "SELECT feature, CAST(sum(n) AS BIGINT) AS count_f FROM feat GROUP BY feature",
    "totals": """SELECT CAST((SELECT sum(n) FROM tri) AS BIGINT) AS l, CAST((SELECT sum(n) FROM feat) AS BIGINT) AS f""",
    "assoc": """SELECT lexeme, feature, CAST(count_lf AS DOUBLE) AS a1, count_lf / CAST(count_l AS DOUBLE) AS a2,
            log2(CAST(count_lf AS DOUBLE) * f / (CAST(count_l AS DOUBLE) * count_f)) AS a3,
            (CAST(count_lf AS DOUBLE) * f - CAST(count_l AS DOUBLE) * count_f)
                / (sqrt(l) * sqrt(count_l) * sqrt(count_f) * sqrt(f)) AS a4
        FROM lf JOIN lex USING (lexeme) JOIN ft USING (feature), totals""",
    "gold": r"""SELECT DISTINCT w1, w2, CASE WHEN substr(w1, 1, 1) = substr(w2, 1, 1) THEN '1' ELSE '0' END AS label
        FROM (SELECT ws[i] AS w1, ws[i + 1] AS w2 FROM (SELECT ws, unnest(range(1, len(ws))) AS i FROM (
            SELECT list_filter(regexp_split_to_array(lower(text), '[^\p{L}]+'), lambda x: x <> '') AS ws
            FROM benchmark)))""",
    "sides": """SELECT w1, w2, feature, 1 AS side, a1, a2, a3, a4 FROM gold JOIN assoc ON lexeme = w1
        UNION ALL SELECT w1, w2, feature, 2, a1, a2, a3, a4 FROM gold JOIN assoc ON lexeme = w2""",
    "cells": """SELECT coalesce(p.w1, q.w1) AS w1, coalesce(p.w2, q.w2) AS w2, coalesce(p.feature, q.feature) AS feature,
            coalesce(p.a1, 0) AS x1, coalesce(p.a2, 0) AS x2, coalesce(p.a3, 0) AS x3, coalesce(p.a4, 0) AS x4,
            coalesce(q.a1, 0) AS y1, coalesce(q.a2, 0) AS y2, coalesce(q.a3, 0) AS y3, coalesce(q.a4, 0) AS y4
        FROM (SELECT * FROM sides WHERE side = 1) p FULL JOIN (SELECT * FROM sides WHERE side = 2) q
        ON p.w1 = q.w1 AND p.w2 = q.w2 AND p.feature = q.feature""",
    "sums": "SELECT w1, w2, "
    + ", ".join(
        f"""sum(abs(x{m} - y{m})) AS abs_{m}, sum((x{m} - y{m}) * (x{m} - y{m})) AS sq_{m}, sum(x{m} * y{m}) AS dot_{m},
            sum(x{m} * x{m}) AS sq1_{m}, sum(y{m} * y{m}) AS sq2_{m}, sum(least(x{m}, y{m})) AS min_{m},
            sum(greatest(x{m}, y{m})) AS max_{m}, sum(x{m} + y{m}) AS add_{m},
            sum(CASE WHEN x{m} + y{m} = 0 THEN 0 ELSE
                CASE WHEN 2 * x{m} / (x{m} + y{m}) > 0 THEN x{m} * log2(2 * x{m} / (x{m} + y{m})) ELSE 0 END
              + CASE WHEN 2 * y{m} / (x{m} + y{m}) > 0 THEN y{m} * log2(2 * y{m} / (x{m} + y{m})) ELSE 0 END
            END) AS js_{m}"""
        for m in (1, 2, 3, 4)
    )
    + " FROM cells GROUP BY w1, w2",
    "manifest": """SELECT CAST(page_id % 7 AS VARCHAR) AS client,
            ['ToText', 'ToHTML', 'ToImage', 'ToSpeech'][page_id % 4 + 1] AS op, url, html FROM pages""",
    "bare": r"""SELECT page_id, url, string_split(regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>'
            || '|</?[a-z](?:[^"''>]|"[^"]*"|''[^'']*'')*>|<[^>]*>', ' ', 'g'), '&') AS ps FROM pages""",
    "texts": r"""SELECT page_id, url, trim(regexp_replace(ps[1] || array_to_string(list_transform(ps[2:], lambda p:
            coalesce(CASE regexp_extract(p, '^(#?[A-Za-z0-9]{1,8});', 1) WHEN 'lt' THEN '<' WHEN 'gt' THEN '>' WHEN 'quot' THEN '"'
                WHEN 'apos' THEN '''' WHEN 'nbsp' THEN ' ' WHEN '#160' THEN ' ' WHEN 'amp' THEN '&'
                ELSE chr(TRY_CAST(regexp_extract(p, '^#([0-9]{1,7});', 1) AS INTEGER)) END
                || regexp_replace(p, '^#?[A-Za-z0-9]{1,8};', ''), '&' || p)), ''),
            '[ \t\r\n]+', ' ', 'g')) AS text FROM bare""",
    "keys": r"""SELECT client, op, url, html, 'DoneLocalId' || client || regexp_extract(url, '([^/]+)/*$', 1) || op
            || CASE op WHEN 'ToText' THEN '.txt' WHEN 'ToHTML' THEN '.html' WHEN 'ToImage' THEN '.jpg' END AS output_key
        FROM manifest""",
    "converted": r"""SELECT k.client, k.op, k.url,
            CASE WHEN op IN ('ToText', 'ToHTML') AND text <> '' THEN 'done' ELSE 'error' END AS status,
            CASE WHEN op IN ('ToText', 'ToHTML') AND text <> '' THEN output_key END AS result,
            CASE WHEN op = 'ToImage' THEN 'no page renderer for ToImage'
                 WHEN op NOT IN ('ToText', 'ToHTML') THEN 'unknown operation ' || op
                 WHEN text = '' THEN 'empty document' END AS error,
            CASE WHEN text = '' THEN NULL WHEN op = 'ToText' THEN text
                 WHEN op = 'ToHTML' THEN '<!DOCTYPE html>' || chr(10) || '<html>' || chr(10) || '<head>' || chr(10)
                    || '<title>PDF Page 1</title>' || chr(10) || '</head>' || chr(10) || '<body>' || chr(10) || text
                    || chr(10) || '</body>' || chr(10) || '</html>' END AS content
        FROM keys k JOIN (SELECT url, min(text) AS text FROM texts GROUP BY url) t ON t.url = k.url""",
    "posted": """SELECT CAST(user_id AS VARCHAR) AS client, event_type AS op, CAST(event_id AS VARCHAR) AS task,
            CASE WHEN value > 300 THEN '' WHEN event_type = 'error' THEN 'Error: task failed'
                 ELSE 'DoneLocalId' || user_id || event_id || 'ToText.txt' END AS result,
            CASE WHEN value > 300 THEN 'open' WHEN event_type = 'error' THEN 'error' ELSE 'done' END AS status, value
        FROM events""",
    "deliveries": """SELECT user_id, ts + CASE WHEN value > 30 AND value <= 300 THEN INTERVAL 30 SECOND ELSE INTERVAL 0 SECOND END AS sent
        FROM events""",
    "progress": """SELECT CAST(user_id AS VARCHAR) AS client, CAST(count(*) FILTER (value <= 300) AS BIGINT) AS done,
            CAST(count(*) AS BIGINT) AS total FROM events GROUP BY user_id""",
}


def _uses(name: str, text: str) -> bool:
    import re

    return re.search(rf"\b{name}\b", text) is not None


def sql(select: str) -> str:
    """``select`` with the table expressions it needs in front."""
    needed, text = [], select
    for name in reversed(CTES):
        if any(_uses(name, t) for t in [text, *[CTES[n] for n in needed]]):
            needed.append(name)
    body = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in reversed(needed))
    return f"WITH {body}\n{select}" if needed else select


def _r(expr: str, places: int, name: str) -> str:
    return f"round({expr}, {places}) + 0.0 AS {name}"


SUM_PLACES = {1: 4, 2: 9, 3: 4, 4: 6}
SQUARE_PLACES = {1: 4, 2: 9, 3: 3, 4: 6}
DISTANCE_PLACES = {1: 4, 2: 8, 3: 4, 4: 6}

DISTANCES = [
    "abs_{m}",
    "sqrt(sq_{m})",
    "CASE WHEN sqrt(sq1_{m}) * sqrt(sq2_{m}) > 0 THEN dot_{m} / (sqrt(sq1_{m}) * sqrt(sq2_{m})) ELSE -1 END",
    "CASE WHEN max_{m} > 0 THEN min_{m} / max_{m} ELSE -1 END",
    "CASE WHEN add_{m} > 0 THEN 2 * min_{m} / add_{m} ELSE -1 END",
    "js_{m}",
]


def _distances(*kinds: int) -> str:
    return ", ".join(
        _r(f"CAST({DISTANCES[k].format(m=m)} AS DOUBLE)", DISTANCE_PLACES[m], f"c{4 * k + m}") for k in kinds for m in (1, 2, 3, 4)
    )


def _pair_sums() -> str:
    out = []
    for m in (1, 2, 3, 4):
        for s in ("abs", "sq", "dot", "sq1", "sq2", "min", "max", "add", "js"):
            places = (SQUARE_PLACES if s in ("sq", "dot", "sq1", "sq2") else SUM_PLACES)[m]
            out.append(_r(f"CAST({s}_{m} AS DOUBLE)", places, f"{s}_{m}"))
    return ", ".join(out)


# ---- Porter stems: one step per table expression, mark = chr(1) for a consonant y ----

V, C = "[aeiouy]", "[^aeiouy]"
M0 = f"^{C}*{V}+{C}"
M1 = f"^{C}*{V}+{C}+{V}+{C}"
MEQ1 = f"^{C}*{V}+{C}+{V}*$"
CVC = C + V + r"[^aeiouywx\x01]$"


def _has(expr: str, pattern: str) -> str:
    return f"regexp_matches({expr}, '{pattern}')"


def _ends(cases: list[tuple[str, str]], measure: str) -> str:
    """The longest listed ending decides; it is replaced only if the rest has the measure."""
    whens = []
    for ending, new in sorted(cases, key=lambda c: -len(c[0])):
        rest = f"left(w, length(w) - {len(ending)})"
        whens.append(f"WHEN ends_with(w, '{ending}') THEN CASE WHEN {_has(rest, measure)} THEN {rest} || '{new}' ELSE w END")
    return f"CASE {' '.join(whens)} ELSE w END"


# Fixed values of the Porter algorithm.
STEP_DOUBLE = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"),
    ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"),
    ("iviti", "ive"), ("biliti", "ble"), ("logi", "log"),
]
STEP_SINGLE = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""),
]
STEP_DROP = [
    (s, "")
    for s in (
        "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ou", "ism", "ate", "iti", "ous",
        "ive", "ize",
    )
] + [("sion", "s"), ("tion", "t")]

STEM_CTES = f"""
vocab AS (SELECT unnest(ws) AS word, count(*) AS n FROM tok GROUP BY 1),
s0 AS (SELECT word, n, regexp_replace(regexp_replace(word, '(^|[aeiou])y', '\\1' || chr(1), 'g'), 'yy', 'y' || chr(1), 'g') AS w
       FROM vocab),
s1 AS (SELECT word, n, CASE WHEN ends_with(w, 'sses') OR ends_with(w, 'ies') THEN left(w, length(w) - 2)
       WHEN ends_with(w, 'ss') OR NOT ends_with(w, 's') THEN w ELSE left(w, length(w) - 1) END AS w FROM s0),
s2 AS (SELECT word, n, w, CASE WHEN ends_with(w, 'eed') THEN NULL
       WHEN ends_with(w, 'ed') AND {_has("left(w, length(w) - 2)", V)} THEN left(w, length(w) - 2)
       WHEN ends_with(w, 'ing') AND {_has("left(w, length(w) - 3)", V)} THEN left(w, length(w) - 3) END AS r FROM s1),
s3 AS (SELECT word, n, CASE
       WHEN r IS NULL THEN CASE WHEN ends_with(w, 'eed') AND {_has("left(w, length(w) - 3)", M0)}
                                THEN left(w, length(w) - 1) ELSE w END
       WHEN ends_with(r, 'at') OR ends_with(r, 'bl') OR ends_with(r, 'iz') THEN r || 'e'
       WHEN (length(r) > 1 AND right(r, 1) = substr(r, length(r) - 1, 1) AND {_has("right(r, 1)", C)})
            OR ends_with(r, 'y' || chr(1))
            THEN CASE WHEN right(r, 1) IN ('l', 's', 'z') THEN r ELSE left(r, length(r) - 1) END
       WHEN {_has("r", MEQ1)} AND {_has("r", CVC)} THEN r || 'e' ELSE r END AS w FROM s2),
s4 AS (SELECT word, n, CASE WHEN right(w, 1) IN ('y', chr(1)) AND {_has("left(w, length(w) - 1)", V)}
       THEN left(w, length(w) - 1) || 'i' ELSE w END AS w FROM s3),
s5 AS (SELECT word, n, {_ends(STEP_DOUBLE, M0)} AS w FROM s4),
s6 AS (SELECT word, n, {_ends(STEP_SINGLE, M0)} AS w FROM s5),
s7 AS (SELECT word, n, {{drop}} AS w FROM s6),
s8 AS (SELECT word, n, CASE WHEN ends_with(w, 'e') AND ({_has("w", M1)} OR ({_has("w", MEQ1)}
       AND NOT {_has("left(w, length(w) - 1)", CVC)})) THEN left(w, length(w) - 1) ELSE w END AS w FROM s7),
s9 AS (SELECT word, n, CASE WHEN ends_with(w, 'll') AND {_has("w", M1)} THEN left(w, length(w) - 1) ELSE w END AS w FROM s8),
stems AS (SELECT word, n, CASE WHEN length(word) < 3 THEN word ELSE replace(w, chr(1), 'y') END AS stem FROM s9)
"""


def _drop_step() -> str:
    """-sion and -tion give up three letters but count the s or t as part of the rest."""
    whens = []
    for ending, keep in sorted(STEP_DROP, key=lambda c: -len(c[0])):
        rest = f"left(w, length(w) - {len(ending) - len(keep)})"
        whens.append(f"WHEN ends_with(w, '{ending}') THEN CASE WHEN {_has(rest, M1)} THEN {rest} ELSE w END")
    return f"CASE {' '.join(whens)} ELSE w END"


def stem_sql(select: str) -> str:
    return f"WITH tok AS ({CTES['tok']}),{STEM_CTES.replace('{drop}', _drop_step())}\n{select}"


ROUNDED_A = "round(a1, 9) + 0.0 AS a1, round(a2, 9) + 0.0 AS a2, round(a3, 9) + 0.0 AS a3, round(a4, 9) + 0.0 AS a4"

SELECTS = {
    "trigram_from_text": "SELECT * FROM tri",
    "ngram_parse": "SELECT * FROM yearly",
    "rejected_rows": r"""
        SELECT 'ngram' AS kind, 'fewer than 3 words' AS reason,
               w1 || ' ' || w2 || chr(9) || year || chr(9) || match_count AS line FROM yearly2
        UNION ALL SELECT 'ngram', CASE WHEN len(string_split(text, ' ')) < 3 THEN 'fewer than 3 words'
               ELSE 'fewer than 3 fields' END, text FROM conversations
        UNION ALL SELECT 'dependency', 'bad head index',
               w2 || chr(9) || w2 || '/X/ROOT/0 ' || w3 || '/X/right' || chr(9) || n FROM tri
        UNION ALL SELECT 'dependency', CASE WHEN regexp_matches(text, '^\p{L}') THEN 'fewer than 3 fields or no count'
               ELSE 'head does not start with a letter' END, text FROM conversations""",
    "trigram_counts": "SELECT * FROM tri",
    "trigram_counts_merged": "SELECT * FROM tri",
    "stopword_filter": """WITH_STOP SELECT * FROM tri WHERE w1 NOT IN (SELECT word FROM stop)
        AND w2 NOT IN (SELECT word FROM stop) AND w3 NOT IN (SELECT word FROM stop)""",
    "stopword_filter_from_file": """WITH_STOP SELECT * FROM tri WHERE w1 NOT IN (SELECT word FROM stop)
        AND w2 NOT IN (SELECT word FROM stop) AND w3 NOT IN (SELECT word FROM stop)""",
    "sequence_file_counts": "SELECT * FROM tri",
    "key_value_round_trip": "SELECT * FROM tri",
    "tsv_round_trip": "SELECT * FROM tri",
    "csv_round_trip": "SELECT * FROM tri",
    "dep_irregular_roots": """SELECT w2 || chr(9) || w1 || '/X/left/2 ' || w2 || '/X/mid/1 ' || w3 || '/X/right/2' || chr(9) || n AS line,
            0 AS root FROM tri
        UNION ALL SELECT w2 || chr(9) || ',/X/punct/x ' || w2 || '/X/ROOT/0 ' || w3 || '/X/right/2 ''/X/punct/2 ' || w1
            || '/X/far/3' || chr(9) || n, 2 FROM tri
        UNION ALL SELECT w2 || chr(9) || w2 || '/X/ROOT/0 ' || w1 || '/X/ROOT/0 ' || w3 || '/X/first/1 ' || w3 || '/X/second/2'
            || chr(9) || n, 1 FROM tri""",
    "dep_irregular_features": """SELECT w2 AS lexeme, w3 || '-right' AS feature, n AS total FROM tri
        UNION ALL SELECT w2, w3 || '-first', n FROM tri""",
    "dep_irregular_totals": "SELECT CAST(3 * sum(n) AS BIGINT) AS l, CAST(2 * sum(n) AS BIGINT) AS f FROM tri",
    "corpus_subset": """SELECT CAST(percent AS INTEGER) AS percent, CAST(count(*) AS BIGINT) AS n_docs,
        CAST(sum(n_chars) AS BIGINT) AS n_chars FROM documents, (VALUES (1), (10), (100)) t(percent)
        WHERE doc_id % 100 < percent GROUP BY percent""",
    "corpus_shard_files": """SELECT CAST(doc_id % 8 AS INTEGER) AS shard, count(*) AS n_docs, CAST(sum(n_chars) AS BIGINT) AS n_chars
        FROM documents WHERE doc_id % 8 < 2 GROUP BY ALL""",
    "rejected_gold_lines": "SELECT text AS line, 'fewer than 2 fields' AS reason FROM conversations",
    "rejected_manifest_lines": "SELECT role AS client, text AS line, 'fewer than 2 fields' AS reason FROM conversations",
    "labelled_csv": f"""SELECT w1, w2, {_distances(0, 1, 2, 3, 4, 5)}, label AS result
        FROM sums LEFT JOIN gold USING (w1, w2)""",
    "bigram_counts": "SELECT * FROM bi",
    "unigram_counts": "SELECT * FROM uni",
    "corpus_size": "SELECT * FROM size0",
    "corpus_size_direct": "SELECT CAST(3 * sum(n) AS BIGINT) AS c0 FROM tri",
    "corpus_size_observed": """SELECT CAST(3 * sum(n) AS BIGINT) AS c0, CAST(sum(n) AS BIGINT) AS occurrences, count(*) AS "distinct"
        FROM tri""",
    "corpus_totals_observed": "SELECT l, f FROM totals",
    "trigram_with_c12": "SELECT w1, w2, w3, n, c12 FROM stats",
    "trigram_with_c23": "SELECT w1, w2, w3, n, c23 FROM stats",
    "trigram_with_unigrams": "SELECT w1, w2, w3, n, c2, c3 FROM stats",
    "trigram_stats": "SELECT * FROM stats",
    "interp_weights": """SELECT w1, w2, w3, round((ln(c23 + 1) + 1) / (ln(c23 + 1) + 2), 9) AS k2,
        round((ln(n + 1) + 1) / (ln(n + 1) + 2), 9) AS k3 FROM stats""",
    "next_word_prob": "SELECT * FROM prob",
    "next_word_prob_guarded": "SELECT * FROM prob",
    "next_word_prob_laid_out": "SELECT * FROM prob",
    "next_word_ranked": f"SELECT w1, w2, w3, {_significant('p')} AS prob FROM raw ORDER BY w1, w2, p DESC, w3",
    "next_word_topk": f"""SELECT w1, w2, w3, {_significant('p')} AS prob, rank FROM (SELECT *,
        CAST(row_number() OVER (PARTITION BY w1, w2 ORDER BY p DESC, w3) AS INTEGER) AS rank FROM raw) WHERE rank <= 5""",
    "next_word_rank": f"""SELECT w1, w2, w3, {_significant('p')} AS prob,
        row_number() OVER (PARTITION BY w1, w2 ORDER BY p DESC, w3) AS rank FROM raw""",
    "backoff_topk": f"""SELECT w1, w2, w3, {_significant('p')} AS prob, rank FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY w1, w2 ORDER BY p DESC, w3) AS INTEGER) AS rank FROM (
            SELECT t.w1, t.w2, s.w3, s.p FROM (
                SELECT w1, w2, unnest(range(1, count(*) + 6)) AS k FROM tri GROUP BY w1, w2) t JOIN (
                SELECT *, row_number() OVER (PARTITION BY w2 ORDER BY p DESC, w3) AS k FROM (
                    SELECT b.w1 AS w2, b.w2 AS w3, 0.5::DOUBLE * ((ln(b.n + 1) + 1) / (ln(b.n + 1) + 2)) * b.n / u.n
                        + 0.5::DOUBLE * (1 - (ln(b.n + 1) + 1) / (ln(b.n + 1) + 2)) * v.n / c0 AS p
                    FROM bi b JOIN uni u ON u.word = b.w1 JOIN uni v ON v.word = b.w2, size0)) s ON s.w2 = t.w2 AND s.k = t.k
            ANTI JOIN tri x ON x.w1 = t.w1 AND x.w2 = t.w2 AND x.w3 = s.w3
            UNION ALL SELECT t.w1, t.w2, f.w3, f.p FROM (SELECT DISTINCT w1, w2 FROM tri) t JOIN (
                SELECT *, row_number() OVER (PARTITION BY w2 ORDER BY p DESC, w3) AS place FROM (
                    SELECT m.w1 AS w2, u.word AS w3, 0.25::DOUBLE * u.n / c0 AS p FROM (
                        SELECT w1, unnest(range(1, count(*) + 6)) AS k FROM bi GROUP BY w1) m
                    JOIN (SELECT word, n, row_number() OVER (ORDER BY n DESC, word) AS k FROM uni) u ON u.k = m.k
                    ANTI JOIN bi b ON b.w1 = m.w1 AND b.w2 = u.word, size0)) f ON f.w2 = t.w2 AND f.place <= 5
        )) WHERE rank <= 5""",
    "backoff_candidates": f"""SELECT * EXCLUDE (p), {_significant('p')} AS prob FROM (
        SELECT b.w1 AS w2, b.w2 AS w3, u.n AS c2, v.n AS c3, b.n AS c23, c0,
        (SELECT count(*) FROM uni) - coalesce(s.seen, 0) AS unseen,
        0.5::DOUBLE * ((ln(b.n + 1) + 1) / (ln(b.n + 1) + 2)) * b.n / u.n
            + 0.5::DOUBLE * (1 - (ln(b.n + 1) + 1) / (ln(b.n + 1) + 2)) * v.n / c0 AS p
        FROM bi b JOIN uni u ON u.word = b.w1 JOIN uni v ON v.word = b.w2
        LEFT JOIN (SELECT w2, w3, count(DISTINCT w1) AS seen FROM tri GROUP BY w2, w3) s ON s.w2 = b.w1 AND s.w3 = b.w2,
        size0)""",
    "backoff_scored": f"""SELECT w1, w2, w3, seen, {_significant('p')} AS prob FROM (SELECT w1, w2, w3, n > 0 AS seen,
        (CASE WHEN c12 = 0 THEN 0 ELSE k3 * n / c12 END + CASE WHEN c2 = 0 THEN 0 ELSE (1 - k3) * k2 * c23 / c2 END
            + (1 - k3) * (1 - k2) * c3 / c0) AS p
        FROM (SELECT *, (ln(n + 1) + 1) / (ln(n + 1) + 2) AS k3, (ln(c23 + 1) + 1) / (ln(c23 + 1) + 2) AS k2 FROM (
            SELECT r.w1, r.w2, r.w3, coalesce(t.n, 0) AS n, coalesce(p.n, 0) AS c12, coalesce(q.n, 0) AS c23,
                coalesce(u.n, 0) AS c2, coalesce(v.n, 0) AS c3
            FROM conv r LEFT JOIN tri t ON t.w1 = r.w1 AND t.w2 = r.w2 AND t.w3 = r.w3
            LEFT JOIN bi p ON p.w1 = r.w1 AND p.w2 = r.w2 LEFT JOIN bi q ON q.w1 = r.w2 AND q.w2 = r.w3
            LEFT JOIN uni u ON u.word = r.w2 LEFT JOIN uni v ON v.word = r.w3)), size0)""",
    "dep_parse": """SELECT w2 AS head, n AS total, place, word, 'X' AS pos, dep, head_idx FROM (
        SELECT *, 1 AS place, w1 AS word, 'left' AS dep, 2 AS head_idx FROM tri
        UNION ALL SELECT *, 2, w2, 'ROOT', 0 FROM tri UNION ALL SELECT *, 3, w3, 'right', 2 FROM tri)""",
    "dep_root": """SELECT w2 || chr(9) || w1 || '/X/left/2 ' || w2 || '/X/ROOT/0 ' || w3 || '/X/right/2' || chr(9) || n AS line,
        2 AS root FROM tri""",
    "dep_features": "SELECT lexeme, feature, n AS total FROM feat",
    "lexeme_counts": "SELECT * FROM lex",
    "lexeme_feature_counts": "SELECT lexeme, feature, count_lf, count_l FROM lf JOIN lex USING (lexeme)",
    "feature_counts": "SELECT * FROM ft",
    "corpus_totals": "SELECT l, f FROM totals",
    "association": f"SELECT lexeme, feature, {ROUNDED_A} FROM assoc",
    "gold_pairs": "SELECT * FROM gold",
    "gold_vocab_filter": """SELECT lexeme, feature, count_lf FROM lf
        WHERE lexeme IN (SELECT w1 FROM gold UNION SELECT w2 FROM gold)""",
    "pair_features": f"SELECT w1, w2, feature, side, {ROUNDED_A} FROM sides",
    "pair_vector_outer": "SELECT w1, w2, feature, "
    + ", ".join(_r(f"CAST({s}{m} AS DOUBLE)", 9, f"{s}{m}") for s in "xy" for m in (1, 2, 3, 4))
    + " FROM cells",
    "pair_sums": f"SELECT w1, w2, {_pair_sums()} FROM sums",
    "dist_manhattan": f"SELECT w1, w2, {_distances(0)} FROM sums",
    "dist_euclid": f"SELECT w1, w2, {_distances(1)} FROM sums",
    "sim_cosine": f"SELECT w1, w2, {_distances(2)} FROM sums",
    "sim_jaccard": f"SELECT w1, w2, {_distances(3)} FROM sums",
    "sim_dice": f"SELECT w1, w2, {_distances(4)} FROM sums",
    "dist_js": f"SELECT w1, w2, {_distances(5)} FROM sums",
    "similarity_matrix": f"SELECT w1, w2, {_distances(0, 1, 2, 3, 4, 5)} FROM sums",
    "labelled_matrix": f"""SELECT w1, w2, {_distances(0, 1, 2, 3, 4, 5)}, label AS result
        FROM sums LEFT JOIN gold USING (w1, w2)""",
    "task_manifest": "SELECT client, op, url FROM manifest",
    "doc_to_text": "SELECT page_id, text AS content FROM texts",
    "doc_to_html": """SELECT page_id, '<!DOCTYPE html>' || chr(10) || '<html>' || chr(10) || '<head>' || chr(10)
        || '<title>PDF Page 1</title>' || chr(10) || '</head>' || chr(10) || '<body>' || chr(10) || text
        || chr(10) || '</body>' || chr(10) || '</html>' AS content FROM texts""",
    "doc_output_key": "SELECT client, op, url, output_key FROM keys",
    "doc_convert": "SELECT * FROM converted",
    "client_progress": """SELECT client, CAST(count(*) AS BIGINT) AS total, CAST(count(*) AS BIGINT) AS done,
        CAST(count(*) FILTER (status = 'error') AS BIGINT) AS failed, true AS complete FROM converted GROUP BY client""",
    "client_report": """SELECT client, 1 AS section, op || chr(9) || url || chr(9) || coalesce(result, error) AS line FROM converted
        UNION ALL SELECT DISTINCT client, 0, '<!DOCTYPE html>' || chr(10) || '<html>' || chr(10) || '<head>' || chr(10)
            || '<title>Document</title>' || chr(10) || '</head>' || chr(10) || '<body>' || chr(10) || '<pre>' FROM manifest
        UNION ALL SELECT DISTINCT client, 2, '</pre>' || chr(10) || '</body>' || chr(10) || '</html>' FROM manifest""",
    "stream_results": """SELECT client, op, task, result, status FROM posted
        UNION ALL SELECT client, op, task, result, status FROM posted WHERE value > 30 AND value <= 300""",
    "rejected_messages": """SELECT text AS value, 'not a message' AS reason FROM conversations
        UNION ALL SELECT '{"localID":"' || user_id || '","content":"' || event_type || '"}', 'fewer than 3 fields'
        FROM events WHERE value > 300""",
    "stream_dedup": "SELECT client, op, task, result, status FROM posted",
    "stream_once": "SELECT client, op, task, result, status FROM posted",
    "stream_progress": "SELECT client, done, total, done = total AS complete FROM progress",
    "stream_outcomes": """SELECT client, CASE WHEN done = total THEN 'complete' ELSE 'unresolved' END AS status, done,
            total - done AS missing
        FROM progress JOIN (SELECT CAST(user_id AS VARCHAR) AS client, max(sent) AS last FROM deliveries GROUP BY user_id) USING (client),
            (SELECT max(sent) AS ends FROM deliveries)
        WHERE done = total OR last + INTERVAL 1 HOUR <= ends - INTERVAL 1 HOUR""",
    "stream_unresolved": "SELECT client, done, total - done AS missing FROM progress WHERE done <> total",
}


def _build(select: str) -> str:
    if not select.startswith("WITH_STOP"):
        return sql(select)
    stop = ",\nstop AS (SELECT word FROM uni ORDER BY n DESC, word LIMIT 20)\nSELECT"
    return sql(select.removeprefix("WITH_STOP ") + " -- uni").replace("\nSELECT", stop, 1).replace(" -- uni", "")


ORACLE = {name: _build(select) for name, select in SELECTS.items()}
ORACLE["stem_vocabulary"] = stem_sql("SELECT word, stem FROM stems")
ORACLE["stemmed_counts"] = stem_sql("SELECT stem, CAST(sum(n) AS BIGINT) AS n FROM stems GROUP BY stem")


def stemmed_model_sql(select: str) -> str:
    """``select`` over the co-occurrence expressions with every word of the trigrams and gold pairs stemmed."""
    known = f"""tok AS (SELECT ws FROM ({CTES["tok"]}) UNION ALL SELECT list_distinct([w1, w2]) FROM ({CTES["gold"]}))"""
    stems = STEM_CTES.replace("{drop}", _drop_step())
    own = {
        "pieces": CTES["tok"],
        "occ": CTES["occ"].replace("FROM tok", "FROM pieces"),
        "tri": """SELECT a.stem AS w1, b.stem AS w2, c.stem AS w3, CAST(count(*) AS BIGINT) AS n FROM occ
            JOIN stems a ON a.word = w1 JOIN stems b ON b.word = w2 JOIN stems c ON c.word = w3 GROUP BY ALL""",
        "gold": f"""SELECT a.stem AS w1, b.stem AS w2, max(label) AS label FROM ({CTES["gold"]})
            JOIN stems a ON a.word = w1 JOIN stems b ON b.word = w2 GROUP BY ALL""",
    }
    own |= {n: CTES[n] for n in ("feat", "lex", "lf", "ft", "totals", "assoc", "sides", "cells", "sums")}
    body = ",\n".join(f"{n} AS MATERIALIZED ({text})" for n, text in own.items())
    return f"WITH {known},{stems},\n{body}\n{select}"


ORACLE["stemmed_association"] = stemmed_model_sql(f"SELECT lexeme, feature, {ROUNDED_A} FROM assoc")
ORACLE["stemmed_labelled_matrix"] = stemmed_model_sql(
    f"""SELECT w1, w2, {_distances(0, 1, 2, 3, 4, 5)}, label AS result FROM sums LEFT JOIN gold USING (w1, w2)"""
)
