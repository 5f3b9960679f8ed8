"""DuckDB SQL for the queries that SQL can express.

Training (6), SimHash components (5), tokenizers (1, 4), tiling (2), the union of repeated runs
(3), a seeded 64-bit hash order (7), rounds of clustering (11) and of pattern scores (13) are not
among them; tests compare these by brute force.
"""

from __future__ import annotations

from retailflow.llm import fill_in_middle, licenses, quality, secrets

_ROWS = """
docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, source AS host
    FROM documents
)"""


def _licenses() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    phrases = []
    for phrase, label in licenses.PHRASES.items():
        tests = " AND ".join(
            f"words[k + {n}] = '{part}'" if n else f"words[k] = '{part}'"
            for n, part in enumerate(phrase.split())
        )
        phrases.append(f"SELECT r, k - 1 AS place, '{label}' AS label FROM places WHERE {tests}")
    templates = ", ".join(
        f"({n}, '{label}', '{text}')"
        for n, (label, text) in enumerate(
            (label, text) for label, texts in licenses.TEMPLATES.items() for text in texts
        )
    )
    texts = [text for label in licenses.TEMPLATES.values() for text in label]
    reach, edge = licenses.reach(texts), range(licenses.EDGE)
    quoted = [f"'{word}'" for word in licenses.COMMON]
    common = ", ".join(quoted)
    pairs = ", ".join(f"'{pair}'" for pair in licenses._pairs(texts))
    beside = ", ".join(
        f"'{i} {j} ' || before[len(before) - {i}] || ' ' || words[{j + 1}]"
        for i in edge
        for j in edge
    )
    return rf"""
WITH {_ROWS},
worded AS (
    SELECT *, regexp_extract_all(translate(text, '{upper}', '{upper.lower()}'), '{word}') AS words
    FROM docs
),
places AS (SELECT r, words, unnest(range(1, len(words) + 1)) AS k FROM worded),
base AS ({" UNION ALL ".join(phrases)}),
base_rows AS (
    SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
        list(DISTINCT label) AS base_labels
    FROM base GROUP BY r
),
lines AS (
    SELECT r, k, regexp_extract_all(lower(line), '{word}') AS words
    FROM (SELECT r, unnest(string_split(text, chr(10))) AS line,
        unnest(range(len(string_split(text, chr(10))))) AS k FROM docs)
),
broken AS (
    SELECT r, k, words, coalesce(list_has_any([{beside}], [{pairs}]), false) AS goes_on
    FROM (SELECT *, lag(words) OVER (PARTITION BY r ORDER BY k) AS before FROM lines)
),
numbered AS (
    SELECT *, sum(CASE WHEN goes_on THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY k) AS run
    FROM broken
),
runs AS (
    SELECT r, flatten(list(words ORDER BY k)) AS words FROM numbered
    GROUP BY r, run HAVING count(*) > 1
),
whole AS (SELECT r, words FROM lines UNION ALL SELECT r, words FROM runs),
blocks AS (
    SELECT r, list_distinct(words) AS block FROM whole WHERE len(words) <= {2 * reach}
    UNION ALL
    SELECT r, list_distinct(words[k + 1:k + {2 * reach}]) FROM (
        SELECT r, words, unnest(range(0, len(words) - {reach}, {reach})) AS k
        FROM whole WHERE len(words) > {2 * reach}
    )
),
templates AS (
    SELECT label, list_distinct(string_split(template, ' ')) AS wanted,
        list_filter(list_distinct(string_split(template, ' ')),
            lambda w: NOT list_contains([{common}], w)) AS telling
    FROM (VALUES {templates}) AS t(n, label, template)
),
met AS (
    SELECT r, label, len(list_intersect(block, wanted)) / len(wanted) AS containment
    FROM blocks, templates
    WHERE len(list_intersect(block, wanted)) >= {licenses.CONTAINMENT} * len(wanted) - 1e-9
        AND len(list_intersect(block, telling)) >= {licenses.CONTAINMENT} * len(telling) - 1e-9
),
met_rows AS (
    SELECT r, list(DISTINCT label) AS met, max(containment) AS containment FROM met GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base,
    first_word, last_word,
    coalesce(array_to_string(list_sort(base_labels), ','), '') AS base_labels,
    coalesce(array_to_string(list_sort(list_distinct(
        list_concat(coalesce(base_labels, []), coalesce(met, []))
    )), ','), '') AS labels,
    CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(containment, 0.0::DOUBLE) END AS score
FROM worded LEFT JOIN base_rows USING (r) LEFT JOIN met_rows USING (r)"""


def _quality() -> str:
    word = r"[^\x20\x09-\x0D]+"
    return rf"""
WITH {_ROWS},
worded AS (
    SELECT *, regexp_extract_all(text, '{word}') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{word}')) AS lines
    FROM docs
),
windows AS (
    SELECT r, k, array_to_string(list_slice(words, k, k + {quality.WINDOW - 1}), ' ') AS part
    FROM (
        SELECT r, words, unnest(range(1, len(words) - {quality.WINDOW - 2})) AS k
        FROM worded WHERE len(words) >= {quality.WINDOW}
    )
),
repeated AS (
    SELECT r, k FROM (SELECT r, k, count(*) OVER (PARTITION BY r, part) AS n FROM windows)
    WHERE n > 1
),
covered AS (
    SELECT r, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT r, unnest(range(k, k + {quality.WINDOW})) AS p FROM repeated) GROUP BY r
),
keyed AS (
    SELECT r, host, text, len(regexp_extract_all(line, '{word}')) AS n, array_to_string(
        regexp_extract_all(regexp_replace(lower(line), '[0-9]', '0', 'g'), '{word}'), ' ') AS line
    FROM (SELECT r, host, text, unnest(lines) AS line FROM worded)
),
sizes AS (SELECT host, count(DISTINCT text) AS documents FROM docs GROUP BY host),
boilerplate AS (
    SELECT keyed.host, line
    FROM keyed JOIN sizes ON keyed.host IS NOT DISTINCT FROM sizes.host
    GROUP BY keyed.host, line, documents
    HAVING count(DISTINCT text) > {quality.LEAST}
        OR (documents <= {quality.LEAST} AND count(DISTINCT text) >= {quality.SMALL_LEAST}
            AND count(DISTINCT text) > {quality.SMALL_SHARE} * documents)
),
gone AS (
    SELECT r, CAST(sum(n) AS BIGINT) AS words_removed
    FROM keyed JOIN boilerplate
        ON keyed.line = boilerplate.line AND keyed.host IS NOT DISTINCT FROM boilerplate.host
    GROUP BY r
),
numbers AS (
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
        length(text) - length(translate(text, '{quality._SYMBOLS}', '')) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words,
        coalesce(words_removed, 0) AS words_removed
    FROM worded LEFT JOIN covered USING (r) LEFT JOIN gone USING (r)
)
SELECT *, (n_words < {quality.FEW_WORDS} OR 100 * n_repeat_words > {quality.REPEATED} * n_words)
    AS base_failed,
    NOT (n_words < {quality.FEW_WORDS} OR 100 * n_repeat_words > {quality.REPEATED} * n_words)
    AND n_words - words_removed >= {quality.LEFT} * n_words AS kept
FROM numbers"""


def _secrets() -> str:
    matches = []
    for number, (kind, (pattern, group, least, holds)) in enumerate(secrets.KINDS.items()):
        quoted = pattern.replace("'", "''")
        tests = "".join(f" AND regexp_matches(value, '{part}')" for part in holds)
        matches.append(rf"""
    SELECT r, host, {number} AS kind, '{kind}' AS name, value, stop - length(whole) AS start, stop
    FROM (
        SELECT *, sum(length(gap) + length(whole)) OVER (PARTITION BY r ORDER BY k) AS stop
        FROM (
            SELECT r, host, unnest(range(1, len(wholes) + 1)) AS k,
                unnest(gaps[1:len(wholes)]) AS gap, unnest(wholes) AS whole,
                unnest(texts) AS value
            FROM (
                SELECT r, host, regexp_split_to_array(text, '{quoted}') AS gaps,
                    regexp_extract_all(text, '{quoted}') AS wholes,
                    regexp_extract_all(text, '{quoted}', {group}) AS texts
                FROM docs
            )
        )
    )
    WHERE length(value) >= {least}{tests}""")
    added = ", ".join(str(list(secrets.KINDS).index(kind)) for kind in secrets.ADDED)
    return rf"""
WITH {_ROWS},
matches AS ({" UNION ALL ".join(matches)}),
owned AS (
    SELECT value, count(DISTINCT host) + max(CAST(host IS NULL AS INT)) AS owners
    FROM matches GROUP BY value
),
spans AS (
    SELECT r, kind, owners, start, format('{{}}:{{}}:{{}}', name, start, stop) AS span
    FROM matches JOIN owned USING (value) WHERE kind NOT IN ({added}) OR owners < {secrets.WIDE}
),
joined AS (
    SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
        count(*) FILTER (kind = 2) AS n_hex,
        string_agg(span, ',' ORDER BY start, kind) FILTER (kind NOT IN ({added})) AS base,
        string_agg(span, ',' ORDER BY start, kind) AS spans,
        count(*) FILTER (owners < {secrets.WIDE}) AS n_live,
        count(*) FILTER (owners >= {secrets.WIDE}) AS n_example
    FROM spans GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
    coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
    coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
    coalesce(n_example, 0) AS n_example
FROM docs LEFT JOIN joined USING (r)"""


def _fill_in_middle() -> str:
    changed = "form <> 'plain'"
    return rf"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '{fill_in_middle.UNIT}') AS units,
        sha256('{fill_in_middle.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
    FROM documents
),
hashed AS (
    SELECT *, len(units) AS n, CAST('0x' || substr(digest, 1, 8) AS BIGINT) AS h1,
        CAST('0x' || substr(digest, 9, 8) AS BIGINT) AS h2,
        CAST('0x' || substr(digest, 17, 8) AS BIGINT) AS h3,
        CAST('0x' || substr(digest, 25, 8) AS BIGINT) AS h4
    FROM drawn
),
formed AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
            OR contains(text, '<M>') OR h3 % 100 >= {fill_in_middle.RATE} THEN 'plain'
        WHEN h4 % 100 < {fill_in_middle.SPM} THEN 'spm' ELSE 'psm' END AS form
    FROM hashed
),
parts AS (
    SELECT doc_id, text, n, form, array_to_string(list_slice(units, 1, a), '') AS prefix,
        array_to_string(list_slice(units, a + 1, b), '') AS middle,
        array_to_string(list_slice(units, b + 1, n), '') AS suffix
    FROM formed
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
    CASE WHEN {changed} THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
    CASE WHEN {changed} THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text
        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts"""


SQL: dict[str, str] = {
    "op8_licenses": _licenses(),
    "op9_quality": _quality(),
    "op10_secrets": _secrets(),
    "op12_fill_in_middle": _fill_in_middle(),
}
