"""SQL counterparts, for DuckDB, of the queries that SQL can express."""

from __future__ import annotations

from namewright.llm.fill_in_middle import MIDDLE, PLAIN_SHARE, PREFIX, SPM_SHARE, SUFFIX
from namewright.llm.mixing import DRAW_MEAN, TERMS
from namewright.llm.quality_rules import CLASSES, COMMON_WORDS, N_COMMON, Rules
from namewright.llm.vector_codes import ENTRIES, PARTS, ROUNDS, SCALE

OP1 = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS src, b.vec_id AS dst
    FROM vectors a JOIN vectors b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reached AS (
    SELECT vec_id AS src, vec_id AS dst FROM embeddings
    UNION
    SELECT reached.src, links.dst FROM reached JOIN links ON reached.dst = links.src
), lowest AS (
    SELECT src, min(dst) AS component_id FROM reached GROUP BY src
), counted AS (
    SELECT src, count(*) AS n FROM links GROUP BY src
)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN lowest ON lowest.src = e.vec_id LEFT JOIN counted ON counted.src = e.vec_id
"""

OP3 = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS spot FROM turns
), replies AS (
    SELECT conv_id, max(spot) AS last_at, arg_max(text, spot) AS last_text FROM numbered WHERE role = 'assistant' GROUP BY conv_id
), known AS (
    SELECT numbered.*, coalesce(spot = own.last_at, false) AS is_last, other.last_text AS other_text
    FROM numbered LEFT JOIN replies own USING (conv_id) LEFT JOIN replies other ON other.conv_id = xor(numbered.conv_id, 1)
    WHERE own.last_at IS NULL OR spot <= own.last_at
), sides AS (
    SELECT 'c' AS side, conv_id, turn, role, text, spot FROM known
    UNION ALL
    SELECT 'r', conv_id, turn, role, CASE WHEN is_last THEN other_text ELSE text END, spot FROM known WHERE NOT is_last OR other_text IS NOT NULL
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY side, conv_id ORDER BY spot) - 1 AS place,
           '<|' || role || '|>' || chr(10) AS head
    FROM sides
), met AS (
    SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.place, r.place) AS place,
           c.role IS NOT DISTINCT FROM r.role AND c.text IS NOT DISTINCT FROM r.text AS same
    FROM (SELECT * FROM placed WHERE side = 'c') c FULL JOIN (SELECT * FROM placed WHERE side = 'r') r
      ON c.conv_id = r.conv_id AND c.place = r.place
), prefixes AS (
    SELECT conv_id, coalesce(min(place) FILTER (WHERE NOT same), count(*)) AS n_common FROM met GROUP BY conv_id
), rendered AS (
    SELECT placed.*, n_common, head || text || '<|end|>' || chr(10) AS shown,
           sum(CASE WHEN place >= n_common THEN length(head || text) + 8 ELSE 0 END)
               OVER (PARTITION BY side, conv_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS until
    FROM placed JOIN prefixes USING (conv_id)
), masks AS (
    SELECT *, (until - length(text) - 8)::BIGINT || ':' || until::BIGINT AS span FROM rendered
)
SELECT conv_id AS pair_id, n_common::INT AS n_common,
       coalesce(string_agg(shown, '' ORDER BY place) FILTER (WHERE side = 'c' AND place < n_common), '') AS prompt,
       coalesce(string_agg(shown, '' ORDER BY place) FILTER (WHERE side = 'c' AND place >= n_common), '') AS chosen,
       coalesce(string_agg(shown, '' ORDER BY place) FILTER (WHERE side = 'r' AND place >= n_common), '') AS rejected,
       coalesce(string_agg(span, ',' ORDER BY place) FILTER (WHERE side = 'c' AND place >= n_common AND role = 'assistant'), '') AS chosen_mask,
       coalesce(string_agg(span, ',' ORDER BY place) FILTER (WHERE side = 'r' AND place >= n_common AND role = 'assistant'), '') AS rejected_mask,
       count(*) FILTER (WHERE side = 'c' AND place >= n_common AND role = 'assistant') > 0
           AND count(*) FILTER (WHERE side = 'r' AND place >= n_common AND role = 'assistant') > 0 AS usable
FROM masks GROUP BY conv_id, n_common
"""

OP5 = f"""
WITH RECURSIVE counts AS (
    SELECT source, count(*) AS n, sqrt(count(*)) AS weight FROM documents GROUP BY source
), rates AS (
    SELECT source, 1.0::DOUBLE * sum(n) OVER () * (weight / sum(weight) OVER ()) / n AS rate FROM counts
), parts AS (
    SELECT source, greatest(ceil(rate / {DRAW_MEAN}), 1)::INT AS draws, rate / greatest(ceil(rate / {DRAW_MEAN}), 1)::INT AS mean FROM rates
), terms AS (
    SELECT source, draws, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS total FROM parts
    UNION ALL
    SELECT source, draws, mean, k + 1, p * mean / (k + 1), total + p * mean / (k + 1) FROM terms WHERE k + 1 < {TERMS}
), tables AS (
    SELECT source, draws, list(total) AS cdf FROM terms GROUP BY source, draws
), hashed AS (
    SELECT d.*, draws, cdf, md5(concat_ws(':', '7', coalesce(doc_id::VARCHAR, ''), coalesce(d.source, ''), md5(coalesce(text, '')))) AS h
    FROM documents d JOIN tables t ON t.source IS NOT DISTINCT FROM d.source
), drawn AS (
    SELECT *, list_sum(list_transform(range(draws), lambda j: len(list_filter(cdf, lambda c:
        c <= ('0x' || substr(md5(h || ':' || j::VARCHAR), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)))) AS n_copies
    FROM hashed
), copies AS (
    SELECT *, unnest(range(n_copies::BIGINT))::INT AS copy FROM drawn WHERE n_copies > 0
)
SELECT doc_id, text, lang, source, n_chars, copy, md5('order:' || h || ':' || copy::VARCHAR) AS shuffle_key FROM copies
"""


def _op10() -> str:
    rules = Rules()

    def common(lang: str) -> str:
        return "[" + ", ".join(f"len(list_filter(words, lambda x: x = '{word}'))" for word in COMMON_WORDS[lang]) + "]"

    chosen = " ".join(f"WHEN lang = '{lang}' THEN {common(lang)}" for lang in COMMON_WORDS)
    removed = {"lower": "[a-z]", "upper": "[A-Z]", "digit": "[0-9]", "wide": r"[^\x00-\x7F]", "symbols": "[#*$%&|<>]"}
    counts = ", ".join(f"length(t) - length(regexp_replace(t, '{pattern}', '', 'g')) AS n_{name}" for name, pattern in removed.items())

    def mean(bins: str, n: int, enough: str) -> str:
        return "[" + ", ".join(f"avg({bins}[{i + 1}] / list_sum({bins})) FILTER (WHERE {enough})" for i in range(n)) + "]"

    def distance(bins: str, reference: str) -> str:
        part = "CASE WHEN {0} > 0 THEN {0} * log2({0} / ((p + q) / 2)) ELSE 0 END"
        each = f"list_transform(list_zip({bins}, {reference}), lambda z: {{'p': z[1] / list_sum({bins}), 'q': z[2]}})"
        total = f"list_sum(list_transform({each}, lambda s: {part.format('p')} + {part.format('q')})) / 2"
        total = total.replace("(p + q)", "(s.p + s.q)").replace("WHEN p", "WHEN s.p").replace("THEN p", "THEN s.p").replace("log2(p", "log2(s.p")
        total = total.replace("WHEN q", "WHEN s.q").replace("THEN q", "THEN s.q").replace("log2(q", "log2(s.q")
        return f"round(sqrt(greatest({total}, 0)), 6)"

    chars, words = f"n_length >= {rules.guard_chars}", f"n_words >= {rules.guard_words} AND listed"
    return rf"""
WITH texts AS (
    SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), places AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts
), windows AS (
    SELECT doc_id, place, word AS a, lead(word) OVER w AS b, lead(word, 2) OVER w AS c FROM places WINDOW w AS (PARTITION BY doc_id ORDER BY place)
), again AS (
    SELECT doc_id, place FROM windows WHERE c IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1
), covered AS (
    SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, place + unnest([0, 1, 2]) AS at FROM again) GROUP BY doc_id
), measured AS (
    SELECT doc_id, lang, words, t, length(t) AS n_length, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
           list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines, {counts},
           coalesce(covered.n, 0) AS n_repeat_words, coalesce(lang IN ({', '.join(f"'{x}'" for x in COMMON_WORDS)}), false) AS listed,
           CASE {chosen} ELSE list_transform(range({N_COMMON}), lambda x: 0) END AS found
    FROM texts LEFT JOIN covered USING (doc_id)
), binned AS (
    SELECT *, [n_lower, n_upper, n_digit, n_length - word_chars, n_wide, word_chars - n_lower - n_upper - n_digit - n_wide]::DOUBLE[] AS chars,
           list_append(found, n_words - list_sum(found))::DOUBLE[] AS common
    FROM measured
), reference AS (
    SELECT lang, {mean('chars', len(CLASSES), chars)} AS chars_reference, {mean('common', N_COMMON + 1, words)} AS words_reference,
           count(*) FILTER (WHERE {chars}) AS n_chars_judged, count(*) FILTER (WHERE {words}) AS n_words_judged
    FROM binned GROUP BY lang
), judged AS (
    SELECT b.*, n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeated} * n_words AS base_failed,
           CASE WHEN {chars} AND n_chars_judged >= {rules.guard_documents} THEN {distance('chars', 'chars_reference')} END AS chars_distance,
           CASE WHEN {words} AND n_words_judged >= {rules.guard_documents} THEN {distance('common', 'words_reference')} END AS words_distance
    FROM binned b JOIN reference r ON r.lang IS NOT DISTINCT FROM b.lang
)
SELECT doc_id, lang, n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_repeat_words, base_failed,
       chars_distance, words_distance,
       NOT base_failed AND coalesce(chars_distance, 0) <= {rules.max_chars_distance} AND coalesce(words_distance, 0) <= {rules.max_words_distance} AS kept
FROM judged
"""


OP11 = f"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
           sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS digest
    FROM documents
), drawn AS (
    SELECT *, len(units) AS n, ('0x' || substr(digest, 1, 8))::BIGINT % (len(units) + 1) AS one,
           ('0x' || substr(digest, 9, 8))::BIGINT % (len(units) + 1) AS two,
           CASE WHEN t = '' OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}')
                  OR ('0x' || substr(digest, 17, 8))::BIGINT % 100 >= {100 - PLAIN_SHARE} THEN 'plain'
                WHEN ('0x' || substr(digest, 25, 8))::BIGINT % 100 < {SPM_SHARE} THEN 'spm' ELSE 'psm' END AS form
    FROM texts
), parted AS (
    SELECT *, array_to_string(units[1:least(one, two)], '') AS prefix, array_to_string(units[least(one, two) + 1:greatest(one, two)], '') AS middle,
           array_to_string(units[greatest(one, two) + 1:], '') AS suffix
    FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
                        ELSE '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parted
"""


def _op12() -> str:
    steps = []
    for turn in range(ROUNDS + 1):
        # Entries by part, entry and position; the nearest one of each part of each vector; and its mean.
        steps.append(f"""
near{turn} AS MATERIALIZED (
    SELECT number, part, min(distance * {ENTRIES} + entry) % {ENTRIES} AS entry, min(distance) AS distance
    FROM (SELECT v.number, v.part, b.entry, sum((v.x - b.c) * (v.x - b.c))::BIGINT AS distance
          FROM pieces v JOIN books{turn} b USING (part, place) GROUP BY v.number, v.part, b.entry)
    GROUP BY number, part
)""")
        if turn < ROUNDS:
            steps.append(f"""
means{turn} AS MATERIALIZED (
    SELECT part, entry, place, sum(x)::BIGINT AS s, count(*) AS n FROM near{turn} JOIN pieces USING (number, part) GROUP BY part, entry, place
), books{turn + 1} AS MATERIALIZED (
    SELECT part, entry, place, CASE WHEN n IS NULL THEN c ELSE ((s - ((s % n) + n) % n) // n)::BIGINT END AS c
    FROM books{turn} LEFT JOIN means{turn} USING (part, entry, place)
)""")
    return f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v, row_number() OVER () AS number FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pieces AS MATERIALIZED (
    SELECT number, (spot - 1) // (size // {PARTS}) AS part, (spot - 1) % (size // {PARTS}) AS place, x
    FROM (SELECT number, len(v) AS size, unnest(v) AS x, generate_subscripts(v, 1) AS spot FROM kept)
), firsts AS (
    SELECT number, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS entry FROM kept QUALIFY entry < {ENTRIES}
), books0 AS MATERIALIZED (
    SELECT part, entry, place, x AS c FROM pieces JOIN firsts USING (number)
), {",".join(steps)},
coded AS (
    SELECT vec_id, label, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' ORDER BY part) AS code, sum(distance)::BIGINT AS error
    FROM near{ROUNDS} JOIN kept USING (number) GROUP BY number, vec_id, label
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, place)) FROM books{ROUNDS}) AS codebooks_sha256
FROM coded
"""


ORACLES = {
    "op1_embedding_dedup": OP1, "op3_preference_formatting": OP3, "op5_poisson_mixing": OP5, "op10_quality_rules": _op10(),
    "op11_fill_in_middle": OP11, "op12_vector_codes": _op12(),
}
