"""The registered queries as SQL over the same tables, written without joins on segments,
inverted indexes or staging: every pair is compared."""

from __future__ import annotations

from namewright.config import LETTERS, STOPWORDS

STOP = "[" + ", ".join(f"'{w}'" for w in STOPWORDS) + "]"
OLD, NEW = "".join(o for o, _ in LETTERS), "".join(n for _, n in LETTERS)
WORD = r"\p{L}\p{N}_"
LETTERS_PATTERN = r"[^a-z\s]"


def fold(expr: str) -> str:
    return f"translate(lower({expr}), '{OLD}', '{NEW}')"


def dedupe(words: str) -> str:
    """Keep the first occurrence of each word that is no stopword."""
    return (
        f"list_filter({words}, lambda w, i: list_position({words}, w) = i "
        f"AND NOT list_contains({STOP}, w))"
    )


def strip_first(expr: str, punctuation: str = r"[^a-z0-9\s]") -> str:
    return f"coalesce(array_to_string({dedupe(stripped_words(expr, punctuation))}, ' '), '')"


def fold_first(expr: str) -> str:
    runs = f"regexp_extract_all({fold(expr)}, '[{WORD}]+|[^{WORD}]+')"
    kept = f"array_to_string(list_filter({runs}, lambda w: NOT list_contains({STOP}, w)), '')"
    squeezed = rf"trim(regexp_replace({kept}, '[\x09-\x0d\x1c-\x20\x{{85}}\p{{Z}}]+', ' ', 'g'))"
    return rf"""trim(regexp_replace({squeezed}, '[.,?!@#$%^&*()\-+={{}}\[\]:;''"]', ' ', 'g'))"""


def tokens(expr: str) -> str:
    runs = rf"regexp_extract_all({fold(expr)}, '[\p{{L}}\p{{Nl}}\p{{No}}_]+')"
    return f"list_filter({runs}, lambda t: length(t) BETWEEN 2 AND 15 AND t[1] <> '_')"


def first_words(name: str, source: str, keys: str, words: str) -> str:
    """CTE of the distinct words per key without stopwords: keys, token, pos of first occurrence."""
    return f"""
{name} AS (
  SELECT {keys}, token, min(pos) AS pos FROM (
    SELECT {keys}, unnest({words}) AS token, generate_subscripts({words}, 1) AS pos FROM {source})
  WHERE NOT list_contains({STOP}, token) GROUP BY ALL)"""


def rejoined(name: str, source: str, keys: str, words: str, out: str) -> str:
    """CTEs of the distinct words per key, joined by blanks as ``out``."""
    return f"""{first_words(name + '_words', source, keys, words)},
{name} AS (
  SELECT {keys}, coalesce(string_agg(token, ' ' ORDER BY pos), '') AS {out}
  FROM (SELECT {keys} FROM {source}) LEFT JOIN {name}_words USING ({keys}) GROUP BY ALL)"""


def stripped_words(expr: str, punctuation: str = r"[^a-z0-9\s]") -> str:
    stripped = f"translate(regexp_replace(lower({expr}), '{punctuation}', '', 'g'), '{OLD}', '{NEW}')"
    return rf"string_split(trim(regexp_replace({stripped}, '\s+', ' ', 'g')), ' ')"


ENTITY = """
entity0 AS (
  SELECT p_partkey, p_brand, lower(p_type) || ' ' || p_name AS s FROM part),
entity AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id,
         substr(s, 1, CAST(p_partkey % length(s) AS INT))
           || substr(s, CAST(p_partkey % length(s) AS INT) + 2) AS name,
         p_brand AS cluster
  FROM entity0)"""
CLEAN_ENTITY = f"{ENTITY}, clean_entity AS (SELECT id, {strip_first('name')} AS name, cluster FROM entity)"
SPECIALITY = f"""{CLEAN_ENTITY},
speciality AS (
  SELECT *, CASE WHEN cluster <> 'Brand#7' THEN replace(name, ' ', '|') END AS matched_speciality
  FROM clean_entity)"""
TAXONOMY = """
taxonomy AS (
  SELECT lpad(CAST(min(p_partkey) AS VARCHAR), 12, '0') AS id, p_name AS degree_name
  FROM part GROUP BY p_name)"""
PART_TAXONOMY = """
parts AS (
  SELECT lpad(CAST(min(p_partkey) AS VARCHAR), 12, '0') AS id, concat_ws(' ', lower(p_type), p_brand, p_name) AS degree_name
  FROM part GROUP BY concat_ws(' ', lower(p_type), p_brand, p_name))"""
KEYWORD = """
keyword AS (
  SELECT clean_word, type, load_order FROM (
    SELECT lower(p_type) AS clean_word, 'Level ' || p_type || ' ' || p_brand AS type,
           p_partkey AS load_order,
           row_number() OVER (PARTITION BY lower(p_type) ORDER BY p_partkey) AS r FROM part)
  WHERE r = 1)"""
BENCHMARK = f"""
item AS (
  SELECT lpad(CAST(item_id AS VARCHAR), 12, '0') AS id, {strip_first('text')} AS degree_name
  FROM benchmark)"""
TAXONOMY_WORD_ROWS = f"""{TAXONOMY},
clean_taxonomy AS (SELECT id, {strip_first('degree_name')} AS degree_name FROM taxonomy),
word_rows AS (
  SELECT id, degree_name, unnest(string_split(degree_name, ' ')) AS words FROM clean_taxonomy)"""
TAXONOMY_TARGETS = f"""{TAXONOMY_WORD_ROWS},
target AS (SELECT DISTINCT words AS target, words AS rank FROM word_rows WHERE words <> '')"""
KEYWORD_TARGETS = f"""{KEYWORD},
target AS (SELECT clean_word AS target, load_order AS rank FROM keyword WHERE clean_word <> '')"""
ITEM_TARGETS = f"""{BENCHMARK},
target AS (
  SELECT DISTINCT w AS target, w AS rank
  FROM (SELECT unnest(string_split(degree_name, ' ')) AS w FROM item) WHERE w <> '')"""
VECTORS = """
known AS (
  SELECT DISTINCT w AS word FROM (
    SELECT unnest(string_split(name, ' ')) AS w FROM clean_entity
    UNION ALL SELECT unnest(string_split(degree_name, ' ')) FROM taxonomy) WHERE w <> ''),
vectors AS (
  SELECT word, CAST(embedding AS DOUBLE[]) AS vector FROM known JOIN embeddings
  ON vec_id = (ascii(word) * 7 + ascii(right(word, 1)) * 31 + length(word) * 3)
              % (SELECT count(*) FROM embeddings))"""


def dictionary(suffix: str, names: str, target: str, threshold: float, vectors: bool = False,
               edit: bool = True) -> str:
    """CTEs token{s} (distinct tokens) and dict{s} (best target per token)."""
    parts = []
    if edit:
        parts.append(f"""
    SELECT token, target, rank, 3 AS source,
           1 - levenshtein(regexp_replace(token, '[^a-z_]', '?', 'g'), target)
               / CAST(greatest(length(token), length(target)) AS DOUBLE) AS similarity
    FROM token{suffix} CROSS JOIN {target}""")
    if vectors:
        parts.append(f"""
    SELECT token, target, rank, 1 AS source,
           round(list_cosine_similarity(a.vector, b.vector), 9) AS similarity
    FROM token{suffix} JOIN vectors a ON token = a.word
    CROSS JOIN {target} JOIN vectors b ON target = b.word""")
    return f"""
token{suffix} AS (
  SELECT DISTINCT token FROM (SELECT unnest({tokens('name')}) AS token FROM {names})
  WHERE NOT list_contains({STOP}, token)),
pair{suffix} AS ({' UNION ALL '.join(parts)}),
dict{suffix} AS (
  SELECT token, target, source, similarity FROM (
    SELECT *, row_number() OVER (
      PARTITION BY token ORDER BY similarity DESC, source, rank, target) AS r
    FROM pair{suffix} WHERE similarity >= {threshold})
  WHERE r = 1)"""


def corrected(suffix: str, names: str) -> str:
    """CTE done{s}: corrections of the distinct names of space-separated distinct plain words."""
    return f"""
name{suffix} AS (SELECT DISTINCT name FROM {names} WHERE name IS NOT NULL),
words{suffix} AS (
  SELECT name, unnest(string_split(name, ' ')) AS word,
         generate_subscripts(string_split(name, ' '), 1) AS pos FROM name{suffix}),
text{suffix} AS (
  SELECT name, string_agg(coalesce(target, word), ' ' ORDER BY pos) AS name_corrected
  FROM words{suffix} LEFT JOIN dict{suffix} ON word = token GROUP BY name),
{first_words('found' + suffix, 'name' + suffix, 'name', tokens('name'))},
list{suffix} AS (
  SELECT name, string_agg(target, '|' ORDER BY length(token) DESC, pos) AS matched_words,
         string_agg(token, '|' ORDER BY length(token) DESC, pos) AS original_tokens_matched,
         string_agg(CAST(source AS VARCHAR), '|' ORDER BY length(token) DESC, pos) AS model_sources
  FROM found{suffix} JOIN dict{suffix} USING (token) GROUP BY name),
done{suffix} AS (
  SELECT name, name_corrected, matched_words, original_tokens_matched, model_sources
  FROM text{suffix} LEFT JOIN list{suffix} USING (name))"""


def correct_query(source: str, targets: str, names: str, threshold: float, vectors: str = "") -> str:
    needs = f", {vectors}" if vectors else ""
    return f"""
WITH {source}, {targets}{needs}, {dictionary('1', names, 'target', threshold, bool(vectors))},
{corrected('1', names)}
SELECT {names}.*, name_corrected, matched_words, original_tokens_matched, model_sources
FROM {names} LEFT JOIN done1 USING (name)"""


CLEAN_DOCUMENTS = rejoined("clean_documents", "documents", "doc_id", stripped_words("text"), "name")
TURNS = "turns AS (SELECT conv_id, turn, role, text AS name FROM conversations)"
EDGE = f"[^{WORD}]"
FREE_TEXT = f"""
WITH {TURNS}, {TAXONOMY_TARGETS}, {dictionary('1', 'turns', 'target', 0.7)},
{first_words('found', 'turns', 'conv_id, turn', tokens('name'))},
lists AS (
  SELECT conv_id, turn, list(token || '|' || target ORDER BY length(token) DESC, pos) AS changes,
         string_agg(target, '|' ORDER BY length(token) DESC, pos) AS matched_words,
         string_agg(token, '|' ORDER BY length(token) DESC, pos) AS original_tokens_matched,
         string_agg(CAST(source AS VARCHAR), '|' ORDER BY length(token) DESC, pos) AS model_sources
  FROM found JOIN dict1 USING (token) GROUP BY conv_id, turn)
SELECT turns.*, matched_words, original_tokens_matched, model_sources,
  CASE WHEN changes IS NULL THEN name ELSE list_reduce(changes, lambda running, m: regexp_replace(
    running, '(?is)^((?:.*?{EDGE})??)' || split_part(m, '|', 1) || '((?:{EDGE}.*)?)$',
    '\\1' || split_part(m, '|', 2) || '\\2'), name) END AS name_corrected
FROM turns LEFT JOIN lists USING (conv_id, turn)"""


def overlap(source: str, taxonomy: str, rows: str, columns: str, gate: int) -> str:
    return f"""
WITH {source}, {taxonomy},
scored AS (
  SELECT r.*, t.id AS master_degree_id, t.degree_name AS full_name,
         lower(replace(matched_speciality, '|', ' ')) AS matched_speciality_cleaned,
         string_split(lower(replace(matched_speciality, '|', ' ')), ' ') AS e,
         string_split(lower(t.degree_name), ' ') AS m
  FROM ({rows}) r CROSS JOIN {taxonomy.split(' AS ')[0].strip()} t
  WHERE matched_speciality IS NOT NULL
  UNION ALL
  SELECT r.*, NULL, NULL, NULL, NULL, NULL FROM ({rows}) r WHERE matched_speciality IS NULL),
counted AS (
  SELECT *, CASE WHEN e IS NOT NULL THEN len(list_intersect(e, m)) END AS score FROM scored),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY id ORDER BY score DESC NULLS LAST, master_degree_id, matched_speciality) AS rank
  FROM counted)
SELECT {columns.format(gate=gate)}
FROM ranked WHERE rank = 1"""


GATED = "CASE WHEN score >= {gate} THEN full_name END AS degree_name, CAST(score AS INT) AS match_score"
SHOWN = f"""id, name, master_degree_id, {GATED}, CAST(rank AS INT) AS rank, matched_speciality_cleaned,
  '[''' || coalesce(array_to_string(e, ''','''), '') || ''']' AS education_tokens,
  '[''' || coalesce(array_to_string(m, ''','''), '') || ''']' AS master_tokens"""


def classification(vectors: str, speciality: float) -> str:
    use = bool(vectors)
    needs = f"{vectors}," if vectors else ""
    return f"""
WITH {CLEAN_ENTITY}, {KEYWORD}, {TAXONOMY_WORD_ROWS}, {needs}
types AS (SELECT clean_word AS target, load_order AS rank FROM keyword),
specialities AS (SELECT DISTINCT words AS target, words AS rank FROM word_rows WHERE words <> ''),
{dictionary('1', 'clean_entity', 'types', 0.75, use)}, {corrected('1', 'clean_entity')},
typed AS (SELECT id, cluster, name_corrected AS name, model_sources AS model_source_types,
                 split_part(matched_words, '|', 1) AS matched_type
          FROM clean_entity JOIN done1 USING (name)),
{dictionary('2', 'typed', 'specialities', speciality, use)}, {corrected('2', 'typed')},
specified AS (SELECT id, cluster, name_corrected AS name, model_source_types, matched_type,
                     model_sources AS model_source_specialities, matched_words
              FROM typed JOIN done2 USING (name)),
scored AS (
  SELECT s.*, t.id AS master_degree_id, t.degree_name,
         string_split(replace(matched_words, '|', ' '), ' ') AS e,
         string_split(t.degree_name, ' ') AS m
  FROM specified s LEFT JOIN clean_taxonomy t ON matched_words IS NOT NULL),
best AS (
  SELECT * FROM (
    SELECT *, CASE WHEN e IS NOT NULL THEN CAST(len(list_intersect(e, m)) AS INT) END AS match_score,
           row_number() OVER (PARTITION BY id
             ORDER BY len(list_intersect(e, m)) DESC NULLS LAST, master_degree_id) AS r FROM scored)
  WHERE r = 1)
SELECT id, name, cluster, CASE WHEN match_score >= 2 THEN degree_name END AS degree_name,
       type AS degree_level, matched_type, match_score, model_source_specialities, model_source_types,
       '[''' || coalesce(array_to_string(e, ''','''), '') || ''']' AS education_tokens,
       CASE WHEN e IS NULL THEN '['''']'
            ELSE '[''' || array_to_string(m, ''',''') || ''']' END AS master_tokens
FROM best LEFT JOIN keyword ON matched_type = clean_word"""


ORACLES: dict[str, str] = {
    "clean_strip_first": f"WITH {CLEAN_DOCUMENTS} SELECT doc_id, name AS text FROM clean_documents",
    "clean_letters_only": f"""
WITH {rejoined('cleaned', 'conversations', 'conv_id, turn', stripped_words('text', LETTERS_PATTERN), 'name')}
SELECT conv_id, turn, role, name AS text FROM conversations JOIN cleaned USING (conv_id, turn)""",
    "clean_fold_first": f"SELECT doc_id, {fold_first('text')} AS text FROM documents",
    "fold_letters": f"SELECT conv_id, turn, {fold('text')} AS folded FROM conversations",
    "match_tokens": f"""
WITH {rejoined('kept', 'documents', 'doc_id', tokens('text'), 'words')}
SELECT doc_id, array_to_string({tokens('text')}, ' ') AS tokens, words
FROM documents JOIN kept USING (doc_id)""",
    "word_difference": f"""
WITH {rejoined('kept', 'conversations', 'conv_id, turn', "string_split(lower(text), ' ')", 'kept')}
SELECT conv_id, turn, kept.kept, CAST(count(token) AS INT) AS n
FROM kept LEFT JOIN kept_words USING (conv_id, turn) GROUP BY ALL""",
    "word_intersection": f"""
WITH t AS (SELECT conv_id, turn, {tokens('text')} AS words FROM conversations)
SELECT a.conv_id, a.turn,
       array_to_string(list_sort(list_intersect(a.words, b.words)), ' ') AS shared,
       CAST(len(list_intersect(a.words, b.words)) AS INT) AS match_score
FROM t a JOIN t b ON a.conv_id = b.conv_id AND a.turn = b.turn + 1""",
    "rendered_words": f"""
WITH {SPECIALITY}
SELECT id, '[''' || coalesce(replace(lower(matched_speciality), '|', ''','''), '') || ''']'
         AS education_tokens FROM speciality""",
    "edit_similarity": f"""
WITH {ENTITY}
SELECT id, CAST(levenshtein(name, s) AS INT) AS distance,
       round(1 - levenshtein(name, s) / CAST(greatest(length(name), length(s)) AS DOUBLE), 5) AS similarity
FROM entity JOIN entity0 ON id = CAST(p_partkey AS VARCHAR)""",
    "token_vocabulary": f"""
WITH {CLEAN_DOCUMENTS}
SELECT word, count(*) AS n FROM (
  SELECT unnest({tokens('name')}) AS word FROM clean_documents)
GROUP BY word HAVING count(*) >= 2""",
    "taxonomy_word_rows": f"WITH {TAXONOMY_WORD_ROWS} SELECT id, degree_name, words FROM word_rows",
    "taxonomy_word_list": f"WITH {TAXONOMY_WORD_ROWS} SELECT DISTINCT words AS target FROM word_rows",
    "keyword_dedupe": f"WITH {KEYWORD} SELECT clean_word, type, load_order FROM keyword",
    "level_lookup": f"""
WITH {CLEAN_ENTITY}, {KEYWORD_TARGETS}, {dictionary('1', 'clean_entity', 'target', 0.75)},
{corrected('1', 'clean_entity')}
SELECT id, cluster, name_corrected AS name, model_sources AS model_source_types,
       split_part(matched_words, '|', 1) AS matched_type, type AS degree_level
FROM clean_entity JOIN done1 USING (name)
LEFT JOIN keyword ON split_part(matched_words, '|', 1) = clean_word""",
    "corpus_shape": """
SELECT count(*) AS n_rows, CAST((SELECT count(*) FROM (DESCRIBE documents)) AS INT) AS n_columns
FROM documents""",
    "fuzzy_dictionary_low_threshold": f"""
WITH {CLEAN_ENTITY}, {TAXONOMY_TARGETS}, {dictionary('1', 'clean_entity', 'target', 0.3)}
SELECT token, target, source, round(similarity, 5) AS similarity FROM dict1""",
    "fuzzy_dictionary": f"""
WITH {CLEAN_ENTITY}, {TAXONOMY_TARGETS}, {dictionary('1', 'clean_entity', 'target', 0.75)}
SELECT token, target, source, round(similarity, 5) AS similarity FROM dict1""",
    "fuzzy_dictionary_documents": f"""
WITH {CLEAN_DOCUMENTS}, {ITEM_TARGETS}, {dictionary('1', 'clean_documents', 'target', 0.8)}
SELECT token, target, source, round(similarity, 5) AS similarity FROM dict1""",
    "fuzzy_correct_names": correct_query(CLEAN_ENTITY, TAXONOMY_TARGETS, "clean_entity", 0.8),
    "fuzzy_correct_keywords": correct_query(CLEAN_ENTITY, KEYWORD_TARGETS, "clean_entity", 0.75),
    "fuzzy_correct_documents": correct_query(CLEAN_DOCUMENTS, TAXONOMY_TARGETS, "clean_documents", 0.75),
    "fuzzy_correct_free_text": FREE_TEXT,
    "fuzzy_correct_with_vectors": correct_query(
        CLEAN_ENTITY, TAXONOMY_TARGETS, "clean_entity", 0.75, VECTORS),
    "semantic_dictionary": f"""
WITH {CLEAN_ENTITY}, {TAXONOMY_TARGETS}, {VECTORS},
{dictionary('1', 'clean_entity', 'target', 0.3, True, False)}
SELECT token, target, round(similarity, 5) AS similarity FROM dict1""",
    "preview_corrections": correct_query(
        CLEAN_ENTITY, TAXONOMY_TARGETS, "clean_entity", 0.8) + " ORDER BY CAST(id AS BIGINT) LIMIT 50",
    "overlap_best": overlap(SPECIALITY, TAXONOMY, "SELECT * FROM speciality", SHOWN, 0),
    "overlap_gate": overlap(SPECIALITY, TAXONOMY, "SELECT * FROM speciality", SHOWN, 2),
    "overlap_per_cluster": overlap(
        SPECIALITY, TAXONOMY, "SELECT cluster AS id, matched_speciality FROM speciality",
        f"id, matched_speciality, master_degree_id, {GATED}, CAST(rank AS INT) AS rank", 2),
    "overlap_large_taxonomy": overlap(
        SPECIALITY, PART_TAXONOMY, "SELECT * FROM speciality", f"id, master_degree_id, {GATED}", 2),
    "overlap_documents": overlap(
        CLEAN_DOCUMENTS, BENCHMARK, "SELECT doc_id AS id, name AS matched_speciality FROM clean_documents",
        f"id, master_degree_id, {GATED}", 2),
    "classify_names": classification("", 0.8),
    "classify_names_with_vectors": classification(VECTORS, 0.75),
    "cosine_pairs": """
WITH firsts AS (SELECT label, arg_min(embedding, vec_id) AS f FROM embeddings GROUP BY label)
SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(f AS DOUBLE[])), 5)
         AS similarity FROM embeddings JOIN firsts USING (label)""",
    "cosine_best": """
WITH firsts AS (SELECT label, min(vec_id) AS v, arg_min(embedding, vec_id) AS f
                FROM embeddings GROUP BY label),
scored AS (
  SELECT vec_id, firsts.label AS best_label, v,
         list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(f AS DOUBLE[])) AS similarity
  FROM embeddings CROSS JOIN firsts),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY vec_id ORDER BY round(similarity, 9) DESC, v) AS r FROM scored)
  WHERE r = 1 AND similarity >= 0.1)
SELECT e.vec_id, best_label, round(similarity, 5) AS similarity
FROM embeddings e LEFT JOIN best USING (vec_id)""",
    "mean_vector": """
SELECT label, CAST(position AS INT) AS position, round(avg(value), 5) AS value FROM (
  SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS value,
         generate_subscripts(embedding, 1) - 1 AS position FROM embeddings)
GROUP BY ALL""",
    "word_mean_vector": f"""
WITH {CLEAN_ENTITY}, {TAXONOMY}, {VECTORS},
words AS (SELECT id, unnest(string_split(degree_name, ' ')) AS word FROM taxonomy)
SELECT id, CAST(position AS INT) AS position, round(avg(value), 5) AS value FROM (
  SELECT id, unnest(vector) AS value, generate_subscripts(vector, 1) - 1 AS position
  FROM words JOIN vectors USING (word) WHERE NOT list_contains({STOP}, word))
GROUP BY ALL""",
    "match_by_vector": f"""
WITH {SPECIALITY}, {TAXONOMY}, {VECTORS},
texts AS (
  SELECT DISTINCT matched_speciality AS t, unnest(string_split(matched_speciality, '|')) AS word,
         generate_subscripts(string_split(matched_speciality, '|'), 1) AS i FROM speciality
  UNION ALL
  SELECT degree_name, unnest(string_split(degree_name, ' ')),
         -generate_subscripts(string_split(degree_name, ' '), 1) FROM taxonomy),
means AS (
  SELECT t, kind, list(value ORDER BY position) AS vector FROM (
    SELECT t, i > 0 AS kind, position, avg(value) AS value FROM (
      SELECT t, i, unnest(vector) AS value, generate_subscripts(vector, 1) AS position
      FROM texts JOIN vectors USING (word) WHERE NOT list_contains({STOP}, word))
    GROUP BY ALL) GROUP BY ALL),
scored AS (
  SELECT a.t, x.id AS tid, x.degree_name, list_cosine_similarity(a.vector, b.vector) AS similarity
  FROM means a CROSS JOIN taxonomy x JOIN means b ON b.t = x.degree_name AND NOT b.kind WHERE a.kind),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY t ORDER BY round(similarity, 9) DESC, tid) AS r FROM scored)
  WHERE r = 1 AND similarity >= 0.6)
SELECT speciality.*, degree_name AS best_match_degree_name,
       round(similarity, 5) AS best_match_similarity
FROM speciality LEFT JOIN best ON matched_speciality = t""",
    "vectors_from_text": f"""
WITH {CLEAN_ENTITY}, {TAXONOMY}, {VECTORS}
SELECT word, len(vector)::INT AS n_dimensions, round(list_sum(vector), 5) AS total FROM vectors""",
    "nearest_words_of_all": f"""
WITH {CLEAN_ENTITY}, {TAXONOMY}, {VECTORS}, pairs AS (
  SELECT a.word, b.word AS neighbour, list_cosine_similarity(a.vector, b.vector) AS s FROM vectors a JOIN vectors b ON a.word <> b.word)
SELECT word, neighbour, round(s, 5) AS similarity, place::INT AS place
FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY round(s, 9) DESC, neighbour) AS place FROM pairs) WHERE place <= 3""",
    "nearest_vectors": """
WITH pairs AS (
  SELECT a.vec_id, b.vec_id AS candidate, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS s
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)
SELECT vec_id, candidate, round(s, 5) AS similarity, place::INT AS place
FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(s, 9) DESC, candidate) AS place FROM pairs) WHERE place <= 4""",
    "nearest_words": f"""
WITH {CLEAN_ENTITY}, {TAXONOMY}, {VECTORS}
SELECT a.word, round(list_cosine_similarity(a.vector, b.vector), 5) AS similarity
FROM vectors a CROSS JOIN vectors b WHERE b.word = 'ring' AND a.word <> 'ring'
ORDER BY round(list_cosine_similarity(a.vector, b.vector), 9) DESC, a.word LIMIT 10""",
    "word2vec_vocabulary": f"""
SELECT word, 100 AS n_dimensions FROM (
  SELECT unnest({tokens('name')}) AS word FROM (SELECT {fold_first('text')} AS name FROM documents))
GROUP BY word HAVING count(*) >= 2""",
    "csv_round_trip": "SELECT conv_id, turn, role, text FROM conversations",
    "corpus_from_csv": f"WITH {ENTITY} SELECT id, name, cluster FROM entity",
    "dimension_from_csv": f"WITH {TAXONOMY} SELECT id, degree_name FROM taxonomy",
    "word2vec_neighbours": f"""
WITH vocabulary AS (
  SELECT word FROM (SELECT unnest({tokens('name')}) AS word FROM (SELECT {fold_first('text')} AS name FROM documents))
  GROUP BY word HAVING count(*) >= 2)
SELECT least(10, count(*) - 1) AS n_neighbours, least(10, count(*) - 1) AS n_known, 0::BIGINT AS n_itself, 0::BIGINT AS n_out_of_order
FROM vocabulary""",
    "corpus_with_bad_quotes": f"""
WITH {ENTITY}
SELECT id, CASE WHEN id::BIGINT % 5 = 0 THEN '"' || name ELSE name END AS name,
       CASE WHEN id::BIGINT % 7 = 2 THEN NULL ELSE cluster END AS cluster FROM entity""",
    "corpus_rejects": "SELECT 'columns missing' AS reason, (count(*) > 0)::BIGINT AS n_files FROM part",
    "corpus_with_line_breaks": "SELECT doc_id, nullif(text, '') AS name, nullif(source, '') AS cluster FROM documents",
    "entities_with_quotes_at_line_ends": f"""
        WITH {ENTITY}
        SELECT id, CASE id::BIGINT % 4 WHEN 0 THEN replace(name, ' ', chr(10)) WHEN 1 THEN '"' || name WHEN 2 THEN name || ' 5" wide' ELSE name END AS name, cluster
        FROM entity""",
    "corpus_with_a_long_header": f"WITH {ENTITY} SELECT id, name, cluster FROM entity",
    "entities_of_several_layouts": f"""
WITH {ENTITY}
SELECT id, name, CASE WHEN name < 'h' OR name >= 'q' THEN cluster END AS cluster FROM entity""",
}
ORACLES["classify_from_files"] = ORACLES["classify_names"]
ORACLES["cosine_best_in_blocks"] = ORACLES["cosine_best"]
ORACLES["match_by_vector_hot_words"] = ORACLES["match_by_vector"]
