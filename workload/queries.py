"""The registered queries."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from namewright.config import LETTERS, LETTERS_AND_DIGITS, STOPWORDS, Thresholds
from namewright.functions import similarity, text
from namewright.operators import dimensions, fuzzy, overlap, vector_match
from namewright.operators.cleaning import clean_column, taxonomy_words
from namewright.operators.cosine_match import cosine_matches
from namewright.operators.cosine_search import PivotIndex, most_similar
from namewright.plans.classify import classify, classify_files
from namewright.plans.training import train_word_vectors
from namewright.sources import csv, staging, tables
from workload import tables as given
from workload.tables import table

ROUND = 5
#: Parts trained at once; fixed, as the vectors depend on it.
TRAINING_PARTS = 8


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{staging.run_folder(spark)}/{name}-{uuid.uuid4().hex}"


# Text functions

def clean_strip_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return clean_column(documents, "text", punctuation=LETTERS_AND_DIGITS)


def _cleaned_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written once: cleaning costs far more than reading, and what follows reads its input several times."""
    return staging.stage(clean_strip_first(spark, sf_dir), "cleaned-documents")


def clean_letters_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_column(table(spark, sf_dir, "conversations"), "text")


def clean_fold_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return clean_column(documents, "text", mode="fold_first")


def fold_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", text.fold_letters(F.lower("text")).alias("folded"))


def match_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    tokens, words = text.match_tokens(F.col("text")), text.match_words(F.col("text"))
    return documents.select(
        "doc_id", F.concat_ws(" ", tokens).alias("tokens"), F.concat_ws(" ", words).alias("words")
    )


def word_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    kept = text.drop_stopwords(F.split(F.lower("text"), " "))
    return turns.select("conv_id", "turn", F.concat_ws(" ", kept).alias("kept"), F.size(kept).alias("n"))


def word_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words each turn shares with the turn before."""
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", text.match_tokens(F.col("text")).alias("words")
    )
    earlier = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("words").alias("before"))
    shared = F.array_intersect("words", "before")
    return turns.join(earlier, ["conv_id", "turn"]).select(
        "conv_id", "turn", F.concat_ws(" ", F.array_sort(shared)).alias("shared"),
        similarity.shared_words(F.col("words"), F.col("before")).alias("match_score"),
    )


def rendered_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = text.overlap_words(F.col("matched_speciality"))
    return given.specialities(spark, sf_dir).select("id", text.render_list(words).alias("education_tokens"))


def edit_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each damaged name against the name it came from."""
    part = table(spark, sf_dir, "part")
    whole = F.concat(F.lower("p_type"), F.lit(" "), F.col("p_name"))
    origins = part.select(F.col("p_partkey").cast("string").alias("id"), whole.alias("origin"))
    pairs = given.entities(spark, sf_dir).join(origins, "id")
    close = similarity.edit_similarity(F.col("name"), F.col("origin"))
    return pairs.select("id", F.levenshtein("name", "origin").alias("distance"),
                        F.round(close, ROUND).alias("similarity"))


# Dimensions

def token_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.vocabulary(clean_strip_first(spark, sf_dir), "text")


def taxonomy_word_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy_words(given.taxonomy(spark, sf_dir))


def taxonomy_word_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.distinct_words(taxonomy_word_rows(spark, sf_dir))


def keyword_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.keep_first(given.keyword_rows(spark, sf_dir), ["clean_word"], ["load_order"])


def level_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    corrected = fuzzy_correct_keywords(spark, sf_dir)
    leveled = dimensions.lookup_level(dimensions.first_match(corrected), keyword_dedupe(spark, sf_dir))
    return dimensions.rename(
        leveled.drop("original_tokens_matched", "matched_words"),
        {"name_corrected": "name", "model_sources": "model_source_types"},
    )


def corpus_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.corpus_shape(table(spark, sf_dir, "documents"))


# Fuzzy correction

def _taxonomy_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy_word_list(spark, sf_dir)


def fuzzy_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = fuzzy.text_tokens(given.cleaned_entities(spark, sf_dir), "name")
    targets = fuzzy.as_targets(spark, _taxonomy_targets(spark, sf_dir))
    found = fuzzy.correction_dictionary(tokens, targets, 0.75)
    return found.withColumn("similarity", F.round("similarity", ROUND))


def fuzzy_dictionary_low_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A threshold at which many words are too short to be cut into segments."""
    tokens = fuzzy.text_tokens(given.cleaned_entities(spark, sf_dir), "name")
    targets = fuzzy.as_targets(spark, _taxonomy_targets(spark, sf_dir))
    found = fuzzy.correction_dictionary(tokens, targets, 0.3)
    return found.withColumn("similarity", F.round("similarity", ROUND))


def fuzzy_dictionary_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents against the words of the benchmark items."""
    tokens = fuzzy.text_tokens(clean_strip_first(spark, sf_dir), "text")
    words = taxonomy_words(given.benchmark_taxonomy(spark, sf_dir))
    targets = fuzzy.as_targets(spark, dimensions.distinct_words(words))
    found = fuzzy.correction_dictionary(tokens, targets, 0.8)
    return found.withColumn("similarity", F.round("similarity", ROUND))


def _correct(spark, names, targets, threshold, vectors=None) -> DataFrame:
    return fuzzy.correct_words(names, "name", targets, STOPWORDS, LETTERS, threshold, "|", vectors)


def fuzzy_correct_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = given.cleaned_entities(spark, sf_dir)
    return _correct(spark, names, _taxonomy_targets(spark, sf_dir), 0.8)


def fuzzy_correct_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = given.cleaned_entities(spark, sf_dir)
    keywords = keyword_dedupe(spark, sf_dir)
    targets = keywords.select(F.col("clean_word").alias("target"), F.col("load_order").alias("rank"))
    return _correct(spark, names, targets, 0.75)


def fuzzy_correct_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole cleaned documents corrected towards the taxonomy words."""
    names = _cleaned_documents(spark, sf_dir).withColumnRenamed("text", "name")
    return _correct(spark, names, _taxonomy_targets(spark, sf_dir), 0.75)


def fuzzy_correct_free_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw conversation turns: mixed case, accents, repeats and punctuation."""
    turns = table(spark, sf_dir, "conversations").withColumnRenamed("text", "name")
    return _correct(spark, turns, _taxonomy_targets(spark, sf_dir), 0.7)


def fuzzy_correct_with_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = given.cleaned_entities(spark, sf_dir)
    vectors = staging.stage(given.word_vectors(spark, sf_dir), "vectors")
    return _correct(spark, names, _taxonomy_targets(spark, sf_dir), 0.75, vectors)


def semantic_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = staging.stage(given.word_vectors(spark, sf_dir), "vectors")
    tokens = fuzzy.text_tokens(given.cleaned_entities(spark, sf_dir), "name")
    targets = fuzzy.as_targets(spark, _taxonomy_targets(spark, sf_dir))
    known = vectors.withColumnRenamed("word", "token")
    offered = targets.join(vectors.withColumnRenamed("word", "target"), "target")
    found = cosine_matches(tokens.join(known, "token"), offered, 0.3)
    return found.select("token", "target", F.round("similarity", ROUND).alias("similarity"))


def preview_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    corrected = fuzzy_correct_names(spark, sf_dir)
    return corrected.orderBy(F.col("id").cast("bigint")).limit(50)


# Classification

OVERLAP_COLUMNS = ("id", "name", "master_degree_id", "degree_name", "match_score", "rank")


def _shown(df: DataFrame) -> DataFrame:
    return df.select(
        *OVERLAP_COLUMNS, "matched_speciality_cleaned",
        text.render_list(F.col("education_tokens")).alias("education_tokens"),
        text.render_list(F.col("master_tokens")).alias("master_tokens"),
    )


def overlap_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = given.specialities(spark, sf_dir)
    return _shown(overlap.classify_by_overlap(named, given.taxonomy(spark, sf_dir), 0))


def overlap_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = given.specialities(spark, sf_dir)
    return _shown(overlap.classify_by_overlap(named, given.taxonomy(spark, sf_dir), 2))


def overlap_per_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few ids with very many rows each: the best row per id remains."""
    named = given.specialities(spark, sf_dir).select(F.col("cluster").alias("id"), "matched_speciality")
    best = overlap.classify_by_overlap(named, given.taxonomy(spark, sf_dir), 2)
    return best.select("id", "matched_speciality", "master_degree_id", "degree_name", "match_score", "rank")


def overlap_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark item that shares most words with each document."""
    documents = _cleaned_documents(spark, sf_dir).select(
        F.col("doc_id").alias("id"), F.col("text").alias("matched_speciality")
    )
    best = overlap.classify_by_overlap(documents, given.benchmark_taxonomy(spark, sf_dir), 2)
    return best.select("id", "master_degree_id", "degree_name", "match_score")


def overlap_large_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A taxonomy that grows with the parts, over few words: nearly all of them are frequent."""
    named, parts = given.specialities(spark, sf_dir), given.part_taxonomy(spark, sf_dir)
    best = overlap.classify_by_overlap(named, parts, 2, rows_per_split=500, max_postings=20)
    return best.select("id", "master_degree_id", "degree_name", "match_score")


def _classify(spark: SparkSession, sf_dir: str, vectors: DataFrame | None, speciality: float) -> DataFrame:
    return classify(
        given.entities(spark, sf_dir), given.keyword_rows(spark, sf_dir), given.taxonomy(spark, sf_dir),
        "load_order", vectors, Thresholds(0.75, speciality, 2),
    )


def classify_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classify(spark, sf_dir, None, 0.8)


def classify_names_with_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = staging.stage(given.word_vectors(spark, sf_dir), "vectors")
    return _classify(spark, sf_dir, vectors, 0.75)


def classify_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from CSV to CSV; the keywords count in the order of their file."""
    entities, keywords, degrees, result = (_scratch(spark, n) for n in ("entities", "keywords", "degrees", "result"))
    csv.write_result(given.entities(spark, sf_dir), entities)
    ordered = given.keyword_rows(spark, sf_dir).repartitionByRange(3, "load_order").sortWithinPartitions("load_order")
    csv.write_result(ordered.select("clean_word", "type"), keywords)
    csv.write_result(given.taxonomy(spark, sf_dir), degrees)
    classify_files(spark, entities, keywords, degrees, result, thresholds=Thresholds(0.75, 0.8, 2))
    read = csv.read_entities(spark, result)
    return read.withColumn("match_score", F.col("match_score").cast("int"))


# Vectors

def cosine_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector against the first of its label."""
    embeddings = table(spark, sf_dir, "embeddings")
    firsts = embeddings.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("first"))
    close = similarity.cosine_similarity(F.col("embedding"), F.col("first"))
    return embeddings.join(firsts, "label").select("vec_id", F.round(close, ROUND).alias("similarity"))


def cosine_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors, firsts = given.labelled_vectors(spark, sf_dir)
    best = cosine_matches(vectors, firsts, 0.1)
    joined = vectors.select("vec_id").join(best, "vec_id", "left")
    return joined.select("vec_id", "best_label", F.round("similarity", ROUND).alias("similarity"))


def cosine_best_in_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through many small blocks of both sides."""
    vectors, firsts = given.labelled_vectors(spark, sf_dir)
    best = cosine_matches(vectors, firsts, 0.1, broadcast_rows=0, candidate_block=3, query_block=150)
    joined = vectors.select("vec_id").join(best, "vec_id", "left")
    return joined.select("vec_id", "best_label", F.round("similarity", ROUND).alias("similarity"))


def mean_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = vector_match.mean_vectors(table(spark, sf_dir, "embeddings"), ["label"], "embedding")
    return means.select("label", F.posexplode("vector").alias("position", "value")).withColumn(
        "value", F.round("value", ROUND)
    )


def word_mean_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = staging.stage(given.word_vectors(spark, sf_dir), "vectors")
    names = given.taxonomy(spark, sf_dir)
    means = vector_match.word_mean_vectors(names, F.split("degree_name", " "), vectors)
    return means.select("id", F.posexplode("vector").alias("position", "value")).withColumn(
        "value", F.round("value", ROUND)
    )


def match_by_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = staging.stage(given.word_vectors(spark, sf_dir), "vectors")
    named = given.specialities(spark, sf_dir)
    best = vector_match.match_by_vector(named, given.taxonomy(spark, sf_dir), vectors, threshold=0.6)
    return best.withColumn("best_match_similarity", F.round("best_match_similarity", ROUND))


def match_by_vector_hot_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a vocabulary beyond what may be broadcast: its frequent words are, the others are shuffled."""
    vectors = staging.stage(given.word_vectors(spark, sf_dir), "vectors")
    named = given.specialities(spark, sf_dir)
    best = vector_match.match_by_vector(named, given.taxonomy(spark, sf_dir), vectors, threshold=0.6, broadcast_bytes=4096)
    return best.withColumn("best_match_similarity", F.round("best_match_similarity", ROUND))


def nearest_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten words closest to ``ring`` among the words of the names."""
    vectors = staging.stage(given.word_vectors(spark, sf_dir), "vectors")
    return vector_match.nearest_words(vectors, "ring", 10).select(
        F.round("similarity", ROUND).alias("similarity"), "word"
    )


def vectors_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The word vectors written as lines of text and read back."""
    path = _scratch(spark, "text-vectors")
    tables.write_vectors_text(given.word_vectors(spark, sf_dir), path)
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x)
    return tables.read_vectors_text(spark, path).select("word", F.size("vector").alias("n_dimensions"), F.round(total, ROUND).alias("total"))


def nearest_words_of_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three words closest to each word of the names."""
    vectors = staging.stage(given.word_vectors(spark, sf_dir), "vectors")
    found = vector_match.nearest_words_of(vectors, vectors, 3)
    return found.withColumn("similarity", F.round("similarity", ROUND))


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four embeddings closest to each one, itself left out, by pivots and bands."""
    embeddings = table(spark, sf_dir, "embeddings")
    index = PivotIndex(embeddings, "vec_id", "embedding")
    found, _ = most_similar(index, embeddings, "vec_id", 4, "embedding", leave_out_itself=True)
    return found.withColumn("similarity", F.round("similarity", ROUND))


def _trained(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(F.col("text").alias("name"))
    model = train_word_vectors(documents, TRAINING_PARTS)
    path = _scratch(spark, "model")
    tables.write_model(model, path)
    vectors = _scratch(spark, "vectors")
    tables.write_vectors(tables.model_vectors(tables.read_model(path)), vectors)
    return tables.read_vectors(spark, vectors)


def word2vec_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train on all documents, save and load: the words that have a vector, and its length."""
    return _trained(spark, sf_dir).select("word", F.size("vector").alias("n_dimensions"))


def word2vec_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds of the ten neighbours, by the trained vectors, of the most frequent word."""
    vocabulary = staging.stage(token_vocabulary(spark, sf_dir), "vocabulary")
    vectors = _trained(spark, sf_dir)
    word = vocabulary.orderBy(F.desc("n"), "word").first()["word"]
    found = vector_match.nearest_words(vectors, word, 10).withColumn("place", F.monotonically_increasing_id())
    found = found.join(vectors.select("word", F.lit(True).alias("known")), "word", "left")
    before = F.lag("similarity").over(Window.orderBy("place"))
    return found.withColumn("before", before).agg(
        F.count("*").alias("n_neighbours"), F.count("known").alias("n_known"), F.count_if(F.col("word") == word).alias("n_itself"),
        F.count_if(F.col("similarity") > F.col("before")).alias("n_out_of_order"),
    )


# Sources and sinks

def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations written as quoted CSV and read back with line breaks and quotes intact."""
    path = _scratch(spark, "result")
    csv.write_result(table(spark, sf_dir, "conversations"), path)
    read = csv.read_entities(spark, path, multi_line=True)
    return read.withColumns({k: F.col(k).cast("bigint") for k in ("conv_id", "turn")})


def corpus_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts written with three delimiters and one bad header, read back as one corpus."""
    folder = _scratch(spark, "corpus")
    rows = given.entities(spark, sf_dir)
    early, late = F.col("name") < "h", F.col("name") >= "q"
    for chosen, delimiter in ((early, ","), (late, ";"), (~early & ~late, "|")):
        writer = rows.where(chosen).write.option("header", True).option("sep", delimiter)
        writer.mode("append").csv(folder)
    given.taxonomy(spark, sf_dir).write.option("header", True).mode("append").csv(folder)
    corpus, _ = csv.read_corpus(spark, folder)
    return corpus.select("id", "name", "cluster")


def _headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of a file after a header line of its own."""
    for place, batch in enumerate(batches):
        if not place:
            yield pa.RecordBatch.from_arrays([pa.array(["id,name,cluster"])], schema=batch.schema)
        yield batch


def _damaged_corpus(spark: SparkSession, sf_dir: str) -> str:
    """Lines of the parts in one folder: some with a quote never closed, some too long, some too short; and a file of another kind."""
    folder = _scratch(spark, "damaged")
    key = F.col("id").cast("bigint")
    name = F.when(key % 5 == 0, F.concat(F.lit('"'), "name")).otherwise(F.col("name"))
    cluster = F.when(key % 7 == 1, F.concat("cluster", F.lit(",more"))).otherwise(F.col("cluster"))
    rest = F.when(key % 7 == 2, F.lit("")).otherwise(F.concat(F.lit(","), cluster))
    body = given.entities(spark, sf_dir).select(F.concat("id", F.lit(","), name, rest).alias("value"), key.alias("key"))
    lines = body.repartitionByRange("key").sortWithinPartitions("key").select("value").mapInArrow(_headed, "value string")
    lines.write.mode("append").option("compression", "none").text(f"{folder}/whole.csv")
    other = body.agg(F.concat(F.lit("foo,bar,"), F.count("*").cast("string")).alias("value"))
    other.write.mode("append").text(f"{folder}/other.csv")
    return folder


def _read_damaged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return csv.read_corpus(spark, f"{_damaged_corpus(spark, sf_dir)}/*", pattern="*.txt")


def corpus_with_bad_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unclosed quotes cost no row; long rows are cut, short ones padded."""
    return _read_damaged(spark, sf_dir)[0].select("id", "name", "cluster")


def corpus_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many files are rejected, by reason."""
    return _read_damaged(spark, sf_dir)[1].groupBy("reason").agg(F.count("*").alias("n_files"))


def entities_of_several_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one folder with their columns in different order, and one without a column."""
    folder = _scratch(spark, "layouts")
    rows = given.entities(spark, sf_dir)
    early, late = F.col("name") < "h", F.col("name") >= "q"
    for part, columns in ((early, ("id", "name", "cluster")), (late, ("cluster", "id", "name")), (~early & ~late, ("name", "id"))):
        csv.write_result(rows.where(part).select(*columns), folder, "append")
    return csv.read_entities(spark, folder).select("id", "name", "cluster")


def corpus_with_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as quoted CSV, with their line breaks, quotes and blanks, read back as a corpus from files that are split."""
    folder = _scratch(spark, "documents")
    documents = table(spark, sf_dir, "documents")
    csv.write_result(documents.select(F.col("doc_id").alias("id"), F.col("text").alias("name"), F.col("source").alias("cluster")), folder)
    return csv.read_corpus(spark, folder)[0].select(F.col("id").cast("bigint").alias("doc_id"), "name", "cluster")


def entities_with_quotes_at_line_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the parts: some names hold a line break in quotes, some open a quote that is never closed, some measure inches."""
    folder = _scratch(spark, "quotes")
    key = F.col("id").cast("bigint")
    name = (
        F.when(key % 4 == 0, F.concat(F.lit('"'), F.replace("name", F.lit(" "), F.lit("\n")), F.lit('"')))
        .when(key % 4 == 1, F.concat(F.lit('"'), "name")).when(key % 4 == 2, F.concat("name", F.lit(' 5" wide'))).otherwise(F.col("name"))
    )
    lines = given.entities(spark, sf_dir).select(F.concat_ws(",", "id", name, "cluster").alias("value"), key.alias("key"))
    ordered = lines.repartitionByRange("key").sortWithinPartitions("key").select("value")
    ordered.mapInArrow(_headed, "value string").write.option("compression", "none").text(folder)
    return csv.read_entities(spark, folder)


def corpus_with_a_long_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file whose header names a column for every part, far beyond the buffers of a reader; its rows are the parts."""
    folder = _scratch(spark, "wide")
    rows = given.entities(spark, sf_dir)
    more = F.array_join(F.array_sort(F.collect_list(F.concat(F.lpad("id", 40, "_")))), ";")
    header = rows.agg(F.concat(F.lit("id;name;cluster;"), more).alias("value"))
    body = rows.select(F.concat_ws(";", "id", F.concat(F.lit('"'), "name", F.lit('\n"')), "cluster").alias("value"))
    header.withColumn("place", F.lit(0)).union(body.withColumn("place", F.lit(1))).coalesce(1).sortWithinPartitions("place").select("value").write.text(folder)
    corpus, _ = csv.read_corpus(spark, folder, pattern="*.txt")
    return corpus.select("id", F.rtrim(F.translate("name", "\n", " ")).alias("name"), "cluster")


def dimension_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _scratch(spark, "taxonomy")
    csv.write_result(given.taxonomy(spark, sf_dir), path)
    return tables.read_dimension(spark, path, tables.TAXONOMY_SCHEMA)


QUERIES = {
    f.__name__: f
    for f in (
        clean_strip_first, clean_letters_only, clean_fold_first, fold_letters, match_tokens,
        word_difference, word_intersection, rendered_words, edit_similarity, token_vocabulary,
        taxonomy_word_rows, taxonomy_word_list, keyword_dedupe, level_lookup, corpus_shape,
        fuzzy_dictionary, fuzzy_dictionary_documents, fuzzy_correct_names, fuzzy_correct_keywords,
        fuzzy_correct_documents, fuzzy_correct_free_text, fuzzy_correct_with_vectors,
        semantic_dictionary, preview_corrections, overlap_best, overlap_gate, overlap_per_cluster,
        overlap_documents, classify_names, classify_names_with_vectors, cosine_pairs, cosine_best,
        mean_vector, word_mean_vector, match_by_vector, nearest_words, word2vec_vocabulary,
        word2vec_neighbours, csv_round_trip, corpus_from_csv, dimension_from_csv,
        overlap_large_taxonomy, classify_from_files, cosine_best_in_blocks, corpus_with_bad_quotes, corpus_rejects, entities_of_several_layouts,
        corpus_with_line_breaks, entities_with_quotes_at_line_ends, corpus_with_a_long_header,
        fuzzy_dictionary_low_threshold, nearest_words_of_all, nearest_vectors,
        vectors_from_text, match_by_vector_hot_words,
    )
}
