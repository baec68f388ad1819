from __future__ import annotations

from pyspark.sql import functions as F

from namewright.config import Thresholds
from namewright.operators import dimensions
from namewright.operators.attach import attach
from namewright.plans.classify import RESULT_COLUMNS, classify, classify_files
from namewright.sources import csv

ENTITIES = "id int, name string, cluster string"


def run(spark, entities, keywords, taxonomy, **options):
    result = classify(
        spark.createDataFrame(entities, ENTITIES),
        spark.createDataFrame(keywords, "clean_word string, type string, load int"),
        spark.createDataFrame(taxonomy, "id int, degree_name string"), keyword_order="load", **options)
    assert tuple(result.columns) == RESULT_COLUMNS
    return {r.id: r for r in result.collect()}


KEYWORDS = [("master", "Level 7", 1), ("degree", "Level 6", 2), ("master", "ignored", 3)]
TAXONOMY = [(10, "Degree in Finance"), (11, "Business Administration"), (12, "Civil Law")]


def test_messy_names(spark):
    got = run(spark, [(1, "Masters in Busines & Administraton", "k"), (2, "Degre of Fnance", "k"),
                      (3, "law", "k"), (4, None, "m"), (5, "???", "m")], KEYWORDS, TAXONOMY)
    one = got["1"]
    assert (one.name, one.degree_level, one.matched_type) == ("master business administration", "Level 7", "master")
    assert (one.degree_name, one.match_score) == ("business administration", 2)
    assert one.education_tokens == "['administration','business']"
    assert one.master_tokens == "['business','administration']"
    assert (one.model_source_types, one.model_source_specialities) == ("3", "3|3")
    assert (got["2"].degree_name, got["2"].degree_level) == ("degree finance", "Level 6")
    assert (got["3"].degree_name, got["3"].match_score, got["3"].degree_level) == (None, 1, None)
    for empty in (got["4"], got["5"]):
        assert (empty.name, empty.match_score, empty.degree_name) == ("", None, None)
        assert (empty.education_tokens, empty.master_tokens) == ("['']", "['']")


def test_hot_names_repeated_ids_and_lower_minimum(spark):
    entities = [(i, "Fnance degre", "k") for i in range(300)] + [(7, "civil law", "z"), (None, "law", "n")]
    plain = run(spark, entities, KEYWORDS, TAXONOMY, thresholds=Thresholds(min_overlap=1))
    split = run(spark, entities, KEYWORDS, TAXONOMY, thresholds=Thresholds(min_overlap=1), rows_per_split=9)
    assert plain == split and len(plain) == 301
    assert plain[None].degree_name == "civil law" and plain["7"].match_score == 2


def test_limits_of_the_index_change_nothing(spark):
    taxonomy = [(i, f"{a} {b}") for i, (a, b) in enumerate((a, b) for a in ("business", "civil", "tax") for b in ("law", "administration", "finance"))]
    entities = [(i, text, "k") for i, text in enumerate(["tax law", "civil administration law", "busines finance", "law", "nothing"])]
    plain = run(spark, entities, KEYWORDS, taxonomy)
    assert plain["0"].degree_name == "tax law"
    for max_postings, max_subset in ((1, 8), (1, 1), (2, 0)):
        assert run(spark, entities, KEYWORDS, taxonomy, max_postings=max_postings, max_subset=max_subset) == plain


def test_empty_taxonomy_and_keywords_keep_rows(spark):
    got = run(spark, [(1, "Finance", "k")], [], [])
    assert (got["1"].name, got["1"].match_score, got["1"].degree_level) == ("finance", None, None)


def test_names_are_shuffled_once_until_they_meet_the_rows(spark):
    result = classify(
        spark.createDataFrame([(1, "Fnance", "k")], ENTITIES),
        spark.createDataFrame(KEYWORDS, "clean_word string, type string, load int"),
        spark.createDataFrame(TAXONOMY, "id int, degree_name string"), keyword_order="load")
    plan = result._jdf.queryExecution().executedPlan().toString()
    for operator in ("EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInArrow"):
        assert operator not in plan
    assert plan.count("Exchange hashpartitioning(_name") == 3  # names; both sides of the final join
    assert plan.count("REPARTITION_BY_COL") == 1


def test_keep_first_follows_the_order_and_merges_null_keys(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), (None, 4), (None, 3)], "k string, o int")
    kept = dimensions.keep_first(df, ["k"], ["o"])
    assert {(r.k, r.o) for r in kept.collect()} == {("a", 1), (None, 3)}
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()


def test_shape_vocabulary_and_rename(spark):
    df = spark.createDataFrame([("tax law tax", 1), ("law x", 2)], "name string, n int")
    assert tuple(dimensions.corpus_shape(df).head()) == (2, 2)
    assert {(r.word, r.n) for r in dimensions.vocabulary(df, "name").collect()} == {("tax", 2), ("law", 2)}
    assert dimensions.rename(df, {"name": "n"}).columns == ["n"]


def test_attach_spreads_a_hot_key_and_keeps_every_row(spark):
    rows = spark.range(0, 1000, 1, 8).select(
        "id", F.when(F.col("id") < 700, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 9)).alias("key"))
    rows = rows.union(spark.createDataFrame([(5000, None)], "id long, key string"))
    counts = rows.groupBy("key").agg(F.count("*").alias("n_rows"))
    results = counts.where("key != 'k3'").select("key", F.upper("key").alias("v"))
    joined = attach(rows, results, counts, "key", rows_per_split=50)
    expected = rows.withColumn("v", F.when(F.col("key") != "k3", F.upper("key")))
    assert joined.exceptAll(expected).isEmpty() and expected.exceptAll(joined).isEmpty()
    assert joined.columns == ["id", "key", "v"]


def test_attach_spreads_rows_without_key(spark):
    rows = spark.createDataFrame([(None if i % 10 else str(i), i) for i in range(20_000)], "key string, n int")
    results = spark.createDataFrame([("0", "found")], "key string, result string")
    counts = rows.where("key IS NOT NULL").groupBy("key").count().withColumnRenamed("count", "n_rows")
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    for k, v in zip(before, ("false", "-1", "8"), strict=True):
        spark.conf.set(k, v)
    try:
        sizes = attach(rows, results, counts, "key", 100).rdd.glom().map(len).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 20_000 and max(sizes) < 2 * 20_000 / 8


def test_load_order_decides_and_not_the_alphabet(spark, tmp_path):
    (tmp_path / "keywords.csv").write_text("clean_word,type\nmaster,Postgraduate\nmaster,Level 7\n")
    (tmp_path / "entities.csv").write_text("id,name,cluster\n1,Master of Civil Law,k\n")
    (tmp_path / "taxonomy.csv").write_text("id,degree_name\n5,Civil Law\n")
    paths = [str(tmp_path / f"{n}.csv") for n in ("entities", "keywords", "taxonomy")]
    classify_files(spark, *paths, str(tmp_path / "out"))
    (row,) = csv.read_entities(spark, str(tmp_path / "out")).collect()
    assert (row.degree_level, row.degree_name) == ("Postgraduate", "civil law")


def test_names_with_line_breaks_from_file_to_file(spark, tmp_path):
    (tmp_path / "keywords.csv").write_text("clean_word,type\nmaster,Postgraduate\n")
    (tmp_path / "entities.csv").write_text('id,name,cluster\n1,"Master of\nCivil Law",k\n2,Master of Civil Law,k\n')
    (tmp_path / "taxonomy.csv").write_text("id,degree_name\n5,Civil Law\n")
    paths = [str(tmp_path / f"{n}.csv") for n in ("entities", "keywords", "taxonomy")]
    classify_files(spark, *paths, str(tmp_path / "out"), multi_line=True)
    got = csv.read_entities(spark, str(tmp_path / "out"), multi_line=True).collect()
    assert {(r.id, r.cluster, r.degree_level, r.degree_name) for r in got} == {(i, "k", "Postgraduate", "civil law") for i in ("1", "2")}
