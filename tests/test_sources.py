from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from namewright.operators import dimensions
from namewright.plans.training import train_from_folder, train_word_vectors
from namewright.sources import csv, staging, tables


@pytest.fixture
def folder(tmp_path):
    directory = tmp_path / "training data"
    directory.mkdir()

    def write(**files):
        for name, content in files.items():
            (directory / f"{name}.csv").write_text(content, encoding="utf-8")
        return str(directory)

    return write


def rows(df):
    return sorted(map(tuple, df.select("id", "name", "cluster").collect()), key=str)


def test_corpus_with_several_delimiters_and_layouts(spark, folder):
    path = folder(
        comma='id,name,cluster\n1,x,c\n2,"y, ""q""\nz",d\n',
        semicolon="id;name;cluster;extra\n3;n,m;c;e\n",
        tab="cluster\tid\tname\nk\t4\tw\n",
        pipe="﻿id|name|cluster\n5|p|q\n",
        missing="foo,bar\n1,2\n",
        empty="",
    )
    corpus, rejected = csv.read_corpus(spark, path, multi_line=True)
    assert rows(corpus) == [("1", "x", "c"), ("2", 'y, "q"\nz', "d"), ("3", "n,m", "c"), ("4", "w", "k"),
                            ("5", "p", "q")]
    assert {(r.file, r.reason) for r in rejected.collect()} == {
        ("missing.csv", "columns missing"), ("empty.csv", "no content")}
    assert {r.source_file for r in corpus.collect()} == {"comma.csv", "semicolon.csv", "tab.csv", "pipe.csv"}


def test_corpus_cuts_long_rows_and_pads_short_ones(spark, folder):
    corpus, _ = csv.read_corpus(spark, folder(a="id,name,cluster\n1,a,b,c\n2\n"))
    assert rows(corpus) == [("1", "a", "b"), ("2", None, None)]


def test_corpus_with_an_unclosed_quote_loses_no_row(spark, folder):
    lines = ["id,name,cluster", '1,"x,c', *(f"{i},y,d" for i in range(2, 1001)), '1001,"closed, well",e', '1002,z,"f']
    path = folder(a="\n".join(lines) + "\n", b="id,name,cluster\n3000,z,e\n")
    corpus, rejected = csv.read_corpus(spark, path)
    found = rows(corpus)
    assert len(found) == 1003 and rejected.count() == 0
    assert {("1", '"x', "c"), ("2", "y", "d"), ("1001", "closed, well", "e"), ("3000", "z", "e")} <= set(found)


def test_corpus_of_quoted_lines_rejects_files_with_an_unclosed_quote(spark, folder):
    path = folder(a='id,name,cluster\n1,"x,c\n2,y,d\n', b='id,name,cluster\n3,"z\nz",e\n')
    corpus, rejected = csv.read_corpus(spark, path, multi_line=True)
    assert rows(corpus) == [("3", "z\nz", "e")]
    assert [tuple(r) for r in rejected.collect()] == [("a.csv", csv.OPEN_QUOTE)]
    with pytest.raises(ValueError, match="a.csv"):
        csv.read_entities(spark, path, multi_line=True)


def test_headers_of_any_length(spark, folder):
    more = ",".join(f"{'column' * 12}_{i}" for i in range(1000))
    path = folder(a=f"id,name,cluster,{more}\n1,x,c\n2,\"y\nz\",d,{'e,' * 999}f\n3,x,c\n", b="x" * 300_000 + "\n1\n", c="", d=" \n\n")
    corpus, rejected = csv.read_corpus(spark, path)
    assert rows(corpus) == [("1", "x", "c"), ("2", "y\nz", "d"), ("3", "x", "c")]
    assert {tuple(r) for r in rejected.collect()} == {("b.csv", csv.COLUMNS_MISSING), ("c.csv", csv.NO_CONTENT), ("d.csv", csv.NO_CONTENT)}
    assert rows(csv.read_entities(spark, f"{path}/a.csv")) == rows(corpus)


def test_entities_meet_by_column_name(spark, folder):
    path = folder(a="id,name,cluster\n1,x,c\n", b="cluster,id,name\nd,2,y\n", c="id,name\n3,z\n")
    assert rows(csv.read_entities(spark, path)) == [("1", "x", "c"), ("2", "y", "d"), ("3", "z", None)]


def test_corpus_of_no_or_only_bad_files_has_the_declared_columns(spark, folder):
    for path in (folder(), folder(bad="x\n1\n")):
        corpus, _ = csv.read_corpus(spark, path)
        assert corpus.columns == ["id", "name", "cluster", "source_file"] and corpus.count() == 0


def test_entities_drop_long_rows_and_keep_short_ones(spark, folder):
    path = folder(a='id,name,cluster\n1,x,c\n2,"a,b",c\n3,s\n4,a,b,c\n5,a,b,\n6,"q,""r",t,u\n7,,\n')
    assert rows(csv.read_entities(spark, f"{path}/a.csv")) == [
        ("1", "x", "c"), ("2", "a,b", "c"), ("3", "s", None), ("7", None, None)]
    assert csv.read_entities(spark, f"{path}/a.csv").select("name").count() == 4


def test_result_is_quoted_and_reads_back(spark, tmp_path):
    df = spark.createDataFrame([("1", 'a"b\nc', "x,y"), ("2", "é", "z")], "id string, name string, cluster string")
    csv.write_result(df.coalesce(1), str(tmp_path / "out"))
    written = "".join(p.read_text("utf-8") for p in (tmp_path / "out").glob("*.csv"))
    assert written.startswith('"id","name","cluster"\n') and '"a""b\nc"' in written
    assert rows(csv.read_entities(spark, str(tmp_path / "out"), multi_line=True)) == rows(df)


def test_dimension_has_the_declared_schema(spark, folder):
    path = folder(keywords="clean_word,type\nmaster,Master\n")
    df = tables.read_dimension(spark, path, tables.KEYWORD_SCHEMA)
    assert [tuple(r) for r in df.collect()] == [("master", "Master")]


def test_vectors_are_required_where_named(spark, tmp_path):
    with pytest.raises(Exception):
        tables.read_vectors(spark, str(tmp_path / "none"))


def test_training_saves_and_loads(spark, tmp_path):
    texts = ["Máster of finance and tax", "finance tax law", "tax law master", None, "rare"] * 1
    corpus = spark.createDataFrame([(t,) for t in texts], "name string")
    model = train_word_vectors(corpus, 1, vector_size=8, epochs=1)
    tables.write_model(model, str(tmp_path / "model"))
    tables.write_vectors(tables.model_vectors(tables.read_model(str(tmp_path / "model"))), str(tmp_path / "v"))
    vectors = tables.read_vectors(spark, str(tmp_path / "v")).collect()
    expected = {r.word for r in dimensions.vocabulary(
        corpus.withColumn("name", F.translate(F.lower("name"), "á", "a")), "name").collect()}
    assert {r.word for r in vectors} == expected == {"master", "finance", "tax", "law"}
    assert {len(r.vector) for r in vectors} == {8}


def test_training_from_a_folder(spark, folder, tmp_path):
    path = folder(a="id,name,cluster\n1,tax law,c\n2,tax law,c\n", bad="x\n1\n")
    model, rejected = train_from_folder(spark, path, str(tmp_path / "model"), 2, vector_size=4, epochs=1)
    assert {r.word for r in model.getVectors().collect()} == {"tax", "law"}
    assert [r.file for r in rejected.collect()] == ["bad.csv"]
    assert tables.read_model(str(tmp_path / "model")).getOrDefault("numPartitions") == 2


def test_training_on_names_with_line_breaks(spark, folder, tmp_path):
    path = folder(a='id,name,cluster\n1,"tax\nlaw",c\n2,"tax\nlaw",c\n')
    model, rejected = train_from_folder(spark, path, str(tmp_path / "model"), 2, vector_size=4, epochs=1, multi_line=True)
    assert {r.word for r in model.getVectors().collect()} == {"tax", "law"} and rejected.count() == 0


def test_staged_tables_can_be_deleted(spark):
    staged = staging.stage(spark.range(5).toDF("n"), "numbers")
    assert staged.count() == 5
    folder = Path(staging.run_folder(spark))
    assert any(folder.iterdir())
    staging.clean_up(spark)
    assert not folder.exists()
