from __future__ import annotations

import json

import corpus_pipeline
import __spark_entry__ as driver
from tests.llm.tables import awkward, changed, empty, prose

LABELS = "doc_id long, quality int, toxic int"


def test_stages_take_effect(spark, tmp_path):
    rows = []
    for i in range(260):
        words = prose(i, 60)
        if i % 4 == 3:
            words = " ".join(w + "%%%" for w in words.split(" "))
        rows.append((i, words, "en", f"src{i % 3}", len(words)))
    base = prose(999, 200)
    rows += [(500, base, "en", "src1", 1), (501, changed(base, 100), "en", "src1", 1), (502, base, "en", "src1", 1)]
    rows += [(600, f"{prose(77, 50)} token = \"0123456789abcdef0123456789abcdef\" {prose(78, 30)}", "en", "src2", 1), (601, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(i, int(i % 4 != 3), 0) for i in range(200)], LABELS)
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    kept = {}
    for place, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / f"{place}")
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = docs.collect()
        if name != "packing":
            assert docs.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
    ids = {name: [r["doc_id"] for r in found] for name, found in kept.items()}
    good = {i for i in range(260) if i % 4 != 3}
    assert set(ids["quality"]) == good | {500, 501, 502, 600, 601}
    assert sorted(ids["near_dedup"]) == sorted(good | {500, 600, 601})
    assert sorted(ids["secrets"]) == sorted(ids["near_dedup"])
    (clean,) = (r for r in kept["secrets"] if r["doc_id"] == 600)
    assert "<secret>" in clean["text"] and "0123456789abcdef" not in clean["text"] and clean["n_chars"] == len(clean["text"])
    assert set(ids["mixing"]) <= set(ids["secrets"]) and len(set(ids["mixing"])) < len(ids["mixing"])
    assert set(ids["packing"]) == set(ids["mixing"])


def test_registered(spark, tmp_path):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "secrets", "mixing", "packing"]
    assert {"pipeline", *(f"op{n}_" for n in range(1, 14))} <= {k if k == "pipeline" else k.split("_")[0] + "_" for k in driver.queries()}
    json.dumps(driver.oracle_sql())


def test_awkward_rows_pass_through(spark, tmp_path):
    table = awkward(spark)
    table.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    docs = table
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == table.columns


def test_empty_tables(spark, tmp_path):
    empty(spark).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert packed.count() == 0 and {"doc_id", "piece", "sequence_id", "offset"} <= set(packed.columns)
