from __future__ import annotations

import struct
import zipfile

import pytest

from namewright.plans.classify import classify, classify_files
from namewright.sources import csv, tables
from namewright.sources.workbook import read_workbook

NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
RELATION = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def cell(column, row, value, strings):
    reference = f"{column}{row}"
    if value is None:
        return f'<c r="{reference}"/>'
    if isinstance(value, bool):
        return f'<c r="{reference}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{reference}"><v>{value}</v></c>'
    if value.startswith("inline:"):
        return f'<c r="{reference}" t="inlineStr"><is><r><t>{value[7:]}</t></r></is></c>'
    if value == "#N/A":
        return f'<c r="{reference}" t="e"><v>#N/A</v></c>'
    strings.append(value)
    return f'<c r="{reference}" t="s"><v>{len(strings) - 1}</v></c>'


def workbook(path, sheets):
    strings = []
    with zipfile.ZipFile(path, "w") as book:
        names = "".join(f'<sheet name="{n}" sheetId="{i + 1}" r:id="r{i}"/>' for i, n in enumerate(sheets))
        book.writestr("xl/workbook.xml", f'<workbook {NS} xmlns:r="{RELATION}"><sheets>{names}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(len(sheets)))
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
        for i, rows in enumerate(sheets.values()):
            lines = "".join(
                f'<row r="{r + 1}">' + "".join(cell("ABCDEFGH"[c], r + 1, v, strings) for c, v in enumerate(row) if v != "gap") + "</row>" for r, row in enumerate(rows)
            )
            book.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet {NS}><sheetData>{lines}</sheetData></worksheet>")
        shared = "".join(f"<si><r><t>{s[:1]}</t></r><r><t>{s[1:]}</t></r><rPh><t>reading</t></rPh></si>" for s in strings)
        book.writestr("xl/sharedStrings.xml", f"<sst {NS}>{shared}</sst>")


def test_sheets_by_number_and_name(spark, tmp_path):
    workbook(tmp_path / "a.xlsx", {
        "words": [["type", "note", "clean_word"], ["Master", 1, "master"], ["gap", "x", "inline:mba"], [None, None, None], ["#N/A", True, "law"]],
        "degrees": [["id", "degree_name", "weight"], [17, "Tax Law", 2.5], [18.0, "Finance &amp; Tax", None], ["A9", "", 7]],
    })
    words = read_workbook(spark, str(tmp_path), 0, tables.KEYWORD_SCHEMA, order_column="load_order")
    assert [(r.clean_word, r.type, r.load_order.row) for r in words.orderBy("load_order").collect()] == [("master", "Master", 0), ("mba", None, 1), ("law", None, 2)]
    degrees = read_workbook(spark, str(tmp_path / "a.xlsx"), "degrees", "id string, degree_name string, weight double")
    assert [tuple(r) for r in degrees.collect()] == [("17", "Tax Law", 2.5), ("18", "Finance & Tax", None), ("A9", None, 7.0)]


def test_missing_sheets_and_columns(spark, tmp_path):
    workbook(tmp_path / "a.xlsx", {"one": [["id"], [1]]})
    for sheet, schema in ((1, "id string"), ("two", "id string"), (0, "name string")):
        with pytest.raises(Exception, match="sheet|missing"):
            read_workbook(spark, str(tmp_path), sheet, schema).collect()


def test_names_are_classified_from_a_workbook(spark, tmp_path):
    workbook(tmp_path / "book.xlsx", {"k": [["clean_word", "type"], ["master", "Postgraduate"]], "t": [["id", "degree_name"], [1, "tax law"], [2, "finance"]]})
    keywords = read_workbook(spark, str(tmp_path), 0, tables.KEYWORD_SCHEMA, order_column="load_order")
    taxonomy = read_workbook(spark, str(tmp_path), 1, tables.TAXONOMY_SCHEMA)
    entities = spark.createDataFrame([("7", "Mastr in tax law", "c")], "id string, name string, cluster string")
    (row,) = classify(entities, keywords, taxonomy, "load_order").collect()
    assert (row["degree_level"], row["degree_name"]) == ("Postgraduate", "tax law")


def test_files_are_classified_with_one_workbook(spark, tmp_path):
    workbook(tmp_path / "book.xlsx", {"k": [["clean_word", "type"], ["master", "Postgraduate"]], "t": [["id", "degree_name"], [1, "tax law"], [2, "finance"]]})
    (tmp_path / "in.csv").write_text('id,name,cluster\n7,"Mastr in\ntax law",c\n')
    book = str(tmp_path / "book.xlsx")
    classify_files(spark, str(tmp_path / "in.csv"), book, book, str(tmp_path / "out"))
    (row,) = csv.read_entities(spark, str(tmp_path / "out")).collect()
    assert (row["id"], row["degree_level"], row["degree_name"]) == ("7", "Postgraduate", "tax law")


def test_text_vectors(spark, tmp_path):
    vectors = spark.createDataFrame([("a", [1.0, -2.5e-7]), ("1", [3.0, 0.1]), ("été", [0.0, 1e300])], tables.VECTOR_SCHEMA)
    tables.write_vectors_text(vectors, str(tmp_path / "v"))
    key = lambda r: r.word
    assert sorted(tables.read_vectors_text(spark, str(tmp_path / "v")).collect(), key=key) == sorted(vectors.collect(), key=key)
    (tmp_path / "w.txt").write_text("2 3\nking 1 2 3 \nqueen 4 5 6\n")
    assert [tuple(r) for r in tables.read_vectors_text(spark, str(tmp_path / "w.txt")).collect()] == [("king", [1.0, 2.0, 3.0]), ("queen", [4.0, 5.0, 6.0])]
    (tmp_path / "bad.txt").write_text("king 1 2 3\nqueen 4 5\n")
    with pytest.raises(Exception, match="width"):
        tables.read_vectors_text(spark, str(tmp_path / "bad.txt")).collect()
    with pytest.raises(Exception, match="white space"):
        tables.write_vectors_text(spark.createDataFrame([("a b", [1.0])], tables.VECTOR_SCHEMA), str(tmp_path / "x"))


def test_binary_vectors(spark, tmp_path):
    for name, end in (("plain.bin", b""), ("lines.bin", b"\n")):
        body = b"".join(w.encode() + b" " + struct.pack("<3f", *v) + end for w, v in (("king", (1, 2, 3)), ("größe", (0.5, -1, 10))))
        (tmp_path / name).write_bytes(b"2 3\n" + body)
        assert [tuple(r) for r in tables.read_vectors_binary(spark, str(tmp_path / name)).collect()] == [("king", [1.0, 2.0, 3.0]), ("größe", [0.5, -1.0, 10.0])]
