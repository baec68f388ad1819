"""Sheets of .xlsx workbooks as DataFrames."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_WHOLE = re.compile(r"(-?[0-9]+)\.0+")


def _column(reference: str) -> int:
    """Number of a cell's column, from 0: A is 0, AA is 26."""
    number = 0
    for letter in reference.rstrip("0123456789"):
        number = number * 26 + ord(letter) - 64
    return number - 1


def _strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    with book.open("xl/sharedStrings.xml") as stream:
        # Text in pieces of several formats is one string; readings beside it are not part of it.
        return [
            "".join(t.text or "" for t in entry.findall(f"{_MAIN}t") + entry.findall(f"{_MAIN}r/{_MAIN}t"))
            for _, entry in ElementTree.iterparse(stream) if entry.tag == f"{_MAIN}si"
        ]


def _part(book: zipfile.ZipFile, sheet: int | str) -> str:
    """Name of the part that holds a sheet, by its number from 0 or its name."""
    sheets = ElementTree.fromstring(book.read("xl/workbook.xml")).findall(f"{_MAIN}sheets/{_MAIN}sheet")
    found = sheets[sheet : sheet + 1] if isinstance(sheet, int) else [s for s in sheets if s.get("name") == sheet]
    if not found:
        raise ValueError(f"no sheet {sheet!r}")
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(link.get("Target") for link in links if link.get("Id") == found[0].get(_LINK))
    return target.removeprefix("/") if target.startswith("/") else f"xl/{target}"


def _value(cell: ElementTree.Element, strings: list[str]) -> str | None:
    kind, value = cell.get("t", "n"), cell.findtext(f"{_MAIN}v")
    if kind == "inlineStr":
        text = "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
    elif kind == "s":
        text = strings[int(value)] if value else None
    elif kind == "b":
        text = None if value is None else ("false", "true")[int(value)]
    elif kind == "e":
        text = None
    elif kind == "n" and value is not None and (whole := _WHOLE.fullmatch(value)):
        text = whole[1]
    else:
        text = value
    return text or None


def sheet_rows(content: bytes, sheet: int | str) -> Iterator[list[str | None]]:
    """Cells of a sheet, row by row; rows without a value are left out. A sheet is read as a stream, and no row is kept."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        strings = _strings(book)
        with book.open(_part(book, sheet)) as stream:
            for _, row in ElementTree.iterparse(stream):
                if row.tag != f"{_MAIN}row":
                    continue
                cells: list[str | None] = []
                for cell in row.findall(f"{_MAIN}c"):
                    at = _column(cell.get("r")) if cell.get("r") else len(cells)
                    cells += [None] * (at - len(cells)) + [_value(cell, strings)]
                row.clear()
                if any(cell is not None for cell in cells):
                    yield cells


def read_sheets(contents: DataFrame, sheet: int | str, schema: StructType | str, order_column: str | None = None) -> DataFrame:
    """One sheet of each workbook of a table (path, content) in the columns of ``schema``, which the first row must name.

    Values are read as text and cast: whole numbers have no decimals, dates are the numbers that workbooks keep. Cells without a
    value, and errors, are null. ``order_column`` adds (file, row), the load order. Workbooks are read side by side, each by one
    task, as they are made to be opened whole.
    """
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = fields.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = sheet_rows(content.as_py(), sheet)
                header = next(rows, [])
                if missing := [n for n in names if n not in header]:
                    raise ValueError(f"{path}: columns missing: {', '.join(missing)}")
                places = [header.index(n) for n in names]
                kept: list[tuple] = []
                for number, cells in enumerate(rows):
                    kept.append((path, number, *(cells[p] if p < len(cells) else None for p in places)))
                    if len(kept) == 10_000:
                        yield _batch(kept, names)
                        kept = []
                yield _batch(kept, names)

    columns = ", ".join(f"_{i} string" for i in range(len(names)))
    rows = contents.select("path", "content").mapInArrow(run, f"_file string, _row long, {columns}")
    cast = [F.col(f"_{i}").cast(field.dataType).alias(field.name) for i, field in enumerate(fields)]
    order = [] if order_column is None else [F.struct(F.col("_file").alias("file"), F.col("_row").alias("row")).alias(order_column)]
    return rows.select(*cast, *order)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), *(pa.string() for _ in names))
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)], names=["_file", "_row", *(f"_{i}" for i in range(len(names)))]
    )


def read_workbook(
    spark: SparkSession, path: str, sheet: int | str, schema: StructType | str, order_column: str | None = None, pattern: str = "*.xlsx"
) -> DataFrame:
    """``read_sheets`` of a workbook, or of all workbooks of a folder."""
    contents = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return read_sheets(contents, sheet, schema, order_column)
