"""CSV sources and the CSV sink."""

from __future__ import annotations

import csv
import io
import re
import sys
from collections.abc import Sequence
from functools import reduce
from operator import and_
from pathlib import PurePosixPath
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from namewright.config import CSV_DELIMITERS
from namewright.sources.records import read_lines, read_records, read_splits
from namewright.sources.staging import stage

CORPUS_COLUMNS = ("id", "name", "cluster")
REJECTED_SCHEMA = "file string, reason string"
NO_CONTENT, COLUMNS_MISSING, OPEN_QUOTE = "no content", "columns missing", "quote never closed"


def _strings(names: Sequence[str]) -> StructType:
    schema = StructType()
    for name in names:
        schema = schema.add(name, StringType())
    return schema


def _fields(line: str, delimiter: str) -> list[str]:
    csv.field_size_limit(sys.maxsize)
    return next(csv.reader(io.StringIO(line.removeprefix("﻿"), newline=""), delimiter=delimiter), [])


def _file_name(uri: str) -> str:
    return PurePosixPath(unquote(uri)).name


def _plain(uri: str) -> str:
    """A URI without its escapes; ``file:///x`` and ``file:/x`` become one."""
    return re.sub("^file:/+", "file:/", unquote(uri))


def _unique(names: Sequence[str]) -> list[str]:
    """Header names made usable as columns: blanks and repeats get their position."""
    seen: set[str] = set()
    result = []
    for position, name in enumerate(names):
        usable = name if name and name.lower() not in seen else f"{name}_{position}"
        seen.add(usable.lower())
        result.append(usable)
    return result


def _field_count(record: Column, delimiter: str) -> Column:
    unquoted = F.regexp_replace(record, '"[^"]*+(?:""[^"]*+)*+"', "")
    return F.length(unquoted) - F.length(F.replace(unquoted, F.lit(delimiter), F.lit(""))) + 1


class _Layout:
    """Files of one header and delimiter."""

    def __init__(self, header: list[str], delimiter: str, wanted: Sequence[str] | None = None) -> None:
        """Of a header with only some ``wanted`` columns, no field after the last of them is kept."""
        names = _unique(header)
        last = max((i for i, name in enumerate(names) if name in wanted), default=0) + 1 if wanted else len(names)
        self.names, self.delimiter, self.width = names[:last], delimiter, len(names)
        # ``value`` and ``_record`` have nothing to do with columns of those names in the file.
        self.inner = [f"_column_{i}" for i in range(len(self.names))]

    def parsed(self, record: Column, literal: Column) -> Column:
        """Fields of a record; ``_record`` is the record itself where it has other than their number."""
        schema = ", ".join(f"{name} string" for name in [*self.inner, "_record"])
        options = {
            "sep": self.delimiter, "escape": '"', "columnNameOfCorruptRecord": "_record", "multiLine": "true",
            "maxColumns": str(max(self.width + 2, 20480)),
        }
        return F.when(literal, F.from_csv(record, schema, {**options, "quote": ""})).otherwise(F.from_csv(record, schema, options))

    def fits(self, parsed: Column) -> Column:
        """Whether a record has no more fields than the header."""
        return F.coalesce(_field_count(parsed["_record"], self.delimiter) <= len(self.names), F.lit(True))

    def places(self) -> dict[str, str]:
        return dict(zip(self.names, self.inner, strict=True))


class _Files:
    """The CSV files of a path: their splits, and their headers."""

    def __init__(self, spark: SparkSession, path: str, pattern: str, delimiters: Sequence[str]) -> None:
        self.spark, self.path, self.pattern = spark, path, pattern
        self.lines = read_lines(spark, path, pattern, "".join(delimiters))
        self.splits = read_splits(self.lines)

    def headers(self) -> DataFrame:
        """(file, path, head): a row for each file that isn't empty; nothing but names is read again."""
        names = self.spark.read.option("pathGlobFilter", self.pattern).format("binaryFile").load(self.path)
        path = F.col("_metadata.file_path")
        paths = names.select(F.xxhash64(path).alias("file"), path.alias("path"))
        # Of one name in two cases both are files; equal hashes of names would be one file.
        return paths.join(self.splits.where("block = 0").select("file", "head"), "file", "left")

    def with_open_quotes(self) -> DataFrame:
        """Files whose number of quotes is odd: one of them is never closed, or never opened."""
        return self.splits.groupBy("file").agg(F.sum("n_quotes").alias("_n")).where("_n % 2 = 1").select("file")

    def rows(self, files: DataFrame, layouts: Sequence[_Layout], columns: Sequence[str], keep_long: bool) -> DataFrame:
        """Records of ``files`` (file, layout, _source) as ``columns``, and ``_source``."""
        records = read_records(self.lines, self.splits).join(files, "file")
        # A record is parsed once, by its file's layout.
        parsed = {
            f"_parsed_{n}": F.when(F.col("layout") == n, layout.parsed(F.col("record"), F.col("literal"))) for n, layout in enumerate(layouts)
        }
        rows = records.withColumns(parsed)
        if not keep_long:
            fits = [F.col(name).isNull() | layout.fits(F.col(name)) for name, layout in zip(parsed, layouts, strict=True)]
            rows = rows.where(F.col("literal") | reduce(and_, fits))
        places = [(name, layout.places()) for name, layout in zip(parsed, layouts, strict=True)]
        return rows.select(
            *(F.coalesce(*(F.col(name)[inner[c]] for name, inner in places if c in inner)).alias(c) for c in columns), F.col("_source")
        )


def _source_file(path: Column) -> Column:
    return F.url_decode(F.replace(F.element_at(F.split(path, "/"), -1), F.lit("+"), F.lit("%2B")))


def read_corpus(
    spark: SparkSession,
    folder: str,
    columns: Sequence[str] = CORPUS_COLUMNS,
    pattern: str = "*.csv",
    multi_line: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Union of all CSV files of a folder, and the rejected files with a reason.

    A file is read with commas, or else with the first of ``; tab |`` whose header, the first record that isn't blank, holds all
    ``columns``; a file without such a header is rejected, whatever its length. Rows carry ``source_file``; over-long rows are cut and
    short ones padded with nulls. What reaches the driver are the distinct headers, and the names of the files as Spark lists them.

    Quoted fields may hold line breaks. Files are split all the same: one pass finds what each split starts with, another one reads the records
    (``sources.records``). A quote that is never closed costs no row: its line keeps its fields, quotes included, and can't take in the lines
    after it. With ``multi_line`` a file whose quotes don't pair up is rejected instead.
    """
    listed = spark.read.option("pathGlobFilter", pattern).text(folder).inputFiles()
    if not listed:
        return spark.createDataFrame([], _strings([*columns, "source_file"])), spark.createDataFrame([], REJECTED_SCHEMA)
    files = _Files(spark, folder, pattern, CSV_DELIMITERS)
    headers = stage(files.headers(), "csv-headers")
    layouts, heads = [], []
    for row in headers.where("head IS NOT NULL").select("head").distinct().orderBy("head").collect():
        found = [d for d in CSV_DELIMITERS if set(columns) <= set(_fields(row["head"], d))]
        if found:
            heads.append((row["head"], len(layouts)))
            layouts.append(_Layout(_fields(row["head"], found[0]), found[0], columns))
    layout_of = spark.createDataFrame(heads, "head string, layout int")
    reason = F.when(F.col("head").isNull(), NO_CONTENT).when(F.col("layout").isNull(), COLUMNS_MISSING)
    if multi_line:
        open_quotes = files.with_open_quotes().withColumn("_open", F.lit(True))
        headers, reason = headers.join(open_quotes, "file", "left"), reason.when(F.col("_open"), OPEN_QUOTE)
    # The heads are those that the driver has just seen.
    judged = headers.join(F.broadcast(layout_of), "head", "left").select(
        "file", "layout", _source_file(F.col("path")).alias("_source"), reason.alias("reason")
    )
    judged = stage(judged, "csv-files")
    # Spark's scans leave out files without a byte.
    empty = spark.createDataFrame([(_file_name(_plain(uri)), _plain(uri)) for uri in listed], "file string, path string")
    present = headers.select(F.regexp_replace(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/").alias("path"))
    empty = empty.join(present, "path", "left_anti").select("file", F.lit(NO_CONTENT).alias("reason"))
    rejected = judged.where("reason IS NOT NULL").select(F.col("_source").alias("file"), "reason").union(empty)
    if not layouts:
        return spark.createDataFrame([], _strings([*columns, "source_file"])), rejected
    good = judged.where("reason IS NULL").select("file", "layout", "_source")
    return files.rows(good, layouts, columns, keep_long=True).withColumnRenamed("_source", "source_file"), rejected


def read_entities(
    spark: SparkSession, path: str, delimiter: str = ",", multi_line: bool = False
) -> DataFrame:
    """One CSV data set with a header in each file, all columns as strings.

    Files may order their columns differently: columns meet by name, and one that a file lacks is null in its rows.
    Rows with more fields than their header are dropped; shorter ones are padded with nulls. Quotes and line breaks inside of them are
    treated as in ``read_corpus``; with ``multi_line`` a file whose quotes don't pair up is an error.
    """
    files = _Files(spark, path, "*", [delimiter])
    headers = stage(files.headers(), "csv-headers")
    found = headers.where("head IS NOT NULL").groupBy("head").agg(F.min("path").alias("path")).orderBy("path").collect()
    if not found:
        raise ValueError(f"no content: {path}")
    if multi_line and (broken := headers.join(files.with_open_quotes(), "file").select(_source_file(F.col("path")).alias("name")).limit(20).collect()):
        raise ValueError(f"{OPEN_QUOTE}: {', '.join(sorted(row['name'] for row in broken))}")
    layouts = [_Layout(_fields(row["head"], delimiter), delimiter) for row in found]
    layout_of = spark.createDataFrame([(row["head"], number) for number, row in enumerate(found)], "head string, layout int")
    chosen = headers.join(F.broadcast(layout_of), "head").select("file", "layout", _source_file(F.col("path")).alias("_source"))
    columns = list(dict.fromkeys(name for layout in layouts for name in layout.names))
    return files.rows(stage(chosen, "csv-files"), layouts, columns, keep_long=False).drop("_source")


def write_result(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a folder of UTF-8 CSV files with header, every field quoted."""
    writer = df.write.mode(mode).option("header", True).option("quoteAll", True)
    # Blanks around a value belong to it.
    writer.options(escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
