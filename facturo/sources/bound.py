"""CSV scan that binds columns by the names in each file's header and sets bad lines aside.

``scan_csv_typed`` binds by position, as Spark's CSV source does: a file whose
columns stand in another order would load without complaint. Here the header
of every file is read first (one line a file: each task stops after it), and
files are read in groups of equal headers, each with a schema in that header's
order. Lines that do not fit the schema (a field that is no number, too few or
too many fields) are not turned into nulls: they go to ``rejects`` with their
text and file.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from facturo.schema import RAW_SCHEMA

_LINE = "_rejected_line"
_WHOLE_FILE = str(1 << 50)


@dataclass(frozen=True)
class CsvScan:
    """``rows``: the lines that fit, with the schema's columns. ``rejects``: ``file`` and ``line`` of all others."""

    rows: DataFrame
    rejects: DataFrame


def csv_headers(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Column names in the first non-empty line of each file, and the files that have them.

    The driver gets one line a file; it lists the files in any case. Files
    are not cut for this pass, and a task reads one batch of one line.
    """
    session = spark.newSession()
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        session.conf.set(key, _WHOLE_FILE)
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")

    def first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    lines = session.read.text(paths).select(F.col("_metadata.file_path").alias("file"), "value").where("trim(value) <> ''")
    found: dict[tuple[str, ...], list[str]] = {}
    for row in lines.mapInArrow(first_line, "file string, value string").collect():
        names = tuple(name.strip() for name in next(csv.reader([row["value"].lstrip("﻿")])))
        found.setdefault(names, []).append(row["file"])
    return found


def _file_schema(names: tuple[str, ...], schema: StructType, missing: str, file: str) -> StructType:
    """Fields in the order of a header; columns that the schema lacks are read as text and left out later."""
    wanted = set(schema.names)
    twice = sorted({n for n in names if n in wanted and names.count(n) > 1})
    if twice:
        raise ValueError(f"columns {twice} stand more than once in the header of {file}")
    absent = [n for n in schema.names if n not in names]
    if absent and missing == "error":
        raise ValueError(f"columns {absent} are missing from the header of {file}")
    return StructType([schema[n] if n in wanted else StructField(f"_extra_{i}", StringType()) for i, n in enumerate(names)])


def scan_csv_bound(
    spark: SparkSession, paths: str | list[str], schema: StructType = RAW_SCHEMA, missing: str = "error", multiline: bool = False
) -> CsvScan:
    """Typed CSV scan by header names, with rejected lines apart.

    Quotes are escaped by doubling and only empty fields are null, as in
    ``scan_csv_typed``. A column of ``schema`` that a file lacks is an error,
    or null with ``missing="null"``; further columns are ignored. Header lines
    must not contain line breaks. An input without any header gives no rows.
    """
    if missing not in ("error", "null"):
        raise ValueError(f"missing is error or null, not {missing}")
    paths = [paths] if isinstance(paths, str) else paths
    headers = csv_headers(spark, paths)
    # checked for all headers before anything is read
    schemas = {names: _file_schema(names, schema, missing, files[0]) for names, files in headers.items()}
    rows = spark.createDataFrame([], schema)
    rejects = spark.createDataFrame([], "file string, line string")
    for names, files in headers.items():
        of_file = schemas[names]
        read = (
            spark.read.schema(StructType([*of_file.fields, StructField(_LINE, StringType())]))
            .option("header", True)
            .option("escape", '"')
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", _LINE)
            .option("columnPruning", False)
            .option("multiLine", multiline)
            .csv(paths if len(headers) == 1 else files)
        )
        columns = [F.col(f"`{n}`") if n in names else F.lit(None).cast(schema[n].dataType).alias(n) for n in schema.names]
        rows = rows.unionAll(read.where(F.col(_LINE).isNull() & _all_read(of_file)).select(*columns))
        bad = read.where(F.col(_LINE).isNotNull() & _all_read(of_file))
        rejects = rejects.unionAll(bad.select(F.col("_metadata.file_path").alias("file"), F.col(_LINE).alias("line")))
    return CsvScan(rows, rejects)


def _all_read(schema: StructType) -> Column:
    """Always true, but needs every column: a line is only found bad by the columns that a query reads."""
    return F.length(F.concat_ws("", *[F.col(f"`{n}`").cast(StringType()) for n in schema.names])) >= 0
