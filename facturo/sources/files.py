"""File scans and sinks: typed CSV, text lines, space-separated pairs, parquet.

Every sink writes a directory of part files (one dataset), never a single
coalesced file, so writing scales with the number of tasks. ``mode`` defaults
to overwrite, which replaces the result of an earlier run, and does so in one
step: the new result is written to a staging folder beside the old one and takes
its place when it is complete, so a run that fails leaves the last good result.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from facturo.schema import PAIRS_SCHEMA, RAW_SCHEMA


def _file_system(spark: SparkSession, path: str):
    """(Hadoop file system of a path, constructor of paths)."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def staging_path(path: str) -> str:
    """A folder beside ``path`` whose name readers of the folder above skip."""
    folder, name = posixpath.split(path.rstrip("/"))
    return posixpath.join(folder, f"_staging-{uuid.uuid4().hex}-{name}")


def publish(spark: SparkSession, staged: dict[str, str]) -> None:
    """Put complete staged folders (path -> staged folder) in the place of what is there.

    The old result moves aside, the new one takes its name, then the old one
    is deleted; should the process end between the two renames, both still
    exist, the old one as ``_replaced-...`` beside its place.
    """
    aside = []
    for path, new in staged.items():
        files, make = _file_system(spark, path)
        old = staging_path(path).replace("_staging-", "_replaced-")
        had = files.exists(make(path))
        if had and not files.rename(make(path), make(old)):
            raise OSError(f"cannot replace {path}")
        if not files.rename(make(new), make(path)):
            if had:
                files.rename(make(old), make(path))
            raise OSError(f"cannot publish {path}")
        if had:
            aside.append((files, make(old)))
    for files, old in aside:
        files.delete(old, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[[str], str]]:
    """Gives staged folders for paths; all are published at the end, or none if anything inside fails."""
    staged: dict[str, str] = {}

    def stage(path: str) -> str:
        files, make = _file_system(spark, path)
        files.mkdirs(make(path).getParent())
        return staged.setdefault(path, staging_path(path))

    try:
        yield stage
    except BaseException:
        for new in staged.values():
            files, make = _file_system(spark, new)
            files.delete(make(new), True)
        raise
    publish(spark, staged)


def _put(df: DataFrame, path: str, mode: str, write: Callable[[DataFrame, str, str], None]) -> None:
    """Write by way of a staging folder if ``mode`` is overwrite."""
    if mode != "overwrite":
        write(df, path, mode)
        return
    with staging(df.sparkSession) as stage:
        write(df, stage(path), "errorifexists")


def scan_csv_typed(
    spark: SparkSession, path: str, schema: StructType = RAW_SCHEMA, multiline: bool = False
) -> DataFrame:
    """Typed CSV scan with a header line; no inference.

    Quotes are escaped by doubling (``"a ""b"", c"``); only empty fields are
    null, so text such as ``NA`` stays text. Malformed numbers become null
    (permissive mode) and show up in the null profile. Splittable: the
    planner cuts large files by ``spark.sql.files.maxPartitionBytes``.
    ``multiline=True`` reads quoted fields that contain line breaks, at the
    price of one task per file (such files cannot be split).
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("multiLine", multiline)
        .csv(path)
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header line, doubled-quote escaping, text kept byte for byte (no trimming).

    As in any CSV, an empty text and a missing value are the same empty
    field: an empty string reads back as null.
    """

    def write(rows: DataFrame, to: str, how: str) -> None:
        (
            rows.write.mode(how)
            .option("header", True)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(to)
        )

    _put(df, path, mode, write)


def scan_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def write_text_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a single string column, one value per line."""
    _put(df, path, mode, lambda rows, to, how: rows.write.mode(how).text(to))


def scan_pairs(spark: SparkSession, path: str, schema: StructType = PAIRS_SCHEMA, sep: str = " ") -> DataFrame:
    """Integer pairs, one per line (``id qty``; ``sep="\t"`` for the sorted job output)."""
    return spark.read.schema(schema).option("sep", sep).option("mode", "PERMISSIVE").csv(path)


def write_pairs(df: DataFrame, path: str, mode: str = "overwrite", sep: str = " ") -> None:
    """One pair per line; part files keep the order of an ordered ``df``."""
    _put(df, path, mode, lambda rows, to, how: rows.write.mode(how).option("sep", sep).csv(to))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Parquet parts; with ``partition_by`` rows are rebalanced by those columns first.

    So a folder gets a few files of a good size, not one from every task; a
    partition value with a large share of the rows is split over several tasks.
    """

    def write(rows: DataFrame, to: str, how: str) -> None:
        writer = (rows.hint("rebalance", *partition_by) if partition_by else rows).write.mode(how)
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(to)

    _put(df, path, mode, write)


def result_roundtrip(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
) -> DataFrame:
    """Write a result as a directory of parts and read it back as one result.

    The read uses the written schema (partition columns last, as Spark lays
    them out), so nothing is inferred and an empty result reads back empty.
    """
    if fmt == "parquet":
        write_parquet(df, path, partition_by=partition_by)
        parts = partition_by or []
        fields = [f for f in df.schema.fields if f.name not in parts] + [df.schema[c] for c in parts]
        return spark.read.schema(StructType(fields)).parquet(path)
    if fmt == "csv":
        if partition_by:
            raise ValueError("partitioned CSV round trips are not supported")
        write_csv(df, path)
        return scan_csv_typed(spark, path, df.schema)
    raise ValueError(f"unsupported format: {fmt}")
