"""Helpers shared by the training-data operators.

Row identity. An operator that returns its input rows packs them into one
struct column (``row``), so input columns of any name cannot clash with its
own, and unpacks them at the end.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facturo.session import ScratchScope, collected_scratch, discard, ensure_checkpoint_dir, materialize, scratch_path, scratch_scope

__all__ = ["ScratchScope", "collected_scratch", "discard", "materialize", "open_input", "packed", "prepare", "scratch_path", "scratch_scope", "sized_join", "sliced", "small_enough", "unpacked", "write_bytes"]

#: Rows that a broadcast side may have. At the widths used here (under 100
#: bytes a row) that is under 20 MB; larger sides take the shuffled way.
BROADCAST_ROWS = 200_000
#: Parts that a hot key of a shuffled join is dealt into.
JOIN_SALTS = 32
#: Bytes of an Arrow batch that goes to a Python worker. Batches are otherwise cut by
#: rows alone, and 10,000 long texts fill the executor's and the worker's memory at once.
BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Settings every dealt query relies on, and this package's folder on the Python workers' path.

    On a cluster the package is installed or shipped as usual; the path entry
    serves sessions whose workers start elsewhere than the driver.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(":"):
        environment["PYTHONPATH"] = ":".join(filter(None, [root, environment.get("PYTHONPATH", "")]))
    ensure_checkpoint_dir(spark)
    return spark


def packed(df: DataFrame, **columns: str) -> DataFrame:
    """``row`` (a struct of all input columns) and the named expressions over the input columns."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[F.expr(e).alias(n) for n, e in columns.items()])


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("row.*")


def small_enough(small: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``small`` has at most ``max_rows`` rows; reads at most that many and one."""
    return small.limit(max_rows + 1).count() <= max_rows


def sized_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "left", max_rows: int = BROADCAST_ROWS, rows: int | None = None, salts: int = JOIN_SALTS) -> DataFrame:
    """Join on unique keys of ``small``: broadcast when its counted size allows, else shuffled with salted keys.

    ``how`` is left, inner, left_semi or left_anti. The salt deals a hot key
    of ``big`` over ``salts`` parts; ``small``, which has one row a key,
    is copied that many times (1: none, where few rows of ``big`` can have the same key). ``rows``: an upper bound of its rows that is
    already known, so that they need no counting. The salt is a hash of the
    row, so a task that runs again deals its rows alike.
    """
    if rows <= max_rows if rows is not None else small_enough(small, max_rows):
        return big.join(F.broadcast(small), on, how)
    if salts == 1:
        return big.join(small, on, how)
    salted = big.withColumn("_salt", _salt(big, salts))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def _salt(rows: DataFrame, salts: int) -> Column:
    """A number below ``salts`` from the plain columns of a row, or from all that can be hashed if it has no other."""
    plain = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.AtomicType)]
    nested = [f.name for f in rows.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    return F.pmod(F.xxhash64(F.lit(7), *[F.col(f"`{c}`") for c in plain or nested]), F.lit(salts)).cast("int")


def write_bytes(folder: str, name: str, parts: list[bytes]) -> str:
    """Write one file into a shared folder (a path or URI that pyarrow knows); returns its URI. Runs inside tasks."""
    from pyarrow import fs

    files, base = fs.FileSystem.from_uri(folder)
    files.create_dir(base, recursive=True)
    with files.open_output_stream(f"{base}/{name}") as out:
        for part in parts:
            out.write(part)
    return f"{folder.rstrip('/')}/{name}"


def open_input(uri: str):
    """A random-access file handle of a shared file. Runs inside tasks."""
    from pyarrow import fs

    files, path = fs.FileSystem.from_uri(uri)
    return files.open_input_file(path)


def trim_memory() -> None:
    """Inside a task: give freed memory back to the system, where that is possible.

    Python workers live on from task to task and share a limit with their
    executor, but allocators keep what a task has freed.
    """
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def sliced(batches: Iterator[pa.RecordBatch], column: str, max_chars: int = 4 << 20, max_rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``max_chars`` bytes, and at most ``max_rows`` rows, in each; one row may hold more bytes."""
    import numpy as np
    import pyarrow.compute as pc

    trim_memory()
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        block = np.cumsum(sizes, dtype=np.int64) // max_chars
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            for start in range(a, b, max_rows):
                yield batch.slice(start, min(max_rows, b - start))
    trim_memory()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))
