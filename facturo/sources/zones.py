"""Data-lake zones: ``raw/`` (source files), ``input/`` (extracts), ``output/`` (results).

A path convention only: every result is a directory of part files under
``output/<name>``; writing again replaces it when the new one is complete.
A set of results is published together, after all of them are written.
"""

from __future__ import annotations

import posixpath
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from facturo.sources import files
from facturo.operators import text


@dataclass(frozen=True)
class Zones:
    base: str

    @property
    def raw(self) -> str:
        return posixpath.join(self.base, "raw")

    @property
    def input(self) -> str:
        return posixpath.join(self.base, "input")

    @property
    def output(self) -> str:
        return posixpath.join(self.base, "output")

    def input_path(self, name: str) -> str:
        return posixpath.join(self.input, name)

    def output_path(self, name: str) -> str:
        return posixpath.join(self.output, name)


def write_results(results: dict[str, DataFrame], zones: Zones) -> dict[str, str]:
    """Write each result as parquet under ``output/<name>``, publish all at the end; return the paths."""
    paths = {name: zones.output_path(name) for name in results}
    if results:
        with files.staging(next(iter(results.values())).sparkSession) as stage:
            for name, df in results.items():
                df.write.parquet(stage(paths[name]))
    return paths


def write_text_inputs(raw: DataFrame, zones: Zones) -> tuple[str, str]:
    """The two extracts of the text/order jobs, written to the input zone.

    ``descriptions``: one stripped, non-empty description per line.
    ``customer_quantity``: ``id qty`` per line for lines with a customer.
    """
    lines_path = zones.input_path("descriptions")
    pairs_path = zones.input_path("customer_quantity")
    files.write_text_lines(text.description_lines(raw), lines_path)
    files.write_pairs(text.customer_quantity_pairs(raw), pairs_path)
    return lines_path, pairs_path


def text_jobs_from_inputs(spark: SparkSession, zones: Zones) -> dict[str, DataFrame]:
    """Word mean, length histogram, median and the secondary sort, read from the extracts."""
    lines = files.scan_text_lines(spark, zones.input_path("descriptions"))
    pairs = files.scan_pairs(spark, zones.input_path("customer_quantity"))
    return {
        "word_mean": text.word_mean(lines),
        "word_length_hist": text.word_length_hist(lines),
        "word_median": text.word_median(lines),
        "customer_quantity_sorted": text.customer_quantity_sorted(pairs),
    }
