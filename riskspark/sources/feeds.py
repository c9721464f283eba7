"""Raw feed readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskspark import schemas


def read_catalogue_feed(
    spark: SparkSession, paths: str | list[str], one_document_per_file: bool = True
) -> DataFrame:
    """Nested catalogue documents, plain or gzipped.

    A document that spans lines cannot be split, so such a file is one task: pass every file in
    one call to read them side by side. With one document per line the files are splittable.
    """
    return (
        spark.read.schema(schemas.FEED).option("multiLine", one_document_per_file).json(paths)
    )


def read_exploited_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The exploited list; quoted values may hold line breaks and doubled quotes."""
    return (
        spark.read.schema(schemas.EXPLOITED_RAW)
        .options(header=True, multiLine=True, escape='"')
        .csv(paths)
    )


def read_probability_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """A daily probability file; lines that start with ``#`` are comments."""
    return (
        spark.read.schema(schemas.PROBABILITY_RAW).options(header=True, comment="#").csv(paths)
    )
