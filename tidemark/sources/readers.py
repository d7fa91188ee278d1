"""Readers that fail on an ambiguous schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import ContractError
from tidemark.operators.checks import require_unique_columns
from tidemark.operators.conversion import clean_conversions, conversion_quality

# Cell texts that mean "missing" in a CSV file.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns of one or more CSV files as text, after the header has been checked.

    The first file's header is read as data, so a repeated name cannot be renamed silently. Every
    other file must have the same header, which the reader itself enforces.
    """
    first = spark.read.csv(path, header=False, maxColumns=20480).head()
    if first is None:
        raise ContractError("CSV file has no header; count=0")
    names = [name or "" for name in first]
    require_unique_columns(names, "CSV header")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    rows = spark.read.csv(
        path, schema=schema, header=True, enforceSchema=False, mode="FAILFAST",
    )
    return rows.select(
        *[
            F.when(~F.col(f"`{name}`").isin(*MISSING_TEXTS), F.col(f"`{name}`")).alias(name)
            for name in names
        ]
    )


def load_conversions(
    spark: SparkSession, path: str, *, keep: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """The cleaned conversion table of a CSV path and its one-row quality report."""
    rows = read_csv(spark, path)
    return clean_conversions(rows, keep=keep), conversion_quality(rows)
