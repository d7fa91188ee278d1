"""Sinks for features, report tables and one-row reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_json_report(report: DataFrame, path: str) -> None:
    """A one-row report as JSON with sorted keys, nulls kept; one file with LF line ends."""
    row = F.to_json(
        F.struct(*[F.col(c) for c in sorted(report.columns)]), {"ignoreNullFields": "false"}
    )
    report.select(row.alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_table(table: DataFrame, path: str, *, partition_by: Sequence[str] = ()) -> None:
    """Parquet, partitioned by the columns of ``partition_by`` that the table has."""
    parts = [c for c in partition_by if c in table.columns]
    table.write.mode("overwrite").partitionBy(*parts).parquet(path)


def write_report_tables(
    report: object, folder: str, *, partition_by: Sequence[str] = ("scenario", "split_strategy")
) -> list[str]:
    """Every table of a report dataclass under its own name; returns the names."""
    names = []
    for field in fields(report):
        table = getattr(report, field.name)
        if isinstance(table, DataFrame):
            write_table(table, f"{folder}/{field.name}", partition_by=partition_by)
            names.append(field.name)
    return names


def write_csv(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").option("header", True).csv(path)
