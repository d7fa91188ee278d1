"""Tables that carry a manifest: what was written is checked before it is read again.

A checked table is a folder with ``data`` and ``manifest``. The manifest has the schema of the table
and, for each data file, its rows and a digest of them that does not depend on their order. It is
written last, so a table without one was never finished. Reading compares every file with its line:
a missing, added, cut or changed file raises.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import ContractError

#: Written formats and the options that make what is read equal to what was written.
FORMATS = {
    "parquet": {},
    "csv": {
        "header": True, "escape": '"', "nullValue": "NULL", "lineSep": "\n", "multiLine": True,
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    },
    "json": {"ignoreNullFields": False},
}
_LINES = "format string, schema string, partitions array<string>, file string, rows long, digest decimal(38,0)"


def _measures(columns: Sequence[str]) -> list[Column]:
    """Rows and digest: a sum of row hashes, so equal rows count as often as they occur."""
    parts = [F.struct(F.col(f"`{c}`").isNull(), F.col(f"`{c}`")) for c in sorted(columns)]
    row = F.xxhash64(*parts).cast("decimal(20,0)")
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(row), F.lit(0)).cast("decimal(38,0)").alias("digest"),
    ]


def _data(spark: SparkSession, path: str, form: str, schema: T.StructType) -> DataFrame:
    return spark.read.format(form).options(**FORMATS[form]).schema(schema).load(f"{path}/data")


def _files(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``file, rows, digest`` of what lies in the folder now."""
    name = F.regexp_extract(F.col("_metadata.file_path"), "/data/(.*)$", 1)
    return rows.withColumn("file", name).groupBy("file").agg(*_measures(columns))


def write_checked(
    table: DataFrame, path: str, *, form: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Write ``table`` into the new folder ``path`` and commit its manifest.

    Rows and digest of the table are compared with those of the files, so a format that cannot
    hold it (sub-millisecond moments, or the text NULL, in a CSV) raises. ``table`` is read twice;
    write it first where that is dear. An observed aggregate would save a pass, but a session that
    has observed once can no longer send a fitted logistic model to its tasks.
    """
    if form not in FORMATS:
        raise ContractError(f"unknown format {form!r}; known: {', '.join(FORMATS)}")
    spark, wrote = table.sparkSession, table.agg(*_measures(table.columns)).first()
    writer = table.write.format(form).options(**FORMATS[form])
    writer.partitionBy(*partition_by).save(f"{path}/data")
    files = _files(_data(spark, path, form, table.schema), table.columns)
    lines = files.select(
        F.lit(form).alias("format"), F.lit(table.schema.json()).alias("schema"),
        F.array(*[F.lit(c) for c in partition_by]).cast("array<string>").alias("partitions"),
        "file", "rows", "digest",
    )
    # One line is for the whole table: it stands where there is no file.
    total = lines.agg(
        F.lit(form).alias("format"), F.lit(table.schema.json()).alias("schema"),
        F.array(*[F.lit(c) for c in partition_by]).cast("array<string>").alias("partitions"),
        F.lit("").alias("file"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("digest"), F.lit(0)).cast("decimal(38,0)").alias("digest"),
    ).first()
    if (total["rows"], total["digest"]) != (wrote["rows"], wrote["digest"]):
        raise ContractError(
            f"the {form} files do not hold the table; count={wrote['rows'] - total['rows']}"
        )
    whole = spark.createDataFrame([total], _LINES)
    lines.unionByName(whole).write.json(f"{path}/manifest")


def read_checked(spark: SparkSession, path: str) -> DataFrame:
    """The table of ``path``, after every file has been compared with the manifest."""
    try:
        lines = spark.read.schema(_LINES).json(f"{path}/manifest")
        whole = lines.where("file = ''").first()
    except Exception as error:
        raise ContractError("the table has no manifest; count=0") from error
    if whole is None:
        raise ContractError("the table has no manifest; count=0")
    schema = T.StructType.fromJson(json.loads(whole["schema"]))
    table = _data(spark, path, whole["format"], schema)
    found = _files(table, schema.names)
    want = lines.where("file <> ''").select("file", F.col("rows").alias("r"), F.col("digest").alias("d"))
    odd = found.join(want, "file", "full").where(
        ~(F.col("rows").eqNullSafe(F.col("r")) & F.col("digest").eqNullSafe(F.col("d")))
    )
    bad = odd.count()
    if bad:
        raise ContractError(f"files differ from the manifest; count={bad}")
    return table.select(*schema.names)
