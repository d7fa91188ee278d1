"""Registered queries against their DuckDB SQL on the smallest driver tables."""

from __future__ import annotations

import math
import re
from pathlib import Path

import pytest

FOLDER = "/root/testdata/sf0.001"
SAMPLE = (
    "pit_features", "pit_audit", "event_contract_violations", "conversion_quality",
    "grouped_split", "evaluate_metrics", "threshold_choice_ceiling", "top_k", "corrupted_inputs",
)


def test_every_sql_has_a_query():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    # What a fitted model decides has no SQL. The corpus queries have tests of their own.
    rest = set(entry.queries()) - set(entry.oracle_sql())
    assert {n for n in rest if not re.match(r"op\d+_|pipeline$", n)} == {
        "model_scores", "corruption_metrics",
        *[f"training_{t}" for t in ("choices", "metrics", "champions", "curves")],
        *[f"decision_{t}" for t in ("runs", "comparison", "summary", "diagnostics")],
        *[f"audit_{t}" for t in ("splits", "metrics", "summary", "bootstrap", "corruption")],
    }


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool) or isinstance(value, str):
        return value
    return float(value)


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables are not here")
@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as entry

    base = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        base.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    relation = base.sql(entry.oracle_sql()[name])
    columns = sorted(relation.columns)
    got = entry.queries()[name](spark, FOLDER)
    assert sorted(got.columns) == columns

    def table(rows, names):
        at = [names.index(c) for c in columns]
        lines = [tuple(plain(row[i]) for i in at) for row in rows]
        return sorted(lines, key=lambda t: tuple((v is None, str(v)) for v in t))

    assert table(got.collect(), got.columns) == table(relation.fetchall(), relation.columns)


def test_tables_without_models_need_no_run(spark, monkeypatch):
    """Quality, profiles and splits of a report are made without fitting its models."""
    import checks.queries as registered

    monkeypatch.setattr(registered, "_report", lambda *_: pytest.fail("the whole report was made"))
    one = spark.createDataFrame(
        [(i, "US", 20 + i % 9, i % 2, "Ads", 1 + i % 5, int(i % 4 == 0)) for i in range(60)],
        "row_id long, country string, age int, new_user int, source string,"
        " total_pages_visited int, converted int",
    )
    monkeypatch.setattr(registered.tables, "conversions", lambda *_: one)
    found = registered.all_queries()
    assert found["decision_quality"](spark, "").first()["input_rows"] == 60
    assert found["audit_quality"](spark, "").first()["output_rows"] == 60
    assert found["audit_profiles"](spark, "").count() == 2
    assert found["training_splits"](spark, "").agg({"rows": "sum"}).first()[0] == 60
