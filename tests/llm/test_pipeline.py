"""The pipeline against plain versions of its stages, and its queries."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tidemark.llm import pieces

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables are not here")


def test_stages_by_hand(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    left = [(r["doc_id"], r["text"]) for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")]
    left = [d for d, row in zip(left, brute.exact(left), strict=True) if row[3]]
    left = [d for d, row in zip(left, brute.near(left, 80), strict=True) if row[3]]
    left = [d for d, row in zip(left, brute.contaminated(left, items), strict=True) if not row[5]]
    own = pieces.pieces(public_tokenizers.path("word_bpe_49k.json")).tokenizer
    expected = sorted((i, len(own.encode(t, add_special_tokens=False).ids)) for i, t in left)
    got = corpus_pipeline.run(spark, FOLDER)
    assert sorted((r["doc_id"], r["n_tokens"]) for r in got.collect()) == expected


def test_stages_take_odd_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 60").withColumn("score", F.lit(1))
    odd = docs.unionByName(docs.where("doc_id < 5")).unionByName(
        docs.where("doc_id < 5").withColumn("text", F.lit(None).cast("string"))
    ).unionByName(docs.where("doc_id < 3").withColumn("doc_id", F.lit(None).cast("long")))
    for frame in (odd, docs.where("doc_id < 0")):
        now = frame
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            now = stage(spark, now, FOLDER)
            path = f"{tmp_path}/{frame is odd}-{k}"
            now.write.parquet(path)
            now = spark.read.schema(now.schema).parquet(path)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert now.columns == frame.columns
        assert (now.count() > 0) == (frame is odd)


def test_queries_that_have_sql_equal_it(spark):
    duckdb = pytest.importorskip("duckdb")
    from tidemark.llm import queries

    base = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        base.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    for name, sql in queries.oracle_sql().items():
        got = queries.queries()[name](spark, FOLDER)
        relation = base.sql(sql)
        assert sorted(got.columns) == sorted(relation.columns)
        mine = sorted(tuple(r) for r in got.select(*relation.columns).collect())
        assert mine == sorted(relation.fetchall())


def test_near_stage_joins_pairs_from_80_percent_on(spark):
    """Pairs at exactly 80 %, between it and 85 %, and just under it, against brute force."""
    rows, texts = [], {}
    for pair, more in enumerate([*[20] * 12, *range(13, 20), 21, 22, 30]):
        words = [f"w{pair}x{k}" for k in range(84)]
        # 80 shingles and as many as words are added: 80 of 80 + more are in common.
        texts[pair] = [" ".join(words), " ".join([*words, *[f"a{pair}x{k}" for k in range(more)]])]
        rows += [(2 * pair + k, t) for k, t in enumerate(texts[pair])]
    got = corpus_pipeline.near(spark, spark.createDataFrame(rows, "doc_id long, text string"), FOLDER)
    assert {r["doc_id"] for r in got.collect()} == {r[0] for r in brute.near(rows, 80) if r[3]}
    assert len(rows) - got.count() == 19


def test_forest_misses_as_seldom_at_other_percentages():
    from tidemark.llm.near_dedup import HASHES, MISS, forest

    assert (forest(85).trees, forest(85).depth, forest(85).length, forest(85).least_equal) == (20, 4, 8, 112)
    assert (forest(80).depth, forest(80).least_equal) == (3, 101)
    for percent in (50, 70, 80, 90, 95):
        own = forest(percent)
        assert (1 - (percent / 100) ** own.depth) ** own.trees <= MISS
        assert own.trees * own.length <= HASHES


def test_rows_of_one_id_are_dropped_by_their_own_text(spark):
    """A clean row stays beside a contaminated row or a near copy of the same id, or of none."""
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").where("length(text) > 100").first()["text"]
    other = lambda name, n=84: " ".join(f"{name}{k}" for k in range(n))
    rows = [(1, other("a")), (None, f"{other('a')} more"), (None, other("b")), (7, f"{other('a')} again"), (7, other("c"))]
    docs = lambda r: spark.createDataFrame(r, "doc_id long, text string").withColumn("row_key", F.lit("x"))
    left = lambda frame: {(r["doc_id"], r["text"]) for r in frame.collect()}
    near = corpus_pipeline.near(spark, docs(rows), FOLDER)
    assert near.columns == ["doc_id", "text", "row_key"]
    assert left(near) == {rows[0], rows[2], rows[4]}
    rows = [(None, f"so {item}"), (None, other("b")), (7, f"{item} so"), (7, other("c")), (None, None)]
    leaks = corpus_pipeline.leaks(spark, docs(rows), FOLDER)
    assert leaks.columns == ["doc_id", "text", "row_key"]
    assert left(leaks) == {rows[1], rows[3], rows[4]}
