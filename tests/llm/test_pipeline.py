import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from coursepulse.llm import pieces, queries, shared
from verify import compare

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="the given tables are not here")


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, function in corpus_pipeline.STAGES:
        docs = shared.stage(function(spark, docs, SMALL), name)
        assert docs.columns[: len(columns)] == columns
        counts.append(docs.count())
        if name != "pieces":
            assert docs.columns == columns
    assert counts[1] > 0.9 * counts[0]
    assert counts[3] < counts[1] and counts[5] == counts[4]
    decoded = pieces.decode(docs, pieces.read_model(queries.model_path()))
    assert decoded.filter(F.col("decoded") != F.col("text")).count() == 0
    assert docs.filter(F.size("pieces") != F.col("n_pieces")).count() == 0


def test_stages_take_empty_tables_and_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = [(1, "the old house on the hill", "en", None, 1), (2, None, None, None, None), (None, "the old house", "en", "s", 3),
           (1, "the old house on the hill", "en", None, 1), (3, "", "en", "s", 0)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, schema)
        for name, function in corpus_pipeline.STAGES:
            docs = shared.stage(function(spark, docs, SMALL), name)
        assert docs.count() <= 2 * len(rows)


def test_stages_take_columns_of_their_own_names(spark, documents):
    docs = documents(*[(n, f"the old house number {n} on the hill by the village " * 3, "en", "s") for n in range(6)])
    given = docs.columns
    for name, function in corpus_pipeline.STAGES:
        docs = shared.stage(function(spark, docs, SMALL), name)
    assert docs.columns == [*given, "pieces_", "n_pieces_"]
    assert {(r["pieces"], r["meta.url"], r["language__"]) for r in docs.collect()} <= {("p", "u", "l")}


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "embeddings", "labels"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    outcome = compare(contract.queries()[name](spark, SMALL), db, queries.ORACLE_SQL[name])
    assert outcome.same, outcome.difference


def test_all_are_registered():
    names = contract.queries()
    assert [n for n in range(1, 11) if not any(x.startswith(f"op{n}_") for x in names)] == [] and "pipeline" in names


def test_one_query_per_document(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name in ("op3_language", "op5_pieces", "op6_toxicity", "op8_suffixes"):
        rows = queries.QUERIES[name](spark, SMALL)
        assert rows.count() == docs.count() and rows.select("doc_id").distinct().count() == docs.count()
