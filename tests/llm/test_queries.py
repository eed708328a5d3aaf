"""The registered queries of the training-data operators, and the pipeline."""
import pytest
from pyspark.sql import functions as F
from conftest import SF0001
from oracle_check import compare

import __spark_entry__ as E
import corpus_pipeline

QUERIES, SQL = E.queries(), E.oracle_sql()
OWN = sorted(q for q in QUERIES if q == "pipeline" or q.startswith("op"))


def test_all_are_registered():
    assert [int(q[2:].split("_")[0]) for q in sorted(OWN[:-1], key=lambda q: int(q[2:].split("_")[0]))] == list(range(1, 14))


@pytest.mark.parametrize("name", [q for q in OWN if q in SQL])
def test_matches_duckdb(spark, duck, name):
    message, ok = compare(spark, name, QUERIES[name], SQL[name], SF0001, duck, verbose=True)
    assert ok, message


def test_pipeline_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF0001)
        assert docs.columns == columns
        assert (m := docs.count()) <= n
        n = m
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF0001)
    assert pieces.select("doc_id").distinct().count() == n


def test_stages_take_odd_rows_and_clashing_names(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    odd = spark.createDataFrame([(None, None, "en", None, None), (None, "", None, None, 0), (9, " " * 5000, "en", "x", 5000)], docs.schema)
    some = docs.limit(40)
    extra = ["__n_words", "__score", "__id", "__print", "__removed", "__key", "a.b", "key", "extra_0", "more_5"]
    rows = some.unionByName(some.limit(9)).unionByName(some.limit(3).withColumn("doc_id", F.lit(None).cast("long"))).unionByName(odd)
    rows = rows.select("*", *[F.lit(i).alias(c) for i, c in enumerate(extra)])
    texts = {r.text for r in some.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = corpus_pipeline.stored(stage(spark, rows, SF0001), "odd")
        assert rows.columns == [*docs.columns, *extra]
        assert all([r[c] for c in extra] == list(range(len(extra))) for r in rows.collect())
    left = rows.collect()
    assert left and all(r.text for r in left) and {r.text for r in left if r.n_chars == len(r.text)} & texts
    assert corpus_pipeline.STAGES[-1][1](spark, rows, SF0001).count() >= len(left)
    nothing = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        nothing = stage(spark, nothing, SF0001)
        assert nothing.count() == 0
