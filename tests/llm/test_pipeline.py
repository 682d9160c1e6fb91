"""The pipeline's stages against plain versions, and its queries against SQL."""

import duckdb
import pytest

import corpus_pipeline
from test_text_operators import brute_components
from wardflow.llm import decontaminate, pii, queries, rules


def test_stages_against_plain_versions(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert sorted(out.columns) == sorted(["doc_id", "text", "lang", "source", "n_chars"]), name
        docs = spark.createDataFrame(out.collect(), out.schema)
        got = {r.doc_id: r.text for r in docs.collect()}
        before = {i: r.text for i, r in rows.items()}
        if name == "quality_rules":
            assert got == {i: t for i, t in before.items() if not any(test(rules.Facts(t)) for test in rules.RULES.values())}
        elif name == "near_duplicates":
            groups = brute_components(before.items(), 5, 80)
            assert got == {i: t for i, t in before.items() if groups[i][1] == i}
        elif name == "decontamination":
            hits = {r.doc_id for r in decontaminate.benchmark_hits(spark.createDataFrame([(i, t) for i, t in before.items()], "doc_id bigint, text string"), spark.read.parquet(f"{small}/benchmark.parquet")).where("contaminated").collect()}
            assert hits and got == {i: t for i, t in before.items() if i not in hits}
        else:
            assert got == {i: pii.mask(t) for i, t in before.items()}
        rows = {r.doc_id: r for r in docs.collect()}
    final = corpus_pipeline.STAGES[-1][1](spark, docs, small)
    assert {r.doc_id for r in final.collect()} == set(rows) and final.columns == ["doc_id", "n_tokens", "ids"]


def test_stages_take_odd_texts(spark, texts, small):
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, texts, small).count()
    kept = [r.doc_id for r in corpus_pipeline.near_duplicates(spark, texts, small).collect()]
    assert sorted(i for i in kept if i is not None) == [1, 2, 3, 4, 5, 6, 8, 9] and kept.count(None) == 1


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_queries_equal_their_sql(spark, small, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations", "pages"):
        con.sql(f"create view {table} as select * from '{small}/{table}.parquet'")
    want = con.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, small)
    rows = sorted(map(tuple, got.select(want.columns).collect()), key=str)
    assert sorted(got.columns) == sorted(want.columns) and rows == sorted(want.fetchall(), key=str)
