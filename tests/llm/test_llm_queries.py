"""Registered text-collection queries against their SQL twins, and the pipeline
against a brute-force version of its stages."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from check_oracle import compare
from tessera.llm import common, mixing, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, name):
    assert compare(spark, SF, [name], verbose=False)[name].get("ok") is True


def test_registered():
    names = E.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)
    assert set(queries.ORACLES) <= set(E.oracle_sql())
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]


@pytest.mark.parametrize("name", ["op1_mixing", "op6_decontamination", "op10_fingerprints"])
def test_native_queries_have_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|BroadcastNestedLoop", plan)


def test_stages(spark):
    docs = common.read_table(spark, SF, "documents")
    odd = spark.createDataFrame(
        [(10**6, None, None, None, None), (10**6 + 1, "1234 ...", "en", "src1", 8), (10**6 + 2, "", None, "src2", 0)], docs.schema
    )
    docs = common.written(docs.unionByName(odd), "test-docs")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = common.written(stage(spark, docs, SF), "test-stage")
        seen[name] = (before, docs)
        if name != "token_files":
            assert docs.columns == columns
    before, after = seen["language_id"]
    left = {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()}
    assert left == {10**6, 10**6 + 1, 10**6 + 2}
    before, after = seen["ngram_jaccard_join"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    sets = {}
    for i, t in rows:
        w = t.split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    up = {i: i for i in sets}

    def root(x):
        return x if up[x] == x else root(up[x])

    for i in sets:
        for j in sets:
            if j < i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    assert sorted(r.doc_id for r in after.collect()) == sorted({root(i) for i in sets})
    before, after = seen["benchmark_decontamination"]
    norm = lambda t: f" {' '.join(re.findall(r'[^\W_]+', t.lower()))} "
    items = [norm(r.text) for r in common.read_table(spark, SF, "benchmark").collect()]
    clean = {r.doc_id for r in before.collect() if not any(x in norm(r.text) for x in items)}
    assert {r.doc_id for r in after.collect()} == clean
    before, after = seen["mixing"]
    plan = mixing.mix_plan(before.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")))
    want = {r.doc_id: r.reps for r in plan.collect() if r.reps}
    assert {r.doc_id: r["count"] for r in after.groupBy("doc_id").count().collect()} == want
    before, after = seen["token_files"]
    out = after.orderBy("start").collect()
    assert [r.doc_id for r in out] == sorted(r.doc_id for r in before.collect())
    assert [r.start for r in out] == [0, *np.cumsum([r.n_tokens for r in out])[:-1]]
