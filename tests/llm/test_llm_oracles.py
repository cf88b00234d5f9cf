"""The dealt queries that SQL can express, on the smallest tables; the pipeline runs over them."""

import os

import pytest
from oracle_check import compare, duck

from wrenchline.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    assert compare(spark, con, QUERIES[name], ORACLES[name], FOLDER) is None


def test_pipeline_against_plain_python(spark):
    """Stages 1 to 5 by hand, on what each stage of the run was given."""
    import corpus_pipeline as pipeline
    from wrenchline.llm import near

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {}
    for name, stage in pipeline.STAGES[:-1]:
        given = {r.doc_id: r.text or "" for r in docs.collect()}
        out = spark.createDataFrame(stage(spark, docs, FOLDER).collect(), docs.schema)
        assert out.columns == docs.columns
        kept[name] = (given, {r.doc_id: r.text or "" for r in out.collect()})
        docs = out
    given, left = kept["ngram_join"]
    sets = {d: near.shingle_set(t) for d, t in given.items()}
    group = {d: d for d in given}
    for a in sorted(given):
        for b in sorted(given):
            common = len(set(sets[a].tolist()) & set(sets[b].tolist()))
            if a < b and common and 5 * common >= 4 * (len(sets[a]) + len(sets[b]) - common):
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = {d: new if g == old else g for d, g in group.items()}
    assert set(left) == set(group.values())
    given, left = kept["line_dedup"]
    assert set(given) == set(left) and all(len(left[d]) <= len(given[d]) for d in given)
    given, left = kept["quality"]
    assert set(left) < set(given)
    total = pipeline.run(spark, FOLDER)
    assert {r.doc_id for r in total.collect()} == {r.doc_id for r in docs.collect()}
