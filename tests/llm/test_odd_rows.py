"""Rows that used to be dropped or to end a job."""

import json
import math

from pyspark.sql import functions as F

from wrenchline.llm import chat, quality, topk

VECTORS = "vec_id bigint, embedding array<double>"


def test_long_vectors_are_queries_and_candidates(spark):
    big = 70_000.0
    rows = [(i, [math.sin(i * 7.0) * 3, math.cos(i * 3.0), i / 50]) for i in range(1, 230) if i != 50]
    rows += [(0, [1.0, 0.5, 0.25]), (50, [big, -1.0, 2.5]), (301, [big * 1000, 1.0]), (302, [-big * 9e9, 1.0, 3.0]), (302, [2.0**40, 0.1, 3.0])]
    rows += [(400, [1e300, 0.0, 1.0]), (401, [math.inf, 0.0, 0.0]), (402, [None, 0.0, 0.0]), (450, None), (None, [1.0, 2.0, 3.0])]
    fine = [(i, v) for i, v in rows if i is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    held = lambda c: math.floor(max(min(256 * c, 2.0**58), -(2.0**58)))
    whole = [(i, [held(c) for c in v]) for i, v in fine]
    want = {}
    for q, x in whole:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y, strict=False)), i) for i, y in whole if i != q)[:5]
            want |= {(q, rank): (i, -s if abs(s) < 2**63 else None) for rank, (s, i) in enumerate(scores, 1)}
    got = topk.digest(spark.createDataFrame(rows, VECTORS).repartition(3), spark).collect()
    assert len(got) == len(want) and {(r.query_id, r.rank): (r.vec_id, r.score) for r in got} == want


def test_blocks_of_long_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 7)
    rows = [(i, [float(10**8 + (i * 37) % 101), float(i % 13 - 6) * 10**7, 1.0]) for i in range(200)]
    whole = {i: [math.floor(256 * c) for c in v] for i, v in rows}
    want = {}
    for q in range(0, 200, 50):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], y, strict=True)), i) for i, y in whole.items() if i != q)[:5]
        want |= {(q, rank): (i, -s) for rank, (s, i) in enumerate(scores, 1)}
    got = topk.digest(spark.createDataFrame(rows, VECTORS), spark).collect()
    assert {(r.query_id, r.rank): (r.vec_id, r.score) for r in got} == {k: (i, s if s < 2**63 else None) for k, (i, s) in want.items()}


def test_a_repeated_argument_counts_once(spark):
    call = '{"tool_call":{"id":"a","name":"reply","arguments":{"text":"1","role":"u","text":"2"}}}'
    rows = [(1, 0, "user", call), (1, 1, "assistant", '{"tool_result":{"id":"a","content":"ok"}}'), (2, 0, "user", "hello")]
    found = chat.formatted(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"), spark)
    by = {(r.conv_id, r.turn): r for r in found.collect()}
    assert json.loads(by[1, 0].json)["arguments"] == {"role": "u", "text": "2"}
    assert (by[1, 0].status, by[1, 0].errors, by[1, 1].status, by[2, 0].status) == ("linked", "", "linked", "unanswered")


def test_quality_keeps_a_column_of_its_own_name(spark):
    docs = spark.range(40).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 2 == 0, "some plain words in a line\nand some more of them").otherwise("$$ ## 1 !!").alias("text"),
        F.lit("mine").alias("_quality_score"),
        F.lit(3).alias("_QUALITY_SCORE_"),
    )
    labels = docs.select("doc_id", (F.lit(1) - F.col("doc_id") % 2).cast("int").alias("quality"))
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns
    assert {(r[2], r[3]) for r in kept.collect()} == {("mine", 3)} and kept.count() >= 20


def test_a_filter_of_bits_loses_no_wanted_row(spark, monkeypatch):
    from wrenchline.llm import common

    for words, most in ((1 << 20, 120), (2, 5000)):
        monkeypatch.setattr(common, "FILTER_WORDS", words)
        rows = spark.range(5000).select((F.col("id") * 7919 - 10**6).alias("a"), (F.col("id") % 11).alias("b"), F.lit("x").alias("t.x"))
        wanted = rows.where("a % 50 = 0")
        found = common.maybe_in(rows, wanted.unionByName(wanted), ["a", "b"])
        assert found.columns == rows.columns and found.count() <= most
        assert found.join(wanted, ["a", "b"], "left_semi").count() == wanted.count() == 100
    assert common.maybe_in(rows, wanted.limit(0), ["a"]).count() == 0
