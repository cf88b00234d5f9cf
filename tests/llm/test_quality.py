"""The field's marginals against all labellings, the bounded fit, and held-out rows of the tables."""

import itertools
import os
import random
import zlib

import numpy as np
import pytest

from wrenchline.llm import quality

FOLDER = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string"


def text_of(rng, good, lines):
    word = (lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))) if good else (lambda: "".join(rng.choice("#|$%XYZ019") for _ in range(rng.randint(2, 7))))
    return "\n".join(" ".join(word() for _ in range(rng.randint(1, 12))) for _ in range(lines))


def enumerated(field, text):
    """The weighted mean marginal of good by the sum over all labellings of the lines."""
    x, _ = quality.features([text])
    emitted = x @ field.emission
    weights = [max(len(line.encode()), 1) for line in text.split("\n")]
    total, good = 0.0, np.zeros(len(x))
    for labels in itertools.product((0, 1), repeat=len(x)):
        score = sum(e for e, y in zip(emitted, labels, strict=True) if y) + sum(field.transition[a, b] for a, b in itertools.pairwise(labels))
        total += np.exp(score)
        good += np.exp(score) * np.array(labels)
    return float(good / total @ weights) / sum(weights)


def test_scores_equal_the_sum_over_all_labellings():
    rng = random.Random(3)
    numbers = np.random.default_rng(3)
    texts = [text_of(rng, rng.random() < 0.5, rng.randint(1, 9)) for _ in range(30)] + ["", "\n\n", "é\n\nx"]
    for _ in range(3):
        field = quality.Field(numbers.normal(size=quality.FEATURES), numbers.normal(size=(2, 2)))
        assert np.allclose(field.scores(texts), [enumerated(field, t) for t in texts], atol=1e-6)


def test_fit_climbs_the_gradient_of_the_likelihood():
    """One step of the ascent goes to the side on which the enumerated likelihood grows."""
    rng = random.Random(5)
    documents = [(quality.features([text_of(rng, i % 2, rng.randint(1, 5))])[0], i % 2) for i in range(20)]

    def likelihood(field):
        out = 0.0
        for x, y in documents:
            e = x @ field.emission
            score = lambda labels: sum(v for v, s in zip(e, labels, strict=True) if s) + sum(field.transition[a, b] for a, b in itertools.pairwise(labels))  # noqa: B023, E731
            out += score([y] * len(x)) - np.log(sum(np.exp(score(labels)) for labels in itertools.product((0, 1), repeat=len(x))))
        return out / len(documents)

    values = [likelihood(quality.fit(documents, rounds=n, rate=0.02)) for n in (0, 5, 20, 60)]
    assert values == sorted(values) and values[-1] > 0.5 * values[0]


def test_chains_are_the_whole_text_in_stretches():
    rng = random.Random(7)
    for lines in (1, 2, 9, 10, 11, 31):
        text = text_of(rng, True, lines)
        parts = list(quality.chains(text, 10))
        assert [len(p) for p in parts] == [min(10, lines - i) for i in range(0, lines, 10)]
        assert np.array_equal(np.concatenate(parts), quality.features([text])[0])


def test_a_very_long_text_leaves_the_fit_small(spark):
    rng = random.Random(11)
    long = next(i for i in range(1000, 2000, 2) if zlib.crc32(str(i).encode()) % 5)
    rows = [(i, text_of(rng, i % 2 == 0, 1 + i % 4)) for i in range(300)] + [(long, text_of(rng, True, 5) + "\nplain words in a line" * 30_000), (2001, None), (2002, "")]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i, _ in rows], "doc_id bigint, quality int")
    used = {i for (i, flag) in docs.select("doc_id", quality.held_out(docs.doc_id)).collect() if not flag}
    found = quality.training_chains(docs, labels, sample_chains=260).collect()
    assert len(found) == 260 and {r.doc_id for r in found} == used
    assert all(len(r.features) <= 2 * quality.FEATURES * quality.CHAIN_LINES for r in found)
    scored = quality.digest(docs, labels).collect()
    right = [r.predicted == int(r.doc_id % 2 == 0) for r in scored if r.doc_id < 1000 and r.held_out]
    assert len(scored) == len(rows) and np.mean(right) > 0.95


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_held_out_rows_of_the_tables(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{name}.parquet") for name in ("documents", "labels"))
    marked = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    rows = quality.digest(docs, labels).collect()
    assert len(rows) == docs.count() and all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    held = [(r.score, marked[r.doc_id]) for r in rows if r.held_out and r.doc_id in marked]
    good, bad = ([s for s, y in held if y == k] for k in (1, 0))
    above = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert above > 0.97 and np.mean([s >= 0.3 for s in good]) > 0.97
