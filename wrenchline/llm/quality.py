"""Document quality from a linear-chain conditional random field over the lines.

Every line is good or bad. A line is described by which characters it is made of
and by simple word statistics, its own and those of the lines before and after it.
The field is fitted to labelled documents, each line carrying the label of its
document. A document's score is the mean of its lines' forward-backward marginals
of "good", weighted by line length.

The fit uses at most ``sample_docs`` labelled documents (default 4,000), the first
by a hash of the id; rows whose crc32(doc_id) mod 5 is 0 never enter. Their lines are cut
into chains of at most ``CHAIN_LINES``, and at most ``SAMPLE_CHAINS`` chains enter, one of each
document before a second of any. The fit runs in one task on that bounded sample, whatever
the length of the documents. Scoring reads nothing of a document but its text.

Rows: a null text is an empty one; an empty text is one empty line, and gets a
score as any other. Repeated rows each get a score. Labels that are null or
contradict each other for a doc_id are left out of the fit; without any usable
label of both kinds every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SAMPLE_DOCS = 4000
#: Bounds of the fit, in lines a chain and chains in all.
CHAIN_LINES = 128
SAMPLE_CHAINS = 6000
THRESHOLD = 0.3
#: Own statistics of a line: the shares of its bytes by kind (each ASCII sign for itself, lower
#: case, upper case, digits, all others), and four word statistics.
_PLACE = np.zeros(256, np.int64)
_SIGNS = [c for c in range(32, 127) if not chr(c).isalnum()]
_PLACE[_SIGNS] = np.arange(4, 4 + len(_SIGNS))
_PLACE[ord("a") : ord("z") + 1] = 1
_PLACE[ord("A") : ord("Z") + 1] = 2
_PLACE[ord("0") : ord("9") + 1] = 3
BYTE_KINDS = 4 + len(_SIGNS)
WIDTH = BYTE_KINDS + 4
#: Features of a line: its own, those of its neighbours, whether it is first or last, and a constant.
FEATURES = 3 * WIDTH + 3
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_MIX = np.random.default_rng(7).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
#: So many bytes are looked at together.
PIECE = 1 << 21


def _pieces(raw: bytes) -> Iterator[bytes]:
    """The bytes in pieces that end at a blank where there is one."""
    start = 0
    while start < len(raw):
        end = min(start + PIECE, len(raw))
        if end < len(raw):
            cut = max(raw.rfind(b" ", start, end), raw.rfind(b"\n", start, end))
            end = cut + 1 if cut > start else end
        yield raw[start:end]
        start = end


def _statistics(texts: list[bytes]) -> np.ndarray:
    """Own statistics of all lines of the texts, in order."""
    raw = b"\n".join(texts) + b"\n"
    n = raw.count(b"\n")
    kinds = np.zeros((n, BYTE_KINDS))
    words, length, square, repeats = np.zeros((4, n))
    done = 0
    for piece in _pieces(raw):
        data = np.frombuffer(piece, np.uint8)
        ends = data == 10
        line = np.cumsum(ends) - ends
        span = int(line[-1]) + 1
        here = slice(done, done + span)
        inner = ~ends
        kinds[here] += np.bincount(
            (line * BYTE_KINDS + _PLACE[data])[inner], minlength=span * BYTE_KINDS
        ).reshape(span, BYTE_KINDS)
        solid = ~_BLANK[data]
        first = np.flatnonzero(solid & np.concatenate([[True], ~solid[:-1]]))
        if first.size:
            last = np.flatnonzero(solid & np.concatenate([~solid[1:], [True]]))
            size = last - first + 1
            place = np.zeros(data.size, np.int64)
            place[first[0] :] = np.arange(first[0], data.size) - np.repeat(first, np.diff(np.append(first, data.size)))
            key = np.add.reduceat(np.where(solid, data, 0).astype(np.uint64) * _MIX[place & 63], first)
            at = line[first]
            words[here] += np.bincount(at, minlength=span)
            length[here] += np.bincount(at, size, span)
            square[here] += np.bincount(at, size.astype(float) ** 2, span)
            same = (key[1:] == key[:-1]) & (at[1:] == at[:-1]) & (size[1:] == size[:-1])
            repeats[here] += np.bincount(at[1:][same], minlength=span)
        done += int(ends.sum())
    out = np.zeros((n, WIDTH), np.float32)
    out[:, :BYTE_KINDS] = np.sqrt(kinds / np.maximum(kinds.sum(1, keepdims=True), 1))
    some = np.maximum(words, 1)
    mean = length / some
    out[:, -4] = np.log1p(words) / 5
    out[:, -3] = np.minimum(mean / 10, 5)
    out[:, -2] = np.minimum(np.sqrt(np.maximum(square / some - mean**2, 0)) / 10, 5)
    out[:, -1] = np.sqrt(repeats / some)
    return out


def _lines(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own statistics of all lines, the number of lines of each text, and each line's weight: its length, at least 1."""
    raw = [(t or "").encode() for t in texts]
    counts = np.array([r.count(b"\n") + 1 for r in raw])
    ends = [np.flatnonzero(np.frombuffer(r + b"\n", np.uint8) == 10) for r in raw]
    weights = [np.maximum(np.diff(np.concatenate([[-1], e])) - 1, 1) for e in ends]
    return _statistics(raw), counts, np.concatenate(weights).astype(float)


def _neighbours(own: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each line is the first and the last of its text."""
    stops = np.cumsum(counts)
    first, last = np.zeros(len(own), bool), np.zeros(len(own), bool)
    first[stops - counts] = last[stops - 1] = True
    return first, last


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(lines x FEATURES of all texts, number of lines of each)."""
    own, counts, _ = _lines(texts)
    return _described(own, *_neighbours(own, counts)), counts


def chains(text: str | None, size: int = CHAIN_LINES) -> Iterator[np.ndarray]:
    """The features of a text's lines in stretches of at most ``size``, with the neighbours that they have in the text."""
    own, counts, _ = _lines([text])
    first, last = _neighbours(own, counts)
    for start in range(0, len(own), size):
        low, high = max(start - 1, 0), min(start + size + 1, len(own))
        yield _described(own[low:high], first[low:high], last[low:high])[start - low :][:size]


def _described(own: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Features of successive lines: each line's own and its neighbours' statistics."""
    out = np.zeros((len(own), FEATURES), np.float32)
    out[:, :WIDTH] = own
    out[1:, WIDTH : 2 * WIDTH] = own[:-1] * ~first[1:, None]
    out[:-1, 2 * WIDTH : 3 * WIDTH] = own[1:] * ~last[:-1, None]
    out[:, -3], out[:, -2], out[:, -1] = first, last, 1
    return out


@dataclass
class Field:
    """Weights: ``emission`` is the score of good less that of bad, ``transition[a, b]`` that of b after a."""

    emission: np.ndarray
    transition: np.ndarray

    def line_scores(self, own: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Emission scores of all lines, without building the neighbours' copies."""
        first, last = _neighbours(own, counts)
        e = self.emission
        out = own @ e[:WIDTH] + first * e[-3] + last * e[-2] + e[-1]
        out[1:] += (own[:-1] @ e[WIDTH : 2 * WIDTH]) * ~first[1:]
        out[:-1] += (own[1:] @ e[2 * WIDTH : 3 * WIDTH]) * ~last[:-1]
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Each text's mean marginal of good, weighted by line length."""
        own, counts, weights = _lines(texts)
        emitted = self.line_scores(own, counts)
        starts = np.cumsum(counts) - counts
        out = np.empty(len(texts))
        order = np.argsort(-counts, kind="stable")
        while order.size:  # padded to the longest of a group of bounded size
            group = order[: max(1, CELLS // int(counts[order[0]]))]
            order = order[group.size :]
            lengths = counts[group]
            owner = np.repeat(np.arange(group.size), lengths)
            step = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            at = starts[group][owner] + step
            padded = np.zeros((group.size, lengths[0]))
            padded[owner, step] = emitted[at]
            alpha, beta, total = _forward_backward(padded, lengths, self.transition)
            good = np.exp(alpha[owner, step, 1] + beta[owner, step, 1] - total[owner])
            mass = np.bincount(owner, weights[at])
            out[group] = np.bincount(owner, good * weights[at]) / mass
        return np.clip(out, 0, 1)


#: Lines times documents that are padded together.
CELLS = 1 << 18


def _forward_backward(scores, lengths, transition):
    """Log alpha and beta of padded sequences (sequence, step, state), and log Z; sequences by falling length."""
    n, steps = scores.shape
    emit = np.stack([np.zeros_like(scores), scores], -1)
    alpha, beta = np.zeros((n, steps, 2)), np.zeros((n, steps, 2))
    alpha[:, 0] = emit[:, 0]
    live = (lengths[None] > np.arange(steps)[:, None]).sum(1)
    for t in range(1, steps):
        k = live[t]
        alpha[:k, t] = emit[:k, t] + np.logaddexp(
            alpha[:k, t - 1, :1] + transition[0], alpha[:k, t - 1, 1:] + transition[1]
        )
    for t in range(steps - 2, -1, -1):
        k = live[t + 1]
        later = emit[:k, t + 1] + beta[:k, t + 1]
        beta[:k, t] = np.logaddexp(later[:, :1] + transition[:, 0], later[:, 1:] + transition[:, 1])
    last = alpha[np.arange(n), lengths - 1]
    return alpha, beta, np.logaddexp(last[:, 0], last[:, 1])


def fit(
    documents: list[tuple[np.ndarray, int]], rounds: int = 160, rate: float = 0.08, decay: float = 2e-4, shares: list[float] | None = None
) -> Field:
    """Gradient ascent (Adam) on the mean conditional log-likelihood per document, with L2 decay.

    A document may come as several chains, each with its share of the document's weight.
    """
    field = Field(np.zeros(FEATURES), np.zeros((2, 2)))
    if len({label for _, label in documents}) < 2:
        return field
    by_length = sorted(range(len(documents)), key=lambda i: -len(documents[i][0]))
    share = np.ones(len(documents)) if shares is None else np.array(shares, float)[by_length]
    documents = [documents[i] for i in by_length]
    lengths = np.array([len(x) for x, _ in documents])
    labels = np.array([y for _, y in documents], float)
    rows = np.concatenate([x for x, _ in documents])
    owner = np.repeat(np.arange(len(documents)), lengths)
    step = np.concatenate([np.arange(k) for k in lengths])
    # Every document weighs the same, however many lines it has.
    weight = share / share.sum()
    state = np.zeros((2, FEATURES + 4))
    theta = np.zeros(FEATURES + 4)
    live = [(lengths > t).sum() for t in range(lengths[0])]
    for i in range(1, rounds + 1):
        field = Field(theta[:FEATURES], theta[FEATURES:].reshape(2, 2))
        scores = np.zeros((len(documents), lengths[0]))
        scores[owner, step] = rows @ field.emission.astype(np.float32)
        alpha, beta, total = _forward_backward(scores, lengths, field.transition)
        good = np.exp(alpha[..., 1] + beta[..., 1] - total[:, None])[owner, step]
        gradient = np.zeros_like(theta)
        gradient[:FEATURES] = ((labels[owner] - good) / np.sqrt(lengths)[owner] * weight[owner]).astype(np.float32) @ rows
        pairs = np.zeros((2, 2))
        for t in range(1, lengths[0]):
            k = live[t]
            for a in (0, 1):
                for b in (0, 1):
                    expected = np.exp(
                        alpha[:k, t - 1, a] + field.transition[a, b] + b * scores[:k, t] + beta[:k, t, b] - total[:k]
                    )
                    truth = (labels[:k] == a) * (a == b)
                    pairs[a, b] += ((truth - expected) / lengths[:k]) @ weight[:k]
        gradient[FEATURES:] = pairs.ravel()
        gradient -= decay * theta
        state[0] = 0.9 * state[0] + 0.1 * gradient
        state[1] = 0.999 * state[1] + 0.001 * gradient**2
        theta = theta + rate * (state[0] / (1 - 0.9**i)) / (np.sqrt(state[1] / (1 - 0.999**i)) + 1e-8)
    return Field(theta[:FEATURES], theta[FEATURES:].reshape(2, 2))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """At most ``sample_docs`` rows (text, label): chosen among the labels first, so few texts are read."""
    usable = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("_q_low"), F.max("quality").alias("_q_high"))
        .where("_q_low = _q_high")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_docs)
        .select("doc_id", F.col("_q_low").cast("int").alias("label"))
    )
    texts = docs.select("doc_id", "text").join(usable, "doc_id", "left_semi")
    # A doc_id that rows repeat gives one text, so the sample stays bounded.
    one = texts.groupBy("doc_id").agg(F.min("text").alias("text"))
    return one.join(usable, "doc_id").select("doc_id", "text", "label")


def training_chains(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chains: int = SAMPLE_CHAINS) -> DataFrame:
    """At most ``sample_chains`` rows (doc_id, place, label, features), made where the texts are.

    The chains of a document are in the order of a hash, and the first of every document
    comes before the second of any; a document whose chains all fit is there whole.
    """

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text, label in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "label")), strict=True):
                for number, x in enumerate(chains(text)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc], pa.int64()), pa.array([number], pa.int64()), pa.array([label], pa.int32()), pa.array([x.astype(np.float16).tobytes()], pa.binary())],
                        names=["doc_id", "number", "label", "features"],
                    )

    cut = training_sample(docs, labels, sample_docs).mapInArrow(describe, "doc_id bigint, number bigint, label int, features binary")
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("doc_id", "number"), "number"))
    ranked = cut.withColumn("place", place).where(F.col("place") <= sample_chains)
    return ranked.orderBy("place", F.xxhash64("doc_id"), "doc_id").limit(sample_chains).select("doc_id", "place", "label", "features")


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chains: int = SAMPLE_CHAINS) -> Field:
    """Features are made where the texts are; one task fits; the weights come back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r["doc_id"], r["place"], r["features"], r["label"]) for b in batches for r in b.to_pylist())
        found = [np.frombuffer(x, np.float16).reshape(-1, FEATURES).astype(np.float32) for _, _, x, _ in rows]
        _, doc = np.unique([r[0] for r in rows], return_inverse=True) if rows else ([], np.zeros(0, int))
        sizes = np.array([len(x) for x in found], float)
        shares = sizes / np.bincount(doc, sizes)[doc] if rows else sizes
        field = fit(list(zip(found, [r[3] for r in rows], strict=True)), shares=shares)
        yield pa.RecordBatch.from_arrays(
            [pa.array([field.emission.tolist()]), pa.array([field.transition.ravel().tolist()])], names=["emission", "transition"]
        )

    sample = training_chains(docs, labels, sample_docs, sample_chains)
    fitted = sample.repartition(1).mapInArrow(run, "emission array<double>, transition array<double>").collect()
    row = fitted[0]
    return Field(np.array(row["emission"]), np.array(row["transition"]).reshape(2, 2))


def with_score(docs: DataFrame, field: Field, name: str = "score") -> DataFrame:
    """``docs`` and their score, in one pass."""
    schema = docs.withColumn(name, F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 512):
                batch = whole.slice(first, 512)
                scores = field.scores(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = with_score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject, with their columns as they are."""
    name = "_quality_score"
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    return with_score(docs, train(docs, labels), name).where(F.col(name) >= THRESHOLD).select(*docs.columns)
