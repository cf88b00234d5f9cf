"""Prefix trie, whitening and BPE by forced boundaries on small inputs with odd rows, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from wrenchline.llm import forced_bpe, prefix_trie, whitening

VECTORS = "vec_id bigint, embedding array<double>"
TURNS = "conv_id bigint, turn bigint, role string, text string"


# -- BPE by forced boundaries


@pytest.fixture(scope="module")
def bpe():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        config = file.read()
    return path, forced_bpe.Codec(config), Tokenizer.from_str(config)


def test_forced_bpe_equals_the_library(bpe):
    _, own, library = bpe
    rng = random.Random(5)
    alphabet = " \n\t\r\x0b\x85\xa0　\x1c'sdlveabcXY019.,!éçü漢字😀ͅ\x00"
    for i in range(20_000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14)))
        if i % 10 == 0:
            text = f"{text}<|endoftext|>{text}"
        if i % 5 == 0:
            text = f"{text} {chr(rng.randrange(0x20, 0xD7FF))} {text}"
        ids = own.encode(text)
        assert list(ids) == library.encode(text, add_special_tokens=False).ids, repr(text)
        assert own.decode(ids) == library.decode(list(ids), skip_special_tokens=False) == text


def test_forced_bpe_of_long_words_and_broken_bytes(bpe):
    _, own, library = bpe
    text = "a" * 50_000 + "é" * 50_000 + "\n" * 500 + " x" * 50_000
    assert list(own.encode(text)) == library.encode(text, add_special_tokens=False).ids
    ids = list(own.encode("é漢"))[:-1] + [50256]
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_cuts_stand_where_no_entry_spans_and_nowhere_else():
    allowed = forced_bpe.allowed_pairs(["ab", "bc", "d"])
    assert forced_bpe.fragments(["abcd", "b", "ca"], allowed) == (["abc", "d", "b", "c", "a"], [2, 1, 2])


def test_forgotten_words_come_out_the_same(bpe, monkeypatch):
    _, own, library = bpe
    monkeypatch.setattr(own, "words", forced_bpe.Recent(20))
    monkeypatch.setattr(own, "pieces", forced_bpe.Recent(20))
    rng = random.Random(6)
    for _ in range(300):
        text = " ".join("".join(rng.choice("abcé") for _ in range(rng.randint(1, 3))) for _ in range(30))
        assert list(own.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_forced_bpe_rows(spark, bpe):
    path, own, library = bpe
    rows = [(1, None), (1, ""), (None, "a b"), (2, "same"), (2, "same"), (3, "word " * 200_000)]
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id bigint, text string, ids int, decoded string")
    got = sorted(map(repr, forced_bpe.digest(docs, path).collect()))
    want = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        raw, back = np.array(ids, dtype="<u4").tobytes(), library.decode(ids, skip_special_tokens=False).encode()
        want.append((i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back).hexdigest()))
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    assert got == sorted(map(repr, spark.createDataFrame(want, schema).collect()))
    out = {(r.doc_id, len(r.ids)): r.decoded for r in forced_bpe.encode_documents(docs, path).collect()}
    assert out[None, 2] == "a b" and out[3, len(own.encode("word " * 200_000))] == "word " * 200_000
    assert forced_bpe.digest(docs.limit(0), path).count() == 0


# -- whitening


def whitened_by_hand(rows, k, weights="counts"):
    fine = [
        (i, tuple(math.floor(1024 * c) + 100_000 for c in v))
        for i, v in rows
        if v and all(c is not None and math.isfinite(c) for c in v)
    ]
    fit = [v for _, v in fine] if weights == "counts" else sorted({v for _, v in fine})
    n, sums = len(fit), [sum(column) for column in zip(*fit, strict=True)]
    exact = {i: [n * x - s for x, s in zip(v, sums, strict=True)] for i, v in fine}
    centred = np.array([[float(n * x - s) / n for x, s in zip(v, sums, strict=True)] for v in fit])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:k]
    scale = np.sqrt(values[order])
    return {
        i: (n, sum(d * d for d in own), np.array([float(d) / n for d in own]) @ vectors[:, order] / scale, values[order] / np.trace(covariance))
        for i, own in exact.items()
    }


def check_whitening(got, want, k):
    rows = defaultdict(dict)
    for r in got:
        rows[r.vec_id][r.component] = r
    assert set(rows) == set(want) and all(sorted(c) == list(range(1, k + 1)) for c in rows.values())
    for c in range(1, k + 1):
        ours = np.array([rows[i][c].whitened for i in sorted(want)])
        theirs = np.array([want[i][2][c - 1] for i in sorted(want)])
        sign = np.sign(ours @ theirs)
        assert np.allclose(ours, sign * theirs, atol=1e-7)
    for i, (n, deviation, _, explained) in want.items():
        held = deviation if deviation < 2**63 else None
        assert all((r.n, r.deviation) == (n, held) for r in rows[i].values())
        assert np.allclose([rows[i][c].explained for c in range(1, k + 1)], explained, rtol=1e-9)
        assert all(r.identity_error < 1e-8 for r in rows[i].values())


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(2)
    mixed = rng.normal(size=(400, 12)) @ rng.normal(size=(12, 12))
    rows = [(i, v.tolist()) for i, v in enumerate(mixed)]
    rows += [(1000 + i, rows[7][1]) for i in range(300)]  # a third is one vector
    rows += [(2000, None), (2001, []), (2002, [None] + [0.0] * 11), (2003, [math.inf] + [0.0] * 11), (2004, [math.nan] * 12)]
    rows += [(3000, [70_000.0] + [0.25] * 11)]
    odd = [(4000, [1.0, 2.0])]  # of another length than most
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows + odd], VECTORS + ", digest string, n int").repartition(5)
    check_whitening(whitening.digest(frame, spark).collect(), whitened_by_hand(rows, 8), 8)


def test_whitening_of_singles_counts_each_vector_once(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(60, 3)))]
    rows += [(100 + i, rows[0][1]) for i in range(50)]
    frame = spark.createDataFrame(rows, VECTORS)
    want = whitened_by_hand(rows, 3, "one")
    for r in whitening.whiten(frame, spark, 3, "one").collect():
        n, deviation, whitened, _ = want[r.vec_id]
        assert (r.n, int(r.deviation)) == (n, deviation) and np.allclose(np.abs(r.whitened), np.abs(whitened), atol=1e-8)
        assert r.identity_error < 1e-9


def test_whitening_without_variance(spark):
    assert whitening.digest(spark.createDataFrame([], VECTORS), spark).count() == 0
    assert whitening.digest(spark.createDataFrame([(1, None), (2, [])], VECTORS), spark).count() == 0
    flat = spark.createDataFrame([(1, [0.5, 1.0]), (None, [0.5, 1.0]), (1, [0.5, 1.0])], VECTORS)
    got = whitening.digest(flat, spark).collect()
    assert len(got) == 6 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {(3, 0, None, None, None)}
    line = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(4)], VECTORS)
    got = whitening.digest(line, spark).collect()
    assert {r.component: r.whitened is None for r in got} == {1: False, 2: True}
    assert all(r.identity_error < 1e-12 for r in got)


def test_whitening_of_entries_beyond_a_long(spark):
    rows = [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [5.0, 2.0])]
    got = whitening.digest(spark.createDataFrame(rows, VECTORS), spark).collect()
    assert len(got) == 6 and all(r.n == 3 for r in got)


# -- prefix trie


def trie_by_hand(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            own[c].append(((turn is not None, turn or 0), role, key, text))
    own = {c: [(role, text) for _, role, _, text in sorted(v)] for c, v in own.items()}
    members, text_of, full = defaultdict(list), {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        full[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:])
        for d in range(len(full[c]) + 1):
            members[full[c][:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[b] for b in below) or 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[b] for b in below)
    out = []
    for node, who in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in who if len(full[c]) == len(node)))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(who), len(node), parent, len(who), len(children.get(node, [])), leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("height", [2, 3, 16])
def test_trie_against_brute_force(spark, monkeypatch, height):
    monkeypatch.setattr(prefix_trie, "HEIGHT", height)
    monkeypatch.setattr(prefix_trie, "SECTION", 7)
    rng = random.Random(height)
    rows = [
        (rng.choice([None, *range(-45, 60)]), rng.choice([None, *range(9)]), rng.choice([None, "", "u", "a"]),
         rng.choice([None, "", "x y", "z  q\x0b w", "u"]))
        for _ in range(600)
    ]
    rows += [(40, i, "u", "x" if i % 7 else "y z") for i in range(70)] + [(41, i, "u", "x" if i % 7 else "y z") for i in range(73)]
    rows += [(c, 0, "u", "same first turn") for c in range(1000, 1060)] * 2
    rows += [(200, 1, "u", "word " * 50_000)]
    frame = spark.createDataFrame([(*r, 1, "k") for r in rows], TURNS + ", depth int, name string").repartition(6)
    got = sorted((tuple(r) for r in prefix_trie.digest(frame, spark).collect()), key=repr)
    assert got == trie_by_hand(rows)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert prefix_trie.digest(spark.createDataFrame([], TURNS), spark).count() == 0
    assert prefix_trie.digest(spark.createDataFrame([(None, 1, "u", "x")], TURNS), spark).count() == 0
    loses_all = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)  # there is no conversation 0
    got = prefix_trie.digest(spark.createDataFrame([(loses_all, 1, "u", "x")], TURNS), spark).collect()
    assert [tuple(r) for r in got] == trie_by_hand([(loses_all, 1, "u", "x")])
    assert len(got) == 1 and got[0].n_leaves == 1


def test_bands_hold_fewer_ancestors_than_their_height(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "HEIGHT", 4)
    handed = []
    whole = prefix_trie.prefixes

    def watched(bands):
        out = whole(bands)
        handed.append(max((len(r.above) for r in out.select("above").collect()), default=0))
        return out

    monkeypatch.setattr(prefix_trie, "prefixes", watched)
    rows = [(c, i, "u", f"t{i}") for c in (20, 21) for i in range(100)]
    got = prefix_trie.digest(spark.createDataFrame(rows, TURNS), spark).collect()
    assert sorted((tuple(r) for r in got), key=repr) == trie_by_hand(rows)
    assert len(handed) == 4 and max(handed) < 4  # 100 turns, 25 bands, 6 bands of bands, 1 of those
