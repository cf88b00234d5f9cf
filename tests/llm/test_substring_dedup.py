"""Planted passages, with and without edits, and odd rows."""

import random

import numpy as np

from wrenchline.llm import near, substring_dedup


def words(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def table_of(text):
    return near.word_table(text.encode())[0]


def test_equal_paragraphs_share_a_label():
    rng = random.Random(21)
    size = substring_dedup.paragraph_words()
    for _ in range(300):
        shared = words(rng, size)
        found = [
            set(substring_dedup.places(table_of(" ".join(words(rng, rng.randint(0, 60)) + shared + words(rng, rng.randint(0, 60)))), size)[0].tolist())
            for _ in range(2)
        ]
        assert found[0] & found[1]


def test_places_are_the_least_of_some_paragraph():
    rng = random.Random(22)
    size = substring_dedup.paragraph_words()
    width = size - substring_dedup.LABEL_WORDS + 1
    for text in (words(rng, 200), words(rng, 3) * 50, words(rng, 26)):
        raw = table_of(" ".join(text))
        ranks = near.mixed(near.shingles_of(raw)[: raw.size - substring_dedup.LABEL_WORDS + 1] ^ substring_dedup._LABEL_MIX[0])
        want = {i for a in range(ranks.size - width + 1) for i in range(a, a + width) if ranks[i] == ranks[a : a + width].min()}
        assert set(np.asarray(substring_dedup.places(raw, size)[1]).tolist()) == want


def test_planted_passages_are_covered_and_nothing_else(spark):
    rng = random.Random(23)
    rows, planted = [], {}
    for kind, (n, edits) in enumerate([(51, 0), (51, 1), (60, 1), (100, 0), (100, 2), (200, 4)]):
        for i in range(40):
            passage = words(rng, n)
            other = list(passage)
            for at in rng.sample(range(n), edits):
                other[at] = "zz" + words(rng, 1)[0]
            before, doc = words(rng, 70), (kind * 40 + i) * 2
            rows += [(doc, " ".join(words(rng, 80) + passage + words(rng, 50))), (doc + 1, " ".join(before + other + words(rng, 60)))]
            start = len(" ".join(before)) + 1
            planted[doc + 1] = (edits, start, start + len(" ".join(other)))
    rows += [(10_000 + i, " ".join(words(rng, 150))) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in substring_dedup.digest(docs, spark).collect()}
    assert max(got) < 10_000
    for doc, (edits, start, end) in planted.items():
        spans = [tuple(map(int, s.split(":")[1:])) for s in got[doc].spans.split(",") if s.startswith("drop")]
        assert all(start <= a < b <= end for a, b in spans)
        share = sum(b - a for a, b in spans) / (end - start)
        assert share == 1 if not edits else share > 0.75
        assert got[doc].keepers == [doc - 1] and got[doc - 1].n_removed == 0


def test_odd_rows(spark):
    rng = random.Random(24)
    passage, long = " ".join(words(rng, 60)), " ".join(words(rng, 30_000))
    rows = [
        (1, f"{' '.join(words(rng, 30))} {passage}", "a", 1), (2, passage, "b", 2), (2, passage, "c", 3),
        (2, " ".join(words(rng, 80)), "d", 4), (None, passage, "e", 5), (3, long, "f", 6), (4, long.upper(), "g", 7),
        (5, None, "h", 8), (6, "", "i", 9), (7, None, "j", 0), (8, "", "k", 0),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, label string, partner int")
    got = {r.doc_id: r for r in substring_dedup.digest(docs, spark).collect()}
    assert set(got) == {None, 1, 2, 3, 4}
    assert got[None].n_removed == 0 and got[1].n_removed == 1 and got[1].keepers == []
    assert got[2].removed_chars == len(passage) and got[2].spans == f"drop:0:{len(passage)}"
    assert got[4].removed_chars == len(long) and got[4].keepers == [3] and got[3].spans == f"keep:0:{len(long)}"
    assert substring_dedup.digest(docs.limit(0), spark).count() == 0


def test_a_smaller_document_with_the_labels_hides_no_link(spark):
    rng = random.Random(25)
    passage, other = words(rng, 60), words(rng, 60)
    size = substring_dedup.LABEL_WORDS
    rows = [(i, " ".join(passage[i : i + size])) for i in range(60 - size + 1)]
    rows += [(100 + i, " ".join(words(rng, 40) + passage + words(rng, 40))) for i in range(3)]
    # Pieces of the passage come before it in the smallest document.
    pieces = [w for i in range(60 - size + 1) for w in other[i : i + size] + words(rng, 20)]
    rows += [(200, " ".join(pieces + other + words(rng, 30))), (201, " ".join(words(rng, 40) + other))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in substring_dedup.digest(docs, spark).collect()}
    assert set(got) == {100, 101, 102, 200, 201}
    assert [got[d].keepers for d in (100, 101, 102, 200, 201)] == [[], [100], [100], [], [200]]
    assert got[101].removed_chars == got[102].removed_chars == len(" ".join(passage))
    assert got[201].removed_chars == len(" ".join(other))


def test_anchors_of_a_batch_of_many_rows():
    import pyarrow as pa

    rng = random.Random(26)
    texts = [" ".join(words(rng, rng.choice((0, 5, 12, 24, 25, 26, 80)))) for _ in range(600)]
    batch = pa.RecordBatch.from_pydict({"doc": list(range(600)), "part": [0] * 600, "text": texts})
    got = pa.Table.from_batches(substring_dedup._anchors(iter([batch]), substring_dedup.paragraph_words())).to_pylist()
    number = {}
    for r in got:
        number[r["doc"]] = number.get(r["doc"], 0) + len(r["paragraphs"])
    assert all(number.get(i, 0) == max(0, len(t.split()) - 24) for i, t in enumerate(texts))  # each paragraph has one least place


def test_places_of_several_texts_at_once():
    rng = random.Random(27)
    size = substring_dedup.paragraph_words()
    tables = [table_of(" ".join(words(rng, n))) for n in (0, 3, 11, 12, 24, 25, 26, 200, 0, 90, 13)] + [table_of("a b c " * 40)]
    label, at, number, inner = substring_dedup.places(np.concatenate(tables), size, np.array([t.size for t in tables]))
    alone = [substring_dedup.places(t, size) for t in tables]
    shift = np.cumsum([0] + [t.size for t in tables[:-1]])
    assert label.tolist() == [x for a in alone for x in a[0].tolist()]
    assert at.tolist() == [x + s for a, s in zip(alone, shift.tolist(), strict=True) for x in a[1].tolist()]
    assert number.tolist() == [x for a in alone for x in a[2].tolist()]
    assert inner.tolist() == [x for a in alone for x in a[3].tolist()]


def test_matched_by_brute_force():
    def same(own, theirs):
        at = [i for i, x in enumerate(theirs) if x in set(own)]
        a, b = set(own), set(theirs[at[0] : at[-1] + 1])
        return len(a & b) * near.SIMILARITY[1] >= len(a | b) * near.SIMILARITY[0]

    rng = random.Random(28)
    parted = 0
    for _ in range(600):
        kinds = rng.choice((3, 400))
        line = [rng.randrange(kinds) for _ in range(rng.randint(5, 200))]
        edited = [np.array([rng.randrange(500, 900) if rng.random() < 0.015 else x for x in line], np.uint64) for _ in range(2)]
        mine, theirs = (near.shingles_of(x).tolist() for x in edited)
        at = [i for i in range(len(mine)) if rng.random() < 0.97]
        want = []
        for i in at:
            if mine[i] in theirs:
                if want and i - want[-1][-1] <= near.SHINGLE:
                    want[-1].append(i)
                else:
                    want.append([i])
        runs = []
        for run in want:
            if runs and run[0] - runs[-1][1] <= substring_dedup.EDIT_WORDS and same(mine[runs[-1][0] : run[-1] + 1], theirs):
                runs[-1][1] = run[-1] + near.SHINGLE
                parted += 1
            else:
                runs.append([run[0], run[-1] + near.SHINGLE])
        got = substring_dedup.matched(np.array(mine, np.uint64), np.array(at, np.int64), np.array(theirs, np.uint64), 7)
        assert got == [r for r in runs if r[1] - r[0] >= 7]
    assert parted > 50


def test_links_by_paragraph_and_only_those_the_label_does_not_give(spark, monkeypatch):
    from pyspark.sql import functions as F

    rng = random.Random(29)
    passage, other = words(rng, 60), words(rng, 60)
    plain = [(i, 0, " ".join(words(rng, 40) + passage + words(rng, 40))) for i in range(12)]
    pieces = [(-20 + i, 0, " ".join(words(rng, 30) + other[3 * i : 3 * i + 20] + words(rng, 30))) for i in range(14)]
    hidden = [(100 + i, i % 2, " ".join(words(rng, 30) + other + words(rng, 9) + other[:40])) for i in range(5)]
    counts = {}
    save = substring_dedup.Stages.save

    def saved(self, df, name):
        out = save(self, df, name)
        counts[name] = out.count()
        return out

    monkeypatch.setattr(substring_dedup.Stages, "save", saved)
    for rows, some in ((plain, False), (plain + pieces + hidden, True)):
        source = spark.createDataFrame(rows, "doc bigint, part bigint, text string")
        got = substring_dedup.stretches(source, substring_dedup.Stages(spark))
        size = substring_dedup.paragraph_words()
        schema = "label bigint, doc bigint, part bigint, pos int, paragraphs array<int>"
        anchors = source.mapInArrow(lambda b: substring_dedup._anchors(b, size), schema).withColumn("around", F.xxhash64("paragraphs")).collect()
        groups, around = {}, {}
        for r in anchors:
            around.setdefault(r.label, set()).add(r.around)
        for r in anchors:
            for key in [(r.label,), *((r.label, p) for p in r.paragraphs if len(around[r.label]) > 1)]:
                groups.setdefault(key, []).append((r.doc, r.part, r.pos))
        want = {}
        for found in groups.values():
            low, high = min(found), min(found, key=lambda f: (-f[0], f[1:]))
            for doc, part, pos in found if low[0] < high[0] else []:
                partner = high if doc == low[0] else low
                want.setdefault((doc, part, partner[0], partner[1], partner[2] - pos), []).append(pos)
        assert {(r.doc, r.part, r.partner, r.partner_part, r["shift"]): (r["first"], r["last"]) for r in got.collect()} == {k: (min(v), max(v)) for k, v in want.items()}
        # All copies of the plain passage are linked by its labels.
        assert (counts["paragraphs"] > 0) == some
