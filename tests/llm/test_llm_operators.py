"""The dealt operators on small inputs with odd rows, against brute force."""

import base64
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wrenchline.llm import byte_bpe, chat, decontamination, line_dedup, near, ngram_join, pii, quality, substring_dedup, topk, warc
from wrenchline.llm.common import Stages
from wrenchline.llm.queries import vocabulary

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, *rows):
    """Documents from (doc_id, text)."""
    return spark.createDataFrame([(i, t, "en", None, None if t is None else len(t)) for i, t in rows], DOCS)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


# -- personal data


def base_spans(text):
    kinds = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    out = []
    for kind, pattern in kinds.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            fine = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                "card": 14 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if fine:
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], pii.BASE.index(s[0])))


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    for _ in range(20_000):
        alphabet = rng.choice(["ab@.-+ 1", "0123456789 -.", "+0123456789 ().-", "a1@.b", "@.a-é1"])
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        assert [s for s in pii.spans(text) if s[0] in pii.BASE] == base_spans(text), text


def test_added_spans_and_mask():
    text = 'see https://a.example/x?y=1. token = "0123456789abcdef0123" iban DE89 3704 0044 0532 0130 00, account no: 12345678'
    assert [k for k, _, _ in pii.spans(text)] == ["url", "secret", "iban", "account"]
    assert pii.mask("to a.b@c.de!") == "to [email]!" and pii.mask(None) is None


def test_pii_digest_of_odd_rows(spark):
    rows = pii.digest(documents(spark, (1, None), (1, ""), (None, "a@b.c"), (2, "9" * 50_000))).collect()
    assert sorted((r.n_email, r.n_card, r.spans) for r in rows) == [(0, 0, ""), (0, 0, ""), (0, 0, ""), (1, 0, "email:0:5")]
    assert pii.digest(documents(spark)).count() == 0


# -- byte BPE


def test_bpe_equals_the_library():
    import tiktoken

    path, pattern = vocabulary()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    own = byte_bpe.codec(path, pattern)
    rng = random.Random(5)
    texts = ["", " ", "\n\n a  b\t", "don't  x", "<|endoftext|>", "ab" * 9000, " lead", "trail ", "a\x1cb \x85 c"]
    texts += ["".join(chr(rng.choice([rng.randint(0, 0x2FF), rng.randint(0x2000, 0x30FF), rng.randint(0x1F300, 0x1FFFF), 32, 10, 97])) for _ in range(60)) for _ in range(500)]
    for text in texts:
        ids = own.encode(text)
        assert ids == library.encode_ordinary(text), text
        assert own.decode(ids) == text.encode()


def test_bpe_rows(spark):
    found = byte_bpe.encode_documents(documents(spark, (1, None), (1, "a b"), (None, "é")), *vocabulary())
    assert sorted(bytes(r.decoded) for r in found.collect()) == [b"", b"a b", "é".encode()]


# -- line dedup


def test_line_dedup_odd_rows(spark):
    line = "A shared line of some length"
    docs = documents(
        spark, (1, f"{line}\nown one"), (2, f"  {line.upper()}\t\nx\n{line}"), (3, f"y\n{line}\n{line}"), (4, None), (None, line), (5, ""), (6, "short\nshort")
    )
    found = {(r.doc_id, r.n_lines, r.n_dropped) for r in line_dedup.digest(docs).collect()}
    assert found == {(1, 2, 1), (2, 3, 2), (3, 3, 0), (4, 1, 0), (None, 1, 1), (5, 1, 0), (6, 2, 0)}
    kept = {r.doc_id: r.text for r in line_dedup.deduplicated(docs.withColumn("_id", docs.doc_id)).collect()}
    assert kept == {1: "own one", 2: "x", 3: f"y\n{line}\n{line}", 4: None, None: "", 5: "", 6: "short\nshort"}
    assert line_dedup.digest(documents(spark)).count() == 0


# -- similarity


def test_ngram_join_against_all_pairs(spark):
    rng = random.Random(9)
    rows = []
    for group in range(12):
        base = words(rng, rng.choice([3, 30, 200])).split()
        for _ in range(rng.randint(1, 8)):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                text[rng.randrange(len(text))] = words(rng, 1)
            rows.append((len(rows), " ".join(text)))
    rows += [(1000, None), (1001, ""), (1002, "..."), (None, rows[0][1]), (0, rows[0][1])]
    texts = [t for _, t in rows]
    sets = [set(near.shingle_set(t).tolist()) for t in texts]
    links = [[j for j in range(len(rows)) if j != i and sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(len(rows))]
    got = ngram_join.digest(documents(spark, *rows), spark).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_links) for r in got) == sorted((i is None, i or 0, len(x)) for (i, _), x in zip(rows, links, strict=True))
    kept = ngram_join.one_per_group(documents(spark, *rows), spark)
    assert kept.columns == documents(spark).columns
    assert kept.where("doc_id = 0").count() == 1 and kept.where("doc_id >= 1000").count() == 3
    assert kept.where("text IS NOT NULL").select("doc_id").distinct().count() == kept.where("text IS NOT NULL").count()
    assert ngram_join.digest(documents(spark), spark).count() == 0


def test_large_cluster_is_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK_ITEMS", 7)
    rng = random.Random(4)
    base = words(rng, 120).split()
    rows = []
    for i in range(60):
        text = list(base)
        text[rng.randrange(len(text))] = words(rng, 1)
        rows.append((i, " ".join(text)))
    got = ngram_join.digest(documents(spark, *rows), spark).collect()
    sets = [set(near.shingle_set(t).tolist()) for _, t in rows]
    want = {i: sum(5 * len(sets[i] & s) >= 4 * len(sets[i] | s) for s in sets) - 1 for i in range(60)}
    assert {r.doc_id: r.n_links for r in got} == want and {r.class_id for r in got} == {0}


def test_shared_passages_are_found_and_clean_texts_left_alone(spark):
    rng = random.Random(2)
    passage = words(rng, 60)
    rows = [(i, f"{words(rng, 90)} {passage} {words(rng, 40)}") for i in (3, 5, 9)]
    rows += [(20 + i, words(rng, 150)) for i in range(10)] + [(40, None), (41, ""), (42, "one two three")]
    found = {r.doc_id: r for r in substring_dedup.digest(documents(spark, *rows), spark).collect()}
    assert set(found) == {3, 5, 9}
    assert found[3].n_removed == 0 and found[5].keepers == [3] and found[9].removed_chars > 0.4 * len(passage)
    text = dict(rows)[5]
    kind, start, end = found[5].spans.split(",")[0].split(":")
    assert kind == "drop" and text[int(start) : int(end)] in passage
    assert substring_dedup.digest(documents(spark), spark).count() == 0


def test_paragraph_links_against_all_pairs(spark):
    rng = random.Random(12)
    rows = []
    for i in range(600):  # 8 of 10 shingles are common: a similarity of 0.8 exactly
        line = words(rng, 13).split()
        rows += [(2 * i, " ".join(line)), (2 * i + 1, " ".join([*line[1:], words(rng, 1)]))]
    sets = [set(near.shingle_set(t).tolist()) for _, t in rows]
    want = {d for i, a in enumerate(sets) for j, b in enumerate(sets) if i < j and 5 * len(a & b) >= 4 * len(a | b) for d in (i, j)}
    found = substring_dedup.repeated(documents(spark, *rows), spark)
    assert len(want) == 1200 and found.select("doc").distinct().count() >= 0.99 * len(want)


def test_passages_that_repeat_a_few_words_are_found(spark):
    rng = random.Random(13)
    rows = []
    for period in range(1, 8):
        passage = " ".join(words(rng, period).split() * (60 // period))
        rows += [(10 * period + i, f"{words(rng, 70)} {passage} {words(rng, 50)}") for i in range(2)]
    found = {r.doc_id: r for r in substring_dedup.digest(documents(spark, *rows), spark).collect()}
    assert set(found) == {d for d, _ in rows} and all((r.n_removed > 0) == (d % 10 == 1) for d, r in found.items())


# -- chat


def test_chat_links_orders_and_validates(spark):
    rows = [
        (1, 0, "assistant", '{"tool_call":{"id":"a","name":"add","arguments":{"y":"2","x":"1"}}}'),
        (1, 1, "tool", '{"tool_result":{"id":"a","content":"3"}}'),
        (1, 2, "assistant", '{"tool_call":{"id":"b","name":"add","arguments":{"x":"no"},"after":["a"]}}'),
        (1, 3, "assistant", '{"tool_call":{"id":"c","name":"add","arguments":{"x":"1"},"after":["d"]}}'),
        (1, 4, "assistant", '{"tool_call":{"id":"d","name":"add","arguments":{"x":"1"},"after":["c"]}}'),
        (1, 5, "tool", '{"tool_result":{"id":"zz","content":null}}'),
        (2, 0, "user", "hello"), (2, 1, "assistant", "{broken"), (2, 1, None, None), (None, None, "user", "x"),
    ]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    schemas = {"add": {"x": ("integer", True), "y": ("integer", False)}, **chat.REPLY}
    got = {(r.call_id, r.kind): r for r in chat.formatted(frame, spark, schemas).collect()}
    assert {k[0]: (r.level, r.status) for k, r in got.items() if k[1] == "call"} == {
        "1:#a": (0, "linked"), "1:#b": (2, "unanswered"), "1:#c": (None, "cycle"), "1:#d": (None, "cycle"), "2:0": (0, "linked")
    }
    assert got["1:#a", "result"].level == 1 and got["1:#zz", "result"].status == "orphan"
    assert got["1:#b", "call"].errors == "x: not integer" and got["1:#a", "call"].errors == ""
    assert got["1:#a", "call"].json.startswith('{"arguments":{"x":"1","y":"2"},"conv":"1","id":"1:#a","name":"add","turn":0')


# -- top-k


def test_topk_of_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(300)]
    rows += [(400 + i, rows[7][1]) for i in range(40)]
    rows += [(500, None), (550, [1.0, None]), (600, [float("nan")]), (650, [float("inf")]), (700, []), (None, [1.0]), (750, [1.0, 2.0]), (50, rows[50][1])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.digest(frame, spark).collect()}
    usable = [(i, np.floor(np.pad(np.array(v, np.float32).astype(float) * 256, (0, 8 - len(v))))) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    want = {}
    for q, x in usable:
        if q % 50 == 0:
            best = sorted((-int(x @ y), i) for i, y in usable if i != q)[:5]
            want.update({(q, n): (i, -s) for n, (s, i) in enumerate(best, 1)})
    assert got == want
    assert topk.digest(frame.limit(0), spark).count() == 0


# -- quality


def test_quality_learns_from_lines_and_scores_everything():
    rng = random.Random(6)
    def make(good):
        return "\n".join(words(rng, 12) if good else " | ".join(words(rng, 9).upper().split()) for _ in range(rng.randint(1, 5)))
    documents_ = [(make(i % 3 > 0), int(i % 3 > 0)) for i in range(300)]
    field = quality.fit([(quality.features([t])[0], y) for t, y in documents_[:200]], rounds=60)
    scores = field.scores([t for t, _ in documents_[200:]])
    assert np.mean([(s >= 0.3) == y for s, (_, y) in zip(scores, documents_[200:], strict=True)]) > 0.95
    odd = field.scores([None, "", "\n\n", "x" * 5000])
    assert np.isfinite(odd).all() and odd[0] == odd[1] and ((odd >= 0) & (odd <= 1)).all()


def test_quality_without_labels(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0)], "doc_id bigint, quality int, toxic int")
    rows = quality.digest(documents(spark, (1, "a"), (None, None)), labels).collect()
    assert [(r.score, r.predicted) for r in rows] == [(0.5, 1)] * 2


# -- decontamination


@pytest.mark.parametrize("limit", [0, 10**6])
def test_contamination_of_odd_rows(spark, limit):
    rng = random.Random(8)
    item, short = words(rng, 40), "Tiny, item"
    rows = [(1, f"{words(rng, 5)} {item.upper()} end"), (2, item.replace(" ", " - ")), (2, item), (3, "a TINY item"), (4, None), (5, "..."), (None, item[:80] + " " + words(rng, 300)), (6, words(rng, 50))]
    bench = spark.createDataFrame([(7, item), (7, item), (8, short), (9, None), (None, "")], "item_id bigint, text string")
    got = decontamination.judged(documents(spark, *rows), bench, spark, limit=limit).collect()
    seen = sorted((r.doc_id or 0, r._dc_n_hit, r._dc_items, r._dc_contaminated) for r in got)
    assert seen[1:] == [(1, 40, ["7"], True), (2, 40, ["7"], True), (2, 40, ["7"], True), (3, 2, ["8"], True), (4, 0, [], False), (5, 0, [], False), (6, 0, [], False)]
    assert decontamination.digest(documents(spark), bench, spark).count() == 0
    assert decontamination.digest(documents(spark, *rows), bench.limit(0), spark).where("contaminated").count() == 0


def test_edited_items_against_brute_force(spark):
    rng = random.Random(14)
    common = words(rng, 6).split()
    items = {i: [rng.choice(common) if rng.random() < 0.5 else words(rng, 1) for _ in range(13 + 4 * (i % 3))] for i in range(20)}
    rows = []
    for i, item in items.items():
        for edits in range(5):
            text = list(item)
            for at in rng.sample(range(len(item)), edits):
                text[at] = words(rng, 2).replace(" ", "")
            cut = text[edits % 3 :]
            rows.append((10 * i + edits, " ".join([*(rng.choice(common) for _ in range(rng.randint(0, 9))), *cut, *words(rng, rng.randint(0, 9)).split()])))
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in items.items()], "item_id bigint, text string")
    want = {}
    for doc, text in rows:
        ws, close = text.split(), set()
        for item in items.values():
            for shift in range(-len(item), len(ws)):
                for first in range(len(item) - 12):
                    equal = [p + shift for p in range(first, first + 13) if 0 <= p + shift < len(ws) and ws[p + shift] == item[p]]
                    if len(equal) >= 10:
                        close |= set(range(equal[0], equal[-1] + 1))
        want[doc] = len(close)
    got = {r.doc_id: r.n_near for r in decontamination.digest_with_near(documents(spark, *rows), bench, spark).collect()}
    assert got == want and sum(n > 0 for n in want.values()) > 50


# -- WARC


def test_audit_finds_changed_lost_and_added_records(spark):
    rows = [(i, f"http://h/{i}", "b" * i) for i in range(400)] + [(None, None, None), (5, "http://h/5", "b" * 5)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    stages = Stages(spark)
    index = stages.save(warc.manifest(warc.written(pages), 3), "index")
    mine = warc.tree(index, stages, "a")
    same, compared = warc.audit(mine, warc.tree(index, stages, "b"), stages)
    assert same.count() == 0 and compared == 2
    changed = index.withColumn("digest", F.expr("if(position = 17, 'x', digest)"))
    found, compared = warc.audit(mine, warc.tree(changed, stages, "c"), stages)
    assert {(r.segment, r.node) for r in found.collect()} == {(0, 17), (1, 17), (2, 17)} and compared < 300
    lost, _ = warc.audit(mine, warc.tree(index.where("position < 120"), stages, "d"), stages)
    assert lost.count() == index.where("position >= 120").count()
    assert warc.drill(pages.limit(0), spark).count() == 0
    assert warc.drill(pages, spark).where("copies = 2").count() == 1
