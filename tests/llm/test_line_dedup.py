"""The dealt method in the physical plan, and odd tables."""

import random

from wrenchline.llm import decontamination, line_dedup

DOCS = "doc_id bigint, text string"


def expected(rows):
    """doc_id, kept text and kept runs of every row, by brute force."""
    blanks = " \t\n\x0b\x0c\r"
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(blanks))
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        gone = [len(holders.get(key(x), ())) >= 3 and max(holders[key(x)]) != doc for x in lines]
        kept = [i for i, g in enumerate(gone) if not g]
        runs = [[i] for i in kept if i - 1 not in kept]
        runs = [f"{r[0]}:{next(n for n in range(1, len(lines) + 1) if r[0] + n not in kept)}" for r in runs]
        out.append((doc, "\n".join(lines[i] for i in kept), ",".join(runs)))
    return out


def test_kept_lines_and_runs_against_brute_force(spark):
    rng = random.Random(17)
    pool = [f"shared line number {i} of the pool" for i in range(30)] + ["short", "", "\tA Line That Is Long Enough \r"]
    rows = []
    for doc in range(60):
        lines = [rng.choice(pool) if rng.random() < 0.6 else f"own line {rng.random()} of a document" for _ in range(rng.randint(0, 12))]
        rows.append((doc, "\n".join(x.upper() if rng.random() < 0.2 else x for x in lines)))
    frame = spark.createDataFrame(rows, DOCS).repartition(5)
    found = line_dedup.kept_documents(frame)
    got = {r.doc_id: (r._ld_kept, ",".join(f"{x.start}:{x.length}" for x in r._ld_keep_runs)) for r in found.collect()}
    assert got == {doc: (kept, runs) for doc, kept, runs in expected(rows)}
    assert {r.doc_id: r.keep_runs for r in line_dedup.digest(frame).collect()} == {doc: runs for doc, _, runs in expected(rows)}


def test_ranges_are_sorted_and_streamed_without_a_further_exchange(spark):
    hashes = line_dedup.line_hashes(spark.range(1000).selectExpr("id AS doc_id", "'a line of more than twenty signs' AS text"), 20)
    plan = line_dedup.first_occurrences(hashes)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning(_ld_h1" in plan
    assert plan.index("Window") < plan.index("Sort [_ld_h1") < plan.index("Exchange")


def test_a_very_long_text_and_a_line_of_all_documents(spark):
    line = "this line is in every document of the table"
    rows = [(i, f"{line}\nown line {i} of document {i}") for i in range(500)] + [(500, "\n".join([line] * 200_000)), (501, "x" * 3_000_000), (502, None)]
    found = {r.doc_id: r for r in line_dedup.digest(spark.createDataFrame(rows, DOCS).repartition(8)).collect()}
    assert (found[500].n_lines, found[500].n_dropped, found[500].keep_runs) == (200_000, 0, "0:200000")
    assert all(found[i].n_dropped == 1 and found[i].keep_runs == "1:1" for i in range(500))
    assert found[501].n_dropped == found[502].n_dropped == 0 and found[502].keep_runs == "0:1"


def test_words_of_a_very_long_text(spark):
    item = " ".join(f"item{i}" for i in range(20))
    docs = spark.createDataFrame([(1, "word " * 300_000 + item), (2, item)], DOCS)
    bench = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    found = {r.doc_id: r for r in decontamination.digest(docs, bench, spark).collect()}
    assert (found[1].n_words, found[1].n_hit, found[1].contaminated) == (300_020, 20, False)
    assert found[2].contaminated
