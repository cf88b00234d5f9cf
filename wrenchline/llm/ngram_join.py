"""N-gram Jaccard join by a MinHash LSH forest.

A document is its set of five-word shingles (words: runs of digits, lower-cased
letters and characters beyond ASCII; a text of fewer words is one shingle). Documents
with equal sets are one class. A class has a label in each tree: a sequence of
min-hashes. Sorted labels are a prefix trie; a link is proposed where labels agree on a
prefix. The prefix starts at its full length and is shortened until the chance to miss a
pair at the similarity threshold falls below the target, over all trees. Proposed links
are only a way to gather clusters: all pairs of a cluster are verified exactly.

Result: one row per document: ``class_id``, the smallest doc_id that is connected by
links (null if no connected document has an id), and ``n_links``, the number of other
documents at or above the threshold. Rows that repeat a document are linked documents of
their own. Texts without words have no links and are classes of themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wrenchline.llm import near
from wrenchline.llm.common import NO_ID, Stages, id_key, maybe_in

TREES = 24
DEPTH = 8
RECALL = 0.999

_RNG = np.random.default_rng(77)
_XOR = _RNG.integers(0, 2**32, TREES * DEPTH, dtype=np.uint32)
_MULTIPLY = _RNG.integers(0, 2**32, TREES * DEPTH, dtype=np.uint32) | np.uint32(1)


def prefix_length(similarity: float = near.SIMILARITY[0] / near.SIMILARITY[1], recall: float = RECALL) -> int:
    """The longest prefix, shortened from the full depth, that finds a pair with the target probability."""
    depth = DEPTH
    while depth > 1 and 1 - (1 - similarity**depth) ** TREES < recall:
        depth -= 1
    return depth


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Min-hashes of non-empty sets: one row each."""
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    values = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(sets), TREES * DEPTH), np.uint32)
    for i in range(TREES * DEPTH):
        out[:, i] = np.minimum.reduceat((values ^ _XOR[i]) * _MULTIPLY[i], starts)
    return out


def labels(signature: np.ndarray) -> list[bytes]:
    """The label of each tree: its number and the low halves of its min-hashes."""
    halves = (signature & np.uint32(0xFFFF)).astype(">u2").reshape(TREES, DEPTH)
    return [bytes([t]) + halves[t].tobytes() for t in range(TREES)]


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, text key -> id, number of shingles, labels; without words all three are null."""
    for whole in batches:
        for first in range(0, whole.num_rows, 256):
            batch = whole.slice(first, 256)
            sets = [near.shingle_set(t) for t in batch.column("text").to_pylist()]
            some = [s for s in sets if s.size]
            rows = iter(signatures(some)) if some else iter(())
            found = [labels(next(rows)) if s.size else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("doc"), batch.column("text_key"),
                    pa.array([near.identity(s) if s.size else None for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(found, pa.list_(pa.binary())),
                ],
                names=["doc_id", "doc", "text_key", "id", "n_shingles", "labels"],
            )


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for first in range(0, whole.num_rows, 256):
            batch = whole.slice(first, 256)
            sets = [near.shingle_set(t).tobytes() for t in batch.column("text").to_pylist()]
            keep = [batch.column(n) for n in ("root", "n_blocks", "block", "id", "copies")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(sets, pa.binary())], names=["root", "n_blocks", "block", "id", "copies", "shingles"])


def join(docs: DataFrame, spark: SparkSession) -> DataFrame:
    """Rows doc_id, doc, text_key, id, group_id, n_links: ``group_id`` names the connected group (null without words)."""
    stages = Stages(spark)
    keyed = docs.select("doc_id", "text", id_key().alias("doc"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    described = stages.save(
        keyed.mapInArrow(_describe, f"doc_id {kind}, doc bigint, text_key bigint, id binary, n_shingles bigint, labels array<binary>"), "described"
    )
    # Copies are summed per task before the shuffle; one of them stands for the class.
    classes = stages.save(
        described.where("id IS NOT NULL").groupBy("id").agg(
            F.count("*").alias("copies"), F.min(F.struct("doc", "text_key")).alias("one"), F.min("n_shingles").alias("n_shingles"), F.min("labels").alias("labels")
        ),
        "classes",
    )
    proposed = near.linked_labels(
        classes.select(F.explode("labels").alias("label"), "id"), 1 + 2 * prefix_length(), stages
    )
    roots = near.components(proposed, stages)
    places = near.blocked(classes, roots).join(classes.select("id", "copies", "one"), "id")
    wanted = places.select("root", "n_blocks", "block", "id", "copies", F.col("one.doc").alias("doc"), F.col("one.text_key").alias("text_key"))
    # Few documents have a candidate; the texts of the others stay where they are.
    wanted = stages.save(wanted, "wanted")
    texts = maybe_in(keyed.select("doc", "text_key", "text"), wanted, ["doc", "text_key"]).join(wanted, ["doc", "text_key"])
    rows = texts.select("root", "n_blocks", "block", "id", "copies", "text").mapInArrow(
        _shingles, "root binary, n_blocks int, block int, id binary, copies bigint, shingles binary"
    )
    links, edges = near.verified(rows, stages)
    groups = near.components(edges, stages)
    per_class = (
        classes.select("id", "copies").join(links, "id", "left").join(groups.withColumnRenamed("root", "linked"), "id", "left")
        .select("id", F.coalesce("linked", "id").alias("group_id"), (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    per_class = stages.save(per_class, "class-links")
    return described.select("doc_id", "doc", "text_key", "id").join(per_class, "id", "left")


def digest(docs: DataFrame, spark: SparkSession) -> DataFrame:
    """doc_id, class_id, n_links."""
    rows = join(docs, spark)
    names = rows.where("group_id IS NOT NULL").groupBy("group_id").agg(F.min("doc_id").alias("class_id"))
    return rows.join(names, "group_id", "left").select(
        "doc_id",
        F.when(F.col("group_id").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
    )


def one_per_group(docs: DataFrame, spark: SparkSession) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest doc_id, then of the smallest text hash.

    Repeated rows of that document are reduced to one. Rows without words all stay.
    """
    columns = docs.columns
    rows = join(docs, spark)
    # A row without an id comes last, so a group keeps one that can be named.
    order = F.struct((F.col("doc") == F.lit(NO_ID)).alias("_nj_none"), F.col("doc").alias("_nj_doc"), F.col("text_key").alias("_nj_key"))
    grouped = rows.where("group_id IS NOT NULL").groupBy("group_id", "doc", "text_key").agg(F.count("*").alias("n"))
    winners = grouped.groupBy("group_id").agg(F.min(F.struct(order.alias("at"), F.col("n"))).alias("w"))
    chosen = winners.select(F.col("w.at._nj_doc").alias("_nj_doc"), F.col("w.at._nj_key").alias("_nj_key"), F.col("w.n").alias("_nj_n"))
    alone = rows.where("group_id IS NULL").select(F.col("doc").alias("_nj_doc"), F.col("text_key").alias("_nj_key")).distinct()
    stay = Stages(spark).save(chosen.unionByName(alone.withColumn("_nj_n", F.lit(1).cast("bigint"))), "stay")
    keyed = docs.withColumns({"_nj_doc": id_key(), "_nj_key": F.xxhash64(F.coalesce("text", F.lit("")))})
    kept = keyed.join(stay, ["_nj_doc", "_nj_key"])
    if stay.where("_nj_n > 1").head(1):  # the chosen document itself is repeated: one of its rows stays
        row = F.when(F.col("_nj_n") > 1, F.lit(-1)).otherwise(F.monotonically_increasing_id())
        kept = kept.withColumn("_nj_row", row).dropDuplicates(["_nj_doc", "_nj_key", "_nj_row"])
    return kept.select(*columns)
