"""WARC records and their fixity audit by Merkle trees.

Pages become WARC response records, byte for byte determined by the row. Records are
dealt over segments (files) by their digest and lie in a segment in the order of page
id and digest, each copy of a repeated row after the other; offsets are running lengths.

A replica is audited without reading the archive's bytes again: records are hashed, and
ordered ranges of offsets are hashed into trees of ``FANOUT`` children a node, per
segment and then over the segments. Equal roots end the audit. Otherwise the levels are
walked down and only children of nodes that differ are looked at, to the records.

Rows: null urls and bodies are empty; a null page id comes first. Records that a replica
lost, added or changed are all differences.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wrenchline.llm.common import Stages, id_key

FANOUT = 16
#: Records that a segment holds on average.
SEGMENT_RECORDS = 1024


def record(page_id: Column, url: Column, body: Column) -> Column:
    """The bytes of a WARC response record."""
    content = F.coalesce(body, F.lit("")).cast("binary")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(content).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head.cast("binary"), content, F.lit("\r\n\r\n").cast("binary"))


def written(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, order key and the record."""
    return pages.select("page_id", id_key("page_id").alias("page"), record(F.col("page_id"), F.col("url"), F.col("html")).alias("record"))


def hashed(records: DataFrame) -> DataFrame:
    """One row per distinct record: page, digest, length, copies."""
    found = records.select("page", F.sha2("record", 256).alias("digest"), F.octet_length("record").cast("bigint").alias("length"))
    return found.groupBy("page", "digest", "length").agg(F.count("*").alias("copies"))


def manifest(records: DataFrame, segments: int) -> DataFrame:
    """Hashed records in their places: segment, position, first offset; the archive's index.

    A segment is chosen by the digest, so none holds more than its share, whatever
    ids repeat; copies of a row are one entry.
    """
    number = F.conv(F.substring("digest", 1, 8), 16, 10).cast("bigint")
    placed = hashed(records).withColumn("segment", (number % segments).cast("int"))
    order = Window.partitionBy("segment").orderBy("page", "digest")
    return placed.withColumns(
        {
            "position": (F.row_number().over(order) - 1).cast("bigint"),
            "offset": (F.sum(F.col("length") * F.col("copies")).over(order) - F.col("length") * F.col("copies")).cast("bigint"),
        }
    )


def _joined(children: Column) -> Column:
    """Hash over the ordered children's hashes and ranges."""
    return F.sha2(F.array_join(F.transform(F.array_sort(children), lambda c: F.concat_ws(":", c["node"], c["first"], c["last"], c["hash"])), ","), 256)


def _level(nodes: DataFrame, level: int) -> DataFrame:
    """The next level: FANOUT neighbours each."""
    part = F.struct("node", "first", "last", "hash")
    up = nodes.groupBy("segment", F.expr(f"node div {FANOUT}").alias("up")).agg(
        F.min("first").alias("low"), F.max("last").alias("high"), F.collect_list(part).alias("children")
    )
    return up.select("segment", F.lit(level).alias("level"), F.col("up").alias("node"), F.col("low").alias("first"), F.col("high").alias("last"), _joined(F.col("children")).alias("hash"))


@dataclass
class Tree:
    """Levels of nodes, leaves first: segment, level, node, first and last offset, hash.

    The roots of the segments are the children of one more tree, whose nodes carry
    segment -1: ``join`` is its lowest level, where a node's number is a segment's.
    """

    levels: list[DataFrame]
    join: int


def tree(index: DataFrame, stages: Stages, name: str) -> Tree:
    """The tree over an index; a node has at most FANOUT children."""
    leaf = index.select(
        "segment", F.lit(0).alias("level"), F.col("position").alias("node"), F.col("offset").alias("first"),
        (F.col("offset") + F.col("length") * F.col("copies")).alias("last"),
        F.sha2(F.concat_ws(":", "digest", "length", "copies"), 256).alias("hash"),
    )
    levels = [stages.save(leaf, f"{name}-0")]
    while levels[-1].where("node > 0").head(1):
        levels.append(stages.save(_level(levels[-1], len(levels)), f"{name}-{len(levels)}"))
    join = len(levels)
    roots = levels[-1].select(F.lit(-1).alias("segment"), F.lit(join).alias("level"), F.col("segment").cast("bigint").alias("node"), "first", "last", "hash")
    levels.append(stages.save(roots, f"{name}-segments"))
    while levels[-1].where("node > 0").head(1):
        levels.append(stages.save(_level(levels[-1], len(levels)), f"{name}-{len(levels)}"))
    return Tree(levels, join)


def _differing(mine: DataFrame, theirs: DataFrame) -> DataFrame:
    keys = ["segment", "node"]
    both = mine.select(*keys, F.col("hash").alias("mine"), "first", "last").join(
        theirs.select(*keys, F.col("hash").alias("theirs"), F.col("first").alias("first2"), F.col("last").alias("last2")), keys, "full_outer"
    )
    return both.where("NOT (mine <=> theirs)").select(*keys, F.coalesce("first", "first2").alias("first"), F.coalesce("last", "last2").alias("last"))


def audit(mine: Tree, theirs: Tree, stages: Stages) -> tuple[DataFrame, int]:
    """(differing leaves: segment, node, first, last; number of nodes that were compared).

    Trees of other heights have nothing in common above the leaves, which are compared then.
    """
    same = len(mine.levels) == len(theirs.levels) and mine.join == theirs.join
    level = len(mine.levels) - 1 if same else 0
    a, b = mine.levels[level], theirs.levels[level]
    compared = 0
    while True:
        compared += a.count() + b.count()
        found = stages.save(_differing(a, b), f"differing-{level}")
        if level == 0:
            return found, compared
        if not found.head(1):
            return found.limit(0), compared
        if level == mine.join:
            wanted = found.select(F.col("node").cast("int").alias("segment"), F.lit(0).cast("bigint").alias("up"))
            parent = F.col("node")
        else:
            wanted = found.select("segment", F.col("node").alias("up"))
            parent = F.expr(f"node div {FANOUT}")
        level -= 1
        a, b = (
            t.levels[level].withColumn("up", parent).join(wanted, ["segment", "up"], "left_semi").drop("up") for t in (mine, theirs)
        )


def damaged_copy(records: DataFrame) -> DataFrame:
    """A replica for a drill: records whose digest begins with 00 have their last byte changed."""
    hit = F.substring(F.sha2("record", 256), 1, 2) == "00"
    size = F.octet_length("record")
    changed = F.concat(F.expr("substring(record, 1, octet_length(record) - 1)"), F.lit(b"\x00"))
    return records.withColumn("record", F.when(hit & (size > 0), changed).otherwise(F.col("record")))


def segments_for(records: DataFrame) -> int:
    return max(1, -(-records.count() // SEGMENT_RECORDS))


def drill(pages: DataFrame, spark: SparkSession) -> DataFrame:
    """Archives the pages, damages a replica, and audits it.

    One row per distinct record: page_id, segment, offset, length, copies, record_sha256,
    intact. The replica's records keep their places, as files do whose bytes rot.
    """
    stages = Stages(spark)
    records = written(pages)
    index = stages.save(manifest(records, segments_for(pages)), "index")
    # A replica is read at the places that the archive's index names, and hashed anew.
    replica = damaged_copy(records.withColumn("digest", F.sha2("record", 256))).select(
        "page", "digest", F.sha2("record", 256).alias("found"), F.octet_length("record").cast("bigint").alias("found_length")
    ).distinct()
    there = index.join(replica, ["page", "digest"]).select("segment", "position", "offset", "copies", F.col("found").alias("digest"), F.col("found_length").alias("length"))
    found, _ = audit(tree(index, stages, "archive"), tree(there, stages, "replica"), stages)
    wrong = found.select("segment", F.col("node").alias("position"), F.lit(False).alias("intact"))
    return index.join(wrong, ["segment", "position"], "left").select(
        F.when(F.col("page") != F.lit(-(2**63)), F.col("page")).alias("page_id"),
        "segment", "position", "offset", "length", "copies", F.col("digest").alias("record_sha256"),
        F.coalesce("intact", F.lit(True)).alias("intact"),
    )


ORACLE = r"""
WITH r AS (
  SELECT page_id, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) ||
         'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, '') || '>' || chr(13) || chr(10) ||
         'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) ||
         'Content-Length: ' || octet_length(encode(coalesce(html, '')))::VARCHAR || chr(13) || chr(10) || chr(13) || chr(10) ||
         coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM pages
), h AS (
  SELECT page_id, sha256(record) AS d, octet_length(encode(record)) AS length, count(*) AS copies FROM r GROUP BY ALL
), p AS (
  SELECT *, ((('0x' || substr(d, 1, 8))::BIGINT) % greatest(1, (SELECT (count(*) + 1023) // 1024 FROM pages)))::INTEGER AS segment FROM h
)
SELECT page_id, segment, row_number() OVER w - 1 AS position,
       (sum(length * copies) OVER w - length * copies)::BIGINT AS "offset",
       length, copies, d AS record_sha256, substr(d, 1, 2) <> '00' AS intact
FROM p WINDOW w AS (PARTITION BY segment ORDER BY page_id NULLS FIRST, d)
"""
