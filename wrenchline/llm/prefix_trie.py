"""Prefix trie of conversations, with totals over subtrees by bands of fixed height.

A node is a distinct sequence of first turns; it is named by a digest of that
sequence. Two things would be sequential along a conversation, and conversations
may be long: naming prefixes and adding up subtrees. Both go by bands of
``HEIGHT`` turns.

* Names: inside a band the name of a prefix is the digest of the name before it
  and the turn. Names at the borders of bands come from the conversation of whole
  bands, by the same rule, where a whole band is one turn. So a conversation of n
  turns takes log(n) rounds and no group holds more than ``HEIGHT`` rows.
* Totals: every node hands its value to its ancestors inside its band only, fewer
  than ``HEIGHT``. What is below a band's border is first added up at the border
  node; border nodes form a trie of their own, whose totals come by the same rule,
  and are then handed to the ancestors in the band above.

Turns are numbered by a range partition over (conversation, turn), so that one
conversation may spread over many tasks; parents with very many children go to
them by broadcast (at most a thousand such parents), the others by a shuffle.

Rows: null roles and texts are empty. Turns go by number, null first; rows of one
turn by role and then by the digest of the turn, so repeated rows are turns of
their own. Rows without ``conv_id`` belong to no conversation and are left out.
Empty tables have no node. Only the four named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wrenchline.llm.common import Stages

#: Turns of a band; also the most rows of a group and one more than the ancestors a node hands its value to.
HEIGHT = 16
#: Rows of one conversation that meet its shift in one task.
SECTION = 4096
#: Parents with more than one part in so many of all nodes as children are broadcast.
HOT_PARTS = 1000
BLANKS = r"[^\x20\x09-\x0D]+"
VALUES = ("leaves", "saved")


def _digest(*parts: Column) -> Column:
    """First 128 bits of the SHA-256 digest of the parts."""
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


ROOT = hashlib.sha256(b"root").digest()[:16]


def numbered_turns(conversations: DataFrame, stages: Stages) -> DataFrame:
    """Per turn: conv_id, ``place`` from 1, ``turn_key`` (digest of role and text), ``words``."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = _digest(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").alias("turn"),
        role.alias("role"),
        key.alias("turn_key"),
        F.regexp_count(text, F.lit(BLANKS)).cast("bigint").alias("words"),
        # Equal rows may fall into different ranges; which of them comes first makes no difference.
        F.monotonically_increasing_id().alias("row"),
    )
    # The ranges are sampled first: the texts are read for neither of the two passes.
    turns = stages.save(turns, "turn_keys")
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "turn_key", "row"]
    ranged = turns.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("range", F.spark_partition_id())

    def count(batches: Iterator[pa.RecordBatch]):
        last, before = None, 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            if not len(ids):
                continue
            new = np.concatenate(([True], ids[1:] != ids[:-1]))
            starts = np.flatnonzero(new)
            place = np.arange(1, len(ids) + 1) - np.repeat(starts, np.diff(np.append(starts, len(ids))))
            first = int(starts[1]) if len(starts) > 1 else len(ids)
            if ids[0] == last:
                place[:first] += before
            last, before = ids[-1], int(place[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], names=[*batch.schema.names, "place"])

    local = ranged.select("conv_id", "turn_key", "words", "range").mapInArrow(
        count, "conv_id bigint, turn_key binary, words bigint, range int, place bigint"
    )
    turns = stages.save(local, "ranged_turns")
    ends = turns.groupBy("range", "conv_id").agg(F.max("place").alias("n"))
    # A conversation that lies in several ranges is the first or the last of each: two rows a range at most.
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ends.withColumn("offset", F.sum("n").over(earlier)).where("offset is not null").drop("n")
    return turns.join(F.broadcast(offsets), ["range", "conv_id"], "left").select(
        "conv_id", (F.col("place") + F.coalesce("offset", F.lit(0))).alias("place"), "turn_key", "words"
    )


def rebuilt(turns: DataFrame, stages: Stages) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (conv_id, ``depth``, turn_key, words), and per conversation its ``length``.

    The first h turns of conversation c come from conversation c - c % 20, as far as
    it has them, where h = crc32(c) % 4; c's own turns after its first h follow.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).alias("h")
    own = turns.groupBy("conv_id").agg(F.count("*").alias("n")).select("conv_id", "n", h)
    donors = own.where("conv_id % 20 = 0").select(F.col("conv_id").alias("donor"), F.col("n").alias("donor_n"))
    convs = own.withColumn("donor", F.col("conv_id") - F.col("conv_id") % 20).join(donors, "donor", "left")
    taken = F.least("h", F.coalesce("donor_n", F.lit(0))).alias("taken")
    convs = stages.save(convs.select("conv_id", "n", "h", "donor", taken), "conversations")
    firsts = turns.where("place <= 3 and conv_id % 20 = 0").withColumnRenamed("conv_id", "donor")
    borrowed = (
        convs.where("taken > 0")
        .select("conv_id", "donor", F.explode(F.sequence(F.lit(1).cast("bigint"), "taken")).alias("place"))
        .join(firsts, ["donor", "place"])
        .select("conv_id", F.col("place").alias("depth"), "turn_key", "words")
    )
    section = F.expr(f"place div {SECTION}").alias("section")
    shifts = convs.where("taken < h and n > h").select(
        "conv_id", (F.col("h") - F.col("taken")).alias("shift"), F.explode(F.expr(f"sequence(0, n div {SECTION})")).alias("section")
    )
    kept = turns.where(F.col("place") > h).select("*", section).join(shifts, ["conv_id", "section"], "left")
    kept = kept.select("conv_id", (F.col("place") - F.coalesce("shift", F.lit(0))).alias("depth"), "turn_key", "words")
    lengths = convs.select("conv_id", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    return borrowed.unionByName(kept), lengths


def named(steps: DataFrame, longest: int, level: int, stages: Stages) -> list[DataFrame]:
    """Names of all prefixes, per level: the turns, the whole bands, the whole bands of bands, ...

    ``steps`` has conv_id, depth, turn_key and words. Each result has per
    conversation and band (``band`` from 0): ``entry``, the name before the band,
    and the arrays ``names`` and ``words`` of its prefixes.
    """
    bands = steps.groupBy("conv_id", F.expr(f"(depth - 1) div {HEIGHT}").alias("band")).agg(
        F.sort_array(F.collect_list(F.struct("depth", "turn_key", "words"))).alias("steps")
    )
    root = F.lit(ROOT)
    mark = F.lit(bytes([level]))
    if longest < HEIGHT:
        bands = bands.withColumn("entry", root).withColumn("border", F.lit(None).cast("binary"))
        upper = []
    else:
        bands = stages.save(bands, f"bands_{level}")
        joined = F.aggregate("steps", F.lit(b""), lambda all_, s: F.concat(all_, s["turn_key"]))
        whole = bands.where(F.size("steps") == HEIGHT).select(
            "conv_id", (F.col("band") + 1).alias("depth"), _digest(joined).alias("turn_key"), F.lit(0).cast("bigint").alias("words")
        )
        upper = named(whole, longest // HEIGHT, level + 1, stages)
        borders = upper[0].select("conv_id", F.posexplode("names").alias("i", "name"), "band")
        borders = borders.select("conv_id", (F.col("band") * HEIGHT + F.col("i") + 1).alias("border_depth"), "name")
        entry = borders.select("conv_id", F.col("border_depth").alias("band"), F.col("name").alias("entry"))
        border = borders.select("conv_id", (F.col("border_depth") - 1).alias("band"), F.col("name").alias("border"))
        bands = bands.join(entry, ["conv_id", "band"], "left").join(border, ["conv_id", "band"], "left")
        bands = bands.withColumn("entry", F.coalesce("entry", root))
    start = F.array("entry")
    chain = F.aggregate(
        F.slice("steps", 1, HEIGHT - 1),
        start,
        lambda names, s: F.concat(names, F.array(_digest(mark, F.element_at(names, -1), s["turn_key"]))),
    )
    inside = F.slice(chain, 2, HEIGHT)
    names = F.when(F.size("steps") == HEIGHT, F.concat(inside, F.array("border"))).otherwise(inside)
    out = bands.select("conv_id", "band", "entry", names.alias("names"), F.col("steps.words").alias("words"))
    return [stages.save(out, f"names_{level}"), *upper]


def prefixes(bands: DataFrame) -> DataFrame:
    """One row per conversation and prefix: depth, name, entry, ``above`` (ancestors in the band), words."""
    rows = bands.select("*", F.posexplode("names").alias("i", "name"))
    return rows.select(
        "conv_id",
        (F.col("band") * HEIGHT + F.col("i") + 1).alias("depth"),
        "name",
        "entry",
        F.slice("names", 1, F.col("i")).alias("above"),
        F.element_at("words", F.col("i") + 1).alias("words"),
    )


def ends(lengths: DataFrame, bands: DataFrame) -> DataFrame:
    """Per name at which conversations end: ``ends_sha256`` of their ids in ascending order.

    Sorted ids are joined to pieces of text where they lie, range by range; then the
    pieces of a name stream through one digest, which holds none of them.
    """
    last = lengths.where("length > 0").select(
        "conv_id", F.expr(f"(length - 1) div {HEIGHT}").alias("band"), F.expr(f"cast((length - 1) % {HEIGHT} as int)").alias("i")
    )
    at = last.join(bands.select("conv_id", "band", "names"), ["conv_id", "band"])
    members = at.select(F.element_at("names", F.col("i") + 1).alias("name"), "conv_id")
    turnless = lengths.where("length = 0").select(F.lit(ROOT).alias("name"), "conv_id")
    order = ["name", "conv_id"]
    ranged = members.unionByName(turnless).repartitionByRange(*order).sortWithinPartitions(*order)

    def runs(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            names, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            first, out = 0, []
            for i in range(1, len(ids) + 1):
                if i == len(ids) or names[i] != names[first]:
                    out.append((names[first], ids[first], ",".join(map(str, ids[first:i]))))
                    first = i
            yield pa.RecordBatch.from_pylist([dict(zip(("name", "first", "ids"), o, strict=True)) for o in out], _RUNS)

    pieces = ranged.mapInArrow(runs, "name binary, first bigint, ids string")

    def digests(batches: Iterator[pa.RecordBatch]):
        name, own = None, None
        for batch in batches:
            out = []
            for n, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if n != name:
                    if own:
                        out.append((name, own.hexdigest()))
                    name, own = n, hashlib.sha256(ids.encode())
                else:
                    own.update(b"," + ids.encode())
            yield _digests(out)
        if own:
            yield _digests([(name, own.hexdigest())])

    streams = pieces.repartition("name").sortWithinPartitions("name", "first").select("name", "ids")
    return streams.mapInArrow(digests, "name binary, ends_sha256 string")


_RUNS = pa.schema([("name", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])


def _digests(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    names, hashes = ([r[i] for r in rows] for i in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(hashes, pa.string())], names=["name", "ends_sha256"])


def _sums(frame: DataFrame) -> DataFrame:
    return frame.groupBy("name").agg(*[F.sum(v).alias(v) for v in VALUES])


def rolled_up(values: DataFrame, tries: list[DataFrame], longest: int, level: int, stages: Stages) -> DataFrame:
    """Sum of the values over the subtree of every node, by name.

    ``values`` has a row for each node of this level, the root included; ``tries``
    has its nodes without the root (name, ``border``: whether it ends a whole
    band, entry, above), and those of the levels over it.
    """
    nodes = tries[0].join(values, "name")
    entries = nodes.where("not border").select(F.col("entry").alias("name"), *VALUES)
    root = values.where(F.col("name") == F.lit(ROOT))
    if longest < HEIGHT:
        below = _sums(entries.unionByName(root))
        handed = nodes
    else:
        at_borders = _sums(entries.unionByName(root).unionByName(nodes.where("border").select("name", *VALUES)))
        at_borders = stages.save(at_borders, f"borders_{level}")
        below = stages.save(rolled_up(at_borders, tries[1:], longest // HEIGHT, level + 1, stages), f"totals_{level + 1}")
        totals = tries[0].where("border").join(below, "name")
        handed = nodes.where("not border").unionByName(totals)
    kept = F.when(F.col("border"), F.col("above")).otherwise(F.concat("above", F.array("name")))
    inner = handed.select(F.explode(kept).alias("name"), *VALUES)
    return _sums(inner).unionByName(below)


def trie(conversations: DataFrame, spark: SparkSession) -> DataFrame:
    """One row per node.

    Columns: ``name`` (binary), conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.
    """
    stages = Stages(spark)
    turns = numbered_turns(conversations, stages)
    steps, lengths = rebuilt(turns, stages)
    longest = lengths.agg(F.max("length")).first()[0]
    if longest is None:
        return spark.createDataFrame([], "name binary, " + ", ".join(f"{c} {k}" for c, k in COLUMNS))
    levels = named(steps, longest, 0, stages)

    found = prefixes(levels[0])
    # Depth, ancestors and words follow from the name; as keys they cost no sort.
    nodes = found.groupBy("name", "depth", "entry", "above", "words").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")
    )
    nodes = stages.save(nodes.withColumn("parent", F.coalesce(F.try_element_at("above", F.lit(-1)), "entry")), "nodes")
    everyone = lengths.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    root = everyone.select(F.lit(ROOT).alias("name"), F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("binary").alias("parent"),
                           F.lit(0).cast("bigint").alias("words"), "n_convs", "conv_id")
    children = nodes.groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    facts = nodes.drop("entry", "above").unionByName(root).join(children, "name", "left").na.fill(0, ["n_children"])
    facts = stages.save(facts, "facts")

    values = facts.select(
        "name",
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    border = (F.col("depth") % HEIGHT == 0).alias("border")
    tries = [nodes.select("name", border, "entry", "above")]
    tries += [prefixes(b).select("name", border, "entry", "above").distinct() for b in levels[1:]]
    totals = rolled_up(values, tries, longest, 0, stages)

    n_nodes = facts.count()
    parents = facts.where("n_children > 0").select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    hot = F.col("n_children") * HOT_PARTS > n_nodes
    common = F.broadcast(parents.where(hot).drop("n_children"))
    with_parent = facts.join(common, "parent").unionByName(
        facts.join(common.select("parent"), "parent", "left_anti").join(parents.where(~hot).drop("n_children"), "parent", "left")
    )
    none = hashlib.sha256(b"").hexdigest()
    return (
        with_parent.join(totals, "name")
        .join(ends(lengths, levels[0]), "name", "left")
        .select(
            "name", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
            F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
        )
    )


COLUMNS = [
    *((c, "bigint") for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")),
    ("ends_sha256", "string"),
]


def digest(conversations: DataFrame, spark: SparkSession) -> DataFrame:
    """The nodes without their names."""
    return trie(conversations, spark).select(*[F.col(c).cast(k).alias(c) for c, k in COLUMNS])


#: The same in SQL: prefixes as nested digests by window, members by conversation, subtrees by pairs of a prefix and
#: those before it. The remainder of the checksum goes bit by bit.
ORACLE = r"""
WITH RECURSIVE ids AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR) AS id, count(*) AS n FROM conversations WHERE conv_id IS NOT NULL GROUP BY ALL
), bits AS (
  SELECT conv_id, id, 0 AS step, CAST(4294967295 AS BIGINT) AS crc FROM ids
  UNION ALL
  SELECT conv_id, id, step + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, CAST(3988292384 AS BIGINT)) ELSE c // 2 END
  FROM (SELECT conv_id, id, step,
          CASE WHEN step % 8 = 0 THEN xor(crc, CAST(ascii(substr(id, step // 8 + 1, 1)) AS BIGINT)) ELSE crc END AS c
        FROM bits WHERE step < 8 * length(id))
), convs AS (
  SELECT i.conv_id, i.n, xor(b.crc, CAST(4294967295 AS BIGINT)) % 4 AS h, coalesce(d.n, 0) AS donor_n
  FROM ids i JOIN bits b ON b.conv_id = i.conv_id AND b.step = 8 * length(b.id)
  LEFT JOIN ids d ON d.conv_id = i.conv_id - i.conv_id % 20
), turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), steps AS (
  SELECT c.conv_id, t.place AS depth, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.place <= c.h
  UNION ALL
  SELECT c.conv_id, t.place - c.h + least(c.h, c.donor_n), t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h
), named AS (
  SELECT conv_id, depth, text,
    sha256(string_agg(sha256(concat(length(role), ':', role, text)), '') OVER (PARTITION BY conv_id ORDER BY depth)) AS name
  FROM steps
  UNION ALL SELECT conv_id, 0, '', 'root' FROM convs
), placed AS (
  SELECT *, lag(name) OVER (PARTITION BY conv_id ORDER BY depth) AS parent, max(depth) OVER (PARTITION BY conv_id) AS length FROM named
), nodes AS (
  SELECT name, depth, parent, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * len(regexp_extract_all(any_value(text), '[^\x20\x09-\x0D]+')) AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE depth = length), '')) AS ends_sha256
  FROM placed GROUP BY name, depth, parent
), children AS (
  SELECT parent AS name, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), pairs AS (
  SELECT DISTINCT a.name, b.name AS below FROM placed a JOIN placed b ON a.conv_id = b.conv_id AND a.depth <= b.depth
), totals AS (
  SELECT p.name, count(*) FILTER (WHERE c.n_children IS NULL) AS n_leaves, sum(n.saved) AS saved_tokens
  FROM pairs p JOIN nodes n ON n.name = p.below LEFT JOIN children c ON c.name = p.below GROUP BY p.name
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children,
  t.n_leaves, CAST(t.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN totals t ON t.name = n.name LEFT JOIN nodes p ON p.name = n.parent LEFT JOIN children c ON c.name = n.name
"""
