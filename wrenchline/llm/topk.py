"""Exact top-k by inner product over an M-tree of paged metric nodes.

Components become integers, floor(256 x). With M the largest squared length of all
vectors, a vector o gets one more component sqrt(M - |o|^2) and a query q gets 0; then
the squared distance is |q|^2 + M - 2 q.o, so the nearest rows are those of the highest
score, and distances obey the triangle inequality.

The tree has three levels. Region pivots are vectors of a bounded sample (``REGIONS``);
every row belongs to its nearest one. A region's rows are dealt over nodes of at most
about ``NODE_ROWS`` rows. A node holds pages: a pivot, a covering radius, and its entries
with their distances to the page pivot, in order; a page keeps its distance to the region
pivot.

A search is best-first. Each query looks into the node of its nearest region first, which
gives it a bound: its k-th best score so far. Then it visits only regions, pages and
entries that the stored distances cannot rule out. Scores are integers and
exact; distances decide only what is skipped, with a margin for rounding.

Vectors so long that doubles cannot hold their products (a squared length of 2^53 or more
after scaling) stay out of the tree. What they take part in, as query or as candidate, is
scored block by block in whole numbers, and both results are ranked together.

Rows: vectors that are null, or hold null or non-finite components, and rows without an id
take no part. Components are held at +-2^58 after scaling; a score that a long cannot hold
is null in its place. Shorter vectors count as
filled up with zeros. Repeated rows each count as candidates; rows with the query's id are
the query's own. Repeated query rows give their result once; different vectors of one id are
ranked together under it.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wrenchline.llm.common import Stages

REGIONS = 64
NODE_ROWS = 4096
PAGE_ROWS = 64
QUERY_ROWS = 256
#: Up to this squared length sums of products are exact in doubles.
EXACT_SQUARE = float(2**53)
#: Where components end.
LARGEST = 2**58
#: Rows of a block that is scored in whole numbers.
BLOCK_ROWS = 256
#: Distances are compared with this share of slack.
SLACK = 1e-9


def scaled(vectors: DataFrame) -> DataFrame:
    """vec_id, v: the integer vectors that take part, as doubles; ``long`` where their squared length is 2^53 or more."""
    times = lambda x: F.least(F.greatest(x.cast("double") * 256, F.lit(-float(LARGEST))), F.lit(float(LARGEST)))
    v = F.transform("embedding", lambda x: F.floor(times(x)).cast("double"))
    usable = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
    finite = lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf"))
    rows = vectors.where(usable & F.coalesce(F.forall("embedding", finite), F.lit(False)))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v")).withColumn("long", square >= EXACT_SQUARE)


def _matrix(column, width: int) -> np.ndarray:
    """Rows of a list column, filled up with zeros."""
    ends = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(ends)
    out = np.zeros((len(sizes), width))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(ends[-1] - ends[0]) - np.repeat(ends[:-1] - ends[0], sizes)
    out[owner, place] = flat[ends[0] : ends[-1]]
    return out


def lift(x: np.ndarray, bound: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(bound - (x * x).sum(1), 0))[:, None]])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0))


def build_node(ids: np.ndarray, x: np.ndarray, bound: float, region: np.ndarray) -> dict:
    """Pages of a node: rows near the same pivot, sorted by their distance to it."""
    lifted = lift(x, bound)
    k = max(1, len(ids) // PAGE_ROWS)
    order = np.lexsort((ids, distances(lifted, region[None])[:, 0]))
    pivots = np.unique(lifted[order[:: max(1, len(ids) // k)]], axis=0)
    to = distances(lifted, pivots)
    page = to.argmin(1)
    own = to[np.arange(len(ids)), page]
    by = np.lexsort((ids, own, page))
    first = np.searchsorted(page[by], np.arange(len(pivots) + 1))
    radius = np.array([own[by[b - 1]] if b > a else -1.0 for a, b in zip(first[:-1], first[1:], strict=True)])
    return {"ids": ids[by], "x": x[by], "own": own[by], "first": first, "pivots": pivots, "radius": radius, "parent": distances(pivots, region[None])[:, 0]}


def search_node(node: dict, region: np.ndarray, ids: np.ndarray, q: np.ndarray, floor: np.ndarray, bound: float, k: int):
    """The k best of a node for each query: rows (query, vec_id, score). ``floor``: scores below it are of no use."""
    lifted = np.hstack([q, np.zeros((len(q), 1))])
    square = (q * q).sum(1) + bound
    to_region = distances(lifted, region[None])[:, 0]
    to_page = distances(lifted, node["pivots"])
    margin = SLACK * np.sqrt(square + bound) + 1e-6
    out = []
    for i in range(len(ids)):
        limit = np.sqrt(max(square[i] - 2 * floor[i], 0)) if np.isfinite(floor[i]) else np.inf
        # The parent distance rules pages out before their own distance is looked at.
        nearest = np.maximum(np.abs(to_region[i] - node["parent"]), to_page[i]) - node["radius"]
        best_ids, best_scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for p in np.argsort(nearest, kind="stable"):
            if nearest[p] - margin[i] > limit:
                break
            a, b = node["first"][p], node["first"][p + 1]
            low, high = np.searchsorted(node["own"][a:b], [to_page[i, p] - limit - margin[i], to_page[i, p] + limit + margin[i]])
            a, b = a + low, a + high
            if a >= b:
                continue
            found = node["ids"][a:b]
            scores = np.rint(node["x"][a:b] @ q[i]).astype(np.int64)
            other = found != ids[i]
            best_ids = np.concatenate([best_ids, found[other]])
            best_scores = np.concatenate([best_scores, scores[other]])
            order = np.lexsort((best_ids, -best_scores))[:k]
            best_ids, best_scores = best_ids[order], best_scores[order]
            if len(order) == k:
                limit = min(limit, np.sqrt(max(square[i] - 2 * best_scores[-1], 0)))
        out += [(int(ids[i]), int(v), int(s)) for v, s in zip(best_ids, best_scores, strict=True)]
    return out


_HIT = "query_id bigint, vec_id bigint, score bigint"


def _hits(rows: list[tuple[int, int, int]]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [[], [], []]
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, queries: DataFrame, spark: SparkSession, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score. ``vectors`` and ``queries``: vec_id, v (integer components)."""
    stages = Stages(spark)
    rows = stages.save(vectors, "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    facts = rows.agg(F.max(square).alias("bound"), F.max(F.size("v")).alias("width")).collect()[0]
    if facts["bound"] is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    bound, width = facts["bound"], max(facts["width"], 1)
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(4 * REGIONS).select("v").collect()
    sample = np.unique(np.array([r["v"] + [0.0] * (width - len(r["v"])) for r in picked]), axis=0)
    pivots = lift(sample[np.random.default_rng(5).permutation(len(sample))[:REGIONS]], bound)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"), width)
            to = distances(lift(x, bound), pivots)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array(to.argmin(1).astype(np.int32)), pa.array(to.min(1))],
                names=["vec_id", "v", "region", "to_region"],
            )

    placed = stages.save(rows.mapInArrow(assign, "vec_id bigint, v array<double>, region int, to_region double"), "placed")
    # One row per region, at most REGIONS: how many nodes it needs and how far it reaches.
    reach = {
        r["region"]: (max(1, -(-r["n"] // NODE_ROWS)), r["near"], r["far"])
        for r in placed.groupBy("region").agg(F.count("*").alias("n"), F.min("to_region").alias("near"), F.max("to_region").alias("far")).collect()
    }
    parts = F.create_map(*[F.lit(x) for region, (n, _, _) in reach.items() for x in (region, n)])
    dealt = placed.withColumn("node", F.pmod(F.xxhash64("vec_id", "v"), parts[F.col("region")]).cast("int"))
    # Equal rows would share a node; only repeated ids of equal vectors do, and they are counted first.
    dealt = dealt.groupBy("region", "node", "vec_id", "v").agg(F.count("*").alias("copies"))

    def build(key, group):
        x, copies = _matrix(group.column("v").combine_chunks(), width), group.column("copies").to_numpy()
        ids = np.repeat(group.column("vec_id").to_numpy(), np.minimum(copies, k))
        region = group.column("region")[0].as_py()
        node = build_node(ids, np.repeat(x, np.minimum(copies, k), axis=0), bound, pivots[region])
        return pa.table(
            {"region": pa.array([region], pa.int32()), "node": pa.array([group.column("node")[0].as_py()], pa.int32()), "blob": pa.array([pickle.dumps(node, 5)], pa.binary())}
        )

    nodes = stages.save(dealt.groupBy("region", "node").applyInArrow(build, "region int, node int, blob binary"), "nodes")
    asked = queries.distinct()

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The home of each query: one node of its nearest region."""
        for batch in batches:
            q, ids = _matrix(batch.column("v"), width), batch.column("vec_id").to_numpy()
            to = distances(np.hstack([q, np.zeros((len(q), 1))]), pivots)
            far = np.full(len(pivots), False)
            far[list(reach)] = True
            to[:, ~far] = np.inf
            home = to.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array(home.astype(np.int32)),
                 pa.array((ids % [reach[h][0] for h in home.tolist()]).astype(np.int32))], names=["vec_id", "v", "region", "node"]
            )

    homed = asked.mapInArrow(route, "vec_id bigint, v array<double>, region int, node int").withColumn("floor", F.lit(None).cast("double"))
    first = stages.save(_visit(homed, nodes, pivots, bound, width, k), "first-hits")
    at_least = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("low")).where(F.col("n") >= k)
    bounded = asked.join(at_least.select(F.col("query_id").alias("vec_id"), F.col("low").cast("double").alias("floor")), "vec_id", "left")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for every node whose region the bound does not rule out."""
        for batch in batches:
            q, floor = _matrix(batch.column("v"), width), batch.column("floor").to_numpy(zero_copy_only=False)
            to = distances(np.hstack([q, np.zeros((len(q), 1))]), pivots)
            square = (q * q).sum(1) + bound
            limit = np.where(np.isnan(floor), np.inf, np.sqrt(np.maximum(square - 2 * np.nan_to_num(floor), 0))) + SLACK * np.sqrt(square + bound) + 1e-6
            at, region, node = [], [], []
            for r, (n, near, far) in reach.items():
                open_ = np.flatnonzero((to[:, r] - far <= limit) & (near - to[:, r] <= limit))
                at.append(np.repeat(open_, n))
                region.append(np.full(len(open_) * n, r))
                node.append(np.tile(np.arange(n), len(open_)))
            at = np.concatenate(at)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(at)), batch.column("v").take(pa.array(at)), pa.array(np.concatenate(region).astype(np.int32)),
                 pa.array(np.concatenate(node).astype(np.int32)), batch.column("floor").take(pa.array(at))], names=["vec_id", "v", "region", "node", "floor"]
            )

    everywhere = bounded.select("vec_id", "v", "floor").mapInArrow(spread, "vec_id bigint, v array<double>, region int, node int, floor double")
    hits = _visit(everywhere, nodes, pivots, bound, width, k)
    # A query keeps k rows per task before its rows meet.
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _visit(queries: DataFrame, nodes: DataFrame, pivots: np.ndarray, bound: float, width: int, k: int) -> DataFrame:
    """Searches nodes with blocks of queries: a block holds at most about ``QUERY_ROWS`` queries of a node."""

    def block(key, group):
        rows = {n: group.column(n).combine_chunks() for n in ("vec_id", "v", "floor")}
        return pa.table(
            {
                "region": pa.array([group.column("region")[0].as_py()], pa.int32()),
                "node": pa.array([group.column("node")[0].as_py()], pa.int32()),
                "asked": pa.array([pickle.dumps((rows["vec_id"].to_numpy(), _matrix(rows["v"], width), rows["floor"].to_numpy(zero_copy_only=False).astype(float)), 5)], pa.binary()),
            }
        )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for region, asked, blob in zip(*(batch.column(n).to_pylist() for n in ("region", "asked", "blob")), strict=True):
                ids, q, floor = pickle.loads(asked)
                floor = np.where(np.isnan(floor), -np.inf, floor)
                yield from _hits(search_node(pickle.loads(blob), pivots[region], ids, q, floor, bound, k)).to_batches()

    load = queries.groupBy("region", "node").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("blocks"))
    numbered = queries.join(load, ["region", "node"]).withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks"))
    blocks = numbered.groupBy("region", "node", "block").applyInArrow(block, "region int, node int, asked binary")
    return blocks.join(nodes, ["region", "node"]).select("region", "asked", "blob").mapInArrow(search, _HIT)


def _blocks(rows: DataFrame, side: str) -> tuple[DataFrame, int]:
    """Rows packed in blocks of about ``BLOCK_ROWS``; how many blocks there are."""
    n = -(-rows.count() // BLOCK_ROWS)
    number = F.pmod(F.xxhash64("vec_id", "v"), F.lit(max(n, 1))).cast("int").alias(f"{side}_block")
    packed = rows.groupBy(number).agg(F.collect_list(F.struct("vec_id", "v")).alias(side))
    return packed, n


def whole_scores(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """The k best of every pair of blocks for each query, scored in whole numbers: query_id, vec_id, score (decimal).

    Every block of queries meets every block of candidates in a task of its own.
    """
    asked, n_asked = _blocks(queries.distinct(), "asked")
    given, n_given = _blocks(candidates, "given")
    schema = "query_id bigint, vec_id bigint, score decimal(38,0)"
    if not n_asked or not n_given:
        return queries.sparkSession.createDataFrame([], schema)
    pairs = asked.withColumn("given_block", F.explode(F.sequence(F.lit(0), F.lit(n_given - 1))))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ours, theirs in zip(batch.column("asked").to_pylist(), batch.column("given").to_pylist(), strict=True):
                rows = [(r["vec_id"], list(map(int, r["v"]))) for r in theirs]
                found = []
                for query in ours:
                    q, own = list(map(int, query["v"])), query["vec_id"]
                    scores = [(-sum(a * b for a, b in zip(q, v, strict=False)), i) for i, v in rows if i != own]
                    found += [(own, i, str(-s)) for s, i in sorted(scores)[:k]]
                yield pa.RecordBatch.from_pydict({n: [f[i] for f in found] for i, n in enumerate(("query_id", "vec_id", "score"))}, _TEXT_HIT)

    met = pairs.join(given, "given_block").repartition("asked_block", "given_block")
    hits = met.select("asked", "given").mapInArrow(best, "query_id bigint, vec_id bigint, score string")
    return hits.select("query_id", "vec_id", F.col("score").cast("decimal(38,0)").alias("score"))


_TEXT_HIT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.string())])


def search(rows: DataFrame, queries: DataFrame, spark: SparkSession, k: int = 5) -> DataFrame:
    """``top_k`` for vectors of any length; ``rows`` and ``queries`` as ``scaled`` gives them."""
    short = lambda df: df.where(~F.col("long")).drop("long")
    found = top_k(short(rows), short(queries), spark, k)
    stages = Stages(spark)
    long_rows = stages.save(rows.where("long").drop("long"), "long-vectors")
    if not long_rows.head(1):
        return found
    long_queries = queries.where("long").drop("long")
    whole = whole_scores(queries.drop("long"), long_rows, k).unionByName(whole_scores(long_queries, short(rows), k))
    both = stages.save(found.drop("rank").withColumn("score", F.col("score").cast("decimal(38,0)")).unionByName(whole), "all-hits")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    ranked = both.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", F.expr("try_cast(score as bigint)").alias("score"))


def digest(embeddings: DataFrame, spark: SparkSession, every: int = 50, k: int = 5) -> DataFrame:
    """The stated query set (ids divisible by ``every``) against all rows."""
    rows = scaled(embeddings)
    return search(rows, rows.where(F.col("vec_id") % every == 0), spark, k)


ORACLE = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS c FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.c) + 1), lambda i: q.c[i] * c.c[i]))::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
