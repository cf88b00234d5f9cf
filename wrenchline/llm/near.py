"""Shared parts of the similarity operators: words, shingles, tries, components, exact verification.

Items (documents or paragraphs) are named by a hash of their content, so copies are one
item. Candidate links come from sorted labels; connected items form
candidate clusters; every pair inside a cluster is verified exactly, in blocks: a
block holds a bounded number of items and shingles, and large clusters compare their
blocks pairwise in separate tasks, which return sums and spanning edges, not pairs.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wrenchline.llm.common import Stages

SHINGLE = 5
#: Similarity as a fraction, so that the test is exact in integers.
SIMILARITY = (4, 5)
BLOCK_ITEMS = 400
BLOCK_SHINGLES = 1_500_000
#: Clusters with up to so many items times bytes of shingles are compared pair by pair, and larger pairs too.
FEW = 40_000
#: Blocks that one task compares a block with.
BLOCK_CHUNK = 16

_RNG = np.random.default_rng(20240501)
_BYTE_MIX = _RNG.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_WORD_MIX = _RNG.integers(1, 2**63, SHINGLE, dtype=np.uint64) | np.uint64(1)
#: Bytes of words: digits, lower-case letters and everything beyond ASCII.
_WORD = np.zeros(256, bool)
_WORD[ord("0") : ord("9") + 1] = _WORD[ord("a") : ord("z") + 1] = _WORD[128:] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64 bits that spreads them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_table(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first byte, byte after the last) of every word of a lower-cased text."""
    data = np.frombuffer(raw, np.uint8)
    inside = _WORD[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    first, after = edge[::2], edge[1::2]
    if not first.size:
        return np.zeros(0, np.uint64), first, after
    at = np.flatnonzero(inside)
    size = after - first
    starts = np.cumsum(size) - size
    place = np.arange(at.size) - np.repeat(starts, size)
    keys = np.add.reduceat((data[at].astype(np.uint64) + np.uint64(1)) * _BYTE_MIX[place & 63], starts)
    return mixed(keys + size.astype(np.uint64)), first, after


def shingles_of(words: np.ndarray) -> np.ndarray:
    """Hashes of all runs of five words, in order; fewer words are one run; none gives none."""
    if words.size < SHINGLE:
        return mixed(np.array([(words * _WORD_MIX[: words.size]).sum() + np.uint64(words.size)], np.uint64)) if words.size else words
    total = np.zeros(words.size - SHINGLE + 1, np.uint64)
    for i in range(SHINGLE):
        total += words[i : words.size - SHINGLE + 1 + i] * _WORD_MIX[i]
    return mixed(total)


def shingle_set(text: str | None) -> np.ndarray:
    return np.unique(shingles_of(word_table((text or "").lower().encode())[0]))


def identity(values: np.ndarray) -> bytes:
    """16 bytes that name a sequence of hashes."""
    import xxhash

    return xxhash.xxh3_128_digest(np.ascontiguousarray(values).tobytes())


def linked_labels(labels: DataFrame, prefix_bytes: int, stages: Stages) -> DataFrame:
    """Edges (a, b) that connect all items with a common label prefix.

    ``labels``: label binary and id binary, each of one length. Rows are sorted by range;
    each task streams its stretch and links every item to the first one of its prefix. A
    prefix that spans several tasks is joined up by the first items of its parts, two rows
    per task. A frequent prefix is thus split by the range, and costs a row per item.
    """

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix, center, opened = b"", b"", []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = _fixed(batch.column(0))[:, :prefix_bytes]
            ids = _fixed(batch.column(1))
            fresh = np.ones(len(keys), bool)
            fresh[1:] = (keys[1:] != keys[:-1]).any(1)
            fresh[0] = keys[0].tobytes() != prefix
            start = np.maximum.accumulate(np.where(fresh, np.arange(len(keys)), -1))
            before = np.frombuffer(center or bytes(ids.shape[1]), np.uint8)
            centers = np.where((start >= 0)[:, None], ids[np.maximum(start, 0)], before)
            if not opened:
                opened.append((keys[0].tobytes(), ids[0].tobytes()))
            prefix, center = keys[-1].tobytes(), centers[-1].tobytes()
            other = (centers != ids).any(1)
            if other.any():
                yield _edge_batch(centers[other], ids[other], None)
        if opened:
            ends = list(dict.fromkeys([*opened, (prefix, center)]))
            both = np.frombuffer(b"".join(c for _, c in ends), np.uint8).reshape(len(ends), -1)
            yield _edge_batch(both, both, [p for p, _ in ends])

    ordered = labels.select("label", "id").repartitionByRange("label", "id").sortWithinPartitions("label", "id")
    found = stages.save(ordered.mapInArrow(stream, "a binary, b binary, prefix binary"), "links")
    inner = found.where("prefix IS NULL").select("a", "b")
    seams = found.where("prefix IS NOT NULL").select("prefix", "a")
    heads = seams.groupBy("prefix").agg(F.min("a").alias("head"))
    across = seams.join(heads, "prefix").where("a <> head").select(F.col("head").alias("a"), F.col("a").alias("b"))
    return inner.unionByName(across)


def binaries(matrix: np.ndarray) -> pa.Array:
    """Rows of bytes as a column of binaries."""
    data = np.ascontiguousarray(matrix)
    ends = np.arange(len(data) + 1, dtype=np.int32) * data.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _fixed(column: pa.Array) -> np.ndarray:
    """A column of binaries of one length as a matrix of bytes."""
    _, ends, data = column.buffers()
    at = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]].reshape(len(column), -1)


def _edge_batch(a: np.ndarray, b: np.ndarray, prefix: list | None) -> pa.RecordBatch:
    cells = [pa.array([r.tobytes() for r in x], pa.binary()) for x in (a, b)]
    return pa.RecordBatch.from_arrays([*cells, pa.array(prefix or [None] * len(a), pa.binary())], names=["a", "b", "prefix"])


def components(edges: DataFrame, stages: Stages) -> DataFrame:
    """(id, root) for every item of an edge: root is the smallest id that is connected.

    Rounds of large and small stars; a round is staged, and the one before it dropped.
    Minima are summed per task before they are shuffled, and joins with a frequent key
    are left to the skew handling of sort-merge joins.
    """
    now = stages.save(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0]
        if state == before:
            return now.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
            )
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stages.save(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = stages.save(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        stages.drop(large)
        stages.drop(now)
        now = small


def blocked(items: DataFrame, roots: DataFrame) -> DataFrame:
    """Roots with ``n_blocks`` and ``block``: enough blocks for a cluster's items and shingles.

    ``items``: id, n_shingles. Items of a block are chosen by hash.
    """
    members = roots.join(items.select("id", "n_shingles"), "id")
    sizes = members.groupBy("root").agg(
        F.greatest(
            F.ceil(F.count("*") / BLOCK_ITEMS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES), F.lit(1)
        ).cast("int").alias("n_blocks")
    )
    return members.join(sizes, "root").withColumn("block", F.pmod(F.xxhash64("id"), F.col("n_blocks")).cast("int"))


def pack(ids: np.ndarray, copies: np.ndarray, sets: list[np.ndarray]) -> dict:
    """A block: its shingles, the most frequent first, and each item as rising positions in them."""
    sizes = np.array([len(s) for s in sets])
    values, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(-count, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    owner = np.repeat(np.arange(len(sets)), sizes)
    column = rank[place]
    by = np.lexsort((column, owner))
    return {"ids": ids, "copies": copies, "sizes": sizes, "values": values[order], "column": column[by].astype(np.int32), "count": count[order]}


def _matrix(block: dict, columns: np.ndarray, width: int) -> np.ndarray:
    """Items x shared shingles; ``columns`` maps positions to shared ones, -1 for the rest."""
    owner = np.repeat(np.arange(len(block["sizes"])), block["sizes"])
    to = columns[block["column"]]
    out = np.zeros((len(block["sizes"]), width), np.float32)
    out[owner[to >= 0], to[to >= 0]] = 1
    return out


def common_counts(a: dict, b: dict) -> np.ndarray:
    """Sizes of all intersections between the items of two blocks."""
    if a is b:
        pa_, pb_ = (np.flatnonzero(a["count"] > 1),) * 2
    else:
        _, pa_, pb_ = np.intersect1d(a["values"], b["values"], assume_unique=True, return_indices=True)
    total = np.zeros((len(a["sizes"]), len(b["sizes"])), np.float64)
    for first in range(0, len(pa_), 4096):
        here = slice(first, first + 4096)
        width = len(pa_[here])
        ca, cb = np.full(len(a["values"]), -1), np.full(len(b["values"]), -1)
        ca[pa_[here]] = cb[pb_[here]] = np.arange(width)
        ma = _matrix(a, ca, width)
        total += ma @ (ma if a is b else _matrix(b, cb, width)).T
    if a is b:  # shingles of one item alone count for the item itself only
        np.fill_diagonal(total, a["sizes"])
    return total


def similar(a: dict, b: dict) -> np.ndarray:
    """Whether the Jaccard similarity of two items reaches the threshold, exactly."""
    common = common_counts(a, b)
    union = a["sizes"][:, None] + b["sizes"][None, :] - common
    return common * SIMILARITY[1] >= union * SIMILARITY[0]


class Forest:
    """Union of numbered nodes; the smaller number is the root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def _spanning(matrix: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the items of one block, by breadth-first search over rows."""
    left = np.ones(len(matrix), bool)
    edges = []
    for start in range(len(matrix)):
        if not left[start]:
            continue
        left[start] = False
        queue = [start]
        while queue:
            x = queue.pop()
            found = np.flatnonzero(matrix[x] & left)
            left[found] = False
            edges += [(start, int(y)) for y in found]
            queue += found.tolist()
    return edges


RESULT = "id binary, other binary, n_links bigint"


def _result(links: list, edges: list) -> pa.Table:
    """Rows (id, null, links) and rows (id, other, null)."""
    return pa.table(
        {
            "id": pa.array([i for i, _ in links] + [a for a, _ in edges], pa.binary()),
            "other": pa.array([None] * len(links) + [b for _, b in edges], pa.binary()),
            "n_links": pa.array([n for _, n in links] + [None] * len(edges), pa.int64()),
        }
    )


_BLOCK = pa.schema(
    [("id", pa.binary()), ("other", pa.binary()), ("n_links", pa.int64()), ("blob", pa.binary()), ("root", pa.binary()), ("n_blocks", pa.int32()), ("block", pa.int32())]
)


class _Found:
    """What the blocks of a batch give: links, edges and packed blocks."""

    def __init__(self):
        self.links, self.edges, self.blobs = [], [], []

    def batches(self) -> Iterator[pa.RecordBatch]:
        result = _result(self.links, self.edges)
        rest = [pa.nulls(result.num_rows, field.type) for field in list(_BLOCK)[3:]]
        yield from pa.table([*result.columns, *rest], schema=_BLOCK).to_batches()
        for blob in self.blobs:
            yield pa.RecordBatch.from_pylist([dict(zip(_BLOCK.names, blob, strict=True))], _BLOCK)


def _few(ids: list[bytes], seen: dict, out: _Found) -> None:
    """Links and edges of a small cluster, pair by pair."""
    sets = [set(np.frombuffer(seen[i][1], np.uint64).tolist()) for i in ids]
    counts, forest = [0] * len(ids), Forest(len(ids))
    for x, a in enumerate(sets):
        for y in range(x + 1, len(sets)):
            common = len(a & sets[y])
            if common * SIMILARITY[1] >= (len(a) + len(sets[y]) - common) * SIMILARITY[0]:
                counts[x] += seen[ids[y]][0]
                counts[y] += seen[ids[x]][0]
                if forest.join(x, y):
                    out.edges.append((ids[x], ids[y]))
    out.links += [(i, n) for i, n in zip(ids, counts, strict=True) if n]


def _open(blob: bytes) -> dict:
    return pickle.loads(zlib.decompress(blob))


def verified(rows: DataFrame, stages: Stages) -> tuple[DataFrame, DataFrame]:
    """Exact links of all items in candidate clusters: ((id, n_links), edges (a, b)).

    ``rows``: root, n_blocks, block, id, copies, shingles (64-bit hashes as bytes).
    ``n_links`` counts other items by their copies. The edges connect all linked items.
    """

    def own(place, ids, copies, sets, out):
        """Verifies a block within itself; a block of a larger cluster is passed on, packed."""
        seen = {i: (c, s) for i, c, s in zip(ids, copies, sets, strict=True)}
        ids = sorted(seen)
        size = sum(len(s) for _, s in seen.values())
        if place[1] == 1 and (len(ids) * size <= FEW or len(ids) == 2 and size <= 100 * FEW):  # most clusters
            return _few(ids, seen, out)
        sets = [np.unique(np.frombuffer(seen[i][1], np.uint64)) for i in ids]
        block = pack(np.array(ids, object), np.array([seen[i][0] for i in ids]), sets)
        linked = similar(block, block)
        np.fill_diagonal(linked, False)
        counts = linked @ block["copies"]
        edges = _spanning(linked)
        group_of = np.arange(len(ids))
        for start, y in edges:
            group_of[y] = start
        block["group"] = group_of
        out.links += [(i, int(n)) for i, n in zip(ids, counts, strict=True) if n]
        out.edges += [(ids[a], ids[b]) for a, b in edges]
        if place[1] > 1:
            out.blobs.append([None] * 3 + [zlib.compress(pickle.dumps(block, 5), 1), *place])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, rows = None, ([], [], [])
        for batch in batches:
            if not batch.num_rows:
                continue
            places = list(zip(*(batch.column(n).to_pylist() for n in ("root", "n_blocks", "block")), strict=True))
            cells = [batch.column(n).to_pylist() for n in ("id", "copies", "shingles")]
            cuts = [0, *(i for i in range(1, len(places)) if places[i] != places[i - 1]), len(places)]
            out = _Found()
            for first, after in zip(cuts, cuts[1:]):
                if places[first] != place:
                    if place:
                        own(place, *rows, out)
                    place, rows = places[first], ([], [], [])
                for kept, column in zip(rows, cells, strict=True):
                    kept += column[first:after]
            yield from out.batches()
        if place:
            out = _Found()
            own(place, *rows, out)
            yield from out.batches()

    schema = RESULT + ", blob binary, root binary, n_blocks int, block int"
    # Blocks are streamed one after the other: a call for each would cost more than most clusters do.
    sorted_rows = rows.repartition("root", "block").sortWithinPartitions("root", "block")
    first = stages.save(sorted_rows.mapInArrow(stream, schema), "blocks")
    blobs = first.where("blob IS NOT NULL").select("root", "n_blocks", "block", "blob")
    chunks = F.ceil(F.col("n_blocks") / BLOCK_CHUNK).cast("int")
    mine = blobs.select("*", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"), F.col("block").alias("at"), F.lit(True).alias("mine"))
    other = blobs.withColumn("chunk", F.expr(f"block div {BLOCK_CHUNK}").cast("int")).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("at"), F.lit(False).alias("mine")
    )
    pairs = mine.unionByName(other.where("at <> block").select(*mine.columns))

    def across(key, group):
        parts = list(zip(*(group.column(n).to_pylist() for n in ("mine", "block", "blob")), strict=True))
        at = next(_open(blob) for is_mine, _, blob in parts if is_mine)
        at_block = next(block for is_mine, block, _ in parts if is_mine)
        counts = np.zeros(len(at["ids"]), np.int64)
        edges = []
        for is_mine, block, blob in parts:
            if is_mine:
                continue
            there = _open(blob)
            linked = similar(at, there)
            counts += linked @ there["copies"]
            if at_block < block:  # one edge for each pair of linked groups is enough
                x, y = np.nonzero(linked)
                n = len(there["ids"])
                _, one = np.unique(at["group"][x].astype(np.int64) * n + there["group"][y], return_index=True)
                edges += [(at["ids"][x[i]], there["ids"][y[i]]) for i in one]
        return _result([(i, int(n)) for i, n in zip(at["ids"], counts, strict=True) if n], edges)

    second = stages.save(pairs.groupBy("root", "at", "chunk").applyInArrow(across, RESULT), "block-pairs")
    both = first.where("blob IS NULL").select("id", "other", "n_links").unionByName(second)
    links = both.where("n_links IS NOT NULL").groupBy("id").agg(F.sum("n_links").alias("n_links"))
    return links, both.where("other IS NOT NULL").select(F.col("id").alias("a"), F.col("other").alias("b"))
