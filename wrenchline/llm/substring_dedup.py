"""Passages that several documents share, by MinHash banding of overlapping paragraphs.

Shared passages begin and end anywhere, so a paragraph is every run of ``paragraph_words``
words. Its min-hash is taken over its five-word shingles, and its label is the hash of the
``LABEL_WORDS`` words from that shingle on. Neighbouring paragraphs mostly share the label and
then are one row, about 0.13 a word.

1. Tuning: a passage of ``PASSAGE_WORDS`` words or more at similarity 0.8 has a stretch
   between two edits that holds a whole paragraph (``paragraph_words``), and equal paragraphs
   have equal labels. One band of one row thus finds every such passage; more bands add
   nothing.
2. Labels in two or more documents collide. A document's occurrence is linked to the
   smallest document with the label, the smallest one's to the largest: a row an
   occurrence, not all pairs. Where the words around a label differ, the same is done for
   each paragraph that the label stands for, so a document that has the label by chance or
   elsewhere hides nobody; paragraphs that would only give the label's links again are left out.
3. Linked occurrences on one diagonal are a stretch. It is compared with the words of the
   partner around it, which travel in blocks: shingles that the partner has too are marked,
   and stretches of marked words grow word for word on both sides.
4. Marked runs that small edits part are one passage if the exact Jaccard similarity of its
   five-word shingles and the partner's is 0.8 or more; else only the equal runs count.
5. Removals follow links to smaller documents. Links never rise, so every component of
   linked passages keeps the passage of its smallest document.
6. Passages of ``run_words`` words or more count, so a short formula that many documents use
   leaves them alone.

Result: a row per document with such passages: the spans (code points, end exclusive), what
is removed, and the documents that keep the passages. Clean documents have no row.

Rows: null and empty texts have no passages. Rows that repeat a doc_id are one document, whose
texts are told apart by their digest; rows without one are a document smaller than all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wrenchline.llm import near
from wrenchline.llm.common import NO_ID, Stages, id_key, maybe_in

#: Passages of so many words and more are found with certainty at the similarity of ``near``.
PASSAGE_WORDS = 51
LABEL_WORDS = 12
RUN_WORDS = 16
#: Words beyond the outermost labels that a passage may reach on each side.
REACH = 56
#: Words of a partner that travel together.
BLOCK = 64
#: Words that an edit may take between two runs of one passage.
EDIT_WORDS = 3

#: Bytes of text whose words are hashed together.
CHUNK = 1 << 17

_LABEL_MIX = np.random.default_rng(11).integers(1, 2**63, 2, dtype=np.uint64) | np.uint64(1)


def paragraph_words(least: int = PASSAGE_WORDS, similarity: tuple[int, int] = near.SIMILARITY) -> int:
    """The longest run that some stretch between the edits of any passage of ``least`` words or more holds.

    A changed word takes up to five shingles on each side of the union: of n shingles,
    with d lost, the similarity is (n - d) / (n + d).
    """
    shortest = least
    for words in range(least, 40 * least):
        n = words - near.SHINGLE + 1
        lost = n * (similarity[1] - similarity[0]) // (similarity[1] + similarity[0])
        edits = lost // near.SHINGLE
        shortest = min(shortest, -(-(words - edits) // (edits + 1)))
    return shortest


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each run of ``width`` values, by minima of runs that double."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values, done = np.minimum(values[:-step], values[step:]), done + step
    return values


def _short(words: np.ndarray) -> np.ndarray:
    """Words as 32 bits."""
    return (words >> np.uint64(32)).astype(np.uint32)


def _run_hashes(words: np.ndarray, widths: tuple[int, ...]) -> list[np.ndarray]:
    """Hashes of all runs of each width, as differences of one running sum of words times powers of an odd number."""
    base = int(_LABEL_MIX[1])
    powers, inverse = (np.cumprod(np.append(np.uint64(1), np.full(words.size, x, np.uint64))) for x in (base, pow(base, -1, 1 << 64)))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers[:-1])])
    return [near.mixed((sums[w:] - sums[:-w]) * inverse[: max(sums.size - w, 0)]) for w in widths]


def places(words: np.ndarray, paragraph: int, sizes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(label, first word) of the min-hashes of all paragraphs of a text, and the paragraphs of each as (number, hashes).

    Texts of no more words than a paragraph give every place, as their copies may be cut
    differently; so do places that tie. ``words`` may be those of several texts of ``sizes`` words.
    """
    n = words.size - LABEL_WORDS + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
    sizes = np.array([words.size]) if sizes is None else sizes
    left = (np.repeat(np.cumsum(sizes), sizes) - np.arange(words.size))[:n]  # words of the text from here on
    counts = np.repeat(sizes, sizes)[:n] <= paragraph
    labels, whole = _run_hashes(words, (LABEL_WORDS, paragraph))
    if not whole.size:
        at = np.flatnonzero(left >= LABEL_WORDS)
        return labels[at], at, np.zeros(at.size, np.int64), np.zeros(0, np.int32)
    width = paragraph - LABEL_WORDS + 1
    ranks = near.mixed(near.shingles_of(words)[:n] ^ _LABEL_MIX[0])
    least = _window_minima(ranks, width)
    least[left[: least.size] < paragraph] = 0  # no paragraph of one text
    # A place counts if it is the least of one of the paragraphs that hold it: then it equals the largest of their minima.
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    counts |= ranks == ~_window_minima(~padded, width)
    at = np.flatnonzero(counts & (left >= LABEL_WORDS))
    whole = _short(whole).view(np.int32)
    first = at[:, None] - np.arange(width)
    inside = np.clip(first, 0, least.size - 1)
    own = (first == inside) & (least[inside] == ranks[at][:, None])
    return labels[at], at, own.sum(axis=1), whole[inside[own]]


def _chunks(texts: list[str | None]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Stretches of texts: lower-cased bytes, first byte and first word of each text and the end, table of words."""
    size, raws = 0, []
    for after, text in enumerate(texts, 1):
        raws.append((text or "").lower().encode())
        size += len(raws[-1]) + 1
        if size >= CHUNK or after == len(texts):
            starts = np.cumsum([0, *(len(r) + 1 for r in raws)])
            raw = b"\n".join(raws)  # a line break parts the words of two texts
            table = near.word_table(raw)
            yield raw, starts, np.searchsorted(table[1], starts), table
            size, raws = 0, []


def _tables(texts: list[str | None]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Of every text the lower-cased bytes and what ``near.word_table`` gives for them."""
    for raw, starts, opens, (words, low, high) in _chunks(texts):
        for start, end, a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), opens[:-1].tolist(), opens[1:].tolist(), strict=True):
            yield raw[start : end - 1], words[a:b], low[a:b] - start, high[a:b] - start


def _anchors(batches: Iterator[pa.RecordBatch], paragraph: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = 0
        for _, _, opens, (words, _, _) in _chunks(batch.column("text").to_pylist()):
            sizes = np.diff(opens)
            labels, at, number, hashes = places(words, paragraph, sizes)
            owner = np.repeat(np.arange(sizes.size), sizes)[at]
            keys = [batch.column(k).take(pa.array(owner + done)) for k in ("doc", "part")]
            paragraphs = pa.ListArray.from_arrays(pa.array(np.cumsum(np.append(0, number)).astype(np.int32)), pa.array(hashes))
            yield pa.RecordBatch.from_arrays(
                [pa.array(labels.view(np.int64)), *keys, pa.array((at - opens[owner]).astype(np.int32)), paragraphs],
                names=["label", "doc", "part", "pos", "paragraphs"],
            )
            done += sizes.size


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wanted blocks of words of every text."""
    schema = pa.schema([("partner", pa.int64()), ("partner_part", pa.int64()), ("block", pa.int32()), ("words", pa.binary())])
    for whole in batches:
        for first in range(0, whole.num_rows, 256):
            batch = whole.slice(first, 256)
            rows = []
            keys = zip(*(batch.column(k).to_pylist() for k in ("doc", "part", "blocks")), strict=True)
            for (doc, part, blocks), (_, full, _, _) in zip(keys, _tables(batch.column("text").to_pylist()), strict=True):
                words = _short(full)
                for b in blocks:
                    if b * BLOCK < words.size:
                        rows.append({"partner": doc, "partner_part": part, "block": b, "words": words[b * BLOCK : (b + 1) * BLOCK].tobytes()})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _heads(hits: DataFrame, keys: list[str], *more: str) -> DataFrame:
    """Of every key the first place in the smallest document that has it, and in the largest."""
    # Of a document one place is looked at; hashes of texts make it one text's.
    place = F.struct("part", "pos", *more)
    ends = [F.min(F.when(F.col("doc") == F.col(end), place)).alias(f"at_{end}") for end in ("low", "high")]
    return hits.where("doc = low OR doc = high").groupBy(*keys).agg(*ends)


def _linked(hits: DataFrame, heads: DataFrame, keys: list[str]) -> DataFrame:
    """Occurrences of a key, each with a place of the smallest document that has it, the smallest one's with the largest's."""
    first = F.col("doc") == F.col("low")
    met = hits.join(heads, keys).withColumn("at", F.when(first, F.struct("at_high.part", "at_high.pos")).otherwise(F.struct("at_low.part", "at_low.pos")))
    links = {"partner": F.when(first, F.col("high")).otherwise(F.col("low")), "partner_part": F.col("at.part"), "shift": F.expr("at.pos - pos")}
    return met.withColumns(links).drop("at")


def stretches(source: DataFrame, stages: Stages) -> DataFrame:
    """Linked stretches: doc, part, partner, partner_part, shift, first and last word of the outermost labels.

    The smallest document with a label may have it among other words, and then hides those
    that share the passage. So where the paragraphs around a label differ, its
    occurrences are also linked by each paragraph. One that the smallest and the largest
    document both have at the place that the label links to gives the label's links again and is left out.
    """
    paragraph = paragraph_words()
    schema = "label bigint, doc bigint, part bigint, pos int, paragraphs array<int>"
    found = stages.save(source.mapInArrow(lambda b: _anchors(b, paragraph), schema), "anchors")
    around = F.xxhash64("paragraphs")
    counted = found.groupBy("label").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), (F.min(around) != F.max(around)).alias("mixed"))
    shared = stages.save(counted.where("low <> high"), "labels")
    hits = maybe_in(found, shared, ["label"]).join(shared, "label")
    hits = stages.save(hits.withColumn("paragraphs", F.when(F.col("mixed"), F.col("paragraphs"))).drop("mixed"), "hits")
    stages.drop(found)
    heads = _heads(hits, ["label"], "paragraphs").withColumn("known", F.array_intersect("at_low.paragraphs", "at_high.paragraphs"))
    heads = stages.save(heads.select("label", *(F.struct(f"{c}.part", f"{c}.pos").alias(c) for c in ("at_low", "at_high")), "known"), "heads")
    rest = F.when(F.col("paragraphs") != F.col("known"), F.array_except("paragraphs", "known"))
    by_label = _linked(hits, heads, ["label"]).withColumn("rest", rest)
    by_label = stages.save(by_label.select("label", "doc", "part", "pos", "partner", "partner_part", "shift", "rest"), "linked")
    keys = ["label", "paragraph"]
    single = by_label.select("label", F.explode("rest").alias("paragraph"), "doc", "part", "pos")
    ends = single.groupBy(*keys).agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low <> high")
    ends = stages.save(ends, "ends")
    several = stages.save(single.join(ends, keys), "paragraphs")
    places_ = stages.save(_heads(several, keys), "heads")
    link = ["doc", "part", "partner", "partner_part", "shift"]
    links = by_label.select(*link, "pos").unionByName(_linked(several, places_, keys).select(*link, "pos"))
    out = stages.save(links.groupBy(*link).agg(F.min("pos").alias("first"), F.max("pos").alias("last")), "stretches")
    for used in (shared, hits, heads, by_label, ends, several, places_):
        stages.drop(used)
    return out


def repeated(docs: DataFrame, spark: SparkSession, run_words: int = LABEL_WORDS) -> DataFrame:
    """Passages that repeat across documents: doc, part, start, end, size, opens, keeper.

    ``keeper`` is the smallest partner that has the passage, or the document itself if
    all its partners are larger; ``opens`` tells that no other passage ends where this one begins.
    """
    stages = Stages(spark)
    source = docs.select(id_key().alias("doc"), F.xxhash64("text").alias("part"), F.col("text"))
    found = stretches(source, stages)
    low = F.greatest(F.lit(0), F.expr(f"first + shift - {REACH}"))
    high = F.expr(f"last + shift + {REACH + LABEL_WORDS}")
    keys = ["doc", "part", "partner", "partner_part"]
    span = F.sequence(F.floor(low / BLOCK).cast("int"), F.floor(high / BLOCK).cast("int"))
    # A block that several stretches of a text ask for travels once.
    wants = stages.save(found.select(*keys, F.explode(span).alias("block")).distinct(), "wants")
    asked = wants.groupBy(F.col("partner").alias("doc"), F.col("partner_part").alias("part")).agg(F.collect_set("block").alias("blocks"))
    texts = maybe_in(source, wants.select(F.col("partner").alias("doc"), F.col("partner_part").alias("part")), ["doc", "part"])
    cut = texts.join(asked, ["doc", "part"]).mapInArrow(_blocks, "partner bigint, partner_part bigint, block int, words binary")
    blocks = cut.dropDuplicates(["partner", "partner_part", "block"])  # rows may repeat
    # What is gathered for a text are its stretches and at most their blocks.
    met = wants.join(blocks, ["partner", "partner_part", "block"]).groupBy("doc", "part")
    met = met.agg(F.collect_list(F.struct("partner", "partner_part", "block", "words")).alias("met"))
    ranges = found.groupBy("doc", "part").agg(F.collect_list(F.struct("partner", "partner_part", "first", "last")).alias("ranges"))
    own = maybe_in(source, found, ["doc", "part"]).join(ranges, ["doc", "part"]).join(met, ["doc", "part"])
    return own.mapInArrow(
        lambda b: _verified(b, run_words), "doc bigint, part bigint, start int, end int, size int, opens boolean, keeper bigint"
    ).distinct()


def _before(values: np.ndarray) -> np.ndarray:
    """The place of the same value before each place, or -1."""
    order = np.argsort(values, kind="stable")
    same = np.flatnonzero(values[order[1:]] == values[order[:-1]])
    before = np.full(values.size, -1)
    before[order[same + 1]] = order[same]
    return before


class _Partner:
    """Where a partner's shingles lie."""

    def __init__(self, theirs: np.ndarray):
        self.order = np.argsort(theirs, kind="stable")
        self.held = theirs[self.order]
        self.before = _before(theirs)

    def ends(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last place of each value; a last place before the first where there is none."""
        low, high = np.searchsorted(self.held, values), np.searchsorted(self.held, values, "right")
        some = high > low
        first = np.where(some, self.order[np.minimum(low, self.held.size - 1)], self.held.size)
        return first, np.where(some, self.order[high - 1], -1)


def _same_passage(before: np.ndarray, base: int, first: np.ndarray, last: np.ndarray, theirs: _Partner) -> bool:
    """Whether two passages, as shingles, reach the threshold exactly; theirs is cut to what own has of it.

    ``before``, ``first`` and ``last`` are those of the own shingles, which begin at place ``base``.
    A shingle counts once, at its first place in the passage.
    """
    once = before < base
    size, both = np.count_nonzero(once), np.count_nonzero(once & (last >= 0))
    low, high = int(first.min()), int(last.max())
    other = np.count_nonzero(theirs.before[low : high + 1] < low)
    return bool(both * near.SIMILARITY[1] >= (size + other - both) * near.SIMILARITY[0])


def matched(mine: np.ndarray, at: np.ndarray, theirs: np.ndarray, run_words: int, before: np.ndarray | None = None) -> list[list[int]]:
    """Passages [first, end) in words that a partner has too.

    ``mine`` are all shingles of a text, ``at`` the rising places that are looked at, and
    ``theirs`` the partner's shingles around the stretches, in order.
    """
    held = np.sort(theirs)
    near_ = held[np.minimum(np.searchsorted(held, mine[at]), held.size - 1)]
    hit = at[near_ == mine[at]]
    if not hit.size:
        return []
    step = np.diff(hit)
    cut = np.flatnonzero(step > near.SHINGLE)  # words that touch are one run
    starts, ends = hit[np.append(0, cut + 1)].tolist(), hit[np.append(cut, hit.size - 1)].tolist()
    reach = near.SHINGLE + EDIT_WORDS
    if (step[cut] <= reach).any():
        # The partner's places of all that lies in the runs and between those that an edit may part, looked at or not.
        partner, base = _Partner(theirs), int(hit[0])
        gaps = np.flatnonzero((step > 1) & (step <= reach))
        between = hit[gaps][:, None] + np.arange(1, reach)
        known = np.concatenate([hit, between[between < hit[gaps + 1][:, None]]])
        first, last = np.full(hit[-1] - base + 1, theirs.size), np.full(hit[-1] - base + 1, -1)
        first[known - base], last[known - base] = partner.ends(mine[known])
        before = _before(mine) if before is None else before
    joined: list[list[int]] = []
    for a, b in zip(starts, ends, strict=True):
        if joined and a - joined[-1][1] <= EDIT_WORDS:
            low = joined[-1][0]
            if _same_passage(before[low : b + 1], low, first[low - base : b + 1 - base], last[low - base : b + 1 - base], partner):
                joined[-1][1] = b + near.SHINGLE
                continue
        joined.append([a, b + near.SHINGLE])
    return [run for run in joined if run[1] - run[0] >= run_words]


def _verified(batches: Iterator[pa.RecordBatch], run_words: int) -> Iterator[pa.RecordBatch]:
    """Compares the stretches of every text with the partner's words around them."""
    schema = pa.schema([("doc", pa.int64()), ("part", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("size", pa.int32()), ("opens", pa.bool_()), ("keeper", pa.int64())])
    for whole in batches:
        for head in range(0, whole.num_rows, 64):
            batch = whole.slice(head, 64)
            rows = []
            own = zip(batch.column("doc").to_pylist(), batch.column("part").to_pylist(), _tables(batch.column("text").to_pylist()), strict=True)
            spans = _by_partner(batch.column("ranges"), "first", ("first", "last"))
            blocks = _by_partner(batch.column("met"), "block", ("words",))
            for (doc, part, table), span, block in zip(own, spans, blocks, strict=True):
                rows += _passages(doc, part, table, span, block, run_words)
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _by_partner(lists: pa.ListArray, order: str, names: tuple[str, ...]) -> Iterator[dict[tuple[int, int], list]]:
    """Of each list of structs the columns ``names`` of every (partner, partner_part), which rise, sorted by ``order``."""
    flat = lists.flatten()
    sizes = np.asarray(lists.value_lengths())
    partner, part, sort = (np.asarray(flat.field(k)) for k in ("partner", "partner_part", order))
    row = np.repeat(np.arange(sizes.size), sizes)
    sorted_ = np.lexsort((sort, part, partner, row))
    row, partner, part = row[sorted_], partner[sorted_], part[sorted_]
    columns = [flat.field(k).take(pa.array(sorted_)) for k in names]
    columns = [c.to_pylist() if pa.types.is_binary(c.type) else np.asarray(c) for c in columns]
    cut = np.flatnonzero((row[1:] != row[:-1]) | (partner[1:] != partner[:-1]) | (part[1:] != part[:-1])) + 1
    first, after = (np.append(0, cut), np.append(cut, row.size)) if row.size else (cut, cut)
    at = np.searchsorted(row[first], np.arange(sizes.size + 1))
    for i in range(sizes.size):
        groups = range(at[i], at[i + 1])
        yield {(int(partner[first[g]]), int(part[first[g]])): [c[first[g] : after[g]] for c in columns] for g in groups}


def _passages(doc: int, part: int, table: tuple, spans: dict[tuple, list], blocks: dict[tuple, list], run_words: int) -> list[dict]:
    raw, full, low, high = table
    words = _short(full)
    mine = near.shingles_of(words.astype(np.uint64))
    before = _before(mine)
    # The smallest partner of every word, or the document itself where only larger ones have it.
    keeper = np.full(words.size, np.iinfo(np.int64).max)
    for key, (pieces,) in blocks.items():
        theirs = near.shingles_of(np.frombuffer(b"".join(pieces), np.uint32).astype(np.uint64))
        first, last = spans[key]
        opens = np.clip(first.astype(np.int64) - REACH, 0, mine.size)
        closes = np.clip(last.astype(np.int64) + (LABEL_WORDS + REACH - near.SHINGLE + 1), 0, mine.size)
        looked = np.cumsum(np.bincount(opens, minlength=mine.size + 1) - np.bincount(closes, minlength=mine.size + 1))[:-1]
        for a, b in matched(mine, np.flatnonzero(looked), theirs, run_words, before):
            keeper[a:b] = np.minimum(keeper[a:b], min(key[0], doc))
    some = np.iinfo(np.int64).max
    change = np.flatnonzero(np.concatenate([[True], keeper[1:] != keeper[:-1], [True]])) if keeper.size else np.zeros(1, np.int64)
    point = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    out = []
    for a, b in zip(change[:-1].tolist(), change[1:].tolist(), strict=True):
        if keeper[a] != some:
            span = {"start": int(point[low[a]] - 1), "end": int(point[high[b - 1] - 1]), "size": b - a, "opens": bool(a == 0 or keeper[a - 1] == some)}
            out.append({"doc": doc, "part": part, **span, "keeper": int(keeper[a])})
    return out


def digest(docs: DataFrame, spark: SparkSession, run_words: int = RUN_WORDS) -> DataFrame:
    """One row per document with repeated passages."""
    found = repeated(docs, spark, run_words)
    gone = F.col("keeper") != F.col("doc")
    kind = F.when(gone, F.lit("drop")).otherwise(F.lit("keep"))
    span = F.struct("part", "start", F.concat_ws(":", kind, "start", "end").alias("text"))
    # All that is gathered for a document is part of its own text.
    return found.groupBy("doc").agg(
        F.count_if("opens").alias("n_runs"),
        F.count("*").alias("n_repeated"),
        F.count_if(gone).alias("n_removed"),
        F.coalesce(F.sum(F.when(gone, F.col("end") - F.col("start"))), F.lit(0)).alias("removed_chars"),
        F.array_join(F.transform(F.array_sort(F.collect_list(span)), lambda s: s["text"]), ",").alias("spans"),
        F.array_sort(F.collect_set(F.when(gone & (F.col("keeper") != NO_ID), F.col("keeper")))).alias("keepers"),
    ).select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "n_runs", "n_repeated", "n_removed", "removed_chars", "spans", "keepers")
