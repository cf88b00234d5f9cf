"""Benchmark passages in training documents, by a positional inverted index.

1. Words of the benchmark are counted over the whole corpus.
2. Each benchmark window names its rarest words as anchors: two more than the words that a
   proximity match may change. The index stores the postings (word, document, position) of
   anchors and is written out.
3. A posting moved back by its anchor's place in the item is an alignment of item and
   document. A match holds all anchors in its window, its own and its neighbours', but for
   the words it may change. Alignments that fewer support than any window needs are left out.
4. The words of the documents left are laid against the item at these alignments, word
   for word. Runs of equal words as long as a window are exact phrases; windows with
   most words equal at their places are proximity matches, from their first equal word to
   the last one.

Words are runs of digits, a-z after lower-casing A-Z, and everything beyond ASCII. A
window is ``window`` consecutive words of an item; an item of fewer words, but not
none, is one window.

The benchmark's words reach the scanning tasks by broadcast if there are at most
``broadcast_words`` of them (16 bytes each), and by a shuffled join beyond that.

Rows: null texts and texts without words match nothing; a document without words is
not contaminated. Repeated documents each get the same result. Repeated items count
once; items without an id hit words but are neither counted nor listed. Rows of the
same doc_id with other texts are judged by themselves.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wrenchline.llm.common import Stages, id_key

WINDOW = 13
#: Words of a window that are equal at their places in a proximity match.
NEAR = 10
BROADCAST_WORDS = 2_000_000
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _parts(text: Column) -> Column:
    """The words in order; an empty string may come first or last."""
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.split(lower, _GAPS, -1)


def n_words(text: Column) -> Column:
    parts = _parts(text)
    size = F.size(parts)
    first = F.when(F.element_at(parts, 1) == "", 1).otherwise(0)
    last = F.when((size > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
    return (size - first - last).cast("bigint")


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _words(df: DataFrame, *keys: Column) -> DataFrame:
    """One row per word: keys, position, word."""
    # Keys are made before the words are rows, else every word would hash its whole text.
    cut = df.select(*keys, _parts(F.col("text")).alias("_dc_parts"))
    kept = [c for c in cut.columns if c != "_dc_parts"]
    return cut.select(*kept, F.posexplode("_dc_parts").alias("_dc_pos", "_dc_word")).where("_dc_word <> ''")


def document_words(docs: DataFrame) -> DataFrame:
    return _words(docs, id_key().alias("_dc_doc"), _text_key(F.col("text")).alias("_dc_text"))


def _small(df: DataFrame, rows: int, limit: int) -> DataFrame:
    return F.broadcast(df) if rows <= limit else df


def item_words(benchmark: DataFrame) -> DataFrame:
    """One row per word of each distinct item: item number, id, number of words, position, word and its hash.

    To be stored before it is used twice, as the numbers are given where the items lie.
    """
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    items = items.withColumn("_dc_item", F.monotonically_increasing_id())
    words = _words(items, F.col("_dc_item"), F.col("item_id"), n_words(F.col("text")).alias("_dc_size"))
    return words.withColumn("_dc_hash", F.xxhash64("_dc_word"))


def anchors(items: DataFrame, counts: DataFrame, window: int, near: int) -> DataFrame:
    """The rarest places of every window, of which any ``near`` places hold two: item, place, word hash; rarity over the corpus.

    ``_dc_need`` is the least number of an item's anchors that a match of any of its windows holds.
    """
    ranked = items.join(counts, "_dc_hash", "left").fillna(0, ["_dc_count"])
    last = F.greatest(F.col("_dc_first") + F.col("_dc_size") - window, F.col("_dc_first"))
    starts = ranked.withColumn("_dc_first", F.min("_dc_pos").over(Window.partitionBy("_dc_item"))).withColumn(
        "_dc_start",
        F.explode(F.sequence(F.greatest(F.col("_dc_first"), F.col("_dc_pos") - window + 1), F.least(F.col("_dc_pos"), last))),
    )
    order = Window.partitionBy("_dc_item", "_dc_start").orderBy("_dc_count", "_dc_pos")
    rare = starts.withColumn("_dc_rank", F.row_number().over(order)).where(F.col("_dc_rank") <= max(window - near, 0) + 2)
    chosen = rare.select("_dc_item", "_dc_pos", "_dc_hash", "_dc_size").distinct()
    held = starts.join(chosen.select("_dc_item", "_dc_pos"), ["_dc_item", "_dc_pos"]).groupBy("_dc_item", "_dc_start", "_dc_size").agg(F.count("*").alias("_dc_held"))
    changed = F.when(F.col("_dc_size") >= window, max(window - near, 0)).otherwise(0)
    needs = held.groupBy("_dc_item").agg(F.min(F.col("_dc_held") - changed).alias("_dc_need"))
    return chosen.join(needs, "_dc_item").withColumnRenamed("_dc_pos", "_dc_place")


def alignments(docs: DataFrame, benchmark: DataFrame, stages: Stages, window: int, near: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """(item words, candidate alignments): the document position of the item's position 0."""
    items = stages.save(item_words(benchmark), "item-words")
    vocabulary = items.select("_dc_hash").distinct()
    size = vocabulary.count()
    hashed = document_words(docs).withColumn("_dc_hash", F.xxhash64("_dc_word"))
    if size <= limit:
        seen = hashed.join(F.broadcast(vocabulary), "_dc_hash", "left_semi").groupBy("_dc_hash")
        counts = seen.agg(F.count("*").alias("_dc_count"))
    else:  # all words are counted before they meet the vocabulary, so a frequent word is one row per task
        counts = hashed.groupBy("_dc_hash").agg(F.count("*").alias("_dc_count")).join(vocabulary, "_dc_hash", "left_semi")
    chosen = stages.save(anchors(items, counts, window, near), "anchors")
    words = chosen.select("_dc_hash").distinct()
    postings = stages.save(
        hashed.join(_small(words, size, limit), "_dc_hash", "left_semi").select("_dc_hash", "_dc_doc", "_dc_text", "_dc_pos"),
        "postings",
    )
    named = chosen.select("_dc_hash", "_dc_item", "_dc_place")
    moved = postings.join(_small(named, chosen.count(), limit), "_dc_hash").withColumn("_dc_shift", F.expr("_dc_pos - _dc_place"))
    supported = moved.groupBy("_dc_doc", "_dc_text", "_dc_item", "_dc_shift").agg(
        F.min("_dc_place").alias("_dc_low"), F.max("_dc_place").alias("_dc_high"), F.count("*").alias("_dc_held")
    )
    # What an item needs joins the sums, so that the shuffled rows don't carry it.
    needs = chosen.groupBy("_dc_item").agg(F.max("_dc_size").alias("_dc_size"), F.max("_dc_need").alias("_dc_need"))
    enough = supported.join(_small(needs, size, limit), "_dc_item").where("(_dc_low < _dc_high OR _dc_size = 1) AND _dc_held >= _dc_need")
    found = stages.save(enough.select("_dc_doc", "_dc_text", "_dc_item", "_dc_shift"), "alignments")
    stages.drop(postings)
    return items, found


def matches(docs: DataFrame, benchmark: DataFrame, stages: Stages, window: int = WINDOW, near: int = NEAR, limit: int = BROADCAST_WORDS) -> DataFrame:
    """Runs of document words that match an item: document, item, kind ('phrase' or 'near'), first and last position."""
    items, candidates = alignments(docs, benchmark, stages, window, near, limit)
    places = items.select("_dc_item", "item_id", "_dc_size", F.col("_dc_pos").alias("_dc_place"), "_dc_word")
    wanted = candidates.join(places, "_dc_item").withColumn("_dc_pos", F.expr("_dc_shift + _dc_place"))
    # The places of a document that some alignment asks for: no more than it has words, but for those off its ends.
    spots = wanted.groupBy("_dc_doc", "_dc_text").agg(F.collect_set("_dc_pos").alias("_dc_spots"))
    keyed = docs.select("text", id_key().alias("_dc_doc"), _text_key(F.col("text")).alias("_dc_text"))
    suspects = keyed.join(spots, ["_dc_doc", "_dc_text"])
    at = lambda parts: F.transform("_dc_spots", lambda p: F.struct(p.alias("_dc_pos"), F.get(parts, p).alias("_dc_word")))
    # The text is cut once: the outer array holds its words alone.
    cut = F.explode(F.flatten(F.transform(F.array(_parts(F.col("text"))), at)))
    found = suspects.select("_dc_doc", "_dc_text", cut.alias("_dc_at")).select("_dc_doc", "_dc_text", "_dc_at.*").where("_dc_word <> ''")
    equal = wanted.join(found, ["_dc_doc", "_dc_text", "_dc_pos", "_dc_word"], "left_semi")
    # An item is at one place of a document at a time, so a group is at most as long as the item.
    row = Window.partitionBy("_dc_doc", "_dc_text", "_dc_item", "_dc_shift").orderBy("_dc_pos")
    spread = row.rangeBetween(0, window - 1)
    need = F.least("_dc_size", F.lit(window))
    marked = equal.withColumns(
        {
            "_dc_run": F.col("_dc_pos") - F.row_number().over(row),
            "_dc_ahead": F.count("*").over(spread),
            "_dc_end": F.max("_dc_pos").over(spread),
        }
    )
    keys = ["_dc_doc", "_dc_text", "_dc_item", "item_id", "_dc_shift"]
    runs = (
        marked.groupBy(*keys, "_dc_run")
        .agg(F.min("_dc_pos").alias("first"), F.max("_dc_pos").alias("last"), F.first(need).alias("_dc_need"))
        .where("last - first + 1 >= _dc_need")
    )
    close = marked.where((F.col("_dc_ahead") >= near) & (F.col("_dc_size") >= window))
    columns = ["_dc_doc", "_dc_text", "item_id"]
    return runs.select(*columns, F.lit("phrase").alias("kind"), "first", "last").unionByName(
        close.select(*columns, F.lit("near").alias("kind"), F.col("_dc_pos").alias("first"), F.col("_dc_end").alias("last"))
    )


def judged(docs: DataFrame, benchmark: DataFrame, spark: SparkSession, **options) -> DataFrame:
    """``docs`` with n_words, n_hit, n_near, n_items, item_ids and contaminated, as ``_dc_*`` columns."""
    stages = Stages(spark)
    found = stages.save(matches(docs, benchmark, stages, **options), "matches")
    keys = ["_dc_doc", "_dc_text"]
    covered = found.select(*keys, "kind", F.explode(F.sequence("first", "last")).alias("_dc_pos"))
    hits = covered.groupBy(*keys, "_dc_pos").agg(F.max(F.col("kind") == "phrase").alias("_dc_exact"))
    per_doc = hits.groupBy(*keys).agg(
        F.sum(F.col("_dc_exact").cast("bigint")).alias("_dc_n_hit"), F.count("*").alias("_dc_n_near")
    )
    items = found.where("kind = 'phrase'").groupBy(*keys).agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("_dc_items"))
    results = per_doc.join(items, keys, "left")
    joined = docs.withColumns({"_dc_doc": id_key(), "_dc_text": _text_key(F.col("text")), "_dc_n_words": n_words(F.col("text"))})
    out = joined.join(results, keys, "left").drop(*keys)
    none = F.array().cast("array<string>")
    hit = F.coalesce("_dc_n_hit", F.lit(0).cast("bigint"))
    return out.withColumns(
        {
            "_dc_n_hit": hit,
            "_dc_n_near": F.coalesce("_dc_n_near", F.lit(0).cast("bigint")),
            "_dc_items": F.coalesce("_dc_items", none),
            "_dc_contaminated": (hit > 0) & (hit * 20 >= F.col("_dc_n_words")),
        }
    )


def digest_with_near(docs: DataFrame, benchmark: DataFrame, spark: SparkSession, **options) -> DataFrame:
    """The contract's columns, and ``n_near``: words in exact or proximity matches."""
    # Texts are not carried to the result, so only ids, keys and counts are joined.
    return judged(docs.select("doc_id", "text"), benchmark, spark, **options).select(
        "doc_id",
        F.col("_dc_n_words").alias("n_words"),
        F.col("_dc_n_hit").alias("n_hit"),
        F.size("_dc_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("_dc_items", ","), 256).alias("items_sha256"),
        F.col("_dc_contaminated").alias("contaminated"),
        F.col("_dc_n_near").alias("n_near"),
    )


def digest(docs: DataFrame, benchmark: DataFrame, spark: SparkSession) -> DataFrame:
    """The contract's columns, which the query's SQL has too; ``n_near`` is none of them."""
    return digest_with_near(docs, benchmark, spark).drop("n_near")


def clean(docs: DataFrame, benchmark: DataFrame, spark: SparkSession) -> DataFrame:
    """The documents that are not contaminated, with their columns as they are."""
    return judged(docs, benchmark, spark).where(~F.col("_dc_contaminated")).select(*docs.columns)


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), b AS (
  SELECT DISTINCT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
), w AS (
  SELECT DISTINCT item_id, least(len(ws), 13) AS n, array_to_string(ws[s:s + least(len(ws), 13) - 1], ' ') AS phrase
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS s FROM b WHERE len(ws) > 0)
), sizes AS (SELECT DISTINCT n FROM w), starts AS (
  SELECT row_id, ws, unnest(range(1, len(ws) + 1)) AS s FROM d
), grams AS (
  SELECT row_id, s, n, array_to_string(ws[s:s + n - 1], ' ') AS phrase FROM starts, sizes WHERE s + n - 1 <= len(ws)
), found AS (
  SELECT row_id, s, w.n, item_id FROM grams JOIN w ON grams.phrase = w.phrase AND grams.n = w.n
), hit AS (
  SELECT row_id, count(DISTINCT p) AS n_hit FROM (SELECT row_id, unnest(range(s, s + n)) AS p FROM found) GROUP BY row_id
), items AS (
  SELECT row_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM found GROUP BY row_id
)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit USING (row_id) LEFT JOIN items USING (row_id)
"""
