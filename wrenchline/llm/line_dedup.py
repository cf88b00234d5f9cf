"""Lines that many documents share are kept in one of them only.

Texts are cut once into a staged table of line hashes. It is range-partitioned with
the document as a further key, so that a line of a third of all documents spreads
over tasks, and sorted by document and position. Each task streams its stretch, keeps
the first occurrence of a line in each document, and counts these per line before
anything is exchanged again. What comes back to the documents is their keep bitmap,
compressed as runs of kept lines, and no text.

Rows: a null text is an empty one, and an empty text is one empty line. Rows that
repeat a doc_id are one document for the count and all follow its decisions; rows
without a doc_id are one document, smaller than all others. Very long texts give as many
hashes as they have lines, in any number of tasks. Further columns of the
input are passed on by ``kept_documents`` and may have any name but ``_ld_*``.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wrenchline.llm.common import Stages, id_key

BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """A line without outer blanks and with A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _keys() -> list[Column]:
    text = F.coalesce(F.col("text"), F.lit(""))
    return [id_key().alias("_ld_id"), F.xxhash64(text).alias("_ld_text")]


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per line whose key is long enough: 128 hash bits, document, position."""
    # The text's own hash is made before its lines are rows, else every line would hash the whole text.
    cut = docs.select(*_keys(), split_lines(F.col("text")).alias("_ld_lines"))
    lines = cut.select("_ld_id", "_ld_text", F.posexplode("_ld_lines").alias("_ld_pos", "_ld_line"))
    keyed = lines.withColumn("_ld_key", line_key(F.col("_ld_line"))).where(F.length("_ld_key") >= min_chars)
    return keyed.select(
        F.xxhash64("_ld_key").alias("_ld_h1"),
        F.xxhash64(F.lit("second"), "_ld_key").alias("_ld_h2"),
        "_ld_id", "_ld_text", "_ld_pos",
    )


def first_occurrences(hashes: DataFrame) -> DataFrame:
    """The first place of every line in every document, streamed from sorted ranges of hashes."""
    ranged = hashes.repartitionByRange("_ld_h1", "_ld_h2", "_ld_id")
    places = Window.partitionBy("_ld_h1", "_ld_h2", "_ld_id").orderBy("_ld_pos", "_ld_text")
    return ranged.withColumn("_ld_nth", F.row_number().over(places)).where("_ld_nth = 1")


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Per document that loses lines: ``dropped`` positions, ascending; staged."""
    stages = Stages(docs.sparkSession)
    hashes = stages.save(line_hashes(docs, min_chars), "line-hashes")
    shared = (
        first_occurrences(hashes)
        .groupBy("_ld_h1", "_ld_h2")
        .agg(F.count("*").alias("_ld_docs"), F.max("_ld_id").alias("_ld_keeper"))
        .where(F.col("_ld_docs") >= min_docs)
        .select("_ld_h1", "_ld_h2", "_ld_keeper")
    )
    dropped = hashes.join(shared, ["_ld_h1", "_ld_h2"]).where("_ld_id < _ld_keeper")
    bitmaps = stages.save(dropped.groupBy("_ld_id", "_ld_text").agg(F.array_sort(F.collect_set("_ld_pos")).alias("_ld_dropped")), "bitmaps")
    stages.drop(hashes)
    return bitmaps


def _runs(dropped: Column, n_lines: Column) -> Column:
    """Runs of kept lines between the dropped positions: the bitmap, run-length coded."""
    starts = F.concat(F.array(F.lit(0)), F.transform(dropped, lambda x: x + 1))
    ends = F.concat(dropped, F.array(n_lines))
    runs = F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("start"), (e - s).alias("length")))
    return F.filter(runs, lambda r: r["length"] > 0)


def kept_documents(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with ``_ld_n_lines``, ``_ld_n_dropped``, ``_ld_keep_runs`` and the kept text ``_ld_kept``."""
    keyed = docs.withColumns({"_ld_id": _keys()[0], "_ld_text": _keys()[1]})
    bitmaps = keep_bitmaps(docs, min_chars, min_docs)
    joined = keyed.join(bitmaps, ["_ld_id", "_ld_text"], "left")
    lines = split_lines(F.col("text"))
    n_lines = F.size(lines)
    runs = _runs(F.coalesce("_ld_dropped", F.array().cast("array<int>")), n_lines)
    kept = F.flatten(F.transform(F.col("_ld_keep_runs"), lambda r: F.slice(lines, r["start"] + 1, r["length"])))
    return (
        joined.withColumns(
            {
                "_ld_n_lines": n_lines.cast("bigint"),
                "_ld_n_dropped": F.coalesce(F.size("_ld_dropped"), F.lit(0)).cast("bigint"),
                "_ld_keep_runs": runs,
            }
        )
        .withColumn(
            "_ld_kept",
            F.when(F.col("_ld_dropped").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(kept, "\n")),
        )
        .drop("_ld_id", "_ld_text", "_ld_dropped")
    )


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns, and the keep bitmap: runs of kept lines as first:number, comma-joined."""
    return kept_documents(docs.select("doc_id", "text")).select(
        "doc_id",
        F.col("_ld_n_lines").alias("n_lines"),
        F.col("_ld_n_dropped").alias("n_dropped"),
        F.sha2("_ld_kept", 256).alias("kept_sha256"),
        F.array_join(F.transform("_ld_keep_runs", lambda r: F.concat(r["start"].cast("string"), F.lit(":"), r["length"].cast("string"))), ",").alias("keep_runs"),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents with their kept lines as text; ``n_chars`` follows where it is there.

    A text that loses nothing stays as it is, null included.
    """
    columns = docs.columns
    out = kept_documents(docs).withColumn("text", F.when(F.col("_ld_n_dropped") == 0, F.col("text")).otherwise(F.col("_ld_kept")))
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("_ld_n_dropped") == 0, F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return out.select(*columns)


ORACLE = r"""
WITH lines AS (
  SELECT row_id, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos
  FROM (SELECT row_number() OVER () AS row_id, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), shared AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT keyed.*, coalesce(keeper <> doc_id, false) AS gone FROM keyed LEFT JOIN shared USING (k)
), runs AS (
  SELECT row_id, min(pos) - 1 AS start, count(*) AS n
  FROM (SELECT row_id, pos, pos - row_number() OVER (PARTITION BY row_id ORDER BY pos) AS stretch FROM marked WHERE NOT gone)
  GROUP BY row_id, stretch
), bitmaps AS (
  SELECT row_id, string_agg(start::VARCHAR || ':' || n::VARCHAR, ',' ORDER BY start) AS keep_runs FROM runs GROUP BY row_id
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256,
       coalesce(any_value(keep_runs), '') AS keep_runs
FROM marked LEFT JOIN bitmaps USING (row_id) GROUP BY row_id
"""
