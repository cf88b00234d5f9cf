"""Text files of four-line question records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wrenchline.functions.text import strip
from wrenchline.operators.keep_first import keep_first

LINES_PER_RECORD = 4


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line) with exact line numbers, files split as usual.

    Every split counts its lines; the running sum over the splits of a file (one
    row per split, not per line) gives the number of its first line.
    """
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("id"),
        F.col("value").alias("line"),
    )
    splits = raw.groupBy("file", "split").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    numbered = raw.join(starts, ["file", "split"])
    line_no = F.col("start") + F.col("id") - F.col("first_id")
    return numbered.select("file", line_no.alias("line_no"), "line")


def records(lines: DataFrame) -> DataFrame:
    """(file, record_no, question, answers) of every four lines, trimmed."""
    place = F.col("line_no") % LINES_PER_RECORD
    record = F.floor(F.col("line_no") / LINES_PER_RECORD).alias("record_no")
    line = strip(F.col("line"))
    parts = [F.max(F.when(place == i, line)).alias(f"p{i}") for i in range(LINES_PER_RECORD)]
    answers = F.array(*[F.col(f"p{i}") for i in range(1, LINES_PER_RECORD)])
    return (
        lines.groupBy("file", record)
        .agg(*parts)
        .select("file", "record_no", F.col("p0").alias("question"), answers.alias("answers"))
    )


def records_of_texts(texts: DataFrame, key: str, text: str, lines_per_record: int = LINES_PER_RECORD) -> DataFrame:
    """(key, record_no, question, answers, complete) of whole texts held in a column.

    Lines are trimmed. Record n has the lines n * k to n * k + k - 1 of its own text
    and never runs into the next one: a record cut at the end of its text has fewer
    answers and isn't ``complete``. A line end that closes the text opens no line; a
    null or empty text has no record. Texts are cut where they are, without a shuffle.
    """
    k = lines_per_record
    body = F.regexp_replace(F.col(text), "\\r?\\n\\z", "")
    lines = F.transform(F.split(body, "\\r?\\n"), strip)
    found = texts.where(F.length(text) > 0).select(F.col(key), lines.alias("_lines"))
    starts = F.sequence(F.lit(1), F.size("_lines"), F.lit(k))
    cut = F.transform(starts, lambda i: F.slice("_lines", i, k))
    rows = found.select(key, F.posexplode(cut).alias("record_no", "_record"))
    return rows.select(
        key,
        F.col("record_no").cast("bigint").alias("record_no"),
        F.element_at("_record", 1).alias("question"),
        F.slice("_record", 2, k).alias("answers"),
        (F.size("_record") == k).alias("complete"),
    )


def keep_first_records(recs: DataFrame, key: str = "file") -> DataFrame:
    """First record of every question; repeats with other answers are dropped too."""
    return keep_first(recs, ["question"], F.struct(key, "record_no"))


def question_level(question):
    """Number in the closing "(Level n)" of a question."""
    return F.regexp_extract(question, r"\(Level (\d+)\)$", 1).try_cast("int")
