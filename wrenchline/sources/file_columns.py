"""What every export file says of itself: columns, types, rows, and whether it can be read.

One row per file, found in tasks. Csv heads and Parquet footers are opened where
the task runs, so only they are read; keys of json lines come from one pass over
the text with partial aggregation. The result joins to lines by ``file``.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wrenchline.functions.text import SPACE
from wrenchline.sources import workbook

COLUMNS = "columns array<struct<name: string, type: string>>"
#: Prefix of the type of a column that Spark cannot read.
UNREADABLE = "unreadable "
#: A csv head that doesn't end within so many bytes is none.
LONGEST_HEAD = 1 << 20
_FOUND = pa.schema(
    [
        ("file", pa.string()),
        ("columns", pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())]))),
        ("head", pa.string()),
        ("rows", pa.int64()),
        ("error", pa.string()),
    ]
)


def glob(file_format: str) -> str:
    return f"*.{file_format}*"


def package_of(file: Column, per: str) -> Column:
    """The package a file belongs to: its own name, or with ``folder`` that of its folder (``key=`` left out)."""
    if per == "file":
        return workbook.file_stem(file)
    name = F.regexp_replace(F.element_at(F.split(file, "/"), -2), "^[^=]*=", "")
    return F.url_decode(F.regexp_replace(name, r"\+", "%2B"))


def reader(spark: SparkSession, file_format: str, per: str = "file"):
    if per not in ("file", "folder"):
        raise ValueError("a package is a 'file' or a 'folder'")
    return spark.read.option("pathGlobFilter", glob(file_format)).option("recursiveFileLookup", per == "folder")


def listed(spark: SparkSession, folder: str | list[str], file_format: str, per: str = "file") -> DataFrame:
    """(file, path) of all files; contents are not read."""
    files = reader(spark, file_format, per).format("binaryFile").load(folder)
    return files.select(F.col("_metadata.file_path").alias("file"), "path")


def text_lines(spark: SparkSession, folder: str | list[str], file_format: str, per: str = "file") -> DataFrame:
    """Lines that aren't blank: file, split, place in the task that reads it, value."""
    lines = reader(spark, file_format, per).text(folder)
    value = F.col("value")
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("place"),
        F.when(F.startswith(value, F.lit("\ufeff")), F.substr(value, F.lit(2))).otherwise(value).alias("value"),
    ).where(F.rlike("value", F.lit(f"[^{SPACE}]")))


def _opened(file: str, path: str):
    """File system and place; ``file`` is the escaped form of ``path``."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(file.replace("s3a://", "s3://", 1))


def csv_head(stream) -> str | None:
    """First line that isn't blank; null for a file without lines."""
    read = b""
    while len(read) <= LONGEST_HEAD:
        more = stream.read(1 << 16)
        read += more
        lines = read.replace(b"\r\n", b"\n").replace(b"\r", b"\n").split(b"\n")
        complete = lines[:-1] if more else lines
        texts = (line.decode("utf-8", "replace").removeprefix("\ufeff") for line in complete)
        found = next((t for t in texts if t.strip()), None)
        if found is not None or not more:
            return found
    raise ValueError(f"no head within {LONGEST_HEAD} bytes")


def _type_text(kind: pa.DataType) -> str:
    from pyspark.errors import PySparkException
    from pyspark.sql.pandas.types import from_arrow_type

    if pa.types.is_timestamp(kind) and kind.unit == "ns":
        return UNREADABLE + str(kind)
    try:
        return from_arrow_type(kind, prefer_timestamp_ntz=True).simpleString()
    except PySparkException:
        return UNREADABLE + str(kind)


def _looked_into(file_format: str):
    def columns_of(system, path: str) -> dict:
        if file_format == "csv":
            with system.open_input_stream(path, compression="detect") as stream:
                head = csv_head(stream)
            names = next(csv.reader([head])) if head is not None else []
            return {"columns": [{"name": n, "type": "string"} for n in names], "head": head, "rows": None}
        import pyarrow.parquet as pq

        with system.open_input_file(path) as stream:
            footer = pq.ParquetFile(stream).metadata
            schema = footer.schema.to_arrow_schema()
        return {"columns": [{"name": f.name, "type": _type_text(f.type)} for f in schema], "head": None, "rows": footer.num_rows}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for file, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                system, place = _opened(file, path)  # an unknown kind of storage ends the job
                try:
                    found.append({"file": file, "error": None} | columns_of(system, place))
                except (pa.ArrowException, OSError, ValueError, csv.Error) as problem:
                    text = f"{type(problem).__name__}: {str(problem)[:200]}"
                    found.append({"file": file, "columns": [], "head": None, "rows": None, "error": text})
            yield pa.RecordBatch.from_pylist(found, schema=_FOUND)

    return run


def _json_columns(spark: SparkSession, folder: str | list[str], names: Sequence[str] | None, per: str) -> DataFrame:
    lines = text_lines(spark, folder, "json", per).select("file", F.json_object_keys("value").alias("keys"))
    # A line that is no object has no keys, not even none.
    broken = F.nullif(F.count_if(F.col("keys").isNull()), F.lit(0))
    if names is None:
        pairs = lines.select("file", F.explode(F.coalesce("keys", F.array(F.lit(None).cast("string")))).alias("name"))
        counts = pairs.groupBy("file", "name").agg(F.count("*").alias("n"))
        listed_ = F.collect_list(F.when(F.col("name").isNotNull(), F.struct("name", F.lit("string").alias("type"))))
        broken = F.max(F.when(F.col("name").isNull(), F.col("n")))
    else:  # one flag a name spares a row for each key of each line
        counts = lines
        found = [F.when(F.max(F.array_contains("keys", n)), F.struct(F.lit(n).alias("name"), F.lit("string").alias("type"))) for n in names]
        listed_ = F.array_compact(F.array(*found))
    return counts.groupBy("file").agg(
        F.sort_array(listed_).cast(COLUMNS.split(" ", 1)[1]).alias("columns"),
        F.lit(None).cast("string").alias("head"),
        F.lit(None).cast("bigint").alias("rows"),
        F.concat(broken.cast("string"), F.lit(" lines that are no JSON objects")).alias("error"),
    )


def file_columns(
    spark: SparkSession, folder: str | list[str], file_format: str, names: Sequence[str] | None = None, per: str = "file"
) -> DataFrame:
    """(file, workpack_id, columns, head, rows, error) of every file of a folder.

    ``columns`` are the names and types in the file, in its order (json: all keys of
    its lines, sorted; with ``names`` only those). ``head`` is the first line of a csv
    file, ``rows`` the number of rows where the file tells it, ``error`` why a file
    cannot be read. A json file without lines has no columns.
    """
    files = listed(spark, folder, file_format, per)
    if file_format == "json":
        found = files.select("file").join(_json_columns(spark, folder, names, per), "file", "left")
        found = found.withColumn("columns", F.coalesce("columns", F.array().cast(COLUMNS.split(" ", 1)[1])))
    elif file_format in ("csv", "parquet"):
        found = files.mapInArrow(_looked_into(file_format), f"file string, {COLUMNS}, head string, rows bigint, error string")
    else:
        raise ValueError(f"unknown format {file_format!r}")
    return found.withColumn("workpack_id", package_of(F.col("file"), per))


def names() -> Column:
    return F.transform("columns", lambda c: c["name"])


def has_column(name: str) -> Column:
    """Whether a file has a column, with values or not."""
    return F.exists("columns", lambda c: c["name"] == name)


def missing_columns(required: Sequence[str]) -> Column:
    """Required columns that a file lacks, in the order given."""
    return F.array_except(F.array(*[F.lit(n) for n in required]), names())


def column_table(files: DataFrame) -> DataFrame:
    """One row per file and column: file, workpack_id, place, name, type, rows."""
    return files.select("file", "workpack_id", F.posexplode("columns").alias("place", "column"), "rows").select(
        "file", "workpack_id", "place", "column.name", "column.type", "rows"
    )
