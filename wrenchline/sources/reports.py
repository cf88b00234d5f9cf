"""Report datasets on storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKET = "package_bucket"


def package_bucket(buckets: int):
    return F.pmod(F.xxhash64(F.col("workpack_id")), F.lit(buckets)).cast("int").alias(BUCKET)


def write_report(
    df: DataFrame, folder: str, dataset: str, run_id: str, buckets: int = 16, file_format: str = "parquet"
) -> str:
    """One dataset of one run, partitioned by a bucket of the package key.

    A run has a folder of its own and writing it again replaces just that. The
    rebalance hint evens out the files: a package with a large share of the rows
    is split over several, small buckets are merged.
    """
    path = f"{folder}/{dataset}/run={run_id}"
    if file_format == "csv":  # no nested values in csv
        nested = [f.name for f in df.schema if isinstance(f.dataType, StructType)]
        df = df.withColumns({name: F.to_json(name) for name in nested})
    out = df.select("*", package_bucket(buckets)).hint("rebalance", BUCKET)
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(BUCKET)
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.format(file_format).save(path)
    return path


def buckets_of(packages: DataFrame, buckets: int) -> list[int]:
    """Buckets of the given packages (workpack_id); at most ``buckets`` numbers."""
    return sorted(r[0] for r in packages.select(package_bucket(buckets)).distinct().collect())


def read_packages(spark: SparkSession, path: str, packages: DataFrame, buckets: int, schema: StructType | None = None) -> DataFrame:
    """Rows of some packages (workpack_id) of a written dataset; other buckets are not read.

    ``buckets`` is the number the dataset was written with.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    rows = reader.parquet(path).where(F.col(BUCKET).isin(buckets_of(packages, buckets)))
    return rows.join(packages.select("workpack_id").distinct(), "workpack_id", "left_semi")


def replace_packages(df: DataFrame, path: str, buckets: int) -> list[int]:
    """Put the rows of ``df`` in place of all rows of its packages in a dataset that ``write_report`` wrote.

    Only the buckets of these packages are written, by dynamic partition overwrite;
    the other packages of those buckets are carried over, all other files stay as they
    are. Returns the buckets. Repeating it gives the same dataset.
    """
    spark = df.sparkSession
    packages = df.select("workpack_id").distinct()
    touched = buckets_of(packages, buckets)
    if not touched:
        return []
    old = spark.read.parquet(path).where(F.col(BUCKET).isin(touched))
    carried = old.join(packages, "workpack_id", "left_anti")
    merged = carried.unionByName(df.select("*", package_bucket(buckets))).hint("rebalance", BUCKET)
    writer = merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET)
    writer.parquet(path)
    return touched


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """What a written dataset holds: (package_bucket, files, rows, packages, content), read back from storage.

    ``content`` is a sum of row hashes, which doesn't depend on order or files.
    """
    rows = spark.read.parquet(path)
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]).cast("decimal(38,0)")
    return rows.select(BUCKET, "workpack_id", F.col("_metadata.file_path").alias("file"), hashed.alias("hash")).groupBy(BUCKET).agg(
        F.count_distinct("file").alias("files"),
        F.count("*").alias("rows"),
        F.count_distinct("workpack_id").alias("packages"),
        F.sum("hash").alias("content"),
    )


def write_reports(
    reports: dict[str, DataFrame], folder: str, run_id: str, buckets: int = 16, file_format: str = "parquet"
) -> dict[str, str]:
    return {
        name: write_report(df, folder, name, run_id, buckets, file_format) for name, df in reports.items()
    }
