"""Reading tables, staging intermediate results, and keys that survive odd rows."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a document without an id where ids are compared; smaller than all others.
NO_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_key(column: str = "doc_id") -> Column:
    """The id with null as the smallest, so that joins and orders need no null rules."""
    return F.coalesce(F.col(column).cast("bigint"), F.lit(NO_ID))


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; a temporary one in local mode without that setting."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="wrenchline-stage-")
    return f"{base.rstrip('/')}/stage-{uuid.uuid4().hex}"


#: Words of 64 bits in the table of ``maybe_in``; it never has more rows than that.
FILTER_WORDS = 1 << 20


def maybe_in(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys may be among the wanted ones; no wanted row is lost, others pass now and then.

    Each wanted key sets one bit of a table of at most ``FILTER_WORDS`` words, which is
    small enough to broadcast whatever the tables' sizes. It spares a join the shuffle
    of rows that cannot match; the join itself must still follow. With very many wanted
    keys all rows pass.
    """
    hashed = F.xxhash64(*keys)
    word = F.pmod(hashed, F.lit(FILTER_WORDS)).cast("int").alias("_maybe_word")
    bit = F.shiftrightunsigned(hashed, 32).bitwiseAND(F.lit(63)).cast("int").alias("_maybe_bit")
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), "_maybe_bit")
    table_ = wanted.select(word, bit).groupBy("_maybe_word").agg(F.bit_or(one).alias("_maybe_bits"))
    found = rows.select("*", word, bit).join(F.broadcast(table_), "_maybe_word")
    return found.where(F.getbit("_maybe_bits", F.col("_maybe_bit")) == 1).select(*[f"`{c}`" for c in rows.columns])


class Stages:
    """Intermediate tables as Parquet in the shared folder.

    A staged table cuts the lineage and outlives any executor. Tables that a
    later one replaces can be dropped; the rest stay as long as the folder does,
    since returned frames still read them.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = shared_folder(spark)
        self.count = 0

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self.count += 1
        path = f"{self.folder}/{self.count:03d}-{name}"
        df.write.parquet(path)
        staged = self.spark.read.schema(df.schema).parquet(path)
        staged.staged_path = path
        return staged

    def drop(self, df: DataFrame) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(df.staged_path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
