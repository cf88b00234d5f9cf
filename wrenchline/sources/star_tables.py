"""Lines and lookups of the model, read from order / line / part tables.

An order's customer stands for the work package. Only the columns a query asks
for are read; the part table is joined only for the columns that come from it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wrenchline.operators.new_tasks import reference_ids

# Order of the lines inside a package.
ROW_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")

# Columns that need the part table.
_FROM_PART = {"title", "func_group", "tool_name"}


def _pick(key: Column, *names: str) -> Column:
    """One of the names, by the key's remainder."""
    position = (key % len(names) + 1).cast("int")
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)


def _line_columns() -> dict[str, Column]:
    col, lit, when = F.col, F.lit, F.when
    text = lambda c: col(c).cast("string")
    part = col("l_partkey")
    number = (part % 500).cast("string")
    package_type = _pick(col("o_custkey"), "A06", "C12", "Y01", "A12", "Z99")
    slash_title = F.concat(
        when(part % 4 == 0, "EO-").otherwise("TC-"), number, lit(" / "), col("p_name")
    )
    return {
        "wpno": F.concat(lit("VN"), text("o_custkey"), lit("-X-"), package_type),
        "seq": when(
            part % 37 != 0,
            F.concat(text("l_linenumber"), lit("."), (col("l_orderkey") % 20).cast("string")),
        ),
        "title": when(part % 53 == 0, None)
        .when(col("l_linenumber") == 4, slash_title)
        .when(part % 50 == 7, F.concat(lit("VNA-"), number, lit(" (00) - "), col("p_name")))
        .otherwise(F.concat(lit("24-"), number, lit(" ("), text("p_size"), lit(") - "), col("p_name"))),
        "planned_min": when(part % 43 == 0, None)
        .when(part % 41 == 0, "TBD")
        .otherwise((col("l_quantity") * 30).cast("int").cast("string")),
        "special_code": when(
            col("l_returnflag") != "R", F.concat(col("l_returnflag"), col("l_linestatus"))
        ),
        "func_group": col("p_type"),
        "tool_name": col("p_name"),
        "part_no": when(part % 29 == 0, "").otherwise(F.concat(lit("STD-"), text("l_partkey"))),
        "tool_flag": when(part % 31 == 0, None)
        .when(part % 23 == 0, "X")
        .when(col("l_linestatus") == "O", "Y")
        .otherwise("N"),
        "total_qty": when(part % 47 == 0, "bad").otherwise((part % 5).cast("string")),
        "alt_qty": when(part % 2 != 0, (part % 3).cast("string")),
        "percentage": when(part % 3 == 0, col("l_discount")),
        "start_date": col("o_orderdate"),
        "end_date": col("l_shipdate"),
    }


LINE_COLUMNS = tuple(
    "wpno seq title planned_min special_code func_group tool_name part_no tool_flag "
    "total_qty alt_qty start_date end_date".split()
)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def lines(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """``workpack_id``, ``row_no`` and the given columns (all when none is given).

    ``row_no`` is the order key itself, not a running number: numbering would
    pull a whole package into one task.
    """
    wanted = columns or LINE_COLUMNS
    rows = read(spark, folder, "lineitem").join(
        read(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    if _FROM_PART.intersection(wanted):
        rows = rows.join(read(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"), "left")
    expressions = _line_columns()
    return rows.select(
        F.col("o_custkey").alias("workpack_id"),
        F.struct(*ROW_ORDER).alias("row_no"),
        *[expressions[c].alias(c) for c in wanted],
    )


def with_part(rows: DataFrame, spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Rows of ``lines`` with columns that come from the part table.

    The key of the part is in ``row_no``, so the join can wait until few rows are left.
    """
    part = read(spark, folder, "part").select("p_partkey", "p_name", "p_size", "p_type")
    keys = {k: F.col(f"row_no.{k}") for k in ("l_partkey", "l_linenumber")}
    joined = rows.withColumns(keys).join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    expressions = _line_columns()
    return joined.select(*rows.columns, *[expressions[c].alias(c) for c in columns])


def row_columns() -> list[Column]:
    """The parts of ``row_no`` as plain columns."""
    return [F.col(f"row_no.{c}").alias(c) for c in ROW_ORDER]


def _aircraft(last: str) -> Column:
    return _pick(F.col("p_partkey"), "MACHINERY", "BUILDING", "AUTOMOBILE", "FURNITURE", last)


def registrations(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read(spark, folder, "customer")
        .where("c_custkey % 11 <> 0")
        .selectExpr("concat('VN', c_custkey) AS regis", "c_mktsegment AS ac_type", "c_custkey AS row_no")
    )


def bonus_rows(spark: SparkSession, folder: str) -> DataFrame:
    part = F.col("p_partkey")
    product = _pick(part, "A06", "C12", "Y01", "A12", "none", "B01", "B01")
    return read(spark, folder, "part").select(
        F.col("p_brand").alias("sheet"),
        part.alias("row_no"),
        _aircraft(" HOUSEHOLD ").alias("aircraft_code"),
        product.alias("product_code"),
        (F.col("p_size") / 4.0).cast("double").alias("hours"),
        F.when(part % 2 != 0, F.lit(0.5)).alias("hours2"),
        (part % 3 != 0).alias("is_active"),
    )


def type_coefficient_rows(spark: SparkSession, folder: str) -> DataFrame:
    part = F.col("p_partkey")
    group = _pick(part, "A-CHECK", "C-CHECK", "Y-CHECK")
    return read(spark, folder, "part").select(
        part.alias("row_no"),
        _aircraft("HOUSEHOLD").alias("aircraft_code"),
        group.alias("check_group"),
        F.col("p_type").alias("func_group"),
        (F.lit(1.0) + F.col("p_size") / F.lit(100.0)).alias("coeff"),
        (part % 4 != 0).alias("is_active"),
    )


def reference(spark: SparkSession, folder: str) -> DataFrame:
    """Known task and EO IDs as (kind, id)."""
    part = read(spark, folder, "part").select((F.col("p_partkey") % 500).alias("n"))
    known = lambda prefix, rule: part.where(rule).selectExpr(f"concat('{prefix}', n) AS id")
    tasks = known("24-", "n % 3 <> 0").unionByName(known("TC-", "n % 5 <> 0"))
    return reference_ids(tasks, known("EO-", "n % 4 = 0 AND n % 8 <> 0"))


def ignore_items(spark: SparkSession, folder: str) -> DataFrame:
    part = read(spark, folder, "part")
    names = part.where("p_name LIKE '%anvil'").selectExpr("lower(p_name) AS item")
    numbers = part.where("p_partkey % 70 = 0").selectExpr("concat('std-', p_partkey) AS item")
    return names.unionByName(numbers).distinct()


def sites(spark: SparkSession, folder: str) -> DataFrame:
    """(workpack_id, site): the nation of the customer."""
    nation = read(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("site"))
    customer = read(spark, folder, "customer").select(F.col("c_custkey").alias("workpack_id"), "c_nationkey")
    return customer.join(nation, "c_nationkey", "left").select("workpack_id", "site")


def site_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rules of single sites: other modes, unchecked lines, other coefficients."""
    key = F.col("n_nationkey")
    none = F.lit(None).cast("string")
    rows = [
        (1, none, "4", F.lit("keep"), F.lit(1.0) + key / F.lit(100.0)),
        (2, F.lit("mhr"), "3", F.lit("ignore"), F.lit(None).cast("double")),
        (3, none, "5", F.lit("true"), F.lit(3.0)),
        (3, none, "99", F.lit("true"), key + F.lit(0.5)),
    ]
    nation = read(spark, folder, "nation")
    frames = [
        nation.where(key % 5 == rest).select(
            F.col("n_name").alias("site"), sheet.alias("sheet"), F.lit(prefix).alias("prefix"), mode.alias("mode"),
            none.alias("id_method"), coefficient.cast("double").alias("coefficient"),
        )
        for rest, sheet, prefix, mode, coefficient in rows
    ]
    return reduce(lambda a, b: a.unionByName(b), frames)
