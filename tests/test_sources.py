"""Workbooks, exports, lookups, text records and report sinks."""

import dataclasses
import gzip

import pytest
from helpers import Date, Span, values, write_workbook
from pyspark.sql import functions as F

from wrenchline.config import DEFAULT_CONFIG as CFG
from wrenchline.functions.text import strip
from wrenchline.operators import bonus, lines as line_ops, packages, type_coefficients
from wrenchline.sources import line_tables, lookups, reports, text_records, workbook

HEADER = ["SEQ", "forecast.event_display", "forecast.est_mh", "wph.wpno", "Start_date", "End_date"]


def cells_of(row):
    return {k: (v["kind"], v["text"]) if v else None for k, v in row["cells"].items()}


def test_workbook_cells(spark, tmp_path):
    write_workbook(
        tmp_path / "pack 1+2.xlsx",
        {
            "First": [
                ["a", "b", None, "a"],
                ["text", 2.10, True, 7],
                None,
                ["N/A", "inline:in", False, Date(45292.5)],
                ["error:#DIV/0!", 3.0, Span(1.5), Date(0.25)],
                [None, None, None, None],
            ],
            "Second": [["z"], ["other sheet"]],
        },
    )
    (tmp_path / "notes.txt").write_text("not a workbook")
    sub = tmp_path / "sub"
    sub.mkdir()
    write_workbook(sub / "hidden.xlsx", {"S": [["a"], ["x"]]})
    rows = workbook.read_cells(spark, str(tmp_path)).orderBy("row_no").collect()
    assert {r["workpack_id"] for r in rows} == {"pack 1+2"} and {r["sheet"] for r in rows} == {"First"}
    assert rows[0]["columns"] == ["a", "b", "Unnamed: 2", "a.1"]
    assert [r["row_no"] for r in rows] == [-1, 0, 1, 2, 3]
    assert cells_of(rows[1]) == {"a": ("s", "text"), "b": ("n", "2.1"), "Unnamed: 2": ("b", "True"), "a.1": ("n", "7")}
    assert set(cells_of(rows[2]).values()) == {None}
    assert cells_of(rows[3]) == {"a": None, "b": ("s", "in"), "Unnamed: 2": ("b", "False"), "a.1": ("d", "2024-01-01 12:00:00")}
    assert cells_of(rows[4]) == {"a": None, "b": ("n", "3.0"), "Unnamed: 2": ("d", "1 days 12:00:00"), "a.1": ("d", "06:00:00")}
    both = workbook.read_cells(spark, str(tmp_path), first_sheet_only=False)
    assert sorted(values(workbook.data_rows(both).groupBy("sheet").count())) == [("First", 4), ("Second", 1)]
    listed = workbook.workbook_files(spark, str(tmp_path))
    assert values(listed, "workpack_id") == [("pack 1+2",)]


def test_lines_and_status_from_workbooks(spark, tmp_path):
    write_workbook(
        tmp_path / "good.xlsx",
        {"S": [HEADER, ["2.1", "24-1 (x", 60, "VN1-A06", Date(45292), Date(45294)], [2.2, "24-2 (x", "TBD", None, None, None]]},
    )
    write_workbook(
        tmp_path / "events.xlsx",
        {"S": [[*HEADER[:3], "event", "part.description"], ["2.1", "t", 60, "e1", "n"], ["2.1", "t", 60, "e2", "n"]]},
    )
    write_workbook(tmp_path / "short.xlsx", {"S": [["SEQ", "forecast.est_mh"], ["2.1", 5]]})
    write_workbook(tmp_path / "empty.xlsx", {"S": []})
    (tmp_path / "broken.xlsx").write_bytes(b"no zip file")
    cells = workbook.read_cells(spark, str(tmp_path))
    status = {r["workpack_id"]: r for r in line_tables.ingest_status(cells, CFG).collect()}
    assert {k: v["status"] for k, v in status.items()} == {
        "good": "ok", "events": "ok", "short": "failed", "empty": "failed", "broken": "failed",
    }
    assert status["good"]["rows"] == 2 and "forecast.event_display" in status["short"]["error"]
    lines = line_tables.lines_from_cells(cells, CFG)
    assert {r[0] for r in values(lines, "workpack_id")} == {"good", "events"}
    mhr = line_ops.mhr_rows(lines, CFG)
    assert sorted(values(mhr, "workpack_id", "seq", "base_hours")) == [
        ("events", "2.1", 1.0), ("events", "2.1", 1.0), ("good", "2.1", 1.0), ("good", "2.2", 0.0),
    ]
    headers = {r["workpack_id"]: r for r in packages.package_headers(lines, CFG).collect()}
    assert (headers["good"]["wp_type"], headers["good"]["days"]) == ("A06", 3)
    assert headers["events"]["wp_type"] is None and headers["events"]["days"] is None
    assert values(lines.select("has_tool_columns").distinct()) == [(False,)]


def _csv(path, rows, name="SEQ,forecast.event_display,forecast.est_mh"):
    path.write_text("\n".join([name, *rows]) + "\n")


def test_csv_row_numbers_follow_the_file_over_splits(spark, tmp_path):
    rows = [f"2.{i % 50},title {i},{i}" for i in range(2000)]
    _csv(tmp_path / "big.csv", rows)
    _csv(tmp_path / "small one.csv", ["3.1,t,60"])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = line_tables.read_exports(spark, str(tmp_path), "csv", CFG)
        big = lines.where("workpack_id = 'big'").orderBy("row_no").collect()
        first = line_ops.mhr_rows(lines.where("workpack_id = 'big'"), CFG).collect()
        assert lines.rdd.getNumPartitions() > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r["planned_min"] for r in big] == [str(i) for i in range(2000)]
    assert len({r["row_no"] for r in big}) == 2000
    assert sorted(int(r["planned_min"]) for r in first) == list(range(50))
    assert values(lines.where("workpack_id = 'small one'"), "seq", "planned_min") == [("3.1", "60")]


def test_csv_with_other_columns_fails(spark, tmp_path):
    _csv(tmp_path / "a.csv", ["2.1,t,60"])
    _csv(tmp_path / "b.csv", ["60,t,2.1"], name="forecast.est_mh,forecast.event_display,SEQ")
    with pytest.raises(Exception, match="(?i)header"):
        line_tables.read_exports(spark, str(tmp_path), "csv", CFG).collect()


def test_compressed_csv_parquet_and_json_exports(spark, tmp_path):
    source = spark.createDataFrame(
        [("2.1", "t", 60.0, "x"), ("2.2", "u", None, "y")],
        "SEQ string, `forecast.event_display` string, `forecast.est_mh` double, `wph.wpno` string",
    ).coalesce(1)
    for kind in ("parquet", "json"):
        source.write.format(kind).save(str(tmp_path / kind))
        lines = line_tables.read_exports(spark, str(tmp_path / kind), kind, CFG)
        rows = values(line_ops.with_base_hours(lines).orderBy("row_no"), "seq", "base_hours", "wpno")
        assert rows == [("2.1", 1.0, "x"), ("2.2", 0.0, "y")]
    given = line_tables.read_exports(spark, str(tmp_path / "json"), "json", CFG, source.columns)
    assert sorted(values(given, "seq", "planned_min")) == [("2.1", "60.0"), ("2.2", None)]
    parquet = line_tables.read_exports(spark, str(tmp_path / "parquet"), "parquet", CFG)
    assert sorted(values(parquet, "row_no")) == [(0,), (1,)]
    zipped = tmp_path / "zipped"
    zipped.mkdir()
    with gzip.open(zipped / "a.csv.gz", "wt") as out:
        out.write("SEQ,forecast.event_display,forecast.est_mh\n2.1,x,60\n")
    packed = line_tables.read_exports(spark, str(zipped), "csv", CFG)
    assert values(packed, "workpack_id", "seq", "planned_min") == [("a", "2.1", "60")]
    with pytest.raises(ValueError, match="unknown format"):
        line_tables.read_exports(spark, str(zipped), "xml", CFG)
    missing = tmp_path / "missing"
    missing.mkdir()
    _csv(missing / "a.csv", ["1,2"], name="SEQ,other")
    with pytest.raises(ValueError, match="planned_min"):
        line_tables.read_exports(spark, str(missing), "csv", CFG)


def test_lookups_from_workbooks(spark, tmp_path):
    write_workbook(
        tmp_path / "ids.xlsx",
        {"Task": [["Taskcard Number"], ["24-1"], [None], ["24-1"], [" 24-2"], [25]], "EO": [["EO"], ["EO-1"]], "X": [["EO"], ["EO-9"]]},
    )
    cells = workbook.read_cells(spark, str(tmp_path), "ids.xlsx", first_sheet_only=False)
    assert sorted(values(lookups.reference_from_cells(cells))) == [
        ("eo", "EO-1"), ("task", " 24-2"), ("task", "24-1"), ("task", "25"),
    ]
    write_workbook(tmp_path / "noeo.xlsx", {"Task": [["Other"], ["24-1"]]})
    none = workbook.read_cells(spark, str(tmp_path), "noeo.xlsx", first_sheet_only=False)
    assert values(lookups.reference_from_cells(none)) == []

    write_workbook(tmp_path / "regis.xlsx", {"S": [["Regis", "Type"], ["VN1", "320"], [" VN1 ", "787"]], "T": [["Regis", "Type"], ["VN9", "1"]]})
    cells = workbook.read_cells(spark, str(tmp_path), "regis.xlsx", first_sheet_only=False)
    assert values(packages.registration_table(lookups.registrations_from_cells(cells))) == [("VN1", "787")]

    norm = ["AircraftCode", "ProductCode", "Hours", "Hours2"]
    write_workbook(
        tmp_path / "norms.xlsx",
        {
            "flagged": [[*norm, "IsActive"], ["787", "A06", 1, 2, True], ["787", "A06", 10, None, "TRUE"], ["787", "A06", 20, None, 1], ["787", "A06", 40, None, None], ["787", "A06", 80, None, False]],
            "unflagged": [norm[:3], ["787", "A06", 100]],
            "no keys": [["AircraftCode", "Hours"], ["787", 1000]],
            "no hours": [["AircraftCode", "ProductCode"], ["787", "A06"]],
        },
    )
    rows = lookups.bonus_from_cells(workbook.read_cells(spark, str(tmp_path), "norms.xlsx", first_sheet_only=False))
    assert values(bonus.bonus_table(rows)) == [("A06", "787", 123.0)]
    assert sorted(values(bonus.first_norm_per_sheet(rows), "sheet", "bonus_hours")) == [("flagged", 3.0), ("unflagged", 100.0)]

    coeff = ["AircraftCode", "CheckGroup", "FuncGroup", "Coeff"]
    write_workbook(
        tmp_path / "types.xlsx",
        {
            "one": [[*coeff, "IsActive"], ["787", "A-CHECK", "ENG", 1.5, True], ["787", "A-CHECK", "CAB", 1.2, True]],
            "two": [[*coeff, "IsActive"], ["787", "A-CHECK", "ENG", 1.7, True], ["787", "A-CHECK", "CAB", 9, False]],
            "three": [coeff, ["787", "A-CHECK", "ENG", 5]],
        },
    )
    rows = lookups.type_coefficients_from_cells(workbook.read_cells(spark, str(tmp_path), "types.xlsx", first_sheet_only=False))
    table = type_coefficients.type_coefficient_table(rows)
    assert sorted(values(table, "func_group", "type_coefficient")) == [("CAB", 1.2), ("ENG", 1.7)]
    assert values(lookups.type_coefficients_from_cells(cells)) == []


def test_union_sheets(spark):
    one = spark.createDataFrame([(1, "a")], "x int, y string")
    two = spark.createDataFrame([("b", 2.0)], "y string, z double")
    merged = lookups.union_sheets({"s1": one, "s2": two})
    assert sorted(values(merged, "sheet", "x", "y", "z"), key=str) == [("s1", 1, "a", None), ("s2", None, "b", 2.0)]


def test_ignore_list(spark, tmp_path):
    path = tmp_path / "ignore.txt"
    path.write_text("# comment\n\n  STD-1 \nOil Can\noil can\n\t#also\n", encoding="utf-8")
    assert sorted(values(lookups.ignore_items(spark, str(path)))) == [("oil can",), ("std-1",)]
    assert values(lookups.ignore_items(spark, str(tmp_path / "absent.txt"))) == []


def test_rename_exports(spark):
    df = spark.createDataFrame([("1", "2", "3")], "`wph.wpno` string, SEQ string, extra string")
    assert line_tables.rename_exports(df, CFG).columns == ["wpno", "seq", "extra"]
    own = dataclasses.replace(CFG, columns={"No": "seq"})
    assert line_tables.rename_exports(df.withColumnRenamed("extra", "No"), own).columns == ["wph.wpno", "SEQ", "seq"]


def _records(n, distinct):
    """Question records: every question repeats with other answers."""
    text = []
    for i in range(n):
        text += [f"Question {i % distinct} about valves. (Level {i % distinct % 3 + 1}) ", f"answer {i} ", f"@@right {i}", f" wrong {i}"]
    return text


def test_text_records(spark, tmp_path):
    path = tmp_path / "records.txt"
    path.write_text("\n".join(_records(600, 400)) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        lines = text_records.numbered_lines(spark, str(path))
        numbered = values(lines.orderBy("line_no"), "line_no", "line")
        kept = text_records.keep_first_records(text_records.records(lines)).orderBy("record_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert numbered == list(enumerate(_records(600, 400)))
    assert [r["record_no"] for r in kept] == list(range(400))
    assert kept[7]["question"] == "Question 7 about valves. (Level 2)"
    assert kept[7]["answers"] == ["answer 7", "@@right 7", "wrong 7"]
    levels = spark.createDataFrame([(r["question"],) for r in kept], "q string")
    assert sorted(values(levels.groupBy(text_records.question_level(F.col("q")).alias("level")).count())) == [(1, 134), (2, 133), (3, 133)]
    assert values(levels.where(strip(F.col("q")) != F.col("q"))) == []


def test_write_reports(spark, tmp_path):
    df = spark.range(0, 1000).select((F.col("id") % 40).cast("string").alias("workpack_id"), F.col("id"))
    path = reports.write_report(df, str(tmp_path), "totals", "r1", buckets=4)
    assert spark.read.parquet(path).count() == 1000
    reports.write_report(df, str(tmp_path), "totals", "r2", buckets=4)
    again = reports.write_report(df.where("id < 100"), str(tmp_path), "totals", "r1", buckets=2)
    back = spark.read.parquet(again)
    assert back.count() == 100 and {r[0] for r in values(back.select("package_bucket").distinct())} <= {0, 1}
    assert spark.read.parquet(str(tmp_path / "totals")).where("run = 'r2'").count() == 1000
    one_bucket = back.groupBy("workpack_id").agg(F.count_distinct("package_bucket").alias("n")).where("n > 1")
    assert one_bucket.count() == 0
    nested = df.withColumn("row_no", F.struct("id"))
    csv = reports.write_report(nested, str(tmp_path), "text", "r1", file_format="csv")
    assert spark.read.option("header", True).csv(csv).count() == 1000


@pytest.mark.parametrize("kind", ["json", "parquet"])
def test_export_status_keeps_packages_with_empty_required_columns(spark, tmp_path, kind):
    names = {"seq": "SEQ", "title": "forecast.event_display", "planned_min": "forecast.est_mh"}
    columns = [f"`{n}` string" for n in names.values()]
    for package, empty in (("full", ()), ("seqless", (0,)), ("idle [1]", (2,)), ("blank", (0, 1, 2))):
        rows = [tuple(None if i in empty else v for i, v in enumerate(("2.1", "t", "60"))) for _ in range(2)]
        frame = spark.createDataFrame(rows, ", ".join(columns)).coalesce(1)
        frame.write.format(kind).option("ignoreNullFields", False).save(str(tmp_path / "out" / package))
    spark.createDataFrame([("2.1", "t")], ", ".join(columns[:2])).coalesce(1).write.format(kind).save(str(tmp_path / "out" / "short"))
    source = tmp_path / "in"
    source.mkdir()
    for part in (tmp_path / "out").glob(f"*/part-*.{'json' if kind == 'json' else 'parquet'}"):
        (source / f"{part.parent.name}.{kind}").write_bytes(part.read_bytes())
    lines = line_tables.read_exports(spark, str(source), kind, CFG)
    status = line_tables.export_status(spark, str(source), kind, lines, CFG)
    assert {r.workpack_id: (r.status, r.rows, r.error) for r in status.collect()} == {
        **{p: ("ok", 2, None) for p in ("full", "seqless", "idle [1]", "blank")},
        "short": ("failed", 1, "Missing required columns: forecast.est_mh"),
    }
    assert sorted(values(line_ops.with_base_hours(lines), "workpack_id", "base_hours"))[:2] == [("blank", 0.0)] * 2
