"""The batch job from workbooks to report datasets."""

import dataclasses

import pandas as pd
import pytest
from helpers import Date, values, write_workbook

from wrenchline.config import DEFAULT_CONFIG as CFG
from wrenchline.plans.batch import BatchPaths, run_batch, work_folder
from wrenchline.sources.settings import config_of, read_settings

HEADER = [
    "SEQ", "forecast.event_display", "forecast.est_mh", "scl.special", "wph.wpno", "Start_date", "End_date",
    "part.description", "part.tool", "prq2.partno", "total_qty", "altpart_total_qty", "special type",
]


@pytest.fixture
def folders(tmp_path):
    source, reference = tmp_path / "in", tmp_path / "ref"
    source.mkdir()
    reference.mkdir()
    dates = [Date(45292), Date(45293)]
    write_workbook(
        source / "WP1.xlsx",
        {
            "Export": [
                HEADER,
                ["2.1", "24-001 (00) - A", 1200, "X1", "VN1-B-A06", *dates, "JACK", "Y", "P1", 0, None, "ENG"],
                ["2.1", "24-001 (00) - A", 1200, "X1", "VN1-B-A06", *dates, "SEAL", "N", "P2", 1, 0, "ENG"],
                ["4.1", "EO-7 / B", 60, "X2", "VN1-B-A06", *dates, "OIL", "N", "P3", 0, 0, "CAB"],
                ["5.1", "24-005 (x", 600, None, "VN1-B-A06", *dates, "RIG", "Y", "P4", 0, 0, None],
            ]
        },
    )
    write_workbook(source / "WP2.xlsx", {"Export": [HEADER[:3], ["3.1", "24-009 (x)", 90]]})
    write_workbook(source / "WP3.xlsx", {"Export": [HEADER[:2], ["3.1", "24-009 (x)"]]})
    (source / "WP4.xlsx").write_bytes(b"broken")
    write_workbook(reference / "ids.xlsx", {"Task": [["Taskcard Number"], ["24-001"]], "EO": [["EO"], ["EO-1"]]})
    write_workbook(reference / "regis.xlsx", {"S": [["Regis", "Type"], ["VN1", "787"]]})
    write_workbook(reference / "norms.xlsx", {"S": [["AircraftCode", "ProductCode", "Hours"], ["787", "A06", 2.5]]})
    write_workbook(
        reference / "types.xlsx",
        {"S": [["AircraftCode", "CheckGroup", "FuncGroup", "Coeff"], ["787", "A-CHECK", "ENG", 2.0]]},
    )
    (reference / "ignore_item.txt").write_text("oil\n")
    paths = BatchPaths(
        str(source), str(reference), str(tmp_path / "out"), "ids.xlsx", "regis.xlsx", "norms.xlsx", "types.xlsx"
    )
    return paths


def test_run_batch(spark, folders):
    written = run_batch(spark, folders, "r1", buckets=2)
    read = {name: spark.read.parquet(path) for name, path in written.items() if name != "oversized_hours"}  # none: no files
    assert sorted(values(read["status"], "workpack_id", "status")) == [
        ("WP1", "ok"), ("WP2", "ok"), ("WP3", "failed"), ("WP4", "failed"),
    ]
    totals = sorted(values(read["totals"], "workpack_id", "ac_type", "days", "base_hours", "adjusted_hours", "bonus_hours", "total_hhmm"))
    assert totals == [("WP1", "787", 2, 21.0, 45.1, 2.5, "47:36"), ("WP2", None, None, 1.5, 3.3, 0.0, "03:18")]
    assert values(read["high_tasks"], "workpack_id", "task_id", "base_mhrs") == [("WP1", "24-001", "20:00")]
    assert sorted(values(read["new_task_ids"], "workpack_id", "new_task_id", "is_eo")) == [("WP1", "EO-7", True), ("WP2", "24-009", False)]
    # WP2 has no tool columns and is not checked; OIL is ignored.
    assert sorted(values(read["tool_issues"], "workpack_id", "part_no", "type")) == [("WP1", "P1", "Tool"), ("WP1", "P4", "Tool")]
    assert sorted(values(read["special_codes"], "workpack_id", "label", "hhmm")) == [
        ("WP1", "TOTAL", "47:36"), ("WP1", "X1", "44:00"), ("WP1", "X2", "01:06"),
    ]
    assert values(read["bonus_breakdown"], "workpack_id", "sheet", "bonus_hours") == [("WP1", "S", 2.5)]
    assert values(read["type_coefficients"], "workpack_id", "func_group", "additional_hours") == [("WP1", "ENG", 20.0)]
    assert len(values(read["sample"])) == 3
    assert len(values(read["run_metrics"])) == 10


def test_type_system_and_switches(spark, folders):
    cfg = dataclasses.replace(CFG, coefficient_system="type", enable_special_code=False, enable_tool_control=False)
    written = run_batch(spark, folders, "r2", cfg, buckets=2)
    assert "special_codes" not in written and "tool_issues" not in written
    totals = spark.read.parquet(written["totals"])
    assert sorted(values(totals, "workpack_id", "base_hours", "adjusted_hours", "total_hours")) == [
        ("WP1", 21.0, 41.0, 43.5), ("WP2", 1.5, 1.5, 1.5),
    ]


def test_package_without_lines_and_missing_ignore_list(spark, folders):
    write_workbook(f"{folders.input}/WP5.xlsx", {"Export": [HEADER]})
    written = run_batch(spark, dataclasses.replace(folders, ignore_list="none.txt"), "r4", buckets=2)
    names = ("status", "totals", "tool_issues", "tool_summary", "new_id_summary", "type_coefficient_totals")
    read = {name: spark.read.parquet(written[name]) for name in names}
    status = dict(values(read["status"], "workpack_id", "status"))
    assert status == {"WP1": "ok", "WP2": "ok", "WP3": "failed", "WP4": "failed", "WP5": "ok", "none.txt": "missing"}
    totals = {r[0]: r[1:] for r in values(read["totals"], "workpack_id", "base_hours", "total_hours", "total_hhmm")}
    assert sorted(totals) == ["WP1", "WP2", "WP5"] and totals["WP5"] == (0.0, 0.0, "00:00")
    assert sorted(values(read["tool_issues"], "part_no")) == [("P1",), ("P3",), ("P4",)]
    assert values(read["tool_summary"], "workpack_id", "total_issues") == [("WP1", 3)]
    assert sorted(values(read["new_id_summary"], "workpack_id")) == [("WP1",), ("WP2",)]
    assert values(read["type_coefficient_totals"].where("workpack_id = 'WP1'"), "base_hours", "additional_hours") == [(21.0, 20.0)]


@pytest.mark.parametrize("file_format", ["csv", "json", "parquet"])
def test_batch_over_exports(spark, folders, tmp_path, file_format):
    source = tmp_path / file_format
    source.mkdir()
    names = ["SEQ", "forecast.event_display", "forecast.est_mh"]

    def export(name, columns, rows):
        table = pd.DataFrame([[str(v) for v in row] for row in rows], columns=columns)
        path = source / f"{name}.{file_format}"
        if file_format == "csv":
            table.to_csv(path, index=False)
        elif file_format == "json":
            table.to_json(path, orient="records", lines=True)
        else:
            table.to_parquet(path)

    own = names if file_format == "csv" else [*names, "event"]
    export("WA", names, [(f"2.{i}", "24-001 (x)", 60) for i in range(5)])
    export("WB", own, [("2.1", "24-001 (x)", 60, f"e{i % 4}")[: len(own)] for i in range(5)])
    export("WC", names, [("2.1", "24-001 (x)", "1e400"), ("2.2", "24-001 (x)", "1e25"), ("2.3", "24-001 (x)", 30)])
    if file_format != "csv":
        export("WD", names[:2], [("2.1", "24-001 (x)")])
    paths = dataclasses.replace(folders, input=str(source))
    written = run_batch(spark, paths, "e1", buckets=2, file_format=file_format)
    read = {name: spark.read.parquet(written[name]) for name in ("status", "totals", "oversized_hours")}
    status = {"WA": "ok", "WB": "ok", "WC": "ok"} | ({} if file_format == "csv" else {"WD": "failed"})
    assert dict(values(read["status"], "workpack_id", "status")) == status
    # Events decide in WB, sequences elsewhere; numbers too large to be summed are left out and listed.
    hours = {"WA": 5.0, "WB": 1.0 if file_format == "csv" else 4.0, "WC": 0.5}
    assert dict(values(read["totals"], "workpack_id", "base_hours")) == hours
    assert {r[0] for r in values(read["oversized_hours"], "workpack_id")} == {"WC"}

    low = config_of({"rules": [{"prefix": "2", "base": "true", "id_method": "-", "coefficient": 1}]})
    again = spark.read.parquet(run_batch(spark, paths, "e2", low, 2, file_format)["totals"])
    assert dict(values(again, "workpack_id", "adjusted_hours")) == hours
    assert dict(values(read["totals"], "workpack_id", "adjusted_hours"))["WA"] == 11.0


def test_settings(spark, tmp_path):
    path = tmp_path / "settings.json"
    path.write_text('{"high_hours": 8, "skip_codes": ["abc"], "coefficient_system": "type",\n "enable_tool_control": false}')
    cfg = read_settings(spark, str(path))
    assert (cfg.high_hours, cfg.skip_codes, cfg.coefficient_system, cfg.enable_tool_control) == (8, ("abc",), "type", False)
    assert cfg.rules == CFG.rules
    for bad in (
        {"hours": 1}, {"high_hours": "8"}, {"skip_codes": "abc"}, {"enable_tool_control": 1}, {"coefficient_system": "x"},
        {"rules": [{"prefix": "2", "coefficient": "x"}]}, {"rules": [{"other": 1}]}, {"sample_size": None},
    ):
        with pytest.raises(ValueError):
            config_of(bad)


def test_empty_folder(spark, folders, tmp_path):
    empty = tmp_path / "none"
    empty.mkdir()
    written = run_batch(spark, dataclasses.replace(folders, input=str(empty)), "r3", buckets=2)
    assert "totals" in written


def test_work_folder(spark):
    assert work_folder(spark, "/x") == (spark.conf.get("spark.checkpoint.dir", None) or "/x")


def test_reports_from_csv_exports(spark, tmp_path):
    """Lines of another source, reports written as csv; row_no is a struct here."""
    from wrenchline.plans.report import Lookups, build_reports
    from wrenchline.sources import line_tables, reports

    source = tmp_path / "csv"
    source.mkdir()
    names = HEADER[:-1]
    rows = [f"2.{i % 30},24-{i % 7} (x,{i * 30},{'X' if i % 2 else 'Y'},VN1-A06,2024-01-01,2024-01-03,n{i},Y,p{i},0,{i % 2}" for i in range(90)]
    (source / "WP9.csv").write_text("\n".join([",".join(names), *rows]) + "\n")
    lines = line_tables.read_exports(spark, str(source), "csv", CFG)
    empty = spark.createDataFrame([], "item string")
    lookups = Lookups(
        registrations=spark.createDataFrame([("VN1", "787", 0)], "regis string, ac_type string, row_no int"),
        bonus_rows=spark.createDataFrame(
            [("s", 0, "787", "A06", 4.0)], "sheet string, row_no int, aircraft_code string, product_code string, hours double"
        ),
        reference=spark.createDataFrame([("task", "24-1")], "kind string, id string"),
        ignore_items=empty,
    )
    datasets = build_reports(lines, lookups, CFG)
    written = reports.write_reports(datasets, str(tmp_path / "out"), "r", buckets=2, file_format="csv")
    filled = ("totals", "new_task_ids", "tool_issues", "sample", "special_codes")
    read = {name: spark.read.option("header", True).csv(written[name]) for name in filled}
    # No task is above the threshold: nothing but the schema is known of that dataset.
    high = datasets["high_tasks"].drop("row_no")
    assert spark.read.schema(high.schema).option("header", True).csv(written["high_tasks"]).count() == 0
    # Keep-first: rows 0..29 with i * 30 minutes each, coefficient 2.2.
    base = sum(range(30)) / 2
    total = read["totals"].collect()[0]
    assert (float(total["base_hours"]), float(total["adjusted_hours"]), total["days"]) == (base, pytest.approx(base * 2.2), "3")
    assert float(total["total_hours"]) == pytest.approx(base * 2.2 + 4)
    assert read["new_task_ids"].count() == sum(1 for i in range(30) if i % 7 != 1)
    assert read["tool_issues"].count() == 45 and read["sample"].count() == 10
    assert {r["label"] for r in read["special_codes"].collect()} == {"X", "Y", "TOTAL"}
