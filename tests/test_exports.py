"""Folders of exports that differ or are damaged."""

import dataclasses
import json

import pandas as pd
import pytest
from helpers import values, write_workbook

from wrenchline.config import DEFAULT_CONFIG as CFG
from wrenchline.operators import lines as line_ops
from wrenchline.plans.batch import BatchPaths, run_batch
from wrenchline.sources import exports, file_columns
from wrenchline.storage import staged

NAMES = ["SEQ", "forecast.event_display", "forecast.est_mh"]
FORMATS = ("csv", "json", "parquet")


def write(folder, name, file_format, columns, rows):
    table = pd.DataFrame(rows, columns=columns, dtype=object)
    path = folder / f"{name}.{file_format}"
    if file_format == "csv":
        table.to_csv(path, index=False)
    elif file_format == "json":
        path.write_text("".join(json.dumps(dict(zip(columns, row, strict=True))) + "\n" for row in rows))
    else:
        table.astype("string").to_parquet(path)
    return path


@pytest.fixture
def read(spark, tmp_path):
    def run(folder, file_format, cfg=CFG, per="file"):
        store = lambda df, name: staged(df, str(tmp_path / f"work-{len(list(tmp_path.iterdir()))}" / name))
        return exports.read_folder(spark, str(folder), file_format, cfg, store, per)

    return run


def status_of(found):
    return {r.workpack_id: (r.status, r.rows, r.error) for r in found.status.collect()}


@pytest.mark.parametrize("file_format", FORMATS)
def test_one_bad_file_leaves_the_others(read, tmp_path, file_format):
    source = tmp_path / "in"
    source.mkdir()
    for i in range(4):
        # Other order of the columns, and further ones, in every second file.
        columns = [*NAMES[::-1], "extra"] if i % 2 else NAMES
        row = dict(zip(NAMES, ["2.1", "24-001 (x), y", str(60 * (i + 1))], strict=True)) | {"extra": "?"}
        write(source, f"W {i}", file_format, columns, [[row[c] for c in columns]] * 2)
    (source / f"bad.{file_format}").write_bytes(b'{"SEQ": "2.1", \x00\xff\nno such thing,\n')
    found = read(source, file_format)
    status = status_of(found)
    assert {p: s[:2] for p, s in status.items()} == {**{f"W {i}": ("ok", 2) for i in range(4)}, "bad": ("failed", 0)}
    assert status["bad"][2]
    hours = values(line_ops.with_base_hours(found.lines), "workpack_id", "seq", "title", "base_hours")
    assert sorted(hours) == sorted([(f"W {i}", "2.1", "24-001 (x), y", float(i + 1)) for i in range(4)] * 2)


@pytest.mark.parametrize("file_format", FORMATS)
def test_missing_required_columns_and_files_without_lines(read, tmp_path, file_format):
    source = tmp_path / "in"
    source.mkdir()
    write(source, "short", file_format, NAMES[:2], [["2.1", "t"]])
    write(source, "none", file_format, NAMES, [])
    write(source, "blank", file_format, NAMES, [["2.1", None, None]])
    (source / f"zero.{file_format}").write_bytes(b"")  # Spark does not list files without bytes
    status = status_of(read(source, file_format))
    assert status["short"] == ("failed", 0, "Missing required columns: forecast.est_mh")
    assert status.get("none", ("ok", 0, None)) == ("ok", 0, None) and status["blank"] == ("ok", 1, None)
    assert ("none" in status) == (file_format != "json") and "zero" not in status


def test_lines_that_do_not_fit_fail_their_file(read, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    head = ",".join(NAMES)
    (source / "long.csv").write_text(f"{head}\n2.1,a, b,60\n2.2,t,30\n")
    (source / "fine.csv").write_text(f"\n﻿{head}\n2.1,\"a, b\",60,\n2.2\n{head}\n\n2.3,t,30\n")
    found = read(source, "csv")
    assert status_of(found) == {"long": ("failed", 2, "1 lines with more values than the head"), "fine": ("ok", 3, None)}
    assert sorted(values(found.lines, "seq", "title", "planned_min")) == [("2.1", "a, b", "60"), ("2.2", None, None), ("2.3", "t", "30")]


def test_parquet_files_of_other_types_and_a_damaged_one(spark, read, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    pd.DataFrame([["2.1", "t", 60.5], ["2.2", "t", None]], columns=NAMES).to_parquet(source / "double.parquet")
    pd.DataFrame([["2.1", "t", 90]], columns=NAMES).to_parquet(source / "long.parquet")
    pd.DataFrame([[2.1, "t", "120"]], columns=NAMES).to_parquet(source / "text.parquet")
    pd.DataFrame([["2.1", "t", pd.Timestamp("2024-01-01")]], columns=NAMES).to_parquet(source / "nano.parquet", version="2.6", coerce_timestamps=None)
    # Row groups whose pages are overwritten under an intact footer.
    many = pd.DataFrame([[f"2.{i}", "t" * (i % 50), "60"] for i in range(20_000)], columns=NAMES)
    path = source / "torn.parquet"
    many.to_parquet(path, row_group_size=1000)
    raw = bytearray(path.read_bytes())
    raw[len(raw) // 2 : len(raw) // 2 + 4000] = b"\xff" * 4000
    path.write_bytes(bytes(raw))
    found = read(source, "parquet")
    status = status_of(found)
    assert {p: s[0] for p, s in status.items()} == {"double": "ok", "long": "ok", "text": "ok", "nano": "failed", "torn": "failed"}
    assert status["nano"][2] == "Columns of other types: forecast.est_mh" and "of 20000 lines" in status["torn"][2]
    hours = values(line_ops.with_base_hours(found.lines), "workpack_id", "seq", "base_hours")
    assert sorted(hours) == [("double", "2.1", 60.5 / 60), ("double", "2.2", 0.0), ("long", "2.1", 1.5), ("text", "2.1", 2.0)]


def test_a_folder_as_package(read, tmp_path):
    for package, parts in (("wp=A", 3), ("wp=B +b", 1)):
        folder = tmp_path / "in" / package
        folder.mkdir(parents=True)
        for part in range(parts):
            write(folder, f"part-{part}", "csv", NAMES if part else [*NAMES, "event"], [["2.1", f"t{part}", "60", "e"][: 4 - bool(part)]])
    found = read(tmp_path / "in", "csv", per="folder")
    assert {p: s[:2] for p, s in status_of(found).items()} == {"A": ("ok", 3), "B +b": ("ok", 1)}
    first = line_ops.base_rows(found.lines.where("workpack_id = 'A'"), CFG)
    # The file with events and those without are kept apart; the first of the latter stays.
    assert sorted(values(first, "title", "has_event")) == [("t0", True), ("t1", False)]


def test_columns_of_files(spark, tmp_path):
    write(tmp_path, "a", "parquet", NAMES, [["1", "2", "3"]])
    pd.DataFrame({"SEQ": [1], "forecast.est_mh": [1.5], "ok": [True], "d": [pd.Timestamp("2024-01-01").date()]}).to_parquet(tmp_path / "b.parquet")
    (tmp_path / "c.parquet").write_bytes(b"PAR1nothing")
    files = file_columns.file_columns(spark, str(tmp_path), "parquet")
    table = sorted(values(file_columns.column_table(files), "workpack_id", "place", "name", "type", "rows"))
    assert table == [
        *[("a", i, n, "string", 1) for i, n in enumerate(NAMES)],
        ("b", 0, "SEQ", "bigint", 1), ("b", 1, "forecast.est_mh", "double", 1), ("b", 2, "ok", "boolean", 1), ("b", 3, "d", "date", 1),
    ]
    missing = files.select("workpack_id", file_columns.missing_columns(NAMES).alias("m"), file_columns.has_column("SEQ").alias("h"), "error")
    found = {r.workpack_id: (r.m, r.h, r.error is None) for r in missing.collect()}
    assert found == {"a": ([], True, True), "b": (["forecast.event_display"], True, True), "c": (NAMES, False, False)}


@pytest.fixture
def lookups(tmp_path):
    reference = tmp_path / "ref"
    reference.mkdir()
    write_workbook(reference / "ids.xlsx", {"Task": [["Taskcard Number"], ["24-001"]], "EO": [["EO"], ["EO-1"]]})
    write_workbook(reference / "regis.xlsx", {"S": [["Regis", "Type"], ["VN1", "787"]]})
    write_workbook(reference / "norms.xlsx", {"S": [["AircraftCode", "ProductCode", "Hours"], ["787", "A06", 2.5]]})
    (reference / "ignore_item.txt").write_text("oil\n")
    return BatchPaths("", str(reference), str(tmp_path / "out"), "ids.xlsx", "regis.xlsx", "norms.xlsx")


def test_a_package_gives_the_same_in_every_format(spark, tmp_path, lookups):
    """Also where an optional column is there but empty: the column decides, not its values."""
    columns = [*NAMES, "event", "wph.wpno", "scl.special", "part.description", "part.tool", "prq2.partno", "total_qty", "altpart_total_qty"]
    tail = ["VN1-A06", "X1", "JACK", "Y", "P1", "0", "0"]
    packages = {
        "empty events": (columns, [["2.1", "24-001 (x)", "60", None, *tail], ["2.2", "24-002 (x)", "90", None, *tail], ["3.1", "24-003 (x)", "30", None, *tail]]),
        "events": (columns, [["2.1", "24-001 (x)", "60", "e1", *tail], ["2.1", "24-002 (x)", "1000", "e2", *tail], ["3.1", "24-003 (x)", "30", "e1", *tail]]),
        "plain": (NAMES, [["2.1", "24-001 (x)", "60"], ["2.1", "24-002 (x)", "90"], ["4.1", "EO-9 / x", "30"]]),
    }
    results = {}
    for file_format in ("xlsx", *FORMATS):
        source = tmp_path / file_format
        source.mkdir()
        for name, (own, rows) in packages.items():
            if file_format == "xlsx":
                write_workbook(source / f"{name}.xlsx", {"S": [own, *rows]})
            else:
                write(source, name, file_format, own, rows)
        (source / f"bad.{file_format}").write_bytes(b"nothing of the kind\n")
        written = run_batch(spark, dataclasses.replace(lookups, input=str(source)), f"r-{file_format}", buckets=2, file_format=file_format)
        names = ("totals", "high_tasks", "new_task_ids", "special_codes", "tool_issues", "coefficient_summary", "run_metrics")
        results[file_format] = {
            name: sorted(values(spark.read.parquet(written[name]).drop("row_no", "package_bucket")), key=repr) for name in names
        }
        status = dict(values(spark.read.parquet(written["status"]), "workpack_id", "status"))
        assert status == {"empty events": "ok", "events": "ok", "plain": "ok", "bad": "failed"}
    for file_format in FORMATS:
        assert results[file_format] == results["xlsx"], file_format
    hours = dict(values(spark.read.parquet(written["totals"]), "workpack_id", "base_hours"))
    assert hours == {"empty events": 1.0, "events": 17.6667, "plain": 1.5}


def test_only_new_files_are_processed(spark, tmp_path, lookups):
    from wrenchline.plans.incremental import run_new_packages

    source = tmp_path / "in"
    source.mkdir()
    paths = dataclasses.replace(lookups, input=str(source))
    row = lambda i: [["2.1", "24-009 (x)", str(60 * i)], ["2.2", "EO-3 x", "30"]]

    def run():
        return run_new_packages(spark, paths, "inc", str(tmp_path / "progress"), buckets=2, file_format="csv", files_per_run=2)

    def totals(pattern):
        rows = spark.read.parquet(f"{lookups.output}/totals").where(f"run LIKE '{pattern}'")
        return sorted(values(rows, "workpack_id", "base_hours", "total_hours"))

    for i in range(3):
        write(source, f"W [{i}]", "csv", NAMES, row(i))
    first = run()
    assert first == ["inc-000000", "inc-000001"] and run() == []
    write(source, "late", "csv", NAMES, row(9))
    (source / "bad.csv").write_text("a,b\n1,2\n")
    assert run() == ["inc-000002"]
    assert [r[0] for r in totals("inc-000002")] == ["late"]
    status = spark.read.parquet(f"{lookups.output}/status").where("run LIKE 'inc%'")
    assert sorted(values(status, "workpack_id", "status")) == [("W [0]", "ok"), ("W [1]", "ok"), ("W [2]", "ok"), ("bad", "failed"), ("late", "ok")]
    run_batch(spark, paths, "full", buckets=2, file_format="csv")
    assert totals("inc%") == totals("full") and len(totals("full")) == 4


def test_run_totals_come_from_the_write_of_the_kept_lines(spark, tmp_path, lookups):
    source = tmp_path / "in"
    source.mkdir()
    write(source, "A", "csv", NAMES, [["2.1", "t", "60"], ["2.1", "t", "90"], ["5.1", "t", "30"], ["", "t", "30"]])
    write(source, "B", "csv", NAMES, [["4.1", "t", "120"]])
    written = run_batch(spark, dataclasses.replace(lookups, input=str(source)), "t", buckets=2, file_format="csv")
    totals = {r.stage: (r.rows, r.hours) for r in spark.read.parquet(written["run_totals"]).collect()}
    assert totals == {"loaded": (5, 5.5), "base": (3, 3.5), "mhr": (2, 3.0), "excluded_mhr": (1, 0.5), "coefficient": (2, 4.4)}
    by_package = spark.read.parquet(written["run_metrics"]).groupBy("stage").agg({"rows": "sum", "hours": "sum"})
    assert {r[0]: (r["sum(rows)"], pytest.approx(r["sum(hours)"])) for r in by_package.collect()} == totals


def test_exports_are_written_from_lines_joined_once(spark, monkeypatch):
    from wrenchline.plans import catalog_storage

    read, real = [], catalog_storage._write
    monkeypatch.setattr(catalog_storage, "_write", lambda rows, *rest: read.extend(rows.inputFiles()) or real(rows, *rest))
    catalog_storage.q47_isolated_exports(spark, "/root/testdata/sf0.001")
    assert read and not any("lineitem" in f or "orders" in f for f in read)


def test_keys_of_json_lines_with_and_without_names(spark, tmp_path):
    from wrenchline.sources import file_columns

    (tmp_path / "a.json").write_text('﻿{"SEQ": "1", "x": 2}\n  \n{"event": null}\n[1]\n7\n')
    (tmp_path / "b.json").write_text('{"x": 1}\n')
    found = lambda names: {r.workpack_id: ([c.name for c in r.columns], r.error) for r in file_columns.file_columns(spark, str(tmp_path), "json", names).collect()}
    broken = "2 lines that are no JSON objects"
    assert found(None) == {"a": (["SEQ", "event", "x"], broken), "b": (["x"], None)}
    assert found(["event", "SEQ", "title"]) == {"a": (["SEQ", "event"], broken), "b": ([], None)}
