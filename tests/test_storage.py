"""Datasets replaced in place, rules as data, reconciliation, unlike sheets, records from texts."""

import os

import pytest
from helpers import frame, lines, values
from pyspark.sql import functions as F

from wrenchline.config import DEFAULT_CONFIG as CFG
from wrenchline.operators import lines as line_ops
from wrenchline.operators import quality, site_rules
from wrenchline.sources import lookups, reports, text_records
from wrenchline.storage import new_folder

ROWS = "workpack_id string, n int"


def stored(path):
    """Modification time of every data file."""
    found = {}
    for folder, _, names in os.walk(path):
        found |= {os.path.join(folder, n): os.stat(os.path.join(folder, n)).st_mtime_ns for n in names if n.endswith(".parquet")}
    return found


def test_replacing_packages_writes_their_buckets_only(spark, tmp_path):
    rows = [(f"P{i % 50}", i) for i in range(500)]
    path = reports.write_report(frame(spark, ROWS, *rows), str(tmp_path), "hours", "r", buckets=8)
    before = stored(path)
    told = {r.package_bucket: tuple(r) for r in reports.manifest(spark, path).collect()}
    new = frame(spark, ROWS, ("P7", -1), ("P7", -2), ("new", -3))
    touched = reports.replace_packages(new, path, 8)
    want = sorted([r for r in rows if r[0] != "P7"] + [("P7", -1), ("P7", -2), ("new", -3)])
    assert sorted(values(spark.read.parquet(path), "workpack_id", "n")) == want
    kept = {f: t for f, t in before.items() if not any(f"package_bucket={b}/" in f for b in touched)}
    after = stored(path)
    assert kept and kept.items() <= after.items() and 1 <= len(touched) <= 2
    again = {r.package_bucket: tuple(r) for r in reports.manifest(spark, path).collect()}
    assert {b: m for b, m in again.items() if b not in touched} == {b: m for b, m in told.items() if b not in touched}
    # Once more: the same rows, and the same content in the manifest.
    assert reports.replace_packages(new, path, 8) == touched
    assert sorted(values(spark.read.parquet(path), "workpack_id", "n")) == want
    assert {r.package_bucket: r.content for r in reports.manifest(spark, path).collect()} == {b: m[4] for b, m in again.items()}
    assert reports.replace_packages(new.limit(0), path, 8) == []


def test_reading_packages_prunes_buckets(spark, tmp_path):
    path = reports.write_report(frame(spark, ROWS, *[(f"P{i}", i) for i in range(100)]), str(tmp_path), "hours", "r", buckets=16)
    wanted = frame(spark, "workpack_id string", ("P3",), ("P3",), ("P90",), ("none",))
    rows = reports.read_packages(spark, path, wanted, 16)
    assert sorted(values(rows, "workpack_id", "n")) == [("P3", 3), ("P90", 90)]
    plan = rows._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(package_bucket" in plan or "PartitionFilters: [package_bucket" in plan


def test_new_folder_is_below_the_shared_one(spark):
    assert new_folder(spark, "x") != new_folder(spark, "x")


RULES = [
    # site, sheet, prefix, mode, id_method, coefficient
    (None, None, "2", "true", "-", 2.2),
    (None, "mhr", "2", "general mhr", None, None),
    ("A", None, "2", "keep", None, 9.0),
    ("A", "tool", "2", "own tool", "/", 8.0),
    ("B", "mhr", "2", "ignore", None, None),
    ("B", None, "7", None, "x", None),
    (None, None, "3", "ignore", None, None),
]


def test_the_most_specific_rule_wins(spark):
    rules = frame(spark, site_rules.RULE_SCHEMA, *RULES)
    keys = [(s, p) for s in ("A", "B", "C", None) for p in ("2", "3", "7", "nan")]
    found = {
        (r.site, r.prefix): (r.base_mode, r.mhr_mode, r.newtask_mode, r.tool_mode, r.id_method, r.coefficient, r.level)
        for r in site_rules.resolved_rules(frame(spark, "site string, prefix string", *keys, *keys), rules, CFG).collect()
    }
    none = ("true", "true", "true", "true", "/", 1.1, 4)
    gone = ("ignore", "ignore", "ignore", "ignore", "/", 1.1, 3)
    assert len(found) == len(keys)
    # What a site says of all sheets goes before what all sites say of one sheet.
    assert found["A", "2"] == ("keep", "keep", "keep", "own tool", "-", 9.0, 1)
    assert found["B", "2"] == ("true", "ignore", "true", "true", "-", 2.2, 3)
    assert found["C", "2"] == found[None, "2"] == ("true", "general mhr", "true", "true", "-", 2.2, 3)
    assert found["B", "7"] == ("true", "true", "true", "true", "x", 1.1, 4)
    assert all(found[s, "3"] == gone and found[s, "nan"] == none for s in ("A", "B", "C", None))


def test_rules_of_the_settings_as_data_say_the_same(spark):
    rows = lines(spark, "seq title planned_min", *[(f"{p}.1" if p else None, "24-1 (x", "60") for p in ("2", "3", "4", "5", "10", "11", None)])
    found = site_rules.with_site_rules(rows.withColumn("site", F.lit("A")), site_rules.rule_rows(spark, CFG), CFG)
    literal = line_ops.with_coefficient(line_ops.with_base_hours(line_ops.base_gate(rows, CFG)), CFG, use_skip_codes=False)
    want = sorted(values(literal, "row_no", "check_ref", "coefficient"))
    assert sorted(values(found.where("processed"), "row_no", "check_ref", "coefficient")) == want
    assert sorted(values(found.where("seq IS NOT NULL AND mhr_mode <> 'ignore'"), "row_no")) == sorted(
        values(rows.where(line_ops.in_sheet(CFG, "mhr")), "row_no")
    )


def test_site_findings(spark):
    rules = frame(spark, site_rules.RULE_SCHEMA, *RULES, ("C", None, "4", "true", None, -1.0), ("C", "mhr", "4", None, None, 10.0))
    found = sorted(values(site_rules.site_findings(rules)), key=repr)
    assert found == sorted([(s, "4", "no mode") for s in ("A", "B", None)] + [("C", "4", "unusual coefficient")], key=repr)


def test_reconciliation_finds_planted_differences(spark):
    schema = "workpack_id string, row_no int, hours double"
    expected = frame(spark, schema, ("P", 1, 1.0), ("P", 2, 2.0), ("P", 3, 3.0), ("P", 4, None), ("P", 5, None), ("Q", 1, 1.0))
    delivered = frame(spark, schema, ("P", 1, 1.009), ("P", 2, 2.02), ("P", 4, None), ("P", 5, 5.0), ("P", 9, 1.0))
    rows = quality.reconcile(delivered, expected, ["workpack_id", "row_no"], "hours")
    found = {(r.workpack_id, r.row_no): r.finding for r in rows.collect()}
    assert found == {
        ("P", 1): None, ("P", 2): "different", ("P", 3): "missing", ("P", 4): None, ("P", 5): "different", ("P", 9): "unexpected", ("Q", 1): "missing",
    }
    twice = quality.reconcile(delivered.unionByName(delivered), expected, ["workpack_id", "row_no"], "hours")
    assert twice.where("finding = 'unexpected'").count() == 6 and twice.where("row_no = 1 AND workpack_id = 'P'").count() == 2
    summary = {r.workpack_id: tuple(r)[1:] for r in quality.reconciliation_summary(rows, "hours").collect()}
    assert summary["P"][:4] == (2, 2, 1, 1) and summary["P"][4] == pytest.approx(0.02) and summary["Q"] == (0, 0, 1, 0, 0.0)


def test_sheets_of_other_types(spark):
    one = frame(spark, "key int, day date, v int, `a.b` int", (1, None, 1, 5))
    two = frame(spark, "v double, key string, day timestamp_ntz", (2.5, "x", None))
    three = frame(spark, "v bigint, flag boolean", (2**40, True))
    merged = lookups.union_sheets({"one": one, "two": two, "three": three})
    kinds = {f.name: f.dataType.simpleString() for f in merged.schema}
    assert kinds == {
        "key": "string", "day": "timestamp_ntz", "v": "double", "a.b": "int", "flag": "boolean", "sheet": "string", "sheet_no": "int",
    }
    rows = sorted(values(merged, "sheet_no", "sheet", "key", "v", "`a.b`", "flag"))
    assert rows == [(0, "one", "1", 1.0, 5, None), (1, "two", "x", 2.5, None, None), (2, "three", None, float(2**40), None, True)]
    longs = lookups.union_sheets({"a": one.select("v"), "b": three.select("v")})
    assert longs.schema["v"].dataType.simpleString() == "bigint"
    with pytest.raises(ValueError):
        lookups.union_sheets({})


def test_records_of_texts(spark):
    texts = [
        (1, "q1\n a \nb\nc\nq2\nd"), (2, " q1 \r\nother\r\n"), (3, None), (4, ""), (5, "\n"), (6, "q3\n\n\n\nq3"), (7, "x\n" * 40_000),
    ]
    found = text_records.records_of_texts(frame(spark, "doc_id int, body string", *texts), "doc_id", "body")
    rows = {(r.doc_id, r.record_no): (r.question, r.answers, r.complete) for r in found.where("doc_id < 7").collect()}
    assert rows == {
        (1, 0): ("q1", ["a", "b", "c"], True), (1, 1): ("q2", ["d"], False), (2, 0): ("q1", ["other"], False), (5, 0): ("", [], False),
        (6, 0): ("q3", ["", "", ""], True), (6, 1): ("q3", [], False),
    }
    assert found.where("doc_id = 7").count() == 10_000
    kept = text_records.keep_first_records(found, "doc_id")
    assert sorted(values(kept, "doc_id", "record_no")) == [(1, 0), (1, 1), (5, 0), (6, 0), (7, 0)]
    by_two = text_records.records_of_texts(frame(spark, "doc_id int, body string", *texts[:1]), "doc_id", "body", 2)
    assert [r.answers for r in by_two.orderBy("record_no").collect()] == [["a"], ["c"], ["d"]]


def test_equal_plans_are_stored_once(spark, tmp_path):
    from wrenchline.storage import staged_once

    store = staged_once(str(tmp_path / "work"))
    rows = spark.range(10)
    first = store(rows.where("id > 3"), "a")
    assert store(rows.where("id > 3"), "b") is first
    assert store(rows.where("id > 4"), "c").count() == 5
    assert store(rows.where("id > 3").withColumnRenamed("id", "n"), "d").columns == ["n"]
    assert len(list((tmp_path / "work").iterdir())) == 3


def test_report_datasets_store_the_kept_lines_once(spark, tmp_path, monkeypatch):
    from wrenchline import storage
    from wrenchline.plans import catalog_storage

    paths = []
    real = storage.staged
    for module in (storage, catalog_storage):
        monkeypatch.setattr(module, "staged", lambda df, path: paths.append(path) or real(df, path))
    catalog_storage.q58_report_datasets(spark, "/root/testdata/sf0.001")
    assert sorted(p.rpartition("/")[2].lstrip("0123456789-") for p in paths) == ["headers", "kept_lines", "lines"]
