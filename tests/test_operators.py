"""Operators on small tables with the cases the large tables lack."""

import dataclasses

import pytest
from helpers import frame, lines, values
from pyspark.sql import functions as F

from wrenchline.config import DEFAULT_CONFIG as CFG
from wrenchline.config import EngineConfig, SeqRule
from wrenchline.operators import (
    bonus,
    coefficients,
    keep_first,
    lines as line_ops,
    metrics,
    new_tasks,
    packages,
    quality,
    sampling,
    special_codes,
    text_dedup,
    tools,
    type_coefficients,
)
from wrenchline.sources.rules import rules_table


def test_null_sequence_in_every_path(spark):
    df = lines(
        spark,
        "seq title planned_min tool_name part_no tool_flag total_qty alt_qty",
        (None, "A / a", "60", "n", "p", "Y", "0", None),
        (None, "B / b", "60", "n", "q", "N", None, "bad"),
        ("5.1", "C (c", "60", "n", "r", "Y", "0", "0"),
        ("2.1", "D (d", "60", "n", "s", "Y", "1", "0"),
    )
    assert sorted(values(line_ops.base_gate(df, CFG), "row_no")) == [(0,), (1,), (3,)]
    assert sorted(values(line_ops.base_rows(df, CFG), "row_no")) == [(0,), (3,)]
    assert values(line_ops.mhr_rows(df, CFG), "row_no") == [(3,)]
    assert sorted(values(new_tasks.new_task_rows(df, CFG), "row_no")) == [(0,), (3,)]
    nothing = frame(spark, "item string")
    assert sorted(values(tools.tool_issues(df, nothing, CFG), "row_no")) == [(0,), (1,), (2,)]
    filtered = dataclasses.replace(CFG, filter_tools_by_rule=True)
    assert values(tools.tool_issues(df, nothing, filtered), "row_no") == [(2,)]


def test_keep_first_uses_event_and_runs_before_the_sheet_gate(spark):
    df = lines(
        spark,
        "seq event title planned_min",
        ("9.1", "e1", "x", "60"),
        (None, "e2", "x", "60"),
        ("2.1", "e2", "x", "60"),
        ("2.1", "e3", "x", "60"),
        ("2.1", None, "x", "60"),
        ("2.2", None, "x", "60"),
        ("2.3", "e1", "x", "60"),
    )
    # e1 first passes on row 6, since row 0 is ignored; e2 is taken by the null sequence.
    assert sorted(values(line_ops.base_rows(df, CFG), "row_no")) == [(1,), (3,), (4,), (6,)]
    assert sorted(values(line_ops.mhr_rows(df, CFG), "row_no")) == [(3,), (4,), (6,)]


def test_event_per_package(spark):
    df = lines(
        spark,
        "workpack_id seq event title planned_min",
        ("A", "2.1", "e1", "x", "60"),
        ("A", "2.1", "e2", "x", "60"),
        ("B", "2.1", None, "x", "60"),
        ("B", "2.1", None, "x", "60"),
        ("B", "2.2", None, "x", "60"),
    ).withColumn("has_event", F.col("workpack_id") == "A")
    assert sorted(values(line_ops.mhr_rows(df, CFG), "row_no")) == [(0,), (1,), (2,), (4,)]


def test_sheet_overrides(spark):
    cfg = EngineConfig(
        rules=(
            SeqRule("8", "ignore", newtask="true"),
            SeqRule("9", "true", mhr="ignore", newtask="false"),
            SeqRule("10", "false", tool="ignore"),
        )
    )
    df = lines(spark, "seq title planned_min", ("8.1", "a", "1"), ("9.1", "b", "1"), ("10.1", "c", "1"), ("1.1", "d", "1"))
    assert sorted(values(line_ops.base_gate(df, cfg), "seq", "check_ref")) == [("1.1", True), ("10.1", False), ("9.1", True)]
    assert sorted(values(line_ops.mhr_rows(df, cfg), "seq")) == [("1.1",), ("10.1",)]
    fresh = new_tasks.new_task_rows(df, cfg)
    assert sorted(values(fresh, "seq", "check_ref")) == [("1.1", True), ("10.1", False), ("8.1", True), ("9.1", False)]
    none = frame(spark, "kind string, id string")
    assert sorted(values(new_tasks.missing_ids(fresh, none, cfg), "seq")) == [("1.1",), ("8.1",)]
    assert sorted(values(line_ops.sheet_gate(df, cfg, "tool"), "seq")) == [("1.1",), ("9.1",)]
    table = {r["prefix"]: r for r in rules_table(spark, cfg).collect()}
    assert (table["8"]["base"], table["8"]["newtask"], table["8"]["mhr"]) == ("ignore", "true", "ignore")
    assert (table["9"]["mhr"], table["9"]["tool"], table["9"]["coefficient"]) == ("ignore", "true", 1.1)


def test_skip_codes_can_be_left_out(spark):
    df = lines(spark, "seq title planned_min", ("2.1", "VNA-1 (x)", "60"), ("2.2", "24-1 (x)", "400"))
    rows = line_ops.with_base_hours(line_ops.with_task_id(df, CFG))
    with_skip = values(line_ops.with_coefficient(rows, CFG).orderBy("row_no"), "coefficient")
    without = values(line_ops.with_coefficient(rows, CFG, use_skip_codes=False).orderBy("row_no"), "coefficient")
    assert (with_skip, without) == ([(1.0,), (2.2,)], [(2.2,), (2.2,)])
    summary = coefficients.coefficient_summary(line_ops.with_coefficient(rows, CFG), CFG)
    assert sorted(values(summary, "coefficient", "rows", "is_skip_value")) == [(1.0, 1, True), (2.2, 1, False)]
    assert values(quality.coefficient_mismatches(line_ops.with_coefficient(rows, CFG)), "bad_rows") == [(0,)]
    off = line_ops.with_coefficient(rows, CFG).withColumn("adjusted_hours", F.col("adjusted_hours") + 0.02)
    assert values(quality.coefficient_mismatches(off), "bad_rows") == [(2,)]


def test_high_hours_are_strict_and_before_coefficients(spark):
    df = lines(spark, "seq title planned_min", ("2.1", "a", "960"), ("2.2", "b", "960.5"), ("2.3", "c", "600"))
    mhr = line_ops.mhr_rows(df, CFG)
    assert values(line_ops.high_hour_tasks(mhr, CFG), "seq") == [("2.2",)]
    adjusted = dataclasses.replace(CFG, high_hours_basis="adjusted_hours")
    assert len(values(line_ops.high_hour_tasks(mhr, adjusted), "seq")) == 3


def _lookups(spark):
    registrations = packages.registration_table(
        frame(spark, "regis string, ac_type string, row_no int", (" VN1 ", " 787 ", 0), ("VN2", "320", 1), ("VN2", "321", 2), ("VN3", None, 3))
    )
    norms = frame(
        spark,
        "sheet string, row_no int, aircraft_code string, product_code string, hours string, hours2 string, is_active boolean",
        ("s1", 0, "787", "A06", "2", None, True),
        ("s1", 1, " 787 ", "A06", "3", "0.5", True),
        ("s2", 0, "787", "A06", "bad", "1", True),
        ("s2", 1, "787", "A06", "100", "1", False),
        ("s2", 2, "787", "A06", "100", "1", None),
        ("s3", 0, "none", "A06", "9", None, True),
        ("s3", 1, "787", "NaN", "9", None, True),
        ("s3", 2, "787", None, "9", None, True),
        ("s4", 0, "787", "A06", "0", None, True),
    )
    return registrations, norms


def test_totals_with_bonus_and_empty_packages(spark):
    df = lines(
        spark,
        "workpack_id seq title planned_min wpno start_date end_date",
        ("A", "2.1", "24-1 (x", "60", "VN1-X-A06", "2024-01-01 10:00:00", "2024-01-03 09:00:00"),
        ("A", "2.1", "24-1 (x", "600", "other", None, None),
        ("A", "4.1", "VNA / y", "30", None, None, None),
        ("B", "5.1", "24-2 (x", "60", "VN2-Z99", None, None),
        ("C", None, "24-2 (x", "60", None, None, None),
    )
    registrations, norms = _lookups(spark)
    totals = packages.package_totals(line_ops.kept_lines(df, CFG), registrations, bonus.bonus_table(norms), CFG)
    columns = ("workpack_id", "ac_name", "wp_type", "ac_type", "days", "base_hours", "coefficient_effect", "adjusted_hours", "bonus_hours", "total_hours", "total_hhmm")
    assert sorted(values(totals, *columns)) == [
        ("A", "VN1", "A06", "787", 2, 1.5, 1.2, 2.7, 6.5, 9.2, "09:12"),
        ("B", "VN2", "Z99", "321", None, 0.0, 0.0, 0.0, 0.0, 0.0, "00:00"),
        ("C", None, None, None, None, 0.0, 0.0, 0.0, 0.0, 0.0, "00:00"),
    ]
    headers = packages.with_aircraft_type(packages.package_headers(df, CFG), registrations)
    # First active row per sheet; 0 h is not listed.
    assert sorted(values(bonus.bonus_breakdown(headers, norms))) == [("A", "s1", 2.0), ("A", "s2", 1.0)]


def test_registration_of_a_null_type_is_the_text_nan(spark):
    registrations, _ = _lookups(spark)
    assert sorted(values(registrations, "regis", "ac_type")) == [("VN1", "787"), ("VN2", "321"), ("VN3", "nan")]


def test_active_flags(spark):
    numbers = frame(spark, "v int, is_active double", (1, 1.0), (2, 0.0), (3, None), (4, 2.0))
    assert values(bonus.active_rows(numbers), "v") == [(1,)]
    texts = frame(spark, "v int, is_active string", (1, "TRUE"), (2, "True"))
    assert values(bonus.active_rows(texts), "v") == []
    assert len(values(bonus.active_rows(frame(spark, "v int", (1,), (2,))), "v")) == 2


def test_bonus_without_one_hour_column(spark):
    rows = frame(spark, "aircraft_code string, product_code string, hours2 double", ("787", "A06", 1.5), ("787", "A06", None))
    assert values(bonus.bonus_table(rows)) == [("A06", "787", 1.5)]
    with pytest.raises(ValueError):
        bonus.bonus_table(rows.drop("hours2"))


def test_special_code_table(spark):
    df = lines(
        spark,
        "workpack_id seq title planned_min special_code wpno start_date end_date",
        ("A", "1.1", "x", "6000", "AA", "VN1-A06", "2024-01-01", "2024-01-02"),
        ("A", "1.2", "x", "600", "BB", None, None, None),
        ("A", "1.3", "x", "600", None, None, None, None),
        ("A", "5.3", "x", "600", "IGNORED", None, None, None),
        ("B", "1.1", "x", "60", None, "VN1-A06", "2024-01-01", "2024-01-02"),
        ("C", "1.1", "x", "60", "CC", "VN9-A06", "2024-01-02", "2024-01-01"),
    )
    registrations, norms = _lookups(spark)
    kept = line_ops.kept_lines(df, CFG)
    table = special_codes.special_code_table(kept, registrations, bonus.bonus_table(norms), CFG)
    got = sorted(values(table, "workpack_id", "line", "label", "hhmm", "avg_hhmm", "workers", "pct_text"), key=str)
    # Total of A: 132 h adjusted + 6.5 h bonus, with the line that has no code.
    assert got == sorted(
        [
            ("A", 1, "AA", "110:00", "55:00", "6 worker(s)", "79.4%"),
            ("A", 2, "BB", "11:00", "05:30", "< 8h/day", "7.9%"),
            ("A", None, "TOTAL", "138:30", "69:15", "8 worker(s)", "100.0%"),
            ("C", 1, "CC", "01:06", None, None, "100.0%"),
            ("C", None, "TOTAL", "01:06", None, None, "100.0%"),
        ],
        key=str,
    )
    usable = special_codes.usable_special_codes(df)
    assert sorted(values(usable)) == [("A", True), ("B", False), ("C", True)]
    summary = special_codes.special_code_summary(special_codes.special_code_hours(kept, CFG))
    shares = {(r["workpack_id"], r["code"]): r["pct"] for r in summary.collect()}
    assert shares[("A", "AA")] == pytest.approx(110 / 132 * 100) and ("A", "IGNORED") not in shares


def test_new_ids_with_null_keys_on_both_sides(spark):
    df = lines(
        spark,
        "seq title",
        ("2.1", "24-1 (x"),
        ("2.2", "24-2 (x"),
        ("2.3", None),
        ("2.4", "  (blank id"),
        ("4.1", "EO-1 / y"),
        ("4.2", "EO-2 / y"),
        ("4.3", "eo-2 / y"),
        (None, "24-9 / z"),
    )
    tasks = frame(spark, "id string", ("24-1",), (None,), (" 24-2",), ("24-1",), ("EO-2",))
    eos = frame(spark, "id string", ("EO-1",), (None,))
    reference = new_tasks.reference_ids(tasks, eos)
    assert sorted(values(reference)) == [("eo", "EO-1"), ("task", " 24-2"), ("task", "24-1"), ("task", "EO-2")]
    found = new_tasks.new_task_ids(df, reference, CFG)
    assert sorted(values(found, "task_id", "source_rank")) == [("", 1), ("24-2", 1), ("24-9", 1), ("EO-2", 0), ("eo-2", 1), ("nan", 1)]
    report = new_tasks.new_task_report(found)
    assert sorted(values(report, "seq", "new_task_id", "seq_missing")) == [
        ("", "24-9", True), ("2.2", "24-2", False), ("4.2", "EO-2", False), ("4.3", "eo-2", False),
    ]
    assert values(new_tasks.new_task_summary(found), "total_new_ids", "unique_seqs") == [(4, 3)]


# (sequence, title, part, name, kind, stock, alternate stock); one branch a row.
TOOL_ROWS = (
    ("3.7", "31-700-10 (01) - PUMP", "P-20", "SEALANT", "N", "0", "0"),  # spare, none left
    ("3.7", "31-700-10 (01) - PUMP", "P-21", "SEALANT B", "N", "0", "7"),  # spare, alternate stock only
    ("2.9", "52-110-03 (04) - DOOR", "K-1", "TORQUE KEY", "Y", "0", "0"),  # tool, none left
    ("2.9", "52-110-03 (04) - DOOR", "K-2", "STAND", "Y", "9", "9"),  # tool in stock
    ("2.10", "52-111-00 (00) - DOOR", "K-1", "TORQUE KEY", "Y", "0", "0"),  # the same part again
    ("4.6", "EO-77 / GALLEY", "", "", "N", "0", "0"),  # no part and no name
    ("4.8", "EO-78 / GALLEY", "K-3", "MIRROR", "Y", "0", "0"),  # an order's tool, none left
)
TOOL_FIELDS = "seq title part_no tool_name tool_flag total_qty alt_qty"


def test_tool_branches(spark):
    df = lines(spark, TOOL_FIELDS, *TOOL_ROWS)
    issues = tools.tool_issues(df, frame(spark, "item string"), CFG)
    assert sorted(values(issues, "seq", "task_id", "part_no", "type")) == [
        ("2.10", "52-111-00", "K-1", "Tool"),
        ("2.9", "52-110-03", "K-1", "Tool"),
        ("3.7", "31-700-10", "P-20", "Spare"),
        ("4.8", "EO-78", "K-3", "Tool"),
    ]
    assert values(tools.tool_summary(issues)) == [("P", 4, 3, 1, 3, 4)]
    assert values(tools.tool_counts_by_type(issues)) == [("P", 3, 1, 0)]


def test_ignore_list_matches_whole_texts(spark):
    df = lines(spark, TOOL_FIELDS, *TOOL_ROWS)
    ignore = frame(spark, "item string", ("k-1",), ("sealant",), ("mirro",), (None,))
    issues = tools.tool_issues(df, ignore, CFG)
    assert sorted(values(issues, "part_no")) == [("K-3",)]


def test_tool_columns(spark):
    df = lines(spark, TOOL_FIELDS, *TOOL_ROWS)
    nothing = frame(spark, "item string")
    with pytest.raises(ValueError, match="alt_qty"):
        tools.tool_issues(df.drop("alt_qty"), nothing, CFG)
    assert "percentage" not in tools.tool_issues(df, nothing, CFG).columns
    assert "percentage" in tools.tool_issues(df.withColumn("percentage", F.lit("5")), nothing, CFG).columns
    unchecked = df.withColumn("has_tool_columns", F.lit(False))
    assert values(tools.tool_issues(unchecked, nothing, CFG)) == []
    repeated = lines(spark, TOOL_FIELDS, TOOL_ROWS[2], TOOL_ROWS[2])
    assert len(values(tools.tool_issues(repeated, nothing, CFG))) == 2


def _type_rows(spark):
    return type_coefficients.type_coefficient_table(
        frame(
            spark,
            "row_no int, aircraft_code string, check_group string, func_group string, coeff string, is_active boolean",
            (0, "787", "A-CHECK", "ENG", "1.5", True),
            (1, " 787 ", "A-CHECK", "ENG", "2.0", True),
            (2, "787", "A-CHECK", "CAB", "bad", True),
            (3, "787", "A-CHECK", "AVI", "9", False),
            (4, "787", "none", "AVI", "9", True),
            (5, "320", "A-CHECK", "ENG", "3", True),
        )
    )


def test_type_coefficients(spark):
    table = _type_rows(spark)
    assert sorted(values(table, "aircraft_code", "type_coefficient")) == [("320", 3.0), ("787", 2.0)]
    assert values(type_coefficients.table_statistics(table)) == [("A-CHECK", 2, 2)]
    df = lines(
        spark,
        "workpack_id seq title planned_min func_group wpno",
        ("A", "2.1", "x", "60", " ENG", "VN1-A06"),
        ("A", "2.1", "x", "60", " ENG", None),
        ("A", "2.2", "x", "60", "CAB", None),
        ("A", "2.3", "x", "60", None, None),
        ("B", "2.1", "x", "60", "ENG", "VN1-Z1"),
        ("C", "2.1", "x", "60", "ENG", "VN7-A06"),
    )
    registrations, _ = _lookups(spark)
    headers = packages.with_aircraft_type(packages.package_headers(df, CFG), registrations)
    rows = type_coefficients.type_coefficient_lines(df, headers, table, CFG)
    got = sorted(values(rows, "row_no", "type_coefficient", "adjusted_hours"))
    assert got == [(0, 2.0, 2.0), (2, 1.0, 1.0), (3, 1.0, 1.0), (4, 1.0, 1.0), (5, 1.0, 1.0)]
    assert values(type_coefficients.type_coefficient_breakdown(df, headers, table, CFG)) == [("A", " ENG", 1.0)]
    raw = dataclasses.replace(CFG, type_coefficient_per_seq=False)
    assert values(type_coefficients.type_coefficient_breakdown(df, headers, table, raw)) == [("A", " ENG", 2.0)]
    totals = type_coefficients.type_coefficient_totals(df, headers, table, CFG)
    assert sorted(values(totals)) == [("A", 3.0, 1.0), ("B", 1.0, 0.0), ("C", 1.0, 0.0)]
    without = type_coefficients.type_coefficient_lines(df.drop("func_group"), headers, table, CFG)
    assert {r[0] for r in values(without, "type_coefficient")} == {1.0}
    pairs = type_coefficients.function_map(df, headers, table, CFG).where("workpack_id = 'A'")
    assert len(values(pairs)) == 3
    small = dataclasses.replace(CFG, function_map_size=2)
    found = type_coefficients.function_map(df, headers, table, small).where("workpack_id = 'A'")
    assert sorted(values(found, "func_group", "type_coefficient")) == [(" ENG", 2.0), ("CAB", 1.0)]
    seen = type_coefficients.first_seen_functions(df, CFG).where("workpack_id = 'A'").orderBy("first_row")
    assert values(seen, "func_group") == [(" ENG",), ("CAB",), (None,)]


def test_last_value_keeps_null(spark):
    rows = frame(spark, "k string, v string, row_no int", ("a", "x", 0), ("a", None, 1), ("b", "y", 0))
    assert sorted(values(keep_first.last_value(rows, ["k"], "v")), key=str) == [("a", None), ("b", "y")]


def test_sample_is_reproducible(spark):
    df = lines(spark, "workpack_id seq", *[(p, f"2.{i}") for p in "AB" for i in range(30)], ("C", "2.1"))
    draw = lambda d, seed=1: sorted(values(sampling.sample_per_package(d, F.col("seq"), 10, seed), "workpack_id", "seq"))
    first = draw(df)
    assert len(first) == 21 and first == draw(df.repartition(7)) and set(first) <= set(values(df, "workpack_id", "seq"))
    assert first != draw(df, seed=2)


def test_quality_checks(spark):
    df = lines(spark, "seq planned_min title", ("2.1", "1", "a"), ("x", "TBD", None), (None, None, " "), ("2.1", "2", "b"))
    assert values(quality.non_numeric_rows(df, "planned_min"), "row_no") == [(1,)]
    assert sorted(values(quality.non_numeric_rows(df, "planned_min", allow_null=False), "row_no")) == [(1,), (2,)]
    assert sorted(values(quality.bad_sequences(df), "row_no")) == [(1,), (2,)]
    assert values(quality.duplicate_sequences(df), "seq", "n") == [("2.1", 2)]
    shares = sorted(values(quality.empty_shares(df, ["title", "seq", "absent"], 0.5)))
    assert shares == [("absent", 1.0, False), ("seq", 0.25, True), ("title", 0.5, True)]
    assert values(quality.empty_shares(df.where("false"), ["title"]), "share", "passes") == [(0.0, True)]
    with pytest.raises(ValueError, match="nope"):
        quality.require_columns(df, ["seq", "nope"])
    assert quality.has_column(df, "seq") and not quality.has_column(df, "nope")


def test_validation_sample(spark):
    df = frame(spark, "Column1 int, Column2 string, Column3 double", (1, "A", 1.5), (2, "B", 2.5), (3, "C", 3.5))
    quality.require_columns(df, ["Column1", "Column2"])
    assert values(quality.non_numeric_rows(df, "Column1")) == [] and len(values(quality.non_numeric_rows(df, "Column2"))) == 3
    assert values(quality.empty_shares(df, ["Column2"])) == [("Column2", 0.0, True)]


def test_rule_findings():
    assert quality.rule_findings(CFG) == []
    odd = EngineConfig(rules=(SeqRule("2", "true", coefficient=11.0), SeqRule("3", "true", coefficient="x")))
    assert quality.rule_findings(odd) == [
        "no rule for prefix 4", "coefficient of prefix 2 is unusual: 11.0", "coefficient of prefix 3 is not a number",
    ]


def test_run_metrics_and_batch_result(spark):
    df = lines(spark, "seq title planned_min", ("2.1", "x", "60"), ("2.1", "x", "60"), (None, "x", "30"), ("5.1", "x", "60"))
    got = {r["stage"]: (r["rows"], r["hours"]) for r in metrics.run_metrics(df, line_ops.kept_lines(df, CFG), CFG).collect()}
    assert got == {"loaded": (4, 3.5), "base": (2, 1.5), "mhr": (1, 1.0), "excluded_mhr": (1, 0.5), "coefficient": (1, 2.2)}
    status = frame(spark, "workpack_id string, status string", ("A", "ok"), ("B", "failed"), ("C", "ok"))
    assert sorted(values(metrics.batch_result(status))) == [("failed", 1), ("ok", 2)]
    observed, observation = metrics.observe_rows(df, "rows seen")
    observed.collect()
    assert observation.get == {"rows": 4}


def test_keep_first_text(spark):
    docs = frame(spark, "doc_id bigint, text string", (3, "same"), (1, "same"), (2, "other"), (4, None), (5, None))
    assert sorted(values(text_dedup.keep_first_text(docs, "text", "doc_id"), "doc_id", "copies")) == [(1, 2), (2, 1), (4, 2)]


def test_type_hours_are_rounded_once(spark):
    """A third of an hour at coefficient 10, alone and over 300 functions."""
    table = frame(
        spark, "check_group string, aircraft_code string, func_group string, type_coefficient double",
        *[("A-CHECK", "787", f"F{i}", 10.0 if i == 0 else 1.1) for i in range(300)],
    )
    registrations = frame(spark, "regis string, ac_type string", ("VN1", "787"))
    for functions, base, extra in ((1, 0.3333, 3.0), (300, 100.0, 12.9667)):
        df = lines(spark, "seq title planned_min func_group wpno", *[(f"2.{i}", "x", "20", f"F{i}", "VN1-A06") for i in range(functions)])
        headers = packages.with_aircraft_type(packages.package_headers(df, CFG), registrations)
        assert values(type_coefficients.type_coefficient_totals(df, headers, table, CFG)) == [("P", base, extra)]


def test_huge_hours_do_not_end_a_run(spark):
    df = lines(spark, "workpack_id seq title planned_min", ("A", "2.1", "x", "1e25"), ("A", "2.2", "x", "60"), ("B", "2.1", "x", "120"), ("C", "2.1", "x", "1e400"))
    from wrenchline.operators import quality
    from wrenchline.operators.lines import kept_lines

    sums = packages.package_sums(kept_lines(df, CFG), CFG)
    assert {r["workpack_id"]: r["base_hours"] for r in sums.collect()} == {"A": 1.0, "B": 2.0, "C": 0.0}
    assert sorted(values(quality.oversized_hours(df), "workpack_id", "seq")) == [("A", "2.1"), ("C", "2.1")]
