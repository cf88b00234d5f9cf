"""Scalar expressions against literal tables and against plain Python."""

import datetime as dt
import math
import random

import pytest
from helpers import evaluate
from pyspark.sql import functions as F

from wrenchline.config import DEFAULT_CONFIG as CFG
from wrenchline.config import EngineConfig
from wrenchline.functions import display, hours, ids, text


def test_hours_to_hhmm(spark):
    cases = {
        2.5: "02:30", 36.5: "36:30", 0.25: "00:15", 10.75: "10:45", 0.0: "00:00",
        123 + 4 / 60: "123:04", -1.0: "00:00", 0.5 / 60: "00:00", 2.5 / 60: "00:02", 1.5 / 60: "00:02", None: None,
    }
    assert evaluate(spark, hours.hours_to_hhmm, cases, "double") == list(cases.values())


def test_hours_to_hhmm_like_python(spark):
    rng = random.Random(3)
    inputs = [rng.uniform(0, 5000) for _ in range(300)] + [n / 120 for n in range(300)]

    def expected(h):
        minutes = int(round(h * 60))
        return f"{minutes // 60:02d}:{minutes % 60:02d}"

    assert evaluate(spark, hours.hours_to_hhmm, inputs, "double") == [expected(h) for h in inputs]


def test_minutes_to_hours(spark):
    cases = {
        "120": 2.0, "90": 1.5, "30": 0.5, "0": 0.0, None: 0.0, "TBD": 0.0, " 60 ": 1.0, " 60\t": 1.0,
        "1e2": 100 / 60, "+6": 0.1, ".5": 0.5 / 60, "5.": 5 / 60, "12d": 0.0, "nan": 0.0, "": 0.0, "1_000": 1000 / 60,
        "1__0": 0.0, "0x10": 0.0, "-30": -0.5,
    }
    assert evaluate(spark, hours.minutes_to_hours, cases) == list(cases.values())
    numeric = lambda c: hours.minutes_to_hours(c, dtype)
    from pyspark.sql.types import DoubleType

    dtype = DoubleType()
    assert evaluate(spark, numeric, [120.0, None, math.nan], "double") == [2.0, 0.0, 0.0]


def test_time_to_hours(spark):
    cases = {
        "1 day 12:30:00": 36.5, "2 days, 01:00:00": 49.0, "-1 days +02:00:00": -22.0, "-02:00:00": -2.0,
        "25:00:00": 25.0, "00:75:00": 1.25, "02:30": 0.0, "1 day 02:30": 0.0, "1:02:03:04": 0.0, "0.5": 0.0,
        "01:00:00.": 0.0, "1DAY 02:00:00": 26.0, "abc": 0.0, None: 0.0, " 02:30:00 ": 2.5,
    }
    assert evaluate(spark, hours.time_to_hours, cases) == pytest.approx(list(cases.values()))

    from pyspark.sql.types import DayTimeIntervalType, DoubleType

    numbers = evaluate(spark, lambda c: hours.time_to_hours(c, DoubleType()), [0.5, 1.0, 7.25, 0.0, -2.0, None], "double")
    assert numbers == [12.0, 1.0, 7.25, 0.0, -2.0, 0.0]
    spans = [dt.timedelta(hours=2, minutes=30), dt.timedelta(days=1, seconds=1.5), None]
    got = evaluate(spark, lambda c: hours.time_to_hours(c, DayTimeIntervalType()), spans, "interval day to second")
    assert got == pytest.approx([2.5, 24 + 1.5 / 3600, 0.0])


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_inclusive_days(spark, zone):
    pairs = [
        ("2024-01-01 10:00", "2024-01-02 09:00", 1),
        ("2024-01-01 10:00", "2024-01-02 10:00", 2),
        ("2024-01-01 00:00", "2024-01-01 00:00", 1),
        ("2024-01-05 00:00", "2024-01-01 00:00", -3),
        ("2024-01-05 10:00", "2024-01-05 09:00", 0),
        ("2024-03-09 12:00", "2024-03-11 12:00", 3),
        ("2024-01-01 00:00", None, None),
        (None, "2024-01-01 00:00", None),
    ]
    for start, end, days in pairs:
        if start and end:
            span = dt.datetime.fromisoformat(end) - dt.datetime.fromisoformat(start)
            assert span.days + 1 == days
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(pairs)], "i int, a string, b string")
        typed = df.select("i", F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
        rows = typed.select("i", hours.inclusive_days(F.col("a"), F.col("b")).alias("d")).orderBy("i").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r["d"] for r in rows] == [d for _, _, d in pairs]


def test_to_timestamp(spark):
    from pyspark.sql.types import StringType

    day = dt.datetime(2024, 1, 2)
    cases = {
        "2024-01-02": day, "2024-01-02 10:30:00": day.replace(hour=10, minute=30), "1/2/2024": day, "01/02/2024 10:30": day.replace(hour=10, minute=30),
        "2-Jan-2024": day, "02 Jan 2024": day, "2024/1/2": day, "soon": None, "": None, None: None,
    }
    assert evaluate(spark, lambda c: hours.to_timestamp(c, StringType()), cases) == list(cases.values())


def test_strip_like_python(spark):
    inputs = [f"{c}a b{c}" for c in map(chr, (9, 10, 11, 12, 13, 28, 31, 32, 0x85, 0xA0, 0x2003, 0x3000, 0x200B))]
    assert evaluate(spark, text.strip, inputs) == [s.strip() for s in inputs]


def test_task_id(spark):
    def task(rows, cfg=CFG):
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, seq string, title string")
        got = df.select("i", ids.task_id(cfg, F.col("seq"), F.col("title")).alias("t")).orderBy("i").collect()
        return [r["t"] for r in got]

    assert task(
        [
            ("2.1", "24-045-00 (00) - ITEM 1"),
            ("4.1", "EO-2024-001 / CABIN AIR SYSTEM"),
            ("2.1", " no bracket "),
            ("4.1", "no slash"),
            ("2.1", "(x"),
            ("1.1", "default / slash"),
            (None, "null seq / slash"),
            ("3.9", None),
        ]
    ) == [
        "24-045-00", "EO-2024-001", "no bracket", "no slash", "", "default", "null seq", "nan",
    ]
    whole = EngineConfig(default_id_method="none")
    assert task([("1.1", " all / of (it) ")], whole) == ["all / of (it)"]


def test_prefix(spark):
    assert evaluate(spark, ids.seq_prefix, ["2.1", "3.45", "10", None, ".5", "1.2.3"]) == ["2", "3", "10", "nan", "", "1"]


def test_seq_coefficient(spark):
    cases = {"2.1": 2.2, "3.0": 2.2, "2.999": 2.2, "4.5": 1.1, "1.1": 1.1, "0.1": 1.1, "99.9": 1.1, None: 1.1, "20.1": 1.1}
    assert evaluate(spark, lambda c: ids.seq_coefficient(CFG, c), cases) == list(cases.values())
    skipped = lambda c: ids.seq_coefficient(CFG, F.lit("2.1"), c)
    assert evaluate(spark, skipped, ["VNA-1", "xx vna", "24-1", "", None]) == [1.0, 1.0, 2.2, 2.2, 2.2]
    null_seq = lambda c: ids.seq_coefficient(CFG, F.lit(None).cast("string"), c)
    assert evaluate(spark, null_seq, ["VNA-1", "24-1"]) == [1.0, 1.1]


def test_rule_keys_are_upper_cased_and_values_exact(spark):
    from wrenchline.config import SeqRule

    cfg = EngineConfig(rules=(SeqRule("a", "ignore"), SeqRule("b", "Ignore"), SeqRule("c", "false")))
    assert evaluate(spark, lambda c: ids.should_process(cfg, c), ["A.1", "a.1", "B.1", "C.1"]) == [False, True, True, True]
    checks = evaluate(spark, lambda c: ids.should_check_reference(cfg, c), ["A.1", "a.1", "B.1", "C.1"])
    assert checks == [False, True, False, False]


def test_header_split(spark):
    values = ["VN1-X-A06", "single", " VN2 - C12 ", None, "A-"]
    assert evaluate(spark, ids.aircraft_name, values) == ["VN1", "single", "VN2", None, "A"]
    assert evaluate(spark, ids.package_type, values) == ["A06", "single", "C12", None, ""]
    documented = lambda c: ids.aircraft_name(c, "last")
    assert evaluate(spark, documented, ["VN-A123-A06", "single"]) == ["VN-A123", "single"]


def test_check_group(spark):
    cases = {"A06": "A-CHECK", "c12": "C-CHECK", "Y01": "Y-CHECK", "B1": None, "": None, None: None}
    assert evaluate(spark, ids.check_group, cases) == list(cases.values())


def test_seq_format(spark):
    cases = {
        "2.1": True, "3.45": True, "2": False, "a.1": False, "2.": False, "2.1.x": True, " 2.1 ": True, "-1.+2": True,
        "2 . 1": True, "1_0.1": False, None: False, "": False, ".1": False,
    }
    assert evaluate(spark, ids.is_valid_seq, cases) == list(cases.values())


def test_percentages_like_python(spark):
    rng = random.Random(5)
    inputs = [rng.uniform(-50, 2000) for _ in range(300)] + [n / 20 for n in range(200)] + [0.25, 0.35, 12345.65]
    assert evaluate(spark, display.percent_text, inputs, "double") == [f"{p:.1f}%" for p in inputs]
    fractions = {0.255: "25.5%", None: "0.0%", math.nan: "0.0%", 0.5: "50.0%"}
    assert evaluate(spark, display.format_percentage, fractions, "double") == list(fractions.values())
    assert evaluate(spark, lambda c: display.format_percentage(c, 2), [0.5, None], "double") == ["50.00%", "0.0%"]
    assert evaluate(spark, lambda c: display.format_percentage(c, 0), [0.5], "double") == ["50%"]


def test_display_defaults(spark):
    assert evaluate(spark, display.clean, ["  hello  ", None, "\t"]) == ["hello", "", ""]
    long = "This is a very long string"
    assert evaluate(spark, lambda c: display.truncate(c, 10), [long, "short", None]) == ["This is...", "short", ""]
    assert evaluate(spark, lambda c: display.truncate(c, 2), [long]) == [long[: 2 - 3] + "..."]
    assert evaluate(spark, display.seq_display, [" 2.1 ", None]) == ["2.1", "N/A"]
    assert evaluate(spark, display.task_id_display, ["24-1 ", None, "NaN"]) == ["24-1", "(No ID)", "(No ID)"]
    assert evaluate(spark, display.special_code_display, ["A ", None, " ", "nan"]) == ["A", "(No Code)", "(No Code)", "(No Code)"]
    assert evaluate(spark, display.tool_type, ["Y", " n ", None, "X", ""]) == ["Tool", "Spare", "Unknown", "X", ""]


def test_workers_per_day(spark):
    cases = {7.99: "< 8h/day", 8.0: "1 worker(s)", 23.9: "2 worker(s)", 0.0: "< 8h/day", None: None}
    assert evaluate(spark, display.workers_per_day, cases, "double") == list(cases.values())
    shift = lambda c: display.workers_per_day(c, 10)
    assert evaluate(spark, shift, [9.0, 10.0], "double") == ["< 8h/day", "1 worker(s)"]
