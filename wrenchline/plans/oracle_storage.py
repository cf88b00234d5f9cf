"""SQL of the queries that go through storage or take their rules from tables."""

from __future__ import annotations

from wrenchline.plans.oracle import _ISSUES, _LINES, _POS, _WP, _sum
from wrenchline.plans.oracle import ORACLES as ORACLES_OF_LINES

_SPACE = r"[\t-\r\x1c- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

_SITED = f"""{_LINES},
sited AS (
  SELECT ln.*, n_name AS site, n_nationkey AS k, split_part(coalesce(seq, 'nan'), '.', 1) AS prefix
  FROM ln LEFT JOIN customer ON c_custkey = workpack_id LEFT JOIN nation ON n_nationkey = c_nationkey
),
ruled AS (
  SELECT *, CASE WHEN k % 5 = 1 AND prefix = '4' THEN 'keep' WHEN k % 5 = 3 AND prefix = '5' THEN 'true'
      WHEN prefix IN ('5', '6', '7', '8', '9', '10') THEN 'ignore' ELSE 'true' END AS base_mode,
    CASE WHEN prefix IN ('2', '3', '5', '6', '7', '8', '9', '10') THEN '-' ELSE '/' END AS id_method,
    CASE WHEN k % 5 = 1 AND prefix = '4' THEN 1.0::double + k / 100.0::double WHEN k % 5 = 3 AND prefix = '5' THEN 3.0::double
      WHEN prefix IN ('2', '3') THEN 2.2::double ELSE 1.1::double END AS coefficient,
    CASE WHEN k % 5 = 1 AND prefix = '4' OR k % 5 = 3 AND prefix IN ('5', '99') THEN 1
      WHEN prefix IN ('2', '3', '4', '5', '6', '7', '8', '9', '10') THEN 3 ELSE 4 END AS level
  FROM sited
),
modes AS (
  SELECT *, CASE WHEN k % 5 = 2 AND prefix = '3' THEN 'ignore' ELSE base_mode END AS mhr_mode,
    CASE WHEN prefix IN ('5', '6', '7', '8', '9', '10') THEN 'true' ELSE base_mode END AS tool_mode
  FROM ruled
)"""

_HOURS = "CASE WHEN seq IS NOT NULL AND mhr_mode <> 'ignore' THEN {0} END"

_ONE_FORMAT = """SELECT '{0}' AS format, 'P' || (workpack_id % 8) AS workpack_id, CASE WHEN workpack_id % 8 = 5 THEN 'failed' ELSE 'ok' END AS status,
  CASE WHEN workpack_id % 8 = 5 THEN 0 ELSE count(*) END AS "rows",
  CASE WHEN workpack_id % 8 = 5 THEN 'Missing required columns: forecast.est_mh' END AS error,
  CASE WHEN workpack_id % 8 <> 5 THEN {1} END AS base_hours,
  CASE WHEN workpack_id % 8 <> 5 THEN count(seq) END AS with_seq, CASE WHEN workpack_id % 8 <> 5 THEN count(title) END AS with_title,
  CASE workpack_id % 8 WHEN 5 THEN NULL WHEN 6 THEN count(*) ELSE 0 END AS with_event,
  CASE WHEN workpack_id % 8 <> 5 THEN workpack_id % 8 = 6 END AS has_event
FROM ln GROUP BY workpack_id % 8"""

#: Datasets of a run and the queries that give the same rows.
_DATASETS = {
    "totals": "q12_totals", "high_tasks": "q07_high_hours", "new_task_ids": "q16_new_task_ids", "new_id_summary": "q17_new_id_summary",
    "bonus_breakdown": "q11_bonus_breakdown", "coefficient_summary": "q20_coefficient_summary", "run_metrics": "q37_run_metrics",
    "sample": "q26_sample", "type_coefficients": "q23_type_coeff_breakdown", "type_coefficient_totals": "q38_type_coeff_totals",
}
_SWITCHED = {
    "special_codes": "q14_special_table", "tool_issues": "q18_tool_issues", "tool_summary": "q19_tool_summary", "tool_counts": "q39_tool_counts",
}


def _rows_of(switches: str, datasets: dict[str, str]) -> list[str]:
    return [f"SELECT '{switches}' AS switches, '{d}' AS dataset, count(*) AS \"rows\" FROM ({ORACLES_OF_LINES[q]}) HAVING count(*) > 0" for d, q in datasets.items()]


ORACLES = {
    "q46_file_columns": """WITH shapes(shape, odd, missing, has_title, names) AS (
        VALUES ('plain', 1, 'forecast.event_display, forecast.est_mh', false, ['SEQ string', 'prq2.partno string', 'Start_date timestamp_ntz']),
          ('full', 0, '', true, ['SEQ string', 'forecast.event_display string', 'forecast.est_mh double'])),
        counts AS (SELECT l_linenumber % 2 AS odd, count(*) AS lines FROM lineitem GROUP BY ALL),
        named AS (SELECT shape, odd, missing, has_title, unnest(names) AS name FROM shapes)
        SELECT shape, split_part(name, ' ', 1) AS column_name, split_part(name, ' ', 2) AS column_type, lines, missing, has_title
        FROM named JOIN counts USING (odd)""",
    "q47_isolated_exports": f"WITH {_LINES} "
    + " UNION ALL ".join(_ONE_FORMAT.format(f, f"coalesce({_sum('base_hours')}, 0)") for f in ("csv", "json", "parquet")),
    "q48_sink_round_trip": f"""WITH {_LINES}, s AS (SELECT workpack_id, count(*) AS lines, {_sum('base_hours')} AS hours FROM ln GROUP BY workpack_id)
        SELECT workpack_id, lines, CASE WHEN workpack_id % 5 = 2 THEN hours * 2 ELSE hours END AS hours,
          CASE WHEN workpack_id % 5 = 2 THEN 2 ELSE 1 END AS version, (SELECT count(*) FROM s) AS manifest_rows,
          (SELECT count(DISTINCT workpack_id) FROM s) AS manifest_packages FROM s""",
    "q49_text_records": rf"""WITH texts AS (
          SELECT doc_id, list_transform(regexp_split_to_array(regexp_replace(text, '\r?\n\z', ''), '\r?\n'),
            lambda x: regexp_replace(x, '^{_SPACE}+|{_SPACE}+$', '', 'g')) AS lines
          FROM documents WHERE text <> ''
        ), recs AS (
          SELECT doc_id, unnest(range(0, len(lines), 4)) AS first, lines FROM texts
        )
        SELECT doc_id, first // 4 AS record_no, md5(lines[first + 1]) AS question_md5, CAST(least(3, len(lines) - first - 1) AS integer) AS n_answers,
          md5(array_to_string(lines[first + 2 : first + 4], chr(10))) AS answers_md5, first + 4 <= len(lines) AS complete
        FROM recs QUALIFY row_number() OVER (PARTITION BY lines[first + 1] ORDER BY doc_id, first) = 1""",
    "q50_hours_reconciliation": f"""WITH {_LINES}, rows_ AS (
          SELECT workpack_id, CASE WHEN l_partkey % 17 = 0 THEN 'missing' WHEN l_suppkey % 13 = 3 THEN 'different' END AS finding,
            CASE WHEN l_partkey % 17 = 0 THEN NULL WHEN l_suppkey % 13 = 3 THEN abs((base_hours + 0.5::double) - base_hours)
              WHEN l_suppkey % 13 = 4 THEN abs((base_hours + 0.005::double) - base_hours) ELSE 0 END AS off FROM ln
          UNION ALL SELECT workpack_id, 'unexpected', NULL FROM ln WHERE l_suppkey % 29 = 1 AND l_linenumber = 1
        )
        SELECT workpack_id, count(*) FILTER (finding IS NULL) AS matching, count(*) FILTER (finding = 'different') AS different,
          count(*) FILTER (finding = 'missing') AS missing, count(*) FILTER (finding = 'unexpected') AS unexpected,
          coalesce(max(off), 0) AS largest FROM rows_ GROUP BY workpack_id""",
    "q51_site_rules": f"""WITH {_SITED} SELECT workpack_id, {_POS}, site, base_mode, mhr_mode, base_mode AS newtask_mode, tool_mode, id_method,
        coefficient, CAST(level AS integer) AS level, base_mode <> 'ignore' AS processed, base_mode = 'true' AS check_ref FROM modes""",
    "q52_site_hours": f"""WITH {_SITED} SELECT site, count(*) AS lines, count(*) FILTER (base_mode <> 'true') AS unchecked,
        coalesce({_sum(_HOURS.format('base_hours'))}, 0) AS base_hours, coalesce({_sum(_HOURS.format('base_hours * coefficient'))}, 0) AS adjusted_hours
        FROM modes WHERE base_mode <> 'ignore' GROUP BY site""",
    "q53_site_rule_findings": """SELECT n_name AS site, '4' AS prefix, 'no mode' AS finding FROM nation WHERE n_nationkey % 5 IN (2, 3)
        UNION ALL SELECT NULL, '4', 'no mode'
        UNION ALL SELECT n_name, '99', 'unusual coefficient' FROM nation WHERE n_nationkey % 5 = 3 AND n_nationkey + 0.5 > 10""",
    "q54_union_sheets": """SELECT CAST(p_partkey AS varchar) AS key, p_name AS name, CAST(p_size AS double) AS amount, NULL AS brand, 'whole' AS sheet, 0 AS sheet_no FROM part
        UNION ALL SELECT NULL, NULL, p_size / 4.0::double, p_brand, 'priced', 1 FROM part WHERE p_partkey % 3 = 0
        UNION ALL SELECT 'K' || p_partkey, p_type, NULL, NULL, 'coded', 2 FROM part WHERE p_partkey % 5 = 0""",
    "q55_ignore_file": """SELECT DISTINCT CASE p_partkey % 6 WHEN 4 THEN 'std-' || (p_partkey % 100) ELSE lower(p_name) END AS item
        FROM part WHERE p_partkey % 6 >= 3""",
    "q56_tool_percentages": f"""WITH {_ISSUES.replace(_WP, _WP.replace('o_orderdate AS start_date', 'CASE WHEN l_partkey % 3 = 0 THEN l_discount END AS percentage, o_orderdate AS start_date'))}
        SELECT workpack_id, {_POS}, part_no, type, percentage FROM issues""",
    # What every stage counts is the same, however it is computed.
    "q57_group_metrics": ORACLES_OF_LINES["q37_run_metrics"],
    "q58_report_datasets": " UNION ALL ".join([*_rows_of("on", _DATASETS | _SWITCHED), *_rows_of("off", _DATASETS)]),
}
