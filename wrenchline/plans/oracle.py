"""The catalogue's queries as SQL, written from the rules and not from the DataFrames.

The statements spell out rules, coefficients and joins in their own way, so that
an error in an operator does not repeat here.
"""

from __future__ import annotations

_WP = """
wp AS (
  SELECT o_custkey AS workpack_id, l_orderkey, l_linenumber, l_partkey, l_suppkey,
    'VN' || o_custkey || '-X-' ||
      CASE o_custkey % 5 WHEN 0 THEN 'A06' WHEN 1 THEN 'C12' WHEN 2 THEN 'Y01' WHEN 3 THEN 'A12' ELSE 'Z99' END AS wpno,
    CASE WHEN l_partkey % 37 = 0 THEN NULL ELSE l_linenumber || '.' || (l_orderkey % 20) END AS seq,
    CASE WHEN l_partkey % 53 = 0 THEN NULL
      WHEN l_linenumber = 4 THEN CASE WHEN l_partkey % 4 = 0 THEN 'EO-' ELSE 'TC-' END || (l_partkey % 500) || ' / ' || p_name
      WHEN l_partkey % 50 = 7 THEN 'VNA-' || (l_partkey % 500) || ' (00) - ' || p_name
      ELSE '24-' || (l_partkey % 500) || ' (' || p_size || ') - ' || p_name END AS title,
    CASE WHEN l_partkey % 43 = 0 THEN NULL WHEN l_partkey % 41 = 0 THEN 'TBD'
      ELSE CAST(CAST(l_quantity * 30 AS int) AS varchar) END AS planned_min,
    CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_returnflag || l_linestatus END AS special_code,
    p_type AS func_group,
    p_name AS tool_name,
    CASE WHEN l_partkey % 29 = 0 THEN '' ELSE 'STD-' || l_partkey END AS part_no,
    CASE WHEN l_partkey % 31 = 0 THEN NULL WHEN l_partkey % 23 = 0 THEN 'X'
      WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END AS tool_flag,
    CASE WHEN l_partkey % 47 = 0 THEN 'bad' ELSE CAST(l_partkey % 5 AS varchar) END AS total_qty,
    CASE WHEN l_partkey % 2 = 0 THEN NULL ELSE CAST(l_partkey % 3 AS varchar) END AS alt_qty,
    o_orderdate AS start_date,
    l_shipdate AS end_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
)"""

_POS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"

# Per line: base gate, check flag, ID, hours, coefficient.
_LINES = f"""{_WP},
ln AS (
  SELECT *,
    split_part(coalesce(seq, 'nan'), '.', 1) NOT IN ('5', '6', '7', '8', '9', '10') AS passes,
    trim(CASE WHEN split_part(coalesce(seq, 'nan'), '.', 1) IN ('2', '3', '5', '6', '7', '8', '9', '10')
      THEN split_part(coalesce(title, 'nan'), '(', 1)
      ELSE split_part(coalesce(title, 'nan'), '/', 1) END) AS task_id,
    CASE WHEN regexp_full_match(planned_min, '[0-9]+') THEN CAST(planned_min AS double) ELSE 0.0::double END / 60.0::double AS base_hours
  FROM wp
),
lc AS (
  SELECT *, CASE WHEN contains(upper(task_id), 'VNA') THEN 1.0::double
      WHEN split_part(seq, '.', 1) IN ('2', '3') THEN 2.2::double ELSE 1.1::double END AS coefficient
  FROM ln
)"""

_BASE = f"""{_LINES},
base AS (
  SELECT *, base_hours * coefficient AS adjusted_hours FROM lc WHERE passes
  QUALIFY row_number() OVER (PARTITION BY workpack_id, seq ORDER BY {_POS}) = 1
),
mhr AS (SELECT * FROM base WHERE seq IS NOT NULL AND passes)"""


def _sum(expression: str) -> str:
    return f"CAST(round(sum(CAST({expression} AS decimal(28,8))), 4) AS double)"


_PACKAGES = f"""
regis AS (
  SELECT 'VN' || c_custkey AS regis, c_mktsegment AS ac_type FROM customer WHERE c_custkey % 11 <> 0
),
head AS (
  SELECT workpack_id, split_part(wpno, '-', 1) AS ac_name, split_part(wpno, '-', -1) AS wp_type, start_date, end_date,
    CAST(floor((epoch_us(end_date) - epoch_us(start_date)) / 86400000000.0) AS bigint) + 1 AS days
  FROM wp QUALIFY row_number() OVER (PARTITION BY workpack_id ORDER BY {_POS}) = 1
),
pkg AS (
  SELECT head.*, ac_type, CASE upper(wp_type[1]) WHEN 'A' THEN 'A-CHECK' WHEN 'C' THEN 'C-CHECK' WHEN 'Y' THEN 'Y-CHECK' END AS check_group
  FROM head LEFT JOIN regis ON ac_name = regis
)"""

_NORMS = """
norms AS (
  SELECT p_brand AS sheet, p_partkey AS row_no,
    CASE p_partkey % 5 WHEN 0 THEN 'MACHINERY' WHEN 1 THEN 'BUILDING' WHEN 2 THEN 'AUTOMOBILE' WHEN 3 THEN 'FURNITURE' ELSE 'HOUSEHOLD' END AS aircraft_code,
    CASE p_partkey % 7 WHEN 0 THEN 'A06' WHEN 1 THEN 'C12' WHEN 2 THEN 'Y01' WHEN 3 THEN 'A12' WHEN 4 THEN 'none' ELSE 'B01' END AS product_code,
    CAST(p_size AS double) / 4 + CASE WHEN p_partkey % 2 = 0 THEN 0 ELSE 0.5 END AS bonus
  FROM part WHERE p_partkey % 3 <> 0
)"""

_BONUS = f"""{_NORMS},
bonus AS (
  SELECT product_code, aircraft_code, {_sum('bonus')} AS bonus_hours
  FROM norms WHERE product_code <> 'none' GROUP BY ALL
)"""

_TOTALS = f"""{_BASE}, {_PACKAGES}, {_BONUS},
sums AS (
  SELECT workpack_id, {_sum('base_hours')} AS base_hours, {_sum('adjusted_hours')} AS adjusted_hours,
    CAST(round(sum(CAST(adjusted_hours AS decimal(28,8))) - sum(CAST(base_hours AS decimal(28,8))), 4) AS double) AS coefficient_effect
  FROM mhr GROUP BY ALL
),
totals AS (
  SELECT pkg.*, coalesce(base_hours, 0) AS base_hours, coalesce(adjusted_hours, 0) AS adjusted_hours,
    coalesce(coefficient_effect, 0) AS coefficient_effect, coalesce(bonus_hours, 0) AS bonus_hours,
    coalesce(adjusted_hours, 0) + coalesce(bonus_hours, 0) AS total_hours
  FROM pkg LEFT JOIN sums USING (workpack_id)
  LEFT JOIN bonus ON product_code = wp_type AND aircraft_code = ac_type
)"""


def _hhmm(h: str) -> str:
    minutes = f"CAST(round_even({h} * 60, 0) AS bigint)"
    return f"CASE WHEN {h} < 0 THEN '00:00' WHEN {h} IS NOT NULL THEN printf('%02d:%02d', {minutes} // 60, {minutes} % 60) END"


def _workers(h: str) -> str:
    return f"CASE WHEN {h} / 8 < 1 THEN '< 8h/day' WHEN {h} IS NOT NULL THEN CAST(CAST(floor({h} / 8) AS bigint) AS varchar) || ' worker(s)' END"


_CODES = f"""{_TOTALS},
codes AS (
  SELECT c.workpack_id, c.special_code, c.hours, t.days, t.adjusted_hours, t.total_hours,
    CASE WHEN days > 0 THEN c.hours / days END AS hours_per_day,
    CAST(row_number() OVER (PARTITION BY c.workpack_id ORDER BY c.hours DESC, c.special_code) AS integer) AS rank
  FROM (SELECT workpack_id, special_code, {_sum('adjusted_hours')} AS hours
        FROM mhr WHERE special_code IS NOT NULL GROUP BY ALL) c
  JOIN totals t USING (workpack_id)
)"""

_REFERENCE = """
known AS (
  SELECT DISTINCT 'task' AS kind, '24-' || (p_partkey % 500) AS id FROM part WHERE (p_partkey % 500) % 3 <> 0
  UNION SELECT DISTINCT 'task', 'TC-' || (p_partkey % 500) FROM part WHERE (p_partkey % 500) % 5 <> 0
  UNION SELECT DISTINCT 'eo', 'EO-' || (p_partkey % 500) FROM part WHERE (p_partkey % 500) % 4 = 0 AND (p_partkey % 500) % 8 <> 0
)"""

# No checked prefix has another mode than "true", so passing the gate is enough.
_NEW_IDS = f"""{_LINES}, {_REFERENCE},
fresh AS (
  SELECT * FROM ln WHERE passes
  QUALIFY row_number() OVER (PARTITION BY workpack_id, seq ORDER BY {_POS}) = 1
),
found AS (
  SELECT *, starts_with(task_id, 'EO') AS is_eo FROM fresh f
  WHERE lower(task_id) <> 'nan' AND trim(task_id) <> ''
    AND NOT EXISTS (SELECT 1 FROM known k WHERE k.id = f.task_id
                    AND k.kind = CASE WHEN starts_with(f.task_id, 'EO') THEN 'eo' ELSE 'task' END)
)"""

_IGNORED = """
ignored AS (
  SELECT DISTINCT lower(p_name) AS item FROM part WHERE p_name LIKE '%anvil'
  UNION SELECT 'std-' || p_partkey FROM part WHERE p_partkey % 70 = 0
)"""

_TYPE_LABEL = """CASE WHEN tool_flag IS NULL THEN 'Unknown' WHEN upper(trim(tool_flag)) = 'Y' THEN 'Tool'
      WHEN upper(trim(tool_flag)) = 'N' THEN 'Spare' ELSE tool_flag END"""

_ISSUES = f"""{_LINES}, {_IGNORED},
issues AS (
  SELECT *, {_TYPE_LABEL} AS type FROM ln
  WHERE coalesce(try_cast(total_qty AS double), 0) = 0 AND coalesce(try_cast(alt_qty AS double), 0) = 0
    AND trim(coalesce(tool_name, '')) <> '' AND trim(coalesce(part_no, '')) <> ''
    AND NOT EXISTS (SELECT 1 FROM ignored WHERE item = lower(trim(part_no)))
    AND NOT EXISTS (SELECT 1 FROM ignored WHERE item = lower(trim(tool_name)))
)"""

_TYPE_TABLE = """
tc AS (
  SELECT check_group, aircraft_code, func_group, arg_max(coeff, row_no) AS coeff FROM (
    SELECT p_partkey AS row_no, p_type AS func_group, 1.0::double + p_size / 100.0::double AS coeff,
      CASE p_partkey % 5 WHEN 0 THEN 'MACHINERY' WHEN 1 THEN 'BUILDING' WHEN 2 THEN 'AUTOMOBILE' WHEN 3 THEN 'FURNITURE' ELSE 'HOUSEHOLD' END AS aircraft_code,
      CASE p_partkey % 3 WHEN 0 THEN 'A-CHECK' WHEN 1 THEN 'C-CHECK' ELSE 'Y-CHECK' END AS check_group
    FROM part WHERE p_partkey % 4 <> 0)
  GROUP BY ALL
)"""

_TYPED = f"""{_BASE}, {_PACKAGES}, {_TYPE_TABLE},
typed AS (
  SELECT m.* EXCLUDE (coefficient, adjusted_hours), coalesce(coeff, 1.0::double) AS type_coefficient
  FROM mhr m JOIN pkg p USING (workpack_id)
  LEFT JOIN tc ON tc.check_group = p.check_group AND tc.aircraft_code = p.ac_type AND tc.func_group = m.func_group
),
per_function AS (
  SELECT workpack_id, func_group, {_sum('base_hours')} AS base_total,
    CAST(round(sum(CAST(base_hours * type_coefficient AS decimal(28,8))) - sum(CAST(base_hours AS decimal(28,8))), 4) AS double) AS additional_hours
  FROM typed GROUP BY workpack_id, func_group
)"""

_RULES = """
rules(prefix, base, mhr, newtask, tool, id_method, coefficient) AS (
  VALUES ('2', 'true', 'true', 'true', 'true', '-', 2.2::double),
    ('3', 'true', 'true', 'true', 'true', '-', 2.2::double),
    ('4', 'true', 'true', 'true', 'true', '/', 1.1::double),
    ('5', 'ignore', 'ignore', 'ignore', 'true', '-', 1.1::double),
    ('6', 'ignore', 'ignore', 'ignore', 'true', '-', 1.1::double),
    ('7', 'ignore', 'ignore', 'ignore', 'true', '-', 1.1::double),
    ('8', 'ignore', 'ignore', 'ignore', 'true', '-', 1.1::double),
    ('9', 'ignore', 'ignore', 'ignore', 'true', '-', 1.1::double),
    ('10', 'ignore', 'ignore', 'ignore', 'true', '-', 1.1::double)
),
used AS (SELECT split_part(coalesce(seq, 'nan'), '.', 1) AS prefix, count(*) AS lines FROM wp GROUP BY ALL)"""


def _share(column: str) -> str:
    share = f"sum(CASE WHEN {column} IS NULL OR trim({column}) = '' THEN 1 ELSE 0 END)::double / count(*)"
    return f"SELECT '{column}' AS \"column\", {share} AS share, {share} <= 0.3 AS passes FROM wp"


_STAGE_SUM = "coalesce(" + _sum("base_hours") + ", 0)"

ORACLES = {
    "q01_rules": f"""WITH {_WP}, {_RULES}
        SELECT prefix, coalesce(base, 'true') AS base, coalesce(mhr, 'true') AS mhr, coalesce(newtask, 'true') AS newtask,
          coalesce(tool, 'true') AS tool, coalesce(id_method, '/') AS id_method, coalesce(coefficient, 1.1::double) AS coefficient,
          base IS NOT NULL AS has_rule, coalesce(lines, 0) AS lines
        FROM rules FULL JOIN used USING (prefix)""",
    "q02_base_gate": f"WITH {_LINES} SELECT workpack_id, {_POS}, task_id, true AS check_ref FROM ln WHERE passes",
    "q03_base_hours": f"WITH {_LINES} SELECT workpack_id, {_POS}, base_hours FROM ln",
    "q04_keep_first": f"WITH {_BASE} SELECT workpack_id, {_POS}, seq FROM base",
    "q05_mhr_rows": f"WITH {_BASE} SELECT workpack_id, {_POS}, seq FROM mhr",
    "q06_seq_coefficient": f"WITH {_BASE} SELECT workpack_id, {_POS}, seq, coefficient, adjusted_hours FROM mhr",
    "q07_high_hours": f"""WITH {_BASE} SELECT workpack_id, seq, title, task_id, {_hhmm('base_hours')} AS base_mhrs,
        seq IS NULL OR trim(seq) = '' AS seq_missing FROM mhr WHERE base_hours > 16""",
    "q08_package_header": f"""WITH {_WP}, {_PACKAGES} SELECT workpack_id, ac_name, wp_type, ac_type, check_group,
        strftime(start_date, '%Y-%m-%d') AS start_date, strftime(end_date, '%Y-%m-%d') AS end_date, CAST(days AS integer) AS days FROM pkg""",
    "q09_bonus_table": f"WITH {_BONUS} SELECT * FROM bonus",
    "q10_package_bonus": f"""WITH {_WP}, {_PACKAGES}, {_BONUS} SELECT workpack_id, coalesce(bonus_hours, 0) AS bonus_hours
        FROM pkg LEFT JOIN bonus ON product_code = wp_type AND aircraft_code = ac_type""",
    "q11_bonus_breakdown": f"""WITH {_WP}, {_PACKAGES}, {_NORMS},
        firsts AS (SELECT * FROM norms
          QUALIFY row_number() OVER (PARTITION BY sheet, product_code, aircraft_code ORDER BY row_no) = 1)
        SELECT workpack_id, sheet, bonus AS bonus_hours FROM pkg
        JOIN firsts ON product_code = wp_type AND aircraft_code = ac_type WHERE bonus > 0""",
    "q12_totals": f"""WITH {_TOTALS} SELECT workpack_id, base_hours, coefficient_effect, adjusted_hours, bonus_hours, total_hours,
        {_hhmm('base_hours')} AS base_hhmm, {_hhmm('total_hours')} AS total_hhmm FROM totals""",
    "q13_special_codes": f"WITH {_CODES} SELECT workpack_id, special_code, hours, hours_per_day, rank FROM codes",
    "q14_special_table": f"""WITH {_CODES},
        line AS (
          SELECT workpack_id, rank AS line, special_code AS label, hours, hours_per_day,
            CASE WHEN total_hours > 0 THEN hours / total_hours * 100 ELSE 0 END AS pct FROM codes
          UNION ALL
          SELECT workpack_id, NULL, 'TOTAL', total_hours, CASE WHEN days > 0 THEN total_hours / days END, 100.0
          FROM totals WHERE workpack_id IN (SELECT workpack_id FROM codes))
        SELECT workpack_id, line, label, {_hhmm('hours')} AS hhmm, {_hhmm('hours_per_day')} AS avg_hhmm,
          {_workers('hours_per_day')} AS workers, pct, printf('%.1f%%', pct) AS pct_text FROM line""",
    "q15_special_summary": f"""WITH {_CODES} SELECT workpack_id, special_code AS code, hours, hours / adjusted_hours * 100 AS pct
        FROM codes WHERE adjusted_hours > 0""",
    "q16_new_task_ids": f"""WITH {_NEW_IDS} SELECT workpack_id, coalesce(seq, '') AS seq, task_id AS new_task_id,
        coalesce(title, '') AS description, is_eo, CASE WHEN is_eo THEN 0 ELSE 1 END AS source_rank,
        seq IS NULL AS seq_missing FROM found""",
    "q17_new_id_summary": f"""WITH {_NEW_IDS} SELECT workpack_id, count(*) AS total_new_ids, count(DISTINCT seq) AS unique_seqs
        FROM found GROUP BY ALL""",
    "q18_tool_issues": f"""WITH {_ISSUES} SELECT workpack_id, {_POS}, seq, task_id, part_no, tool_name, type,
        seq IS NULL AS seq_missing FROM issues""",
    "q19_tool_summary": f"""WITH {_ISSUES} SELECT workpack_id, count(*) AS total_issues,
        count(*) FILTER (type = 'Tool') AS total_tools, count(*) FILTER (type = 'Spare') AS total_spares,
        count(DISTINCT part_no) AS unique_parts, count(DISTINCT seq) AS affected_seqs FROM issues GROUP BY workpack_id""",
    "q20_coefficient_summary": f"""WITH {_BASE} SELECT workpack_id, coefficient, count(*) AS "rows", count(seq) AS "count",
        {_sum('base_hours')} AS base_hours, {_sum('adjusted_hours')} AS adjusted_hours, coefficient = 1.0 AS is_skip_value
        FROM mhr GROUP BY workpack_id, coefficient""",
    "q21_type_coeff_table": f"""WITH {_TYPE_TABLE} SELECT check_group, count(DISTINCT aircraft_code) AS aircrafts,
        count(DISTINCT aircraft_code || '|' || func_group) AS functions FROM tc GROUP BY check_group""",
    "q22_type_coeff_lines": f"""WITH {_TYPED} SELECT workpack_id, {_POS}, type_coefficient,
        base_hours * type_coefficient AS adjusted_hours FROM typed""",
    "q23_type_coeff_breakdown": f"""WITH {_TYPED} SELECT workpack_id, func_group, additional_hours FROM per_function
        WHERE abs(additional_hours) > 0.01 AND trim(func_group) <> ''""",
    "q24_function_map": f"""WITH {_TYPED},
        pairs AS (SELECT workpack_id, func_group, type_coefficient, min(row({_POS})) AS seen FROM typed GROUP BY ALL)
        SELECT workpack_id, func_group, type_coefficient FROM pairs""",
    "q25_text_keep_first": "SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY text",
    "q26_sample": f"""WITH {_BASE} SELECT workpack_id, {_POS}, seq FROM mhr QUALIFY row_number() OVER (
        PARTITION BY workpack_id ORDER BY md5('1|' || workpack_id || '|' || concat_ws('-', {_POS}))) <= 10""",
    "q27_non_numeric": f"WITH {_WP} SELECT workpack_id, {_POS} FROM wp WHERE planned_min IS NOT NULL AND try_cast(planned_min AS double) IS NULL",
    "q28_empty_share": f"WITH {_WP} "
    + " UNION ALL ".join(
        _share(c) for c in ("seq", "title", "special_code", "part_no", "tool_flag", "alt_qty")
    ),
    "q29_bad_seq": f"WITH {_WP} SELECT workpack_id, {_POS}, seq FROM wp WHERE seq IS NULL OR NOT regexp_full_match(seq, '[0-9]+[.][0-9]+')",
    "q30_bad_dates": f"WITH {_WP}, {_PACKAGES} SELECT workpack_id FROM pkg WHERE end_date < start_date",
    "q31_coefficient_check": f"""WITH {_BASE} SELECT workpack_id,
        count(*) FILTER (abs(adjusted_hours - base_hours * coefficient) > 0.01) AS bad_rows FROM mhr GROUP BY ALL""",
    "q32_duplicate_seq": f"WITH {_WP} SELECT workpack_id, seq, count(*) AS n FROM wp GROUP BY ALL HAVING count(*) > 1",
    "q33_registration": f"WITH {_WP}, {_PACKAGES} SELECT regis, ac_type FROM regis",
    "q34_reference_ids": f"WITH {_REFERENCE} SELECT kind, id FROM known",
    "q35_ignore_list": f"WITH {_IGNORED} SELECT item FROM ignored",
    "q36_display": f"""WITH {_LINES} SELECT workpack_id, {_POS}, trim(coalesce(title, '')) AS title,
        CASE WHEN length(trim(coalesce(title, ''))) > 12 THEN left(trim(title), 9) || '...' ELSE trim(coalesce(title, '')) END AS short_title,
        coalesce(trim(seq), 'N/A') AS seq, CASE WHEN lower(task_id) = 'nan' THEN '(No ID)' ELSE task_id END AS task_id,
        coalesce(special_code, '(No Code)') AS special_code, {_TYPE_LABEL} AS type FROM ln""",
    "q37_run_metrics": f"""WITH {_BASE}
        SELECT workpack_id, 'loaded' AS stage, count(*) AS "rows", {_STAGE_SUM} AS hours FROM ln GROUP BY workpack_id
        UNION ALL SELECT p.workpack_id, 'base', count(b.workpack_id), {_STAGE_SUM} FROM (SELECT DISTINCT workpack_id FROM wp) p LEFT JOIN base b USING (workpack_id) GROUP BY 1
        UNION ALL SELECT p.workpack_id, 'mhr', count(b.workpack_id), {_STAGE_SUM} FROM (SELECT DISTINCT workpack_id FROM wp) p LEFT JOIN mhr b USING (workpack_id) GROUP BY 1
        UNION ALL SELECT p.workpack_id, 'excluded_mhr', count(b.workpack_id), {_STAGE_SUM} FROM (SELECT DISTINCT workpack_id FROM wp) p LEFT JOIN (SELECT * FROM base WHERE seq IS NULL) b USING (workpack_id) GROUP BY 1
        UNION ALL SELECT p.workpack_id, 'coefficient', count(b.workpack_id), coalesce({_sum('adjusted_hours')}, 0) FROM (SELECT DISTINCT workpack_id FROM wp) p LEFT JOIN mhr b USING (workpack_id) GROUP BY 1""",
    "q38_type_coeff_totals": f"""WITH {_TYPED} SELECT workpack_id, {_sum('base_hours')} AS base_hours,
        CAST(round(sum(CAST(base_hours * type_coefficient AS decimal(28,8))) - sum(CAST(base_hours AS decimal(28,8))), 4) AS double) AS additional_hours
        FROM typed GROUP BY workpack_id""",
    "q39_tool_counts": f"""WITH {_ISSUES} SELECT workpack_id, count(*) FILTER (type = 'Tool') AS tools,
        count(*) FILTER (type = 'Spare') AS spares, count(*) FILTER (type = 'Unknown') AS unknown FROM issues GROUP BY workpack_id""",
    "q40_special_code_usable": f"WITH {_WP} SELECT workpack_id, count(special_code) > 0 AS usable FROM wp GROUP BY ALL",
    "q41_sheet_gates": f"""WITH {_LINES} SELECT workpack_id, count(*) FILTER (passes) AS base,
        count(*) FILTER (passes AND seq IS NOT NULL) AS mhr, count(*) FILTER (passes) AS newtask,
        count(*) FILTER (seq IS NOT NULL) AS tool, count(*) FILTER (passes) AS checked FROM ln GROUP BY workpack_id""",
    "q42_display_hours": f"""WITH {_LINES}, m AS (SELECT *, CAST(round_even(base_hours * 60, 0) AS bigint) AS minutes FROM ln)
        SELECT workpack_id, {_POS}, printf('%02d:%02d:30', minutes // 60, minutes % 60) AS clock,
          ((minutes // 60) * 3600.0::double + (minutes % 60) * 60.0::double + 30.0::double) / 3600.0::double AS clock_hours,
          printf('%.1f%%', base_hours / 24 * 100) AS day_share FROM m""",
    "q43_first_functions": f"""WITH {_BASE} SELECT workpack_id, func_group, {_POS} FROM mhr
        QUALIFY row_number() OVER (PARTITION BY workpack_id, func_group ORDER BY {_POS}) = 1""",
    "q44_plain_coefficient": f"""WITH {_LINES}, c AS (SELECT *, CASE WHEN split_part(seq, '.', 1) IN ('2', '3') THEN 2.2::double ELSE 1.1::double END AS k FROM ln)
        SELECT workpack_id, {_POS}, k AS coefficient, base_hours * k AS adjusted_hours FROM c""",
    "q45_totals_by_type": f"""WITH {_TYPED}, {_BONUS},
        sums AS (SELECT workpack_id, {_sum('base_hours')} AS base, {_sum('base_hours * type_coefficient')} AS adjusted
          FROM typed GROUP BY workpack_id)
        SELECT p.workpack_id, coalesce(base, 0) AS base_hours, coalesce(adjusted, 0) AS adjusted_hours,
          coalesce(b.bonus_hours, 0) AS bonus_hours, coalesce(adjusted, 0) + coalesce(b.bonus_hours, 0) AS total_hours
        FROM pkg p LEFT JOIN sums USING (workpack_id)
        LEFT JOIN bonus b ON product_code = wp_type AND aircraft_code = ac_type""",
}


def all_oracles() -> dict[str, str]:
    from wrenchline.plans.oracle_storage import ORACLES as STORAGE_ORACLES

    return {**ORACLES, **STORAGE_ORACLES}
