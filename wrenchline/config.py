"""Settings passed to the operators (no globals, no files read at import)."""

from __future__ import annotations

from dataclasses import dataclass, field

# Words a rule mode can take: "ignore" drops the row, "true" keeps it and checks
# its ID against the reference lists, anything else keeps it unchecked.
IGNORE = "ignore"
CHECKED = "true"

SHEETS = ("base", "mhr", "newtask", "tool")


@dataclass(frozen=True)
class SeqRule:
    """How lines of one sequence prefix are treated.

    ``mhr``, ``newtask`` and ``tool`` override ``base`` for one output each;
    ``None`` inherits.
    """

    prefix: str
    base: str | None = None
    mhr: str | None = None
    newtask: str | None = None
    tool: str | None = None
    id_method: str | None = None
    coefficient: float | None = None

    def mode(self, sheet: str) -> str | None:
        override = None if sheet == "base" else getattr(self, sheet)
        return self.base if override is None else override


# The rules, coefficients and thresholds of the standard setup.
STANDARD_RULES = (
    SeqRule("2", "true", id_method="-", coefficient=2.2),
    SeqRule("3", "true", id_method="-", coefficient=2.2),
    SeqRule("4", "true", id_method="/", coefficient=1.1),
    SeqRule("5", "ignore", tool="true", id_method="-"),
    SeqRule("6", "ignore", tool="true", id_method="-"),
    SeqRule("7", "ignore", tool="true", id_method="-"),
    SeqRule("8", "ignore", tool="true", id_method="-"),
    SeqRule("9", "ignore", tool="true", id_method="-"),
    SeqRule("10", "ignore", mhr="ignore", newtask="ignore", tool="true", id_method="-"),
)

# Export column name -> logical column name.
EXPORT_COLUMNS = {
    "SEQ": "seq",
    "forecast.event_display": "title",
    "forecast.est_mh": "planned_min",
    "scl.special": "special_code",
    "wph.wpno": "wpno",
    "Start_date": "start_date",
    "End_date": "end_date",
    "event": "event",
    "part.description": "tool_name",
    "part.tool": "tool_flag",
    "prq2.partno": "part_no",
    "total_qty": "total_qty",
    "altpart_total_qty": "alt_qty",
    "prq2.percentage": "percentage",
    "special type": "func_group",
}

REQUIRED_COLUMNS = ("seq", "title", "planned_min")
TOOL_COLUMNS = ("tool_name", "tool_flag", "part_no", "total_qty", "alt_qty")


@dataclass(frozen=True)
class EngineConfig:
    rules: tuple[SeqRule, ...] = STANDARD_RULES
    default_mode: str = CHECKED
    default_id_method: str = "/"
    default_coefficient: float = 1.1
    skip_codes: tuple[str, ...] = ("vna",)
    skip_coefficient: float = 1.0
    default_type_coefficient: float = 1.0
    type_coefficient_per_seq: bool = True
    coefficient_system: str = "seq"  # or "type"
    high_hours: float = 16
    high_hours_basis: str = "base_hours"  # or "adjusted_hours"
    sample_size: int = 10
    sample_seed: int = 1
    function_map_size: int | None = None  # pairs per package; None: all
    shift_hours: float = 8
    eo_prefix: str = "EO"
    enable_special_code: bool = True
    enable_tool_control: bool = True
    filter_tools_by_rule: bool = False
    aircraft_name_part: str = "first"  # "last": all but the package type
    columns: dict[str, str] = field(default_factory=lambda: dict(EXPORT_COLUMNS))

    def rule_values(self, attribute: str) -> dict[str, object]:
        """{prefix: value} of one rule attribute (a sheet, id_method, coefficient).

        Prefixes are upper-cased here and compared exactly with the data.
        """
        values = {}
        for rule in self.rules:
            value = rule.mode(attribute) if attribute in SHEETS else getattr(rule, attribute)
            if value is not None:
                values[rule.prefix.upper()] = value
        return values


DEFAULT_CONFIG = EngineConfig()
