"""Text and number cleaning with Python semantics, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType

# The characters Python's str.strip() removes, as a regex class.
SPACE = r"\t-\r\x1c- \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# Leading space, then everything up to the last other character.
_STRIPPED = rf"^[{SPACE}]*((?s:.*[^{SPACE}])?)"

# Decimal floats between space; a double cast alone would also take "12d", "nan"
# and "inf". One pattern trims, checks and extracts.
_PLAIN_NUMBER = rf"^[{SPACE}]*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)[{SPACE}]*$"
_GROUP = "[0-9]+(?:_[0-9]+)*"
_GROUPED_NUMBER = (
    rf"^[{SPACE}]*([+-]?(?:{_GROUP}\.?(?:{_GROUP})?|\.{_GROUP})(?:[eE][+-]?{_GROUP})?)[{SPACE}]*$"
)

# Texts that stand for a blank lookup key, in any case.
BLANK_KEYS = ("nan", "", "none")


def strip(text: Column) -> Column:
    """Trim all Unicode whitespace (plain ``trim`` only removes blanks)."""
    return F.regexp_extract(text, _STRIPPED, 1)


def text_or_nan(value: Column) -> Column:
    """String form of a value; a null becomes the text ``nan``."""
    return F.coalesce(value.cast("string"), F.lit("nan"))


def is_blank(value: Column) -> Column:
    return value.isNull() | (strip(value.cast("string")) == "")


def lookup_key(value: Column) -> Column:
    """Trimmed key, or null where the key counts as blank."""
    key = strip(value.cast("string"))
    return F.when(~F.lower(key).isin(*BLANK_KEYS), key)


def number(value: Column, dtype: DataType | None = None, digit_groups: bool = False) -> Column:
    """Double value, or null where the value is not a plain number.

    Pass the column's ``dtype`` so numeric columns skip the text check.
    ``digit_groups`` also accepts ``1_000``.
    """
    if isinstance(dtype, NumericType):
        plain = value.cast("double")
        return F.when(~F.isnan(plain), plain)
    pattern = _GROUPED_NUMBER if digit_groups else _PLAIN_NUMBER
    # Null and not empty without a match: a failing cast is slow.
    digits = F.nullif(F.regexp_extract(value.cast("string"), pattern, 1), F.lit(""))
    if digit_groups:
        digits = F.replace(digits, F.lit("_"), F.lit(""))
    return digits.try_cast("double")
