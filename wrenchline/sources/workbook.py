"""Cells of spreadsheet files as a DataFrame.

Spark has no spreadsheet source. Files are listed and read by the ``binaryFile``
source; each task unpacks its own files and streams the rows out. The format
bounds a sheet to 1,048,576 rows, so one file is a bounded unit of work.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = (
    "workpack_id string, sheet string, sheet_no int, row_no bigint, columns array<string>, "
    "cells map<string, struct<kind: string, text: string>>, error string"
)
_ARROW = pa.schema(
    [
        ("workpack_id", pa.string()),
        ("sheet", pa.string()),
        ("sheet_no", pa.int32()),
        ("row_no", pa.int64()),
        ("columns", pa.list_(pa.string())),
        ("cells", pa.map_(pa.string(), pa.struct([("kind", pa.string()), ("text", pa.string())]))),
        ("error", pa.string()),
    ]
)
_BATCH_ROWS = 5000

# Texts that read as an empty cell.
NA_TEXTS = frozenset(
    [
        "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
        "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
    ]
)
# Built-in number formats that show a date or time.
_DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])
_ELAPSED_FORMAT = 46

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _items(archive: zipfile.ZipFile, member: str, tag: str) -> Iterator[ElementTree.Element]:
    """Elements of a part one at a time, freed after use."""
    if member not in archive.namelist():
        return
    with archive.open(member) as stream:
        for _, element in ElementTree.iterparse(stream):
            if element.tag == _MAIN + tag:
                yield element
                element.clear()


def _all_text(element: ElementTree.Element) -> str:
    """Text of a string item without its phonetic runs."""
    runs = [element, *element.findall(f"{_MAIN}r")]
    return "".join(t.text or "" for run in runs for t in run.findall(f"{_MAIN}t"))


def _date_styles(archive: zipfile.ZipFile) -> dict[int, bool]:
    """Cell styles that show a date or time; true for those that show elapsed time."""
    if "xl/styles.xml" not in archive.namelist():
        return {}
    root = ElementTree.fromstring(archive.read("xl/styles.xml"))
    custom = {int(f.get("numFmtId")): f.get("formatCode", "") for f in root.iter(f"{_MAIN}numFmt")}
    formats = root.find(f"{_MAIN}cellXfs")
    styles = {}
    for index, style in enumerate(formats if formats is not None else ()):
        number = int(style.get("numFmtId", 0))
        code = custom.get(number, "[h]" if number == _ELAPSED_FORMAT else "")
        letters = re.sub(r'"[^"]*"|\\.|\[(?![hms]+\])[^\]]*\]', "", code.lower())
        if number in _DATE_FORMATS or re.search("[ymdhs]", letters):
            styles[index] = bool(re.search(r"\[[hms]+\]", letters))
    return styles


def _serial_text(serial: float, epoch: dt.datetime, elapsed: bool) -> str:
    """Date serial as date and time, as a clock time below one day, or as elapsed time."""
    span = dt.timedelta(milliseconds=round(serial * 86400000))
    clock = (dt.datetime.min + (span - dt.timedelta(days=span.days))).time().isoformat()
    if elapsed:
        return f"{span.days} days {clock}"
    return clock if 0 <= serial < 1 else (epoch + span).isoformat(sep=" ")


def _cell(cell, strings: list[str], dates: dict[int, bool], epoch: dt.datetime) -> dict | None:
    """{kind, text} of a cell, None when it is empty."""
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        inline = cell.find(f"{_MAIN}is")
        text = _all_text(inline) if inline is not None else ""
        return None if text in NA_TEXTS else {"kind": "s", "text": text}
    value = cell.findtext(f"{_MAIN}v")
    if value is None or kind == "e":
        return None
    if kind in ("s", "str"):
        text = strings[int(value)] if kind == "s" else value
        return None if text in NA_TEXTS else {"kind": "s", "text": text}
    if kind == "b":
        return {"kind": "b", "text": "True" if value.strip() == "1" else "False"}
    if kind == "d":
        return {"kind": "d", "text": value.replace("T", " ")}
    style = int(cell.get("s", 0))
    if style in dates:
        return {"kind": "d", "text": _serial_text(float(value), epoch, dates[style])}
    # Whole numbers stay whole, others take their shortest form.
    is_float = any(mark in value for mark in ".eE")
    return {"kind": "n", "text": repr(float(value)) if is_float else str(int(value))}


def _column_index(reference: str) -> int:
    index = 0
    for letter in reference.rstrip("0123456789"):
        index = index * 26 + ord(letter) - 64
    return index - 1


def _header(cells: dict[int, dict | None]) -> list[str]:
    """Column names; blanks are numbered and repeats get a suffix."""
    names, seen = [], {}
    for index in range(max(cells, default=-1) + 1):
        cell = cells.get(index)
        name = cell["text"] if cell else f"Unnamed: {index}"
        count = seen.get(name, 0)
        seen[name] = count + 1
        names.append(f"{name}.{count}" if count else name)
    return names


def _sheets(archive: zipfile.ZipFile) -> tuple[list[tuple[str, str]], dt.datetime]:
    """(name, part) of the sheets in order, and the day that serial 0 stands for."""
    book = ElementTree.fromstring(archive.read("xl/workbook.xml"))
    links = ElementTree.fromstring(archive.read("xl/_rels/workbook.xml.rels"))
    targets = {link.get("Id"): link.get("Target") for link in links}
    sheets = []
    for sheet in book.iter(f"{_MAIN}sheet"):
        target = targets[sheet.get(_REL_ID)]
        part = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        sheets.append((sheet.get("name"), part))
    settings = book.find(f"{_MAIN}workbookPr")
    late = settings is not None and settings.get("date1904") in ("1", "true")
    return sheets, dt.datetime(1904, 1, 1) if late else dt.datetime(1899, 12, 30)


def decode(content: bytes, first_sheet_only: bool) -> Iterator[dict]:
    """Header row (``columns``, row_no -1) and data rows (``cells``) of each sheet."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        sheets, epoch = _sheets(archive)
        strings = [_all_text(item) for item in _items(archive, "xl/sharedStrings.xml", "si")]
        dates = _date_styles(archive)
        for sheet_no, (name, part) in enumerate(sheets[:1] if first_sheet_only else sheets):
            where = {"sheet": name, "sheet_no": sheet_no}
            names: list[str] | None = None
            expected = 1
            for row in _items(archive, part, "row"):
                cells = {}
                for position, cell in enumerate(row.findall(f"{_MAIN}c")):
                    reference = cell.get("r")
                    index = _column_index(reference) if reference else position
                    cells[index] = _cell(cell, strings, dates, epoch)
                if not any(cells.values()):
                    continue  # empty rows count only when data follows
                line = int(row.get("r", expected))
                if names is None:
                    names = _header(cells)
                    first, expected = line + 1, line + 1
                    yield {**where, "row_no": -1, "columns": names}
                    continue
                for number in range(expected, line):
                    yield {**where, "row_no": number - first, "cells": [(n, None) for n in names]}
                expected = line + 1
                yield {
                    **where,
                    "row_no": line - first,
                    "cells": [(n, cells.get(i)) for i, n in enumerate(names)],
                }
            if names is None:
                yield {**where, "row_no": -1, "columns": []}


def _decode_files(first_sheet_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for package, content in zip(batch.column("workpack_id"), batch.column("content")):
                identity = {"workpack_id": package.as_py()}
                rows: list[dict] = []
                try:
                    for row in decode(content.as_py(), first_sheet_only):
                        rows.append({**identity, **row})
                        if len(rows) == _BATCH_ROWS:
                            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                            rows = []
                except Exception as error:  # one bad file is a row of its own, not a failed job
                    rows.append({**identity, "error": f"{type(error).__name__}: {error}"})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return run


def file_stem(path: Column) -> Column:
    """File name without folder and extension."""
    name = F.url_decode(F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\+", "%2B"))
    return F.regexp_replace(name, r"(\.(csv|json|parquet))?\.[^.]*$", "")


def workbook_files(spark: SparkSession, folder: str, pattern: str = "*.xlsx") -> DataFrame:
    """Workbooks of one folder, not of its subfolders; contents are read on demand."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select(file_stem(F.col("path")).alias("workpack_id"), "path", "length", "content")


def read_cells(
    spark: SparkSession, folder: str, pattern: str = "*.xlsx", first_sheet_only: bool = True
) -> DataFrame:
    """One row per sheet row, one header row per sheet, one error row per unreadable file."""
    files = workbook_files(spark, folder, pattern).select("workpack_id", "content")
    return files.mapInArrow(_decode_files(first_sheet_only), SCHEMA)


def data_rows(cells: DataFrame) -> DataFrame:
    return cells.where("row_no >= 0")


def text_of(column: str) -> Column:
    return F.try_element_at("cells", F.lit(column)).getField("text")


def has(column: str) -> Column:
    return F.map_contains_key("cells", column)


def is_true(column: str) -> Column:
    """A true or 1 cell; the text "TRUE" is not."""
    cell = F.try_element_at("cells", F.lit(column))
    kind, text = cell.getField("kind"), cell.getField("text")
    return F.coalesce(
        ((kind == "b") & (text == "True")) | ((kind == "n") & (text.try_cast("double") == 1)), F.lit(False)
    )
