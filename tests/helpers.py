"""Small inputs for the tests: frames from tuples and hand-written workbooks."""

from __future__ import annotations

import zipfile
from xml.sax.saxutils import escape

LINE_SCHEMA = {
    "workpack_id": "string", "row_no": "bigint", "seq": "string", "title": "string", "planned_min": "string",
    "special_code": "string", "wpno": "string", "start_date": "timestamp_ntz", "end_date": "timestamp_ntz",
    "event": "string", "tool_name": "string", "tool_flag": "string", "part_no": "string",
    "total_qty": "string", "alt_qty": "string", "func_group": "string", "percentage": "string",
}


def frame(spark, schema: str, *rows):
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def lines(spark, columns: str, *rows, package="P"):
    """Line table from rows of the named columns; row_no counts up."""
    names = columns.split()
    own_package = names and names[0] == "workpack_id"
    fields = ["workpack_id", "row_no", *[n for n in names if n != "workpack_id"]]
    schema = ", ".join(f"{n} {'string' if LINE_SCHEMA[n] == 'timestamp_ntz' else LINE_SCHEMA[n]}" for n in fields)
    data = []
    for number, row in enumerate(rows):
        row = row if isinstance(row, tuple) else (row,)
        head, rest = (row[0], row[1:]) if own_package else (package, row)
        data.append((head, number, *rest))
    df = spark.createDataFrame(data, schema)
    for name in ("start_date", "end_date"):
        if name in names:
            df = df.withColumn(name, df[name].cast("timestamp_ntz"))
    return df


def values(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def evaluate(spark, expression, inputs, dtype="string"):
    """Results of ``expression(column)`` over the inputs, in order."""
    df = spark.createDataFrame(list(enumerate(inputs)), f"i bigint, x {dtype}")
    rows = df.select("i", expression(df["x"]).alias("y")).collect()
    return [r["y"] for r in sorted(rows, key=lambda r: r["i"])]


class Date(float):
    """A number shown as a date."""

    style = 1


class Span(Date):
    """A number shown as elapsed time."""

    style = 2


def _letters(index: int) -> str:
    name = ""
    index += 1
    while index:
        index, rest = divmod(index - 1, 26)
        name = chr(65 + rest) + name
    return name


def _cell_xml(reference: str, value, strings: list[str]) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{reference}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, Date):
        return f'<c r="{reference}" s="{value.style}"><v>{float(value)!r}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{reference}"><v>{value!r}</v></c>'
    if value.startswith("inline:"):
        return f'<c r="{reference}" t="inlineStr"><is><t>{escape(value[7:])}</t></is></c>'
    if value.startswith("error:"):
        return f'<c r="{reference}" t="e"><v>{escape(value[6:])}</v></c>'
    strings.append(value)
    return f'<c r="{reference}" t="s"><v>{len(strings) - 1}</v></c>'


def write_workbook(path, sheets: dict[str, list[list]]) -> None:
    """A minimal workbook; a row given as None is left out of the file."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    strings: list[str] = []
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        entries, links = "", ""
        for number, (name, rows) in enumerate(sheets.items(), 1):
            entries += f'<sheet name="{escape(name)}" sheetId="{number}" r:id="rId{number}"/>'
            links += f'<Relationship Id="rId{number}" Type="t" Target="worksheets/sheet{number}.xml"/>'
            body = ""
            for line, row in enumerate(rows, 1):
                if row is not None:
                    cells = "".join(_cell_xml(f"{_letters(i)}{line}", v, strings) for i, v in enumerate(row))
                    body += f'<row r="{line}">{cells}</row>'
            xml = f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>'
            out.writestr(f"xl/worksheets/sheet{number}.xml", xml)
        out.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{entries}</sheets></workbook>')
        out.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{links}</Relationships>")
        items = "".join(f"<si><t>{escape(s)}</t></si>" for s in strings)
        out.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">{items}</sst>')
        out.writestr(
            "xl/styles.xml",
            f'<styleSheet xmlns="{main}"><numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/></numFmts>'
            '<cellXfs><xf numFmtId="0"/><xf numFmtId="164"/><xf numFmtId="46"/></cellXfs></styleSheet>',
        )
