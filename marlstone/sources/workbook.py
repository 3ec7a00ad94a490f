"""A minimal spreadsheet file: one sheet of text cells with column widths."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable
from xml.sax.saxutils import escape

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006"
HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'


def letters(column: int) -> str:
    """A column's name: 1 is A, 27 is AA."""
    name = ""
    while column:
        column, rest = divmod(column - 1, 26)
        name = chr(65 + rest) + name
    return name


def _cell(row: int, column: int, value: str) -> str:
    # characters that markup can't hold are left out
    text = escape("".join(c for c in value if c in "\t\n\r" or 0x20 <= ord(c) <= 0xFFFD and not 0xD800 <= ord(c) <= 0xDFFF or ord(c) > 0xFFFF))
    return f'<c r="{letters(column)}{row}" t="inlineStr"><is><t xml:space="preserve">{text}</t></is></c>'


def sheet(title: str, heading: tuple[str, ...], rows: Iterable[tuple[str, ...]], widths: Iterable[int]) -> bytes:
    """The file's bytes."""
    cols = "".join(f'<col min="{i}" max="{i}" width="{w}" customWidth="1"/>' for i, w in enumerate(widths, 1))
    lines = [heading, *rows]
    data = "".join(f'<row r="{r}">' + "".join(_cell(r, c, v or "") for c, v in enumerate(row, 1)) + "</row>" for r, row in enumerate(lines, 1))
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{PACKAGE}/relationships"><Relationship Id="rId1" Type="{LINKS}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{MAIN}" xmlns:r="{LINKS}"><sheets><sheet name="{escape(title)}" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{PACKAGE}/relationships"><Relationship Id="rId1" Type="{LINKS}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{MAIN}"><cols>{cols}</cols><sheetData>{data}</sheetData></worksheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in parts.items():
            book.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), HEAD + text)
    return out.getvalue()
