"""Turns frames into workbooks so that the workbook scan has whole tables to read."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame

# As the decoder, the encoder travels with the query.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The smallest set of parts a valid workbook needs.
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PARTS = {
    "[Content_Types].xml": (
        '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
        '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        '<Default Extension="xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
        '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
        "</Types>"
    ),
    "_rels/.rels": (
        '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        f'<Relationship Id="rId1" Type="{_REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>'
    ),
    "xl/workbook.xml": (
        f'<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets>'
        '<sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>'
    ),
    "xl/_rels/workbook.xml.rels": (
        '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        f'<Relationship Id="rId1" Type="{_REL}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>'
    ),
}


def _column_letters(index: int) -> str:
    letters = ""
    index += 1
    while index:
        index, rest = divmod(index - 1, 26)
        letters = chr(ord("A") + rest) + letters
    return letters


def _cell(value: object, column: int, row: int) -> str:
    if value is None or value != value:
        return ""
    place = f"{_column_letters(column)}{row}"
    if isinstance(value, str):
        return f'<c r="{place}" t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'
    return f'<c r="{place}"><v>{value!r}</v></c>'


def workbook_bytes(headers: list[str], rows: list[list[object]]) -> bytes:
    lines = []
    for number, row in enumerate([headers, *rows], start=1):
        cells = "".join(_cell(value, column, number) for column, value in enumerate(row))
        lines.append(f'<row r="{number}">{cells}</row>')
    sheet = f'<worksheet xmlns="{_MAIN}"><sheetData>{"".join(lines)}</sheetData></worksheet>'
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in {**_PARTS, "xl/worksheets/sheet1.xml": sheet}.items():
            book.writestr(name, text)
    return buffer.getvalue()


def as_workbooks(df: DataFrame) -> DataFrame:
    """``(content binary)``: one workbook per Arrow batch, so no group ever grows."""
    headers = df.columns

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [list(row) for row in batch.astype(object).itertuples(index=False)]
            yield pd.DataFrame({"content": [workbook_bytes(headers, rows)]})

    return df.mapInPandas(encode, "content binary")
