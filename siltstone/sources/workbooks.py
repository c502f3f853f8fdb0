"""Excel workbooks, decoded inside Spark tasks, one file per row of the scan.

Open-source Spark has no Excel source. The files are found and shipped by the
``binaryFile`` scan; the decoder below only turns the bytes of one workbook
into text cells. A worksheet holds at most 1,048,576 rows, which bounds what
one task decodes.
"""

from __future__ import annotations

import io
import re
import sys
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The decoder travels to the executors with the query; they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# XML namespaces and part names of the Office Open XML format.
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PACKAGE_REL = "{http://schemas.openxmlformats.org/package/2006/relationships}"
_WORKBOOK = "xl/workbook.xml"
_WORKBOOK_RELS = "xl/_rels/workbook.xml.rels"
_SHARED_STRINGS = "xl/sharedStrings.xml"

_ROWS_PER_BATCH = 10_000


def _sheet_part(book: zipfile.ZipFile, sheet: str | None) -> str:
    sheets = ElementTree.fromstring(book.read(_WORKBOOK)).iter(f"{_MAIN}sheet")
    wanted = next((s for s in sheets if sheet is None or s.get("name") == sheet), None)
    if wanted is None:
        raise ValueError(f"Workbook has no sheet '{sheet}'")
    links = ElementTree.fromstring(book.read(_WORKBOOK_RELS)).iter(f"{_PACKAGE_REL}Relationship")
    target = next(l.get("Target") for l in links if l.get("Id") == wanted.get(f"{_REL}id"))
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _text(node) -> str:
    """Text runs of a string item, leaving out phonetic hints."""
    parts = [t.text or "" for t in node.findall(f"{_MAIN}t")]
    parts += [t.text or "" for t in node.findall(f"{_MAIN}r/{_MAIN}t")]
    return "".join(parts)


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if _SHARED_STRINGS not in book.namelist():
        return []
    root = ElementTree.fromstring(book.read(_SHARED_STRINGS))
    return [_text(item) for item in root.findall(f"{_MAIN}si")]


def _column_index(reference: str) -> int:
    index = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        index = index * 26 + ord(letter) - ord("A") + 1
    return index - 1


def _cell_value(cell, shared: list[str]) -> str | None:
    kind = cell.get("t")
    if kind == "inlineStr":
        return _text(cell.find(f"{_MAIN}is"))
    value = cell.find(f"{_MAIN}v")
    if value is None or value.text is None or kind == "e":
        return None
    if kind == "s":
        return shared[int(value.text)]
    if kind == "b":
        return "true" if value.text == "1" else "false"
    return value.text


def workbook_rows(content: bytes, sheet: str | None = None) -> Iterator[dict[int, str]]:
    """Rows of one sheet as ``{column index: text}``, read without holding the sheet."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared = _shared_strings(book)
        with book.open(_sheet_part(book, sheet)) as part:
            for _, node in ElementTree.iterparse(part):
                if node.tag != f"{_MAIN}row":
                    continue
                row = {}
                for position, cell in enumerate(node.findall(f"{_MAIN}c")):
                    reference = cell.get("r")
                    index = _column_index(reference) if reference else position
                    value = _cell_value(cell, shared)
                    if value is not None:
                        row[index] = value
                node.clear()
                yield row


def decode_workbooks(
    files: DataFrame, schema: T.StructType, sheet: str | None = None
) -> DataFrame:
    """Rows of all workbooks in ``files(content binary, …)``.

    The first row holds headers; columns bind by header name, a header that is
    missing gives NULL, and text that does not fit the declared type gives NULL.
    Empty rows are skipped.
    """
    names = [field.name for field in schema]

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows = workbook_rows(content, sheet)
                headers = {text.strip(): i for i, text in next(rows, {}).items()}
                places = [headers.get(name) for name in names]
                pending = []
                for row in rows:
                    if row:
                        pending.append([row.get(place) for place in places])
                    if len(pending) == _ROWS_PER_BATCH:
                        yield pd.DataFrame(pending, columns=names, dtype=object)
                        pending = []
                if pending:
                    yield pd.DataFrame(pending, columns=names, dtype=object)

    as_text = T.StructType([T.StructField(name, T.StringType()) for name in names])
    cells = files.select("content").mapInPandas(decode, as_text)
    typed = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema]
    return cells.select(*typed)


def read_workbooks(
    spark: SparkSession, path: str, schema: T.StructType, sheet: str | None = None
) -> DataFrame:
    """All workbooks under ``path`` (a file, a folder or a pattern).

    A task receives files in batches of at most
    ``spark.sql.execution.arrow.maxBytesPerBatch``.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xls[xm]").load(path)
    return decode_workbooks(files, schema, sheet)
