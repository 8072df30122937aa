"""Spreadsheets as a Spark data source, and the scans over their cells.

`xlsx` reads every sheet of each file as text cells (file, sheet, row_no, col_no,
value), one partition a file, by the standard library's zip and XML readers. Files
are given as the binary content that Spark's own reader fetched, so any store works.
"""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import parse_month, to_number

CELLS = "file string, sheet string, row_no int, col_no int, value string, is_date boolean"
_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_DATE_FORMATS = {*range(14, 18), 22, *range(27, 37), *range(50, 59)}


def workbook_cells(raw: bytes) -> Iterator[tuple[str, int, int, str, bool]]:
    """(sheet, row from 1, column from 1, text, whether it is formatted as a date); dates as ISO text."""
    book = zipfile.ZipFile(io.BytesIO(raw))
    read = lambda name: ET.fromstring(book.read(name)) if name in book.namelist() else None
    shared, styles = read("xl/sharedStrings.xml"), read("xl/styles.xml")
    strings = ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in shared] if shared is not None else []
    dated: list[bool] = []
    if styles is not None:
        own = {int(f.get("numFmtId")): f.get("formatCode", "") for f in styles.findall(".//m:numFmts/m:numFmt", _NS)}
        for xf in styles.findall(".//m:cellXfs/m:xf", _NS):
            k = int(xf.get("numFmtId", 0))
            dated.append(k in _DATE_FORMATS or bool(re.search(r"[dmy]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", own.get(k, "")).lower())))
    targets = {r.get("Id"): r.get("Target") for r in read("xl/_rels/workbook.xml.rels")}
    for sheet in read("xl/workbook.xml").findall(".//m:sheets/m:sheet", _NS):
        path = targets[sheet.get(_REL)].lstrip("/")
        root = read(path if path.startswith("xl/") else f"xl/{path}")
        for c in root.iter(f"{{{_NS['m']}}}c"):
            letters, row = re.fullmatch(r"([A-Z]+)(\d+)", c.get("r")).groups()
            column = 0
            for ch in letters:
                column = column * 26 + ord(ch) - 64
            v, kind = c.find("m:v", _NS), c.get("t")
            if kind == "inlineStr":
                text = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t"))
            elif v is None or v.text is None:
                continue
            else:
                text = strings[int(v.text)] if kind == "s" else v.text
            style = int(c.get("s", 0))
            is_date = kind in (None, "n") and style < len(dated) and dated[style]
            if is_date:
                text = (date(1899, 12, 30) + timedelta(days=int(float(text)))).isoformat()
            yield sheet.get("name"), int(row), column, text, is_date


def read_xlsx(spark: SparkSession, path: str) -> DataFrame:
    """Cells of all workbooks under a path or glob; temporary files (~$) are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = [(name, *cell) for cell in workbook_cells(raw)]
                columns = list(zip(*rows)) or [()] * 6
                kinds = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "sheet", "row_no", "col_no", "value", "is_date"])

    files = spark.read.format("binaryFile").load(path).where(~F.col("path").contains("~$") & F.col("path").endswith(".xlsx"))
    return files.select("path", "content").mapInArrow(run, CELLS)


def header_rows(cells: DataFrame, date_column: int = 1, max_scan: int = 10) -> DataFrame:
    """(file, sheet, header_rows): how many rows stand above the first whose date cell parses."""
    dates = cells.where((F.col("col_no") == date_column) & (F.col("row_no") <= max_scan) & parse_month("value").isNotNull())
    return dates.groupBy("file", "sheet").agg((F.min("row_no") - 1).alias("header_rows"))


def vintage_header(cells: DataFrame, max_scan: int = 15) -> DataFrame:
    """(file, sheet, row_no): the first row with two or more dates from column 2 on."""
    rows = cells.where((F.col("col_no") >= 2) & (F.col("row_no") <= max_scan)).groupBy("file", "sheet", "row_no").agg(F.count_if(parse_month("value").isNotNull()).alias("dates"))
    return rows.where("dates >= 2").groupBy("file", "sheet").agg(F.min("row_no").alias("row_no"))


def price_and_drivers(cells: DataFrame, date_column: int = 1, price_column: int = 2) -> tuple[DataFrame, DataFrame]:
    """(series_id, ds, price) and (series_id, driver, ds, raw) by position; the series is the file's name."""
    head = header_rows(cells, date_column)
    rows = cells.join(head, ["file", "sheet"]).where(F.col("row_no") > F.col("header_rows"))
    rows = rows.withColumn("series_id", F.regexp_replace(F.element_at(F.split("file", "/"), -1), r"\.xlsx$", ""))
    dates = rows.where(F.col("col_no") == date_column).select("file", "sheet", "row_no", parse_month("value").alias("ds")).where("ds is not null")
    values = rows.where(F.col("col_no") != date_column).join(dates, ["file", "sheet", "row_no"]).select("series_id", "ds", "col_no", to_number("value").alias("value"))
    prices = values.where(F.col("col_no") == price_column).select("series_id", "ds", F.col("value").alias("price"))
    return prices, values.where(F.col("col_no") > price_column).select("series_id", F.concat(F.lit("col"), F.col("col_no").cast("string")).alias("driver"), "ds", F.col("value").alias("raw"))


def vintage_cells(cells: DataFrame) -> DataFrame:
    """(series_id, vintage, target, value) of third-party sheets: column 1 holds the
    target month, every dated header cell is a vintage."""
    head = vintage_header(cells).withColumnRenamed("row_no", "head")
    rows = cells.join(head, ["file", "sheet"]).withColumn("series_id", F.regexp_replace(F.element_at(F.split("file", "/"), -1), r"\.xlsx$", ""))
    names = rows.where("row_no = head and col_no >= 2").select("file", "sheet", "col_no", parse_month("value").alias("vintage")).where("vintage is not null")
    targets = rows.where("row_no > head and col_no = 1").select("file", "sheet", "row_no", parse_month("value").alias("target")).where("target is not null")
    return rows.where("row_no > head").join(names, ["file", "sheet", "col_no"]).join(targets, ["file", "sheet", "row_no"]).select("series_id", "vintage", "target", to_number("value").alias("value"))


def profile(prices: DataFrame) -> DataFrame:
    """(series_id, start_period, n, frequency) of scanned series."""
    from ..operators.calendar import infer_frequency

    n = prices.groupBy("series_id").agg(F.count("*").alias("n"))
    return infer_frequency(prices).join(n, "series_id").select("series_id", F.date_format("start", "yyyy-MM").alias("start_period"), "n", "frequency")


def merge_registry(existing: DataFrame, found: DataFrame, columns: list[str]) -> DataFrame:
    """Found series beside registered ones; what is registered wins, nothing registered is lost."""
    joined = found.alias("f").join(existing.alias("e"), "series_id", "full")
    return joined.select("series_id", *(F.coalesce(F.col(f"e.{c}"), F.col(f"f.{c}")).alias(c) for c in columns))


def latest_by(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))
    return rows.withColumn("_p", place).where("_p = 1").drop("_p")
