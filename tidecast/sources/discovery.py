"""What can be told about a series from its workbook's header cells, and the registry of a folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import parse_month
from . import sheets

# Words of the value column that name no grade or region.
NO_NAMES = ("price", "value", "index", "exports", "nan", "")


def with_series(cells: DataFrame, suffix: str = "") -> DataFrame:
    """Adds series_id: the file's name without .xlsx and the suffix."""
    name = F.regexp_replace(F.element_at(F.split("file", "/"), -1), r"\.xlsx$", "")
    return cells.withColumn("series_id", F.regexp_replace(name, f"{suffix}$", "") if suffix else name)


def display_name(series_id: Column, header: Column) -> Column:
    """The header cell where it shares a word with the id, else the id in title case."""
    words = F.filter(F.split(series_id, "_"), lambda w: w != "")
    shared = F.exists(words, lambda w: F.contains(F.lower(header), F.lower(w)))
    return F.when(shared, F.trim(header)).otherwise(F.initcap(F.replace(series_id, F.lit("_"), F.lit(" "))))


def header_cells(cells: DataFrame) -> DataFrame:
    """The cells above the data, with the header's height."""
    return cells.join(sheets.header_rows(cells), ["file", "sheet"]).where(F.col("row_no") <= F.col("header_rows"))


def grades_and_regions(header: DataFrame) -> DataFrame:
    """(series_id, grade, region): the value beside the last header label, from the second row
    on, that speaks of either; general words are no names."""
    label = header.where("col_no = 1 and row_no > 1").select("file", "sheet", "series_id", "row_no", F.lower(F.trim("value")).alias("label"))
    named = label.join(header.where("col_no = 2").select("file", "sheet", "row_no", F.trim("value").alias("name")), ["file", "sheet", "row_no"]).where(~F.lower("name").isin(*NO_NAMES))
    region = F.contains("label", F.lit("region"))
    grade = F.contains("label", F.lit("grade")) & ~region
    last = lambda which: F.max_by("name", F.when(which, F.col("row_no")))
    one = lambda which: F.when(F.count_if(which) > 0, last(which))
    return named.groupBy("series_id").agg(one(grade).alias("grade"), one(region).alias("region"))


def candidate_drivers(cells: DataFrame, header: DataFrame) -> DataFrame:
    """(series_id, column_no, label, unit) of every column from the third on: header cells
    joined from the top, without the unit row and repeated dates."""
    units = header.where((F.col("col_no") == 1) & F.contains(F.lower("value"), F.lit("unit"))).groupBy("file", "sheet").agg(F.min("row_no").alias("unit_row"))
    columns = cells.where("col_no >= 3").select("file", "sheet", "series_id", "col_no").distinct()
    rows = header.where("col_no >= 3").join(units, ["file", "sheet"], "left")
    rows = rows.withColumn("text", F.trim("value"))
    is_unit = F.coalesce(F.col("row_no") == F.col("unit_row"), F.lit(False))
    part = ~is_unit & (F.col("text") != "") & (F.lower("text") != "nan") & parse_month("text").isNull()
    parts = F.transform(F.sort_array(F.collect_list(F.when(part, F.struct("row_no", "text")))), lambda x: x["text"])
    told = rows.groupBy("file", "sheet", "col_no").agg(F.array_join(parts, " — ").alias("label"), F.max(F.when(is_unit, F.col("text"))).alias("unit"))
    out = columns.join(told, ["file", "sheet", "col_no"], "left")
    label = F.when(F.coalesce("label", F.lit("")) != "", F.col("label")).otherwise(F.concat(F.lit("Driver column "), F.col("col_no").cast("string")))
    return out.select("series_id", F.col("col_no").alias("column_no"), label.alias("label"), F.coalesce(F.nullif("unit", F.lit("")), F.lit("TBD")).alias("unit"))


def discover(spark: SparkSession, path: str, existing: DataFrame | None = None, suffix: str = "_ext_var") -> tuple[DataFrame, DataFrame]:
    """(registry, candidate drivers) of all workbooks under a path. A series that is
    registered as selected is left as it is; of another registered one, what the file
    tells is refreshed and its status kept. Nothing registered is lost, and candidate
    drivers are those of series that aren't selected."""
    cells = with_series(sheets.read_xlsx(spark, path), suffix)
    header = header_cells(cells)
    prices, _ = sheets.price_and_drivers(cells.drop("series_id"))
    prices = prices.withColumn("series_id", F.regexp_replace("series_id", f"{suffix}$", "") if suffix else F.col("series_id"))
    title = header.where("row_no = 1 and col_no = 2").select("series_id", F.col("value").alias("title"))
    files = cells.groupBy("series_id").agg(F.min("file").alias("data_file"))
    found = files.join(sheets.profile(prices), "series_id").join(title, "series_id", "left").join(grades_and_regions(header), "series_id", "left")
    found = found.select("series_id", display_name(F.col("series_id"), F.coalesce("title", F.lit(""))).alias("display_name"), "grade", "region", "frequency", "start_period", "data_file", F.lit("candidates").alias("drivers_status"))
    if existing is not None:
        own = [c for c in found.columns if c != "series_id"]
        joined = found.alias("f").join(existing.alias("e"), "series_id", "full")
        done = F.col("e.drivers_status") == "selected"
        keep = lambda c: F.when(done, F.col(f"e.{c}")).otherwise(F.coalesce(*([f"e.{c}", f"f.{c}"] if c == "drivers_status" else [f"f.{c}", f"e.{c}"])))
        found = joined.select("series_id", *(keep(c).alias(c) for c in own))
    drivers = candidate_drivers(cells, header).join(found.where("drivers_status = 'candidates'").select("series_id"), "series_id", "left_semi")
    return found, drivers
