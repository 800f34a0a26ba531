"""Landed form exports and spreadsheet tabs as tables.

Form services and spreadsheets are not read directly: their exports land
as CSV (or Parquet) files in a shared folder and are read with a declared
schema, never with inference. Column names are normalised to snake_case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook.functions import clean_name_list
from fieldbook.sources.json_forms import BAD_ROW, JsonForm, flatten, records

#: One CSV convention for every export and landed file: header row, cells
#: kept as typed (no white-space trimming, quoted cells may hold line
#: breaks), a missing value written and read as ``NA`` so that it stays
#: distinct from an empty string (written ``""``).
CSV_OPTIONS = {
    "header": True,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "nullValue": "NA",
    "escape": '"',
    "multiLine": True,
}

#: Rows in a file of an export. A file whose cells may hold line breaks is read by one task, so that a task
#: reads this many rows of it, however large the export is.
FILE_ROWS = 20_000


def read_csv(spark: SparkSession, path: str, schema: T.StructType, bad_rows: str = "fail",
             blank_as_null: bool = False, line_breaks: bool = True) -> DataFrame:
    """CSV files under a declared schema, by the one convention.

    The header must name the schema's columns in their order, else the read
    fails: columns are never bound by position alone. A row that does not
    fit (a cell that is not of its type, too few or too many cells) fails
    the read, or with ``bad_rows="report"`` stays, with NULL in the cells
    that do not fit and the row's text in ``_bad_row``. With
    ``blank_as_null`` an empty text cell is a missing value, as some report
    readers take it; otherwise it stays ``''``. ``line_breaks=False`` declares
    that no cell holds a line break: a plain file is then split among tasks,
    and otherwise read by one.
    """
    if bad_rows not in ("fail", "report"):
        raise ValueError(f"bad_rows is 'fail' or 'report', not {bad_rows!r}")
    reader = spark.read.options(**CSV_OPTIONS).option("enforceSchema", False).option("multiLine", line_breaks)
    if bad_rows == "report":
        schema = T.StructType([*schema.fields, T.StructField(BAD_ROW, T.StringType(), True)])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_ROW)
    else:
        reader = reader.option("mode", "FAILFAST")
    df = reader.schema(schema).csv(path)
    if blank_as_null:
        df = df.select(*[F.nullif(F.col(f"`{f.name}`"), F.lit("")).alias(f.name)
                         if isinstance(f.dataType, T.StringType) and f.name != BAD_ROW else F.col(f"`{f.name}`")
                         for f in schema.fields])
    return df


def renamed_schema(schema: T.StructType) -> T.StructType:
    """The schema with snake_case field names (types unchanged)."""
    names = clean_name_list([f.name for f in schema.fields])
    return T.StructType([T.StructField(n, f.dataType, f.nullable) for n, f in zip(names, schema.fields)])


def load_submissions(spark: SparkSession, path: str, schema: T.StructType | JsonForm | None = None,
                     fmt: str = "csv", bad_rows: str = "fail", blank_as_null: bool = False,
                     line_breaks: bool = True) -> DataFrame:
    """A landed export as a table with clean column names.

    ``schema`` lists the export's own (raw) column names and their types, in
    file order; CSV exports need it, and their header is held against it
    (see ``read_csv``, also for bad rows and blanks). ``NA`` cells read as
    NULL, a quoted empty string as ``''``. Quoted cells may hold line
    breaks (free-text answers), so a CSV file is read by one task unless
    ``line_breaks=False`` says that no cell does; ``write_export`` writes
    files of bounded size.

    ``fmt="json"`` reads records or pages of records, one a line, under a
    declared form (``json_forms``), which ``schema`` then is.
    """
    if fmt == "csv":
        if schema is None:
            raise ValueError("a CSV export needs a declared schema")
        df = read_csv(spark, path, schema, bad_rows, blank_as_null, line_breaks)
    elif fmt == "json":
        if not isinstance(schema, JsonForm):
            raise ValueError("a JSON export needs a declared form")
        df = flatten(records(spark.read.text(path)), schema, bad_rows, blank_as_null)
    elif fmt == "parquet":
        df = spark.read.schema(schema).parquet(path) if schema is not None else spark.read.parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    names = clean_name_list([c for c in df.columns if c != BAD_ROW])
    return df.toDF(*names, *[BAD_ROW] * (BAD_ROW in df.columns))


def write_export(df: DataFrame, path: str, header_names: list[str] | None = None,
                 partitions: int | None = None, file_rows: int = FILE_ROWS) -> None:
    """Write a CSV export with the given header names (spreadsheet style), ``file_rows`` to a file at most."""
    out = df.toDF(*header_names) if header_names else df
    if partitions:
        out = out.coalesce(partitions)
    out.write.mode("overwrite").options(**CSV_OPTIONS).option("maxRecordsPerFile", file_rows).csv(path)
