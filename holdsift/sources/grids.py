"""Raw table grids: every cell a string, no header, one row per grid row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A line runs to a line break outside quotes, blank ones too; a cell follows a comma outside quotes
# (one is put ahead of the line); a doubled quote is the end of one quoted stretch and the start of
# the next.  Possessive throughout: nothing is tried twice, however long the line.
_LINE = r'(?=[\s\S])((?:[^"\r\n]++|"[^"]*+"|")*+)(?:\r\n?|\n|\z)'
_CELL = r',((?:[^",]++|"[^"]*+"|")*+)'

GRID_SCHEMA = "doc_id string, table_id int, sheet_name string, sheet_idx int, row_idx int, cells array<string>"


def read_grid_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV files as grids.

    A file is read whole as one table (multi-line quoted cells need it), so it must be below
    2 GB, and given row numbers in file order; a blank line is a row with one empty cell. No
    type or header is guessed.
    """
    text = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("doc_id"), "value"
    )
    lines = text.select(
        "doc_id",
        F.posexplode(F.regexp_extract_all("value", F.lit(_LINE), F.lit(1))).alias("row_idx", "line"),
    )
    cells = F.transform(
        F.regexp_extract_all(F.concat(F.lit(","), "line"), F.lit(_CELL), F.lit(1)),
        lambda c: F.when(
            c.rlike(r'(?s)^".*"$'), F.replace(F.regexp_replace(c, r'(?s)^"(.*)"$', "$1"), F.lit('""'), F.lit('"'))
        ).when(c != "", c),
    )
    return lines.select(
        "doc_id", F.lit(0).alias("table_id"), F.lit(None).cast("string").alias("sheet_name"),
        F.lit(0).alias("sheet_idx"), "row_idx", cells.alias("cells"),
    )
