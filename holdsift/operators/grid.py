"""Table normalisation: raw grids to holding rows.

Input is the long grid ``(doc_id, table_id, row_idx, cells)``.  The header of a
table is found with one map-side-combined aggregate over its first rows; that
small table-level frame joins back to the cells on the table key, so the cells
move at most once and AQE may split or broadcast the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdsift import rules as R
from holdsift.functions import cells as C
from holdsift.functions.text import hit, settle

TABLE = ["doc_id", "table_id"]


def header_rows(grid: DataFrame, dialect: str = "excel", scan_rows: int | None = None,
                min_mapped: int = R.MIN_MAPPED_COLUMNS, headers=None, min_rows: int = 2) -> DataFrame:
    """One row per usable table: header position, names, per-field column positions, header hash.

    The header is the first of the leading ``scan_rows`` rows with at least
    ``min_mapped`` recognised cells; tables under ``min_rows`` rows are left out.
    """
    k = R.HEADER_SCAN_ROWS[dialect] if scan_rows is None else scan_rows
    fields = F.transform(F.col("cells"), lambda c: C.header_field(c, dialect, headers))
    mapped_cells = F.size(F.array_compact(F.when(F.col("_likely"), fields)))
    likely = C.may_be_header(F.col("_text"), dialect, min_mapped, headers)
    # one column per step: the few rows that pass the cheap test have their cells mapped
    scanned = grid.withColumn("_text", settle(F.when(F.col("row_idx") < k, C.row_text(F.col("cells")))))
    scanned = scanned.withColumn("_likely", settle(likely)).withColumn("_ok", settle(mapped_cells >= min_mapped))
    # only rows that can be the header carry their cells into the aggregate
    found = scanned.select(*TABLE, F.when(F.col("_ok"), F.struct("row_idx", "cells")).alias("_head")).groupBy(*TABLE).agg(
        F.count(F.lit(1)).alias("grid_rows"), F.min_by("_head", F.col("_head.row_idx")).alias("_h"),
    ).filter((F.col("grid_rows") >= min_rows) & F.col("_h").isNotNull())
    raw = F.col("_h.cells")
    names = C.excel_column_names(raw) if dialect == "excel" else F.filter(raw, lambda c: c.isNotNull() & (c != ""))
    # one column per step, so that names and fields are worked out once per table
    named = found.select(
        *TABLE, F.col("_h.row_idx").alias("header_row_idx"), "grid_rows", settle(names).alias("column_names"), raw.alias("_raw")
    )
    # the spreadsheet reader maps the names it made up; the other one maps the cells themselves
    cells = F.col("column_names" if dialect == "excel" else "_raw")
    mapped = F.transform(cells, lambda c: C.header_field(c, dialect, headers))
    out = named.select(
        *TABLE, "header_row_idx", "grid_rows", "column_names", settle(mapped).alias("mapped_fields"),
        cells.alias("header_cells"), C.header_hash(F.col("column_names"), dialect).alias("header_hash"),
    )
    if dialect == "excel":
        out = out.filter(F.size(F.array_compact("mapped_fields")) >= min_mapped)
    return out


def column_mapping(headers: DataFrame) -> DataFrame:
    """Long form of the mapping: one row per recognised column, named by the cell at its position."""
    return headers.select(
        *TABLE, F.posexplode("mapped_fields").alias("column_idx", "field"), "header_cells"
    ).filter(F.col("field").isNotNull()).select(
        *TABLE, "column_idx", F.get("header_cells", F.col("column_idx")).alias("column_name"), "field"
    )


def _positions(field: str) -> Column:
    marked = F.transform(F.col("mapped_fields"), lambda f, i: F.when(f == field, i))
    return F.array_compact(marked)


def _choose(field: str, read, last: bool, usable) -> Column:
    """``read(cell)`` of the field's column; with several columns the first (or last) usable one.

    Nearly every table has one column per field: that case is a plain lookup, arrays
    are only walked for repeated columns.
    """
    pos = F.col(f"_pos.{field}")
    many = F.filter(F.transform(pos, lambda p: read(F.get(F.col("cells"), p))), usable)
    picked = F.try_element_at(many, F.lit(-1)) if last else F.get(many, F.lit(0))
    return F.when(F.size(pos) > 1, picked).otherwise(read(F.get(F.col("cells"), F.get(pos, F.lit(0)))))


def holding_rows(grid: DataFrame, dialect: str = "excel", headers: DataFrame | None = None,
                 fields: Sequence[str] = tuple(R.HOLDING_FIELDS), null_markers: Sequence[str] | None = None) -> DataFrame:
    """Data rows under each table's header, mapped to the standard fields and cleaned.

    Numbers come as double in ``<field>``; text that is no number is kept in
    ``<field>_raw``.  Rows with fewer than two set fields are dropped.
    """
    head = header_rows(grid, dialect) if headers is None else headers
    slim = head.select(
        *TABLE, "header_row_idx", F.struct(*[_positions(f).alias(f) for f in fields]).alias("_pos")
    )
    data = grid.join(slim, TABLE).filter(F.col("row_idx") > F.col("header_row_idx"))
    numeric = [f for f in fields if f in R.NUMERIC_FIELDS]
    plain = [f for f in fields if f not in numeric]
    filled = lambda v: v.isNotNull()
    # one column per step, so that each cell is picked and cleaned once
    if dialect == "excel":
        clean = lambda c: C.null_markers(c, null_markers)
        data = data.withColumns({f"_v_{f}": _choose(f, clean, False, filled) for f in fields})
        data = data.withColumns({f"_n_{f}": C.number_cell(F.col(f"_v_{f}"), dialect) for f in numeric})
    else:
        data = data.filter(F.exists("cells", lambda c: c.isNotNull() & (F.trim(c) != "")))
        number = lambda c: C.number_cell(c, "pdf")
        set_ = lambda x: x["num"].isNotNull() | x["txt"].isNotNull()
        data = data.withColumns({
            **{f"_v_{f}": _choose(f, lambda c: c, True, filled) for f in plain},
            **{f"_n_{f}": _choose(f, number, True, set_) for f in numeric},
        })
    out = {}
    for f in fields:
        if f in numeric:
            out[f], out[f + "_raw"] = F.col(f"_n_{f}.num"), F.col(f"_n_{f}.txt")
        else:
            v = F.trim(F.col(f"_v_{f}"))
            out[f] = v if dialect == "pdf" else F.when(v != "", C.clean_isin(v) if f == "isin" else v)
    rows = data.select(
        *TABLE, (F.col("row_idx") - F.col("header_row_idx") - 1).alias("row_idx"),
        *[c.alias(n) for n, c in out.items()],
    )
    n_set = F.lit(0)
    for f in fields:
        n_set = n_set + hit(F.col(f).isNotNull() | F.col(f + "_raw").isNotNull() if f in numeric else F.col(f).isNotNull())
    return rows.withColumn("_set", settle(n_set)).filter(F.col("_set") >= R.MIN_MAPPED_COLUMNS).drop("_set")


def number_kept_rows(rows: DataFrame) -> DataFrame:
    """``row_idx`` counted over the rows that were kept, from 0: the number a nameless row's key is made of.

    The window holds one table of one file, which its format bounds.
    """
    return rows.withColumn("row_idx", F.row_number().over(Window.partitionBy(*TABLE).orderBy("row_idx")) - 1)


def table_results(rows: DataFrame, headers: DataFrame) -> DataFrame:
    """Table-level metadata with row counts and the percentage check; tables without rows drop out."""
    counts = pct_totals(rows)
    return counts.join(headers.drop("mapped_fields", "header_cells"), TABLE)


def pct_totals(rows: DataFrame, low: float = R.PCT_TOTAL_RANGE[0], high: float = R.PCT_TOTAL_RANGE[1]) -> DataFrame:
    """Sum of the numeric percentages per table and whether it is off the plausible range."""
    total = F.coalesce(F.sum("pct_to_net_assets"), F.lit(0.0))
    return rows.groupBy(*TABLE).agg(F.count(F.lit(1)).alias("row_count"), total.alias("pct_total")).withColumn(
        "pct_violation", (F.col("pct_total") > 0) & ~F.round("pct_total", 9).between(low, high)
    )


def split_by_type(docs: DataFrame, file_type: str = "file_type") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pdf documents, spreadsheet documents, error rows for every other type)."""
    t = F.col(file_type)
    pdf = docs.filter(t == "pdf")
    sheets = docs.filter(t.isin("xlsx", "xls"))
    bad = docs.filter(~F.coalesce(t.isin("pdf", "xlsx", "xls"), F.lit(False))).withColumn(
        "last_error",
        F.concat(F.lit("Extraction error: Unsupported file type: "), F.coalesce(t, F.lit("None"))),
    )
    return pdf, sheets, bad


def header_text(grid: DataFrame, rows: int = R.HEADER_ROWS, sheets: int = R.HEADER_SHEETS) -> DataFrame:
    """Header text and sheet names per document: the first rows of the first sheets, blanks between cells.

    Each sheet's rows are followed by a line with the sheet's name. Per sheet at most ``rows`` lines reach the
    aggregate, per document at most its sheets.
    """
    line = F.array_join(F.array_compact("cells"), " ")
    sheet = grid.filter(F.col("row_idx") < rows).groupBy("doc_id", "sheet_idx", "sheet_name").agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("row_idx", line.alias("line")))), lambda x: x["line"]), " "
        ).alias("text"),
        F.bool_or(F.col("row_idx") == 0).alias("named"),
    )
    ordered = F.sort_array(F.collect_list(F.struct("sheet_idx", "sheet_name", "text", "named")))
    whole = sheet.groupBy("doc_id").agg(ordered.alias("s"))
    read = F.filter("s", lambda x: x["sheet_idx"] < sheets)
    block = lambda x: F.concat(
        F.lit(" "), x["text"], F.lit("\n[Sheet: "), F.coalesce(x["sheet_name"], F.lit("None")), F.lit("]\n"))
    return whole.select(
        "doc_id", F.array_join(F.transform(read, block), "").alias("header_text"),
        F.transform(F.filter("s", lambda x: x["named"]), lambda x: x["sheet_name"]).alias("sheet_names"),
    )


def to_clean_json(rows: DataFrame, fields: Sequence[str] = tuple(R.HOLDING_FIELDS), out: str = "clean_data") -> DataFrame:
    """JSON of a row's non-null fields."""
    return rows.withColumn(out, F.to_json(F.struct(*fields)))
