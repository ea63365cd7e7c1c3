"""Tabular files: row counts, profiles, samples, summaries."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pagequarry.config import PREVIEW_COLUMNS, SAMPLE_ROWS
from pagequarry.functions import markdown, naming
from pagequarry.functions.pipe_table import render_table
from pagequarry.operators.rollup import ordered, part_of
from pagequarry.operators.skew import number_within

TABLES_PER_TEXT = 64

# Cell texts a CSV reader takes as missing, and those it takes as booleans.
NA_TEXTS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
            "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
BOOL_TEXTS = ("True", "TRUE", "true", "False", "FALSE", "false")
_INT = r"^\s*[+-]?[0-9]+\s*$"
_FLOAT = r"(?i)^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?\s*$|^\s*[+-]?inf(?:inity)?\s*$"


def table_rows(rows: DataFrame, *table_key: str) -> DataFrame:
    return rows.groupBy(*table_key).agg(F.count(F.lit(1)).alias("rows"))


def table_numbering(tables: DataFrame, order: str) -> DataFrame:
    """1-based table numbers inside each document, and the CSV file each is written to."""
    numbered = number_within(tables, "doc_id", order, "table_idx")
    return numbered.withColumn("csv_name", naming.table_name(F.col("doc_id"), F.col("table_idx")))


def table_sample(rows: DataFrame, table_key: str, order: list[str], n: int = SAMPLE_ROWS) -> DataFrame:
    """First rows of each table in file order; each task passes on at most ``n`` rows per table."""
    w = Window.partitionBy(table_key).orderBy(*order)
    return rows.withColumn("sample_row", F.row_number().over(w)).filter(F.col("sample_row") <= n)


# What a cell looks like, as bits: a column's dtype follows from the bits seen in it.
_MISSING, _BOOL, _INT_CELL, _FLOAT_CELL, _OTHER = 1, 2, 4, 8, 16


def cell_kind(c: Column) -> Column:
    return (F.when(c.isNull() | c.isin(*NA_TEXTS), _MISSING).when(c.rlike(_INT), _INT_CELL)
            .when(c.rlike(_FLOAT), _FLOAT_CELL).when(c.isin(*BOOL_TEXTS), _BOOL).otherwise(_OTHER))


def dtype_of(kinds: Column) -> Column:
    """dtype of a text column from the kinds seen; no rows at all is object, no values float64."""
    numeric = _MISSING | _INT_CELL | _FLOAT_CELL
    return (F.when(kinds.isNull(), "object").when(kinds == _BOOL, "bool").when(kinds == _INT_CELL, "int64")
            .when(kinds.bitwiseAND(F.lit(~numeric)) == 0, "float64").otherwise("object"))


def _stored_type(t: T.DataType) -> str:
    if isinstance(t, T.IntegralType):
        return "int64"
    if isinstance(t, (T.DoubleType, T.FloatType)):
        return "float64"
    if isinstance(t, T.BooleanType):
        return "bool"
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return "datetime64[ns]"
    return "object"


def _profile_row(name: str, df: DataFrame) -> DataFrame:
    """One row: table_name, rows, columns and the array of column profiles.

    String columns are typed by their cells, as a CSV reader would; typed columns keep their type,
    an integer column with missing cells being float64 and a boolean one object.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    marked = df.withColumns({c: cell_kind(F.col(f"`{c}`")) for c in texts})
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, column in enumerate(df.columns):
        c = F.col(f"`{column}`")
        if column in texts:
            aggs += [F.count_if(c == _MISSING).alias(f"m{i}"), F.bit_or(c).alias(f"k{i}")]
        else:
            aggs.append(F.count_if(c.isNull()).alias(f"m{i}"))
    columns = []
    for i, f in enumerate(df.schema.fields):
        missing = F.col(f"m{i}")
        if f.name in texts:
            dtype = dtype_of(F.col(f"k{i}"))
        else:
            stored = _stored_type(f.dataType)
            widened = {"int64": "float64", "bool": "object"}.get(stored, stored)
            dtype = F.when(missing > 0, widened).otherwise(stored)
        label = f.name if f.name.strip() else f"Unnamed: {i}"
        columns.append(F.struct(F.lit(i + 1).alias("col_idx"), F.lit(label).alias("column"),
                                dtype.alias("dtype"), missing.alias("missing")))
    return marked.agg(*aggs).select(
        F.lit(name).alias("table_name"), F.col("n").alias("rows"),
        F.lit(len(df.columns)).alias("columns"), F.array(*columns).alias("cols"))


def table_profile(name: str, df: DataFrame) -> DataFrame:
    """Row count, column count and dtype of each column, in one pass over the table."""
    return _profile_row(name, df).select("table_name", "rows", "columns", F.inline("cols"))


def profile_tables(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [table_profile(n, d) for n, d in tables.items()])


def cell_profile(cells: DataFrame, *table_key: str) -> DataFrame:
    """Profile of very many tables held as text cells (table key, row_no, col_idx, column, value).

    Row 0 holds the headers. ``first_cells`` are the cells of the first rows. Counts and kinds are
    combined before the shuffle, so a huge table costs a row per column and input partition.
    """
    table_key = table_key or ("table_id",)
    data = F.col("row_no") > 0
    marked = cells.withColumn("kind", F.when(data, cell_kind(F.col("value"))))
    value = F.when(F.col("kind") != _MISSING, F.col("value"))
    early = F.when(data & (F.col("row_no") <= SAMPLE_ROWS), F.struct("row_no", value.alias("value")))
    return (marked.groupBy(*table_key, "col_idx", "column")
            .agg(F.count_if(data).alias("rows"), F.count_if(F.col("kind") == _MISSING).alias("missing"),
                 F.bit_or("kind").alias("kinds"), F.collect_list(early).alias("first_cells"))
            .select(*table_key, "col_idx", "column", "rows", "missing", dtype_of(F.col("kinds")).alias("dtype"), "first_cells"))


def _dtype_lines(columns: Column) -> Column:
    """Column names and dtypes, names padded right and dtypes padded left."""
    name_width = F.array_max(F.transform(columns, lambda x: F.length(x["column"])))
    type_width = F.array_max(F.transform(columns, lambda x: F.length(x["dtype"])))
    return F.array_join(F.transform(columns, lambda x: F.concat(
        F.rpad(x["column"], name_width, " "), F.lit("    "), F.lpad(x["dtype"], type_width, " "))), "\n")


@F.pandas_udf(T.StringType())
def _render_samples(columns: pd.Series, dtypes: pd.Series, rows: pd.Series) -> pd.Series:
    return pd.Series([render_table(list(c), list(d), [list(r) for r in s])
                      for c, d, s in zip(columns, dtypes, rows)])


def _summary_markdown(filename: Column, title: Column, page: Column, csv_name: Column, file_hash: Column,
                      run_time: str) -> Column:
    """Page of a tabular file from its rows, columns, cols (column, dtype) and sample."""
    cat, doc = naming.category(filename), naming.doc_id(filename)
    table = _render_samples(F.transform("cols", lambda x: x["column"]),
                            F.transform("cols", lambda x: x["dtype"]), F.col("sample"))
    # Fixed layout of a tabular file's page.
    return F.concat(
        markdown.metadata_header(doc, filename, page, cat, file_hash),
        F.lit("\n\n# "), title, F.lit("\n\n## Summary\n- Document ID: "), doc,
        F.lit("\n- Rows: "), F.col("rows").cast("string"),
        F.lit("\n- Columns: "), F.col("columns").cast("string"),
        F.lit("\n- CSV File: "), csv_name, F.lit("\n\n## Column Information\n"), _dtype_lines(F.col("cols")),
        F.lit("\n\n## Sample Data (First 5 rows)\n"),
        F.when(F.col("rows") > 0, table).otherwise("No data"),
        F.lit(f"\n\n## Processing Information\n- Extracted using: pandas\n- Processing timestamp: {run_time}\n"))


def _rendered_table(filename: str, df: DataFrame, order: list[str], title: Column, page: int, output: Column,
                    file_hash: Column, run_time: str) -> DataFrame:
    cells = F.array(*[F.col(f"`{c}`").cast("string") for c in df.columns])
    first = df.orderBy(*order).limit(SAMPLE_ROWS).select(F.struct(*order).alias("k"), cells.alias("v"))
    sample = first.agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "v"))), lambda x: x["v"]).alias("sample"))
    halves = _profile_row(filename, df).unionByName(
        sample.withColumn("table_name", F.lit(filename)), allowMissingColumns=True)
    whole = halves.groupBy("table_name").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in ("rows", "columns", "cols", "sample")])
    name = F.lit(filename)
    cat = naming.category(name)
    md = _summary_markdown(name, title, F.lit(page), F.concat(output, F.lit(".csv")), file_hash, run_time)
    return whole.select(name.alias("filename"), naming.doc_id(name).alias("doc_id"), cat.alias("category"),
                        naming.md_path(cat, output).alias("md_file"), "rows", "columns", md.alias("md"))


def profile_render(filename: str, df: DataFrame, order: list[str], file_hash: Column, run_time: str) -> DataFrame:
    """Markdown summary of one tabular file: counts, dtypes and its first rows by ``order``."""
    name = F.lit(filename)
    return _rendered_table(filename, df, order, name, 1, naming.doc_id(name), file_hash, run_time)


def workbook_render(filename: str, sheets: dict[str, tuple[DataFrame, list[str]]], file_hash: Column, run_time: str) -> DataFrame:
    """Markdown summaries of a workbook's sheets, numbered from 1; each comes with its row order."""
    doc = naming.doc_id(F.lit(filename))
    return reduce(DataFrame.unionByName, [
        _rendered_table(filename, df, order, F.lit(f"{filename} - Sheet: {sheet}"), i,
                        naming.sheet_output_name(doc, F.lit(sheet)), file_hash, run_time)
        for i, (sheet, (df, order)) in enumerate(sheets.items(), 1)])


def render_cell_tables(cells: DataFrame, files: DataFrame, run_time: str) -> DataFrame:
    """Markdown summaries of the tables of many files from their cells; ``files`` has path, filename, hash.

    Cells may have table_no and table_name: sheets of a workbook, each with a page of its own. Without them a file is one table.
    """
    if "table_no" not in cells.columns:
        cells = cells.withColumns({"table_no": F.lit(1), "table_name": F.lit(None).cast("string")})
    keys = ["path", "table_no", "table_name"]
    columns = cell_profile(cells, *keys)
    tables = columns.groupBy(*keys).agg(
        F.max("rows").alias("rows"), F.count(F.lit(1)).alias("columns"),
        F.sort_array(F.collect_list(F.struct("col_idx", "column", "dtype", "first_cells"))).alias("cols"))
    row_numbers = F.when(F.col("rows") > 0, F.sequence(F.lit(1), F.least(F.lit(SAMPLE_ROWS), F.col("rows")).cast("int"))
                         ).otherwise(F.array().cast("array<int>"))
    sample = F.transform(row_numbers, lambda n: F.transform("cols", lambda c: F.get(
        F.transform(F.filter(c["first_cells"], lambda x: x["row_no"] == n), lambda x: x["value"]), F.lit(0))))
    named = tables.withColumn("sample", sample).join(files.select("path", "filename", "hash"), "path")
    name, sheet = F.col("filename"), F.col("table_name")
    doc, cat = naming.doc_id(name), naming.category(name)
    output = F.when(sheet.isNull(), doc).otherwise(naming.sheet_output_name(doc, sheet))
    title = F.when(sheet.isNull(), name).otherwise(F.concat(name, F.lit(" - Sheet: "), sheet))
    md = _summary_markdown(name, title, F.col("table_no"), F.concat(output, F.lit(".csv")), F.col("hash"), run_time)
    return named.select("path", doc.alias("doc_id"), cat.alias("category"), "hash", "rows", "columns", "table_no",
                        naming.md_path(cat, output).alias("md_file"), naming.csv_path(cat, output).alias("csv_file"), md.alias("md"))


def _shown(values: pd.Series) -> pd.Series:
    """Numbers as a table shows them; of texts those that are numbers, marked as whole or not, and null for the others."""
    if values.dtype != object:
        return values.map("{:g}".format)

    def text(v: str | None) -> str | None:
        try:
            shown = f"f{float('nan' if v is None else v):g}"
        except ValueError:
            return None
        try:
            int(v)
        except (TypeError, ValueError):
            return shown
        return "i" + shown[1:]

    return values.map(text)


def _fraction(cell: Column) -> Column:
    """Characters after the decimal point, or the exponent mark; -1 for whole numbers."""
    point, mark = F.locate(".", cell), F.locate("e", cell)
    return F.when(point > 0, F.length(cell) - point).when(mark > 0, F.length(cell) - mark).otherwise(-1)


def pipe_tables(sample: DataFrame, table_key: str, order: str, columns: list[str]) -> DataFrame:
    """(table key, table): a pipe table of the rows of each table, by ``order``. Columns of numbers are right-aligned on their decimal point, all others left-aligned.

    Alignment is by maxima over a table's few rows, which lie together already where the sample was taken.
    """
    types = {f.name: f.dataType for f in sample.schema.fields}
    number = {c: isinstance(types[c], T.NumericType) and not isinstance(types[c], T.DecimalType) for c in columns}
    asked = [c for c in columns if not isinstance(types[c], (T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType))]
    shape = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(asked))])

    @F.pandas_udf(shape)
    def shown(*values: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({f"c{i}": _shown(v) for i, v in enumerate(values)})

    if asked:
        sample = sample.withColumn("_shown", shown(*(F.col(c).cast("double" if number[c] else "string") for c in asked)))
    cells = {}
    for i, c in enumerate(columns):
        text, whole, g = F.coalesce(F.col(c).cast("string"), F.lit("nan")), F.lit(False), F.when(F.col(c).isNull(), "nan")
        if isinstance(types[c], T.BooleanType):
            text, g = F.initcap(text), F.lit(None).cast("string")
        elif c in asked:
            told = F.col("_shown")[f"c{asked.index(c)}"]
            whole = F.col(c).isNotNull() & F.lit(isinstance(types[c], T.IntegralType)) if number[c] else F.coalesce(told.startswith("i"), F.lit(False))
            g = F.coalesce(told, F.lit("nan")) if number[c] else F.substring(told, 2, 1000)
        cells |= {f"_t{i}": text, f"_g{i}": g, f"_w{i}": whole}
    w = Window.partitionBy(table_key)
    n = range(len(columns))
    rows = sample.select(table_key, order, *(v.alias(k) for k, v in cells.items()))
    rows = rows.select(table_key, order, *(f"_t{i}" for i in n), *(f"_g{i}" for i in n), *(F.bool_and(F.col(f"_g{i}").isNotNull()).over(w).alias(f"_n{i}") for i in n),
                       *(F.bool_and(f"_w{i}").over(w).alias(f"_w{i}") for i in n))
    rows = rows.select(table_key, order, *(f"_n{i}" for i in n), *(F.when(F.col(f"_n{i}") & ~F.col(f"_w{i}"), F.col(f"_g{i}")).otherwise(F.col(f"_t{i}")).alias(f"_t{i}") for i in n))
    rows = rows.withColumns({f"_f{i}": F.when(F.col(f"_n{i}"), F.max(_fraction(F.col(f"_t{i}"))).over(w) - _fraction(F.col(f"_t{i}"))).otherwise(0) for i in n})
    rows = rows.withColumns({f"_t{i}": F.concat(f"_t{i}", F.repeat(F.lit(" "), F.col(f"_f{i}"))) for i in n})
    rows = rows.withColumns({f"_l{i}": F.greatest(F.lit(len(c) + 2), F.max(F.length(f"_t{i}")).over(w)) for i, c in enumerate(columns)})

    def line(texts: list[Column]) -> Column:
        padded = [F.when(F.col(f"_n{i}"), F.lpad(t, F.col(f"_l{i}"), F.lit(" "))).otherwise(F.rpad(t, F.col(f"_l{i}"), F.lit(" "))) for i, t in enumerate(texts)]
        return F.concat(F.lit("| "), F.concat_ws(" | ", *padded), F.lit(" |"))

    dashes = [F.repeat(F.lit("-"), F.col(f"_l{i}") + 1) for i in n]
    rule = F.concat_ws("|", *(F.when(F.col(f"_n{i}"), F.concat(d, F.lit(":"))).otherwise(F.concat(F.lit(":"), d)) for i, d in enumerate(dashes)))
    head = F.concat(line([F.lit(c) for c in columns]), F.lit("\n|"), rule, F.lit("|\n"))
    made = rows.select(table_key, order, line([F.col(f"_t{i}") for i in n]).alias("line"), F.when(F.col(order) == F.min(order).over(w), head).alias("head"))
    return made.groupBy(table_key).agg(F.concat(F.max("head"), F.array_join(ordered(order, F.col("line")), "\n")).alias("table"))


def table_summaries(rows: DataFrame, tables: DataFrame, order: list[str], columns: list[str],
                    per_part: int = TABLES_PER_TEXT) -> DataFrame:
    """Per document a title and its tables in number order: name, counts, first column names, first rows.

    ``rows`` has table_id and the data columns, ``order`` among them; ``tables`` has doc_id, table_id,
    table_idx and csv_name. Documents of many tables come in parts, as in the page rollups; parts join
    without anything between them.
    """
    counts = table_rows(rows, "table_id")
    # Rows stay typed until the sample is taken: only the few sampled ones become text.
    first = table_sample(rows.select("table_id", *columns, *[c for c in order if c not in columns]), "table_id", order)
    # the sample is small, so its shuffle is coalesced into few tasks; what follows is heavy per row and is spread again
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    samples = pipe_tables(first.repartition(width, "table_id"), "table_id", "sample_row", columns)
    # Fixed layout of a document's title and of one table's entry.
    title = F.when(F.col("part") == 0, F.concat(F.lit("# Table Summaries for "), F.col("doc_id"), F.lit("\n\n"))).otherwise("\n")
    entry = F.concat(
        F.lit("## "), F.col("csv_name"), F.lit(".csv\n- Rows: "), F.col("rows").cast("string"),
        F.lit(f"\n- Columns: {len(columns)}\n### Columns Preview: {', '.join(columns[:PREVIEW_COLUMNS])}\n\n"),
        F.col("table"), F.lit("\n\n---"))
    return (
        counts.join(samples, "table_id").join(tables, "table_id")
        .select("doc_id", "table_idx", part_of(F.col("table_idx"), per_part).alias("part"), entry.alias("entry"))
        .groupBy("doc_id", "part")
        .agg(F.count(F.lit(1)).alias("tables"), F.array_join(ordered("table_idx", F.col("entry")), "\n").alias("entries"))
        .select("doc_id", "part", "tables", F.concat(title, F.col("entries")).alias("summary"))
    )
