"""CSV files and workbooks."""

from __future__ import annotations

import csv
import io
import json
from collections.abc import Callable, Iterable, Iterator
from functools import partial, reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pagequarry.functions import naming


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             infer: bool = True) -> DataFrame:
    """CSV with a header row. Inference costs a second pass over the files; give a schema to skip it."""
    reader = (spark.read.option("header", "true").option("multiLine", "true")
              .option("quote", '"').option("escape", '"'))
    return reader.csv(path, schema=schema) if schema else reader.csv(path, inferSchema=infer)


def write_csv(df: DataFrame, path: str, partition_by: str = "category") -> None:
    (df.write.mode("overwrite").partitionBy(partition_by).option("header", "true")
     .option("quote", '"').option("escape", '"').csv(path))


def workbook_rows(sheets: dict[str, DataFrame]) -> DataFrame:
    """All sheets of a workbook as one table of cells, in sheet order with 1-based numbers."""
    parts = [
        df.select(F.lit(i).alias("sheet_idx"), F.lit(name).alias("sheet_name"),
                  F.to_json(F.struct(*df.columns)).alias("row"))
        for i, (name, df) in enumerate(sheets.items(), 1)
    ]
    return reduce(DataFrame.unionByName, parts)


def workbook_sheets(doc: str, category: str, sheets: dict[str, DataFrame]) -> DataFrame:
    """One row per sheet with its row and column counts and output paths."""
    parts = []
    for i, (name, df) in enumerate(sheets.items(), 1):
        out = naming.sheet_output_name(F.lit(doc), F.lit(name))
        parts.append(df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(i).alias("sheet_idx"), F.lit(name).alias("sheet_name"),
            naming.safe_name(F.lit(name)).alias("safe_sheet"), "rows",
            F.lit(len(df.columns)).alias("columns"), F.lit(len(sheets)).alias("pages"),
            naming.md_path(F.lit(category), out).alias("md_file"),
            naming.csv_path(F.lit(category), out).alias("csv_file")))
    return reduce(DataFrame.unionByName, parts)


#: Tables of one file's content: (name or None, rows of texts, the first being the header).
TableSource = Callable[[bytes], Iterable[tuple[str | None, list[list[str]]]]]
SHEET_SOURCES: dict[str, TableSource] = {}
TABLE_EXTRACTORS: dict[str, TableSource] = {}
TABLE_CELLS = "path string, table_no int, table_name string, row_no int, col_idx int, column string, value string"
TABLE_TEXTS = "path string, table_no int, table_name string, rows bigint, content binary"


def register_sheet_source(name: str, read: TableSource) -> None:
    """Make a reader of workbooks available by name: bytes to the sheets in order, each with its name."""
    SHEET_SOURCES[name] = read


def register_table_extractor(name: str, read: TableSource) -> None:
    """Make a finder of tables in documents available by name: bytes to the tables in order."""
    TABLE_EXTRACTORS[name] = read


def json_sheets(content: bytes) -> list[tuple[str | None, list[list[str]]]]:
    """A workbook as a JSON object of sheets, each a list of rows; null cells are empty."""
    return [(name, [["" if v is None else str(v) for v in row] for row in rows]) for name, rows in json.loads(content).items()]


def pipe_tables(content: bytes) -> list[tuple[str | None, list[list[str]]]]:
    """Pipe tables in plain text: runs of lines that begin and end with a bar; lines of dashes between bars are no rows."""
    found: list[tuple[str | None, list[list[str]]]] = []
    rows: list[list[str]] = []
    for line in [*content.decode("utf-8", "replace").splitlines(), ""]:
        body = line.strip()
        if len(body) > 1 and body[0] == body[-1] == "|":
            cells = [c.strip() for c in body[1:-1].split("|")]
            if any(c.strip("-:") or not c for c in cells):
                rows.append(cells)
        elif rows:
            found.append((None, rows))
            rows = []
    return found


register_sheet_source("json", json_sheets)
register_table_extractor("pipes", pipe_tables)


def csv_table(content: bytes) -> list[tuple[str | None, list[list[str]]]]:
    table = _rows_of(content)
    return [] if table is None else [(None, [table[0], *table[1]])]


def _tables_in(read: TableSource, content: bytes | None) -> list[tuple[str | None, list[list[str]]]]:
    """The file's tables; none if it cannot be read, so that one bad file costs itself only."""
    try:
        return [] if content is None else [(name, rows) for name, rows in read(bytes(content)) if rows]
    except Exception:  # noqa: BLE001 - readers are the user's own
        return []


def _cells_of(batches: Iterator[pa.RecordBatch], read: TableSource) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in TABLE_CELLS.split(", ")]
    types = [pa.string(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string()]
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            for number, (name, rows) in enumerate(_tables_in(read, content.as_py()), 1):
                header = rows[0]
                for start in range(0, len(rows), _BATCH_ROWS):
                    cells = [(path, number, name, n, i, h, row[i - 1] if n and i <= len(row) else None)
                             for n, row in enumerate(rows[start:start + _BATCH_ROWS], start) for i, h in enumerate(header, 1)]
                    if cells:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*cells), types)], names)


def table_cells(files: DataFrame, read: TableSource) -> DataFrame:
    """Cells of all tables of many files (path, content); row 0 holds the header."""
    return files.select("path", "content").mapInArrow(partial(_cells_of, read=read), TABLE_CELLS)


def _texts_of(batches: Iterator[pa.RecordBatch], read: TableSource) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            for number, (name, rows) in enumerate(_tables_in(read, content.as_py()), 1):
                out = io.StringIO(newline="")
                csv.writer(out, lineterminator="\n").writerows(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([number], pa.int32()), pa.array([name], pa.string()), pa.array([len(rows) - 1], pa.int64()),
                     pa.array([out.getvalue().encode("utf-8", "surrogatepass")], pa.binary())], [f.split()[0] for f in TABLE_TEXTS.split(", ")])


def table_texts(files: DataFrame, read: TableSource) -> DataFrame:
    """Each table of many files (path, content) as the CSV file that is written of it, with its number of rows."""
    return files.select("path", "content").mapInArrow(partial(_texts_of, read=read), TABLE_TEXTS)


def output_name(doc: Column, kind: str) -> Column:
    """Name of a table's outputs without suffix: by document, sheet, or number."""
    return {"csv": doc, "excel": naming.sheet_output_name(doc, F.col("table_name")), "pdf": naming.table_name(doc, F.col("table_no"))}[kind]


CELLS = "path string, row_no int, col_idx int, column string, value string"
_BATCH_ROWS = 20_000


def header_names(names: list[str]) -> list[str]:
    """Column names of a header row: empty ones are numbered from 0, repeated ones get a suffix."""
    seen: dict[str, int] = {}
    header = []
    for i, name in enumerate(names):
        name = name or f"Unnamed: {i}"
        again = seen.get(name, 0)
        seen[name] = again + 1
        header.append(f"{name}.{again}" if again else name)
    return header


def _rows_of(content: bytes) -> tuple[list[str], list[list[str]]] | None:
    """Header and rows of one CSV file; None when it cannot be read as a table."""
    try:
        lines = [r for r in csv.reader(io.StringIO(bytes(content).decode("utf-8-sig"), newline="")) if r]
    except (UnicodeDecodeError, csv.Error):
        return None
    if not lines:
        return None
    # Leading fields without a header are row labels when the first row has them; they are no columns.
    labels = max(0, len(lines[1]) - len(lines[0])) if len(lines) > 1 else 0
    if any(len(r) > len(lines[0]) + labels for r in lines):
        return None
    header = header_names(lines[0])
    return header, [r[labels:] for r in lines[1:]]


def csv_cells(files: DataFrame) -> DataFrame:
    """Cells of many CSV files of differing columns (path, content); row 0 holds the header.

    One file is one row here and parsed by one task, as a stored file content is; read a single
    huge file with :func:`read_csv`. Unreadable files give no cells.
    """

    columns = ["path", "row_no", "col_idx", "column", "value"]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                table = _rows_of(content)
                if table is None:
                    continue
                header, rows = table
                yield pd.DataFrame([(path, 0, i, h, None) for i, h in enumerate(header, 1)], columns=columns)
                for start in range(0, len(rows), _BATCH_ROWS):
                    yield pd.DataFrame(
                        [(path, n, i, h, row[i - 1] if i <= len(row) else None)
                         for n, row in enumerate(rows[start:start + _BATCH_ROWS], start + 1)
                         for i, h in enumerate(header, 1)], columns=columns)

    return files.select("path", "content").filter(F.col("content").isNotNull()).mapInPandas(parse, CELLS)
