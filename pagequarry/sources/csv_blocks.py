"""CSV files read in parallel blocks, quoted line breaks included.

Whether a line break ends a row depends on all quotes before it. A block of bytes either keeps or turns "inside quotes", by the parity of its quotes; these
two-state functions are composed by a running sum over a file's blocks, one small row each. Then every block knows its state, finds the first row that
begins in it and parses the rows that begin in it, reading on to the end of the last one. Row numbers come from a running sum of the blocks' row counts.

That holds for files whose quotes stand around whole fields, doubled inside. Blocks check it, and a file that breaks it is parsed as a whole by
:func:`~pagequarry.sources.tabular.csv_cells`, with the same rules.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagequarry.operators.skew import join_salted
from pagequarry.session import materialize
from pagequarry.sources.folder import file_system, read_named
from pagequarry.sources.tabular import csv_cells, header_names

BLOCK_BYTES = 64 << 20
_QUOTE, _LF, _CR = 34, 10, 13
_AROUND = np.frombuffer(b',\n\r"', np.uint8)
_BOM = b"\xef\xbb\xbf"
_BATCH_ROWS = 4096
_ROWS = "path string, block bigint, local int, values array<string>, odd boolean, bad boolean"


def csv_blocks(files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """path, block and start of each block of the listed files (path, length)."""
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(block_bytes).cast("long"))
    return files.select("path", F.posexplode(starts).alias("block", "start")).withColumn("block", F.col("block").cast("long"))


def _parities(batches: Iterator[pa.RecordBatch], root: str, block_bytes: int) -> Iterator[pa.RecordBatch]:
    fs, _, scheme = file_system(root)
    for batch in batches:
        turns = []
        for path, start in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            try:
                with fs.open_input_file(path.removeprefix(scheme)) as f:
                    turns.append(f.read_at(block_bytes, start).count(b'"') % 2)
            except OSError:
                turns.append(None)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(turns, pa.int32())], [*batch.schema.names, "turn"])


def row_ends(data: np.ndarray, inside: int) -> np.ndarray:
    """Positions of the line breaks that end rows; a CR counts unless a LF follows. ``inside``: whether the first byte is within quotes."""
    after = np.r_[data[1:], 0]
    breaks = np.flatnonzero((data == _LF) | ((data == _CR) & (after != _LF)))
    quotes = np.cumsum(data == _QUOTE)
    return breaks[(quotes[breaks] + inside) % 2 == 0] if len(breaks) else breaks


def _oddly_quoted(data: bytes, inside: int, before: int, after: int) -> bool:
    """Whether a quote stands elsewhere than around a whole field or doubled within one."""
    at = np.frombuffer(data, np.uint8)
    quotes = np.flatnonzero(at == _QUOTE)
    padded = np.r_[np.uint8(before), at, np.uint8(after)]
    opens = quotes[(np.arange(len(quotes)) + inside) % 2 == 0]
    closes = quotes[(np.arange(len(quotes)) + inside) % 2 == 1]
    return bool((~np.isin(padded[opens], _AROUND)).any() or (~np.isin(padded[closes + 2], _AROUND)).any())


def rows_of_block(f: pafs.FileSystem, size: int, start: int, block_bytes: int, inside: int) -> tuple[bytes, bool]:
    """(bytes of the rows that begin in the block, whether its quotes are odd). ``inside``: whether the block begins within quotes."""
    from_before = f.read_at(min(block_bytes, size - start) + (1 if start else 0), max(0, start - 1))
    before, data = (from_before[0], from_before[1:]) if start else (_LF, from_before)
    end = start + len(data)
    after = f.read_at(1, end)[0] if end < size else _LF
    if start == 0 and data.startswith(_BOM):
        before_quotes = data[3:]
    else:
        before_quotes = data
    odd = _oddly_quoted(before_quotes, inside, before, after)
    at = np.frombuffer(data + bytes([after]), np.uint8)
    ends = row_ends(at, inside)
    ends = ends[ends < len(data)]
    if start == 0 or (not inside and (before == _LF or (before == _CR and data[:1] != b"\n"))):
        first = 0
    elif len(ends) and ends[0] + 1 < len(data):
        first = int(ends[0]) + 1
    else:
        return b"", odd  # no row begins here, or none that the next block does not begin with
    if len(ends) and ends[-1] == len(data) - 1:
        return data[first:], odd
    # the last row goes on: read up to its end
    parts, state, at_byte = [data[first:]], (inside + data.count(b'"')) % 2, end
    while at_byte < size:
        more = f.read_at(min(1 << 20, size - at_byte), at_byte)
        following = f.read_at(1, at_byte + len(more)) if at_byte + len(more) < size else b"\n"
        stops = row_ends(np.frombuffer(more + following, np.uint8), state)
        stops = stops[stops < len(more)]
        if len(stops):
            parts.append(more[:int(stops[0]) + 1])
            break
        parts.append(more)
        state, at_byte = (state + more.count(b'"')) % 2, at_byte + len(more)
    return b"".join(parts), odd


def _parse(batches: Iterator[pa.RecordBatch], root: str, block_bytes: int) -> Iterator[pa.RecordBatch]:
    """The rows that begin in each block, numbered from 1; blank lines are no rows. Each block ends with a row without values that says how it is."""
    fs, _, scheme = file_system(root)
    names = [f.split()[0] for f in _ROWS.split(", ")]

    def packed(path: str, block: int, first: int, rows: list, odd: bool, bad: bool) -> pa.RecordBatch:
        n = len(rows)
        return pa.RecordBatch.from_arrays(
            [pa.array([path] * n), pa.array([block] * n, pa.int64()), pa.array(range(first, first + n), pa.int32()), pa.array(rows, pa.list_(pa.string())),
             pa.array([odd] * n, pa.bool_()), pa.array([bad] * n, pa.bool_())], names)

    for batch in batches:
        for path, block, start, inside in zip(*(batch.column(c).to_pylist() for c in ("path", "block", "start", "inside"))):
            done, odd, bad, rows = 0, False, inside is None, []
            try:
                if not bad:
                    with fs.open_input_file(path.removeprefix(scheme)) as f:
                        data, odd = rows_of_block(f, f.size(), start, block_bytes, inside)
                    text = data.decode("utf-8-sig" if start == 0 else "utf-8")
                    for row in csv.reader(io.StringIO(text, newline="")):
                        if row:
                            rows.append(row)
                            if len(rows) == _BATCH_ROWS:
                                yield packed(path, block, done + 1, rows, False, False)
                                done, rows = done + len(rows), []
            except (OSError, UnicodeDecodeError, csv.Error):
                bad = True
            if rows:
                yield packed(path, block, done + 1, rows, False, False)
            yield packed(path, block, 0, [None], odd, bad)


def csv_rows(files: DataFrame, root: str, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """(rows, files): path, row_no (from 1, the header included) and values of the rows of the listed files (path, length) of the folder ``root``, and
    per path its widest row, whether it is odd, which needs a parser of whole files, and whether it is bad, which cannot be read."""
    # a few blocks a partition: reading and parsing is what costs
    listed = csv_blocks(files, block_bytes).repartition(F.col("path"), F.col("block"))
    turned = materialize(listed.mapInArrow(partial(_parities, root=root, block_bytes=block_bytes), "path string, block bigint, start bigint, turn int"), "csv-blocks")
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = (F.coalesce(F.sum("turn").over(earlier), F.lit(0)) % 2).cast("int")
    stated = turned.withColumn("inside", F.when(F.col("turn").isNotNull(), inside)).repartition(F.col("path"), F.col("block"))
    parsed = materialize(stated.mapInArrow(partial(_parse, root=root, block_bytes=block_bytes), _ROWS), "csv-rows")
    blocks = parsed.groupBy("path", "block").agg(F.max("local").alias("n"), F.max("odd").alias("odd"), F.max("bad").alias("bad"), F.max(F.size("values")).alias("widest"))
    numbered = materialize(blocks.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "csv-numbers")
    found = numbered.groupBy("path").agg(F.max("odd").alias("odd"), F.max("bad").alias("bad"), F.max("widest").alias("widest"), F.sum("n").alias("rows"))
    rows = (parsed.filter("local > 0").join(numbered.select("path", "block", "before"), ["path", "block"])
            .select("path", (F.col("before") + F.col("local")).cast("long").alias("row_no"), "values"))
    return rows, found


def csv_cells_by_blocks(files: DataFrame, root: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """What :func:`~pagequarry.sources.tabular.csv_cells` gives of the listed files (path, length), however large one of them is."""
    rows, found = csv_rows(files, root, block_bytes)
    first = rows.filter("row_no <= 2").groupBy("path").agg(
        F.max(F.when(F.col("row_no") == 1, F.col("values"))).alias("names"), F.max(F.when(F.col("row_no") == 2, F.size("values"))).alias("second"))
    labels = F.greatest(F.lit(0), F.coalesce("second", F.lit(0)) - F.size("names"))
    heads = (first.join(found.filter("not odd and not bad"), "path").withColumn("labels", labels)
             .filter(F.col("widest") <= F.size("names") + F.col("labels")).select("path", "names", "labels"))
    heads = heads.mapInArrow(_headers, "path string, labels int, header array<string>")
    cells = join_salted(rows, heads, "path", F.col("row_no")).select("path", (F.col("row_no") - 1).cast("int").alias("row_no"), "labels", "values", F.posexplode("header").alias("pos", "column")).select(
        "path", "row_no", (F.col("pos") + 1).alias("col_idx"), "column",
        F.when(F.col("row_no") > 0, F.get("values", F.col("pos") + F.col("labels"))).alias("value"))
    odd = files.join(found.filter("odd and not bad").select("path"), "path", "left_semi")
    return cells.unionByName(csv_cells(read_named(odd.select("path", "length"), root)))


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("labels"), pa.array([header_names(n) for n in batch.column("names").to_pylist()], pa.list_(pa.string()))],
                                         ["path", "labels", "header"])


def read_csv_blocks(spark: SparkSession, files: DataFrame, root: str, schema: str, block_bytes: int = BLOCK_BYTES, header: bool = True) -> DataFrame:
    """One table of the listed files, which share the columns of ``schema`` in its order. Empty values are null; files that cannot be
    read, and files with odd quotes, raise an error rather than vanish."""
    rows, found = csv_rows(files, root, block_bytes)
    wrong = found.filter("odd or bad").select("path").limit(3).collect()
    if wrong:
        raise ValueError("no plain CSV: " + ", ".join(r["path"] for r in wrong))
    fields = spark.createDataFrame([], schema).schema.fields
    value = [F.get("values", F.lit(i)) for i in range(len(fields))]
    return rows.filter(F.col("row_no") > (1 if header else 0)).select(
        *(F.when(v != "", v).try_cast(f.dataType).alias(f.name) for v, f in zip(value, fields)))
