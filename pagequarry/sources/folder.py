"""A folder of files as a data source, and files written and read by name.

Files are reached through Arrow's file systems, so a folder may be local, on HDFS or in an object store. Folders are listed by the executors, a level after
the other, and the names are dealt out to packs there: the driver knows the packs and no names. Contents are read in blocks by the executors: a hash
needs no file in memory, and a file that cannot be read gives a row that says why.
"""

from __future__ import annotations

import hashlib
import os
import posixpath
from collections.abc import Iterator
from datetime import datetime, timezone
from functools import partial
from itertools import islice

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from pagequarry.config import FILE_TYPES
from pagequarry.session import materialize, work_folder

PACK_BYTES = 128 << 20  # of the files of a task, unless a single one is larger
PACK_FILES = 10_000
BLOCK_BYTES = 4 << 20
CONTENT_LIMIT = 1 << 30  # a larger file has a hash and no content: a value must stay below 2 GiB
FLUSH_BYTES = 8 << 20  # of contents that a task hands on at once

LIST_ROWS = 10_000  # names that a task lists or reads at once
LISTED = "path string, folder boolean, modified double, length bigint"
SCANNED = "path string, modificationTime timestamp, length bigint, hash string, content binary, error string"


def file_system(root: str) -> tuple[pafs.FileSystem, str, str]:
    """(file system, path in it, what precedes its paths in a URI)."""
    if root.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + root[5:].strip("/"), "file:"
    if "://" not in root:
        return pafs.LocalFileSystem(), os.path.abspath(root), "file:"
    fs, path = pafs.FileSystem.from_uri(root)
    return fs, path, root.rstrip("/").removesuffix(path.rstrip("/"))


def read_blocks(fs: pafs.FileSystem, path: str, block: int, keep: int) -> tuple[str | None, bytes | None, str | None]:
    """(SHA-256, content, error) of a file read block by block; content only if it has at most ``keep`` bytes."""
    digest, parts, size = hashlib.sha256(), [], 0
    try:
        with fs.open_input_stream(path) as stream:
            while data := stream.read(block):
                digest.update(data)
                size += len(data)
                if size <= keep:
                    parts.append(data)
                else:
                    parts.clear()
    except OSError as e:
        return None, None, f"{type(e).__name__}: {e}"[:500]
    if size > keep:
        return digest.hexdigest(), None, f"larger than {keep} bytes" if keep else None
    return digest.hexdigest(), b"".join(parts) if keep else None, None


def _supported(path: str, suffixes: tuple[str, ...], any_case: bool) -> bool:
    return (path.lower() if any_case else path).endswith(suffixes)


def _inside(fs: pafs.FileSystem, folder: str) -> Iterator[tuple[str, bool, float, int]]:
    """(path, whether it is a folder, modification time, length) of the files and folders in a folder; none if there is no such folder."""
    if isinstance(fs, pafs.LocalFileSystem):  # one after another, however many there are
        try:
            with os.scandir(folder) as found:
                for f in found:
                    try:
                        if f.is_dir() or f.is_file():
                            yield f.path, f.is_dir(), f.stat().st_mtime_ns / 1e9, 0 if f.is_dir() else f.stat().st_size
                    except FileNotFoundError:  # gone meanwhile
                        continue
        except FileNotFoundError:
            return
    else:
        for f in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
            if f.type in (pafs.FileType.File, pafs.FileType.Directory):
                yield f.path, f.type == pafs.FileType.Directory, f.mtime_ns / 1e9 if f.mtime_ns else 0.0, f.size or 0


def _entries(batches: Iterator[pa.RecordBatch], root: str, suffixes: tuple[str, ...], any_case: bool) -> Iterator[pa.RecordBatch]:
    """The supported files and the folders in each listed folder."""
    fs, _, _ = file_system(root)
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            rows = (r for r in _inside(fs, folder) if r[1] or _supported(r[0], suffixes, any_case))
            while part := list(islice(rows, LIST_ROWS)):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), (pa.string(), pa.bool_(), pa.float64(), pa.int64()))],
                                                 ["path", "folder", "modified", "length"])


def list_folder(spark: SparkSession, root: str, suffixes: tuple[str, ...], any_case: bool = False) -> DataFrame:
    """path, modified and length of the supported files below ``root``, without a scheme. Each level of folders is a job, whose tasks list
    folders; every name counts, also those that begin with a dot or an underscore."""
    level = spark.createDataFrame([(file_system(root)[1],)], "path string")
    files = spark.createDataFrame([], LISTED)
    while (n := level.count()):
        dealt = level.repartition(min(n, 4 * spark.sparkContext.defaultParallelism))
        found = materialize(dealt.mapInArrow(partial(_entries, root=root, suffixes=suffixes, any_case=any_case), LISTED), "listing")
        files = files.union(found.filter("not folder"))
        level = found.filter("folder").select("path")
    return files.drop("folder")


class FilePack(InputPartition):
    """Files (path, modification time, length) that a task scans, or the Parquet file that lists them."""

    def __init__(self, files: list[tuple[str, float, int]], listed: str | None = None):
        super().__init__(None)
        self.files, self.listed = files, listed

    def __iter__(self) -> Iterator[tuple[str, float, int]]:
        yield from self.files
        if self.listed:
            fs, path, _ = file_system(self.listed)
            with fs.open_input_file(path) as f:
                for batch in pq.ParquetFile(f).iter_batches(LIST_ROWS, columns=["path", "modified", "length"]):
                    yield from zip(*(c.to_pylist() for c in batch.columns))


class FolderReader(DataSourceReader):
    """Options: path; suffixes (comma-separated); anyCase (suffixes in any case); content (true: with contents); packBytes, blockBytes, contentLimit;
    packs: a folder of Parquet files that list the files of a pack each. Without it the driver lists the files."""

    def __init__(self, options: dict[str, str]):
        self.root = options["path"]
        self.suffixes = tuple(options.get("suffixes", ",".join(FILE_TYPES)).split(","))
        self.any_case = options.get("anycase", "false").lower() == "true"
        self.keep = int(options.get("contentlimit", CONTENT_LIMIT)) if options.get("content", "false").lower() == "true" else 0
        self.packs = options.get("packs")
        self.pack_bytes, self.block = int(options.get("packbytes", PACK_BYTES)), int(options.get("blockbytes", BLOCK_BYTES))

    def partitions(self) -> list[InputPartition]:
        """Files in path order, cut into packs. Every name counts, also those that begin with a dot or an underscore."""
        if self.packs:
            fs, base, scheme = file_system(self.packs)
            lists = [f.path for f in fs.get_file_info(pafs.FileSelector(base)) if f.path.endswith(".parquet")]
            return [FilePack([], scheme + path) for path in sorted(lists)] or [FilePack([])]
        fs, base, _ = file_system(self.root)
        packs, pack, size = [], [], 0
        found = fs.get_file_info(pafs.FileSelector(base, recursive=True, allow_not_found=True))
        for f in sorted((f for f in found if f.type == pafs.FileType.File), key=lambda f: f.path):
            if not _supported(f.path, self.suffixes, self.any_case):
                continue
            if pack and (size + f.size > self.pack_bytes or len(pack) == PACK_FILES):
                packs.append(FilePack(pack))
                pack, size = [], 0
            pack.append((f.path, f.mtime_ns / 1e9 if f.mtime_ns else 0.0, f.size))
            size += f.size
        return [*packs, FilePack(pack)]

    def read(self, partition: FilePack) -> Iterator[tuple]:
        fs, _, scheme = file_system(self.root)
        for path, modified, length in partition:
            digest, content, error = read_blocks(fs, path, self.block, self.keep)
            yield scheme + path, datetime.fromtimestamp(modified, timezone.utc), length, digest, content, error


class FolderSource(DataSource):
    """``spark.read.format("corpus_folder")``: one row per supported file below ``path``; a missing folder has none."""

    @classmethod
    def name(cls) -> str:
        return "corpus_folder"

    def schema(self) -> str:
        return SCANNED

    def reader(self, schema) -> FolderReader:
        return FolderReader(self.options)


def scan_folder(spark: SparkSession, root: str, any_case: bool = False, content: bool = False, **options: int | str) -> DataFrame:
    """Supported files below ``root`` with their SHA-256. Rows without a hash could not be read; ``error`` says why. The files are those that
    are there when it is called."""
    spark.dataSource.register(FolderSource)
    given = {k.lower(): str(v) for k, v in options.items()}
    listed = list_folder(spark, root, tuple(given.get("suffixes", ",".join(FILE_TYPES)).split(",")), any_case)
    packs = work_folder(spark, "packs")
    _packs(listed, "length", int(given.get("packbytes", PACK_BYTES))).write.parquet(packs)
    reader = spark.read.format("corpus_folder").option("anyCase", str(any_case)).option("content", str(content)).option("packs", packs)
    return reader.options(**given).load(root)


def _packs(files: DataFrame, length: str, pack_bytes: int) -> DataFrame:
    """The listed files dealt out by a hash of their path, about ``pack_bytes`` a partition."""
    total = files.agg(F.count(F.lit(1)), F.coalesce(F.sum(length), F.lit(0))).first()  # one row
    return files.repartition(max(1, -(-total[1] // pack_bytes), -(-total[0] // PACK_FILES)), "path")


def _contents(batches: Iterator[pa.RecordBatch], root: str, block: int, limit: int) -> Iterator[pa.RecordBatch]:
    fs, _, scheme = file_system(root)
    for batch in batches:
        begin, contents, errors, held = 0, [], [], 0

        def flush(to: int) -> pa.RecordBatch:
            part = batch.slice(begin, to - begin)
            return pa.RecordBatch.from_arrays([*part.columns, pa.array(contents, pa.binary()), pa.array(errors, pa.string())],
                                              [*part.schema.names, "content", "error"])

        for i, path in enumerate(batch.column("path").to_pylist()):
            _, content, error = read_blocks(fs, path.removeprefix(scheme), block, limit)
            contents.append(content)
            errors.append(error)
            held += len(content or b"")
            if held > FLUSH_BYTES:
                yield flush(i + 1)
                begin, contents, errors, held = i + 1, [], [], 0
        if contents:
            yield flush(batch.num_rows)


def read_named(files: DataFrame, root: str, length: str = "length", pack_bytes: int = PACK_BYTES, block_bytes: int = BLOCK_BYTES,
               limit: int = CONTENT_LIMIT) -> DataFrame:
    """``files`` (path, length, ...) of the folder ``root`` with their ``content`` and ``error``, read where they were dealt to; however many there are."""
    schema = T.StructType(files.schema.fields).add("content", "binary").add("error", "string")
    return _packs(files, length, pack_bytes).mapInArrow(partial(_contents, root=root, block=block_bytes, limit=limit), schema)


def _write(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    fs, base, _ = file_system(root)
    for batch in batches:
        sizes = []
        for name, content in zip(batch.column("file").to_pylist(), batch.column("content")):
            path = posixpath.join(base, name.lstrip("/"))
            fs.create_dir(posixpath.dirname(path), recursive=True)
            # a name of the attempt's own until it is whole, so that a task that runs twice never leaves half a file
            partly = f"{path}.{os.getpid()}.part"
            with fs.open_output_stream(partly) as out:
                out.write(data := content.as_py())
            fs.move(partly, path)
            sizes.append(len(data))
        kept = [i for i, n in enumerate(batch.schema.names) if n != "content"]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), pa.array(sizes, pa.int64())], [*(batch.schema.names[i] for i in kept), "length"])


def write_named(files: DataFrame, root: str) -> DataFrame:
    """Write each row's ``content`` to the ``file`` below ``root``; gives the other columns and the ``length`` of those written. Lazy: it
    writes when its rows are computed, and a task that runs again writes the same."""
    kept = files.withColumn("content", F.col("content").cast("binary"))
    schema = T.StructType([f for f in kept.schema.fields if f.name != "content"]).add("length", T.LongType())
    return kept.mapInArrow(partial(_write, root=root), schema)
