"""One whole run: scan a folder, process what is new, store the results, report.

Everything is written below ``config.output_dir``, which all executors must share:
``index/`` (keyed log of records), ``md/`` (rendered pages), ``csv/`` (a file per table), ``logs/`` (events) and,
when embedding, ``chunks/``, ``vectors/`` (keyed log) and ``model/``. Each run adds ``batch_id=<run>`` folders or a segment of a log; in ``csv/``, a
document's newer tables replace its older ones.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pagequarry.config import UNSUPPORTED_ERROR, JobConfig
from pagequarry.functions import naming
from pagequarry.operators import chunks, embed, incremental, pages, registry, report, rollup, search, tables
from pagequarry.session import materialize
from pagequarry.sources import stores, tabular
from pagequarry.sources.folder import read_named, scan_folder, write_named
from pagequarry.sources.keyed_log import KeyedLog

RECORD = ("doc_id string, path string, filename string, type string, category string, log string, length bigint, hash string, "
          "pages int, md_files int, csv_files int, status string, created string, "
          "embeddings struct<status:string,vector_db:string,chunk_count:int,error:string>")

@dataclass(frozen=True)
class Run:
    """Tables of one run. ``results`` has every discovered file, ``summary`` one row."""

    results: DataFrame
    summary: DataFrame
    report: DataFrame
    outputs: DataFrame
    markdown: DataFrame


def run_extraction(spark: SparkSession, config: JobConfig, methods: tuple[str, ...] = ("html", "text")) -> Run:
    """Process a folder. ``methods`` names the page extractors to try on PDF files, in order.

    Of new files that share a doc_id the last by path is processed; the others would only have been
    overwritten by it and are reported as 'superseded'. Files no method can read are failed. The scan hashes every file in
    blocks; the contents of the files to process, and of no others, are then read where they are needed.
    """
    started = time.time()
    batch_id, run_time = int(started * 1000), datetime.now().isoformat()
    root = config.output_dir.rstrip("/")
    scan = scan_folder(spark, config.input_dir)
    found = materialize(registry.register(scan.select("path", naming.base_name(F.col("path")).alias("filename"), "length", "hash")), "registry")
    index = KeyedLog(spark, f"{root}/index", RECORD, "doc_id")
    known = index.latest().drop("batch_id")
    flagged = incremental.incremental_split(found, known, config)
    winners = registry.last_record_wins(flagged.filter("is_new").select("doc_id", "path"), "path")
    split = materialize(flagged.join(winners.select("path", F.lit(True).alias("wins")), "path", "left")
                        .withColumn("wanted", F.coalesce("wins", F.lit(False))).drop("wins"), "split")
    wanted = split.filter("wanted").drop("is_new", "wanted")

    def content(kind: str) -> DataFrame:
        return read_named(wanted.filter(F.col("type") == kind), config.input_dir).drop("error")

    pdf_pages = pages.extract_pages(content("pdf"), list(methods), config.estimate_blank_pages)
    page_md = pages.render_pages(pdf_pages, F.col("method"), run_time, "path")
    readers = {"csv": [tabular.csv_table], "excel": [tabular.SHEET_SOURCES[config.sheet_source]] if config.sheet_source else [],
               "pdf": [tabular.TABLE_EXTRACTORS[name] for name in config.table_methods]}
    cells = materialize(_cells(spark, content, readers), "cells")
    table_md = tables.render_cell_tables(cells, found, run_time)
    shared = ["path", "doc_id", "category", "hash", "md_file", "md"]
    markdown = stores.store_markdown(  # the first write: two runs never share a number
        page_md.select(*shared, "page").unionByName(table_md.select(*shared, F.col("table_no").alias("page"))),
        f"{root}/md/batch_id={batch_id}", mode="errorifexists")
    csv_files = materialize(_write_tables(spark, content, readers, root), "csv")

    counts = (markdown.groupBy("path").agg(F.count(F.lit(1)).cast("int").alias("md_files"))
              .join(csv_files.groupBy("path").agg(F.count_distinct("csv_file").cast("int").alias("csv_files")), "path", "full"))
    readable = F.coalesce("md_files", F.lit(0)) > 0
    unread = F.lit(config.sheet_source is None) & (F.col("type") == "excel") & F.col("wanted")
    status = (F.when(~F.col("is_new"), "skipped").when(~F.col("wanted"), "superseded")
              .when(readable, "completed").otherwise("failed"))
    done = (split.join(counts, "path", "left").withColumn("status", status).withColumn("error", F.when(unread, UNSUPPORTED_ERROR))
            .withColumn("pages", F.when(~F.col("wanted") & F.col("is_new"), 0).when(F.col("type") == "csv", 1).when(F.col("type") == "csv", 1).otherwise(F.coalesce("md_files", F.lit(0))))
            .fillna(0, ["md_files", "csv_files"]).withColumn("created", F.lit(run_time)))
    if config.embed:
        chunk_counts = _embed(markdown, split.filter("wanted").select("doc_id"), root, batch_id, config).join(split.filter("wanted").select("doc_id", "path"), "doc_id")
        done = embed.embedding_outcome(done, chunk_counts, "parquet", key="path")
    else:
        done = done.withColumn("embeddings", F.lit(None).cast("struct<status:string,vector_db:string,chunk_count:int,error:string>"))
    results = materialize(done, "results")

    # A PDF without pages, or a workbook that nothing reads, is reported but not indexed, so that the next run tries it again.
    fields = [f.split()[0] for f in RECORD.split(", ")]
    indexed = results.filter("wanted and not (type = 'pdf' and pages = 0) and error is null")
    index.upsert(indexed.select(*fields), batch_id)
    stores.append_events(report.doc_events(results, run_time, datetime.now().isoformat()), f"{root}/logs", batch_id)
    page_results = markdown.select("doc_id", "page", "md_file")
    table_results = csv_files.select("doc_id", "method", F.col("table_no").alias("table_idx"), "csv_file")
    return Run(
        results=results,
        summary=report.run_summary(results, time.time() - started),
        report=report.status_report(results.filter("is_new"), results.filter("not is_new")),
        outputs=rollup.doc_rollup(page_results, table_results),
        markdown=markdown)


def _cells(spark: SparkSession, content, readers: dict[str, list[tabular.TableSource]]) -> DataFrame:
    """Cells of the files that are tables: CSV files, and workbooks if there is a reader of sheets."""
    cells = spark.createDataFrame([], tabular.TABLE_CELLS)
    for kind in ("csv", "excel"):
        for read in readers[kind]:
            cells = cells.union(tabular.table_cells(content(kind), read))
    return cells


def _write_tables(spark: SparkSession, content, readers: dict[str, list[tabular.TableSource]], root: str) -> DataFrame:
    """Write every table as a CSV file under the name that the results report: path, doc_id, method, table_no, csv_file."""
    written = spark.createDataFrame([], "path string, doc_id string, method string, table_no int, csv_file string")
    for kind, sources in readers.items():
        for n, read in enumerate(sources):
            texts = tabular.table_texts(content(kind), read)
            name = naming.base_name(F.col("path"))
            doc = naming.doc_id(name)
            named = texts.select("path", doc.alias("doc_id"), F.lit(f"{kind}{n}").alias("method"), "table_no",
                                 naming.csv_path(naming.category(name), tabular.output_name(doc, kind)).alias("file"), "content")
            written = written.unionByName(write_named(named, root).drop("length").withColumnRenamed("file", "csv_file"))
    return written


def _embed(markdown: DataFrame, processed: DataFrame, root: str, batch_id: int, config: JobConfig) -> DataFrame:
    """Chunk and embed the run's Markdown; returns chunk counts per document.

    The model is fitted by the first run and kept, so that vectors of all runs can be compared.
    """
    made = stores.store(chunks.chunk_markdown(markdown, config), f"{root}/chunks/batch_id={batch_id}")
    # vectors don't depend on when a page was read
    plain = made.withColumn("whole_chunk", F.col("chunk")).withColumn("chunk", F.regexp_replace("chunk", r"- Processing timestamp: \S*", ""))
    embedder = load_embedder(f"{root}/model", config)
    if embedder is None and made.isEmpty():
        return made.select(F.col("source_doc_id").alias("doc_id"), F.lit(0).cast("long").alias("chunk_count"))  # nothing to learn from
    if embedder is None:
        embedder = embed.EMBEDDERS[config.embedding_model].fit(plain)
        embedder.save(f"{root}/model")
    vectors = embedder.embed(plain).withColumn("chunk", F.col("whole_chunk")).drop("whole_chunk")
    # a processed document without a chunk replaces its earlier vectors by a row without one
    gone = processed.join(made.select(F.col("source_doc_id").alias("doc_id")), "doc_id", "left_anti").select(F.col("doc_id").alias("source_doc_id"))
    _vectors(spark=made.sparkSession, root=root, schema=vectors.schema).upsert(vectors.unionByName(gone, allowMissingColumns=True), batch_id)
    return made.groupBy(F.col("source_doc_id").alias("doc_id")).agg(F.count(F.lit(1)).alias("chunk_count"))


def load_embedder(path: str, config: JobConfig):
    try:
        return embed.EMBEDDERS[config.embedding_model].load(path)
    except Exception as e:  # noqa: BLE001 - the reader of models has no type of its own for a missing path
        if "does not exist" not in str(e):
            raise
        return None


def _vectors(spark: SparkSession, root: str, schema: StructType) -> KeyedLog:
    return KeyedLog(spark, f"{root}/vectors", schema, "source_doc_id")


def stored_vectors(spark: SparkSession, config: JobConfig) -> DataFrame | None:
    """For each document the vectors of the last run that processed it; None before the first. However many runs there were, a
    read opens a few sorted segments."""
    root = config.output_dir.rstrip("/")
    try:
        schema = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/vectors/segments").schema
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None
    return _vectors(spark, root, schema).latest().filter(F.col("chunk_id").isNotNull())


def search_run(spark: SparkSession, config: JobConfig, query: str, k: int | None = None, condition: Column | None = None) -> DataFrame | None:
    """The k chunks nearest to a text, among those whose metadata meets ``condition``; None when nothing has been embedded yet."""
    vectors = stored_vectors(spark, config)
    if vectors is None:
        return None
    if condition is not None:
        vectors = vectors.filter(condition)
    embedder = load_embedder(f"{config.output_dir.rstrip('/')}/model", config)
    return search.format_hits(search.search_documents(vectors, embedder, query, k or config.search_k))


def export_index(spark: SparkSession, config: JobConfig, path: str) -> None:
    """Write the current index as JSON lines."""
    root = config.output_dir.rstrip("/")
    stores.export_index_json(KeyedLog(spark, f"{root}/index", RECORD, "doc_id").latest().drop("batch_id"), path)
