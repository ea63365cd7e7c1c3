"""Inputs of the catalogue queries, derived by Spark from the given tables.

The documents stand for files, conversations for paged documents, customers for documents with
tables, orders for their tables and line items for the table rows. ``labels`` tells what an earlier
run knew: a labelled document was indexed, a low quality one with other content, a toxic one as
failed because it could not be read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry.functions import naming
from pagequarry.operators import embed, pages, registry, tables
from pagequarry.session import materialize, spread
from pagequarry.sources.files import fingerprint, select_supported
from pagequarry.sources.folder import write_named

# Fixed values of the derived corpus.
NAME_PARTS = ("Bank_Statement", "hearing_Transcript", "expert report", "Exhibit", "notes", "transcript of bank")
SUFFIXES = (".pdf", ".xlsx", ".csv", ".txt")
SHEETS = ("Data", "Notes")
PAGE_CHARS = 1800
RUN_TIME = "2024-01-01T00:00:00"
VECTOR_DB = "parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number % len(values)).cast("int") + 1)


def listing(docs: DataFrame) -> DataFrame:
    """path, filename, length and content of the documents as files."""
    filename = F.concat("source", F.lit("_"), _pick(NAME_PARTS, F.col("doc_id")), F.lit(" ("),
                        (F.col("doc_id") % 7).cast("string"), F.lit(") "), F.col("doc_id").cast("string"),
                        _pick(SUFFIXES, F.col("doc_id")))
    return docs.select(F.concat(F.lit("/corpus/"), "lang", F.lit("/"), filename).alias("path"),
                       filename.alias("filename"), F.col("n_chars").alias("length"),
                       F.col("text").alias("content"), F.col("doc_id").alias("source_id"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing(table(spark, sf_dir, "documents"))


def corpus_files(docs: DataFrame) -> DataFrame:
    """file, content and type of the documents as files of a folder: text, workbooks as JSON and CSV; some names are hidden ones, and
    every eighth document holds a table."""
    number = F.col("doc_id")
    lang, source = F.coalesce("lang", F.lit("none")), F.coalesce("source", F.lit("none"))
    hidden = F.when(number % 11 == 0, "_").when(number % 11 == 1, ".").otherwise("")
    filename = F.concat(hidden, source, F.lit("_"), _pick(NAME_PARTS, number), F.lit(" ("), (number % 7).cast("string"), F.lit(") "),
                        number.cast("string"), _pick(SUFFIXES, number))
    bars = F.when(number % 8 == 0, F.format_string("\n| id | source |\n| --- | --- |\n| %d | %s |\n", number, source)).otherwise("")
    sheets = F.format_string('{"Data": [["id", "chars"], [%d, %d]], "Notes": [["note"]]}', number, F.coalesce("n_chars", F.lit(0)))
    csv = F.format_string('id,"source, lang"\n%d,"%s, %s"\n', number, source, lang)
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").alias("source_id"), F.concat(lang, F.lit("/"), filename).alias("file"),
        F.when(number % 4 == 1, sheets).when(number % 4 == 2, csv).otherwise(F.concat(text, bars)).alias("content"))


def write_corpus(spark: SparkSession, sf_dir: str, root: str) -> int:
    """Write the documents' files below ``root``; returns how many there are."""
    return write_named(corpus_files(spread(table(spark, sf_dir, "documents"))), root).count()


def change_corpus(spark: SparkSession, sf_dir: str, root: str) -> int:
    """Write the files of low quality documents again, with a line more."""
    low = labels(spark, sf_dir).filter("quality = 0")
    changed = corpus_files(table(spark, sf_dir, "documents")).join(low.select("source_id"), "source_id", "left_semi")
    return write_named(changed.withColumn("content", F.concat("content", F.lit("\n"))), root).count()


def registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supported files with id, type, category and hash, without their content."""
    supported = select_supported(listing(spread(table(spark, sf_dir, "documents"))))
    return registry.register(fingerprint(supported))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("source_id"), "quality", "toxic")


def earlier_index(registry_table: DataFrame, known: DataFrame) -> DataFrame:
    """What the earlier run stored, given the registry and the labels."""
    old_hash = F.when(F.col("quality") == 0, F.sha2(F.concat("hash", F.lit("-old")), 256)).otherwise(F.col("hash"))
    return registry_table.join(known, "source_id").select(
        "doc_id", "path", "filename", "type", "category", "log", old_hash.alias("hash"),
        F.when(F.col("toxic") == 1, "failed").otherwise("completed").alias("status"))


def registry_and_index(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The registry, written once so that no content is hashed twice, and the earlier index."""
    reg = materialize(registered(spark, sf_dir), "registry")
    return reg, earlier_index(reg, labels(spark, sf_dir))


def records(registered_files: DataFrame, known: DataFrame) -> DataFrame:
    """Document records after extraction."""
    unreadable = F.coalesce("toxic", F.lit(0)) == 1
    page_count = (F.when(F.col("type") == "csv", 1).when(unreadable, 0)
                  .when(F.col("type") == "pdf", F.ceil(F.col("length") / PAGE_CHARS)).otherwise(len(SHEETS)).cast("int"))
    empty = F.array().cast("array<string>")
    doc, cat = F.col("doc_id"), F.col("category")
    names = (
        F.when(F.col("type") == "pdf", F.transform(F.sequence(F.lit(1), F.greatest(F.col("pages"), F.lit(1))), lambda p: naming.page_name(doc, p)))
        .when(F.col("type") == "excel", F.array(*[naming.sheet_output_name(doc, F.lit(s)) for s in SHEETS]))
        .otherwise(F.array(doc)))
    failed = F.col("status") == "failed"
    return (registered_files.join(known, "source_id", "left")
            .withColumn("pages", page_count)
            .withColumn("status", F.when(unreadable, "failed").otherwise("completed"))
            .withColumn("output_md", F.when(failed, empty).otherwise(F.transform(names, lambda n: naming.md_path(cat, n))))
            .withColumn("output_csv", F.when(failed | (F.col("type") == "pdf"), empty)
                        .otherwise(F.transform(names, lambda n: naming.csv_path(cat, n))))
            .drop("quality", "toxic"))


def all_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(registered(spark, sf_dir), labels(spark, sf_dir))


def with_embeddings(recs: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with the outcome of embedding: a document has as many chunks as stored vectors."""
    counts = (table(spark, sf_dir, "embeddings").groupBy(F.col("vec_id").alias("source_id"))
              .agg(F.count(F.lit(1)).alias("chunk_count")))
    return embed.embedding_outcome(recs, counts, VECTOR_DB, key="source_id")


def registry_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source_id and doc_id of every file."""
    return files(spark, sf_dir).select("source_id", naming.doc_id(F.col("filename")).alias("doc_id"))


def paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page rows: a conversation is a document, a turn a page."""
    turns = table(spark, sf_dir, "conversations")
    return pages.page_rows(turns, F.col("conv_id"), F.col("turn") + 1, F.col("text"))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with the name, category and hash of their document."""
    docs = registry.register(fingerprint(files(spark, sf_dir)))
    meta = docs.select(F.col("source_id").cast("string").alias("doc_id"), F.col("doc_id").alias("name_id"),
                       "filename", "category", "hash")
    return pages.page_enriched(paged(spark, sf_dir), meta)


def rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = enriched(spark, sf_dir).withColumn("doc_id", F.col("name_id")).drop("name_id")
    return pages.render_pages(named, F.lit("conversation turns"), RUN_TIME)


def numbered_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the tables of their customer, numbered."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("doc_id"), F.col("o_orderkey").alias("table_id"), "o_orderstatus")
    return tables.table_numbering(orders, "table_id")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("chunk_id"), "embedding", "label")


def label_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query vector per label: the mean of its vectors."""
    items = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    means = items.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return means.groupBy("label").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "m"))), lambda v: v.m).alias("embedding"))


def mean_vector(spark: SparkSession, sf_dir: str) -> list[float]:
    """The mean of all vectors: one row of as many numbers as a vector has."""
    items = table(spark, sf_dir, "embeddings").select(F.posexplode("embedding").alias("pos", "x"))
    means = items.groupBy("pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    middle = means.agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "m"))), lambda v: v.m).alias("m"))
    return middle.first()["m"]
