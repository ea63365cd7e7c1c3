"""Record layouts."""

from pyspark.sql import types as T

EMBEDDING_STATUS = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("vector_db", T.StringType()),
    T.StructField("chunk_count", T.IntegerType()),
    T.StructField("error", T.StringType()),
])

DOCUMENT_INDEX = T.StructType([
    T.StructField("doc_id", T.StringType()),
    T.StructField("filename", T.StringType()),
    T.StructField("hash", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("pages", T.IntegerType()),
    T.StructField("output_md", T.ArrayType(T.StringType())),
    T.StructField("output_csv", T.ArrayType(T.StringType())),
    T.StructField("log", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("created", T.TimestampNTZType()),
    T.StructField("embeddings", EMBEDDING_STATUS),
])

PAGES = T.StructType([
    T.StructField("doc_id", T.StringType()),
    T.StructField("page", T.IntegerType()),
    T.StructField("text", T.StringType()),
    T.StructField("text_length", T.IntegerType()),
])

CHUNKS = T.StructType([
    T.StructField("doc_id", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("file_hash", T.StringType()),
    T.StructField("file_type", T.StringType()),
    T.StructField("page", T.IntegerType()),
    T.StructField("chunk_id", T.StringType()),
    T.StructField("chunk_index", T.IntegerType()),
    T.StructField("chunk_size", T.IntegerType()),
    T.StructField("chunk", T.StringType()),
])
